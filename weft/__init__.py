"""weft: text and speech corpus preparation as lazy Spark DataFrame transformations."""

from weft.functions.text import clean_text, content_hash, is_usable, latin_ratio, word_count
from weft.operators.corpus import add_columns, clean_web, file_corpus, first_wins, split_documents
from weft.operators.dedup import append_to, dedup_against
from weft.operators.split import shards, train_test
from weft.sources.writers import publish

__all__ = ["add_columns", "append_to", "clean_text", "clean_web", "content_hash", "dedup_against", "file_corpus", "first_wins", "is_usable", "latin_ratio", "publish", "shards", "split_documents", "train_test", "word_count"]
