"""Corpus statistics and the data set card."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def totals(df: DataFrame) -> DataFrame:
    """One row: documents, and sum, mean (1 place, ties to even), min and max of token_count; 0 if empty (A1)."""
    t = F.col("token_count")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return df.agg(F.count("*").alias("total_docs"), zero(F.sum(t)).alias("total_tokens"), F.coalesce(F.bround(F.avg(t), 1), F.lit(0.0)).alias("avg_tokens"), zero(F.min(t)).alias("min_tokens"), zero(F.max(t)).alias("max_tokens"))


def by_source(df: DataFrame) -> DataFrame:
    """Documents per source, most first, ties by name (A2, O1)."""
    return df.groupBy("source").agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "source")


def files_by_source(records: DataFrame, files: DataFrame) -> DataFrame:
    """Documents and files of every source and language of the files, those without documents too (A5)."""
    keys = ["source", "language"]
    docs = records.groupBy(*keys).agg(F.count("*").alias("documents"))
    held = files.groupBy(*keys).agg(F.count("*").alias("files"))
    same = [held[k].eqNullSafe(docs[k]) for k in keys]
    return held.join(docs, same, "left").select(held.source, held.language, F.coalesce("documents", F.lit(0)).alias("documents"), "files")


def by_language(df: DataFrame) -> DataFrame:
    """Documents and tokens per language (A3)."""
    return df.groupBy("language").agg(F.count("*").alias("documents"), F.sum("token_count").alias("tokens"))


def language_table(df: DataFrame) -> DataFrame:
    """by_language with a Total row (A4)."""
    rolled = df.rollup("language").agg(F.grouping("language").alias("g"), F.count("*").alias("documents"), F.sum("token_count").alias("tokens"))
    return rolled.select(F.when(F.col("g") == 1, "Total").otherwise(F.col("language")).alias("language"), "documents", "tokens")


def card_state(df: DataFrame) -> DataFrame:
    """The figures of a card from one scan (A1 to A4, K7): documents, tokens, and fewest and most tokens of all
    rows, of each source and of each language, as (kind, name) rows. States of parts of a corpus can be put
    together by merged()."""
    t = F.col("token_count")
    sets = df.groupingSets([[], ["source"], ["language"]], "source", "language").agg(F.grouping_id().alias("g"), F.count("*").alias("documents"), F.count(t).alias("counted"), F.coalesce(F.sum(t), F.lit(0)).alias("tokens"), F.min(t).alias("min_tokens"), F.max(t).alias("max_tokens"))
    kind = F.when(F.col("g") == 3, "total").when(F.col("g") == 1, "source").otherwise("language")
    name = F.when(F.col("g") == 1, F.col("source")).when(F.col("g") == 2, F.col("language"))
    return sets.select(kind.alias("kind"), name.alias("name"), "documents", "counted", "tokens", "min_tokens", "max_tokens")


def merged(states: DataFrame) -> DataFrame:
    """One state of the states of several parts: sums of sums, least of least."""
    return states.groupBy("kind", "name").agg(*[F.sum(c).alias(c) for c in ("documents", "counted", "tokens")], F.min("min_tokens").alias("min_tokens"), F.max("max_tokens").alias("max_tokens"))


def add_to_card(new: DataFrame, path: str, name: str) -> DataFrame:
    """Put the state of the new rows of an append beside the states at `path`, in the place of one of the same
    name, and return the whole corpus's: no row of an earlier append is read again."""
    card_state(new).coalesce(1).write.mode("overwrite").parquet(f"{path}/append={name}")
    return merged(new.sparkSession.read.parquet(path))


def render_card(df: DataFrame, name: str, language: str, existing: str | None = None) -> str:
    """Markdown card of a corpus (K7), from one scan of it."""
    return render_state(card_state(df), name, language, existing)


def render_state(state: DataFrame, name: str, language: str, existing: str | None = None) -> str:
    """Markdown card of a state: the existing front matter, or a plain one, then the tables. As many rows reach the
    driver as there are sources and languages."""
    rows = state.collect()
    if existing and existing.startswith("---") and "---" in existing[3:]:
        front = existing[: existing.index("---", 3) + 3]
    else:
        front = f"---\nlanguage:\n- {language}\ntask_categories:\n- text-generation\n---"
    none = {"documents": 0, "counted": 0, "tokens": 0, "min_tokens": 0, "max_tokens": 0}  # an empty corpus has no rows
    t = next((r for r in rows if r["kind"] == "total"), none)
    mean = float(round(Decimal(t["tokens"]) / t["counted"], 1)) if t["counted"] else 0.0
    figures = [("Documents", t["documents"]), ("Tokens", t["tokens"]), ("Mean tokens", mean), ("Fewest tokens", t["min_tokens"] or 0), ("Most tokens", t["max_tokens"] or 0)]
    most_first = lambda kind: sorted((r for r in rows if r["kind"] == kind), key=lambda r: (-r["documents"], r["name"] is not None, r["name"] or ""))
    sources = [f"| `{r['name']}` | {r['documents']:,} |" for r in most_first("source")]
    languages = [f"| `{r['name']}` | {r['documents']:,} | {r['tokens']:,} |" for r in most_first("language")]
    languages.append(f"| **Total** | **{t['documents']:,}** | **{t['tokens']:,}** |")
    parts = [
        front, f"# {name}", "## Sources", "\n".join(["| Source | Documents |", "|---|---|", *sources]), "## Statistics",
        "\n".join(["| Figure | Value |", "|---|---|", *(f"| {k} | {v:,} |" for k, v in figures)]), "## Languages", "\n".join(["| Language | Documents | Tokens |", "|---|---|---|", *languages]),
    ]
    return "\n\n".join(parts) + "\n"


def append_card(existing: str, section: str, marker: str) -> str:
    """A card with a section after a marker comment, replaced when it is there already (K8)."""
    tag = f"<!-- {marker} -->"
    return existing.split(tag)[0].rstrip() + f"\n\n{tag}\n{section.strip()}\n"
