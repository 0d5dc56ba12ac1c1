"""Column -> Column text functions with the semantics of Python's ``re`` and ``str`` on Java patterns.

Every pattern carries ``(?dU)``: Unicode classes and only ``\\n`` as a line end. ``\\s`` is widened by
U+001C-U+001F, which Python counts as white space; word boundaries are look-aheads over letters, numbers
and the underscore.
"""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Lines dropped as boilerplate. Anchored at the line's start; END stands for a word's end.
LINE_CASED = [
    r"\s*\|[\s|\-:]+\|\s*$",
    r"\s*\|.*\|\s*$",
    r"\s*-\s*\[.+?\]\(https?://[^)]+\)",
    r"\s*\[.+?\]\(https?://[^)]+\)\s*$",
    r"\s*https?://\S+\s*$",
    r"\s*!\[.*?\]\(.*?\)\s*$",
    r"\s*(Share|Tweet|Pin|Email|Print|Like|Follow|Subscribe|Sign [Ii]n|Log [Ii]n|Sign [Uu]p|Log [Oo]ut|Create Blog|Register)END",
    r"\s*en\s*$",
]
#: The same, in either case.
LINE_UNCASED = [
    r"\s*\[Skip to",
    r"\s*(Home|About|Contact|Privacy|Terms|FAQ|Search|Menu|Navigation|Sidebar|Footer|Header)\s*[|\-\\]?\s*$",
    r"\s*(WordPress|Blogger|Tumblr|Blogspot)END",
    r"\s*-\s*About WordPress\s*$",
    r"\s*-\s*Search\s*$",
    r"\s*-\s*(Documentation|Support|Feedback|Learn WordPress|Get WordPress)\s*$",
    r"\s*BREAKING NEWS\s*:?\s*$",
    r"\s*Close this dialog\s*$",
    r"\s*Close suggestions",
    r"\s*SearchSearch\s*$",
    r"\s*Download free for \d+ days\s*$",
    r"\s*\d+\s*ratings?",
    r"\s*\d+%\s*found this document useful",
    r"\s*\d+[KM]?\s*views?\s*\d*\s*pages?\s*$",
    r"\s*(Change Language|en\s*Change Language)\s*$",
    r"\s*(Facebook|Twitter|Instagram|YouTube|TikTok|LinkedIn|Pinterest|Vimeo|VKontakte)\s*$",
    r"\s*ArticlePDF Available\s*$",
    r"\s*DOI\s*:",
    r"\s*UploadedbyEND",
    r"\s*AI-en",
    r"\s*PPTX?,\s*PDF",
    r"\s*\d+\s*views?\s*$",
    r"\s*Latest\s*$",
    r"\s*MoreShareEND",
    r"\s*Report Abuse\s*$",
]
#: The same, anywhere in the line, in either case.
LINE_ANYWHERE = ["cookie", "Opens in a new window"]
#: Fixed value: the last code point that counts as Latin.
LAST_LATIN = 0x24F

SPACE = r"[\s\x1c-\x1f]"
#: The characters of SPACE, for trimming, which needs no pattern then.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LETTER = r"[a-zA-ZÀ-ɏ]"
LINE_END = "[\n\u0085  ]"


def _anchored(patterns: list[str]) -> str:
    """Alternatives behind the white space that all of them begin with."""
    return rf"\s*(?:{'|'.join(p.removeprefix(chr(92) + 's*') for p in patterns)})".replace("END", r"(?![\p{L}\p{N}_])")


#: Every listed pattern begins with white space, so it is skipped once for all of them.
BOILERPLATE = f"(?dU)^(?:{_anchored(LINE_CASED)}|(?iu:{_anchored(LINE_UNCASED)}))"
ANYWHERE = f"(?diuU){'|'.join(LINE_ANYWHERE)}"
#: No line without a match of this is changed by clean_markup.
MARKED = r"[<\[(\\|\t]|http|  "


def _replace(c: Column, pattern: str, by: str = "", flags: str = "dU") -> Column:
    return F.regexp_replace(c, F.lit(f"(?{flags}){pattern}"), F.lit(by))


def _where(c: Column, mark: str, f: Callable[[Column], Column]) -> Column:
    """f of texts that hold a mark, which is looked for in their bytes. Bound as a lambda variable, so that the text
    is made once."""
    return F.transform(F.array(c), lambda x: F.when(F.contains(x, F.lit(mark)), f(x)).otherwise(x))[0]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def normalize_line_ends(c: Column) -> Column:
    """CRLF and CR become LF, control characters but tab and LF go."""
    return F.regexp_replace(_where(c, "\r", lambda x: F.regexp_replace(x, "\r\n?", "\n")), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def collapse_blank_lines(c: Column) -> Column:
    """Three line ends or more become two; outer white space goes."""
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def lines(c: Column) -> Column:
    """Lines of a text that went through normalize_line_ends."""
    return F.split(c, LINE_END, -1)


def word_count(c: Column) -> Column:
    """White-space words; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)[^\s\x1c-\x1f]+")), F.lit(0)).cast("int")


def latin_ratio(c: Column) -> Column:
    """Share of characters up to U+024F among those that are not white space; 0 without any (T11). Two passes, of
    which the second leaves next to nothing of a Latin text."""
    solid = F.length(_replace(c, rf"{SPACE}+"))
    high = F.length(F.regexp_replace(c, r"(?U)[\x00-\x{24F}\s]+", ""))
    # Bound as a lambda variable: filters compute an expression anew at each of its uses.
    return F.coalesce(F.transform(F.array(solid), lambda n: F.try_divide(n - high, n))[0], F.lit(0.0))


def content_hash(c: Column) -> Column:
    """MD5 of the text; null counts as empty (H1)."""
    return F.md5(F.coalesce(c, F.lit("")))


def is_boilerplate(line: Column) -> Column:
    return line.rlike(BOILERPLATE) | line.rlike(ANYWHERE)


def has_letter(line: Column) -> Column:
    return line.rlike(LETTER)


def is_usable(c: Column, min_words: int = 30, min_latin_ratio: float = 0.4) -> Column:
    """Enough words and enough Latin (F1)."""
    return (word_count(c) >= min_words) & (latin_ratio(c) >= min_latin_ratio)


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """HTML entities decoded, the full HTML 5 table (T5)."""
    return texts.map(html.unescape, na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def unescape_each(texts: pd.Series) -> pd.Series:
    """The lines of a text, with their entities decoded one by one: what a line decodes to may hold line ends."""
    return texts.map(lambda t: [html.unescape(x) if "&" in x else x for x in t.split("\n")], na_action="ignore")


#: Rewrites 2-13 of a line (pattern, replacement, flags), in their order.
MARKUP = [
    ("<[^>]+>", "", "dU"),
    (r"!\[.*?\]\(.*?\)", "", "dU"),
    (r"\[([^\]]+)\]\(https?://[^)]+\)", "$1", "dU"),
    (r"\[\*{0,2}([^\]\n]+)\*{0,2}\]\(", "$1 ", "dU"),
    (r"\[([^\]\n]*)\][\s\x1c-\x1f]*$", "$1", "mdU"),
    (r"\[([^\]]{1,100})\](?!\()", "$1", "dU"),
    (r"https?://[^\s\x1c-\x1f]+", "", "dU"),
    (r"\[\s*\d+\s*\]", "", "dU"),
    (r"\(\s*\d+\s*\)", "", "dU"),
    (r"\\+", " ", "dU"),
    (r"[\s\x1c-\x1f]*\|[\s\x1c-\x1f]*", " ", "dU"),
    ("[ \t]+", " ", "dU"),
]
#: Rewrites of a text of the file corpus before its lines are dropped, behind what each of them needs.
CORPUS = [
    ("~", r"([\p{L}\p{N}_])~([\p{L}\p{N}_])", "$1$2", "dU"),
    ("'", r"'[\s\x1c-\x1f]+([a-zA-Z])", "'$1", "dU"),
    ("[", r"\[\s*\d+\s*\]", "", "dU"),
    ("(", r"\(\s*\d+\s*\)", "", "dU"),
]
#: Lines of the file corpus that go, by what they begin with.
TITLE, RULE = r"(?dUiu)^Title\s*:", r"^[=\-*.]{2,}"
#: Fixed value: a line of nothing but parentheses.
PARENTHESES = r"^[\s\x1c-\x1f]*\(.*?\)[\s\x1c-\x1f]*$"


def clean_markup(c: Column) -> Column:
    """Rewrites 2-13 of an unescaped line: tags, images, links, brackets, URLs, notes, bars, blanks (T4)."""
    out = c
    for pattern, by, flags in MARKUP:
        out = _replace(out, pattern, by, flags)
    return F.when(c.rlike(MARKED), out).otherwise(c)


def clean_inline(c: Column) -> Column:
    return clean_markup(unescape(c))


def clean_text(c: Column) -> Column:
    """The web cleaner: boilerplate lines go, the rest is rewritten, lines without letters go, blank
    ones stay (T1). Null gives the empty text."""
    c = F.coalesce(c, F.lit(""))
    kept = F.filter(lines(normalize_line_ends(c)), lambda x: ~is_boilerplate(x))
    # A text's lines are made once: for Python if it has an ampersand, else here.
    decoded = F.coalesce(unescape_each(F.when(F.contains(c, F.lit("&")), F.array_join(kept, "\n"))), kept)
    rewritten = F.transform(decoded, lambda x: strip(clean_markup(x)))
    return collapse_blank_lines(F.array_join(F.filter(rewritten, lambda x: (x == "") | has_letter(x)), "\n"))


def clean_corpus(c: Column, lang: Column) -> Column:
    """The file-corpus cleaner (T7); lines of nothing but parentheses are blanked where lang is ceb."""
    c = F.coalesce(unescape(F.when(F.contains(c, F.lit("&")), c)), c)
    c = normalize_line_ends(c)
    for mark, pattern, by, flags in CORPUS:
        c = _where(c, mark, lambda x: _replace(x, pattern, by, flags))  # noqa: B023
    dropped = lambda s: s.rlike(TITLE) | s.rlike(RULE) | ((s != "") & ~has_letter(s))
    # No later rewrite leaves white space at a line's ends or makes a line, so lines are cut and stripped here only.
    c = F.array_join(F.filter(F.transform(lines(c), strip), lambda s: ~dropped(s)), "\n")
    c = F.transform(F.array(c), lambda x: F.when(lang == "ceb", _replace(x, PARENTHESES, "", "mdU")).otherwise(x))[0]
    return collapse_blank_lines(_replace(c, "[ \t]+", " "))


def clean_sentence(c: Column) -> Column:
    """Parentheses go, white space becomes single blanks."""
    return strip(_replace(_replace(c, r"\(.*?\)"), rf"{SPACE}+", " "))
