"""String functions with Python's notion of white space, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that Python's str.split() takes for white space, for Java and for RE2.
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS_RE2 = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

_WS_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: A run of white space; the two ranges in front turn most letters away before the list is gone through.
_GAP = rf"[\t-\x20\x85-\u3000&&[{WS}]]+"

# The 18 universal part-of-speech columns.
TAGS = ("ADJ", "NOUN", "PUNCT", "PROPN", "VERB", "SYM", "NUM", "PART", "SCONJ", "ADP", "DET", "PRON", "SPACE", "CCONJ", "INTJ", "X", "AUX", "ADV")


def py_strip(c: Column) -> Column:
    """str.strip(). Trimming by a list of characters looks at the ends only; a pattern would be tried at every character."""
    return F.trim(c, F.lit(_WS_CHARACTERS))


def words(c: Column) -> Column:
    """str.split(): an empty array for a blank text."""
    bare = py_strip(c)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _GAP))


def word_count(c: Column) -> Column:
    """len(str.split()); null for null."""
    return F.when(c.isNotNull(), F.size(words(c)))


def one_line(c: Column, strip: bool = True) -> Column:
    """A caption, stripped unless told otherwise, with its line feeds as spaces."""
    return F.replace(py_strip(c) if strip else c, F.lit("\n"), F.lit(" "))


def clean_text(c: Column) -> Column:
    """Lower case; only ASCII letters, underscores and single spaces stay; trimmed."""
    kept = F.regexp_replace(F.lower(c), r"[^a-z_\t-\r\x1c-\x20]", "")
    return F.trim(F.regexp_replace(kept, r"[\t-\r\x1c-\x20]+", " "))


def strip_end(c: Column, chars: str = " .") -> Column:
    """Without any of ``chars`` at the end."""
    return F.rtrim(c, F.lit(chars))


def label_of(c: Column, pattern: str = r"^__label__(.+)$") -> Column:
    """The first group of a pattern; '' without a match."""
    return F.regexp_extract(c, pattern, 1)


def tag_string(tags: Column) -> Column:
    """Tags joined by '_' with one more at the end; '' for no tags."""
    return F.when(F.size(tags) == 0, F.lit("")).otherwise(F.concat(F.array_join(tags, "_"), F.lit("_")))


def tags_of(joined: Column) -> Column:
    """The tags of a tag_string()."""
    return F.filter(F.split(joined, "_"), lambda x: x != "")


def signature(tags: Column) -> Column:
    """Sorted distinct tags joined by '_'."""
    return F.array_join(F.array_sort(F.array_distinct(tags)), "_")


def n_kinds(tags: Column) -> Column:
    """Number of distinct tags; an empty array counts 1, like an empty string cut at '_'."""
    return F.greatest(F.size(F.array_distinct(tags)), F.lit(1))


def tag_counts(tags: Column) -> dict[str, Column]:
    """One integer column for each of TAGS."""

    def times(tag: str) -> Column:
        return F.size(F.filter(tags, lambda x: x == tag))

    return {t: times(t).alias(t) for t in TAGS}


def is_uid(c: Column) -> Column:
    return c.rlike("^[0-9a-fA-F]{32}$")


def uid_halves(c: Column) -> tuple[Column, Column]:
    """The two unsigned 64-bit halves of a 32-digit uid, as decimals. Anything else raises."""
    good = F.when(is_uid(c), c).otherwise(F.raise_error(F.concat(F.lit("not a 32-digit uid: "), F.coalesce(c, F.lit("null")))).cast("string"))
    half = lambda at: F.conv(F.substring(good, at, 16), 16, 10).cast("decimal(20,0)")
    return half(1), half(17)
