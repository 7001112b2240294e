"""What a model must look like, adapters to columns, and offline stand-ins.

The stand-ins are rules, not models: they keep the shape of the results (labels with a
score, universal tags, pair scores) so that real models can take their place.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate, chain
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from quern.functions import text

_LOADED: dict[str, object] = {}


class LanguageScorer(Protocol):
    def __call__(self, captions: list[str]) -> list[tuple[str, float]]: ...


class PosTagger(Protocol):
    def __call__(self, captions: list[str]) -> list[list[str]]: ...


class PairScorer(Protocol):
    def __call__(self, images: list[bytes], captions: list[str]) -> list[float]: ...


def loaded(key: str, make: Callable[[], object]) -> object:
    """A model made once per worker process."""
    if key not in _LOADED:
        _LOADED[key] = make()
    return _LOADED[key]


def language_column(caption: Column, key: str, make: Callable[[], LanguageScorer], strip: bool = True) -> Column:
    """struct(label, score) of a language model, which sees captions as one line; null captions stay null. Marked non-deterministic, as tags_column() is."""

    @F.pandas_udf("label string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = loaded(key, make)
        for s in batches:
            good = s.notna()
            out = pd.DataFrame({"label": pd.Series([None] * len(s), dtype=object), "score": float("nan")})
            found = model(s[good].tolist()) if good.any() else []
            out.loc[good.to_numpy(), "label"] = [x for x, _ in found]
            out.loc[good.to_numpy(), "score"] = [float(x) for _, x in found]
            yield out

    return run.asNondeterministic()(text.one_line(caption, strip))


def tags_column(caption: Column, key: str, make: Callable[[], PosTagger]) -> Column:
    """array of tags. Marked non-deterministic, so that filters before it stay below it and it sees survivors only."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loaded(key, make)
        for s in batches:
            good = s.notna()
            found = iter(model(s[good].tolist()) if good.any() else [])
            yield pd.Series([next(found) if g else None for g in good])

    return run.asNondeterministic()(caption)


def pair_column(image: Column, caption: Column, key: str, make: Callable[[], PairScorer]) -> Column:
    """Score of each (image, caption) pair, a whole batch at a time."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = loaded(key, make)
        for a, b in batches:
            good = a.notna() & b.notna()
            out = pd.Series(float("nan"), index=a.index)
            if good.any():
                out[good] = model(a[good].tolist(), b[good].tolist())
            yield out

    return F.nullif(run.asNondeterministic()(image, caption), F.lit(float("nan")))


def generated_column(source: Column, key: str, make: Callable[[], Callable[[list], list]], kind: str = "string") -> Column:
    """What a generating model makes of each value, a batch at a time: a caption of an image, an image of a caption."""

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loaded(key, make)
        for s in batches:
            good = s.notna()
            made = iter(model(s[good].tolist()) if good.any() else [])
            yield pd.Series([next(made) if g else None for g in good], dtype=object)

    return run.asNondeterministic()(source)


def mask_column(fn: Callable[..., list[bool]], *columns: Column, **params) -> Column:
    """A list-to-list-of-booleans filter function as a boolean column."""

    @F.pandas_udf("boolean")
    def run(*series: pd.Series) -> pd.Series:
        lists = [s.tolist() for s in series]
        return pd.Series(fn(lists[0] if len(lists) == 1 else lists, **params), dtype="boolean")

    return run(*columns)


# Frequent words of four languages.
STOP_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "en": "the of and to in a is that for it was on are as with his they at be this from".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se".split(),
}
#: First match wins; the last one matches everything.
TAG_RULES = (
    ("PUNCT", r"^[^A-Za-z0-9\x{80}-\x{10ffff}]+$"),
    ("NUM", r"^[0-9][0-9.,]*$"),
    ("DET", r"^(?i:the|a|an|this|that)[.,]?$"),
    ("ADP", r"^(?i:of|to|in|for|with|on|at|by|from)[.,]?$"),
    ("CCONJ", r"^(?i:and|or|but)[.,]?$"),
    ("AUX", r"^(?i:is|was|are|be)[.,]?$"),
    ("PRON", r"^(?i:it|he|they|his)[.,]?$"),
    ("ADV", r"ly[.,]?$"),
    ("VERB", r"(ing|ed)[.,]?$"),
    ("ADJ", r"(ble|al|ous|er|est)[.,]?$"),
    ("PROPN", r"^[A-Z]"),
    ("NOUN", r""),
)


#: Rows worked on at a time, words that a worker remembers the tags of, and code points of the longest such word.
ROWS, REMEMBERED, LONGEST = 512, 1 << 17, 64
_HITS = {w: tuple(i for i, known in enumerate(STOP_WORDS.values()) if w in known) for w in chain(*STOP_WORDS.values())}


def language_of(caption: str) -> tuple[str, float]:
    """(label, score): the language whose frequent words occur most, and its share of all such hits; ties by code."""
    hits = [0] * len(STOP_WORDS)
    lower = caption.replace("\u0130", "i").lower()  # one code point stays one, as in the SQL
    for w, n in Counter(filter(_HITS.__contains__, lower.split())).items():
        for i in _HITS[w]:
            hits[i] += n
    best, total = max(hits), sum(hits)
    return f"__label__{[*STOP_WORDS][hits.index(best)]}", best / total if total else 0.0


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for a in batches:
        for lo in range(0, len(a), ROWS):
            yield a.slice(lo, ROWS)


def stand_in_language(caption: Column) -> Column:
    """struct(label, score) as language_of() says; nulls for a null caption. Marked non-deterministic, so that filters on both parts don't work it out twice."""
    from quern.plans.shipping import ship

    ship(SparkSession.active())

    @F.arrow_udf("label string, score double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in _slices(batches):
            found = [language_of(x.as_py()) if x.is_valid else (None, None) for x in a]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["label", "score"])

    return run.asNondeterministic()(caption)


def _python_rule(rule: str) -> re.Pattern:
    """A rule of TAG_RULES for Python. Without regard to case, RE2 takes the long s for an s, Python also marks with and without a dot for an i."""
    rule = rule.replace(r"\x{80}-\x{10ffff}", "\x80-\U0010ffff")
    if m := re.fullmatch(r"\^\(\?i:([a-z|]+)\)(.*)", rule):
        rule = "^(" + "".join(c if c == "|" else f"[{c}{c.upper()}{chr(0x17F) if c == 's' else ''}]" for c in m[1]) + ")" + m[2]
    return re.compile(rule)


_PYTHON_RULES = [_python_rule(rule) for _, rule in TAG_RULES]
_PLACES = {name: i for i, (name, _) in enumerate(TAG_RULES)}
#: Word or ending to the place of its tag, from those rules that are lists of words or of endings; no word has two of these endings.
_LISTED = {w: i for i, (_, rule) in enumerate(TAG_RULES) if (m := re.fullmatch(r"\^\(\?i:([a-z|]+)\)\[\.,\]\?\$", rule)) for w in m[1].split("|")}
_ENDINGS = {w: i for i, (_, rule) in enumerate(TAG_RULES) if (m := re.fullmatch(r"\(?([a-z|]+)\)?\[\.,\]\?\$", rule)) for w in m[1].split("|")}
_LONGEST_LISTED = max(map(len, _LISTED))
_LETTER = re.compile("[A-Za-z\x80-\U0010ffff]")


def tag_number(w: str) -> int:
    """The place of the first rule that holds for a word; for one with a letter by lookups, as texts have ever new words."""
    if not (w[0].isalpha() or _LETTER.search(w)):
        return next(i for i, rule in enumerate(_PYTHON_RULES) if rule.search(w))
    bare = w[:-1] if w[-1] in ".," else w
    found = _LISTED.get(bare.replace("\u017f", "s").lower()) if len(bare) <= _LONGEST_LISTED else None
    if found is None:
        found = _ENDINGS.get(bare[-2:])
    if found is None:
        found = _ENDINGS.get(bare[-3:])
    return found if found is not None else _PLACES["PROPN"] if "A" <= w[0] <= "Z" else _PLACES["NOUN"]


class _TagNumbers(dict):
    """Word to tag_number(); remembers short words, so many at most."""

    def __missing__(self, w: str) -> int:
        found = tag_number(w)
        if len(w) <= LONGEST and len(self) < REMEMBERED:
            self[w] = found
        return found


_TAG_NUMBERS = _TagNumbers()


def tag_numbers(caption: str) -> bytes:
    """The place in TAG_RULES of each word's tag."""
    return bytes(map(_TAG_NUMBERS.__getitem__, caption.split()))


def stand_in_tags(caption: Column, distinct: bool = False) -> Column:
    """array of tags, one a word, as TAG_RULES say; null for a null caption. Marked non-deterministic, so that each caption is tagged once whatever filters read.

    ``distinct``: each tag once, for those who ask which tags occur; arrays of a few tags then leave Python, not one string a word.
    """
    from quern.plans.shipping import ship

    ship(SparkSession.active())

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = pa.array([name for name, _ in TAG_RULES])
        for a in _slices(batches):
            found = [tag_numbers(x.as_py()) if x.is_valid else None for x in a]
            if distinct:
                found = [None if x is None else bytes(dict.fromkeys(x)) for x in found]
            ends = [0, *accumulate(len(x or b"") for x in found)]
            numbers = pa.Array.from_buffers(pa.int8(), ends[-1], [None, pa.py_buffer(b"".join(x or b"" for x in found))])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names.take(numbers), mask=pa.array([x is None for x in found]))

    return run.asNondeterministic()(caption)
