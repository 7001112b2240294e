"""Quality rules as a short-circuit cascade.

Every rule is a cheap test that rejects a text. What a rule costs and how much it
rejects is estimated on a bounded sample; rules then run in the order of rejection
per cost, and a text leaves the cascade at the first rule that rejects it. The
order changes the work done, never the verdict, which is the conjunction of all rules.

Defined cases: a null text counts as an empty one (all counts 0, base_failed true,
kept false); a null id stays null; repeated rows are judged one by one; an empty
table gives an empty result; columns that are not asked for are ignored.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.batches import arrow_schema, column, mapped, positional, slices

SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r "
MIN_WORDS = 50
#: Expected rows of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 512

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SCHEMA = f"doc_id long, {COUNTS}, base_failed boolean, kept boolean"


class Text:
    """A text with the counts that rules read, each computed once and only when asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self._memo: dict[str, object] = {}

    def _once(self, name: str, fn: Callable):
        if name not in self._memo:
            self._memo[name] = fn()
        return self._memo[name]

    @property
    def raw(self) -> bytes:
        return self._once("raw", self.text.encode)

    @property
    def words(self) -> list[bytes]:
        return self._once("words", self.raw.split)  # bytes.split() cuts at exactly 0x20 and 0x09 to 0x0D

    @property
    def n_words(self) -> int:
        return len(self.words)

    @property
    def word_chars(self) -> int:
        return self._once("word_chars", lambda: len(self.text) - sum(map(self.text.count, SPACES)))

    @property
    def n_symbols(self) -> int:
        return self._once("n_symbols", lambda: sum(map(self.text.count, SYMBOLS)))

    @property
    def lines(self) -> list[bytes]:
        return self._once("lines", lambda: [x for x in self.raw.split(b"\n") if x.strip()])

    @property
    def n_dup_lines(self) -> int:
        return self._once("n_dup_lines", lambda: len(self.lines) - len(set(self.lines)))

    @property
    def n_repeat_words(self) -> int:
        return self._once("n_repeat_words", lambda: repeat_words(self.words))

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > 50 * self.n_words


def repeat_words(words: Sequence[bytes]) -> int:
    """Words covered by a window of three words that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    n = end = 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            n += i + 3 - max(i, end)
            end = i + 3
    return n



#: Rule name to test; true rejects. Integer arithmetic only, so that SQL can repeat it.
RULES: dict[str, Callable[[Text], bool]] = {
    "too_few_words": lambda t: t.n_words < MIN_WORDS,
    "repeated_windows": lambda t: 100 * t.n_repeat_words > 50 * t.n_words,
    "symbols": lambda t: 100 * t.n_symbols > 5 * t.word_chars,
    "repeated_lines": lambda t: 100 * t.n_dup_lines > 60 * len(t.lines),
    "word_length": lambda t: t.word_chars < 2 * t.n_words or t.word_chars > 20 * t.n_words,
    "shouting": lambda t: 5 * t.text.count("!") > t.n_words,
}


def estimate(docs: DataFrame, rules: dict[str, Callable], text: str = "text") -> list[tuple[str, float, float]]:
    """(rule, seconds a row, share rejected) on a sample of about SAMPLE_ROWS rows, drawn from all partitions.

    Sampled rows are measured where they are read; the driver gets two sums a rule.
    """
    n = docs.count()

    def measure(batches):
        for b in batches:
            rows = []
            for name, rule in rules.items():
                texts = [Text(x) for x in column(b, 0)]
                began = time.perf_counter()
                rejected = sum(map(rule, texts))
                rows.append((name, time.perf_counter() - began, rejected, len(texts)))
            if rows and rows[0][3]:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["rule", "s", "rejected", "rows"])

    sample = docs.select(F.col(f"`{text}`").cast("string").alias("text")).sample(fraction=min(1.0, SAMPLE_ROWS / max(1, n)), seed=7)
    seen = mapped(sample, measure, "rule string, s double, rejected long, rows long").groupBy("rule").agg(F.sum("s").alias("s"), F.sum("rejected").alias("rejected"), F.sum("rows").alias("rows"))
    found = {r["rule"]: (r["s"] / r["rows"], r["rejected"] / r["rows"]) for r in seen.collect() if r["rows"]}
    return [(name, *found.get(name, (0.0, 0.0))) for name in rules]


def ordered(estimates: list[tuple[str, float, float]]) -> list[str]:
    """Rule names by rejection per cost, highest first; ties keep the given order."""
    return [name for name, *_ in sorted(estimates, key=lambda x: -x[2] / max(x[1], 1e-9))]


def first_rejection(t: Text, rules: Sequence[tuple[str, Callable]]) -> str | None:
    """The first rule of the cascade that rejects t; later rules do not run."""
    for name, rule in rules:
        if rule(t):
            return name
    return None


def filtered(docs: DataFrame, text: str = "text", rules: dict[str, Callable] = RULES) -> DataFrame:
    """The rows of docs, all columns as they are and whatever their names, that no rule rejects."""
    cascade = [(n, rules[n]) for n in ordered(estimate(docs, rules, text))]
    at = docs.columns.index(text)
    rows = positional(docs)

    def run(batches):
        for whole in batches:
            for b in slices(whole, at):
                yield b.filter(pa.array([first_rejection(Text(x), cascade) is None for x in b.column(at).to_pylist()], pa.bool_()))

    return mapped(rows, run, rows.schema).toDF(*docs.columns)


def judged(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: dict[str, Callable] = RULES) -> DataFrame:
    """One row per document: its counts, whether a base rule failed, and the cascade's verdict."""
    cascade = [(n, rules[n]) for n in ordered(estimate(docs, rules, text))]
    schema = arrow_schema(SCHEMA)

    def run(batches):
        for whole in batches:
            for b in slices(whole, 1):
                rows = []
                for x in column(b, 1):
                    t = Text(x)
                    rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, t.base_failed, not t.base_failed and first_rejection(t, cascade) is None))
                cols = list(zip(*rows, strict=True)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:], strict=True))], schema=schema)

    return mapped(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")), run, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    from quern.sources.tables import table

    return judged(table(spark, sf_dir, "documents"))


#: The same counts and verdict as one DuckDB statement.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT k, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT k, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
  FROM (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM t WHERE len(ws) >= 3)
), rep AS (
  SELECT k, count(DISTINCT i + j) AS n
  FROM (SELECT k, i, count(*) OVER (PARTITION BY k, w) AS c FROM win), (VALUES (0), (1), (2)) v(j)
  WHERE c > 1 GROUP BY k
), c AS (
  SELECT t.k, doc_id, text, len(ws) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_shout
  FROM t LEFT JOIN rep USING (k)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 5 * word_chars OR 100 * n_dup_lines > 60 * n_lines
         OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 5 * n_shout > n_words) AS kept
FROM b
"""
