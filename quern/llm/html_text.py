"""Main text of HTML pages by nearest-URL page differencing.

Pages of a host are paired by URL path: the witnesses of a page are the two nearest pages
with other content on either side of it in path order, which share the longest path prefixes with it. Their text
lines are aligned with the page's own by longest common subsequence, and shared lines are template, so they go:

* On a page that marks no main text, a line goes if over half of the witnesses share it.
* Inside marked main text (article, main or content elements) a line goes if every witness shares it. A passage
  that two articles have in common is no template; a line that all articles around have is.
* A witness that shares over half of the marked text is a version of the same article, one that shares every
  line of an unmarked page tells nothing: such witnesses don't count. Pages with the very same content are one
  run, whose witnesses stand around the whole run, so articles that recur under many URLs stay whole.

Structure settles what differencing leaves open, since menus, footers and adverts can differ from page to page:
lines of boilerplate elements and class words go even where no other page has them (``html_blocks``). Beside
marked text a first-level heading of the page's own stays, and so do all its own unmarked lines if they outweigh
the marked ones, which are teasers then. A page whose every line stands in weak places
(class words, forms) is treated like one without marks.

Pairing sorts digests by host, path and content through a range partitioning, so a host
with a third of all pages is spread over many tasks; the few rows at partition edges
are matched on the driver (four a partition). Lines are equal if their 64-bit digests are.

Defined cases: a null page is an empty one; a page without text gives ''; a null or broken URL
has host and path ''; a page without witnesses keeps what structure leaves; repeated rows
get the same text; an empty table gives an empty result; columns that are not asked
for are ignored.
"""

from __future__ import annotations

from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.batches import arrow_schema, column, mapped, slices
from quern.llm.html_blocks import LOOSE, MAIN, OUT, TITLE, WEAK, blocks
from quern.plans.scratch import stored

PARSED = "page_id long, url string, k1 long, k2 long, host string, path string, body long, marked boolean, places array<int>, texts array<string>, lines array<long>"
_BESIDE = "struct<k1: long, k2: long, host: string, path: string>"
PAIRS = f"k1 long, k2 long, b1 long, b2 long, a1 long, a2 long, edge int, end int, part int, host string, path string, whole long, before {_BESIDE}, after {_BESIDE}"
SHARED = "k1 long, k2 long, void boolean, shared array<int>"
SCHEMA = "page_id long, url string, text string, n_chars long"
#: Cells of a comparison matrix; larger ones are cut at a point that a longest common subsequence passes.
CELLS = 25_000_000
FIRST, LAST = 1, 2
START, END = 1, 2


def place_of(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL, in lower case and without a trailing slash."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path.rstrip("/").lower()
    except ValueError:
        return "", ""


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in a of a longest common subsequence of a and b.

    Common ends are cut off first, then lines that the other side lacks.
    """
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < hi_a and lo < hi_b and a[lo] == b[lo]:
        lo += 1
    while hi_a > lo and hi_b > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
    in_a, in_b = set(a[lo:hi_a]), set(b[lo:hi_b])
    xs = [i for i in range(lo, hi_a) if a[i] in in_b]
    ys = [x for x in b[lo:hi_b] if x in in_a]
    ends = [*range(lo), *range(hi_a, len(a))]
    if not xs or not ys:
        return sorted(ends)
    number = {x: i for i, x in enumerate(dict.fromkeys(ys))}
    at = _longest(np.array([number[a[i]] for i in xs]), np.array([number[y] for y in ys]))
    return sorted(ends + [xs[i] for i in at])


def _lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of a longest common subsequence of x with each prefix of y."""
    row = np.zeros(len(y) + 1, np.int32)
    for v in x:  # a row at a time: diagonal steps, then a running maximum
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], (row[:-1] + 1) * (y == v)))
    return row


def _longest(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Positions in x of a longest common subsequence, in linear memory beyond CELLS (Hirschberg)."""
    if not len(x) or not len(y):
        return []
    if len(x) * len(y) > CELLS and len(x) > 1:
        mid = len(x) // 2
        cut = int(np.argmax(_lengths(x[:mid], y) + _lengths(x[mid:][::-1], y[::-1])[::-1]))
        return _longest(x[:mid], y[:cut]) + [mid + i for i in _longest(x[mid:], y[cut:])]
    table = np.zeros((len(x) + 1, len(y) + 1), np.int32)
    for r, v in enumerate(x, 1):
        row = np.maximum(table[r - 1, 1:], (table[r - 1, :-1] + 1) * (y == v))
        table[r, 1:] = np.maximum.accumulate(row)
    r, c, found = len(x), len(y), []
    while r and c:
        if table[r, c] == table[r - 1, c]:
            r -= 1
        elif table[r, c] == table[r, c - 1]:
            c -= 1
        else:
            r, c = r - 1, c - 1
            found.append(r)
    return found[::-1]


def content_of(marked: bool, places: list[int]) -> list[int]:
    """Positions of the lines that structure alone takes for the main text."""
    if marked:
        return [i for i, p in enumerate(places) if p >= MAIN]
    return [i for i, p in enumerate(places) if p >= LOOSE] or [i for i, p in enumerate(places) if p == WEAK]


def tells_nothing(marked: bool, sizes: list[int], other: list[int], content: list[int], shared: list[int]) -> bool:
    """Whether a witness with the content sizes ``other`` is a version of the same article, or the same lines."""
    own = set(content)
    both = sum(sizes[i] for i in shared if i in own)
    total = sum(sizes[i] for i in content)
    if not both:
        return False
    return (2 * both > total or 2 * both > sum(other)) if marked else both == total


def staying(marked: bool, places: list[int], sizes: list[int], witnesses: list[list[int]]) -> list[int]:
    """Positions of the main text's lines; witnesses: positions of the lines shared with each page that counts."""
    votes = Counter(i for x in witnesses for i in x)
    n, content = len(witnesses), content_of(marked, places)
    if not marked:
        return [i for i in content if 2 * votes[i] <= n]
    kept = [i for i in content if not n or votes[i] < n]
    beside = [i for i, p in enumerate(places) if p in (LOOSE, TITLE) and 2 * votes[i] <= n]
    if n and sum(sizes[i] for i in beside) > sum(sizes[i] for i in kept):
        return sorted(kept + beside)
    return sorted(kept + [i for i in beside if places[i] == TITLE])


def main_text(page: str | None, witnesses: list[list[int]] | None = None) -> str:
    """The page's main text; witnesses: positions, among its lines, of those that each witness shares."""
    marked, found = lines_of(page)
    return "\n".join(found[i][1] for i in staying(marked, [p for p, _ in found], [len(t) for _, t in found], witnesses or []))


def lines_of(page: str | None) -> tuple[bool, list[tuple[int, str]]]:
    """(whether main text is marked, (place, text) of each line outside boilerplate elements)."""
    marked, found = blocks(page or "")
    return marked, [x for x in found if x[0] != OUT]


def _line_digest(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) - 2**63


def _digest(parts: list, seed: int = 0) -> int:
    import xxhash

    h = xxhash.xxh64(seed=seed)
    for x in parts:
        h.update(x.encode("utf-8", "surrogatepass") + b"\0" if isinstance(x, str) else x)
    return h.intdigest() - 2**63


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """One row per page: its lines with places and digests; pages alike in host, path and lines have one key (k1, k2)."""
    schema = arrow_schema(PARSED)

    def run(batches):
        for whole in batches:
            for b in slices(whole, 2, 2_000_000):
                rows = []
                for page_id, url, page in zip(*(column(b, i) for i in range(3)), strict=True):
                    marked, found = lines_of(page)
                    host, path = place_of(url)
                    places = [p for p, _ in found]
                    lines = [_line_digest(t) for _, t in found]
                    raw = np.array(lines, np.int64).tobytes()
                    same = [host, path, raw, bytes(places), bytes([marked])]
                    body = np.array([lines[i] for i in content_of(marked, places)], np.int64).tobytes()
                    rows.append((page_id, url, _digest(same), _digest(same, 1), host, path, _digest([body]), marked, places, [t for _, t in found], lines))
                cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    cols = [F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html")]
    return mapped(pages.select(*cols), run, PARSED)


def _beyond(ends: list) -> dict[int, tuple]:
    """By partition: the nearest rows with other lines before its first run and after its last, in other partitions."""
    runs: dict[int, dict] = {}
    for r in sorted(ends, key=lambda r: r["part"]):
        key, me = (r["host"], r["whole"]), (r["k1"], r["k2"], r["host"], r["path"])
        x = runs.setdefault(r["part"], {})
        for flag, side, at in ((FIRST, "head", "after"), (LAST, "tail", "before")):
            if r["edge"] & flag:
                x[side] = key
                # The row on the run's inner side is what a run of the same lines in the partition beside meets next.
                x[side + "_beside"] = tuple(r[at]) if r[at] is not None else None
        if r["edge"] & FIRST and r["end"] & START:
            x["first"] = me
        if r["edge"] & LAST and r["end"] & END:
            x["last"] = me
    out: dict[int, list] = {p: [None, None] for p in runs}
    for side, (mine, theirs, outer) in enumerate((("head", "tail", "last"), ("tail", "head", "first"))):
        seen = None  # the partition beside: (key of its near run, the run's outermost row, the row past the run)
        for p in sorted(runs, reverse=side == 1):
            x = runs[p]
            if seen is not None:
                out[p][side] = seen[2] if x[mine] == seen[0] else seen[1]
            single = x[theirs + "_beside"] is None and x["head"] == x["tail"]
            seen = (x[theirs], x[outer], out[p][side] if single else x[theirs + "_beside"])
    return {p: tuple(x) for p, x in out.items()}


def partners(keys: DataFrame) -> DataFrame:
    """keys: distinct (k1, k2, host, path, body). Adds each page's neighbours by path in its host that have other content: (b1, b2) before, (a1, a2) after."""
    schema = arrow_schema(PAIRS)
    ordered = keys.select("k1", "k2", "host", "path", "body").repartitionByRange("host", "path", "body", "k1").sortWithinPartitions("host", "path", "body", "k1", "k2")

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        earlier, held, out, first = None, [], [], True

        def ended(after):
            """Rows of the run of equal content that is held; its neighbours are the rows around the whole run."""
            edge = (FIRST if first else 0) + (LAST if after is None else 0)
            b, a = (y if y is not None and y[2] == held[0][2] else None for y in (earlier, after))
            for i, x in enumerate(held):
                # The run's ends carry the rows beside it, which a run in the next partition may need.
                end = (START if i == 0 else 0) + (END if i == len(held) - 1 else 0)
                beside = [y and y[:4] for y in (earlier, after)] if edge and end else [None, None]
                out.append((x[0], x[1], b and b[0], b and b[1], a and a[0], a and a[1], edge, end if edge else 0, part, x[2], x[3], x[4], *beside))

        def batch():
            rows = [tuple(dict(zip(("k1", "k2", "host", "path"), v, strict=True)) if i > 11 and v else v for i, v in enumerate(r)) for r in out]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            for x in zip(*(column(b, i) for i in range(5)), strict=True):
                if held and (x[2], x[4]) != (held[0][2], held[0][4]):
                    ended(x)
                    earlier, held, first = held[-1], [], False
                held.append(x)
            if len(out) > 10_000:
                yield batch()
                out.clear()
        if held:
            ended(None)
        if out:
            yield batch()

    found = stored(mapped(ordered, run, PAIRS), "pairs")
    # Ends of the first and last runs of the partitions: at most four rows a partition.
    beyond = _beyond(found.where("end > 0").select("k1", "k2", "edge", "end", "part", "host", "path", "whole", "before", "after").collect())
    chosen = "k1 long, k2 long, b1 long, b2 long, a1 long, a2 long"
    fields = arrow_schema(chosen)

    def choose(batches):
        for b in batches:
            rows = []
            for k1, k2, b1, b2, a1, a2, edge, part, host in zip(*(column(b, i) for i in range(9)), strict=True):
                before, after = beyond.get(part, (None, None))
                if edge & FIRST and before is not None and before[2] == host:
                    b1, b2 = before[:2]
                if edge & LAST and after is not None and after[2] == host:
                    a1, a2 = after[:2]
                rows.append((k1, k2, b1, b2, a1, a2))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields, strict=True)], schema=fields)

    return mapped(found.select("k1", "k2", "b1", "b2", "a1", "a2", "edge", "part", "host"), choose, chosen)


def witnesses(near: DataFrame) -> DataFrame:
    """near: stored, of partners(). (k1, k2, p1, p2): the two nearest pages with other content on either side."""
    beyond = lambda c: near.select(F.col("k1").alias(f"{c}1"), F.col("k2").alias(f"{c}2"), F.col(f"{c}1").alias(f"{c}{c}1"), F.col(f"{c}2").alias(f"{c}{c}2"))
    wide = near.join(beyond("b"), ["b1", "b2"], "left").join(beyond("a"), ["a1", "a2"], "left")
    each = F.array(*(F.struct(F.col(f"{c}1").alias("p1"), F.col(f"{c}2").alias("p2")) for c in ("b", "a", "bb", "aa")))
    return wide.select("k1", "k2", F.inline(each)).where("p1 IS NOT NULL")


def shared_lines(pages: DataFrame, pairs: DataFrame) -> DataFrame:
    """pages: stored (k1, k2, marked, shape, lines). (k1, k2, seen): what each witness that counts shares with a page, where any does."""
    schema = arrow_schema(SHARED)
    other = pages.toDF("p1", "p2", "o_marked", "o_shape", "o_lines")
    both = pairs.join(other, ["p1", "p2"]).join(pages, ["k1", "k2"]).select("k1", "k2", *pages.columns[2:], "o_marked", "o_shape", "o_lines")

    def run(batches):
        for b in batches:
            rows = []
            for k1, k2, marked, shape, lines, o_marked, o_shape, o_lines in zip(*(column(b, i) for i in range(8)), strict=True):
                shared = common_lines(lines, o_lines)
                (places, sizes), (o_places, o_sizes) = unpacked(shape), unpacked(o_shape)
                void = tells_nothing(marked, sizes, [o_sizes[i] for i in content_of(o_marked, o_places)], content_of(marked, places), shared)
                rows.append((k1, k2, void, shared))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    found = mapped(both, run, SHARED).where("NOT void").groupBy("k1", "k2").agg(F.collect_list("shared").alias("seen"))  # four at most
    return found.where(F.exists("seen", lambda x: F.size(x) > 0))


def decided(pages: DataFrame, seen: DataFrame) -> DataFrame:
    """(k1, k2, stay): positions of the main text's lines, of those pages where differencing changes what structure leaves."""
    spec = "k1 long, k2 long, stay array<int>"
    schema = arrow_schema(spec)

    def run(batches):
        for b in batches:
            rows = []
            for k1, k2, marked, shape, found in zip(*(column(b, i) for i in range(5)), strict=True):
                places, sizes = unpacked(shape)
                stay = staying(marked, places, sizes, found)
                if stay != staying(marked, places, sizes, []):
                    rows.append((k1, k2, stay))
            cols = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return mapped(seen.join(pages, ["k1", "k2"]).select("k1", "k2", "marked", "shape", "seen"), run, spec)


def unpacked(shape: list[int]) -> tuple[list[int], list[int]]:
    """(places, sizes) of lines whose size and place are one number."""
    return [x & 7 for x in shape], [x >> 3 for x in shape]


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    every = parsed(pages, id_col, url_col, html_col)  # twice, for its keys are digests of the page: a table of all texts takes as much disk as the pages
    shape = F.zip_with("texts", "places", lambda t, p: (F.length(t) * 8 + p).cast("int")).alias("shape")
    few = stored(every.select("k1", "k2", "host", "path", "body", "marked", shape, "lines").dropDuplicates(["k1", "k2"]), "lines")
    near = stored(partners(few), "near")
    few = few.drop("host", "path", "body")
    seen = stored(shared_lines(few, witnesses(near)), "shared")
    changed = stored(decided(few, seen), "decided")
    schema = arrow_schema(SCHEMA)

    def run(batches):
        for whole in batches:
            for b in slices(whole, 4, 2_000_000):
                texts = []
                for marked, places, lines, stay in zip(*(column(b, i) for i in (2, 3, 4, 5)), strict=True):
                    texts.append("\n".join(lines[i] for i in (stay if stay is not None else staying(marked, places, list(map(len, lines)), []))))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], schema=schema)

    # The texts stay in the tasks that parse them unless many pages have changed: Spark knows the size of the stored table.
    rows = every.join(changed, ["k1", "k2"], "left").select("page_id", "url", "marked", "places", "texts", "stay")
    return mapped(rows, run, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    from quern.sources.tables import table

    return extracted(table(spark, sf_dir, "pages"))
