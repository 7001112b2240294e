"""Byte-level BPE by corpus-level merge replay, and its inverse.

The distinct pieces of a block of texts form one small corpus. An inverted index maps
what a token pair merges into (its rank, which is also the new token's id) to the
positions where such a pair stands in that corpus. Ranks are taken in rising order from
a heap; a rank's merges are applied at all its positions, left to right, and only the
pairs to the left and right of a merge enter the index anew. If a new pair ranks
below the one at work, that pair comes first, as it would word by word.

A block is at most 4 MB of text, so memory is bounded; what was encoded in this block
or shortly before is looked up, from one lone space to the next. Longer texts are cut into
stretches, whose pieces are looked up in a cache (emptied when full). Patterns must begin
a piece at every space that stands between two characters which are not white space, as
those of the public byte-level vocabularies do.

Defined cases: a null text counts as an empty one (no ids, digests of nothing); null
ids and repeated rows are kept as they are; an empty table gives an empty result;
columns that are not asked for are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.batches import arrow_schema, column, mapped, slices

CACHED_PIECES = 300_000
#: Words replayed together, and pieces of one text handled at a time.
CORPUS_WORDS = 64_000
CHUNK = 200_000
STRETCH = 1_000_000
#: Bytes of text that are encoded together.
BLOCK = 4_000_000
#: Beyond so many characters nothing is kept for later texts.
LONG = 256
#: Bits of a token id, and how many places of a rank are worth a vector step.
WIDTH, MANY = 24, 32
#: Any character that a pattern could take for white space counts here.
_ALONE = re.compile(r"(?<=\S) (?=\S)")

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Recent:
    """A bounded cache of two generations: what was used in the last one or two outlives a change."""

    def __init__(self, most: int):
        self.most, self.young, self.old, self.long = most, {}, {}, []

    def missing(self, keys: set[str]) -> list[str]:
        """The keys that must be made; the others are in ``young`` afterwards."""
        young, out = self.young, []
        for k in keys.difference(young):
            v = self.old.get(k)
            if v is None:
                out.append(k)
                if len(k) > LONG:
                    self.long.append(k)
            else:
                young[k] = v
        return out

    def tidy(self) -> None:
        for k in self.long:
            self.young.pop(k, None)
        self.long.clear()
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {i: b for b, i in ranks.items()}
        #: One object for each id: ids that are kept share it.
        self.own = {i: i for i in self.tokens}
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        #: Two tokens, as one number, to the rank of merging them: every cut of every token into two.
        self.pair_ranks = {a << WIDTH | c: r for b, r in ranks.items() for k in range(1, len(b)) if (a := ranks.get(b[:k])) is not None and (c := ranks.get(b[k:])) is not None}
        pairs = np.array(sorted(self.pair_ranks), np.int64)
        self.pair_keys, self.pair_values = np.r_[pairs, np.iinfo(np.int64).max], np.array([*map(self.pair_ranks.__getitem__, pairs.tolist()), -1], np.int64)
        self.cache, self.spaced = Recent(CACHED_PIECES), Recent(CACHED_PIECES)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of merging each left with its right; -1 where the vocabulary has no such token."""
        key = left.astype(np.int64) << WIDTH | right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_values[at], -1)

    def replay(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each word, all words merged together in rank order."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n = int(sizes.sum())
        token, after, before = (array("i", bytes(4 * n)) for _ in range(3))
        tokens, afters, befores = (np.frombuffer(x, np.int32) for x in (token, after, before))
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        tokens[:] = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        same = np.r_[word[1:] == word[:-1], False] if n else np.empty(0, bool)
        afters[:] = np.where(same, np.arange(1, n + 1), -1)
        befores[:] = np.where(np.r_[False, same[:-1]], np.arange(-1, n - 1), -1) if n else 0
        where: dict[int, list[int]] = {}
        heap: list[int] = []

        def enter(ranks: np.ndarray, at: np.ndarray) -> None:
            keep = np.flatnonzero(ranks >= 0)
            order = keep[np.argsort(ranks[keep], kind="stable")]
            ranks, at = ranks[order], at[order].tolist()
            cuts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]).tolist() if len(at) else []
            for r, lo, hi in zip(ranks[cuts].tolist(), cuts, [*cuts[1:], len(at)], strict=False):
                if r in where:
                    where[r] += at[lo:hi]
                else:
                    where[r] = at[lo:hi]
                    heapq.heappush(heap, r)

        p = np.flatnonzero(same)
        enter(self.pairs(tokens[p], tokens[p + 1]), p)
        known = self.pair_ranks
        while heap:
            rank = heapq.heappop(heap)
            places = where.pop(rank, None)
            if places is None:
                continue
            if len(places) >= MANY:  # one merge in every word at a time, the leftmost; a word's next one waits for lower ranks
                p = np.sort(np.array(places))
                p = p[(tokens[p] >= 0) & (afters[p] >= 0)]
                p = p[self.pairs(tokens[p], tokens[afters[p]]) == rank]
                first = np.r_[True, word[p[1:]] != word[p[:-1]]] if len(p) else np.empty(0, bool)
                rest, p = p[~first].tolist(), p[first]
                if rest:
                    where[rank] = rest
                    heapq.heappush(heap, rank)
                gone = afters[p]
                tokens[p], tokens[gone] = rank, -1
                follows = afters[gone]
                afters[p] = follows
                has = follows >= 0
                right, follows = p[has], follows[has]
                befores[follows] = right
                left = befores[p]
                has = left >= 0
                left, p = left[has], p[has]
                enter(np.r_[self.pairs(tokens[right], tokens[follows]), self.pairs(tokens[left], tokens[p])], np.r_[right, left])
                continue
            places.sort()
            for done, p in enumerate(places, 1):
                n = after[p]
                if n < 0 or token[p] < 0 or known.get(token[p] << WIDTH | token[n], -1) != rank:
                    continue  # a neighbour's merge has changed this pair
                token[p], token[n] = rank, -1
                n = after[p] = after[n]
                lower = False
                if n >= 0:
                    before[n] = p
                    r = known.get(rank << WIDTH | token[n])
                    if r is not None:
                        if r not in where:
                            where[r] = []
                            heapq.heappush(heap, r)
                        where[r].append(p)
                        lower = r < rank
                n = before[p]
                if n >= 0:
                    r = known.get(token[n] << WIDTH | rank)
                    if r is not None:
                        if r not in where:
                            where[r] = []
                            heapq.heappush(heap, r)
                        where[r].append(n)
                        lower = lower or r < rank
                if lower and done < len(places):
                    where.setdefault(rank, []).extend(places[done:])
                    heapq.heappush(heap, rank)
                    break
        alive = tokens >= 0
        ids = [*map(self.own.__getitem__, tokens[alive].tolist())]
        ends = np.cumsum(np.bincount(word[alive], minlength=len(words))).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def made(self, pieces: Iterable[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """(piece, its ids) for each of the distinct pieces; nothing is kept."""
        whole: list[str] = []
        for p in pieces:
            i = self.ranks.get(p.encode())
            if i is None:
                whole.append(p)
            else:
                yield p, (i,)
        for k in range(0, len(whole), CORPUS_WORDS):
            part = whole[k : k + CORPUS_WORDS]
            yield from zip(part, self.replay([p.encode() for p in part]), strict=True)

    def learn(self, pieces: Iterable[str]) -> None:
        """Put the ids of all pieces that are not there yet into the cache."""
        missing = self.cache.missing(set(pieces))
        self.cache.young.update(self.made(missing))

    def cut(self, chunks: list[str]) -> Iterator[tuple[str, list[tuple[int, ...]]]]:
        """(chunk, ids of each piece of " " + chunk)."""
        pieces = [self.pattern.findall(f" {c}") for c in chunks]
        self.learn(chain.from_iterable(pieces))
        cache = self.cache.young
        for c, found in zip(chunks, pieces, strict=True):
            yield c, [cache[p] for p in found]

    def know(self, chunks: Iterable[str]) -> None:
        """Put the ids of " " + chunk into ``spaced`` for all chunks that are not there yet."""
        for c, ids in self.cut(self.spaced.missing(set(chunks))):
            self.spaced.young[c] = tuple(chain.from_iterable(ids))

    def tidy(self) -> None:
        """Bound the memory of what is kept from text to text."""
        self.cache.tidy()
        self.spaced.tidy()

    def forget(self) -> None:
        """Drop what is kept: a worker outlives its task, and the next stage needs the memory."""
        self.cache, self.spaced = Recent(CACHED_PIECES), Recent(CACHED_PIECES)

    def head(self, text: str) -> Iterator[list[tuple[int, ...]]]:
        """The ids of the pieces of a text, in lists of bounded length."""
        found = self.pattern.finditer(text)
        while part := [m.group() for m in islice(found, CHUNK)]:
            self.learn(part)
            yield [self.cache.young[p] for p in part]

    def encoded(self, text: str) -> Iterator[tuple[int, ...]]:
        """The ids of a text, stretch by stretch."""
        for head, chunks in stretches(text):
            for ids in self.head(head):
                yield from ids
            self.know(chunks)
            yield from map(self.spaced.young.__getitem__, chunks)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.encoded(text)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def stretches(text: str) -> Iterator[tuple[str, list[str]]]:
    """A text as (head, chunks): it reads head + " " + chunks[0] + " " + chunks[1] + ..., in stretches of about STRETCH.

    Cuts are only at a space between two characters that are not white space. There a piece always
    begins with the space, so every chunk falls into the same pieces wherever it stands.
    """
    at = 0
    while at < len(text):
        end = _ALONE.search(text, at + STRETCH) if len(text) - at > 2 * STRETCH else None
        part = text[at : end.start()] if end else text[at:]
        at = end.start() if end else len(text)
        chunks = _ALONE.split(part)
        yield chunks[0], chunks[1:]


_CODECS: dict[tuple, Codec] = {}


def codec(raw: bytes, pattern: str) -> Codec:
    """This worker's codec for the given rank file, made once."""
    key = (hash(raw), len(raw), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}, pattern)
    return _CODECS[key]


def _vocabulary(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, about 1 MB whatever the input


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of each whole text."""
    raw = _vocabulary(docs, path)
    schema = arrow_schema("doc_id long, ids array<int>")

    def listed(written, part):  # apart, so that nothing of a block outlives its result
        ids = [b"".join([x for x, _ in parts]) for parts in written.block([t or "" for t in column(part, 1)])]
        ends = np.cumsum([0, *map(len, ids)]) // 4
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
        return pa.RecordBatch.from_arrays([part.column(0), lists.cast(schema.field(1).type)], schema=schema)

    def run(batches):
        written = Written(codec(raw.value, pattern), lambda i: i.to_bytes(4, sys.byteorder), decode=False)
        for b in batches:
            for part in slices(b, 1, BLOCK):
                yield listed(written, part)
            del b, part  # not beside the next batch
        written.codec.forget()

    return mapped(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, raw): the bytes that the ids of each row stand for; null ids decode to nothing."""
    raw = _vocabulary(rows, path)
    schema = arrow_schema("doc_id long, raw binary")

    def run(batches):
        c = codec(raw.value, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or ()) for x in column(b, 1)], schema.field(1).type)], schema=schema)

    return mapped(rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids")), run, "doc_id long, raw binary")


class Written:
    """Ids in the form of ``number`` and, if they are to be decoded, the bytes they stand for.

    By chunk they are kept until ``recent`` blocks of text are read, by piece as long again: more saves work and takes memory.
    """

    def __init__(self, codec: Codec, number: Callable[[int], bytes], decode: bool = True, recent: float = 0.5):
        self.codec, self.decode, self.recent = codec, decode, recent
        self.number = {i: number(i) for i in codec.tokens}
        self.ids: dict[str, bytes] = {}
        self.raw: dict[str, bytes] = {}
        self.pieces: tuple[dict, dict] = ({}, {})
        self.old: tuple[dict, dict] = ({}, {})
        self.long: list[str] = []
        #: Characters of the texts whose chunks are in ``ids`` and whose pieces are in ``pieces``.
        self.read = 0

    def both(self, ids: Iterable[int]) -> tuple[bytes, bytes]:
        return b"".join(map(self.number.__getitem__, ids)), self.codec.decode(ids) if self.decode else b""

    def learn(self, pieces: set[str]) -> None:
        """Make the ids and bytes of all pieces that are not there yet."""
        (ids, raw), (old_ids, old_raw), decode = self.pieces, self.old, self.decode
        fresh = pieces.difference(ids)
        again = fresh.intersection(old_ids) if old_ids else ()
        for p in again:
            ids[p] = old_ids[p]
            if decode:
                raw[p] = old_raw[p]
        new = fresh.difference(again)
        self.long += [p for p in new if len(p) > LONG]
        number, token, join = self.number.__getitem__, self.codec.tokens.__getitem__, b"".join
        for p, i in self.codec.made(new):
            ids[p] = join(map(number, i))
            if decode:
                raw[p] = join(map(token, i))

    def know(self, chunks: set[str]) -> None:
        """Make what is missing, but for chunks with white space at an end, whose pieces depend on what stands beside them."""
        new = [x for x in chunks.difference(self.ids) if x and not x[0].isspace() and not x[-1].isspace()]
        if not new:
            return
        self.long += [x for x in new if len(x) > LONG]
        # One text of all new chunks: a piece that begins with a space begins a chunk.
        pieces = self.codec.pattern.findall(" " + " ".join(new))
        self.learn(set(pieces))
        starts = [k for k, p in enumerate(pieces) if p[0] == " "]
        ends = [*starts[1:], len(pieces)]
        for out, found in zip((self.ids, self.raw), self.pieces if self.decode else self.pieces[:1], strict=False):
            for x, lo, hi in zip(new, starts, ends, strict=True):
                out[x] = found[pieces[lo]] if hi - lo == 1 else b"".join([found[p] for p in pieces[lo:hi]])

    def tidy(self) -> None:
        """Drop what was last used too much text ago: so memory is bounded, and what is frequent is kept."""
        for x in self.long:
            for kept in (self.ids, self.raw, *self.pieces):
                kept.pop(x, None)
        self.long.clear()
        if self.read >= self.recent * BLOCK:
            self.old, self.pieces, self.ids, self.raw, self.read = self.pieces, ({}, {}), {}, {}, 0

    def block(self, texts: list[str]) -> Iterator[Iterator[tuple[bytes, bytes]]]:
        """The parts of each text. All new chunks of the block, and the beginnings of its texts, are one corpus."""
        self.codec.tidy()
        self.tidy()
        short = [t for t in texts if len(t) <= 2 * STRETCH]
        self.codec.learn(p for t in short for p in self.codec.pattern.findall(t.partition(" ")[0]))
        chunks: set[str] = set()
        for t in short:  # one text's list at a time: the words of a block take ten times its bytes
            chunks.update(t.split(" ")[1:])
            self.read += len(t)
        self.know(chunks)
        return map(self.parts, texts)

    def parts(self, text: str) -> Iterator[tuple[bytes, bytes]]:
        """(ids, bytes) of a text of the block, stretch by stretch."""
        if len(text) <= 2 * STRETCH:
            chunks = text.split(" ")[1:]
            try:
                whole = b"".join(map(self.ids.__getitem__, chunks)), b"".join(map(self.raw.__getitem__, chunks)) if self.decode else b""
            except KeyError:  # white space beside a space somewhere
                pass
            else:
                head = text[: text.find(" ")] if chunks else text
                yield from (self.both(list(chain.from_iterable(x))) for x in self.codec.head(head))
                yield whole
                return
        for head, rest in stretches(text):
            self.codec.tidy()  # a text may be all new words
            yield from (self.both(list(chain.from_iterable(x))) for x in self.codec.head(head))
            for x, found in self.codec.cut(rest):
                yield self.both(list(chain.from_iterable(found)))


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, in one pass.

    Ids and decoded bytes of a chunk are kept as they enter the digests; nothing longer than a stretch is built.
    """
    raw = _vocabulary(docs, path)
    schema = arrow_schema(DIGESTS)

    def run(batches):
        written = Written(codec(raw.value, pattern), lambda i: b" %d" % i, recent=4)
        for b in batches:
            for part in slices(b, 1, BLOCK):
                rows = []
                for parts in written.block([t or "" for t in column(part, 1)]):
                    n, ids, out = 0, hashlib.sha256(), hashlib.sha256()
                    for number, body in parts:
                        ids.update(number if n else number[1:])
                        out.update(body)
                        n += number.count(b" ")
                    rows.append((n, ids.hexdigest(), out.hexdigest()))
                cols = list(zip(*rows, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(v, f.type) for v, f in zip(cols, list(schema)[1:], strict=True))], schema=schema)
        written.codec.forget()

    return mapped(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, DIGESTS)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quern.sources.tables import table

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
