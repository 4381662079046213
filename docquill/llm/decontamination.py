"""Benchmark decontamination by an FM-index per training shard.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z became a-z. A window is `width` consecutive
words of a benchmark item, or all words of a shorter item. A document word inside any
occurrence of a window is hit.

The test set is the stated query side: it is taken in blocks of at most BLOCK_BYTES of text, and each
block goes over all documents where they lie, without a shuffle. A shard is a run of
documents of about 4 MB. Words that no item has can't be inside an occurrence, so the
shard's sequence keeps only runs of known words at least as long as the shortest window, with a
separator before each. Its suffix array gives the Burrows-Wheeler transform, kept as a
wavelet matrix with popcount ranks. Backward search narrows the rows of all windows at once,
rows are located by walking back to sampled suffix positions, and the located stretches are
merged to spans per document.

Cases: null or empty text has no words; a null or empty item has no windows; an item without
an id counts for words and spans but isn't listed; equal items are listed each, repeated
rows of one id once; repeated documents are marked alike; empty tables give no hits; only the
named columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Bits, pieces, released, text_of

#: Text of the test set that one pass over the documents takes. A task holds its windows, some 70 times as large.
BLOCK_BYTES = 1 << 20
#: Every so many positions the suffix array is kept.
SAMPLE = 16

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Positions in suffix order by prefix doubling; 0 separates, and each 0 differs from all others."""
    n, gap = len(seq), seq == 0
    rank = np.where(gap, np.cumsum(gap) - 1, seq + int(gap.sum())).astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (max(n, int(rank.max())) + 2) + after
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Symbols by bit levels, highest first; at each level zeros go before ones."""

    def __init__(self, seq: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        for level in range(levels - 1, -1, -1):
            bit = (seq >> level) & 1
            self.bits.append(Bits(bit.astype(bool)))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        start = np.zeros_like(i)
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            one = (symbol >> (self.levels - 1 - level)) & 1 == 1
            a, b = bits.ones(start), bits.ones(i)
            start, i = np.where(one, zeros + a, start - a), np.where(one, zeros + b, i - b)
        return i - start

    def access(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(i)
        for bits, zeros in zip(self.bits, self.zeros, strict=True):
            one = bits.at(i)
            ones = bits.ones(i)
            symbol, i = symbol * 2 + one, np.where(one == 1, zeros + ones, i - ones)
        return symbol


class FMIndex:
    """An index of a sequence that begins with a separator; symbols are 1 to `top`, 0 separates."""

    def __init__(self, seq: np.ndarray, top: int):
        order = suffix_array(seq)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=top + 1))])
        self.bwt = WaveletMatrix(seq[order - 1], max(1, int(top).bit_length()))
        # A walk back never crosses a separator: where one stands before, the position is kept too.
        kept = (order % SAMPLE == 0) | (seq[order - 1] == 0)
        self.kept, self.places, self.n = Bits(kept), order[kept], len(seq)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of each phrase (a row of right-aligned symbols), by backward search."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (lo < hi))
            if not len(live):
                break
            symbol = phrases[live, -back]
            lo[live] = self.first[symbol] + self.bwt.rank(symbol, lo[live])
            hi[live] = self.first[symbol] + self.bwt.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each row's suffix."""
        out, steps, todo = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            done = self.kept.at(rows[todo]) == 1
            here = todo[done]
            out[here] = self.places[self.kept.ones(rows[here])] + steps[here]
            todo = todo[~done]
            symbol = self.bwt.access(rows[todo])
            rows[todo] = self.first[symbol] + self.bwt.rank(symbol, rows[todo])
            steps[todo] += 1
        return out


class Phrases:
    """The windows of a block of items: distinct phrases, and the items of each."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int):
        self.known: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.known.setdefault(w, len(self.known) + 1) for w in words(text)]
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                owners.setdefault(tuple(ids[i : i + width]), set()).update([item] if item is not None else [])
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.symbols = np.zeros((len(owners), width), np.int64)
        for k, p in enumerate(owners):
            self.symbols[k, width - len(p) :] = p
        self.names = sorted({x for own in owners.values() for x in own})
        place = {x: i for i, x in enumerate(self.names)}
        self.owned = np.array([place[x] for own in owners.values() for x in own], np.int64)
        self.edges = np.cumsum([0, *map(len, owners.values())])
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0

    def occurrences(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words before each text and after all, start, length, phrase) of every occurrence in the shard, starts counted over all its words."""
        get = self.known.get
        ids = [[get(w, 0) for w in words(t)] for t in texts]
        edges = np.cumsum([0, *map(len, ids)])
        none = np.zeros(0, np.int64)
        flat = np.fromiter((i for x in ids for i in x), np.int64, edges[-1])
        if not len(self.lengths) or not len(flat):
            return edges, none, none, none
        known = flat > 0
        begin = known.copy()
        begin[1:] &= ~known[:-1]
        begin[edges[:-1][np.diff(edges) > 0]] |= known[edges[:-1][np.diff(edges) > 0]]
        run = np.cumsum(begin) - 1
        size = np.bincount(run[known], minlength=max(1, int(run[-1]) + 1))
        keep = known & (size[run] >= self.shortest)
        where = np.flatnonzero(keep)
        if not len(where):
            return edges, none, none, none
        start = begin[where]
        at = np.arange(len(where)) + np.cumsum(start)  # a separator before each run
        seq, back = np.zeros(int(at[-1]) + 1, np.int64), np.zeros(int(at[-1]) + 1, np.int64)
        seq[at], back[at] = flat[where], where
        index = FMIndex(seq, len(self.known))
        lo, hi = index.search(self.symbols, self.lengths)
        count = np.maximum(hi - lo, 0)
        phrase = np.repeat(np.arange(len(count)), count)
        rows = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count) + lo[phrase]
        return edges, back[index.locate(rows)], self.lengths[phrase], phrase

    def mark(self, texts: list[bytes], spans: list[list[int]], items: list[list[str]]) -> tuple[np.ndarray, list[list[int]], list[list[str]]]:
        """Words per text; the given spans and items with those found added. Spans are flat: start, end, start, end."""
        edges, start, length, phrase = self.occurrences(texts)
        doc = np.searchsorted(edges, start, side="right") - 1
        order = np.argsort(doc, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else []:
            d = int(doc[own[0]])
            found = {(int(a), int(a + n)) for a, n in zip(start[own] - edges[d], length[own], strict=True)}
            spans[d] = merge([*found, *zip(spans[d][::2], spans[d][1::2], strict=True)])
            named = {self.names[i] for p in np.unique(phrase[own]) for i in self.owned[self.edges[p] : self.edges[p + 1]]}
            items[d] = sorted(named.union(items[d]))
        return np.diff(edges), spans, items


def merge(spans: list[tuple[int, int]]) -> list[int]:
    """Disjoint spans in order, flat; those that touch or overlap become one."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 10,
    block_bytes: int = BLOCK_BYTES,
    with_text: bool = False,
) -> DataFrame:
    """The columns `keep` with n_words long, spans array<int> (flat word spans) and items array<string>, one row per document.

    with_text: the text comes along as `_text`, empty where it is null; it is sent once.
    """
    spark, keep = docs.sparkSession, keep or []
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), text_of(item_text).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    rows = docs.select(
        *[F.col(c) for c in keep],
        text_of(text).cast("binary").alias("_text"),
        F.lit(0).cast("long").alias("_n"),
        F.array().cast("array<int>").alias("_spans"),
        F.array().cast("array<string>").alias("_items"),
    )
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        # At most about block_bytes, whatever the test set's size.
        phrases = spark.sparkContext.broadcast(Phrases([(r.item, r.text.encode()) for r in part.toLocalIterator()], width))
        rows = _pass(rows, phrases, keep, block == blocks - 1 and not with_text)
    read = [F.col("_text").cast("string").alias("_text")] if with_text else []
    return rows.select(*keep, *read, F.col("_n").alias("n_words"), F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def _pass(rows: DataFrame, phrases, keep: list[str], last: bool) -> DataFrame:
    schema = T.StructType([f for f in rows.schema if not (last and f.name == "_text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            n, spans, items = phrases.value.mark(
                batch.column("_text").to_pylist(), batch.column("_spans").to_pylist(), batch.column("_items").to_pylist()
            )
            out = {c: batch.column(c) for c in schema.names}
            out |= {"_n": pa.array(n, pa.int64()), "_spans": pa.array(spans, pa.list_(pa.int32())), "_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(released(run), schema)


def words_hit(spans: str = "spans") -> Column:
    """Number of words inside flat spans."""
    signed = F.transform(F.col(spans), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)


def cut_spans(text: str, spans: list[int]) -> str:
    """The text without the words of the spans, from the first word's first character to the last word's end."""
    raw = text.encode()
    marks = np.frombuffer(raw.translate(_WORD), np.uint8) != 32
    step = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[at : begin[a]])
        at = int(end[b - 1])
    return b"".join([*out, raw[at:]]).decode()
