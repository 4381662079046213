"""Repeated substrings of a corpus, by suffix arrays of the places where repeats can begin or end.

Every byte covered by a string of `length` bytes that also starts anywhere else, in the same document or another,
is removed; documents are UTF-8 bytes and no match crosses from one to the next.

1. Anchors. Of each window of `length` bytes the leftmost of its smallest hashed GRAM-grams is an anchor. Equal windows
   have the anchor at the same place, so all occurrences of a window meet under its anchor's gram. The context of an
   anchor is the bytes of all windows around its gram.
2. Buckets of anchors count equal grams and equal contexts. A gram that occurs once is no repeat; a context that occurs
   twice is covered whole. What is left are different contexts of one gram: edges of a passage, edits.
3. Suffix arrays. Only those contexts are cut from the texts. The contexts of a gram are aligned at it; bytes between two
   columns at which any two of them part are one symbol. The suffix array of the symbols, column by column,
   shows for each suffix the longest match at the same columns; matches of `length` bytes are covered.
4. The covered stretches are merged per document and cut out.

The suffix array is built by linear grouping: suffixes are grouped by their first symbol, then groups are processed in
descending order. Each member's nearest earlier suffix of a lower group (previous-smaller pointer)
is followed by the group's Lyndon prefix; as often as it is, so far up it moves out of its own
group. In the end a group holds the suffixes with the same longest Lyndon prefix, and one pass in
ascending order puts each in its place through the same pointers. No names are given anew and nothing recurs.

A context that a batch has twice is covered at once and sent on as one row. A gram with HEAVY different contexts in
a batch, or TOGETHER over all batches, has its contexts compared by the hashes of all their windows instead, which
are counted with partial sums. So no suffix array is built over more than TOGETHER - 1 contexts, however a
passage is spread. Only an entry of 40 bytes for each different context of a batch meets in the bucket of the gram.

Cases: null and empty texts, and those shorter than `length`, lose nothing; texts of any length are read
whole, in overlapping stretches; repeated rows are occurrences of each other; rows with null ids
are documents like others; an empty table stays empty; only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, pieces, settled, text_of

LENGTH, GRAM = 200, 48
#: Anchors per bucket, bytes of contexts per group, and different contexts of a gram from which on windows are counted: in a batch, and over all.
BUCKET, GROUP_BYTES, HEAVY, TOGETHER = 500_000, 4 << 20, 64, 1024
#: Bytes of a batch and of a stretch of a long document; finding anchors takes some eighty times as much memory.
BATCH_BYTES, _STRETCH = 2 << 20, 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 24) - 1)


def suffix_array(text: list[int]) -> list[int]:
    """Suffix order of a text whose last symbol is smaller than all others and occurs once."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, start, size = [0] * n, [0] * n, [0] * n
    begin = 0
    for i, s in enumerate(order):
        if i and text[s] != text[order[i - 1]]:
            begin = i
        place[s], start[s] = i, begin
        size[begin] += 1
    before = [-1] * n
    high = n - 1
    while high >= 0:
        low = start[order[high]]
        followed: dict[int, int] = {}
        for s in sorted(order[low : high + 1]) if high > low else (order[low],):
            j = s - 1
            while j >= 0 and start[j] >= low:
                j = before[j]
            before[s] = j
            if j >= 0:
                followed[j] = followed.get(j, 0) + 1
        classes: dict[int, dict[int, list[int]]] = {}
        for j, times in followed.items():
            classes.setdefault(times, {}).setdefault(start[j], []).append(j)
        for times in sorted(classes, reverse=True):
            for group, movers in classes[times].items():
                if len(movers) == size[group]:
                    continue
                top = group + size[group]
                for j in movers:
                    top -= 1
                    other = order[top]
                    at = place[j]
                    order[at], order[top] = other, j
                    place[other], place[j] = at, top
                for j in movers:
                    start[j] = top
                size[group] -= len(movers)
                size[top] = len(movers)
        high = low - 1
    free, out, done = list(range(n)), [0] * n, [False] * n  # free: the next place of the group that starts there
    out[0], done[n - 1], free[0] = n - 1, True, 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not done[j]:
            group = start[j]
            out[free[group]] = j
            free[group] += 1
            done[j] = True
            j = before[j]
    return out


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """Symbols that each suffix in order shares with the one before it."""
    n = len(text)
    rank = [0] * n
    for i, s in enumerate(order):
        rank[s] = i
    out, h = [0] * n, 0
    for s in range(n):
        if rank[s] == 0:
            h = 0
            continue
        t = order[rank[s] - 1]
        while s + h < n and t + h < n and text[s + h] == text[t + h]:
            h += 1
        out[rank[s]] = h
        h = max(0, h - 1)
    return out


def anchors(raw: np.ndarray, edges: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors in the joined documents, and hashes of their grams. edges: first byte of each document, and the end."""
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, have, total, rest = raw.astype(np.uint64) + np.uint64(1), 1, None, gram
    done = 0
    while rest:  # the gram's hash from those of its binary parts
        if rest & 1:
            part = h[done:] if total is not None else h
            total = h if total is None else total[: len(part)] * _ODD + part[: len(total)]
            done += have
        rest >>= 1
        if rest:
            h = (h[: len(h) - have] * (_ODD + np.uint64(2 * have)) + h[have:]) * _ODD
            have *= 2
    value = mixed(total)
    n, width = len(value), length - gram + 1
    # The smallest hash, then the leftmost place: both in one number.
    key = (value & ~_PLACE) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.concatenate([key, np.full(blocks * width - n, ~np.uint64(0), np.uint64)]).reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - width + 1], ahead[width - 1 : n]) & _PLACE
    inside = np.ones(len(least), bool)
    for end in edges[1:-1]:
        inside[max(0, int(end) - length + 1) : int(end)] = False
    place = least[inside].astype(np.int64)
    place = place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place
    return place, value[place]


_FOUND = "bucket long, key long, place int, gram long, state int, many binary"
#: States of a found anchor: covered whole; one of several contexts of its gram; the same, of a heavy gram; not to be covered again, but a partner.
WHOLE, ONE, HEAVY_ONE, PARTNER, HEAVY_PARTNER = range(5)
_ENTRY = np.dtype([("low", "<u4"), ("place", "<u4"), ("context", "<u8"), ("key", "<i8"), ("twice", "<u4"), ("heavy", "<u4")])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _stretches(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(document, first byte, bytes) in runs of bounded size; long documents overlap by a window."""
    run, size = [], 0
    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        for a in range(0, max(1, len(t) - length + 1), _STRETCH):
            part = t[a : a + _STRETCH + length - 1]
            if size + len(part) > 2 * _STRETCH and run:
                yield run
                run, size = [], 0
            run.append((i, a, part))
            size += len(part)
    if run:
        yield run


def _anchor_rows(texts: list[bytes], keys: np.ndarray, buckets: int, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    side, last = length - gram, {}
    for run in _stretches(texts, length):
        edges = np.cumsum([0, *(len(p) for _, _, p in run)])
        place, value = anchors(np.frombuffer(b"".join(p for _, _, p in run), np.uint8), edges, length, gram)
        which = np.searchsorted(edges, place, side="right") - 1
        doc = np.array([i for i, _, _ in run], np.int64)[which]
        at = place - edges[which] + np.array([a for _, a, _ in run], np.int64)[which]
        # Places never fall from window to window, so only a stretch's first can be the one that ended the stretch before.
        fresh = np.ones(len(at), bool)
        for k in (k for k, (i, _, _) in enumerate(run) if len(texts[i]) - length >= _STRETCH):
            x, z = np.searchsorted(which, [k, k + 1])
            fresh[x] = last.get(run[k][0]) != at[x]
            last[run[k][0]] = at[z - 1]
        doc, at, value = doc[fresh], at[fresh], value[fresh]
        entry = np.zeros(len(at), _ENTRY)
        entry["place"], entry["key"] = at, keys[doc]
        hashed = xxhash.xxh3_64_intdigest
        entry["context"] = np.fromiter(
            (hashed(texts[d][max(0, p - side) : p + length], min(p, side)) for d, p in zip(doc.tolist(), at.tolist(), strict=True)), np.uint64, len(at)
        )
        bucket = (value >> np.uint64(32)) % np.uint64(buckets)
        entry["low"] = value & np.uint64(0xFFFFFFFF)
        order = np.lexsort((entry["context"], entry["low"], bucket))
        entry, bucket = entry[order], bucket[order]
        new_gram = np.ones(len(entry), bool)
        new_gram[1:] = (bucket[1:] != bucket[:-1]) | (entry["low"][1:] != entry["low"][:-1])
        new = new_gram.copy()
        new[1:] |= entry["context"][1:] != entry["context"][:-1]
        count = np.bincount(np.cumsum(new) - 1)
        whole = (count > 1)[np.cumsum(new) - 1] if len(entry) else new
        for a in range(0, int(whole.sum()), 1 << 16):
            part = entry[whole][a : a + (1 << 16)]
            yield _found(np.zeros(len(part), np.int64) - 1, part["key"], part["place"], np.zeros(len(part), np.int64), np.full(len(part), WHOLE))
        own = np.cumsum(new_gram) - 1
        contexts = np.bincount(own[new]) if len(entry) else own
        entry["twice"], entry["heavy"] = whole, (contexts >= HEAVY)[own] if len(entry) else 0
        entry, bucket = entry[new], bucket[new]
        names, first = np.unique(bucket, return_index=True)
        parts = [p.tobytes() for p in np.split(entry, first[1:])] if len(entry) else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(_signed(names)), *(pa.nulls(len(names), t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int32())), pa.array(parts, pa.binary())],
            names=["bucket", "key", "place", "gram", "state", "many"],
        )


def _found(bucket, key, place, gram, state) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket.astype(np.int64)), pa.array(key.astype(np.int64)), pa.array(place.astype(np.int32)), pa.array(gram.astype(np.int64)), pa.array(state.astype(np.int32)), pa.nulls(len(key), pa.binary())],
        names=["bucket", "key", "place", "gram", "state", "many"],
    )


def _judge(table: pa.Table) -> pa.Table:
    """A bucket of anchors: those covered whole, and one anchor of each context of grams that have several."""
    entry = np.frombuffer(b"".join(table.column("many").to_pylist()), _ENTRY)
    entry = entry[np.lexsort((entry["key"], entry["context"], entry["low"]))]
    new_gram = np.ones(len(entry), bool)
    new_gram[1:] = entry["low"][1:] != entry["low"][:-1]
    new = new_gram.copy()
    new[1:] |= entry["context"][1:] != entry["context"][:-1]
    context, own = np.cumsum(new) - 1, np.cumsum(new_gram) - 1
    whole = (np.bincount(context, entry["twice"] + 1) > 1)[context]
    contexts = np.bincount(own[new])
    several, heavy = (contexts > 1)[own], ((np.bincount(own, entry["heavy"]) > 0) | (contexts >= TOGETHER))[own]
    gram = _signed(np.uint64(table.column("bucket")[0].as_py() << 32) | entry["low"].astype(np.uint64))
    # Those covered in their batch were told so there.
    first = whole & (entry["twice"] == 0)
    partner = several & new
    state = np.where(heavy, np.where(whole, HEAVY_PARTNER, HEAVY_ONE), np.where(whole, PARTNER, ONE))
    parts = [_found(own[m], entry["key"][m], entry["place"][m], gram[m], s[m]) for m, s in ((first, np.full(len(entry), WHOLE)), (partner, state))]
    return pa.Table.from_batches(parts).select(["key", "place", "gram", "state"])


def extents(contexts: list[bytes], lefts: list[int], length: int, gram: int) -> list[tuple[int, int]]:
    """For each of different contexts of one gram: how far the bytes around the gram's first are covered, (0, 0) if they aren't.

    lefts: bytes before the gram.
    """
    side = length - gram
    g, width = len(contexts), length + side
    m = np.empty((g, width), np.uint32)
    m[:] = (256 + np.arange(g))[:, None]  # where a document ends, nothing matches
    for i, (c, left) in enumerate(zip(contexts, lefts, strict=True)):
        m[i, side - left : side - left + len(c)] = np.frombuffer(c, np.uint8)
    cuts = {0, side, width}
    for part, place in ((m[:, side:], lambda d: side + d), (m[:, : side + gram][:, ::-1], lambda d: side + gram - d)):
        part = np.ascontiguousarray(part)
        part = part[np.argsort(part.view(f"V{part.itemsize * part.shape[1]}").ravel(), kind="stable")]
        different = part[1:] != part[:-1]
        cuts.update(place(int(d)) for d in different.argmax(1)[different.any(1)])
    edge = np.array(sorted(cuts))
    # A symbol is the bytes of its columns, told apart from those of other columns.
    symbol = np.add.reduceat(mixed(m.astype(np.uint64) + np.arange(1, width + 1, dtype=np.uint64) * _ODD), edge[:-1], axis=1)
    names, text = np.unique(symbol.ravel(), return_inverse=True)
    text = [*(text + 1).tolist(), 0]
    order = suffix_array(text)
    shared = common_prefixes(text, order)
    columns, out = len(edge) - 1, [(0, 0)] * g
    for i, s in enumerate(order):
        c, b = divmod(s, columns)
        if c == g or edge[b] > side:
            continue
        match = min(max(shared[i], shared[i + 1] if i + 1 < len(order) else 0), columns - b)
        a, z = int(edge[b]), int(edge[b + match])
        if z - a >= length:
            out[c] = (max(out[c][0], side - a), max(out[c][1], z - side))
    return out


def _resolve(table: pa.Table, length: int, gram: int) -> pa.Table:
    """A group of grams with all their contexts: the stretch covered around each context's gram."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("gram", "context", "left", "key", "place", "state")), strict=True))
    out: list[tuple[int, int, int]] = []
    a = 0
    while a < len(rows):
        z = a
        while z < len(rows) and rows[z][0] == rows[a][0]:
            z += 1
        found = extents([r[1] for r in rows[a:z]], [r[2] for r in rows[a:z]], length, gram)
        out += [(r[3], r[4] - left, r[4] + right) for r, (left, right) in zip(rows[a:z], found, strict=True) if right and r[5] == ONE]
        a = z
    key, start, end = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"key": pa.array(key, pa.int64()), "start": pa.array(start, pa.int32()), "end": pa.array(end, pa.int32())})


def _windows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Every window of the contexts of heavy grams, hashed with the gram and its place around it."""
    for batch in batches:
        for row in batch.to_pylist():
            context, left, seed = row["context"], row["left"], row["gram"] & 0xFFFFFFFFFFFFFFFF
            back = range(max(0, left - (length - gram)), min(left, len(context) - length) + 1)
            hashes = [xxhash.xxh3_64_intdigest(context[a : a + length], seed ^ (left - a)) for a in back]
            n = len(hashes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(hashes, np.uint64).view(np.int64)),
                    pa.array([row["key"]] * n, pa.int64()),
                    pa.array([row["place"]] * n, pa.int32()),
                    pa.array([left - a for a in back], pa.int32()),
                    pa.array([row["state"] == HEAVY_ONE] * n, pa.bool_()),
                ],
                names=["window", "key", "place", "back", "open"],
            )


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Rows with the same id and text share a key; they are covered alike."""
    return docs.select(F.xxhash64(F.col(key), text_of(text)).alias("key"), F.col(key).alias("id"), text_of(text).cast("binary").alias("raw"))


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, spans): disjoint covered stretches of bytes of each document that has some, as flat starts and ends."""
    rows = _keyed(docs, text, key)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("raw")), F.lit(0))).first()[0]
    buckets = max(1, size // (BUCKET * max(1, (length - gram) // 2)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "raw", BATCH_BYTES):
            yield from _anchor_rows(batch.column("raw").to_pylist(), batch.column("key").to_numpy(), buckets, length, gram)

    sent = rows.select("key", "raw").mapInArrow(cut, _FOUND)
    # What a batch found by itself goes through unchanged, dealt out by document.
    group = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(-1 - F.pmod(F.col("key"), F.lit(255 + 16 * buckets)))

    def judge(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table.select(["key", "place", "gram", "state"])
        return _judge(table)

    found = settled(sent.withColumn("group", group).groupBy("group").applyInArrow(judge, "key long, place int, gram long, state int"), "anchors")
    stretch = found.where(F.col("state") == WHOLE).select("key", (F.col("place") - (length - gram)).alias("start"), (F.col("place") + length).alias("end"))

    asked = found.where(F.col("state") != WHOLE).groupBy("key").agg(F.collect_list(F.struct("place", "gram", "state")).alias("asked"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "raw"):
            out = []
            for k, raw, asked_ in zip(batch.column("key").to_pylist(), batch.column("raw").to_pylist(), batch.column("asked").to_pylist(), strict=True):
                for q in asked_:
                    p = q["place"]
                    out.append((k, p, q["gram"], q["state"], min(p, length - gram), raw[max(0, p - (length - gram)) : p + length]))
            columns = zip(*out, strict=True) if out else ((),) * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "place", "gram", "state", "left", "context"])

    schema = "key long, place int, gram long, state int, left int, context binary"
    # A document that occurs as several rows gives its contexts as often; they are one.
    open_ = settled(rows.select("key", "raw").join(asked, "key").mapInArrow(contexts, schema), "contexts")
    groups = max(1, open_.count() * (2 * length - gram) // GROUP_BYTES)
    near = open_.where(F.col("state").isin(ONE, PARTNER)).dropDuplicates(["key", "place"])
    near = near.groupBy(F.pmod(F.xxhash64("gram"), F.lit(groups)).alias("g")).applyInArrow(lambda t: _resolve(t, length, gram), "key long, start int, end int")
    heavy = open_.where(F.col("state").isin(HEAVY_ONE, HEAVY_PARTNER)).dropDuplicates(["key", "place"])
    windows = heavy.mapInArrow(lambda b: _windows(b, length, gram), "window long, key long, place int, back int, open boolean")
    counted = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    matched = windows.where("open").join(counted, "window").groupBy("key", "place").agg(F.max("back").alias("far"), F.min("back").alias("near"))
    wide = matched.select("key", (F.col("place") - F.col("far")).alias("start"), (F.col("place") - F.col("near") + length).alias("end"))
    every = stretch.unionByName(near).unionByName(wide)
    return every.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("found"))


def cut_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM, kept: bool = False) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, spans (flat, bytes) and kept_sha256; with kept also the bytes left."""
    rows = _keyed(docs, text, key)
    joined = rows.join(settled(repeated_spans(docs, text, key, length, gram), "spans"), "key", "left")
    kind = dict(docs.select(F.col(key).alias("id")).dtypes)["id"]
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, spans array<int>, kept_sha256 string" + ", kept binary" * kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "raw"):
            out = [_cut(raw, found or []) for raw, found in zip(batch.column("raw").to_pylist(), batch.column("found").to_pylist(), strict=True)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            names = ["n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns[: 5 + kept]], names=["id", *names[: 5 + kept]])

    return joined.select("id", "raw", "found").mapInArrow(run, schema)


def _cut(raw: bytes, found: list[dict]) -> tuple:
    spans: list[int] = []
    for a, z in sorted((max(0, f["start"]), min(len(raw), f["end"])) for f in found):
        if spans and a <= spans[-1]:
            spans[-1] = max(spans[-1], z)
        else:
            spans += [a, z]
    kept = b"".join(raw[a:z] for a, z in zip([0, *spans[1::2]], [*spans[::2], len(raw)], strict=True))
    return len(raw), len(raw) - len(kept), len(spans) // 2, spans, hashlib.sha256(kept).hexdigest(), kept
