"""Near duplicates by Jaccard similarity of word shingles, joined through parity sketches.

A document's set is its distinct 5-word shingles as 64-bit hashes; equal sets are one class. Two sets link when
100 * intersection >= 80 * union. Sets of sizes a <= b then have b <= 1.25 a and differ in at most (a + b) / 9 tokens.

Sketch. In a band of sizes up to `hi` every token toggles one bit of a sparse sketch of K segments of 2^32
bits. A segment can differ only where a differing token toggled it, so the number of differing segments, like the
Hamming distance, is at most the symmetric difference, D at most. As K is more than D, all but D segments
agree, and of those that are not empty in a set, all but D as well. A segment's set bits, hashed and
XORed, are its word. Sets of up to 64 tokens have one segment per token. Bands are octaves; a set
that is up to 1.25 times larger than a band goes into it too, so each linked pair meets in a band.

Join. All words of a band meet in buckets, where words of only one class fall out; those of a class are
mostly gone with them. A class that keeps fewer than its words less D has no partner. The others
order their words by how many classes have them, rarest first: among the first D + 1, counting those that nobody
shares, a linked pair has a word in common (pigeonhole). Per word, all classes are held against the one
with the fewest words of its own, which the others were likely made from; what that links is one component, and pairs between components that still share a word are held
against each other by a short sketch of parity bits: if its Hamming distance is over the pair's D, they
can't link. The others are tested in a second turn. So a group of g copies gives some g pairs, and every pair that could join components
is tested. Tests are exact on the sets, which are made again for the classes in question only.

A word that many classes of a batch have isn't sent to its bucket row by row but as a count; its rows stay outside and
are given the total afterwards. Leaders' sets are copied to groups of bounded size.

Cases: null, empty and blank text has no set, links with nothing, and is its own component; with fewer
than five words the whole sequence is the one shingle; texts of any length are read whole; repeated rows
share a component; a null id belongs to its text's component, which has the smallest id that isn't null;
an empty table stays empty; only the named columns are read, so further columns never clash. Two different
sets pass for one class if their 64-bit digests agree, which among 10^9 sets happens with odds of 1 in 37.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, pieces, released, settled, small, text_of
from .components import components

WIDTH = 5
#: Up to this size every token is a segment of its own.
SINGLE = 64
#: Words that one bucket holds on average; classes of a batch from which on a word is sent as a count; members that one copy of a leader's set is held against.
BUCKET, HEAVY, GROUP = 500_000, 8, 200
#: Words whose hash a task remembers.
HELD = 100_000
#: Text bytes of a batch; its words and their hashes take some twenty times as much memory.
BATCH_BYTES = 2 << 20

_MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    """Hash of each word seen, anew when HELD are held."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes, seen: _Hashes) -> np.ndarray:
    """The text's set: sorted 64-bit hashes of its shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    if len(h) < WIDTH:
        return mixed((h * _MULTIPLY[: len(h)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))
    n = len(h) - WIDTH + 1
    total = h[:n] * _MULTIPLY[0]
    for k in range(1, WIDTH):
        total += h[k : k + n] * _MULTIPLY[k]
    return np.unique(mixed(total))


def bands(n: int) -> list[int]:
    """Upper sizes of the bands that a set of n tokens goes into."""
    hi = max(SINGLE, 1 << (n - 1).bit_length())
    below = hi // 2
    return [hi, below] if below >= SINGLE and 4 * n <= 5 * below else [hi]


def most_different(n: int, hi: int) -> int:
    """Most tokens by which a set of n can differ from one linked to it in the band."""
    return n // 4 if n <= hi else (n + hi) // 9


def words_of(tokens: np.ndarray, hi: int) -> np.ndarray:
    """Words of the sketch's segments that are not empty; tokens are sorted."""
    salt = np.uint64(hi * int(_MULTIPLY[1]) % 2**64)
    bits = mixed(tokens ^ salt)
    if hi <= SINGLE:
        return bits
    segments = np.uint64(hi // 3 + 16)
    place = (tokens >> np.uint64(32)) * segments >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    words = np.bitwise_xor.reduceat(bits, first)
    set_ = words != 0
    return mixed(words[set_] + place[first][set_] * _MULTIPLY[2])


def bits_of(tokens: np.ndarray, hi: int) -> np.ndarray:
    """The short sketch of a band: 4 * hi bits, each the parity of the tokens hashed to it, in 64-bit numbers."""
    place = mixed(tokens + np.uint64(hi * int(_MULTIPLY[3]) % 2**64)) & np.uint64(4 * hi - 1)
    odd = (np.bincount(place.astype(np.int64), minlength=4 * hi) & 1).astype(bool)
    return np.frombuffer(np.packbits(odd, bitorder="little").tobytes(), np.int64)


_SKETCHES = (
    "kind string, id long, mark long, n int, cid long, unit long, most int, rest int, hi int, bits array<long>, "
    "bucket long, words binary, units binary, heavy binary, counts binary"
)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def sketch(docs: DataFrame, text: str, key: str) -> DataFrame:
    """All that is needed of the documents, in rows of four kinds, written once.

    doc: id, mark (of its text), n, cid. unit (a class in a band): unit, cid, n, hi, most, rest (words less most), bits. bucket: words and units
    in step, and heavy words with counts. heavy: a word (bucket, n) and a unit that has it.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text_of(text)).alias("mark"), text_of(text).cast("binary").alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    # A document has about a word for every 12 bytes of its text.
    buckets = max(1, size // (12 * BUCKET))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Hashes()
        for batch in pieces(batches, "_text", BATCH_BYTES):
            yield from _sketched(batch, seen, buckets)

    return settled(rows.mapInArrow(released(run), _SKETCHES), "sketches")


_ARROW = pa.schema(
    [("kind", pa.string()), ("id", pa.int64()), ("mark", pa.int64()), ("n", pa.int32()), ("cid", pa.int64()), ("unit", pa.int64()), ("most", pa.int32()), ("rest", pa.int32())]
    + [("hi", pa.int32()), ("bits", pa.list_(pa.int64())), ("bucket", pa.int64())]
    + [(c, pa.binary()) for c in ("words", "units", "heavy", "counts")]
)


def _rows(row_kind: str, size: int, **columns) -> pa.RecordBatch:
    """A batch of rows of one kind; columns that aren't given are null."""
    filled = {f.name: pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _ARROW}
    return pa.RecordBatch.from_pydict(filled | {"kind": pa.array([row_kind] * size, pa.string())}, schema=_ARROW)


def _sketched(batch: pa.RecordBatch, seen: _Hashes, buckets: int) -> Iterator[pa.RecordBatch]:
    sets = [shingles(t, seen) for t in batch.column("_text").to_pylist()]
    n = np.array([len(s) for s in sets], np.int32)
    cid = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
    yield _rows("doc", len(sets), id=batch.column("id"), mark=batch.column("mark"), n=n, cid=_signed(cid))
    first = np.unique(cid, return_index=True)[1]
    chosen = [(i, hi) for i in first.tolist() if n[i] for hi in bands(int(n[i]))]
    if not chosen:
        return
    words = [words_of(sets[i], hi) for i, hi in chosen]
    sizes = np.array([len(w) for w in words])
    own = np.array([i for i, _ in chosen])
    unit = mixed(cid[own] ^ mixed(np.array([hi for _, hi in chosen], np.uint64)))
    most = np.array([most_different(int(n[i]), hi) for i, hi in chosen], np.int32)
    if (sizes <= most).any():
        raise ValueError("a sketch is too full for its band")
    yield _rows("unit", len(chosen), n=n[own], cid=_signed(cid[own]), unit=_signed(unit), most=most, rest=(sizes - most).astype(np.int32), hi=[hi for _, hi in chosen], bits=[bits_of(sets[i], hi) for i, hi in chosen])
    word, place = np.concatenate(words), np.repeat(np.arange(len(chosen)), sizes)
    order = np.argsort(word, kind="stable")
    word, place = word[order], place[order]
    start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    count = np.diff(np.append(start, len(word)))
    often = np.repeat(count >= HEAVY, count)
    bucket = (word >> np.uint64(32)) % np.uint64(buckets)
    low = (word & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    if often.any():
        yield _rows("heavy", int(often.sum()), bucket=_signed(bucket[often] << np.uint64(32) | low[often]), unit=_signed(unit[place[often]]))
    light = ~often
    heads = start[count >= HEAVY]
    out = {"bucket": [], "words": [], "units": [], "heavy": [], "counts": []}
    by = np.argsort(bucket[light], kind="stable")
    b, w, u = bucket[light][by], low[light][by], unit[place[light]][by]
    hb, hw, hc = bucket[heads], low[heads], count[count >= HEAVY].astype(np.int32)
    hby = np.argsort(hb, kind="stable")
    hb, hw, hc = hb[hby], hw[hby], hc[hby]
    for k in np.unique(np.concatenate([b, hb])):
        x, y = np.searchsorted(b, [k, k + np.uint64(1)])
        v, z = np.searchsorted(hb, [k, k + np.uint64(1)])
        for name, value in zip(out, (int(k), w[x:y].tobytes(), u[x:y].tobytes(), hw[v:z].tobytes(), hc[v:z].tobytes()), strict=True):
            out[name].append(value)
    yield _rows("bucket", len(out["bucket"]), **out)


def _count(table: pa.Table) -> pa.Table:
    """A bucket: the units of each word that more than one class has, with the number n; heavy words once more without a unit."""

    def joined(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    word, unit = joined("words", np.uint32), joined("units", np.uint64)
    heavy, counts = joined("heavy", np.uint32), joined("counts", np.int32)
    order = np.lexsort((unit, word))
    word, unit = word[order], unit[order]
    fresh = np.ones(len(word), bool)
    fresh[1:] = (word[1:] != word[:-1]) | (unit[1:] != unit[:-1])
    word, unit = word[fresh], unit[fresh]
    names, of = np.unique(np.concatenate([word, heavy]), return_inverse=True)
    total = np.bincount(of[: len(word)], minlength=len(names)) + np.bincount(of[len(word) :], counts, len(names)).astype(np.int64)
    n = total[of[: len(word)]]
    keep = n > 1
    high = np.uint64(table.column("bucket")[0].as_py() << 32)
    out_heavy, at = np.unique(heavy, return_index=True)
    tokens = np.concatenate([word[keep], out_heavy]).astype(np.uint64) | high
    units = pa.array(np.concatenate([_signed(unit[keep]), np.zeros(len(out_heavy), np.int64)]), mask=np.arange(len(tokens)) >= keep.sum())
    return pa.table({"word": _signed(tokens), "unit": units, "n": np.concatenate([n[keep], total[of[len(word) :][at]]]).astype(np.int64)})


def prefixes(sketches: DataFrame) -> DataFrame:
    """(word, cid, n, hi, own): the words under which each class that may have a partner looks for one; own: words that nobody shares."""
    met = sketches.where("kind = 'bucket'").groupBy("bucket").applyInArrow(_count, "word long, unit long, n long")
    met = settled(met, "words")
    totals = met.where("unit is null").select("word", F.col("n").alias("total"))
    heavy = sketches.where("kind = 'heavy'").select(F.col("bucket").alias("word"), "unit").distinct()
    heavy = heavy.join(small(settled(totals, "totals")), "word").select("word", "unit", F.col("total").alias("n"))
    shared = met.where("unit is not null").unionByName(heavy)
    shared = shared.groupBy("unit").agg(F.collect_set(F.struct("n", "word")).alias("words"))
    units = sketches.where("kind = 'unit'").groupBy("unit").agg(F.first("cid").alias("cid"), F.first("n").alias("n"), F.first("most").alias("most"), F.first("rest").alias("rest"), F.first("hi").alias("hi"))
    found = shared.join(units, "unit").where(F.size("words") >= F.col("rest"))
    # Of the first most + 1 words those that nobody shares come first: there are rest + most less the shared ones.
    look = F.slice(F.array_sort("words"), F.lit(1), F.size("words") - F.col("rest") + 1)
    own = F.col("rest") + F.col("most") - F.size("words")
    found = found.select("cid", "n", "hi", own.alias("own"), F.explode(look).alias("w"))
    return settled(found.select("cid", "n", "hi", "own", F.col("w.word").alias("word")), "prefixes")


def _sets(docs: DataFrame, text: str, key: str, wanted: DataFrame) -> DataFrame:
    """(cid, tokens binary) of wanted classes, each made from one of its documents (id, cid)."""
    rows = docs.select(F.col(key).cast("long").alias("id"), text_of(text).cast("binary").alias("_text")).alias("l")
    ids = small(settled(wanted.select("id").distinct(), "ids")).alias("r")
    rows = rows.join(ids, F.col("l.id").eqNullSafe(F.col("r.id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Hashes()
        for batch in pieces(batches, "_text", BATCH_BYTES):
            sets = [shingles(t, seen) for t in batch.column("_text").to_pylist()]
            cid = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(cid)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cid", "tokens"])

    made = rows.select("l.id", "l._text").mapInArrow(released(run), "cid long, tokens binary")
    classes = small(settled(wanted.select("cid").distinct(), "classes"))
    return settled(made.join(classes, "cid", "left_semi").groupBy("cid").agg(F.first("tokens").alias("tokens")), "sets")


def _test(members: pa.Table, leader: pa.Table) -> pa.Table:
    """Which members link with the leader."""
    linked = []
    own = np.frombuffer(leader.column("own")[0].as_py(), np.uint64) if leader.num_rows else np.zeros(0, np.uint64)
    for raw in members.column("tokens").to_pylist():
        tokens = np.frombuffer(raw, np.uint64)
        at = np.searchsorted(own, tokens)
        same = int((own[np.minimum(at, len(own) - 1)] == tokens).sum()) if len(own) else 0
        linked.append(100 * same >= 80 * (len(own) + len(tokens) - same))
    return members.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) of classes whose sets link, tested exactly."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    sizes = settled(sizes, "leaders")
    members = pairs.join(sizes, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    members = members.join(sets.withColumnRenamed("cid", "b"), "b").select("a", "part", "b", "tokens")
    leaders = sizes.join(sets, sizes["a"] == sets["cid"])
    # Names of its own, as both sides come from the same tables.
    leaders = leaders.select(F.col("a").alias("leader"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("copy"), F.col("tokens").alias("own"))
    return members.groupBy("a", "part").cogroup(leaders.groupBy("leader", "copy")).applyInArrow(_test, "a long, b long")


def similar_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document: id, mark (hash of its text), n_shingles, cid (of its set), root (least cid of its component), component_id (its smallest id)."""
    sketches = sketch(docs, text, key)
    members = sketches.where("kind = 'doc'").select("id", "mark", "n", "cid")
    words = prefixes(sketches)
    leaders = words.groupBy("word").agg(F.min(F.struct("own", "n", "cid")).alias("a"), F.count("*").alias("m")).where("m > 1").select("word", "a")
    near = lambda less, more: 5 * F.col(less) >= 4 * F.col(more)
    first = words.join(leaders, "word").where((F.col("cid") != F.col("a.cid")) & near("a.n", "n") & near("n", "a.n"))
    first = settled(first.select(F.col("a.cid").alias("a"), F.col("cid").alias("b")).distinct(), "pairs")
    asked = words.join(leaders, "word").select("cid").distinct()
    some = members.where("n > 0").groupBy("cid").agg(F.min("id").alias("id"))
    sets = _sets(docs, text, key, settled(some.join(asked, "cid", "left_semi"), "wanted"))
    links = settled(linked(first, sets), "links")
    roots = components(links)
    # Words that more than one component still shares: every pair between components that may link.
    left = words.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    open_ = left.groupBy("word").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("word")
    bits = sketches.where("kind = 'unit'").groupBy("cid", "hi").agg(F.first("bits").alias("bits"))
    left = settled(left.join(open_, "word", "left_semi").join(bits, ["cid", "hi"]), "open")
    right = left.select("word", F.col("cid").alias("b"), F.col("n").alias("m"), F.col("root").alias("other"), F.col("bits").alias("against"))
    apart = F.aggregate(F.zip_with("bits", "against", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    may = near("n", "m") & near("m", "n") & (9 * apart <= F.col("n") + F.col("m"))
    more = left.join(right, (left["word"] == right["word"]) & (F.col("root") < F.col("other")) & may)
    more = more.select(F.least("cid", "b").alias("a"), F.greatest("cid", "b").alias("b")).distinct()
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    again = settled(linked(settled(more.join(done, ["a", "b"], "left_anti"), "pairs"), sets), "links")
    if not again.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(again))
    return _named(members, settled(roots, "roots"))


def _named(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Components by their smallest id; a document without a set is its own."""
    classes = members.where("n > 0").groupBy("cid").agg(F.min("id").alias("id"))
    classes = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    names = classes.groupBy("root").agg(F.min("id").alias("component_id"))
    names = settled(classes.join(names, "root").select("cid", "root", "component_id"), "names")
    out = members.join(names, "cid", "left")
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "mark", F.col("n").cast("long").alias("n_shingles"), "cid", "root", own.alias("component_id"))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents without all but one of each component, all columns; the smallest id stays, ids before null.

    Documents without a set stay. Of rows that share an id and text, one stays.
    """
    own = ["_id", "_mark"]
    members = settled(similar_groups(docs, text, key).where("n_shingles > 0").select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), "root"), "members")
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_mark")
    best = members.groupBy("root").agg(F.min(place).alias("best"), F.count("*").alias("m")).where("m > 1").select("root", "best")
    best = settled(best, "best")
    crowd = members.join(small(best), "root").withColumn("stays", place == F.col("best"))
    keys = settled(crowd.groupBy(*own).agg(F.max("stays").alias("stays"), F.count("*").alias("n")).where("not stays or n > 1"), "dropped")
    # The row's own columns are carried in one, so that no name of theirs is lost.
    tagged = docs.select(F.struct("*").alias("_row"), F.col(key).cast("long").alias("_id"), F.xxhash64(text_of(text)).alias("_mark"))

    def joined(rows: DataFrame, how: str) -> DataFrame:
        return tagged.alias("l").join(small(rows).alias("r"), [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in own], how)

    rest = joined(keys, "left_anti").select("_row.*")
    again = keys.where("stays")
    if again.isEmpty():
        return rest
    return rest.unionByName(joined(again, "left_semi").dropDuplicates(own).select("_row.*"))
