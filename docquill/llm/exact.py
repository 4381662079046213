"""Exact duplicates through minimal perfect hashes over the distinct digests seen so far.

Two texts are equal if they are identical without the characters [\\x20\\x09-\\x0D]; SHA-256 stands for
the text. A history is a table of shards. A shard has some 100,000 distinct digests, a minimal perfect hash
of them, and one slot per digest with the whole digest and the locator of the winner: the id
and length of the row that stays, and the number of copies. The hash has levels of bits: a
digest takes a bit of a level if no other digest wants the same one, the rest go on to the next
level; the rank of its bit is its slot.

Rows meet their shard in groups of bounded size: a shard that more than ROWS rows ask for, such as
that of a text which a third of all rows have, is copied for groups of them. A slot
answers for a row only if all bytes of the digest agree, so strangers are told apart; those
nonmembers are then grouped among themselves in the same way.

Of equal texts the row with most characters stays, then that with the smallest id, ids before null. Cases: null text
counts as empty, empty texts are equal to each other; of repeated rows with the same id
and length, one stays; an empty table gives no rows and an empty history; only the named columns are read,
so further columns never clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Bits, mixed, settled, small, text_of

#: Distinct digests of a shard, and rows that ask one copy of it.
KEYS, ROWS = 100_000, 200_000
_LEVELS = 64

HISTORY = "shard int, sizes array<long>, bits binary, digests binary, ids array<long>, chars array<long>, copies array<long>"


def digest(text: str | Column) -> Column:
    """SHA-256 of the text without white space, as 32 bytes."""
    return F.unhex(F.sha2(F.regexp_replace(text_of(text), r"[\x20\x09-\x0D]+", "").cast("binary"), 256))


def digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One narrow row (id, digest, chars) per document, written once."""
    return settled(docs.select(F.col(key).cast("long").alias("id"), digest(text).alias("digest"), F.length(text_of(text)).cast("long").alias("chars")), "digests")


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys of two 64-bit numbers."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.starts, self.bits, self.set = sizes, np.cumsum([0, *sizes]), bits, Bits(bits)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys[:, 0] + mixed(keys[:, 1] + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        for level in range(_LEVELS):
            if not len(keys):
                return cls(sizes, np.concatenate([np.zeros(0, bool), *levels]))
            size = 2 * len(keys)
            place = cls._place(keys, level, size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[place]]
        raise ValueError("two distinct digests agree in their first 128 bits")

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; for strangers any slot, or -1."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            place = self.starts[level] + self._place(keys[todo], level, size)
            hit = self.set.at(place) == 1
            out[todo[hit]] = self.set.ones(place[hit])
            todo = todo[~hit]
        return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Digests as rows of 32 bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _keys(matrix: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(matrix[:, :16]).view(np.uint64).reshape(-1, 2)


def _build(table: pa.Table) -> pa.Table:
    """One shard: its perfect hash, and its slots in order."""
    matrix = _matrix(table.column("digest"))
    found = PerfectHash.build(_keys(matrix))
    order = np.argsort(found.slot(_keys(matrix)))
    lists = {to: pa.array([table.column(c).take(pa.array(order)).to_pylist()], pa.list_(pa.int64())) for c, to in (("id", "ids"), ("chars", "chars"), ("copies", "copies"))}
    return pa.table(
        {
            "shard": table.column("shard").slice(0, 1),
            "sizes": pa.array([found.sizes], pa.list_(pa.int64())),
            "bits": pa.array([np.packbits(found.bits, bitorder="little").tobytes()]),
            "digests": pa.array([matrix[order].tobytes()]),
            **lists,
        }
    )


def build_history(rows: DataFrame, keys: int = KEYS) -> tuple[DataFrame, int]:
    """The history of digest rows, and its number of shards. One row per shard, bounded by `keys`."""
    first = F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    winners = rows.groupBy("digest").agg(F.min(first).alias("w"), F.count("*").alias("copies"))
    winners = settled(winners.select("digest", F.col("w.id").alias("id"), (-F.col("w.chars")).alias("chars"), "copies"), "winners")
    shards = max(1, -(-winners.count() // keys))
    history = winners.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(_build, HISTORY)
    return settled(history, "history"), shards


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def _look_up(rows: pa.Table, shard: pa.Table) -> pa.Table:
    """The rows with member, keep_id, keep_chars, copies and first (of rows repeated as a whole)."""
    n = rows.num_rows
    member, slot = np.zeros(n, bool), np.zeros(n, np.int64)
    names = ["id", "digest", "chars"]
    if n and shard.num_rows:
        sizes, raw = shard.column("sizes")[0].as_py(), shard.column("bits")[0].as_py()
        bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: sum(sizes)].astype(bool)
        asked = _matrix(rows.column("digest"))
        slots = np.frombuffer(shard.column("digests")[0].as_py(), np.uint8).reshape(-1, 32)
        slot = PerfectHash(sizes, bits).slot(_keys(asked))
        member = (slot >= 0) & (slots[np.maximum(slot, 0)] == asked).all(1)
    seen: set[tuple] = set()
    first = []
    for row in zip(*(rows.column(c).to_pylist() for c in names), strict=True):
        first.append(row not in seen)
        seen.add(row)
    out = {c: rows.column(c) for c in names} | {"member": pa.array(member)}
    for source, to in (("ids", "keep_id"), ("chars", "keep_chars"), ("copies", "copies")):
        if member.any():
            values = shard.column(source)[0].values
            out[to] = values.take(pa.array(np.maximum(slot, 0), mask=~member))
        else:
            out[to] = pa.nulls(n, pa.int64())
    return pa.table(out | {"first": pa.array(first, pa.bool_())})


def look_up(rows: DataFrame, history: DataFrame, shards: int, most: int = ROWS) -> DataFrame:
    """Every digest row with what its slot says; all null for nonmembers."""
    rows = rows.select("id", "digest", "chars", _shard(shards).alias("shard"))
    hot = rows.groupBy("shard").count().where(F.col("count") > most)
    hot = small(settled(hot.select("shard", F.ceil(F.col("count") / most).cast("int").alias("parts")), "hot"))
    salt = F.pmod(F.xxhash64("id", "chars"), F.coalesce("parts", F.lit(1))).cast("int")
    asking = rows.join(hot, "shard", "left").withColumn("salt", salt).select("shard", "salt", "id", "digest", "chars")
    copies = history.join(hot, "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    schema = "id long, digest binary, chars long, member boolean, keep_id long, keep_chars long, copies long, first boolean"
    return asking.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(_look_up, schema)


def _update(shard: pa.Table, more: pa.Table) -> pa.Table:
    """A shard whose slots take in further rows of their digests: the winner may change, the copies add up."""
    if not more.num_rows or not shard.num_rows:
        return shard
    sizes, raw = shard.column("sizes")[0].as_py(), shard.column("bits")[0].as_py()
    bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: sum(sizes)].astype(bool)
    slots = PerfectHash(sizes, bits).slot(_keys(_matrix(more.column("digest"))))
    ids, chars, copies = (shard.column(c)[0].as_py() for c in ("ids", "chars", "copies"))
    for slot, i, n, m in zip(slots.tolist(), *(more.column(c).to_pylist() for c in ("id", "chars", "copies")), strict=True):
        copies[slot] += m
        if (-n, i is None, i or 0) < (-chars[slot], ids[slot] is None, ids[slot] or 0):
            ids[slot], chars[slot] = i, n
    kept = {c: shard.column(c) for c in ("shard", "sizes", "bits", "digests")}
    return pa.table(kept | {c: pa.array([v], pa.list_(pa.int64())) for c, v in (("ids", ids), ("chars", chars), ("copies", copies))})


def update_history(history: tuple[DataFrame, int], rows: DataFrame) -> tuple[DataFrame, int]:
    """The history after further rows of digests that it has; others are an error of the caller's."""
    table, shards = history
    first = F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    more = rows.groupBy("digest").agg(F.min(first).alias("w"), F.count("*").alias("copies"))
    more = more.select(_shard(shards).alias("shard"), "digest", F.col("w.id").alias("id"), (-F.col("w.chars")).alias("chars"), "copies")
    updated = table.groupBy("shard").cogroup(more.groupBy("shard")).applyInArrow(_update, HISTORY)
    return settled(updated, "history"), shards


def decide_in_parts(rows: DataFrame, earlier: Column) -> DataFrame:
    """The columns of `decide`, by a history of the earlier rows, whatever rows are called earlier.

    Later rows are looked up in the history of the earlier ones. Members are taken into their digests' slots; all rows are
    then answered by the updated history, and those it doesn't know are grouped among themselves.
    """
    history = build_history(rows.where(earlier))
    found = settled(look_up(rows.where(~earlier), *history), "members")
    history = update_history(history, found.where("member").select("id", "digest", "chars"))
    known = settled(look_up(rows, *history), "answers")
    strangers = known.where("not member").select("id", "digest", "chars")
    own = known.where("member").unionByName(look_up(strangers, *build_history(strangers)))
    wins = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars")) & F.col("first")
    return own.select("id", "chars", "keep_id", "copies", wins.alias("kept"), "digest")


def decide(rows: DataFrame, history: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Per digest row: id, chars, keep_id, copies, kept and digest.

    With a history of earlier rows, a member is a repeat and goes; its keep_id is the earlier row. Nonmembers, or
    without a history all rows, are grouped among themselves, and the winner of each group stays.
    """
    seen = None
    if history is not None:
        found = settled(look_up(rows, *history), "members")
        seen = found.where("member").select("id", "chars", "keep_id", "copies", F.lit(False).alias("kept"), "digest")
        rows = found.where("not member").select("id", "digest", "chars")
    own = look_up(rows, *build_history(rows))
    wins = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars")) & F.col("first")
    own = own.select("id", "chars", "keep_id", "copies", wins.alias("kept"), "digest")
    return own if seen is None else seen.unionByName(own)


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents that stay, all their columns; of rows repeated with one id, length and text, one."""
    # The row's own columns are carried in one, so that no name of theirs is lost.
    own = ["_id", "_digest", "_chars"]
    decided = decide(digests(docs, text, key))
    keys = decided.groupBy(F.col("id").alias("_id"), F.col("digest").alias("_digest"), F.col("chars").alias("_chars"))
    keys = settled(keys.agg(F.max("kept").alias("_stays"), F.count("*").alias("_n")).where("not _stays or _n > 1"), "dropped")
    marks = [F.col(key).cast("long").alias("_id"), digest(text).alias("_digest"), F.length(text_of(text)).cast("long").alias("_chars")]
    tagged = docs.select(F.struct("*").alias("_row"), *marks)

    def joined(rows: DataFrame, how: str) -> DataFrame:
        left, right = tagged.alias("l"), small(rows).alias("r")
        return left.join(right, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in own], how)

    rest = joined(keys, "left_anti").select("_row.*")
    again = keys.where("_stays")
    if again.isEmpty():
        return rest
    return rest.unionByName(joined(again, "left_semi").dropDuplicates(own).select("_row.*"))
