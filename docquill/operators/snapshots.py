"""Snapshots that are written in key ranges with a tree of digests, so that comparing two reads only what differs.

A range is a prefix of the hash of the key, so ranges are of even size and both snapshots cut them alike. A range is a folder. Its
digest is that of a multiset: the number of rows and, for each 32-bit part of the rows' SHA-256, the sum of the parts; equal
sets of rows give equal digests in whatever order and number of files they lie. Each further level of the tree has the SHA-256 of
FAN digests below, up to the root. The tree is a small table beside the rows.

Two trees are compared from the root: a level's nodes are looked at only below nodes that differ. Rows are then read from the
differing ranges alone, the folders being pruned, and given to the change feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .changes import change_feed, content

#: Bits of the key's hash by which the tree branches, and levels below the root.
FAN_BITS, LEVELS = 3, 2


def key_range(key: str, levels: int = LEVELS) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - FAN_BITS * levels).cast("int")


def _leaf_digest(columns: list[str]) -> Column:
    digest = content(columns)
    # Sums of 32-bit parts stay in 64 bits up to 2^31 rows of a range; beyond, more levels are due.
    parts = [F.sum(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")) for i in range(8)]
    return F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[p.cast("string") for p in parts]), 256)


def write_snapshot(df: DataFrame, path: str, key: str, levels: int = LEVELS) -> None:
    """The rows under path/rows, a folder per range, and the tree under path/tree: level, node, digest, n."""
    spark = df.sparkSession
    ranged = df.withColumn("_range", key_range(key, levels))
    ranged.repartition("_range").write.partitionBy("_range").parquet(f"{path}/rows")
    written = _rows(spark, path, df.schema)
    nodes = written.groupBy(F.col("_range").cast("int").alias("node")).agg(_leaf_digest(df.columns).alias("digest"), F.count(F.lit(1)).alias("n"))
    nodes.withColumn("level", F.lit(levels)).write.parquet(f"{path}/tree/level={levels}")
    for level in range(levels - 1, -1, -1):
        below = spark.read.parquet(f"{path}/tree/level={level + 1}")
        pairs = F.array_sort(F.collect_list(F.struct("node", "digest")))
        text = F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p["node"].cast("string"), p["digest"])), ",")
        # At most 2^FAN_BITS digests to a node.
        up = below.groupBy(F.shiftright("node", FAN_BITS).alias("node")).agg(F.sha2(text, 256).alias("digest"), F.sum("n").alias("n"))
        up.withColumn("level", F.lit(level)).write.parquet(f"{path}/tree/level={level}")


def _rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema, StructField("_range", IntegerType())])).parquet(f"{path}/rows")


def differing_ranges(spark: SparkSession, old: str, new: str, levels: int = LEVELS) -> tuple[list[int], int]:
    """The ranges whose rows differ, and the number of tree nodes that were compared.

    A level has at most 2^FAN_BITS nodes for each differing node above it.
    """
    open_, compared = None, 0
    for level in range(levels + 1):
        sides = [spark.read.parquet(f"{p}/tree/level={level}") for p in (old, new)]
        if open_ is not None:
            sides = [s.where(F.shiftright("node", FAN_BITS).isin(open_)) for s in sides]
        both = sides[0].alias("o").join(sides[1].alias("n"), "node", "full").select("node", (~F.col("o.digest").eqNullSafe(F.col("n.digest"))).alias("differs"))
        rows = both.collect()
        compared += len(rows)
        open_ = [r.node for r in rows if r.differs]
        if not open_:
            return [], compared
    return sorted(open_), compared


def snapshot_changes(spark: SparkSession, old: str, new: str, key: str, schema: StructType, levels: int = LEVELS) -> DataFrame:
    """`change_feed` of two written snapshots; rows of equal ranges are never read. `schema` is that of the rows."""
    ranges, _ = differing_ranges(spark, old, new, levels)

    def read(path: str) -> DataFrame:
        return _rows(spark, path, schema).where(F.col("_range").isin(ranges)).select(schema.names)

    return change_feed(read(old), read(new), key)
