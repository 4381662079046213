"""The first place of every key, streamed from range-partitioned, sorted rows; DataFrame functions only.

Keys that hold more than a set share of all rows never meet in one task. They are found exactly, by two counts: buckets of
keys with more rows than the limit, then the keys within those buckets. A limit of n / 2^15 rows leaves at most 2^15 such
keys, so their first places are broadcast whatever the table's size is. All other keys are dealt by ranges, with a secondary
sort by place, and the first row of each run of a key gives the key's first place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled

#: Rows that a key may always have in one task, most keys beyond the limit (as a power of two), and buckets of the first count.
LEAST, MOST_HOT, BUCKETS = 1000, 15, 1 << 18


def with_first(rows: DataFrame, key: str = "hash", place: str = "place") -> DataFrame:
    """A settled table's rows with the column `first`, the least place among the rows of their key."""
    limit = max(LEAST, rows.count() >> MOST_HOT)
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    crowded = rows.groupBy(bucket.alias("_bucket")).count().where(F.col("count") > limit).select("_bucket")
    near = rows.join(F.broadcast(crowded), bucket == F.col("_bucket"), "left_semi")
    hot = near.groupBy(key).agg(F.count("*").alias("n"), F.min(place).alias("first")).where(F.col("n") > limit)
    told = rows.join(F.broadcast(settled(hot.select(key, "first"), "hot")), key, "left")
    run = Window.partitionBy(key).orderBy(place)
    cold = told.where(F.col("first").isNull()).drop("first").repartitionByRange(key)
    return told.where(F.col("first").isNotNull()).unionByName(cold.withColumn("first", F.first(place).over(run)))
