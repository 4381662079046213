import datetime as dt
import glob
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docquill.operators import changes, snapshots
from docquill.session import work_path
from docquill.sources import tables


def test_changes_below_a_millisecond_and_in_any_type(spark):
    schema = "k long, at timestamp, ntz timestamp_ntz, x double, raw binary, n struct<when:timestamp,list:array<double>>"
    t = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)

    def row(k, micros=0, x=1.0, raw=b"a", inner=0, y=2.0):
        return (k, t + dt.timedelta(microseconds=micros), t + dt.timedelta(microseconds=micros), x, bytearray(raw), (t + dt.timedelta(microseconds=inner), [y]))

    old = [row(1), row(2), row(3, x=math.nan), row(4, x=0.0), row(5), row(6), row(7, x=None)]
    new = [row(1, micros=543), row(2, inner=1), row(3, x=math.nan), row(4, x=-0.0), row(5, raw=b"b"), row(6, y=math.inf), row(7, x=None)]
    old, new = (spark.createDataFrame(rows, schema) for rows in (old, new))
    feed = changes.change_feed(old, new, "k")
    assert Counter((r.k, r._change_type) for r in feed.collect()) == Counter((k, kind) for k in (1, 2, 4, 5, 6) for kind in ("update_preimage", "update_postimage"))
    assert changes.index_status(old, new, "k").first().stale == 5


def written(spark, rows, levels):
    path = work_path(spark, "snapshot")
    snapshots.write_snapshot(rows, path, "k", levels)
    return path


@pytest.mark.parametrize("levels", [1, 2])
def test_only_differing_ranges_are_read(spark, levels):
    rng = random.Random(levels)
    old = [(k, rng.choice("abc")) for k in range(400)] + [(7, "twice"), (7, "twice")]
    new = [r for r in old if r[0] != 11]
    new = [(k, "changed") if k == 30 else (k, v) for k, v in new] + [(1000, "new"), (7, "twice")]
    sides = [spark.createDataFrame(rows, "k long, v string").repartition(n) for rows, n in ((old, 3), (new, 5))]
    paths = [written(spark, side, levels) for side in sides]
    got = snapshots.snapshot_changes(spark, *paths, "k", sides[0].schema, levels)
    want = changes.change_feed(*sides, "k")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    ranges, compared = snapshots.differing_ranges(spark, *paths, levels)
    # Keys 7, 11, 30 and 1000 have changed.
    assert 1 <= len(ranges) <= 4 and compared <= 1 + 4 * 2**snapshots.FAN_BITS * levels
    # The other ranges' files can't be read any more, and needn't be.
    for path in paths:
        for file in glob.glob(f"{path}/rows/_range=*/*.parquet"):
            if int(file.split("_range=")[1].split("/")[0]) not in ranges:
                with open(file, "wb") as damaged:
                    damaged.write(b"no table")
    again = snapshots.snapshot_changes(spark, *paths, "k", sides[0].schema, levels)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, want.collect()))


def test_equal_and_empty_snapshots(spark):
    rows = spark.createDataFrame([(k, "x") for k in range(50)], "k long, v string")
    a, b = written(spark, rows, 2), written(spark, rows.orderBy(F.desc("k")), 2)
    assert snapshots.differing_ranges(spark, a, b) == ([], 1)
    assert snapshots.snapshot_changes(spark, a, b, "k", rows.schema).count() == 0
    none = written(spark, rows.limit(0), 2)
    assert snapshots.snapshot_changes(spark, none, b, "k", rows.schema).where("_change_type = 'insert'").count() == 50
    assert snapshots.snapshot_changes(spark, none, none, "k", rows.schema).count() == 0


def test_filters_on_each_column_skip_files(spark):
    rng = random.Random(1)
    rows = spark.createDataFrame([(rng.random(), f"{rng.randrange(10**6):06d}", dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(900)), i) for i in range(4000)] + [(None, None, None, -1)], "x double, name string, day date, i int")
    path = work_path(spark, "clustered")
    tables.cluster_table(rows, ["x", "name", "day"], 64).write.parquet(path)
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, rows.collect()))
    spans = back.groupBy(F.input_file_name()).agg(*[f(c).alias(f"{c}_{n}") for c in ("x", "name", "day") for n, f in (("lo", F.min), ("hi", F.max))]).collect()
    for column, value in (("x", 0.37), ("name", "612345"), ("day", dt.date(2021, 3, 3))):
        touched = sum(s[f"{column}_lo"] <= value <= s[f"{column}_hi"] for s in spans if s[f"{column}_lo"] is not None)
        assert 0 < touched <= len(spans) / 2, (column, touched, len(spans))


def test_vectors_differ_in_nulls_zeros_order_and_length(spark):
    base = [1.0, 0.0, 2.0]
    others = [[2.0, 0.0, 1.0], [1.0, -0.0, 2.0], [1.0, None, 2.0], [None, 1.0, 2.0], [1.0, 2.0], [], None, [1.0, 0.0, math.nan], [1.0, 0.0, 2.0000002]]
    for kind in ("float", "double"):
        old = spark.createDataFrame([(i, base) for i in range(len(others) + 2)], f"k long, v array<{kind}>")
        new = spark.createDataFrame([*enumerate(others), (len(others), base), (len(others) + 1, base)], f"k long, v array<{kind}>")
        assert changes.index_status(old, new, "k").first().stale == len(others)
        assert changes.index_status(new, new, "k").first().ready
        # Equal numbers of different types are equal, as they were.
        assert changes.index_status(old, old.withColumn("v", F.col("v").cast("array<double>")), "k").first().ready


def test_a_table_without_later_changes_is_read_as_it_is(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, 1.0])], "k long, v array<float>").withColumn("_sign", F.lit(1))
    got = changes.replay(rows, rows.where("k < 0"), "k")
    assert sorted(tuple(r) for r in got.collect()) == [(1, [1.0, 2.0]), (2, [0.5, 1.0])]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "Join" not in plan


def test_only_odd_vectors_are_written_out(spark):
    """A NULL or a negative zero anywhere, also beside zeros; as text, as hashes don't tell those apart."""
    rows = [([0.0, 1.0] * 200, False), ([0.0, 1.0] * 200 + [-0.0], True), ([-0.0], True), ([0.0, 0.0, None], True), ([None], True), ([], False), (None, None), ([math.nan, 0.0], False)]
    for kind in ("float", "double"):
        df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(rows)], f"i int, v array<{kind}>").repartition(3)
        got = {r.i: r.odd for r in df.select("i", F.startswith(changes._short("v", kind), F.lit("{")).alias("odd")).collect()}
        assert got == {i: odd for i, (_, odd) in enumerate(rows)}
        plan = df.select(changes._short("v", kind))._jdf.queryExecution().optimizedPlan().toString()
        # Whole vectors are neither cast nor taken apart by a lambda.
        assert "lambda" not in plan and "cast(v" not in plan
