import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docquill.operators import changes
from docquill.operators.logs import LOG_SCHEMA
from docquill.session import work_path
from docquill.sources import files, tables


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "k string, record_hash string, body string")


def brute_feed(old, new):
    """Count rows per (key, hash) on both sides."""
    a, b = Counter(old), Counter(new)
    lost, gained = a - b, b - a
    lost_keys, gained_keys = {r[0] for r in lost}, {r[0] for r in gained}
    out = Counter()
    for r, n in lost.items():
        out[(*r, "update_preimage" if r[0] in gained_keys else "delete")] += n
    for r, n in gained.items():
        out[(*r, "update_postimage" if r[0] in lost_keys else "insert")] += n
    return out


@pytest.mark.parametrize("seed", range(4))
def test_change_feed_and_sync(spark, seed):
    rng = random.Random(seed)

    def draw(n):
        rows = []
        for _ in range(n):
            k, h = rng.choice("abcdef"), rng.choice("123")
            rows.append((k, h, f"{k}{h}"))
        return rows + [("hot", "9", "hot9")] * rng.choice([0, n // 2, n])

    old, new = draw(20), draw(20)
    got = Counter(tuple(r) for r in changes.change_feed(snapshot(spark, old), snapshot(spark, new), "k").collect())
    assert got == brute_feed(old, new)
    synced = changes.index_sync(snapshot(spark, old), snapshot(spark, new), "k", ["body"])
    assert Counter(tuple(r) for r in synced.collect()) == Counter(new)
    assert changes.index_status(synced, snapshot(spark, new), "k").first().ready


def test_change_feed_of_nothing(spark):
    some, none = [("a", "1", "x")], []
    assert changes.change_feed(snapshot(spark, none), snapshot(spark, none), "k").count() == 0
    assert changes.change_feed(snapshot(spark, some), snapshot(spark, some), "k").count() == 0
    assert changes.change_feed(snapshot(spark, none), snapshot(spark, some), "k").first()._change_type == "insert"
    assert changes.change_feed(snapshot(spark, some), snapshot(spark, none), "k").first()._change_type == "delete"


def test_a_value_that_moves_beside_a_null_is_a_change(spark):
    old = spark.createDataFrame([(1, "h", "a", None)], "k int, record_hash string, x string, y string")
    new = spark.createDataFrame([(1, "h", None, "a")], old.schema)
    assert changes.change_feed(old, new, "k").count() == 2
    assert tuple(changes.index_sync(old, new, "k", ["x", "y"]).first()) == (1, "h", None, "a")
    assert not changes.index_status(old, new, "k").first().ready


def test_big_change_is_not_broadcast(spark):
    from docquill.operators.sizes import settle

    rows = spark.range(10)
    small = rows.join(settle(rows, 10), "id")._jdf.queryExecution().optimizedPlan().toString()
    large = rows.join(settle(rows, 9), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in small and "strategy=broadcast" not in large


def test_status(spark):
    source = snapshot(spark, [("a", "1", ""), ("b", "1", ""), ("c", "1", "")])
    index = snapshot(spark, [("a", "1", ""), ("b", "2", ""), ("z", "1", "")])
    row = changes.index_status(index, source, "k", "n").first()
    assert tuple(row) == ("n", 3, 3, 1, 1, 1, False)


def test_rows_and_columns(spark):
    with pytest.raises(ValueError):
        tables.rows_to_table(spark, [])
    df = tables.rows_to_table(spark, [{"name": "Alice", "age": 1}])
    assert tables.validate_columns(df, ["name", "age"]) and tables.validate_columns(df, [])
    with pytest.raises(ValueError, match="email"):
        tables.validate_columns(df, ["name", "email"])


def test_write_append_info(spark):
    path = work_path(spark, "t")
    assert not tables.table_exists(spark, path) and not tables.table_exists(spark, "no_such_table")
    df = spark.range(5).withColumn("p", F.col("id") % 2)
    tables.write_table(df, path, partition_by=["p"])
    tables.append_rows(df, path + "-log")
    tables.append_rows(df, path + "-log")
    assert tables.table_row_count(spark, path) == 5 and tables.table_row_count(spark, path + "-log") == 10
    info = {r.table_name: (r.table_exists, r.row_count) for r in tables.catalog_info(spark, [path, "nope"]).collect()}
    assert info == {path: (True, 5), "nope": (False, None)}
    plan = tables.scan_table(spark, path).filter("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_append_keeps_the_schema(spark):
    path = work_path(spark, "log")
    with pytest.raises(ValueError, match="Missing required columns"):
        tables.append_rows(spark.range(1), path, LOG_SCHEMA)


def test_named_tables(spark):
    tables.write_table(spark.range(3), "docquill_test_table", properties={"kind": "test"})
    try:
        assert tables.table_row_count(spark, "docquill_test_table") == 3
        properties = {r.key: r.value for r in tables.table_properties(spark, "docquill_test_table").collect()}
        assert properties["kind"] == "test"
        got = tables.query_sql(spark, "SELECT count(*) AS n FROM docquill_test_table WHERE id >= :low", low=1)
        assert got.first().n == 2
    finally:
        spark.sql("DROP TABLE docquill_test_table")


def test_compaction_cuts_a_frequent_value(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("c"), "id")
    out = tables.compact_table(df, ["c"], 6)
    sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) >= 5 and max(r["count"] for r in sizes) < 1600
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_report_file(spark, tmp_path):
    path = files.write_report(spark.range(3), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(path).count() == 3


def test_status_compares_keys_of_differing_ranges_only(spark):
    rows = [(None if n == 7 else f"k{n}", str(n), "x" * 40) for n in range(6000)] + [("k1", "1", "x" * 40), ("k2", "2", "other")]
    index = snapshot(spark, rows)

    def status(new):
        got = changes.index_status(index, snapshot(spark, new), "k", "n")
        return tuple(got.first()), "sha2" in got._jdf.queryExecution().optimizedPlan().toString()

    # Equal rows in another order: no row is left to be compared by its key.
    assert status(rows[::-1]) == (("n", 6002, 6002, 0, 0, 0, True), False)
    # A copy less, a key gone, a key new, and a row without key that has other text.
    changed = [r for r in rows[:6000] if r[0] not in (None, "k9")] + [("k2", "2", "other"), (None, "7", "y"), ("new", "1", "")]
    assert status(changed) == (("n", 6001, 6002, 1, 2, 1, False), True)
    assert status([(k, h, b + "!") for k, h, b in rows]) == (("n", 6002, 6002, 0, 6000, 0, False), True)
    assert status([]) == (("n", 0, 6002, 0, 0, 6000, False), True)
    none = snapshot(spark, [])
    assert tuple(changes.index_status(none, none, "k", "n").first()) == ("n", 0, 0, 0, 0, 0, True)
