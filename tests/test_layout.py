"""Clustered and bucketed tables: which files are opened, and that rows are whole."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from care_lake.plans import reports
from care_lake.sources import layout
from workload.standin import lake, read

SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def buckets_shown(spark):
    """Spark prunes buckets either way, but names their number only where it reads bucket by bucket."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    yield
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


@pytest.fixture(scope="module")
def orders(spark):
    return read(spark, SF, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority")


@pytest.fixture(scope="module")
def clustered(spark, orders, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    rows = layout.write_clustered(orders, root, "gold", "orders", ["o_custkey", "day"], files=64, comment="orders", properties={"quality": "gold"})
    return root, rows


def test_curve_deals_the_bits_in_turn(spark):
    df = spark.createDataFrame([(5, 3)], "a int, b int")
    assert df.select(layout.curve_place([F.col("a"), F.col("b")], bits=3)).first()[0] == 0b100111


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 63])
def test_share_is_the_number_of_cuts_at_or_below(spark, n):
    cuts = [3 * i - n for i in range(n)]
    values = [None, *range(-70, 140)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    found = [r[0] for r in df.coalesce(1).select(layout.share_of(F.col("v"), cuts)).collect()]
    assert found == [0 if v is None else sum(c <= v for c in cuts) for v in values]


def test_place_of_a_text_is_worked_out_once_a_row(spark):
    df = spark.createDataFrame([(f"{i:03d}", i) for i in range(300)], "name string, n int")
    text = layout.placed(df, ["name", "n"])._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("conv(") == 1


def test_bounds_of_files_are_found_without_a_sort(spark, clustered):
    root, rows = clustered
    both = rows.select("o_orderpriority", "day")
    assert "SortAggregate" not in plan(layout.file_bounds(both, both.columns))
    want = both.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*"), F.min("o_orderpriority"), F.max("o_orderpriority"), F.min("day"), F.max("day"), F.lit(0), F.lit(0))
    assert sorted(layout.file_bounds(both, both.columns).collect()) == sorted(want.collect())


def test_each_column_opens_few_files(spark, orders, clustered):
    root, rows = clustered
    assert rows.count() == orders.count()
    total = len(rows.inputFiles())
    assert total == 64
    days = (date(1996, 3, 1), date(1996, 3, 20))
    for where, most in (({"o_custkey": 77}, 0.3), ({"day": days}, 0.3), ({"o_custkey": (70, 90), "day": days}, 0.06), ({"o_custkey": (None, 60)}, 0.4)):
        found = layout.read_clustered(spark, root, "gold", "orders", where)
        want = orders
        for c, w in where.items():
            first, last = w if isinstance(w, tuple) else (w, w)
            want = want.where((F.col(c) >= first) if first is not None else F.lit(True)).where(F.col(c) <= last)
        assert sorted(found.collect()) == sorted(want.collect())
        assert len(layout.files_of(spark, root, "gold", "orders", where)) <= most * total, where
    assert layout.files_of(spark, root, "gold", "orders", {"day": date(1950, 1, 1)}) == []
    assert layout.read_clustered(spark, root, "gold", "orders", {"day": date(1950, 1, 1)}).columns == orders.columns


def test_one_sort_order_opens_more_files_than_the_curve(spark, orders, clustered, tmp_path):
    root, _ = clustered
    layout.write_clustered(orders, str(tmp_path), "gold", "by_customer", ["o_custkey"], files=64)
    by_day = {"day": (date(1996, 3, 1), date(1996, 3, 20))}
    in_one_order = len(layout.files_of(spark, str(tmp_path), "gold", "by_customer", by_day))
    assert in_one_order == 64 > 3 * len(layout.files_of(spark, root, "gold", "orders", by_day))


def test_comment_and_properties_are_kept(spark, clustered):
    about = layout.describe(spark, clustered[0], "gold", "orders")
    assert (about["comment"], about["properties"], about["clustered_by"]) == ("orders", {"quality": "gold"}, ["o_custkey", "day"])


def test_a_hot_value_is_split_and_nulls_are_kept(spark, tmp_path):
    rows = [(7 if i % 3 else i, None if i % 10 == 0 else f"name {i % 100:03d}", i) for i in range(30_000)]
    df = spark.createDataFrame(rows, "k long, s string, v int")
    kept = layout.write_clustered(df, str(tmp_path), "silver", "hot", ["k", "s"], files=16)
    sizes = [r["count"] for r in kept.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 3 * 30_000 / 16
    found = layout.read_clustered(spark, str(tmp_path), "silver", "hot", {"k": 7, "s": "name 011"})
    assert sorted(r.v for r in found.collect()) == sorted(v for k, s, v in rows if k == 7 and s == "name 011")
    none = layout.write_clustered(df.where("v < 0"), str(tmp_path), "silver", "none", ["k", "s"])
    assert none.count() == 0 and layout.read_clustered(spark, str(tmp_path), "silver", "none", {"k": 1}).count() == 0


def test_one_patient_reads_one_bucket(spark, tmp_path, buckets_shown):
    t = lake(spark, SF)
    facts = {}
    for name in ("fact_lab_result", "fact_condition", "patient_timeline"):
        layout.write_bucketed(t[name], str(tmp_path), "gold", name, "patient_id", 16)
        facts[name] = layout.read_bucketed(spark, str(tmp_path), "gold", name)
    for report in (reports.patient_labs, reports.patient_diagnoses, reports.patient_events):
        found = report(facts, "7")
        assert "SelectedBucketsCount: 1 out of 16" in plan(found)
        assert sorted(map(str, found.collect())) == sorted(map(str, report(t, "7").collect()))
    assert facts["fact_condition"].count() == t["fact_condition"].count()


def test_buckets_join_without_a_shuffle_and_are_found_again(spark, tmp_path):
    t = lake(spark, SF)
    for name in ("fact_condition", "patient_360"):
        layout.write_bucketed(t[name], str(tmp_path), "gold", name, "patient_id", 8)
        spark.sql(f"DROP TABLE {layout.bucketed_name(str(tmp_path), 'gold', name)}")  # as in a new session
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, people = (layout.read_bucketed(spark, str(tmp_path), "gold", n) for n in ("fact_condition", "patient_360"))
        both = facts.select("patient_id", "icd10cm_code").join(people.select("patient_id", "age"), "patient_id")
        assert "SortMergeJoin" in plan(both) and "Exchange" not in plan(both)
        assert both.count() == t["fact_condition"].join(t["patient_360"], "patient_id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_patient_is_written_by_several_tasks(spark, tmp_path, buckets_shown):
    df = spark.range(300_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as patient_id", "sha2(cast(id as string), 256) as v")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        kept = layout.write_bucketed(df, str(tmp_path), "gold", "hot", "patient_id", 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = kept.where("patient_id = 'hot'")
    assert "SelectedBucketsCount: 1 out of 4" in plan(hot) and hot.count() == 100_000
    assert hot.select(F.col("_metadata.file_path")).distinct().count() > 2
