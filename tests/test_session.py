"""Where intermediate results are written."""

from care_lake import session


def test_the_configured_folder_is_used(spark, monkeypatch):
    monkeypatch.setattr(session, "_configured_folder", lambda s: "/shared/x/")
    assert session.shared_folder(spark) == "/shared/x"


def test_without_setting_the_warehouse_is_used(spark, monkeypatch):
    monkeypatch.setattr(session, "_configured_folder", lambda s: None)
    assert session.shared_folder(spark) == spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
    assert session.staged(spark.range(3), "t").count() == 3


def test_staged_keeps_the_schema(spark):
    df = spark.sql("select 1 as a, cast(null as date) as b, array('x') as c")
    assert session.staged(df, "t").dtypes == df.dtypes


def test_splits_are_small_while_tables_are_built_and_own_settings_stay(spark):
    default = spark.conf.get(session.SPLIT)
    with session.sorted_splits(spark):
        assert spark.conf.get(session.SPLIT) == session.SORTED_SPLIT
        with session.sorted_splits(spark):
            pass
        assert spark.conf.get(session.SPLIT) == session.SORTED_SPLIT
    assert spark.conf.get(session.SPLIT) == default
    spark.conf.set(session.SPLIT, "1m")
    try:
        with session.sorted_splits(spark):
            assert spark.conf.get(session.SPLIT) == "1m"
        assert spark.conf.get(session.SPLIT) == "1m"
    finally:
        spark.conf.unset(session.SPLIT)


def test_the_lake_reads_small_splits_where_it_writes_tables(spark, monkeypatch):
    """The rows a task sorts to find the newest copies are bounded by the split, not by the input."""
    from care_lake.plans import tables
    from workload.standin import PERIOD, RawTables

    seen, default = [], spark.conf.get(session.SPLIT)
    monkeypatch.setattr(tables, "staged", lambda df, *a: seen.append(spark.conf.get(session.SPLIT)) or df)
    own = tables.StagedLake(RawTables(spark, "/root/testdata/sf0.001"), PERIOD)
    assert own["encounter"].count() and seen == [session.SORTED_SPLIT]
    assert spark.conf.get(session.SPLIT) == default
