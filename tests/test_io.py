"""Sources and sinks: write modes, clustered layout, bucketed write, staging
projection, incremental load."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from auditmart.operators.audit import duplicate_keys
from auditmart.queries import programs, states
from auditmart.sources import TableRef, cluster, read_table, scratch_path, write_clustered, write_table
from auditmart.sources.staging import denormalize, existing_table, incremental_load, staging_projection
from conftest import SF


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_append_is_default_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    path = scratch_path(spark, "test/append")
    write_table(df, path)
    write_table(df, path)
    assert read_table(spark, path).count() == 4
    write_table(df, path, mode="overwrite")
    assert read_table(spark, path).count() == 2


def test_cluster_is_bag_equal_and_sorted(spark):
    ev = read_table(spark, f"{SF['0.01']}/events.parquet")
    c = cluster(ev, ["user_id", "ts"], num_partitions=6)
    assert bag(c) == bag(ev)
    parts = c.rdd.mapPartitions(lambda it: [[(r["user_id"], r["ts"]) for r in it]]).collect()
    for prt in parts:
        assert prt == sorted(prt)
    # partitions are contiguous ranges of the compound key
    firsts_lasts = [(p[0], p[-1]) for p in parts if p]
    for (a, b), (c2, _) in zip(firsts_lasts, firsts_lasts[1:]):
        assert b <= c2


def test_write_clustered_one_file_a_bucket_and_hot_program_spread(spark):
    """40 tasks, one program with nine tenths of the rows: a file per bucket, and
    the program is spread over most of them."""
    df = spark.range(0, 4000, 1, 40).selectExpr(
        "IF(id % 10 = 0, id % 7, 99) AS program_id", "id % 2 AS calendar_season_id", "id % 50 AS day"
    )
    name, keys = "auditmart_bucket_test", ["program_id", "calendar_season_id", "day"]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_clustered(df, name, "program_id", keys, num_buckets=8, mode="overwrite")
    back = spark.table(name)
    assert bag(back) == bag(df)
    assert len(back.inputFiles()) <= 8
    hot = back.where("program_id = 99").select(F.input_file_name()).distinct().count()
    assert hot >= 6
    agg_plan = back.groupBy(*keys).count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in agg_plan  # buckets co-locate the whole key
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_staging_projection_drops_binary_and_cuts_named_columns_only(spark):
    import pytest

    df = spark.createDataFrame(
        [(1, "x" * 1500, "y" * 1500, bytearray(b"\x00\x01"), 2.5)], "id long, t string, u string, b binary, d double"
    )
    whole = staging_projection(df)
    assert whole.columns == ["id", "t", "u", "d"]
    assert (len(whole.first()["t"]), len(whole.first()["u"])) == (1500, 1500)
    cut = staging_projection(df, {"t": 1000}).first()
    assert (len(cut["t"]), len(cut["u"])) == (1000, 1500)
    with pytest.raises(ValueError):
        staging_projection(df, {"d": 3})


def test_denormalize_keeps_all_children(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "ok long, x long")
    parent = spark.createDataFrame([(1, 100, "a"), (2, 200, "b")], "pk long, cust long, s string")
    out = denormalize(child, parent, "ok", "pk", ["cust"])
    assert out.columns == ["ok", "x", "cust"]
    assert bag(out) == Counter([(1, 10, 100), (2, 20, 200), (3, 30, None)])


def staged_ids(spark, target):
    return sorted(r["id"] for r in read_table(spark, target).collect())


def test_incremental_load_stages_late_tied_and_undated_rows_once(spark):
    at = dt.datetime(2024, 1, 1)
    first = [(1, at), (2, at + dt.timedelta(hours=5)), (3, None)]
    later = first + [(4, at + dt.timedelta(hours=5)), (5, at - dt.timedelta(days=9)), (6, None), (7, at + dt.timedelta(hours=6))]
    schema = "id long, ts timestamp_ntz"
    target = scratch_path(spark, "test/incremental")
    assert existing_table(spark, target) is None
    for rows in (first, later, later):
        incremental_load(spark, spark.createDataFrame(rows, schema), target, ["id"])
    assert staged_ids(spark, target) == [1, 2, 3, 4, 5, 6, 7]


def test_incremental_load_pruned_by_an_ordered_timestamp(spark):
    """A source that only adds newer or equal timestamps: the scan is pruned to
    the watermark, ties and undated rows are still staged once."""
    at = dt.datetime(2024, 1, 1)
    rows = [(i, at + dt.timedelta(hours=i // 2)) for i in range(10)] + [(10, None)]
    schema = "id long, ts timestamp_ntz"
    target = scratch_path(spark, "test/incremental_ordered")
    for upto in (3, 6, 11, 11):
        incremental_load(spark, spark.createDataFrame(rows[:upto], schema), target, ["id"], ts_col="ts")
    assert staged_ids(spark, target) == list(range(11))


def test_incremental_load_only_undated_rows_and_the_autumn_hour(spark):
    """Instants around the hour that New York's clocks repeat, over three runs."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        base = spark.range(6).selectExpr(
            "id", "IF(id = 5, NULL, timestamp_seconds(1730610000 + id * 1800)) AS ts"  # 2024-11-03 05:00 UTC on
        )
        for ts_col in (None, "ts"):
            target = scratch_path(spark, "test/incremental_autumn")
            incremental_load(spark, base.where("id = 5"), target, ["id"], ts_col=ts_col)
            for upto in (2, 4, 6, 6):
                incremental_load(spark, base.where(f"id < {upto}"), target, ["id"], ts_col=ts_col)
            assert staged_ids(spark, target) == list(range(6))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_mistyped_target_is_an_error(spark):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        existing_table(spark, TableRef("no_such_database.events.x.y", catalog=True))


def test_stream_stages_old_files(spark, tmp_path):
    """A file that lands with an old modification time is staged too."""
    import os
    import shutil
    import time

    from auditmart.streaming import stage_new_files

    landing = tmp_path / "landing"
    landing.mkdir()
    source = f"{SF['0.001']}/events.parquet"
    schema, n = read_table(spark, source).schema, read_table(spark, source).count()
    base = scratch_path(spark, "test/stream_old")
    for i, age in enumerate((0, 30)):
        path = landing / f"part-{i}.parquet"
        shutil.copy(source, path)
        os.utime(path, (time.time() - age * 86400,) * 2)
        stage_new_files(spark, str(landing), schema, f"{base}/table", f"{base}/_checkpoint")
        assert read_table(spark, f"{base}/table").count() == (i + 1) * n


def test_scratch_folder_is_handed_over_for_deletion(spark):
    path = scratch_path(spark, "test/cleanup")
    root = path.split("/test/cleanup/")[0]
    assert root.endswith(spark.sparkContext.applicationId)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.cancelDeleteOnExit(folder)  # it was registered
    assert files.deleteOnExit(folder)


def test_catalog_table_roundtrip(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    ref = TableRef("auditmart_catalog_test", catalog=True)
    spark.sql("DROP TABLE IF EXISTS auditmart_catalog_test")
    write_table(df, ref, mode="overwrite")
    write_table(df, ref)  # append
    assert bag(read_table(spark, ref)) == Counter({(1, "a"): 2, (2, "b"): 2})
    spark.sql("DROP TABLE IF EXISTS auditmart_catalog_test")


def test_dimension_keys_are_unique(spark):
    for sf in SF.values():
        assert duplicate_keys(programs(spark, sf), ["program_id"]).count() == 0
        assert duplicate_keys(states(spark, sf), ["application_id"]).count() == 0


def test_apply_cluster_conf_sets_sql_keys_and_returns_static_ones(spark):
    from auditmart.session import CLUSTER_CONF, apply_cluster_conf

    keys = [k for k in CLUSTER_CONF if k.startswith("spark.sql.")]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        static = apply_cluster_conf(spark, {"spark.sql.shuffle.partitions": "8"})
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        assert "spark.cleaner.referenceTracking.cleanCheckpoints" in static
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_read_clustered_is_the_table_laid_out_by_the_compound_key(spark):
    from auditmart.sources import read_clustered

    path = f"{SF['0.01']}/orders.parquet"
    c = read_clustered(spark, path, "o_custkey", ["o_custkey", "o_orderdate"], num_partitions=5)
    assert bag(c) == bag(read_table(spark, path))
    assert c.rdd.getNumPartitions() == 5


def test_conform_selects_casts_and_reports_missing_columns(spark):
    import pytest

    from auditmart import model as m

    df = spark.createDataFrame([(1, 2, 3)], "PROGRAM_ID int, calendar_season_id int, all_tier_quantity int")
    out = m.conform(df, m.SLOT_SCHEMA)
    assert out.columns == ["program_id", "calendar_season_id", "all_tier_quantity"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint"] * 3
    with pytest.raises(m.ContractError):
        m.conform(df.drop("all_tier_quantity"), m.SLOT_SCHEMA)


def test_stage_tables_copies_every_source_table(spark):
    from auditmart.sources.driver_tables import table_path
    from auditmart.sources.staging import stage_tables

    names = ["region", "nation", "supplier", "events", "documents"]
    sources = {n: table_path(SF["0.001"], n) for n in names}
    staged = stage_tables(spark, sources, scratch_path(spark, "test/staging_all"))
    for n in names:
        src, dst = read_table(spark, sources[n]), read_table(spark, staged[n])
        assert dst.count() == src.count() and dst.columns == src.columns
    longest = read_table(spark, staged["documents"]).selectExpr("max(length(text)) AS m").first()["m"]
    assert longest == read_table(spark, sources["documents"]).selectExpr("max(length(text)) AS m").first()["m"]
    cut = stage_tables(
        spark, {"documents": sources["documents"]}, scratch_path(spark, "test/staging_cut"), {"documents": {"text": 1000}}
    )
    assert read_table(spark, cut["documents"]).selectExpr("max(length(text)) AS m").first()["m"] == 1000


def test_streaming_staging_picks_up_only_new_files(spark, tmp_path):
    """Files land in a folder over time; each availableNow run stages only the
    files its checkpoint has not seen (exactly once per file)."""
    import shutil

    from auditmart.streaming import stage_new_files

    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(f"{SF['0.001']}/events.parquet", landing / "part-0.parquet")
    schema = read_table(spark, f"{SF['0.001']}/events.parquet").schema
    base = scratch_path(spark, "test/stream_landing")
    target, ckpt = f"{base}/table", f"{base}/_checkpoint"
    stage_new_files(spark, str(landing), schema, target, ckpt)
    n0 = read_table(spark, f"{SF['0.001']}/events.parquet").count()
    assert read_table(spark, target).count() == n0
    shutil.copy(f"{SF['0.01']}/events.parquet", landing / "part-1.parquet")
    stage_new_files(spark, str(landing), schema, target, ckpt)
    n1 = read_table(spark, f"{SF['0.01']}/events.parquet").count()
    assert read_table(spark, target).count() == n0 + n1
    stage_new_files(spark, str(landing), schema, target, ckpt, max_files_per_trigger=1)
    assert read_table(spark, target).count() == n0 + n1


def test_continuous_staging_stream_can_be_drained_and_stopped(spark, tmp_path):
    import shutil

    from auditmart.streaming import start_staging_stream

    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(f"{SF['0.001']}/events.parquet", landing / "part-0.parquet")
    schema = read_table(spark, f"{SF['0.001']}/events.parquet").schema
    base = scratch_path(spark, "test/stream_continuous")
    query = start_staging_stream(spark, str(landing), schema, f"{base}/table", f"{base}/_checkpoint", available_now=False)
    try:
        query.processAllAvailable()
        assert read_table(spark, f"{base}/table").count() == read_table(spark, f"{SF['0.001']}/events.parquet").count()
    finally:
        query.stop()
    assert not query.isActive
