"""Merge, versioned tables, dated snapshots, publishing and the layer jobs."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st

from auric import jobs, specs
from auric.operators.merge import merge_upsert
from auric.operators.snapshot import append_snapshot, has_snapshot
from auric.sources.lake import LakeTable, ShrinkRefused, list_tables

T = dt.datetime
SCHEMA = "Id string, SystemModstamp timestamp, v string"


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_merge_cases(spark):
    target = spark.createDataFrame([("a", T(2024, 1, 1), "old"), ("b", T(2024, 1, 1), "keep")],
                                   SCHEMA)
    batch = spark.createDataFrame([("a", T(2024, 1, 2), "new"), ("c", T(2024, 1, 2), "add"),
                                   ("c", T(2024, 1, 1), "older-dup")], SCHEMA)
    out = merge_upsert(target, batch, "Id", "SystemModstamp")
    assert as_set(out.select("Id", "v")) == {("a", "new"), ("b", "keep"), ("c", "add")}
    # empty batch leaves the table as it is
    assert as_set(merge_upsert(target, batch.limit(0), "Id", "SystemModstamp")) == \
        as_set(target)
    # a new column in the batch is NULL for untouched rows
    wider = batch.withColumn("extra", batch.v)
    out = merge_upsert(target, wider, "Id", "SystemModstamp")
    assert {r.Id: r.extra for r in out.collect()}["b"] is None
    # an older re-delivery does not roll back with keep_newer
    stale = spark.createDataFrame([("a", T(2023, 1, 1), "stale")], SCHEMA)
    out = merge_upsert(target, stale, "Id", "SystemModstamp", keep_newer=True)
    assert {r.Id: r.v for r in out.collect()}["a"] == "old"
    out = merge_upsert(target, stale, "Id", "SystemModstamp")
    assert {r.Id: r.v for r in out.collect()}["a"] == "stale"


rows_st = st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 5),
                             st.sampled_from(["x", "y"])), max_size=8)


@settings(max_examples=8, deadline=None)
@given(base=rows_st, batch=rows_st)
def test_merge_idempotent(spark, base, batch):
    def df(rows):
        return spark.createDataFrame([(k, T(2024, 1, 1 + c), v) for k, c, v in rows], SCHEMA)
    t = merge_upsert(None, df(base), "Id", "SystemModstamp", ["v"])
    once = merge_upsert(t, df(batch), "Id", "SystemModstamp", ["v"])
    twice = merge_upsert(once, df(batch), "Id", "SystemModstamp", ["v"])
    assert as_set(once) == as_set(twice)
    assert once.count() == once.select("Id").distinct().count()


def test_lake_table_versions(spark, tmp_root):
    t = LakeTable.at(spark, tmp_root, "silver", "thing")
    assert not t.exists()
    v1 = t.commit(spark.createDataFrame([(1,), (2,)], "k int"), "build")
    v2 = t.commit(spark.createDataFrame([(3,)], "k int"), "build")
    assert (v1, v2) == (1, 2)
    assert [r.k for r in t.read().collect()] == [3]
    assert sorted(r.k for r in t.read(version=1).collect()) == [1, 2]
    h = t.history().collect()
    assert [r.snapshot_id for r in h] == [2, 1] and h[0].rows == 1
    assert [r.table_name for r in list_tables(spark, tmp_root, "silver").collect()] == ["thing"]


def test_replace_guards(spark, tmp_root):
    t = LakeTable.at(spark, tmp_root, "bronze", "x__live_ids")
    t.replace(spark.range(100).selectExpr("cast(id as string) as Id"))
    with pytest.raises(ShrinkRefused):
        t.replace(spark.range(10).selectExpr("cast(id as string) as Id"), max_shrink=0.5)
    with pytest.raises(ShrinkRefused):
        t.replace(spark.range(90).selectExpr("cast(id as string) as Id"), expected_rows=95)
    t.replace(spark.range(90).selectExpr("cast(id as string) as Id"), expected_rows=90)
    assert t.read().count() == 90


def test_snapshot_append_idempotent(spark, tmp_root):
    path = f"{tmp_root}/gold/m"
    def batch(d, n):
        return spark.createDataFrame([(n, dt.date.fromisoformat(d))], "n int, snapshot_date date")
    assert append_snapshot(spark, batch("2025-01-01", 1), path, "2025-01-01")
    assert not append_snapshot(spark, batch("2025-01-01", 2), path, "2025-01-01")
    assert append_snapshot(spark, batch("2025-01-02", 3), path, "2025-01-02")
    got = sorted((r.n, r.snapshot_date.isoformat()) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2025-01-01"), (3, "2025-01-02")]
    # replace rewrites only that date
    assert append_snapshot(spark, batch("2025-01-01", 9), path, "2025-01-01", replace=True)
    got = sorted((r.n, r.snapshot_date.isoformat()) for r in spark.read.parquet(path).collect())
    assert got == [(3, "2025-01-02"), (9, "2025-01-01")]
    # an empty batch still marks its date
    assert append_snapshot(spark, batch("2025-01-03", 0).limit(0), path, "2025-01-03")
    assert has_snapshot(spark, path, "2025-01-03")
    with pytest.raises(ValueError):
        append_snapshot(spark, batch("2025-01-04", 0), path, None)


def _land(spark, events, root, table, cut):
    """Land the change log: CSV text up to ``cut`` (backfill), JSON after."""
    from pyspark.sql import functions as F
    txt = [F.col(c).cast("string").alias(c) for c in ("Id", "Name", "IsDeleted")]
    iso = F.date_format("SystemModstamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    (events.where(F.col("SystemModstamp") <= cut)
     .select(*txt, iso.alias("SystemModstamp"))
     .write.option("header", True).csv(f"{root}/{table}/csv"))
    ms = F.unix_millis(F.col("SystemModstamp"))
    (events.where(F.col("SystemModstamp") > cut - dt.timedelta(minutes=1))
     .select(F.struct(F.lit("T").alias("type")).alias("attributes"), "Id", "Name",
             F.col("IsDeleted").cast("boolean").alias("IsDeleted"),
             ms.alias("SystemModstamp"))
     .write.json(f"{root}/{table}/json"))


def test_pipeline_end_to_end(spark, tmp_root):
    """land -> bronze (backfill, then incremental) -> silver -> publish, twice."""
    from auric.operators.dedupe import latest_by_key, soft_delete_filter
    from pyspark.sql import functions as F
    ev = (spark.read.parquet("/root/testdata/sf0.001/events.parquet")
          .select(F.col("user_id").cast("string").alias("Id"),
                  F.col("event_type").alias("Name"),
                  F.when(F.col("event_type") == "error", "true").otherwise("false")
                  .alias("IsDeleted"),
                  F.col("ts").cast("timestamp").alias("SystemModstamp")))
    spec = specs.EntitySpec(table="thing", model="thing", pk="Id", cursor="SystemModstamp",
                            columns=("Id", "Name"), live_ids_table="thing__live_ids")
    lake, landing = f"{tmp_root}/lake", f"{tmp_root}/landing"
    _land(spark, ev, landing, "thing", T(2024, 1, 15))
    jobs.ingest(spark, lake, landing, [spec])                  # backfill
    jobs.ingest(spark, lake, landing, [spec])                  # incremental
    bronze = LakeTable.at(spark, lake, "bronze", "thing").latest("Id", "SystemModstamp")
    want = latest_by_key(ev, "Id", "SystemModstamp", ["Name"])
    assert bronze.count() == want.count() == ev.select("Id").distinct().count()
    def ms(t):  # the JSON path delivers epoch milliseconds
        return t.replace(microsecond=t.microsecond // 1000 * 1000)
    got = {r.Id: r.SystemModstamp for r in bronze.collect()}
    assert {k: ms(v) for k, v in got.items()} == \
        {r.Id: ms(r.SystemModstamp) for r in want.collect()}
    assert LakeTable.at(spark, lake, "bronze", "thing").last_cursor() == max(got.values())
    # bronze keeps text flags from both paths; silver drops deleted rows
    live_keys = {r.Id for r in soft_delete_filter(want).collect()}
    jobs.build_silver(spark, lake, [spec])
    silver = LakeTable.at(spark, lake, "silver", "thing").read()
    assert silver.columns == ["Id", "Name"]
    assert {r.Id for r in silver.collect()} == live_keys
    # hard deletes: only the first ten keys are still live at the source
    export = ev.where(F.col("Id").cast("int") < 10)
    jobs.reconcile_ids(spark, lake, [spec], {"thing": export})
    dest = f"{tmp_root}/published"
    jobs.build_silver(spark, lake, [spec], publish_to=dest)
    silver = LakeTable.at(spark, lake, "silver", "thing").read()
    assert {r.Id for r in silver.collect()} == {k for k in live_keys if int(k) < 10}
    assert spark.read.parquet(f"{dest}/silver/thing").count() == silver.count()


def test_build_gold_job(spark, tmp_root):
    from auric.plans.roles import role
    sf = "/root/testdata/sf0.001"
    lake = f"{tmp_root}/lake"
    for name in ("account", "country_data", "certificate_c", "recordtype",
                 "non_certificate_holder"):
        LakeTable.at(spark, lake, "silver", name).commit(role(spark, sf, name), "build")
    LakeTable.at(spark, lake, "gold", "regions").commit(role(spark, sf, "regions"), "seed")
    first = jobs.build_gold(spark, lake, snapshot_date="2026-12-01", as_of="2027-01-01")
    assert set(first) == set(jobs.GOLD_TABLES) and all(first.values())
    again = jobs.build_gold(spark, lake, snapshot_date="2026-12-01", as_of="2027-01-01")
    assert not any(again.values())
    n = spark.read.parquet(f"{lake}/gold/coc_per_country").count()
    jobs.build_gold(spark, lake, snapshot_date="2026-12-02", as_of="2027-01-01",
                    select=["coc_per_country"])
    assert spark.read.parquet(f"{lake}/gold/coc_per_country").count() == 2 * n
    dest = f"{tmp_root}/pub"
    published = jobs.publish(spark, lake, "gold", dest)
    assert "regions" in published and "members" in published


def test_stream_ingest_resumes(spark, tmp_root):
    """Two available-now runs over a growing landing folder: the second run
    merges only the new file, including a late row with an older cursor."""
    from pyspark.sql.types import StringType, StructField, StructType
    from auric.streaming import stream_ingest
    schema = StructType([StructField(c, StringType()) for c in ("Id", "v", "ts")])
    landing, ckpt = f"{tmp_root}/landing", f"{tmp_root}/ckpt"
    table = LakeTable(spark, f"{tmp_root}/bronze/t")
    spark.createDataFrame([("a", "1", 1700000000000), ("b", "1", 1700000000000)],
                          "Id string, v string, ts long").write.json(f"{landing}/f1")
    stream_ingest(spark, f"{landing}/*", schema, table, "ts", ckpt)
    spark.createDataFrame([("a", "2", 1700000005000), ("c", "late", 1600000000000),
                           ("b", "older", 1600000000000)],
                          "Id string, v string, ts long").write.json(f"{landing}/f2")
    assert stream_ingest(spark, f"{landing}/*", schema, table, "ts", ckpt) == 1
    assert {(r.Id, r.v) for r in table.latest("Id", "ts").collect()} == {("a", "2"), ("b", "1"),
                                                             ("c", "late")}


def test_change_log_appends_small_and_compacts(spark, tmp_root):
    t = LakeTable(spark, f"{tmp_root}/log")
    base = [(str(k), T(2024, 1, 1), "v0") for k in range(50)]
    t.append(spark.createDataFrame(base, SCHEMA), "SystemModstamp")
    assert t.last_cursor() == T(2024, 1, 1)
    delta = [("7", T(2024, 1, 2), "v1"), ("new", T(2024, 1, 3), "n"), ("8", None, "no cursor"),
             ("9", T(2024, 1, 1), "same cursor, later load"), ("5", T(2023, 1, 1), "late")]
    t.append(spark.createDataFrame(delta, SCHEMA), "SystemModstamp")
    assert t.last_cursor() == T(2024, 1, 3) and t.parts() == [1, 2]
    assert spark.read.parquet(t.version_path(2)).count() == len(delta)   # nothing rewritten
    want = {**{str(k): "v0" for k in range(50)}, "7": "v1", "new": "n",
            "9": "same cursor, later load"}
    latest = lambda: {r.Id: r.v for r in t.latest("Id", "SystemModstamp").collect()}
    assert latest() == want
    # a column only the new load has
    wider = spark.createDataFrame([("w", T(2024, 1, 4), "x", 1)], SCHEMA + ", more int")
    t.append(wider, "SystemModstamp")
    want["w"] = "x"
    assert latest() == want and "more" in t.read().columns
    assert t.compact("Id", "SystemModstamp") == 4 and t.parts() == [4]
    assert latest() == want and t.last_cursor() == T(2024, 1, 4)
    assert t.read(version=2).count() == 50 + len(delta)                  # time travel
    assert [r.operation for r in t.history().collect()][0] == "compact"
    # a load without rows keeps the watermark
    t.append(wider.limit(0), "SystemModstamp")
    assert t.last_cursor() == T(2024, 1, 4) and latest() == want
    with pytest.raises(FileNotFoundError):
        t.read(version=99)


def test_merge_keeps_the_greater_watermark(spark, tmp_root):
    t = LakeTable(spark, f"{tmp_root}/merged")
    t.merge(spark.createDataFrame([("a", T(2024, 1, 5), "1")], SCHEMA), "Id", "SystemModstamp")
    t.merge(spark.createDataFrame([("b", T(2024, 1, 2), "2"), ("b", T(2024, 1, 1), "0")], SCHEMA),
            "Id", "SystemModstamp")
    assert t.last_cursor() == T(2024, 1, 5)
    assert {(r.Id, r.v) for r in t.read().collect()} == {("a", "1"), ("b", "2")}


def test_ingest_compacts_and_takes_entities(spark, tmp_root):
    lake, landing = f"{tmp_root}/lake", f"{tmp_root}/landing"
    spec = [specs.EntitySpec("a", "Id", "ts"), specs.EntitySpec("b", "Id", "ts")]
    rows = spark.createDataFrame([("x", "2024-01-01T00:00:00Z")], "Id string, ts string")
    rows.write.option("header", True).csv(f"{landing}/a/csv")
    spark.createDataFrame([("x", 1704153600000), ("y", 1704153600000)], "Id string, ts long"
                          ).write.json(f"{landing}/a/json")
    for _ in range(4):
        jobs.ingest(spark, lake, landing, spec, entities=["A"], compact_every=2)
    t = LakeTable.at(spark, lake, "bronze", "a")
    assert len(t.parts()) <= 2
    assert sorted(r.Id for r in t.latest("Id", "ts").collect()) == ["x", "y"]
    with pytest.raises(FileNotFoundError, match="b"):
        jobs.build_silver(spark, lake, spec)
    assert set(jobs.build_silver(spark, lake, spec, select=["a"])) == {"a"}


def test_seed_since_days_bounds_the_first_run(spark, tmp_root):
    now = dt.datetime.now(dt.timezone.utc)
    rows = [(k, (now - dt.timedelta(days=k)).strftime("%Y-%m-%dT%H:%M:%SZ")) for k in (1, 3, 9)]
    landing = f"{tmp_root}/landing"
    spark.createDataFrame(rows, "Id int, ts string").write.option("header", True).csv(
        f"{landing}/a/csv")
    spec = [specs.EntitySpec("a", "Id", "ts")]
    jobs.ingest(spark, f"{tmp_root}/lake", landing, spec, seed_since_days=5)
    got = LakeTable.at(spark, f"{tmp_root}/lake", "bronze", "a").read()
    assert sorted(r.Id for r in got.collect()) == ["1", "3"]


def test_paged_source_through_the_jobs(spark, tmp_root):
    """Pages to bronze (types kept, no overlap), live keys from pages, silver without
    annotations."""
    lake, landing = f"{tmp_root}/lake", f"{tmp_root}/landing"
    spec = specs.EntitySpec.odata("accounts", "accountid")
    spec = specs.EntitySpec(**{**spec.__dict__, "drop_matching": "@"})

    def page(name, records):
        import json
        text = json.dumps({"value": records, "@odata.nextLink": "next"})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(
            f"{landing}/accounts/{name}")

    one = {"accountid": "a", "n": 1, "n@x.FormattedValue": "one",
           "modifiedon": "2024-01-01T00:00:00Z"}
    page("pages", [one, {**one, "accountid": "b", "modifiedon": None}])
    jobs.ingest(spark, lake, landing, [spec])
    page("pages", [{**one, "n": 2, "modifiedon": "2024-01-02T00:00:00Z"}])
    jobs.ingest(spark, lake, landing, [spec])
    page("ids", [{"accountid": "a"}])
    assert jobs.reconcile_ids(spark, lake, [spec], landing_root=landing,
                              entities=["accounts"]) == {"accounts": 1}
    jobs.build_silver(spark, lake, [spec])
    silver = LakeTable.at(spark, lake, "silver", "accounts").read()
    assert silver.columns == ["accountid", "modifiedon", "n"] and silver.schema["n"].dataType \
        .simpleString() == "bigint"
    assert [(r.accountid, r.n) for r in silver.collect()] == [("a", 2)]


def test_second_run_with_changed_and_deleted_rows(spark, tmp_root):
    """A delete hides the row it deletes, a live row stays, flags as CSV and JSON write them."""
    lake, landing = f"{tmp_root}/lake", f"{tmp_root}/landing"
    spec = [specs.EntitySpec("t", "Id", "ts", columns=("Id", "v"), live_ids_table="t__live_ids")]
    spark.createDataFrame([("a", "1", "false", "2024-01-01T00:00:00Z"),
                           ("b", "1", "True", "2024-01-01T00:00:00Z"),
                           ("c", "1", "false", "2024-01-01T00:00:00Z"),
                           ("d", "1", None, "2024-01-01T00:00:00Z")],
                          "Id string, v string, IsDeleted string, ts string"
                          ).write.option("header", True).csv(f"{landing}/t/csv")
    jobs.ingest(spark, lake, landing, spec)
    spark.createDataFrame([("a", 2, False, 1704153600000), ("c", 2, True, 1704153600000)],
                          "Id string, v int, IsDeleted boolean, ts long"
                          ).write.json(f"{landing}/t/json")
    jobs.ingest(spark, lake, landing, spec)
    jobs.build_silver(spark, lake, spec)
    read = lambda: {tuple(r) for r in LakeTable.at(spark, lake, "silver", "t").read().collect()}
    assert read() == {("a", "2"), ("d", "1")}
    jobs.reconcile_ids(spark, lake, spec, {"t": spark.createDataFrame([("a",)], "Id string")},
                       expected_rows={"t": 1})
    jobs.build_silver(spark, lake, spec)
    assert read() == {("a", "2")}


def test_snapshot_of_another_date_is_refused(spark, tmp_root):
    day = spark.createDataFrame([(1, dt.date(2025, 1, 1)), (2, None)], "n int, snapshot_date date")
    with pytest.raises(Exception, match="another date"):
        append_snapshot(spark, day, f"{tmp_root}/m", "2025-01-01")
    assert not has_snapshot(spark, f"{tmp_root}/m", "2025-01-01")


def test_unlogged_partition_is_written_anew(spark, tmp_root):
    path = f"{tmp_root}/m"
    rows = [(k, dt.date(2025, 1, 1)) for k in range(10)]
    day = spark.createDataFrame(rows, "n int, snapshot_date date")
    day.limit(1).write.partitionBy("snapshot_date").parquet(path)    # a failed attempt
    assert not has_snapshot(spark, path, "2025-01-01")
    assert append_snapshot(spark, day, path, "2025-01-01")
    assert LakeTable(spark, path).read().count() == 10
    other = day.limit(0)
    other.sparkSession.createDataFrame([(1, dt.date(2025, 1, 2))], day.schema).write.mode(
        "append").partitionBy("snapshot_date").parquet(path)
    assert LakeTable(spark, path).read().count() == 10               # not listed, not read
    assert append_snapshot(spark, other, path, "2025-01-02")
    assert LakeTable(spark, path).read().count() == 10


def test_lost_version_and_missing_seed_are_errors(spark, tmp_root):
    from auric.session import remove_path
    t = LakeTable.at(spark, tmp_root, "silver", "gone")
    remove_path(spark, t.version_path(t.commit(spark.range(1), "build")))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.publish(spark, tmp_root, "silver", f"{tmp_root}/pub")
    with pytest.raises(FileNotFoundError, match="seed"):
        jobs.gold_frames({}, None, select=["members"])


def test_checkpoint_folder_is_required_off_local_masters():
    from auric.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context("spark://host:7077")

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_csv_is_bound_by_header_names(spark, tmp_root):
    from auric.sources.landed import landed_csv_scan
    path = f"{tmp_root}/csv"
    spark.createDataFrame([("V1", "id1", "x")], "v string, Id string, more string").coalesce(
        1).write.option("header", True).csv(path)
    assert landed_csv_scan(spark, path).columns == ["v", "Id", "more"]
    assert [tuple(r) for r in landed_csv_scan(spark, path, ["Id", "v"]).collect()] == [("id1", "V1")]
    with pytest.raises(Exception, match="nonesuch"):
        landed_csv_scan(spark, path, ["nonesuch"])
    # a second file with the columns the other way round must not shift values
    spark.createDataFrame([("id2", "V2", "y")], "Id string, v string, more string").coalesce(
        1).write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception):
        landed_csv_scan(spark, path, ["Id", "v", "more"]).collect()


def test_csv_line_breaks_need_multi_line(spark, tmp_root):
    from auric.sources.landed import landed_csv_scan
    path = f"{tmp_root}/csv"
    spark.createDataFrame([('Id,v\n1,"two\nlines"\n2,"say ""hi"""',)], "value string").coalesce(
        1).write.text(path)
    got = landed_csv_scan(spark, path, multi_line=True).collect()
    assert [tuple(r) for r in got] == [("1", "two\nlines"), ("2", 'say "hi"')]
    with pytest.raises(Exception):
        landed_csv_scan(spark, path).collect()


def test_cut_pages_and_broken_lines_fail(spark, tmp_root):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from auric.sources.landed import paged_json_explode
    from auric.streaming import stream_ingest
    text = lambda path, line: spark.createDataFrame([(line,)], "value string").write.text(path)
    record = StructType([StructField("k", LongType())])
    text(f"{tmp_root}/cut", '{"value": [{"k": 1}, {"k"')
    text(f"{tmp_root}/kind", '{"value": [{"k": "x"}]}')
    for name in ("cut", "kind"):
        with pytest.raises(Exception):
            paged_json_explode(spark, f"{tmp_root}/{name}", record).collect()
    text(f"{tmp_root}/stream/f", '{"Id": "a", ')
    schema = StructType([StructField(c, StringType()) for c in ("Id", "ts")])
    with pytest.raises(Exception):
        stream_ingest(spark, f"{tmp_root}/stream/*", schema, LakeTable(spark, f"{tmp_root}/t"),
                      "ts", f"{tmp_root}/ckpt")


def test_delta_cut_allows_for_the_lag(spark, tmp_root):
    from auric.sources.landed import delta_from_json
    path = f"{tmp_root}/json"
    (spark.createDataFrame([("late", 1704067200000, "2024-01-06")],
                           "Id string, ts long, ingest_date string")
     .write.partitionBy("ingest_date").json(path))
    week = 7 * 86400
    out = delta_from_json(spark, path, "ts", since=T(2024, 1, 10), lag_seconds=week)
    assert [r.Id for r in out.collect()] == ["late"]


def test_delta_partition_pruning(spark, tmp_root):
    """A landing partitioned by ingest_date is pruned to days near the
    watermark; the partition column does not leak into the records."""
    from auric.sources.landed import delta_from_json
    path = f"{tmp_root}/json"
    rows = [("a", 1700000000000, "2023-11-10"), ("b", 1704067200000, "2024-01-01"),
            ("c", 1704153600000, "2024-01-02")]
    (spark.createDataFrame(rows, "Id string, ts long, ingest_date string")
     .write.partitionBy("ingest_date").json(path))
    out = delta_from_json(spark, path, "ts", since=T(2024, 1, 1, 12))
    assert out.columns == ["Id", "ts"]
    assert sorted(r.Id for r in out.collect()) == ["b", "c"]
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_skip_existing_snapshot_rows(spark):
    from auric.operators.snapshot import latest_snapshot, skip_existing_snapshot
    stored = spark.createDataFrame([(1, dt.date(2025, 1, 1)), (2, dt.date(2025, 1, 2))],
                                   "n int, snapshot_date date")
    batch = spark.createDataFrame([(3, dt.date(2025, 1, 2)), (4, dt.date(2025, 1, 3))],
                                  "n int, snapshot_date date")
    assert [r.n for r in skip_existing_snapshot(batch, stored).collect()] == [4]
    assert skip_existing_snapshot(batch, None).count() == 2
    # a NULL stored date does not block other dates (unlike NOT IN)
    with_null = stored.union(spark.createDataFrame([(9, None)], "n int, snapshot_date date"))
    assert [r.n for r in skip_existing_snapshot(batch, with_null).collect()] == [4]
    assert [r.n for r in latest_snapshot(stored).collect()] == [2]


def test_list_tables_hides_staging_and_publish_keeps_dates(spark, tmp_root):
    from auric.operators.snapshot import append_snapshot
    lake = f"{tmp_root}/lake"
    LakeTable.at(spark, lake, "silver", "a").commit(spark.range(3), "build")
    LakeTable.at(spark, lake, "silver", "b_staging").commit(spark.range(1), "build")
    assert [r.table_name for r in list_tables(spark, lake, "silver").collect()] == ["a"]
    day = spark.createDataFrame([(1, dt.date(2025, 1, 1))], "n int, snapshot_date date")
    append_snapshot(spark, day, f"{lake}/gold/m", "2025-01-01")
    dest = f"{tmp_root}/pub"
    assert jobs.publish(spark, lake, "gold", dest) == ["m"]
    got = spark.read.parquet(f"{dest}/gold/m").collect()
    assert [(r.n, r.snapshot_date) for r in got] == [(1, dt.date(2025, 1, 1))]


def test_publish_skips_table_with_only_empty_snapshots(spark, tmp_root):
    from auric.operators.snapshot import append_snapshot
    lake = f"{tmp_root}/lake"
    empty = spark.createDataFrame([], "n int, snapshot_date date")
    append_snapshot(spark, empty, f"{lake}/gold/e", "2025-01-01")
    assert jobs.publish(spark, lake, "gold", f"{tmp_root}/pub") == []


def _land_json(spark, path, rows, schema="Id string, v string, SystemModstamp string"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


def _bronze(spark, root, spec):
    from auric.sources.lake import LakeTable
    return LakeTable.at(spark, f"{root}/lake", "bronze", spec.table)


def test_each_landed_file_is_loaded_once(spark, tmp_root):
    """A third run reads the one new file of a folder that is not partitioned."""
    from auric import jobs
    from auric.specs import EntitySpec
    from auric.sources.landed import LandingLedger
    spec = EntitySpec("t", "Id", "SystemModstamp")
    folder = f"{tmp_root}/landing/t/json"
    ledger = LandingLedger(spark, f"{tmp_root}/lake/bronze/t/_files")
    for k in range(3):
        _land_json(spark, folder, [(f"a{k}", "x", f"2026-01-0{k + 1}T00:00:00Z"),
                              ("same", f"v{k}", f"2026-01-0{k + 1}T01:00:00Z")])
        assert len(ledger.new_files(folder)) == 1
        jobs.ingest(spark, f"{tmp_root}/lake", f"{tmp_root}/landing", [spec])
        assert ledger.new_files(folder) == [] and ledger.loaded().count() == k + 1
    table = _bronze(spark, tmp_root, spec)
    assert len(table.parts()) == 3 and table.read().count() == 6
    before = table.current_version()
    jobs.ingest(spark, f"{tmp_root}/lake", f"{tmp_root}/landing", [spec])
    assert table.current_version() == before          # nothing new: nothing written


def test_replaced_file_is_loaded_again(spark, tmp_root):
    from auric.sources.landed import LandingLedger
    ledger = LandingLedger(spark, f"{tmp_root}/_files")
    _land_json(spark, f"{tmp_root}/in", [("a", "x", None)])
    files = ledger.new_files(f"{tmp_root}/in")
    ledger.add("json", files, 1)
    assert ledger.new_files(f"{tmp_root}/in") == [] and ledger.has_rows("json")
    spark.createDataFrame([("b", "longer text", None)], "Id string, v string, c string").coalesce(
        1).write.mode("overwrite").json(f"{tmp_root}/in")
    assert len(ledger.new_files(f"{tmp_root}/in")) == 1
    assert ledger.new_files(f"{tmp_root}/nowhere") == []


def test_rows_sent_again_are_loaded_once(spark, tmp_root):
    """Deltas repeat rows without a readable cursor and rows of the overlap; columns come
    and go. Only what is new in content is appended, also after a compaction."""
    from auric import jobs
    from auric.specs import EntitySpec
    spec = EntitySpec("t", "Id", "SystemModstamp")
    folder, lake, landing = f"{tmp_root}/landing/t/json", f"{tmp_root}/lake", f"{tmp_root}/landing"
    again = [("n", "old", None), ("bad", "x", "no date"), ("o", "y", "2026-01-01T00:00:00Z")]
    _land_json(spark, folder, again)
    jobs.ingest(spark, lake, landing, [spec])
    table = _bronze(spark, tmp_root, spec)
    assert table.read().count() == 3
    _land_json(spark, folder, [("n", "new", None), *again])
    jobs.ingest(spark, lake, landing, [spec], compact_every=1)      # folds the log
    assert table.read().count() == 3
    _land_json(spark, folder, [(*r, None) for r in again],
          "Id string, v string, SystemModstamp string, extra string")
    jobs.ingest(spark, lake, landing, [spec])
    rows = {r["Id"]: r["v"] for r in table.latest("Id", "SystemModstamp").collect()}
    assert rows == {"n": "new", "bad": "x", "o": "y"}
    assert table.read().count() == 3


def test_load_that_failed_before_its_ledger_entry_is_repeated(spark, tmp_root, monkeypatch):
    from auric import jobs
    from auric.specs import EntitySpec
    from auric.sources.landed import LandingLedger
    spec = EntitySpec("t", "Id", "SystemModstamp")
    _land_json(spark, f"{tmp_root}/landing/t/json", [("a", "x", None), ("b", "y", "2026-01-01T00:00:00Z")])

    def lost(self, *args):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(LandingLedger, "add", lost)
        with pytest.raises(RuntimeError):
            jobs.ingest(spark, f"{tmp_root}/lake", f"{tmp_root}/landing", [spec])
    jobs.ingest(spark, f"{tmp_root}/lake", f"{tmp_root}/landing", [spec])
    assert _bronze(spark, tmp_root, spec).read().count() == 2


def test_append_is_one_job_of_the_write(spark, tmp_root):
    """Rows and watermark are observed by the write: the batch is computed once."""
    from pyspark.sql import functions as F
    from auric.sources.lake import LakeTable
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b
    batch = spark.range(10).select("id", F.timestamp_seconds("id").alias("at")).coalesce(1)
    table = LakeTable(spark, f"{tmp_root}/t")
    table.append(batch.mapInArrow(count, batch.schema), "at")
    assert calls.value == 10
    assert table.last()["rows"] == 10 and table.last_cursor().second == 9
    empty = batch.limit(0)
    table.append(empty, "at")
    assert table.last()["rows"] == 0 and table.last_cursor().second == 9


def test_publish_leaves_exactly_the_table(spark, tmp_root):
    """Stale dates and files go; a table without rows leaves nothing behind."""
    from auric.operators.snapshot import append_snapshot
    from auric.sources.lake import LakeTable
    dest = f"{tmp_root}/pub"
    for k, day in enumerate(("2025-01-01", "2025-01-02")):
        lake = f"{tmp_root}/lake{k}"
        rows = spark.createDataFrame([(k, dt.date.fromisoformat(day))], "n int, snapshot_date date")
        append_snapshot(spark, rows, f"{lake}/gold/m", day)
        append_snapshot(spark, rows.limit(1 - k), f"{lake}/gold/e", day)
        LakeTable.at(spark, lake, "silver", "s").commit(spark.range(10 - 9 * k), "build")
        assert jobs.publish(spark, lake, "gold", dest) == (["e", "m"] if k == 0 else ["m"])
        assert jobs.publish(spark, lake, "silver", dest) == ["s"]
    assert [(r.n, str(r.snapshot_date)) for r in spark.read.parquet(f"{dest}/gold/m").collect()] \
        == [(1, "2025-01-02")]
    assert spark.read.parquet(f"{dest}/silver/s").count() == 1
    from auric.sources.lake import _folders
    assert _folders(spark, f"{dest}/gold") == ["m"]      # nothing staged, nothing hidden


def test_failed_publish_leaves_the_old_copy(spark, tmp_root):
    from pyspark.sql import functions as F
    from auric.sources.lake import LakeTable, _folders
    lake, dest = f"{tmp_root}/lake", f"{tmp_root}/pub"
    table = LakeTable.at(spark, lake, "silver", "s")
    table.commit(spark.range(5), "build")
    jobs.publish(spark, lake, "silver", dest)

    class Broken(LakeTable):
        def read(self, version=None):
            return super().read(version).select(F.raise_error(F.lit("lost")).alias("id"))
    real = jobs.LakeTable
    jobs.LakeTable = Broken
    try:
        with pytest.raises(Exception, match="lost"):
            jobs.publish(spark, lake, "silver", dest)
    finally:
        jobs.LakeTable = real
    assert spark.read.parquet(f"{dest}/silver/s").count() == 5
    assert _folders(spark, f"{dest}/silver") == ["s"]


def test_layers_by_name(spark, tmp_root):
    """Views of a change log whose columns grew, of a dated table and of a plain one; a
    table that is gone loses its view, odd column names are kept."""
    from auric.operators.snapshot import append_snapshot
    from auric.sources.catalog import register_layers
    from auric.sources.lake import LakeTable
    from auric.session import remove_path
    from auric.specs import EntitySpec
    beside, lake = spark.newSession(), f"{tmp_root}/lake"
    log = LakeTable.at(spark, lake, "bronze", "t")
    log.append(spark.createDataFrame([("a", "1", 5), ("b", "1", 5)], "Id string, `x@y` string, at int"))
    log.append(spark.createDataFrame([("a", "2", 6, "m")],
                                     "Id string, `x@y` string, at int, more string"))
    LakeTable.at(spark, lake, "silver", "gone").commit(spark.range(2), "build")
    rows = spark.createDataFrame([(1, dt.date(2025, 1, 1))], "n int, snapshot_date date")
    append_snapshot(spark, rows, f"{lake}/gold/m", "2025-01-01")
    append_snapshot(spark, rows.limit(0), f"{lake}/gold/empty", "2025-01-01")
    assert register_layers(beside, lake, [EntitySpec("t", "Id", "at")]) == [
        "bronze.t", "silver.gone", "gold.m"]
    got = beside.sql("SELECT Id, `x@y` AS x, more FROM bronze.t ORDER BY Id").collect()
    assert [tuple(r) for r in got] == [("a", "2", "m"), ("b", "1", None)]
    assert beside.sql("SELECT sum(n) FROM gold.m").first()[0] == 1
    assert beside.sql("SELECT count(*) FROM silver.gone").first()[0] == 2
    remove_path(spark, f"{lake}/silver/gone")
    assert register_layers(beside, lake, [EntitySpec("t", "Id", "at")]) == ["bronze.t", "gold.m"]
    assert not beside.catalog.tableExists("silver.gone")


def test_latest_snapshot_opens_one_partition(spark, tmp_root):
    from auric.operators.snapshot import append_snapshot, read_latest_snapshot
    path = f"{tmp_root}/gold/m"
    for d in ("2025-01-01", "2025-01-03", "2025-01-02"):
        append_snapshot(spark, spark.createDataFrame(
            [(1, dt.date.fromisoformat(d))], "n int, snapshot_date date"), path, d)
    append_snapshot(spark, spark.createDataFrame([], "n int, snapshot_date date"), path, "2025-02-01")
    out = read_latest_snapshot(spark, path)
    assert [str(r.snapshot_date) for r in out.collect()] == ["2025-01-03"]
    assert "PartitionFilters: [isnotnull(snapshot_date" in out._jdf.queryExecution().toString()
    with pytest.raises(FileNotFoundError):
        read_latest_snapshot(spark, f"{tmp_root}/gold/none")


def test_variant_fields_that_change(spark, tmp_root):
    from auric.sources import landed
    lines = ['{"id":1,"v":1.50,"o":{"a":1},"l":[1,"x"],"it\'s x@y":3,"n":null}', "", "  ",
             '{"id":"two","v":"text","extra":12345678901234567890}', '{"id":3,"v":true}']
    spark.createDataFrame([(x,) for x in lines], "t string").coalesce(1).write.text(f"{tmp_root}/j")
    records = landed.landed_variant_scan(spark, f"{tmp_root}/j")
    fields = landed.variant_fields(records)
    assert set(fields) == {"id", "v", "o", "l", "it's x@y", "n", "extra"}
    assert len(fields["id"]) == 2 and len(fields["v"]) == 3
    rows = {r["id"]: r for r in landed.variant_columns(records, sorted(fields)).collect()}
    assert (rows["1"]["v"], rows["1"]["o"], rows["1"]["l"], rows["1"]["it's x@y"], rows["1"]["n"]) \
        == ("1.5", '{"a":1}', '[1,"x"]', "3", None)
    assert (rows["two"]["v"], rows["two"]["extra"], rows["3"]["v"], rows["3"]["o"]) == (
        "text", "12345678901234567890", "true", None)
    spark.createDataFrame([('{"cut":',)], "t string").write.text(f"{tmp_root}/bad")
    with pytest.raises(Exception, match="MALFORMED"):
        landed.landed_variant_scan(spark, f"{tmp_root}/bad").collect()


def test_load_above_the_stored_cursor_stores_no_digests(spark, tmp_root):
    """An export of one time and a later delta: the log is all that a table keeps; rows
    sent again are known from it, to the microsecond and after a compaction."""
    from auric.sources.lake import _folders
    spec = specs.EntitySpec("t", "Id", "SystemModstamp")
    lake, landing = f"{tmp_root}/lake", f"{tmp_root}/landing"
    folder, table = f"{landing}/t/json", LakeTable.at(spark, lake, "bronze", "t")
    first = [(f"a{k}", "x", "2026-01-01T00:00:00.123456Z") for k in range(20)] + [("n", "x", None)]
    _land_json(spark, folder, first)
    jobs.ingest(spark, lake, landing, [spec])
    _land_json(spark, folder, [("a1", "y", "2026-01-02T00:00:00.000789Z")])
    jobs.ingest(spark, lake, landing, [spec])
    assert table.read().count() == 22 and "_seen" not in _folders(spark, table.path)
    again = [("a1", "y", "2026-01-02T00:00:00.000789Z"), ("n", "x", None),
             ("new", "z", "2026-01-02T00:00:00.000790Z"), ("n", "other", None)]
    _land_json(spark, folder, [again[0], again[1]])
    jobs.ingest(spark, lake, landing, [spec], compact_every=2)       # brings nothing, folds
    assert table.last()["operation"] == "compact" and table.last()["rows"] == 21
    _land_json(spark, folder, [("b", "w", "2026-01-03T00:00:00Z"), *again[:2], again[3]])
    jobs.ingest(spark, lake, landing, [spec], lag_seconds=200_000)
    assert table.last()["rows"] == 2                                 # b and the other n
    assert [f for f in _folders(spark, table.path) if "staged" in f or ".old" in f] == []


def test_silver_in_slices_is_the_whole(spark, tmp_root):
    """A log over ``slice_rows`` is ranked slice by slice: the same rows, each key once."""
    lake = f"{tmp_root}/lake"
    spec = specs.EntitySpec("t", "Id", "SystemModstamp", live_ids_table="t__live_ids")
    schema = "Id bigint, SystemModstamp timestamp, v string, IsDeleted string"
    log = LakeTable.at(spark, lake, "bronze", "t")
    log.append(spark.createDataFrame(
        [(k % 40 if k % 7 else None, T(2024, 1, 1 + k % 3), f"v{k}", None) for k in range(90)],
        schema), "SystemModstamp")
    log.append(spark.createDataFrame(
        [(k, T(2024, 1, 9), "late", "true" if k % 2 else "false") for k in range(0, 30, 3)],
        schema), "SystemModstamp")
    for ids, kind in (([f"0{k}" for k in range(35)], "string"), (list(range(35)), "bigint")):
        LakeTable.at(spark, lake, "bronze", "t__live_ids").replace(
            spark.createDataFrame([(i,) for i in ids], f"Id {kind}"))
        built = []
        for rows in (10**9, 20, 1):
            jobs.build_silver(spark, lake, [spec], slice_rows=rows, max_slices=5)
            silver = LakeTable.at(spark, lake, "silver", spec.model)
            built.append(sorted(map(tuple, silver.read().collect()), key=str))
            assert silver.last()["rows"] == len(built[-1])
        assert built[0] and built[0] == built[1] == built[2]


def test_shuffle_files_go_with_the_job(spark, tmp_root):
    import time
    from pathlib import Path

    from pyspark.sql import functions as F

    from auric.session import short_lived_shuffles
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    here = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager(
        ).diskBlockManager().localDirs()
    files = lambda: {f for d in here for f in Path(str(d)).rglob("shuffle_*.data")}
    old = files()
    with pytest.raises(ZeroDivisionError), short_lived_shuffles(spark):
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(
            f"{tmp_root}/counts")
        assert spark.conf.get(key) == "true"
        until = time.monotonic() + 30                # they go in the background
        while files() - old and time.monotonic() < until:
            time.sleep(0.1)
        assert not files() - old
        raise ZeroDivisionError
    assert spark.conf.get(key) == before


def test_landed_history_is_compressed_and_not_kept(spark, tmp_root, monkeypatch):
    from auric.plans import registry_lake
    from auric.sources.landed import LandingLedger
    sf = "/root/testdata/sf0.001"
    files = LandingLedger(spark, f"{tmp_root}/_files")
    registry_lake._land_history(spark, sf, f"{tmp_root}/landing")
    names = [f["path"] for f in files.new_files(f"{tmp_root}/landing/account")]
    parts = [n for n in names if "/part-" in n]
    assert parts and all(n.endswith((".csv.gz", ".json.gz")) for n in parts)
    monkeypatch.setattr(registry_lake, "scratch_path", lambda spark, name: f"{tmp_root}/run/{name}")
    registry_lake.q_medallion_end_to_end(spark, sf)
    for table in registry_lake._E2E_ROLES.values():
        for kind in ("csv", "json", "ids"):
            assert files.new_files(f"{tmp_root}/run/medallion/landing/{table}/{kind}") == []
