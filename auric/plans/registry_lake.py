"""Registered queries for storage, ingest, scans and utilities (see
``auric.plans.registry`` for the contract)."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from auric import jobs, specs
from auric.functions.casts import safe_date, safe_double
from auric.functions.normalize import normalize_record, parse_cursor
from auric.operators.dedupe import latest_by_key, silver_dedupe
from auric.operators.incremental import incremental_since, max_cursor
from auric.operators.merge import merge_upsert
from auric.operators.snapshot import append_snapshot, latest_snapshot, read_latest_snapshot
from auric.plans import gold
from auric.plans.registry import _ASOF, ORACLE, register, sql_list
from auric.plans.roles import (AS_OF, SNAPSHOT_DATE, TEST_TABLES, read_table, role, role_cte,
                               table_path)
from auric.session import remove_path, scratch_path, short_lived_shuffles
from auric.sources.bucketed import write_bucketed
from auric.sources.catalog import (adhoc_sql, describe_columns, footer_row_counts,
                                   register_layers)
from auric.sources.landed import (landed_csv_scan, landed_json_scan, live_ids_snapshot,
                                  load_seed, paged_json_explode, select_queryable_columns)
from auric.sources.lake import LakeTable, list_tables

# --------------------------------------------------------------------------
# Merge by key
# --------------------------------------------------------------------------

_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
_MERGE_SQL = """
WITH target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS modstamp
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' OR o_orderdate IS NULL
), batch AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice,
         o_orderdate + INTERVAL '1' DAY AS modstamp
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01'
)
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL SELECT * FROM batch"""


def _merge_inputs(spark, sf):
    o = read_table(spark, sf, "orders")
    d = F.col("o_orderdate")
    target = (o.where((d < F.lit("1999-01-01").cast("timestamp_ntz")) | d.isNull())
              .select(*_ORDER_COLS, d.alias("modstamp")))
    batch = (o.where(d >= F.lit("1998-07-01").cast("timestamp_ntz"))
             .select("o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"),
                     "o_totalprice", (d + F.expr("INTERVAL '1' DAY")).alias("modstamp")))
    return target, batch


@register("merge_upsert", _MERGE_SQL)
def q_merge_upsert(spark, sf):
    """Upsert with the ranked batch stored once: join and union both read that."""
    target, batch = _merge_inputs(spark, sf)
    ranked = jobs.materialize(latest_by_key(batch, "o_orderkey", "modstamp"), "merge-batch")
    return merge_upsert(target, ranked, "o_orderkey", cursor="modstamp", ranked=True)


def _orders_log(spark, sf) -> LakeTable:
    target, batch = _merge_inputs(spark, sf)
    t = LakeTable(spark, scratch_path(spark, "orders-log"))
    t.append(target, "modstamp")
    t.append(batch, "modstamp")
    return t


@register("bronze_log_latest", _MERGE_SQL)
def q_bronze_log_latest(spark, sf):
    """The same two loads appended to a change log, which is ranked by key."""
    return _orders_log(spark, sf).latest("o_orderkey", "modstamp")


@register("merge_upsert_buckets", _MERGE_SQL)
def q_merge_upsert_buckets(spark, sf):
    """The change log folded into a full version (``compact``) and read back."""
    t = _orders_log(spark, sf)
    t.compact("o_orderkey", "modstamp")
    return t.read()


@register("silver_bucketed", role_cte("bronze_events", "live_ids") + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS _rn
  FROM bronze_events)
SELECT user_id, event_type, value, ts FROM ranked
WHERE _rn = 1 AND NOT coalesce(try_cast(IsDeleted AS boolean), false)
  AND user_id IN (SELECT user_id FROM live_ids)""")
def q_silver_bucketed(spark, sf):
    """Log and live keys in tables bucketed by key: ranked and reconciled without a
    shuffle."""
    name = f"auric_{uuid.uuid4().hex[:12]}"
    log, live = (write_bucketed(role(spark, sf, r), f"{name}_{r}", "user_id", 8,
                                scratch_path(spark, f"bucketed-{r}"))
                 for r in ("bronze_events", "live_ids"))
    return silver_dedupe(log, "user_id", "ts", columns=["user_id", "event_type", "value", "ts"],
                         live_ids=live, tie_breakers=["event_id"], delete_filter="after")


# --------------------------------------------------------------------------
# Live-key snapshots, versioned tables, dated snapshots
# --------------------------------------------------------------------------

@register("live_ids_snapshot", """
SELECT cast(c_custkey AS varchar) AS c_custkey FROM customer""")
def q_live_ids_snapshot(spark, sf):
    return live_ids_snapshot(read_table(spark, sf, "customer"), "c_custkey")


@register("replace_snapshot", """
SELECT cast(c_custkey AS varchar) AS c_custkey FROM customer WHERE c_acctbal >= 0""")
def q_replace_snapshot(spark, sf):
    c = read_table(spark, sf, "customer")
    t = LakeTable(spark, scratch_path(spark, "live-ids"))
    t.replace(live_ids_snapshot(c, "c_custkey"))
    t.replace(live_ids_snapshot(c.where(F.col("c_acctbal") >= 0), "c_custkey"),
              max_shrink=0.5)
    return t.read()


_SNAP_DATES = ("1996-01-01", "1997-01-01", "1998-01-01")


def _orders_snapshot(o: DataFrame, as_of: str, stamp: str | None = None) -> DataFrame:
    """Order counts and cents per status as of a date, stamped with a date."""
    out = (o.where(F.col("o_orderdate") < F.lit(as_of).cast("timestamp_ntz"))
           .groupBy("o_orderstatus")
           .agg(F.count(F.lit(1)).alias("orders"),
                F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total_cents")))
    return gold.snapshot_stamp(out, stamp or as_of)


def _snap_sql(as_of: str, stamp: str | None = None) -> str:
    return f"""
SELECT o_orderstatus, count(*) AS orders,
       cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS total_cents,
       DATE '{stamp or as_of}' AS snapshot_date
FROM orders WHERE o_orderdate < TIMESTAMP '{as_of}' GROUP BY o_orderstatus"""


def _dated_table(spark, sf, runs) -> str:
    o = read_table(spark, sf, "orders")
    path = scratch_path(spark, "dated")
    for as_of, stamp in runs:
        append_snapshot(spark, _orders_snapshot(o, as_of, stamp), path, stamp)
    return path


_SNAP_COLS = ("o_orderstatus", "orders", "total_cents", "snapshot_date")


def _dated_rows(spark, sf, runs) -> DataFrame:
    return LakeTable(spark, _dated_table(spark, sf, runs)).read().select(*_SNAP_COLS)


@register("snapshot_stamp", _snap_sql(_SNAP_DATES[0]))
def q_snapshot_stamp(spark, sf):
    return _orders_snapshot(read_table(spark, sf, "orders"), _SNAP_DATES[0])


@register("snapshot_append_first_run", _snap_sql(_SNAP_DATES[0]))
def q_snapshot_append_first_run(spark, sf):
    return _dated_rows(spark, sf, [(_SNAP_DATES[0], _SNAP_DATES[0])])


@register("snapshot_append", _snap_sql(_SNAP_DATES[0]) + " UNION ALL "
          + _snap_sql(_SNAP_DATES[1]))
def q_snapshot_append(spark, sf):
    return _dated_rows(spark, sf, [(d, d) for d in _SNAP_DATES[:2]])


@register("snapshot_append_idempotent", _snap_sql(_SNAP_DATES[0]) + " UNION ALL "
          + _snap_sql(_SNAP_DATES[1]))
def q_snapshot_append_idempotent(spark, sf):
    # the second run for the first date carries different numbers; first write wins
    return _dated_rows(spark, sf, [(_SNAP_DATES[0], _SNAP_DATES[0]),
                                   (_SNAP_DATES[1], _SNAP_DATES[0]),
                                   (_SNAP_DATES[1], _SNAP_DATES[1])])


@register("latest_snapshot", _snap_sql(_SNAP_DATES[2]))
def q_latest_snapshot(spark, sf):
    path = _dated_table(spark, sf, [(d, d) for d in _SNAP_DATES])
    return read_latest_snapshot(spark, path).select(*_SNAP_COLS)


@register("latest_snapshot_rows", _snap_sql(_SNAP_DATES[2]))
def q_latest_snapshot_rows(spark, sf):
    """The same of any stored frame, by its greatest date."""
    return latest_snapshot(_dated_rows(spark, sf, [(d, d) for d in _SNAP_DATES]))


@register("time_travel_read", _snap_sql(_SNAP_DATES[0]))
def q_time_travel_read(spark, sf):
    o = read_table(spark, sf, "orders")
    t = LakeTable(spark, scratch_path(spark, "versioned"))
    v1 = t.commit(_orders_snapshot(o, _SNAP_DATES[0]), "build")
    t.commit(_orders_snapshot(o, _SNAP_DATES[1]), "build")
    return t.read(version=v1)


# --------------------------------------------------------------------------
# Incremental reads and record normalisation
# --------------------------------------------------------------------------

_LAST = "2024-01-15T00:00:00Z"


@register("incremental_since", """
SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""")
def q_incremental_since(spark, sf):
    return incremental_since(read_table(spark, sf, "events"), "ts", _LAST)


@register("incremental_with_lag", """
SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-14 23:58:00'""")
def q_incremental_with_lag(spark, sf):
    return incremental_since(read_table(spark, sf, "events"), "ts", _LAST,
                             lag_seconds=specs.LAG_SECONDS)


@register("max_cursor", "SELECT max(ts) AS max_cursor FROM events")
def q_max_cursor(spark, sf):
    return max_cursor(read_table(spark, sf, "events"), "ts")


@register("normalize_record", """
SELECT cast(event_id AS varchar) AS event_id, cast(user_id AS varchar) AS user_id,
       nullif(event_type, '') AS event_type, nullif(cast(value AS varchar), '') AS value,
       nullif(props, '') AS props, ts
FROM events""")
def q_normalize_record(spark, sf):
    return normalize_record(read_table(spark, sf, "events"), "ts")


@register("parse_cursor", """
SELECT event_id, ts AS c_iso_z, ts AS c_iso_offset,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS c_epoch_ms,
       cast(NULL AS timestamp) AS c_csv_digits
FROM events""")
def q_parse_cursor(spark, sf):
    e = read_table(spark, sf, "events")
    ts = F.col("ts")
    iso_z = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    iso_off = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+0000"))
    epoch = F.unix_millis(ts.cast("timestamp")).cast("string")
    return e.select("event_id",
                    parse_cursor(iso_z).alias("c_iso_z"),
                    parse_cursor(iso_off).alias("c_iso_offset"),
                    parse_cursor(epoch).alias("c_epoch_ms"),
                    parse_cursor(epoch, allow_epoch_ms=False).alias("c_csv_digits"))


# --------------------------------------------------------------------------
# Landed extracts
# --------------------------------------------------------------------------

_ORDERS_TEXT_SQL = """
SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey,
       o_orderstatus, cast(o_totalprice AS varchar) AS o_totalprice, o_orderpriority,
       o_orderdate
FROM orders"""
_TEXT_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@register("landed_csv_scan", _ORDERS_TEXT_SQL)
def q_landed_csv_scan(spark, sf):
    """Land orders as a CSV text export (ISO datetimes with Z) whose header is in
    another order and has a column more; scan it back by header name, normalise."""
    o = read_table(spark, sf, "orders")
    path = scratch_path(spark, "landing-csv")
    cols = [F.col(c).cast("string").alias(c) for c in _TEXT_COLS]
    cursor = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("o_orderdate")
    o.select(cursor, F.lit("extra").alias("more"), *reversed(cols)) \
     .write.option("header", True).csv(path)
    raw = landed_csv_scan(spark, path, [*_TEXT_COLS, "o_orderdate"])
    return normalize_record(raw, "o_orderdate", allow_epoch_ms=False)


@register("landed_json_scan", _ORDERS_TEXT_SQL)
def q_landed_json_scan(spark, sf):
    """Land orders as typed JSON records with an ``attributes`` envelope and
    epoch-millisecond datetimes, scan back as text, normalise."""
    o = read_table(spark, sf, "orders")
    path = scratch_path(spark, "landing-json")
    attrs = F.struct(F.lit("Order").alias("type"),
                     F.concat(F.lit("/orders/"), F.col("o_orderkey").cast("string")).alias("url"))
    epoch = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    o.select(attrs.alias("attributes"), *_TEXT_COLS, epoch.alias("o_orderdate")) \
     .write.json(path)
    return normalize_record(landed_json_scan(spark, path), "o_orderdate")


@register("landed_variant_scan", """
SELECT cast(o_orderkey AS varchar) AS o_orderkey,
       CASE o_orderkey % 3 WHEN 0 THEN cast(o_custkey AS varchar)
            WHEN 1 THEN 'C-' || cast(o_custkey AS varchar) END AS o_custkey,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderstatus END AS added,
       CASE WHEN o_orderkey % 3 = 0 THEN '{"p":"' || o_orderpriority || '"}'
            WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS prio, o_orderdate
FROM orders""")
def q_landed_variant_scan(spark, sf):
    """Ingest three batches of JSON in which a field is a number, text or missing, another is
    added, a third is an object or text; one column, compound by the source's own
    description, is not loaded."""
    o = read_table(spark, sf, "orders")
    landing, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    when = F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate")
    key, prio = F.col("o_orderkey"), F.col("o_orderpriority")
    forms = [("o_custkey", F.struct(prio.alias("p")).alias("prio"), F.lit("x").alias("blob")),
             (F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("o_custkey"),
              prio.alias("prio"), F.lit("x").alias("blob")),
             (F.col("o_orderstatus").alias("added"), F.lit("x").alias("blob"))]
    for k, form in enumerate(forms):
        o.where(key % 3 == k).select(key, *form, when).write.mode("append").json(
            f"{landing}/orders/json")
    jobs.ingest(spark, lake, landing, [_ORDERS_SPEC], variant=["orders"],
                described={"orders": {"Blob": "base64"}})
    return LakeTable.at(spark, lake, "bronze", "orders").latest("o_orderkey", "o_orderdate")


@register("ingest_entity_subset", """
SELECT 'orders' AS entity, cast(o_orderkey AS varchar) AS id, o_orderdate AS at FROM orders
WHERE o_orderkey % 2 = 0""")
def q_ingest_entity_subset(spark, sf):
    """Two entities landed, one of them selected: the rows of every bronze table there is."""
    o = read_table(spark, sf, "orders")
    landing, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    when = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("o_orderdate")
    for k, name in enumerate(("orders", "returns")):
        (o.where(F.col("o_orderkey") % 2 == k).select(F.col("o_orderkey").cast("string"), when)
         .write.option("header", True).csv(f"{landing}/{name}/csv"))
    chosen = [_ORDERS_SPEC, specs.EntitySpec("returns", "o_orderkey", "o_orderdate")]
    jobs.ingest(spark, lake, landing, chosen, entities=["orders"])
    names = [r["table_name"] for r in list_tables(spark, lake, "bronze").collect()]
    parts = [LakeTable.at(spark, lake, "bronze", t).read().select(
        F.lit(t).alias("entity"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"))
        for t in names]
    return reduce(lambda a, b: a.union(b), parts)


_FORMATTED = "o_orderstatus@OData.Community.Display.V1.FormattedValue"
_PAGE_RECORD = StructType([
    StructField("o_orderkey", LongType()), StructField("o_orderstatus", StringType()),
    StructField(_FORMATTED, StringType()), StructField("o_totalprice", DoubleType()),
    StructField("modifiedon", StringType())])
PAGE_SIZE = 5000


@register("paged_json_explode", f"""
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open'
            ELSE 'Pending' END AS "{_FORMATTED}",
       o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS modifiedon
FROM orders""")
def q_paged_json_explode(spark, sf):
    """Every page's ``value`` array back as rows."""
    path = scratch_path(spark, "landing-pages")
    _land_pages(spark, sf, path)
    return paged_json_explode(spark, path, _PAGE_RECORD)


def _land_pages(spark, sf, path):
    """Land orders as API page documents of at most PAGE_SIZE records (pages by key
    range)."""
    o = read_table(spark, sf, "orders")
    label = (F.when(F.col("o_orderstatus") == "F", "Fulfilled")
             .when(F.col("o_orderstatus") == "O", "Open").otherwise("Pending"))
    rec = F.struct(F.col("o_orderkey"), F.col("o_orderstatus"), label.alias(_FORMATTED),
                   F.col("o_totalprice"),
                   F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("modifiedon"))
    page = F.floor(F.col("o_orderkey") / PAGE_SIZE)
    pages = (o.groupBy(page.alias("page"))
             .agg(F.collect_list(rec).alias("value"))
             .select("value", F.concat(F.lit("page-"), (F.col("page") + 1).cast("string"))
                     .alias("@odata.nextLink")))
    pages.write.json(path)


@register("stream_ingest", _ORDERS_TEXT_SQL)
def q_stream_ingest(spark, sf):
    """Land orders as JSON deltas in four slices by key, then append them to a
    bronze change log with an available-now stream (some files per trigger) and
    rank it."""
    from auric.streaming import stream_ingest
    o = read_table(spark, sf, "orders")
    landing = scratch_path(spark, "landing-stream")
    epoch = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    (o.select(*_TEXT_COLS, epoch.alias("o_orderdate"),
              F.pmod(F.xxhash64("o_orderkey"), F.lit(4)).alias("slice"))
     .write.partitionBy("slice").json(landing))
    schema = StructType([StructField(c, StringType()) for c in (*_TEXT_COLS, "o_orderdate")])
    table = LakeTable(spark, scratch_path(spark, "bronze-orders"))
    stream_ingest(spark, f"{landing}/*", schema, table, "o_orderdate",
                  scratch_path(spark, "stream-ckpt"), max_files_per_trigger=8)
    return table.latest("o_orderkey", "o_orderdate")


def _ingested(spark, landing, spec, runs=1, **kw) -> DataFrame:
    lake = scratch_path(spark, "lake")
    for _ in range(runs):
        jobs.ingest(spark, lake, landing, [spec], **kw)
    return LakeTable.at(spark, lake, "bronze", spec.table).latest(spec.pk, spec.cursor)


_ORDERS_SPEC = specs.EntitySpec("orders", "o_orderkey", "o_orderdate")


@register("ingest_bad_cursor", """
SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_orderstatus,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate
FROM orders""")
def q_ingest_bad_cursor(spark, sf):
    """Bronze loads of an export in which every third cursor is missing or is no date: such
    rows are loaded, with a NULL cursor, and once, however often the load runs (the rows
    of the change log itself)."""
    o = read_table(spark, sf, "orders")
    landing = scratch_path(spark, "landing")
    cursor = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    bad = F.when(F.col("o_orderkey") % 2 == 0, F.lit("not a date"))
    (o.select(F.when(F.col("o_orderkey") % 3 == 0, bad).otherwise(cursor).alias("o_orderdate"),
              "o_orderstatus", F.col("o_orderkey").cast("string").alias("o_orderkey"))
     .write.option("header", True).csv(f"{landing}/orders/csv"))
    lake = scratch_path(spark, "lake")
    for _ in range(3):
        jobs.ingest(spark, lake, landing, [_ORDERS_SPEC])
    return LakeTable.at(spark, lake, "bronze", "orders").read().select(
        "o_orderkey", "o_orderstatus", "o_orderdate")


@register("ingest_all_bad_cursor", """
SELECT cast(o_orderkey AS varchar) AS o_orderkey,
       CASE WHEN o_orderkey % 4 = 0 THEN 'changed' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate END AS o_orderdate
FROM orders""")
def q_ingest_all_bad_cursor(spark, sf):
    """An export without one readable cursor, then a delta with readable ones for every
    fourth row: the second run takes the delta, the third finds no new file."""
    o = read_table(spark, sf, "orders")
    landing = scratch_path(spark, "landing")
    key = F.col("o_orderkey").cast("string").alias("o_orderkey")
    (o.select(key, "o_orderstatus", F.lit("unknown").alias("o_orderdate"))
     .write.option("header", True).csv(f"{landing}/orders/csv"))
    epoch = F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate")
    (o.where("o_orderkey % 4 = 0").select(key, F.lit("changed").alias("o_orderstatus"), epoch)
     .write.json(f"{landing}/orders/json"))
    return _ingested(spark, landing, _ORDERS_SPEC, runs=3)


@register("ingest_empty_first_run", _ORDERS_TEXT_SQL)
def q_ingest_empty_first_run(spark, sf):
    """The first run finds an export without rows; the next one, with no cursor
    stored, takes the backfill again."""
    o = read_table(spark, sf, "orders")
    landing, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    out = o.select(*[F.col(c).cast("string").alias(c) for c in _TEXT_COLS],
                   F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
                   .alias("o_orderdate"))
    for rows in (out.limit(0).coalesce(1), out):
        rows.write.mode("overwrite").option("header", True).csv(f"{landing}/orders/csv")
        jobs.ingest(spark, lake, landing, [_ORDERS_SPEC])
    return LakeTable.at(spark, lake, "bronze", "orders").latest("o_orderkey", "o_orderdate")


@register("ingest_odata", f"""
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open'
            ELSE 'Pending' END AS "{_FORMATTED}",
       o_totalprice, o_orderdate AS modifiedon
FROM orders""")
def q_ingest_odata(spark, sf):
    """Bronze load of a paged source, twice: the second run finds no new page."""
    landing = scratch_path(spark, "landing")
    _land_pages(spark, sf, f"{landing}/orders/pages")
    spec = specs.EntitySpec.odata("orders", "o_orderkey")
    return _ingested(spark, landing, spec, runs=2, page_schemas={"orders": _PAGE_RECORD})


@register("seed_scan", "SELECT cast(n_nationkey AS varchar) AS ISO3, n_name AS Region, "
          "cast(n_regionkey AS varchar) AS Functional_region FROM nation")
def q_seed_scan(spark, sf):
    """A seed CSV whose header is in another order, read by the declared names."""
    path = scratch_path(spark, "seed")
    (read_table(spark, sf, "nation")
     .select(F.col("n_regionkey").cast("string").alias("Functional_region"), F.lit("x").alias("more"),
             F.col("n_name").alias("Region"), F.col("n_nationkey").cast("string").alias("ISO3"))
     .write.option("header", True).option("escape", '"').csv(path))
    return load_seed(spark, path, specs.REGIONS_SEED_SCHEMA)


@register("select_queryable_columns", "SELECT vec_id, label FROM embeddings")
def q_select_queryable_columns(spark, sf):
    return select_queryable_columns(read_table(spark, sf, "embeddings"))


# --------------------------------------------------------------------------
# Catalog, publishing, previews, ad-hoc SQL
# --------------------------------------------------------------------------

@register("table_row_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in TEST_TABLES))
def q_table_row_counts(spark, sf):
    return footer_row_counts(spark, {t: table_path(sf, t) for t in TEST_TABLES})


@register("layer_tables", """
SELECT 'customer' AS table_name, count(*) AS rows FROM customer
UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'orders', count(*) FROM orders""")
def q_layer_tables(spark, sf):
    """The tables of a layer with their rows; what is being staged is no table."""
    root = scratch_path(spark, "lake")
    for name, t in (("orders", "orders"), ("nation", "nation"), ("customer", "customer"),
                    ("orders_staging", "orders")):
        LakeTable.at(spark, root, "silver", name).commit(read_table(spark, sf, t), "build")
    names = [r["table_name"] for r in list_tables(spark, root, "silver").collect()]
    tables = {n: LakeTable.at(spark, root, "silver", n) for n in names}
    return footer_row_counts(spark, {n: t.version_path(t.current_version()) for n, t in
                                     tables.items()}).withColumnRenamed("table", "table_name")


# The names of types in the oracle's catalog and in Spark
_TYPE_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float",
               "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
               "BOOLEAN": "boolean", "FLOAT[]": "array<float>", "DOUBLE[]": "array<double>"}


@register("column_listing", f"""
SELECT table_name AS "table", column_name, CASE data_type
         {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _TYPE_NAMES.items())}
         ELSE data_type END AS data_type, cast(ordinal_position AS integer) AS ordinal_position
FROM information_schema.columns WHERE table_name IN ({sql_list(TEST_TABLES)})""")
def q_column_listing(spark, sf):
    """Name, type and place of every column of every table."""
    parts = [describe_columns(spark, read_table(spark, sf, t)).select(
        F.lit(t).alias("table"), "column_name", "data_type", "ordinal_position")
        for t in TEST_TABLES]
    return reduce(lambda a, b: a.union(b), parts)


@register("published_roundtrip", _snap_sql(_SNAP_DATES[0]) + " UNION ALL "
          + _snap_sql(_SNAP_DATES[1]))
def q_published_roundtrip(spark, sf):
    """A dated gold table of two dates, published and read back."""
    root, dest = scratch_path(spark, "lake"), scratch_path(spark, "published")
    o = read_table(spark, sf, "orders")
    for d in _SNAP_DATES[:2]:
        append_snapshot(spark, _orders_snapshot(o, d), f"{root}/gold/orders_daily", d)
    jobs.publish(spark, root, "gold", dest)
    return spark.read.parquet(f"{dest}/gold/orders_daily").select(*_SNAP_COLS)


@register("published_replace", _snap_sql(_SNAP_DATES[1]) + " UNION ALL "
          + _snap_sql(_SNAP_DATES[2]))
def q_published_replace(spark, sf):
    """Published over a copy that holds another date: what is left is the table."""
    dest, o = scratch_path(spark, "published"), read_table(spark, sf, "orders")
    for dates in (_SNAP_DATES[:2], _SNAP_DATES[1:]):
        root = scratch_path(spark, "lake")
        for d in dates:
            append_snapshot(spark, _orders_snapshot(o, d), f"{root}/gold/orders_daily", d)
        jobs.publish(spark, root, "gold", dest)
    return spark.read.parquet(f"{dest}/gold/orders_daily").select(*_SNAP_COLS)


@register("preview_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20")
def q_preview_limit(spark, sf):
    return read_table(spark, sf, "orders").orderBy("o_orderkey").limit(20)


@register("top_k", """
SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_top_k(spark, sf):
    return (read_table(spark, sf, "orders")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc())
            .limit(10))


@register("ordered_metrics", """
SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM orders
GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 2 NULLS LAST""")
def q_ordered_metrics(spark, sf):
    return (read_table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority")
            .agg(F.count(F.lit(1)).alias("orders"))
            .orderBy(F.col("o_orderstatus").asc_nulls_last(),
                     F.col("o_orderpriority").asc_nulls_last()))


@register("adhoc_sql", """
SELECT p_brand, count(*) AS parts, max(p_size) AS max_size FROM part
WHERE p_size >= 10 GROUP BY p_brand""")
def q_adhoc_sql(spark, sf):
    return adhoc_sql(spark, """
        SELECT p_brand, count(*) AS parts, max(p_size) AS max_size FROM {part}
        WHERE p_size >= :min_size GROUP BY p_brand""",
                     args={"min_size": 10}, part=read_table(spark, sf, "part"))


@register("adhoc_sql_layers", f"""
SELECT s.o_orderstatus, count(*) AS orders, max(g.total_cents) AS total_cents,
       count(b.o_orderkey) AS in_bronze
FROM ({_MERGE_SQL}) AS s
LEFT JOIN ({_MERGE_SQL}) AS b ON s.o_orderkey = b.o_orderkey
LEFT JOIN ({_snap_sql(_SNAP_DATES[2])}) AS g ON s.o_orderstatus = g.o_orderstatus
GROUP BY s.o_orderstatus""")
def q_adhoc_sql_layers(spark, sf):
    """SQL text over the tables of a lake by layer and name: a bronze change log of two
    loads, a silver version, dated gold snapshots."""
    root = scratch_path(spark, "lake")
    target, batch = _merge_inputs(spark, sf)
    bronze = LakeTable.at(spark, root, "bronze", "orders")
    bronze.append(target, "modstamp")
    bronze.append(batch.withColumn("note", F.lit("late")), "modstamp")
    spec = specs.EntitySpec("orders", "o_orderkey", "modstamp")
    LakeTable.at(spark, root, "silver", "orders").commit(
        bronze.latest("o_orderkey", "modstamp"), "build")
    for d in _SNAP_DATES[1:]:
        append_snapshot(spark, _orders_snapshot(read_table(spark, sf, "orders"), d),
                        f"{root}/gold/orders_daily", d)
    beside = spark.newSession()                   # leaves the caller's catalog settings alone
    register_layers(beside, root, [spec])
    return adhoc_sql(beside, """
        SELECT s.o_orderstatus, count(*) AS orders, max(g.total_cents) AS total_cents,
               count(b.o_orderkey) AS in_bronze
        FROM silver.orders AS s
        LEFT JOIN bronze.orders AS b ON s.o_orderkey = b.o_orderkey
        LEFT JOIN gold.orders_daily AS g
               ON g.o_orderstatus = s.o_orderstatus AND g.snapshot_date = :day
        GROUP BY s.o_orderstatus""", args={"day": dt.date.fromisoformat(_SNAP_DATES[2])})


@register("like_escape", r"""
SELECT p_partkey, p_name,
       p_name LIKE 'small\_%' ESCAPE '\' AS literal_underscore,
       p_name LIKE 'small_%' AS any_char,
       p_name NOT LIKE '%\%%' ESCAPE '\' AS no_percent
FROM part""")
def q_like_escape(spark, sf):
    p = read_table(spark, sf, "part")
    name = F.col("p_name")
    return p.select("p_partkey", "p_name",
                    F.like(name, F.lit(r"small\_%"), F.lit("\\")).alias("literal_underscore"),
                    name.like("small_%").alias("any_char"),
                    (~F.like(name, F.lit(r"%\%%"), F.lit("\\"))).alias("no_percent"))


# --------------------------------------------------------------------------
# Casts and certificate predicates
# --------------------------------------------------------------------------

@register("try_cast_date", role_cte("date_texts") + """
SELECT id, txt, try_cast(txt AS date) AS d FROM date_texts""")
def q_try_cast_date(spark, sf):
    return role(spark, sf, "date_texts").select("id", "txt", safe_date("txt").alias("d"))


@register("try_cast_double", role_cte("number_texts") + """
SELECT id, txt, try_cast(txt AS double) AS x FROM number_texts""")
def q_try_cast_double(spark, sf):
    return role(spark, sf, "number_texts").select("id", "txt", safe_double("txt").alias("x"))


@register("certificate_filter", role_cte("certificate_c") + f"""
SELECT * FROM certificate_c
WHERE Cert_Status__c IN ({sql_list(specs.ALL_STATUSES)})
  AND CB__c NOT IN ({sql_list(specs.EXCLUDED_CBS)})""")
def q_certificate_filter(spark, sf):
    return gold.certificate_filter(role(spark, sf, "certificate_c"))


@register("currently_valid", role_cte("certificate_c") + f"""
SELECT * FROM certificate_c WHERE try_cast(Date_To__c AS date) >= {_ASOF}""")
def q_currently_valid(spark, sf):
    c = role(spark, sf, "certificate_c")
    return c.where(gold.currently_valid("Date_To__c", AS_OF))



# --------------------------------------------------------------------------
# The layer jobs end to end
# --------------------------------------------------------------------------

_E2E_ROLES = {"certificate_c": "certificate_c__c", "account": "account",
              "country_data": "country_data__c", "recordtype": "recordtype",
              "non_certificate_holder": "non_certificate_holder__c"}


# gold table -> (its key columns, its measures)
_GOLD_SHAPES = {
    "baseline_certification": (
        ["ctype", "country"],
        ["certificates", "boreal_forests", "community_forestry", "forest_area_total",
         "management_for_ntfp_and_services", "plantations", "temperate_forests",
         "tropical_forests"]),
    "coc_per_country": (["country"], ["certificates"]),
    "fm_per_country": (["country"], ["forest_area", "certificates"]),
    "sites_with_identity": (["country", "ctype", "Certificate_Type__c"],
                            ["number of sites with identity"]),
    "issued_vs_terminations": (["kind", "country", "event_date", "ctype", "status",
                                "Certificate_Type__c"], ["certificates"]),
    "daily_certificate_numbers": (["Certificate Category"],
                                  ["Number Of Certificates", "Number Of Companies"]),
    "daily_forest_areas": (["Forest Type"], ["Number Of Certificates", "Certified Forest Area"]),
    "daily_headline": ([], ["Promotional license", "Members", "Member Countries"]),
    "members": (["Sub_Chamber", "Member_Type", "Country", "Website", "Member", "Chamber",
                 "Region", "region_fun"], []),
}


def _long_sql(t: str) -> str:
    """A gold oracle as rows (table, key, measure, value, snapshot_date)."""
    keys, measures = _GOLD_SHAPES[t]
    key = ", ".join(["'k'", *(f"coalesce(\"{k}\"::varchar, '~')" for k in keys)])
    value = " ".join(f"WHEN '{m}' THEN \"{m}\"::double" for m in [*measures]) or "WHEN '' THEN 0"
    names = ", ".join(f"('{m}')" for m in (measures or ["row"]))
    return (f"SELECT '{t}' AS gold_table, concat_ws('|', {key}) AS row_key, measure, "
            f"CASE measure {value} ELSE 1 END AS value, snapshot_date "
            f"FROM ({ORACLE[t]}) AS t, (VALUES {names}) AS m(measure)")


def _long(df: DataFrame, t: str) -> DataFrame:
    keys, measures = _GOLD_SHAPES[t]
    key = F.concat_ws("|", F.lit("k"), *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("~"))
                                         for k in keys])
    values = [F.struct(F.lit(m).alias("measure"), F.col(f"`{m}`").cast("double").alias("value"))
              for m in measures] or [F.struct(F.lit("row").alias("measure"),
                                              F.lit(1.0).alias("value"))]
    return (df.select(F.lit(t).alias("gold_table"), key.alias("row_key"), "snapshot_date",
                      F.explode(F.array(*values)).alias("v"))
            .select("gold_table", "row_key", "v.measure", "v.value", "snapshot_date"))


def _land_history(spark, sf, landing):
    """Land each CRM table as it would arrive over time, so that what is left is the role.

    The CSV export has every row, each third in an older form, plus rows that are
    deleted later and rows whose keys are gone at the source. The JSON deltas bring the
    current form of the older rows and the deletes; the key export lacks the gone. The files
    are compressed chunks of bounded rows, as extracts are delivered. A role is computed
    once for the three."""
    old, new = "2026-11-01T12:00:00.000Z", "2026-11-30T12:00:00.000Z"

    def land(name, table):
        scratch = scratch_path(spark, f"role-{name}")
        role(spark, sf, name).write.option("compression", "zstd").parquet(scratch)
        rows = spark.read.parquet(scratch)
        third = F.pmod(F.xxhash64("Id"), F.lit(3)) == 0
        text = [c for c in rows.columns if c != "Id"]
        stale = [F.when(third & F.col(c).isNotNull(), F.concat(F.lit("old "), c)).otherwise(
            F.col(c)).alias(c) for c in text]

        def copies(mark):
            return rows.where(third).withColumn("Id", F.concat(F.lit(mark), "Id"))

        def stamped(df, flag, at):
            return df.withColumns({"IsDeleted": F.lit(flag), "SystemModstamp": F.lit(at)})

        def chunks(df):
            return df.write.option("compression", "gzip").option("maxRecordsPerFile", 1_000_000)

        export = (stamped(rows.select("Id", *stale), "false", old)
                  .union(stamped(copies("deleted-"), None, old))
                  .union(stamped(copies("gone-"), "0", old)))
        delta = (stamped(rows.where(third), "false", new)
                 .union(stamped(copies("deleted-"), "True", new)))
        ids = rows.select("Id").union(copies("deleted-").select("Id"))
        base = f"{landing}/{table}"
        try:
            chunks(export).option("header", True).option("escape", '"').csv(f"{base}/csv")
            chunks(delta).json(f"{base}/json")
            chunks(ids).option("header", True).csv(f"{base}/ids")
        finally:
            remove_path(spark, scratch)

    tasks = {table: (lambda name=name, table=table: land(name, table))
             for name, table in _E2E_ROLES.items()}
    tasks["regions"] = lambda: role(spark, sf, "regions").write.option("header", True).csv(
        f"{landing}/regions")
    with short_lived_shuffles(spark):
        jobs.write_concurrently(tasks)


@register("medallion_end_to_end", " UNION ALL ".join(_long_sql(t) for t in jobs.GOLD_TABLES))
def q_medallion_end_to_end(spark, sf):
    """The layer jobs over a landed history: backfill, delta run with changed and
    deleted rows, live-key reconcile, silver with projected columns and the seed, gold
    build and publish; returns every published gold table in one long form."""
    root = scratch_path(spark, "medallion")
    landing, lake, dest = f"{root}/landing", f"{root}/lake", f"{root}/published"
    _land_history(spark, sf, landing)
    entity_specs = [
        specs.EntitySpec(table=table, model=name, pk="Id", cursor="SystemModstamp",
                         columns=tuple(role(spark, sf, name).columns),
                         live_ids_table=f"{table}__live_ids")
        for name, table in _E2E_ROLES.items()]
    steps = {"csv": lambda: jobs.ingest(spark, lake, landing, entity_specs),
             "json": lambda: jobs.ingest(spark, lake, landing, entity_specs),
             "ids": lambda: jobs.reconcile_ids(spark, lake, entity_specs, landing_root=landing)}
    for kind, load in steps.items():
        load()
        for spec in entity_specs:            # the lake has them: landed files are not kept
            remove_path(spark, f"{landing}/{spec.table}/{kind}")
    jobs.build_silver(spark, lake, entity_specs, regions_seed=f"{landing}/regions")
    jobs.build_gold(spark, lake, snapshot_date=SNAPSHOT_DATE, as_of=AS_OF, publish_to=dest)
    parts = [_long(spark.read.parquet(f"{dest}/gold/{t}"), t) for t in jobs.GOLD_TABLES]
    return reduce(lambda a, b: a.union(b), parts)
