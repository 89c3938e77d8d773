"""Layer jobs: bronze ingest, live-key reconcile, silver build, gold build,
publish. Run them in that order (gold after silver after the bronze loads;
the live-key reconcile is run on demand after a bronze load).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from auric import specs as S
from auric.operators.dedupe import find_column, key_slice, silver_dedupe
from auric.operators.incremental import incremental_since, may_come_again
from auric.operators.snapshot import append_snapshot, has_snapshot
from auric.plans import gold
from auric.session import remove_path, replace_path, scratch_path, short_lived_shuffles
from auric.sources.landed import (LandingLedger, backfill_from_csv, delta_from_json,
                                  delta_from_pages, delta_from_variant, landed_csv_scan,
                                  live_ids_snapshot, load_seed, paged_json_explode,
                                  select_queryable_columns)
from auric.sources.lake import LOAD_COLUMN, LakeTable, list_tables, path_missing


def ingest(spark: SparkSession, lake_root: str, landing_root: str,
           specs: Sequence[S.EntitySpec], csv_columns: dict[str, Sequence[str]] | None = None,
           entities: Iterable[str] | None = None, seed_since=None,
           seed_since_days: int | None = None, lag_seconds: int | None = None,
           json_schemas: dict[str, StructType] | None = None,
           page_schemas: dict[str, StructType] | None = None,
           described: dict[str, Mapping[str, str]] | None = None,
           variant: Iterable[str] = (), compact_every: int = 16, workers: int = 4) -> dict[str, int]:
    """Bronze load of each selected entity: what was landed since its last load.

    Each landed file is loaded once; the table keeps a ledger of them. A CRM entity takes
    the CSV backfill under ``<landing>/<table>/csv`` until one has brought rows, bounded by
    ``seed_since`` (or ``seed_since_days`` before now), then (or if nothing new is there) the
    JSON deltas under ``<landing>/<table>/json``. Both become text with a UTC cursor. A
    paged entity reads ``<landing>/<table>/pages``, types as delivered. So what counts as
    a first run is what has been loaded, not whether a cursor could be read.
    ``lag_seconds`` replaces every spec's own overlap.

    Of the new files the rows after the stored cursor, less the overlap, are loaded, and
    rows whose cursor cannot be read, with a NULL cursor. A row of either kind that is
    already loaded with the same contents is left out; a batch whose rows are all above the
    stored cursor is compared with nothing. ``described`` gives, by table, the
    source's own type of each column; compound and binary ones are not loaded. The JSON of
    the tables named in ``variant`` is read without a schema, whatever its fields' types
    (else by ``json_schemas`` or inference). The batch is appended to the
    bronze change log; after ``compact_every`` loads that is folded to one row per key. A
    run that finds no new file writes nothing. Entities are independent tables, so up to
    ``workers`` of them load at the same time.
    """
    if seed_since_days is not None:
        if seed_since is not None:
            raise ValueError("give seed_since or seed_since_days")
        seed_since = _dt.datetime.now(_dt.timezone.utc) - _dt.timedelta(days=seed_since_days)
    loose = set(variant)

    def load(spec: S.EntitySpec) -> int:
        table = LakeTable.at(spark, lake_root, "bronze", spec.table)
        ledger = LandingLedger(spark, f"{table.path}/_files")
        base = f"{landing_root.rstrip('/')}/{spec.table}"
        lag = spec.lag_seconds if lag_seconds is None else lag_seconds
        last, seed = table.last_cursor(), seed_since
        kinds = ["pages"] if spec.source == "odata" else ["json"]
        if spec.source != "odata" and not ledger.has_rows("csv"):
            kinds.insert(0, "csv")
        for kind in kinds:
            files = ledger.new_files(f"{base}/{kind}")
            if files:
                break
        else:
            return table.current_version() or 0
        paths = [f["path"] for f in files]
        if kind == "pages":
            batch = delta_from_pages(spark, paths, spec.cursor,
                                     (page_schemas or {}).get(spec.table))
        elif kind == "csv":
            batch = backfill_from_csv(spark, paths, (csv_columns or {}).get(spec.table),
                                      spec.cursor, spec.csv_multi_line)
        else:
            batch = (delta_from_variant(spark, paths, spec.cursor) if spec.table in loose else
                     delta_from_json(spark, paths, spec.cursor,
                                     (json_schemas or {}).get(spec.table), last, lag))
            seed = seed if table.current_version() is None else None
        if described and spec.table in described:
            batch = select_queryable_columns(batch, (), described[spec.table])
        batch = incremental_since(batch, spec.cursor, last, lag, seed, keep_unreadable=True)
        seen_path = f"{table.path}/_seen"
        version = table.append(batch, spec.cursor,
                               lambda: _may_come(spark, table, seen_path, spec.cursor, last, lag))
        ledger.add(kind, files, table.last()["rows"])
        if len(table.parts()) > compact_every:
            for rows in table.appended():       # the folded version lacks some of these
                (may_come_again(rows, spec.cursor, table.last_cursor(), lag)
                 .write.mode("append").parquet(seen_path))
            version = table.compact(spec.pk, spec.cursor, spec.tie_breakers)
        return version

    with short_lived_shuffles(spark):
        return write_concurrently({s.table: (lambda s=s: load(s))
                                   for s in S.select_specs(specs, entities)}, workers)


def _may_come(spark: SparkSession, table: LakeTable, path: str, cursor: str, last,
              lag_seconds: int) -> DataFrame:
    """Digests of loaded rows that a load from ``last`` on may bring again: of the rows
    loaded since the last compaction, and those stored in ``path`` before they were folded."""
    parts = [may_come_again(rows, cursor, last, lag_seconds) for rows in table.appended()]
    try:
        seen = spark.read.schema("digest string, cursor timestamp").parquet(path)
        parts.append(seen if last is None else incremental_since(
            seen, "cursor", last, lag_seconds, keep_unreadable=True))
    except AnalysisException as e:
        if not path_missing(e):
            raise
    if not parts:
        return spark.createDataFrame([], "digest string, cursor timestamp")
    return reduce(DataFrame.unionAll, parts)


def reconcile_ids(spark: SparkSession, lake_root: str, specs: Sequence[S.EntitySpec],
                  exports: dict[str, DataFrame] | None = None, landing_root: str | None = None,
                  entities: Iterable[str] | None = None,
                  expected_rows: dict[str, int] | None = None,
                  max_shrink: float | None = None) -> dict[str, int]:
    """Replace each selected ``<table>__live_ids`` with the full key set of a fresh
    export: a frame from ``exports``, or what is landed under
    ``<landing>/<table>/ids`` (CSV, or pages for a paged source). A row count other
    than the manifest's (``expected_rows``) is refused; ``max_shrink`` refuses a
    set that lost more than that share."""
    done = {}
    for spec in S.select_specs(specs, entities or (list(exports) if exports else None)):
        if exports and spec.table in exports:
            full = exports[spec.table]
        elif landing_root is None:
            raise ValueError(f"no export and no landing folder for {spec.table}")
        else:
            path = f"{landing_root.rstrip('/')}/{spec.table}/ids"
            full = (paged_json_explode(spark, path) if spec.source == "odata"
                    else landed_csv_scan(spark, path))
        t = LakeTable.at(spark, lake_root, "bronze", spec.live_ids_table)
        done[spec.table] = t.replace(live_ids_snapshot(full, spec.pk),
                                     (expected_rows or {}).get(spec.table), max_shrink)
    return done


def build_silver(spark: SparkSession, lake_root: str, specs: Sequence[S.EntitySpec],
                 select: Iterable[str] | None = None,
                 overrides: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
                 regions_seed: str | None = None, workers: int = 4,
                 publish_to: str | None = None, slice_rows: int = 2_000_000,
                 max_slices: int = 8) -> dict[str, int]:
    """Rebuild each selected silver table as a new version, then publish them if
    ``publish_to`` names a folder. A model named in ``overrides`` is built by that
    function from its bronze frame instead. Bronze is a change log, so deleted rows
    are filtered after ranking: a delete hides what it deletes. A selected table
    without bronze is an error. Up to ``workers`` tables build at the same time.

    The ranking shuffles a log with all its columns. A log of more than ``slice_rows`` rows
    is ranked in slices of its keys, up to ``max_slices``, one after another, so only one
    slice is in shuffle files at a time; each slice scans the log, so their number is
    bounded. Every key is in one slice."""
    chosen = S.select_specs(specs, select)
    bronze = {s.table: LakeTable.at(spark, lake_root, "bronze", s.table) for s in chosen}
    missing = [t for t, table in bronze.items() if not table.exists()]
    if missing:
        raise FileNotFoundError(f"no bronze table: {', '.join(sorted(missing))}")

    def build(spec: S.EntitySpec) -> int:
        src = bronze[spec.table].read()
        if overrides and spec.model in overrides:
            out = [overrides[spec.model](src)]
        else:
            live_t = LakeTable.at(spark, lake_root, "bronze", spec.live_ids_table) \
                if spec.live_ids_table else None
            live = live_t.read() if live_t is not None and live_t.exists() else None
            load = [LOAD_COLUMN] if LOAD_COLUMN in src.columns else []
            slices = min(max_slices, 1 + bronze[spec.table].stored_rows() // slice_rows)

            def ranked(rows, ids):
                return silver_dedupe(rows, spec.pk, spec.cursor, spec.has_soft_delete,
                                     spec.columns, ids, [*spec.tie_breakers, *load],
                                     delete_filter="after", drop_matching=spec.drop_matching)
            out = [ranked(src, live)] if slices == 1 else [
                ranked(key_slice(src, spec.pk, k, slices), ids_of(src, live, spec.pk, k, slices))
                for k in range(slices)]
        return LakeTable.at(spark, lake_root, "silver", spec.model).commit_parts(out, "build")

    tasks = {s.model: (lambda s=s: build(s)) for s in chosen}
    if regions_seed:
        seed = load_seed(spark, regions_seed, S.REGIONS_SEED_SCHEMA)
        tasks["regions"] = lambda: LakeTable.at(spark, lake_root, "gold", "regions").commit(
            seed, "seed")
    with short_lived_shuffles(spark):
        done = write_concurrently(tasks, workers)
    if publish_to:
        publish(spark, lake_root, "silver", publish_to, [s.model for s in chosen])
    return done


def ids_of(src: DataFrame, live: DataFrame | None, pk: str, k: int,
           slices: int) -> DataFrame | None:
    """The live keys of a slice of ``src``; all, where the key has another type there and
    equal keys may hash apart."""
    if live is None or live.schema[find_column(live, pk) or pk].dataType != \
            src.schema[find_column(src, pk) or pk].dataType:
        return live
    return key_slice(live, pk, k, slices)


GOLD_TABLES = ("baseline_certification", "coc_per_country", "daily_certificate_numbers",
               "daily_forest_areas", "daily_headline", "fm_per_country",
               "issued_vs_terminations", "members", "sites_with_identity")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a frame reading it back: the lineage is cut, every consumer sees
    the same rows, a lost executor re-reads files instead of recomputing the
    joins, and consumers still get column pruning and pushed filters."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def gold_frames(silver: dict[str, DataFrame], regions: DataFrame | None,
                as_of=None, snapshot_date=None, select: Iterable[str] | None = None,
                cut_lineage: bool = True, scratch: str | None = None) -> dict[str, DataFrame]:
    """The gold metric frames from silver frames keyed by model name.

    The certificate x account frame (G1) and its holder dedup (G2) feed five
    outputs; with ``cut_lineage`` both are written once (to ``scratch``, else to
    the shared checkpoint folder) and the outputs read them back. G2 then ranks the
    stored G1, so certificates and accounts are joined once; a hot certificate
    sends one row per map task to the ranking. ``members`` needs the regions seed.
    """
    want = set(select or GOLD_TABLES)
    if "members" in want and regions is None:
        raise FileNotFoundError("members needs the regions seed")

    def stored(df, name):
        if not scratch:
            return materialize(df, name)
        df.write.parquet(f"{scratch}/{name}")
        return df.sparkSession.read.parquet(f"{scratch}/{name}")

    out: dict[str, DataFrame] = {}
    needs_g1 = want & {"baseline_certification", "coc_per_country", "fm_per_country",
                       "sites_with_identity", "issued_vs_terminations"}
    if needs_g1:
        args = (silver["account"], silver["country_data"], silver["certificate_c"],
                silver["recordtype"])
        g1 = gold.certificate_account_country(*args)
        if cut_lineage:
            g1 = stored(g1, "gold-g1")
            g2 = stored(gold.holder_preference_dedup(g1), "gold-g2")
        else:                     # skew-safe form; silver certificate ids are unique
            g2 = gold.certificate_holder(*args)
        if "baseline_certification" in want:
            out["baseline_certification"] = gold.baseline_certification(g2, as_of, snapshot_date)
        if "coc_per_country" in want:
            out["coc_per_country"] = gold.coc_per_country(g2, as_of, snapshot_date)
        if "fm_per_country" in want:
            out["fm_per_country"] = gold.fm_per_country(g2, as_of, snapshot_date)
        if "sites_with_identity" in want:
            out["sites_with_identity"] = gold.sites_with_identity(g1, as_of, snapshot_date)
        if "issued_vs_terminations" in want:
            out["issued_vs_terminations"] = gold.issued_vs_terminations(g1, snapshot_date)
    if "daily_certificate_numbers" in want:
        out["daily_certificate_numbers"] = gold.daily_certificate_numbers(
            silver["certificate_c"], silver["recordtype"], as_of, snapshot_date)
    if "daily_forest_areas" in want:
        out["daily_forest_areas"] = gold.daily_forest_areas(
            silver["certificate_c"], silver["recordtype"], as_of, snapshot_date)
    if "daily_headline" in want:
        out["daily_headline"] = gold.daily_headline(
            silver["non_certificate_holder"], silver["account"], as_of, snapshot_date)
    if "members" in want:
        out["members"] = gold.members(silver["account"], silver["country_data"], regions,
                                      snapshot_date)
    return out


def build_gold(spark: SparkSession, lake_root: str, snapshot_date=None, as_of=None,
               select: Iterable[str] | None = None, replace: bool = False,
               cut_lineage: bool = True, publish_to: str | None = None) -> dict[str, bool]:
    """Append today's (or ``snapshot_date``'s) snapshot of each gold table, then
    publish the layer if ``publish_to`` names a folder.

    Tables that already hold the date are skipped before any work is planned
    (first write wins) unless ``replace``. A missing silver table or seed is an
    error. The shared intermediates are removed after the run.
    """
    snap = snapshot_date or _dt.datetime.now(_dt.timezone.utc).date()
    root, tables = lake_root.rstrip("/"), list(select or GOLD_TABLES)
    todo = [t for t in tables if replace or not has_snapshot(spark, f"{root}/gold/{t}", snap)]
    done = dict.fromkeys(tables, False)
    if todo:
        names = ("account", "country_data", "certificate_c", "recordtype",
                 "non_certificate_holder")
        silver = {n: LakeTable.at(spark, lake_root, "silver", n).read() for n in names}
        regions_t = LakeTable.at(spark, lake_root, "gold", "regions")
        regions = regions_t.read() if "members" in todo else None
        scratch = scratch_path(spark, "gold")
        try:
            with short_lived_shuffles(spark):
                frames = gold_frames(silver, regions, as_of, snap, todo, cut_lineage, scratch)
                # dates were looked up above; append_snapshot need not do it again
                done.update(write_concurrently(
                    {t: (lambda t=t, df=df: append_snapshot(
                        spark, df, f"{root}/gold/{t}", snap, replace, known_absent=not replace))
                     for t, df in frames.items()}))
        finally:
            remove_path(spark, scratch)
    if publish_to:
        publish(spark, lake_root, "gold", publish_to)
    return done


def write_concurrently(tasks: dict[str, Callable[[], object]], workers: int = 4) -> dict:
    """Submit independent output jobs from a few driver threads, so small jobs
    overlap instead of leaving executors idle between them."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def publish(spark: SparkSession, lake_root: str, layer: str, dest_root: str,
            tables: Iterable[str] | None = None) -> list[str]:
    """Copy the current contents of every table of a layer to ``<dest>/<layer>/<table>/``,
    in the place of what was published before: a date or file that the table no longer has
    is gone. Dated gold tables keep their ``snapshot_date`` partitions. A table whose log
    counts no rows so far has no files; what was published of it goes, and it is not in
    the returned list.

    A table is written to a hidden folder beside its place and takes it by rename, so a
    run that fails leaves the earlier copy as it was. Each table is a folder of part files
    written by parallel tasks, not one object through one task.
    """
    names = list(tables) if tables is not None else \
        [r["table_name"] for r in list_tables(spark, lake_root, layer).collect()]
    done, base = [], f"{dest_root.rstrip('/')}/{layer}"
    for t in names:
        table = LakeTable.at(spark, lake_root, layer, t)
        if table.is_dated() and not table.log().agg(F.sum("rows")).first()[0]:
            remove_path(spark, f"{base}/{t}")     # by its log it never had a row
            continue
        df = table.read()
        staged = f"{base}/.staged-{t}-{uuid.uuid4().hex[:12]}"
        w = df.write
        if "snapshot_date" in df.columns:
            w = w.partitionBy("snapshot_date")
        try:
            w.parquet(staged)
            replace_path(spark, staged, f"{base}/{t}")
        finally:
            remove_path(spark, staged)
        done.append(t)
    return done
