"""Keeping silver fresh: K2-K4, C5-C7, C9 and the refresh of all models.

Reference semantics by default: append the rows whose version column is
strictly newer than the target's maximum (the high-water mark), first run
= full build, readers take the last version per key (``read_model`` with
``final=True``).  The known gaps of that rule (deletes after the first
load stay, late rows older than the mark are missed) are reproduced; C9
(``propagate_deletes=True``) closes the first one with delete markers.

Only the delta's keys are deduplicated: ``touched_since`` restricts the
bronze CDC copy to keys with a version newer than the mark before ``final``.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.operators.cdc import newer_than as cdc_newer_than
from silverline.operators.cdc import (BATCH_ID, BRONZE_ORDER, LINK_KEYS, RESOURCE_KEYS, TOMBSTONE, current_resources,
                                      deleted_keys, drop_tombstones, final_links, final_metadata,
                                      latest, live, touched_since)
from silverline.plans import silver
from silverline.session import scratch_dir
from silverline.sinks.tables import (append_table, current_version, list_names,
                                     partition_values, touch, write_table)
from silverline.sources.bronze import Bronze
from silverline.sources.fixtures import batch_view, source_state

DELETED = "_deleted"
# Every write job lands in its own ``_write_id=<uuid>`` folder of the table
# version, so a version with a single folder was written by one job (a full
# build or a compaction) and is unique per key: it is read without dedup.
WRITE_ID = "_write_id"
MARKS = "_marks"
INTERNAL = (BATCH_ID, DELETED, WRITE_ID)
EPOCH = dt.datetime(1970, 1, 1)
INCREMENTAL_MODELS = ("resource", "organizations", "encounters", "conditions", "observations",
                      "careplans", "res_link")


def version_column(name: str) -> str:
    return silver.VERSION_COLUMN.get(name, "res_updated")


def key_columns(name: str) -> list[str]:
    return silver.SORT_KEYS[name]


def mark_literal(mark) -> Column:
    """A mark as a typed literal, so the comparison is pushed into the scan."""
    if isinstance(mark, dt.datetime):
        return F.lit(mark.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(mark)


def high_water_mark(target: DataFrame, col: str):
    """``max(col)`` of the stored target (one value to the driver), epoch when empty."""
    mark = target.agg(F.max(col)).first()[0]
    return EPOCH if mark is None else mark


def newer_than(df: DataFrame, col: str, mark) -> DataFrame:
    """C5 with a Python mark (see ``cdc.newer_than``)."""
    return cdc_newer_than(df, col, mark_literal(mark))


def newer_by_type(marks: dict) -> Column:
    """Resource metadata above the mark of its own type's model; no mark: all rows of the type."""
    keep = F.lit(False)
    for name, (res_type, _) in silver.RESOURCE_MODELS.items():
        own = F.col("res_type") == res_type
        if marks.get(name) is not None:
            own = own & (F.col("res_updated") > mark_literal(marks[name]))
        keep = keep | own
    return keep


def read_version(spark: SparkSession, version: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored version; with a schema it may hold no file at all."""
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(version)


def build_full(b: Bronze, name: str, current: DataFrame | None = None,
               winners: DataFrame | None = None,
               link_winners: DataFrame | None = None) -> DataFrame:
    if name in silver.RESOURCE_MODELS:
        return silver.SILVER_BUILDERS[name](b, current)
    if name == "resource":
        return silver.resource(b, winners)
    if name == "res_link":
        return silver.res_link(b, link_winners)
    if name == "patients":
        return silver.patients(b, winners, link_winners)
    return silver.SILVER_BUILDERS[name](b)


def clustered_current(b: Bronze, name: str, current: DataFrame | None) -> DataFrame:
    """The current resources of a model's type in ranges of their id (K5).

    Spark computes the rows of a range shuffle twice, first to find the ranges:
    so it takes the bodies as they are, and they are parsed once, after it.
    """
    return silver.of_type(b, silver.RESOURCE_MODELS[name][0], current).repartitionByRange("res_id")


def touched_bronze(b: Bronze, name: str, mark) -> Bronze:
    """Bronze restricted to the keys with a version newer than ``mark`` (exact for the delta)."""
    if name == "res_link":
        return Bronze(b.hfj_resource, b.hfj_res_ver,
                      touched_since(b.hfj_res_link, LINK_KEYS, "sp_updated", mark_literal(mark),
                                    BROADCAST_DELTA_ROWS),
                      b.hfj_spidx_token)
    return Bronze(touched_since(b.hfj_resource, RESOURCE_KEYS, "res_updated", mark_literal(mark),
                                BROADCAST_DELTA_ROWS),
                  b.hfj_res_ver, b.hfj_res_link, b.hfj_spidx_token)


def build_delta(b: Bronze, name: str, mark, current: DataFrame | None = None,
                winners: DataFrame | None = None,
                link_winners: DataFrame | None = None) -> DataFrame:
    """Rows of model ``name`` whose version is newer than ``mark``.

    With the run's shared ``winners`` / ``link_winners`` / ``current`` the
    delta is a filter on them; without, only keys touched since the mark are
    deduplicated.  Either way the result equals the full build filtered by
    the mark.
    """
    shared = {"resource": winners, "res_link": link_winners}.get(name) \
        if name not in silver.RESOURCE_MODELS else current
    source = b if shared is not None else touched_bronze(b, name, mark)
    return newer_than(build_full(source, name, current, winners, link_winners),
                      version_column(name), mark)


def _stamp(df: DataFrame, batch_id: int, deleted: bool = False) -> DataFrame:
    return df.withColumn(BATCH_ID, F.lit(batch_id).cast("bigint")) \
             .withColumn(DELETED, F.lit(deleted))


def store(df: DataFrame, target_path: str, name: str, append: bool, mark=None, batch: int = 0,
          clustered: bool = False) -> str:
    """Write one job's rows (already stamped) into its own write folder.

    The folder's highest version is observed while the rows are written (no
    second pass) and, after the data commit, recorded in the name of an empty
    marker file (``_marks/<write id>-<epoch micros>-<batch>``), so the next
    run's high-water mark is a listing instead of a scan of the whole table.
    ``max`` is idempotent, so retried or speculative tasks cannot skew it.
    ``mark`` is one the table had before (a compaction drops delete markers):
    the recorded mark never falls below it.  A full build without any row
    still stores one empty file, so the table can be read.  ``clustered``: the
    rows are in ranges of the key already.
    """
    spark = df.sparkSession
    write_id = "w" + uuid.uuid4().hex
    seen = Observation(f"mark-{write_id}")
    rows = df.observe(seen, F.max(version_column(name)).alias("top")) \
             .withColumn(WRITE_ID, F.lit(write_id))
    # sorted by the write folder first, so the writer keeps the key order (K5)
    order = [WRITE_ID, *key_columns(name)]
    if append:
        version = append_table(rows, target_path, order, [WRITE_ID])
    else:
        version = write_table(rows, target_path, order, [WRITE_ID], range_partition=not clustered)
    if write_id in partition_values(spark, version, WRITE_ID):
        top = seen.get["top"]
    elif append:
        return version  # an empty append leaves nothing behind, and needs no marker
    else:
        df.limit(0).coalesce(1).write.mode("append").parquet(f"{version}/{WRITE_ID}={write_id}")
        top = None
    top = max((m for m in (top, mark) if m is not None), default=None)
    micros = "none" if top is None else str(_epoch_micros(top))
    touch(spark, f"{version}/{MARKS}/{write_id}-{micros}-{batch}")
    return version


def _epoch_micros(ts: dt.datetime) -> int:
    delta = ts - EPOCH
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def _from_micros(micros: int) -> dt.datetime:
    return EPOCH + dt.timedelta(microseconds=micros)


def _markers_of(spark: SparkSession, version: str) -> dict[str, tuple[str, int]]:
    """write id -> (mark in micros or ``none``, batch id)."""
    out = {}
    for entry in list_names(spark, f"{version}/{MARKS}"):
        write_id, value, batch = entry.split("-", 2)
        out[write_id] = (value, int(batch))
    return out


def recorded_mark(spark: SparkSession, version: str):
    """The mark from the marker files, or ``...`` when a write folder has none."""
    writes = partition_values(spark, version, WRITE_ID)
    marks = _markers_of(spark, version)
    if any(w not in marks for w in writes):
        return ...
    values = [_from_micros(int(v)) for v, _ in marks.values() if v != "none"]
    return max(values) if values else EPOCH


def next_batch(spark: SparkSession, target_path: str, at_least: int = 0) -> int:
    """One sequence of batch ids for all jobs that write a table: above every stored one."""
    version = current_version(spark, target_path)
    used = [b for _, b in _markers_of(spark, version).values()] if version else []
    return max([at_least, *(b + 1 for b in used)])


def write_jobs(spark: SparkSession, version: str) -> int:
    return len(partition_values(spark, version, WRITE_ID))


def gone_keys(b: Bronze, name: str, mark, winners: DataFrame | None = None,
              link_winners: DataFrame | None = None, gone: DataFrame | None = None) -> DataFrame:
    """Key and version columns of the rows of ``name`` that left it after ``mark``.

    ``resource`` and ``res_link`` lose a key to a tombstone; a resource model
    also to a soft delete or a tombstoned body (``gone``: these for all
    types, computed once a run).
    """
    if name == "res_link":
        if link_winners is None:
            link_winners = latest(touched_bronze(b, name, mark).hfj_res_link, LINK_KEYS, BRONZE_ORDER)
        dead = link_winners.where(F.col(TOMBSTONE) != 0)
        return newer_than(dead, "sp_updated", mark).select(*key_columns(name), "sp_updated")
    if name == "resource":
        if winners is None:
            winners = final_metadata(touched_bronze(b, name, mark).hfj_resource)
        return newer_than(winners.where(F.col(TOMBSTONE) != 0), "res_updated", mark).select(
            *key_columns(name), "res_updated")
    res_type, id_col = silver.RESOURCE_MODELS[name]
    if gone is None:
        gone = deleted_keys(b.hfj_resource, b.hfj_res_ver, res_type, mark_literal(mark), winners,
                            BROADCAST_DELTA_ROWS)
    else:
        gone = newer_than(gone.where(F.col("res_type") == res_type), "res_updated", mark)
    return gone.select(F.col("res_id").alias(id_col), "res_updated")


def _markers(like: DataFrame, gone: DataFrame, batch_id: int) -> DataFrame:
    """One delete marker for each gone key."""
    return _stamp(gone.select(*[
        F.col(f.name) if f.name in gone.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in like.schema.fields]), batch_id, deleted=True)


def stored_mark(spark: SparkSession, name: str, target_path: str, full_refresh: bool = False):
    """The target's high-water mark, or None when this run is a full build (K3/K4).

    Taken from the write folders' marker files when every folder has one,
    else by scanning the version column (S6).
    """
    version = None if full_refresh else current_version(spark, target_path)
    if version is None:
        return None
    mark = recorded_mark(spark, version)
    if mark is ...:
        field = T.StructType([T.StructField(version_column(name), T.TimestampNTZType())])
        mark = high_water_mark(read_version(spark, version, field), version_column(name))
    return mark


def append_delta(b: Bronze, name: str, target_path: str, batch_id: int,
                 full_refresh: bool = False, propagate_deletes: bool = False,
                 current: DataFrame | None = None, mark=...,
                 winners: DataFrame | None = None,
                 link_winners: DataFrame | None = None,
                 gone: DataFrame | None = None) -> DataFrame:
    """K2/K3/K4 (+C9): refresh one incremental model stored at ``target_path``.

    Returns the rows written in this run (read back from storage).
    """
    spark = b.hfj_resource.sparkSession
    if mark is ...:
        mark = stored_mark(spark, name, target_path, full_refresh)
    batch_id = next_batch(spark, target_path, batch_id)
    if mark is None:
        by_id = name in silver.RESOURCE_MODELS
        rows = _stamp(build_full(b, name, clustered_current(b, name, current) if by_id else current,
                                 winners, link_winners), batch_id)
        version = store(rows, target_path, name, False, batch=batch_id, clustered=by_id)
    else:
        like = build_full(b, name, current, winners, link_winners)
        rows = _stamp(build_delta(b, name, mark, current, winners, link_winners), batch_id)
        if propagate_deletes:
            rows = rows.unionByName(_markers(
                like, gone_keys(b, name, mark, winners, link_winners, gone), batch_id))
        version = store(rows, target_path, name, True, batch=batch_id)
    return read_version(spark, version, rows.schema).where(F.col(BATCH_ID) == batch_id)


def final_rows(stored: DataFrame, keys: Sequence[str], version: str,
               batch_first: bool = False) -> DataFrame:
    """Merge-on-read of appended batches: last row per key, delete markers dropped."""
    order = [F.col(BATCH_ID).desc(), F.col(version).desc()] if batch_first else \
        [F.col(version).desc(), F.col(BATCH_ID).desc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    picked = stored.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return live_rows(picked)


def live_rows(stored: DataFrame) -> DataFrame:
    """Drop delete markers and the bookkeeping columns."""
    if DELETED in stored.columns:
        stored = stored.where(~F.col(DELETED))
    return stored.drop(*INTERNAL)


def read_model(spark: SparkSession, target_path: str, name: str, final: bool = True) -> DataFrame:
    """Read a stored model; ``final=True`` gives the last row per key (``FINAL``).

    A version written by a single job is unique per key already and is read
    as is; otherwise C6 merge-on-read picks the row of the last batch per key.
    Batches of all jobs share one sequence (``next_batch``): a scheduled run
    only appends versions above the mark, and a micro-batch re-derives its
    keys from the whole bronze copy, so the last batch is the newest state.
    """
    version = current_version(spark, target_path)
    if version is None:
        raise FileNotFoundError(f"no committed version under {target_path}")
    stored = spark.read.parquet(version)
    if not final or BATCH_ID not in stored.columns:
        return stored
    if write_jobs(spark, version) <= 1:
        return live_rows(stored)
    return final_rows(stored, key_columns(name), version_column(name), batch_first=True)


def compact(spark: SparkSession, target_path: str, name: str) -> str:
    """Rewrite a stored model as its final rows (a new version; equals ``read_model``).

    Delete markers go, but the mark and the batch sequence stay what they
    were, so later runs append the same rows as without a compaction.
    """
    mark = stored_mark(spark, name, target_path)
    batch = next_batch(spark, target_path) - 1
    compacted = read_model(spark, target_path, name)
    return store(_stamp(compacted, batch), target_path, name, append=False, mark=mark, batch=batch)


# ---- the two-batch fixture (FIXTURES.md section 4) --------------------------

def two_batch_query(spark: SparkSession, bronze: Bronze, what: str) -> DataFrame:
    """Run the two-batch scenario for ``encounters`` and return one of its tables."""
    name = "encounters"
    root = scratch_dir(spark, f"two-batch-{what}")
    target = f"{root}/{name}"
    b1, b2 = batch_view(bronze, 1), batch_view(bronze, 2)
    append_delta(b1, name, target, batch_id=1)
    if what == "full_refresh":
        append_delta(b2, name, target, batch_id=2, full_refresh=True)
        return read_model(spark, target, name)
    if what == "compacted_then_next_batch":
        append_delta(batch_view(bronze, 2, late=True), name, target, batch_id=2, propagate_deletes=True)
        compact(spark, target, name)
        append_delta(batch_view(bronze, 3, late=True), name, target, batch_id=3, propagate_deletes=True)
        return read_model(spark, target, name)
    delta = append_delta(b2, name, target, batch_id=2,
                         propagate_deletes=(what == "propagated_deletes"))
    if what == "high_water_delta":
        return delta.drop(*INTERNAL)
    if what == "compacted":
        version = compact(spark, target, name)
        return spark.read.parquet(version).drop(*INTERNAL)
    return read_model(spark, target, name)


_REFRESHED: dict[tuple, dict[str, str]] = {}


def two_batch_refresh(spark: SparkSession, bronze: Bronze, source: str, name: str,
                      propagate_deletes: bool = False) -> DataFrame:
    """Model ``name`` after two scheduled runs over every type and link (``refresh_all``).

    One pair of runs serves all models, for a session and the files of ``source`` as they are.
    """
    key = (spark.sparkContext.applicationId, source_state(spark, source), propagate_deletes)
    if key not in _REFRESHED:
        root = scratch_dir(spark, "two-batch-refresh")
        refresh_all(spark, batch_view(bronze, 1), root, batch_id=1, propagate_deletes=propagate_deletes)
        _REFRESHED[key] = refresh_all(spark, batch_view(bronze, 2), root, batch_id=2,
                                      propagate_deletes=propagate_deletes)
    path = _REFRESHED[key][name]
    return read_model(spark, path, name)


# ---- one refresh of every model --------------------------------------------

class _Clock:
    """Optional wall-clock seconds per refresh step (for the bench)."""

    def __init__(self, sink: dict[str, float] | None):
        self.sink = sink

    @contextmanager
    def __call__(self, step: str):
        start = time.perf_counter()
        yield
        if self.sink is not None:
            self.sink[step] = round(time.perf_counter() - start, 3)


# Largest metadata delta (rows) broadcast to filter the JSON bodies map-side:
# five narrow columns, about 50 MB at this bound.
BROADCAST_DELTA_ROWS = 1_000_000


def shared_current(spark: SparkSession, bronze: Bronze, winners: DataFrame, marks: dict,
                   root: str, broadcast_rows: int = BROADCAST_DELTA_ROWS) -> DataFrame:
    """C8 once for all five resource models, stored partitioned by ``res_type``.

    With marks (an incremental run) only winners newer than the mark of their
    own type's model are joined to their bodies (a type without a mark takes
    all of its rows), and the bodies are pre-filtered to those keys.  The
    delta is counted first (a scan of the stored winners with the marks
    pushed down); when it is at most ``broadcast_rows`` it is broadcast, so
    the body table is only scanned and filtered map-side, never shuffled
    whole.  Otherwise the join shuffles both sides.  Storing the result cuts
    the lineage and lets each model read just its type's partition.
    """
    incremental = any(marks[n] is not None for n in silver.RESOURCE_MODELS)
    broadcast = False
    if incremental:
        winners = live(drop_tombstones(winners.where(newer_by_type(marks))))
        broadcast = winners.count() <= broadcast_rows
    current = current_resources(bronze.hfj_resource, bronze.hfj_res_ver, winners=winners,
                                prefilter=incremental, broadcast_meta=broadcast)
    version = write_table(current, root, partition_by=["res_type"])
    return read_version(spark, version, current.schema)


def run_all(tasks: dict[str, Callable[[], object]], parallel: int, clock: _Clock | None = None) -> dict:
    """Run independent Spark jobs from a thread pool (each job is still distributed)."""
    clock = clock or _Clock(None)

    def timed(name):
        with clock(name):
            return tasks[name]()
    if parallel <= 1:
        return {name: timed(name) for name in tasks}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = {name: pool.submit(timed, name) for name in tasks}
        return {name: f.result() for name, f in futures.items()}


def refresh_all(spark: SparkSession, bronze: Bronze, silver_root: str, batch_id: int,
                full_refresh: bool = False, propagate_deletes: bool = False,
                compact_after: int | None = 8, names: dict[str, str] | None = None,
                parallel_jobs: int = 4,
                timings: dict[str, float] | None = None,
                bronze_root: str | None = None) -> dict[str, str]:
    """One scheduled run: incremental silver models, then full rebuild of the rest.

    With ``bronze_root`` (the folder that ``bronze`` was read from) the winners
    of metadata and links are kept (``plans.kept``): the run folds in the new
    files instead of computing FINAL of the whole copies.

    Returns model name -> stored table path.  ``names`` overrides the stored
    name of a model (K6).  An incremental table that has collected
    ``compact_after`` write jobs is compacted (C7) after its append, so chart
    reads stay single-pass.  Charts read silver through
    ``read_model(final=True)``.  Independent writes are submitted
    ``parallel_jobs`` at a time.
    """
    from silverline.plans.models import CHART_MODELS, CHART_SORT_KEYS, Models

    clock = _Clock(timings)
    names = names or {}
    paths = {name: f"{silver_root}/{names.get(name, name)}" for name in
             (*INCREMENTAL_MODELS, "patients", *CHART_MODELS)}
    marks = run_all({f"mark:{name}": (lambda n=name: stored_mark(spark, n, paths[n], full_refresh))
                     for name in INCREMENTAL_MODELS}, parallel_jobs)
    marks = {name: marks[f"mark:{name}"] for name in INCREMENTAL_MODELS}
    # one dedup of the bronze metadata and of the links per run, shared by every consumer
    def winners_of(frame: DataFrame, folder: str) -> DataFrame:
        return read_version(spark, write_table(frame, f"{silver_root}/{folder}"), frame.schema)

    def kept_winners(table: str) -> DataFrame:
        from silverline.plans.kept import BUCKET, Kept

        state = Kept(f"{silver_root}/_kept/{table}", table)
        state.fold_new(spark, bronze_root)
        return state.winners(spark).drop(BUCKET)

    if bronze_root is not None:
        finals = {"final_metadata": lambda: kept_winners("hfj_resource"),
                  "final_links": lambda: kept_winners("hfj_res_link")}
    else:
        finals = {"final_metadata": lambda: winners_of(final_metadata(bronze.hfj_resource), "_final_metadata"),
                  "final_links": lambda: winners_of(final_links(bronze.hfj_res_link), "_final_links")}
    shared = run_all(finals, parallel_jobs, clock)
    winners, link_winners = shared["final_metadata"], shared["final_links"]
    with clock("current_resources"):
        current = shared_current(spark, bronze, winners, marks, f"{silver_root}/_current")
    gone = None
    if propagate_deletes and any(marks[n] is not None for n in silver.RESOURCE_MODELS):
        with clock("gone"):  # C9 once for all types
            changed = winners.where(newer_by_type(marks))
            gone = winners_of(deleted_keys(bronze.hfj_resource, bronze.hfj_res_ver, None, winners=changed,
                                           broadcast_rows=BROADCAST_DELTA_ROWS), "_gone")

    def refresh_one(name: str) -> None:
        append_delta(bronze, name, paths[name], batch_id, propagate_deletes=propagate_deletes,
                     current=current if name in silver.RESOURCE_MODELS else None, mark=marks[name],
                     winners=winners, link_winners=link_winners, gone=gone)
        version = current_version(spark, paths[name])
        if compact_after and write_jobs(spark, version) >= compact_after:
            compact(spark, paths[name], name)

    silver_tasks: dict[str, Callable[[], object]] = {
        name: (lambda n=name: refresh_one(n)) for name in INCREMENTAL_MODELS}
    silver_tasks["patients"] = lambda: write_table(
        silver.patients(bronze, winners, link_winners), paths["patients"], key_columns("patients"))
    # charts that read bronze only are built alongside the silver models
    bronze_only = [name for name, (_, inputs) in CHART_MODELS.items()
                   if all(i.startswith("@") and i != "@bronze_live" for i in inputs)]
    bronze_models = Models(bronze)
    for name in bronze_only:
        silver_tasks[name] = lambda n=name: write_table(bronze_models[n], paths[n], CHART_SORT_KEYS[n])
    run_all(silver_tasks, parallel_jobs, clock)

    # Charts read silver straight from Parquet (column pruning per chart).  A
    # table holding several write jobs needs merge-on-read; that one is
    # deduplicated once and stored for the charts sharing it: a cached copy keeps
    # every column of every such table in the executors, in partitions AQE does not join.
    needed = sorted({i for _, inputs in CHART_MODELS.values() for i in inputs
                     if not i.startswith("@")})
    inputs = {name: read_model(spark, paths[name], name) for name in needed}
    merged = [name for name in needed if name in INCREMENTAL_MODELS
              and write_jobs(spark, current_version(spark, paths[name])) > 1]
    inputs.update(run_all({name: (lambda n=name: winners_of(inputs[n], f"_merged/{n}")) for name in merged},
                          parallel_jobs))
    models = Models(bronze, silver_source=inputs.__getitem__, winners=winners)
    run_all({name: (lambda n=name: write_table(models[n], paths[n], CHART_SORT_KEYS[n]))
             for name in CHART_MODELS if name not in bronze_only}, parallel_jobs, clock)
    return paths
