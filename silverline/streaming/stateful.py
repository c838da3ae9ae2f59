"""R1/R2 with kept state: current resources from changes alone, no bronze re-read.

One stateful operator sees metadata and bodies as they land.  Resources are
kept in groups of ``SPAN`` neighbouring ids, so a call of the operator, whose
cost hardly depends on its rows, serves many of them, and a group's state
stays bounded however many groups there are.  State (RocksDB, below the
checkpoint; one of an earlier layout, by id or as JSON, is not read) holds of
each resource the winning metadata version and the bodies of that version or
newer ones, as one compressed Arrow batch a group.  A micro-batch emits a
resource whose current row has changed, or that it is gone; it reads neither
stored bodies nor stored metadata.  A body that lands after its metadata is
joined when it lands, a delete and an undelete are just further winners.

Lateness (R2): metadata whose ``res_updated`` lies more than ``bound`` behind
the newest of the micro-batches before (Spark's watermark) is not folded in;
it is stored in a table of late rows.  Bodies carry no event time and are
never late.

Semantics: highest CDC version wins, on equal ones a tombstone; a resource is
current if its winner is neither a tombstone nor soft-deleted and the winning
body of its version is there and not tombstoned.  Versions of a resource count
up, so bodies older than the winner's version are let go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from silverline.plans import silver
from silverline.plans.incremental import BATCH_ID, DELETED, next_batch, read_model, run_all, store
from silverline.session import scratch_dir
from silverline.sinks.tables import folder_bytes
from silverline.sources.bronze import SCHEMAS, Bronze
from silverline.sources.fixtures import two_batch_resource

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Longer than any clock: nothing is late.
NO_BOUND = "36500 days"
#: Ids of one group of the state: at most so many resources, that are written anew when one of them changes.
SPAN = 2048
#: Landed bytes (compressed) for one partition of a new stream's state.
STATE_PARTITION_BYTES = 32 << 20
#: Rows a group keeps, columns of what lands as well (but ``shown_cdc``); numbers all, none of them null.
NUMBERS = ("res_id", "flags", "res_ver", "published", "updated", "deleted_at", "cdc", "tombstone")
#: Bits of ``flags``: a row of metadata, of a null id, of a null version; metadata whose resource was last shown as
#: current.  Above them the place of the type in ``KINDS``.
META, NO_ID, NO_VERSION, SHOWN, KIND_BITS = 1, 2, 4, 8, 4
#: Places are kept in states: new types go to the end.
KINDS = [res_type for res_type, _ in silver.RESOURCE_MODELS.values()]
CURRENT, GONE, LATE = 0, 1, 2
#: A row of the operator's output, whose cost hardly depends on what it holds, holds several changes: of each the
#: numbers and what it is, one after the other, and its body.  At most so many, and bodies of so many bytes.
CHANGES = "numbers array<bigint>, res_text_vc array<string>"
PIECE_ROWS, PIECE_BYTES = 16, 6400


def folder():
    """The state's update, as a function of its own (workers need not find this package)."""
    numbers, in_state = list(NUMBERS), [*NUMBERS, "shown_cdc"]
    piece_rows, piece_bytes = PIECE_ROWS, PIECE_BYTES

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Fold a group's new rows into those it keeps; what changed, and rows that are too late.

        Kept are the winning metadata of each id and the bodies of its version
        or newer ones, by id, metadata first, then by version.  All ids of the
        group are folded at once, in arrays.
        """
        import numpy as np
        import pyarrow as pa

        frames = list(frames)
        landed = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        rows = {c: landed[c].to_numpy() for c in numbers}
        rows["shown_cdc"] = np.zeros(len(landed), np.int64)
        text = pa.array(landed["res_text_vc"], pa.large_string(), from_pandas=True)
        n_kept = 0
        if state.exists:
            kept = pa.ipc.open_stream(state.get[0]).read_next_batch()
            n_kept = len(kept)
            rows = {c: np.concatenate([kept.column(c).to_numpy(), rows[c]]) for c in in_state}
            text = pa.concat_arrays([kept.column("res_text_vc"), text])
        rid, flags, ver, cdc, tombstone = (rows[c] for c in ("res_id", "flags", "res_ver", "cdc", "tombstone"))
        is_meta = flags & META != 0
        late = is_meta & (rows["updated"] // 1000 < state.getCurrentWatermarkMs())
        late[:n_kept] = False

        # the highest CDC version first, on equal ones a tombstone, on equal rows the one kept (the sort is stable)
        at = np.flatnonzero(~late)
        at = at[np.lexsort((~tombstone[at], ~cdc[at], np.where(is_meta, 0, ver)[at], ~is_meta[at], rid[at]))]
        r, m, v = rid[at], is_meta[at], ver[at]
        new_id = np.append(True, r[1:] != r[:-1])[:len(at)]
        winner = new_id | np.append(True, (m[1:] != m[:-1]) | ~m[1:] & (v[1:] != v[:-1]))[:len(at)]
        at, m, v, new_id = at[winner], m[winner], v[winner], new_id[winner]

        head = np.flatnonzero(new_id)[np.cumsum(new_id) - 1]  # the id's first row: its metadata, if there is any
        versioned = m[head] & (flags[at[head]] & NO_VERSION == 0)
        own = ~m & versioned & (v == v[head])
        body = np.full(len(at), -1)
        body[head[own]] = at[own]
        meta, body = at[m], body[m]
        current = (tombstone[meta] == 0) & (rows["deleted_at"][meta] == 0) & (body >= 0)
        current[current] = tombstone[body[current]] == 0
        body_cdc = np.zeros(len(meta), np.int64)
        body_cdc[current] = cdc[body[current]]

        # what was shown of an id before stands at its kept metadata
        before = np.flatnonzero(is_meta[:n_kept])
        was = np.zeros(len(meta), bool)
        same = was.copy()
        if len(before):
            place = np.minimum(np.searchsorted(rid[before], rid[meta]), len(before) - 1)
            before = before[place]
            was = (rid[before] == rid[meta]) & (flags[before] & SHOWN != 0)
            same = was & (meta < n_kept) & (rows["shown_cdc"][before] == body_cdc)
        shown, gone = current & ~same, was & ~current
        flags[meta] = flags[meta] & ~SHOWN | np.where(current, SHOWN, 0)
        rows["shown_cdc"][meta] = body_cdc

        at = at[m | ~versioned | (v >= v[head])]
        keep = pa.record_batch([*[pa.array(rows[c][at]) for c in in_state], text.take(pa.array(at))],
                               names=[*in_state, "res_text_vc"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, keep.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(keep)
        state.update((sink.getvalue().to_pybytes(),))

        parts = [meta[shown], meta[gone], np.flatnonzero(late)]
        at, what = np.concatenate(parts), np.repeat([CURRENT, GONE, LATE], [len(p) for p in parts])
        values = np.column_stack([*[rows[c][at] for c in numbers], what])
        bodies = text.take(pa.array(body[shown]))
        texts = bodies.to_numpy(zero_copy_only=False).tolist() + [None] * (len(at) - len(bodies))
        step = max(1, min(piece_rows, piece_bytes * len(bodies) // max(1, bodies.nbytes)))
        pieces = range(0, len(at), step)
        yield pd.DataFrame({"numbers": [values[k:k + step].ravel().tolist() for k in pieces],
                            "res_text_vc": [texts[k:k + step] for k in pieces]})

    return fold


def changes(spark: SparkSession, bronze_root: str, types: list[str], bound: str = NO_BOUND,
            max_files_per_trigger: int = 1000) -> DataFrame:
    """The stream of changes of current resources (``what``: current, gone or late)."""
    def landed(table: str) -> DataFrame:
        return (spark.readStream.schema(SCHEMAS[table]).option("maxFilesPerTrigger", max_files_per_trigger)
                .parquet(f"{bronze_root}/{table}"))

    def micros(c: str):
        return F.coalesce(F.unix_micros(F.col(c).cast("timestamp")), F.lit(0)).alias

    def number(c: str):
        return F.coalesce(F.col(c).cast("long"), F.lit(0))

    def bit(condition, value: int):
        return F.when(condition, value).otherwise(0)

    span = F.expr(f"res_id div {SPAN}").alias("span")
    rest = [number("res_ver").alias("res_ver"), number("_peerdb_version").alias("cdc"),
            number("_peerdb_is_deleted").alias("tombstone")]
    no_id = bit(F.col("res_id").isNull(), NO_ID)
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("res_type")) - 1
    meta = landed("hfj_resource").where(F.col("res_type").isin(*types)).select(
        span, number("res_id").alias("res_id"),
        (F.lit(META) + no_id + bit(F.col("res_ver").isNull(), NO_VERSION) + F.shiftleft(kind, KIND_BITS)).alias("flags"),
        micros("res_published")("published"), micros("res_updated")("updated"), micros("res_deleted_at")("deleted_at"),
        *rest, F.lit(None).cast("string").alias("res_text_vc"), F.col("res_updated").cast("timestamp").alias("event"))
    zero = F.lit(0).cast("long")
    # a body of no version is never anyone's current one
    bodies = landed("hfj_res_ver").where(F.col("res_ver").isNotNull()).select(
        span, number("res_id").alias("res_id"), no_id.cast("long").alias("flags"),
        zero.alias("published"), zero.alias("updated"), zero.alias("deleted_at"),
        *rest, "res_text_vc", F.lit(None).cast("timestamp").alias("event"))
    changed = (meta.unionByName(bodies).withWatermark("event", bound).groupBy("span")
               .applyInPandasWithState(folder(), CHANGES, "kept binary", "append", GroupStateTimeout.NoTimeout))

    changed = changed.select("numbers", F.posexplode("res_text_vc").alias("at", "res_text_vc"))
    value = {c: F.get("numbers", F.col("at") * (len(NUMBERS) + 1) + k) for k, c in enumerate([*NUMBERS, "what"])}

    def unless(null: int, c: str):
        return F.when(value["flags"].bitwiseAND(null) == 0, value[c]).alias(c)

    return changed.select(
        unless(NO_ID, "res_id"),
        F.element_at(F.array(*map(F.lit, KINDS)), (F.shiftright(value["flags"], KIND_BITS) + 1).cast("int")).alias("res_type"),
        unless(NO_VERSION, "res_ver"), *[value[c].alias(c) for c in ("published", "updated", "deleted_at", "cdc", "tombstone")],
        "res_text_vc", F.element_at(F.array(F.lit("current"), F.lit("gone"), F.lit("late")),
                                    (value["what"] + 1).cast("int")).alias("what"))


def state_partitions(spark: SparkSession, bronze_root: str) -> int:
    """Partitions of a new stream's state: by what has landed, one for each core at least, the session's at most.

    Each costs a store to open and commit and a Python worker in every
    micro-batch, whatever it holds.  A stream that has a checkpoint keeps its
    own number.
    """
    landed = sum(folder_bytes(spark, f"{bronze_root}/{t}") for t in ("hfj_resource", "hfj_res_ver"))
    wanted = max(spark.sparkContext.defaultParallelism, -(-landed // STATE_PARTITION_BYTES))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


def _timestamp(c: str):
    return F.timestamp_micros(c).cast("timestamp_ntz")


def ingest_changes(spark: SparkSession, bronze_root: str, targets: dict[str, str], late_path: str, checkpoint: str,
                   bound: str = NO_BOUND, trigger: dict | None = None,
                   after_batch: Callable[[], object] | None = None):
    """Keep the resource models ``targets`` (name -> stored path) and the late rows fresh; the ``StreamingQuery``.

    Each micro-batch appends changed rows and delete markers to each model
    (read back by ``read_model``) and writes its late rows as one folder of
    ``late_path``, which a replay of the batch replaces.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    types = [silver.RESOURCE_MODELS[name][0] for name in targets]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        partitions = batch.rdd.getNumPartitions()
        try:
            stamped = batch.select("res_id", "res_type", "res_ver", _timestamp("published").alias("res_published"),
                                   _timestamp("updated").alias("res_updated"),
                                   _timestamp("deleted_at").alias("res_deleted_at"),
                                   F.col("cdc").alias("_peerdb_version"), F.col("tombstone").alias("_peerdb_is_deleted"),
                                   "res_text_vc", "what")
            stamped.where("what = 'late'").drop("res_text_vc", "what") \
                .write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")

            def store_changes(name: str, target: str) -> None:
                res_type, id_col = silver.RESOURCE_MODELS[name]
                mine = stamped.where(F.col("res_type") == res_type)
                rows = silver.SILVER_BUILDERS[name](None, mine.where("what = 'current'"))
                gone = mine.where("what = 'gone'").select(*[
                    F.col("res_id").alias(f.name) if f.name == id_col else
                    F.col("res_updated") if f.name == "res_updated" else F.lit(None).cast(f.dataType).alias(f.name)
                    for f in rows.schema.fields])
                stamp = next_batch(spark, target, 1)
                # one task (and file) for both kinds of rows of a partition of the batch, not one each
                store(rows.withColumn(DELETED, F.lit(False)).unionByName(gone.withColumn(DELETED, F.lit(True)))
                      .withColumn(BATCH_ID, F.lit(stamp).cast("bigint")).coalesce(partitions),
                      target, name, append=True, batch=stamp)

            # the batch is kept by now: each model filters it, writing a table of its own
            run_all({name: (lambda n=name, t=target: store_changes(n, t)) for name, target in targets.items()},
                    len(targets))
            if after_batch is not None:
                after_batch()
        finally:
            batch.unpersist()

    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions(spark, bronze_root)))
    try:  # a query takes the session's settings as they are when it starts
        return (changes(spark, bronze_root, types, bound).writeStream.foreachBatch(write_batch)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)


def read_late(spark: SparkSession, late_path: str) -> DataFrame:
    """Rows that came later than the bound."""
    return spark.read.parquet(late_path).drop("batch")


def late_body_stream(spark: SparkSession, bronze: Bronze, names: list[str] | None = None,
                     bound: str = NO_BOUND) -> tuple[dict[str, str], str]:
    """The two-batch fixture with late bodies: stored models (name -> path) and the late rows' path.

    Batch 1 lands metadata, and the bodies of two thirds of the ids; batch 2
    the rest of both.  The stream is run for each, from one checkpoint.
    """
    names = names or list(silver.RESOURCE_MODELS)
    root = scratch_dir(spark, "stateful-stream")
    landed = two_batch_resource(bronze)
    columns = SCHEMAS["hfj_resource"].fieldNames()
    targets = {n: f"{root}/{n}" for n in names}
    for arrival in (1, 2):
        held = F.col("res_id") % 3 == 1
        arrived = {"hfj_resource": landed.where(F.col("arrival") == arrival).select(*columns),
                   "hfj_res_ver": bronze.hfj_res_ver.where(~held if arrival == 1 else held)}
        run_all({table: (lambda t=table, rows=rows: rows.write.mode("append").parquet(f"{root}/bronze/{t}"))
                 for table, rows in arrived.items()}, len(arrived))
        ingest_changes(spark, f"{root}/bronze", targets, f"{root}/late", f"{root}/_checkpoint", bound).awaitTermination()
    return targets, f"{root}/late"


def read_stream(spark: SparkSession, targets: dict[str, str], name: str) -> DataFrame:
    return read_model(spark, targets[name], name)
