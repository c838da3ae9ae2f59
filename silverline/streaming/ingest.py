"""Bronze changes fed into silver by Structured Streaming micro-batches.

The stream watches the bronze folders of both tables a resource model reads
(metadata and bodies).  Each micro-batch takes the resource ids it touched
and re-derives exactly those ids from the full bronze copy, then appends
the result (plus a delete marker for each id that is no longer in the
model) with the batch id.  Because the checkpoint, not a timestamp mark,
decides what is new, late rows and bodies that arrive after their metadata
are not missed, and a replayed batch re-derives the same rows (the reader
dedups by key, newest batch first).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.plans import silver
from silverline.operators.cdc import current_resources
from silverline.plans.incremental import (BATCH_ID, BROADCAST_DELTA_ROWS, DELETED, next_batch, read_model,
                                          store)
from silverline.session import scratch_dir
from silverline.sources.bronze import SCHEMAS, Bronze, read_bronze
from silverline.sources.fixtures import two_batch_resource


def _rederive(scoped: Bronze, name: str, current: DataFrame) -> DataFrame:
    """Model rows and delete markers for the ids in ``scoped`` (full history of those ids)."""
    res_type, id_col = silver.RESOURCE_MODELS[name]
    rows = silver.SILVER_BUILDERS[name](scoped, current)
    # ids of this type whose latest metadata no longer yields a model row
    typed = scoped.hfj_resource.where(F.col("res_type") == res_type) \
        .groupBy("res_id").agg(F.max("res_updated").alias("res_updated"))
    gone = typed.join(rows.select(F.col(id_col).alias("res_id")), "res_id", "left_anti")
    markers = gone.select(*[
        F.col("res_id").alias(f.name) if f.name == id_col else
        F.col("res_updated") if f.name == "res_updated" else
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in rows.schema.fields])
    return rows.withColumn(DELETED, F.lit(False)).unionByName(markers.withColumn(DELETED, F.lit(True)))


def ingest_models(spark: SparkSession, bronze_root: str, static: Bronze, targets: dict[str, str],
                  checkpoint: str, trigger: dict | None = None,
                  max_files_per_trigger: int = 1000,
                  after_batch: Callable[[], object] | None = None):
    """One stream keeping several resource models fresh; returns the ``StreamingQuery``.

    ``targets`` maps model name -> stored table path.  Each micro-batch
    scopes the bronze metadata to the ids it touched and joins their current
    bodies once for all target types (both persisted for the batch), then
    re-derives every model from them.  ``trigger`` defaults
    to ``{"availableNow": True}`` (drain what is there, then stop);
    ``{"processingTime": "1 minute"}`` matches the reference's schedule.
    ``after_batch`` runs once the batch is stored (a scheduled run that
    rebuilds the charts and compacts, see ``jobs.py``); no append of this
    stream is under way then.
    """
    def ids_of(table: str) -> DataFrame:
        return (spark.readStream.schema(SCHEMAS[table])
                .option("maxFilesPerTrigger", max_files_per_trigger)
                .parquet(f"{bronze_root}/{table}").select("res_id"))

    changes = ids_of("hfj_resource").unionByName(ids_of("hfj_res_ver"))

    types = [silver.RESOURCE_MODELS[name][0] for name in targets]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        ids = batch.distinct().persist()
        resource = current = None
        try:
            # a batch that touched at most BROADCAST_DELTA_ROWS ids is broadcast:
            # bronze metadata and bodies are then filtered map-side, not shuffled
            small = ids.count() <= BROADCAST_DELTA_ROWS
            resource = read_bronze(spark, bronze_root, "hfj_resource") \
                .join(F.broadcast(ids) if small else ids, "res_id", "left_semi").persist()
            res_ver = read_bronze(spark, bronze_root, "hfj_res_ver")
            current = current_resources(resource, res_ver, types, prefilter=True,
                                        broadcast_meta=small).persist()
            scoped = Bronze(resource, res_ver, static.hfj_res_link, static.hfj_spidx_token)
            for name, target in targets.items():
                # above every batch stored so far, by this stream or by a scheduled run;
                # a replayed batch re-derives its ids once more, under a later number
                stamp = next_batch(spark, target, 1)
                out = _rederive(scoped, name, current) \
                    .withColumn(BATCH_ID, F.lit(stamp).cast("bigint"))
                store(out, target, name, append=True, batch=stamp)
            if after_batch is not None:
                after_batch()
        finally:
            for df in (current, resource, ids):
                if df is not None:
                    df.unpersist()

    return (changes.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start())


def ingest_stream(spark: SparkSession, bronze_root: str, static: Bronze, name: str,
                  target_path: str, checkpoint: str, trigger: dict | None = None,
                  max_files_per_trigger: int = 1000):
    """R1 for a single model (see ``ingest_models``)."""
    return ingest_models(spark, bronze_root, static, {name: target_path}, checkpoint, trigger,
                         max_files_per_trigger)


def read_stream_model(spark: SparkSession, target_path: str, name: str) -> DataFrame:
    """R2: the model as of the last batch: newest batch per key wins."""
    return read_model(spark, target_path, name)


def two_batch_stream(spark: SparkSession, bronze: Bronze, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Feed the two-batch fixture through R1; the end state equals a full refresh.

    Two scheduled runs of one stream over the models ``names`` (all resource
    models): batch 1 lands and the stream drains it, then batch 2 lands and
    the stream (restarted from its checkpoint) drains the rest.
    """
    names = names or list(silver.RESOURCE_MODELS)
    root = scratch_dir(spark, "stream")
    bronze_root = f"{root}/bronze"
    tb = two_batch_resource(bronze)
    cols = SCHEMAS["hfj_resource"].fieldNames()
    bronze.hfj_res_ver.write.mode("overwrite").parquet(f"{bronze_root}/hfj_res_ver")
    for arrival in (1, 2):
        tb.where(F.col("arrival") == arrival).select(*cols) \
            .write.mode("append").parquet(f"{bronze_root}/hfj_resource")
        q = ingest_models(spark, bronze_root, bronze, {n: f"{root}/{n}" for n in names},
                          f"{root}/_checkpoint")
        q.awaitTermination()
    return {n: read_stream_model(spark, f"{root}/{n}", n) for n in names}
