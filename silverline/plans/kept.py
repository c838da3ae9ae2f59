"""C1/C5/C6 with kept state: FINAL as a table in hash buckets, fed by the files that are new.

``refresh_all`` computes FINAL of the whole bronze copy each run.  Here the
winners are kept: Spark's file source remembers, in its checkpoint, which
bronze files it has given out (C5 as an exact ingest mark: late, equal and
replayed rows are seen like any others), and a run folds just the new ones in.

1. the new rows' keys are looked up in the buckets they fall into (the others
   are not read), and the changes, each with the winner before and after, are
   stored as one folder of the batch;
2. the touched buckets are written anew from the stored changes (dynamic
   partition overwrite); the other buckets' files stay.

A replayed batch finds its stored changes and only repeats step 2, which gives
the same rows.  If the driver is lost inside step 2, buckets may be missing:
the ``_open`` mark it left makes the next run start a new generation from
bronze.  ``maintained_counts`` carries chart counts on from the changes: the
row before counts -1, the row after +1.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.functions.scalars import to_date_of
from silverline.operators.cdc import BRONZE_ORDER, LINK_KEYS, RESOURCE_KEYS, TOMBSTONE, is_deleted, latest
from silverline.operators.links import ENCOUNTER_SUBJECT
from silverline.plans import silver
from silverline.plans.incremental import BROADCAST_DELTA_ROWS
from silverline.session import scratch_dir
from silverline.sinks.tables import list_names, path_exists, read_table, remove, touch, write_table
from silverline.sources.bronze import SCHEMAS, Bronze
from silverline.sources.fixtures import two_batch_link, two_batch_resource

BUCKET = "_bucket"
KEYS = {"hfj_resource": RESOURCE_KEYS, "hfj_res_link": LINK_KEYS}


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Keys agree (a null agrees with a null, as in a window's partitions)."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return on


@dataclass(frozen=True)
class Kept:
    """The kept winners of one bronze table below ``root``."""

    root: str
    table: str
    buckets: int = 64

    @property
    def keys(self) -> Sequence[str]:
        return KEYS[self.table]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*SCHEMAS[self.table].fields, T.StructField(BUCKET, T.IntegerType())])

    def _generation(self, spark: SparkSession) -> str:
        """The newest generation's folder; one left open by a lost driver is given up."""
        known = sorted(int(n[4:]) for n in list_names(spark, self.root) if n.startswith("gen-"))
        if known and not path_exists(spark, f"{self.root}/gen-{known[-1]}/_open"):
            return f"{self.root}/gen-{known[-1]}"
        return f"{self.root}/gen-{known[-1] + 1 if known else 0}"

    def winners(self, spark: SparkSession, generation: str | None = None) -> DataFrame:
        """FINAL, tombstoned winners included: unique by key, read without a dedup."""
        state = f"{generation or self._generation(spark)}/state"
        if not path_exists(spark, state):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(state)

    def changes(self, spark: SparkSession, batch: str | list[str]) -> DataFrame:
        """``before, after`` (structs of the table's columns; no row before: null) of folders that :meth:`fold_new` names."""
        row = T.StructType(SCHEMAS[self.table].fields)
        schema = T.StructType([T.StructField("before", row), T.StructField("after", row),
                               T.StructField(BUCKET, T.IntegerType())])
        folders = [batch] if isinstance(batch, str) else batch
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def _find_changes(self, batch: DataFrame, generation: str) -> DataFrame:
        columns = SCHEMAS[self.table].fieldNames()
        delta = latest(batch.select(*columns), self.keys, BRONZE_ORDER).withColumn(
            BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        if not path_exists(batch.sparkSession, f"{generation}/state"):  # no winner before: nothing to look up
            row = F.struct(*columns)
            return delta.select(F.when(F.lit(False), row).alias("before"), row.alias("after"), BUCKET)
        delta = delta.persist()
        small = delta.count() <= BROADCAST_DELTA_ROWS
        touched = [r[0] for r in delta.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
        side = F.broadcast(delta) if small else delta
        old = self.winners(batch.sparkSession, generation).where(F.col(BUCKET).isin(touched))
        pairs = old.alias("o").join(side.alias("d"), _same("o", "d", self.keys) & F.expr(f"o.{BUCKET} = d.{BUCKET}"), "right")
        before = F.when(F.col(f"o.{BUCKET}").isNotNull(), F.struct(*[F.col(f"o.{c}").alias(c) for c in columns]))
        after = F.struct(*[F.col(f"d.{c}").alias(c) for c in columns])
        newer = F.struct(*[F.col(f"d.{c}") for c in BRONZE_ORDER]) > F.struct(*[F.col(f"o.{c}") for c in BRONZE_ORDER])
        return pairs.where(F.col(f"o.{BUCKET}").isNull() | newer).select(
            before.alias("before"), after.alias("after"), F.col(f"d.{BUCKET}").alias(BUCKET))

    def _apply(self, spark: SparkSession, generation: str, folder: str) -> None:
        found = self.changes(spark, folder)
        touched = [r[0] for r in found.select(BUCKET).distinct().collect()]
        if not touched:
            return
        rows = after = found.select("after.*", BUCKET)
        if path_exists(spark, f"{generation}/state"):
            side = F.broadcast(after) if found.count() <= BROADCAST_DELTA_ROWS else after
            rest = self.winners(spark, generation).where(F.col(BUCKET).isin(touched)).alias("o").join(
                side.alias("a"), _same("o", "a", self.keys) & F.expr(f"o.{BUCKET} = a.{BUCKET}"), "left_anti")
            rows = rest.unionByName(after)
        touch(spark, f"{generation}/_open")
        (rows.repartition(BUCKET).sortWithinPartitions(BUCKET, *self.keys).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{generation}/state"))
        remove(spark, f"{generation}/_open")

    def fold_new(self, spark: SparkSession, bronze_root: str) -> tuple[list[str], bool]:
        """Fold all new bronze files in: (folders of the changes, oldest first; whether the state began anew)."""
        generation = self._generation(spark)
        anew = not path_exists(spark, generation)
        folders: list[str] = []

        def fold(batch: DataFrame, batch_id: int) -> None:
            folder = f"{generation}/changes/batch={batch_id}"
            if not path_exists(spark, f"{folder}/_SUCCESS"):
                self._find_changes(batch, generation).write.mode("overwrite").parquet(folder)
            self._apply(spark, generation, folder)
            folders.append(folder)

        (spark.readStream.schema(SCHEMAS[self.table]).parquet(f"{bronze_root}/{self.table}")
         .writeStream.foreachBatch(fold).option("checkpointLocation", f"{generation}/_checkpoint")
         .trigger(availableNow=True).start()).awaitTermination()
        return folders, anew


# ---- counts carried on from the changes -----------------------------------------

def resource_counts() -> dict:
    """Chart -> (group columns, counts) over resource rows."""
    return {
        "resource_daily_growth": ({"ingest_date": to_date_of("res_published"), "res_type": F.col("res_type")},
                                  {"total": F.lit(True)}),
        "resource_type_summary": ({"res_type": F.col("res_type")},
                                  {"total": F.lit(True), "active": ~is_deleted(), "deleted": is_deleted()})}


def maintained_counts(spark: SparkSession, chart: str, changes: DataFrame, target: str, anew: bool = False) -> DataFrame:
    """A1/A2/A4: carry a stored chart on by signed counts of changed resource rows; the chart.

    Groups whose count falls to zero go.  ``anew``: the changes hold all rows,
    so the stored chart is left out.
    """
    groups, counts = resource_counts()[chart]
    signed = changes.select(F.inline(F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")),
        F.struct(F.lit(1).alias("sign"), F.col("after").alias("row"))))).where("row IS NOT NULL").select("sign", "row.*") \
        .where(F.col(TOMBSTONE) == 0)
    delta = signed.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(
        *[F.sum(F.when(c, F.col("sign")).otherwise(0)).cast("bigint").alias(n) for n, c in counts.items()])
    if not anew:
        delta = read_table(spark, target).unionByName(delta).groupBy(*groups).agg(
            *[F.sum(n).cast("bigint").alias(n) for n in counts])
    first = next(iter(counts))
    write_table(delta.where(F.col(first) > 0), target, list(groups))
    return read_table(spark, target)


# ---- M08 carried on from the changes ----------------------------------------------

def affected_patients(changes: DataFrame, link_changes: DataFrame, links: DataFrame) -> DataFrame:
    """``patient_res_id`` of the patients whose rows may differ: changed themselves, by a changed link
    (before or after), or by a changed visit that links to them."""
    def either(df: DataFrame) -> DataFrame:
        return df.select(F.inline(F.array(F.struct(F.col("before").alias("row")), F.struct(F.col("after").alias("row"))))) \
            .where("row IS NOT NULL").select("row.*")

    changed, subject = either(changes), F.col("src_path") == ENCOUNTER_SUBJECT
    own = changed.where("res_type = 'Patient'").select(F.col("res_id").alias("patient_res_id"))
    linked = either(link_changes).where(subject).select(F.col("target_resource_id").alias("patient_res_id"))
    visits = changed.where("res_type = 'Encounter'").select(F.col("res_id").alias("src_resource_id")).distinct()
    visited = links.where(subject).join(visits, "src_resource_id", "left_semi").select(
        F.col("target_resource_id").alias("patient_res_id"))
    return own.unionByName(linked).unionByName(visited).where("patient_res_id IS NOT NULL").distinct()


def carry_patients(spark: SparkSession, resources: Kept, links: Kept, changes: DataFrame, link_changes: DataFrame,
                   target: str) -> DataFrame:
    """Rows of the affected patients are made again from the kept winners and take the place of their old rows.

    The stored table is bucketed by patient; only the buckets of affected patients are read and replaced.
    """
    winners, link_winners = resources.winners(spark).drop(BUCKET), links.winners(spark).drop(BUCKET)
    bucket = F.pmod(F.xxhash64("patient_res_id"), F.lit(resources.buckets)).cast("int")
    affected = affected_patients(changes, link_changes, link_winners).withColumn(BUCKET, bucket).persist()
    small = affected.count() <= BROADCAST_DELTA_ROWS
    ids = F.broadcast(affected) if small else affected
    own_links = link_winners.where(F.col("src_path") == ENCOUNTER_SUBJECT).join(
        ids.select(F.col("patient_res_id").alias("target_resource_id")), "target_resource_id", "left_semi")
    people = winners.where("res_type = 'Patient'").join(
        ids.select(F.col("patient_res_id").alias("res_id")), "res_id", "left_semi")
    visits = winners.where("res_type = 'Encounter'").join(
        own_links.select(F.col("src_resource_id").alias("res_id")).distinct(), "res_id", "left_semi")
    made = silver.patients(None, people.unionByName(visits), own_links).withColumn(BUCKET, bucket)
    rows, emptied = made, []
    if path_exists(spark, target):
        touched = [r[0] for r in affected.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
        old = spark.read.schema(made.schema).parquet(target).where(F.col(BUCKET).isin(touched))
        rows = old.join(ids, ["patient_res_id", BUCKET], "left_anti").select(*made.columns).unionByName(made)
        emptied = sorted(set(touched) - {r[0] for r in rows.select(BUCKET).distinct().collect()})
    (rows.repartition(BUCKET).sortWithinPartitions(BUCKET, "patient_res_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(target))
    for bucket_number in emptied:  # overwriting replaces only buckets that have rows
        remove(spark, f"{target}/{BUCKET}={bucket_number}")
    affected.unpersist()
    return spark.read.schema(made.schema).parquet(target).drop(BUCKET)


# ---- the two-batch fixture ------------------------------------------------------

def two_batch_kept(spark: SparkSession, bronze: Bronze) -> dict[str, DataFrame]:
    """Winners of metadata and links, and maintained charts, after two folded batches."""
    root = scratch_dir(spark, "kept")
    resources, links = Kept(f"{root}/resource", "hfj_resource"), Kept(f"{root}/links", "hfj_res_link")
    landed = {"hfj_resource": two_batch_resource(bronze), "hfj_res_link": two_batch_link(bronze)}
    charts: dict[str, DataFrame] = {}
    for arrival in (1, 2):
        for name, df in landed.items():
            df.where(F.col("arrival") == arrival).select(*SCHEMAS[name].fieldNames()) \
                .write.mode("append").parquet(f"{root}/bronze/{name}")
        link_folders, _ = links.fold_new(spark, f"{root}/bronze")
        folders, anew = resources.fold_new(spark, f"{root}/bronze")
        patients = carry_patients(spark, resources, links, resources.changes(spark, folders),
                                  links.changes(spark, link_folders), f"{root}/patients")
        for k, folder in enumerate(folders):
            for chart in resource_counts():
                charts[chart] = maintained_counts(spark, chart, resources.changes(spark, folder),
                                                  f"{root}/charts/{chart}", anew and k == 0)
    return {"kept_resource": resources.winners(spark).drop(BUCKET), "kept_links": links.winners(spark).drop(BUCKET),
            "patients_carried_on": patients,
            **{f"maintained_{c}": df for c, df in charts.items()}}
