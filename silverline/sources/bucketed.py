"""C8/J1 on co-bucketed tables: FINAL and the body join without moving a body.

Metadata and bodies are stored once as catalog tables, bucketed and sorted by
``res_id``.  A bucket then holds all versions of its ids, so the dedup of the
metadata, that of the bodies and their join on ``(res_id, res_ver)`` run bucket
by bucket: no exchange, and the wide JSON is read once and not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverline.operators.cdc import current_resources
from silverline.session import configure
from silverline.sources.bronze import SCHEMAS, Bronze

TABLES = ("hfj_resource", "hfj_res_ver")
# One bucket holds a hash of res_id: it serves a join on (res_id, res_ver) too.
BUCKETED_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false",
                 "spark.sql.requireAllClusterKeysForDistribution": "false",
                 "spark.sql.sources.bucketing.enabled": "true",
                 "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}


def bucketed_session(spark: SparkSession) -> SparkSession:
    """A session of its own (same catalog) with the settings that let buckets stand for partitions."""
    session = configure(spark.newSession())
    for key, value in BUCKETED_CONF.items():
        session.conf.set(key, value)
    return session


def store_bucketed(bronze: Bronze, db: str, location: str, buckets: int = 64) -> None:
    """Metadata and bodies as tables ``db.hfj_...``, bucketed and sorted by id, below ``location``."""
    spark = bronze.hfj_resource.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    for name in TABLES:
        rows = getattr(bronze, name).select(*SCHEMAS[name].fieldNames())
        # one task a bucket writes it, so a bucket is one sorted file
        (rows.repartition(buckets, "res_id").write.mode("overwrite").format("parquet")
         .option("path", f"{location}/{name}").bucketBy(buckets, "res_id").sortBy("res_id").saveAsTable(f"`{db}`.`{name}`"))


def current_of_buckets(session: SparkSession, db: str) -> DataFrame:
    """C8 over the stored tables, in a :func:`bucketed_session`."""
    resource, bodies = (session.table(f"`{db}`.`{name}`") for name in TABLES)
    return current_resources(resource, bodies)
