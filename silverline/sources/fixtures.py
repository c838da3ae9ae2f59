"""Bronze CDC tables derived from the driver's test tables (FIXTURES.md).

The reference ships no data.  Its inputs, four CDC copies of a FHIR
server's tables, are derived here from ``customer supplier orders lineitem
events`` with DataFrame functions, so every query's work grows with the
test tables.  ``fixture_sql.py`` holds the same rules as SQL for the
oracle.  The modulo rules below decide which rows get a second version, a
soft delete, a tombstone, a stale body and so on; they select CDC patterns,
not a sample: every input row yields bronze rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.functions.scalars import epoch_ts
from silverline.sources.bronze import SCHEMAS, Bronze

# Fixed values of the fixture (FIXTURES.md section 2).
PATIENT_BASE = 1_000_000_000
ORGANIZATION_BASE = 2_000_000_000
ENCOUNTER_BASE = 3_000_000_000
CONDITION_BASE = 4_000_000_000
OBSERVATION_BASE = 5_000_000_000
CAREPLAN_BASE = 6_000_000_000
TOKEN_NOISE_BASE = 100_000_000
STATIC_PUBLISHED = "2023-01-01 00:00:00"
CONDITION_CODES = {  # first digit of o_orderpriority -> (code, display); 4 has none
    "1": ("I10", "Essential hypertension"),
    "2": ("E11.9", "Type 2 diabetes"),
    "3": ("J06.9", "Acute URI"),
    "5": ("I11.9", "Hypertensive heart disease"),
}
STALE_BODY = '{"stale":true}'


def _s(c: Column) -> Column:
    return c.cast("string")


def _lit(v) -> Column:
    return F.lit(v)


def load_test_tables(spark: SparkSession, sf_dir: str, names=("customer", "supplier", "orders",
                                                                "lineitem", "events")) -> dict:
    # finding out a schema is a small job of its own: side by side
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return dict(zip(names, pool.map(lambda n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet"), names)))


def _other_layout(which: Column) -> Column:
    """The time ``ts`` in one of five layouts without dashes (no offset: UTC)."""
    layouts = [F.date_format("ts", "yyyy/MM/dd"), F.date_format("ts", "yyyyMMdd"),
               F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), F.date_format("ts", "dd MMM yyyy"),
               _s(F.unix_seconds(F.col("ts").cast("timestamp")))]
    out = layouts[0]
    for k, layout in enumerate(layouts[1:], 1):
        out = F.when(which % 5 == k, layout).otherwise(out)
    return out


def source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the test tables' files: what was derived from them holds while this is the same."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for name in ("customer", "supplier", "orders", "lineitem", "events"):
        root = path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
        out += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(out))


def base_resources(t: dict) -> DataFrame:
    """One row per resource: res_id, res_type, published, body."""
    customer, supplier, orders, events = t["customer"], t["supplier"], t["orders"], t["events"]
    static = _lit(STATIC_PUBLISHED).cast("timestamp_ntz")

    patients = customer.select(
        (F.col("c_custkey") + PATIENT_BASE).alias("res_id"), _lit("Patient").alias("res_type"),
        static.alias("published"),
        F.concat(_lit('{"resourceType":"Patient","name":"'), F.col("c_name"), _lit('"}')).alias("body"))

    orgs = supplier.select(
        (F.col("s_suppkey") + ORGANIZATION_BASE).alias("res_id"), _lit("Organization"), static,
        F.concat(_lit('{"resourceType":"Organization"'),
                 F.when(F.col("s_suppkey") % 10 == 9, _lit(""))
                  .otherwise(F.concat(_lit(',"name":"PKM '), _s(F.col("s_suppkey") % 40), _lit('"'))),
                 _lit("}")))

    status = (F.when(F.col("o_orderstatus") == "F", "finished")
               .when(F.col("o_orderstatus") == "O", "in-progress").otherwise("planned"))
    subject = F.concat(_lit('"subject":{"reference":"Patient/'), _s(F.col("o_custkey")), _lit('"}'))
    encounters = orders.select(
        (F.col("o_orderkey") + ENCOUNTER_BASE).alias("res_id"), _lit("Encounter"), F.col("o_orderdate"),
        F.when(F.col("o_orderkey") % 41 == 0, _lit("not json")).otherwise(F.concat(
            _lit('{"resourceType":"Encounter","status":"'), status,
            _lit('","class":{"code":"'),
            F.when(F.col("o_orderkey") % 4 == 0, "EMER").otherwise("AMB"),
            _lit('"},'), subject, _lit("}"))))

    digit = F.substring("o_orderpriority", 1, 1)
    code_json = F.lit("")
    for d, (code, display) in reversed(list(CONDITION_CODES.items())):
        code_json = F.when(digit == d, _lit(
            f',"code":{{"coding":[{{"code":"{code}","display":"{display}"}}]}}')).otherwise(code_json)
    conditions = orders.where(F.col("o_orderkey") % 3 == 0).select(
        (F.col("o_orderkey") + CONDITION_BASE).alias("res_id"), _lit("Condition"), F.col("o_orderdate"),
        F.concat(_lit('{"resourceType":"Condition",'), subject,
                 _lit(',"clinicalStatus":{"coding":[{"code":"active"}]}'), code_json, _lit("}")))

    eid = F.col("event_id")
    etype = F.col("event_type")
    even = eid % 2 == 0
    whole = F.floor("value")
    value_json = (F.when(eid % 43 == 0, F.concat(_s(whole % 60 + 100), _lit(".50")))
                   .when((etype == "error") & (eid % 3 == 0), _lit("0"))
                   .when((etype == "error") & (eid % 3 == 1), _lit('"n/a"'))
                   .when(even, _s(whole % 60 + 100))
                   .otherwise(_s(whole % 45 + 60)))
    observations = events.select(
        (eid + OBSERVATION_BASE).alias("res_id"), _lit("Observation"), F.col("ts"),
        F.concat(
            _lit('{"resourceType":"Observation"'),
            F.when(eid % 31 == 0, _lit("")).otherwise(
                F.concat(_lit(',"subject":{"reference":"Patient/'), _s(F.col("user_id")), _lit('"}'))),
            _lit(',"encounter":{"reference":"Encounter/'), _s(eid), _lit('"}'),
            F.when(eid % 47 == 0, _lit(',"note":"a","note":"b"')).otherwise(_lit("")),
            F.when(etype == "signup", _lit(""))
             .when(eid % 59 == 0, _lit(',"effectiveDateTime":"10:00:00"'))
             .when(eid % 61 == 0, F.concat(_lit(',"effectiveDateTime":"'), _other_layout(F.floor(eid / 61)), _lit('"')))
             .otherwise(F.concat(
                _lit(',"effectiveDateTime":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                _lit('+07:00"'))),
            _lit(',"code":{"coding":[{"code":"'),
            F.when(etype == "purchase", "29463-7").otherwise("8480-6"),
            _lit('","display":"'),
            F.when(etype == "purchase", "Body weight")
             .when(even, "Systolic blood pressure").otherwise("Diastolic blood pressure"),
            _lit('"}]},"valueQuantity":{"value":'), value_json, _lit(',"unit":"mmHg"}}')))

    careplans = orders.where(F.col("o_orderkey") % 7 == 0).select(
        (F.col("o_orderkey") + CAREPLAN_BASE).alias("res_id"), _lit("CarePlan"), F.col("o_orderdate"),
        F.concat(_lit('{"resourceType":"CarePlan","status":"active","category":[{"coding":[{"display":"'),
                 F.when(F.col("o_orderkey") % 2 == 0, "Weight faltering").otherwise("Diet"),
                 _lit('"}]}],"description":"d"}')))

    out = patients
    for part in (orgs, encounters, conditions, observations, careplans):
        out = out.unionByName(part.toDF(*patients.columns))
    return out.withColumn("published", F.col("published").cast("timestamp_ntz"))


def _versions(base: DataFrame) -> DataFrame:
    """Version 1 for every resource, version 2 as well when res_id % 5 = 0."""
    last = F.when(F.col("res_id") % 5 == 0, 2).otherwise(1)
    return (base.withColumn("last_ver", last)
                .withColumn("ver", F.explode(F.sequence(F.lit(1), F.col("last_ver")))))


def hfj_resource(versions: DataFrame) -> DataFrame:
    on_last = F.col("ver") == F.col("last_ver")
    published = F.col("published")
    return versions.select(
        F.col("res_id").cast("bigint").alias("res_id"),
        F.concat(_lit("f"), _s(F.col("res_id"))).alias("fhir_id"),
        "res_type",
        F.col("ver").cast("bigint").alias("res_ver"),
        published.alias("res_published"),
        F.timestamp_add("DAY", F.col("ver") - 1, published).alias("res_updated"),
        F.when(on_last & (F.col("res_id") % 11 == 0), F.timestamp_add("DAY", _lit(2), published))
         .otherwise(epoch_ts()).alias("res_deleted_at"),
        F.col("ver").cast("bigint").alias("_peerdb_version"),
        F.when(on_last & (F.col("res_id") % 13 == 0), 1).otherwise(0).cast("int").alias("_peerdb_is_deleted"),
    )


def hfj_res_ver(versions: DataFrame) -> DataFrame:
    bodies = versions.select(
        F.col("res_id").cast("bigint").alias("res_id"), F.col("ver").cast("bigint").alias("res_ver"),
        F.col("body").alias("res_text_vc"), _lit(2).cast("bigint").alias("_peerdb_version"),
        F.when(F.col("res_id") % 37 == 0, 1).otherwise(0).cast("int").alias("_peerdb_is_deleted"))
    stale = versions.where((F.col("res_id") % 6 == 0) | (F.col("res_id") % 37 == 0)).select(
        F.col("res_id").cast("bigint"), F.col("ver").cast("bigint"), _lit(STALE_BODY),
        _lit(1).cast("bigint"), _lit(0).cast("int"))
    return bodies.unionByName(stale.toDF(*bodies.columns))


def hfj_res_link(t: dict) -> DataFrame:
    orders, lineitem = t["orders"], t["lineitem"]
    key = F.col("o_orderkey")
    subject = orders.select(
        _lit("Encounter.subject").alias("src_path"), _lit("Encounter").alias("source_resource_type"),
        (key + ENCOUNTER_BASE).alias("src_resource_id"), _lit("Patient").alias("target_resource_type"),
        (F.col("o_custkey") + PATIENT_BASE).alias("target_resource_id"),
        F.col("o_orderdate").alias("sp_updated"),
        ((key % 17 == 0) | (key % 9 == 0)).alias("has_v2"), (key % 17 == 0).alias("v2_deleted"))
    provider = (lineitem.groupBy("l_orderkey")
                .agg(F.min("l_suppkey").alias("supp"), F.min("l_shipdate").alias("ship"))
                .select(_lit("Encounter.serviceProvider"), _lit("Encounter"),
                        F.col("l_orderkey") + ENCOUNTER_BASE, _lit("Organization"),
                        F.col("supp") + ORGANIZATION_BASE, F.col("ship"),
                        F.col("l_orderkey") % 8 == 0, _lit(False)))
    careplan = orders.where(key % 7 == 0).select(
        _lit("CarePlan.encounter"), _lit("CarePlan"), key + CAREPLAN_BASE, _lit("Encounter"),
        key + ENCOUNTER_BASE, F.col("o_orderdate"), _lit(False), _lit(False))
    v1 = subject.unionByName(provider.toDF(*subject.columns)).unionByName(careplan.toDF(*subject.columns))
    cols = ["src_path", "source_resource_type", F.col("src_resource_id").cast("bigint"),
            "target_resource_type", F.col("target_resource_id").cast("bigint")]
    first = v1.select(*cols, F.col("sp_updated").cast("timestamp_ntz").alias("sp_updated"),
                      _lit(1).cast("bigint").alias("_peerdb_version"),
                      _lit(0).cast("int").alias("_peerdb_is_deleted"))
    second = v1.where("has_v2").select(
        *cols, F.timestamp_add("DAY", _lit(1), F.col("sp_updated").cast("timestamp_ntz")),
        _lit(2).cast("bigint"), F.col("v2_deleted").cast("int"))
    return first.unionByName(second.toDF(*first.columns)).toDF(*SCHEMAS["hfj_res_link"].fieldNames())


def hfj_spidx_token(t: dict) -> DataFrame:
    orders = t["orders"]
    key = F.col("o_orderkey")
    v1 = orders.select(key.cast("bigint").alias("sp_id"), _lit("Encounter").alias("res_type"),
                       _lit("status").alias("sp_name"), F.col("o_orderstatus").alias("sp_value"),
                       _lit(1).cast("bigint").alias("_peerdb_version"),
                       _lit(0).cast("int").alias("_peerdb_is_deleted"))
    v2 = orders.where((key % 10 == 0) | (key % 19 == 0)).select(
        key.cast("bigint"), _lit("Encounter"), _lit("status"), _lit("X"), _lit(2).cast("bigint"),
        F.when(key % 19 == 0, 1).otherwise(0).cast("int"))
    noise = orders.select((key + TOKEN_NOISE_BASE).cast("bigint"), _lit("Condition"), _lit("code"),
                          F.col("o_orderpriority"), _lit(1).cast("bigint"), _lit(0).cast("int"))
    return v1.unionByName(v2.toDF(*v1.columns)).unionByName(noise.toDF(*v1.columns))


def derive_bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    """All four bronze tables, lazily, from the test tables under ``sf_dir``."""
    t = load_test_tables(spark, sf_dir)
    versions = _versions(base_resources(t))
    return Bronze(hfj_resource(versions), hfj_res_ver(versions), hfj_res_link(t), hfj_spidx_token(t))


def write_bronze(bronze: Bronze, root: str) -> None:
    """Store the derived tables as Parquet under ``root`` (one folder each)."""
    for name, df in bronze.tables().items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


# Two-batch fixture for incremental loads (FIXTURES.md section 4) -----------

def two_batch_resource(bronze: Bronze, late: bool = False) -> DataFrame:
    """Metadata rows of every type with an ``arrival`` batch and shifted ``res_updated``.

    ``late``: a third of batch 2 arrives as batch 3, half of it with a version above batch 2's.
    """
    r = bronze.hfj_resource
    rid, ver = F.col("res_id"), F.col("res_ver")
    arrival = F.when((ver == 2) | (rid % 23 == 0) | (rid % 29 == 0), 2).otherwise(1)
    days = F.when((ver == 2) | (rid % 29 == 0), 4000).otherwise(0)
    if late:
        third = (arrival == 2) & (rid % 3 == 0)
        days = days + F.when(third & (rid % 2 == 0), 4000).otherwise(0)
        arrival = F.when(third, 3).otherwise(arrival)
    return r.withColumn("res_updated", F.timestamp_add("DAY", days, F.col("res_published"))) \
            .withColumn("arrival", arrival)


def two_batch_link(bronze: Bronze) -> DataFrame:
    """Links with an ``arrival`` batch: second versions (and some first ones) land in batch 2."""
    second, src = F.col("_peerdb_version") == 2, F.col("src_resource_id")
    shifted = F.when(second | (src % 29 == 0), F.timestamp_add("DAY", _lit(4000), F.col("sp_updated"))) \
               .otherwise(F.col("sp_updated"))
    return bronze.hfj_res_link.withColumn("sp_updated", shifted) \
        .withColumn("arrival", F.when(second | (src % 23 == 0) | (src % 29 == 0), 2).otherwise(1))


def batch_view(bronze: Bronze, batch: int, late: bool = False) -> Bronze:
    """Bronze as seen after ``batch`` arrivals (bodies are all there from the start)."""
    r = two_batch_resource(bronze, late).where(F.col("arrival") <= batch).drop("arrival")
    links = two_batch_link(bronze).where(F.col("arrival") <= batch).drop("arrival")
    return Bronze(r, bronze.hfj_res_ver, links, bronze.hfj_spidx_token)
