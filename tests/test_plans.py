"""Physical plan checks: the plan shapes the design relies on at scale."""

import pytest

from silverline.operators import cdc
from silverline.plans.models import ALL_MODELS, Models
from silverline.sources.bronze import Bronze
from silverline.sources.fixtures import derive_bronze, write_bronze
from silverline.session import scratch_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored_bronze(spark):
    root = scratch_dir(spark, "plan-bronze")
    write_bronze(derive_bronze(spark, SF), root)
    return Bronze.read(spark, root)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_drops_old_versions_before_the_shuffle(spark, stored_bronze):
    plan = _plan(cdc.final(stored_bronze.hfj_resource, cdc.RESOURCE_KEYS))
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", ALL_MODELS)
def test_models_stay_in_the_jvm(spark, stored_bronze, name):
    plan = _plan(Models(stored_bronze)[name])
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scans_read_only_needed_columns(spark, stored_bronze):
    df = Models(stored_bronze)["resource_type_summary"]
    plan = _plan(df)
    # the body table is not read at all, and the metadata scan is narrow
    assert "res_text_vc" not in plan
    assert "fhir_id" not in plan


def test_hot_body_copies_are_cut_before_the_exchange(spark):
    """One body with thousands of CDC copies (a hot key) still ships one row per map partition."""
    import datetime as dt

    from pyspark.sql import functions as F

    from silverline.sources.bronze import SCHEMAS

    t0 = dt.datetime(2024, 1, 1)
    epoch = dt.datetime(1970, 1, 1)
    meta = spark.createDataFrame(
        [(i, f"f{i}", "Encounter", 1, t0, t0, epoch, 1, 0) for i in range(1, 51)],
        SCHEMAS["hfj_resource"])
    hot = spark.range(5000).select(F.lit(1).cast("bigint").alias("res_id"),
                                   F.lit(1).cast("bigint").alias("res_ver"),
                                   F.lit('{"status":"old"}').alias("res_text_vc"),
                                   F.col("id").alias("_peerdb_version"),
                                   F.lit(0).alias("_peerdb_is_deleted"))
    winner = spark.createDataFrame([(1, 1, '{"status":"new"}', 10_000, 0)], SCHEMAS["hfj_res_ver"])
    others = spark.createDataFrame([(i, 1, '{"status":"x"}', 1, 0) for i in range(2, 51)],
                                   SCHEMAS["hfj_res_ver"])
    bodies = hot.unionByName(winner).unionByName(others).repartition(8)
    cur = cdc.current_resources(meta, bodies)
    got = {r.res_id: r.res_text_vc for r in cur.collect()}
    assert len(got) == 50 and got[1] == '{"status":"new"}'
    lines = _plan(cur).split("\n")
    cut_before_shuffle = any(
        "Exchange hashpartitioning(res_id" in line and "res_ver" in line
        and any("WindowGroupLimit" in nxt and "Partial" in nxt for nxt in lines[i + 1:i + 4])
        for i, line in enumerate(lines))
    assert cut_before_shuffle


def test_checked_broadcast_filters_bodies_before_any_shuffle(spark, stored_bronze):
    winners = cdc.final_metadata(stored_bronze.hfj_resource)
    cur = cdc.current_resources(stored_bronze.hfj_resource, stored_bronze.hfj_res_ver,
                                winners=winners.limit(10), prefilter=True, broadcast_meta=True)
    lines = _plan(cur).split("\n")
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "res_text_vc" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    parent = None
    for line in reversed(lines[:scan]):
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth and "Filter" not in line and "Project" not in line \
                and "ColumnarToRow" not in line and "WholeStageCodegen" not in line:
            parent = line
            break
        if d < depth:
            depth = d
    assert parent is not None and "BroadcastHashJoin" in parent, parent
