"""Micro-batch ingest closes the gaps of the high-water-mark rule."""

import datetime as dt

from silverline.plans.incremental import read_model
from silverline.session import scratch_dir
from silverline.sources.bronze import SCHEMAS, Bronze
from silverline.streaming.ingest import ingest_stream, read_stream_model

T0 = dt.datetime(2024, 1, 1)
EPOCH = dt.datetime(1970, 1, 1)


def _meta(rid, ver, updated, deleted_at=EPOCH, tomb=0):
    return (rid, f"f{rid}", "Encounter", ver, T0, updated, deleted_at, ver, tomb)


def _body(rid, ver):
    return (rid, ver, '{"status":"finished","class":{"code":"AMB"},"subject":{"reference":"Patient/1"}}', 2, 0)


def _land(spark, root, table, rows):
    spark.createDataFrame(rows, SCHEMAS[table]).write.mode("append").parquet(f"{root}/{table}")


def _run(spark, bronze_root, out, ckpt):
    static = Bronze.read(spark, bronze_root)
    ingest_stream(spark, bronze_root, static, "encounters", out, ckpt).awaitTermination()


def test_late_body_late_row_and_delete_are_all_caught(spark):
    root = scratch_dir(spark, "stream-gaps")
    bronze, out, ckpt = f"{root}/bronze", f"{root}/encounters", f"{root}/_ckpt"
    for table in ("hfj_res_link", "hfj_spidx_token"):
        spark.createDataFrame([], SCHEMAS[table]).write.parquet(f"{bronze}/{table}")
    t5 = T0 + dt.timedelta(days=5)
    # run 1: ids 1 and 2 with bodies, id 3 without its body yet
    _land(spark, bronze, "hfj_resource", [_meta(1, 1, t5), _meta(2, 1, t5), _meta(3, 1, t5)])
    _land(spark, bronze, "hfj_res_ver", [_body(1, 1), _body(2, 1)])
    _run(spark, bronze, out, ckpt)
    assert {r.encounter_id for r in read_stream_model(spark, out, "encounters").collect()} == {1, 2}
    # run 2: the body of 3 arrives late, 4 arrives with an old timestamp, 2 is deleted
    _land(spark, bronze, "hfj_res_ver", [_body(3, 1), _body(4, 1), _body(2, 2)])
    _land(spark, bronze, "hfj_resource", [_meta(4, 1, T0), _meta(2, 2, t5, deleted_at=t5)])
    _run(spark, bronze, out, ckpt)
    got = {r.encounter_id for r in read_stream_model(spark, out, "encounters").collect()}
    assert got == {1, 3, 4}
    # the stored table is append-only; the reader resolves it per key
    assert read_model(spark, out, "encounters", final=False).count() > len(got)


def test_one_stream_keeps_several_models_fresh(spark):
    from silverline.streaming.ingest import ingest_models

    root = scratch_dir(spark, "stream-many")
    bronze = f"{root}/bronze"
    for table in ("hfj_res_link", "hfj_spidx_token"):
        spark.createDataFrame([], SCHEMAS[table]).write.parquet(f"{bronze}/{table}")
    obs_body = (5, 1, '{"code":{"coding":[{"code":"8480-6","display":"Systolic blood pressure"}]},'
                      '"valueQuantity":{"value":150}}', 2, 0)
    _land(spark, bronze, "hfj_resource",
          [_meta(1, 1, T0), (5, "f5", "Observation", 1, T0, T0, EPOCH, 1, 0)])
    _land(spark, bronze, "hfj_res_ver", [_body(1, 1), obs_body])
    targets = {"encounters": f"{root}/encounters", "observations": f"{root}/observations"}
    ingest_models(spark, bronze, Bronze.read(spark, bronze), targets,
                  f"{root}/_ckpt").awaitTermination()
    assert [r.encounter_id for r in read_stream_model(spark, targets["encounters"],
                                                      "encounters").collect()] == [1]
    obs = read_stream_model(spark, targets["observations"], "observations").collect()
    assert [(r.observation_id, r.nilai) for r in obs] == [(5, 150.0)]


def test_stream_job_rebuilds_charts_and_compacts(spark):
    from silverline import jobs
    from silverline.plans.incremental import INTERNAL, read_model, write_jobs
    from silverline.plans.models import Models
    from silverline.sinks.tables import current_version, read_table
    from silverline.sources.bronze import Bronze
    from silverline.sources.fixtures import derive_bronze, two_batch_resource, write_bronze

    root, silver_root = scratch_dir(spark, "job-bronze"), scratch_dir(spark, "job-silver")
    derived = derive_bronze(spark, "/root/testdata/sf0.001")
    write_bronze(derived, root)
    rows = two_batch_resource(derived)
    rows.where("arrival = 1").drop("arrival").write.mode("overwrite").parquet(f"{root}/hfj_resource")
    argv = ["stream", "--bronze", root, "--silver", silver_root, "--once", "--compact-after", "2"]
    jobs.main(argv)
    rows.where("arrival = 2").drop("arrival").write.mode("append").parquet(f"{root}/hfj_resource")
    jobs.main(argv)
    models = Models(Bronze.read(spark, root))
    stored = read_model(spark, f"{silver_root}/encounters", "encounters")
    assert stored.exceptAll(models["encounters"]).isEmpty() and stored.count() == models["encounters"].count()
    assert write_jobs(spark, current_version(spark, f"{silver_root}/encounters")) == 1
    for chart in ("encounter_class", "tren_tensi_harian", "top_diagnosis"):
        got, want = read_table(spark, f"{silver_root}/{chart}"), models[chart]
        assert got.count() == want.count() and got.drop(*INTERNAL).exceptAll(want).isEmpty()
