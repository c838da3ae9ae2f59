"""refresh_all: stored tables equal the lazily computed models."""

import pytest
from pyspark.sql import functions as F

from silverline.plans.incremental import INTERNAL, read_model, refresh_all
from silverline.plans.models import ALL_MODELS, CHART_MODELS, Models
from silverline.session import scratch_dir
from silverline.sinks.tables import read_table
from silverline.sources.bronze import Bronze
from silverline.sources.fixtures import derive_bronze, write_bronze

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in
                  df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def bronze(spark):
    root = scratch_dir(spark, "refresh-bronze")
    write_bronze(derive_bronze(spark, SF), root)
    return Bronze.read(spark, root)


def test_full_then_incremental_refresh_match_models(spark, bronze):
    silver_root = scratch_dir(spark, "refresh-silver")
    timings = {}
    paths = refresh_all(spark, bronze, silver_root, batch_id=1, full_refresh=True, timings=timings)
    assert set(paths) == set(ALL_MODELS)
    assert "current_resources" in timings and "kpi_totals" in timings
    expected = Models(bronze)
    for name in ALL_MODELS:
        stored = read_model(spark, paths[name], name) if name not in CHART_MODELS \
            else read_table(spark, paths[name])
        assert _rows(stored.drop(*[c for c in INTERNAL if c in stored.columns])) == \
            _rows(expected[name]), name

    # next run on unchanged bronze: nothing new is appended, charts are rebuilt equal;
    # compact_after=2 compacts every incremental table after this second write job
    refresh_all(spark, bronze, silver_root, batch_id=2, compact_after=2)
    for name in ("encounters", "observations", "deteksi_dini_hipertensi", "kpi_totals"):
        stored = read_model(spark, paths[name], name) if name not in CHART_MODELS \
            else read_table(spark, paths[name])
        assert _rows(stored) == _rows(expected[name]), name


def test_output_name_override(spark, bronze):
    silver_root = scratch_dir(spark, "refresh-names")
    paths = refresh_all(spark, bronze, silver_root, batch_id=1, names={"encounters": "visits"},
                        parallel_jobs=1)
    assert paths["encounters"].endswith("/visits")
    assert read_model(spark, paths["encounters"], "encounters").count() == 1225


def test_two_batch_refresh_equals_oracle_and_unshared_path(spark):
    from pyspark.sql import functions as F

    import __spark_entry__ as entry_mod
    from oracle_check import duck, normalise
    from silverline.plans.incremental import INCREMENTAL_MODELS, append_delta
    from silverline.sources.bronze import SCHEMAS
    from silverline.sources.fixtures import two_batch_resource

    derived = derive_bronze(spark, SF)
    root = scratch_dir(spark, "two-batch-refresh")
    for name in ("hfj_res_ver", "hfj_res_link", "hfj_spidx_token"):
        derived.tables()[name].write.parquet(f"{root}/bronze/{name}")

    def land(batch):
        two_batch_resource(derived).where(F.col("arrival") == batch) \
            .select(*SCHEMAS["hfj_resource"].fieldNames()) \
            .write.mode("append").parquet(f"{root}/bronze/hfj_resource")

    land(1)
    b1 = Bronze.read(spark, f"{root}/bronze")
    # the unshared path must read batch 1 as it was, so keep a copy of it
    b1_copy = f"{root}/bronze_b1"
    for name, df in b1.tables().items():
        df.write.parquet(f"{b1_copy}/{name}")
    paths = refresh_all(spark, b1, f"{root}/silver", batch_id=1, full_refresh=True)
    land(2)
    b2 = Bronze.read(spark, f"{root}/bronze")
    refresh_all(spark, b2, f"{root}/silver", batch_id=2)

    for name in INCREMENTAL_MODELS:
        other = f"{root}/unshared/{name}"
        append_delta(Bronze.read(spark, b1_copy), name, other, 1)
        append_delta(b2, name, other, 2)
        assert _rows(read_model(spark, paths[name], name)) == \
            _rows(read_model(spark, other, name)), name

    enc = read_model(spark, paths["encounters"], "encounters")
    res = duck(SF).execute(entry_mod.oracle_sql()["append_then_final"])
    cols = [c[0] for c in res.description]
    assert normalise([tuple(r) for r in enc.collect()], enc.columns) == normalise(res.fetchall(), cols)


def test_job_entry_point_refresh(spark, bronze, capsys):
    import json

    from silverline import jobs

    root = scratch_dir(spark, "job-bronze")
    for name, df in bronze.tables().items():
        df.write.parquet(f"{root}/{name}")
    silver_root = scratch_dir(spark, "job-silver")
    jobs.main(["refresh", "--bronze", root, "--silver", silver_root, "--batch-id", "7"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(out["tables"]) == set(ALL_MODELS)
    assert read_table(spark, out["tables"]["encounter_class"]).count() == 3


def _tiny(spark, resources, links=()):
    """Bronze of a few rows: (res_id, res_type, ver, updated day, deleted?) and links."""
    import datetime as dt

    from silverline.sources.bronze import SCHEMAS
    day = lambda n: dt.datetime(2024, 1, n)
    epoch = dt.datetime(1970, 1, 1)
    meta = [(i, f"f{i}", t, v, day(1), day(u), epoch, v, int(dead)) for i, t, v, u, dead in resources]
    bodies = [(i, v, '{"status":"s%d"}' % v, 1, 0) for i, _, v, _, _ in resources]
    return Bronze(spark.createDataFrame(meta, SCHEMAS["hfj_resource"]),
                  spark.createDataFrame(bodies, SCHEMAS["hfj_res_ver"]),
                  spark.createDataFrame([(*k, day(u), v, int(dead)) for *k, u, v, dead in links],
                                        SCHEMAS["hfj_res_link"]),
                  spark.createDataFrame([], SCHEMAS["hfj_spidx_token"]))


TYPES = ("Organization", "Encounter", "Condition", "Observation", "CarePlan")


def test_unchanged_run_absent_type_and_delta_of_one_row(spark):
    root = scratch_dir(spark, "tiny")
    rows = [(10 + k, t, 1, 2, False) for k, t in enumerate(TYPES) if t != "CarePlan"]
    rows += [(100 + k, "Organization", 1, 1, False) for k in range(20)]
    paths = refresh_all(spark, _tiny(spark, rows), root, batch_id=1)  # no CarePlan at all
    assert read_model(spark, paths["careplans"], "careplans").count() == 0
    refresh_all(spark, _tiny(spark, rows), root, batch_id=2)  # unchanged
    assert read_model(spark, paths["encounters"], "encounters").count() == 1
    more = [*rows, (50, "Encounter", 1, 9, False)]
    refresh_all(spark, _tiny(spark, more), root, batch_id=3)
    stored = read_table(spark, f"{root}/_current")
    assert stored.count() == 1  # the quiet types are not derived again
    assert read_model(spark, paths["encounters"], "encounters").count() == 2
    refresh_all(spark, _tiny(spark, [*more, (60, "CarePlan", 1, 1, False)]), root, batch_id=4)
    assert read_model(spark, paths["careplans"], "careplans").count() == 1


def test_compaction_changes_no_later_run(spark):
    from silverline.plans.incremental import append_delta, compact, stored_mark
    one = _tiny(spark, [(1, "Encounter", 1, 2, False), (2, "Encounter", 1, 2, False)])
    two = _tiny(spark, [(1, "Encounter", 1, 2, False), (1, "Encounter", 2, 10, True), (2, "Encounter", 1, 2, False)])
    late = _tiny(spark, [(1, "Encounter", 1, 2, False), (1, "Encounter", 2, 10, True),
                         (2, "Encounter", 1, 2, False), (3, "Encounter", 1, 5, False)])
    seen = []
    for compacted in (False, True):
        target = f"{scratch_dir(spark, 'late')}/encounters"
        append_delta(one, "encounters", target, 1, propagate_deletes=True)
        append_delta(two, "encounters", target, 2, propagate_deletes=True)
        if compacted:
            compact(spark, target, "encounters")
        append_delta(late, "encounters", target, 3, propagate_deletes=True)
        seen.append((_rows(read_model(spark, target, "encounters")), stored_mark(spark, "encounters", target)))
    assert seen[0] == seen[1] and len(seen[0][0]) == 1


def test_deletes_of_links_and_metadata_only(spark):
    link = ("Encounter.serviceProvider", "Encounter", 1, "Organization", 2)
    rows = [(1, "Encounter", 1, 2, False), (2, "Organization", 1, 2, False)]
    root = scratch_dir(spark, "gone")
    paths = refresh_all(spark, _tiny(spark, rows, [(*link, 2, 1, False)]), root, 1, propagate_deletes=True)
    assert read_model(spark, paths["res_link"], "res_link").count() == 1
    later = _tiny(spark, [*rows, (1, "Encounter", 2, 5, True)], [(*link, 2, 1, False), (*link, 6, 2, True)])
    refresh_all(spark, later, root, 2, propagate_deletes=True)
    assert read_model(spark, paths["res_link"], "res_link").count() == 0
    assert [r["res_id"] for r in read_model(spark, paths["resource"], "resource").collect()] == [2]
    assert read_model(spark, paths["encounters"], "encounters").count() == 0
    assert read_table(spark, paths["utilisasi_faskes"]).count() == 0


def test_refresh_then_stream_batches_agree(spark):
    """A micro-batch written after a scheduled run is newer for every reader."""
    from pyspark.sql import functions as F

    from silverline.plans.incremental import BATCH_ID, DELETED, append_delta, next_batch, store
    from silverline.streaming.ingest import read_stream_model
    target = f"{scratch_dir(spark, 'both')}/encounters"
    append_delta(_tiny(spark, [(1, "Encounter", 1, 8, False)]), "encounters", target, 1_700_000_000)
    row = read_model(spark, target, "encounters").withColumn("status", F.lit("late"))
    row = row.withColumn("res_updated", F.lit("2024-01-03").cast("timestamp_ntz"))
    stamp = next_batch(spark, target, 1)
    assert stamp == 1_700_000_001
    store(row.withColumn(BATCH_ID, F.lit(stamp).cast("bigint")).withColumn(DELETED, F.lit(False)), target,
          "encounters", append=True, batch=stamp)
    for reader in (read_model, read_stream_model):
        assert [r["status"] for r in reader(spark, target, "encounters").collect()] == ["late"]


def test_versions_are_kept_by_age_and_tables_are_clustered(spark):
    from silverline.sinks.tables import committed_versions, publish, write_table
    root = scratch_dir(spark, "age")
    df = spark.range(0, 4000, 1, 8).selectExpr("(id * 7919) % 4000 as k", "id")
    for _ in range(4):
        write_table(df, f"{root}/kept", ["k"])
    assert len(committed_versions(spark, f"{root}/kept")) == 4
    for _ in range(4):
        last = write_table(df, f"{root}/short", ["k"], range_partition=True, retain_seconds=0.0)
    assert len(committed_versions(spark, f"{root}/short")) <= 2
    spans = sorted((r["lo"], r["hi"]) for r in spark.read.parquet(last).selectExpr(
        "k", "input_file_name() as f").groupBy("f").agg({"k": "min"}).withColumnRenamed("min(k)", "lo").join(
        spark.read.parquet(last).selectExpr("k", "input_file_name() as f").groupBy("f").agg(
            {"k": "max"}).withColumnRenamed("max(k)", "hi"), "f").collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    name = publish(df.limit(10), "m01", "silver_default", " silver_custom ", ["k"])
    assert name == "silver_custom.m01" and spark.table(name).count() == 10
    spark.sql("DROP TABLE silver_custom.m01")


def test_kept_winners_refresh_equals_the_plain_one(spark):
    """Two scheduled runs with kept winners store the same tables as two that compute FINAL of all bronze."""
    from pyspark.sql import functions as F

    from silverline.sources.bronze import SCHEMAS
    from silverline.sources.fixtures import two_batch_link, two_batch_resource

    derived, root = derive_bronze(spark, SF), scratch_dir(spark, "kept-refresh")
    for name in ("hfj_res_ver", "hfj_spidx_token"):
        derived.tables()[name].write.parquet(f"{root}/bronze/{name}")
    paths = {}
    for batch in (1, 2):
        for name, df in (("hfj_resource", two_batch_resource(derived)), ("hfj_res_link", two_batch_link(derived))):
            df.where(F.col("arrival") == batch).select(*SCHEMAS[name].fieldNames()).write.mode("append") \
                .parquet(f"{root}/bronze/{name}")
        live = Bronze.read(spark, f"{root}/bronze")
        for kind, bronze_root in (("plain", None), ("kept", f"{root}/bronze")):
            paths[kind] = refresh_all(spark, live, f"{root}/{kind}", batch_id=batch, bronze_root=bronze_root)
    for name in ALL_MODELS:
        read = read_table if name in CHART_MODELS else lambda s, p, n=name: read_model(s, p, n)
        assert _rows(read(spark, paths["kept"][name])) == _rows(read(spark, paths["plain"][name])), name


def test_readers_see_the_old_table_until_the_new_one_stands(spark):
    from silverline.sinks.tables import publish

    root = scratch_dir(spark, "repoint")
    df = spark.range(10).withColumnRenamed("id", "k")
    name = publish(df, "m02", "silver_default", "silver_repoint", ["k"], location=root)
    reader = spark.table(name)  # opened before the rebuild
    assert reader.count() == 10
    publish(df.where("k < 4"), "m02", "silver_default", "silver_repoint", ["k"], location=root)
    assert spark.table(name).count() == 4 and reader.count() in (4, 10)

    def broken(batches):
        raise RuntimeError("lost")
        yield

    with pytest.raises(Exception):
        publish(df.mapInArrow(broken, "k long"), "m02", "silver_default", "silver_repoint", ["k"], location=root)
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 4  # a failed rebuild leaves the table as it was
    spark.sql("DROP DATABASE silver_repoint CASCADE")


def test_charts_read_merged_tables_from_storage(spark, monkeypatch):
    """Merged tables were cached whole, in partitions that are not joined."""
    rows = [(10, "Encounter", 1, 1, False), (20, "Condition", 1, 1, False), (30, "Organization", 1, 1, False)]
    root = scratch_dir(spark, "merged-silver")
    refresh_all(spark, _tiny(spark, rows), root, batch_id=1)
    kept = []
    for cls in {type(spark.range(1)), *type(spark.range(1)).__mro__} - {object}:
        if "persist" in vars(cls):
            monkeypatch.setattr(cls, "persist", lambda self, *a, **k: kept.append(1) or self)
    paths = refresh_all(spark, _tiny(spark, [*rows, (11, "Encounter", 1, 3, False)]), root, batch_id=2)
    assert not kept
    counts = {"encounters": 2, "conditions": 1, "organizations": 1}
    assert {n: read_model(spark, paths[n], n).count() for n in counts} == counts
    assert read_table(spark, f"{root}/_merged/encounters").count() == 2
    assert sum(r.total for r in read_table(spark, paths["encounter_class"]).collect()) == 2


def test_full_builds_parse_bodies_after_the_ranges_are_known(spark, bronze, monkeypatch):
    """a range shuffle computes its input twice, so parsing below it was done twice."""
    from silverline.plans import incremental

    stored = []

    def write_table(df, path, *args, **kwargs):
        stored.append((df, kwargs.get("range_partition", False)))
        return real(df, path, *args, **kwargs)

    real = incremental.write_table
    monkeypatch.setattr(incremental, "write_table", write_table)
    target = f"{scratch_dir(spark, 'ranges')}/encounters"
    got = incremental.append_delta(bronze, "encounters", target, 1)
    (df, again), = stored
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert not again and plan.index("json_doc") < plan.index("repartitionbyexpression")
    assert got.drop(*incremental.INTERNAL).exceptAll(incremental.build_full(bronze, "encounters")).count() == 0
    spans = sorted(tuple(r)[1:] for r in got.selectExpr("input_file_name() as f", "encounter_id").groupBy("f").agg(
        F.min("encounter_id"), F.max("encounter_id")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
