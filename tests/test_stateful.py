"""The stateful stream: late bodies, deletes, undeletes, late rows, replays, and what a micro-batch reads."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from silverline.plans.incremental import read_model
from silverline.session import scratch_dir
from silverline.sinks.tables import current_version
from silverline.sources.bronze import SCHEMAS
from silverline.streaming import stateful

EPOCH = dt.datetime(1970, 1, 1)
T0 = dt.datetime(2024, 1, 1)


def meta(rid, ver, days=0, deleted=False, tomb=0, cdc=None, kind="Encounter"):
    at = T0 + dt.timedelta(days=days)
    return (rid, f"f{rid}", kind, ver, T0, at, at if deleted else EPOCH, ver if cdc is None else cdc, tomb)


def body(rid, ver, status="finished", cdc=2, tomb=0):
    return (rid, ver, f'{{"status":"{status}","class":{{"code":"AMB"}}}}', cdc, tomb)


class Run:
    def __init__(self, spark, bound=stateful.NO_BOUND):
        self.spark, self.root, self.bound = spark, scratch_dir(spark, "stateful-test"), bound
        self.targets = {"encounters": f"{self.root}/encounters"}

    def land(self, metas=(), bodies=()):
        for name, rows in (("hfj_resource", metas), ("hfj_res_ver", bodies)):
            self.spark.createDataFrame(list(rows), SCHEMAS[name]).coalesce(1).write.mode("append") \
                .parquet(f"{self.root}/bronze/{name}")
        q = stateful.ingest_changes(self.spark, f"{self.root}/bronze", self.targets, f"{self.root}/late",
                                    f"{self.root}/ckpt", self.bound)
        q.awaitTermination()
        return q

    def rows(self):
        return {r.encounter_id: r.status for r in read_model(self.spark, self.targets["encounters"], "encounters").collect()}

    def late(self):
        return sorted((r.res_id, r.res_ver) for r in stateful.read_late(self.spark, f"{self.root}/late").collect())


@pytest.fixture(scope="module")
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_late_body_delete_undelete_stale_and_replayed_rows(spark, few_partitions):
    run = Run(spark)
    run.land([meta(1, 1), meta(2, 1), meta(3, 1), meta(9, 1, kind="Patient")], [body(1, 1), body(2, 1), body(9, 1)])
    assert run.rows() == {1: "finished", 2: "finished"}
    # 3's body is late; 2 is soft-deleted; 1 gets version 2 without its body; 4 lands whole, with an old body copy
    run.land([meta(2, 2, 1, deleted=True), meta(1, 2, 1), meta(4, 1)], [body(3, 1), body(4, 1), body(4, 1, "stale", 1)])
    assert run.rows() == {3: "finished", 4: "finished"}
    # 2 is undeleted, 1's body lands, 3 is a tombstone, 4's body is tombstoned; 1's old version comes once more
    run.land([meta(2, 3, 2), meta(3, 2, 2, tomb=1), meta(1, 1)],
             [body(2, 3, "planned"), body(1, 2, "in-progress"), body(4, 1, cdc=3, tomb=1)])
    assert run.rows() == {2: "planned", 1: "in-progress"}
    run.land([meta(2, 3, 2)], [body(2, 3, "planned")])  # all known already
    assert run.rows() == {2: "planned", 1: "in-progress"} and run.late() == []


def test_rows_later_than_the_bound_are_stored_apart(spark, few_partitions):
    run = Run(spark, "10 days")
    run.land([meta(1, 1, 100)], [body(1, 1), body(2, 1), body(3, 1), body(4, 1), body(1, 2)])
    run.land([meta(2, 1, 90), meta(3, 1, 89), meta(4, 1, 300), meta(1, 2, 0, deleted=True)])
    assert run.rows() == {1: "finished", 2: "finished", 4: "finished"}
    assert run.late() == [(1, 2), (3, 1)]


def test_a_micro_batch_reads_no_stored_rows(spark, few_partitions):
    run = Run(spark)
    run.land([meta(1, 1)], [body(1, 1)])
    q = run.land([meta(2, 1)], [body(2, 1)])
    plan = q._jsq.explainInternal(False)
    assert "FlatMapGroupsInPandasWithState" in plan
    assert run.rows() == {1: "finished", 2: "finished"}
    read = [s["numInputRows"] for p in q.recentProgress for s in p["sources"]]
    assert sum(read) == 2  # one row of metadata and one body: what has landed since


def test_state_is_kept_for_groups_of_ids(spark, few_partitions):
    """One call of the operator (and one state row) an id was most of the stream's time."""
    run = Run(spark)
    ids = range(1024, 1024 + 1500)
    q = run.land([meta(i, 1) for i in ids], [body(i, 1) for i in ids])
    assert run.rows() == {i: "finished" for i in ids}
    assert max(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]) == 2
    run.land([meta(2000, 2, 1, deleted=True), meta(2001, 2, 1)], [body(2001, 2, "planned"), body(7, 1)])
    assert run.rows() == {**{i: "finished" for i in ids if i != 2000}, 2001: "planned"}


def test_null_ids_and_versions_have_a_group_too(spark, few_partitions):
    run = Run(spark)
    run.land([meta(1, 1), meta(2, 1), (2, "f2", "Encounter", None, T0, T0 + dt.timedelta(days=1), EPOCH, 5, 0), meta(None, 1)],
             [body(1, 1), body(2, 1), body(2, None)])
    assert run.rows() == {1: "finished"}
    run.land([], [body(None, 1)])
    assert run.rows() == {1: "finished", None: "finished"}


def test_a_batch_stores_one_file_a_partition_and_model(spark):
    """Changed rows and delete markers of a partition took a task and a file each, for every model."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        run = Run(spark)
        run.land([meta(1, 1), meta(2, 1)], [body(1, 1), body(2, 1)])
        before = set(spark.read.parquet(current_version(spark, run.targets["encounters"])).inputFiles())
        run.land([meta(1, 2, 1, deleted=True), meta(3, 1)], [body(3, 1)])
        after = set(spark.read.parquet(current_version(spark, run.targets["encounters"])).inputFiles())
        assert len(after - before) == 1 and run.rows() == {2: "finished", 3: "finished"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_small_landings_need_no_more_state_partitions_than_cores(spark):
    """Every partition of the state opens a store and a Python worker in each micro-batch."""
    old, cores = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(2 * cores))
    try:
        run = Run(spark)
        for k in (1, 2):
            q = run.land([meta(1024 * k, 1)], [body(1024 * k, 1)])
            assert {s["numShufflePartitions"] for p in q.recentProgress for s in p["stateOperators"]} == {cores}
        assert run.rows() == {1024: "finished", 2048: "finished"}
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(2 * cores)
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert stateful.state_partitions(spark, f"{run.root}/bronze") == 1  # the session's at most
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_state_partitions_grow_with_what_lands(spark, monkeypatch):
    run, old, cores = Run(spark), spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.defaultParallelism
    run.land([meta(1, 1)], [body(1, 1)])
    spark.conf.set("spark.sql.shuffle.partitions", str(4 * cores))
    try:
        assert stateful.state_partitions(spark, f"{run.root}/bronze") == cores
        monkeypatch.setattr(stateful, "STATE_PARTITION_BYTES", 1)
        assert stateful.state_partitions(spark, f"{run.root}/bronze") == 4 * cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


class Kept:
    """A group's state, as the operator sees it."""

    def __init__(self):
        self.value, self.watermark = None, 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def getCurrentWatermarkMs(self):
        return self.watermark


def landed_rows(rows):
    """(id, version or None, is metadata, updated, deleted_at, cdc, tombstone, text) as the operator gets them."""
    flags = [stateful.META * m + stateful.NO_VERSION * (v is None) for _, v, m, *_ in rows]
    columns = {"res_id": [r[0] for r in rows], "flags": flags, "res_ver": [r[1] or 0 for r in rows],
               "published": [7] * len(rows), "updated": [r[3] for r in rows], "deleted_at": [r[4] for r in rows],
               "cdc": [r[5] for r in rows], "tombstone": [r[6] for r in rows]}
    return pd.DataFrame({**{c: np.array(v, np.int64) for c, v in columns.items()},
                         "res_text_vc": np.array([r[7] for r in rows], object)})


def changed(frames):
    """The operator's output, a row for each change."""
    width = len(stateful.NUMBERS) + 1
    rows = [(*numbers[k * width:(k + 1) * width], text) for f in frames for numbers, texts in f.itertuples(index=False)
            for k, text in enumerate(texts)]
    return pd.DataFrame(rows, columns=[*stateful.NUMBERS, "what", "res_text_vc"])


def by_row(kept, rows, watermark):
    """The same update, a row after the other, as its definition has it."""
    out, touched = [], set()
    for rid, ver, is_meta, updated, deleted, cdc, tombstone, text in rows:
        one = kept.setdefault(rid, {"meta": None, "bodies": {}, "shown": None})
        touched.add(rid)
        if is_meta and updated // 1000 < watermark:
            out.append((rid, ver, updated, cdc, tombstone, None, stateful.LATE))
        elif is_meta and (one["meta"] is None or (cdc, tombstone) > one["meta"][2:4]):
            one["meta"] = (ver, updated, cdc, tombstone, deleted)
        elif not is_meta and (ver not in one["bodies"] or (cdc, tombstone) > one["bodies"][ver][:2]):
            one["bodies"][ver] = (cdc, tombstone, text)
    for rid in touched:
        one = kept[rid]
        if one["meta"] is None:
            continue
        ver, updated, cdc, tombstone, deleted = one["meta"]
        if ver is not None:
            one["bodies"] = {v: b for v, b in one["bodies"].items() if v >= ver}
        body = one["bodies"].get(ver)
        current = not tombstone and not deleted and body is not None and not body[1]
        shown = (one["meta"], body[0]) if current else None
        if shown != one["shown"]:
            out.append((rid, ver, updated, cdc, tombstone, body[2] if current else None,
                        stateful.CURRENT if current else stateful.GONE))
        one["shown"] = shown
    return sorted(out, key=repr)


def test_a_group_is_folded_at_once_as_row_by_row():
    rng = np.random.default_rng(5)
    seen = set()
    for ids in (3, 40):
        fold, state, kept = stateful.folder(), Kept(), {}
        for batch in range(40):
            state.watermark = 0 if batch < 10 else 3 * batch
            rows = []
            for _ in range(rng.integers(0, 60) + 1):
                is_meta = bool(rng.integers(2))
                ver = int(rng.integers(1, 5)) if rng.integers(9) or not is_meta else None
                cdc, tombstone = int(rng.integers(1, 9)), int(rng.integers(5) == 0)
                # equal order, equal row: which of two such copies is kept is nobody's to say
                key = f"{ver}.{cdc}.{tombstone}"
                updated = (4 * cdc + 60 * (cdc % 3)) * 1000 if is_meta else 0
                deleted = int(is_meta and cdc % 4 == 3)
                ver = ver if not is_meta else (None if cdc == 8 else cdc // 2 + 1)
                text = None if is_meta or cdc == 5 else f'{{"x":"{key}é"}}'
                rows.append((int(rng.integers(-1, ids)), ver, is_meta, updated, deleted, cdc, tombstone, text))
            cut = int(rng.integers(len(rows)))
            frames = [landed_rows(part) for part in (rows[:cut], rows[cut:]) if part]
            got = changed(fold((0,), iter(frames), state))
            found = [(int(r.res_id), None if r.flags & stateful.NO_VERSION else int(r.res_ver), int(r.updated), int(r.cdc),
                      int(r.tombstone), r.res_text_vc, int(r.what)) for r in got.itertuples()]
            assert sorted(found, key=repr) == by_row(kept, rows, state.watermark)
            seen |= set(got["what"])
    assert seen == {stateful.CURRENT, stateful.GONE, stateful.LATE}


def test_a_groups_state_is_smaller_than_its_bodies():
    """F1: a state was one JSON text, written and read anew in every micro-batch, larger than the bodies it held."""
    texts = [body(i, 1)[2].replace("AMB", f"AMB{i * i}") for i in range(1000)]
    state = Kept()
    rows = [(i, 1, True, 0, 0, 1, 0, None) for i in range(1000)] + [(i, 1, False, 0, 0, 2, 0, t) for i, t in enumerate(texts)]
    out = changed(stateful.folder()((0,), iter([landed_rows(rows)]), state))
    assert sorted(out["res_text_vc"]) == sorted(texts)
    assert len(state.get[0]) < sum(map(len, texts)) / 2


def test_changes_leave_the_operator_in_pieces():
    """F1: each row of the operator's output costs several microseconds, whatever it holds."""
    for size, rows_each in ((10, 16), (1000, 6), (20000, 1)):
        rows = [(i, 1, True, 0, 0, 1, 0, None) for i in range(100)] + [(i, 1, False, 0, 0, 2, 0, "x" * size) for i in range(100)]
        frames = list(stateful.folder()((0,), iter([landed_rows(rows)]), Kept()))
        assert sorted(changed(frames)["res_id"]) == list(range(100))
        assert sum(map(len, frames)) == -(-100 // rows_each)
