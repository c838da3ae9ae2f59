
import datetime as dt

from silverline.plans.models import Models
from silverline.sources.bronze import SCHEMAS, Bronze

T0 = dt.datetime(2024, 1, 1)
EPOCH = dt.datetime(1970, 1, 1)


def _meta(rid, rtype, updated=T0, deleted_at=EPOCH, tomb=0):
    return (rid, f"f{rid}", rtype, 1, T0, updated, deleted_at, 1, tomb)


def _body(rid, text):
    return (rid, 1, text, 2, 0)


def _link(path, src_type, src, tgt_type, tgt):
    return (path, src_type, src, tgt_type, tgt, T0, 1, 0)


def _bronze(spark, meta, bodies, links):
    return Bronze(spark.createDataFrame(meta, SCHEMAS["hfj_resource"]),
                  spark.createDataFrame(bodies, SCHEMAS["hfj_res_ver"]),
                  spark.createDataFrame(links, SCHEMAS["hfj_res_link"]),
                  spark.createDataFrame([], SCHEMAS["hfj_spidx_token"]))


def _fixture(spark):
    later = T0 + dt.timedelta(days=9)
    meta = [
        _meta(1, "Organization"), _meta(2, "Organization"), _meta(3, "Organization"),
        _meta(10, "Encounter"), _meta(11, "Encounter"),
        _meta(12, "Encounter", deleted_at=T0),                 # soft-deleted visit
        _meta(20, "CarePlan"), _meta(21, "CarePlan"),
        _meta(30, "Patient", updated=later, deleted_at=later),  # newest, soft-deleted
        _meta(31, "Patient", updated=later + dt.timedelta(days=1), tomb=1),  # newest, tombstone
    ]
    bodies = [
        _body(1, '{"name":"PKM A"}'), _body(2, '{"name":"PKM A"}'), _body(3, '{}'),
        _body(10, '{"status":"finished"}'), _body(11, '{"status":"finished"}'),
        _body(12, '{"status":"finished"}'),
        _body(20, '{"category":[{"coding":[{"display":"Weight faltering"}]}]}'),
        _body(21, '{"category":[{"coding":[{"display":"Diet"}]}]}'),
        _body(30, '{}'), _body(31, '{}'),
    ]
    sp, cp = "Encounter.serviceProvider", "CarePlan.encounter"
    links = [
        _link(sp, "Encounter", 10, "Organization", 1),
        _link(sp, "Encounter", 11, "Organization", 2),
        _link(sp, "Encounter", 12, "Organization", 1),   # link of a deleted visit
        _link(sp, "Encounter", 13, "Organization", 3),   # link of a visit not in bronze
        _link(cp, "CarePlan", 20, "Encounter", 10),
        _link(cp, "CarePlan", 21, "Encounter", 11),
    ]
    return Models(_bronze(spark, meta, bodies, links))


def test_utilisation_counts_links_not_live_visits(spark):
    rows = {r.nama_puskesmas: r.jumlah_kunjungan
            for r in _fixture(spark)["utilisasi_faskes"].collect()}
    assert rows == {"PKM A": 3, "": 1}


def test_visit_trend_counts_live_visits_only(spark):
    rows = [(r.nama_puskesmas, r.jumlah_kunjungan)
            for r in _fixture(spark)["encounter_trend_per_faskes"].collect()]
    assert rows == [("PKM A", 2)]


def test_weight_faltering_counts_every_care_plan(spark):
    rows = [(r.nama_puskesmas, r.jumlah_kasus)
            for r in _fixture(spark)["weight_faltering_per_faskes"].collect()]
    assert rows == [("PKM A", 2)]


def test_kpi_freshness_and_distinct_facility_names(spark):
    k = _fixture(spark)["kpi_totals"].first()
    # soft-deleted rows count for freshness, tombstoned ones do not
    assert k.data_terakhir_diperbarui == T0 + dt.timedelta(days=9)
    # '' is a name of its own: "PKM A" and "" have provider links
    assert k.puskesmas_aktif == 2
    assert (k.total_pasien, k.total_kunjungan) == (0, 2)


def test_daily_bp_mean_is_null_when_nothing_positive(spark):
    def obs(rid, day, name, value):
        return _body(rid, '{"effectiveDateTime":"2024-01-%02dT08:00:00+07:00",'
                          '"code":{"coding":[{"code":"8480-6","display":"%s"}]},'
                          '"valueQuantity":{"value":%s}}' % (day, name, value))
    meta = [_meta(i, "Observation") for i in (1, 2, 3, 4)]
    bodies = [obs(1, 2, "Systolic blood pressure", "0"), obs(2, 2, "Diastolic blood pressure", '"n/a"'),
              obs(3, 3, "Systolic blood pressure", "120"), obs(4, 3, "Systolic blood pressure", "140")]
    m = Models(_bronze(spark, meta, bodies, []))
    rows = {r.tanggal_periksa.day: (r.rata_sistol, r.rata_diastol)
            for r in m["tren_tensi_harian"].collect()}
    assert rows == {2: (None, None), 3: (130.0, None)}
