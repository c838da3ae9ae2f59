"""Chart tables M09-M20 (and T2): group/count/avg over the silver models.

Inputs are silver DataFrames already reduced to their final version (C6);
outputs are full-rebuild tables.  Joins with the facility dimension are
done after aggregating the large side on the join key, so the dimension
join sees one row per (group, facility id) instead of one per visit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.functions.scalars import (DIAGNOSED, DIASTOLIC, LOINC_BLOOD_PRESSURE,
                                          NOT_DIAGNOSED, PTM_DIABETES, PTM_HYPERTENSION,
                                          SYSTOLIC, bp_category, to_date_of)
from silverline.operators.cdc import TOKEN_KEYS, final
from silverline.operators.links import (CAREPLAN_ENCOUNTER, ENCOUNTER_SERVICE_PROVIDER,
                                        edges, membership_flag)


def _count_star(name: str):
    return F.count(F.lit(1)).alias(name)


def _facility_names(organizations: DataFrame) -> DataFrame:
    return organizations.select(F.col("organization_id").alias("_org_id"), "nama_puskesmas")


def _sum_by_name(counted: DataFrame, organizations: DataFrame, target: str,
                 group_cols: list[str], name: str) -> DataFrame:
    """Join per-facility-id partial counts to facility names and add them up."""
    orgs = _facility_names(organizations)
    joined = counted.join(orgs, counted[target] == orgs["_org_id"], "inner")
    return joined.groupBy(*group_cols, "nama_puskesmas").agg(F.sum("_n").cast("bigint").alias(name))


def kpi_totals(resource: DataFrame, conditions: DataFrame, res_link: DataFrame,
               organizations: DataFrame, bronze_live: DataFrame) -> DataFrame:
    """One row of headline numbers; one scan per source (A10).

    ``bronze_live`` is bronze metadata FINAL without tombstones (soft-deleted
    rows included), the source of the freshness time.
    """
    live_r = ~F.col("is_deleted")
    rs = resource.agg(
        F.count_if((F.col("res_type") == "Patient") & live_r).alias("total_pasien"),
        F.count_if((F.col("res_type") == "Encounter") & live_r).alias("total_kunjungan"),
        F.count_if((F.col("res_type") == "Condition") & live_r).alias("total_diagnosis_tercatat"))
    cs = conditions.agg(
        F.count_if(F.col("kategori_ptm") == PTM_HYPERTENSION).alias("kasus_hipertensi"),
        F.count_if(F.col("kategori_ptm") == PTM_DIABETES).alias("kasus_diabetes"))
    # count(DISTINCT name) over links JOIN organizations: the names of the
    # facilities that have at least one provider link (semi join on the
    # distinct target ids), exact and without the per-visit fan-out.
    targets = edges(res_link, ENCOUNTER_SERVICE_PROVIDER, "Encounter", "Organization") \
        .select(F.col("target_resource_id").alias("_org_id")).distinct()
    fk = organizations.join(targets, organizations["organization_id"] == targets["_org_id"],
                            "left_semi") \
        .agg(F.countDistinct("nama_puskesmas").alias("puskesmas_aktif"))
    fr = bronze_live.agg(F.max("res_updated").alias("data_terakhir_diperbarui"))
    # J6 without a join: every part is a single-row aggregate, so the parts are
    # stacked (four rows, each filling its own columns) and folded into one row.
    return _one_row([rs, cs, fk, fr], KPI_COLUMNS)


KPI_COLUMNS = ("total_pasien", "total_kunjungan", "total_diagnosis_tercatat", "puskesmas_aktif",
               "kasus_hipertensi", "kasus_diabetes", "data_terakhir_diperbarui")


def _one_row(parts: list[DataFrame], columns: tuple[str, ...]) -> DataFrame:
    """Combine single-row aggregates into one row (what a 1x1 cross join gives)."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in columns])


def encounter_class(encounters: DataFrame) -> DataFrame:
    """Visits by class code."""
    return encounters.groupBy(F.col("class_code").alias("encounter_class")).agg(_count_star("total"))


def resource_daily_growth(resource: DataFrame) -> DataFrame:
    """Resources by publish day and type (soft-deleted included)."""
    return resource.groupBy(to_date_of("res_published").alias("ingest_date"), "res_type") \
        .agg(_count_star("total"))


def top_diagnosis(conditions: DataFrame) -> DataFrame:
    """Diagnoses by code and name, all groups (the chart takes the top 10)."""
    return conditions.groupBy(F.col("icd10_code").alias("kode_icd10"),
                              F.col("diagnosis_name").alias("nama_diagnosis")) \
        .agg(_count_star("jumlah_kasus"))


def top_k_diagnosis(conditions: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent diagnoses, ties broken by code then name."""
    return top_diagnosis(conditions).orderBy(F.desc("jumlah_kasus"), "kode_icd10", "nama_diagnosis") \
        .limit(k)


def penyakit_prioritas_trend(conditions: DataFrame) -> DataFrame:
    """Hypertension and diabetes cases by day and diagnosis name."""
    return conditions.where(F.col("kategori_ptm").isin(PTM_HYPERTENSION, PTM_DIABETES)) \
        .groupBy(F.col("tanggal_diagnosis").alias("tanggal_layanan"),
                 F.col("kategori_ptm").alias("kategori_penyakit"),
                 F.col("diagnosis_name").alias("nama_diagnosis")) \
        .agg(_count_star("jumlah_kasus"))


def utilisasi_faskes(res_link: DataFrame, organizations: DataFrame) -> DataFrame:
    """Provider links per facility name (links, not live visits, are counted)."""
    per_org = edges(res_link, ENCOUNTER_SERVICE_PROVIDER, "Encounter", "Organization") \
        .groupBy("target_resource_id").agg(F.count(F.lit(1)).alias("_n"))
    return _sum_by_name(per_org, organizations, "target_resource_id", [], "jumlah_kunjungan")


def encounter_trend_per_faskes(encounters: DataFrame, res_link: DataFrame,
                               organizations: DataFrame) -> DataFrame:
    """Live visits by day and facility (no target-type test, as in the model)."""
    provider = edges(res_link, ENCOUNTER_SERVICE_PROVIDER, "Encounter",
                     src_as="_enc_id", target_as="_org")
    visits = encounters.select("encounter_id", "tanggal_kunjungan")
    per_org = visits.join(provider, visits["encounter_id"] == provider["_enc_id"], "inner") \
        .groupBy("tanggal_kunjungan", "_org").agg(F.count(F.lit(1)).alias("_n"))
    return _sum_by_name(per_org, organizations, "_org", ["tanggal_kunjungan"], "jumlah_kunjungan")


def bp_readings(observations: DataFrame) -> DataFrame:
    """Systolic and diastolic value per patient and day (A7: pivot by conditional max)."""
    return observations.where(F.col("loinc_code") == LOINC_BLOOD_PRESSURE) \
        .groupBy("patient_ref", "tanggal_periksa") \
        .agg(F.max(F.when(F.col("nama_pengukuran") == SYSTOLIC, F.col("nilai"))).alias("sistol"),
             F.max(F.when(F.col("nama_pengukuran") == DIASTOLIC, F.col("nilai"))).alias("diastol"))


def diagnosed_hypertensive(conditions: DataFrame) -> DataFrame:
    """Distinct patients with a formal hypertension diagnosis."""
    return conditions.where(F.col("kategori_ptm") == PTM_HYPERTENSION).select("patient_ref").distinct()


def deteksi_dini_hipertensi(observations: DataFrame, conditions: DataFrame) -> DataFrame:
    """Patients per BP class x whether a hypertension diagnosis exists.

    A patient is counted once per class they were measured in (per day
    classification, then distinct patients).  The (patient, class) pairs are
    made distinct before the membership join, so a patient with thousands of
    readings (or the ``''`` patient of readings without a subject) reaches
    the join as at most one row per class; counting those rows is then the
    exact ``count(DISTINCT patient_ref)``.
    """
    classified = bp_readings(observations) \
        .select("patient_ref", bp_category("sistol", "diastol").alias("kategori_tensi")) \
        .where(F.col("kategori_tensi").isNotNull()) \
        .distinct()
    flagged = membership_flag(classified, "patient_ref", diagnosed_hypertensive(conditions),
                              "patient_ref", DIAGNOSED, NOT_DIAGNOSED, "status_diagnosis")
    return flagged.groupBy("kategori_tensi", "status_diagnosis").agg(_count_star("jumlah_pasien"))


# A reference whose number is a bit: canonical, so that equal numbers are equal texts.
NUMBERED_PATIENT = r"^Patient/(0|[1-9][0-9]{0,17})\z"


def daily_bp_patients(observations: DataFrame) -> DataFrame:
    """A5, mergeable: the patients of each day and BP class as bitmaps of their numbers.

    ``tanggal_periksa, kategori_tensi, part, patients, other``: a bitmap for
    each run of 32,768 numbers (``part``), or, where the reference is no
    number, the reference itself in ``other``.  A day's rows depend on that day's readings only, so
    they can be stored by day and merged.
    """
    classified = bp_readings(observations).select(
        "tanggal_periksa", "patient_ref", bp_category("sistol", "diastol").alias("kategori_tensi")) \
        .where(F.col("kategori_tensi").isNotNull())
    return _bitmaps(classified, "patient_ref", ["tanggal_periksa", "kategori_tensi"])


def _bitmaps(df: DataFrame, ref: str, by: list[str]) -> DataFrame:
    number = F.regexp_extract(F.col(ref), NUMBERED_PATIENT, 1)
    numbered = df.where(number != "").select(*by, number.cast("long").alias("_id")) \
        .groupBy(*by, F.bitmap_bucket_number("_id").alias("part")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("patients")) \
        .withColumn("other", F.lit(None).cast("string"))
    others = df.where((number == "") & F.col(ref).isNotNull()).select(
        *by, F.lit(None).cast("long").alias("part"), F.lit(None).cast("binary").alias("patients"),
        F.col(ref).alias("other")).distinct()
    return numbered.unionByName(others)


def deteksi_dini_from_days(days: DataFrame, conditions: DataFrame) -> DataFrame:
    """M16 from stored days: bitmaps merged by OR, no reading is touched again; equals ``countDistinct``.

    Patients of a class with a diagnosis: |class| + |diagnosed| - |class or diagnosed|.
    """
    sick = _bitmaps(diagnosed_hypertensive(conditions), "patient_ref", [])
    merged = days.where("part IS NOT NULL").groupBy("kategori_tensi", "part") \
        .agg(F.bitmap_or_agg("patients").alias("patients"))
    known = sick.where("part IS NOT NULL").select(F.col("part").alias("_part"), F.col("patients").alias("_sick"))
    # one bitmap a part on either side: OR of the two is their count together
    both = merged.join(known, merged["part"] == known["_part"], "left").select(
        "kategori_tensi", "part", F.array("patients", F.coalesce("_sick", "patients")).alias("two"),
        F.bitmap_count("patients").alias("_all"), F.coalesce(F.bitmap_count("_sick"), F.lit(0)).alias("_ill"),
        F.col("_sick").isNotNull().alias("_any"))
    counted = both.select("kategori_tensi", "part", "_all", "_ill", "_any", F.explode("two").alias("one")) \
        .groupBy("kategori_tensi", "part", "_all", "_ill", "_any") \
        .agg(F.bitmap_count(F.bitmap_or_agg("one")).alias("_union")) \
        .select("kategori_tensi", "_all", F.when(F.col("_any"), F.col("_all") + F.col("_ill") - F.col("_union"))
                .otherwise(0).alias("_diagnosed"))
    others = days.where("other IS NOT NULL").select("kategori_tensi", "other").distinct()
    ill = sick.where("other IS NOT NULL").select(F.col("other").alias("_other")).distinct()
    others = others.join(ill, others["other"] == ill["_other"], "left").select(
        "kategori_tensi", F.lit(1).cast("long").alias("_all"),
        F.col("_other").isNotNull().cast("long").alias("_diagnosed"))
    total = counted.unionByName(others).groupBy("kategori_tensi").agg(
        F.sum("_all").alias("_all"), F.sum("_diagnosed").alias("_diagnosed"))
    return total.select("kategori_tensi", F.inline(F.array(
        F.struct(F.lit(DIAGNOSED).alias("status_diagnosis"), F.col("_diagnosed").cast("bigint").alias("jumlah_pasien")),
        F.struct(F.lit(NOT_DIAGNOSED).alias("status_diagnosis"),
                 (F.col("_all") - F.col("_diagnosed")).cast("bigint").alias("jumlah_pasien"))))) \
        .where("jumlah_pasien > 0")


def tren_tensi_harian(observations: DataFrame) -> DataFrame:
    """Daily mean systolic / diastolic over positive readings (NULL when none)."""
    positive = F.col("nilai") > 0
    return observations.where(F.col("loinc_code") == LOINC_BLOOD_PRESSURE) \
        .groupBy("tanggal_periksa") \
        .agg(F.avg(F.when((F.col("nama_pengukuran") == SYSTOLIC) & positive, F.col("nilai")))
              .alias("rata_sistol"),
             F.avg(F.when((F.col("nama_pengukuran") == DIASTOLIC) & positive, F.col("nilai")))
              .alias("rata_diastol"))


def weight_faltering_per_faskes(careplans: DataFrame, res_link: DataFrame,
                                organizations: DataFrame) -> DataFrame:
    """Care plans by day and facility, two link hops (every plan counts)."""
    cp_enc = edges(res_link, CAREPLAN_ENCOUNTER, "CarePlan", src_as="_cp", target_as="_enc")
    enc_org = edges(res_link, ENCOUNTER_SERVICE_PROVIDER, "Encounter", src_as="_enc2", target_as="_org")
    plans = careplans.select("careplan_id", "tanggal")
    hop1 = plans.join(cp_enc, plans["careplan_id"] == cp_enc["_cp"], "inner")
    hop2 = hop1.join(enc_org, hop1["_enc"] == enc_org["_enc2"], "inner")
    per_org = hop2.groupBy("tanggal", "_org").agg(F.count(F.lit(1)).alias("_n"))
    return _sum_by_name(per_org, organizations, "_org", ["tanggal"], "jumlah_kasus")


def resource_type_summary(resource: DataFrame) -> DataFrame:
    """Total / active / deleted resources by type."""
    return resource.groupBy("res_type").agg(
        _count_star("total"),
        F.count_if(~F.col("is_deleted")).alias("active"),
        F.count_if(F.col("is_deleted")).alias("deleted"))


def clinical_status_summary(hfj_spidx_token: DataFrame) -> DataFrame:
    """Status tokens by resource type, straight from the bronze search index."""
    tokens = final(hfj_spidx_token, TOKEN_KEYS).where(F.col("sp_name") == "status")
    return tokens.groupBy("res_type", F.col("sp_value").alias("status")).agg(_count_star("total"))
