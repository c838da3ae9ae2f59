"""Silver models M01-M08: clean, typed tables extracted from bronze.

Every function takes bronze DataFrames and returns the full-rebuild result
of one model.  Incremental loading (C5 and the append) is layered on top in
``incremental.py``; these functions accept a ``current`` frame (the output
of ``current_resources``) so a refresh computes it once for all five
resource models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.functions.scalars import (fhir_date, ptm_category, to_date_of,
                                          to_double_or_null, with_json_fields)
from silverline.operators.cdc import (LINK_KEYS, current_resources, drop_tombstones, final_links,
                                      final_metadata, is_deleted, live)
from silverline.operators.links import ENCOUNTER_SUBJECT
from silverline.sources.bronze import Bronze

# Model -> (FHIR resource type, id column); the five models built on C8.
RESOURCE_MODELS = {
    "organizations": ("Organization", "organization_id"),
    "encounters": ("Encounter", "encounter_id"),
    "conditions": ("Condition", "condition_id"),
    "observations": ("Observation", "observation_id"),
    "careplans": ("CarePlan", "careplan_id"),
}

# Stored sort keys (K5) and dedup keys of each model.
SORT_KEYS = {
    "resource": ["res_type", "res_id"],
    "organizations": ["organization_id"],
    "encounters": ["encounter_id"],
    "conditions": ["condition_id"],
    "observations": ["observation_id"],
    "careplans": ["careplan_id"],
    "res_link": list(LINK_KEYS),
    "patients": ["patient_res_id"],
}
VERSION_COLUMN = {"res_link": "sp_updated"}  # others: res_updated


def of_type(b: Bronze, res_type: str, current: DataFrame | None) -> DataFrame:
    """C8 of one type, from the run's shared ``current`` if there is one."""
    if current is None:
        return current_resources(b.hfj_resource, b.hfj_res_ver, res_type)
    return current.where(F.col("res_type") == res_type)


def _winners(b: Bronze, winners: DataFrame | None) -> DataFrame:
    return final_metadata(b.hfj_resource) if winners is None else winners


def resource(b: Bronze, winners: DataFrame | None = None) -> DataFrame:
    """Latest, non-tombstoned metadata of every resource, soft deletes flagged."""
    r = drop_tombstones(_winners(b, winners))
    return r.select("res_id", "res_type", "res_ver", "res_published", "res_updated",
                    is_deleted().alias("is_deleted"))


def organizations(b: Bronze, current: DataFrame | None = None) -> DataFrame:
    """Live facilities and their names."""
    c = with_json_fields(of_type(b, "Organization", current), "res_text_vc", {"nama_puskesmas": "$.name"})
    return c.select(F.col("res_id").alias("organization_id"), "nama_puskesmas", "res_updated")


def encounters(b: Bronze, current: DataFrame | None = None) -> DataFrame:
    """Live visits."""
    c = with_json_fields(of_type(b, "Encounter", current), "res_text_vc", {
        "status": "$.status", "class_code": "$.class.code", "patient_ref": "$.subject.reference"})
    return c.select(
        F.col("res_id").alias("encounter_id"),
        to_date_of("res_published").alias("tanggal_kunjungan"),
        "res_published", "res_updated", "status", "class_code", "patient_ref")


def conditions(b: Bronze, current: DataFrame | None = None) -> DataFrame:
    """Live diagnoses with the priority-disease class of their ICD-10 code."""
    c = with_json_fields(of_type(b, "Condition", current), "res_text_vc", {
        "patient_ref": "$.subject.reference", "icd10_code": "$.code.coding[0].code",
        "diagnosis_name": "$.code.coding[0].display", "clinical_status": "$.clinicalStatus.coding[0].code"})
    return c.select(
        F.col("res_id").alias("condition_id"),
        to_date_of("res_published").alias("tanggal_diagnosis"),
        "res_published", "res_updated", "patient_ref", "icd10_code", "diagnosis_name", "clinical_status",
        ptm_category("icd10_code").alias("kategori_ptm"))


def observations(b: Bronze, current: DataFrame | None = None) -> DataFrame:
    """Live measurements; bad dates become 1970-01-01, bad numbers NULL."""
    c = with_json_fields(of_type(b, "Observation", current), "res_text_vc", {
        "_effective": "$.effectiveDateTime", "patient_ref": "$.subject.reference",
        "encounter_ref": "$.encounter.reference", "loinc_code": "$.code.coding[0].code",
        "nama_pengukuran": "$.code.coding[0].display", "_value": "$.valueQuantity.value",
        "satuan": "$.valueQuantity.unit"}, numbers=("_value",))
    return c.select(
        F.col("res_id").alias("observation_id"), "res_updated",
        fhir_date("_effective").alias("tanggal_periksa"),
        "patient_ref", "encounter_ref", "loinc_code", "nama_pengukuran",
        to_double_or_null("_value").alias("nilai"), "satuan")


def careplans(b: Bronze, current: DataFrame | None = None) -> DataFrame:
    """Live care plans."""
    c = with_json_fields(of_type(b, "CarePlan", current), "res_text_vc", {
        "status": "$.status", "patient_ref": "$.subject.reference", "encounter_ref": "$.encounter.reference",
        "kategori_careplan": "$.category[0].coding[0].display", "deskripsi": "$.description"})
    return c.select(
        F.col("res_id").alias("careplan_id"),
        to_date_of("res_published").alias("tanggal"),
        "res_published", "res_updated", "status", "patient_ref", "encounter_ref", "kategori_careplan", "deskripsi")


def _link_winners(b: Bronze, link_winners: DataFrame | None) -> DataFrame:
    return final_links(b.hfj_res_link) if link_winners is None else link_winners


def res_link(b: Bronze, link_winners: DataFrame | None = None) -> DataFrame:
    """Latest, non-tombstoned resource links."""
    return drop_tombstones(_link_winners(b, link_winners)).select(
        "src_path", "source_resource_type", "src_resource_id",
        "target_resource_type", "target_resource_id", "sp_updated")


def patients(b: Bronze, winners: DataFrame | None = None,
             link_winners: DataFrame | None = None) -> DataFrame:
    """Live patients x their linked live encounters; unlinked patients kept once.

    ``p LEFT JOIN links LEFT JOIN encounters`` is evaluated as
    (links INNER JOIN patients) LEFT JOIN encounters, plus the patients with
    no link at all (left-anti against the distinct link targets).  Same rows,
    but a patient with a huge number of visits is an inner-join key that AQE
    can split, and the unlinked patients never enter the second join with a
    NULL key (which would hash them all into one task).
    """
    r = live(drop_tombstones(_winners(b, winners)))
    pts = r.where(F.col("res_type") == "Patient").select(
        F.col("res_id").alias("patient_res_id"), F.col("fhir_id").alias("patient_id"))
    encs = r.where(F.col("res_type") == "Encounter").select(
        F.col("res_id").alias("_enc_res_id"), F.col("fhir_id").alias("encounter_id"))
    # Only the path is tested here (no source/target type test, as in the model).
    links = drop_tombstones(_link_winners(b, link_winners)) \
        .where(F.col("src_path") == ENCOUNTER_SUBJECT) \
        .select(F.col("src_resource_id").alias("_src"), F.col("target_resource_id").alias("_target"))
    linked = links.join(pts, links["_target"] == pts["patient_res_id"], "inner")
    with_enc = linked.join(encs, linked["_src"] == encs["_enc_res_id"], "left") \
        .select("patient_res_id", "patient_id", "encounter_id")
    targets = links.select(F.col("_target")).distinct()
    unlinked = pts.join(targets, pts["patient_res_id"] == targets["_target"], "left_anti") \
        .select("patient_res_id", "patient_id", F.lit(None).cast("string").alias("encounter_id"))
    return with_enc.unionByName(unlinked)


SILVER_BUILDERS = {
    "resource": resource,
    "organizations": organizations,
    "encounters": encounters,
    "conditions": conditions,
    "observations": observations,
    "careplans": careplans,
    "res_link": res_link,
    "patients": patients,
}
