"""Every registered query against its DuckDB oracle on the smallest test tables.

The driver repeats this at sf0.01; here sf0.001 keeps the suite quick.
FIXTURES.md section 3 gives the expected row counts checked below.
"""

import os

import pytest

import __spark_entry__ as entry_mod
from oracle_check import compare, duck

SF = os.environ.get("SILVERLINE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {n: q for n, q in entry_mod.queries().items() if n not in entry_mod.LLM_QUERIES}
ORACLE = {n: q for n, q in entry_mod.oracle_sql().items() if n not in entry_mod.LLM_QUERIES}

EXPECTED_ROWS_SF0001 = {
    "scan_hfj_resource": 4050, "scan_hfj_res_ver": 4716, "scan_hfj_res_link": 3618,
    "scan_hfj_spidx_token": 3221, "resource": 3115, "organizations": 9, "encounters": 1225,
    "conditions": 409, "observations": 815, "careplans": 175, "res_link": 3099, "patients": 1170,
    "kpi_totals": 1, "encounter_class": 3, "resource_daily_growth": 1682, "top_diagnosis": 5,
    "penyakit_prioritas_trend": 226, "utilisasi_faskes": 9, "encounter_trend_per_faskes": 963,
    "deteksi_dini_hipertensi": 6, "tren_tensi_harian": 32, "weight_faltering_per_faskes": 142,
    "resource_type_summary": 6, "clinical_status_summary": 4,
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, QUERIES, ORACLE, con)
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["values_match"]
    if SF.endswith("sf0.001") and name in EXPECTED_ROWS_SF0001:
        assert r["spark_rows"] == EXPECTED_ROWS_SF0001[name]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["kategori_tensi", "status_diagnosis", "jumlah_pasien"]
    assert df.count() == 6
