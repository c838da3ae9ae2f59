"""The 20 models wired together in dependency order.

``Models`` builds each model lazily from one ``Bronze`` and memoises the
DataFrames, so a chart that needs ``conditions`` and ``observations`` reuses
the same plan objects.  ``current`` (C8 over every type) is built once and
the five resource models filter it by type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from silverline.operators.cdc import (current_resources, drop_tombstones, final_links,
                                      final_metadata)
from silverline.plans import charts, silver
from silverline.sources.bronze import Bronze

SILVER_MODELS = ("resource", "organizations", "encounters", "conditions", "observations",
                 "careplans", "res_link", "patients")

# chart -> (builder, inputs); an input starting with "@" comes from bronze:
# a bronze table, or "@bronze_live" (metadata FINAL without tombstones).
CHART_MODELS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "kpi_totals": (charts.kpi_totals,
                   ("resource", "conditions", "res_link", "organizations", "@bronze_live")),
    "encounter_class": (charts.encounter_class, ("encounters",)),
    "resource_daily_growth": (charts.resource_daily_growth, ("resource",)),
    "top_diagnosis": (charts.top_diagnosis, ("conditions",)),
    "penyakit_prioritas_trend": (charts.penyakit_prioritas_trend, ("conditions",)),
    "utilisasi_faskes": (charts.utilisasi_faskes, ("res_link", "organizations")),
    "encounter_trend_per_faskes": (charts.encounter_trend_per_faskes,
                                   ("encounters", "res_link", "organizations")),
    "deteksi_dini_hipertensi": (charts.deteksi_dini_hipertensi, ("observations", "conditions")),
    "tren_tensi_harian": (charts.tren_tensi_harian, ("observations",)),
    "weight_faltering_per_faskes": (charts.weight_faltering_per_faskes,
                                    ("careplans", "res_link", "organizations")),
    "resource_type_summary": (charts.resource_type_summary, ("resource",)),
    "clinical_status_summary": (charts.clinical_status_summary, ("@hfj_spidx_token",)),
}

# K5: stored sort keys of the charts.
CHART_SORT_KEYS: dict[str, list[str]] = {
    "kpi_totals": [],
    "encounter_class": ["encounter_class"],
    "resource_daily_growth": ["ingest_date", "res_type"],
    "top_diagnosis": ["kode_icd10"],
    "penyakit_prioritas_trend": ["tanggal_layanan", "kategori_penyakit"],
    "utilisasi_faskes": ["nama_puskesmas"],
    "encounter_trend_per_faskes": ["tanggal_kunjungan", "nama_puskesmas"],
    "deteksi_dini_hipertensi": ["kategori_tensi"],
    "tren_tensi_harian": ["tanggal_periksa"],
    "weight_faltering_per_faskes": ["tanggal", "nama_puskesmas"],
    "resource_type_summary": ["res_type"],
    "clinical_status_summary": ["res_type", "status"],
}

ALL_MODELS = (*SILVER_MODELS, *CHART_MODELS)


class Models:
    """Lazy model graph over one bronze snapshot.

    ``silver_source`` optionally replaces the silver builders, e.g. with
    stored tables read back with ``read_model(final=True)``.
    """

    def __init__(self, bronze: Bronze, current: DataFrame | None = None,
                 silver_source: Callable[[str], DataFrame] | None = None,
                 winners: DataFrame | None = None):
        self.bronze = bronze
        self._current = current
        self._silver_source = silver_source
        # one FINAL of the bronze metadata (and of the links) for every model of this graph
        self._winners = winners if winners is not None else final_metadata(bronze.hfj_resource)
        self._link_winners = final_links(bronze.hfj_res_link)
        self._memo: dict[str, DataFrame] = {}

    @property
    def current(self) -> DataFrame:
        """C8 over every type (a refresh materialises this once)."""
        if self._current is None:
            self._current = current_resources(self.bronze.hfj_resource, self.bronze.hfj_res_ver,
                                              winners=self._winners)
        return self._current

    def bronze_live(self) -> DataFrame:
        """Bronze metadata FINAL without tombstones (what the ``resource`` model holds)."""
        return drop_tombstones(self._winners)

    def _build_silver(self, name: str) -> DataFrame:
        if self._silver_source is not None:
            return self._silver_source(name)
        builder = silver.SILVER_BUILDERS[name]
        if name in silver.RESOURCE_MODELS:
            if self._current is not None:
                return builder(self.bronze, self._current)
            # no shared, stored ``current``: the type filter goes into the metadata
            # scan, below FINAL, and the bodies are joined to that type's ids only
            res_type = silver.RESOURCE_MODELS[name][0]
            return builder(self.bronze, current_resources(
                self.bronze.hfj_resource, self.bronze.hfj_res_ver, res_type))
        if name == "resource":
            return silver.resource(self.bronze, self._winners)
        if name == "res_link":
            return silver.res_link(self.bronze, self._link_winners)
        if name == "patients":
            return silver.patients(self.bronze, self._winners, self._link_winners)
        return builder(self.bronze)

    def get(self, name: str) -> DataFrame:
        if name == "@bronze_live":
            return self.bronze_live()
        if name.startswith("@"):
            return getattr(self.bronze, name[1:])
        if name not in self._memo:
            if name in SILVER_MODELS:
                self._memo[name] = self._build_silver(name)
            else:
                builder, inputs = CHART_MODELS[name]
                self._memo[name] = builder(*(self.get(i) for i in inputs))
        return self._memo[name]

    __getitem__ = get
