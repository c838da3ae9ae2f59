"""Bronze schemas and how tables are addressed and read.

Bronze tables are read with an explicit ``StructType`` (no inference).  A
"root" is either a catalog database (``bronze``) or a folder holding one
Parquet directory per table (``/data/bronze``, ``s3a://...``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _S, _I, _TS = T.LongType(), T.StringType(), T.IntegerType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "hfj_resource": _schema(
        ("res_id", _L), ("fhir_id", _S), ("res_type", _S), ("res_ver", _L),
        ("res_published", _TS), ("res_updated", _TS), ("res_deleted_at", _TS),
        ("_peerdb_version", _L), ("_peerdb_is_deleted", _I)),
    "hfj_res_ver": _schema(
        ("res_id", _L), ("res_ver", _L), ("res_text_vc", _S),
        ("_peerdb_version", _L), ("_peerdb_is_deleted", _I)),
    "hfj_res_link": _schema(
        ("src_path", _S), ("source_resource_type", _S), ("src_resource_id", _L),
        ("target_resource_type", _S), ("target_resource_id", _L), ("sp_updated", _TS),
        ("_peerdb_version", _L), ("_peerdb_is_deleted", _I)),
    "hfj_spidx_token": _schema(
        ("sp_id", _L), ("res_type", _S), ("sp_name", _S), ("sp_value", _S),
        ("_peerdb_version", _L), ("_peerdb_is_deleted", _I)),
}

# Physical names used by the CDC replica (``public_`` schema prefix).
PHYSICAL_PREFIX = "public_"
BRONZE_TABLES = tuple(SCHEMAS)


def _is_path(root: str) -> bool:
    return "/" in root or ":" in root


def table_name(root: str, name: str, physical: bool = False) -> str:
    """Address of a table: ``db.table`` in the catalog or ``root/table``."""
    ident = f"{PHYSICAL_PREFIX}{name}" if physical else name
    return f"{root.rstrip('/')}/{ident}" if _is_path(root) else f"{root}.{ident}"


def read_bronze(spark: SparkSession, root: str, name: str, physical: bool = False) -> DataFrame:
    """Scan one bronze table with its fixed schema."""
    where = table_name(root, name, physical)
    if _is_path(root):
        return spark.read.schema(SCHEMAS[name]).parquet(where)
    return spark.table(where).select(*SCHEMAS[name].fieldNames())


@dataclass(frozen=True)
class Bronze:
    """The four CDC tables the models read."""

    hfj_resource: DataFrame
    hfj_res_ver: DataFrame
    hfj_res_link: DataFrame
    hfj_spidx_token: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, root: str, physical: bool = False) -> "Bronze":
        return cls(*(read_bronze(spark, root, n, physical) for n in BRONZE_TABLES))

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in BRONZE_TABLES}
