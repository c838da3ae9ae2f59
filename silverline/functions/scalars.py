"""Column functions X1-X8: JSON paths, dates, numbers and the two classifiers.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; there is no Python UDF anywhere in the library.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
EPOCH_TS = "1970-01-01 00:00:00"          # "not deleted" / unparseable date
EPOCH_DATE = "1970-01-01"
ICD_HYPERTENSION_PREFIX = "I1"            # LIKE 'I1%'
ICD_DIABETES_PREFIX = "E1"                # LIKE 'E1%'
PTM_HYPERTENSION = "Hipertensi"
PTM_DIABETES = "Diabetes Melitus"
PTM_OTHER = "Lainnya"
LOINC_BLOOD_PRESSURE = "8480-6"
SYSTOLIC = "Systolic blood pressure"
DIASTOLIC = "Diastolic blood pressure"
BP_HYPERTENSION = "Hipertensi (>=140/90)"
BP_ELEVATED = "Waspada/Pra-Hipertensi (>=130/85)"
BP_NORMAL = "Normal"
BP_HYPERTENSION_SYS, BP_HYPERTENSION_DIA = 140, 90
BP_ELEVATED_SYS, BP_ELEVATED_DIA = 130, 85
DIAGNOSED = "Sudah Terdiagnosis Hipertensi"
NOT_DIAGNOSED = "Belum Ada Diagnosis Formal"
# ---------------------------------------------------------------------------

# Plain decimal or scientific number; anything else (1.5d, NaN, inf, '',
# blanks, text) is not a number.  Spark's own cast would accept a trailing
# d/f and NaN/Infinity, the reference's parser does not.
# (``\z``: ``$`` would also match before a final line end.)
NUMERIC_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
# A JSON number; a parsed document spells 120.0 as 120.
JSON_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?\z"
# Layouts that are tried in order; the first whose shape a text has decides.
# (shape, format; None: Spark's own ISO 8601 cast.)  A time of day alone is no
# date; nine or ten digits are unix seconds, as in the reference's parser.
DATE_LAYOUTS = (
    (r"^\s*[0-9]{4}([-T ]|\s*\z)", None),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}\z", "y/M/d"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}[T ]", "y/M/d['T'][' ']H:m[:s][.SSSSSS][.SSS][XXX][X]"),
    (r"^[0-9]{8}\z", "yyyyMMdd"),
    (r"^[0-9]{8}T[0-9]{6}(Z|[+-][0-9]{2}:?[0-9]{2})?\z", "yyyyMMdd'T'HHmmss[XXX][XX]"),
    (r"^[0-9]{14}\z", "yyyyMMddHHmmss"),
    (r"^[0-9]{9,10}(\.[0-9]+)?\z", "unix"),
    (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}\z", "d MMM y"),
    (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4} [0-9]", "d MMM y H:m[:s][ XXX][ XX][XXX]"),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ts() -> Column:
    """The epoch timestamp literal, typed like the bronze columns."""
    return F.lit(EPOCH_TS).cast("timestamp_ntz")


def parse_json_doc(text: Column | str) -> Column:
    """Parse a JSON text once into a VARIANT; malformed text gives NULL."""
    return F.try_parse_json(_col(text))


def json_value(doc: Column, path: str, raw: Column | None = None) -> Column:
    """X1 on a parsed document: scalar at ``path`` as text, ``''`` otherwise.

    Missing path, JSON null, malformed text and a path that lands on an
    object or array all give ``''`` (JSON_VALUE returns scalars only and the
    stored column is not nullable).  With the ``raw`` text, a fractional number
    is spelled as a double (``120.0`` stays so, ``1.50`` is ``1.5``, as the
    oracle has it), and a valid document that cannot be parsed as a
    whole (too large, a repeated key) is searched instead, so no row is lost.
    """
    text = F.try_variant_get(doc, path, "string")
    first = F.substring(text, 1, 1)
    is_container = first.isin("{", "[") & (
        F.try_variant_get(doc, path, "array<variant>").isNotNull()
        | F.try_variant_get(doc, path, "map<string,variant>").isNotNull()
    )
    value = F.when(text.isNull() | is_container, F.lit("")).otherwise(text)
    if raw is None:
        return value
    found = F.get_json_object(raw, path)
    holds_more = found.startswith("{") & F.json_object_keys(found).isNotNull() \
        | found.startswith("[") & F.json_array_length(found).isNotNull()
    searched = F.when(found.isNull() | holds_more, F.lit("")).otherwise(found)
    whole = F.json_object_keys(raw).isNotNull() | F.json_array_length(raw).isNotNull()
    return (F.when(doc.isNull(), F.when(raw.isNotNull() & whole, searched).otherwise(F.lit("")))
            .when(value.rlike(JSON_NUMBER), F.coalesce(found, value)).otherwise(value))


def json_text(text: Column | str, path: str) -> Column:
    """``JSON_VALUE(text, path)`` with ``''`` for anything that is not a scalar."""
    return json_value(parse_json_doc(text), path, _col(text))


def with_json_fields(df: DataFrame, text: str, paths: Mapping[str, str],
                     numbers: Collection[str] = ()) -> DataFrame:
    """X1 for many paths of one text column: ``df`` with a column for each name of ``paths``.

    One parse a row.  The steps are projections of their own, so that none is
    too large to be compiled: parse; read every path; go back to the text only
    for what the parsed document can't tell (the spelling of a number, or a
    valid document that does not parse as a whole); drop objects and arrays.
    ``numbers`` are columns to be read as numbers anyway: their spelling does
    not matter (``120.0`` may come as ``120``).  Values equal ``json_text``'s.
    """
    raw, doc = F.col(text), F.col("_json_doc")
    whole = F.json_object_keys(raw).isNotNull() | F.json_array_length(raw).isNotNull()
    read = {name: f"_json_read_{i}" for i, name in enumerate(paths)}
    value = {name: f"_json_value_{i}" for i, name in enumerate(paths)}
    out = (df.withColumn("_json_doc", parse_json_doc(raw))
           .withColumns({read[n]: F.try_variant_get("_json_doc", p, "string") for n, p in paths.items()})
           .withColumn("_json_search", doc.isNull() & whole))
    values, fields = {}, {}
    for name, path in paths.items():
        found, own = F.col(read[name]), F.col(value[name])
        search = F.col("_json_search")
        if name not in numbers:
            search = search | F.substring(found, 1, 1).between("-", "9") & found.rlike(JSON_NUMBER)
        values[value[name]] = F.when(search, F.coalesce(F.get_json_object(raw, path), found)).otherwise(found)
        is_container = F.when(doc.isNull(), F.json_object_keys(own).isNotNull() | F.json_array_length(own).isNotNull()) \
            .otherwise(F.try_variant_get(doc, path, "array<variant>").isNotNull()
                       | F.try_variant_get(doc, path, "map<string,variant>").isNotNull())
        fields[name] = F.when(own.isNull() | F.substring(own, 1, 1).isin("{", "[") & is_container, F.lit("")) \
            .otherwise(own)
    out = out.withColumns(values)
    return out.select(*[F.col(c) for c in df.columns], *[f.alias(n) for n, f in fields.items()])


def to_date_of(ts: Column | str) -> Column:
    """Calendar day of a timestamp (session time zone, UTC)."""
    return F.to_date(_col(ts))


def parse_ts_or_null(text: Column | str) -> Column:
    """Lenient parse (offset honoured, else UTC) or NULL.

    ISO 8601 with separators comes first; the other layouts of
    ``DATE_LAYOUTS`` are tried for texts of their shape.
    """
    c = _col(text)
    (iso, _), *others = DATE_LAYOUTS
    parsed = F.when(c.rlike(iso), c.try_cast("timestamp"))
    for shape, layout in others:
        parsed = parsed.when(c.rlike(shape), F.timestamp_seconds(c.try_cast("decimal(20,6)")) if layout == "unix"
                             else F.try_to_timestamp(c, F.lit(layout)))
    return parsed


def fhir_date(text: Column | str, report_tz: str = "UTC") -> Column:
    """Date of an ISO date-time text, or 1970-01-01 when absent/unparseable.

    The day is taken in ``report_tz`` (the session's zone is UTC, see
    ``session.py``): in UTC, 00:30 at +07:00 falls on the previous day, as in
    the reference.
    """
    parsed = parse_ts_or_null(text)
    if report_tz != "UTC":
        parsed = F.from_utc_timestamp(parsed, report_tz)
    return F.coalesce(F.to_date(parsed), F.lit(EPOCH_DATE).cast("date"))


def to_double_or_null(text: Column | str) -> Column:
    """Text -> double, NULL when it is not a plain, finite number."""
    c = _col(text)
    number = F.when(c.rlike(NUMERIC_PATTERN), c.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def ptm_category(icd_code: Column | str) -> Column:
    """Priority non-communicable disease class of an ICD-10 code (prefix rule)."""
    c = _col(icd_code)
    return (
        F.when(c.startswith(ICD_HYPERTENSION_PREFIX), F.lit(PTM_HYPERTENSION))
        .when(c.startswith(ICD_DIABETES_PREFIX), F.lit(PTM_DIABETES))
        .otherwise(F.lit(PTM_OTHER))
    )


def bp_category(systolic: Column | str, diastolic: Column | str) -> Column:
    """Blood-pressure class of one reading, or NULL when there is none.

    Three-valued logic is kept on purpose: with one value missing and the
    other under a threshold the comparison is NULL and the next branch is
    tried, exactly as a SQL searched CASE does.
    """
    s, d = _col(systolic), _col(diastolic)
    return (
        F.when(s.isNull() & d.isNull(), F.lit(None).cast("string"))
        .when((F.coalesce(s, F.lit(0)) == 0) & (F.coalesce(d, F.lit(0)) == 0),
              F.lit(None).cast("string"))
        .when((s >= BP_HYPERTENSION_SYS) | (d >= BP_HYPERTENSION_DIA), F.lit(BP_HYPERTENSION))
        .when((s >= BP_ELEVATED_SYS) | (d >= BP_ELEVATED_DIA), F.lit(BP_ELEVATED))
        .otherwise(F.lit(BP_NORMAL))
    )
