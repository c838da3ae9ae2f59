"""Join operators over the resource-link edge list: J7, J8 and friends.

Links are walked by fixed-length equi-joins (one or two hops), never by
recursion.  Where a count over a join with a small dimension is wanted, the
edge side is aggregated on the join key first, so a facility that owns a
third of all visits is reduced map-side instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Link paths used by the models (fixed values of the FHIR link index).
ENCOUNTER_SUBJECT = "Encounter.subject"
ENCOUNTER_SERVICE_PROVIDER = "Encounter.serviceProvider"
CAREPLAN_ENCOUNTER = "CarePlan.encounter"


def edges(links: DataFrame, path: str, src_type: str, target_type: str | None = None,
          src_as: str = "src_resource_id", target_as: str = "target_resource_id") -> DataFrame:
    """The (source id, target id) pairs of one link path (J8's edge filter)."""
    cond = (F.col("source_resource_type") == src_type) & (F.col("src_path") == path)
    if target_type is not None:
        cond = cond & (F.col("target_resource_type") == target_type)
    return links.where(cond).select(F.col("src_resource_id").alias(src_as),
                                    F.col("target_resource_id").alias(target_as))


def follow_link(df: DataFrame, key: str, links: DataFrame, path: str, src_type: str,
                target_type: str | None = None, target_as: str = "target_id",
                how: str = "inner") -> DataFrame:
    """Attach the target id of ``path`` to each row whose ``key`` is the link source."""
    e = edges(links, path, src_type, target_type, src_as="_src", target_as=target_as)
    return df.join(e, df[key] == e["_src"], how).drop("_src")


def membership_flag(df: DataFrame, key: str, members: DataFrame, member_key: str,
                    yes: str, no: str, name: str, salts: int = 1) -> DataFrame:
    """``CASE WHEN key IN (SELECT member_key FROM members) THEN yes ELSE no END``.

    Written as a left join to the distinct member keys.  A NULL key and a key
    absent from the set both get ``no``, as ``IN`` inside ``CASE`` does.  Where
    ``df`` may hold a third of its rows under one key, ``salts`` deals them to
    as many tasks; the member keys, one row each, are repeated that often.
    """
    m = members.select(F.col(member_key).alias("_member")).where(F.col("_member").isNotNull()).distinct()
    on = df[key] == m["_member"]
    if salts > 1:
        df = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        m = m.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = (df[key] == m["_member"]) & (df["_salt"] == m["_copy"])
    flagged = df.join(m, on, "left")
    return flagged.withColumn(name, F.when(F.col("_member").isNotNull(), F.lit(yes))
                                     .otherwise(F.lit(no))).drop("_member", "_salt", "_copy")
