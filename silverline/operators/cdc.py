"""Operators on change-data-capture copies: C1-C5, C8, C9.

A CDC copy keeps every version of a row; readers must first pick the last
version per key (C1, what ``FINAL`` does), then drop tombstones (C2) and,
for resources, soft-deleted rows (C4).  The order matters: filtering before
C1 would bring an older version of a deleted row back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.functions.scalars import epoch_ts

TOMBSTONE = "_peerdb_is_deleted"
CDC_VERSION = "_peerdb_version"
BATCH_ID = "_batch_id"

# Dedup keys and version order of the four bronze tables (parameters: the
# CDC copy itself does not record its keys).
RESOURCE_KEYS = ("res_id",)
RES_VER_KEYS = ("res_id", "res_ver")
LINK_KEYS = ("source_resource_type", "src_path", "src_resource_id",
             "target_resource_type", "target_resource_id")
TOKEN_KEYS = ("sp_id",)
# Highest CDC version wins; on equal versions a tombstone wins, so a replayed
# delete is never undone by a replayed insert of the same version.
BRONZE_ORDER = (CDC_VERSION, TOMBSTONE)


def _ordering(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc() if isinstance(c, str) else c for c in order]


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the last version of each key (``FINAL``).

    ``order`` lists the version columns, highest first wins; add tie-break
    columns so that the choice is total.  Written as ``row_number() = 1`` so
    Spark plans a partial ``WindowGroupLimit`` before the exchange: old
    versions are dropped map-side and a hot key ships at most one row per
    map partition.
    """
    w = Window.partitionBy(*keys).orderBy(*_ordering(order))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def drop_tombstones(df: DataFrame, flag: str = TOMBSTONE) -> DataFrame:
    """Drop rows whose winning version is a CDC delete."""
    return df.where(F.col(flag) == 0)


def final(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = BRONZE_ORDER,
          flag: str = TOMBSTONE) -> DataFrame:
    """C1 then C2: what ``FROM t FINAL WHERE _peerdb_is_deleted = 0`` reads."""
    return drop_tombstones(latest(df, keys, order), flag)


def is_deleted(col: str = "res_deleted_at") -> Column:
    """Soft-delete flag; the epoch timestamp means "not deleted"."""
    return F.col(col) != epoch_ts()


def with_is_deleted(df: DataFrame, col: str = "res_deleted_at") -> DataFrame:
    return df.withColumn("is_deleted", is_deleted(col))


def live(df: DataFrame, col: str = "res_deleted_at") -> DataFrame:
    """C4: keep rows that are not soft-deleted (``res_deleted_at = epoch``)."""
    return df.where(F.col(col) == epoch_ts())


def newer_than(df: DataFrame, col: str, mark) -> DataFrame:
    """Rows strictly newer than the high-water mark.

    ``mark`` is a literal (read once by ``high_water_mark``), so that the
    comparison reaches the Parquet scan as a pushed filter.
    """
    return df.where(F.col(col) > (mark if isinstance(mark, Column) else F.lit(mark)))


def touched_since(df: DataFrame, keys: Sequence[str], col: str, mark,
                  broadcast_rows: int | None = None) -> DataFrame:
    """All versions of the keys that have at least one version newer than ``mark``.

    ``final(touched_since(df, ...))`` filtered by ``col > mark`` equals
    ``final(df)`` filtered the same way (a key whose versions are all older
    cannot win with a newer one), but only the delta's keys are deduplicated.
    With ``broadcast_rows`` the changed keys are counted first (a scan with
    the mark pushed down) and, when there are at most that many, broadcast,
    so the CDC copy is filtered map-side instead of shuffled whole.
    """
    changed = newer_than(df, col, mark).select(*keys).distinct()
    if broadcast_rows is not None and changed.count() <= broadcast_rows:
        changed = F.broadcast(changed)
    return df.join(changed, list(keys), "left_semi")


META_COLUMNS = ("res_id", "fhir_id", "res_type", "res_ver", "res_published", "res_updated",
                "res_deleted_at", CDC_VERSION, TOMBSTONE)


def final_metadata(resource: DataFrame) -> DataFrame:
    """C1 on the resource metadata: the winning version of every id, tombstones kept.

    Everything that reads resource metadata (``resource``, C8, ``patients``,
    freshness, C9) starts from this; a scheduled refresh computes it once.
    """
    return latest(resource.select(*META_COLUMNS), RESOURCE_KEYS, BRONZE_ORDER)


def final_links(links: DataFrame) -> DataFrame:
    """C1 on the link copy: the winning version of every link, tombstones kept."""
    return latest(links, LINK_KEYS, BRONZE_ORDER)


def current_resources(resource: DataFrame, res_ver: DataFrame,
                      res_type: str | Sequence[str] | None = None,
                      winners: DataFrame | None = None,
                      prefilter: bool | None = None,
                      broadcast_meta: bool = False) -> DataFrame:
    """Live resources joined to the JSON body of their current version.

    Metadata: (type filter ->) FINAL (or the given ``winners`` of
    ``final_metadata``) -> not tombstoned -> not soft-deleted.  Bodies: FINAL per
    ``(res_id, res_ver)``, not tombstoned.  Then an inner join on
    ``(res_id, res_ver)``.

    The body dedup runs before its exchange (partial ``WindowGroupLimit``), so
    many CDC copies of one body are cut to one per map partition before the
    shuffle; the join then reuses that hash partitioning, so the wide JSON
    is shuffled once.  When the metadata side is selective (a type filter,
    or the delta of an incremental run: ``prefilter``), the bodies are joined
    to it first and deduplicated after (exact: the metadata is unique on the
    body's own dedup key).  ``broadcast_meta`` (set only by a caller
    that has checked the metadata side's size) broadcasts it explicitly, so
    the bodies are filtered map-side before any shuffle.
    """
    types = None if res_type is None else [res_type] if isinstance(res_type, str) else list(res_type)
    if winners is None:
        # the type of an id never changes, so the type test may go below FINAL, into the scan
        winners = final_metadata(resource if types is None else
                                 resource.where(F.col("res_type").isin(*types)))
    meta = live(drop_tombstones(winners))
    if types is not None:
        meta = meta.where(F.col("res_type").isin(*types))
    meta = meta.select("res_id", "res_ver", "res_type", "res_published", "res_updated")
    bodies = res_ver.select("res_id", "res_ver", "res_text_vc", CDC_VERSION, TOMBSTONE)
    if prefilter if prefilter is not None else res_type is not None:
        # selective metadata: join first (a map-side filter when it is
        # broadcast), then FINAL of the surviving bodies; exact because the
        # metadata is unique on the body's own dedup key
        side = F.broadcast(meta) if broadcast_meta else meta
        current = final(bodies.join(side, list(RES_VER_KEYS), "inner"), RES_VER_KEYS)
    else:
        current = final(bodies, RES_VER_KEYS).join(meta, list(RES_VER_KEYS), "inner")
    return current.select("res_id", "res_type", "res_ver", "res_published", "res_updated",
                          "res_text_vc")


def deleted_keys(resource: DataFrame, res_ver: DataFrame, res_type: str | None,
                 mark=None, winners: DataFrame | None = None,
                 broadcast_rows: int | None = None) -> DataFrame:
    """C9 helper: ids of ``res_type`` (None: all) changed after ``mark`` that are no longer live.

    A key is gone when its last metadata version is a tombstone or
    soft-deleted, or when the body of that version is tombstoned.  Returns
    ``res_id, res_type`` and the ``res_updated`` of the deleting version.  ``winners``
    (from ``final_metadata``) saves the metadata dedup; without it only the
    ids touched since ``mark`` are deduplicated.
    """
    if winners is None:
        meta = resource.select(*META_COLUMNS)
        if mark is not None:
            meta = touched_since(meta, RESOURCE_KEYS, "res_updated", mark, broadcast_rows)
        winners = latest(meta, RESOURCE_KEYS, BRONZE_ORDER)
    meta = winners if res_type is None else winners.where(F.col("res_type") == res_type)
    if mark is not None:
        meta = newer_than(meta, "res_updated", mark)
    # only the bodies of these versions (their own dedup key, so exact), then FINAL
    keys = meta.select("res_id", "res_ver")
    if broadcast_rows is not None and keys.count() <= broadcast_rows:
        keys = F.broadcast(keys)
    body = latest(res_ver.select("res_id", "res_ver", CDC_VERSION, TOMBSTONE)
                  .join(keys, list(RES_VER_KEYS), "left_semi"),
                  RES_VER_KEYS, BRONZE_ORDER).withColumnRenamed(TOMBSTONE, "_body_deleted")
    joined = meta.join(body.select("res_id", "res_ver", "_body_deleted"),
                       list(RES_VER_KEYS), "left")
    gone = (F.col(TOMBSTONE) != 0) | is_deleted() | \
        F.coalesce(F.col("_body_deleted") != 0, F.lit(True))
    return joined.where(gone).select("res_id", "res_type", "res_updated")
