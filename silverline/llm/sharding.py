"""8. Sharding: a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``2**RING_BITS`` cells.  Each shard owns ``vnodes`` points on it;
the cells from one point to the next form an arc, served by the point that
closes it.  A key (``doc_id``) lies in the cell of its MD5 and goes to the
shard of its arc.  No shard takes more than its capacity: keys over it
continue clockwise to the next points whose shards have room.  With
``slack=0`` the capacities add up to the number of rows, so shard counts
differ by at most one; a larger slack moves fewer keys.

Only the count of each arc (``shards * vnodes`` numbers at most) is seen by
the driver, which lays out who takes which ranks of an arc.  The rows
themselves are ranked inside small cells and looked up by arc, so there is
one shuffle of narrow rows, no group grows with the largest key, and nothing
is sorted as a whole.

Cases: a null text counts no bytes; a null ``doc_id`` has no key, its row
lies at a place of its own; repeated rows are placed one by one (a salt
splits a cell, so that many rows of one id do not meet in one task); an empty
table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from silverline.llm.common import stored, table

RING_BITS = 16
SALTS = 16


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in ring order; one node a cell."""
    taken: dict[int, int] = {}
    for replica in range(vnodes):
        for shard in range(shards):
            digest = hashlib.md5(f"shard {shard} node {replica}".encode()).hexdigest()
            cell = int(digest[:8], 16) >> (32 - RING_BITS)
            taken.setdefault(cell, shard)
    return sorted(taken.items())


def arc_of(points: list[tuple[int, int]], cell: int) -> int:
    """Index of the first point at or after ``cell``, clockwise."""
    return bisect.bisect_left(points, (cell, -1)) % len(points)


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may take: shares one apart at most, plus slack."""
    base, more = divmod(total, shards)
    fair = [base + (s < more) for s in range(shards)]
    return [int(c * (1 + slack)) for c in fair] if slack else fair


def lay_out(points: list[tuple[int, int]], counts: dict[int, int], capacity: list[int]) -> list[dict]:
    """Segments of ranks of each arc: ``arc, lo, hi, shard, base`` (first slot).

    Home keys come first, in ring order; what is over a shard's capacity then
    walks clockwise from its arc to the next point whose shard has room.
    """
    room, used, out, over = list(capacity), [0] * len(capacity), [], []

    def take(arc: int, lo: int, n: int, shard: int) -> int:
        got = min(n, room[shard])
        if got:
            out.append({"arc": arc, "lo": lo, "hi": lo + got, "shard": shard, "base": used[shard]})
            room[shard] -= got
            used[shard] += got
        return got

    for arc, (_, shard) in enumerate(points):
        n = counts.get(arc, 0)
        got = take(arc, 0, n, shard)
        if got < n:
            over.append((arc, got, n - got))
    for arc, lo, left in over:
        at = arc
        while left:
            at = (at + 1) % len(points)
            got = take(arc, lo, left, points[at][1])
            lo, left = lo + got, left - got
    return out


def shard(docs: DataFrame, shards: int = 40, vnodes: int = 128, slack: float = 0.0) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"),
                     F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")))
    place = F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long")
    rows = stored(docs.select(
        "doc_id", (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), place.alias("place"),
        F.shiftright(place, 48 - RING_BITS).cast("int").alias("cell"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")), "shard-rows")

    points = ring(shards, vnodes)
    arcs = _arcs(spark, points)
    cells = stored(rows.groupBy("cell", "salt").agg(F.count(F.lit(1)).alias("n")).join(arcs, "cell"),
                   "shard-cells")
    counts = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    total = sum(counts.values())
    segments = lay_out(points, counts, capacities(total, shards, slack))

    schema = "array<struct<arc:int, lo:bigint, hi:bigint, shard:int, base:bigint>>"
    plan = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(segments)), schema)))
    plan = plan.groupBy("arc").agg(F.collect_list(F.struct("lo", "hi", "shard", "base")).alias("segments"))
    ring_order = W.partitionBy("arc").orderBy("turn", "salt").rowsBetween(W.unboundedPreceding, -1)
    placed = (cells.withColumn("before", F.coalesce(F.sum("n").over(ring_order), F.lit(0)))
              .join(F.broadcast(plan), "arc")  # at most shards * vnodes arcs
              .select("cell", "salt", "before", "segments"))
    in_cell = W.partitionBy("cell", "salt").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = (rows.withColumn("rank", F.row_number().over(in_cell) - 1)
              .join(placed, ["cell", "salt"]).withColumn("rank", F.col("rank") + F.col("before")))
    seg = F.element_at(F.filter("segments", lambda s: (s["lo"] <= F.col("rank"))
                                & (F.col("rank") < s["hi"])), 1)
    return ranked.withColumn("seg", seg).select(
        "doc_id", "size", "text_crc32", F.col("seg.shard").alias("shard"),
        (F.col("seg.base") + F.col("rank") - F.col("seg.lo")).cast("long").alias("slot"))


def _arcs(spark: SparkSession, points: list[tuple[int, int]]) -> DataFrame:
    """cell, arc, turn: every ring cell, its arc and its place along the arc."""
    size, spans = 1 << RING_BITS, []
    for arc, (cell, _) in enumerate(points):
        lo = points[arc - 1][0] + 1 - (0 if arc else size)  # the first arc wraps round
        spans.append({"arc": arc, "lo": lo, "hi": cell})
    rows = spark.range(1).select(F.inline(F.from_json(
        F.lit(json.dumps(spans)), "array<struct<arc:int, lo:int, hi:int>>")))
    return rows.select("arc", F.explode(F.sequence("lo", "hi")).alias("turn")).select(
        F.pmod("turn", F.lit(size)).alias("cell"), "arc", "turn")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39, row counts at most one apart."""
    out = shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
