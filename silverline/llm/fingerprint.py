"""7. Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the ``k`` least distinct 64-bit hashes of a text's five-word
shingles (ASCII upper case folded; fewer words: the whole sequence; none: an
empty sketch).  The least k hashes of a union are those of two sketches
merged, so sketches of parts give the sketch of the whole.  Two sketches
estimate resemblance (Jaccard), containment and, each alone, the number of
distinct shingles.  Standard error of a resemblance J: sqrt(J (1 - J) / k).

Cases: null text is empty; two empty sketches are alike (1.0), an empty and
another are not (0.0); equal texts have equal fingerprints; ids of whole
numbers are ordered as such, all others as text (by code point); null ids come
last; rows of one id are ordered by text; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm.common import map_texts, shingle_hashes, table

K = 256
SHINGLE = 5
#: Rows of one range of ids, and the most ranges (one number each on the driver).
RANGE_ROWS = 256
MAX_RANGES = 20_000


def sketch(text: str | None, k: int = K, size: int = SHINGLE) -> np.ndarray:
    """The k least distinct shingle hashes, ascending."""
    words = text.encode().lower().split() if text else []  # bytes.lower: A-Z only
    h = shingle_hashes(words, size)
    if len(h) > 4 * k:  # the least k distinct are among the least few
        least = np.unique(np.partition(h, 2 * k)[:2 * k])
        if len(least) >= k:
            return least[:k]
    return np.unique(h)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two texts' shingles."""
    return np.union1d(a, b)[:k]


def distinct(s: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(s)) if len(s) < k else (k - 1) / ((float(s[-1]) + 1) / 2.0 ** 64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of the two shingle sets."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], side="right")) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that are in b."""
    if not len(a):
        return 1.0
    j, na, nb = resemblance(a, b, k), distinct(a, k), distinct(b, k)
    return min(1.0, j * (na + nb) / ((1 + j) * na))


def encode(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8")


def sketches(docs: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, distinct_shingles`` of each row."""
    def factory():
        def run(texts):
            out = [sketch(t, k, size) for t in texts]
            return {"fingerprint": [encode(s) for s in out],
                    "distinct_shingles": [distinct(s, k) for s in out]}
        return run

    return map_texts(docs, factory, [("fingerprint", "string"), ("distinct_shingles", "double")], ["doc_id"])


def merged(sk: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """One sketch for each value of ``by``: hashes exploded, the least k kept.

    Each task keeps its own least k of a group before the shuffle, so a group
    that holds a third of all rows sends k hashes a task.
    """
    from pyspark.sql import Window as W

    @F.pandas_udf("array<decimal(20,0)>")
    def hashes(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [int(v) for v in decode(x)])

    rows = sk.select(*by, F.explode(hashes("fingerprint")).alias("h")).distinct()
    first = rows.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy("h"))).where(F.col("rank") <= k)
    return first.groupBy(*by).agg(F.sort_array(F.collect_list("h")).alias("hashes"))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows ``range, tail, doc_id, text`` dealt by ranges of ids, highest first.

    Each range ends with a ``tail`` row, the first row of the range below it
    (of the highest, after the lowest), so that each task sees the next
    document of all of its own.  Repeated ids are ordered by text; null ids
    come last.
    """
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    kind = "long" if whole else "string"
    src = docs.select(F.col("doc_id").cast(kind).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # a number that grows with the id: the id, or the first seven bytes of its text
    place = F.col("doc_id") if whole else F.conv(F.rpad(F.hex(F.substring(F.encode("doc_id", "utf-8"), 1, 7)), 14, "0"),
                                                 16, 10).cast("long")
    ids = src.select("doc_id", place.alias("place"))
    n = ids.count()
    count = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    cuts = ids.agg(F.percentile_approx("place", [i / count for i in range(1, count)], 10 * max(count, 1000))
                   if count > 1 else F.array().cast("array<bigint>")).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, doc_id.to_numpy(), side="right").astype(np.int32))

    at = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(range_of(F.coalesce(place, F.lit(0))))
    tops = ids.select("doc_id", at.alias("range")).groupBy("range").agg(F.max("doc_id").alias("top")) \
        .orderBy(F.desc("range")).collect()  # one row a range
    above = {r["range"]: tops[i - 1]["range"] for i, r in enumerate(tops)}
    edges = docs.sparkSession.createDataFrame(
        [(r["range"], r["top"], above[r["range"]]) for r in tops], f"range int, top {kind}, above int")
    ranged = src.withColumn("range", at)
    own = F.struct("range", F.lit(False).alias("tail"))
    tail = F.struct(F.col("above").alias("range"), F.lit(True).alias("tail"))
    rows = (ranged.join(F.broadcast(edges), "range")  # at most MAX_RANGES + 1 rows
            .select("doc_id", "text", F.explode(
                F.when(F.col("doc_id").eqNullSafe(F.col("top")), F.array(own, tail)).otherwise(F.array(own))).alias("at"))
            .select("at.range", "at.tail", "doc_id", "text"))
    parts = max(1, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(tops)))
    return rows.repartitionByRange(parts, F.desc("range")).sortWithinPartitions(
        F.desc("range"), "tail", F.desc_nulls_last("doc_id"), F.desc("text"))


def edited(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as much of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """The digest of ``op7_fingerprint`` for each row of ``docs``."""
    rows = with_next(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out = None, []

        def one(a, b):
            text = edited(a[2], b[2])
            s = sketch(text, k)
            return (a[1], len(a[2]), hashlib.sha256(text.encode()).hexdigest(), encode(a[3]), encode(s),
                    resemblance(a[3], s, k), resemblance(a[3], b[3], k))

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (id_type, pa.int64(), pa.string(), pa.string(),
                                                            pa.string(), pa.float64(), pa.float64()))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next"])

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for r, tail, i, text in zip(*(part.column(c).to_pylist() for c in range(4))):
                    if tail and before is None:
                        continue  # a repeated id: the first tail row has closed the range
                    row = (r, i, text, sketch(text, k))
                    if before is not None:
                        out.append(one(before, row))
                    before = None if tail else row
                    if len(out) >= 256:
                        yield batch()
                        out = []
        if out:
            yield batch()

    kind = rows.schema["doc_id"].dataType.simpleString()
    id_type = pa.string() if kind == "string" else pa.int64()
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-256 sketches of every document and of its edited text."""
    return compare_edits(table(spark, sf_dir, "documents"))
