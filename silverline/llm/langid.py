"""2. Language identification by error-correcting output codes.

Every language has a codeword.  One binary classifier a bit, over hashed
character trigrams of the UTF-8 text, predicts that bit; loss-weighted
decoding adds up each bit's logistic loss against every codeword, weighted by
how well the bit does on that language in training, and the nearest codeword
wins.  A text whose two nearest codewords are close is flagged ``ambiguous``.

Training: at most ``PER_LANGUAGE`` labelled ids of each language, ``SAMPLE`` in
all (those of least id hash: the bounded, documented sample; every language has
one at least), of which each gives one row (an id's rows: the least text) and at
most ``TRAIN_BYTES`` bytes from its middle.  A language's ids are cut by a
threshold of the hash before they are ranked, so no task ranks a whole language.
Their trigram counts are taken in tasks; the driver fits the classifiers on
the sample's sparse counts, a block of rows at a time.  Prediction reads whole texts, in one pass without
a shuffle; only the text is an input.

Cases: null text, or one without a letter: ``und`` with score 0; no labelled
rows: ``und`` for all; one language only: that language; repeated rows get
equal results; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from silverline.llm.common import crc_mod, map_texts, stored, table

PER_LANGUAGE = 400
SAMPLE = 3200
TRAIN_BYTES = 4000
#: Rows of the sample that are held as dense vectors at once.
BLOCK_ROWS = 1024
BUCKET_BITS = 14
UNKNOWN = "und"
#: Least relative gap of the two smallest decoding losses of a clear text.
MARGIN = 0.1

_LETTER = regex.compile(r"\p{L}")
_MIX = np.uint32(2654435761)


def buckets(text: str) -> np.ndarray:
    """Hash bucket of each byte trigram of the lower-cased, space-padded text."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    raw[(raw < 65)] = 32  # digits, punctuation and white space part words
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return ((code * _MIX) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Rows of +-1: exhaustive codes up to seven classes, else random dense ones.

    The random code is the one of 200 draws whose rows (and columns) lie
    farthest apart at the least.
    """
    if n == 1:
        return np.ones((1, 1), np.int8)
    if n <= 7:
        cols = np.array([[1 if k >> i & 1 else -1 for i in range(n)] for k in range(1, 1 << (n - 1))])
        return cols.T.astype(np.int8)
    bits, rng, best = int(np.ceil(10 * np.log2(n))), np.random.default_rng(seed), (-1, None)
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        gram = code.astype(int) @ code.T
        far = int((bits - gram[~np.eye(n, dtype=bool)]).min()) // 2
        if far > best[0] and (np.abs(code.sum(0)) < n).all():
            best = (far, code)
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray         # languages x bits, +-1
    weights: np.ndarray      # buckets x bits
    bias: np.ndarray         # bits
    trust: np.ndarray        # languages x bits, rows add up to one

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of every codeword for each row of margins."""
        plus, minus = self.trust * (self.code > 0), self.trust * (self.code < 0)
        return np.logaddexp(0.0, -margins) @ plus.T + np.logaddexp(0.0, margins) @ minus.T


def vector(counts: np.ndarray) -> np.ndarray:
    """Length-normalised square roots of counts."""
    v = np.sqrt(counts.astype(np.float32))
    return v / max(float(np.sqrt((v * v).sum())), 1e-9)


def fit(sample: list[tuple[str, np.ndarray, np.ndarray]], steps: int = 150, l2: float = 1e-4) -> Model | None:
    """Fit on (language, bucket ids, values): one logistic regression a bit."""
    languages = sorted({s[0] for s in sample})
    if not languages:
        return None
    code = codewords(len(languages))
    label = np.array([languages.index(s[0]) for s in sample])
    y = code[label].astype(np.float32)
    w = np.zeros((1 << BUCKET_BITS, code.shape[1]), np.float32)
    b = np.zeros(code.shape[1], np.float32)
    share = (1.0 / np.bincount(label)[label] / len(languages)).astype(np.float32)  # languages count alike

    def blocks():
        for at in range(0, len(sample), BLOCK_ROWS):
            rows = sample[at:at + BLOCK_ROWS]
            x = np.zeros((len(rows), 1 << BUCKET_BITS), np.float32)
            for i, (_, ids, values) in enumerate(rows):
                x[i, ids] = values
            yield x, slice(at, at + BLOCK_ROWS)

    kept = list(blocks()) if len(sample) <= 4 * BLOCK_ROWS else None
    vw, vb, rate = np.zeros_like(w), np.zeros_like(b), 20.0
    for _ in range(steps):  # accelerated gradient descent
        gw, gb = l2 * w, np.zeros_like(b)
        for x, at in kept or blocks():
            m = np.clip(y[at] * (x @ w + b), -30, 30)
            g = (-y[at] / (1 + np.exp(m))) * share[at, None]
            gw += x.T @ g
            gb += g.sum(axis=0)
        vw = 0.9 * vw - rate * 0.1 * gw
        vb = 0.9 * vb - rate * 0.1 * gb
        w, b = w + vw, b + vb
    right = np.concatenate([(y[at] * (x @ w + b) > 0).astype(float) for x, at in kept or blocks()])
    trust = np.stack([right[label == k].mean(axis=0) for k in range(len(languages))]) + 1e-3
    return Model(languages, code, w, b, trust / trust.sum(axis=1, keepdims=True))


def predict(model: Model | None, texts: list) -> list[tuple[str, float, bool]]:
    """(language, score, ambiguous) of each whole text."""
    out: list = [(UNKNOWN, 0.0, False)] * len(texts)
    if model is None:
        return out
    rows, margins = [], []
    for i, t in enumerate(texts):
        if t and _LETTER.search(t):
            counts = np.zeros(1 << BUCKET_BITS, np.int64)
            for at in range(0, len(t), 1 << 20):  # bounded scratch memory; two characters overlap
                counts += np.bincount(buckets(t[max(0, at - 2):at + (1 << 20)]), minlength=1 << BUCKET_BITS)
            rows.append(i)
            margins.append(vector(counts) @ model.weights + model.bias)
    if not rows:
        return out
    loss = model.losses(np.array(margins))
    prob = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * 4)
    prob /= prob.sum(axis=1, keepdims=True)
    for i, l, p in zip(rows, loss, prob):
        order = np.argsort(l, kind="stable")
        near = len(l) > 1 and (l[order[1]] - l[order[0]]) < MARGIN * l[order[1]]
        out[i] = (model.languages[order[0]], float(p[order[0]]), bool(near))
    return out


def drawn_ids(rows: DataFrame, per_language: int, sample: int) -> DataFrame:
    """``label, id`` of the ids of least hash of each language (rows ``label, id``)."""
    ids = rows.select("label", "id").distinct()
    counts = stored(ids.groupBy("label").agg(F.count(F.lit(1)).alias("ids")), "langid-counts")
    share = max(1, min(per_language, sample // max(1, counts.count())))
    # about twice the share is below the cut: far fewer than the share never are
    cut = F.when(F.col("ids") <= 2 * share + 50, F.lit(2 ** 63 - 1)).otherwise(
        (F.lit(2.0 ** 64) * ((2 * share + 50) / F.col("ids")) - F.lit(2.0 ** 63)).cast("long"))
    few = (ids.join(counts.select("label", cut.alias("cut")), "label").withColumn("draw", F.xxhash64("id"))
           .where("draw <= cut"))
    per = W.partitionBy("label").orderBy("draw", "id")
    return few.withColumn("rank", F.row_number().over(per)).where(F.col("rank") <= share).select("label", "id")


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> Model | None:
    """Fit on rows ``doc_id, text, lang`` (null text or lang: left out)."""
    start = F.greatest(F.lit(1), F.floor((F.length("text") - TRAIN_BYTES) / 2).cast("int"))
    rows = labelled.where("text is not null and lang is not null").select(
        F.col("lang").cast("string").alias("label"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.substring("text", start, F.lit(TRAIN_BYTES)).alias("text"))
    chosen = stored(drawn_ids(rows, per_language, sample), "langid-drawn")  # a bounded number of ids
    sample = rows.join(F.broadcast(chosen), ["label", "id"]).groupBy("label", "id").agg(F.min("text").alias("text"))

    def factory():
        def run(texts):
            ids, values = [], []
            for t in texts:
                counts = np.bincount(buckets(t), minlength=1 << BUCKET_BITS)
                at = np.flatnonzero(counts)
                ids.append(at.astype(np.int32))
                values.append(vector(counts)[at])
            return {"ids": ids, "values": values}
        return run

    got = map_texts(sample, factory, [("ids", "array<int>"), ("values", "array<float>")], ["label"])
    found = [(r["label"], np.array(r["ids"], np.int64), np.array(r["values"], np.float32)) for r in got.collect()]
    return fit(sorted(found, key=lambda f: (f[0], f[1].tolist()[:64])))


def classify(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``lang_pred, score, ambiguous``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x bits floats: bounded

    def factory():
        def run(texts):
            out = predict(shared.value, texts)
            return dict(zip(("lang_pred", "score", "ambiguous"), map(list, zip(*out))))
        return run

    return map_texts(docs, factory, [("lang_pred", "string"), ("score", "double"), ("ambiguous", "boolean")], keep)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn on three quarters of the ids, predict all whole texts."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 4) == 2)
    model = train(docs.where("not held_out").select("doc_id", "text", "lang"))
    return classify(docs, model, ["doc_id", "held_out"])
