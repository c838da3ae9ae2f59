"""6. Toxicity: multiple-instance learning over sentences.

A document is a bag of sentences (cut after ``. ! ?`` before a space, and at
line ends).  A sentence's probability is a logistic function of its hashed
words and word beginnings (letters only, lower case); the document's is their
noisy-or, 1 - prod(1 - p).  Training sees document labels only and fits the
sentence weights by the likelihood of the noisy-or; the fitted weights then
locate the offending sentences.

Training: at most ``PER_CLASS`` labelled ids of each label, those of least id
hash, one row each (an id's rows: the least text), whole texts; of a text with
more than ``TRAIN_SENTENCES`` sentences so many, evenly spaced (the bounded,
documented sample).  Tasks hash the
words; the driver runs gradient ascent on the sample's sparse bags.  Features
without clear evidence in the document labels (``EVIDENCE``) have no weight.  Scoring
reads whole texts in one pass without a shuffle; only the text is an input.

Cases: null, empty and word-free texts have the score of an empty sentence;
no labelled rows: every score is 0; one label only: a constant; labels that
are null or repeated for an id: null is left out, the largest counts; an
empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import crc_mod, map_texts, table

PER_CLASS = 1500
TRAIN_SENTENCES = 400
#: Words of the memo, and bytes of a word that is kept in it.
MEMO_WORDS, LONG_WORD = 200_000, 128
BUCKET_BITS = 18
PREFIXES = (5, 6, 7, 8)
#: Least excess of a feature among toxic training documents, in standard deviations.
EVIDENCE = 5.0
THRESHOLD = 0.7
#: Sentences at or over this probability are located as offending.
SENTENCE = 0.5

_SENTENCE = re.compile(r"(?<=[.!?])[ \t]+|\n+")
_NOT_WORD = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Spans of the non-empty sentences; an empty text is one empty span."""
    out, at = [], 0
    for m in _SENTENCE.finditer(text or ""):
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if text and len(text) > at:
        out.append((at, len(text)))
    return out or [(0, 0)]


def features(word: bytes) -> tuple[int, ...]:
    """Buckets of a word and of its first bytes (inflected and compound forms share them)."""
    parts = {b"=" + word, *(b"^" + word[:n] for n in PREFIXES if len(word) >= n)}
    return tuple((zlib.crc32(p) * 2654435761 & 0xFFFFFFFF) >> (32 - BUCKET_BITS) for p in sorted(parts))


class Hasher:
    """Feature buckets of a sentence's words, with a bounded memo of words.

    With ``weights``, only features that have one are told.
    """

    def __init__(self, weights: np.ndarray | None = None):
        self.memo: dict[bytes, tuple[int, ...]] = {}
        self.weights = weights

    def __call__(self, words: list[bytes]) -> list[int]:
        memo, out = self.memo, set()
        for w in words:
            b = memo.get(w)
            if b is None:
                b = features(w)
                if self.weights is not None:
                    b = tuple(f for f in b if self.weights[f])
                if len(w) <= LONG_WORD:
                    if len(memo) > MEMO_WORDS:
                        memo.clear()
                    memo[w] = b
            if b:
                out.update(b)
        return sorted(out)


def bag(text: str | None, hasher: Hasher, most: int | None = None) -> tuple[list[int], list[int]]:
    """Feature buckets of all sentences (or ``most``, evenly spaced) in turn, and the number in each sentence."""
    ids, sizes = [], []
    spans = sentences(text)
    if most is not None and len(spans) > most:
        spans = [spans[k * len(spans) // most] for k in range(most)]
    for s, e in spans:
        found = hasher(_NOT_WORD.sub(b" ", (text or "")[s:e].lower().encode()).split())
        ids += found
        sizes.append(len(found))
    return ids, sizes


@dataclass
class Model:
    weights: np.ndarray  # a weight for each bucket
    bias: float
    constant: float | None = None

    def sentence_scores(self, ids: list[int], sizes: list[int]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(sizes), self.constant)
        total = np.add.reduceat(np.append(self.weights[np.array(ids, np.int64)], 0.0),
                                np.minimum(np.cumsum([0, *sizes[:-1]]), len(ids)))
        total[np.array(sizes) == 0] = 0.0
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))


def evidence(doc: np.ndarray, feature: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Features in clearly more toxic documents than chance gives (whatever their number)."""
    seen = np.bincount(feature, minlength=1 << BUCKET_BITS)
    toxic = np.bincount(feature, labels[doc], minlength=1 << BUCKET_BITS)
    words = np.bincount(doc, minlength=len(labels))
    rate = (words * labels).sum() / max(1, words.sum())  # longer documents hold more features
    return toxic - seen * rate > EVIDENCE * np.sqrt(np.maximum(seen, 1) * rate * (1 - rate))


def slope(w: np.ndarray, ids: np.ndarray, sentence: np.ndarray, doc: np.ndarray, labels: np.ndarray,
          share: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Weighted noisy-or log-likelihood (less the penalty) of weights, the bias last, and its gradient.

    ``ids`` are the features in turn, of the ``sentence`` each is in; ``doc`` is each sentence's bag.
    """
    z = np.bincount(sentence, w[ids], len(doc)) + w[-1]
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(labels))  # log P(no toxic sentence)
    clean = np.minimum(clean, -1e-9)
    value = (share * np.where(labels == 1, np.log(-np.expm1(clean)), clean)).sum() - l2 / 2 * (w[:-1] ** 2).sum()
    odds = np.exp(clean) / -np.expm1(clean)
    pull = np.where(labels == 1, odds, -1.0) * share  # d value / d(-clean)
    gz = pull[doc] * p
    grad = np.append(np.bincount(ids, gz[sentence], len(w) - 1), gz.sum())
    grad[:-1] -= l2 * w[:-1]
    return value, grad


def fit(bags: list[tuple[int, np.ndarray, np.ndarray]], steps: int = 200, l2: float = 2e-5,
        rate: float = 0.15) -> Model:
    """Maximise the bags' noisy-or likelihood (label, ids, sizes); Adam steps."""
    labels = np.array([b[0] for b in bags], float)
    if not len(bags) or labels.min() == labels.max():
        return Model(np.zeros(1 << BUCKET_BITS), 0.0, 0.0 if not len(bags) else float(labels[0]))
    ids = np.concatenate([np.asarray(b[1], np.int32) for b in bags])
    sizes = np.concatenate([np.asarray(b[2], np.int32) for b in bags])
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    doc = np.repeat(np.arange(len(bags)), [len(b[2]) for b in bags])
    pairs = np.unique((doc[sentence] << BUCKET_BITS) + ids)
    known = evidence(pairs >> BUCKET_BITS, pairs & ((1 << BUCKET_BITS) - 1), labels)[ids]
    ids, sentence = ids[known], sentence[known]
    names, ids = np.unique(ids, return_inverse=True)
    w, b = np.zeros(len(names) + 1), -4.0  # the last weight is the bias
    w[-1] = b
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        _, grad = slope(w, ids, sentence, doc, labels, share, l2)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-6)
    weights = np.zeros(1 << BUCKET_BITS)
    weights[names] = w[:-1]
    return Model(weights, float(w[-1]))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on documents ``doc_id, text`` and labels ``doc_id, toxic``."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]  # each task keeps its least PER_CLASS
    drawn = [known.where(F.col("toxic") == y).orderBy(*order).limit(PER_CLASS) for y in (0, 1)]
    rows = (docs.select("doc_id", "text").join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))

    def factory():
        hasher = Hasher()

        def run(texts):
            out = [bag(t, hasher, TRAIN_SENTENCES) for t in texts]
            return {"ids": [o[0] for o in out], "sizes": [o[1] for o in out]}
        return run

    got = map_texts(rows, factory, [("ids", "array<int>"), ("sizes", "array<int>")], ["doc_id", "toxic"])
    bags = [(r["doc_id"], r["toxic"], np.array(r["ids"], np.int32), np.array(r["sizes"], np.int32))
            for r in got.toLocalIterator()]
    return fit([b[1:] for b in sorted(bags, key=lambda b: (b[0], len(b[2]), len(b[3])))])


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``score``, and the spans and scores of offending sentences."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BUCKET_BITS floats

    def factory():
        hasher = Hasher(shared.value.weights)

        def run(texts):
            scores, spans = [], []
            for t in texts:
                p = shared.value.sentence_scores(*bag(t, hasher))
                scores.append(noisy_or(p))
                cut = sentences(t)
                spans.append([{"start": cut[i][0], "end": cut[i][1], "score": float(p[i])}
                              for i in np.flatnonzero(p >= SENTENCE).tolist()])
            return {"score": scores, "offending": spans}
        return run

    return map_texts(docs, factory, [("score", "double"), (
        "offending", "array<struct<start:int,end:int,score:double>>")], keep)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn on two thirds of the ids, score all whole texts."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 3) == 1)
    labels = table(spark, sf_dir, "labels").withColumn("held_out", crc_mod("doc_id", 3) == 1)
    model = train(docs.where("not held_out"), labels.where("not held_out"))
    out = score(docs, model, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                      F.size("offending").alias("n_offending"))
