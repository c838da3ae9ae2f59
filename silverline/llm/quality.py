r"""4. Quality rules: tokeniser fertility.

Base counts come from the words ``[^\x20\x09-\x0D]+`` of the whole text.  The
fertility rules measure, with a public byte-fallback vocabulary and a public
byte-level one:

* characters per token (of each vocabulary),
* the share of byte-fallback tokens (single bytes for characters that the
  vocabulary lacks),
* the entropy of the token distribution, relative to the most that a text of
  its length could have (``log2(min(tokens, vocabulary))``).

A short text's measures scatter more: a deviation counts times the square
root of the text's number of tokens, as that of a mean does.

Words are tokenised one by one, each after a space, as the vocabularies never
merge across white space; equal words are tokenised once (a memo bounded in
bytes).  A band for each language and script holds the median and the scaled
median absolute deviation over *all* documents that pass the base rules, where
copies and near copies (texts of equal ``sketch``) count once; a text is
rejected if a measure lies outside its band.  The bands are wide (``Bands``):
only clear outliers go.  A band of few distinct texts has the spread of its
script (or, failing that, of all texts), and its half widths allow for the
error of its median; no band is narrower than a share of that spread.  Without
a band of enough texts anywhere, only the base rules reject.

Cases: null is an empty text: no words, so ``base_failed``; an unknown
language is ``und``; repeated rows are judged alike; very long texts are
measured whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import Memo, distinct_words, kept, map_texts, shingle_hashes, stored, table

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Estimated bytes of a worker's memo of words.
MEMO_BYTES = 96 << 20

BASE_FIELDS = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"),
               ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint")]
FERTILITY_FIELDS = [("script", "string"), ("n_pieces", "bigint"), ("chars_per_piece", "double"), ("chars_per_byte_token", "double"),
                    ("fallback_share", "double"), ("entropy", "double")]
#: Least hash of a text's runs of ``SKETCH_WORDS`` words: equal for copies, and for most near copies.
SKETCH_FIELD = ("sketch", "bigint")
SKETCH_WORDS = 3

#: First code point of the scripts that are told apart.
SCRIPTS = [(0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0700, "other"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
           (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "japanese"), (0x3100, "han"),
           (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other")]


@dataclass(frozen=True)
class Bands:
    """Half widths of the bands in scaled median absolute deviations."""

    spread: float = 6.0
    #: Least half width of each measure, so that uniform corpora reject nothing small.
    least_chars: float = 0.12
    least_share: float = 0.05
    least_entropy: float = 0.25
    #: Distinct texts from which a band has a spread of its own, and its least share of the script's spread.
    least_texts: int = 30
    least_of_script: float = 0.25


# ---- base counts ------------------------------------------------------------

def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows found twice or more, the first included; exact."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    ids = np.unique(ids, return_inverse=True)[1]
    if int(ids.max()) + 1 == len(ids):
        return 0  # no word comes twice
    rank, size = ids[:n].astype(np.int64), int(ids.max()) + 1
    for k in range(1, window):
        rank = rank * size + ids[k:k + n]
        if k + 1 < window or size ** 2 > 1 << 20:
            rank = np.unique(rank, return_inverse=True)[1]  # ranks stay below n: no overflow
    _, inverse, counts = np.unique(rank, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(counts[inverse] > 1)
    if not len(hit):
        return 0
    marks = np.zeros(len(ids) + 1, np.int64)
    np.add.at(marks, hit, 1)
    np.add.at(marks, hit + window, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def base_counts(text: str | None, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """The base counts of a text; ``words`` are numbers, equal for equal words."""
    if not len(words):
        return 0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines, dup = set(), 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in lines:
                dup += 1
            elif line.strip(" \t\n\x0b\x0c\r"):
                lines.add(line)
    return len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), dup, repeated_words(words)


# ---- fertility --------------------------------------------------------------

def script_of(text: str | None) -> str:
    """The script of most letters; ``none`` without letters."""
    if not text:
        return "none"
    if text.isascii():
        return "latin" if re.search("[A-Za-z]", text) else "none"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letters = points[(points >= 0xAA) | ((points | 32) - 97 < 26)]
    if not len(letters):
        return "none"
    at = np.searchsorted([s for s, _ in SCRIPTS], letters, side="right") - 1
    names = sorted({name for _, name in SCRIPTS})
    index = np.array([names.index(name) for _, name in SCRIPTS])
    return names[int(np.bincount(index[np.maximum(at, 0)]).argmax())]


class Fertility:
    """Token ids of words under the public vocabularies, with a memo bounded in bytes."""

    def __init__(self, piece_model: str, byte_ranks: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        with open(byte_ranks, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
        self.memo = Memo(MEMO_BYTES)

    def _learn(self, words: list[str]) -> list[tuple[bytes, int]]:
        pieces = self.pieces.encode(words, num_threads=1)
        own = self.bytes.encode_ordinary
        return [(np.array(ids, np.uint16).tobytes(), len(own(" " + w)) if w else 0) for w, ids in zip(words, pieces)]

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all pieces in turn, where each word's begin and end, each word's byte tokens)."""
        found = self.memo.lookup(words, self._learn)
        cuts = np.cumsum([0, *[len(f[0]) // 2 for f in found]])
        return np.frombuffer(b"".join([f[0] for f in found]), np.uint16), cuts, np.array([f[1] for f in found])

    def measure(self, words: np.ndarray, chars: int, of) -> tuple[int, float, float, float, float]:
        """Pieces; characters per piece, per byte token, fallback share, relative entropy of word numbers."""
        if not len(words):
            return 0, 0.0, 0.0, 0.0, 0.0
        pieces, cuts, byte_tokens = of
        first, many = cuts[words], cuts[words + 1] - cuts[words]
        n = int(many.sum())
        ids = pieces[np.repeat(first - (np.cumsum(many) - many), many) + np.arange(n)]
        counts = np.bincount(ids, minlength=len(self.fallback))
        seen = counts[counts > 0]
        bits = float(np.log2(n) - (seen * np.log2(seen)).sum() / n)
        return (n, chars / n, chars / max(1, int(byte_tokens[words].sum())), float(counts[self.fallback].sum()) / n,
                bits / np.log2(n) if n > 1 else 1.0)


def sketch(words: list[bytes]) -> int:
    return int(shingle_hashes(words, SKETCH_WORDS).min().view(np.int64)) if words else 0


def measure_factory(piece_model: str | None, byte_ranks: str | None) -> Callable:
    def factory():
        import public_tokenizers

        paths = (piece_model or public_tokenizers.path("piece_bpe_32k.model"),
                 byte_ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        fertility = kept(("quality", *paths), lambda: Fertility(*paths))
        names = [n for n, _ in [*BASE_FIELDS, *FERTILITY_FIELDS, SKETCH_FIELD]]

        def run(texts):
            distinct, numbers, before = distinct_words(texts)
            of, blank = fertility.of(distinct), distinct.index("") if "" in distinct else -1
            rows = []
            for k, t in enumerate(texts.to_pylist()):
                own = numbers[before[k]:before[k + 1]]
                own = own[own != blank]
                base = base_counts(t, own)
                rows.append((*base, script_of(t), *fertility.measure(own, base[1], of),
                             sketch(t.encode().split() if t else [])))
            return dict(zip(names, map(list, zip(*rows))))
        return run

    return factory


def band_key(lang: str, script: str) -> Column:
    """Script and primary language tag (two or three letters; else ``und``): at most some 10**5 values."""
    tag = F.lower(F.regexp_extract(F.coalesce(F.col(lang).cast("string"), F.lit("")), r"^[A-Za-z]{2,3}(?![A-Za-z])", 0))
    return F.concat_ws(":", F.col(script), F.when(tag == "", "und").otherwise(tag))


def measured(docs: DataFrame, keep: list[str], piece_model: str | None = None,
             byte_ranks: str | None = None) -> DataFrame:
    return map_texts(docs, measure_factory(piece_model, byte_ranks),
                     [*BASE_FIELDS, *FERTILITY_FIELDS, SKETCH_FIELD], keep, rows=1024, as_arrow=True)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(rows: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """``rows`` with ``base_failed``, the reason of a rejection and ``kept``.

    The bands are medians over all distinct texts (``sketch``) that pass the
    base rules, of each language and script.
    """
    names = ["chars_per_piece", "chars_per_byte_token", "fallback_share", "entropy"]
    least = [bands.least_chars, bands.least_chars, bands.least_share, bands.least_entropy]
    pieces = F.greatest("n_pieces", F.lit(1))
    scale = [F.sqrt(pieces)] * 3 + [F.lit(1.0)]  # entropy is relative already
    rows = rows.withColumn("base_failed", base_failed()).withColumn("band", band_key("lang", "script"))
    good = stored(rows.where(~F.col("base_failed")).groupBy("band", "script", "sketch").agg(
        F.min(F.struct("n_pieces", *names)).alias("one")).select("band", "script", "one.*"), "quality-texts")
    mid = good.groupBy("band", "script").agg(
        F.count(F.lit(1)).alias("texts"), F.avg(1 / pieces).alias("thin"),
        *[F.percentile_approx(n, 0.5, 1000).alias(f"mid_{n}") for n in names])
    apart = good.join(F.broadcast(mid.drop("script")), "band").select("band", "script", "texts", *[
        (F.abs(F.col(n) - F.col(f"mid_{n}")) * c).alias(n) for n, c in zip(names, scale)])

    def spread(of: DataFrame, prefix: str, *by: str) -> DataFrame:
        return of.groupBy(*by).agg(*[F.percentile_approx(n, 0.5, 1000).alias(f"{prefix}_{n}") for n in names])

    enough = apart.where(F.col("texts") >= bands.least_texts)
    limits = (mid.join(F.broadcast(spread(apart, "off", "band")), "band")
              .join(F.broadcast(spread(enough, "script", "script")), "script", "left")
              .crossJoin(F.broadcast(spread(enough, "all"))).drop("script"))
    outside = []
    for n, w, c in zip(names, least, scale):
        wide = F.coalesce(f"script_{n}", f"all_{n}", F.lit(float("inf")))
        off = F.greatest(f"off_{n}", F.when(F.col("texts") >= bands.least_texts, bands.least_of_script * wide).otherwise(wide))
        # 1.57: variance of a median to that of a mean
        error = 1.57 / F.col("texts") * (F.lit(1.0) if n == "entropy" else F.col("thin"))
        half = F.greatest(F.lit(w), bands.spread * 1.4826 * off * F.sqrt(1 / (c * c) + error))
        low, high = F.col(n) < F.col(f"mid_{n}") - half, F.col(n) > F.col(f"mid_{n}") + half
        outside += [F.when(low, f"{n} low"), F.when(high, f"{n} high")]
    reason = F.concat_ws(", ", F.when(F.col("base_failed"), "base"),
                         *[F.when(~F.col("base_failed"), o) for o in outside])
    return (rows.join(F.broadcast(limits), "band", "left")  # keys: see band_key
            .withColumn("reason", reason).withColumn("kept", F.col("reason") == ""))


def quality(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Base counts, fertility measures and the verdict for each row."""
    return judge(stored(measured(docs, ["doc_id", "lang"]), "quality"), bands)


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns."""
    cols = docs.columns
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)]
    wide = docs.select(*kept, F.col("text").alias("text"), F.col("lang").alias("lang"))
    rows = stored(measured(wide, [f"c{i}" for i in range(len(cols))] + ["lang"]), "quality-docs")
    return judge(rows, bands).where("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "reason", "chars_per_piece", "chars_per_byte_token",
                      "fallback_share", "entropy")
