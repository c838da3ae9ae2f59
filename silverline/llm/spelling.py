r"""12. Spelling variant grouping: search schemes over a bidirectional FM-index.

Words are counted over all texts.  Two words one edit apart agree exactly in
one half: the edit lies in the other.  So there are two searches a word:

* its first half exactly, with the delimiter before it, then on to the right
  across the second half with one inserted, deleted or replaced code point up
  to the delimiter;
* the same for the second half, to the left (run on the reversed words).

The index of a block of words is two suffix orders (of the delimited words and
of their reverse) with the ranks of their preceding symbols.  The exact half is
matched leftwards; each step narrows the suffix-rank interval in one order and
keeps that of the other in step, so the search can then go on rightwards.
Branches are the symbols that follow in an interval.  An edit is only tried in
its first form (no insert of the letter just passed, no delete of a repeated
letter but the first), and the second search leaves out what the first finds,
so each near word is found once: nothing is collected to be made distinct.

**Scale.**  A near word shares the first (last) code points of the exact half,
so words are dealt by a hash of these into blocks of about ``BLOCK``, each with
an index of its own, for each search and for short and long words apart.  A
block made large by a frequent beginning is split: part i of its words is
indexed and searched for the words of part j, in all tasks (i, j).  Words send
back a count and the best near word, not pairs.

Cases: null and empty texts have no words; a null doc_id is the empty text in
the hash; repeated rows count each time; words of any length are searched (a
word alone in its interval has no near word and stops); ties go to the word of
least code points; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import stored, table

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Chance of a lost code point is 1 in this.
LOSS = 97
RUNS = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
#: Distinct words that a task counts before it sends them on, and characters of very long ones.
HELD_WORDS, HELD_CHARS = 200_000, 8_000_000
#: Words of a block of the index.
BLOCK = 32_768
#: Words of at least this length are dealt by longer beginnings.
LONG = 8
#: Code points that a word is dealt by: (first search, second) of short and of long words.
DEALT_BY = {False: (2, 3), True: (4, 4)}


# ---- words ----------------------------------------------------------------------

def counted(doc_id: str, text: str) -> Counter:
    """Words of a text, after the contract's losses."""
    out: Counter = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(RUNS.findall(text.encode().lower().decode())).items():
        h = zlib.crc32(run.encode(), start)
        if h % LOSS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LEAST_LENGTH:
                continue
        out[run] += n
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                           names=["word", "n"])
        held.clear()
        return batch

    chars = 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                found = counted(doc, text)
                held.update(found)
                chars += sum(n for n in map(len, found) if n > 100)
            if len(held) >= HELD_WORDS or chars >= HELD_CHARS:
                yield out()
                chars = 0
    yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words with at least ``LEAST_COUNT`` occurrences."""
    ids = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), "text")
    return (ids.mapInArrow(_counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


# ---- the index --------------------------------------------------------------------

class Order:
    """Suffix order of a text of symbols (cyclic) and ranks of the symbols before each suffix."""

    STRIDE = 64

    def __init__(self, codes: np.ndarray):
        n, rank, k = len(codes), codes.astype(np.int64), 1
        while True:  # prefix doubling
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -k)
            self.suffix = np.argsort(key, kind="stable")
            key = key[self.suffix]
            new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            rank[self.suffix] = new
            if new[-1] == n - 1:
                break
            k *= 2
        self.n = n
        self.before = codes[self.suffix - 1]
        # sorted (symbol, row): the place of (c, i) in it is where c's suffixes begin plus c's rank at row i
        self.places = np.sort(self.before.astype(np.int64) * (n + 1) + np.arange(n))

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes with a symbol put before them."""
        base = symbol.astype(np.int64) * (self.n + 1)
        return np.searchsorted(self.places, base + lo), np.searchsorted(self.places, base + hi)

    def count_below(self) -> None:
        """Prepare :meth:`below`: counts of smaller symbols at every ``STRIDE``-th row."""
        rows = -(-self.n // self.STRIDE)
        padded = np.full(rows * self.STRIDE, 255, np.uint8)
        padded[:self.n] = self.before
        self.strides = padded.reshape(rows, self.STRIDE)
        symbols = int(self.before.max()) + 2
        seen = np.zeros((rows + 1, symbols), np.int32)
        flat = np.repeat(np.arange(1, rows + 1), self.STRIDE)[:self.n] * symbols + self.before
        seen.ravel()[:] = np.bincount(flat, minlength=seen.size)[:seen.size]
        seen = np.cumsum(seen, axis=0, dtype=np.int32)
        self.smaller = np.zeros((rows + 1, symbols + 1), np.int32)
        np.cumsum(seen, axis=1, out=self.smaller[:, 1:])

    def below(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How many symbols less than ``symbol`` are before row ``row``."""
        whole, rest = np.divmod(row, self.STRIDE)
        out = self.smaller[whole, np.minimum(symbol, self.smaller.shape[1] - 1)].astype(np.int64)
        part = np.flatnonzero(rest)
        line = self.strides[whole[part]]
        out[part] += ((line < symbol[part, None]) & (np.arange(self.STRIDE) < rest[part, None])).sum(1)
        return out


def _codes(words: list[str], alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, offsets, lengths): each word's symbols (1 up; 255: not in the alphabet), then the delimiter 0."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    at = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
    known = np.where(alphabet[at] == points, at + 1, 255).astype(np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1)
    flat = np.zeros(int(ends[-1]), np.uint8)
    inside = np.ones(len(flat), bool)
    inside[ends - 1] = False
    flat[inside] = known
    return flat, ends - lengths - 1, lengths


class Index:
    """Bidirectional FM-index of a delimited vocabulary (sorted or not, distinct words)."""

    def __init__(self, words: list[str]):
        self.alphabet = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), "<u4"))
        flat, _, _ = _codes(words, self.alphabet)
        text = np.concatenate([np.zeros(1, np.uint8), flat])
        self.left, self.right = Order(text), Order(text[::-1].copy())
        self.left.count_below()
        self.word_ending = np.cumsum(text == 0) - 2  # at the delimiter after a word: its number
        self.n = len(text)

    def near(self, queries: list[str], half: np.ndarray, inside: np.ndarray, again: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of the words one edit away that share the query's first ``half`` code points.

        ``inside``: whether the query is a word of the index.  ``again``: leave
        out the edits at the half's end, which the other search finds.
        """
        flat, offset, length = _codes(queries, self.alphabet)
        q, lo, hi, rlo = self._exact(flat, offset, half, inside)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        lo, hi = rlo, rlo + (hi - lo)
        at = half[q]
        while len(q):
            # near words of a query at place `at`: it agrees so far, the edit is here
            symbol, last = flat[offset[q] + at], flat[offset[q] + at - 1]
            first = at == half[q]
            tried = self._branches(q, at, lo, hi, symbol, last, first, length, again)
            found += self._verify(flat, offset, *tried)
            lo, hi = self.right.step(symbol, lo, hi)
            go = (symbol != 0) & (hi > lo) & ((hi - lo > 1) | ~inside[q])
            q, at, lo, hi = q[go], at[go] + 1, lo[go], hi[go]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        rows = np.concatenate([r for _, r in found])
        return np.concatenate([a for a, _ in found]), self.word_ending[self.n - 1 - self.right.suffix[rows]]

    def _exact(self, flat, offset, half, inside):
        """Match the half leftwards and the delimiter before it, both intervals in step."""
        q = np.arange(len(offset))
        at = half.astype(np.int64) - 1
        lo, hi, rlo = np.zeros(len(q), np.int64), np.full(len(q), self.n), np.zeros(len(q), np.int64)
        done = []
        while len(q):
            symbol = np.where(at >= 0, flat[offset[q] + np.maximum(at, 0)], 0).astype(np.uint8)
            rlo = rlo + self.left.below(symbol, hi) - self.left.below(symbol, lo)
            lo, hi = self.left.step(symbol, lo, hi)
            keep = (hi > lo) & ((hi - lo > 1) | ~inside[q])  # a word alone with its half has no near word here
            end = keep & (at < 0)
            done.append((q[end], lo[end], hi[end], rlo[end]))
            go = keep & (at >= 0)
            q, at, lo, hi, rlo = q[go], at[go] - 1, lo[go], hi[go], rlo[go]
        return tuple(np.concatenate(part) for part in zip(*done))

    def _branches(self, q, at, lo, hi, symbol, last, first, length, again):
        """(query, place to go on from, lo, hi) after one edit at the queries' places."""
        node, of = np.unique(lo * (self.n + 1) + hi, return_inverse=True)
        nlo, size = node // (self.n + 1), node % (self.n + 1) - node // (self.n + 1)
        rows = np.repeat(nlo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        child = np.unique(np.repeat(np.arange(len(node)), size) * 256 + self.right.before[rows])
        child = child[child % 256 != 0]
        owner, letter = child // 256, (child % 256).astype(np.uint8)
        clo, chi = self.right.step(letter, nlo[owner], nlo[owner] + size[owner])
        begin = np.searchsorted(owner, of)
        many = np.searchsorted(owner, of, side="right") - begin
        who = np.repeat(np.arange(len(q)), many)
        kid = np.repeat(begin - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        replaced = (at[who] < length[q[who]]) & (letter[kid] != symbol[who])
        put = ~first[who] & (letter[kid] != last[who]) if again else first[who] | (letter[kid] != last[who])
        lost = (at < length[q]) & ((symbol != last) | (first & (not again)))
        return (np.concatenate([q[who[replaced]], q[who[put]], q[lost]]),
                np.concatenate([at[who[replaced]] + 1, at[who[put]], at[lost] + 1]),
                np.concatenate([clo[kid[replaced]], clo[kid[put]], lo[lost]]),
                np.concatenate([chi[kid[replaced]], chi[kid[put]], hi[lost]]))

    def _verify(self, flat, offset, q, at, lo, hi):
        """Follow the rest of each query exactly, to the delimiter."""
        out = []
        while len(q):
            symbol = flat[offset[q] + at]
            lo, hi = self.right.step(symbol, lo, hi)
            alive = hi > lo
            end = alive & (symbol == 0)
            if end.any():
                out.append((q[end], lo[end]))
            alive &= symbol != 0
            q, at, lo, hi = q[alive], at[alive] + 1, lo[alive], hi[alive]
        return out


def search(words: list[str], queries: list[str], second: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) numbers of near words by the first search or, of the rest, by the second."""
    length = np.fromiter(map(len, queries), np.int64, len(queries))
    if second:
        words, queries = [w[::-1] for w in words], [w[::-1] for w in queries]
    own = set(words)
    inside = np.fromiter((w in own for w in queries), bool, len(queries))
    return Index(words).near(queries, length - length // 2 if second else length // 2, inside, second)


# ---- Spark --------------------------------------------------------------------------

def _near(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of each query of a block: how many near words it has there, and the best."""
    index = pdf[pdf["indexed"]].sort_values("word")  # str order is by code points
    words, queries = index["word"].tolist(), pdf.loc[pdf["asked"], "word"].tolist()
    out = pd.DataFrame({"word": pd.Series([], dtype=object), "n_near": pd.Series([], dtype="int64"),
                        "best_n": pd.Series([], dtype="int64"), "best": pd.Series([], dtype=object)})
    if not words or not queries:
        return out
    q, x = search(words, queries, bool(pdf["second"].iloc[0]))
    if not len(q):
        return out
    n = index["n"].to_numpy()[x]
    order = np.lexsort((x, -n, q))
    q, x, n = q[order], x[order], n[order]
    heads = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    return pd.DataFrame({"word": [queries[i] for i in q[heads]], "n_near": np.diff(np.append(heads, len(q))),
                         "best_n": n[heads], "best": [words[i] for i in x[heads]]})


def near_words(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have near words, from a stored vocabulary."""
    size = F.char_length("word")

    def place(second: bool, long: bool, asked: Column, indexed: Column) -> Column:
        take = DEALT_BY[long][second]
        key = F.right("word", F.lit(take)) if second else F.left("word", F.lit(take))
        return F.when(indexed, F.struct(F.lit(second).alias("second"), F.lit(long).alias("long"), key.alias("key"),
                                        asked.alias("asked")))

    # a search finds words one shorter and one longer, so words at the border are indexed with both
    places = F.array(*[place(second, long, (size >= LONG) if long else (size < LONG),
                             (size >= LONG - 1) if long else (size <= LONG))
                       for second in (False, True) for long in (False, True)])
    rows = vocab.select("word", "n", F.inline(F.filter(places, lambda p: p.isNotNull())))
    kinds = {(r["second"], r["long"]): r["rows"]
             for r in rows.groupBy("second", "long").agg(F.count("*").alias("rows")).collect()}
    blocks = F.lit(1)
    for (second, long), count in kinds.items():
        blocks = F.when((F.col("second") == second) & (F.col("long") == long),
                        F.lit(max(1, round(count / block)))).otherwise(blocks)
    dealt = rows.withColumn("bin", F.pmod(F.xxhash64("key"), blocks)).drop("key")
    parts = (dealt.groupBy("second", "long", "bin").agg(F.ceil(F.count("*") / (2 * block)).cast("int").alias("parts"))
             .where("parts > 1"))
    mine, others = F.col("mine"), F.sequence(F.lit(0), F.col("parts") - 1)
    tasks = F.concat(
        F.transform(others, lambda k: F.struct(mine.alias("i"), k.alias("j"), F.lit(True).alias("indexed"),
                                               (F.col("asked") & (k == mine)).alias("asked"))),
        F.transform(F.filter(others, lambda k: F.col("asked") & (k != mine)),
                    lambda k: F.struct(k.alias("i"), mine.alias("j"), F.lit(False).alias("indexed"),
                                       F.lit(True).alias("asked"))))
    spread = (dealt.join(parts, ["second", "long", "bin"], "left")
              .withColumn("parts", F.coalesce("parts", F.lit(1)))
              .withColumn("mine", F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).cast("int"))
              .select("word", "n", "second", "long", "bin", F.explode(tasks).alias("t"))
              .select("word", "n", "second", "long", "bin", "t.*"))
    found = spread.groupBy("second", "long", "bin", "i", "j").applyInPandas(
        _near, "word string, n_near bigint, best_n bigint, best string")
    least = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("best")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form (``word, form``), by pointer jumping.

    A form has at least twice its word's count, so chains are short.
    """
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = at.select(F.col("word").alias("w"), F.col("root").alias("next"))
        jumped = at.join(up, F.col("root") == F.col("w"), "left")
        at = stored(jumped.select("word", F.coalesce("next", "root").alias("root"),
                                  F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def grouped(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary (``word, n``)."""
    vocab = stored(vocab, "spelling-words")
    best = F.col("best_n") >= 2 * F.col("n")
    words = stored(vocab.join(near_words(vocab, block), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(best, F.col("best")).alias("form"), F.when(best, F.col("best_n")).alias("form_n")), "spelling-near")
    top = roots(words.where("form IS NOT NULL"))
    return words.join(top, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their likely right form."""
    return grouped(vocabulary(table(spark, sf_dir, "documents")))
