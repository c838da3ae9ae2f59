"""1. Packing: cost-balanced sequences.

A document's tokens (with an end token) are cut every ``capacity`` tokens;
each piece is estimated to cost its tokens times (1 + tokens / ``CROSSOVER``):
a linear part and the quadratic part of attention.  Pieces are dealt by a
hash into groups of about ``GROUP_PIECES``; in a group they are taken in
descending length and each goes to the sequence of lowest cost that has room
for it, out of as few sequences as the group's tokens need.  A piece of more
than ``SMALL`` tokens that has room nowhere opens a sequence; a smaller one is
cut at the end, its parts fill the sequences with most room left.  So there
is less padding than one sequence a group and opened sequence.

Distinct words are tokenised once (a memo bounded in bytes; the vocabulary never
merges across white space) and the ids of a text gathered from them.  A task sends one narrow row a piece; only small pieces,
which may be cut, carry their ids.

Cases: null text is empty (its end token alone); repeated rows and repeated
ids are packed one by one, each under a row number of its own; very long
texts are cut into many pieces; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import Memo, distinct_words, kept, map_texts, stored, table

CAPACITY = 4096
END = 2
#: Tokens at which the quadratic part of the cost equals the linear one.
CROSSOVER = 24_576
GROUP_PIECES = 16_384
#: Pieces of at most this many tokens may be cut to fill sequences.
SMALL = 384
#: Estimated bytes of a worker's memo of words.
MEMO_BYTES = 64 << 20
CLOSING = ".,;:!?)]}\"*#%&$"


#: Stands for the end of a word; no letter has this byte.
MARK = "\x01"


def letter_ranks(path: str) -> dict[bytes, int]:
    """Byte strings of the vocabulary's tokens (``MARK``: a word's end) that come out of their own text.

    A byte-pair engine over them joins any neighbours whose union is a token,
    in order of rank; the vocabulary's merges name the two halves.  Where a
    token's own text comes out as that token, these agree.
    """
    import json

    from tokenizers import models

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    suffix, vocab = model["end_of_word_suffix"], model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    inner = models.BPE(vocab=vocab, merges=merges)
    final = models.BPE(vocab=vocab, merges=merges, end_of_word_suffix=suffix)
    # byte-level symbols: printable bytes are themselves, the others come after 255
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {
        chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    ranks = {}
    for token, number in vocab.items():
        body = token.removesuffix(suffix)
        if all(c in byte for c in body) and [t.id for t in (inner if body == token else final).tokenize(body)] == [number]:
            ranks[bytes(byte[c] for c in body) + (b"" if body == token else MARK.encode())] = number
    return ranks


class LetterWords:
    """Ids of lower-case words of letters alone, many at once."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[n for b, n in ranks.items() if b.endswith(MARK.encode()) and len(b) > 1]] = True
        self.encode = tiktoken.Encoding("letters", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary

    def ids(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        found = np.array(self.encode(MARK.join(words) + MARK), "<u4")
        cuts = (4 * (np.flatnonzero(self.ends[found]) + 1)).tolist()
        raw = found.tobytes()
        return [raw[s:e] for s, e in zip([0, *cuts], cuts)]


def vocabulary(path: str | None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Token ids of texts as little-endian bytes, each distinct word tokenised once."""

    def __init__(self, path: str | None = None, end: int = END, ranks: dict[bytes, int] | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary(path))
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.letters = LetterWords(ranks or letter_ranks(vocabulary(path)))
        self.end = np.array([end], "<u4").tobytes()
        self.memo, self.parts = Memo(MEMO_BYTES), Memo(MEMO_BYTES // 8)

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of each word: of its lower-case letters and its closing marks, if it is so made.

        The vocabulary splits a word there and folds its case, so the parts'
        ids are the word's.
        """
        letters, marks = [], []
        for text in words:
            body = text.rstrip(CLOSING)
            plain = body.isalpha() and max(body) < "\u0250" and "\u0130" not in body
            letters.append(body.lower() if plain else "")
            marks.append(text[len(body):] if plain else text)
        some = iter(self.letters.ids([w for w in letters if w]))
        rest = self.parts.lookup(marks, self._tokenise)
        return [next(some) + m if w else m for w, m in zip(letters, rest)]

    def _tokenise(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, then the end token, four bytes each."""
        words, at, before = distinct_words(texts)
        ids = self.memo.lookup(words, self._learn)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(sizes) - sizes
        count = sizes[at]
        ends = np.concatenate([[0], np.cumsum(count)])
        all_ids = np.frombuffer(b"".join(ids), "<u4")[np.repeat(first[at] - ends[:-1], count) + np.arange(ends[-1])]
        cuts = ends[before].tolist()
        return [all_ids[s:e].tobytes() + self.end for s, e in zip(cuts, cuts[1:])]


def cost(tokens: int) -> float:
    return tokens * (1.0 + tokens / CROSSOVER)


class Room:
    """Sequences by tokens left: finds the cheapest one with room for a piece."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.size)]
        self.best = [(float("inf"), -1)] * (2 * self.size)

    def _mend(self, left: int) -> None:
        at = left + self.size
        self.best[at] = self.heaps[left][0] if self.heaps[left] else (float("inf"), -1)
        while at > 1:
            at >>= 1
            self.best[at] = min(self.best[2 * at], self.best[2 * at + 1])

    def add(self, left: int, paid: float, sequence: int) -> None:
        import heapq

        heapq.heappush(self.heaps[left], (paid, sequence))
        self._mend(left)

    def fill(self, left: int, sequences: int) -> None:
        self.heaps[left] = [(0.0, i) for i in range(sequences)]
        self._mend(left)

    def take(self, least: int) -> tuple[int, float, int] | None:
        """(room, cost, sequence) of the cheapest with at least ``least`` tokens left."""
        import heapq

        lo, hi, found = least + self.size, 2 * self.size, (float("inf"), -1, -1)
        while lo < hi:
            if lo & 1:
                found = min(found, (*self.best[lo], lo))
                lo += 1
            if hi & 1:
                hi -= 1
                found = min(found, (*self.best[hi], hi))
            lo, hi = lo >> 1, hi >> 1
        if found[1] < 0:
            return None
        at = found[2]
        while at < self.size:
            at = 2 * at if self.best[2 * at] == self.best[at] else 2 * at + 1
        left = at - self.size
        heapq.heappop(self.heaps[left])
        self._mend(left)
        return left, found[0], found[1]

    def most(self) -> int:
        """Most tokens left in any sequence."""
        return next((left for left in range(self.size - 1, 0, -1) if self.heaps[left]), 0)


def pack(lengths: np.ndarray, capacity: int = CAPACITY, small: int = SMALL) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in it, length, sequence, offset) for pieces of at most ``capacity`` tokens."""
    sequences = -(-int(lengths.sum()) // capacity)
    room, out, nowhere = Room(capacity), [], []
    room.fill(capacity, sequences)

    def place(piece, start, length, found):
        left, paid, sequence = found
        out.append((piece, start, length, sequence, capacity - left))
        if left > length:
            room.add(left - length, paid + cost(length), sequence)

    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        found = room.take(length)
        if found is None and length > small:
            found = (capacity, 0.0, sequences)
            sequences += 1
        if found is None:
            nowhere.append(piece)
        else:
            place(piece, 0, length, found)
    for piece in nowhere:  # the rooms left add up to the tokens left, at least
        start, rest = 0, int(lengths[piece])
        while rest:
            part = min(rest, room.most())
            place(piece, start, part, room.take(part))
            start, rest = start + part, rest - part
    return out


def pieces(docs: DataFrame, keep: list[str], capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Columns ``keep`` and ``start, length, ids_crc32, doc_tokens, ids`` of each piece.

    ``ids`` (four bytes each) is null for pieces of more than ``SMALL`` tokens.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(letter_ranks(vocabulary(tokenizer)))  # as large as the vocabulary

    def factory():
        words = kept(("packing", tokenizer), lambda: Words(tokenizer, ranks=ranks.value))

        def run(texts):
            out = []
            for ids in words.encode(texts):
                cut = [ids[s:s + 4 * capacity] for s in range(0, len(ids), 4 * capacity)]
                out.append([{"start": k * capacity, "length": len(c) // 4, "ids_crc32": zlib.crc32(c),
                             "doc_tokens": len(ids) // 4, "ids": c if len(c) <= 4 * SMALL else None}
                            for k, c in enumerate(cut)])
            return {"pieces": out}
        return run

    kind = "array<struct<start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint,ids:binary>>"
    return map_texts(docs, factory, [("pieces", kind)], keep, rows=1024, as_arrow=True).select(
        *[F.col(c) for c in keep], F.explode("pieces").alias("p")).select(*keep, "p.*")


def packed(docs: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
           tokenizer: str | None = None) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of each piece."""
    # the row number tells repeated ids apart; it is stored, never computed again
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    found = stored(pieces(rows, ["doc_id", "row"], capacity, tokenizer), "packing-pieces")
    groups = max(1, round(found.count() / group_pieces))
    dealt = found.withColumn("group", F.pmod(F.xxhash64("row", "start"), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "start"], ignore_index=True)
        got = pd.DataFrame(pack(pdf["length"].to_numpy(), capacity), columns=["at", "add", "part", "seq", "offset"])
        out = pdf.iloc[got["at"].to_numpy()].reset_index(drop=True)
        crc = [c if n == part else zlib.crc32(ids[4 * add:4 * (add + part)]) for c, n, part, add, ids in zip(
            out["ids_crc32"], out["length"], got["part"], got["add"], out["ids"])]
        return pd.DataFrame({
            "doc_id": out["doc_id"], "start": out["start"] + got["add"], "length": got["part"], "ids_crc32": crc,
            "doc_tokens": out["doc_tokens"], "sequence_id": got["seq"] * groups + out["group"],
            "offset": got["offset"]})

    kind = found.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("group").applyInPandas(
        run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
             "sequence_id bigint, offset bigint")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return packed(table(spark, sf_dir, "documents"))
