import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from silverline.llm import packing as P
from silverline.llm.common import Memo
from silverline.llm.registry import QUERIES


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


def check(rows, texts, tokenizer, capacity=4096):
    """texts: doc_id -> text.  An exact round trip of every token."""
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
        cut = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(cut) == r["length"] > 0 and r["ids_crc32"] == zlib.crc32(cut.tobytes())
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    assert set(by_doc) == set(texts)
    for i, rs in by_doc.items():
        rs.sort(key=lambda r: r["start"])
        assert [r["start"] for r in rs] == np.cumsum([0, *[r["length"] for r in rs]])[:-1].tolist()
        assert sum(r["length"] for r in rs) == len(ids[i])
    for rs in by_seq.values():
        rs.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rs] == np.cumsum([0, *[r["length"] for r in rs]])[:-1].tolist()
        assert sum(r["length"] for r in rs) <= capacity
    return sum(map(len, ids.values())) / (len(by_seq) * capacity)


def test_round_trip_of_the_whole_table(spark, tokenizer):
    path = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    assert check(QUERIES["op1_packing"](spark, path).collect(), texts, tokenizer) > 0.995


def test_words_alone_give_the_ids_of_whole_texts(tokenizer):
    texts = ["It's  a\ttest's\r\nline\x1cwith\x85odd spaces\xa0", "naïve ΣΑΣ İx 中文 é ́x 12.5!?--",
             "<|endoftext|> <|startoftext|>x", " lead", "", None, "don't we'll I'M 'S"]
    for t, ids in zip(texts, P.Words().encode(pa.array(texts))):
        want = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == [*want, 2]


def test_letter_words_by_the_other_engine(tokenizer):
    """Random joins of tokens and letters: ids are those of the vocabulary's own merges."""
    rng = np.random.default_rng(2)
    tokens = [t.removesuffix("</w>") for t in tokenizer.get_vocab()]
    tokens = sorted({t for t in tokens if t.isascii() and t.isalpha() and t.islower()}) + list("abcdefgéßñöüøłž")
    words = ["".join(rng.choice(tokens, rng.integers(1, 6))) for _ in range(20_000)] + ["a" * 3000, "é" * 500]
    letters = P.LetterWords(P.letter_ranks(public_tokenizers.path("word_bpe_49k.json")))
    assert letters.ends.sum() == sum(t.endswith("</w>") for t in tokenizer.get_vocab())  # every token is in use
    for word, ids, want in zip(words, letters.ids(words), tokenizer.encode_batch(words, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, word


def test_memo_is_bounded_in_bytes():
    memo = Memo(100_000)
    for k in range(300):
        words = [f"w{k}-{i}" for i in range(100)] + ["often", "x" * 10_000 + str(k)]
        assert memo.lookup(words, lambda new: [w.encode() for w in new]) == [w.encode() for w in words]
        held = sum(Memo.ENTRY + 2 * len(w) for m in (memo.young, memo.old) for w in m)
        assert held <= 101_000 and "often" in memo.young | memo.old


def test_very_long_words_stay_out_of_memory(spark, docs_of, tokenizer):
    texts = {i: f"{chr(97 + i) * 50_000} {'Zq9' * 4000}{i}" for i in range(8)}
    check(P.packed(docs_of(list(texts.items()))).collect(), texts, tokenizer)


def test_lowest_cost_with_room():
    """Each whole piece went to the cheapest sequence that had room for it then."""
    rng = np.random.default_rng(4)
    lengths = np.minimum(100, rng.integers(1, 130, 400))
    paid, left = defaultdict(float), defaultdict(lambda: 100)
    out = P.pack(lengths, 100, small=0)
    n = -(-int(lengths.sum()) // 100)
    for piece, start, length, seq, offset in out:
        open_ = [(paid[s], s) for s in range(n) if left[s] >= length]
        assert start == 0 and offset == 100 - left[seq]
        if open_:
            assert (paid[seq], seq) == min(open_)
        else:
            assert seq == n
            n += 1
        paid[seq] += P.cost(length)
        left[seq] -= length
    assert [p for p, *_ in out] == np.argsort(-lengths, kind="stable").tolist()


def test_small_pieces_fill_the_rest_and_costs_are_balanced():
    rng = np.random.default_rng(5)
    lengths = np.minimum(4096, rng.lognormal(6.3, 1.1, 5000).astype(int) + 1)
    out = P.pack(lengths)
    sums, costs = defaultdict(int), defaultdict(float)
    for _, _, length, seq, _ in out:
        sums[seq] += length
        costs[seq] += P.cost(length)
    assert max(sums.values()) <= 4096 and lengths.sum() / (4096 * len(sums)) > 0.99
    plain = np.array(list(costs.values()))
    assert plain.std() / plain.mean() < 0.06


def test_nulls_long_texts_repeats_and_empty(spark, docs_of, tokenizer):
    texts = {1: None, 2: "", 3: "alpha beta " * 40_000, 4: "one", 5: " \n "}
    docs = docs_of(list(texts.items())).selectExpr("*", "1 as row", "2 as start", "3 as ids", "4 as `group`")
    check(P.packed(docs, group_pieces=5).collect(), texts, tokenizer)
    same = P.packed(docs_of([(7, "a b c"), (7, "a b c"), (None, "d"), (None, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in same) == [(0, 1), (0, 2), (7, 4), (7, 4)]
    assert sorted(r["offset"] for r in same) == sorted(np.cumsum([0, *[r["length"] for r in sorted(
        same, key=lambda r: r["offset"])]])[:-1].tolist())
    assert P.packed(docs.limit(0)).count() == 0
