import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from silverline.llm import spelling as S
from silverline.llm.registry import QUERIES

WORDS = st.lists(st.text("abé", min_size=5, max_size=9), min_size=1, max_size=40, unique=True)


def edits(word, alphabet):
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in alphabet}
    return out - {word}


@settings(max_examples=200, deadline=None)
@given(WORDS, WORDS)
def test_searches_find_each_near_word_once(words, more):
    words, queries = sorted(words), words[:3] + [w for w in more if w not in words]
    found = []
    for second in (False, True):
        q, x = S.search(words, queries, second)
        found += [(queries[i], words[j]) for i, j in zip(q.tolist(), x.tolist())]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in queries for b in words if b in edits(a, "abé")}


def test_intervals_stay_in_step():
    """After matching leftwards, the interval of the other order counts the same places."""
    words = ["banana", "bandana", "cabana", "bananas"]
    index = S.Index(words)
    flat, offset, _ = S._codes(words, index.alphabet)
    _, lo, hi, rlo = index._exact(flat, offset, np.array([3, 3, 3, 3]), np.zeros(4, bool))
    text = "\0" + "\0".join(words) + "\0"
    for word, a, b, r in zip(words, lo, hi, rlo):
        part = "\0" + word[:3]
        at = {i for i in range(len(text)) if text.startswith(part, i)}
        assert {int(i) for i in index.left.suffix[a:b]} == at
        assert {len(text) - 1 - int(i) for i in index.right.suffix[r:r + b - a]} == {i + len(part) - 1 for i in at}


def expected(docs):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    lost = defaultdict(list)  # words by themselves less one code point: near words share one
    for w in n:
        for v in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            lost[v].append(w)
    near = defaultdict(set)
    for group in lost.values():
        for a in group:
            for b in group:
                if a != b and (len(a) != len(b) or sum(x != y for x, y in zip(a, b)) == 1):
                    if len(a) == len(b) or abs(len(a) - len(b)) == 1 and min((a, b), key=len) in \
                            {max((a, b), key=len)[:i] + max((a, b), key=len)[i + 1:] for i in range(max(len(a), len(b)))}:
                        near[a].add(b)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def got(rows):
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = expected(docs)
    assert got(QUERIES["op12_spelling"](spark, sf).collect()) == want
    assert len(want) > 2000 and any(v[0] for v in want.values()) and any(v[1] != v[0] and v[0] for v in want.values())


def test_split_blocks_give_the_same(spark, sf_small):
    """Small blocks, one beginning held by most words: all pairs of parts are searched."""
    words = [("aaaa" + f"{i:03d}".translate(str.maketrans("0123456789", "bcdefghijk")), 3 + i % 50) for i in range(400)]
    df = spark.createDataFrame(words, "word string, n long")
    docs = [(None, " ".join([w] * n)) for w, n in words]
    plain = got(S.grouped(df, block=16).collect())
    kept = {w: v for w, v in plain.items()}
    want = {w: v for w, v in expected(docs).items()}
    lost = {w for w, _ in words if zlib.crc32(f":{w}".encode()) % 97 == 0}
    assert len(kept) == 400 and {w: kept[w] for w in kept if not lost} == (want if not lost else {})
    assert got(S.grouped(df).collect()) == plain


def test_chains_of_forms(spark):
    words = [("abcde", 1000), ("abcdef", 400), ("abcdefg", 150), ("abcdefgh", 60), ("abcdefghi", 25), ("zzzzz", 9)]
    rows = got(S.grouped(spark.createDataFrame(words, "word string, n long")).collect())
    assert {w: v[1] for w, v in rows.items()} == {**{w: "abcde" for w, _ in words[:5]}, "zzzzz": "zzzzz"}


def test_nulls_case_long_runs_and_other_letters(spark, docs_of, as_tables):
    long = "ab" * 30_000
    docs = [(None, "Straße STRASSE straße's Straßen"), (1, None), (2, ""), (3, "ÀÉÎÕÜ àéîõü ÀÉÎÕÜ ÷÷÷÷÷ ×××××")]
    docs += [(i, f"{long} {long}x House houses houze 1house2 {'a' * 5000} {'a' * 5001}") for i in range(10, 16)]
    df = docs_of(docs).selectExpr("*", "1 AS word", "2 AS n")
    rows = got(QUERIES["op12_spelling"](spark, as_tables(documents=df)).collect())
    assert rows == expected(docs)


def test_empty_table(spark, docs_of, as_tables):
    assert QUERIES["op12_spelling"](spark, as_tables(documents=docs_of([]))).collect() == []
