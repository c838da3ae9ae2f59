import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from silverline.llm import simhash as S
from silverline.llm.registry import QUERIES


def brute_fingerprint(text, size=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    counts = Counter(b for s in sh for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b, n in counts.items() if 2 * n > len(sh))


def brute_classes(fps):
    """least id reachable over links of at most four bits, ids ascending."""
    values = sorted(set(fps.values()))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    arr = np.array(values, np.uint64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= 4):
            parent[find(values[i + 1 + j])] = find(v)
    least = {}
    for d in sorted(fps):
        least.setdefault(find(fps[d]), d)
    return {d: least[find(v)] for d, v in fps.items()}


def check(rows, texts):
    fps = {d: brute_fingerprint(t) for d, t in texts.items()}
    want = brute_classes(fps)
    assert len(rows) == len(texts)
    for r in rows:
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}"
        assert r["component_id"] == want[r["doc_id"]]
    return want


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    want = check(QUERIES["op3_simhash"](spark, path).collect(), texts)
    assert len(set(want.values())) < len(want)


def _fps(spark, values):
    rows = [(i, int(np.array(v, np.uint64).view(np.int64))) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, fp long").repartition(4)


def test_chains_and_dense_clusters(spark):
    rng = random.Random(5)
    values = []
    for _ in range(60):  # chains of links: ends are far apart
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.append(v)
            for b in rng.sample(range(64), rng.randint(1, 6)):
                v ^= 1 << b
    core = rng.getrandbits(64)
    values += [core ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(900)]
    values += [0, 15, 31, 2 ** 64 - 1]
    got = {r["doc_id"]: r["component_id"] for r in S.classes(_fps(spark, values), 4).collect()}
    assert got == brute_classes(dict(enumerate(values)))


@pytest.mark.parametrize("m,thresholds", [(2, [2, 1]), (3, [1, 1, 0]), (5, [1, 0, 0, 0, -1])])
def test_every_layout_finds_the_same(spark, m, thresholds, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 40)  # forces pairs of blocks
    rng = random.Random(m)
    core = rng.getrandbits(64)
    values = [core ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9))) for _ in range(150)]
    fps = _fps(spark, values)
    parts = S.group_bits(1, np.eye(64), m)
    named = {r["node"]: r["root"] for r in S.components(
        S.links(fps.select("fp").distinct(), parts, thresholds, 4)).collect()}
    signed = [int(np.array(v, np.uint64).view(np.int64)) for v in values]
    want = brute_classes(dict(enumerate(values)))
    groups = {}
    for i, v in enumerate(signed):
        groups.setdefault(named.get(v, v), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_allot_is_exact():
    costs = [[0, 5, 9, 20], [0, 1, 100, 200], [0, 3, 4, 6]]
    best = min((costs[0][a + 1] + costs[1][b + 1] + costs[2][c + 1], [a, b, c])
               for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 2)
    assert S.allot(costs, 2)[0] == best[0]


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (500, 64))
    bits[:, 40] = bits[:, 3]
    bits[:, 17] = 1 - bits[:, 3]
    parts = S.group_bits(500, (bits.T @ bits).astype(float), 4)
    assert sorted(sum(parts, [])) == list(range(64)) and {len(p) for p in parts} == {16}
    assert any({3, 17, 40} <= set(p) for p in parts)


def test_nulls_short_long_repeats_empty(spark, docs_of):
    long = " ".join(f"w{i % 977}" for i in range(100_000))
    texts = {1: None, 2: "", 3: " \n\t", 4: "one", 5: "ONE", 6: "a b c", 7: long, 8: long + " x", 9: "é ü b"}
    docs = docs_of(list(texts.items())).withColumn("fp", F.lit(1)).withColumn("root", F.lit(2))
    hexed = S.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    check(hexed.collect(), texts)
    assert S.near_duplicates(docs.limit(0)).count() == 0
    twice = S.near_duplicates(docs_of([(1, "a b"), (1, "a b"), (None, "zzz y")])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in twice) == [(0, None), (1, 1), (1, 1)]
