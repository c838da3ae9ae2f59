import random

import numpy as np
from pyspark.sql import functions as F

from silverline.llm import licenses as L
from silverline.llm.common import shingle_hashes
from silverline.llm.registry import QUERIES


def brute(text):
    """Templates whose containment in some run of words reaches 0.8, over every window."""
    words, out = L.words_of(text), set()
    for name, t in L.TEMPLATES:
        tw = L.words_of(t)
        k = min(5, len(tw))
        want = {tuple(tw[i:i + k]) for i in range(len(tw) - k + 1)}
        own = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
        n = len(tw) - k + 1
        if any(len(set(own[i:i + n]) & want) >= 0.8 * len(want) for i in range(max(1, len(own) - n + 1))):
            out.add(name)
    return out


def test_whole_table_against_every_window(spark):
    path = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = QUERIES["op10_licenses"](spark, path).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    found = 0
    for r in rows:
        got = set(filter(None, r["licenses"].split(",")))
        assert got == brute(texts[r["doc_id"]])
        found += bool(got)
    assert found > 10


def test_edited_templates_in_long_texts():
    kinds, rng = L.classes(), random.Random(3)
    missed = total = 0
    for name, t in L.TEMPLATES * 8:
        words = t.split()
        if len(words) > 20:  # a changed word breaks at most five shingles
            for _ in range(len(words) // 40):
                words[rng.randrange(len(words))] = "changed"
        fill = [f"w{rng.randrange(900)}" for _ in range(400)]
        at = rng.randrange(400)
        text = " ".join(fill[:at] + words + fill[at:])
        if name in brute(text):
            total += 1
            got = [m for m in L.scan(text, kinds) if m[0] == name]
            missed += not got
            for _, s, e, share in got:
                assert share >= 0.8 and abs(s - at) <= len(words) // 2 + 1
    assert total > 80 and missed == 0


def test_band_settings_guarantee_the_probability():
    for c in L.classes():
        j = L.least_jaccard(c.shingles, c.stride, c.width)
        assert 1 - (1 - j ** L.ROWS) ** c.bands >= L.SURE and j > 0.55
    c = next(c for c in L.classes() if c.shingles > 40)
    rng, hits = np.random.default_rng(1), 0
    own = c.sets[0]
    for _ in range(300):  # windows of the least similarity collide as often as promised
        part = own.copy()
        held = (np.ceil(L.LEAST * c.shingles) - c.stride // 2) / c.shingles
        swap = rng.permutation(len(own))[: len(own) - int(np.ceil(held * len(own)))]
        part[swap] = rng.integers(0, 2 ** 63, len(swap)).astype(np.uint64)
        more = rng.integers(0, 2 ** 63, c.width - c.shingles).astype(np.uint64)
        part = np.concatenate([part, more])
        hits += bool((L._band_keys(L._min_rows(part, c.odd, 1, len(part), 1))[:, 0] == c.keys[0]).any())
    assert hits >= 297


def test_minhash_rows_are_window_minima():
    h = shingle_hashes([f"w{i}".encode() for i in range(60)], 5)
    odd = np.array([3, 7], np.uint32)
    g = (h >> np.uint64(32)).astype(np.uint32)[None, :] * odd[:, None]
    for stride, blocks in ((1, 1), (1, 2), (1, 7), (2, 3), (3, 1), (4, 5), (7, 9)):
        windows = -(-max(0, len(h) - stride * blocks) // stride) + 1
        want = np.array([[g[j, i * stride:(i + blocks) * stride].min() for i in range(windows)] for j in range(2)])
        assert (L._min_rows(h, odd, stride, blocks, windows) == want).all()


def test_nulls_long_texts_repeats_and_empty(spark, docs_of):
    mit = dict(L.TEMPLATES)["mit"]
    long = "some words " * 60_000 + mit + " more words" * 60_000
    docs = docs_of([(1, None), (2, ""), (3, " .. "), (4, mit), (4, mit), (5, long), (6, f"{mit} {mit}"),
                    (None, "RELEASED\nunder the MIT license")])
    docs = docs.withColumn("matches", F.lit(1)).withColumn("licenses", F.lit(2))
    got = [(r["doc_id"], [(m["template"], m["first_word"]) for m in r["matches"]])
           for r in L.matches(docs, ["doc_id"]).collect()]
    by = dict(got)
    assert len(got) == 8 and by[1] == by[2] == by[3] == []
    assert by[4] == by[None] == [("mit", 0)] and by[5] == [("mit", 120_000)]
    assert by[6] == [("mit", 0), ("mit", 5)]
    assert L.matches(docs.limit(0), ["doc_id"]).count() == 0
