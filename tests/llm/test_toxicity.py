import zlib

import numpy as np

from silverline.llm import toxicity as T
from silverline.llm.registry import QUERIES


def test_held_out_documents_of_the_whole_table(spark):
    path = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang").collect()
    lang = {r["doc_id"]: r["lang"] for r in docs}
    assert sorted(rows) == sorted(lang)
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    labels = spark.read.parquet(f"{path}/labels.parquet").collect()
    held = [(r["toxic"], rows[r["doc_id"]]) for r in labels if rows[r["doc_id"]]["held_out"]]
    clean = np.mean([x["predicted"] for y, x in held if y == 0])
    found = {}
    for y, x in held:
        if y == 1:
            found.setdefault(lang[x["doc_id"]], []).append(x["predicted"])
    assert clean < 0.01 and len(found) >= 4
    # measured: en 0.90 of 82, fr 0.90 of 30, de 0.85 of 20, es 0.92 of 12
    assert all(np.mean(v) >= 0.8 for v in found.values()), {k: (len(v), np.mean(v)) for k, v in found.items()}


def test_slope_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 12).astype(float)
    doc = np.sort(rng.integers(0, 12, 40))
    sentence = np.sort(rng.integers(0, 40, 160))
    ids, share, w = rng.integers(0, 20, 160), rng.random(12), rng.normal(0, 0.7, 21)
    # the likelihood again, bag by bag
    p = [1 / (1 + np.exp(-(w[ids[sentence == s]].sum() + w[-1]))) for s in range(40)]
    value = sum(share[d] * (np.log(T.noisy_or(np.array([p[s] for s in np.flatnonzero(doc == d)]))) if labels[d] == 1
                            else sum(np.log1p(-p[s]) for s in np.flatnonzero(doc == d)))
                for d in range(12) if labels[d] == 0 or (doc == d).any())
    got, grad = T.slope(w, ids, sentence, doc, labels, share, 0.0)
    empty = sum(share[d] * np.log(1e-9) for d in range(12) if labels[d] == 1 and not (doc == d).any())
    assert abs(got - value - empty) < 1e-5
    for i in range(21):
        up, down = w.copy(), w.copy()
        up[i], down[i] = up[i] + 1e-6, down[i] - 1e-6
        numeric = (T.slope(up, ids, sentence, doc, labels, share, 1e-2)[0]
                   - T.slope(down, ids, sentence, doc, labels, share, 1e-2)[0]) / 2e-6
        assert abs(numeric - T.slope(w, ids, sentence, doc, labels, share, 1e-2)[1][i]) < 1e-6 * max(1, abs(numeric))


def test_repeated_rows_of_an_id_are_one_bag(spark, docs_of, monkeypatch):
    rows = _corpus(60)
    docs = docs_of([(i, t) for i, t, _ in rows]).unionByName(docs_of([(0, rows[0][1]), (1, "z " * 3 + ". " * 9)]).crossJoin(
        spark.range(25_000)).drop("id"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(T, "fit", lambda bags: seen.extend(bags))
    monkeypatch.setattr(T, "PER_CLASS", 20)
    T.train(docs, labels)
    assert len(seen) == 15 + 20
    assert T.bag("a b. " * 1000, T.Hasher(), 400)[1] == [2] * 400


def test_noisy_or_and_sentences():
    assert abs(T.noisy_or(np.array([0.5, 0.5])) - 0.75) < 1e-12 and T.noisy_or(np.array([0.0])) == 0
    text = "One two. Three!\n\nfour?  Five"
    assert [text[s:e] for s, e in T.sentences(text)] == ["One two.", "Three!", "four?", "Five"]
    assert T.sentences(None) == T.sentences("") == [(0, 0)]


def _corpus(n=400, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        cut = [" ".join(f"w{j}" for j in rng.integers(0, 300, 8)) + "." for _ in range(rng.integers(1, 9))]
        bad = i % 4 == 0
        if bad:
            at = rng.integers(0, len(cut))
            cut[at] = cut[at].replace(" ", " vile ", 1)
        rows.append((i, " ".join(cut), int(bad)))
    return rows


def test_offending_sentences_are_located(spark, docs_of):
    rows = _corpus()
    docs = docs_of([(i, t) for i, t, _ in rows]).selectExpr("*", "1 as toxic", "2 as offending", "3 as draw")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = T.train(docs, labels)
    for r in T.score(docs, model, ["doc_id"]).collect():
        i, text, y = rows[r["doc_id"]]
        assert (r["score"] >= 0.7) == bool(y)
        found = [text[s["start"]:s["end"]] for s in r["offending"]]
        assert found == [text[s:e] for s, e in T.sentences(text) if "vile" in text[s:e]]


def test_nulls_long_texts_one_label_and_empty(spark, docs_of):
    rows = _corpus(200)
    docs = docs_of([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = T.train(docs, labels)
    odd = docs_of([(1, None), (2, ""), (3, "w1 w2 w3. " * 100_000 + "vile w4"), (4, "vile"), (4, "vile"), (None, "w")])
    got = [(r["doc_id"], round(r["score"], 9)) for r in T.score(odd, model, ["doc_id"]).collect()]
    by = dict(got)
    assert len(got) == 6 and by[1] == by[2] and by[4] > 0.7 and by[3] > 0.7 and by[1] < 0.5
    assert T.score(odd.limit(0), model, ["doc_id"]).count() == 0
    none = T.train(docs, labels.limit(0))
    assert {r["score"] for r in T.score(odd, none, ["doc_id"]).collect()} == {0.0}
    assert T.train(docs, labels.where("toxic = 1")).constant == 1.0
