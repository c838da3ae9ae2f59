import zlib

import numpy as np

from silverline.llm import langid as L
from silverline.llm.registry import QUERIES


def test_held_out_accuracy_on_the_whole_table(spark):
    path = "/root/testdata/sf0.1"
    rows = QUERIES["op2_language"](spark, path).collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [langs[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.99


def test_codewords_are_distinct_and_far_apart():
    for n in (1, 2, 3, 4, 7, 8, 20):
        code = L.codewords(n).astype(int)
        assert len(np.unique(code, axis=0)) == n and set(np.unique(code)) <= {-1, 1}
        if n > 1:
            apart = (code.shape[1] - (code @ code.T)[~np.eye(n, dtype=bool)]) // 2
            assert apart.min() >= (1 if n == 2 else 2 if n == 3 else code.shape[1] // 4)
    assert L.codewords(4).shape == (4, 7)


def test_decoding_repairs_a_wrong_bit_and_flags_ties():
    code = L.codewords(4)
    m = L.Model(list("abcd"), code, np.zeros((1 << L.BUCKET_BITS, 7), np.float32), np.zeros(7), np.full((4, 7), 1 / 7))
    margins = 3.0 * code[2:3].astype(float)
    margins[0, 1] *= -0.6
    assert m.losses(margins)[0].argmin() == 2
    assert L.predict(m, ["tie"]) == [("a", 0.25, True)]
    trusted = L.Model(m.languages, code, m.weights, m.bias, np.where(np.arange(7) == 1, 0.01, 0.99 / 6) * np.ones((4, 1)))
    assert trusted.losses(margins)[0][2] < m.losses(margins)[0][2]


def test_nulls_letters_long_texts_and_empty(spark, docs_of):
    en, de = "the quick brown fox and the lazy dog ", "der schnelle braune fuchs und der faule hund "
    docs = docs_of([(i, (en, de)[i % 2] * (1 + i % 3), ("en", "de")[i % 2]) for i in range(40)])
    model = L.train(docs)
    assert model.languages == ["de", "en"]
    odd = docs_of([(1, None), (2, ""), (3, "12 !? 7"), (4, en * 60_000), (5, de), (5, de), (None, de)])
    odd = odd.selectExpr("*", "'x' as score", "'y' as lang_pred", "1 as ids")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in L.classify(odd, model, ["doc_id"]).collect()]
    by = {g[0]: g[1] for g in got}
    assert by[1] == by[2] == by[3] == "und" and by[4] == "en" and by[5] == by[None] == "de" and len(got) == 7
    assert L.train(docs.limit(0)) is None and L.train(odd) is None
    assert L.classify(odd, None, ["doc_id"]).where("lang_pred <> 'und'").count() == 0
    assert L.classify(docs.limit(0), model, ["doc_id"]).count() == 0
    one = L.train(docs.where("lang = 'en'"))
    assert L.predict(one, [de])[0][0] == "en"


def test_repeated_rows_and_a_hot_language_stay_in_the_sample(spark, docs_of, monkeypatch):
    rows = [(i, f"word{i} alpha beta", "en") for i in range(3000)] + [(9000 + i, "das ist gut", "de") for i in range(5)]
    docs = docs_of(rows).unionByName(docs_of([(7, "word7 alpha beta", "en"), (9001, "das ist", "de")]).crossJoin(
        spark.range(25_000)).drop("id"))
    seen = []
    monkeypatch.setattr(L, "fit", lambda sample: seen.extend(sample))
    L.train(docs, per_language=40, sample=100)
    assert sum(s[0] == "en" for s in seen) == 40 and sum(s[0] == "de" for s in seen) == 5
    narrow = docs.selectExpr("lang AS label", "CAST(doc_id AS STRING) AS id")
    drawn = {r["id"] for r in L.drawn_ids(narrow, 40, 100).collect() if r["label"] == "en"}
    order = spark.createDataFrame([(str(i),) for i in range(3000)], "id string").selectExpr("id", "xxhash64(id) AS h")
    assert drawn == {r["id"] for r in order.orderBy("h", "id").limit(40).collect()}


def test_every_language_can_be_predicted(spark, docs_of):
    """More languages than any cap: each is learned and told."""
    texts = {f"l{i}": " ".join(chr(0x4E00 + 7 * i + j % 5) * 3 for j in range(12)) for i in range(230)}
    docs = docs_of([(k, t, lang) for k, (lang, t) in enumerate(sorted(texts.items()) * 2)])
    model = L.train(docs, sample=300)
    assert sorted(model.languages) == sorted(texts)
    got = L.predict(model, list(texts.values()))
    assert np.mean([g[0] == lang for g, lang in zip(got, texts)]) > 0.95


def test_losses_bit_by_bit():
    rng = np.random.default_rng(3)
    code, trust, margins = L.codewords(9), rng.random((9, L.codewords(9).shape[1])), rng.normal(0, 2, (5, L.codewords(9).shape[1]))
    m = L.Model(list("abcdefghi"), code, np.zeros((1, 1)), np.zeros(1), trust)
    want = [[sum(t * np.log1p(np.exp(-x * c)) for t, x, c in zip(trust[k], row, code[k])) for k in range(9)] for row in margins]
    assert np.allclose(m.losses(margins), want)
