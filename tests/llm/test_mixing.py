import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from silverline.llm import mixing as M
from silverline.llm.registry import QUERIES


def test_whole_table_meets_the_targets(spark):
    path = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op9_mixing"](spark, path).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    assert sorted(rows) == sorted(docs)
    total = sum(r["tokens"] for r in rows.values())
    for r in rows.values():
        text = docs[r["doc_id"]] or ""
        assert r["tokens"] == len(text.encode().split())
        p = [r[f"p_{d}"] for d in M.TARGETS]
        assert abs(sum(p) - 1) < 1e-9 and min(p) >= 0 and r["rate"] >= 0
        assert math.floor(r["rate"]) <= r["copies"] <= math.floor(r["rate"]) + 1
    for d, want in M.TARGETS.items():
        got = sum(r["rate"] * r["tokens"] * r[f"p_{d}"] for r in rows.values()) / total
        assert abs(got - want) < 0.01
        whole = sum(r["copies"] * r["tokens"] * r[f"p_{d}"] for r in rows.values()) / total
        assert abs(whole - want) < 0.03
    labels = spark.read.parquet(f"{path}/labels.parquet").withColumn("domain", M.label_domain()).collect()
    right = [rows[r["doc_id"]][f"p_{r['domain']}"] > 0.5 for r in labels if r["domain"]]
    clean = [rows[r["doc_id"]]["copies"] > 0 for r in labels if r["domain"] == "clean"]
    assert np.mean(right) > 0.85 and np.mean(clean) > 0.95


def _cells(spark, post, tokens):
    return spark.createDataFrame([(p.tolist(), int(t)) for p, t in zip(post, tokens)],
                                 "posteriors array<double>, tokens long")


def test_same_as_projected_gradient_in_numpy(spark):
    rng = np.random.default_rng(2)
    post = rng.dirichlet([0.4] * 3, 60)
    tokens = rng.integers(10, 1000, 60).astype(float)
    domains, targets = ["a", "b", "c"], {"a": 0.6, "b": 0.3, "c": 0.1}
    fitted = M.fit(_cells(spark, post, tokens), domains, targets, most=3.0)
    got = np.array([r["r"] for r in _cells(spark, post, tokens).select(
        fitted.rate(F.col("posteriors")).alias("r")).collect()])
    whole, r = tokens.sum(), np.ones(60)
    share = tokens @ post / whole
    for _ in range(M.STEPS):
        off = (tokens * r) @ post / whole - np.array([0.6, 0.3, 0.1])
        if np.abs(off).max() < M.CLOSE:
            break
        r = np.clip(r - (post @ (off / share) + M.STAY * (r - 1)) / (1 + M.STAY), 0, 3.0)
    assert np.allclose(got, r, atol=1e-9)
    assert np.abs((tokens * got) @ post / whole - [0.6, 0.3, 0.1]).max() < 5e-3


def test_unreachable_targets_give_the_nearest_fit(spark):
    post = np.array([[1.0, 0.0], [1.0, 0.0]])
    fitted = M.fit(_cells(spark, post, [10, 30]), ["a", "b"], {"a": 0.5, "b": 0.5})
    got = [r["r"] for r in _cells(spark, post, [10, 30]).select(fitted.rate(F.col("posteriors")).alias("r")).collect()]
    assert all(abs(g - 0.5) < 0.01 for g in got)
    assert M.fit(_cells(spark, post, [0, 0]), ["a", "b"], {"a": 1, "b": 1}).history == []


def _corpus():
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(240):
        kind = i % 4
        own = {0: "vile", 1: "###"}.get(kind, "calm")
        words = [f"w{j}" for j in rng.integers(0, 80, 30)] + [f"{own}{j}" for j in rng.integers(0, 6, 10)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind != 1), int(kind == 0)))
    return rows, labels


def test_posteriors_follow_naive_bayes(spark, docs_of):
    rows, labels = _corpus()
    docs = docs_of(rows)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = M.train(docs, marked, list(M.TARGETS))
    buckets = {r["doc_id"]: r["b"] for r in docs.select("doc_id", F.array_distinct(M.words("text")).alias("w")).select(
        "doc_id", F.transform("w", M.bucket).alias("b")).collect()}
    for r in docs.select("doc_id", model.measures("text")["posteriors"].alias("p")).collect():
        told = [model.ratios[b] for b in buckets[r["doc_id"]] if b in model.ratios]
        z = np.array(model.prior) + np.sum([[0.0] * 3, *told], axis=0) / np.sqrt(1 + len(told) / M.FULL_WEIGHT)
        p = np.exp(np.maximum(z - z.max(), -50))
        assert np.abs(np.array(r["p"]) - p / p.sum()).max() <= 0.011
        domain = ["toxic", "junk", "clean", "clean"][r["doc_id"] % 4]
        assert r["p"][list(M.TARGETS).index(domain)] > 0.5
    seen = Counter(b for bs in buckets.values() for b in set(bs))
    assert set(model.ratios) <= set(seen)


def test_copies_repeat_rows(spark, docs_of):
    rows, labels = _corpus()
    docs = docs_of(rows).selectExpr("*", "1 as copies", "'x' as rate", "2 as tokens", "3 as again")
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    targets = {"clean": 0.8, "junk": 0.1, "toxic": 0.1}
    full, (_, _, rate, copies) = M.rated(docs, marked, targets, steps=6)
    want = {r["doc_id"]: r[copies] for r in full.collect()}
    out = M.mixed(docs, marked, targets, steps=6)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({i: c for i, c in want.items() if c})


def test_nulls_long_texts_repeats_and_empty(spark, docs_of):
    rows, labels = _corpus()
    marked = spark.createDataFrame([*labels, (None, 1, 1), (1, None, None), (2, 0, 1)], "doc_id long, quality int, toxic int")
    docs = docs_of(rows + [(901, None), (902, ""), (903, " \n"), (904, "calm1 w2 " * 100_000), (5, rows[5][1]),
                           (None, "w1")])
    out, _ = M.rated(docs, marked, steps=4)
    got = [(r["doc_id"], r["tokens"], r["rate"]) for r in out.collect()]
    assert len(got) == 246
    by = {g[0]: g[1:] for g in got}
    assert by[901] == by[902] == by[903] and by[901][0] == 0 and by[904][0] == 200_000
    assert len({g for g in got if g[0] == 5}) == 1
    assert M.mixed(docs.limit(0), marked).count() == 0
    plain, _ = M.rated(docs, marked.limit(0), steps=4)
    assert plain.where("rate is null").count() == 0


def test_no_python_in_the_plan(spark, sf_small):
    plan = QUERIES["op9_mixing"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_rates_have_no_upper_bound(spark):
    cells = _cells(spark, np.eye(3), [98_000, 1_500, 500])
    rates = M.fit(cells, list(M.TARGETS), M.TARGETS)
    got = {r["posteriors"].index(1.0): r["r"] for r in cells.withColumn("r", rates.rate(F.col("posteriors"))).collect()}
    off = [got[d] * n / 100_000 - w for d, (n, w) in enumerate(zip([98_000, 1_500, 500], M.TARGETS.values()))]
    assert max(map(abs, off)) < 1e-3 and max(got.values()) > 13


def _settled(spark, post, tokens, targets):
    cells = _cells(spark, post, tokens)
    rates = M.settle(cells, list(targets), targets, M.fit(cells, list(targets), targets))
    return rates, np.array([r["r"] for r in cells.select(rates.rate(F.col("posteriors")).alias("r")).collect()])


def test_soft_posteriors_settle_at_the_optimum(spark):
    rng = np.random.default_rng(5)
    post = rng.dirichlet(np.array([0.76, 0.12, 0.12]) * 60, 400)
    tokens = rng.integers(10, 1000, 400)
    rates, r = _settled(spark, post, tokens, M.TARGETS)
    want, whole = np.array(list(M.TARGETS.values())), tokens.sum()
    share, got = tokens @ post / whole, (tokens * r) @ post / whole
    gradient = post @ ((got - want) / share) + M.STAY * (r - 1)
    assert rates.settled and min(r) >= 0
    assert np.abs(np.where(r > 0, gradient, np.minimum(gradient, 0))).max() < 1e-5
    assert np.allclose(list(rates.achieved.values()), got) and abs(rates.residual - np.abs(got - want).max()) < 1e-9
    assert rates.residual < 0.025  # 40 gradient steps: 0.05


def test_settled_fit_without_a_domain_or_tokens(spark):
    post = np.array([[1.0, 0.0], [1.0, 0.0]])
    rates, r = _settled(spark, post, [10, 30], {"a": 0.5, "b": 0.5})
    assert np.abs(r - 0.5).max() < 0.01 and rates.settled and abs(rates.residual - 0.5) < 1e-9
    rates, r = _settled(spark, post, [0, 0], {"a": 0.5, "b": 0.5})
    assert list(r) == [1.0, 1.0] and rates.residual == 0
