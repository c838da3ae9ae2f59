import re
from collections import Counter

import corpus_pipeline as P
from silverline.llm import mixing, pii, quality, simhash
from silverline.llm.common import table
from test_packing import check
from test_packing import tokenizer  # noqa: F401
from test_simhash import brute_classes, brute_fingerprint

import __spark_entry__ as entry


def run_stages(spark, docs, sf_dir, tmp_path):
    out = [docs]
    for at, (_, stage) in enumerate(P.STAGES):
        path = f"{tmp_path}/stage-{at}"
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_against_brute_force(spark, tmp_path, tokenizer):  # noqa: F811
    path = "/root/testdata/sf0.001"
    raw, good, single, safe, mixed, packed = run_stages(spark, table(spark, path, "documents"), path, tmp_path)
    for df in (good, single, safe, mixed):
        assert df.columns == raw.columns

    verdict = {r["doc_id"]: r["kept"] for r in quality.quality(raw).collect()}
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    assert set(texts) == {i for i, kept in verdict.items() if kept}

    classes = brute_classes({i: brute_fingerprint(t) for i, t in texts.items()})
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(classes.values()))

    field = pii.train(single)
    for r in safe.collect():
        [(base, more)] = pii.spans_of(field, [texts[r["doc_id"]]])
        assert r["text"] == pii.mask(texts[r["doc_id"]], base + more) and r["n_chars"] == len(r["text"])

    full, (_, _, _, copies) = mixing.rated(safe, table(spark, path, "labels"))
    want = Counter({r["doc_id"]: r[copies] for r in full.collect() if r[copies]})
    rows = mixed.collect()
    assert Counter(r["doc_id"] for r in rows) == want

    once = mixed.dropDuplicates(["doc_id"])
    from silverline.llm import packing
    check(packing.packed(once).collect(), {r["doc_id"]: r["text"] for r in once.collect()}, tokenizer)
    pieces = packed.collect()
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == want
    ends = Counter(r["doc_id"] for r in pieces if r["start"] + r["length"] == r["doc_tokens"])
    assert ends == want


def test_run_is_the_registered_query(spark):
    path = "/root/testdata/sf0.001"
    got = entry.queries()["pipeline"](spark, path)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns) and got.count() > 0
    names = [n for n in entry.queries() if re.fullmatch(r"op\d+_\w+", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_one_of_each_keeps_the_least_id_and_all_columns(spark, docs_of):
    text = "one two three four five six seven eight nine ten"
    docs = docs_of([(5, text, "en"), (3, text, "de"), (3, text, "de"), (8, "quite another text stands here", "en"),
                    (None, None), (None, None)]).selectExpr("*", "1 as row", "2 as fp", "array(1, 2) as more")
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["lang"]) for r in out.collect() if r["doc_id"]) == [(3, "de"), (8, "en")]
    assert out.where("doc_id is null").count() == 1
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_odd_rows_and_empty_tables_pass_all_stages(spark, docs_of, as_tables, monkeypatch):
    monkeypatch.setattr(mixing.fit, "__defaults__", (*mixing.fit.__defaults__[:2], 4))  # few steps: a quick test
    fill = [(i, " ".join(f"w{i}{j % 37}x{j}" for j in range(40 + i)), "en", "s") for i in range(20)]
    docs = docs_of(fill + [(100, None), (101, ""), (102, " \n ", None), (103, "tok " * 50_000, "en"),
                           fill[3], fill[3], (None, fill[4][1], None, None)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, None, None)],
                                   "doc_id long, quality int, toxic int")
    path = as_tables(documents=docs, labels=labels)
    assert P.run(spark, path).count() > 0
    empty = as_tables(documents=docs.limit(0), labels=labels.limit(0))
    assert P.run(spark, empty).count() == 0
