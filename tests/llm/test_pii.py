import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from silverline.llm import pii as P
from silverline.llm.registry import QUERIES

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def passes(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == 1:
        return all(int(x) <= 255 for x in s.split("."))
    if kind == 2:
        odd = [int(x) for x in d[::-1][::2]]
        even = [2 * int(x) for x in d[::-1][1::2]]
        return 13 <= len(d) <= 19 and (sum(odd) + sum(x - 9 if x > 9 else x for x in even)) % 10 == 0
    return kind != 3 or 9 <= len(d) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "")
            if passes(k, m.group())]


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("a1209.@-+ ()_%\né"), max_size=60))
def test_base_spans_match_the_plain_patterns(text):
    assert P.base_spans(text)[0] == brute(text)


@pytest.mark.parametrize("text", ["a@b.cc_x@c.org", "1.2.3.4.5.6.7.8", "256.1.1.1 01.02.3.4", "4111111111111111",
                                  "+1 (980) 555-6268 4111111111111111", "a.b@c.d@e.f", "4111-1111 1111-1111 2"])
def test_base_spans_of_odd_texts(text):
    assert P.base_spans(text)[0] == brute(text)


def test_base_spans_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "a@" * 100_000):
        P.base_spans(text)
        P.nodes_of(text[:50_000])


def test_whole_table(spark):
    path = "/root/testdata/sf0.1"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = QUERIES["op5_pii"](spark, path).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    added = 0
    for r in rows:
        text = texts[r["doc_id"]] or ""
        want = brute(text)
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(s[0] == i for s in want) for i in range(4)]
        told = ",".join(f"{P.KINDS[k]}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        spans = [x.split(":") for x in r["spans"].split(",") if x]
        spans = [(P.KINDS.index(k), int(s), int(e)) for k, s, e in spans]
        assert spans == sorted(spans) and set(want) <= set(spans)
        for k, s, e in set(spans) - set(want):
            added += 1
            assert passes(k, text[s:e]) and re.fullmatch(PATTERNS[k], text[s:e])
            assert not any(s < e2 and s2 < e for _, s2, e2 in want)
    assert added > 0


def _field(seed=0):
    rng = np.random.default_rng(seed)
    k = len(P.LABELS)
    return P.Field(rng.normal(0, 0.5, (P.N_FEATURES, k)), np.zeros(k), rng.normal(0, 0.7, (k, k)),
                   2.0 * np.eye(k) - 0.5)


def exact(field, graph):
    """Marginals by enumeration; ties through hidden labels."""
    k, n = len(P.LABELS), len(graph.bits)
    x = (np.array(graph.bits)[:, None] >> np.arange(P.N_FEATURES)) & 1
    node = P._norm(x @ field.weights + field.bias)
    ties = sorted({t for t in graph.ties if t and graph.ties.count(t) > 1})
    out = np.zeros((n, k))
    for y in itertools.product(range(k), repeat=n):
        s = sum(node[i, y[i]] for i in range(n)) + sum(field.chain[y[i - 1], y[i]] for i in range(n) if graph.joined[i])
        p = np.exp(s)
        for t in ties:
            p *= np.exp([sum(field.skip[y[i], h] for i in range(n) if graph.ties[i] == t) for h in range(k)]).sum()
        for i in range(n):
            out[i, y[i]] += p
    return out / out.sum(axis=1, keepdims=True)


def test_messages_are_exact_without_loops():
    field = _field()
    graphs = [P.Nodes([(0, 1)] * 4, [1, 6, 40, 3], [None] * 4, [False, True, True, False]),
              P.Nodes([(0, 1)] * 4, [9, 2, 5, 70], ["a", None, "a", "a"], [False] * 4),
              P.Nodes([], [], [], [])]
    got = P.beliefs(field, graphs, rounds=80)
    assert np.allclose(got, np.concatenate([exact(field, g) for g in graphs[:2]]), atol=1e-3)
    loop = P.Nodes([(0, 1)] * 4, [1, 6, 40, 3], ["a", "b", "a", "b"], [False, True, True, True])
    assert np.abs(P.beliefs(field, [loop], rounds=80) - exact(field, loop)).max() < 0.15


def test_ties_make_labels_agree():
    field = _field()
    field.weights[:] = 0
    field.weights[0, 2], field.weights[1, 0] = 4.0, 0.5
    apart = P.beliefs(field, [P.Nodes([(0, 1)] * 2, [1, 2], ["x", "y"], [False] * 2)], 40)
    tied = P.beliefs(field, [P.Nodes([(0, 1)] * 2, [1, 2], ["x", "x"], [False] * 2)], 40)
    assert apart[1].argmax() == 0 and tied[1].argmax() == 2 and tied[0].argmax() == 2


def _corpus():
    card = "4111111111111111"
    rows = [(i, f"call +1 (20{i % 10}) 555-01{i % 90 + 10} or mail u{i}@m{i % 7}.example.com now") for i in range(150)]
    rows += [(1000 + i, f"pay by {card} from 10.{i}.3.4 in {i} days, v{i}.0 ok") for i in range(150)]
    return rows


def test_swallowed_numbers_are_added_and_masked(spark, docs_of):
    docs = docs_of(_corpus()).selectExpr("*", "1 as masked", "2 as spans", "3 as n_email")
    field = P.train(docs)
    text = "ring +1 (201) 555-0123 4111111111111111 for 2.0 things"
    [(base, more)] = P.spans_of(field, [text])
    assert base == [] and [text[s:e] for _, s, e in sorted(more)] == ["4111111111111111", "+1 (201) 555-0123"]
    assert P.mask(text, base + more) == "ring [PHONE] [CARD] for 2.0 things"
    out = P.masked(docs, field)
    assert out.columns == docs.columns
    for r in out.collect():
        assert "@" not in r["text"] and "4111" not in r["text"] and r["n_chars"] == len(r["text"])


def test_nulls_long_texts_repeats_and_empty(spark, docs_of):
    field = P.train(docs_of(_corpus()))
    long = "word 12 " * 60_000 + "a@b.co " * 500
    docs = docs_of([(1, None), (2, ""), (3, "no data"), (4, "x@y.zz"), (4, "x@y.zz"), (None, "x@y.zz"), (5, long)])
    got = [(r["doc_id"], r["n_email"], r["spans"]) for r in P.find(docs, field, ["doc_id"]).collect()]
    by = {g[0]: g[1:] for g in got}
    assert len(got) == 7 and by[1] == by[2] == by[3] == (0, "") and by[4] == by[None] == (1, "email:0:6")
    assert by[5][0] == 500
    assert P.train(docs.limit(0)) is None and P.find(docs.limit(0), field, ["doc_id"]).count() == 0
    assert P.masked(docs).where("doc_id = 1").first()["text"] is None
    assert [r["n_email"] for r in P.find(docs.where("doc_id = 4"), None, ["doc_id"]).collect()] == [1, 1]


def test_training_counts_keep_every_row(spark, docs_of):
    rng = np.random.default_rng(6)
    digits = ["", "12", "123", "123456", "1234567890", "4111111111111111", "4111111111111112", "1" * 20]
    made = [f"{lead}{letter}{eq}{d}{at}{')' if lead == '(' else ''}" for lead, letter, eq, d, at in itertools.product(
        ["", "+", "("], ["", "z"], ["", "="], digits, ["", "@", "@b.co"])]
    made += ["10.1.2.3", "900.1.2.3", "555-0123"] * 40
    texts = [" ".join(rng.choice(made, 60)) for _ in range(2500)]
    want = Counter()
    for t in texts:
        nodes = P.nodes_of(t)
        want.update(zip(nodes.bits, P.labels_of(nodes, *P.base_spans(t))))
    want = {k: n for k, n in want.items() if k[1] >= 0}
    rows = P.training_counts(docs_of(list(enumerate(texts))))
    assert len(want) > 5000 and {(r["a"], r["b"]): r["n"] for r in rows if r["what"] == "n"} == want
    assert {r["what"] for r in rows} == {"n", "c", "t"} and len(rows) < P.MOST_ROWS


def test_shapes_are_bounded():
    rng = np.random.default_rng(7)
    parts = list("@+()-.=\"19a ,:") + ["1.2.3.4", "123456789", "4111111111111111", "b.co"]
    shapes = {P.shape("".join(rng.choice(parts, rng.integers(1, 9)))) for _ in range(30_000)}
    assert len(shapes) < 300
    assert len({tuple(s >> f & 1 for f in P.AROUND) for s in shapes}) <= 6


def test_addresses_are_tied_whatever_their_digits():
    assert P.tie_of("10.0.0.1") == P.tie_of("(10.0.00.01),") == "10.0.0.1"
    assert P.tie_of("192.168.1.10") != P.tie_of("192.16.81.10")
    assert P.tie_of("12.5") is None and P.tie_of("1.2.3.4.5") is None
