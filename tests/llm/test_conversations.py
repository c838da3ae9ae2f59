import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from silverline.llm import conversations as C
from silverline.llm.registry import QUERIES

KIND = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, repaired [(role, text)]) by trying every sequence of edits; rows: (role, text, forced, cut)."""
    best = [(3 * len(rows) + 1, "", None)]

    def go(i, roles, audit, cost, out):
        if cost > best[0][0] or not re.fullmatch(r"s?(ua)*u?", roles):
            return
        if i == len(rows) and PATTERN.fullmatch(roles):
            best[0] = min(best[0], (cost, audit, tuple(out)))
        if i < len(rows):
            role, text, forced, cut = rows[i]
            go(i + 1, roles, audit + "D", cost + 3, out)
            if not forced:
                if role[:1] in ("s", "u", "a"):
                    go(i + 1, roles + role[:1], audit + "K", cost + cut, [*out, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, roles + new[0], audit + "R", cost + 2 + cut, [*out, (new, text)])
        for new in ("user", "assistant"):
            go(i, roles + new[0], audit + "I", cost + 2, [*out, (new, "")])

    go(0, "", "", 0, [])
    return best[0]


ROWS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.booleans(), st.booleans(),
                          st.sampled_from([1, 1, 1, 2])), max_size=4)


@settings(max_examples=150, deadline=None)
@given(ROWS)
def test_auction_finds_the_cheapest_least_audit(some):
    flat = [(role, "x", forced or k > 0, cut and not forced and k == 0) for role, forced, cut, n in some
            for k in range(n)]
    cost, audit, _ = cheapest(flat)
    lattice = tuple((role[:1], forced, cut and not forced, n) for role, forced, cut, n in some)
    assert C.solve(lattice) == (cost, audit)


@settings(max_examples=100, deadline=None)
@given(ROWS, ROWS, ROWS)
def test_pieces_chain_to_the_whole(a, b, c):
    parts = [tuple((role[:1], forced, cut and not forced, n) for role, forced, cut, n in p) for p in (a, b, c) if p]
    whole = tuple(r for p in parts for r in p)
    if whole:
        cost, taken = C.chain([C.ways_through(p) for p in parts])
        assert (cost, "".join(w for _, w in taken)) == C.solve(whole)


def test_prices_are_feasible_and_tight():
    rows = (("u", False, False, 1), ("u", False, True, 1), ("a", True, False, 2), ("a", False, False, 1))
    price = C.auction(rows, (0, 4, 2, 0))
    for i in range(len(rows)):
        for state in range(4):
            values = [cost + price[j][s] for _, cost, (j, s) in C.arcs(rows, i, state)]
            assert price[i][state] == min(values)


def expected(table):
    """conv_id -> the contract's columns, row by row."""
    sp = " "
    convs = {}
    for conv, turn, role, text in table:
        convs.setdefault(conv, [])
        key = f"{sp if conv is None else conv}:{sp if turn is None else turn}"
        role, text = (sp if v is None else v for v in (role, text))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in rows if t is not None]
        seen, kinds, edit = set(), [], []
        for _, role, text in rows:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            kind = ("blank" if not bare else "duplicate" if (role, text) in seen
                    else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            kinds.append(kind)
            edit.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
        cost, audit, done = cheapest(edit)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        body = "\n".join(f"{r}:{t}" for r, t in done or ())
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"),
                     kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
                     hashlib.sha256(body.encode()).hexdigest())
    return out


def got(spark, as_tables, df):
    rows = QUERIES["op11_conversations"](spark, as_tables(conversations=df)).collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table_against_every_sequence_of_edits(spark):
    sf = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    rows = QUERIES["op11_conversations"](spark, sf).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in rows} == expected(table)


def test_nulls_ties_repeats_and_gaps(spark, as_tables):
    table = [(None, 0, "user", "a."), (None, 5, "assistant", "b"), (1, None, None, "x."), (1, None, "user", None),
             (2, 3, "user", "same."), (2, 3, "user", "same."), (2, 3, "assistant", "same."), (2, 9, "", "n."),
             (3, 1, "tool", "t!"), (3, 2, "assistant", " "), (4, None, "user", "  \n")]
    table += [(100 + c, t, ("system", "user", "assistant")[(c * t) % 3], f"text {t % 2}{'.' * (c % 2)}")
              for c in range(40) for t in range(4)]
    df = spark.createDataFrame(table, KIND).selectExpr("*", "1 AS c", "2 AS n", "3 AS H")
    assert got(spark, as_tables, df) == expected(table)


def test_a_conversation_over_many_tasks(spark, as_tables, monkeypatch):
    """A hot conversation: cut into pieces in many ranges; its audit is that of the whole."""
    roles = ["user", "assistant", "assistant", "user", "system", "user", "assistant"]
    table = [(7, t, roles[t % 7], f"turn {t % 900}{'.' if t % 5 else ''}") for t in range(3000)]
    table += [(c, t, roles[t], f"turn {t}.") for c in range(10, 40) for t in range(2)]
    rows = C.as_they_are(spark.createDataFrame(table, KIND))
    summary, edits = C.repair(rows)
    found = {r["c"]: r for r in summary.collect()}
    flat, seen = [], set()
    for _, _, role, text in table[:3000]:
        again = (role, text) in seen
        seen.add((role, text))
        flat.append((role[0], again, not again and text[-1] != ".", 1))
    assert (found["7"]["cost"], found["7"]["audit"]) == C.solve(tuple(flat))
    assert edits.where("c = '7'").count() == 3000
    out = C.repaired(rows, edits).where("c = '7'").orderBy("t", "role", "h", "place").collect()
    initials = "".join(r["new_role"][0] for r in out)
    assert PATTERN.fullmatch(initials)
    body = "\n".join(f"{r['new_role']}:{r['text']}" for r in out)
    digest = C.digests(rows, edits).where("c = '7'").collect()[0]["repaired_sha256"]
    assert digest == hashlib.sha256(body.encode()).hexdigest()


def test_empty_table(spark, as_tables):
    assert got(spark, as_tables, spark.createDataFrame([], KIND)) == {}


def test_very_long_text(spark, as_tables):
    table = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "y" * 3_000_000)]
    assert got(spark, as_tables, spark.createDataFrame(table, KIND)) == expected(table)


@pytest.mark.parametrize("copies", [50])
def test_many_equal_rows(spark, as_tables, copies):
    table = [(1, 1, "user", "again.")] * copies + [(1, 2, "assistant", "ok.")]
    cols = got(spark, as_tables, spark.createDataFrame(table, KIND))[1]
    fault = zlib.crc32(b"1:1") % 20
    assert fault not in (0, 1, 3) and cols[2] == copies - 1 and "D" * (copies - 1) in cols[6]
