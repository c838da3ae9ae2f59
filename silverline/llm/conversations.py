r"""11. Conversation structure repair: an auction over the lattice of edits.

A conversation's rows, in order of turn, are to give role initials
``(s?(ua)+)?``.  Keep costs 0, Rerole (to user or assistant) 2, Delete 3 (a
must for blank rows and repeats), Insert (an empty text of user or assistant)
2; a truncated row that is not deleted adds 1.  The lattice has a node for
each (rows done, state of the pattern).

**Auction.**  Every node has a price, never above arc cost plus price at the
arc's end.  From an origin a path is grown: if the last node's price is below
its cheapest arc plus price, the price rises to it and the path contracts by
that node; else the path extends along that (tight) arc, until it meets a node
whose price has converged.  Origins go from the last row to the first, so all
prices converge to the exact cost of the rest.  Tight arcs are then just those
of cheapest repairs; taking the letter of least code point at each node traces
the ASCII-least audit.

**Scale.**  Rows without texts (their fault flags and a hash of the text) are
dealt by ranges of (conversation, turn, role, hash), so one conversation may
span many tasks.  A conversation inside a task is solved there.  A piece of
one (cut by a range's end or after ``PIECE`` rows) gives, for each state it
may be entered and left in, the cost and least letters; one row a piece is
chained for the conversation.  Equal rows (same turn, role and text) are one
row with a count.  The digest of a repaired conversation is one SHA-256, so
its texts pass one task, as a stream: memory holds one batch.

Cases: null role or text is one space (so a null text is blank); a null or
empty role has no initial in the pattern, so its row is never kept as it is;
null turns come first; rows of equal turn go by role, then hash of the text;
a null conv_id is a conversation of its own; an empty table gives no rows;
extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import stored, table

#: Costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Most rows of a piece of a conversation.
PIECE = 4096
NEVER = 1 << 60
#: States of the pattern (s?(ua)+)?: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A,
        (AFTER_A, "u"): AFTER_U}
#: The role that an inserted or rerolled row takes in each state, and the state after it.
ROLE = ["u", "u", "a", "u"]
AFTER = [AFTER_U, AFTER_U, AFTER_A, AFTER_U]
#: Inserts that finish the pattern after the last row, by state.
ENDING = ["", "II", "I", ""]
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
SPACES = " \t\n\x0b\x0c\r"


# ---- the lattice --------------------------------------------------------------

Row = tuple[str, bool, bool, int]  # role initial, must go, truncated, equal rows


def arcs(rows: tuple[Row, ...], i: int, state: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
    """(letters, cost, node) of the arcs of a node, by first letter.

    Of ``n`` equal rows all but the first must go: no insert between them makes
    an audit less, so an arc takes them together.
    """
    if i == len(rows):
        return
    role, must_go, cut, n = rows[i]
    rest, more = "D" * (n - 1), DELETE * (n - 1)
    yield "D" + rest, DELETE + more, (i + 1, state)
    yield "I", INSERT, (i, AFTER[state])
    if not must_go:
        more += TRUNCATED * cut
        if (state, role) in STEP:
            yield "K" + rest, KEEP + more, (i + 1, STEP[state, role])
        yield "R" + rest, REROLE + more, (i + 1, AFTER[state])


def auction(rows: tuple[Row, ...], exits: tuple[int, ...]) -> list[list[int]]:
    """Converged price (cheapest cost of the rest) of every node (rows done, state).

    ``exits`` are the prices after the last row (``NEVER``: no exit there).
    """
    price = [[0] * 4 for _ in rows] + [list(exits)]
    settled = [[False] * 4 for _ in rows] + [[True] * 4]
    for i in range(len(rows) - 1, -1, -1):
        # a first price below every way on keeps prices feasible
        ways = [min((c + price[a][s] for _, c, (a, s) in arcs(rows, i, state) if a > i), default=NEVER)
                for state in range(4)]
        price[i] = [min(min(ways), NEVER)] * 4
        for state in (AFTER_U, AFTER_A) if min(ways[AFTER_U], ways[AFTER_A]) >= NEVER else ():
            price[i][state], settled[i][state] = NEVER, True  # they only lead to each other
        for origin in range(4):
            path = [] if settled[i][origin] else [(i, origin)]
            while path:
                at, state = path[-1]
                best, end = min((min(c + price[a][s], NEVER), (a, s)) for _, c, (a, s) in arcs(rows, at, state))
                if price[at][state] < best:
                    price[at][state] = best  # contract
                    if len(path) > 1:
                        path.pop()
                elif settled[end[0]][end[1]]:
                    for a, s in path:
                        settled[a][s] = True
                    path = []
                else:
                    path.append(end)  # extend
    return price


def trace(rows: tuple[Row, ...], price: list[list[int]], state: int) -> tuple[str, int]:
    """Letters of the ASCII-least path of tight arcs from the first row on, and the state it ends in."""
    i, out = 0, []
    while i < len(rows):
        letters, _, (i, state) = next(arc for arc in arcs(rows, i, state)
                                      if arc[1] + price[arc[2][0]][arc[2][1]] == price[i][state])
        out.append(letters)
    return "".join(out), state


@lru_cache(1 << 14)
def solve(rows: tuple[Row, ...]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    price = auction(rows, tuple(INSERT * len(e) for e in ENDING))
    letters, state = trace(rows, price, START)
    return price[0][START], letters + ENDING[state]


def ways_through(rows: tuple[Row, ...]) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, least letters) of a piece's cheapest ways."""
    out = []
    for leave in range(4):
        price = auction(rows, tuple(0 if s == leave else NEVER for s in range(4)))
        out += [(enter, leave, price[0][enter], trace(rows, price, enter)[0])
                for enter in range(4) if price[0][enter] < NEVER]
    return out


def chain(pieces: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost, and (state before, letters) of each piece, of a conversation in pieces.

    Of two ways through a piece neither's letters begin with the other's (a
    piece ends with a row), so the least letters first are the least audit.
    """
    price = [[INSERT * len(e) for e in ENDING]]
    for ways in reversed(pieces):
        now = [NEVER] * 4
        for enter, leave, cost, _ in ways:
            now[enter] = min(now[enter], cost + price[-1][leave])
        price.append(now)
    price.reverse()
    state, out = START, []
    for k, ways in enumerate(pieces):
        letters, after = min((w, leave) for enter, leave, cost, w in ways
                             if enter == state and cost + price[k + 1][leave] == price[k][state])
        out.append((state, letters))
        state = after
    if out:
        out[-1] = (out[-1][0], out[-1][1] + ENDING[state])
    return price[0][START], out


# ---- Spark --------------------------------------------------------------------

def damaged(convs: DataFrame) -> DataFrame:
    """``c, t, role, text, copies`` after the contract's damage (``copies`` 0: dropped)."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    return convs.select(
        F.col("conv_id").cast("string").alias("c"), F.col("turn").cast("long").alias("t"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def as_they_are(convs: DataFrame) -> DataFrame:
    """``c, t, role, text, copies`` of a table that needs no damage."""
    return convs.select(F.col("conv_id").cast("string").alias("c"), F.col("turn").cast("long").alias("t"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
                        F.lit(1).alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """Rows without texts: ``c, t, role, h, n, blank, duplicate, truncated`` (equal rows counted in ``n``)."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    same = (rows.select("c", "t", "role", F.md5("text").alias("h"), "copies",
                        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
            .groupBy("c", "t", "role", "h").agg(F.sum("copies").cast("long").alias("n"),
                                                F.first("blank").alias("blank"), F.first("cut").alias("cut")))
    order = F.struct(F.col("t").isNotNull().alias("late"), F.col("t").alias("t"))
    first = (same.where("n > 0").groupBy(*[F.col(k).alias(f"{k}_") for k in ("c", "role", "h")])
             .agg(F.min(order).alias("first"), F.count("*").alias("turns")).where("turns > 1"))
    on = F.expr("c <=> c_ AND role = role_ AND h = h_")
    again = F.coalesce(F.col("first") != order, F.lit(False)) & ~F.col("blank")
    return same.join(first, on, "left").select(
        "c", "t", "role", "h", "n", "blank", again.alias("duplicate"),
        (F.col("cut") & ~F.col("blank") & ~again).alias("truncated"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a run of a conversation's rows in a sorted partition, cut after ``PIECE`` rows."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = ["c", "part", "at", "rows", "first", "last", "illegal", "whole", "cost", "audit", "ways"]
    kinds = [pa.string(), pa.int32(), pa.int64(),
             pa.list_(pa.struct([("t", pa.int64()), ("role", pa.string()), ("h", pa.string()), ("n", pa.int64())])),
             pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.string(),
             pa.list_(pa.struct([("enter", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()),
                                 ("letters", pa.string())]))]
    done: list[tuple] = []

    def finish(c, at, run, whole):
        lattice = tuple((r["role"][:1], r["blank"] or r["duplicate"], r["truncated"], r["n"]) for r in run)
        illegal = (sum(a[0] + b[0] not in LEGAL for a, b in zip(lattice, lattice[1:]))
                   + sum(r[3] - 1 for r in lattice))
        cost, audit = solve(lattice) if whole else (None, None)
        ways = None if whole else [dict(zip(("enter", "leave", "cost", "letters"), w)) for w in ways_through(lattice)]
        rows = [{k: r[k] for k in ("t", "role", "h", "n")} for r in run]
        done.append((c, part, at, rows, lattice[0][0], lattice[-1][0], illegal, whole, cost, audit, ways))

    def out():
        cols = list(zip(*done)) or [()] * len(names)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds)], names=names)

    run, c, at, opened = [], None, 0, True  # the first run of a partition may go on from the one before
    for batch in batches:
        for row in batch.to_pylist():
            if run and (row["c"] != c or len(run) == PIECE):
                cut = row["c"] == c
                finish(c, at, run, not (opened or cut))
                run, at, opened = [], at + 1, cut
            c = row["c"]
            run.append(row)
        if len(done) >= 1024:
            yield out()
    if run:
        finish(c, at, run, False)
    yield out()


PIECES = ("c string, part int, at bigint, rows array<struct<t:bigint,role:string,h:string,n:bigint>>, "
          "first string, last string, illegal bigint, whole boolean, cost bigint, audit string, "
          "ways array<struct<enter:int,leave:int,cost:bigint,letters:string>>")


def _chained(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one conversation, each with its state before and letters; the conversation's cost on the first."""
    pdf = pdf.sort_values(["part", "at"], ignore_index=True)
    cost, taken = chain([[(w["enter"], w["leave"], w["cost"], w["letters"]) for w in ways] for ways in pdf["ways"]])
    seams = [0] + [int(a + b not in LEGAL) for a, b in zip(pdf["last"], pdf["first"][1:])]
    return pd.DataFrame({"c": pdf["c"], "part": pdf["part"], "at": pdf["at"],
                         "cost": [cost] + [0] * (len(pdf) - 1), "state": [s for s, _ in taken],
                         "letters": [w for _, w in taken], "illegal": pdf["illegal"] + seams})


def solved(rows: DataFrame) -> DataFrame:
    """``c, part, at, rows, state, letters, cost, illegal`` of each piece of a conversation, from :func:`faults`."""
    ordered = (rows.where("n > 0").select("c", "t", "role", "h", "n", "blank", "duplicate", "truncated")
               .repartitionByRange("c", "t", "role", "h").sortWithinPartitions("c", "t", "role", "h"))
    pieces = stored(ordered.mapInArrow(_pieces, PIECES), "conversation-pieces")
    inside = pieces.where("whole").select("c", "part", "at", "rows", F.lit(START).alias("state"),
                                          F.col("audit").alias("letters"), "cost", "illegal")
    cut = pieces.where("NOT whole")
    chained = cut.select("c", "part", "at", "first", "last", "illegal", "ways").groupBy("c").applyInPandas(
        _chained, "c string, part int, at bigint, cost bigint, state int, letters string, illegal bigint")
    across = (cut.select(F.col("part").alias("p"), F.col("at").alias("a"), "rows")
              .join(chained, F.expr("p = part AND a = at"))
              .select("c", "part", "at", "rows", "state", "letters", "cost", "illegal"))
    return stored(inside.unionByName(across), "conversation-edits")


def _row_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"c": pa.string(), "t": pa.int64(), "role": pa.string(), "h": pa.string(), "before": pa.string(),
             "letter": pa.string(), "new_role": pa.string(), "after": pa.string()}
    for batch in batches:
        out: dict[str, list] = {k: [] for k in kinds}
        for piece in batch.to_pylist():
            roles = [r["role"][:1] for r in piece["rows"]]
            for r, edit in zip(piece["rows"], replay(roles, [r["n"] for r in piece["rows"]],
                                                     piece["state"], piece["letters"])):
                for k, v in zip(kinds, (piece["c"], r["t"], r["role"], r["h"], *edit)):
                    out[k].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in kinds.items()], names=list(kinds))


def replay(roles: list[str], counts: list[int], state: int, letters: str) -> list[tuple[str, str, str, str]]:
    """(roles inserted before, letter, new role or "", roles inserted after) of each row."""
    at, out = 0, []

    def inserts():
        nonlocal at, state
        put = ""
        while letters[at:at + 1] == "I":
            put, state, at = put + ROLE[state], AFTER[state], at + 1
        return put

    for role, n in zip(roles, counts):
        before, letter = inserts(), letters[at]
        new = ROLE[state] if letter == "R" else ""
        if letter != "D":
            state = STEP[state, new or role]
        at += n
        out.append([before, letter, NAMES.get(new, ""), ""])
    if out:
        out[-1][3] = inserts()
    return [tuple(e) for e in out]


def row_edits(pieces: DataFrame) -> DataFrame:
    """``c, t, role, h, before, letter, new_role, after`` of each distinct row, from :func:`solved`."""
    return pieces.select("c", "rows", "state", "letters").mapInArrow(
        _row_edits, "c string, t bigint, role string, h string, before string, letter string, new_role string, "
                    "after string")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows of the repaired conversations: ``c, t, role, h, place, new_role, text``, to be read in that order.

    ``place`` orders inserted rows before (negative), the row (0) and after it.
    """
    texts = (rows.where("copies > 0").select("c", "t", "role", F.md5("text").alias("h"), "text")
             .dropDuplicates(["c", "t", "role", "h"]))
    both = edits.alias("e").join(texts.alias("x"), F.expr(
        "e.c <=> x.c AND e.t <=> x.t AND e.role = x.role AND e.h = x.h"))

    def put(col: str, sign: int) -> Column:
        chars = F.filter(F.split(F.col(f"e.{col}"), ""), lambda x: x != "")
        shift = F.size(chars) if sign < 0 else F.lit(-1)
        return F.transform(chars, lambda x, k: F.struct(
            (k - shift).cast("int").alias("place"),
            F.when(x == "u", "user").otherwise("assistant").alias("new_role"), F.lit("").alias("text")))

    own = F.array(F.struct(F.lit(0).alias("place"),
                           F.when(F.col("e.letter") == "R", F.col("e.new_role")).otherwise(F.col("e.role")).alias("new_role"),
                           F.col("x.text").alias("text")))
    kept = F.when(F.col("e.letter") != "D", own).otherwise(F.slice(own, 1, 0))
    return both.select("e.c", "e.t", "e.role", "e.h",
                       F.inline(F.concat(put("before", -1), kept, put("after", 1))))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of ``role:text`` joined by newlines, of sorted rows with their edits; a stream."""
    done: list[tuple] = []
    c, digest, edit, opened = None, None, None, False

    def line(role, text=""):
        nonlocal opened
        digest.update((f"\n{role}:" if opened else f"{role}:").encode())
        digest.update(text.encode())
        opened = True

    def close():
        if edit is not None:
            for x in edit["after"]:
                line(NAMES[x])

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in (0, 1)],
                                           names=["c", "repaired_sha256"])
        done.clear()
        return batch

    for batch in batches:
        for row in batch.to_pylist():
            if digest is None or row["c"] != c:
                if digest is not None:
                    close()
                    done.append((c, digest.hexdigest()))
                c, digest, edit, opened = row["c"], hashlib.sha256(), None, False
            if row["text"] is None:  # a row's edit comes before its texts
                close()
                edit = row
                for x in row["before"]:
                    line(NAMES[x])
            elif edit["letter"] in "KR":
                line(edit["new_role"] or row["role"], row["text"])
                edit = {**edit, "letter": "D"}  # of equal rows the first stays
        if len(done) >= 1024:
            yield out()
    if digest is not None:
        close()
        done.append((c, digest.hexdigest()))
    yield out()


def digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``c, repaired_sha256``: texts are shuffled once, sorted behind their edits."""
    texts = rows.where("copies > 0").select("c", "t", "role", F.md5("text").alias("h"), "text")
    return (edits.unionByName(texts, allowMissingColumns=True).repartition("c")
            .sortWithinPartitions("c", "t", "role", "h", F.col("text").isNotNull())
            .mapInArrow(_digests, "c string, repaired_sha256 string"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A summary a conversation (``c, gaps, blank, duplicate, truncated, illegal, cost, audit``) and :func:`row_edits`."""
    flat = stored(faults(rows), "conversation-rows")
    there = F.when(F.col("n") > 0, F.col("t"))
    alone = ~F.col("blank") & ~F.col("duplicate")
    counts = flat.groupBy("c").agg(
        F.coalesce(F.max(there) - F.min(there) + 1 - F.countDistinct(there), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("duplicate"), F.col("n")).when(alone & (F.col("n") > 0), F.col("n") - 1).otherwise(0))
        .alias("duplicate"),
        F.sum((F.col("truncated") & (F.col("n") > 0)).cast("long")).alias("truncated"))
    pieces = solved(flat)
    whole = pieces.groupBy("c").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "at", "letters"))),
                                 lambda p: p["letters"]), "").alias("audit"))
    summary = (counts.alias("n").join(whole.alias("w"), F.expr("n.c <=> w.c"), "left")
               .select("n.*", *[F.coalesce(f"w.{k}", F.lit(0).cast("long")).alias(k) for k in ("illegal", "cost")],
                       F.coalesce("w.audit", F.lit("")).alias("audit")))
    return summary, row_edits(pieces)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after damage: faults, cheapest repair and its digest."""
    convs = table(spark, sf_dir, "conversations")
    rows = damaged(convs)
    summary, edits = repair(rows)
    kind = convs.schema["conv_id"].dataType
    return (summary.alias("s").join(digests(rows, edits).alias("d"), F.expr("s.c <=> d.c"), "left")
            .select(F.col("s.c").cast(kind).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal",
                    "cost", "audit",
                    F.coalesce("d.repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))
