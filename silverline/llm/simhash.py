"""3. SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints: 64 bits, a bit is 1 if set in over half of the XXH64 hashes
(seed 42) of the text's word shingles.  Two fingerprints link when they
differ in at most ``distance`` bits.

Search over distinct fingerprints (copies are folded first, so a group of
equal texts is one row):

1. Bit means and pairwise counts over *all* fingerprints give the correlation
   of bits; each layout of m parts puts correlated bits into one part.
2. For each part, colliding pairs are counted over all fingerprints and
   carried to larger radii with the part's difference rates.  Dynamic
   programming allots thresholds T_1 .. T_m (-1: part unused) with
   sum T_i = distance - m + 1, which guarantees that a linked pair differs in
   at most T_i bits of some part i; the layout of least estimated cost wins.
3. Each fingerprint is indexed under its part values and probes the values
   within T_i.  Within a bucket, a breadth-first search over verified links
   emits a spanning forest, not all pairs: every link's two ends stay
   connected.  Buckets over ``BLOCK`` members are dealt as pairs of blocks.
4. Connected components by repeated hooking to the least neighbour and
   pointer jumping; each round is stored.

Cases: null, empty and word-free texts have fingerprint zero and are linked
like any other; fewer words than a shingle: the whole sequence; repeated rows
share a class; a null ``doc_id`` never names a class unless it is alone in
it (then the class id is null); an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import map_texts, stored, table

SEED = 42
#: Members of a bucket that one task searches; larger ones go as block pairs.
BLOCK = 32768
#: Cost of shuffling one index or probe row, in verified candidates.
ROW_COST = 400.0
PARTS = (2, 3, 4, 5)


# ---- fingerprints -----------------------------------------------------------

def fingerprint(text: str | None, size: int = 4) -> int:
    """Unsigned 64-bit SimHash of a text."""
    words = text.encode().lower().split() if text else []  # bytes.lower: A-Z only
    if not words:
        return 0
    flat = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - size + 1)
    starts = (ends - lengths)[:n].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(flat[s:e], SEED) for s, e in zip(starts, ends[len(words) - n:].tolist())],
                    np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded scratch memory for very long texts
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long)."""
    return map_texts(docs, _factory(size), [("fp", "bigint")], ["doc_id"])


def _factory(size: int):
    def factory():
        def run(texts):
            return {"fp": np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)}
        return run
    return factory


# ---- layout and thresholds --------------------------------------------------

def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        n = 0
        for b in batches:
            bits = _bits(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)).astype(np.float32)
            for at in range(0, len(bits), 1 << 16):
                total += bits[at:at + (1 << 16)].T @ bits[at:at + (1 << 16)]
            n += len(bits)
        i, j = np.indices((64, 64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i.ravel(), -1), pa.int32()), pa.array(np.append(j.ravel(), -1), pa.int32()),
             pa.array(np.append(total.ravel(), n).astype(np.int64))], names=["i", "j", "n"])

    rows = fps.select("fp").mapInArrow(run, "i int, j int, n bigint").groupBy("i", "j").agg(
        F.sum("n").alias("n")).collect()  # 4097 numbers, whatever the input
    out, n = np.zeros((64, 64)), 0
    for r in rows:
        if r["i"] < 0:
            n = r["n"]
        else:
            out[r["i"], r["j"]] = r["n"]
    return n, out


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """64 bits in ``m`` parts of nearly equal width, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, parts = set(range(64)), []
    for k in range(m):
        width = len(left) // (m - k)
        order = sorted(left)
        part = [max(order, key=lambda b: (corr[b, order].sum(), -b))]
        left.discard(part[0])
        while len(part) < width:
            best = max(sorted(left), key=lambda b: (corr[b, part].mean(), -b))
            part.append(best)
            left.discard(best)
        parts.append(sorted(part))
    return parts


def within(rates: np.ndarray, most: int) -> np.ndarray:
    """P(at most t of independent bits differ), t = 0 .. most."""
    dist = np.zeros(most + 1)
    dist[0] = 1
    for q in rates:
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return np.maximum(np.cumsum(dist), 1e-300)


def allot(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of least cost that add up to ``total``; costs[i][t + 1] is that of t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for k, more in enumerate(row):
                cand = (c + more, [*ts, k - 1])
                if s + k - 1 not in new or cand[0] < new[s + k - 1][0]:
                    new[s + k - 1] = cand
        best = new
    return best[total]


def part_keys(fps: np.ndarray, part: list[int]) -> np.ndarray:
    """The bits of a part, gathered into a small integer."""
    out = np.zeros(len(fps), np.int64)
    for k, b in enumerate(part):
        out |= ((fps >> np.int64(b)) & np.int64(1)) << np.int64(k)
    return out


def choose_layout(fps: DataFrame, distance: int) -> tuple[list[list[int]], list[int]]:
    """Parts and thresholds of least estimated cost, from counts over all rows."""
    n, both = bit_counts(fps)
    layouts = {m: group_bits(n, both, m) for m in PARTS if m <= distance + 1}
    parts = [(m, i, part) for m, ps in layouts.items() for i, part in enumerate(ps)]

    def run(batches):
        for b in batches:
            v = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k, (_, _, part) in enumerate(parts):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), k, np.int32)),
                                                  pa.array(part_keys(v, part))], names=["part", "value"])

    pairs = {r["part"]: float(r["pairs"]) for r in (
        fps.select("fp").mapInArrow(run, "part int, value bigint").groupBy("part", "value").count()
        .groupBy("part").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs"))
        .collect())}
    p = np.diag(both) / max(n, 1)
    best = None
    for m, ps in layouts.items():
        costs = []
        for i, part in enumerate(ps):
            share = within(2 * p[part] * (1 - p[part]), distance)
            seen = pairs.get(parts.index((m, i, part)), 0.0)
            row, probes = [0.0], 0
            for t in range(distance - m + 2):
                probes += len(list(itertools.combinations(range(len(part)), t))) if t else 1
                candidates = min(n * n / 2, max(seen, share[0] * n * n / 2) * share[t] / share[0])
                row.append((1 + (probes - 1) / 2) * n * ROW_COST + candidates)
            costs.append(row)
        cost, thresholds = allot(costs, distance - m + 1)
        if best is None or cost < best[0]:
            best = (cost, ps, thresholds)
    return best[1], best[2]


# ---- candidates and links ---------------------------------------------------

def _forest(index: np.ndarray, probes: np.ndarray, distance: int) -> np.ndarray:
    """Links that connect what links between index members, and to probes, connect."""
    signed = index.dtype
    index, probes = index.view(np.uint64), probes.view(np.uint64)  # bitwise_count drops signs
    out = _search(index, probes, distance)
    return np.array(out, np.uint64).reshape(-1, 2).view(signed)


def _search(index: np.ndarray, probes: np.ndarray, distance: int) -> list[tuple[int, int]]:
    if len(index) * (len(index) + len(probes)) <= 4096:
        every = np.concatenate([index, probes])
        i, j = np.nonzero(np.bitwise_count(index[:, None] ^ every[None, :]) <= distance)
        keep = i < j
        return list(zip(index[i[keep]].tolist(), every[j[keep]].tolist()))
    out: list[tuple[int, int]] = []
    rest, far = index, probes
    while len(rest):
        queue, rest = [(rest[0], True)], rest[1:]
        while queue:
            node, indexed = queue.pop()
            if len(rest):
                hit = np.bitwise_count(rest ^ node) <= distance
                if hit.any():
                    found, rest = rest[hit], rest[~hit]
                    out += [(int(node), int(x)) for x in found]
                    queue += [(x, True) for x in found]
            if indexed and len(far):
                hit = np.bitwise_count(far ^ node) <= distance
                if hit.any():
                    found, far = far[hit], far[~hit]
                    out += [(int(node), int(x)) for x in found]
                    if len(rest):
                        queue += [(x, False) for x in found]
            if not len(rest) and not len(far):
                break
    return out


def links(fps: DataFrame, parts: list[list[int]], thresholds: list[int], distance: int) -> DataFrame:
    """``a, b``: pairs of linked fingerprints with the same components as all links."""
    used = [(k, part, t) for k, (part, t) in enumerate(zip(parts, thresholds)) if t >= 0]

    def expand(batches):
        for b in batches:
            v = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k, part, t in used:
                keys = part_keys(v, part)
                for r in range(t + 1):
                    for flip in itertools.combinations(range(len(part)), r):
                        # of two values that differ, the one whose first differing bit is 0 probes
                        sel = (keys >> np.int64(flip[0])) & 1 == 0 if flip else slice(None)
                        mask = np.int64(sum(1 << f for f in flip))
                        own, key = v[sel], keys[sel] ^ mask
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(own), k, np.int32)), pa.array(key), pa.array(own),
                             pa.array(np.full(len(own), r > 0))], names=["part", "key", "fp", "probe"])

    rows = fps.select("fp").mapInArrow(expand, "part int, key bigint, fp bigint, probe boolean")
    if any(t > 0 for _, _, t in used):
        rows = stored(rows, "simhash-rows")
    sizes = rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    large = stored(sizes, "simhash-large")  # as many rows as the search has rows / BLOCK, at most
    if not large.isEmpty():
        rows = rows.join(large, ["part", "key"], "left")
        blocks = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / F.lit(BLOCK)).cast("int")
        own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        cell = F.transform(F.sequence(F.lit(0), blocks - 1),
                           lambda x: F.struct(F.least(x, own).alias("x"), F.greatest(x, own).alias("y")))
        rows = rows.select("part", "key", "fp", "probe", F.explode(cell).alias("cell"))
    else:
        rows = rows.withColumn("cell", F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))
    rows = rows.select(F.xxhash64("part", "key", "cell.x", "cell.y").alias("bucket"), "part", "key",
                       F.col("cell.x").alias("x"), F.col("cell.y").alias("y"), "fp", "probe")
    order = ["bucket", "part", "key", "x", "y", "probe", "fp"]
    dealt = rows.repartition("bucket").sortWithinPartitions(*order)

    def search(batches):
        held, name = [], None

        def flush():
            fp = np.concatenate([h[0] for h in held])
            probe = np.concatenate([h[1] for h in held])
            if len(fp) < 2 or probe.all():
                return None
            found = _forest(fp[~probe], np.unique(fp[probe]), distance)
            if len(found):
                a, c = found.T
                return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, c)), pa.array(np.maximum(a, c))],
                                                  names=["a", "b"])

        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            names = np.stack([c.astype(np.int64) for c in cols[1:5]])
            cuts = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
            starts = np.concatenate([[0], cuts])
            stops = np.concatenate([cuts, [b.num_rows]])
            for s, e in zip(starts.tolist(), stops.tolist()):
                if e == s:
                    continue
                this = tuple(names[:, s])
                if name is not None and this != name:
                    if (done := flush()) is not None:
                        yield done
                    held = []
                name = this
                held.append((cols[5][s:e].astype(np.int64), cols[6][s:e].astype(bool)))
        if held and (done := flush()) is not None:
            yield done

    return dealt.mapInArrow(search, "a bigint, b bigint").distinct()


# ---- components -------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of an edge; ``root`` names its component.

    Each round hooks every node to its least neighbour, shortens the chains
    by pointer jumping and contracts the graph.  At least half of the nodes
    of a component vanish in a round.
    """
    edges = stored(edges.select("a", "b").where("a <> b"), "simhash-edges")
    names = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("root"))
        up = stored(up, "simhash-up")
        for _ in range(3):  # chains of up to eight hooks become one
            over = up.select(F.col("node").alias("root"), F.col("root").alias("next")).where("root <> next")
            up = up.join(over, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        up = stored(up, "simhash-jumped")
        if names is None:
            names = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            names = stored(names.join(step, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")), "simhash-names")
        a = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stored(edges.join(a, "a").join(b, "b").where("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "simhash-edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if names is None else names


def near_duplicates(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fp, component_id`` of each row of ``docs``."""
    rows = stored(fingerprints(docs, size), "simhash-fp")
    return classes(rows, distance)


def classes(rows: DataFrame, distance: int) -> DataFrame:
    """``doc_id, fp, component_id`` for rows ``doc_id, fp``."""
    unique = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-unique")
    parts, thresholds = choose_layout(unique, distance)
    named = components(links(unique, parts, thresholds, distance))
    whole = unique.join(named.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    whole = stored(whole, "simhash-classes")
    least = whole.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = whole.join(least, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near copies, all columns.

    The one of least id stays; a row number tells repeated ids apart (stored
    with the rows, so that it is the same for every later read).  Groups are
    settled on narrow rows; the texts then meet the numbers that stay, one
    match a row at most.
    """
    cols = docs.columns
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)]
    wide = docs.select(*kept, F.col("text").alias("text"), F.col("doc_id").alias("id"),
                       F.monotonically_increasing_id().alias("row"))
    rows = stored(map_texts(wide, _factory(size), [("fp", "bigint")],
                            [*[f"c{i}" for i in range(len(cols))], "id", "row"]), "simhash-docs")
    named = classes(rows.select(F.struct("id", "row").alias("doc_id"), "fp"), distance)
    first = named.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id.row")
    return rows.join(first, "row", "left_semi").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, links at four or fewer differing bits."""
    out = near_duplicates(table(spark, sf_dir, "documents"), size=4, distance=4)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", hexed.alias("fingerprint"), "component_id")
