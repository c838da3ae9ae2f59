"""9. Mixing sources to target weights by soft membership.

A classifier learned from the labelled table gives every document posterior
probabilities of the domains (by default ``clean``, ``junk`` and ``toxic``,
from the labels' quality and toxicity).  Non-negative document rates r_i are
then fitted so that the expected tokens of each domain,
sum_i r_i * tokens_i * p_i(domain), match the targets in (weighted) least
squares: projected gradient from r = 1, then (if ``STEPS`` steps don't meet the
targets) Newton steps in the domains to the optimum.  Rates over one repeat a
document; they have no upper bound.  ``Rates`` holds the achieved totals beside
the targets, and they are logged.

Only DataFrame and SQL functions are used:

* the classifier is a multinomial naive Bayes one over hashed distinct words,
  with counts by ``groupBy`` over at most ``SAMPLE`` labelled documents (those
  of least id hash: the bounded, documented sample).  A bucket counts only
  when its share in a domain clearly differs (``EVIDENCE``), and the sum over
  h such words counts 1 / sqrt(1 + h / ``FULL_WEIGHT``), as words of a text
  come together; so long texts don't add up noise;
* posteriors are rounded to hundredths, and that rounded value *is* the
  membership.  The rate of a document depends on its posteriors only, so the
  gradient needs one sum a distinct posterior (at most some thousand rows,
  pre-aggregated in the tasks), whatever the number of documents;
* a rate is an expression without join or shuffle: the fold of the gradient
  steps over the history of the domains' residuals (a few numbers a step), or
  at the optimum ``max(0, 1 - posteriors . pull / STAY)``.

Cases: null, empty and word-free texts have no tokens and the prior's
posteriors; labels that are null or repeated for an id: null is left out, the
last domain in the list counts; without labels, or for a domain without any
expected token, its target can't be met and the fit is the nearest one;
repeated rows get equal rates; an empty table gives no rows.
"""

from __future__ import annotations

import json
import logging
import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import free_name, stored, table

BUCKETS = 1 << 18
SAMPLE = 12_000
EVIDENCE = 8.0
#: Told words after which a document's evidence grows as their square root only.
FULL_WEIGHT = 8.0
GRID = 100
STEPS = 40
CLOSE = 1e-4
#: Largest projected gradient at which the fit is settled, and the most Newton steps.
SETTLED = 1e-8
NEWTON = 60
#: Pull of every rate towards one, beside the fit to the targets.
STAY = 1e-3

LOG = logging.getLogger(__name__)

TARGETS = {"clean": 0.85, "junk": 0.08, "toxic": 0.07}


def label_domain() -> Column:
    """Domain of a row of ``labels``; null: not told."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk")
            .when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean"))


def words(text: str) -> Column:
    r"""Lower-case words ``[^\x20\x09-\x0D]+`` of a text column; null: none."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


@dataclass
class Classifier:
    """Log prior of each domain, and the log ratios of the buckets that tell."""

    domains: list[str]
    prior: list[float]
    ratios: dict[int, list[float]]

    def measures(self, text: str) -> Column:
        """``tokens`` and ``posteriors`` of a text, its words split once."""
        return F.transform(F.array(words(text)), lambda ws: F.struct(
            F.size(ws).cast("long").alias("tokens"), self.posteriors(ws).alias("posteriors")))[0]

    def posteriors(self, found: Column) -> Column:
        """Probabilities of a document's words, rounded to a grid, in the order of ``domains``."""
        n = len(self.domains)
        rows: list = [None] * BUCKETS
        for b, r in self.ratios.items():
            rows[b] = r
        known = F.from_json(F.lit(json.dumps(rows)), "array<array<double>>")
        start = F.array(*[F.lit(p) for p in self.prior])
        # one evaluation of each step's value: it is put into a one-element array and folded over
        told = F.filter(F.transform(F.array_distinct(found), lambda w: F.get(known, bucket(w))),
                        lambda r: r.isNotNull())
        none = F.array(*[F.lit(0.0)] * n)
        logs = F.transform(F.array(told), lambda rs: F.zip_with(
            start, F.aggregate(rs, none, lambda acc, r: F.zip_with(acc, r, lambda a, b: a + b)),
            lambda p, v: p + v / F.sqrt(F.lit(1.0) + F.size(rs) / F.lit(FULL_WEIGHT))))[0]
        shares = F.aggregate(
            F.array(logs), start,
            lambda _, z: F.transform(z, lambda x: F.exp(F.greatest(x - F.array_max(z), F.lit(-50.0)))))
        rest = F.aggregate(
            F.array(shares), start,
            lambda _, e: F.transform(e, lambda x: F.round(x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b) * GRID) / GRID))
        # the rounded shares but the largest, which takes what is left
        return F.aggregate(
            F.array(rest), start,
            lambda _, p: F.transform(p, lambda x, i: F.when(
                i == F.array_position(p, F.array_max(p)) - 1,
                F.round(F.lit(1.0) - (F.aggregate(p, F.lit(0.0), lambda a, b: a + b) - x), 2)).otherwise(x))) \
            if n > 1 else F.array(F.lit(1.0))


def train(docs: DataFrame, labels: DataFrame, domains: list[str], domain: Column | None = None,
          sample: int = SAMPLE) -> Classifier:
    """Naive Bayes log ratios from labelled documents."""
    order = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain"))
    known = (labels.select("doc_id", (label_domain() if domain is None else domain).alias("domain"))
             .where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
             .groupBy("doc_id").agg(F.max_by("domain", order).alias("domain")))
    drawn = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # at most ``sample`` rows
    seen = found.select("domain", F.explode(F.array_distinct(F.transform(
        F.array_distinct(words("text")), bucket))).alias("bucket"))
    counts = stored(seen.groupBy("bucket").agg(*[
        F.count(F.when(F.col("domain") == d, 1)).alias(f"d{i}") for i, d in enumerate(domains)]), "mixing-counts")
    total = counts.agg(*[F.sum(f"d{i}").alias(f"d{i}") for i in range(len(domains))]).first()
    total = [t or 0 for t in total]
    n, told = sum(F.col(f"d{i}") for i in range(len(domains))), F.lit(False)
    for i, t in enumerate(total):
        share = t / max(1, sum(total))
        told = told | (F.abs(F.col(f"d{i}") - n * share) > EVIDENCE * F.sqrt(n * share * (1 - share) + 1))
    ratios = {}
    for r in counts.where(told).collect():  # at most BUCKETS rows
        seen_here = [r[f"d{i}"] for i in range(len(domains))]
        ratios[r["bucket"]] = [math.log((c + 2) / (sum(seen_here) * t / sum(total) + 2))
                               for c, t in zip(seen_here, total)]
    docs_of = {r["domain"]: r["n"] for r in found.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(docs_of.values())
    prior = [math.log((docs_of.get(d, 0) + 1) / (n + len(domains))) for d in domains]
    return Classifier(list(domains), prior, ratios)


@dataclass
class Rates:
    """Residuals of the domains at each step; a rate is the fold of the steps.

    With ``pull``, the residuals at the optimum, it is their expression instead.
    """

    most: float
    stay: float
    history: list[list[float]] = field(default_factory=list)
    pull: list[float] | None = None
    #: Shares of the tokens before mixing, by domain: wanted, and achieved by these rates.
    wanted: dict[str, float] = field(default_factory=dict)
    achieved: dict[str, float] = field(default_factory=dict)
    settled: bool = True

    @property
    def residual(self) -> float:
        """Largest difference of an achieved total to its target."""
        return max((abs(self.achieved[d] - w) for d, w in self.wanted.items()), default=0.0)

    def rate(self, posteriors: Column) -> Column:
        if self.pull is not None:
            return F.greatest(F.lit(0.0), F.least(F.lit(self.most), F.lit(1.0) - sum(
                posteriors[d] * F.lit(g / self.stay) for d, g in enumerate(self.pull))))
        if not self.history:
            return F.lit(1.0)
        steps = F.from_json(F.lit(json.dumps(self.history)), "array<array<double>>")
        size = F.lit(1.0 / (1.0 + self.stay))
        return F.aggregate(steps, F.lit(1.0), lambda r, e: F.greatest(F.lit(0.0), F.least(
            F.lit(self.most), r - size * (F.aggregate(F.zip_with(posteriors, e, lambda p, g: p * g), F.lit(0.0),
                                                      lambda a, b: a + b) + F.lit(self.stay) * (r - 1.0)))))


def fit(cells: DataFrame, domains: list[str], targets: dict[str, float], most: float = math.inf,
        stay: float = STAY, steps: int = STEPS) -> Rates:
    """Projected gradient over rows ``posteriors, tokens`` (one a distinct posterior).

    Each domain's squared residual is weighted by one over its tokens before
    mixing; in that scale the step one never overshoots.
    """
    rates = Rates(most, stay)
    n = len(domains)
    before = cells.agg(F.sum("tokens").alias("all"), *[
        F.sum(F.col("tokens") * F.col("posteriors")[d]).alias(f"d{d}") for d in range(n)]).first()
    if not before["all"]:
        return rates
    whole = float(before["all"])
    share = [float(before[f"d{d}"]) / whole for d in range(n)]
    want = [targets[d] / sum(targets.values()) for d in domains]
    for _ in range(steps):
        mixed = cells.withColumn("rate", rates.rate(F.col("posteriors"))).agg(*[
            F.sum(F.col("tokens") * F.col("posteriors")[d] * F.col("rate")).alias(f"d{d}") for d in range(n)]).first()
        off = [float(mixed[f"d{d}"]) / whole - want[d] for d in range(n)]
        if max(map(abs, off)) < CLOSE:
            break
        rates.history.append([o / s if s > 0 else 0.0 for o, s in zip(off, share)])
    return rates


def settle(cells: DataFrame, domains: list[str], targets: dict[str, float], rates: Rates) -> Rates:
    """The optimum of the same least squares, unless ``rates`` meet the targets already.

    Its rates are ``clip(1 - p . g / stay)`` with a number g a domain, which
    maximise a concave function of g (the dual): damped Newton, one sum over
    the cells a try.  ``g`` is the achieved less the wanted total over the
    domain's tokens before mixing; a domain without tokens has none.
    """
    n = len(domains)
    post = F.col("posteriors")
    want = np.array([targets[d] / sum(targets.values()) for d in domains])
    before = cells.agg(F.sum("tokens").alias("all"), *[F.sum(F.col("tokens") * post[d]).alias(f"d{d}")
                                                       for d in range(n)]).first()
    whole = float(before["all"] or 0)
    if not whole:
        return rates
    share = np.array([float(before[f"d{d}"]) for d in range(n)]) / whole
    has = np.flatnonzero(share > 0)

    def tried(now: Rates) -> tuple[float, np.ndarray, np.ndarray]:
        """Sum of stay / 2 (r - 1)**2, achieved totals, products of posteriors of rates inside the bounds."""
        rated_ = cells.withColumn("rate", now.rate(post))
        inside = F.when((F.col("rate") > 0) & (F.col("rate") < now.most), F.col("tokens")).otherwise(0)
        row = rated_.agg(
            F.sum(F.col("tokens") * (F.col("rate") - 1) * (F.col("rate") - 1)),
            *[F.sum(F.col("tokens") * post[d] * F.col("rate")) for d in range(n)],
            *[F.sum(inside * post[a] * post[b]) for a in range(n) for b in range(n)]).first()
        row = np.array(row, float) / whole
        return row[0] * now.stay / 2, row[1:n + 1], row[n + 1:].reshape(n, n)

    _, got, _ = tried(rates)
    if np.abs(got - want).max() >= CLOSE:
        def at(g: np.ndarray):
            now = Rates(rates.most, rates.stay, pull=g.tolist())
            moved, got, curve = tried(now)
            return moved + g @ (got - want) - (share * g * g).sum() / 2, now, got, curve

        g = np.zeros(n)
        g[has] = (got - want)[has] / share[has]
        value, rates, got, curve = min((at(g), at(np.zeros(n))), key=lambda t: -t[0])
        for _ in range(NEWTON):
            g = np.array(rates.pull)
            slope = (got - want - share * g)[has]
            rates.settled = bool(np.abs(slope).max() < SETTLED)
            if rates.settled:
                break
            step = np.zeros(n)
            step[has] = np.linalg.solve(np.diag(share[has]) + curve[np.ix_(has, has)] / rates.stay, slope)
            size = 1.0
            while True:
                tip = at(g + size * step)
                if tip[0] >= value + 1e-4 * size * (slope @ step[has]) or size < 1e-6:
                    break
                size /= 2
            if tip[0] < value:
                break  # no better within the precision of the sums
            value, rates, got, curve = tip
        else:
            rates.settled = bool(np.abs((got - want - share * np.array(rates.pull))[has]).max() < SETTLED)
    rates.wanted, rates.achieved = dict(zip(domains, want.tolist())), dict(zip(domains, got.tolist()))
    LOG.log(logging.INFO if rates.settled else logging.WARNING, "mixing: %s; largest residual %.2g%s",
            ", ".join(f"{d} {rates.achieved[d]:.4f} (target {w:.4f})" for d, w in rates.wanted.items()),
            rates.residual, "" if rates.settled else ", not settled")
    return rates


def rated(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
          keep: list[str] | None = None, **options) -> tuple[DataFrame, list[str]]:
    """Columns ``keep`` (all) of ``docs`` with ``tokens, posteriors, rate, copies``.

    The added columns take names that no column of ``docs`` has.  Rows are
    measured once and stored.  ``copies`` is the rate rounded down or up: up
    with the probability of its fraction, by a hash of the id and text, the
    same on every run.
    """
    targets = targets or TARGETS
    model = train(docs, labels, list(targets))
    names = [free_name(docs, n) for n in ("tokens", "posteriors", "rate", "copies")]
    tokens, post, rate, copies = names
    draw, measured = free_name(docs, "draw"), free_name(docs, "measured")
    kept = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    chance = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("copy"), F.col("text")),
                    F.lit(1 << 20)) / (1 << 20)
    wide = stored(docs.select(*kept, chance.alias(draw), model.measures("text").alias(measured)), "mixing-docs").select(
        *kept, draw, F.col(f"{measured}.tokens").alias(tokens), F.col(f"{measured}.posteriors").alias(post))
    cells = stored(wide.groupBy(F.col(post).alias("posteriors")).agg(F.sum(tokens).alias("tokens")), "mixing-cells")
    rates = settle(cells, model.domains, targets, fit(cells, model.domains, targets, **options))
    out = wide.withColumn(rate, rates.rate(F.col(post)))
    up = (F.col(draw) < F.col(rate) - F.floor(rate)).cast("int")
    return out.withColumn(copies, (F.floor(rate) + up).cast("int")).drop(draw), names


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, **options) -> DataFrame:
    """``docs`` with every row repeated (or dropped) to its number of copies."""
    out, (_, _, _, copies) = rated(docs, labels, targets, **options)
    again = F.explode(F.array_repeat(F.lit(1), F.col(copies)))
    return out.where(F.col(copies) > 0).select(*[F.col(f"`{c}`") for c in docs.columns], again.alias(
        free_name(out, "again"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with tokens, domain posteriors, fitted rate and copies."""
    out, _ = rated(table(spark, sf_dir, "documents").select("doc_id", "text"),
                   table(spark, sf_dir, "labels"), keep=["doc_id"])
    return out.select("doc_id", "tokens", *[F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(TARGETS)],
                      "rate", "copies")
