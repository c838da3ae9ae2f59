r"""5. Personal data: patterns and a skip-chain conditional random field.

Base spans are the matches of one pattern a kind (e-mail, IP address, card,
phone), leftmost and non-overlapping, those that fail the kind's check
dropped.  They miss what a failed match has swallowed (a card number after a
phone number, say); the random field adds such spans.

The field's nodes are the words that hold a digit or ``@`` (every kind needs
one).  Potentials: a multinomial logistic one of a word's shape and its
neighbours' (nodes), one for words next to each other (chain), and one that
ties all words of a document with the same digits or address (skip).  The tie
goes through one hidden label for each set of equal words, so a word that
occurs n times adds n edges, not n squared.  Loopy sum-product message
passing over a document's graph gives each word's label probabilities; runs
of words over ``SURE`` that touch no base span are added.

Training is by counts over *all* documents: base spans label the words (words
of failed matches over several words are left out); shapes, neighbouring and
tied label pairs are counted in tasks and summed, and the driver fits on all
rows of counts.  Their number has a bound, whatever the corpus: most shape bits
rule each other out (under 300 shapes; 7 states of a word on either side; 5
labels), so there are fewer than ``MOST_ROWS``.  No text leaves the tasks.

Cases: null is an empty text: no spans; very long texts are read whole;
repeated rows get equal spans; with no words to learn from, only base spans
remain; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.common import CHUNK_ROWS, map_texts, table

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["other", *KINDS]
SURE = 0.9
ROUNDS = 12
#: Never reached; no rows are left out.
MOST_ROWS = 300 * 7 * 7 * 5 + 2 * 5 * 5
AGREE = 5.0

# The look-behinds only skip starts inside a run whose first character has failed already.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_NEXT = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL.pattern)
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NODE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_HAS = re.compile(r"[0-9@]")
_EDGE = " \t\n\x0b\x0c\r"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def small_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str):
    at = 0
    while True:
        m = (_EMAIL.match(text, at) if at else None) or _EMAIL_NEXT.search(text, at)
        if not m:
            return
        yield m
        at = m.end()


def _ips(text: str):
    """Leftmost matches; after a match ends inside dotted digits the next may start there."""
    at = 0
    while m := _IP.search(text, at):
        yield m
        at = m.end()


def base_spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(kind index, start, end) in the order of kinds and starts; spans of failed matches."""
    out: list[tuple[int, int, int]] = []
    failed: list[tuple[int, int]] = []
    if not text or not _HAS.search(text):
        return out, failed
    if "@" in text:
        out += [(0, m.start(), m.end()) for m in _emails(text)]
    for m in _ips(text):
        if all(small_number(p) for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
        else:
            failed.append(m.span())
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start():
            d = digits_of(m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
            else:
                failed.append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(digits_of(m.group())) <= 15:
                out.append((3, m.start(), m.end()))
            else:
                failed.append(m.span())
    return out, failed


# ---- the random field -------------------------------------------------------

_CORE = re.compile(r"^[^\w+(]*(.*?)[^\w)]*$", re.S)
_MAIL_SHAPE = re.compile(r"[^@\s]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_GROUPS = re.compile(r"[0-9]+(?:-[0-9]+)+")


def shape(word: str) -> int:
    """Shape features of a word as bits."""
    core = _CORE.match(word).group(1)
    d = digits_of(core)
    dotted = bool(_DOTTED.fullmatch(core))
    letters = any(c.isalpha() for c in core)
    tests = [
        "@" in core, bool(_MAIL_SHAPE.fullmatch(core)),
        dotted and all(small_number(p) for p in core.split(".")), dotted,
        core.startswith("+"), core.startswith("(") and core.endswith(")"), bool(_GROUPS.fullmatch(core)),
        letters, core.isdigit(), "=" in core or '"' in core,
        1 <= len(d) <= 2, 3 <= len(d) <= 4, 5 <= len(d) <= 8, 9 <= len(d) <= 12, 13 <= len(d) <= 19, len(d) > 19,
        13 <= len(d) <= 19 and not letters and luhn(d),
    ]
    return sum(1 << i for i, t in enumerate(tests) if t)


N_SHAPE = 17
#: A node also sees these bits of the words right before and after it.
AROUND = (2, 4, 5, 6, 8)
N_FEATURES = N_SHAPE + 2 * len(AROUND) + 2


def tie_of(word: str) -> str | None:
    """What makes two words the same: their address (mail or dotted quad), or their digits if there are seven or more."""
    core = _CORE.match(word).group(1)
    if "@" in core:
        return core.lower()
    if _DOTTED.fullmatch(core.strip("()")):
        return ".".join(part.lstrip("0") or "0" for part in core.strip("()").split("."))
    d = digits_of(core)
    return d if len(d) >= 7 else None


@dataclass
class Nodes:
    """The graph of one document."""

    spans: list[tuple[int, int]]
    bits: list[int]
    ties: list[str | None]
    joined: list[bool]  # next to the node before it, one separator between


def nodes_of(text: str) -> Nodes:
    spans = [m.span() for m in _NODE.finditer(text)]
    words = [text[s:e] for s, e in spans]
    joined = [i > 0 and s - spans[i - 1][1] == 1 and text[s - 1] == " " for i, (s, _) in enumerate(spans)]
    shapes = [shape(w) for w in words]
    bits = []
    for i, b in enumerate(shapes):
        before = shapes[i - 1] if joined[i] else None
        after = shapes[i + 1] if i + 1 < len(spans) and joined[i + 1] else None
        at = N_SHAPE
        for other in (before, after):
            if other is not None:
                b |= 1 << at
                for k, f in enumerate(AROUND):
                    b |= (other >> f & 1) << (at + 1 + k)
            at += 1 + len(AROUND)
        bits.append(b)
    return Nodes(spans, bits, [tie_of(w) for w in words], joined)


def labels_of(nodes: Nodes, base: list[tuple[int, int, int]], failed: list[tuple[int, int]]) -> list[int]:
    """Label of each node by the base spans over it; -1: not told."""
    out = [0] * len(nodes.spans)
    ends = [b for _, b in nodes.spans]

    def over(s: int, e: int) -> range:
        first = bisect.bisect_right(ends, s)
        last = first
        while last < len(ends) and nodes.spans[last][0] < e:
            last += 1
        return range(first, last)

    for s, e in failed:
        if len(hit := over(s, e)) > 1:
            for i in hit:
                out[i] = -1
    for kind, s, e in reversed(base):
        for i in over(s, e):
            out[i] = kind + 1
    return out


def training_counts(docs: DataFrame) -> list:
    """Counts over all documents: ('n', bits, label), ('c', a, b), ('t', a, b)."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK_ROWS):
                counts: Counter = Counter()
                for text in whole.column(0).slice(at, CHUNK_ROWS).to_pylist():
                    if not text or not _HAS.search(text):
                        continue
                    nodes = nodes_of(text)
                    y = labels_of(nodes, *base_spans(text))
                    tied: dict[str, list[int]] = {}
                    for i, label in enumerate(y):
                        if label < 0:
                            continue
                        counts["n", nodes.bits[i], label] += 1
                        if nodes.joined[i] and y[i - 1] >= 0:
                            counts["c", y[i - 1], label] += 1
                        if nodes.ties[i]:
                            last = tied.setdefault(nodes.ties[i], [])
                            if last:
                                counts["t", last[-1], label] += 1
                            last[:] = [label]
                if counts:
                    keys = list(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int64()),
                         pa.array([k[2] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
                        names=["what", "a", "b", "n"])

    rows = docs.select("text").mapInArrow(run, "what string, a bigint, b int, n bigint")
    total = rows.groupBy("what", "a", "b").agg(F.sum("n").alias("n"))
    return sorted(total.collect(), key=lambda r: (r["what"], r["a"], r["b"]))  # fewer than MOST_ROWS


@dataclass
class Field:
    weights: np.ndarray  # features x labels
    bias: np.ndarray
    chain: np.ndarray    # log potentials, labels x labels
    skip: np.ndarray


def _ties(rows: list, what: str, most: float) -> np.ndarray:
    """Log ratio of seen to independent label pairs, smoothed and clipped.

    Before any is seen, tied words are taken to agree (``AGREE`` pairs a label).
    """
    n = np.full((len(LABELS), len(LABELS)), 0.5)
    if what == "t":
        n += AGREE * np.eye(len(LABELS))
    for r in rows:
        if r["what"] == what:
            n[r["a"], r["b"]] += r["n"]
    if what == "t":
        n = n + n.T
    p = n / n.sum()
    return np.clip(np.log(p / np.outer(p.sum(1), p.sum(0))), -most, most)


def fit(rows: list, steps: int = 400, l2: float = 1e-4) -> Field | None:
    """Multinomial logistic node potentials and pair potentials from counts."""
    seen = [r for r in rows if r["what"] == "n"]
    if not seen:
        return None
    x = np.array([[r["a"] >> f & 1 for f in range(N_FEATURES)] for r in seen], float)
    y = np.eye(len(LABELS))[[r["b"] for r in seen]]
    n = np.sqrt(np.array([r["n"] for r in seen], float))  # frequent shapes count less than in proportion
    n /= n.sum()
    w, b = np.zeros((N_FEATURES, len(LABELS))), np.zeros(len(LABELS))
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - y) * n[:, None]
        vw = 0.9 * vw - 0.5 * (x.T @ g + l2 * w)
        vb = 0.9 * vb - 0.5 * g.sum(axis=0)
        w, b = w + vw, b + vb
    return Field(w, b, _ties(rows, "c", 1.5), _ties(rows, "t", 3.0))


def _norm(logs: np.ndarray) -> np.ndarray:
    logs = logs - logs.max(axis=-1, keepdims=True)
    return logs - np.log(np.exp(logs).sum(axis=-1, keepdims=True))


def _through(logs: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Messages across an edge: log-sum over the sender's labels."""
    s = logs[:, :, None] + potential[None]
    top = s.max(axis=1, keepdims=True)
    return _norm(np.log(np.exp(s - top).sum(axis=1)) + top[:, 0])


def beliefs(field: Field, graphs: list[Nodes], rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of all nodes by loopy sum-product messages.

    The graphs are worked on side by side; no edge joins two of them.
    """
    bits = np.array([b for g in graphs for b in g.bits], np.int64)
    n, k = len(bits), len(LABELS)
    node = _norm(((bits[:, None] >> np.arange(N_FEATURES)) & 1) @ field.weights + field.bias)
    after = np.flatnonzero(np.array([j for g in graphs for j in g.joined], bool))  # edges (i - 1, i)
    names: dict[tuple[int, str], int] = {}
    tied, hub = [], []
    at = 0
    for d, g in enumerate(graphs):
        for t in g.ties:
            if t:
                tied.append(at)
                hub.append(names.setdefault((d, t), len(names)))
            at += 1
    tied, hub = np.array(tied, np.int64), np.array(hub, np.int64)
    many = np.bincount(hub, minlength=len(names))[hub] > 1 if len(hub) else np.empty(0, bool)
    tied, hub = tied[many], hub[many]
    right, left = np.zeros((len(after), k)), np.zeros((len(after), k))
    down, up = np.zeros((len(tied), k)), np.zeros((len(tied), k))
    total = node.copy()
    for _ in range(rounds):
        right_new = _through(total[after - 1] - left, field.chain)
        left_new = _through(total[after] - right, field.chain.T)
        up_new = _through(total[tied] - down, field.skip)
        hubs = np.zeros((len(names), k))
        np.add.at(hubs, hub, up_new)
        down_new = _through(hubs[hub] - up_new, field.skip.T)
        change = max([0.0, *(np.abs(a - b).max() for a, b in (
            (right, right_new), (left, left_new), (down, down_new)) if a.size)])
        right, left, down, up = ((a + b) / 2 for a, b in (  # damped
            (right, right_new), (left, left_new), (down, down_new), (up, up_new)))
        total = node.copy()
        np.add.at(total, after, right)
        np.add.at(total, after - 1, left)
        np.add.at(total, tied, down)
        if change < 1e-4:
            break
    return np.exp(_norm(total)) if n else np.empty((0, k))


def added(nodes: Nodes, probs: np.ndarray, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of sure words that touch no base span; neighbouring phone words are one span."""
    label = np.where(probs.max(axis=1) >= SURE, probs.argmax(axis=1), 0) if len(probs) else []
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken], np.int64)
    ends = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    out: list[list[int]] = []
    last = -2
    for i, (a, b) in enumerate(nodes.spans):
        if not label[i]:
            continue
        core = _CORE.match(text[a:b])
        s, e = a + core.start(1), a + core.end(1)
        before = int(np.searchsorted(starts, e, side="left"))
        if s >= e or before and ends[before - 1] > s:
            continue
        if out and last == i - 1 and nodes.joined[i] and label[i] == label[i - 1] == 4 and not text[a:b].startswith("+"):
            out[-1][2] = e
        else:
            out.append([int(label[i]) - 1, s, e])
        last = i
    return [tuple(o) for o in out if o[0] != 3 or 9 <= len(digits_of(text[o[1]:o[2]])) <= 15]


def spans_of(field: Field | None, texts: list) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(t)[0] for t in texts]
    out = [(b, []) for b in base]
    at = [i for i, t in enumerate(texts) if field is not None and t and _HAS.search(t)]
    graphs = [nodes_of(texts[i]) for i in at]
    if not graphs:
        return out
    probs, done = beliefs(field, graphs), 0
    for i, g in zip(at, graphs):
        out[i] = (base[i], added(g, probs[done:done + len(g.bits)], texts[i], base[i]))
        done += len(g.bits)
    return out


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def train(docs: DataFrame) -> Field | None:
    return fit(training_counts(docs))


def find(docs: DataFrame, field: Field | None, keep: list[str]) -> DataFrame:
    """Columns ``keep``, base counts, the digest of base spans, all spans and the masked text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # some hundred numbers

    def factory():
        def run(texts):
            found = spans_of(shared.value, texts)
            out = {f"n_{k}": [sum(s[0] == i for s in b) for b, _ in found] for i, k in enumerate(KINDS)}
            out["base_sha256"] = [hashlib.sha256(told(b).encode()).hexdigest() for b, _ in found]
            out["spans"] = [told(b + a) for b, a in found]
            out["n_added"] = [len(a) for _, a in found]
            return out
        return run

    return map_texts(docs, factory, [*[(f"n_{k}", "bigint") for k in KINDS], ("base_sha256", "string"),
                                     ("spans", "string"), ("n_added", "bigint")], keep)


def mask(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """Each span (overlapping ones as one) replaced by its kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with its texts masked, all columns (``n_chars`` follows the text)."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs) if field is None else field)

    def factory():
        def run(texts):
            return {"masked": [mask(t, b + a) for t, (b, a) in zip(texts, spans_of(shared.value, texts))]}
        return run

    cols = docs.columns
    wide = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], F.col("text").alias("text"))
    out = map_texts(wide, factory, [("masked", "string")],
                    [f"c{i}" for i, c in enumerate(cols) if c != "text"])
    value = {"text": F.col("masked")}
    if "n_chars" in cols:
        i = cols.index("n_chars")
        kind = docs.schema["n_chars"].dataType
        value["n_chars"] = F.when(F.col(f"c{i}").isNotNull(), F.length("masked")).cast(kind)
    return out.select(*[value.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(cols)])


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find(docs, train(docs), ["doc_id"])
