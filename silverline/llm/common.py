"""Shared helpers of the training-data operators.

Every operator selects the columns it needs first, so extra columns of the
input (whatever their names) never clash with its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.session import scratch_dir

#: Rows, and bytes of text, of an Arrow batch that are worked on together in a task.
CHUNK_ROWS, CHUNK_BYTES = 256, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage: write ``df`` below ``spark.checkpoint.dir`` and read it back.

    The files are in the folder all executors share, so losing an executor
    loses nothing that was stored.
    """
    path = scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id's text, modulo ``n`` (null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")),
                  F.lit(n))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def chunks(batch: pa.RecordBatch, column: str, rows: int = CHUNK_ROWS,
           most_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``rows`` rows and ``most_bytes`` of ``column`` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = int(np.searchsorted(ends, before + most_bytes, side="right"))
        end = min(max(end, at + 1), at + rows)
        yield batch.slice(at, end - at)
        at = min(end, batch.num_rows)


def map_texts(df: DataFrame, factory: Callable[[], Callable[[list], dict]],
              fields: Sequence[tuple[str, str]], keep: Sequence[str], text: str = "text",
              rows: int = CHUNK_ROWS, as_arrow: bool = False) -> DataFrame:
    """Columns ``keep`` of each row plus ``fields`` computed from its text.

    ``factory`` runs once per task and returns a function from a list of
    texts (null included; with ``as_arrow`` an Arrow array) to a dict of
    equally long lists.
    """
    src = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    kept = [src.schema[c] for c in keep]
    added = T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in fields)).fields
    schema = T.StructType([*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        want, fn = None, factory()
        for whole in batches:
            want = want or to_arrow_schema(schema)
            for part in chunks(whole, text, rows):
                texts = part.column(part.schema.get_field_index(text))
                out = fn(texts if as_arrow else texts.to_pylist())
                cols = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                cols += [pa.array(out[f.name], type=want.field(f.name).type) for f in added]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema])

    return src.mapInArrow(run, schema)


class Memo:
    """A map of at most about ``most_bytes``, in two generations: what is used again outlives a change.

    Kept for the life of a Python worker, so later tasks start with the
    frequent words of earlier ones.  Very long words are not kept.
    """

    ENTRY, LONG = 240, 256

    def __init__(self, most_bytes: int):
        self.half, self.held, self.young, self.old = most_bytes // 2, 0, {}, {}

    def _keep(self, word, value) -> None:
        if len(word) <= self.LONG:
            self.young[word] = value
            self.held += self.ENTRY + len(word) + len(value)
            if self.held > self.half:
                self.old, self.young, self.held = self.young, {}, 0

    def lookup(self, words: list, compute) -> list:
        """The value (bytes or a tuple) of each word; ``compute`` gives those of a list of new ones."""
        out = list(map(self.young.get, words))
        new = []
        for i in [i for i, v in enumerate(out) if v is None]:
            value = self.old.get(words[i])
            if value is None:
                new.append(i)
            else:
                out[i] = value
                self._keep(words[i], value)
        if new:
            for i, value in zip(new, compute([words[i] for i in new])):
                out[i] = value
                self._keep(words[i], value)
        return out


def distinct_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    r"""(distinct words, number of each word in turn, words before each text and in all).

    Words are ``[^\x20\x09-\x0D]+``; the distinct ones may include ``""`` (no word, found at a text's ends).
    """
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = cut.flatten().dictionary_encode()
    offsets = cut.offsets.to_numpy()
    return flat.dictionary.to_pylist(), flat.indices.to_numpy(), offsets - offsets[0]


_KEPT: dict = {}


def kept(name, make):
    """One object a Python worker, made at first use (a new name takes the place of an old one)."""
    kind = name[0]
    if kind not in _KEPT or _KEPT[kind][0] != name:
        _KEPT[kind] = (name, make())
    return _KEPT[kind][1]


def ascii_words(text: str | None) -> list[bytes]:
    r"""UTF-8 words ``[^\x20\x09-\x0D]+`` (``bytes.split`` splits at just these six bytes)."""
    return text.encode().split() if text else []


_MULT = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``n``."""
    if len(_POWERS[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for k, base in enumerate((_MULT, pow(_MULT, -1, 1 << 64))):
            full = np.full(size, base, np.uint64)
            full[0] = 1
            _POWERS[k] = np.cumprod(full, dtype=np.uint64)
    return _POWERS


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (shift, multiply, shift ...)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words, repeats included.

    Fewer words: one hash of the whole sequence; no word: none.  A polynomial
    hash over the space-joined bytes, taken from prefix sums.
    """
    if not words:
        return np.empty(0, np.uint64)
    flat = np.frombuffer(b" ".join(words), np.uint8)
    up, down = _powers(len(flat) + 1)
    prefix = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[:len(flat)], out=prefix[1:])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - size + 1)
    s, e = starts[:n], ends[len(words) - n:]
    return mix64((prefix[e] - prefix[s]) * down[s])
