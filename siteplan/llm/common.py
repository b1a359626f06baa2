"""Joins, numbering and byte-level text helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], spread: Sequence[Column], how: str = "left",
           salts: int = SALTS, shuffled: bool = False) -> DataFrame:
    """Join ``table`` (one small row per key) to ``df``; every key is split over ``salts`` tasks by ``spread``.

    The planner knows the size of ``table``, not that of its ``salts`` copies, and may send all of them through the driver
    to every executor. ``shuffled`` rules that out, for a table that is not small.
    """
    many = table.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return (df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
            .join(many.hint("merge") if shuffled else many, [*on, "_salt"], how).drop("_salt"))


def shielded(*used: str) -> Callable:
    """For a function that returns rows of its first argument: it sees the columns ``used`` under their names, all others
    under numbers.

    So no column of the user meets one that the function adds, whatever its name (also with dots, or in another case), and
    all come back unchanged, in their order and under their names.
    """
    def around(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(function)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            names = docs.columns
            inner = [n if n in used else f"_user_{i}" for i, n in enumerate(names)]
            return function(docs.toDF(*inner), *args, **kwargs).select(*inner).toDF(*names)
        return run
    return around


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns; maps, which have no order, as sorted text."""
    def hashable(name: str, kind: str) -> Column:
        if kind.startswith("map<"):
            return F.to_json(F.array_sort(F.transform(F.map_entries(F.col(name)), lambda e: F.to_json(F.struct(e["key"].alias("k"), e["value"].alias("v"))))))
        return F.to_json(F.struct(F.col(name))) if "map<" in kind or "variant" in kind else F.col(name)
    return F.xxhash64(*[hashable(n, t) for n, t in df.dtypes])


def without(df: DataFrame, rejected: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` whose (key, text hash) is not in ``rejected`` (columns ``_id``, ``_text_hash``); null ids match null ids."""
    return df.join(rejected, F.col(key).eqNullSafe(F.col("_id"))
                   & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("_text_hash")), "left_anti")


def row_key(key: str = "doc_id", text: str = "text") -> list[Column]:
    """The columns that ``without`` matches."""
    return [F.col(key).alias("_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text_hash")]


def numbered(df: DataFrame, by: Sequence[str], order: Column, buckets: int, out: str) -> DataFrame:
    """Gapless numbers from 0 within each ``by`` group, in the order of the hash ``order``.

    A group is cut by ``order`` into ``buckets`` parts that are sorted apart; part sizes give the offsets.
    Rows with equal ``order`` must be equal in all columns, or be told apart by it.
    """
    cut = df.withColumn("_part", F.pmod(F.xxhash64(order, F.lit(17)), F.lit(int(buckets))))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
               .select(*by, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    place = Window.partitionBy(*by, "_part").orderBy(order)
    return (cut.join(offsets, [*by, "_part"])
            .withColumn(out, F.col("_before") + F.row_number().over(place) - 1).drop("_part", "_before"))


# ---- inside tasks --------------------------------------------------------------------------

def fold_table(separators: bytes | None = None, words: bytes | None = None) -> np.ndarray:
    """256 byte codes: 0 for a separator, else 1 + the byte with A-Z in lower case."""
    codes = np.arange(1, 257, dtype=np.uint64)
    codes[65:91] += 32
    if words is not None:
        keep = np.zeros(256, bool)
        keep[np.frombuffer(words, np.uint8)] = True
        codes[~keep] = 0
    if separators is not None:
        codes[np.frombuffer(separators, np.uint8)] = 0
    return codes


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit of 64-bit values (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BLOCK = 1 << 20
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        step = np.full(max(n, 4096), 0x9E3779B97F4A7C15, np.uint64)
        step[0] = 1
        _powers = np.cumprod(step, dtype=np.uint64)
    return _powers


def blocks(raw: np.ndarray, codes: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, codes) slices that end at a separator, so that memory stays small for very long texts."""
    at = 0
    while at < len(raw):
        end = at + size
        while end < len(raw):
            stop = np.flatnonzero(codes[raw[end:end + size]] == 0)
            if len(stop):
                end += int(stop[0])
                break
            end += size
        yield at, codes[raw[at:end]]
        at = end


def word_spans(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-separators."""
    edge = np.flatnonzero(np.diff(b != 0, prepend=False, append=False))
    return edge[::2], edge[1::2]


def word_hashes(raw: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word of a text's UTF-8 bytes."""
    out = []
    for _, b in blocks(raw, codes):
        starts, ends = word_spans(b)
        if len(starts):
            sizes = ends - starts
            place = np.flatnonzero(b) - np.repeat(starts, sizes)
            first = np.cumsum(sizes) - sizes
            out.append(mix(np.add.reduceat(b[b != 0] * powers(int(sizes.max()))[place], first) + sizes.astype(np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct sorted hashes of runs of ``size`` words; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    return np.unique(h)


def raw_texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text of an Arrow column; a null is an empty text."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    empty = data[:0]
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield data[ends[i]:ends[i + 1]] if valid[i] else empty
