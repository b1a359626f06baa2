"""Best-two-fit packing of tokenized documents into sequences of one length.

A document longer than the sequence is cut into full pieces, with its remainder first. Packing needs only how
many pieces have each length, at most ``size`` counts whatever the corpus. ``plan`` fills one sequence pattern
at a time from these counts: greedily with the longest pieces that fit, then it replaces the smallest piece by
two unpacked pieces that fit the gap left by it more tightly, as long as that gains. A pattern is used as often
as the counts allow. The plan says for every length which ranks of pieces go to which sequences; tasks place
their pieces by it.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteplan.llm.common import numbered
from siteplan.session import stage

SIZE = 2048
PART_ROWS = 200_000

# The split rule of the vocabulary, and the same without look-ahead, which is equal to it
# for texts without two white-space characters in a row.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT_SINGLE_SPACES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
# What both tokenizer libraries class alike: anything else goes to the JSON file's own tokenizer.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\u024f\u2010-\u2027]")
TWO_SPACES = re.compile(r"\s\s")


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str, ranks: str | None):
    """A function from a text to its token ids.

    ``vocabulary`` is the tokenizer's JSON file. ``ranks``, if given, is the same vocabulary as tiktoken ranks: ordinary
    Latin texts are then encoded with it, several times faster and with equal ids; all other texts use the JSON file.
    """
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(vocabulary)
    full.encode_special_tokens = True
    if ranks is None:
        return lambda text: full.encode(text, add_special_tokens=False).ids
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain, single = (tiktoken.Encoding(name, pat_str=rule, mergeable_ranks=table, special_tokens={})
                     for name, rule in (("plain", SPLIT), ("single", SPLIT_SINGLE_SPACES)))

    def encode(text: str) -> list[int]:
        if UNUSUAL.search(text):
            return full.encode(text, add_special_tokens=False).ids
        return (plain if TWO_SPACES.search(text) else single).encode_ordinary(text)

    return encode


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, size: int = SIZE, end_id: int = 0,
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): token pieces of ``docs`` (columns doc_id and text).

    A null text is empty and gives one piece, the end id alone. Rows with equal ids give a set of pieces each.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["RAYON_NUM_THREADS"] = "1"
        encode = tokenizer(vocabulary, ranks)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                first = len(ids) % size or min(size, len(ids))
                borders = [0, *range(first, len(ids), size), len(ids)]
                for k in range(len(borders) - 1):
                    part = ids[borders[k]:borders[k + 1]]
                    rows.append((doc, k, borders[k], len(part), zlib.crc32(part.tobytes()), part) if with_ids
                                else (doc, k, borders[k], len(part), zlib.crc32(part.tobytes())))
            if rows:
                cols = list(zip(*rows, strict=True))
                out = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:5]]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out.append(pa.array([x.astype("<i4") for x in cols[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


@dataclass
class Plan:
    """Per length, sorted by first rank: ranks from ``first`` go to sequence ``sequence`` on, at place ``offset``."""
    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def plan(counts: dict[int, int], size: int = SIZE) -> Plan:
    """Patterns of sequences for so many pieces of each length."""
    have = np.zeros(size + 1, np.int64)
    for n, k in counts.items():
        have[n] = k
    used = np.zeros(size + 1, np.int64)
    rows: list[tuple[int, int, int, int]] = []
    sequences = 0
    while have.any():
        left, gap, pattern = have.copy(), size, []
        present = np.flatnonzero(left)
        while gap:
            present = present[(present <= gap) & (left[present] > 0)]
            if not len(present):
                break
            n = int(present[-1])
            k = int(min(left[n], gap // n))
            pattern += [n] * k
            left[n] -= k
            gap -= n * k
        while gap:  # the smallest piece against two
            small = min(pattern)
            pair = _best_pair(left, gap + small, small)
            if pair is None:
                break
            pattern.remove(small)
            left[small] += 1
            for n in pair:
                left[n] -= 1
                pattern.append(n)
            gap = size - sum(pattern)
        need = Counter(pattern)
        times = min(int(have[n]) // k for n, k in need.items())
        at = 0
        for n in sorted(need, reverse=True):
            for _ in range(need[n]):
                rows.append((n, int(used[n]), sequences, at))
                used[n] += times
                at += n
            have[n] -= need[n] * times
        sequences += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return Plan(cols[0], cols[1], cols[2], cols[3], sequences)


def _best_pair(left: np.ndarray, room: int, over: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum that is at most ``room`` and above ``over``."""
    present = np.flatnonzero(left[:room])
    if not len(present):
        return None
    at = np.searchsorted(present, room - present, side="right") - 1
    ok = at >= 0
    a, b = present[ok], present[at[ok]]
    same = (a == b) & (left[a] < 2)
    # A length that is there once can't pair with itself: take the next smaller one.
    lower = np.maximum(at[ok] - 1, 0)
    valid = ~same | (at[ok] > 0)
    b = np.where(same, present[lower], b)
    a, b = a[valid], b[valid]
    if not len(a):
        return None
    best = int(np.argmax(a + b))
    return (int(a[best]), int(b[best])) if a[best] + b[best] > over else None


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a staged table of pieces; every piece is placed, offsets are gapless.

    Pieces of a length are numbered in parts of about 200,000, so a length that many pieces share is split.
    Repeated rows are pieces of their own. An empty table gives an empty result.
    """
    counts = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    layout = plan(counts, size)
    begins = np.searchsorted(layout.length, np.arange(size + 2))
    columns = cut.columns

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            seq, off = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
            n, rank = x["length"].to_numpy(), x["_rank"].to_numpy()
            for length in np.unique(n):
                a, b = begins[length], begins[length + 1]
                rows = n == length
                k = a + np.searchsorted(layout.first[a:b], rank[rows], side="right") - 1
                seq[rows] = layout.sequence[k] + rank[rows] - layout.first[k]
                off[rows] = layout.offset[k]
            yield x[columns].assign(sequence_id=seq, offset=off)

    parts = max(8, -(-sum(counts.values()) // PART_ROWS))
    # Equal pieces may come twice; the row's place in its part then tells them apart.
    ranked = numbered(cut, ["length"], F.xxhash64(*[F.col(c) for c in columns if c != "ids"]), parts, "_rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.select(*columns, "_rank").mapInPandas(place, schema + ", sequence_id long, offset long")


def packed(docs: DataFrame, vocabulary: str, ranks: str | None = None, size: int = SIZE, end_id: int = 0) -> DataFrame:
    """Placed pieces of ``docs``: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return pack(stage(pieces(docs, vocabulary, ranks, size, end_id), "pieces"), size)


def sequences(docs: DataFrame, vocabulary: str, ranks: str | None = None, size: int = SIZE, end_id: int = 0) -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed token sequences themselves. A sequence holds ``size`` pieces at most."""
    placed = pack(stage(pieces(docs, vocabulary, ranks, size, end_id, with_ids=True), "pieces"), size)
    return (placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids")))
