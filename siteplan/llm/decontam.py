"""Benchmark decontamination by spaced-seed hashing.

Every window of 8 words of a benchmark item is hashed four times, each time without two inner positions, so that
each inner position is ignored at least once: a substituted word leaves seeds intact. Items that count only as a whole
(13 words or fewer) are hashed under masks of their own length: the item is cut into five blocks, and each mask ignores
as many blocks as the item may have substitutions, so one mask ignores all of them wherever they are. The hashes of all
items set bits in a filter of fixed size, which goes to all tasks; document windows that pass it are joined with the
item hashes on the hash. Around each hit the item is laid along the document and compared word by word: the best segment
(match +1, substitution -3) is reported if it meets the rule of ``overlaps``, else the longest segment whose share suffices.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteplan.llm.common import fold_table, lookup, mix, raw_texts, shielded, word_hashes
from siteplan.session import stage

SPAN = 8
MASKS = ["10110111", "11011011", "11101101", "11111001"]
WHOLE = 13   # items up to here are searched by masks of their own length
BLOCKS = 5
SHORTEST = 5  # an item under so many words taints only a text that holds nothing else
LEAST_WORDS, LEAST_SHARE, PENALTY = 13, 0.8, 3
FILTER_BITS = 1 << 25
PROBES = 3
WORD_BYTES = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])

_weights = np.random.default_rng(8).integers(1, 2**63, max(SPAN, WHOLE), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def whole_masks(n: int, share: Fraction) -> list[str]:
    """Masks over a whole item of ``n`` words: any choice of words that leaves ``share`` of it equal is ignored by one."""
    spare = int(n - n * share)  # substitutions, rounded down
    parts = min(n, max(BLOCKS, 2 * spare + 1))
    block = [k * parts // n for k in range(n)]
    return ["".join("0" if b in out else "1" for b in block) for out in combinations(range(parts), spare)]


def masks_of(n: int, least_words: int, share: Fraction) -> list[str]:
    """The masks by which an item of ``n`` words is searched."""
    return whole_masks(n, share) if 0 < n < SPAN or 0 < n <= min(least_words, WHOLE) else MASKS if n else []


def seeds(words: np.ndarray, masks: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of all windows under each mask."""
    at, out = [], []
    for mask in masks:
        n = len(words) - len(mask) + 1
        if n > 0:
            h = np.full(n, int("1" + mask, 2), np.uint64)  # the mask itself, with its length
            for k, use in enumerate(mask):
                if use == "1":
                    h += words[k:k + n] * _weights[k]
            at.append(np.arange(n))
            out.append(mix(h))
    return (np.concatenate(at), np.concatenate(out)) if at else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def bits(hashes: np.ndarray, probe: int) -> np.ndarray:
    """Bit number of a probe: another stretch of the hash each time."""
    return ((hashes >> np.uint64(13 * probe)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def item_table(benchmark: DataFrame, least_words: int, share: Fraction) -> DataFrame:
    """(item_id, words, at, hash): word hashes as bytes and seeds of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = fold_table(words=WORD_BYTES)
        for batch in batches:
            words, at, found = [], [], []
            for raw in raw_texts(batch.column(1)):
                w = word_hashes(raw, codes)
                p, h = seeds(w, masks_of(len(w), least_words, share))
                words.append(w.tobytes())
                at.append(p.astype(np.int32))
                found.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), pa.array(at, pa.list_(pa.int32())),
                                              pa.array(found, pa.list_(pa.int64()))], ["item_id", "words", "at", "hash"])

    return benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "item_id long, words binary, at array<int>, hash array<long>")


def seed_filter(hashes: DataFrame) -> np.ndarray:
    """The bit filter of all item hashes, put together by a grouped aggregation: 4 MB whatever their number."""
    where = F.array(*[F.shiftright("hash", 13 * p).bitwiseAND(F.lit(FILTER_BITS - 1)) for p in range(PROBES)])
    bytes_ = (hashes.select(F.explode(where).alias("bit")).distinct()
              .groupBy((F.col("bit") / 8).cast("long").alias("byte"))
              .agg(F.expr("bit_or(cast(shiftleft(1, cast(bit % 8 as int)) as int))").alias("v")))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    rows = bytes_.toPandas()
    out[rows["byte"].to_numpy()] = rows["v"].to_numpy().astype(np.uint8)
    return out


def best_segment(agree: np.ndarray) -> tuple[int, int]:
    """Borders of the segment with the largest sum of +1 per agreement and -PENALTY per other word."""
    total = np.concatenate([[0], np.cumsum(np.where(agree, 1, -PENALTY))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    return int(np.argmin(total[:end + 1])), end


def longest_segment(agree: np.ndarray, least_share: Fraction) -> tuple[int, int]:
    """Borders of the longest segment with an equal share of ``least_share``; of several, one with the most equal words."""
    equal = np.concatenate([[0], np.cumsum(agree, dtype=np.int64)])
    # In whole numbers: the share of (x, y) suffices if the surplus at y is not below that at x.
    surplus = equal * least_share.denominator - np.arange(len(equal)) * least_share.numerator
    low = np.minimum.accumulate(surplus)
    start = np.searchsorted(-low, -surplus)  # the first place that is as low
    end = int(np.lexsort((equal - equal[start], np.arange(len(equal)) - start))[-1])
    return int(start[end]), end


def overlaps(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS, least_share: float = LEAST_SHARE) -> DataFrame:
    """(doc_id, text_hash, item_id, doc_start, item_start, n_words, n_equal, share, n_doc_words): the best overlap of each pair.

    An overlap counts if it has ``least_words`` words, or all of a shorter item's, and an equal share of ``least_share``;
    words at its ends may differ too. Items of up to 13 words, which count as a whole, are all found: those under 5 words
    allow no substitution at a share of 0.8, those of 5 to 9 words one, those of 10 to 13 two. An overlap with a longer
    item is found where it holds a window of 8 words equal outside a mask's two positions: always if it has one
    substitution, else nearly always (``tests/llm/test_overlaps.py`` measures 0.95 or more for every length).
    A document is hashed under the masks of those lengths only that the benchmark holds (at most ten a length).
    ``n_doc_words`` is the number of words of the whole document. Null and empty texts have no overlap.
    A null item_id is a value like others; several texts under one item_id are items of their own.
    Copies of a text under other ids, and repeated rows, are each reported once per id.
    """
    spark = docs.sparkSession
    share = Fraction(str(least_share))
    # An item is named by the hash of its id, which may be null, and its words.
    items = stage(item_table(benchmark, least_words, share).withColumn("item", F.xxhash64("item_id", "words")).dropDuplicates(["item"]), "items")
    long = SPAN if least_words < SPAN else min(least_words, WHOLE) + 1  # all longer items share the masks of 8 words
    lengths = items.select(F.least(F.octet_length("words") / 8, F.lit(long)).cast("int").alias("n")).distinct().collect()
    masks = sorted({m for r in lengths for m in masks_of(r["n"], least_words, share)})
    item_seeds = items.select("item", F.explode(F.arrays_zip("at", "hash")).alias("s")).select("item", "s.at", "s.hash")
    sent = spark.sparkContext.broadcast(seed_filter(item_seeds))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, table = fold_table(words=WORD_BYTES), sent.value
        for batch in batches:
            rows, words, at, found = [], [], [], []
            for k, raw in enumerate(raw_texts(batch.column(2))):
                w = word_hashes(raw, codes)
                p, h = seeds(w, masks)
                for i in range(PROBES):
                    b = bits(h, i)
                    ok = (table[b >> 3] >> (b & 7).astype(np.uint8)) & 1 == 1
                    p, h = p[ok], h[ok]
                if len(p):
                    rows.append(k)
                    words.append(w.tobytes())
                    at.append(p.astype(np.int32))
                    found.append(h.view(np.int64))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(words, pa.large_binary()).cast(pa.binary()),
                     pa.array(at, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "text_hash", "doc_words", "at", "hash"])

    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"),
                        F.col("text").cast("string"))
    hits = stage(texts.mapInArrow(probe, "doc_id long, text_hash long, doc_words binary, at array<int>, hash array<long>"), "seed_hits")
    key = ["doc_id", "text_hash"]
    places = hits.select(*key, F.explode(F.arrays_zip("at", "hash")).alias("s")).select(*key, F.col("s.at").alias("doc_at"), "s.hash")
    met = lookup(places, item_seeds, ["hash"], [F.coalesce("doc_id", F.lit(0)), F.col("doc_at")], "inner", shuffled=True)
    pairs = (met.select(*key, "item", (F.col("doc_at") - F.col("at")).alias("shift")).distinct()
             .groupBy(*key, "item").agg(F.collect_list("shift").alias("shifts")))  # fewer than the words of one document
    one = hits.select(*key, "doc_words").dropDuplicates(key)
    both = (pairs.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
            .join(one, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash"))).drop("d", "h"))
    full = lookup(both, items.select("item", "item_id", F.col("words").alias("item_words")), ["item"], [F.col("text_hash")], "inner")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, h, item, shifts, dw, iw in zip(*[batch.column(k).to_pylist() for k in range(6)], strict=True):
                d, w = np.frombuffer(dw, np.uint64), np.frombuffer(iw, np.uint64)
                best = None
                for s in sorted(shifts):
                    a, b = max(0, s), min(len(d), s + len(w))
                    agree = d[a:b] == w[a - s:b - s]
                    for x, y in (best_segment(agree), longest_segment(agree, share)):
                        n, equal = y - x, int(agree[x:y].sum())
                        if n >= min(least_words, len(w)) and equal * share.denominator >= share.numerator * n:
                            if best is None or equal > best[5]:
                                best = (doc, h, item, a + x, a + x - s, equal, n, len(d))
                            break
                if best:
                    rows.append(best)
            if rows:
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[k], pa.int64()) for k in (0, 1, 2, 3, 4, 6, 5)] 
                    + [pa.array([e / n for e, n in zip(c[5], c[6], strict=True)], pa.float64()), pa.array(c[7], pa.int64())],
                    ["doc_id", "text_hash", "item_id", "doc_start", "item_start", "n_words", "n_equal", "share", "n_doc_words"])

    return full.select(*key, "item_id", "shifts", "doc_words", "item_words").mapInArrow(
        verify, "doc_id long, text_hash long, item_id long, doc_start long, item_start long, n_words long, n_equal long, share double, n_doc_words long")


@shielded("doc_id", "text")
def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without an overlap.

    An item under 5 words ("yes", "the capital of France") taints a text only if it is the whole text: it stands in
    many clean ones.
    """
    taints = (F.col("n_words") >= SHORTEST) | (F.col("n_words") == F.col("n_doc_words"))
    bad = stage(overlaps(docs, benchmark), "overlaps").filter(taints).select("doc_id", "text_hash").distinct()
    marked = docs.withColumn("_text_hash", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    bad = bad.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    return marked.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")),
                       "left_anti").select(*docs.columns)
