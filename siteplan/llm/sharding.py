"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows fall into source partitions. The number of rows that each partition sends to each shard is
drawn exactly as a uniform permutation of all rows would make it (multivariate hypergeometric).
Every partition permutes its rows and deals them out by its row of the matrix; after the exchange
each shard permutes what it got. Both permutations sort by hashes of the row, so a retried task
repeats its choice. A shard is permuted in parts, so no task holds a whole shard.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART_ROWS = 1_000_000


def hypergeometric(rng: np.random.Generator, total: int, good: int, drawn: int) -> int:
    """Good items among ``drawn`` of ``total`` without replacement: inverse distribution around the mode.

    The probabilities come from their exact ratios within 12 standard deviations of the mode; what lies
    beyond is below the resolution of a double. Unlike numpy's generator it has no limit on ``total``.
    """
    low, high = max(0, drawn - (total - good)), min(good, drawn)
    if low == high:
        return low
    mean = drawn * good / total
    sd = math.sqrt(max(mean * (1 - good / total) * (total - drawn) / max(total - 1, 1), 0.0))
    a, b = max(low, int(mean - 12 * sd) - 12), min(high, int(mean + 12 * sd) + 12)
    k = np.arange(a, b, dtype=float)
    log = np.concatenate([[0.0], np.cumsum(np.log((good - k) * (drawn - k)) - np.log((k + 1) * (total - good - drawn + k + 1)))])
    p = np.cumsum(np.exp(log - log.max()))
    return a + int(np.searchsorted(p, rng.random() * p[-1], side="right"))


def communication_matrix(sizes: list[int], targets: list[int], seed: int) -> np.ndarray:
    """Rows from each source partition to each shard; row sums are ``sizes``, column sums ``targets``."""
    rng, left = np.random.default_rng(seed), list(targets)
    out = np.zeros((len(sizes), len(targets)), np.int64)
    for p, n in enumerate(sizes):
        total = sum(left)
        for s in range(len(left)):
            out[p, s] = x = hypergeometric(rng, total, left[s], n)
            total, n, left[s] = total - left[s], n - x, left[s] - x
    return out


def shuffle_rows(df: DataFrame, shards: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """Add ``shard`` (0 to shards - 1, row counts at most one apart) and ``slot`` (gapless from 0 in the shard).

    ``df`` should be a table that rereads alike; its columns must be hashable (no maps). ``partitions`` is the number
    of source partitions: by default as many as shuffle partitions, and one per million rows at least; the matrix on
    the driver has that many rows. Rows that are equal in all columns are interchangeable, and each gets a place of its
    own. Nulls are values like any other; an empty table gives an empty result. Columns named shard or slot are replaced.
    """
    own = [c for c in df.columns if c not in ("shard", "slot")]
    keyed = df.select(*own).withColumn("_key", F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in own]))
    rows = keyed.count()
    if partitions is None:
        partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))
    placed = keyed.withColumn("_source", F.pmod("_key", F.lit(partitions)))
    sizes = {r[0]: r[1] for r in placed.groupBy("_source").count().collect()}
    sources = sorted(sizes)
    targets = [rows // shards + (s < rows % shards) for s in range(shards)]
    matrix = communication_matrix([sizes[p] for p in sources], targets, seed).cumsum(axis=1)
    table = df.sparkSession.createDataFrame([(p, row.tolist()) for p, row in zip(sources, matrix, strict=True)],
                                            "_source bigint, _upto array<bigint>")
    ties = [F.col(f"`{c}`") for c in own]
    local = Window.partitionBy("_source").orderBy(F.xxhash64(F.lit(seed + 1), "_key"), "_key", *ties)
    sent = (placed.join(table, "_source").withColumn("_rank", F.row_number().over(local) - 1)
            .withColumn("shard", F.expr("cast(size(filter(_upto, x -> x <= _rank)) as int)")))
    # Second permutation: parts of a shard in random order, rows in random order within a part.
    parts = max(1, -(-rows // (shards * PART_ROWS)), partitions // shards)
    cut = sent.select(*own, "shard", "_key").withColumn("_again", F.xxhash64(F.lit(seed + 2), "_key")) \
        .withColumn("_part", F.pmod("_again", F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
               .select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    again = Window.partitionBy("shard", "_part").orderBy("_again", "_key", *ties)
    return (cut.join(offsets, ["shard", "_part"])
            .withColumn("slot", F.col("_before") + F.row_number().over(again) - 1)
            .select(*own, "shard", "slot"))


def write_shards(df: DataFrame, path: str) -> None:
    """Write shuffled rows as one folder per shard, in slot order."""
    (df.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
