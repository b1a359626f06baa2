"""MinHash near-duplicates with sequential Bayesian verification.

Documents are sets of distinct word shingles. Equal sets are merged first. Each distinct set gets a signature of
``hashes_for(threshold)`` MinHash values (16 bits kept of each), in bands of ``ROWS``; sets that agree on a whole band are candidates. Within a
bucket, signatures are compared a batch at a time: after n values with m agreements the posterior of the similarity
(uniform prior) says how likely it reaches the threshold, and a pair is dropped when that is below ``MISS``. Pairs that
survive all batches join their documents into families. Inside a family every pair is tested in the same way and the
survivors are confirmed on the full shingle sets, so a link rests on exact sets only.

There are as many bands as keep the probability that a pair at the threshold shares none below ``MISS``: 24 at 0.85
(8e-7), 36 at 0.8 (6e-7). Buckets and families of any size
are cut into blocks, compared as pairs of blocks: tasks stay small, and each sends on a spanning forest of its links,
never all of them. Connected components are found by star contraction on written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteplan.llm.common import fold_table, lookup, mix, raw_texts, row_hash, shielded, shingles, word_hashes
from siteplan.session import stage

WORDS, ROWS, BATCH = 5, 5, 20
MISS = 1e-6
BLOCK_ROWS, FAMILY_ROWS = 1024, 256
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def hashes_for(threshold: float, miss: float = MISS) -> int:
    """Signature length, in whole batches, at which a pair at the threshold shares no band with probability ``miss`` at most."""
    if threshold >= 1:
        return BATCH
    return BATCH * ceil(log(miss) / log1p(-(threshold**ROWS)) * ROWS / BATCH)


HASHES = hashes_for(0.85)


def permutations(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of so many hash permutations."""
    rng = np.random.default_rng(20)
    return (rng.integers(1, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, hashes, dtype=np.uint64))


def signature(sets: np.ndarray, multiply: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The low 16 bits of the smallest of each permutation's values."""
    low = np.full(len(add), 2**64 - 1, np.uint64)
    for at in range(0, len(sets), 512):
        x = sets[at:at + 512, None] * multiply
        x += add
        x ^= x >> np.uint64(32)
        np.minimum(low, x.min(axis=0), out=low)
    return mix(low).astype(np.uint16)


def band_keys(sigs: np.ndarray) -> np.ndarray:
    """One 64-bit key per signature and band."""
    key = np.tile(np.arange(1, sigs.shape[1] // ROWS + 1, dtype=np.uint64), (len(sigs), 1))
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sigs[:, r::ROWS].astype(np.uint64))
    return key


def least_agreements(threshold: float, miss: float = MISS) -> list[int]:
    """For each batch end n: the fewest agreements m with P(similarity >= threshold | m of n) >= miss.

    The posterior is Beta(m + 1, n - m + 1); its upper tail is a binomial sum.
    """
    out = []
    for n in range(BATCH, hashes_for(threshold) + 1, BATCH):
        tail, m = 0.0, 0
        while m <= n:
            if threshold < 1:  # in logarithms, as long signatures have binomials beyond a float
                tail += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(threshold) + (n + 1 - m) * log1p(-threshold))
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return out


def survivors(a: np.ndarray, b: np.ndarray, same: bool, least: list[int]) -> tuple[np.ndarray, ...]:
    """Index pairs of two signature blocks that no batch prunes, and their agreements.

    ``same``: the blocks are one, pairs are taken once.
    """
    found = []
    for i in range(0, len(a), 64):
        part = a[i:i + 64]
        agree = (part[:, None, :BATCH] == b[None, :, :BATCH]).sum(axis=2, dtype=np.int16)
        x, y = np.nonzero(agree >= least[0])
        if same:
            x, y = x[(keep := x + i < y)], y[keep]
        score = agree[x, y].astype(np.int64)
        for k, m in enumerate(least[1:], 1):
            score += (part[x, k * BATCH:(k + 1) * BATCH] == b[y, k * BATCH:(k + 1) * BATCH]).sum(axis=1)
            keep = score >= m
            x, y, score = x[keep], y[keep], score[keep]
        found.append((x + i, y, score))
    x, y, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    return x, y, score


class Forest:
    """Union-find over the rows of one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def sketches(docs: DataFrame, words: int = WORDS, hashes: int = HASHES) -> DataFrame:
    """(doc_id, text_hash, n_shingles, s1, s2, sig) per row; n_shingles, s1 and s2 identify the shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, (multiply, add) = fold_table(separators=SPACES), permutations(hashes)
        for batch in batches:
            n, s1, s2, sig = [], [], [], []
            for raw in raw_texts(batch.column(2)):
                x = shingles(word_hashes(raw, codes), words)
                n.append(len(x))
                s1.append(int(np.bitwise_xor.reduce(x).view(np.int64)) if len(x) else 0)
                s2.append(int(mix(x.copy()).sum(dtype=np.uint64).view(np.int64)) if len(x) else 0)
                sig.append(signature(x, multiply, add).tobytes() if len(x) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.array(sig, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "s1", "s2", "sig"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, s1 long, s2 long, sig binary")


def banded(sets: DataFrame) -> DataFrame:
    """(key, node): the band keys of each signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_sigs(batch.column(1))).view(np.int64)
                nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(nodes)], ["key", "node"])

    return sets.select("node", "sig").mapInArrow(run, "key long, node long")


def in_blocks(members: DataFrame, group: str, payload: DataFrame, block_rows: int) -> DataFrame:
    """Members (group, node) of groups of two or more, dealt to pairs of blocks and sorted by them.

    A group of m rows has ceil(m / block_rows) blocks by a hash of the node; block pair (i, j), i <= j, gets the
    rows of both. So a task meets two blocks at a time, and a row goes to as many pairs as its group has blocks.
    ``payload`` (node, ...) is joined only to rows that have company. Result: (group, _i, _j, _side, node, ...).
    """
    sizes = (members.groupBy(group).agg(F.count("*").alias("_m")).filter("_m > 1")
             .select(group, F.ceil(F.col("_m") / block_rows).alias("_blocks")))
    dealt = (lookup(members, sizes, [group], [F.col("node")], "inner", shuffled=True)
             .withColumn("_own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("_blocks")))
             .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
             .select(group, F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"),
                     (F.col("_own") > F.col("_other")).alias("_side"), "node"))
    order = [group, "_i", "_j", "_side", "node"]
    return (dealt.join(payload, "node").select(*order, *[c for c in payload.columns if c != "node"])
            .repartition(group, "_i", "_j").sortWithinPartitions(*order))


def _wide(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts and bytes with 64-bit offsets, so that batches joined to one may hold more than 2 GB."""
    wide = {pa.string(): pa.large_string(), pa.binary(): pa.large_binary()}
    return batch.cast(pa.schema([(f.name, wide.get(f.type, f.type)) for f in batch.schema]))


def block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch, bool]]:
    """The two sorted blocks of each (group, _i, _j), which may cross batches; True if a block meets itself."""
    def split(x: pa.RecordBatch):
        i, j, side = (x.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        if i[0] == j[0]:
            return x, x, True
        cut = int(np.searchsorted(side, True))
        return x.slice(0, cut), x.slice(cut), False

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = _wide(batch)
        x = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = np.stack([x.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2)])
        starts = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            yield split(x.slice(a, b - a))
        held = x.slice(int(starts[-1]))
    if held is not None:
        yield split(held)


def _sigs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _link_batch(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def candidate_links(buckets: DataFrame, signatures: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): a spanning forest, per pair of blocks, of the pairs in a bucket that survive the sequential test."""
    least = least_agreements(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, q, same in block_pairs(batches):
            if not p.num_rows or not q.num_rows:
                continue
            i, j, _ = survivors(_sigs(p.column(5)), _sigs(q.column(5)), same, least)
            pn, qn = p.column(4).to_pylist(), q.column(4).to_pylist()
            forest, shift = Forest(len(pn) + len(qn)), 0 if same else len(pn)
            kept = [(pn[u], qn[v]) for u, v in zip(i.tolist(), j.tolist(), strict=True) if forest.join(u, v + shift)]
            if kept:
                yield _link_batch([x for x, _ in kept], [y for _, y in kept])

    return in_blocks(buckets, "key", signatures, block_rows).mapInArrow(run, "a long, b long")


def confirmed_links(families: DataFrame, payload: DataFrame, threshold: tuple[int, int], words: int = WORDS,
                    block_rows: int = FAMILY_ROWS) -> DataFrame:
    """(a, b): a spanning forest, per pair of blocks, of the links in families (family, node).

    ``payload`` is (node, sig, text). ``threshold`` (p, q): a link needs q * intersection >= p * union of the full sets.
    """
    least = least_agreements(threshold[0] / threshold[1])
    num, den = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = fold_table(separators=SPACES)
        for p, q, same in block_pairs(batches):
            if not p.num_rows or not q.num_rows:
                continue
            i, j, score = survivors(_sigs(p.column(5)), _sigs(q.column(5)), same, least)
            pn, qn = p.column(4).to_pylist(), q.column(4).to_pylist()
            forest, shift = Forest(len(pn) + len(qn)), 0 if same else len(pn)
            sets: dict[int, np.ndarray] = {}

            def full(side: pa.RecordBatch, row: int, at: int) -> np.ndarray:
                if at not in sets:
                    raw = next(raw_texts(side.column(6).slice(row, 1)))
                    sets[at] = shingles(word_hashes(raw, codes), words)
                return sets[at]

            a, b = [], []
            for k in np.argsort(-score, kind="stable").tolist():  # the most alike first: later pairs are often joined already
                u, v = int(i[k]), int(j[k])
                if forest.find(u) == forest.find(v + shift):
                    continue
                s, t = full(p, u, u), full(q, v, v + shift)
                if den * min(len(s), len(t)) >= num * max(len(s), len(t)):
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    if den * both >= num * (len(s) + len(t) - both):
                        forest.join(u, v + shift)
                        a.append(pn[u])
                        b.append(qn[v])
            if a:
                yield _link_batch(a, b)

    return in_blocks(families, "family", payload, block_rows).mapInArrow(run, "a long, b long")


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end ``u`` has one edge and is no smaller end ``v``: each component is a star around its smallest node."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))
    nodes = (edges.select(F.explode(ends).alias("x")).groupBy("x.node").agg(F.sum("x.up").alias("n"), F.min("x.up").alias("least")))
    return not nodes.agg(F.bool_or((F.col("n") > 1) | ((F.col("n") == 1) & (F.col("least") == 0)))).first()[0]


def components(links: DataFrame, label: str = "component") -> DataFrame:
    """(node, component): smallest node reachable, for every node of ``links`` (a, b).

    Alternates large-star and small-star steps until only stars are left, which another round would not change; each
    round is a written table.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        # Large star: each larger neighbour points to the smallest node around.
        large = (lookup(both.filter("v > u"), low, ["u"], [F.col("v")], "inner", shuffled=True)
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        # Small star: the smaller neighbours of a node, and itself, point to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (lookup(large, least, ["u"], [F.col("v")], "inner", shuffled=True)
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
                 .filter("u <> v").distinct())
        edges = stage(small, "links")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias(label))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias(label)).distinct())


def grouped(docs: DataFrame, threshold: tuple[int, int] = (85, 100), words: int = WORDS,
            block_rows: int = BLOCK_ROWS, family_rows: int = FAMILY_ROWS) -> DataFrame:
    """``near_duplicates`` and ``group``, a number of the component that does not rest on ids; null for a row without words."""
    source = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    rows = stage(sketches(source, words, hashes_for(threshold[0] / threshold[1])), "sketches")
    ident = ["n_shingles", "s1", "s2"]
    # A node is a distinct shingle set, numbered as the table is written; its smallest doc_id with its smallest text hash
    # stands for it.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one")
    sets = stage(rows.filter("n_shingles > 0").groupBy(*ident).agg(least, F.max("sig").alias("sig"))
                 .select(*ident, "sig", F.col("one.doc_id").alias("one_id"), F.col("one.text_hash").alias("one_hash"),
                         F.monotonically_increasing_id().alias("node")), "sets")
    found = candidate_links(banded(sets), sets.select("node", "sig"), threshold[0] / threshold[1], block_rows)
    families = stage(components(found, "family"), "families")
    wanted = families.hint("merge").join(sets, "node").select("node", "sig", "one_id", "one_hash")  # pairs of numbers: small files, many rows
    texts = (source.join(wanted, F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_hash") == F.col("one_hash")))
             .select("node", "sig", "text").dropDuplicates(["node"]))
    comp = components(confirmed_links(families, texts, threshold, words, family_rows))
    linked = comp.hint("merge").join(sets.select("node", "one_id"), "node")
    least_id = linked.groupBy("component").agg(F.min("one_id").alias("least_id"))
    linked = lookup(linked, least_id, ["component"], [F.col("node")], "inner", shuffled=True).select("node", "component", "least_id")
    named = sets.join(linked.hint("merge"), "node", "left").select(
        *ident, F.coalesce("component", "node").alias("group"),
        F.when(F.col("component").isNull(), F.col("one_id")).otherwise(F.col("least_id")).alias("component_id"))
    out = lookup(rows.select("doc_id", "text_hash", *ident), named, ident, [F.coalesce("doc_id", F.lit(0)), F.col("s1")], shuffled=True)
    return (out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", "text_hash", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "group"))


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = (85, 100), words: int = WORDS,
                    block_rows: int = BLOCK_ROWS, family_rows: int = FAMILY_ROWS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept), one row per row of ``docs`` (columns doc_id, text).

    Two documents are linked when q * intersection >= p * union of their shingle sets, ``threshold`` being (p, q).
    component_id is the smallest doc_id reachable. A null text is empty; documents without words have an empty set, no
    link, and are kept. Repeated rows get equal results. A null doc_id takes part in links but never names a component
    unless nothing in it has an id; then component_id is null and its rows are kept.
    """
    return grouped(docs, threshold, words, block_rows, family_rows).drop("group")


@shielded("doc_id", "text")
def distinct_documents(docs: DataFrame, threshold: tuple[int, int] = (85, 100)) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near-duplicates, and one of each repeated row.

    Of a group the smallest doc_id stays, a null one only if the group has no other, and of its texts the one with the
    smallest hash; of rows with that id and text the one with the smallest hash of all columns. Unrelated texts stay, also without an id or under the same one. Rows without words are a group if id
    and text are equal, a null text being an empty one.
    """
    found = stage(grouped(docs, threshold), "near")
    alone = F.col("group").isNull()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("text_hash").alias("_hash")))
    one = (found.groupBy("group", F.when(alone, F.col("doc_id")).alias("_a"), F.when(alone, F.col("text_hash")).alias("_b"))
           .agg(first.alias("_one")).select("_one.*"))
    number = F.col("doc_id").cast("long")
    marked = docs.withColumns({"_none": number.isNull(), "_id": F.coalesce(number, F.lit(0)),
                               "_hash": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    key, row = ["_none", "_id", "_hash"], row_hash(docs)
    marked = marked.withColumn("_row", row)
    copies = lookup(marked, one, key, [F.col("_row")], "left_semi", shuffled=True)
    return copies.groupBy(*key).agg(F.min_by(F.struct(*docs.columns), "_row").alias("_one")).select("_one.*")
