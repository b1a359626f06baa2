"""Random forests of many fits (targets x held-out folds) grown in one job.

Labelled rows, ``FOREST_ROWS`` of each part at most, are binned once: a byte for each feature. That table, of bounded size
(2,000,000 rows of 17 bytes), goes to all tasks, and a tree is the unit of work, so that no row moves again and no job runs
for each level. Fits differ by the rows they may draw: the rows of their part without those of their held-out fold. A task
grows its trees level by level on counts by node, feature and bin, and sends a tree back as one row. The forest is a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteplan.functions.transforms import FEATURES
from siteplan.plans.l1path import Fold
from siteplan.session import stage

TREES, SEED = 400, 42
LEAST_LEAF, DEEPEST, BINS = 20, 30, 32
BLOBS = ["feature", "cut", "value"]
TRIED = (len(FEATURES) + 1) // 2  # features tried at a node
FOREST_ROWS = 2_000_000
TREES_PER_TASK = 25
CHUNK = 1 << 13  # rows led through a tree at once
SENT_BYTES = 32 << 20  # trees sent to the tasks at once
PACK = float(1 << 26)  # a drawn positive counts so much more: one exact sum tells both counts of fewer rows than that


@dataclass(frozen=True)
class Tree:
    """Nodes in order of their making: feature (-1 at a leaf), bin, left child (the right one follows it), share of positives."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def steps(self) -> np.ndarray:
        """A number for each node: its left child, its feature (8 bits) and bin (8 bits); a leaf leads to itself."""
        inner = self.feature >= 0
        left = np.where(inner, self.left, np.arange(len(inner))).astype(np.int64)
        return left << 16 | np.where(inner, self.feature, 0).astype(np.int64) << 8 | np.where(inner, self.cut, 255)

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Share of positives at the leaf of each row."""
        steps, line, k = self.steps(), bins.ravel(), bins.shape[1]
        out = np.empty(len(bins), self.value.dtype)
        for a in range(0, len(bins), CHUNK):
            row = np.arange(a, min(a + CHUNK, len(bins)))
            out[a:a + CHUNK] = self.value[self._ends(steps, line, row * k, np.zeros(len(row), np.int64))]
        return out

    def _ends(self, steps: np.ndarray, line: np.ndarray, begin: np.ndarray, at: np.ndarray, own: np.ndarray | None = None, swap: int = 0) -> np.ndarray:
        """Leaf reached from each node ``at``; a row's bins begin at ``begin`` of ``line``, that of feature ``own`` stands ``swap`` places on."""
        end, who = at.copy(), None
        while len(at):
            for _ in range(3):
                step = steps.take(at)
                f = step >> 8 & 255
                place = begin + f
                if own is not None:
                    place += swap * (f == own)
                at = (step >> 16) + (line.take(place) > (step & 255))
            there = self.feature.take(at) < 0
            done = np.flatnonzero(there)
            if len(done) * 4 < len(at):
                continue
            end[done if who is None else who[done]] = at[done]
            more = np.flatnonzero(~there)
            who = more if who is None else who[more]
            begin, at, own = begin[more], at[more], own if own is None else own[more]
        return end

    def borrowed(self, bins: np.ndarray, other: np.ndarray) -> np.ndarray:
        """(rows, features): share at a row's leaf if the bin of that feature alone came from ``other``.

        Only where the borrowed bin lies on the other side of a node on the row's own path does a path of its own begin.
        """
        k = bins.shape[1]
        steps, out = self.steps(), np.empty(bins.shape, self.value.dtype)
        for a in range(0, len(bins), CHUNK):
            line = np.hstack([bins[a:a + CHUNK], other[a:a + CHUNK]]).ravel()
            n = len(line) // (2 * k)
            row, at, told, end = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            left_by: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            while len(at):
                step = steps.take(at)
                f, cut, left = step >> 8 & 255, step & 255, step >> 16
                place = row * (2 * k) + f
                side = line.take(place) > cut
                off = np.flatnonzero((side != (line.take(place + k) > cut)) & (told >> f & 1 == 0))
                left_by.append((row[off], f[off], left[off] + ~side[off]))
                told[off] |= 1 << f[off]
                at = left + side
                there = self.feature.take(at) < 0
                if there.any():
                    done, more = np.flatnonzero(there), np.flatnonzero(~there)
                    end[row[done]] = at[done]
                    row, at, told = row[more], at[more], told[more]
            who, own, at = (np.concatenate(x) for x in zip(*left_by, strict=True)) if left_by else (np.zeros(0, np.int64),) * 3
            part = out[a:a + CHUNK]
            part[:] = self.value[end][:, None]
            part[who, own] = self.value[self._ends(steps, line, who * (2 * k), at, own, k)]
        return out

    def blobs(self) -> list[bytes]:
        """Three and a half bytes a node: cuts of inner nodes and shares of leaves only. Children stand in the order of their parents."""
        inner = self.feature >= 0
        return [self.feature.astype(np.int8).tobytes(), self.cut[inner].astype(np.uint8).tobytes(), self.value[~inner].astype(np.float32).tobytes()]

    @classmethod
    def of(cls, feature: bytes, cut: bytes, value: bytes) -> Tree:
        f = np.frombuffer(feature, np.int8)
        inner = f >= 0
        cuts, left, values = np.zeros(len(f), np.uint8), np.zeros(len(f), np.int32), np.zeros(len(f), np.float32)
        cuts[inner], values[~inner] = np.frombuffer(cut, np.uint8), np.frombuffer(value, np.float32)
        left[inner] = 1 + 2 * np.arange(int(inner.sum()))
        return cls(f, cuts, left, values)


def grow_tree(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, rng: np.random.Generator, tried: int = TRIED,
              least: int = LEAST_LEAF, deepest: int = DEEPEST) -> Tree:
    """A tree on the rows (bins of each feature, 0/1 label, times drawn): the best split by Gini impurity at each node.

    Only ``tried`` features, drawn for each node, may split it, and both sides keep ``least`` drawn rows.
    """
    k = bins.shape[1]
    rows = np.flatnonzero(weight)
    w = weight[rows] * (1 + PACK * y[rows])
    b = np.ascontiguousarray(bins[rows].T)
    node = np.zeros(len(rows), np.int64)  # place in the level; ``size`` for rows that no open node has
    feature, cut, left, value = [], [], [], []
    made, size = 0, 1
    for depth in range(deepest + 1):
        both = np.bincount(node, w, size + 1)[:size]
        p = np.floor(both / PACK)
        n = both - p * PACK
        best, best_f, best_c = np.full(size, 1e-9), np.full(size, -1), np.zeros(size, np.int64)
        if depth < deepest:
            pure = p * (n - p) / np.maximum(n, 1)
            drawn = rng.random((size, k)).argsort(axis=1)[:, :tried]
            wanted = np.zeros((size, k), bool)
            np.put_along_axis(wanted, drawn, True, axis=1)
            open_nodes = (n >= 2 * least) & (pure > 0)
            wanted &= open_nodes[:, None]
            many = int(open_nodes.sum())
            number = np.where(open_nodes, np.cumsum(open_nodes) - 1, many)
            at = np.append(number, many).take(node)
            kept = np.flatnonzero(at < many)
            if len(kept) < 0.75 * len(at):
                node, at, w, b = node[kept], at[kept], w[kept], b.take(kept, axis=1)
            at *= BINS
            code = np.empty_like(at)
            for f in range(k):
                here = np.flatnonzero(wanted[:, f])
                if not len(here):
                    continue
                np.add(at, b[f], out=code)
                low = np.bincount(code, w, (many + 1) * BINS).reshape(many + 1, BINS)[number[here]].cumsum(axis=1)[:, :-1]
                pl = np.floor(low / PACK)
                nl = low - pl * PACK
                nr, pr = n[here, None] - nl, p[here, None] - pl
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = pure[here, None] - pl * (nl - pl) / nl - pr * (nr - pr) / nr
                gain[(nl < least) | (nr < least)] = -1
                c = gain.argmax(axis=1)
                top = gain[np.arange(len(here)), c]
                better = top > best[here]
                best[here[better]], best_f[here[better]], best_c[here[better]] = top[better], f, c[better]
        split = best_f >= 0
        first = made + size  # place of the next level's first node
        feature.append(best_f)
        cut.append(best_c)
        left.append(np.where(split, first + 2 * (np.cumsum(split) - 1), 0))
        value.append(p / np.maximum(n, 1))
        made += size
        if not split.any():
            break
        # Rows of a node go on to its left child or the one after it; those of a leaf leave.
        place, cut_at = np.append(np.maximum(best_f, 0), 0) * len(node), np.append(best_c, 0)
        right = b.ravel().take(place.take(node) + np.arange(len(node))) > cut_at.take(node)
        size = 2 * int(split.sum())
        node = np.append(np.where(split, 2 * (np.cumsum(split) - 1), size), size).take(node) + right
        np.minimum(node, size, out=node)
    return Tree(*[np.concatenate(x) for x in (feature, cut, left, value)])


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)


@dataclass(frozen=True)
class Forest:
    """Trees as a table (fit, tree, feature, cut, value) and the bin edges of each part."""

    table: DataFrame
    edges: list[list[np.ndarray]]
    folds: list[Fold]

    def fit(self, number: int) -> ForestFit:
        return ForestFit(self.table.filter(F.col("fit") == number), self.edges[self.folds[number].part])


@dataclass(frozen=True)
class ForestFit:
    """One forest on raw features. A row's probability is the mean over the trees."""

    trees: DataFrame
    edges: list[np.ndarray]

    def _runs(self) -> tuple[int, list[list[int]]]:
        """Number of trees, and (first, last) tree of runs that hold ``SENT_BYTES`` at most, or one tree."""
        size = sum((F.octet_length(c) for c in BLOBS), F.lit(0))
        runs: list[list[int]] = []
        many = total = 0
        for r in self.trees.select("tree", size.alias("size")).orderBy("tree").collect():  # two numbers a tree
            if not runs or total + r["size"] > SENT_BYTES:
                runs.append([r["tree"], r["tree"]])
                total = 0
            runs[-1][1] = r["tree"]
            total += r["size"]
            many += 1
        return many, runs or [[0, -1]]

    def _summed(self, rows: DataFrame, kind: str, start: Callable[[int], np.ndarray], add: Callable[[np.ndarray, list[Tree], list[np.ndarray]], None]) -> DataFrame:
        """``rows`` with their last two columns (arrays of features, the sum so far) replaced by the mean over all trees, of type ``kind``.

        ``add`` adds the shares of trees to the sums of some rows. Trees are sent in runs of bounded size, in their order; the
        sums stay with the rows in between.
        """
        spark, names = rows.sparkSession, rows.columns
        many, runs = self._runs()
        types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2]]
        for i, (first, last) in enumerate(runs):
            got = self.trees.filter(F.col("tree").between(first, last)).orderBy("tree").collect()
            sent = spark.sparkContext.broadcast([tuple(bytes(r[c]) for c in BLOBS) for r in got])
            del got
            end = i == len(runs) - 1

            def work(batches: Iterator[pa.RecordBatch], sent=sent, end=end) -> Iterator[pa.RecordBatch]:
                trees = [Tree.of(*t) for t in sent.value]
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    x, sums = batch.columns[-2:]
                    sums = start(batch.num_rows) if sums.null_count else sums.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).copy()
                    add(sums, trees, x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
                    if end:
                        sums /= max(many, 1)
                    flat = pa.array(sums.ravel())
                    told = flat if end and kind == "double" else pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1, dtype=np.int32) * sums.shape[1]), flat)
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *([] if end else [x]), told], [*names[:-2], *([] if end else names[-2:-1]), names[-1]])

            tail = [f"`{names[-1]}` {kind}"] if end else [f"`{names[-2]}` array<double>", f"`{names[-1]}` array<double>"]
            rows = rows.mapInArrow(work, ", ".join([*types, *tail]))
            if not end:
                rows = stage(rows, "part_scored")
                sent.destroy()
        return rows

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        """Add the probability."""
        edges = self.edges

        def add(sums: np.ndarray, trees: list[Tree], x: np.ndarray) -> None:
            bins = _binned(x, edges)
            for t in trees:
                sums[:, 0] += t.leaves(bins)

        rows = df.select("*", F.array(*[F.col(f).cast("double") for f in FEATURES]).alias("_x"), F.lit(None).cast("array<double>").alias(out))
        return self._summed(rows, "double", lambda n: np.zeros((n, 1)), add)

    def score_borrowed(self, df: DataFrame, own: str, other: str, out: str = "p") -> DataFrame:
        """Replace ``own`` and ``other``, the features of a row and of its donor, by an array: for each feature the probability
        of the row with that feature alone from the donor. A row's way through a tree is found once for all features."""
        edges, k = self.edges, len(FEATURES)

        def add(sums: np.ndarray, trees: list[Tree], x: np.ndarray) -> None:
            bins, borrowed = _binned(x[:, :k], edges), _binned(x[:, k:], edges)
            for t in trees:
                sums += t.borrowed(bins, borrowed)

        rows = df.select(*[c for c in df.columns if c not in (own, other)], F.concat(own, other).alias("_x"), F.lit(None).cast("array<double>").alias(out))
        return self._summed(rows, "array<double>", lambda n: np.zeros((n, k)), add)


def _packed(part: DataFrame, edges: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, labels, folds) of a part of bounded size, in the order of its rows' keys."""
    k = len(edges)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            rest = [batch.column(c).to_numpy(zero_copy_only=False).astype(t).tobytes() for c, t in (("key", np.int64), ("y", np.uint8), ("fold", np.int16))]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (_binned(x, edges).tobytes(), *rest)], ["x", "key", "y", "fold"])

    fold = F.col("fold").cast("int") if "fold" in part.columns else F.lit(0)
    rows = part.select(F.array(*[F.col(f).cast("double") for f in FEATURES]).alias("x"), F.xxhash64("fips", "year").alias("key"),
                       F.col("y").cast("int").alias("y"), fold.alias("fold"))
    # FOREST_ROWS rows of 27 bytes at most, a partition at a time.
    held: dict[str, list[np.ndarray]] = {"x": [], "key": [], "y": [], "fold": []}
    kinds = {"x": np.uint8, "key": np.int64, "y": np.uint8, "fold": np.int16}
    for r in rows.mapInArrow(pack, "x binary, key binary, y binary, fold binary").toLocalIterator():
        for name, kind in kinds.items():
            held[name].append(np.frombuffer(bytes(r[name]), kind))

    def column(name: str) -> np.ndarray:
        found = held.pop(name)
        return np.concatenate(found) if found else np.zeros(0, kinds[name])

    order = np.argsort(column("key"), kind="stable")
    return column("x").reshape(-1, k)[order], column("y")[order], column("fold")[order]


def grow(parts: Sequence[DataFrame], folds: Sequence[Fold], trees: int = TREES, max_rows: int = FOREST_ROWS) -> Forest:
    """A forest for each of ``folds``: all their trees are grown in one job.

    ``parts`` have fips, year, y, the features and, unless all rows may be drawn, fold. A part above ``max_rows`` gives
    about so many rows, drawn by a hash of their key. A tree rests on the seed, its fit and its number, not on cores or files.
    """
    spark = parts[0].sparkSession
    data, edges = [], []
    for part in parts:
        share = max_rows / max(part.count(), max_rows)
        kept = part.filter(F.pmod(F.xxhash64(F.lit(SEED), "fips", "year"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
        cuts = F.array(*[F.percentile_approx(f, [i / BINS for i in range(1, BINS)], 10_000).alias(f) for f in FEATURES])
        row = kept.agg(cuts.alias("q")).first()
        edges.append([np.unique(np.array(q if q is not None else [], np.float64)) for q in row["q"]])
        data.append(_packed(kept, edges[-1]))
    sent = spark.sparkContext.broadcast(data)
    fit_of = [(f.part, f.held) for f in folds]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for unit in batch.column(0).to_pylist():
                number, tree = divmod(unit, trees)
                part, held = fit_of[number]
                bins, y, fold = sent.value[part]
                mine = np.flatnonzero(fold != held)
                rng = np.random.default_rng([SEED, part, held + 1, tree])
                weight = np.zeros(len(y), np.int32)
                if len(mine):
                    weight += np.bincount(mine[rng.integers(0, len(mine), len(mine))], minlength=len(y)).astype(np.int32)
                rows.append((number, tree, *grow_tree(bins, y, weight, rng).blobs()))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[2:]]],
                                             ["fit", "tree", *BLOBS])

    units = len(folds) * trees
    tasks = max(1, -(-units // TREES_PER_TASK))
    table = spark.range(0, units, 1, tasks).mapInArrow(work, "fit int, tree int, feature binary, cut binary, value binary")
    return Forest(stage(table, "trees"), edges, list(folds))
