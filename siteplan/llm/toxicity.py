"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; everything else, labelled or not, is unlabelled text in which a share ``prior``
is toxic. Linear classifiers on distinct word and word-prefix features are trained with numpy on the risk
``prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])``, which corrects the unlabelled part for the
positives in it and never lets it fall below zero. The score is the mean probability of several classifiers, each with
its own part of the unlabelled sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteplan.llm.common import blocks, fold_table, mix, raw_texts, row_key, shielded, without, word_spans

WORD_BYTES = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
FEATURE_BITS = 22
PREFIXES = (3, 4, 5, 6)
WHOLE = 16  # bytes of a word that the word feature reads
POSITIVES, UNLABELLED = 10_000, 30_000  # rows of the fitting sample, at most
LEAST_ROWS, LEAST_LIFT, FEATURES = 8, 2.5, 20_000
MODELS, STEPS, RATE, DECAY = 3, 300, 0.1, 1e-4


def features(raw: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Feature numbers of all words of a text, with repeats: the word's first 3 to 6 bytes, and the word."""
    out = []
    for _, b in blocks(raw, codes):
        starts, ends = word_spans(b)
        if not len(starts):
            continue
        b = np.concatenate([b - 1, np.zeros(WHOLE, np.uint64)])
        size = ends - starts
        head = np.zeros(len(starts), np.uint64)
        tail = np.zeros(len(starts), np.uint64)
        for k in range(WHOLE):
            byte = np.where(size > k, b[starts + k], np.uint64(0))
            if k < 8:
                head |= byte << np.uint64(8 * k)
            else:
                tail |= byte << np.uint64(8 * (k - 8))
            if k + 1 in PREFIXES:
                out.append(mix((head[size > k] + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)))
        out.append(mix(head * np.uint64(0x9E3779B97F4A7C15) + mix(tail + np.uint64(77))))
    return (np.concatenate(out) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64) if out else np.zeros(0, np.int64)


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def bytes_of(numbers: np.ndarray) -> bytes:
    return np.asarray(numbers, ">i4").tobytes()


@dataclass
class Model:
    """Weights by feature number, mean over the classifiers being taken of probabilities."""
    weights: np.ndarray  # (2 ** FEATURE_BITS,): place of a feature among the chosen ones, or -1
    table: np.ndarray  # (chosen features + 1, classifiers); the last row holds the intercepts
    prior: float

    def score(self, raw: np.ndarray, codes: np.ndarray) -> float:
        at = self.weights[features(raw, codes)]
        at = np.unique(at[at >= 0])
        z = self.table[-1] + self.table[at].sum(axis=0)
        return float((1 / (1 + np.exp(-np.clip(z, -40, 40)))).mean())


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float, seed: int) -> np.ndarray:
    """Weights of the ``size`` features and the intercept, by gradient steps on the non-negative risk."""
    def sparse(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), (np.concatenate(rows) if rows else np.zeros(0, np.int64)), max(len(rows), 1)

    rng = np.random.default_rng(seed)
    part = [unlabelled[i] for i in rng.permutation(len(unlabelled))[:max(1, (2 * len(unlabelled)) // 3)]] if unlabelled else []
    p_row, p_col, p_n = sparse(positive)
    u_row, u_col, u_n = sparse(part)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)

    def slope(row: np.ndarray, col: np.ndarray, n: int, g: np.ndarray) -> np.ndarray:
        out = np.empty(size + 1)
        out[:-1] = np.bincount(col, g[row], size)
        out[-1] = g.sum()
        return out / n

    for t in range(1, STEPS + 1):
        zp = np.bincount(p_row, w[p_col], p_n) + w[-1]
        zu = np.bincount(u_row, w[u_col], u_n) + w[-1]
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        # Logistic loss: softplus(-z) for +, softplus(z) for -.
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        rest = slope(u_row, u_col, u_n, su) - prior * slope(p_row, p_col, p_n, sp)
        # A negative part below zero means the unlabelled positives are over-corrected: step back on it.
        grad = prior * slope(p_row, p_col, p_n, sp - 1) + rest if negative >= 0 else -rest
        grad[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    # The intercept at which the unlabelled rows' mean probability is the class prior.
    zu = np.bincount(u_row, w[u_col], u_n)
    low, high = -40.0, 40.0
    for _ in range(60):
        w[-1] = (low + high) / 2
        mean = (1 / (1 + np.exp(-np.clip(zu + w[-1], -40, 40)))).mean()
        low, high = (w[-1], high) if mean < prior else (low, w[-1])
    return w


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, key: str = "doc_id") -> Model:
    """Fit to ``docs`` (key, text) and ``labels`` (key, toxic) outside the held-out part.

    The sample is bounded: the ``positives`` toxic and ``unlabelled`` other ids with the smallest hashes. The class prior
    is the toxic share of all labelled rows learned from. A key with both labels is toxic. Without any positive the
    model scores 0 everywhere.
    """
    known = labels.filter(~held_out(F.col(key)) & F.col("toxic").isNotNull())
    counts = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("int"))).first()
    if not counts[1]:
        return Model(np.full(1 << FEATURE_BITS, -1), np.full((1, 1), -40.0), 0.0)
    prior = min(max(counts[1] / counts[0], 1e-4), 0.5)
    sign = known.filter("toxic = 1").select(F.col(key).cast("long").alias("_id")).distinct()
    sign = F.broadcast(sign.orderBy(F.xxhash64("_id"), "_id").limit(positives))  # bounded by the parameter
    cut = F.xxhash64(F.col(key).cast("long"), F.lit(5))
    free = docs.filter(~held_out(F.col(key)))
    last = free.select(cut.alias("h")).orderBy("h").limit(unlabelled).agg(F.max("h")).first()[0]
    sample = (free.join(sign, F.col(key).cast("long") == F.col("_id"), "left")
              .filter(F.col("_id").isNotNull() | (cut <= F.lit(last)))
              .select(F.col("_id").isNotNull().alias("p"), (cut <= F.lit(last)).alias("u"), F.col("text").cast("string")))

    def count(side: int, only: np.ndarray | None):
        """Rows of one side per feature, and of all its rows at -1; ``only`` marks the features wanted."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, n, rows = fold_table(words=WORD_BYTES), np.zeros(1 << FEATURE_BITS, np.int32), 0
            for batch in batches:
                flag = batch.column(side).to_numpy(zero_copy_only=False)
                for i, raw in enumerate(raw_texts(batch.column(2))):
                    if flag[i]:
                        n[np.unique(features(raw, codes))] += 1
                        rows += 1
            f = np.flatnonzero(n if only is None else n * only)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(f, -1)), pa.array(np.append(n[f], rows).astype(np.int64))], ["f", "n"])

        return sample.filter("pu"[side]).mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n"))

    often = count(0, None).filter((F.col("f") < 0) | (F.col("n") >= LEAST_ROWS)).toPandas().set_index("f")["n"]  # bounded by ``positives``
    wanted = np.zeros(1 << FEATURE_BITS, np.int8)
    wanted[often.index[often.index >= 0].to_numpy()] = 1
    there = count(1, wanted).toPandas().set_index("f")["n"]
    n_sign, n_free = int(often.get(-1, 0)), int(there.get(-1, 0))
    both = often.drop(-1).to_frame("p").assign(u=there).fillna(0).reset_index()
    both["lift"] = (both["p"] / max(n_sign, 1)) / ((both["u"] + 1) / (n_free + 1))
    both = both[both["lift"] >= LEAST_LIFT].assign(rank=lambda x: x["lift"] * np.sqrt(x["p"])).sort_values(["rank", "f"], ascending=[False, True])
    chosen = both["f"].to_numpy(np.int64)[:FEATURES]
    place = np.full(1 << FEATURE_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = fold_table(words=WORD_BYTES)
        for batch in batches:
            found = []
            for raw in raw_texts(batch.column(2)):
                at = place[features(raw, codes)]
                found.append(np.unique(at[at >= 0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["p", "u", "f"])

    rows = sample.mapInArrow(read, "p boolean, u boolean, f array<int>").toPandas()  # bounded by the parameters
    rows = rows.assign(at=rows["f"].map(bytes_of)).sort_values(["p", "u", "at"])  # whatever the order in which tasks end
    pos = [np.asarray(f, np.int64) for f in rows.loc[rows["p"], "f"]]
    un = [np.asarray(f, np.int64) for f in rows.loc[rows["u"], "f"]]
    return Model(place, np.column_stack([train(pos, un, len(chosen), prior, seed) for seed in range(MODELS)]), prior)


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of every row; a null text is scored as an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = fold_table(words=WORD_BYTES)
        for batch in batches:
            s = [sent.value.score(raw, codes) for raw in raw_texts(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(s, pa.float64())], [*keep, "score"])

    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:at])
    return rows.mapInArrow(run, f"{types}, score double")


@shielded("doc_id", "text")
def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) whose score is below ``threshold``."""
    found = scored(docs.select(*row_key(), "text"), fit(docs, labels), ("_id", "_text_hash"))
    return without(docs, found.filter(F.col("score") >= threshold).select("_id", "_text_hash").distinct())
