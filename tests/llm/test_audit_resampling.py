"""Filter audit and importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteplan.llm import audit, resampling

LONG = " ".join(f"word{i}" for i in range(70))
TEXTS = [LONG, LONG, LONG + " #", "short text", "short text", "", None, "A" * 40 + " " + LONG, "same " * 80, LONG.upper(), "é" * 30 + " $", LONG,
         "\t \n", "ABC", " ".join(f"w{i % 30}" for i in range(60))]


def fails(rows):
    """Failing letters of (doc_id, text) rows, plainly."""
    out = []
    for i, t in rows:
        t = t or ""
        w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
        got = ""
        if len(w) < 50:
            got += "A"
        if 100 * len(set(w)) < 65 * len(w):
            got += "B"
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            got += "C"
        if re.search(r"[#$%&*|]", t):
            got += "D"
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u in rows):
            got += "E"
        out.append(set(got))
    return out


def plain_audit(rows, labels):
    """{(part, order, step): counts} for rows (doc_id, text, part)."""
    sets = fails([(i, t) for i, t, _ in rows])
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, x in labels if x == 1} - {None}
    out = {}
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, s) for (i, _, p), s in zip(rows, sets, strict=True) if (p or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                shapley[f] += sum(f in s and not s & set(order[:k]) for _, s in mine)
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                gone = [(i, s) for i, s in mine if f in s and not s & set(order[:k])]
                out[part, order, k + 1] = (
                    sum(not s & set(order[:k + 1]) for _, s in mine), len(gone), sum(f in s and bool(s & set(order[:k])) for _, s in mine),
                    sum(s == {f} for _, s in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), shapley[f])
    return out


def test_audit_equals_brute_force(spark):
    rows = [(k, t, ("a", "b", None)[k % 3]) for k, t in enumerate(TEXTS * 3)]
    rows += [(None, LONG, "a"), (None, "short text", "a"), (3, "short text", "b"), (3, "short text", "b"), (-5, LONG, "c"), (3, LONG, "b")]
    labels = [(0, 1, 0), (1, 1, 1), (3, 0, 1), (3, 1, 0), (8, None, 1), (None, 1, 1), (20, 1, None)]
    docs = spark.createDataFrame([(*r, "x", 1, {"k": 1}) for r in rows], "doc_id long, text string, source string, row string, `a.b` int, bits map<string,int>").repartition(3)
    got = audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == plain_audit(rows, labels)


def test_audit_of_a_large_group_and_of_nothing(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"),
                                    F.when(F.col("id") % 3 == 0, F.lit(LONG)).otherwise(F.concat(F.lit(LONG + " t"), "id")).alias("text"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    row = audit.audit(docs, labels).filter("filter_order = 'EABCD' and step = 1").first()
    assert (row["removed"], row["kept"], row["unique_fails"], row["shapley"]) == (999, 2001, 999, 999 * 120)
    assert audit.audit(docs.limit(0), labels).count() == 0


def test_audit_of_very_long_texts(spark):
    text = "many words " * 200_000
    docs = spark.createDataFrame([(1, text, "s"), (2, text, "s"), (3, text + "x", "s")], "doc_id long, text string, source string")
    rows = audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).filter("filter_order = 'EBACD'").orderBy("step").collect()
    assert [r["removed"] for r in rows] == [1, 2, 0, 0, 0]


# ---- resampling ----------------------------------------------------------------------------

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text, longest, buckets):
    w = WORD.findall((text or "").encode().lower())
    return [zlib.crc32(b" ".join(w[i:i + k])) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain_resampled(rows, target, longest=1, buckets=10_000, share=(10, 100), least=20):
    docs = [plain_buckets(t, longest, buckets) for _, t in rows]
    s = np.bincount([b for d in docs for b in d], minlength=buckets)
    t = np.bincount([b for x in target for b in plain_buckets(x, longest, buckets)], minlength=buckets)
    gain = [math.floor(1000 * math.log((float(b) + 1) * (float(t.sum() * 0 + s.sum()) + buckets) / ((float(a) + 1) * (float(t.sum()) + buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for (i, _), d in zip(rows, docs, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in d)
        out.append([i, len(d), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:len(able) * share[0] // share[1]], 1):
        r[4] = k
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[4] is None, r[4] or 0)


ROWS = [(k, f"The Alpha{k % 13} beta gamma{k % 5} " + " ".join(f"v{(k * j) % 97}é" for j in range(k % 60))) for k in range(400)]
EDGE = [(None, ROWS[59][1]), (None, ROWS[59][1]), (900, None), (901, ""), (902, "-- !"), (7, ROWS[58][1]), (7, ROWS[58][1]), (903, "x" * 3_000_000),
        (904, "tail of many words " * 120_000), (905, "\x00zero\x00bytes " * 30)]
TARGET = ["beta gamma1 v3é v9é", None, "", "Alpha3 alpha3 beta"]


@pytest.mark.parametrize("longest,segment_rows", [(1, 100_000), (1, 40), (2, 64)])
def test_resampling_equals_brute_force(spark, docs, longest, segment_rows):
    rows = ROWS + EDGE
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = resampling.resampled(docs(rows).repartition(5), target, longest, segment_rows=segment_rows)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(([*r] for r in got.collect()), key=key) == sorted(plain_resampled(rows, TARGET, longest), key=key)


def test_ranks_of_ties(spark):
    rows = spark.range(20_000).select(F.lit(5).cast("long").alias("score"), F.when(F.col("id") % 3 > 0, F.lit(1).cast("long")).otherwise(F.col("id")).alias("doc_id"),
                                      F.col("id").alias("row")).repartition(7)
    from siteplan.session import stage
    ranked = resampling.exact_ranks(stage(rows, "ties"), 1000)
    got = ranked.orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 20_001))
    assert [(r["doc_id"], r["row"]) for r in got] == sorted((r["doc_id"], r["row"]) for r in got)


def test_ranks_are_a_permutation(spark):
    from siteplan.session import stage
    rows = stage(spark.range(50_000).select((F.xxhash64("id") % 10).alias("score"), F.col("id").alias("doc_id"), F.col("id").alias("row")).repartition(9), "even")
    n = rows.count()
    ranked = resampling.exact_ranks(rows, 2_000)
    assert ranked.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first() == (1, n, n)


def test_resampling_of_nothing(spark, docs):
    target = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resampled(docs([]), target).count() == 0
    rows = resampling.resampled(docs([(1, "one two")]), target.limit(0)).collect()
    assert [tuple(r)[:2] + (r["rank"],) for r in rows] == [(1, 2, None)]
