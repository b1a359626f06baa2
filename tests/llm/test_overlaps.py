"""Overlaps with benchmark items of every length against a search of all places, and the measured share that seeds find."""

import random
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest

from siteplan.llm import decontam

SHARE = Fraction("0.8")


@pytest.mark.parametrize("n", range(1, 14))
def test_a_mask_ignores_any_substitutions_of_a_whole_item(n):
    masks = decontam.masks_of(n, decontam.LEAST_WORDS, SHARE)
    spare = n - int(np.ceil(n * 0.8 - 1e-9))
    for changed in combinations(range(n), spare):
        assert any(all(mask[k] == "0" for k in changed) for mask in masks)
    assert len(masks) <= 10 and all(len(mask) == n and mask.count("1") >= min(n, 4) for mask in masks)


@pytest.mark.parametrize("n", [14, 15, 16, 17, 18, 19, 20, 25, 30, 40])
def test_share_of_overlaps_that_seeds_find(n):
    rng = np.random.default_rng(n)
    words = rng.integers(1, 2**63, n, dtype=np.uint64)
    _, want = decontam.seeds(words, decontam.masks_of(n, decontam.LEAST_WORDS, SHARE))
    found = 0
    for _ in range(1000):
        other = words.copy()
        at = rng.choice(n, n - int(np.ceil(n * 0.8 - 1e-9)), replace=False)
        other[at] = rng.integers(1, 2**63, len(at), dtype=np.uint64)
        found += bool(np.isin(decontam.seeds(other, decontam.MASKS)[1], want).any())
    assert found >= 930  # 0.95 at 15 words, more at the others; three standard errors below


def best_of_all_places(doc, item):
    """Most equal words of any segment, at any shift, that meets the rule; None without one."""
    best = None
    for shift in range(-len(item) + 1, len(doc)):
        a, b = max(0, shift), min(len(doc), shift + len(item))
        agree = [doc[k] == item[k - shift] for k in range(a, b)]
        for x in range(len(agree)):
            for y in range(x + 1, len(agree) + 1):
                equal = sum(agree[x:y])
                if y - x >= min(13, len(item)) and 5 * equal >= 4 * (y - x) and (best is None or equal > best):
                    best = equal
    return best


def test_short_items_equal_all_places(spark, docs):
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(40)]
    pick = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, pick(n)) for k, n in enumerate([1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 10, 11, 12, 13, 13, 14, 20])]
    rows = []
    for k, words in items:
        for j in range(6):
            changed = list(words)
            for at in rng.sample(range(len(words)), min(len(words), len(words) // 5 + (j == 5))):
                changed[at] = "zz"
            if j == 4:
                changed = changed[:-1]  # cut short
            rows.append((100 * k + j, pick(rng.randrange(25)) + changed + pick(rng.randrange(25))))
    rows += [(9000, list(items[1][1])), (9001, ["zz", *items[4][1]]), (9002, [])]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    texts = docs([(k, " ".join(w)) for k, w in rows])
    got = {(r.doc_id, r.item_id): r for r in decontam.overlaps(texts, bench).collect()}
    want = {(d, k): best for d, doc in rows for k, item in items if (best := best_of_all_places(doc, item)) is not None}
    short = {k for k, w in items if len(w) <= 13}
    assert {p for p in got if p[1] in short} == {p for p in want if p[1] in short}
    assert set(got) <= set(want)
    full = {k: w for k, w in rows}
    for (d, k), r in got.items():
        doc, item = full[d], dict(items)[k]
        equal = sum(x == y for x, y in zip(doc[r.doc_start:r.doc_start + r.n_words], item[r.item_start:r.item_start + r.n_words], strict=True))
        assert (r.n_equal, r.n_doc_words) == (equal, len(doc)) and equal * 5 >= r.n_words * 4
    tainted = {d for (d, k) in want if k in short and (len(dict(items)[k]) >= 5 or len(full[d]) == len(dict(items)[k]))} | {d for d, k in got if k not in short}
    assert {r.doc_id for r in decontam.clean(texts, bench).collect()} == set(full) - tainted
