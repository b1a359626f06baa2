import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siteplan.operators import exact, ordering, selection
from siteplan.plans import cost, portfolio, scoring

CAND = "fips string, k int, value double, cost double"


def one_pass(rows, budget):
    """The same rule, one row after the other."""
    spent, taken, out = 0.0, {}, set()
    for f, k, v, c in sorted(rows, key=lambda r: (-r[2] / r[3], r[1], r[0])):
        if k == taken.get(f, 0) + 1 and spent + c <= budget:
            spent += c
            taken[f] = k
            out.add((f, k))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_greedy_equals_one_pass(spark, seed):
    rng = np.random.default_rng(seed)
    # Integer costs, so that sums are exact in any order; values are arbitrary, also within an area.
    rows = [(f"{i:03d}", k, float(rng.integers(1, 400)), float(rng.integers(2, 30))) for i in range(60) for k in (1, 2, 3)]
    rows = [r for r in rows if rng.random() > 0.05]  # holes in some chains
    got = {(r["fips"], r["k"]) for r in selection.select_greedy(spark.createDataFrame(rows, CAND), 300.0).collect()}
    assert got == one_pass(rows, 300.0)


def test_order_budget_and_bound(spark):
    c = spark.createDataFrame([("a", 1, 5.0, 5.0), ("a", 2, 4.0, 5.0), ("b", 1, 3.0, 3.0), ("c", 1, 2.9, 2.0)], CAND)
    picks = selection.select_greedy(c, 10.0).collect()
    assert sum(r["cost"] for r in picks) <= 10.0
    assert selection.budget_bound(c, 10.0).first()["bound"] >= 10.9  # the best possible choice
    gap = selection.greedy_gap(c, 10.0).first()
    assert gap["gap"] >= 0


def test_equal_cost_is_top_n(spark):
    df = spark.createDataFrame([("a", 3.0, 0), ("b", 2.0, 0), ("c", 1.0, 0)], "fips string, v double, own_sites int")
    picks, method = selection.select_sites(scoring.site_options(df, "v", 10.0, 2, 0.5), 25.0)
    assert method.startswith("exact")
    assert {(r["fips"], r["k"]) for r in picks.collect()} == {("a", 1), ("b", 1)}


def test_below_one_site_and_empty(spark):
    c = spark.createDataFrame([("a", 1, 1.0, 5.0)], CAND)
    assert selection.select_sites(c, 4.0)[0].isEmpty()
    assert selection.select_greedy(c, 4.0).isEmpty()
    picks, method = selection.select_sites(c.limit(0), 4.0)
    assert method == "none" and picks.columns == c.columns


def test_decay_counts_existing_sites(spark):
    df = spark.createDataFrame([("a", 10.0, 0), ("b", 10.0, 1)], "fips string, v double, own_sites int")
    got = {(r["fips"], r["k"]): r["value"] for r in scoring.site_options(df, "v", 1.0, 2, 0.5).collect()}
    assert got == {("a", 1): 10.0, ("a", 2): 5.0, ("b", 1): 5.0, ("b", 2): 2.5}
    with pytest.raises(ValueError):
        scoring.site_options(df, "v", 1.0, 2, 0.0)


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(0)
    cols = [of[0] for of in {**scoring.DEMAND, **scoring.SATURATION}.values()]
    pdf = pd.DataFrame(rng.random((6, len(cols))), columns=cols)
    pdf.loc[2, "pop_growth"] = np.nan
    pdf.insert(0, "fips", [f"{i:05d}" for i in range(6)])
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    return scoring.add_components(df)


def test_scores_bounded_and_penalized(scored):
    rows = scoring.score(scored, saturation_penalty=0.0).collect()
    assert all(0 <= r["net_opportunity"] <= 100 and r["net_opportunity"] == pytest.approx(r["future_deployment"]) for r in rows)
    rows = scoring.score(scored, saturation_penalty=1.0).collect()
    assert all(r["future_deployment"] <= r["net_opportunity"] + 1e-9 for r in rows)


def test_zero_weights_raise(scored):
    with pytest.raises(ValueError):
        scoring.score(scored, dict.fromkeys(scoring.DEFAULT_WEIGHTS, 0.0))


def test_site_cost(spark):
    unit = lambda name, **kw: portfolio.Controls(name, scenario=name, **kw).unit_cost()
    assert unit("Base") == pytest.approx(8 * 232_700 + 100_000) and unit("Low") == pytest.approx(8 * 183_116)
    assert unit("Low") < unit("Base") < unit("High") and unit("Base", grant=0.5) == pytest.approx(unit("Base") / 2)
    for bad in ({"ports": 0}, {"grant": 1.0}, {"grant": -0.1}):
        with pytest.raises(ValueError):
            portfolio.Controls(**bad)
    df = spark.createDataFrame([("Base", 8), ("High", 4)], "scenario string, ports int")
    got = {r["scenario"]: r["cost"] for r in cost.site_costs(df, cost.scenario_table(spark), F.col("ports")).collect()}
    assert got == {"Base": pytest.approx(unit("Base")), "High": pytest.approx(unit("High", ports=4))}


def test_economics(spark):
    e = cost.annual_economics(8, 100, F.lit(0.5), F.lit(10.0), 0.1)
    r = spark.range(1).select(*[c.alias(n) for n, c in e.items()]).first()
    assert r["kwh"] == 8 * 100 * 365 and r["gross_margin"] == pytest.approx(r["kwh"] * 0.3)


def test_prefix_sums_by_group(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("b", 1, 5)], "g string, o int, v int")
    got = {(r["g"], r["o"]): r["s"] for r in ordering.prefix_sums(df, [F.col("o").asc()], {"s": "v"}, ["g"]).collect()}
    assert got == {("a", 1): 2, ("a", 2): 5, ("b", 1): 5}


def best_value(rows, budget):
    """The best value over all selections, by trying every number of sites in every area."""
    areas = {}
    for f, k, v, c in sorted(rows):
        chain = areas.setdefault(f, [(0, 0.0)])
        if k == len(chain):
            chain.append((chain[-1][0] + c, chain[-1][1] + v))
    states = {0: 0.0}
    for chain in areas.values():
        new = {}
        for spent, value in states.items():
            for c, v in chain:
                if spent + c <= budget and new.get(spent + c, -1.0) < value + v:
                    new[spent + c] = value + v
        states = new
    return max(states.values())


def random_rows(rng, n, sites=3):
    rows = []
    for i in range(n):
        v = float(rng.integers(5, 100))
        for k in range(1, sites + 1):
            rows.append((f"{i:03d}", k, v * float(rng.choice([0.4, 0.5, 0.6, 1.2])) ** (k - 1), int(rng.integers(3, 30))))
    return [r for r in rows if rng.random() > 0.03]


def test_core_search_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        rows, budget = random_rows(rng, int(rng.integers(2, 12))), int(rng.integers(5, 160))
        areas = {}
        for f, k, v, c in sorted(rows):
            chain = areas.setdefault(f, [(0, 0, 0.0)])
            if k == len(chain):
                chain.append((k, chain[-1][1] + c * exact.MICRO, chain[-1][2] + v))
        rate = float(rng.uniform(0, 5))  # any rate gives a right bound, only the search takes longer
        priced = {f: [v - c * rate / exact.MICRO for _, c, v in chain] for f, chain in areas.items()}
        bound = sum(map(max, priced.values())) + rate * budget
        found = exact.search_core([exact.Area(f, *zip(*chain, strict=True), [max(priced[f]) - p for p in priced[f]]) for f, chain in areas.items()],
                                  budget * exact.MICRO, rate, bound + 1e-6)
        got = sum(areas[f][m][2] for f, m in found.items())
        assert sum(areas[f][m][1] for f, m in found.items()) <= budget * exact.MICRO
        assert got == pytest.approx(best_value(rows, budget))


@pytest.mark.parametrize("seed,n", [(1, 8), (2, 30), (3, 120), (4, 300)])
def test_exact_selection_equals_brute_force(spark, seed, n):
    rng = np.random.default_rng(seed)
    rows, budget = random_rows(rng, n), 6 * n
    cand = spark.createDataFrame([(f, k, v, float(c)) for f, k, v, c in rows], CAND)
    picks, method = selection.select_sites(cand, float(budget), exact=True)
    assert method == "exact (core search)"
    got = picks.collect()
    chains = {}
    for r in got:
        chains.setdefault(r["fips"], set()).add(r["k"])
    assert all(ks == set(range(1, len(ks) + 1)) for ks in chains.values())
    assert sum(r["cost"] for r in got) <= budget and sum(r["value"] for r in got) == pytest.approx(best_value(rows, budget))


def test_exact_selection_gives_up_on_a_large_core_and_keeps_empty_cases(spark):
    rng = np.random.default_rng(9)
    cand = spark.createDataFrame([(f, k, v, float(c)) for f, k, v, c in random_rows(rng, 60)], CAND)
    greedy = selection.select_greedy(cand, 300.0)
    rows, proven = exact.select_exact(cand, 300.0, greedy, core_areas=0)
    assert proven or {tuple(r) for r in rows.collect()} == {tuple(r) for r in greedy.collect()}
    picks, method = selection.select_sites(cand, 1.0, exact=True)
    assert picks.isEmpty() and picks.columns == cand.columns and method.startswith("exact")
