"""What near-duplicates and decontamination make the driver do: rounds of the components, seeds sent to all tasks."""

import random

import pytest

from siteplan.llm import decontam, minhash


def plain_components(links):
    up = {x: x for pair in links for x in pair}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {x: root(x) for a, b in links if a != b for x in (a, b)}


def staged(monkeypatch, spark, links):
    """(components, tables written) of the links."""
    written = []
    monkeypatch.setattr(minhash, "stage", lambda df, label, write=minhash.stage: written.append(label) or write(df, label))
    got = {r.node: r.component for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    return got, len(written)


@pytest.mark.parametrize("links", [[], [(7, 7)], [(1, 9), (1, 4), (1, 5), (2, 3)]])
def test_stars_need_no_round(monkeypatch, spark, links):
    got, written = staged(monkeypatch, spark, links)
    assert got == plain_components(links) and written == 1


def test_rounds_end_with_stars(monkeypatch, spark):
    got, written = staged(monkeypatch, spark, [(5, 1), (5, 2), (3, 2), (8, 9)])
    assert got == {5: 1, 1: 1, 2: 1, 3: 1, 8: 8, 9: 8} and written <= 3


def test_components_of_random_links(spark):
    rng = random.Random(4)
    nodes = rng.sample(range(10**6), 150)
    links = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(110)] + list(zip(range(40), range(1, 41), strict=True))
    got = [(r.node, r.component) for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()]
    assert len(got) == len(dict(got)) and dict(got) == plain_components(links)


def test_seeds_are_not_sent_to_all_tasks(monkeypatch, spark, docs):
    plans, lookup = [], decontam.lookup

    def spied(df, table, on, *rest, **more):
        out = lookup(df, table, on, *rest, **more)
        if on == ["hash"]:
            plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(decontam, "lookup", spied)
    words = [f"w{k}" for k in range(20)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    found = decontam.overlaps(docs([(1, "x " + " ".join(words) + " y"), (2, "nothing here")]), items).collect()
    assert [(r.doc_id, r.doc_start, r.n_words) for r in found] == [(1, 1, 20)]
    assert len(plans) == 1 and "Broadcast" not in plans[0]


@pytest.mark.parametrize("module", ["minhash", "audit"])
def test_salted_copies_are_not_sent_to_all_tasks(monkeypatch, spark, docs, module):
    """The planner would take 16 copies of a table for one and send them through the driver."""
    from siteplan.llm import audit
    plans, at = [], {"minhash": minhash, "audit": audit}[module]
    real = at.lookup

    def spied(*args, **more):
        out = real(*args, **more)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(at, "lookup", spied)
    text = " ".join(f"w{k}" for k in range(60))
    rows = docs([(1, text), (2, text + " x"), (3, text + " x y"), (4, "other words " * 30), (5, text)])
    if module == "minhash":
        assert sorted(r.doc_id for r in minhash.distinct_documents(rows).collect()) == [1, 4]
    else:
        labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
        assert audit.audit(rows, labels).filter("step = 1 and filter_order = 'EABCD'").agg({"removed": "sum"}).first()[0] == 1
    joins = [next(line for line in p.splitlines() if "Join" in line) for p in plans]
    assert joins and all("strategy=merge" in j for j in joins)
