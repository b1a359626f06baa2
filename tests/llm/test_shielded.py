"""Columns of the user with the operators' own names, with dots, and maps come back unchanged from every stage."""

import pytest
from pyspark.sql import functions as F

from siteplan.llm import decontam, langid, merkle, minhash, toxicity

NAMES = ["_id", "_hash", "_none", "_salt", "_text_hash", "_g", "_to", "_pieces", "_one", "_row", "group", "node", "score", "a.b", "Component"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = (spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 4000").limit(120)
            .withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in NAMES if "." not in n}))
    rows = rows.withColumn("a.b", F.lit("dotted")).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"), F.lit("j"), F.lit(1).cast("long")))
    return rows.withColumn("s", F.struct(F.col("m").alias("inner"), F.lit(1).alias("x"))).cache()


def stages(spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    return {"language": langid.in_language, "toxicity": lambda d: toxicity.without_toxic(d, labels),
            "near_duplicates": minhash.distinct_documents, "decontamination": lambda d: decontam.clean(d, items)}


@pytest.mark.parametrize("name", ["language", "toxicity", "near_duplicates", "decontamination"])
def test_columns_come_back_unchanged(spark, docs, name):
    out = stages(spark)[name](docs)
    assert out.dtypes == docs.dtypes
    before = {r["doc_id"]: r.asDict(True) for r in docs.collect()}
    after = out.collect()
    assert 0 < len(after) <= len(before) and all(before[r["doc_id"]] == r.asDict(True) for r in after)
    bare = stages(spark)[name](docs.select("doc_id", "text", "lang", "source", "n_chars"))
    assert sorted(r["doc_id"] for r in bare.collect()) == sorted(r["doc_id"] for r in after)


def test_repeated_rows_with_maps_are_told_apart_by_content_only(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = spark.createDataFrame([(1, text, {"a": 1, "b": 2}), (1, text, {"b": 2, "a": 1}), (2, text, None)], "doc_id long, text string, m map<string,int>")
    assert [r["m"] for r in minhash.distinct_documents(rows).collect()] == [{"a": 1, "b": 2}]


def test_next_row_keeps_the_users_columns(docs):
    got = merkle.with_next(docs, "doc_id", ["text", "_g"])
    assert got.columns == [*docs.columns, "next_text", "next__g"]
    rows = sorted(got.collect(), key=lambda r: -r["doc_id"])
    for r, ahead in zip(rows, [*rows[1:], rows[0]], strict=True):
        assert (r["next_text"], r["next__g"]) == (ahead["text"], ahead["_g"]) and r["_to"] == f"_to of {r['doc_id']}"
