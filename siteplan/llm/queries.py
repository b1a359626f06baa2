"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteplan.llm import (
    attention, audit, decontam, langid, licenses, merkle, minhash, packing, quotes, resampling, sharding, toxicity, urltree)
from siteplan.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ahead = merkle.with_next(merkle.with_fingerprint(docs), "doc_id", ["text", "fingerprint"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = (ahead.withColumn("n_chars", F.char_length("text").cast("long"))
              .withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))))
    both = merkle.with_fingerprint(edited, "edited", "edited_fingerprint")
    liked = merkle.with_likeness(merkle.with_likeness(both, "fingerprint", "edited_fingerprint", "near_edited"),
                                 "fingerprint", "next_fingerprint", "near_next")
    return liked.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next")


@query
def op7_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt into 40 shards whose row counts differ by one at most."""
    text = F.coalesce("text", F.lit(""))
    light = stage(table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")), "shard_rows")
    return sharding.shuffle_rows(light, 40, seed=7).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def tokenizer_files() -> tuple[str, str]:
    """The vocabulary's JSON file and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@query
def op5_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces packed into sequences of 2048."""
    return packing.packed(table(spark, sf_dir, "documents"), *tokenizer_files())


@query
def op6_minhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents (similarity 0.85 of 5-word shingles)."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), (85, 100))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op3_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op8_spaced_seed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the passage's place."""
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@query
def op1_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all pages from their text, markup, address suffix and host; the text model learns from documents."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", langid.markup_text(F.col("html")).alias("text"), langid.markup_language(F.col("html")).alias("declared"),
        langid.host_of(F.col("url")).alias("host"))
    return langid.identify(pages, langid.fit(table(spark, sf_dir, "documents")), ["page_id"])


TOXIC = 0.3


@query
def op2_positive_unlabelled_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return (toxicity.scored(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id")))
            .select("doc_id", "held_out", "score", (F.col("score") >= TOXIC).cast("int").alias("predicted")))


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query
def op9_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages. A page's path ends with its document's number: that document's label is the page's."""
    number = F.regexp_extract(urltree.path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1)
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.when(number != "", number).cast("long").alias("doc_id"))
    found = urltree.filtered(pages.join(labels, "doc_id", "left"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query
def op10_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order without quotes."""
    return quotes.conversations(table(spark, sf_dir, "conversations"))


@query
def op13_causal_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents by the attention model, beside those of the smoothed word model."""
    return attention.scored(table(spark, sf_dir, "documents"), tokenizer_files()[1])


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in all 120 orders, by source."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op11_filter_audit"] = audit.SQL


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark, and the tenth that is drawn."""
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op12_importance_resampling"] = resampling.SQL
