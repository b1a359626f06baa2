"""Language identification by Bayesian evidence fusion.

Four kinds of evidence give the posterior of a row's language:
- text: naive Bayes on hashed byte trigrams, fitted to a bounded sample of labelled texts. A fifth of each language is
  uniform, so that a foreign passage costs little; the class ``und`` is uniform but for a tenth, and takes text unlike
  every language;
- the declared language (markup or a column): P(declared | language) from soft counts over all rows;
- the address suffix and the host: soft counts per host, domain, suffix and in total, each level smoothed towards
  the next; a country suffix starts from its language. A row's own count is left out of its priors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteplan.llm.common import lookup, raw_texts, row_key, shielded, without
from siteplan.session import stage

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
FIT_ROWS = 8000  # labelled texts that the text model is fitted to, at most
BUCKETS = 1 << 20
LEAST_TEXTS = 3  # texts of a language that must share a trigram, so that one mislabelled text teaches nothing
TEMPER = 1 / 3  # every byte lies in three trigrams
STRENGTH = 20.0  # rows that a level's parent counts for
DECLARED_RIGHT, DECLARED_STRENGTH = 0.9, 50.0

# Country suffixes and their main language.
COUNTRY = {"de": "de", "at": "de", "li": "de", "uk": "en", "us": "en", "ie": "en", "au": "en", "nz": "en", "es": "es", "mx": "es",
           "ar": "es", "cl": "es", "co": "es", "pe": "es", "uy": "es", "fr": "fr", "re": "fr", "mc": "fr"}

# Letters keep their byte (A-Z in lower case), every run of other ASCII counts as one blank.
_codes = np.arange(256, dtype=np.uint32)
_codes[:128] = 32
_codes[97:123] = np.arange(97, 123)
_codes[65:91] = np.arange(97, 123)


def trigrams(raw: np.ndarray) -> np.ndarray:
    """Buckets of the byte trigrams of a text; a text without letters has none."""
    b = _codes[raw]
    if not len(b) or not (b != 32).any():
        return np.zeros(0, np.int64)
    b = b[(b != 32) | np.concatenate([[True], b[:-1] != 32])]
    b = np.concatenate([[np.uint32(32)], b, [np.uint32(32)]]).astype(np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    return ((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)).astype(np.int64)


def fit(labelled: DataFrame, languages: Sequence[str] = LANGUAGES, rows: int = FIT_ROWS) -> np.ndarray:
    """Log probabilities (bucket, language and last ``und``) from labelled texts (columns doc_id, text, lang).

    A trigram counts by the texts that hold it. The sample is the ``rows`` texts with the smallest hashes of id and text. Without any labelled text all
    languages are equal.
    """
    known = labelled.filter(F.col("lang").isin(*languages) & F.col("text").isNotNull()).withColumn("_h", F.xxhash64("doc_id", "text"))
    last = known.select("_h").orderBy("_h").limit(rows).agg(F.max("_h")).first()[0]
    names = list(languages)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), BUCKETS), np.int32)
        for batch in batches:
            found: list[list[np.ndarray]] = [[] for _ in names]
            for raw, lang in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found[names.index(lang)].append(np.unique(trigrams(raw)))
            for k, x in enumerate(found):
                if x:
                    total[k] += np.bincount(np.concatenate(x), minlength=BUCKETS).astype(np.int32)
        k, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[k, b].astype(np.int64))], ["k", "b", "n"])

    counts = np.full((BUCKETS, len(names)), 1e-3)
    if last is not None:
        got = (known.filter(F.col("_h") <= last).select("text", "lang").mapInArrow(count, "k int, b int, n long")
               .groupBy("k", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TEXTS).toPandas())
        counts[got["b"].to_numpy(), got["k"].to_numpy()] += got["n"].to_numpy()
    p = counts / counts.sum(axis=0)
    und = 0.1 * p.mean(axis=1) + 0.9 / BUCKETS
    return np.log(np.column_stack([0.8 * p + 0.2 / BUCKETS, und])).astype(np.float32)


def host_of(url: Column) -> Column:
    """Host in lower case, without user and port; empty without ``://``."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^/?#]*?://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def markup_language(html: Column) -> Column:
    """The lang attribute of the html element, or null."""
    found = F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return F.when(found != "", F.lower(found))


def markup_text(html: Column) -> Column:
    """Text without tags, comments, scripts and styles; what is not closed ends with the page, a lone ``<`` is text."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>|&#?\w+;", " ")


def identify(rows: DataFrame, model: np.ndarray, keys: Sequence[str], languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """(keys..., host, declared, text_lang, lang, confidence), one row per row.

    ``rows`` has the key columns, text, declared and host; null or empty declared and host are missing evidence, a null
    text is empty. A row without letters is ``und`` with confidence 1. ``confidence`` is the posterior of ``lang``.
    """
    names = [*languages, UNKNOWN]
    size = len(names)
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(model)
    at = len(keys)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            like = np.zeros((batch.num_rows, size))
            n = np.zeros(batch.num_rows, np.int64)
            for i, raw in enumerate(raw_texts(batch.column(at))):
                for a in range(0, len(raw), 1 << 20):  # very long texts in steps
                    g = trigrams(raw[a:a + (1 << 20)])
                    n[i] += len(g)
                    like[i] += table[g].sum(axis=0, dtype=np.float64)
            like *= TEMPER
            like -= like.max(axis=1, keepdims=True) if len(like) else 0
            soft = np.exp(like)
            soft /= soft.sum(axis=1, keepdims=True)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, size, dtype=np.int32)), pa.array(x.reshape(-1))) for x in (like, soft)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *batch.columns[at + 1:], pa.array(n), *lists],
                                             [*keys, "declared", "host", "_n_grams", "_like", "_soft"])

    known = F.lower(F.substring(F.trim("declared"), 1, 2))
    light = rows.select(*keys, F.col("text").cast("string"),
                        F.when(F.length(F.trim("declared")) > 0, F.when(known.isin(*languages), known).otherwise("other")).alias("declared"),
                        F.coalesce(F.col("host"), F.lit("")).alias("host"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in light.schema.fields if f.name in keys)
    seen = stage(light.mapInArrow(read, f"{types}, declared string, host string, _n_grams long, _like array<double>, _soft array<double>"), "language_evidence")

    sums = [F.sum(F.col("_soft")[i]).alias(f"_{i}") for i in range(size)]
    packed = F.array(*[f"_{i}" for i in range(size)])
    lettered = seen.filter("_n_grams > 0")

    # P(declared | language): one row per declared value, at most one more than languages.
    told = {r[0]: np.array(r[1]) for r in lettered.filter("declared is not null").groupBy("declared").agg(*sums).select("declared", packed).collect()}
    values = [*languages, "other"]
    start = np.array([[DECLARED_RIGHT if d == x else (1 - DECLARED_RIGHT) / size for x in names] for d in values])
    start[:, -1] = 1 / len(values)
    joint = np.array([told.get(d, np.zeros(size)) for d in values]) + DECLARED_STRENGTH * start / start.sum(axis=0)
    log_declared = np.log(joint / joint.sum(axis=0))

    # Soft counts per host, domain (last two labels), suffix (last label) and in total.
    part = F.split("host", r"\.")
    hosts = stage(lettered.groupBy("host").agg(*sums).withColumn("_own", packed)
                  .withColumn("_part_domain", F.array_join(F.slice(part, F.greatest(F.size(part) - 1, F.lit(1)), 2), "."))
                  .withColumn("_part_suffix", F.element_at(part, -1)).select("host", "_part_domain", "_part_suffix", "_own"), "hosts")

    def level(by: list[str], name: str) -> DataFrame:
        return hosts.groupBy(*by).agg(*[F.sum(F.col("_own")[i]).alias(f"_{i}") for i in range(size)]).select(*by, packed.alias(name))

    total = hosts.agg(*[F.sum(F.col("_own")[i]).alias(f"_{i}") for i in range(size)]).first()
    everything = [float(x or 0) for x in total]
    prior = (lookup(lookup(hosts, level(["_part_domain"], "_in_domain"), ["_part_domain"], [F.col("host")]), level(["_part_suffix"], "_in_suffix"), ["_part_suffix"], [F.col("host")])
             .select("host", "_own", "_in_domain", "_in_suffix", "_part_suffix"))

    def floats(xs: Sequence[float]) -> Column:
        return F.array(*[F.lit(float(x)) for x in xs])

    def toward(counts: Column, parent: Column) -> Column:
        """Counts without the row's own, smoothed to the parent level."""
        rest = F.zip_with(F.coalesce(counts, F.col("_soft")), "_soft", lambda c, q: F.greatest(c - q, F.lit(0.0)))
        n = F.aggregate(rest, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(rest, parent, lambda c, p: (c + STRENGTH * p) / (n + STRENGTH))

    uniform = floats([1 / size] * size)
    country = F.lit(None).cast("array<double>")
    for suffix, lang in COUNTRY.items():
        if lang in languages:
            country = F.when(F.col("_part_suffix") == suffix, floats([0.5 * (x == lang) for x in names])).otherwise(country)
    out = lookup(seen, prior, ["host"], [F.xxhash64(*keys)])
    step = out.withColumn("_all", toward(floats(everything), uniform))
    step = step.withColumn("_tld", F.coalesce(F.zip_with("_all", country, lambda p, c: 0.5 * p + c), F.col("_all")))
    step = step.withColumn("_suffix", toward(F.col("_in_suffix"), F.col("_tld")))
    step = step.withColumn("_domain", toward(F.col("_in_domain"), F.col("_suffix")))
    step = step.withColumn("_host", toward(F.col("_own"), F.col("_domain")))
    claim = floats([0.0] * size)
    for k, d in enumerate(values):
        claim = F.when(F.col("declared") == d, floats(log_declared[k])).otherwise(claim)
    step = step.withColumn("_claim", claim)
    step = step.withColumn("_log", F.zip_with(F.zip_with("_like", F.transform("_host", lambda x: F.log(x)), lambda a, b: a + b), "_claim", lambda a, b: a + b))
    step = step.withColumn("_top", F.array_max("_log"))
    step = step.withColumn("_post", F.transform("_log", lambda x: F.exp(x - F.col("_top"))))
    step = step.withColumn("_sum", F.aggregate("_post", F.lit(0.0), lambda a, x: a + x))
    name = F.array(*[F.lit(x) for x in names])
    none = F.col("_n_grams") == 0
    best = F.array_position("_log", F.col("_top")).cast("int")
    return step.select(*keys, "host", "declared",
                       F.when(none, F.lit(UNKNOWN)).otherwise(F.element_at(name, F.array_position("_like", F.array_max("_like")).cast("int"))).alias("text_lang"),
                       F.when(none, F.lit(UNKNOWN)).otherwise(F.element_at(name, best)).alias("lang"),
                       F.when(none, F.lit(1.0)).otherwise(1 / F.col("_sum")).alias("confidence"))


@shielded("doc_id", "text", "lang", "source")
def in_language(docs: DataFrame, languages: Sequence[str] = LANGUAGES, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source, ...) whose language is one of ``languages``.

    ``lang`` is the declared language and ``source`` the host. Rejected are texts without letters, texts that are like no
    language, and rows whose posterior stays below ``least``. A foreign declared language alone rejects nothing.
    """
    rows = docs.select(*row_key(), "text", F.col("lang").cast("string").alias("declared"), F.col("source").cast("string").alias("host"))
    model = fit(docs.select("doc_id", "text", "lang"), languages)
    found = identify(rows, model, ["_id", "_text_hash"], languages)
    return without(docs, found.filter(~F.col("lang").isin(*languages) | (F.col("confidence") < least)).select("_id", "_text_hash").distinct())
