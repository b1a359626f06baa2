"""Importance resampling towards a target corpus, with exact ranks by regular sampling.

Runs of words are hashed into buckets; a bucket's gain is the logarithm of its smoothed share in the target over that in the
documents. A row's weight is the sum of its gains, looked up in one array. Adding a Gumbel noise that rests on the id alone
turns the largest scores into a draw without replacement.

The draw needs exact ranks. Every task sorts its rows (a run) and gives every m-th of them; the sorted samples give regular
splitters; the runs are cut at the splitters and exchanged, so that each segment is merged locally; the counts of the
segments before it turn places in a segment into ranks. Splitters are whole keys with a unique row number, so that ties of
any number are cut too.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteplan.llm.common import BLOCK, blocks, fold_table, raw_texts, word_spans
from siteplan.session import stage

WORD_BYTES = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
BUCKETS, SEED, LEAST = 10_000, 2024, 20
LONG = 64  # bytes of a run above which it is hashed by itself
SEGMENT_ROWS, MOST_SEGMENTS, SAMPLES = 100_000, 4096, 16
NO_ID = np.iinfo(np.int64).max


def _crc_table() -> np.ndarray:
    """One step of the usual reflected 32-bit code for each byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(0xEDB88320), out >> np.uint32(1))
    return out.astype(np.uint32)


def crcs(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of the spans of the bytes ``b``, all spans a byte at a time."""
    size = ends - starts
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    at, size = starts[order], size[order]
    code = np.full(len(at), 0xFFFFFFFF, np.uint32)
    far = int(np.searchsorted(-size, -LONG, side="left"))  # spans longer than LONG come first
    for k in range(min(int(size[far]) if far < len(size) else 0, LONG)):
        n = int(np.searchsorted(-size, -k, side="left"))
        code[far:n] = table[(code[far:n] ^ b[at[far:n] + k]) & np.uint32(0xFF)] ^ (code[far:n] >> np.uint32(8))
    code ^= np.uint32(0xFFFFFFFF)
    for i in range(far):
        code[i] = zlib.crc32(b[at[i]:at[i] + size[i]].tobytes())
    out = np.empty_like(code)
    out[order] = code
    return out


def _text_runs(codes: np.ndarray, longest: int, table: np.ndarray, carry: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word each run ends at, its crc) of runs of 1 to ``longest`` words of a block of byte codes; ``carry`` holds the last words of the block before."""
    starts, ends = word_spans(codes)
    old = len(carry)
    if longest > 1:
        words = [*carry, *(codes[s:e] for s, e in zip(starts, ends, strict=True))]
        carry[:] = words[max(0, len(words) - longest + 1):]
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        blank = np.array([0x21], codes.dtype)  # a code is 1 + the byte
        codes = np.concatenate([x for w in words for x in (w, blank)])
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = ends - [len(w) for w in words]
    b = (codes - (codes > 0)).astype(np.uint8)
    last, code = [], []
    for k in range(1, longest + 1):
        n = len(starts) - k + 1
        if n > 0:
            keep = slice(max(0, old - k + 1), n)
            last.append(np.arange(n)[keep] + k - 1)
            code.append(crcs(b, starts[:n][keep], ends[k - 1:][keep], table))
    return (np.concatenate(last), np.concatenate(code)) if last else (np.zeros(0, np.int64), np.zeros(0, np.uint32))


def bucket_runs(texts: Iterator[np.ndarray], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, bucket) of all features, a block of texts at a time; very long texts come in several blocks."""
    codes_of, table = fold_table(words=WORD_BYTES), _crc_table()
    blank = np.zeros(1, np.uint8)
    held: list[np.ndarray] = []
    size, first, i = 0, 0, -1

    def together() -> tuple[np.ndarray, np.ndarray]:
        # The byte 0 is no word byte: it parts the texts.
        raw = np.concatenate([x for t in held for x in (t, blank)])
        stop = np.cumsum([len(t) + 1 for t in held])
        starts, ends = word_spans(codes_of[raw])
        b = (codes_of[raw] - 1).astype(np.uint8)
        return np.searchsorted(stop, starts, side="right") + first, crcs(b, starts, ends, table)

    for i, raw in enumerate(texts):
        if longest == 1 and len(raw) <= BLOCK:
            if held and size + len(raw) > BLOCK:
                row, code = together()
                yield row, (code % np.uint32(buckets)).astype(np.int64)
                held, size = [], 0
            if not held:
                first = i
            held.append(raw)
            size += len(raw)
            continue
        if held:
            row, code = together()
            yield row, (code % np.uint32(buckets)).astype(np.int64)
            held, size = [], 0
        carry: list[np.ndarray] = []
        for _, b in blocks(raw, codes_of):
            _, code = _text_runs(b, longest, table, carry)
            yield np.full(len(code), i), (code % np.uint32(buckets)).astype(np.int64)
    if held:
        row, code = together()
        yield row, (code % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """Features of all rows by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, at in bucket_runs(raw_texts(batch.column(0)), longest, buckets):
                n += np.bincount(at, minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = (texts.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # a row for each bucket
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of each bucket's log ratio of smoothed shares, rounded down."""
    k = float(len(documents))
    s, t = documents.astype(np.float64), target.astype(np.float64)
    big_s, big_t = float(documents.sum()) + k, float(target.sum()) + k
    return np.array([math.floor(1000 * math.log((b + 1) * big_s / ((a + 1) * big_t))) for a, b in zip(s, t, strict=True)], np.int64)


def noise(key: Column, seed: int = SEED) -> Column:
    """Whole thousandths of a Gumbel number that rests on the key alone; a null key is an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """(doc_id, n_features, weight): the sum of ``gain`` over a row's features."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, w = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for row, at in bucket_runs(raw_texts(batch.column(1)), longest, len(sent.value)):
                n += np.bincount(row, minlength=len(batch))
                np.add.at(w, row, sent.value[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(w)], ["doc_id", "n_features", "weight"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(weigh, "doc_id long, n_features long, weight long"))


KEY = np.dtype([("a", "<i8"), ("b", "<i8"), ("c", "<i8")])


def exact_ranks(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Add ``rank`` from 1: falling score, then rising doc_id (a null one last), then the row number ``row``.

    ``rows`` is a written table, so that both readings see the same runs. The driver sees the samples (about 16 for each of
    4,096 segments at most, and one for each run) and a count for each segment.
    """
    n = rows.count()
    segments = max(1, min(MOST_SEGMENTS, -(-n // segment_rows)))
    step = max(1, n // (segments * SAMPLES))
    key = [(-F.col("score")).alias("_a"), F.coalesce("doc_id", F.lit(int(NO_ID))).alias("_b"), F.col("row").alias("_c")]

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = np.arange((step // 2 - seen) % step, len(batch), step)
            seen += len(batch)
            yield batch.take(pa.array(at))

    runs = rows.select(*key).sortWithinPartitions("_a", "_b", "_c")
    got = runs.mapInArrow(sample, "_a long, _b long, _c long").collect()
    keys = np.sort(np.array([tuple(r) for r in got], KEY))
    splitters = keys[[len(keys) * i // segments for i in range(1, segments)]] if len(keys) else keys

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.empty(len(batch), KEY)
            for name, column in zip("abc", batch.columns[-3:], strict=True):
                k[name] = column.to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(np.searchsorted(splitters, k, side="right"), pa.int32())],
                                             [*batch.schema.names[:-3], "_segment"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = stage(rows.select("*", *key).mapInArrow(cut, types + ", _segment int"), "segments")
    before, counts = 0, []
    for r in dealt.groupBy("_segment").count().orderBy("_segment").collect():  # a row for each segment
        counts.append((r["_segment"], before))
        before += r["count"]
    offsets = rows.sparkSession.createDataFrame(counts, "_segment int, _before long")
    place = F.row_number().over(Window.partitionBy("_segment").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row"))
    return (dealt.withColumn("rank", place.cast("long")).join(F.broadcast(offsets), "_segment")  # as above
            .withColumn("rank", F.col("rank") + F.col("_before")).drop("_segment", "_before"))


def resampled(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, share: tuple[int, int] = (10, 100),
              least: int = LEAST, seed: int = SEED, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): all rows of ``docs`` (doc_id, text), drawn ones with their rank.

    Of the N rows with ``least`` features or more, the floor(share * N) largest scores are drawn, equal scores by smaller
    doc_id. ``target`` has a column text. A null text has no features; a null doc_id is hashed as an empty one and ranks
    behind equal scores. Repeated rows are rows of their own, with equal scores and neighbouring ranks. An empty ``docs``
    gives an empty result; an empty ``target`` gives every bucket the same share.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = stage(weighed(docs, gain, longest).withColumns({"score": F.col("weight") + noise(F.col("doc_id"), seed),
                                                          "row": F.monotonically_increasing_id()}), "weighed")
    able = F.col("n_features") >= least
    n = rows.filter(able).count()
    drawn = n * share[0] // share[1]
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = exact_ranks(rows.filter(able), segment_rows).select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return ranked.unionByName(rows.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


SQL = r"""with tab as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda c, x: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
  words as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from documents),
  target as (select unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from benchmark),
  distinct_words as (select w, hex(encode(w)) as h from (select w from words union select w from target) q),
  codes as (select w, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(h) // 2),
      lambda i: (16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket from distinct_words cross join tab),
  s as (select bucket, count(*) as n from words join codes using (w) group by bucket),
  t as (select bucket, count(*) as n from target join codes using (w) group by bucket),
  total as (select (select coalesce(sum(n), 0) from s)::double as s, (select coalesce(sum(n), 0) from t)::double as t),
  gain as (select bucket, floor(1000 * ln((coalesce(t.n, 0)::double + 1) * (total.s + 10000) / ((coalesce(s.n, 0)::double + 1) * (total.t + 10000))))::bigint as g
    from s full join t using (bucket) cross join total),
  weights as (select doc_id, count(*) as n_features, sum(g)::bigint as weight from words join codes using (w) join gain using (bucket) group by doc_id),
  scores as (select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
    from documents left join weights using (doc_id)),
  ranks as (select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from scores where n_features >= 20)
  select doc_id, n_features, weight, score, case when r <= 10 * n // 100 then r end as rank from scores left join ranks using (doc_id)"""
