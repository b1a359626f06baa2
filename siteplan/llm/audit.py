"""How filters interact: for every order of the filters, what each one removes, what another had removed before, and what
good or toxic rows it costs.

A row's failures are bits. Filters that look at one text are Column expressions; the last one, an exact copy of a text with
a smaller id, is an existential self-join. Counts by combination of bits, a few for each part, then give all orders: what
a filter removes after others depends on the set of the earlier ones only.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteplan.llm.common import lookup
from siteplan.session import stage

BITS = 25  # the filter of repeated hashes has two to this power bits, 4 MB
HOT_PARTS = 64
BLANKS = "[\\x20\\x09-\\x0D]+"


def text_failures(text: Column) -> dict[str, Column]:
    """The filters of one text, true where it fails."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    return {"A": F.size(words) < 50,
            "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.char_length(text),
            "D": text.rlike("[#$%&*|]")}


def _bit_map(hashes: DataFrame, column: str) -> DataFrame:
    """(bucket, bits): a bit for each hash modulo ``2 ** BITS``; about a thousand rows of 4 kB whatever the input."""
    place = F.pmod(F.col(column), F.lit(1 << BITS))
    return (hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")))


def _may_hold(df: DataFrame, bit_map: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose hash has its bit set."""
    place = F.pmod(F.col(column), F.lit(1 << BITS))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (df.withColumn("bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bit_map), "bucket")  # 4 MB, see above
            .filter(F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1).drop("bucket", "bits"))


def copies_of_smaller(texts: DataFrame, hashes: DataFrame) -> DataFrame:
    """Distinct (doc_id, h) of the rows of ``texts`` (doc_id, h, text) whose text has a smaller doc_id too.

    Only texts whose hash comes twice in ``hashes`` (h) are moved; they are written first, as the planner would otherwise
    put the semi-join before the filter. Of a group of equal texts the smallest id stands on the right side. A group above a
    thousandth of all rows, of which there can be a thousand, is split into parts on the left.
    """
    twice = stage(hashes.groupBy("h").count().filter("count > 1"), "twice")
    hot = F.broadcast(twice.filter(F.col("count") > hashes.count() / 1000).select("h", F.lit(HOT_PARTS).alias("parts")))  # 1000 rows
    some = stage(_may_hold(texts.filter("doc_id is not null"), _bit_map(twice, "h"), "h").join(hot, "h", "left")
                 .withColumn("parts", F.coalesce("parts", F.lit(1))), "candidates")
    first = (some.groupBy("h", "text").agg(F.min("doc_id").alias("first"), F.max("parts").alias("parts"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    spread = some.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("h", "part", "text")]
    return (spread.alias("l").join(first.hint("merge").alias("r"), same[0] & same[1] & same[2] & (F.col("r.first") < F.col("l.doc_id")), "left_semi")
            .select("doc_id", "h").distinct())


def combinations(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """(part, good, toxic, bits, n): rows by combination of failures; and the filters' letters, in the order of their bits."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    fails = text_failures(F.col("text"))
    letters = [*fails, "E"]
    bits = sum((F.shiftleft(c.cast("int"), i) for i, c in enumerate(fails.values())), F.lit(0))
    light = stage(source.select("doc_id", "part", F.xxhash64("text").alias("h"), bits.alias("bits"), F.monotonically_increasing_id().alias("row")), "audit")
    copies = stage(copies_of_smaller(source.select("doc_id", F.xxhash64("text").alias("h"), "text"), light.select("h")), "copies")
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = lookup(light, marks, ["doc_id"], [F.col("row")], shuffled=True)
    failed = (known.select("row", "part", "good", "toxic", "bits")
              .unionByName(light.join(copies.hint("merge"), ["doc_id", "h"], "left_semi").select("row", F.lit(1 << len(fails)).alias("bits")), allowMissingColumns=True))
    each = failed.groupBy("row").agg(F.max("part").alias("part"), F.coalesce(F.max("good"), F.lit(0)).alias("good"),
                                     F.coalesce(F.max("toxic"), F.lit(0)).alias("toxic"), F.sum("bits").cast("int").alias("bits"))
    return each.groupBy("part", "good", "toxic", "bits").agg(F.count("*").alias("n")), letters


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    A row per source of ``docs`` (doc_id, source, text), order of the filters and step. A null text is empty, a null source
    is "". Repeated rows count as often as they come. A row without an id is no copy and makes no copies; neither is a
    repeated row of the same id. A label counts if any row of ``labels`` (doc_id, quality, toxic) with the id has it; rows
    without an id have none. An empty table gives an empty result.
    """
    combos, letters = combinations(docs, labels)
    combos = stage(combos, "combinations")
    k = len(letters)
    # Every filter after every set of the others: 80 cells of five filters.
    cells = combos.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(k * 2**k - 1)))).select(
        "*", F.expr(f"shiftleft(1, cast(cell div {2**k} as int))").alias("own"), (F.col("cell") % 2**k).alias("before"))
    cells = cells.filter(F.col("own").bitwiseAND(F.col("before")) == 0)
    fails, late = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0

    def count(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))

    here = fails & ~late
    table = cells.groupBy("part", "own", "before").agg(
        count(~fails & ~late).alias("kept"), count(here).alias("removed"), count(fails & late).alias("redundant"),
        count(F.col("bits") == F.col("own")).alias("unique_fails"), count(here & (F.col("good") == 1)).alias("good_lost"),
        count(here & (F.col("toxic") == 1)).alias("toxic_lost"))
    size = F.bit_count("before")
    orders_of = F.element_at(F.array(*[F.lit(factorial(i) * factorial(k - 1 - i)) for i in range(k)]), size + 1)
    shapley = table.groupBy("part", "own").agg(F.sum(F.col("removed") * orders_of).alias("shapley"))
    rows = []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(letters[i] for i in order), step, 1 << f, before))
            before |= 1 << f
    orders = docs.sparkSession.createDataFrame(rows, "filter_order string, step int, own int, before int")
    return (table.join(shapley, ["part", "own"]).join(F.broadcast(orders), ["own", "before"])  # as many rows as the filters have orders
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


SQL = r"""with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
  w as (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from d),
  l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
  f as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    case when len(ws) < 50 then 1 else 0 end | case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 2 else 0 end
    | case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 4 else 0 end
    | case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
    | case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as bits from w left join l using (doc_id)),
  c as (select part, good, toxic, bits, count(*) as n from f group by all),
  x as (select unnest(['A', 'B', 'C', 'D', 'E']) as s, unnest([1, 2, 4, 8, 16]) as b),
  o as (select a.s || b.s || c.s || d.s || e.s as filter_order, [a.b, b.b, c.b, d.b, e.b] as bs from x a join x b on b.s <> a.s
    join x c on c.s not in (a.s, b.s) join x d on d.s not in (a.s, b.s, c.s) join x e on e.s not in (a.s, b.s, c.s, d.s)),
  p as (select filter_order, step, bs[step] as own, coalesce(list_sum(bs[1:step - 1]), 0)::bigint as before from o, (select unnest([1, 2, 3, 4, 5]) as step) q),
  r as (select part, filter_order, step, own, coalesce(sum(n) filter (where bits & (own | before) = 0), 0) as kept,
    coalesce(sum(n) filter (where bits & before = 0 and bits & own <> 0), 0) as removed,
    coalesce(sum(n) filter (where bits & before <> 0 and bits & own <> 0), 0) as redundant,
    coalesce(sum(n) filter (where bits = own), 0) as unique_fails,
    coalesce(sum(n) filter (where bits & before = 0 and bits & own <> 0 and good = 1), 0) as good_lost,
    coalesce(sum(n) filter (where bits & before = 0 and bits & own <> 0 and toxic = 1), 0) as toxic_lost from c cross join p group by all)
  select part, filter_order, cast(step as int) as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
    unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
    (sum(removed) over (partition by part, own))::bigint as shapley from r"""
