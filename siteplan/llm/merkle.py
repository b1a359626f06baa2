"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections.

Leaves are sentence pieces of a text (cut after . ! ? and line ends, nothing is dropped), paragraphs end
with a line, sections end at a blank line or at a paragraph whose last leaf hash begins with 0 or 1, so that
an insertion moves section borders only near by. A node is the SHA-256 of its children's digests. The
fingerprint is ``root:section=leaves|section=leaves``: the whole root, 10 hex digits per section and leaf,
paragraphs separated by ``;`` and leaves by ``,``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP_ROWS = 500
MAX_GROUPS = 65_536


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of a column. A null counts as an empty text, whose tree has a root and no leaf."""
    def end(p: Column, digest: Column) -> Column:
        line = p.endswith("\n")
        section = line & ((p == "\n") | digest.substr(1, 1).isin("0", "1"))
        return F.when(section, F.lit("|")).when(line, F.lit(";")).otherwise(F.lit(","))

    pieces = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"(?<=\n)|(?<=[.!?])(?!\n)", -1), lambda p: p != "")
    step = df.withColumn("_pieces", pieces)
    step = step.withColumn("_digests", F.transform("_pieces", lambda p: F.sha2(p, 256)))
    step = step.withColumn("_leaves", F.zip_with("_pieces", "_digests", lambda p, d: F.concat(d, end(p, d))))
    step = step.withColumn("_full", F.split(F.array_join("_leaves", ""), r"\|", -1))
    step = step.withColumn("_short", F.split(F.array_join(F.transform(
        "_leaves", lambda x: F.concat(x.substr(1, 10), x.substr(65, 1))), ""), r"\|", -1))
    node = F.transform("_full", lambda s: F.sha2(F.array_join(
        F.transform(F.split(s, ";"), lambda p: F.sha2(p, 256)), ""), 256))
    step = step.withColumn("_sections", F.when(F.size("_leaves") == 0, F.array().cast("array<string>")).otherwise(node))
    return (step.withColumn(out, F.concat(F.sha2(F.array_join("_sections", ""), 256), F.lit(":"), F.array_join(
        F.zip_with("_sections", "_short", lambda s, x: F.concat(s.substr(1, 10), F.lit("="), x)), "|")))
            .drop("_pieces", "_digests", "_leaves", "_full", "_short", "_sections"))


def root(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, ":", 1)


def leaves(fingerprint: Column) -> Column:
    """Distinct leaf hashes."""
    bare = F.regexp_replace(F.substring_index(fingerprint, ":", -1), r"[0-9a-f]{10}=", "")
    return F.array_distinct(F.filter(F.split(bare, r"[,;|]"), lambda x: x != ""))


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Dice share of common leaves of two fingerprint columns: 1 for equal roots, 0 if nothing or only one is empty."""
    step = df.withColumn("_a", leaves(F.col(a))).withColumn("_b", leaves(F.col(b)))
    both = F.size("_a") + F.size("_b")
    share = F.when(both == 0, F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect("_a", "_b")) / both)
    return step.withColumn(out, F.when(root(F.col(a)) == root(F.col(b)), F.lit(1.0)).otherwise(share)).drop("_a", "_b")


def changed_sections(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections of ``a`` whose branch does not occur in ``b``: where the texts differ."""
    mine = F.split(F.substring_index(a, ":", -1), r"\|")
    other = F.split(F.substring_index(b, ":", -1), r"\|")
    return F.filter(F.transform(mine, lambda s, i: F.when(~F.array_contains(other, s), i)), lambda i: i.isNotNull())


def with_next(df: DataFrame, key: str, carry: list[str]) -> DataFrame:
    """Add ``next_<c>`` for each ``c`` of ``carry``: its value in the row of the next smaller ``key``.

    After the last row comes the first. Equal keys follow in the order of their row hash; null keys come last.
    Groups are cut at keys that occur (quantiles), about 500 rows each and 65,536 groups at most; the row at
    a cut also goes to the group above it as a guest. So every row is shuffled once.
    """
    names = df.columns
    inner = {c: f"_user_{i}" for i, c in enumerate(names)}
    df, key, carry = df.toDF(*inner.values()), inner[key], [inner[c] for c in carry]
    n = df.count()
    groups = min(MAX_GROUPS, max(1, n // GROUP_ROWS))
    cuts = df.agg(F.percentile_approx(key, [i / groups for i in range(1, groups + 1)], max(10_000, 4 * groups)),
                  F.max(key)).first()
    points = sorted({*(cuts[0] or []), *([cuts[1]] if cuts[1] is not None else [])})
    step = max(1, int(len(points) ** 0.5))
    fine = F.from_json(F.lit(str(points)), "array<bigint>")
    coarse = F.from_json(F.lit(str(points[step - 1::step])), "array<bigint>")
    # Number of cuts below the key, found among every step-th cut first.
    skip = F.size(F.filter(coarse, lambda c: c < F.col(key))) * step
    group = skip + F.size(F.filter(F.slice(fine, skip + 1, step), lambda c: c < F.col(key)))
    top = points[-1] if points else None
    placed = df.withColumn("_group", F.when(F.col(key).isNull(), F.lit(0)).otherwise(group))
    guest_at = F.when(F.col(key) == F.lit(top), F.lit(0)).when(F.array_contains(fine, F.col(key)), F.col("_group") + 1)
    both = (placed.withColumn("_to", F.array_compact(F.array(
        F.struct(F.col("_group").alias("g"), F.lit(False).alias("guest")),
        F.when(guest_at.isNotNull(), F.struct(guest_at.alias("g"), F.lit(True).alias("guest"))))))
        .withColumn("_at", F.explode("_to")).withColumn("_g", F.col("_at.g")).withColumn("_guest", F.col("_at.guest")))
    # A guest of the lowest group is the first row of all: it stands after its last row.
    w = Window.partitionBy("_g").orderBy(F.col("_guest").asc(), F.col(key).desc_nulls_last(),
                                         F.xxhash64(*[F.col(c) for c in carry]).asc(), *[F.col(c) for c in carry])
    packed = F.struct(*carry)
    ahead = F.coalesce(F.lead(packed).over(w), F.first(packed).over(w))
    own = {v: k for k, v in inner.items()}
    return (both.withColumn("_next", ahead).filter(~F.col("_guest"))
            .select(*df.columns, *[F.col(f"_next.{c}").alias(f"_next_{c}") for c in carry]).toDF(*names, *[f"next_{own[c]}" for c in carry]))
