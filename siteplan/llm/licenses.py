"""License detection by ordered signature rules over normalised words.

A text becomes its words in lower case with single blanks. A rule is a regular expression over that form, with a
keyword that every match contains and a priority (0 is the best). Texts without any keyword stem are never searched;
the others meet only the rules whose keyword they contain. A detection is an interval of words. Of two detections, one
inside the other, the one of better priority stays; with equal priority the outer, and of equal intervals the earlier
rule. Everything is built-in functions: one scan, one shuffle of detections by row, and two sorts.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteplan.llm.common import LOWER, UPPER

# Places that always count, as (label, words).
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

# Licenses as (label, words that a match contains, name, short name after a license tag).
LICENSES = [
    ("apache-2.0", "apache", r"apache (?:software )?license(?: version| v)? ?2(?: 0)?", r"apache 2 0"),
    ("apache-1.1", "apache", r"apache (?:software )?license(?: version| v)? 1 1", r"apache 1 1"),
    ("apache-1.0", "apache", r"apache (?:software )?license(?: version| v)? 1 0", r"apache 1 0"),
    ("mit", "mit", r"(?:the )?mit license", r"mit"),
    ("mit-0", "mit", r"mit no attribution license", r"mit 0"),
    ("x11", "x11", r"(?:mit )?x11 license", r"x11"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) license", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) license", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd|old bsd) license", r"bsd 4 clause"),
    ("0bsd", "bsd", r"(?:zero clause bsd|bsd zero clause) license", r"0bsd"),
    ("isc", "isc", r"isc license", r"isc"),
    ("gpl-3.0", "general public license", r"gnu general public license(?: as published by the free software foundation)?(?: either)? (?:version|v) ?3", r"gpl 3 0(?: only| or later)?"),
    ("gpl-2.0", "general public license", r"gnu general public license(?: as published by the free software foundation)?(?: either)? (?:version|v) ?2", r"gpl 2 0(?: only| or later)?"),
    ("gpl-1.0", "general public license", r"gnu general public license(?: either)? (?:version|v) ?1", r"gpl 1 0(?: only| or later)?"),
    ("lgpl-3.0", "lesser general public license", r"(?:gnu )?lesser general public license (?:version|v) ?3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lesser general public license", r"(?:gnu )?lesser general public license (?:version|v) ?2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-2.0", "library general public license", r"(?:gnu )?library general public license(?: (?:version|v) ?2(?: 0)?)?", r"lgpl 2 0(?: only| or later)?"),
    ("agpl-3.0", "affero general public license", r"(?:gnu )?affero general public license(?: (?:version|v) ?3(?: 0)?)?", r"agpl 3 0(?: only| or later)?"),
    ("gfdl-1.3", "free documentation license", r"(?:gnu )?free documentation license (?:version|v) ?1 3", r"gfdl 1 3(?: only| or later)?"),
    ("gfdl-1.2", "free documentation license", r"(?:gnu )?free documentation license (?:version|v) ?1 2", r"gfdl 1 2(?: only| or later)?"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: (?:version|v))? ?2(?: 0)?", r"mpl 2 0"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: (?:version|v))? ?1 1", r"mpl 1 1"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: (?:version|v))? ?2(?: 0)?", r"epl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: (?:version|v))? ?1(?: 0)?", r"epl 1 0"),
    ("cddl-1.0", "common development", r"common development and distribution license(?: (?:version|v))?(?: 1 0)?", r"cddl 1 0"),
    ("cddl-1.1", "common development", r"common development and distribution license(?: (?:version|v))? 1 1", r"cddl 1 1"),
    ("cpl-1.0", "common public license", r"common public license(?: (?:version|v))?(?: 1 0)?", r"cpl 1 0"),
    ("eupl-1.2", "european union public", r"european union public licen[cs]e(?: (?:version|v))? ?1 2", r"eupl 1 2"),
    ("eupl-1.1", "european union public", r"european union public licen[cs]e(?: (?:version|v))? ?1 1", r"eupl 1 1"),
    ("bsl-1.0", "boost", r"boost software license(?: (?:version|v))?(?: 1 0)?", r"bsl 1 0"),
    ("zlib", "zlib", r"zlib(?: libpng)? license", r"zlib"),
    ("libpng", "libpng", r"libpng license", r"libpng(?: 2 0)?"),
    ("artistic-2.0", "artistic", r"artistic license(?: (?:version|v))? ?2(?: 0)?", r"artistic 2 0"),
    ("artistic-1.0", "artistic", r"artistic license(?: (?:version|v))? ?1(?: 0)?", r"artistic 1 0"),
    ("python-2.0", "python", r"python software foundation license(?: (?:version|v))?(?: 2)?", r"(?:python|psf) 2 0"),
    ("ruby", "ruby", r"ruby license", r"ruby"),
    ("php-3.01", "php", r"php license(?: (?:version|v))?(?: 3 01)?", r"php 3 01"),
    ("openssl", "openssl", r"openssl license", r"openssl"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", r"postgresql"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense"),
    ("wtfpl", "public license", r"do what the f\w+ you want to public license", r"wtfpl"),
    ("ofl-1.1", "open font", r"(?:sil )?open font license(?: (?:version|v))?(?: 1 1)?", r"ofl 1 1"),
    ("ms-pl", "microsoft", r"microsoft public license", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", r"ms rl"),
    ("osl-3.0", "open software license", r"open software license(?: (?:version|v))? ?3(?: 0)?", r"osl 3 0"),
    ("afl-3.0", "academic free", r"academic free license(?: (?:version|v))? ?3(?: 0)?", r"afl 3 0"),
    ("ecl-2.0", "educational community", r"educational community license(?: (?:version|v))? ?2(?: 0)?", r"ecl 2 0"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license", r"ncsa"),
    ("upl-1.0", "universal permissive", r"universal permissive license(?: (?:version|v))?(?: 1 0)?", r"upl 1 0"),
    ("vim", "vim", r"vim license", r"vim"),
    ("w3c", "w3c", r"w3c (?:software )?(?:notice and )?license", r"w3c"),
    ("odbl-1.0", "open database", r"(?:open data commons )?open database license(?: (?:version|v))?(?: 1 0)?", r"odbl 1 0"),
    ("odc-by-1.0", "open data commons attribution", r"open data commons attribution license", r"odc by 1 0"),
    ("pddl-1.0", "public domain dedication", r"public domain dedication and licen[cs]e", r"pddl 1 0"),
    ("openrail", "responsible ai", r"(?:open )?responsible ai license", r"openrail(?: m)?"),
    ("bsl-1.1", "business source", r"business source license(?: (?:version|v))?(?: 1 1)?", r"busl 1 1"),
    ("sspl-1.0", "server side public", r"server side public license(?: (?:version|v))?(?: 1)?", r"sspl 1 0"),
    ("elastic-2.0", "elastic license", r"elastic license(?: (?:version|v))? ?2(?: 0)?", r"elastic 2 0"),
]

# Creative Commons variants as (label part, name words, short words); each comes in the versions below.
CREATIVE_COMMONS = [
    ("by", r"attribution", r"by"), ("by-sa", r"attribution share ?alike", r"by sa"), ("by-nd", r"attribution no ?deriv(?:ative|ative work)?s", r"by nd"),
    ("by-nc", r"attribution non ?commercial", r"by nc"), ("by-nc-sa", r"attribution non ?commercial share ?alike", r"by nc sa"),
    ("by-nc-nd", r"attribution non ?commercial no ?deriv(?:ative|ative work)?s", r"by nc nd"),
]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

# Words before a license name that grant it.
GRANT = r"(?:licensed|released|distributed|published|available|covered) (?:under|by) (?:the )?(?:terms of )?(?:the )?"

# Phrases as (label, priority, keyword, expression).
PHRASES = [
    ("mit", 0, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 0, "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", 0, "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", 0, "endorse or promote", r"neither the name of .{1,200}? may be used to endorse or promote products"),
    ("zlib", 0, "as is without any express", r"this software is provided as is without any express or implied warranty in no event"),
    ("apache-2.0", 0, "licensed under the apache", r"licensed under the apache license version 2 0 the license you may not use this file"),
    ("gpl", 0, "free software you can redistribute", r"is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("unlicense", 0, "unencumbered software", r"free and unencumbered software released into the public domain"),
    ("warranty-disclaimer", 2, "without warranty of any kind", r"without warranty of any kind"),
    ("warranty-disclaimer", 2, "without any warranty", r"without any warranty(?: without even the implied warranty)?"),
    ("warranty-disclaimer", 2, "merchantability", r"warrant(?:y|ies) of merchantability"),
    ("public-domain", 1, "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", 2, "public domain", r"(?:is|are) in the public domain"),
    ("all-rights-reserved", 2, "rights reserved", r"(?:all|some|no) rights reserved"),
    ("copyright-notice", 2, "copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d(?= ))*+"),
    ("copyright-notice", 3, "copyright", r"copyright (?:holder|owner|notice)s?"),
    ("proprietary", 1, "proprietary", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", 1, "unauthorized copying", r"unauthorized copying of this (?:file|work|document|software)"),
    ("proprietary", 2, "may not be reproduced", r"may not be reproduced (?:or distributed )?without (?:the )?(?:prior )?(?:written )?(?:permission|consent)"),
    ("no-training", 1, "machine learning", r"may not be used (?:for|to train) machine learning"),
    ("no-training", 1, "text and data mining", r"(?:reserves|opt out of) (?:all rights to |the right to )?text and data mining"),
    ("non-commercial", 2, "commercial", r"(?:for )?non ?commercial (?:use|purposes?) only"),
    ("licensed-reference", 3, "licensed under", r"(?:is |are )?(?:dual )?licensed under (?:the )?(?:terms of )?(?:the )?[0-9a-z]+(?: [0-9a-z]+){0,3} licen[cs]e"),
    ("licensed-reference", 3, "released under", r"released under (?:the )?[0-9a-z]+(?: [0-9a-z]+){0,3} licen[cs]e"),
    ("licensed-reference", 3, "distributed under", r"distributed under (?:the )?(?:terms of )?(?:the )?[0-9a-z]+(?: [0-9a-z]+){0,3} licen[cs]e"),
    ("license-file", 3, "licen", r"see (?:the )?(?:accompanying )?licen[cs]e(?: file| txt| md)? for (?:more )?(?:details|information)"),
    ("creative-commons", 2, "creative commons", r"creative commons(?: licen[cs]e)?"),
    ("cc0-1.0", 1, "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("gpl", 2, "gnu gpl", r"gnu gpl(?: ?v?[123])?"),
    ("lgpl", 2, "gnu lgpl", r"gnu lgpl(?: ?v?[23])?"),
    ("gpl", 2, "gplv", r"gplv[123]"),
    ("0bsd", 1, "free public license", r"free public license"),
    ("0bsd", 0, "free public license", rf"{GRANT}free public license"),
]


def rules() -> list[dict]:
    """All rules in order: base places, tags, names, names with a grant, addresses, creative commons, phrases."""
    out = [(label, 2, words, words) for label, words in BASE]
    for label, word, name, short in LICENSES:
        out += [(label, 0, "spdx", rf"spdx license identifier {short}"),
                (label, 1, word, name),
                (label, 0, word, rf"{GRANT}{name}"),
                (label, 0, "opensource org", rf"opensource org licenses? {short}")]
    for part, name, short in CREATIVE_COMMONS:
        out += [(f"cc-{part}-{v.replace(' ', '.')}", 0, "creative commons", rf"creative commons {name}(?: licen[cs]e)?(?: version)? {v}") for v in CC_VERSIONS]
        out += [(f"cc-{part}-{v.replace(' ', '.')}", 0, "cc by", rf"cc {short} {v}") for v in CC_VERSIONS]
        out += [(f"cc-{part}", 0, "creativecommons org", rf"creativecommons org licenses {short}"),
                (f"cc-{part}", 1, "creative commons", rf"creative commons {name}"), (f"cc-{part}", 1, "cc by", rf"cc {short}")]
    out += PHRASES
    return [{"rule": i, "label": a, "priority": p, "keyword": k, "expr": f"(?<= )(?:{e})(?= )"} for i, (a, p, k, e) in enumerate(out)]


RULE_TYPE = "array<struct<rule: int, label: string, priority: int, keyword: string, expr: string>>"
SCORES = [1.0, 0.9, 0.7, 0.5]


def stems() -> list[str]:
    """A few strings of which every match of every rule contains one: all license names hold the first."""
    own = {"licen", "cc by", "creative commons", *(words for _, words in BASE), *(k for _, _, k, _ in PHRASES)}
    return sorted(s for s in own if not any(t in s and t != s for t in own))


def words_of(text: Column) -> Column:
    """Words with single blanks between them, case as it is."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "))


def _blanks(c: Column) -> Column:
    return (F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))).cast("long")


def detections(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(_row, keep..., n_words, rule, label, priority, first, last): matches as word intervals; one row without a rule if none.

    ``_row`` tells input rows apart. Positions: each match starts after the blanks of the pieces and matches before it.
    """
    every = F.from_json(F.lit(json.dumps(rules())), RULE_TYPE)
    low = F.lower("_words")
    hit = F.lit(False)
    for s in stems():
        hit = hit | F.contains(low, F.lit(s))
    base = (docs.select(F.monotonically_increasing_id().alias("_row"), *keep, words_of(F.col(text)).alias("_words"))
            .withColumn("n_words", F.when(F.col("_words") == "", F.lit(0)).otherwise(_blanks(F.col("_words")) + 1).cast("long"))
            .withColumn("_low", F.when(hit, F.concat(F.lit(" "), F.translate("_words", UPPER, LOWER), F.lit(" ")))))
    tried = base.select("_row", *keep, "n_words", "_low", F.explode_outer(F.when(F.col("_low").isNotNull(), F.filter(
        every, lambda r: F.contains(F.col("_low"), r["keyword"])))).alias("_r"))
    pieces = F.transform(F.split("_low", F.col("_r.expr"), -1), _blanks)
    found = F.transform(F.regexp_extract_all("_low", F.col("_r.expr"), F.lit(0)), _blanks)
    spans = F.filter(F.arrays_zip(pieces.alias("p"), found.alias("m")), lambda x: x["m"].isNotNull())
    each = tried.select("_row", *keep, "n_words", "_r.rule", "_r.label", "_r.priority", F.posexplode_outer(spans).alias("_i", "_s"))
    upto = Window.partitionBy("_row", "rule").orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum(F.col("_s.p") + F.col("_s.m")).over(upto) - F.col("_s.m") - 1
    # Rules that matched nothing only keep the row in the table.
    return (each.repartition("_row").withColumn("first", start).withColumn("last", F.col("first") + F.col("_s.m"))
            .select("_row", *keep, "n_words", *[F.when(F.col("first").isNotNull(), F.col(c)).alias(c) for c in ("rule", "label", "priority")],
                    "first", "last"))


def resolved(found: DataFrame) -> DataFrame:
    """Add ``stays``: no detection that contains it is as good or better, and none inside it is better."""
    place = [F.col("first").asc(), F.col("last").desc(), F.col("priority").asc(), F.col("rule").asc()]
    back = [F.col("first").desc(), F.col("last").asc(), F.col("priority").desc(), F.col("rule").desc()]
    before = Window.partitionBy("_row").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("_row").orderBy(*back).rowsBetween(Window.unboundedPreceding, -1)
    levels = range(len(SCORES))
    reach = [F.max(F.when(F.col("priority") <= p, F.col("last"))).over(before) for p in levels]
    inner = [F.min(F.when(F.col("priority") < p, F.col("last"))).over(after) for p in levels]
    step = found.withColumns({f"_o{p}": reach[p] for p in levels}).withColumns({f"_n{p}": inner[p] for p in levels if p})
    covered, holds = F.lit(False), F.lit(False)
    for p in levels:
        own = F.col("priority") == p
        covered = covered | (own & F.coalesce(F.col(f"_o{p}") >= F.col("last"), F.lit(False)))
        if p:
            holds = holds | (own & F.coalesce(F.col(f"_n{p}") <= F.col("last"), F.lit(False)))
    return step.withColumn("stays", F.col("rule").isNotNull() & ~covered & ~holds).drop(
        *[f"_o{p}" for p in levels], *[f"_n{p}" for p in levels if p])


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: (keep..., n_words, n_base, first_word, last_word, base_labels, labels, score).

    n_base counts all places of the base phrases, suppressed or not; their smallest and largest start are first_word and
    last_word. labels holds base labels and those of the detections that stay, sorted and distinct. score is the best
    confidence of a detection that stays (1, 0.9, 0.7, 0.5 by priority), 0 without any. A null or empty text has no words;
    repeated rows each get a row. Columns of ``docs`` other than ``keep`` and ``text`` are not read.
    """
    is_base = F.col("rule") < len(BASE)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731 - at most one entry per label
    score = F.lit(0.0)
    for p, s in enumerate(SCORES):
        score = F.when(F.col("priority") == p, F.lit(s)).otherwise(score)
    return (resolved(detections(docs, text, keep)).groupBy("_row", *keep, "n_words").agg(
        F.count(F.when(is_base, 1)).alias("n_base"), F.min(F.when(is_base, F.col("first"))).alias("first_word"),
        F.max(F.when(is_base, F.col("first"))).alias("last_word"), joined(F.when(is_base, F.col("label"))).alias("base_labels"),
        joined(F.when(is_base | F.col("stays"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("stays"), score)), F.lit(0.0)).alias("score")).drop("_row"))
