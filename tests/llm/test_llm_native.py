"""License rules, Merkle fingerprints, sharding and quotation links against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from siteplan.llm import licenses, merkle, quotes, sharding

LOWER = str.maketrans(licenses.UPPER, licenses.LOWER)
ODD = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "a. b"), (None, None), (4, "word " * 30_000)]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base_places(w):
    return [(k, label) for k in range(len(w)) for label, p in licenses.BASE if w[k:k + len(p.split())] == p.split()]


def test_license_base_places(spark, docs):
    rng = random.Random(3)
    bits = ["CC", "by", "BY-NC", "General", "Public", "LICENSE", "all rights\n", "reserved", "İx", "K", ".", "é", "cc by", "GNU General Public License v3"]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(60)))) for i in range(150)] + ODD
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs(rows)).collect())
    want = Counter()
    for i, t in rows:
        w = words(t)
        at = base_places(w)
        want[i, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))] += 1
    assert got == want


def test_license_rules_resolve(spark, docs):
    texts = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit",
             "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0", "Creative Commons Attribution-ShareAlike 4.0": "cc-by-sa-4.0",
             "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0", "Some rights reserved.": "all-rights-reserved",
             "Copyright (c) 2019 2020 X": "copyright-notice", "https://opensource.org/licenses/MIT": "mit", "plain text": "",
             "GNU Lesser General Public License v2.1": "gpl,lgpl-2.1"}
    got = {r.doc_id: r for r in licenses.scan(docs(list(enumerate(texts)))).collect()}
    assert {t: got[i].labels for i, t in enumerate(texts)} == texts
    assert all((r.score > 0) == bool(r.labels) for r in got.values())


def test_license_suppression_is_containment(spark):
    rng = random.Random(5)
    rows = [(r, k, rng.randrange(4), a := rng.randrange(12), a + rng.randrange(6)) for r in range(40) for k in range(rng.randrange(1, 9))]
    df = spark.createDataFrame(rows, "_row long, rule int, priority int, first long, last long")
    got = {(r["_row"], r["rule"]): r["stays"] for r in licenses.resolved(df).collect()}
    for r, k, p, a, b in rows:
        stays = True
        for r2, k2, p2, a2, b2 in rows:
            if r2 != r or k2 == k:
                continue
            holds_me = a2 <= a and b2 >= b and (p2 < p or p2 == p and ((a2, b2) != (a, b) or k2 < k))
            in_me = a <= a2 and b >= b2 and p2 < p
            stays = stays and not holds_me and not in_me
        assert got[r, k] == stays, (r, k)


def test_every_rule_compiles_and_contains_its_keyword_stem():
    stems = licenses.stems()
    rules = licenses.rules()
    assert len(rules) > 300 and len({r["rule"] for r in rules}) == len(rules)
    for r in rules:
        re.compile(r["expr"])
        assert any(s in r["keyword"] or s in r["expr"].replace("licen[cs]e", "license") for s in stems), r


def samples(parsed):
    """Strings that a parsed expression matches, among them one of each alternative, with optional parts in and out."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            step = [chr(arg)]
        elif name == "BRANCH":
            step = [x for branch in arg[1] for x in samples(branch)]
        elif name == "SUBPATTERN":
            step = samples(arg[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            one = samples(arg[2])
            step = sorted({x * n for x in one for n in {arg[0], max(arg[0], min(arg[1], 1))}})
        elif name == "IN":
            step = [chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0]) if str(arg[0][0]) != "CATEGORY" else "7"]
            step = ["x"] if str(arg[0]) == "(CATEGORY, CATEGORY_WORD)" else step
        elif name == "ANY":
            step = ["x"]
        else:
            assert name in ("ASSERT", "ASSERT_NOT", "AT"), name
            step = [""]
        out = [a + b for a in out for b in step]
    return out


def test_every_alternative_contains_its_keyword():
    n = 0
    for r in licenses.rules():
        for text in samples(re._parser.parse(r["expr"])):
            n += bool(re.search(r["expr"], f" {text} "))
            assert r["keyword"] in text, (r, text)
    assert n > len(licenses.rules())


def test_free_public_license(spark, docs):
    texts = ["Free Public License 1.0.0", "Released under the Free Public License.", "Zero-Clause BSD License", "SPDX-License-Identifier: 0BSD", "free public library"]
    got = {r.doc_id: r.labels for r in licenses.scan(docs(list(enumerate(texts)))).collect()}
    assert got == {0: "0bsd", 1: "0bsd", 2: "0bsd", 3: "0bsd", 4: ""}


def test_merkle_tree(spark, docs):
    a = "".join(f"One {k}. Two!\nThree {k}?\n\nFour {k}. Five\n" for k in range(3))
    rows = [(1, a), (2, a), (3, a.replace("Three 1", "Drei")), (4, None), (5, ""), (6, "x")]
    df = merkle.with_fingerprint(docs(rows))
    fp = {r.doc_id: r.fingerprint for r in df.collect()}
    assert fp[1] == fp[2] != fp[3] and fp[4] == fp[5] != fp[6]
    pair = spark.createDataFrame([(fp[1], fp[3], fp[1], fp[4])], "a string, b string, c string, d string")
    got = merkle.with_likeness(merkle.with_likeness(merkle.with_likeness(pair, "a", "b", "ab"), "a", "c", "ac"), "a", "d", "ad").first()
    assert 0.5 < got["ab"] < 1 and got["ac"] == 1.0 and got["ad"] == 0.0
    differ = pair.select(merkle.changed_sections(F.col("a"), F.col("b")).alias("x"), merkle.changed_sections(F.col("a"), F.col("c")).alias("y")).first()
    assert len(differ["x"]) == 1 and differ["y"] == []


def test_next_document(spark, docs):
    rng = random.Random(1)
    ids = rng.sample(range(10**9), 1700)
    rows = [(i, f"t{i}") for i in ids]
    got = {r.doc_id: r.next_text for r in merkle.with_next(docs(rows), "doc_id", ["text"]).collect()}
    order = sorted(ids, reverse=True)
    assert got == {i: f"t{j}" for i, j in zip(order, order[1:] + order[:1], strict=True)}


def test_next_document_of_odd_tables(spark, docs):
    got = merkle.with_next(docs(ODD), "doc_id", ["text"]).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ODD)
    assert merkle.with_next(docs([(7, "only")]), "doc_id", ["text"]).first().next_text == "only"
    assert merkle.with_next(docs([(None, "a"), (None, "b")]), "doc_id", ["text"]).count() == 2
    assert merkle.with_next(docs([]), "doc_id", ["text"]).count() == 0


def test_fingerprint_query_digest(spark, tmp_path, docs):
    from siteplan.llm.queries import QUERIES

    rows = [(i, f"Text {i}. " * (i % 9) + "é") for i in range(60)] + [(60, None)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op4_merkle_fingerprints"](spark, str(tmp_path)).collect()}
    order = sorted((i, t or "") for i, t in rows)[::-1]
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (edited == t)
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1


def test_hypergeometric_draws():
    rng = np.random.default_rng(1)
    for total, good, drawn in ((50, 20, 10), (1000, 25, 40), (7, 7, 3), (7, 0, 3)):
        x = np.array([sharding.hypergeometric(rng, total, good, drawn) for _ in range(4000)])
        mean = drawn * good / total
        assert abs(x.mean() - mean) < 0.15 and x.min() >= max(0, drawn - total + good) and x.max() <= min(good, drawn)
    big = sharding.hypergeometric(rng, 10**11, 25 * 10**8, 10**7)
    assert abs(big - 250_000) < 6 * 500


def test_communication_matrix():
    sizes, targets = [10, 0, 35, 7], [13, 13, 13, 13]
    m = sharding.communication_matrix(sizes, targets, 3)
    assert m.sum(axis=1).tolist() == sizes and m.sum(axis=0).tolist() == targets


def test_shards_are_exact_and_uniform(spark, docs):
    rows = [(i, "copy" if i % 3 else f"t{i}") for i in range(1009)] + ODD
    out = sharding.shuffle_rows(docs(rows), 8, seed=2, partitions=5).collect()
    sizes = Counter(r.shard for r in out)
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    again = sharding.shuffle_rows(docs(rows), 8, seed=2, partitions=5).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
    # Neighbours in the input are not neighbours in the output.
    place = {r.doc_id: r.shard for r in out if r.doc_id is not None and r.doc_id < 1009}
    same = np.mean([place[i] == place[i + 1] for i in range(1000)])
    assert abs(same - 1 / 8) < 0.05
    assert sharding.shuffle_rows(docs([]), 3).count() == 0


def test_shard_query(spark, tmp_path, docs):
    from siteplan.llm.queries import QUERIES

    rows = [(i, f"é{i}" * (i % 5)) for i in range(90)] + [(90, None)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op7_hypergeometric_shards"](spark, str(tmp_path)).collect()}
    for i, t in rows:
        raw = (t or "").encode()
        assert (got[i]["size"], got[i].text_crc32, got[i].law, got[i].grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


MESSAGES = "conv_id long, turn long, role string, text string, own string"


def test_quotes_link_and_go(spark):
    rows = [(1, 0, "user", "Hello there. How are you?\nSecond line here."), (1, 1, "assistant", "> Hello there.\n> How are\n> you?\nFine thanks. And you?"),
            (1, 2, "user", "New topic entirely."), (1, 3, "user", "On Monday, X wrote:\n> Fine THANKS!\n>> Hello there.\nGood."),
            (1, 4, "assistant", "> New topic entirely.\nYes."), (2, 0, "user", "> Hello there.\nother conversation")]
    got = {(r.conv_id, r.turn): r for r in quotes.conversations(spark.createDataFrame([(*r, "x") for r in rows], MESSAGES)).collect()}
    assert [got[1, t].text for t in range(5)] == [rows[0][3], "Fine thanks. And you?", rows[2][3], "Good.", "Yes."]
    assert [got[1, t].reply_to for t in range(5)] == [None, 0, None, 1, 2]
    assert [got[1, t].thread for t in range(5)] == [0, 0, 2, 0, 2]
    assert [got[1, t].depth for t in range(5)] == [0, 1, 0, 2, 1]
    assert [got[1, t].position for t in range(5)] == [1, 2, 4, 3, 5]
    assert (got[2, 0].reply_to, got[2, 0].n_quotes, got[2, 0].n_linked) == (None, 1, 0)


def test_long_reply_chain_and_common_sentence(spark):
    rows = [(1, 0, "u", "Start here.")] + [(1, t, "u", f"> {'Start here.' if t == 1 else f'Answer number {t - 1}.'}\nAnswer number {t}.") for t in range(1, 40)]
    rows += [(2, t, "u", "> ok\nok") for t in range(50)]
    got = quotes.conversations(spark.createDataFrame([(*r, "x") for r in rows], MESSAGES)).collect()
    chain = {r.turn: r for r in got if r.conv_id == 1}
    assert all(chain[t].depth == t and chain[t].thread == 0 and chain[t].position == t + 1 for t in range(40))
    ok = {r.turn: r for r in got if r.conv_id == 2}
    assert ok[0].reply_to is None and all(ok[t].reply_to == 0 for t in range(1, 50))


def test_odd_messages(spark):
    rows = [(None, 0, "user", None), (1, None, None, "> x"), (1, 0, "user", "same"), (1, 0, "user", "same"), (3, 1, "user", "")]
    got = quotes.conversations(spark.createDataFrame([(*r, "x") for r in rows], MESSAGES)).collect()
    assert Counter((r.conv_id, r.turn) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert sorted(r.position for r in got if r.conv_id == 1) == [1, 2, 3]
    assert quotes.conversations(spark.createDataFrame([], MESSAGES)).count() == 0


def test_very_long_lines_and_many_lines(spark):
    rows = [(1, 1, "user", "First words."), (1, 2, "user", ">" * 100_000 + " First words."), (1, 3, "user", "> First words.\n" * 3_000 + "new")]
    got = {r.turn: r for r in quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[k].text for k in (2, 3)] == ["", "new"]
    assert [got[k].reply_to for k in (2, 3)] == [None, 1] and got[2].n_linked == 1  # only a quote of level 1 is a reply


def test_license_pattern_on_many_years(spark, docs):
    got = {r.doc_id: r.labels for r in licenses.scan(docs([(1, "copyright " + "2001 " * 20_000), (2, "copyright 2001 20023 x")])).collect()}
    assert got == {1: "copyright-notice", 2: "copyright-notice"}
