"""Packing, near-duplicates, decontamination, language, toxicity and URL filters against plain Python or held-out rows."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siteplan.llm import common, decontam, langid, minhash, packing, toxicity, urltree
from siteplan.llm.queries import QUERIES, URL_RULES, tokenizer_files

SMALL = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "x y"), (3, "x y"), (None, "a b c d e f"), (None, None), (4, "word " * 30_000), (5, "  \n ")]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_word_hashes_do_not_depend_on_blocks():
    codes = common.fold_table(separators=minhash.SPACES)
    raw = np.frombuffer(("Ab cé  " + "x" * 40 + "\n" + "tail " * 50).encode(), np.uint8)
    whole = common.word_hashes(raw, codes)
    parts = [b for _, b in common.blocks(raw, codes, 7)]
    assert sum(map(len, parts)) == len(raw) and len(whole) == 53
    assert len({int(h) for h in whole}) == 4
    assert (common.word_hashes(np.frombuffer(b"ab AB", np.uint8), codes)[0] == whole[0]).all()


def test_numbers_are_gapless_in_hot_groups(spark):
    df = spark.range(5000).select((F.col("id") % 7 == 0).cast("int").alias("g"), "id")
    got = common.numbered(df, ["g"], F.xxhash64("id"), 6, "n").toPandas()
    assert all(sorted(x["n"]) == list(range(len(x))) for _, x in got.groupby("g"))


# ---- packing -----------------------------------------------------------------------------------

def test_tokens_equal_the_json_tokenizer(spark):
    from tokenizers import Tokenizer

    vocabulary, ranks = tokenizer_files()
    full = Tokenizer.from_file(vocabulary)
    full.encode_special_tokens = True
    encode = packing.tokenizer(vocabulary, ranks)
    rng = random.Random(4)
    letters = "abz AZ09 .,'s\n\t  éßñÖ¿“”—x日本語а́\u00a0\u200b\x1c<|endoftext|>’s  \r\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(600)]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + ["", " ", "  a", "<|endoftext|>"]
    for t in texts:
        assert encode(t) == full.encode(t, add_special_tokens=False).ids, repr(t)


def check_packing(rows, docs, encode, size):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for seq in by_seq.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= size
    want = Counter()
    for i, t in docs:
        ids = np.array([*encode(t or ""), 0], "<u4")
        first = len(ids) % size or min(size, len(ids))
        cuts = [0, *range(first, len(ids), size), len(ids)]
        for k in range(len(cuts) - 1):
            part = ids[cuts[k]:cuts[k + 1]]
            want[i, k, cuts[k], len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    return len(by_seq)


def best_fit_decreasing(lengths, size):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in range(len(gaps)) if gaps[g] >= n]
        if fits:
            gaps[min(fits, key=lambda g: gaps[g])] -= n
        else:
            gaps.append(size - n)
    return len(gaps)


def test_packing_round_trip(spark, docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "cat", "zq", "é"]) for _ in range(rng.choice([3, 20, 60, 200])))) for i in range(300)] + ODD
    encode = packing.tokenizer(*tokenizer_files())
    got = packing.packed(docs(rows), *tokenizer_files(), size=128).collect()
    n = check_packing(got, rows, encode, 128)
    assert n <= best_fit_decreasing([r["length"] for r in got], 128)
    full = packing.sequences(docs(rows), *tokenizer_files(), size=128).collect()
    assert len(full) == n and sum(len(r["ids"]) for r in full) == sum(r["length"] for r in got)
    assert packing.packed(docs([]), *tokenizer_files()).count() == 0


def test_two_replace_the_smallest():
    # Greedy takes 60 + 30 and leaves 10; 30 gives way to 22 + 18.
    plan = packing.plan({60: 1, 30: 1, 22: 1, 18: 1}, 100)
    first = [int(n) for n, s in zip(plan.length, plan.sequence, strict=True) if s == 0]
    assert sorted(first) == [18, 22, 60]


def test_plan_places_every_piece_once():
    rng = random.Random(9)
    for _ in range(30):
        size = rng.choice([10, 64, 257])
        counts = {n: rng.randrange(1, 50) for n in rng.sample(range(1, size + 1), rng.randrange(1, min(size, 20)))}
        p = packing.plan(counts, size)
        used = defaultdict(list)
        fill = Counter()
        for n in counts:
            rows = [k for k in range(len(p.length)) if p.length[k] == n]
            ends = [int(p.first[k]) for k in rows[1:]] + [counts[n]]
            for k, end in zip(rows, ends, strict=True):
                for r in range(int(p.first[k]), end):
                    s = int(p.sequence[k]) + r - int(p.first[k])
                    used[s].append((int(p.offset[k]), n))
                    fill[s] += n
        assert set(used) == set(range(p.sequences)) and max(fill.values()) <= size
        for seq in used.values():
            at = 0
            for offset, n in sorted(seq):
                assert offset == at
                at += n


# ---- near-duplicates ---------------------------------------------------------------------------

def shingle_set(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute_components(rows, num, den):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(rows[k][0], len(sets[k]), least[find(k)] if sets[k] else rows[k][0]) for k in range(len(rows))]


def family_rows(seed, families, size):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 60, 150]))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 + f % 2, " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("blocks", [(1024, 256), (7, 5)])
def test_components_equal_all_pairs(spark, docs, blocks):
    rows = family_rows(1, 6, 25) + ODD
    got = minhash.near_duplicates(docs(rows), (85, 100), block_rows=blocks[0], family_rows=blocks[1]).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(brute_components(rows, 85, 100))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_equal_ids_with_different_texts(spark, docs):
    rows = [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "h i j k l m n"), (3, "o p q r s t")]
    got = Counter((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs(rows)).collect())
    assert got == Counter({(1, 1): 2, (2, 1): 1, (3, 3): 1})
    assert minhash.near_duplicates(docs([])).count() == 0


def near_pairs(pairs):
    """Two texts each of 60 words, with the last word changed in the second."""
    return [(f"p{k}x " * 2 + " ".join(f"p{k}w{j}" for j in range(57)), f"p{k}x " * 2 + " ".join(f"p{k}w{j}" for j in range(56)) + " z") for k in range(pairs)]


def test_each_text_of_an_id_has_its_own_links(spark, docs):
    (a, a2), (b, b2), (c, c2) = near_pairs(3)
    rows = [(1, a), (1, b), (2, b2), (3, a2), (-7, c), (4, c2), (None, "n o p q r s")]
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs(rows)).collect())
    assert got == Counter({(1, 1, True): 2, (2, 1, False): 1, (3, 1, False): 1, (-7, -7, True): 1, (4, -7, False): 1, (None, None, True): 1})


def test_one_document_of_each_group_stays(spark, docs):
    rows = family_rows(2, 4, 12)
    out = minhash.distinct_documents(docs(rows + rows[:3]))
    assert out.columns == docs(rows).columns
    assert sorted(r.doc_id for r in out.dropDuplicates(["doc_id"]).collect()) == sorted({c for _, _, c in brute_components(rows, 85, 100)})


def test_repeated_rows_stay_once(spark, docs):
    rows = family_rows(2, 4, 12)
    twice = docs(rows + rows[:3] + [(900, "a b c d e f")] * 3 + [(None, "g h i j k l")] * 2 + [(None, None)] * 2)
    out = minhash.distinct_documents(twice.unionByName(twice.withColumn("source", F.lit("other")))).collect()
    want = {c for _, _, c in brute_components(rows, 85, 100)}
    assert Counter(r.doc_id for r in out) == Counter([*want, 900, None, None])


def test_survivors_are_chosen_by_group(spark, docs):
    (a, a2), (b, b2), (c, c2), (d, d2) = near_pairs(4)
    rows = [(None, a), (None, a2), (None, b), (None, "k l m n o p q"), (5, b2), (7, c), (7, d), (8, c2), (6, d2), (None, ""), (9, None), (9, " ")]
    got = Counter((r.doc_id, r.text) for r in minhash.distinct_documents(docs(rows)).collect())
    of_a = got.pop((None, a), 0) + got.pop((None, a2), 0)
    assert of_a == 1 and got == Counter([(None, "k l m n o p q"), (5, b2), (7, c), (6, d2), (None, ""), (9, None), (9, " ")])


def test_posterior_bound():
    least = minhash.least_agreements(0.85)
    assert least == sorted(least) and least[-1] < 0.85 * minhash.HASHES
    # A pair at the threshold passes all batches almost surely.
    rng = np.random.default_rng(0)
    agree = rng.random((20_000, minhash.HASHES)) < 0.85
    ends = np.arange(minhash.BATCH, minhash.HASHES + 1, minhash.BATCH)
    ok = np.all([agree[:, :e].sum(axis=1) >= m for e, m in zip(ends, least, strict=True)], axis=0)
    assert ok.mean() > 0.999


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.85, 0.99, 1.0])
def test_bands_keep_the_chance_of_a_miss(threshold):
    n = minhash.hashes_for(threshold)
    assert n % minhash.BATCH == 0 and (1 - threshold**minhash.ROWS) ** (n // minhash.ROWS) <= minhash.MISS
    assert len(minhash.least_agreements(threshold)) == n // minhash.BATCH


def test_pipeline_links_at_eight_tenths(spark, docs):
    import corpus_pipeline as cp

    words = [f"w{k}" for k in range(49)]
    near, far = [*words[:-5], *"abcde"], [*words[:-6], *"fghijk"]  # 40 of 50, then 39 of 51 shingles in common with ``words``
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))]
    got = cp.near_duplicates(spark, docs(rows), SMALL)
    assert sorted(r.doc_id for r in got.collect()) == [1, 3]


def test_long_path_is_one_component(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.component for r in minhash.components(links).collect()}
    assert got == {**{k: 0 for k in range(301)}, 1000: 1000, 1001: 1000}


# ---- decontamination ---------------------------------------------------------------------------

def test_overlaps_tolerate_substitutions(spark, docs):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(30))) for k in range(12)] + [(50, "one two three four five six"), (51, "a b"), (52, None), (53, "")]
    noise = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, want = [], set()
    for k in range(12):
        w = items[k][1].split()
        changed = list(w)
        for at in (5, 12, 19, 26):
            changed[at] = "ZZ"
        rows += [(10 * k, " ".join(noise(40) + w + noise(40))), (10 * k + 1, " ".join(noise(5) + changed).upper()),
                 (10 * k + 2, "; ".join(noise(9) + w[8:22] + noise(9))), (10 * k + 3, " ".join(noise(30) + w[:9] + noise(30))), (10 * k + 4, " ".join(noise(200)))]
        want |= {(10 * k, k), (10 * k + 1, k), (10 * k + 2, k)}
    rows += [(900, "x One, two three-four five SIX y"), (901, "one two three four five")] + [(i + 1000 if i is not None else None, t) for i, t in ODD]
    want |= {(900, 50)}
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.overlaps(docs(rows), bench).collect()
    found = want | {(None, 51)}  # an item of two words, exactly; it taints only texts that hold nothing else
    assert {(r.doc_id, r.item_id) for r in got} == found and len(got) == len(found)
    full = {r.doc_id: r for r in got}
    assert (full[0].doc_start, full[0].item_start, full[0].n_words, full[0].n_equal) == (40, 0, 30, 30)
    assert full[1].n_equal == 23 and full[1].n_words == 26  # the last three words don't outweigh the word before them
    left = {r.doc_id for r in decontam.clean(docs(rows), bench).collect()}
    assert left == {i for i, _ in rows if i is None} | {i for i, _ in rows if i is not None} - {d for d, _ in want}
    assert decontam.overlaps(docs([]), bench).count() == 0 and decontam.overlaps(docs(rows), bench.limit(0)).count() == 0


def test_longest_segment_equals_all_segments():
    rng = np.random.default_rng(5)
    for n in [0, 1, 2, 13, *rng.integers(3, 40, 200)]:
        agree = rng.random(n) < rng.choice([0.3, 0.6, 0.8, 0.95])
        fits = [(y - x, int(agree[x:y].sum())) for x in range(n + 1) for y in range(x, n + 1) if 5 * agree[x:y].sum() >= 4 * (y - x)]
        x, y = decontam.longest_segment(agree, Fraction("0.8"))
        assert (y - x, int(agree[x:y].sum())) == max(fits)


def test_overlaps_with_substitutions_that_split_the_best_segment(spark, docs):
    rng = random.Random(8)
    cases = [(27, range(12, 16)), (18, (8, 9, 10)), (15, (2,)), (15, (2, 7)), (8, (2,)), (13, (1,)), (60, (25, 26, 27, 33))]
    items, rows, want = [], [], {}
    for k, (n, changed) in enumerate(cases):
        w = [f"i{k}w{j}" for j in range(n)]
        items.append((k, " ".join(w)))
        for at in changed:
            w[at] = "other"
        part = w[15:36] if n == 60 else w  # 10 + 3 + 5 + 1 + 2 words of a longer item
        rows.append((k, " ".join([*(f"n{rng.random()}" for _ in range(20)), *part, *(f"n{rng.random()}" for _ in range(20))])))
        want[k] = (len(part), len(part) - len(changed))
    rows.append((90, " ".join(items[0][1].split()[:10])))  # 10 words of 27
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_words, r.n_equal) for r in decontam.overlaps(docs(rows), bench).collect()}
    assert got == {(k, k): v for k, v in want.items()}
    assert {r.doc_id for r in decontam.clean(docs(rows), bench).collect()} == {90}


def test_items_without_an_id_are_found(spark, docs):
    passage = lambda k: " ".join(f"i{k}w{j}" for j in range(20))
    bench = spark.createDataFrame([(None, passage(0)), (None, passage(1)), (None, passage(1)), (7, passage(2)), (7, passage(3)), (None, None)], "item_id long, text string")
    rows = [(k, f"x y {passage(k)} z") for k in range(5)]
    got = Counter((r.doc_id, r.item_id, r.n_words) for r in decontam.overlaps(docs(rows), bench).collect())
    assert {(d, i) for d, i, _ in got} == {(0, None), (1, None), (2, 7), (3, 7)} and sum(got.values()) == 4
    assert [r.doc_id for r in decontam.clean(docs(rows), bench).collect()] == [4]


# ---- language ----------------------------------------------------------------------------------

def test_language_of_documents_and_evidence(spark):
    labelled = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.fit(labelled)
    rows = labelled.select("doc_id", "text", F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("host"), F.col("lang").alias("own"))
    got = langid.identify(rows, model, ["doc_id", "own"]).toPandas()
    assert (got["lang"] == got["own"]).mean() > 0.98 and got["confidence"].between(0, 1.000001).all()
    odd = [(1, None, "en", "a.b"), (2, "", "fr", ""), (3, "12 34 !", None, None), (4, "the", "de", "x.de"), (4, "the", "de", "x.de"), (None, "x" * 300_000, "??", "localhost")]
    out = langid.identify(spark.createDataFrame(odd, "doc_id long, text string, declared string, host string"), model, ["doc_id"]).collect()
    assert len(out) == 6 and {r["doc_id"]: (r["lang"], r["confidence"]) for r in out if r["doc_id"] in (1, 2, 3)} == {k: ("und", 1.0) for k in (1, 2, 3)}
    assert langid.identify(rows.limit(0), model, ["doc_id"]).count() == 0


def test_host_prior_and_suffix_settle_short_texts(spark):
    model = langid.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))
    german = [(k, "der die und ist nicht von den zu ein", None, "shop.example.org") for k in range(60)]
    short = [(100, "de", None, "shop.example.org"), (101, "der", None, "www.beispiel.at"), (102, "de", "es", "nowhere.test"), (103, "der", None, "www.beispiel.test")]
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(german + short, "doc_id long, text string, declared string, host string"), model, ["doc_id"]).collect()}
    assert got[100]["lang"] == "de" and got[102]["lang"] == "es"
    # The same text leans more to German where the suffix is Austrian.
    assert got[101]["lang"] == got[103]["lang"] == "de" and got[101]["confidence"] > got[103]["confidence"]


def test_markup(spark):
    html = '<!DOCTYPE html><HTML class="x" lang="de-AT"><style>p{}</style><script>var a="<p>en"</script><p>Hallo&amp;<!-- no --> Welt</p>'
    r = spark.createDataFrame([(html, "https://User@WWW.Example.AT:8080/x?y"), ("<p>", "nothing")], "h string, u string").select(
        langid.markup_language(F.col("h")).alias("l"), langid.markup_text(F.col("h")).alias("t"), langid.host_of(F.col("u")).alias("host")).collect()
    assert r[0]["l"] == "de" and r[0]["t"].split() == ["Hallo", "Welt"] and r[0]["host"] == "www.example.at"
    assert r[1]["l"] is None and r[1]["host"] == ""


def test_foreign_texts_go(spark, docs):
    real = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    junk = spark.createDataFrame([(9001, "Ж" * 400 + " щщъы" * 60, "en", "src0", 1), (9002, "1234 5678", "en", "src0", 9), (9003, None, "en", "src0", 0)], real.schema)
    out = langid.in_language(real.unionByName(junk))
    gone = {r.doc_id for r in real.unionByName(junk).join(out, "doc_id", "left_anti").collect()}
    assert {9001, 9002, 9003} <= gone and len(gone) <= 5 and out.columns == real.columns


# ---- toxicity ----------------------------------------------------------------------------------

def toxic_rows(n, seed=0):
    rng = random.Random(seed)
    plain = [f"{a}{b}{c}" for a in ("ba", "do", "ki", "mu") for b in ("la", "re", "ti") for c in ("", "n", "s", "th")]
    rows, labels = [], []
    for i in range(n):
        bad = i % 8 == 0
        w = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["nasty", "viledom", "vileish", "vileron"]))
        rows.append((i, " ".join(w)))
        if i % 3 == 0:
            labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_toxicity(spark, docs):
    rows, labels = toxic_rows(3000)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs(rows), lab)
    out = toxicity.scored(docs(rows + ODD), model).collect()
    held = [r for r in out if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.doc_id > 10]
    truth = {i: i % 8 == 0 for i, _ in rows}
    assert np.mean([(r.score >= 0.3) == truth[r.doc_id] for r in held]) > 0.98 and len(held) > 500
    assert len(out) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in out)
    # Labels of held-out rows change nothing.
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    other = toxicity.fit(docs(rows), spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    assert np.allclose(other.table, model.table) and (other.weights == model.weights).all()


def test_no_positive_or_no_rows(spark, docs):
    none = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert max(r.score for r in toxicity.scored(docs(ODD), toxicity.fit(docs(ODD), none)).collect()) < 1e-9
    assert toxicity.scored(docs([]), toxicity.fit(docs([]), none.limit(0))).count() == 0
    some = spark.createDataFrame([(k, 1, 1) for k in range(12)], "doc_id long, quality int, toxic int")
    assert toxicity.scored(docs(ODD), toxicity.fit(docs([]), some)).count() == len(ODD)


def test_risk_correction_finds_unlabelled_positives():
    # Feature 0 marks positives, feature 1 is everywhere; a quarter of the unlabelled rows are positive.
    pos = [np.array([0, 1])] * 200
    un = [np.array([0, 1])] * 100 + [np.array([1])] * 300
    w = toxicity.train(pos, un, 2, 0.25, 0)
    p = lambda cols: 1 / (1 + np.exp(-(w[cols].sum() + w[-1])))
    assert p([0, 1]) > 0.8 and p([1]) < 0.1


# ---- URL filter --------------------------------------------------------------------------------

def test_url_parts_and_rules(spark):
    urls = ["HTTP://A.Example.NET/en/x?y#z", "https://example.net/de/", "//no", None, "http://b.example.com/de/1", "x://example.com", "http://notnet/en/",
            "a://b://c/d", "http://x.org/fr/a/b#?", "http://net?x=/en/", "http://net/", "http://E.net#a/b", "http://İ.net/é", ""]
    got = urltree.filtered(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, bad int"), URL_RULES).collect()
    assert len(got) == len(urls)
    for r in got:
        u = urls[r.page_id] or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(LOWER)
        fits = [(h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *best), (u, r)


def test_templates_generalise_merge_and_reject(spark):
    rows = []
    for k in range(400):
        rows += [(f"http://h/news/{k}/title-{k}", 0 if k % 4 == 0 else None), (f"http://h/spam/{chr(97 + k % 26)}{chr(97 + k // 26)}", 1 if k % 3 == 0 else None),
                 (f"http://h/blog/{k}", 0 if k % 50 == 0 else None), (f"http://other/x/{k}", None)]
    df = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    got = urltree.filtered(df, []).toPandas()
    by = got.groupby(["host", "template"])["verdict"].agg(["first", "nunique", "size"])
    assert by["nunique"].eq(1).all() and by["size"].sum() == len(rows)
    assert by.loc[("h", "/spam/*"), "first"] == "block" and by.loc[("h", "/news/#/title-#"), "first"] == "allow"
    assert by.loc[("other", "/x/#"), "first"] == "allow"


def test_similar_leaves_share_a_branch(spark):
    leaves = spark.createDataFrame([("h", "/", "/a", 50, 50), ("h", "/", "/b", 48, 52), ("h", "/", "/c", 99, 1), ("h", "/", "/d", 0, 0)],
                                   "host string, parent string, template string, good long, bad long")
    got = {r.template: r.branch for r in urltree.merge_similar(leaves).collect()}
    assert got["/a"] == got["/b"] != got["/c"] and got["/d"] == got["/c"]


def test_all_queries_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 11))


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before, n = docs.columns, docs.count()
    for name, step in cp.STAGES[:-1]:
        docs = cp.stage(step(spark, docs, SMALL), name)
        assert docs.columns == before and docs.count() <= n
        n = docs.count()
    # Plain counterparts: no near-duplicates and no benchmark passage are left.
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert all(c == i for i, _, c in brute_components(rows, 85, 100))
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    grams = {tuple(w[k:k + 13]) for b in bench for w in [word(b.text)] for k in range(len(w) - 12)}
    assert not any(tuple(w[k:k + 13]) in grams for _, t in rows for w in [word(t)] for k in range(len(w) - 12))
    packed = cp.STAGES[-1][1](spark, docs, SMALL).collect()
    check_packing(packed, rows, packing.tokenizer(*tokenizer_files()), 2048)


def test_patterns_take_very_long_input(spark):
    urls = spark.createDataFrame([("/" + "a" * 50_000,), ("/" + "1-" * 50_000,), ("/x/0123abcd-4567-89ef-00",)], "path string")
    assert [r[0][-1][:3] for r in urls.select(urltree.shape_of(F.col("path"))).collect()] == ["aaa", "#-#", "~"]
    pages = ["<" * 50_000, "a<!--" * 50_000, "b<script>" * 50_000, "<html " * 50_000 + "<html lang=de>", "x<b>y</b><!-- z -->w"]
    got = spark.createDataFrame([(p,) for p in pages], "html string").select(
        F.trim(langid.markup_text(F.col("html"))), langid.markup_language(F.col("html"))).collect()
    assert [r[0][:3] for r in got] == ["<<<", "a", "b", "<ht", "x y"] and got[3][1] == "de"


def test_sets_of_wide_batches_cross_batches():
    rows = [(7, 0, 1, False, 1, b"a", "x"), (7, 0, 1, True, 2, b"b", "y"), (8, 0, 0, False, 3, b"c", "z")]
    names = ["g", "_i", "_j", "_side", "node", "sig", "text"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True))]) for r in rows]
    got = [(p.column(4).to_pylist(), q.column(4).to_pylist(), same) for p, q, same in minhash.block_pairs(iter(batches))]
    assert got == [([1], [2], False), ([3], [3], True)]
