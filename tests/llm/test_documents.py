"""Operators on documents against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import textwrap
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, jaccard, licenses, mixing, rarity, rules, slots, tokens
from ledgerlake.llm.components import components
from ledgerlake.llm.queries import tokenizer_path
from ledgerlake.llm.shingles import Similarity, shingle_set
from ledgerlake.operators import scale

from llm_helpers import brute_components, ids, no_docs, odd_docs, shingles  # noqa: F401


# Rules ------------------------------------------------------------------------------------

def test_binomial_tail_is_exact_or_above(spark):
    cases = [(0, 10), (1, 200), (4, 200), (12, 300), (90, 2500), (10, 200), (5000, 120_000)]
    df = spark.createDataFrame(cases, "k long, n long")
    got = {(r["k"], r["n"]): r["t"] for r in df.select("k", "n", rules.binomial_tail(F.col("k"), F.col("n"), 0.05).alias("t")).collect()}
    for k, n in cases:
        def term(j):
            return math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(0.05) + (n - j) * math.log(0.95))
        want = 1.0 if k >= n * 0.05 else math.fsum(term(j) for j in range(k + 1))
        assert got[k, n] == pytest.approx(want, rel=1e-8)


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_rule_counts_by_brute_force(spark, odd_docs):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("a b c d # é\n\t|".split(" ")) for _ in range(rnd.randrange(60))) for _ in range(60)]
    more = spark.createDataFrame([(100 + i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for docs in (odd_docs, more):
        m = rules.measures(docs, docs.columns)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        for r in m.select("doc", *names).collect():
            assert tuple(r[n] for n in names) == brute_counts(r["doc"]["text"]), r["doc"]["doc_id"]


def test_thresholds_keep_the_promise(spark):
    """Clean texts and junk with symbols: junk goes, and at most the allowed share of clean ones."""
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        junk = i % 4 == 0
        words = [f"word{rnd.randrange(10**6)}" + ("***" if junk else "") for _ in range(80)]
        rows.append((i, " ".join(words), "en" if i % 2 else None))
        labels.append((i, 0 if junk else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r["id"]: r["kept"] for r in rules.judge(docs, lab).select(F.col("doc.doc_id").alias("id"), "kept").collect()}
    assert all(out[i] == (i % 4 != 0) for i in out)
    # Without labels nothing is proven, so only the base rules reject.
    none = rules.judge(docs, lab.limit(0))
    assert none.filter("not kept").isEmpty()


def test_rules_on_awkward_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (99, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    out = rules.judge(odd_docs, labels)
    assert out.count() == odd_docs.count() and out.select("doc.*").columns == odd_docs.columns
    assert out.filter("doc.text is null").select("base_failed").distinct().collect() == [(True,)]
    assert rules.judge(no_docs, labels).isEmpty()


# Near copies ------------------------------------------------------------------------------

def copies(rnd, n, words, edits, vocabulary):
    base = [rnd.choice(vocabulary) for _ in range(words)]
    for _ in range(n):
        text = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            text[rnd.randrange(words)] = rnd.choice(vocabulary)
        yield " ".join(text)


@pytest.mark.parametrize("similarity", [Similarity(3, 90), Similarity(5, 80), Similarity(2, 60)])
def test_components_by_brute_force(spark, similarity):
    """Groups of near copies around the threshold, one larger than what is compared one by one."""
    rnd = random.Random(similarity.part)
    vocabulary = [f"v{i}" for i in range(400)] + ["the"] * 60
    texts = [t for n, words, edits in ((130, 60, 6), (40, 12, 2), (30, 200, 25), (12, 4, 1))
             for t in copies(rnd, n, words, edits, vocabulary)]
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 40))) for _ in range(80)] + ["", " "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(docs, similarity).collect()}
    sets = {i: shingles(t, similarity.words) for i, t in enumerate(texts)}
    want = brute_components(sets, similarity.part)
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_near_copies_that_do_not_link_are_not_compared_one_by_one(spark, monkeypatch):
    """400 texts around one, each a little too far from it and the others: no pair of most is written out."""
    draw, compared, overlaps = random.Random(5), [], jaccard.overlaps
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(400):
        words = list(base)
        for j, at in enumerate(draw.sample(range(2, 118), 2)):
            words[at] = f"x{i}_{j}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(jaccard, "overlaps", lambda pairs, segments: compared.append(pairs.count()) or overlaps(pairs, segments))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_classes(docs, Similarity(3, 90)).collect()}
    assert got == brute_components({i: shingles(t, 3) for i, t in enumerate(texts)}, 90)
    assert len(set(got.values())) > 100 and sum(compared) < 10 * len(texts)


def test_only_pairs_that_may_link_are_compared_whole(spark, monkeypatch):
    """Texts of shared long sentences meet often and seldom link: sizes and the first range end most pairs."""
    draw, compared, overlaps, rule = random.Random(3), [], jaccard.overlaps, Similarity(5, 80)
    pool = [" ".join(f"s{k}w{j}" for j in range(60)) for k in range(30)]
    texts = [" ".join(draw.sample(pool, draw.randrange(1, 9))) for _ in range(150)]
    texts += [t + " end" for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def noting(pairs, segments):
        whole = segments.filter("at > 0").count() > 0
        compared.append((whole, [(r["a"], r["b"]) for r in pairs.select("a", "b").collect()]))
        return overlaps(pairs, segments)

    monkeypatch.setattr(jaccard, "overlaps", noting)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_classes(docs, rule).collect()}
    sets = {i: shingles(t, 5) for i, t in enumerate(texts)}
    assert got == brute_components(sets, 80)
    first, whole = ([pair for w, pairs in compared if w is kind for pair in pairs] for kind in (False, True))
    assert all(100 * min(len(sets[a]), len(sets[b])) >= 79 * max(len(sets[a]), len(sets[b])) for a, b in first + whole)
    assert 0 < len(whole) < len(first)


def test_linked_sets_share_a_key():
    rnd = random.Random(8)
    for s in (Similarity(3, 90), Similarity(5, 80)):
        for _ in range(300):
            a = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(8, 120))]
            b = list(a)
            for _ in range(rnd.randrange(4)):
                b[rnd.randrange(len(b))] = "zz"
            b += ["tail"] * rnd.randrange(2)
            x, y = shingle_set(" ".join(a), s.words), shingle_set(" ".join(b), s.words)
            common = len(set(x) & set(y))
            if len(x) and common < len(set(x) | set(y)) and 100 * common >= s.part * len(set(x) | set(y)):
                assert set(s.keys(x)) & set(s.keys(y))
                order = np.random.default_rng(len(x)).integers(0, 4, 1 << 16).astype(np.uint8)
                x_level, y_level = (order[(z >> np.uint64(48)).astype(np.int64)] for z in (x, y))
                assert set(s.prefix(x, x_level)) & set(s.prefix(y, y_level))


def test_linked_sets_share_as_many_of_the_rarest_as_they_ask_for(spark):
    rnd, linked = random.Random(4), 0
    for s in (Similarity(5, 80), Similarity(2, 60)):
        least = [r[0] for r in spark.range(1000).orderBy("id").select(s.least_column(F.col("id"))).collect()]
        assert least[400] == 1 + 400 * s.part // 100 // 20 and least[1] == 1
        for _ in range(300):
            x = np.unique(np.array([rnd.getrandbits(64) for _ in range(rnd.randrange(1, 400))], np.uint64))
            keep = x[: max(1, len(x) - rnd.randrange(1 + len(x) * (s.whole - s.part) // s.whole))]
            room = max(0, len(keep) * s.whole // s.part - len(x))
            y = np.unique(np.concatenate([keep, np.array([rnd.getrandbits(64) for _ in range(rnd.randrange(1 + room))], np.uint64)]))
            common = len(set(x) & set(y))
            if 100 * common >= s.part * len(set(x) | set(y)):
                order = np.random.default_rng(len(x)).integers(0, 4, 1 << 16).astype(np.uint8)
                a, b = (set(s.prefix(z, order[(z >> np.uint64(48)).astype(np.int64)])) for z in (x, y))
                assert len(a & b) >= max(least[len(x)], least[len(y)])
                linked += 1
    assert linked > 200


def test_documents_that_meet_by_chance_are_not_compared(spark, monkeypatch):
    """Each text shares short passages with many others; counters that are all alike, as with far more shingles than counters."""
    draw, compared, sent, overlaps, segments = random.Random(6), [], [], jaccard.overlaps, jaccard.Join.segments
    passages = [" ".join(f"p{k}w{j}" for j in range(6)) for k in range(400)]
    texts = []
    for i in range(120):
        own = [f"d{i}w{j}" for j in range(200)]
        for k in draw.sample(range(400), 8):
            own[draw.randrange(200)] = passages[k]
        texts.append(" ".join(own))
    texts += [t + " end" for t in texts[:10]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(jaccard, "levels", lambda *a: np.zeros(rarity.COUNTERS, np.uint8))
    monkeypatch.setattr(jaccard, "overlaps", lambda pairs, parts: compared.append(pairs.count()) or overlaps(pairs, parts))

    def noting(self, met):
        sent.append(met.select("node").distinct().count())
        return segments(self, met)

    monkeypatch.setattr(jaccard.Join, "segments", noting)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_classes(docs, Similarity(5, 80)).collect()}
    assert got == brute_components({i: shingles(t, 5) for i, t in enumerate(texts)}, 80)
    assert sent == [20] and compared[0] == 10


def test_near_copies_leave_little_behind(spark, monkeypatch):
    """What was written or shuffled on the way is deleted before the documents themselves are moved."""
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))

    rnd, written, write = random.Random(9), [], scale.materialize
    texts = list(copies(rnd, 60, 60, 6, [f"v{i}" for i in range(400)]))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")

    def noting(df):
        out = write(df)
        written.extend({path.removeprefix("file:").rsplit("/", 1)[0] for path in out.inputFiles()})
        return out

    monkeypatch.setattr(scale, "materialize", noting)
    before = shuffled()
    kept = jaccard.one_of_each(docs, Similarity(5, 80))
    for _ in range(50):  # deleted in the background
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    # The files are named file:///..., file:/... or /... .
    there = [d for d in written if os.path.exists("/" + d.lstrip("/"))]
    assert len(written) > 10 and len(there) == 1
    assert 0 < kept.count() < len(texts)


def test_common_shingles_have_higher_levels(spark):
    """Levels follow the number of documents, over several tasks, nulls and an empty table."""
    texts = [f"shared words here own{i}" for i in range(40)] + ["rare three words", None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    got = rarity.levels(docs, 3)
    common, rare = (got[rarity.place(shingle_set(t, 3))][0] for t in ("shared words here", "rare three words"))
    assert common == int(8 * np.log2(41)) and rare == 8
    assert not rarity.levels(docs.limit(0), 3).any()


def test_near_copies_on_awkward_rows(odd_docs, no_docs):
    out = jaccard.jaccard_classes(odd_docs, Similarity(5, 80))
    assert out.count() == odd_docs.count()
    kept = jaccard.one_of_each(odd_docs, Similarity(5, 80))
    assert kept.columns == odd_docs.columns
    # 1 and 2 are copies and the null id nearly one; 6 and 7 are near copies; empty texts all stay.
    assert ids(kept) == [1, 3, 4, 5, 6, 8, 8, 9, 10, 11, None]
    assert jaccard.jaccard_classes(no_docs, Similarity(5, 80)).isEmpty()
    assert jaccard.one_of_each(no_docs, Similarity(5, 80)).isEmpty()


def test_components_of_a_long_path(spark):
    n = 70
    order = list(range(n))
    random.Random(2).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(n)}, 500: 500, 501: 500}


# Decontamination --------------------------------------------------------------------------

def brute_hits(text, items):
    def words(t):
        low = (t or "").translate({i: i + 32 for i in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    doc, hit, named = words(text), set(), set()
    for item, t in items:
        w = words(t)
        size = min(10, len(w))
        for window in {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else ():
            for i in range(len(doc) - size + 1):
                if tuple(doc[i:i + size]) == window:
                    hit.update(range(i, i + size))
                    if item is not None:
                        named.add(str(item))
    return len(doc), len(hit), sorted(named)


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 5])
def test_hits_by_brute_force(spark, odd_docs, block):
    rnd = random.Random(4)
    items = [(i, " ".join(rnd.choice("abcdef") for _ in range(rnd.randrange(14)))) for i in range(25)]
    items += [(None, "the quick brown fox"), (30, None), (31, "Naïve, CAFÉ!"), (31, "one"), (3, items[3][1])]
    texts = [" ".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(60))) for _ in range(40)]
    docs = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for table in (docs, odd_docs):
        found = decontaminate.hits(table, benchmark, block=block)
        for r in found.select("doc.doc_id", "doc.text", "hits.n_words", "hits.n_hit", "hits.items").collect():
            assert (r["n_words"], r["n_hit"], r["items"]) == brute_hits(r["text"], items), r["doc_id"]


def test_decontamination_cuts_or_drops(spark, odd_docs, no_docs):
    passage = " ".join(f"secret{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"Before, {passage}! After"), (2, "clean text"), (3, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, passage)], "item_id long, text string")
    assert ids(decontaminate.decontaminate(docs, benchmark)) == [2, 3]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, benchmark, drop_above=0.9).collect()}
    assert cut == {1: "Before, ! After", 2: "clean text", 3: None}
    assert decontaminate.decontaminate(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
    assert decontaminate.decontaminate(no_docs, benchmark).isEmpty()


# Tokens -----------------------------------------------------------------------------------

def test_token_counts_are_the_library_s(odd_docs, no_docs, spark):
    model = tokenizer_path("piece_bpe_32k.model")
    counter = tokens.TokenCounter(model)
    assert counter.separable and len(counter.single) > 10_000
    rnd = random.Random(6)
    parts = [" ", "  ", "\n", "\t", "\r", "a", "the", "é", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "中", "😀", "\u3000", "ﬁ", ".", "123", "\x00"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(15))) for _ in range(3000)]
    assert counter.count(texts) == [len(x) for x in counter.library.encode(texts, num_threads=1)]
    out = {(r["doc_id"], r["n_bytes"]): r["n_tokens"] for r in tokens.token_counts(odd_docs, model).collect()}
    for r in odd_docs.collect():
        text = r["text"] or ""
        assert out[r["doc_id"], len(text.encode())] == len(counter.library.encode(text))
    assert tokens.token_counts(no_docs, model).isEmpty()


def test_forgetting_changes_no_count(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 16_000)
    counter = tokens.TokenCounter(tokenizer_path("piece_bpe_32k.model"))
    texts = [" ".join(f"qz{i}x{j}" for j in range(30)) for i in range(60)]
    assert counter.count(texts) == [len(x) for x in counter.library.encode(texts, num_threads=1)]


# Mixing -----------------------------------------------------------------------------------

def test_mix_meets_targets(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randrange(1, 30), "hot" if i % 3 == 0 else f"s{i % 7}" if i % 50 else None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.fair_mix(docs)
    total = sum(r["size"] for r in mix.collect())
    by_source = mix.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.first("source_size").alias("s")).collect()
    assert sum(r["t"] for r in by_source) == pytest.approx(1.5 * total, abs=1)
    for r in by_source:
        assert abs(r["n"] - r["t"]) <= 60 and r["t"] <= 2 * r["s"]
    assert mix.filter("taken > 2 * size").isEmpty()
    again = mixing.fair_mix(docs.repartition(7))
    assert {(r["doc_id"], r["taken"]) for r in mix.collect()} == {(r["doc_id"], r["taken"]) for r in again.collect()}
    assert mixing.mixed_documents(docs).count() == mix.agg(F.sum("passes")).first()[0]


def test_mix_on_awkward_rows(odd_docs, no_docs):
    mix = mixing.fair_mix(odd_docs)
    assert mix.count() == odd_docs.count()
    assert {r["taken"] for r in mix.filter("size = 0").collect()} == {0}
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    assert mixing.fair_mix(no_docs).isEmpty() and mixing.mixed_documents(no_docs).isEmpty()


# Sharding ---------------------------------------------------------------------------------

def test_shards_are_near_equal_and_gapless(spark):
    rnd = random.Random(9)
    docs = spark.createDataFrame([(i, "x" * rnd.randrange(400)) for i in range(9000)], "doc_id long, text string")
    out = slots.shard_documents(docs).collect()
    load, places = defaultdict(int), defaultdict(list)
    for r in out:
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert sorted(load) == list(range(24)) and max(load.values()) < 1.02 * min(load.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["size"] == len(texts[r["doc_id"]]) + 8 for r in out)


def test_growing_moves_rows_to_the_new_shard_only(spark):
    docs = spark.createDataFrame([(i, "y" * (i % 91)) for i in range(20_000)], "doc_id long, text string")
    recs = slots.records(docs)
    old = slots.first_map(spark, slots.slot_totals(recs), 24)
    new = slots.grow_map(old, 25)
    a, b = ({r["virtual_slot"]: r for r in m.collect()} for m in (old, new))
    moved = [s for s in a if a[s]["shard"] != b[s]["shard"]]
    assert moved and {b[s]["shard"] for s in moved} == {24} and {r["version"] for r in b.values()} == {2}
    load = Counter()
    for r in b.values():
        load[r["shard"]] += r["slot_bytes"]
    assert max(load.values()) < 1.6 * min(load.values())
    assert len(a) == slots.SLOTS


def test_the_stored_map_is_kept_and_edited(spark, tmp_path):
    def table(rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    def run(rows, shards=24):
        out = slots.shard_documents(table(rows), shards, maps=str(tmp_path / "m")).collect()
        load, places = defaultdict(int), defaultdict(list)
        for r in out:
            load[r["shard"]] += r["size"]
            places[r["shard"]].append(r["slot"])
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
        (version,) = {r["map_version"] for r in out}
        return {r["virtual_slot"]: r["shard"] for r in out}, version, load

    assert slots.shard_documents(table([]), maps=str(tmp_path / "m")).isEmpty()
    rows = [(i, "x" * (i % 97)) for i in range(20_000)]
    first, version, _ = run(rows)
    assert version == 1
    again, version, _ = run(rows + [(i, "x") for i in range(20_000, 20_020)])
    assert version == 1 and all(again[s] == first[s] for s in first)  # a few more rows move nothing
    full = [s for s in first if first[s] == 0]
    ids = {r["virtual_slot"]: r["n"] for r in slots.records(table(rows)).groupBy("virtual_slot").agg(F.max("doc_id").alias("n")).collect()}
    rows += [(ids[s], rows[ids[s]][1]) for s in full for _ in range(5)]  # shard 0 has drifted
    drifted, version, load = run(rows)
    moved = {s for s in first if drifted[s] != first[s]}
    assert version == 2 and moved and {first[s] for s in moved} == {0} and max(load.values()) < 1.1 * min(load.values())
    grown, version, load = run(rows, 25)
    moved = {s for s in drifted if grown[s] != drifted[s]}
    assert version == 3 and {grown[s] for s in moved} == {24} and len(load) == 25
    assert run(rows, 25)[1] == 3 and set(run(rows, 20)[2]) == set(range(20))


def test_shards_on_awkward_rows(odd_docs, no_docs):
    out = slots.shard_documents(odd_docs)
    assert out.count() == odd_docs.count() and out.filter("text_crc32 is null or shard is null").isEmpty()
    assert slots.with_shard(odd_docs).columns == [*odd_docs.columns, "virtual_slot", "shard"]
    assert slots.shard_documents(no_docs).isEmpty() and slots.with_shard(no_docs).isEmpty()


# Licences ---------------------------------------------------------------------------------

def test_licences_in_all_spellings(spark, odd_docs, no_docs):
    mit = "The MIT Licence (MIT)\n\nCopyright (c) 2020 Somebody\n\n" + licenses.MIT_GRANT.lower().replace("copyright holders", "Copyright Holder")
    docs = spark.createDataFrame([
        (1, mit), (2, "Some prose.\n  LICENSED under the Apache Licence, version 2.0\nMore."),
        (3, "Licensed under CC BY-NC 4.0."), (4, licenses.MIT_GRANT + " And more."), (5, None), (6, ""),
        (7, "a\nReleased under the MIT License.\nThis work is licensed under the GNU General Public License, version 3."),
    ], "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in licenses.scan_licenses(docs).collect()}
    assert got == {1: ("MIT", ""), 2: (None, "Apache-2.0"), 3: ("CC-BY-NC-4.0", "CC-BY-NC-4.0"), 4: (None, ""),
                   5: (None, ""), 6: (None, ""), 7: (None, "GPL-3.0-only,MIT")}
    assert licenses.scan_licenses(odd_docs).count() == odd_docs.count()
    assert licenses.scan_licenses(no_docs).isEmpty()


def test_every_known_licence_is_found_and_marked(spark):
    assert all(re.search(licenses.marks(licenses.KNOWN).replace("(?iu)", "(?i)"), text) for _, text in licenses.KNOWN)
    docs = spark.createDataFrame([(i, t.upper()) for i, (_, t) in enumerate(licenses.KNOWN)], "doc_id long, text string")
    assert {r["doc_id"]: r["license"] for r in licenses.scan_licenses(docs).collect()} == {
        i: name for i, (name, _) in enumerate(licenses.KNOWN)}


def wrapped(text, width):
    """The text's paragraphs at another width; without one, all of it on a line."""
    if not width:
        return " ".join(text.split())
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False) for p in text.split("\n\n"))


def test_licences_at_every_width(spark):
    widths = (None, 30, 40, 60, *range(68, 82), 100, 120, 10_000)
    head = "\n\nCopyright (c) 2020 Some Body\n(c) 2021 Others. All rights reserved.\n\n"
    rows = [(f"{name} {w} {i}", wrapped(t, w)) for i, (name, t) in enumerate(licenses.KNOWN) for w in widths]
    rows += [(f"MIT {w} head", "MIT License" + head + wrapped(licenses.MIT_GRANT, w)) for w in widths]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licenses(docs).collect()}
    assert {k: v for k, v in got.items() if v != k.split()[0]} == {}


def test_only_notices_at_the_head_are_left_out(spark):
    lines = {
        "Copyright (c) 2020 A": "", "/* Copyright 2020, A. */": "", "© A": "", "(C) 1999-2003 A": "", "Copyright: 2020 A": "",
        "Copyright <YEAR> <HOLDER>": "", "Copyright (c) 2020 A\n# All rights reserved.\nb": "b",
        "Copyright holders be liable": "copyright owner be liable", "(c) You must retain": "c you must retain",
        "copyright notice": "copyright notice", "a\n" * 9 + "Copyright (c) 2020 A": "a " * 9 + "copyright c 2020 a",
        "Copyright 2020 A Permission is hereby granted": "permission is hereby granted",
    }
    docs = spark.createDataFrame(list(lines.items()), "text string, want string")
    got = docs.select("text", "want", licenses.canonical(F.col("text")).alias("got")).filter("got <> want").collect()
    assert got == []


def test_grants_within_a_text(spark):
    """Every known text of several lines in a commented source file, in several wrappings."""
    rows = []
    for i, (name, text) in enumerate(licenses.KNOWN):
        for w in (40, 72, 78, 10_000):
            lines = wrapped(text, w).split("\n")
            body = "\n".join(" * " + x for x in ["Copyright (c) 2020 Some Body", "", *lines])
            rows.append((f"{name} {w} {i}", f"#!/bin/x\n/* A program.\n *\n{body}\n */\n\nint main() {{}}\n"))
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r["doc_id"]: (r["license"], r["grants"]) for r in licenses.scan_licenses(docs).collect()}
    assert {k: v for k, v in got.items() if v != (None, k.split()[0])} == {}


def test_licences_of_other_holders_and_parts(spark):
    bsd = licenses.BSD_3.replace("the copyright holder nor", "the University of X nor")
    docs = spark.createDataFrame([
        (1, "BSD 3-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n" + bsd), (2, bsd[:-200]),
        (3, "Prose.\n\n" + licenses.GNU_HEADERS[0][1] + "\n\nMore.\n\n" + licenses.APACHE_HEADER + "\n\n" + licenses.MIT_GRANT),
        (4, licenses.MIT_GRANT.replace("\n\n", "\n\nOther words.\n\n")), (5, "Own licence.\n\nBe kind."),
    ], "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["grants"]) for r in licenses.scan_licenses(docs).collect()}
    assert got == {1: ("BSD-3-Clause", "BSD-3-Clause"), 2: (None, ""), 3: (None, "Apache-2.0,GPL-3.0-or-later,MIT"), 4: (None, ""), 5: (None, "")}
    own = {r["doc_id"]: (r["license"], r["grants"]) for r in licenses.scan_licenses(docs, [("Own", "own license\n\nbe kind")], []).collect()}
    assert own[5] == ("Own", "Own") and own[1] == (None, "")


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="Debian's texts are not here")
def test_digests_of_long_texts(spark):
    files = {"GPL-2.0-only": "GPL-2", "GPL-3.0-only": "GPL-3", "LGPL-2.1-only": "LGPL-2.1", "LGPL-3.0-only": "LGPL-3"}
    rows = []
    for name, _ in licenses.DIGESTS:
        with open(f"/usr/share/common-licenses/{files.get(name, name)}") as f:
            rows.append((name, f.read()))
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert all(r["license"] == r["doc_id"] for r in licenses.scan_licenses(docs).collect())


# Licences by brute force --------------------------------------------------------------------

def brute_canonical(text):
    """The canonical form in Python."""
    import regex

    def java(p):
        return p.replace("\\z", "\\Z")

    out = regex.sub(java(licenses.NOTICE), r"\1", text).lower()
    out = regex.sub(r"[^\p{L}\p{N}]+", " ", out).strip(" ")
    for pattern, written in licenses.SPELLINGS:
        out = regex.sub(java(pattern), written.replace("$", "\\"), out)
    return out


def brute_scan(text, known, digests):
    """(license, notices, grants) of a text by its definition, every line and every run of blocks looked up."""
    import regex

    def blocks(t):
        return [f for f in map(brute_canonical, regex.split(licenses.BLOCK, t)) if f]

    forms = {}
    for name, t in known:
        form = brute_canonical(t)
        forms[form] = min(name, forms.get(form, name))
    by_digest = {hashlib.md5(f.encode()).hexdigest(): n for f, n in forms.items()}
    for name, digest in digests:
        by_digest[digest] = min(name, by_digest.get(digest, name))
    form = brute_canonical(text or "")
    whole = by_digest.get(hashlib.md5(form.encode()).hexdigest()) if form else None
    notices = {forms[f] for f in map(brute_canonical, (text or "").split("\n")) if f in forms}
    mine, grants = blocks(text or ""), set()
    for name, t in known:
        theirs = blocks(t)
        if any(mine[i : i + len(theirs)] == theirs for i in range(len(mine) - len(theirs) + 1)):
            grants.add(name)
    return whole, ",".join(sorted(notices)), ",".join(sorted(grants))


OWN = [("FOO", "All rights granted to everyone"), ("BAR", "Do what you want.\n\nBut tell nobody.")]


@pytest.mark.parametrize("known", [licenses.KNOWN, OWN, [*licenses.KNOWN, *OWN]])
def test_licences_by_brute_force(spark, known):
    texts = [t for _, t in known]
    some = [*texts, *(textwrap.fill(t, 66) for t in texts if "\n\n" not in t), None, "", "  \n", "nothing at all",
            "x = 1\n\n" + OWN[1][1] + "\n\nmore", "before\nALL RIGHTS -- granted to everyone!\nafter", OWN[1][1].replace("\n", " "),
            "Copyright (c) 2020 Somebody\n\n" + texts[0], "// " + texts[0].replace("\n", "\n// "),
            *(t.upper() for t in texts[:6]), *(t.replace("license", "licence") for t in texts[:6])]
    some += [a + "\n\n" + b for a, b in zip(texts[::3], texts[1::3])]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["notices"], r["grants"]) for r in licenses.scan_licenses(docs, known).collect()}
    for i, text in enumerate(some):
        assert got[i] == brute_scan(text, known, licenses.DIGESTS), (i, text)


def test_a_long_holder_name_is_no_other_licence(spark):
    text = next(t for name, t in licenses.KNOWN if name == "BSD-3-Clause" and "either the name" in t)
    named = re.sub(r"(?i)(neither the name of ).*?( nor)", lambda m: m[1] + "the very long named foundation " * 9 + "inc" + m[2], text, flags=re.S)
    assert named != text
    row = licenses.scan_licenses(spark.createDataFrame([(1, named)], "doc_id long, text string")).first()
    assert row["license"] == "BSD-3-Clause" and "BSD-3-Clause" in row["grants"]


# Decontamination in blocks ------------------------------------------------------------------

def test_blocks_of_windows_give_the_same(spark, sf, odd_docs):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        rows = []
        for block in (1_000_000, 150):
            found = decontaminate.hits(docs, bench, block=block)
            rows.append(Counter(
                (str(r["doc"]["doc_id"]), r["doc"]["text"], r["hits"]["n_words"], r["hits"]["n_hit"], tuple(r["hits"]["items"]))
                for r in found.collect()))
            assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") <= 1
        assert rows[0] == rows[1]
