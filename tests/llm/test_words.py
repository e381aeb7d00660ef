"""Language identification, periodic runs and phrases against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import langid, phrases, queries, runs
from llm_helpers import ids, no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})


def brute_runs(words, least=runs.MIN_LENGTH):
    number, found = {}, {}
    a = np.array([number.setdefault(w, len(number)) for w in words])
    for q in range(1, len(a) // 2 + 1):
        step = np.diff(np.concatenate([[0], (a[:-q] == a[q:]).astype(int), [0]]))
        for start, end in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
            if end - start + q >= max(least, 2 * q):
                found.setdefault((int(start), int(end - start + q)), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, spans):
    dropped = {i for s, n, q in spans for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def repetitive(rnd):
    kinds, n = rnd.choice([1, 2, 3, 5, 30]), rnd.randint(0, 90)
    words = [f"w{rnd.randrange(kinds)}" for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        if n > 10:
            a, p = rnd.randrange(n - 5), rnd.randint(1, 20)
            for i in range(a + p, min(n, a + rnd.randint(5, 80))):
                words[i] = words[i - p]
    return words


def test_runs_equal_brute_force_on_repetitive_texts():
    rnd = random.Random(5)
    for _ in range(150):
        texts = [repetitive(rnd) for _ in range(rnd.randint(1, 10))]
        for words, (spans, collapsed) in zip(texts, runs.searched([" ".join(t) for t in texts])):
            assert spans == brute_runs(words)
            assert collapsed == brute_collapsed(words, spans)


def test_runs_of_fibonacci_words_and_long_periods():
    a, b = ["x"], ["x", "y"]
    while len(b) < 400:
        a, b = b, b + a
    period = [f"p{i}" for i in range(700)]
    for words in (b, ["z"] * 3000, period * 3 + period[:50], ["u", "v"] * 10 + period * 2 + ["v"] * 40):
        (spans, collapsed), = runs.searched([" ".join(words)])
        assert spans == brute_runs(words)
        assert collapsed == brute_collapsed(words, spans)


def test_runs_when_hashes_collide(monkeypatch):
    """With hashes of a few values wrong stretches are found, noticed and searched again under others."""
    monkeypatch.setattr(runs, "_PRIMES", (np.uint64(1009), np.uint64(1013)))
    rnd = random.Random(8)
    for _ in range(30):
        words = repetitive(rnd) + [f"n{i}" for i in range(400)]
        (spans, _), = runs.searched([" ".join(words)])
        assert all(words[s : s + n - q] == words[s + q : s + n] for s, n, q in spans)


def test_runs_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        spans = brute_runs(words)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in spans)
        s, m, q = min(spans, key=lambda r: (-r[1], r[0], r[2])) if spans else (None, None, None)
        want = {
            "doc_id": d["doc_id"], "n_runs": len(spans), "start": s, "length": m, "period": q,
            "exponent_milli": 1000 * m // q if spans else None,
            "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(brute_collapsed(words, spans).encode()).hexdigest(),
        }
        assert got[d["doc_id"]].asDict() == want
    assert planted > 50


def test_runs_of_odd_rows(odd_docs, no_docs):
    out = runs.periodic_runs(odd_docs).collect()
    assert sorted(map(str, (r["doc"]["doc_id"] for r in out))) == sorted(map(str, ids(odd_docs)))
    for r in out:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["doc"]["text"] or "")
        if len(words) < 5000:
            spans = [(x["start"], x["length"], x["period"]) for x in r["runs"]]
            assert spans == brute_runs(words) and r["collapsed"] == brute_collapsed(words, spans)
    assert runs.periodic_runs(no_docs).count() == 0
    planted = queries.with_planted_period(odd_docs).collect()
    assert len(planted) == odd_docs.count()
    assert {r["text"] for r in planted if r["doc_id"] == 4} == {""}
    assert {r["text"] for r in planted if r["doc_id"] == 3} == {None}


def test_language_of_held_out_documents(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_language_id(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == langid.is_held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert len(held) > 100 and right >= 0.98 * len(held)


@pytest.fixture(scope="module")
def learnt(spark):
    rows = [
        (1, "the cat sat on the mat with the cat", "en"), (2, "the dog and the cat", "en"),
        (3, "der hund und die katze und der hund", "de"), (4, "die katze und der hund", "de"), (5, "ignored", None),
    ]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def brute_score(model_rows, langs, text):
    """Scores by the definition, from (lang, word) counts."""
    table = {}
    for order in (0, *langid.ORDERS):
        counts = {lang: Counter() for lang in langs}
        for lang, word, n in model_rows:
            for g in [word] if order == 0 else langid.grams(word, order):
                counts[lang][g] += n
        for lang in langs:
            total = sum(counts[lang].values())
            for g, n in counts[lang].items():
                if n >= langid.LEAST:
                    table.setdefault((order, g), {})[lang] = -np.log10(n / total)
    sums, n = dict.fromkeys(langs, 0.0), 0
    for word in langid.words_of(text):
        for order in (0, *langid.ORDERS):
            keys = [k for k in [(order, g) for g in ([word] if order == 0 else langid.grams(word, order))] if k in table]
            if keys:
                for lang in langs:
                    sums[lang] += sum(table[k].get(lang, langid.MISSING) for k in keys) / len(keys)
                n += 1
                break
    means = {lang: sums[lang] / max(n, 1) for lang in langs}
    best = min(langs, key=lambda x: round(means[x], 9))
    return best, 1 / sum(10 ** (means[best] - m) for m in means.values())


def test_language_scores_follow_the_definition(learnt):
    counted = Counter()
    for lang, text in [("en", "the cat sat on the mat with the cat the dog and the cat"),
                       ("de", "der hund und die katze und der hund die katze und der hund")]:
        counted.update((lang, w) for w in text.split())
    rows = [(lang, w, n) for (lang, w), n in counted.items()]
    for text in ("the cat", "und die hunde", "catze", "mathund thee", "Der THE", "xyz qqq the"):
        want, score = brute_score(rows, learnt.languages, text)
        assert learnt.judge(text, {}) == (want, pytest.approx(score, abs=1e-6))


def test_language_of_texts_without_letters_and_of_unknown_letters(learnt):
    assert [learnt.judge(t, {}) for t in (None, "", " \n", "12 ½ ² _ --- 3.4")] == [("und", 0.0)] * 4
    lang, score = learnt.judge("ззз жжж", {})
    assert lang in learnt.languages and score == 0.5
    assert langid.LanguageModel([], []).judge("text", {}) == ("und", 0.0)


def test_language_of_odd_rows(odd_docs, no_docs):
    model = langid.fit(odd_docs)
    out = langid.identify(odd_docs, model).collect()
    assert len(out) == odd_docs.count()
    assert {r["lang_pred"] for r in out if r["doc"]["text"] is None} == {"und"}
    assert {r["lang_pred"] for r in out if (r["doc"]["text"] or "").strip()} <= set(model.languages)
    assert langid.identify(no_docs, langid.fit(no_docs)).count() == 0


def test_language_sample_is_bounded_and_even(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("lang"),
        F.concat(F.lit("word word "), F.col("id").cast("string")).alias("text"),
    )
    names, rows = langid.sample(docs, 10_000, 5)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    assert names == ["a", "b"] and all(3500 < n <= 5000 for n in sizes.values())
    assert langid.sample(docs, 10_000, 1)[0] == ["a"]


def brute_counts(texts, depth):
    out = Counter()
    for text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            out.update(" ".join(words[i : i + k]) for k in range(1, depth + 1) for i in range(len(words) - k + 1))
    return out


def brute_collocations(texts, depth, least, inside, top):
    f = brute_counts(texts, depth)
    found = {p: n for p, n in f.items() if " " in p and n >= least}
    rows, around = [], Counter()
    for longer, n in found.items():
        words = longer.split(" ")
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = " ".join(words[i : i + k])
                around[part] = max(around[part], n)
    for phrase, a in found.items():
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = f[" ".join(words[:k])], f[" ".join(words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        if 100 * around[phrase] < inside * a:
            rows.append((-score, -a, phrase.encode(), left, right))
    n = sum(c for p, c in f.items() if " " not in p)
    return [(i + 1, p.decode(), -a, left, right, n, -score) for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top])]


def random_texts(rnd, n, kinds):
    return [
        "".join(rnd.choice(["A", "b", "é", "d\x0be", "x;", "n\xa0b", "c\x1cd"]) + str(rnd.randrange(kinds))
                + rnd.choice([" ", "  ", " \t", ". ", "\n", " "]) for _ in range(rnd.randint(0, 80)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("depth,kinds", [(2, 3), (3, 1), (3, 4), (4, 2)])
def test_phrases_equal_brute_force(spark, depth, kinds):
    rnd = random.Random(depth * 10 + kinds)
    texts = {"en": random_texts(rnd, 30, kinds), "fr": random_texts(rnd, 10, kinds), None: random_texts(rnd, 10, kinds)}
    rows = [(i, lang, text, "x", 1) for lang, some in texts.items() for i, text in enumerate([*some, None, ""])]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, phrase string, n int")
    out = phrases.collocations(docs.repartition(5), depth, 3, 50, 40).collect()
    for lang, some in texts.items():
        got = sorted(tuple(r)[1:] for r in out if r["lang"] == (lang or "und"))
        assert got == brute_collocations(some, depth, 3, 50, 40)


def test_phrase_scores_beyond_64_bits(spark):
    """Counts whose squares times a million pass 64 bits."""
    rows = [("en", "a", 1, 5_000_000_000), ("en", "b", 1, 4_000_000_001), ("en", "a b", 2, 3_999_999_999)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    totals = spark.createDataFrame([("en", 10**10)], "lang string, n long")
    row, = phrases.ranked_phrases(totals, counts, 50, 10).collect()
    assert row["score"] == 10**6 * 3_999_999_999**2 // (5_000_000_000 * 4_000_000_001)


def test_phrases_across_small_shards(spark, monkeypatch):
    """Very long texts are cut between pieces; the sum over shards is the whole text's count."""
    import pyarrow as pa

    monkeypatch.setattr(phrases, "SHARD", 50)
    rnd = random.Random(1)
    texts = [" ".join(random_texts(rnd, 30, 2)), *random_texts(rnd, 5, 2), "one piece " * 60]
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    every = phrases.Frequent(np.full(phrases.BITS // 8, 255, np.uint8))
    got = Counter()
    for run in (phrases.shard_counts(2, phrases.short_counts, False), phrases.shard_counts(3, phrases.longer_counts(3, every), False)):
        for out in run([batch]):
            for phrase, n in zip(out.column(1).to_pylist(), out.column(2).to_pylist()):
                got[phrase] += n
    assert got == brute_counts(texts, 3)


def test_phrases_of_odd_rows(odd_docs, no_docs):
    out = phrases.collocations(odd_docs, least=2, top=20).collect()
    assert {r["lang"] for r in out} <= {"en", "de", "fr", "und"}
    texts = [r["text"] for r in odd_docs.collect() if r["lang"] == "en"]
    assert sorted(tuple(r)[1:] for r in out if r["lang"] == "en") == brute_collocations(texts, 3, 2, 50, 20)
    assert phrases.collocations(no_docs).count() == 0
