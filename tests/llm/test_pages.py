"""Operators on pages: extraction, URL filter, fixity audit."""

from __future__ import annotations

import hashlib
import html as entities
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import extract, fixity, urls

SCHEMA = "page_id long, url string, html string, host string, template string, digest string"


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (1, "http://A.Example.com/en/1?x=1", "<p>hello</p>"), (1, "http://A.Example.com/en/1?x=1", "<p>hello</p>"),
        (2, None, None), (3, "no scheme", ""), (4, "https://x.net/es/5", "<div <<< &amp; & <p>broken"),
        (None, "https://net/es/", "<article>" + "<p>word word</p>" * 20_000 + "</article>"), (5, "http://", None),
    ]
    return spark.createDataFrame([(*r, "h", "t", "d") for r in rows], SCHEMA)


# Extraction -------------------------------------------------------------------------------

def marked_text(page):
    """The article of a page whose markup says where it is."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br)[^>]*>", inner)
    text = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return " ".join(t for t in text if t)


def test_extraction_equals_the_marked_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r["page_id"]: r for r in extract.extract_text(pages).collect()}
    for r in pages.collect():
        want = marked_text(r["html"])
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_held_out_pages(spark, sf):
    """Weights from half of the pages, article marks taken away from the other half."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    weights = extract.fit(pages.filter("page_id % 2 = 0"))
    for r in pages.filter("page_id % 2 = 1").collect():
        unmarked = re.sub(r"(</?)article\b", r"\1div", r["html"])
        assert "<article" not in unmarked and extract.main_text(unmarked, weights) == marked_text(r["html"])


def test_tags_without_an_end_take_one_scan():
    import time

    weights = extract.Weights({})
    for piece in ("<a ", '<a "x', "<script ", "<!", "</b "):
        start = time.perf_counter()
        extract.main_text("<p>words</p>" + piece * 200_000, weights)
        assert time.perf_counter() - start < 2, piece
    for page, want in (("<p>a b c</p> tail <b unclosed", "a b c tail <b unclosed"), ("<p>a b c</p> tail <!-- <b gone", "a b c tail"),
                       ("<p>a b c</p><!-- x > y", "a b c"), ("<p>a b c</p><script>x > y", "a b c"), ("<p>a b c</p> 1 < 2", "a b c 1 < 2")):
        assert extract.main_text(page, weights) == want


def test_kinds_do_not_name_single_pages():
    assert extract.kind_of("div", ' class="post post-8812" id="x9"') == ("div.post", False)


def test_every_archive_of_the_drill_has_damage(spark, sf):
    out = fixity.fixity_audit(spark.read.parquet(f"{sf}/pages.parquet"), archive_bytes=20_000)
    bad = out.groupBy("archive").agg(F.count_if(F.col("status") == "changed").alias("n")).collect()
    assert len(bad) > 1 and all(r["n"] >= 1 for r in bad)
    rate = fixity.fixity_audit(spark.read.parquet(f"{sf}/pages.parquet"), one_in=4).groupBy("status").count().collect()
    assert {r["status"] for r in rate} == {"ok", "changed", "missing"}


def test_boilerplate_of_other_kinds():
    words = "real article text with several words in every sentence of it "
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header><p>Site name</p></header>
    <nav><ul><li><a>menu</a></li></ul></nav><article><h1>Head &amp; line</h1><p>{words * 3}</p><div class="ad">Buy now</div>
    <p>{words * 2}</p><ul><li>first point</li><li>second point</li></ul><section id="comments"><p>What a comment</p></section>
    <form><label>Name</label></form><script>var a = "<p>no</p>";</script><p>End.</p></article>
    <aside class="sidebar"><p>Other things</p></aside><div class="cookie-notice">We use cookies</div><footer>&copy; x</footer></body></html>"""
    want = f"Head & line {words * 3}{words * 2}first point second point End."
    assert extract.main_text(page, extract.Weights({})) == " ".join(want.split())


BODY = "<p>" + "real article text with several words in every sentence " * 4 + "</p>"
SIDE = "<nav><a>menu</a></nav>"
TEASER = "<article><p>" + "other page's teaser " * 3 + "</p></article>"


@pytest.mark.parametrize("page", [
    f"<html class='no-banner'><body class='single has-sidebar widget'>{SIDE}<article>{BODY}</article></body></html>",
    f"<body>{SIDE}<div id='page' class='with-header'><article>{BODY}</article></div></body>",
    f"<body><div class='reader share'><div class='form'><article>{BODY}</article></div></div>{SIDE}</body>",
    f"<body>{SIDE}<article class='post share-enabled'>{BODY}</article></body>",
    f"<body>{SIDE}<main id='reader' role='main'>{BODY}</main></body>",
    f"<body><form id='aspnetForm'>{SIDE}<main>{BODY}</main></form></body>",
    f"<body><div class='share'><article>{BODY}</article><div class='related'>{TEASER}</div></div></body>",
    f"<body><article>{BODY}</article><div class='related'>{TEASER}{TEASER}</div><aside>{TEASER}</aside></body>",
    f"<body><main>{BODY}<div class='comments'>{TEASER}</div></main></body>",
    f"<body><main><div class='comments'>{TEASER}{TEASER * 9}</div>{BODY}</main></body>",
    f"<body><main><div class='reader'><article>{BODY}</article></div></main></body>",
    f"<body>{SIDE}<div class='with-header entry'>{BODY}</div></body>",
])
def test_names_of_containers_around_the_article(spark, page):
    want = " ".join(re.sub("<[^>]*>", " ", BODY).split())
    assert extract.main_text(page, extract.Weights({})) == want
    fitted = extract.fit(spark.createDataFrame([(i, page) for i in range(5)], "page_id long, html string"))
    if re.search("<(article|main)", page):
        assert extract.main_text(page, fitted) == want


def test_extraction_on_awkward_rows(odd_pages):
    out = extract.extract_text(odd_pages).collect()
    assert len(out) == odd_pages.count()
    text = {r["page_id"]: r["text"] for r in out}
    assert text[2] == text[3] == text[5] == "" and text[1] == "hello" and text[None] == " ".join(["word word"] * 20_000)
    assert extract.extract_text(odd_pages.limit(0)).isEmpty()


# URL filter -------------------------------------------------------------------------------

def brute_rule(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = [(h + p, a) for a, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda f: len(f[0])) if fits else None


def test_rules_by_brute_force(spark, sf, odd_pages):
    more = [("http://www.example.com/en/x",), ("http://sub.www.example.com/en/",), ("http://example.com/en",), ("HTTP://COM/",),
            ("a://net/fr/1#x",), ("://net/es/?q",), ("http://com?x/y",), ("http://x.com#/en/",), ("http://u.com/a://b",)]
    given = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    for table in (given, odd_pages.select("page_id", "url"), spark.createDataFrame(more, "url string").withColumn("page_id", F.lit(1))):
        out = urls.judge_urls(table.withColumn("page_id", F.col("url"))).collect()
        assert len(out) == table.count()
        for r in out:
            host, path, rule = brute_rule(r["page_id"])
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule[0] if rule else None)
            assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == rule[1])


def test_tree_learns_from_labelled_branches(spark):
    rows = [(f"http://a.net/es/{i}",) for i in range(40)] + [("http://a.net/en/7",)]  # only bad labels
    rows += [(f"http://b.example.com/en/{i}",) for i in range(30)] + [(f"http://b.example.com/de/{i}",) for i in range(30)]
    rows += [(f"http://c.net/es/{i}",) for i in range(3)] + [("http://c.net/en/9",), ("http://d.org/en/1",)]
    pages = spark.createDataFrame(rows, "url string").withColumn("page_id", F.col("url"))
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(pages).collect()}
    assert got["http://a.net/en/7"] == got["http://c.net/en/9"] == "allow"  # labels of one kind say nothing of other branches
    assert got["http://d.org/en/1"] == "allow" and got["http://b.example.com/de/3"] == "allow"


def test_labels_of_one_kind_do_not_pass_to_other_branches(spark):
    """However many /es/ pages a .net host has, its rules cannot say anything good of /en/."""
    rows = [(f"http://n{n}.net/es/{i}",) for n in (5, 50, 5000) for i in range(n)]
    rows += [(f"http://n{n}.net/{p}",) for n in (5, 50, 5000) for p in ("en/7", "de/7", "")]
    pages = spark.createDataFrame(rows, "url string").withColumn("page_id", F.col("url"))
    got = urls.judge_urls(pages).filter("rule is null")
    assert {(r["path"], r["verdict"]) for r in got.collect()} == {("/en/7", "allow"), ("/de/7", "allow"), ("/", "allow")}


def test_labels_of_both_kinds_pass_to_other_branches(spark):
    rules = [("block", "m.net", "/a"), ("allow", "m.net", "/a/x1"), ("block", "m.net", "/b")]
    rows = [(f"http://m.net/{b}/x{i}",) for b in "ab" for i in range(20, 78)] + [("http://m.net/a/x1",), ("http://m.net/c/x1",)]
    pages = spark.createDataFrame(rows, "url string").withColumn("page_id", F.col("url"))
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(pages, rules).collect()}
    assert got["http://m.net/c/x1"] == "block" and got["http://m.net/a/x1"] == "allow"


def brute_segments(path):
    general = re.sub(r"[0-9]+", "*", re.sub(r"[0-9a-f]*[0-9][0-9a-f]{7,}", "*", path))
    parts = re.sub("^/", "", general).split("/")
    return tuple(parts if len(parts) <= urls.DEPTH else [*parts[:urls.DEPTH], "**"])


def brute_tree(pages):
    """(template, evidence, rejected) per page from (host, path, label) rows, node by node."""
    keyed = [(".".join(host.split(".")[-2:]), (host, *brute_segments(path)), label) for host, path, label in pages]
    named = {(d, given): given for d, given, _ in keyed}
    for level in range(urls.DEPTH + 1):
        below = {}
        for d, given, _ in keyed:
            node = named[d, given]
            if len(node) > level:
                below.setdefault((d, node[:level]), []).append(node[level])
        varying = {k for k, v in below.items() if len(set(v)) >= urls.VARIABLE and 2 * len(set(v)) >= len(v)}
        for key, node in named.items():
            if len(node) > level and (key[0], node[:level]) in varying:
                named[key] = (*node[:level], "*", *node[level + 1:])
    nodes = {}
    for d, given, label in keyed:
        node = named[d, given]
        for k in range(len(node) + 1):
            counts = nodes.setdefault((d, node[:k]), [0, 0])
            if label:
                counts[label == "block"] += 1
    nodes = {k: v for k, v in nodes.items() if sum(v)}
    own, passed = {}, {}
    for parent in {(d, n[:-1]) for d, n in nodes if n}:
        kids = {k: v for k, v in nodes.items() if k[0] == parent[0] and k[1] and k[1][:-1] == parent[1]}
        p = sum(g for g, _ in kids.values()) / sum(g + b for g, b in kids.values())
        like = {k for k, (g, b) in kids.items() if abs(g - (g + b) * p) <= urls.DEVIATIONS * ((g + b) * p * (1 - p)) ** 0.5 + 0.5}
        total = [sum(kids[k][i] for k in like) for i in (0, 1)]
        own.update({k: total if k in like else v for k, v in kids.items()})
        if len(like) > 1 and min(total) > 0:
            passed[parent] = total
    out = []
    for d, given, _ in keyed:
        node = named[d, given]
        at = next((k for k in range(len(node), -1, -1) if (d, node[:k]) in nodes), None)
        counts = None if at is None else own.get((d, node)) if at == len(node) else passed.get((d, node[:at]))
        bad = counts is not None and (counts[0] + urls.PSEUDO / 2) / (sum(counts) + urls.PSEUDO) < urls.PURITY
        out.append(("/" + "/".join(node[1:]), counts is not None, bad))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_tree_by_brute_force(spark, seed):
    """Random trees with labels, names that vary, deep paths and hosts of one domain; every page's template, evidence and verdict."""
    rnd = random.Random(seed)
    rows = []
    for d in range(4):
        for _ in range(500):
            host = f"{rnd.choice(['', 'a.', 'b.', f'u{rnd.randrange(10**6)}x.'])}d{d}.net" if d else f"{'abcdefgh'[rnd.randrange(8)] * 3}.d.net"
            name = "".join(rnd.choice("ghijk") for _ in range(rnd.choice([2, 9])))
            first = rnd.choice(["sx", "sy", "kq", "kr", "tl", "tm", "tn", "v", ""])
            path = {"s": f"/{first}/{name}", "k": f"/{first}/p/{rnd.randrange(99)}", "t": f"/{first}", "v": "/" + "v/" * rnd.randrange(12), "": ""}[first[:1]]
            bad = 0.995 if zlib.crc32(f"{d}{first}{seed}".encode()) % 2 else 0.05
            rows.append((host, path, None if rnd.random() < 0.4 else "block" if rnd.random() < bad else "allow"))
    pages = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, x) for i, (_, _, x) in enumerate(rows) if x], "page_id long, label string")
    got = {r["page_id"]: (r["template"], r["by_evidence"], r["verdict"] == "block") for r in urls.judge_urls(pages, (), labels).collect()}
    want = brute_tree(rows)
    assert got == dict(enumerate(want))
    assert any(b for _, _, b in want) and any(e and not b for _, e, b in want) and any("*" in t for t, _, _ in want)


@pytest.mark.parametrize("n", [5, 50, 5000])
def test_the_tree_decides_alike_at_every_size(spark, n):
    """Bad labels of one branch reject its other pages; names that vary without digits are one template."""
    def word(i):
        return "".join("abcdefghij"[int(c)] for c in str(i))

    rows = [(f"http://x.org/spam/{i}", "block") for i in range(n + 20)] + [(f"http://x.org/good/{i}", "allow") for i in range(n + 20)]
    rows += [(f"http://x.org/spam/{10**6 + i}", None) for i in range(n)] + [(f"http://x.org/good/{10**6 + i}", None) for i in range(n)]
    rows += [(f"http://y.org/users/{word(i)}", "block") for i in range(n + 20)] + [(f"http://y.org/users/{word(10**6)}", None)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(rows) if x], "page_id long, label string")
    got = {(r["path"].split("/")[1], r["verdict"], r["by_evidence"]) for r in urls.judge_urls(pages, (), labels).collect()}
    assert got == {("spam", "block", True), ("good", "allow", True), ("users", "block", True)}


def test_urls_of_an_empty_table(odd_pages):
    assert urls.judge_urls(odd_pages.limit(0)).isEmpty()


# Fixity -----------------------------------------------------------------------------------

def test_damage_is_located(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    records = fixity.laid_out(fixity.archives(pages, archive_bytes=20_000))
    rows = records.collect()
    assert len({r["archive"] for r in rows}) > 1
    by_archive = {}
    for r in sorted(rows, key=lambda r: (r["archive"], r["seq"])):
        assert r["offset"] == by_archive.get(r["archive"], 0)
        by_archive[r["archive"]] = r["offset"] + r["length"]
    rnd = random.Random(1)
    changed, lost = ({r["digest"] for r in rnd.sample(rows, 3)} for _ in range(2))
    replica = records.filter(~F.col("digest").isin(*lost)).withColumn(
        "digest", F.when(F.col("digest").isin(*changed), F.lit("0" * 64)).otherwise(F.col("digest")))
    got = {r["digest"]: r["status"] for r in fixity.audit(records, replica, fanout=4).collect()}
    assert got == {r["digest"]: "missing" if r["digest"] in lost else "changed" if r["digest"] in changed else "ok" for r in rows}


def test_record_is_a_warc_record(spark):
    text = spark.createDataFrame([(5, "http://x/é", "<p>é</p>")], "page_id long, url string, html string").select(
        fixity.record(F.col("page_id"), F.col("url"), F.col("html")).alias("r")).first()["r"]
    head, body = text.split("\r\n\r\n", 1)
    assert head.startswith("WARC/1.1\r\n") and f"Content-Length: {len('<p>é</p>'.encode())}" in head and body == "<p>é</p>\r\n\r\n"


def test_roots_of_equal_replicas(spark, sf):
    records = fixity.laid_out(fixity.archives(spark.read.parquet(f"{sf}/pages.parquet")))
    assert fixity.audit(records, records).filter("status <> 'ok'").isEmpty()
    top = fixity.tree(records)[-1].collect()
    level = [(r["seq"], hashlib.sha256(f"{r['offset']}:{r['offset'] + r['length']}:{r['digest']}".encode()).hexdigest())
             for r in records.collect() if r["archive"] == top[0]["archive"]]
    level = [h for _, h in sorted(level)]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i:i + 16]).encode()).hexdigest() for i in range(0, len(level), 16)]
    assert level[0] == top[0]["hash"]


def test_fixity_on_awkward_rows(odd_pages):
    out = fixity.fixity_audit(odd_pages, one_in=2)
    assert out.count() == odd_pages.count()
    assert fixity.fixity_audit(odd_pages.limit(0)).isEmpty()


def test_the_copy_is_read(spark, sf):
    """Statuses come from the bytes that the copy holds, also where these were damaged after it was written."""
    copy = fixity.stored(spark.read.parquet(f"{sf}/pages.parquet"), one_in=20)
    first = copy.filter("bytes is not null and sha2(bytes, 256) = digest").agg(F.min("row")).head()[0]
    later = copy.withColumn("bytes", F.when(F.col("row") == first, F.lit(b"x")).otherwise(F.col("bytes")))
    records = fixity.laid_out(fixity.drawn(copy.drop("bytes"), 20_000)).cache()
    got = {r["row"]: r["status"] for r in fixity.audit(records, fixity.replica_of(later, records)).collect()}
    want, changed = {}, 0
    for r in later.collect():
        same = r["bytes"] is not None and hashlib.sha256(r["bytes"]).hexdigest() == r["digest"]
        want[r["row"]] = "ok" if same else "missing" if r["bytes"] is None else "changed"
        assert r["bytes"] is None or r["row"] == first or len(r["bytes"]) == r["length"]
    assert got == want and set(want.values()) == {"ok", "missing", "changed"} and want[first] == "changed"


def test_a_second_table_with_a_changed_page(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    one = pages.filter("length(html) > 20").agg(F.min("page_id")).head()[0]
    other = pages.withColumn("html", F.when(F.col("page_id") == one, F.translate("html", "aeiou", "eioua")).otherwise(F.col("html")))
    a, b = (fixity.laid_out(fixity.archives(t, archive_bytes=20_000)) for t in (pages, other))
    bad = fixity.audit(a, b).filter("status <> 'ok'").collect()
    assert {(r["page_id"], r["status"]) for r in bad} == {(one, "changed")}
