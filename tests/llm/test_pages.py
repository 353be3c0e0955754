"""HTML extraction, URL verdicts and shards."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_extract, sharding, url_filter
from tidemark.llm.queries import URL_RULES

PAGES = "page_id bigint, url string, html string, host string, templates string"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain  &amp; simple", "plain & simple"),
        ("<p>one<p>two<br>three</p>four", "one\ntwo three\nfour"),
        ("<article><h1>T</h1><p><b>a b<br><p>c</article><footer>f</footer>", "T\na b\nc"),
        ("<nav><ul><li>m</ul></nav><main><p>x</p><form>f</form><aside>s</aside></main>", "x"),
        ("<article><p>text</p><div class='post-comments'><p>me too</p></div></article>", "text"),
        ("<div class='layout has-sidebar'><article><p>kept</p></article></div>", "kept"),
        ("<div id='page' class='no-sidebar'><p>kept</p></div>", "kept"),
        ("<article class='post comments-open'><h1 class='entry-header'>Head</h1><p>kept</p></article>", "Head\nkept"),
        ("<div class='elementor-widget-container'><article><p>kept</p></article></div>", "kept"),
        ("<div class='social-science'><p>kept</p></div><div class='social-links'>s</div><ul class='ad-300x250'><li>a</ul>", "kept"),
        ("<div class='widget'><article><p>kept</p></article><p>more</p></div><p>rest</p>", "kept"),
        ("<article><p>kept</p></article><ol class='comment-list'><li><article class='comment-body'>c</article></ol>", "kept"),
        ("<article><p>kept</p></article><div class='related-posts'><article class='card'>r</article></div>", "kept"),
        ("<article><p>kept</p><h2 class='related'>r</h2><div class='site-footer'>f</div></article>", "kept"),
        ("<body><div class=ad>buy</div><div id='cookie-notice'>c</div><p>kept</p></body>", "kept"),
        ("<article>a<script>var t='</p><p>no';</script><style>p{}</style><!-- c --> b</article>", "a b"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut</p><p cla", "cut"),
        ("<article><p>1 &lt; 2 &#233;&copy</article>", "1 < 2 é©"),
        ("<div role=navigation>n</div><ul><li>a<li>b</ul>", "a\nb"),
        ("<article><b>x</article></b></p>", "x"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<article><textarea><p>no</textarea><p>yes", "yes"),
    ],
)
def test_main_text(source, text):
    assert html_extract.main_text(source) == text
    assert html_extract.main_text(source, frozenset([1])) == text


def test_recurring_subtrees_are_deleted_per_host(spark):
    def page(number, menu):
        return f"<body><div class=x><p>{menu}</p></div><div><p>text {number}</p><p>again</p></div></body>"

    rows = [(number, "http://a.org/x", page(number, "same on all"), "c", "d") for number in range(8)]
    rows += [(20, "http://b.org/x", page(20, "same on all"), None, None)]
    rows += [(30 + number, "no host", page(30 + number, "same on all"), None, None) for number in range(8)]
    rows += [(50 + number, "http://c.org/", "<article><h1>T</h1><p>copied article</p></article>", None, None) for number in range(9)]
    rows += [(60, None, None, None, None), (61, "http://a.org/", "", None, None), (50, "http://c.org/", "<article><p>x</article>", None, None)]
    result = html_extract.extract_text(spark.createDataFrame(rows, PAGES).repartition(4))
    texts = sorted(((row.page_id, row.text, row.n_chars) for row in result.collect()), key=str)
    expected = [(number, f"text {number}", 6 + len(str(number)) - 1) for number in range(8)]
    expected += [(20, "same on all\ntext 20\nagain", 25)]
    expected += [(30 + number, f"same on all\ntext {30 + number}\nagain", 25) for number in range(8)]
    expected += [(50 + number, "T\ncopied article", 16) for number in range(9)] + [(60, "", 0), (61, "", 0), (50, "x", 1)]
    assert texts == sorted(expected, key=str)
    assert html_extract.extract_text(spark.createDataFrame([], PAGES)).count() == 0


def test_rules(spark):
    cases = {
        "https://a.NET/x": ("a.net", "/x", "net/", "block"),
        "http://example.net/en/1?q": ("example.net", "/en/1", "example.net/en/", "allow"),
        "http://m.example.net/en/": ("m.example.net", "/en/", "example.net/en/", "allow"),
        "http://notexample.net/en/1": ("notexample.net", "/en/1", "net/", "block"),
        "http://example.com/de/x": ("example.com", "/de/x", "example.com/de/", "block"),
        "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
        "http://x.net": ("x.net", "", None, None),
        "http://x.org/FR/://y.net/": ("x.org", "/FR/://y.net/", None, None),
        "//x.net/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    rows = [(number, url, None, "h", "t") for number, url in enumerate(cases)] * 2
    found = url_filter.judge_urls(spark.createDataFrame(rows, PAGES), URL_RULES).collect()
    assert len(found) == 2 * len(cases)
    for row in found:
        host, path, rule, verdict = list(cases.values())[row.page_id]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
    assert url_filter.judge_urls(spark.createDataFrame([], PAGES), URL_RULES).count() == 0


def test_models_tell_urls_apart(spark):
    good = [f"http://news{n % 7}.org/fr/story-{n}" for n in range(300)]
    bad = [f"http://casino{n % 5}.net/win-{n}" for n in range(300)]
    new = [(1000 + n, f"http://news{n}.com/story-{n}", None, None, None) for n in range(20)]
    new += [(2000 + n, f"http://casino{n}.com/win-{n}", None, None, None) for n in range(20)]
    rows = [(n, url, None, None, None) for n, url in enumerate(good + bad)] + new
    found = {row.page_id: row.verdict for row in url_filter.judge_urls(spark.createDataFrame(rows, PAGES), URL_RULES).collect()}
    assert sum(found[1000 + n] == "allow" for n in range(20)) >= 18
    assert sum(found[2000 + n] == "block" for n in range(20)) >= 18


def test_model_is_a_distribution():
    rows = [("", "a", 6), ("", "b", 3), ("", "\n", 1), ("a", "b", 3), ("a", "a", 2)]
    model = url_filter.MarkovModel(rows)
    assert model.log_likelihood("ab") > model.log_likelihood("ba")
    assert model.log_likelihood("z") > float("-inf")


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_contexts_are_kept_alike_at_every_size(spark, monkeypatch, broadcast):
    """Scores by brute force, where the input has 700,000 characters of a label."""
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", broadcast, raising=False)
    seen = {f"http://site{n}.{end}/page-{n}-of-many": 4000 for n in range(6) for end in ("org/fr", "net")}
    seen |= {f"http://rare{n}.net/wxyzq{n}": 1 for n in range(30)} | {f"http://seld{n}.org/fr/kvjé{n}": 1 for n in range(30)}
    seen |= {"http://x.com/wxyzq": 3, "http://y.com/kvjé": 1, "http://rare.seld/": 1, "nothing": 2}
    once = spark.createDataFrame(list(seen.items()), "url string, times int")
    rows = once.select(F.lit(1).cast("bigint").alias("page_id"), "url", F.explode(F.sequence(F.lit(1), "times")).alias("number"))
    address = {url: url.partition("://")[2] for url in seen}
    held = {row.a for row in spark.createDataFrame([(a,) for a in address.values()], "a string").where("pmod(xxhash64(a), 5) = 0").collect()}
    counts = {"allow": Counter(), "block": Counter()}
    for url, times in seen.items():
        kind = "block" if ".net" in url else "allow" if ".org" in url else None
        if kind and address[url] not in held:
            padded = "\n" * 5 + address[url] + "\n"
            for at in range(5, len(padded)):
                for order in range(6):
                    counts[kind][padded[at - order : at], padded[at]] += times
    likelihood = {}
    for kind, each in counts.items():
        totals = Counter()
        for (context, _), times in each.items():
            totals[context] += times
        model = url_filter.MarkovModel([(context, after, times) for (context, after), times in each.items() if totals[context] >= 4])
        likelihood[kind] = model.log_likelihood
    found = {row.url: (row.score, row.n) for row in _scores_by_url(url_filter.judge_urls(rows, URL_RULES)).collect()}
    assert {url: n for url, (_, n) in found.items()} == {a: seen[url] for url, a in address.items()}
    for url, (score, _) in found.items():
        expected = (likelihood["allow"](url) - likelihood["block"](url)) / (len(url) + 1) if url else 0.0
        assert score == pytest.approx(expected, abs=1e-9)


def _scores_by_url(judged):
    return judged.groupBy(F.concat("host", "path").alias("url")).agg(F.max("score").alias("score"), F.count("*").alias("n"))


@pytest.mark.parametrize("shards", [4, 40])
def test_shards_are_even_and_keep_groups(docs, shards, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_SLICE", 50)
    pairs = [(number, f"text {number}") for number in range(300)]
    pairs += [(1000 + number, f"group {number // 3}") for number in range(90)]
    pairs += [(2000 + number, "large group") for number in range(150)]
    pairs += [(3000, None), (3001, None), (3002, ""), (3003, ""), (3004, "é"), (3004, "é"), (None, "x")]
    rows = sharding.shard_documents(docs(pairs), shards=shards).collect()
    assert Counter(row.doc_id for row in rows) == Counter(doc_id for doc_id, _ in pairs)
    sizes = Counter(row.shard for row in rows)
    assert set(sizes) == set(range(shards)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(shards):
        assert sorted(row.slot for row in rows if row.shard == shard) == list(range(sizes[shard]))
    text = dict(pairs)
    for row in rows:
        raw = (text[row.doc_id] or "").encode()
        assert (row.size, row.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    places = {}
    for row in rows:
        if row.doc_id and 1000 <= row.doc_id < 2000:
            places.setdefault(text[row.doc_id], set()).add(row.shard)
    assert sum(len(each) == 1 for each in places.values()) >= 25
    large = {row.shard for row in rows if row.doc_id and 2000 <= row.doc_id < 3000}
    assert len(large) <= -(-150 // (len(pairs) // shards)) + 4  # few more than it needs
    assert sharding.shard_documents(docs([(1, "x")]).where("doc_id > 1"), shards=shards).count() == 0


def test_very_deep_page():
    depth = 20_000
    page = "<div>" * depth + "<article><p>kept</p></article>" + "</div>" * depth
    assert html_extract.main_text(page) == "kept"
    assert html_extract.subtree_hashes(page) == set()
