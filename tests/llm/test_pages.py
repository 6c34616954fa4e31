"""URL rules and main text."""

from __future__ import annotations

import random

import pytest
from tests_paths import SF0001

from spanpack.llm import html_main, queries, url_rules
from spanpack.llm.boosting import Boosted
from spanpack.llm.dom import blocks_of, parse


# -------------------------------------------------------------- URL rules
def plain_judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))] if rest.startswith("/") else ""
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=url_rules.rank, default=None)
    return host, path, best.text if best else None, best.verdict if best else "allow"


def test_rules_match_the_sql(spark):
    import duckdb

    sf = SF0001.replace("0.001", "0.01")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = con.sql(queries.oracle_sql()["op1_url_rules"])
    got = queries.op1_url_rules(spark, sf)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


URLS = [
    None, "", "no scheme", "http://", "http://com/", "https://www.example.com/en/1?x#y", "https://EXAMPLE.com/en", "http://a.net/es/x", "http://net/es/",
    "ftp://notnet/es/", "http://x.com?q=/en/", "http://a.b.example.com/en/#://", "x://y://z.com/", "http://example.com:80/en/", "http://com", "http://ünï.net/fr/é",
]


@pytest.mark.parametrize("block", [2, 500_000])
def test_rules_match_plain_judge(spark, block):
    rng = random.Random(block)
    labels, paths = ["a", "b", "com", "net", "example", "www"], ["", "/", "/en/", "/en/x", "/es/"]
    rules = queries.URL_RULES + [url_rules.rule(rng.choice(["allow", "block"]), ".".join(rng.choices(labels, k=rng.randint(1, 3))) + rng.choice(paths)) for _ in range(25)]
    urls = URLS + ["http://" + ".".join(rng.choices(labels, k=rng.randint(1, 4))) + rng.choice(paths) + rng.choice(["", "?q", "#f", "9"]) for _ in range(400)]
    rows = [(i // 2, u, "x") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string").repartition(3)
    got = sorted(map(tuple, url_rules.judge_urls(pages, rules, block_rules=block).collect()), key=str)
    assert got == sorted(((i, *plain_judge(u, rules)) for i, u, _ in rows), key=str)
    assert url_rules.judge_urls(pages.where("false"), rules).count() == 0
    assert url_rules.judge_urls(pages, []).where("verdict = 'allow' and rule is null").count() == len(rows)


# --------------------------------------------------------------- main text
def test_reader_of_rough_markup():
    html = '<!DOCTYPE html><p>a &amp; b&nbsp;c<br>d<p class=x>e<!-- <p>no --><b>f</b>  g<script>if (a<b) "</p>"</script><ul><li>1<li>2</ul>tail <a title="x>y">z</a> 3 < 4'
    page = parse(html)
    assert blocks_of(page, [True] * len(page.tag)) == "a & b c d\nef g\n1\n2\ntail z 3 < 4"
    for odd in ("", "<", "</", "<p", "<!--", "<script>", "<a href='x", "</p></p>", "text only", "<div>" * 500):
        page = parse(odd)
        assert len(page.tag) == len(page.end) and all(i < e <= len(page.tag) for i, e in enumerate(page.end))
        html_main.extract_texts([odd], None)


def test_boosting_learns_a_rule():
    import numpy as np

    rng = np.random.default_rng(0)
    x = np.column_stack([rng.integers(0, 2, 2000), rng.random(2000), rng.integers(0, 2, 2000)]).astype(float)
    y = ((x[:, 0] == 1) ^ (x[:, 1] > 0.4)).astype(float)
    model = Boosted(depth=3, trees=30).fit(x, y, np.ones(2000))
    assert ((model.margin(x) > 0) == y).mean() > 0.98


def test_no_kept_element_in_a_dropped_one():
    page = parse("<body><nav><p>x</p></nav><div><p>y</p><aside><p>z</p></aside></div></body>")
    rng = random.Random(1)
    for _ in range(200):
        odds = [rng.uniform(-9, 9) for _ in page.tag]
        keep = html_main.decode(page, odds, [rng.randint(0, 90) for _ in page.tag])
        for i, k in enumerate(keep):
            p, lost = page.parent[i], False
            while p >= 0:
                lost |= not keep[p] and any(keep[a] for a in _above(page, p))
                p = page.parent[p]
            assert not (k and lost)


def _above(page, i):
    while page.parent[i] >= 0:
        i = page.parent[i]
        yield i


@pytest.fixture(scope="session")
def pages(spark):
    return spark.read.parquet(f"{SF0001.replace('0.001', '0.01')}/pages.parquet")


def test_given_pages_give_their_article(pages):
    from html import unescape
    import re

    got = {r["page_id"]: r["text"] for r in html_main.main_text(pages, html_main.learn(pages)).collect()}
    wrong = 0
    for r in pages.collect():
        body = re.sub("<br>", " ", re.search("(?s)<article>(.*?)</article>", r["html"])[1])
        lines = [" ".join(unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        wrong += got[r["page_id"]] != "\n".join(x for x in lines if x)
    assert wrong <= 0.02 * len(got)


def test_layouts_not_seen_in_training(pages):
    model = html_main.learn(pages)
    rng = random.Random(123)
    bodies = [html_main._ARTICLE.search(r["html"])[1] for r in pages.orderBy("page_id").collect()]
    say = lambda: rng.choice(rng.choice(bodies).split("."))[:80].replace("<", " ").replace(">", " ") + "."
    made = [html_main._layout(b, rng, say) for b in bodies[:120]]
    want = [blocks_of(p, [v == 1 for v in html_main._labels(p)]) for p in map(parse, made)]
    assert sum(a != b for a, b in zip(html_main.extract_texts(made, model), want)) <= 0.1 * len(made)


def test_main_text_edges(spark, pages):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "u", "plain"), (3, "u", "<article>" + "<p>long words here.</p>" * 20_000 + "</article>")]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    for model in (None, html_main.learn(pages), html_main.learn(odd), html_main.learn(odd.where("false"))):
        got = html_main.main_text(odd, model).collect()
        assert len(got) == len(rows) and all(r["text"] == "" for r in got if r["page_id"] in (1, None))
    assert html_main.main_text(odd.where("false"), None).count() == 0
