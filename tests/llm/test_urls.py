"""Url rules and classes against SQL and by hand."""

import random

import duckdb
import pytest

from lodgecurve.llm import urls

PAGES = "page_id long, url string, html string, host string, path string, rule string, id string, bare string"
HOSTS = ["a.example.net", "b.Example.COM", "c.org", "d.io", "x.d.io", "e.example.org", "net", "example.net.io"]


def random_pages():
    r = random.Random(3)
    made = [f"{r.choice(['http', 'HTTPS'])}://{r.choice(HOSTS)}/{r.choice(['en', 'fr', 'de', 'En'])}/{k % 25}{r.choice(['', '/', '?utm_a=1', '?q=2&utm_b=3', '#f'])}" for k in range(120)]
    out = []
    for k, u in enumerate(made):
        b = r.choice(made)
        out.append((k, u, r.choice([
            f'<link rel="canonical" href="{b}">', f"<META http-equiv='refresh' content='0; url={b}'>", f"<link href=/fr/{k % 25} rel=canonical>", "<p>",
            '<link rel="stylesheet" href="/x.css">', f'<link rel=canonical href="//c.org/fr/{k}?a=1&amp;b=2">', None,
        ])))
    return out + [(200, None, "<link rel=canonical href='http://net/'>"), (201, "nohost", None), (202, "", "<p>"), (0, made[0], None), (None, made[1], None), (203, "http://", "<p>"), (204, "a://b\n/c", None)]


def test_verdicts_equal_sql(spark, tmp_path):
    df = spark.createDataFrame([(*p, *["x"] * 5) for p in random_pages()], PAGES)
    df.select("page_id", "url", "html").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r) for r in urls.op3_urls(spark, str(tmp_path)).collect()), key=str)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(db.execute(urls.ORACLE).fetchall(), key=str)
    named = urls.judged_urls(df, urls.html_links(df), urls.RULES)
    assert sorted(((r.id, r.host, r.path, r.rule, r.verdict) for r in named.collect()), key=str) == got


@pytest.fixture()
def verdict(spark):
    def judge(pages, edges, rules=urls.RULES):
        df = spark.createDataFrame([(i, u, None, *["x"] * 5) for i, u in enumerate(pages)], PAGES)
        links = spark.createDataFrame(edges, "a string, b string")
        return [r.verdict for r in urls.judged_urls(df, links, rules).orderBy("id").collect()]

    return judge


def test_blocks_spread_and_allows_win(verdict):
    pages = ["http://x.io/1", "http://y.net/1", "http://z.io/", "http://w.io/", "http://v.org/fr/1", "http://q.net/2", "http://alone.io/"]
    edges = [("http://x.io/1", "http://y.net/1"), ("http://z.io/", "http://x.io/1"), ("http://w.io/", "http://v.org/fr/1"), ("http://q.net/2", "http://w.io/"), (None, "http://x.io/1"), ("http://x.io/1", "http://x.io/1")]
    assert verdict(pages, edges) == ["block", "block", "block", "allow", "allow", "block", "allow"]


def test_a_chain_of_redirects_and_a_hub(verdict):
    chain = [f"http://r{i}.io/" for i in range(30)]
    hub = [f"http://h.io/{i}" for i in range(60)]
    edges = list(zip(chain, chain[1:])) + [(h, "http://shared.io/") for h in hub] + [("http://shared.io/", "http://bad.net/")]
    assert set(verdict(chain + ["http://e.net/"], edges[:29] + [(chain[-1], "http://e.net/")])) == {"block"}
    assert verdict(hub, edges) == ["block"] * 60


def test_the_longest_rule_wins_and_subdomains_count(verdict):
    rules = [("block", "a.io", "/"), ("allow", "a.io", "/x/"), ("block", "b.a.io", "/x/y"), ("allow", "io", "/x/y/z/longer")]
    pages = ["http://a.io/", "http://c.a.io/x/", "http://b.a.io/x/y1", "http://ba.io/x", "http://a.io", "http://b.a.io/x/y/z/longer"]
    # the fifth fits no rule, its path being empty, but is the first by another spelling
    assert verdict(pages, [], rules) == ["block", "allow", "block", "allow", "block", "allow"]


def test_no_pages_no_edges(spark):
    none = spark.createDataFrame([], PAGES)
    assert urls.judged_urls(none, urls.html_links(none), urls.RULES).count() == 0


def test_only_builtin_functions_run(spark, tmp_path):
    spark.createDataFrame([(1, "http://a.net/", "<p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    plan = urls.op3_urls(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_links_relative_to_the_page(spark):
    page = "http://A.io/d/e/p.html?x=1"
    want = {
        "index.html": "http://a.io/d/e/index.html", "?id=3": "http://a.io/d/e/p.html?id=3", "../q?u=/v/w": "http://a.io/d/q?u=/v/w", "./": "http://a.io/d/e/",
        "/out?u=http://x.net/": "http://a.io/out?u=http://x.net/", "out?u=http://x.net/": "http://a.io/d/e/out?u=http://x.net/",
        "http://b.io/": "http://b.io/", "//c.io/": "http://c.io/", "mailto:a@b.io": None, "": None,
    }
    df = spark.createDataFrame([(page, link) for link in want], "url string, link string")
    got = {r.link: r.b for r in df.select("link", urls.absolute(urls.F.col("url"), urls.F.col("link")).alias("b")).collect()}
    assert got == want
