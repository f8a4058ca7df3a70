"""URL rules, and what follows from them for redirects and canonical links.

A rule blocks or allows a host, its subdomains and the paths below it; the longest rule that fits
decides. Urls that lead to the same page are one class: redirects and canonical links are edges of
a graph, and its connected components are found by distributed star contraction. A url without a
rule of its own takes the decision of its class: block if a url of the class is blocked by a rule
and none is allowed by one, else allow. A url's own rule always stands before that of its class.

All of it is DataFrame expressions. Rules are a bounded table that the caller writes down (at most
``MOST_RULES``); they are looked up by hash joins on every suffix of the host, and the path test
is part of the join, so a page meets only the rules of its own hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import quoted
from lodgecurve.llm.components import components
from lodgecurve.operators.scale import materialise

MOST_RULES = 10_000
BLOCK, ALLOW = "block", "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for urls without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(after_scheme(url), r"(?s)\A([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), r"(?s)\A[^/?#]*([^?#]*)", 1)


def bare(url: Column) -> Column:
    """The url as a web server and a robot tell pages apart: host lower-cased, without scheme and fragment.

    Also without ``utm_`` parameters and one slash at the end of the path.
    """
    query = F.regexp_extract(after_scheme(url), r"(?s)\A[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.startswith("utm_") & (p != "")), "&")
    return F.concat(host(url), F.regexp_replace(path(url), r"/\z", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def absolute(url: Column, link: Column) -> Column:
    """``link`` as found on the page ``url``, resolved where it is relative to the scheme, the host, the path or the page."""
    scheme = F.regexp_extract(url, r"(?s)\A([^:/?#]*):", 1)
    site = F.concat(scheme, F.lit("://"), host(url))
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    folder = F.regexp_extract(F.when(path(url) == "", F.lit("/")).otherwise(path(url)), r"(?s)\A(.*/)", 1)
    tail = F.regexp_extract(link, r"(?s)([?#].*)\z", 1)
    steps = F.split(F.concat(folder, F.regexp_extract(link, r"(?s)\A([^?#]*)", 1)), "/")
    walked = F.aggregate(
        F.slice(steps, 2, F.size(steps)), F.array().cast("array<string>"),
        lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.concat(done, F.array(x))),
    )
    ends = F.when(F.element_at(steps, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return (
        F.when(F.rlike(link, F.lit(r"\A[A-Za-z][A-Za-z0-9+.-]*://")), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when((link == "") | F.rlike(link, F.lit(r"\A[A-Za-z][A-Za-z0-9+.-]*:")) | (host(url) == ""), F.lit(None))
        .when(link.startswith("?"), F.concat(site, path(url), link))
        .when(link.startswith("#"), url)
        .otherwise(F.concat(site, F.lit("/"), F.array_join(walked, "/"), ends, tail))
    )


def html_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges ``a, b`` from a page's url to its canonical link and to where it refreshes to.

    Reads ``<link rel=canonical href=...>`` and ``<meta http-equiv=refresh content="...url=...">``
    with attributes in any order and quotes of either kind or none. ``<base href>`` is not read.
    """
    page, body = F.col(quoted(url)), F.col(quoted(html))
    attribute = lambda tag, name: F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*[\"']?([^\"'>]*)", 1)
    canonical = F.transform(
        F.filter(F.regexp_extract_all(body, F.lit(r"(?is)<link\s[^>]*>"), F.lit(0)), lambda t: F.rlike(t, F.lit(r"(?is)\srel\s*=\s*[\"']?canonical[\"'\s/>]"))),
        lambda t: attribute(t, "href"),
    )
    refresh = F.transform(
        F.filter(F.regexp_extract_all(body, F.lit(r"(?is)<meta\s[^>]*>"), F.lit(0)), lambda t: F.rlike(t, F.lit(r"(?is)\shttp-equiv\s*=\s*[\"']?refresh[\"'\s/>]"))),
        lambda t: F.regexp_extract(t, r"(?is)url\s*=\s*'?([^\"'>]*)", 1),
    )
    found = pages.where(page.isNotNull() & body.isNotNull()).select(page.alias("a"), F.explode(F.concat(canonical, refresh)).alias("link"))
    return found.select("a", absolute(F.col("a"), F.col("link")).alias("b")).where(F.col("b").isNotNull() & (F.col("b") != ""))


def best_rule(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``urls`` (``host``, ``path`` and others) with ``rule`` and ``rule_verdict``, null where none fits.

    ``rules`` are (verdict, host, path prefix). Longer rules win; of equally long ones the one with
    the longer host, then block before allow.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    table = urls.sparkSession.createDataFrame([(h, p, v) for v, h, p in rules], "rule_host string, rule_path string, rule_own string")
    order = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"), F.col("rule_own").alias("v"),
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    rules_of = table.groupBy("rule_host").agg(F.collect_list(F.struct("rule_path", order.alias("order"))).alias("rules"))  # MOST_RULES at most
    hosts = urls.select("host").distinct()
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    suffixes = hosts.select("host", F.explode(ends).alias("rule_host"))
    by_host = suffixes.join(F.broadcast(rules_of), "rule_host").groupBy("host").agg(F.flatten(F.collect_list("rules")).alias("rules"))
    by_host = materialise(by_host)  # so that the rows of a hot host can be split in the join
    fits = F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"]))
    best = F.array_max(F.transform(fits, lambda r: r["order"]))
    joined = urls.join(by_host, "host", "left").withColumn("best", best)
    return joined.select(*urls.columns, F.col("best.rule").alias("rule"), F.col("best.v").alias("rule_verdict"))


def judged_urls(
    pages: DataFrame, edges: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", key: str = "page_id"
) -> DataFrame:
    """A verdict for every row of ``pages``: ``id, url, host, path, rule, verdict, class_url``.

    ``edges`` has two url columns ``a`` and ``b``; direction does not matter, loops, repeats and
    nulls do no harm. Urls that differ only as ``bare`` allows are one class too. ``class_url`` is
    the smallest bare url of the class. Null urls, and those without ``://``, have empty host and
    path, are in no class and are allowed.
    """
    rows = pages.select(F.col(quoted(key)).cast("long").alias("id"), F.col(quoted(url)).cast("string").alias("url"))
    links = materialise(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select(F.col("a").cast("string"), F.col("b").cast("string")).distinct())
    known = rows.select("url").unionByName(links.select(F.col("a").alias("url"))).unionByName(links.select(F.col("b").alias("url")))
    known = known.where(F.instr("url", "://") > 0).distinct()
    known = known.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), bare(F.col("url")).alias("bare"))
    ruled = materialise(best_rule(known, rules))
    a, b = bare(F.col("a")), bare(F.col("b"))
    usable = (F.instr("a", "://") > 0) & (F.instr("b", "://") > 0)
    roots = components(links.where(usable).select(a.alias("a"), b.alias("b")))
    # decisions of a bare url, then of its component: both combine before any shuffle
    said = lambda verdict: F.max((F.coalesce(F.col("rule_verdict"), F.lit("")) == verdict).cast("int"))
    own = ruled.groupBy("bare").agg(said(BLOCK).alias("blocks"), said(ALLOW).alias("allows"))
    placed = own.join(roots, F.col("bare") == F.col("node"), "left").select("bare", F.coalesce("root", "bare").alias("root"), "blocks", "allows")
    placed = materialise(placed)
    classes = materialise(placed.groupBy("root").agg(F.max("blocks").alias("blocks"), F.max("allows").alias("allows")))
    verdicts = placed.select("bare", "root").join(classes, "root").select(
        "bare", "root", F.when((F.col("blocks") == 1) & (F.col("allows") == 0), F.lit(BLOCK)).otherwise(F.lit(ALLOW)).alias("class_verdict")
    )
    final = materialise(ruled.join(verdicts, "bare").select("url", "host", "path", "rule", F.coalesce("rule_verdict", "class_verdict").alias("verdict"), F.col("root").alias("class_url")))
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.join(final, "url", "left").select(
        "id", "url", empty("host").alias("host"), empty("path").alias("path"), "rule", F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"), "class_url"
    )


RULES = [(BLOCK, "net", "/"), (ALLOW, "example.net", "/en/"), (BLOCK, "example.com", "/de/"), (ALLOW, "org", "/fr/")]


def op3_urls(spark, sf_dir: str) -> DataFrame:
    """Verdict on every page's url, by the rules and by where pages redirect and point to."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = judged_urls(pages, html_links(pages), RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


ORACLE = r"""
WITH RECURSIVE tags AS (
    SELECT url, unnest(list_filter(regexp_extract_all(html, '(?is)<link\s[^>]*>'),
        lambda t: regexp_matches(t, '(?is)\srel\s*=\s*["'']?canonical["''\s/>]'))) AS tag, '(?is)\shref\s*=\s*["'']?([^"''>]*)' AS pattern
    FROM pages WHERE url IS NOT NULL
    UNION ALL
    SELECT url, unnest(list_filter(regexp_extract_all(html, '(?is)<meta\s[^>]*>'),
        lambda t: regexp_matches(t, '(?is)\shttp-equiv\s*=\s*["'']?refresh["''\s/>]'))), '(?is)url\s*=\s*''?([^"''>]*)'
    FROM pages WHERE url IS NOT NULL
), found AS (
    SELECT url AS a, trim(replace(CASE WHEN pattern LIKE '%href%' THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''>]*)', 1)
        ELSE regexp_extract(tag, '(?is)url\s*=\s*''?([^"''>]*)', 1) END, '&amp;', '&')) AS link
    FROM tags
), links AS (
    SELECT a, CASE WHEN instr(link, '://') > 0 THEN link
        WHEN starts_with(link, '//') THEN regexp_extract(a, '(?s)^([^:/?#]*):', 1) || ':' || link
        WHEN starts_with(link, '/') THEN regexp_extract(a, '(?s)^([^:/?#]*):', 1) || '://' || translate(regexp_extract(substr(a, instr(a, '://') + 3), '(?s)^([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || link END AS b
    FROM found
), urls AS (
    SELECT url, substr(url, instr(url, '://') + 3) AS rest
    FROM (SELECT url FROM pages UNION SELECT a FROM links UNION SELECT b FROM links) WHERE instr(url, '://') > 0
), split AS (
    SELECT url, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path,
        array_to_string(list_filter(string_split(regexp_extract(rest, '(?s)^[^?#]*\?([^#]*)', 1), '&'), lambda p: NOT starts_with(p, 'utm_') AND p <> ''), '&') AS kept
    FROM urls
), rules(verdict, rhost, rpath) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fit AS (
    SELECT url, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS own
    FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
    GROUP BY url
), ruled AS (
    SELECT url, host, path, rule, own, host || regexp_replace(path, '/$', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS bare
    FROM split LEFT JOIN fit USING (url)
), edges AS (
    SELECT x.bare AS a, y.bare AS b FROM links JOIN ruled x ON links.a = x.url JOIN ruled y ON links.b = y.url
), both_ways AS (
    SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reach(bare, other) AS (
    SELECT DISTINCT bare, bare FROM ruled UNION SELECT reach.bare, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
), classes AS (
    SELECT reach.bare, bool_or(own = 'block') AS blocks, bool_or(own = 'allow') AS allows
    FROM reach JOIN ruled ON ruled.bare = reach.other GROUP BY reach.bare
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
    coalesce(own, CASE WHEN blocks AND NOT coalesce(allows, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM pages LEFT JOIN ruled USING (url) LEFT JOIN classes USING (bare)
"""
