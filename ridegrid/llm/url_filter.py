"""Operator 2, URL filters with redirect equivalence (DataFrame functions only).

Each page's URL is judged by the longest rule that fits its host and path.  Pages without a rule
take the decision of their aliases: URLs joined by redirects (``<meta http-equiv="refresh">``) and
canonical links (``<link rel="canonical">``), closed under connected components.  An explicit
allow anywhere in a component takes precedence over its blocks; with neither, the page is allowed.
A page with a rule of its own keeps that rule's verdict.

URL nodes drop the scheme, the fragment and a leading ``//``, and their paths' dot segments are resolved
(``/a/./b/../c`` is ``/a/c``).  Targets are freed of character references (numeric ones, and amp, lt, gt,
quot, apos, each with its semicolon; once, so ``&amp;#38;`` is ``&#38;``) and resolved against their page: ``//host/..``,
``/path``, ``?query``, ``#fragment`` and relative paths; a ``<base>`` tag is not looked at.  Targets
of schemes without ``//`` (mailto:, javascript:, data:) are no aliases.  Defined cases: a null URL, or one without ``://``, has empty host and path, no
rule and no alias, so it is allowed; null html has no links; repeated rows are judged one by one;
a page that links to itself adds nothing; an empty table gives an empty result; other columns are
ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegrid.llm import common as C
from ridegrid.session import reliable_checkpoint

#: (verdict, rule); a rule is a host, then a path from its first slash on.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null."""
    pick = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        name, start = rule[:at], rule[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        pick = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(pick)
    return pick


def without_dots(path: Column) -> Column:
    """A path from its first slash on, its ``.`` and ``..`` segments resolved."""
    parts = F.slice(F.split(path, "/"), 2, F.greatest(F.length(path), F.lit(1)))
    kept = F.reduce(parts, F.array().cast("array<string>"), lambda done, x:
                    F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
                    .when(x == ".", done).otherwise(F.array_append(done, x)))
    end = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), end)).otherwise(path)


def url_node(url: Column) -> Column:
    """A URL without scheme, fragment and dot segments; its host in lower case; null without a host."""
    path, query = url_path(url), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)?", 1)
    host = url_host(url)
    return F.when(host != "", F.concat(host, F.when((path == "") & (query == ""), "/").otherwise(
        F.concat(without_dots(path), query))))


#: Named character references that are decoded; numeric ones are decoded all.
NAMED = {"amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "apos;": "'"}


def _code_point(number: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise("\ufffd")


def unescaped(text: Column) -> Column:
    """``text`` with its character references decoded, in one pass from left to right."""
    def piece(x: Column, i: Column) -> Column:
        out = F.concat(F.lit("&"), x)
        for name, char in NAMED.items():
            out = F.when(x.startswith(name), F.concat(F.lit(char), F.substr(x, F.lit(len(name) + 1)))).otherwise(out)
        for pattern, radix in ((r"^#0*([0-9]{1,7});", 10), (r"^#[xX]0*([0-9a-fA-F]{1,6});", 16)):
            number = F.conv(F.regexp_extract(x, pattern, 1), radix, 10).cast("long")
            rest = F.regexp_replace(x, pattern, "")
            out = F.when(x.rlike(pattern), F.concat(_code_point(number), rest)).otherwise(out)
        return F.when(i == 0, x).otherwise(out)

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def targets(html: Column) -> Column:
    """hrefs of canonical links and targets of refresh redirects in a page."""
    links = F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0))
    metas = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0))
    canonical = F.transform(
        F.filter(links, lambda t: t.rlike(r"(?i)\brel\s*=\s*[\"']?canonical\b")),
        lambda t: F.regexp_extract(t, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    refresh = F.transform(
        F.filter(metas, lambda t: t.rlike(r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b")),
        lambda t: F.regexp_extract(t, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1))
    return F.filter(F.transform(F.concat(canonical, refresh), unescaped), lambda t: t != "")


def resolve(url: Column, target: Column) -> Column:
    """A link target as an absolute URL, seen from the page ``url``; null for one that names no page."""
    origin = F.concat(F.lit("http://"), url_host(url))
    path = url_path(url)
    folder = F.regexp_extract(path, r"(?s)^(.*/)?", 1)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .when(target.startswith("#"), url)
            .when(target.startswith("?"), F.concat(origin, path, target))
            .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), target)))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    links = pages.select(F.col(url).alias("_url"), F.explode(targets(F.col(html))).alias("_to"))
    return links.select(url_node(F.col("_url")).alias("u"),
                        url_node(resolve(F.col("_url"), F.col("_to"))).alias("v")).where("u <> v").distinct()


def filter_urls(pages: DataFrame, edges: DataFrame | None = None, rules=RULES, page_id: str = "page_id",
                url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict of every page, and ``by`` (rule, alias or default).

    ``edges`` (u, v: URL nodes, see url_node) adds redirects known from elsewhere, such as a crawl log.
    """
    found = alias_edges(pages, url, html)
    if edges is not None:
        found = found.unionByName(edges.select("u", "v"))
    found = reliable_checkpoint(found, "alias-edges")
    host, path = url_host(F.col(url)), url_path(F.col(url))
    judged = pages.select(F.col(page_id).alias("page_id"), url_node(F.col(url)).alias("_node"),
                          host.alias("host"), path.alias("path"), best_rule(host, path, rules).alias("_r"))
    if found.isEmpty():
        alias = judged.withColumn("_decided", F.lit(None).cast("string"))
    else:
        parts = reliable_checkpoint(C.connected_components(found, "aliases"), "aliases")
        # every node of a component is judged, whether or not its page was fetched
        as_url = F.concat(F.lit("http://"), F.col("node"))
        ruled = parts.withColumn("_r", best_rule(url_host(as_url), url_path(as_url), rules))
        decided = ruled.groupBy("root").agg(
            F.max(F.col("_r.verdict") == "allow").alias("_allow"),
            F.max(F.col("_r.verdict") == "block").alias("_block"))
        decided = decided.select("root", F.when(F.col("_allow"), "allow").when(F.col("_block"), "block")
                                 .alias("_decided"))
        by_node = parts.join(decided, "root").select(F.col("node").alias("_node"), "_decided")
        alias = judged.join(by_node, "_node", "left")
    return alias.select(
        "page_id", "host", "path", F.col("_r.rule").alias("rule"),
        F.coalesce(F.col("_r.verdict"), F.col("_decided"), F.lit("allow")).alias("verdict"),
        F.when(F.col("_r").isNotNull(), "rule").when(F.col("_decided").isNotNull(), "alias")
        .otherwise("default").alias("by"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(C.table(spark, sf_dir, "pages").select("page_id", "url", "html"))
