"""URL filters that hold for all aliases of a page.

Rules block or allow a host (with its subdomains) from a path on; the longest rule that fits a url
decides. A url without a rule takes the decision of its aliases: urls linked by redirects and
canonical links form classes (distributed connected components), and a class is blocked if one of
its urls is blocked by a rule and none is explicitly allowed.

DataFrame functions only; the shortest form of every url is one more node, so that variants of a
url (scheme, "www." and "m.", trailing slash, tracking parameters, fragment) meet without a link
between each two of them.

Defined results
    A null url, or one without "://", has an empty host and path, fits no rule and has no alias:
    verdict allow. Repeated urls share a class. Empty hosts, links or tables give plain results
    (allow, none, empty). Further columns are passed through, except those named like an output
    column, which are replaced. Ties between rules of one length (the same host and path given
    twice) go to allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.components import components
from obsmart.llm.storage import stored
from obsmart.llm.text import ascii_lower, whole

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
OUT = ["host", "path", "rule", "verdict"]
# Elements that name the page's own address: (element, pattern it must hold, pattern of the address).
# Their attributes may stand in any order.
LINKS = ((r"(?is)<link\b[^>]*>", r"(?is)\brel\s*=\s*[\"']?\s*canonical\b", r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"),
         (r"(?is)<meta\b[^>]*>", r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b", r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*?\burl\s*=\s*['\"]?\s*([^\"'\s>]+)"),
         (r"(?is)<meta\b[^>]*>", r"(?is)\b(?:property|name)\s*=\s*[\"']?\s*og:url\b", r"(?is)\bcontent\s*=\s*[\"']?\s*([^\"'\s>]+)"))
TRACKING = r"(?i)^(utm_[a-z]+|ref|gclid|fbclid)="


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(whole(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def shortest_form(url: Column) -> Column:
    """The url without scheme, "www." or "m.", fragment, tracking parameters, index page, ".html"
    and trailing slash; null without a host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(/index)?(\.html?)?/*$", "")
    query = F.regexp_extract(whole(url), r"(?s)^[^#]*?\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)), "&")
    return F.when(host != "", F.concat(F.lit("//"), host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def _collapsed_path(path: Column) -> Column:
    """A path (from its first slash) without "." and ".." segments; ".." above the top is dropped."""
    segments = F.slice(F.split(path, "/", -1), F.lit(2), F.greatest(F.size(F.split(path, "/", -1)) - 1, F.lit(0)))
    none = F.array().cast("array<string>")
    left = F.aggregate(segments, none, lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
                       .when(x == ".", done).otherwise(F.concat(done, F.array(x))))
    ends = F.when(path.rlike(r"/\.\.?$") & (F.size(left) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(left, "/"), ends)


def resolved(to: Column, url: Column) -> Column:
    """A link ``to`` as it stands in a page at ``url``, as an absolute url: with a scheme as it is, else
    against the page's scheme, host, path or directory. Null for other schemes (mailto: and such)."""
    to = F.replace(F.replace(F.replace(to, F.lit("&amp;"), F.lit("&")), F.lit("&#38;"), F.lit("&")), F.lit("&#x26;"), F.lit("&"))
    site = F.regexp_extract(url, r"^([^:/?#]+://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    rest = F.regexp_extract(to, r"^[^?#]*(.*)$", 1)
    own = F.regexp_extract(to, r"^([^?#]*)", 1)
    return (F.when(site == "", F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to))
            .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
            .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
            .when(to.startswith("//"), F.concat(F.regexp_extract(url, r"^([^:/?#]+:)", 1), to))
            .when(to.startswith("#"), F.concat(site, path, query))
            .when(to.startswith("?"), F.concat(site, path, to))
            .when(to.startswith("/"), F.concat(site, _collapsed_path(own), rest))
            .otherwise(F.concat(site, _collapsed_path(F.concat(folder, own)), rest)))


def page_links(pages: DataFrame) -> DataFrame:
    """u, v: canonical, refresh and og:url targets that a page's html names, resolved against its url."""
    def named(element: str, mark: str, address: str) -> Column:
        elements = F.regexp_extract_all(whole(F.col("html")), F.lit(element), F.lit(0))
        return F.transform(F.filter(elements, lambda x: x.rlike(mark)), lambda x: F.regexp_extract(x, address, 1))

    found = F.concat(*[named(*link) for link in LINKS])
    to = pages.where("url IS NOT NULL").select(F.col("url").alias("u"), F.explode(F.array_distinct(found)).alias("to")).where("to <> ''")
    return to.select("u", resolved(F.col("to"), F.col("u")).alias("v")).where("v IS NOT NULL")


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame([(h, p, a) for h, p, a in rules], "rule_host string, rule_path string, action string")


def explicit(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (distinct url) with host, path, and the longest rule that fits (rule, action).

    Each host is looked up under all of its suffixes, so the rules are an equi-join, whatever their
    number.
    """
    u = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    named = u.where("host <> ''").select("url", "path", F.explode(suffix).alias("rule_host"))
    fits = (named.join(rules, "rule_host").where(F.expr("startswith(path, rule_path)"))
            .select("url", F.struct((F.length("rule_host") + F.length("rule_path")).alias("length"),
                                    (F.col("action") == "allow").alias("allows"),
                                    F.concat("rule_host", "rule_path").alias("rule"), "action").alias("fit"))
            .groupBy("url").agg(F.max("fit").alias("fit")))
    return u.join(fits, "url", "left").select("url", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.action").alias("action"))


def judge_urls(pages: DataFrame, links: DataFrame | None = None, rules: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    links: u, v, redirects and canonical links between urls (by default those that the pages name
    themselves, if there is an html column); rules: rule_host, rule_path, action.
    """
    spark = pages.sparkSession
    rules = rule_table(spark) if rules is None else rules
    if links is None and "html" in pages.columns:
        links = page_links(pages)
    urls = pages.select("url").where("url IS NOT NULL")
    if links is not None:
        links = stored(links.select("u", "v"))
        urls = urls.unionAll(links.select("u")).unionAll(links.select("v")).where("url IS NOT NULL")
    urls = stored(explicit(urls.distinct(), rules))
    edges = urls.select(F.col("url").alias("u"), shortest_form(F.col("url")).alias("v")).where("v IS NOT NULL")
    if links is not None:
        edges = edges.unionByName(links)
    classes = stored(components(edges))
    said = (urls.where("action IS NOT NULL").join(classes, F.col("url") == F.col("node"))
            .groupBy("component").agg(F.max(F.col("action") == "allow").alias("allowed")))
    said = classes.join(said, "component").where("NOT allowed").select(F.col("node").alias("url"), F.lit("block").alias("alias_says"))
    judged = (urls.join(said, "url", "left")
              .select(F.col("url").alias("__url"), "rule", F.coalesce("action", "alias_says", F.lit("allow")).alias("verdict")))
    own = [c for c in pages.columns if c not in OUT]
    p = pages.select(*own).join(judged, F.col("url") == F.col("__url"), "left")
    return p.select(*own, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
                    F.coalesce("verdict", F.lit("allow")).alias("verdict"))
