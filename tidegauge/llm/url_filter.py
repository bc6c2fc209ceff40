"""URL block and allow rules carried over redirects and canonical links, in DataFrame functions only.

Addresses joined by redirect or canonical-link edges are aliases. Their connected components are found
by distributed rounds. A block rule that fits any alias blocks all aliases that no rule of their own
judges; an explicit allow rule takes precedence for the address that it fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.components import connected_components
from tidegauge.llm.frames import column, written

#: Rule lists of at most so many rows are broadcast; longer ones are joined by shuffle.
BROADCAST_RULES = 50_000

ALLOW, BLOCK = "allow", "block"


def _lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    return F.coalesce(_lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; empty without `://` or for null."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """What names a page: host, path and query, without scheme and fragment; null where there is no host."""
    tail = F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)
    whole = F.concat(host_of(url), F.when(tail == "", F.lit("/")).otherwise(tail))
    return F.when(host_of(url) != "", whole)


def _resolved(links: DataFrame) -> DataFrame:
    """(source, target) with absolute URLs from (source, link); links that lead to no page are left out."""
    source, link = F.col("source"), F.col("link")
    parts = links.select(
        "source",
        "link",
        F.concat(F.regexp_extract(source, r"^([^:/?#]*)://", 1), F.lit("://")).alias("scheme"),
        host_of(source).alias("host"),
        F.regexp_replace(path_of(source), r"[^/]*$", "").alias("folder"),
    )
    site = F.concat("scheme", "host")
    target = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.rtrim(F.col("scheme"), F.lit("/")), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.rlike(r"^(#|$|[A-Za-z][A-Za-z0-9+.-]*:)"), F.lit(None))
        .otherwise(F.concat(site, F.when(F.col("folder") == "", F.lit("/")).otherwise(F.col("folder")), link))
    )
    return parts.select("source", target.alias("target"))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target) URLs of canonical links and of refresh redirects in the whole markup of each page."""
    html, url = column(pages, html_col), column(pages, url_col)
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    tag = pages.where(html.rlike(r"(?i)canonical|http-equiv")).select(url.alias("source"), F.explode(tags).alias("tag"))
    canonical = F.when(
        F.col("tag").rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?canonical\b"),
        F.regexp_extract("tag", r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1),
    )
    refresh = F.when(
        F.col("tag").rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b"),
        F.regexp_extract("tag", r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)", 1),
    )
    link = F.regexp_replace(F.coalesce(canonical, refresh), "&amp;", "&")
    # Written between the steps: as one expression the rules for links outgrow what can be compiled.
    found = written(tag.where("source is not null").select("source", link.alias("link")), "links")
    return written(_resolved(found.where("link is not null")), "links").where("target is not null")


def parse_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, host, path, verdict) of (verdict, "host/path") pairs."""
    rows = [(text, text.partition("/")[0], "/" + text.partition("/")[2], verdict) for verdict, text in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, rule_verdict string")


def fitting_rule(addresses: DataFrame, rules: DataFrame, key: str, bound: int = BROADCAST_RULES) -> DataFrame:
    """(key, rule, rule_verdict): the longest rule that fits a (key, host, path) row, for keys that have one.

    A rule fits its host and all subdomains where the path starts with the rule's. Of rules of equal
    text, block wins. A row meets only the rules of its own host's suffixes, of no more labels than a rule's host has.
    """
    most = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 1
    labels = F.split("host", r"\.")
    first = F.greatest(F.size(labels) - (most - 1), F.lit(1))
    tail = F.slice(labels, first, F.lit(most))
    suffix = F.transform(F.array(tail), lambda t: F.transform(F.sequence(F.lit(1), F.size(t)), lambda i: F.array_join(F.slice(t, i, F.size(t)), ".")))[0]
    many = addresses.where("host != ''").select(F.col(key).alias("_key"), "path", F.explode(suffix).alias("rule_host"))
    small = rules.limit(bound + 1).count() <= bound
    found = many.join(F.broadcast(rules) if small else rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    rank = F.struct(F.length("rule").alias("n"), (F.col("rule_verdict") == BLOCK).alias("block"), F.col("rule"), F.col("rule_verdict"))
    best = found.groupBy("_key").agg(F.max(rank).alias("best"))
    return best.select(F.col("_key").alias(key), F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    edges: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """One row per page row: page_id, host, path, rule, verdict.

    `edges` (source, target) adds known redirects to the links found in the markup. A page that a rule
    fits gets that rule's verdict; else it is blocked if any alias is blocked by a rule, and allowed
    otherwise. Null, empty and odd URLs have empty host and path, no rule, no aliases, and are allowed.
    Repeated rows are judged alike, one result each. Very long URLs and pages are read whole. Further
    columns are ignored. Addresses are judged once however many pages carry them.
    """
    url = column(pages, url_col)
    named = pages.select(
        column(pages, id_col).alias("page_id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        address_of(url).alias("address"),
    )
    links = link_edges(pages, url_col, html_col) if html_col else None
    if edges is not None:
        given = edges.select("source", "target")
        links = given if links is None else links.union(given)
    where = named.select("host", "path").distinct().select("host", "path", F.concat("host", F.lit("\n"), "path").alias("place"))
    ruled = fitting_rule(where, rules, "place")
    out = named.withColumn("place", F.concat("host", F.lit("\n"), "path")).join(ruled, "place", "left")
    blocked = None
    if links is not None:
        ends = links.select(address_of(F.col("source")).alias("a"), address_of(F.col("target")).alias("b"))
        aliases = written(ends, "aliases").where("a != b").distinct()
        if not aliases.isEmpty():
            member = written(connected_components(aliases), "members")
            seen = F.concat(F.lit("x://"), F.col("node"))
            spots = member.select("node", "component", host_of(seen).alias("host"), path_of(seen).alias("path"))
            hit = fitting_rule(spots, rules, "node").where(F.col("rule_verdict") == BLOCK).select("node")
            bad = member.join(hit, "node").select("component").distinct()
            blocked = member.join(bad, "component").select(F.col("node").alias("address"), F.lit(True).alias("tainted"))
    out = out.join(blocked, "address", "left") if blocked is not None else out.withColumn("tainted", F.lit(False))
    verdict = F.coalesce("rule_verdict", F.when(F.col("tainted"), BLOCK).otherwise(ALLOW))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
