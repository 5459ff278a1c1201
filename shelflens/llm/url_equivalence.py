"""URL filters over redirect equivalence.

A page's own rule is the longest one whose host is the url's host or a parent
of it and whose path begins the url's path.  Urls joined by redirects (meta
refresh, and a table of redirects if there is one) or by canonical links are
aliases: connected components over these edges.  A url without a rule of its
own is blocked if an alias, in the table of pages or not, is blocked by rule
and no alias is explicitly allowed; an explicit allow wins over a propagated
block.  All else is allowed.

Urls are the same node if they agree but for scheme, fragment and the case of
the host.

Defined cases: a null url, or one without `://`, has empty host and path, no
rule, no alias, and is allowed; null html has no edges; of equally long rules
an allow wins; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..staging import stage
from .components import connected_components

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Rule = tuple[str, str, str]  # host, path, "block" or "allow"

_COMMENT = r"(?s)<!--.*?-->"
# `canonical` may stand among other values of `rel`.
_CANONICAL = (
    r"(?is)(<link\b[^>]*\brel\s*=\s*(?:\"(?:[^\">]*\s)?canonical(?:\s[^\">]*)?\"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'"
    r"|canonical\b)[^>]*>)"
)
_REFRESH = r"(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b[^>]*>)"
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
_TARGET = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'>\s]+)"
_AMPERSAND = r"(?i)&(?:amp|#38|#x26);"  # the one sign of urls that pages must escape


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The url without scheme and fragment, host in lower case; null where there is no `://`."""
    rest = F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(F.lit("://"), host_of(url), rest))


def _resolved(base: Column, link: Column) -> Column:
    """A link as a full url, seen from the page at `base`."""
    link = F.trim(link)
    host = F.regexp_extract(base, r"://([^/?#]*)", 1)
    folder = F.regexp_extract(path_of(base), r"^(.*/)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("x:"), link))
        .when(link.startswith("/"), F.concat(F.lit("x://"), host, link))
        .when(link == "", None)
        .otherwise(F.concat(F.lit("x://"), host, F.when(folder == "", "/").otherwise(folder), link))
    )


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`a`, `b`: nodes joined by a canonical link or a meta refresh of a page."""
    found = pages.select(pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    found = found.where(F.col("html").rlike("(?i)canonical|refresh") & F.col("url").contains("://"))
    bare = F.when(F.col("html").contains("<!--"), F.regexp_replace("html", _COMMENT, " ")).otherwise(F.col("html"))
    found = found.select("url", bare.alias("html"))
    href = F.col("tag")
    canonical = found.select("url", F.explode(F.regexp_extract_all("html", F.lit(_CANONICAL), 1)).alias("tag")).select(
        "url", F.concat(*[F.regexp_extract(href, _HREF, i) for i in (1, 2, 3)]).alias("link")
    )
    refresh = found.select("url", F.explode(F.regexp_extract_all("html", F.lit(_REFRESH), 1)).alias("tag")).select(
        "url", F.regexp_extract(href, _TARGET, 1).alias("link")
    )
    links = canonical.union(refresh).where("link != ''").select("url", F.regexp_replace("link", _AMPERSAND, "&").alias("link"))
    return links.select(
        node_of(F.col("url")).alias("a"), node_of(_resolved(F.col("url"), F.col("link"))).alias("b")
    ).where("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct()


def rule_table(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return pages.sparkSession.createDataFrame(
        [(h, p, h + p, a) for h, p, a in rules], "rule_host string, rule_path string, rule string, action string"
    )


def matched_rules(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """`host`, `path`, `rule`, `action` for those different (host, path) that a rule fits."""
    parts = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    each = sites.select("host", "path").distinct().select("host", "path", F.explode(parents).alias("rule_host"))
    fitting = each.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = F.max(F.struct(F.char_length("rule").alias("size"), (F.col("action") == "allow").alias("allow"), "rule"))
    return fitting.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", F.col("best.rule").alias("rule"),
        F.when(F.col("best.allow"), "allow").otherwise("block").alias("action"),
    )


def blocked_aliases(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """`node`: members of components that hold a blocked url and no explicitly allowed one."""
    members = connected_components(edges).select("node", "component", host_of(F.col("node")).alias("host"),
                                                 path_of(F.col("node")).alias("path"))
    members = stage(members, "aliases")
    ruled = members.join(matched_rules(members, rules), ["host", "path"])
    verdicts = ruled.groupBy("component").agg(
        F.max(F.col("action") == "block").alias("blocked"), F.max(F.col("action") == "allow").alias("allowed")
    )
    return members.join(verdicts.where("blocked AND NOT allowed"), "component", "left_semi").select("node")


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """`page_id`, `host`, `path`, `rule` (null if none fits), `verdict`, `by_alias` per page.

    `redirects`: further edges, two columns of urls.
    """
    table = rule_table(pages, rules)
    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        a, b = (F.col(c).cast("string") for c in redirects.columns[:2])
        edges = edges.union(redirects.select(node_of(a), node_of(b)).dropna()).distinct()
    blocked = blocked_aliases(stage(edges, "edges"), table)
    url = pages[url_col].cast("string")
    urls = pages.select(
        pages[id_col].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
        F.coalesce(node_of(url), F.lit("")).alias("node"),
    )
    return (
        urls.join(matched_rules(urls, table), ["host", "path"], "left")
        .join(blocked.withColumn("hit", F.lit(True)), "node", "left")
        .select(
            "page_id", "host", "path", "rule",
            F.when(F.col("action").isNotNull(), F.col("action")).when(F.col("hit"), "block").otherwise("allow")
            .alias("verdict"),
            (F.col("action").isNull() & F.coalesce("hit", F.lit(False))).alias("by_alias"),
        )
    )
