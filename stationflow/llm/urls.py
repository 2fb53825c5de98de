"""URL filters: rules by host and path, and block decisions that reach aliases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.components import components
from stationflow.llm.shared import UPPER, store

_AFTER = r"://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _AFTER, 1)
    return F.translate(found, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _AFTER, 2)


def node_of(url: Column) -> Column:
    """One name for a resource: scheme and host lower-cased, no fragment."""
    bare = F.regexp_replace(url, "(?s)#.*$", "")
    head = F.regexp_extract(bare, r"^([^/?#]*://[^/?#]*)", 1)
    return F.concat(
        F.translate(head, UPPER, UPPER.lower()), F.substr(bare, F.length(head) + 1)
    )


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``rule, rule_host, rule_path, verdict`` from pairs like ("net/es/", "block")."""
    rows = [(r, r.partition("/")[0].lower(), "/" + r.partition("/")[2], v) for r, v in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, verdict string")


def explicit(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict``: the longest rule that fits each distinct place, if any does.

    A host is spread over its suffixes, so rules are found by an equality join
    and any number of them works.
    """
    labels = F.split("host", r"\.")
    suffix = lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    spread = places.select("host", "path").distinct().select(
        "host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), suffix)).alias("s")
    )
    fits = spread.join(rules, F.col("s") == F.col("rule_host")).filter(
        F.startswith("path", F.col("rule_path"))
    )
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def links(pages: DataFrame) -> DataFrame:
    """Alias edges ``u, v``: canonical links and refresh redirects in the raw HTML.

    Relative targets are resolved against the page's URL.
    """
    tags = F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0))
    tag = F.col("tag")
    canonical = F.regexp_like(tag, F.lit(r"(?i)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"))
    refresh = F.regexp_like(tag, F.lit(r"(?i)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"))
    href = F.regexp_extract(tag, r"(?i)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1)
    goes = F.regexp_extract(tag, r"(?i)\burl\s*=\s*[\"']?\s*([^\"'\s>;]+)", 1)
    to = F.replace(F.when(canonical, href).when(refresh, goes), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract("url", r"^([^:/?#]*):", 1)
    site = F.regexp_extract("url", r"^([^/?#]*://[^/?#]*)", 1)
    folder = F.regexp_extract("url", r"^([^?#]*/)", 1)
    full = (
        F.when(F.regexp_like("to", F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), F.col("to"))
        .when(F.startswith("to", F.lit("//")), F.concat(scheme, F.lit(":"), "to"))
        .when(F.startswith("to", F.lit("/")), F.concat(site, "to"))
        .when(F.startswith("to", F.lit("?")), F.concat(site, path_of(F.col("url")), "to"))
        .otherwise(F.concat(F.when(path_of(F.col("url")) == "", F.concat(site, F.lit("/"))).otherwise(folder), "to"))
    )
    return (
        pages.filter(F.col("url").isNotNull())
        .select("url", F.explode(tags).alias("tag"))
        .select("url", to.alias("to"))
        .filter("to <> ''")
        .select(node_of(F.col("url")).alias("u"), node_of(full).alias("v"))
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """The verdict on every page's URL: ``page_id, host, path, rule, verdict, alias_of``.

    The longest fitting rule decides. A URL without one takes the decision of
    its redirect class, that is all URLs connected by canonical links, refresh
    redirects and the optional edges ``redirects (u, v)``: allow if a member is
    explicitly allowed, else block if one is blocked, else allow. ``alias_of``
    is the smallest URL of the class.

    NULL or malformed URLs have an empty host and path, no rule and no aliases:
    allow. NULL HTML has no links. Repeated pages are judged alike, each keeping
    its row; no pages give no rows; other columns are not read.
    """
    pages = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    edges = links(pages)
    if redirects is not None:
        edges = edges.unionByName(
            redirects.select(node_of(F.col("u")).alias("u"), node_of(F.col("v")).alias("v"))
        )
    classes = store(components(edges), "classes")
    named = pages.select(
        "page_id", node_of(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    )
    members = classes.select(
        "node", "root", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")
    )
    ruled = store(
        explicit(named.select("host", "path").unionByName(members.select("host", "path")), rules),
        "ruled",
    )
    of_class = (
        members.join(ruled, ["host", "path"])
        .groupBy("root")
        .agg(F.min("verdict").alias("class_verdict"))  # "allow" sorts before "block"
    )
    alias = store(classes.join(of_class, "root", "left"), "aliases")
    return (
        named.join(ruled, ["host", "path"], "left")
        .join(alias, "node", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("verdict", "class_verdict", F.lit("allow")).alias("verdict"),
            F.col("root").alias("alias_of"),
        )
    )
