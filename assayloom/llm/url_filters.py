"""URL rules that follow redirects and canonical links.

A rule names a host, for it and all its subdomains, and the start of a path.  The
longest rule that fits an address decides it.  Addresses that redirect to each
other or name each other as canonical are one thing under several names: an
address without a rule of its own gets the decision of its component.  There an
explicit allow of any member comes before a block of any other.  All of it is
DataFrame work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Saved, column, connected_components

ALLOW, BLOCK = "allow", "block"

#: Rules that are tried one by one in an expression; longer lists go as a table and are joined.
LISTED_RULES = 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Host with A to Z in lower case; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Path before ``?`` and ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """One name for an address: host, path and query, without scheme and fragment; null without a host."""
    query = F.coalesce(F.regexp_extract(after_scheme(url), r"^[^?#]*(\?[^#]*)", 1), F.lit(""))
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    return F.when(host_of(url) != "", F.concat(host_of(url), path, query))


def resolve(link: Column, url: Column) -> Column:
    """The address a link on the page means; null for fragments and for schemes that name no host."""
    link = F.replace(F.trim(link), F.lit("&amp;"), F.lit("&"))
    here = F.when(host_of(url) != "", F.concat(F.lit("http://"), host_of(url)))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    return (
        F.when((link == "") | link.startswith("#"), F.lit(None))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(here, link))
        .when(link.startswith("?"), F.concat(here, path_of(url), link))
        .otherwise(F.concat(here, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Canonical links and refresh redirects of pages (``url``, ``html``) as pairs of addresses ``a``, ``b``."""
    tags = F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0))
    rows = pages.filter(F.col("html").rlike(r"(?i)canonical|refresh")).select("url", F.explode(tags).alias("tag"))
    href = F.regexp_extract("tag", r"""(?i)\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    goal = F.regexp_extract("tag", r"""(?i)\bcontent\s*=\s*["'][^"'>]*?\burl\s*=\s*["']?([^"'>\s]+)""", 1)
    link = F.when(F.col("tag").rlike(r"""(?is)^<link\b.*\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""), F.regexp_replace(href, r"""^["']|["']$""", ""))
    link = link.when(F.col("tag").rlike(r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?refresh\b"""), goal)
    return rows.select(address_of(F.col("url")).alias("a"), address_of(resolve(link, F.col("url"))).alias("b"))


def _split_rule(rule: Column) -> tuple[Column, Column]:
    return F.translate(F.regexp_extract(rule, r"^[^/]*", 0), _UPPER, _LOWER), F.regexp_extract(rule, r"^[^/]*(.*)$", 1)


def _best(rule: Column, action: Column) -> Column:
    """Order of the rules that fit: length, then allow, then the text."""
    return F.struct(F.length(rule).alias("length"), (action == ALLOW).alias("allow"), rule.alias("rule"), action.alias("action"))


def match_listed(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``rule`` and ``action`` of a short list of (action, rule) to rows with ``host`` and ``path``."""
    if not rules:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action"))
    found = []
    for action, rule in rules:
        host, slash, path = rule.partition("/")
        host = host.translate(str.maketrans(_UPPER, _LOWER))
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        found.append(F.when(fits, _best(F.lit(rule), F.lit(action))))
    return urls.withColumn("_best", F.array_max(F.array(*found))).select("*", "_best.rule", "_best.action").drop("_best")


def match_table(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """As :func:`match_listed`, for a table (``action``, ``rule``) of any size.

    Each distinct address looks up the parts of its host, and of its path the
    starts as long as the rules of that host; it never meets rules that do not fit.
    """
    host, path = _split_rule(F.col("rule"))
    known = rules.filter("rule is not null and action is not null").select(host.alias("at"), path.alias("start"), "rule", "action")
    known = known.groupBy("at", "start").agg(F.max(_best(F.col("rule"), F.col("action"))).alias("best"))
    sizes = known.groupBy("at").agg(F.collect_set(F.length("start")).alias("sizes"))
    parts = F.transform(F.sequence(F.lit(1), F.size(F.split("host", r"\."))), lambda i: F.call_function("substring_index", F.col("host"), F.lit("."), -i))
    places = urls.select("host", "path").distinct().withColumn("at", F.explode(F.array_distinct(parts)))
    starts = places.join(sizes, "at").withColumn("size", F.explode("sizes")).filter(F.col("size") <= F.length("path"))
    starts = starts.withColumn("start", F.expr("substring(path, 1, size)"))
    best = starts.join(known, ["at", "start"]).groupBy("host", "path").agg(F.max("best").alias("best"))
    return urls.join(best, ["host", "path"], "left").select(urls["*"], "best.rule", "best.action")


def match_rules(urls: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    if isinstance(rules, DataFrame):
        return match_table(urls, rules)
    if len(rules) <= LISTED_RULES:
        return match_listed(urls, rules)
    return match_table(urls, urls.sparkSession.createDataFrame([tuple(r) for r in rules], "action string, rule string"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame, redirects: DataFrame | None = None,
               id_column: str = "page_id", url: str = "url", html: str | None = "html") -> DataFrame:
    """``id_column``, ``host``, ``path``, ``rule``, ``verdict``, ``by`` of every page.

    ``by`` is ``rule``, ``alias`` (decided by the component) or ``default`` (allow).
    ``redirects`` has further pairs of addresses, ``source`` and ``target``.

    - A null url, or one without ``://``, has an empty host and path and no address: only a rule of
      the empty host could fit, links do not reach it.
    - A null or empty html has no links; tags in comments count like others.
    - Repeated pages stay repeated; other columns are left out; no rows give no rows.
    """
    given = pages.select(
        column(pages, id_column).alias("id"), column(pages, url).alias("url"),
        (column(pages, html) if html else F.lit(None).cast("string")).alias("html"))
    links = page_links(given)
    if redirects is not None:
        more = redirects.select(address_of(F.col("source")).alias("a"), address_of(F.col("target")).alias("b"))
        links = links.unionByName(more)
    known = connected_components(links)
    decided = known.select("component", "node", F.concat(F.lit("x://"), "node").alias("url"))
    decided = match_rules(decided.select("component", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), rules)
    of_class = decided.groupBy("component").agg(
        F.coalesce(F.max(F.col("action") == ALLOW), F.lit(False)).alias("allowed"),
        F.coalesce(F.max(F.col("action") == BLOCK), F.lit(False)).alias("blocked")).filter("allowed or blocked")
    verdict = F.when(F.col("allowed"), F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    aliases = Saved(known.join(of_class, "component").select("node", verdict.alias("of_class")), "aliases")

    rows = given.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), address_of(F.col("url")).alias("node"))
    rows = match_rules(rows, rules).join(aliases.df, "node", "left")
    by = F.when(F.col("action").isNotNull(), F.lit("rule")).when(F.col("of_class").isNotNull(), F.lit("alias")).otherwise(F.lit("default"))
    return rows.select(
        F.col("id").alias(id_column), "host", "path", "rule",
        F.coalesce("action", "of_class", F.lit(ALLOW)).alias("verdict"), by.alias("by"))
