"""URL filter with redirect equivalence.

Rules of (host, path) allow or block a url and everything below it; the longest fitting rule
wins. Pages that no rule fits take the decision of their class: a redirect (meta refresh) or
a canonical link makes two urls aliases, and classes are the connected components of these
edges. A class with an allowed url is allowed, else one with a blocked url is blocked, else
it is allowed. A rule that fits a url itself always decides for that url.

Everything is a DataFrame expression, aggregation or join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.components import components
from rowsmith.llm.tables import Scratch, quoted

ALLOW, BLOCK = "allow", "block"
#: (verdict, host, path); a rule fits its host, all subdomains, and paths that start with its path.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
_CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
_TARGET = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)"


def _lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(_lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A url as a node of the alias graph: host, path and query, without scheme and fragment."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), path_of(url), F.coalesce(query, F.lit(""))))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, null without one.

    Two rules that fit one url and are of one length are the same rule.
    """
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, found).otherwise(best)
    return best


def folded(path: Column) -> Column:
    """An absolute path without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/", -1)

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    done = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"), step)
    # What ends in a dot segment is a folder.
    folder = F.element_at(parts, -1).isin(".", "..") & (F.size(done) > 0)
    return F.concat(F.lit("/"), F.array_join(done, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")))


def resolved(target: Column, url: Column) -> Column:
    """The url that a link on the page ``url`` means; null for mailto: and the like."""
    path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    above = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    above = F.when(above == "", F.lit("/")).otherwise(above)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:") | ~url.contains("://"), F.lit(None).cast("string"))
        .when(target.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?:)//", 1), target))
        .when(target.startswith("#"), url)
        .when(target.startswith("?"), F.concat(site, path_of(url), target))
        .when(target.startswith("/"), F.concat(site, folded(path), rest))
        .otherwise(F.concat(site, folded(F.concat(above, path)), rest))
    )


def alias_links(html: Column, url: Column) -> Column:
    """Urls that meta refresh and canonical links of the page ``url`` lead to."""
    canonical = F.transform(F.regexp_extract_all(html, F.lit(_CANONICAL), F.lit(0)), lambda t: F.regexp_extract(t, _HREF, 1))
    refresh = F.transform(F.regexp_extract_all(html, F.lit(_REFRESH), F.lit(0)), lambda t: F.regexp_extract(t, _TARGET, 1))
    both = F.transform(F.concat(canonical, refresh), lambda t: F.replace(t, F.lit("&amp;"), F.lit("&")))
    return F.transform(F.filter(both, lambda t: t != ""), lambda t: resolved(t, url))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``.

    A null url or one without :// has empty host and path, no rule, and is allowed. A null
    html has no links; relative links are resolved against the url of their page, ``<base>`` is not read.
    Repeated rows give repeated rows. No pages: no rows.
    """
    scratch = Scratch(pages.sparkSession)
    plain = pages.select(
        quoted(page_id).alias("page_id"), quoted(url).alias("url"), quoted(html).alias("html")
    )
    edges, _ = scratch.write(
        plain.filter("html ilike '%canonical%' or html ilike '%refresh%'")
        .select(node_of(F.col("url")).alias("a"), F.explode(alias_links(F.col("html"), F.col("url"))).alias("target"))
        .select("a", node_of(F.col("target")).alias("b")),
        "alias_links",
    )
    classes, _ = scratch.write(components(edges), "alias_classes")
    # Rules also judge targets that are no page themselves.
    target = F.concat(F.lit("x://"), F.col("node"))
    own = classes.select("component", rule_of(host_of(target), path_of(target), rules)["verdict"].alias("v"))
    decided = own.groupBy("component").agg(
        F.max(F.col("v") == ALLOW).alias("allowed"), F.max(F.col("v") == BLOCK).alias("blocked")
    )
    blocked = (
        classes.join(decided.filter("blocked and not coalesce(allowed, false)"), "component", "left_semi")
        .select(F.col("node").alias("alias"))
        .distinct()
    )
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = plain.select(
        "page_id", node_of(F.col("url")).alias("node"), host.alias("host"), path.alias("path"),
        rule_of(host, path, rules).alias("found"),
    )
    return judged.join(blocked, F.col("node") == F.col("alias"), "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("alias").isNotNull(), BLOCK).otherwise(ALLOW)).alias("verdict"),
    )
