"""URL filters with redirect equivalence (native).

A rule (host, path) fits its host and all subdomains where the url's path
starts with the rule's path; the longest fitting rule decides, an allow before
a block of the same length.  Urls linked by redirects (meta refresh, or a given
redirect table) and canonical links are aliases: connected components over
those links carry a block to every alias without a rule of its own.  A url's
own allow always stands (explicit allow precedence); so does its own block.  A
url without a rule in a component without a block is allowed.

Aliases are compared without scheme and fragment.  Defined results: a null url
or one without ``://`` has empty host and path, fits no rule and has no alias,
so it is allowed; null html has no links; repeated pages are judged alike; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import salted_join, staged, table
from podium.llm.components import components

#: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_REFRESH_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


def _rest(url: Column) -> Column:
    """The url after its first ``://``; null where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_key(url: Column) -> Column:
    """What aliases are compared by: host, path and query; null where there is no ``://``."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1)
    return F.when(_rest(url).isNotNull(), F.concat(host(url), path(url), query))


def _absolute(url: Column, link: Column) -> Column:
    """``link`` as an absolute url, seen from ``url``; null for an empty link."""
    folder = F.regexp_replace(path(url), r"[^/]*$", "")
    base = F.concat(F.lit("http://"), host(url))
    full = (
        F.when(F.locate("://", link) > 0, link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(base, link))
        .otherwise(F.concat(base, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )
    return F.when(link != "", full)


def links(pages: DataFrame) -> DataFrame:
    """``a``, ``b``: alias keys joined by a canonical link or a meta refresh of a page."""
    found = pages.select("url", F.explode(F.array(
        F.regexp_extract(F.regexp_extract("html", _CANONICAL, 0), _HREF, 1),
        F.regexp_extract(F.regexp_extract("html", _REFRESH, 0), _REFRESH_URL, 1),
    )).alias("link"))
    ends = found.where("link != ''").select(alias_key(F.col("url")).alias("a"), alias_key(_absolute(F.col("url"), F.col("link"))).alias("b"))
    return ends.where("a != b").distinct()


def own_rule(rules) -> Column:
    """Struct (rule, verdict) of the longest rule that fits ``host`` and ``path``; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    # the longest is tested first, an allow before a block of equal length
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[2] == "allow")):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule, verdict and component (null: no alias) of every page.

    ``rules`` is configuration, evaluated as one conditional per row;
    ``redirects`` optionally adds rows (from_url, to_url).
    """
    p = pages.select("page_id", "url", "html")
    edges = links(p)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(alias_key(F.col("from_url")).alias("a"), alias_key(F.col("to_url")).alias("b")))
    known = p.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), alias_key(F.col("url")).alias("node"))
    known = known.withColumn("own", own_rule(rules)).select("page_id", "url", "host", "path", "node", "own.*")
    comp = staged(components(edges), "aliases")
    # aliases count even if no page of theirs is in the table: rules apply to the key itself
    named = comp.select("node", "component", host(F.concat(F.lit("x://"), "node")).alias("host"), path(F.concat(F.lit("x://"), "node")).alias("path"))
    bad = named.where(own_rule(rules)["verdict"] == "block").select("component").distinct().withColumn("spread", F.lit(True))
    spread = salted_join(comp, bad, ["component"], F.col("node"))
    out = salted_join(known, spread, ["node"], F.coalesce(F.col("page_id"), F.lit(0)))
    final = F.coalesce(F.col("verdict"), F.when(F.col("spread"), F.lit("block")), F.lit("allow"))
    return out.select("page_id", "url", "host", "path", "rule", final.alias("verdict"), "component")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


_SQL_REST = "CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END"
_SQL_HOST = f"coalesce(translate(regexp_extract({{r}}, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}'), '')"
_SQL_PATH = "coalesce(regexp_extract({r}, '^[^/?#]*([^?#]*)', 1), '')"


def _sql_rule(column: int) -> str:
    """``CASE`` over the rules, longest first; ``column``: 0 the rule, 1 the verdict."""
    out = ""
    for h, p, v in sorted(RULES, key=lambda r: (-len(r[0]) - len(r[1]), r[2])):
        out += f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v if column else h + p}'"
    return f"CASE{out} END"


#: rules, and aliases by canonical link or refresh; relative links are resolved as in :func:`_absolute`
ORACLE = (
    r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html, """ + _SQL_REST + r""" AS rest FROM pages
), k AS (
  SELECT *, """ + _SQL_HOST.format(r="rest") + " AS host, " + _SQL_PATH.format(r="rest") + r""" AS path,
    regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS query FROM p
), n AS (
  SELECT *, CASE WHEN rest IS NOT NULL THEN host || path || query END AS node FROM k
), f AS (
  SELECT node, host, path, unnest([
    regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0), '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0), '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) AS link FROM n
), a AS (
  SELECT node, CASE WHEN contains(link, '://') THEN link WHEN starts_with(link, '//') THEN 'http:' || link
    WHEN starts_with(link, '/') THEN 'http://' || host || link
    ELSE 'http://' || host || CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || link END AS url
  FROM f WHERE link <> ''
), b AS (
  SELECT node, """ + _SQL_REST + r""" AS rest FROM a
), e AS (
  SELECT DISTINCT node AS a, """ + _SQL_HOST.format(r="rest") + " || " + _SQL_PATH.format(r="rest") + r""" || regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS b
  FROM b WHERE rest IS NOT NULL AND node IS NOT NULL
), g AS (
  SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b
), c(node, other) AS (
  SELECT a, b FROM g UNION SELECT c.node, g.b FROM c JOIN g ON c.other = g.a
), h AS (
  SELECT node, other, """ + _SQL_HOST.format(r="other") + " AS host, " + _SQL_PATH.format(r="other") + r""" AS path FROM c
), bad AS (
  SELECT DISTINCT node FROM h WHERE """ + _sql_rule(1) + r""" = 'block'
), j AS (
  SELECT n.*, """ + _sql_rule(0) + " AS rule, " + _sql_rule(1) + r""" AS verdict FROM n
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN bad.node IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM j LEFT JOIN bad ON j.node = bad.node
"""
)
