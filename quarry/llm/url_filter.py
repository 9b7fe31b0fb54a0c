"""URL filter with redirect equivalence (DataFrame operations only).

1. Each url gets the longest of the given rules that fits it.
2. Redirects (``<meta http-equiv=refresh>``) and canonical links
   (``<link rel=canonical>``) of the page are edges between url keys: host and
   path with query, without scheme, fragment, tracking parameters and trailing
   slash, the differences that a site's own redirects remove. Pages with one key
   are aliases without an edge.
3. Connected components over the keys are the alias classes. A page without a
   rule of its own is blocked when a url of its class is blocked and none is
   explicitly allowed; a rule of its own always decides first.

Defined cases: a null url, or one without ``://``, has empty host and path, no
rule and no aliases, and is allowed; null html has no edges; repeated rows are
judged alike; an empty table gives an empty result; extra columns are ignored.
The rule list is a parameter and part of the plan (a policy, not data).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import connected_components
from quarry.llm.store import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_META = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_GOTO = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"
_TRACKING = r"(^|&)(utm_[a-z]+|ref|gclid|fbclid)=[^&]*"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains, below a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url):
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host, path, rules: list[Rule]):
    """``(rule, verdict)`` columns: the longest fitting rule, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is tried first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.text)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def url_key(url):
    """The name of a url's alias node; null without ``://``."""
    query = F.regexp_replace(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), _TRACKING, "")
    query = F.regexp_replace(query, r"^&+", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(
        host_of(url), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def link_targets(pages: DataFrame) -> DataFrame:
    """``(url, target)`` for each canonical link and redirect; relative targets are resolved."""
    found = pages.where("html is not null and url like '%://%'").select("url", F.explode(F.array(
        F.regexp_extract(F.regexp_extract("html", _LINK, 0), _HREF, 1),
        F.regexp_extract(F.regexp_extract("html", _META, 0), _GOTO, 1))).alias("t")).where("t <> ''")
    scheme = F.regexp_extract("url", r"^(.*?)://", 1)
    site = F.regexp_extract("url", r"^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_extract("url", r"^(.*?://[^?#]*)", 1), r"^(.*?://[^/]*(?:/.*/|/)?)", 1)
    t = F.replace("t", F.lit("&amp;"), F.lit("&"))
    target = (F.when(F.instr(t, "://") > 0, t)
              .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t))
              .when(t.startswith("/"), F.concat(site, t))
              .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), t)))
    return found.select("url", target.alias("target"))


def judged(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per page, plus the ``component`` of its url."""
    links = saved(link_targets(pages), "url-links")
    edges = links.select(url_key(F.col("url")).alias("u"), url_key(F.col("target")).alias("v"))
    classes = connected_components(edges)

    h, p, u = host_of(F.col("url")), path_of(F.col("url")), F.col("url")
    rule, verdict = rule_of(h, p, rules)
    own = pages.select("page_id", h.alias("host"), p.alias("path"), rule.alias("rule"),
                       verdict.alias("own"), url_key(u).alias("node"))
    # what the rules say of every url that is a page or a link's target, by class
    targets = links.select(F.col("target").alias("url"))
    said = (pages.select("url").union(targets)
            .select(url_key(u).alias("node"), rule_of(h, p, rules)[1].alias("own"))
            .where("own is not null and node is not null").distinct())
    by_node = classes.withColumnRenamed("component", "c")
    blocked = (said.join(by_node, "node", "left")
               .groupBy(F.coalesce("c", "node").alias("component"))
               .agg(F.max((F.col("own") == "allow").cast("int")).alias("some_allow"),
                    F.max((F.col("own") == "block").cast("int")).alias("some_block"))
               .where("some_block = 1 and some_allow = 0").select("component"))
    blocked = saved(blocked, "url-blocked").withColumn("hit", F.lit(True))
    # only the pages without a rule can be decided by their class; a page's own rule needs no join
    free = own.where("own is null").join(by_node, "node", "left").withColumn(
        "component", F.coalesce("c", "node")).join(blocked, "component", "left")
    free = free.select("page_id", "host", "path", "rule", F.when(F.col("hit"), "block").otherwise(
        F.lit(default)).alias("verdict"))
    return own.where("own is not null").select(
        "page_id", "host", "path", "rule", F.col("own").alias("verdict")).union(free)


#: The rules of the registered query.
RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
         Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]


def _sql_key(url: str) -> str:
    query = f"regexp_replace(regexp_replace(regexp_extract({url}, '://[^?#]*\\?([^#]*)', 1), '{_TRACKING}', '', 'g'), '^&+', '')"
    return (f"CASE WHEN contains({url}, '://') THEN translate(regexp_extract({url}, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
            f" || regexp_replace(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1), '/+$', '')"
            f" || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END")


def _sql_rule(host: str, path: str) -> tuple[str, str]:
    rows = sorted(RULES, key=lambda r: -len(r.text))
    fits = [f"WHEN ({host} = '{r.host}' OR ends_with({host}, '.{r.host}')) AND starts_with({path}, '{r.path}') THEN "
            for r in rows]
    return tuple("CASE " + " ".join(f + f"'{x}'" for f, x in zip(fits, xs)) + " ELSE NULL END"
                 for xs in ([r.text for r in rows], [r.verdict for r in rows]))


def _sql() -> str:
    rule, verdict = _sql_rule("host", "path")
    link = r"""regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)"""
    meta = r"""regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)"""
    return f"""
WITH RECURSIVE t AS (
  SELECT url, replace(x, '&amp;', '&') AS t FROM (
    SELECT url, unnest([{link}, {meta}]) AS x FROM pages WHERE contains(url, '://') AND html IS NOT NULL) WHERE x <> ''),
l AS (
  SELECT url, CASE WHEN contains(t, '://') THEN t
    WHEN starts_with(t, '//') THEN regexp_extract(url, '^(.*?)://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || t
    ELSE rtrim(regexp_extract(regexp_extract(url, '^(.*?://[^?#]*)', 1), '^(.*?://[^/]*(?:/.*/|/)?)', 1), '/') || '/' || t END AS target
  FROM t),
e AS (
  SELECT DISTINCT * FROM (
    SELECT {_sql_key('url')} AS u, {_sql_key('target')} AS v FROM l
    UNION ALL SELECT {_sql_key('target')}, {_sql_key('url')} FROM l) WHERE u <> v),
reach AS (
  SELECT u AS node, u AS other FROM e UNION SELECT r.node, e.v FROM reach r JOIN e ON r.other = e.u),
comp AS (SELECT node, min(other) AS c FROM reach GROUP BY node),
seen AS (
  SELECT {_sql_key('url')} AS node, {verdict} AS own FROM (
    SELECT url, translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
           regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT url FROM pages UNION ALL SELECT target FROM l) WHERE contains(url, '://'))),
blocked AS (
  SELECT coalesce(c, node) AS c FROM seen LEFT JOIN comp USING (node) WHERE own IS NOT NULL
  GROUP BY 1 HAVING bool_or(own = 'block') AND NOT bool_or(own = 'allow')),
p AS (
  SELECT page_id, {_sql_key('url')} AS node,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, {rule} AS rule,
  coalesce({verdict}, CASE WHEN coalesce(comp.c, p.node) IN (SELECT c FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN comp ON p.node = comp.node
"""


SQL = _sql()
