"""URL filter with redirect equivalence: rules by longest match, then decisions spread over aliases.

A page's own rule decides. A page without one takes the decision of its aliases: canonical links and redirects
are edges between addresses, connected components of them are aliases, and a block of any member reaches the
others unless a member is explicitly allowed. With neither, a page is allowed.

Rules are a table and may be many: every address is joined with them on each suffix of its host (a handful),
so the join is an equality, and the path is compared afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.graphs import connected_components
from docloom.llm.registry import query
from docloom.staging import stage

# Fixed values: (rule, decision).
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AFTER = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://`` or for NULL."""
    return F.translate(F.coalesce(F.regexp_extract(url, _AFTER, 1), F.lit("")), _UP, _LOW)


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; '' without ``://`` or for NULL."""
    return F.coalesce(F.regexp_extract(url, _AFTER, 2), F.lit(""))


def resolve(target: Column, url: Column) -> Column:
    """A link target as an absolute address, seen from ``url``."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    return (F.when(target.contains("://"), target).when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(root, target)).otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), target)))


def address(url: Column) -> Column:
    """What aliases are keyed by: host, path and query; scheme, fragment and campaign parameters do not matter."""
    question = F.regexp_extract(url, r"(?s)^[^#]*?\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(question, "&"), lambda p: (p != "") & ~p.startswith("utm_")), "&")
    return F.concat(host_of(url), path_of(url), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))


def edges_of(pages: DataFrame) -> DataFrame:
    """(a, b) addresses joined by a canonical link or a redirect of the page; one row per distinct edge."""
    links = F.array(F.when(F.lower("html").contains("canonical"), F.regexp_extract("html", _CANONICAL, 1)),
                    F.when(F.lower("html").contains("refresh"), F.regexp_extract("html", _REFRESH, 1)))
    found = pages.filter(host_of(F.col("url")) != "").select("url", F.explode(F.filter(links, lambda x: F.coalesce(x != "", F.lit(False)))).alias("target"))
    target = resolve(F.replace("target", F.lit("&amp;"), F.lit("&")), F.col("url"))
    return found.select(address(F.col("url")).alias("a"), target.alias("t")).select("a", address(F.col("t")).alias("b"), host_of(F.col("t")).alias("h")) \
        .filter("h <> '' AND a <> b").select("a", "b").distinct()


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``places`` (host, path, distinct) with ``rule`` and ``decision`` of the longest rule that fits, else NULL.

    ``rules`` (rule, decision): a rule is a host, then a path from its first ``/``. Of equal rules allow wins.
    """
    split = rules.filter("rule IS NOT NULL").groupBy("rule").agg(F.min("decision").alias("decision")).select(
        F.substring_index("rule", "/", 1).alias("rule_host"), F.expr("substr(rule, length(substring_index(rule, '/', 1)) + 1)").alias("rule_path"), "rule", "decision")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    spread = places.filter("host <> ''").select("host", "path", F.explode(suffixes).alias("rule_host"))
    best = (spread.join(split, "rule_host").filter(F.col("path").startswith(F.col("rule_path"))).groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "decision")).alias("best")))
    best = stage(best.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "best.rule", "best.decision"), "url-rules")
    return places.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left").drop("_h", "_p")


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, component.

    A NULL url or one without ``://`` has empty host and path, fits no rule, has no alias and is allowed. NULL
    html has no links. Repeated rows keep one result each; further columns are ignored; empty tables are fine.
    A very popular address is one row of the places table, so its copies never meet in one aggregate.
    """
    pages = pages.select("page_id", "url", "html")
    edges = stage(edges_of(pages), "url-edges")
    roots = connected_components(edges)
    keyed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = roots.withColumn("host", F.substring_index(F.substring_index("node", "/", 1), "?", 1)) \
        .withColumn("path", F.expr("substring_index(substr(node, length(host) + 1), '?', 1)"))
    places = stage(keyed.select("host", "path").union(known.select("host", "path")).distinct(), "url-places")
    judged = stage(match_rules(places, rules), "url-judged").select(F.col("host").alias("_h"), F.col("path").alias("_p"), "rule", "decision")
    on_place = (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p"))
    votes = known.join(judged, on_place, "left").groupBy("root").agg(
        F.bool_or(F.col("decision") == "allow").alias("allowed"), F.bool_or(F.col("decision") == "block").alias("blocked"))
    votes = stage(votes, "url-votes")
    aliases = stage(roots.join(votes, "root").select("node", "root", F.when(F.coalesce("allowed", F.lit(False)), "allow").when(
        F.coalesce("blocked", F.lit(False)), "block").alias("shared")), "url-aliases")
    out = keyed.withColumn("node", F.when(F.col("host") != "", address(F.col("url")))).join(judged, on_place, "left").join(aliases, "node", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("decision", "shared", F.lit("allow")).alias("verdict"), F.col("root").alias("component"))


def _oracle() -> str:
    def host(x: str) -> str:
        return rf"translate(coalesce(regexp_extract({x}, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{_UP}', '{_LOW}')"

    def path(x: str) -> str:
        return rf"coalesce(regexp_extract({x}, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"

    rules = ", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{d}')" for r, d in RULES)
    return f"""WITH r(rule, rh, rp, decision) AS (VALUES {rules}),
    p AS (SELECT page_id, {host('url')} AS host, {path('url')} AS path FROM pages),
    m AS (SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(decision, length(rule)) AS decision
      FROM (SELECT DISTINCT host, path FROM p WHERE host <> '') JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1, 2)
    SELECT page_id, p.host, p.path, m.rule, coalesce(m.decision, 'allow') AS verdict FROM p LEFT JOIN m ON m.host = p.host AND m.path = p.path"""


# Pages of the test tables have no canonical links or redirects, so their verdicts need no components; small tests hold those.
@query(_oracle())
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "rule string, decision string")
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules).drop("component")
