"""Secret scan over an incremental blob ledger, in DataFrame functions only.

Every version of every text is addressed by its SHA-256. The ledger holds one row per (blob, rule, version)
that was ever scanned, with the spans found. A scan reads the ledger, keeps the pairs it has not seen, fetches
one text per unseen blob, applies only the missing rules and appends; findings then join back to all rows
that carry the blob. Copies are scanned once, a new rule version rescans only itself.

Positions need no Python: ``split`` gives the gaps between matches and ``regexp_extract_all`` the matches, both
leftmost and non-overlapping, so running sums of their lengths are the spans in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.llm.registry import query
from docloom.staging import stage

LEDGER = "blob binary, rule string, version int, spans array<struct<start: int, end: int>>"
REDACTED = "[redacted]"


@dataclass(frozen=True)
class Rule:
    """``hint`` is a cheaper test that every text with a match passes; ``group``/``least``: length the match must have."""
    name: str
    pattern: str
    hint: str
    group: int = 0
    least: int = 0
    version: int = 1


# The first three rules and their order are given; a match of 'assign' may be too short and is then dropped.
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A private key runs to its END line, or else over the lines of its header and the key-like lines behind it. Loops are over
# single characters, counted, or possessive (``*+``, which Java runs without a deeper stack), so keys may have any length.
_BREAK = r"""[\x20\t\r\n\\"'>|#*,;+]+"""
_PEM = (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+){0,100}-----END [A-Z ]{0,40}PRIVATE KEY-----"
        rf"|(?:{_BREAK}(?:Proc-Type|DEK-Info):[^\r\n]*){{0,4}}(?:{_BREAK}[A-Za-z0-9+/=]{{20,}})*+"
        rf"(?:{_BREAK}[A-Za-z0-9+/]+={{1,2}}|[\r\n]+[A-Za-z0-9+/]+[\x20\t]*(?:\r?\n|$))?)")
RULES = (
    Rule("assign", _ASSIGN, r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{12}", 0, 16),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", r"[0-9a-f]{32}"),
    Rule("pem", _PEM, r"-----BEGIN ", version=2),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", r"eyJ[A-Za-z0-9_-]{10}"),
)
BASE = ("assign", "access", "hex")


def _long_enough(match: Column, rule: Rule) -> Column:
    value = F.regexp_extract(match, rule.pattern, rule.group) if rule.group else match
    return F.length(value) >= rule.least


def _pieces(text: Column, rule: Rule, wanted: Column) -> Column:
    """Gap and match lengths of one rule, in order; the last piece has no match."""
    found = F.zip_with(F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda gap, match: F.struct(
        F.lit(rule.name).alias("rule"), F.length(gap).alias("gap"), F.length(match).alias("size"), _long_enough(match, rule).alias("ok")))
    none = F.expr("CAST(array() AS array<struct<rule: string, gap: int, size: int, ok: boolean>>)")
    return F.when(wanted & text.rlike(rule.hint), found).otherwise(none)


def address(text: Column) -> Column:
    """The content address of a text; NULL counts as an empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Returns (new ledger rows, findings of all blobs of ``docs``: blob, spans array<struct<start, place, rule, end>>).

    ``docs`` has text and any other columns; ``ledger`` has the columns of ``LEDGER``. Findings have a row only for
    blobs in which some rule at its present version found something, spans ordered by start and rule. NULL and
    empty texts are one blob without findings. Repeated rows and copies share one scan. Both frames are staged.
    """
    spark = docs.sparkSession
    # No rows from the driver's Python: those pass through Python workers and a daemon of their own on every executor.
    ledger = spark.range(0).select(F.from_json(F.lit(None).cast("string"), LEDGER).alias("r")).select("r.*") if ledger is None else ledger
    now = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    current = ledger.filter(F.array_contains(now, F.struct("rule", "version")))
    rows = docs.select(F.xxhash64(F.struct("text")).alias("part"), address(F.col("text")).alias("blob"), "text")
    blobs = rows.groupBy("blob").agg(F.count("*").alias("copies"))
    # At most one entry per rule in the list, so the list is bounded by the rule book.
    seen = current.groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("seen"))
    known = blobs.join(seen, "blob", "left")
    unseen = stage(known.select("blob", F.array_except(now, F.coalesce("seen", F.array_except(now, now))).alias("missing"))
                   .filter(F.size("missing") > 0), "secrets-unseen")
    # One text per unseen blob: the first of each task, then the first of all.
    texts = rows.groupBy("blob").agg(F.any_value("text").alias("text")).join(unseen, "blob")
    wanted = F.transform("missing", lambda x: x["rule"])
    pieces = F.concat(*[_pieces(F.col("text"), r, F.array_contains(wanted, r.name)) for r in rules])
    order = Window.partitionBy("blob", "rule").orderBy("pos")
    cut = (texts.select("blob", pieces.alias("pieces")).filter(F.size("pieces") > 0)
           .select("blob", F.posexplode("pieces").alias("pos", "piece")).select("blob", "pos", "piece.*").filter("size IS NOT NULL"))
    ends = cut.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(order).cast("int")).filter("ok")
    found = ends.groupBy("blob", "rule").agg(F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("size")).alias("start"), "end"))).alias("spans"))
    new = unseen.select("blob", F.explode("missing").alias("pair")).select("blob", "pair.*")
    new = stage(new.join(stage(found, "secrets-found"), ["blob", "rule"], "left")
                .select("blob", "rule", "version", F.coalesce("spans", F.expr("CAST(array() AS array<struct<start: int, end: int>>)")).alias("spans")), "secrets-ledger")
    places = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    spans = current.select("blob", "rule", "spans").join(blobs.select("blob"), "blob", "left_semi").union(new.select("blob", "rule", "spans"))
    each = spans.filter(F.size("spans") > 0).select("blob", F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.element_at(places, F.col("rule")).alias("place"), F.col("rule").alias("rule"), s["end"].alias("end"))).alias("spans"))
    findings = each.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    return new, stage(findings, "secrets-findings")


def label(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_rule(name: str) -> Column:
    return F.filter("spans", lambda s: s["rule"] == name)


def _without(text: Column, rule: Rule) -> Column:
    gaps, matches = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    return F.array_join(F.zip_with(gaps, matches, lambda gap, match: F.concat(
        gap, F.when(match.isNull(), "").when(_long_enough(match, rule), REDACTED).otherwise(match))), "")


def redact(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``text`` with every secret replaced, rule after rule; linear in the text. Keys of many lines go first, so that
    no other rule breaks one up."""
    for rule in sorted(rules, key=lambda r: r.name != "pem"):
        text = _without(text, rule)
    return text


def _oracle() -> str:
    def found(rule: Rule) -> str:
        # RE2 knows neither look-behind nor possessive loops; what follows them here makes both the same without.
        pattern = rule.pattern.replace("(?<![0-9a-f])", "").replace(")*+", ")*").replace("'", "''")
        long = f"length(regexp_extract(m[i], '{pattern}', {rule.group})) >= {rule.least}"
        return (f"SELECT doc_id, '{rule.name}' AS rule, {[r.name for r in RULES].index(rule.name)} AS place, unnest(list_filter(list_transform("
                f"range(1, len(m) + 1), lambda i: {{'s': list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], "
                f"lambda x: length(x))), 0), 'n': length(m[i]), 'ok': {long}}}), lambda x: x.ok)) AS x FROM (SELECT doc_id, "
                f"string_split_regex(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}', 0) AS m FROM d)")

    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    f AS (SELECT doc_id, rule, place, x.s::BIGINT AS s, (x.s + x.n)::BIGINT AS e FROM ({' UNION ALL '.join(found(r) for r in RULES)})),
    t AS (SELECT doc_id, count(*) FILTER (rule = 'assign') AS n_assign, count(*) FILTER (rule = 'access') AS n_access, count(*) FILTER (rule = 'hex') AS n_hex,
      string_agg(rule || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans,
      string_agg(rule || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (place < 3) AS base FROM f GROUP BY 1)
    SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN t USING (doc_id)"""


@query(_oracle())
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    _, findings = scan(docs)
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    count = {k: F.size(_of_rule(k)).cast("long") for k in BASE}
    digest = findings.select("blob", *[c.alias(f"n_{k}") for k, c in count.items()], F.sha2(label(base), 256).alias("base_sha256"), label(F.col("spans")).alias("spans"))
    joined = docs.select("doc_id", address(F.col("text")).alias("blob")).join(digest, "blob", "left")
    return joined.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
                         F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
