"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a boolean column that rejects. On a hashed sample each rule is run alone: its rejections give the
selectivity, its measured time the cost. The cascade asks the rules in order of rejections per second, in one
CASE expression, so a document that a cheap and strict rule rejects never pays for the rest. The order only
changes the time: a document is kept when no rule rejects it, whatever the order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.registry import query

SPACE = r"[\x20\x09-\x0D]+"
SAMPLE_ROWS = 1000  # size of the sample that sets the order of rules
REPEATS, TIMINGS, LEAST_SECONDS = 3, 2, 1e-3  # how often a rule judges the sample in a job, and the job is timed
RUN = 8


def split_words(text: Column) -> Column:
    """Words of the whole text; NULL gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` over ``value`` computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def count_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long")


def count_duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _pairs(hashes: Column, apart: int) -> Column:
    """Hash of every element with the one ``apart`` later; shorter by ``apart``."""
    return bound(hashes, lambda h: F.when(F.size(h) > apart, F.zip_with(
        F.slice(h, 1, F.size(h) - apart), F.slice(h, F.lit(1 + apart), F.size(h) - apart), lambda a, b: F.xxhash64(a, b)))
        .otherwise(F.expr("CAST(array() AS array<bigint>)")))


def count_repeated_words(words: Column) -> Column:
    """Words inside runs of eight that occur twice or more in the text, the first occurrence included.

    Doubling joins word hashes to hashes of two, four and eight words. Only texts in which some hash repeats
    sort their runs; runs of equal hash lie side by side, and the words they cover follow from the gaps
    between their sorted positions. Nothing grows faster than n log n.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for apart in (1, 2, 4):
        hashes = _pairs(hashes, apart)

    def covered(runs: Column) -> Column:
        ordered = F.array_sort(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = bound(ordered, lambda o: F.filter(o, lambda x, i: (
            ((i > 0) & (F.get(o, i - 1)["h"] == x["h"])) | F.coalesce(F.get(o, i + 1)["h"] == x["h"], F.lit(False)))))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return bound(at, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(RUN), F.coalesce(F.get(p, i + 1) - x, F.lit(RUN)))),
                                               F.lit(0).cast("long"), lambda total, x: total + x))

    return bound(hashes, lambda runs: F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0).cast("long")).otherwise(covered(runs)))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column  # over text, words, n_words, word_chars, n_symbols, n_dup_lines


def default_rules() -> list[Rule]:
    """Rules in no particular order. Each compares counts of the whole text; a text without words meets none."""
    text, words = F.coalesce("text", F.lit("")), F.col("words")
    n = F.greatest("n_words", F.lit(1))

    def share(matches: Callable[[Column], Column]) -> Column:
        return F.size(F.filter(words, matches)) / n

    return [
        Rule("symbols", F.col("n_symbols") * 10 > F.col("n_words")),
        Rule("long_words", F.col("word_chars") > 25 * F.col("n_words")),
        Rule("short_words", (F.col("word_chars") < 2 * F.col("n_words")) & (F.col("n_words") >= 20)),
        Rule("shouting", (F.length(F.regexp_replace(text, r"\P{Lu}+", "")) * 2 > F.length(F.regexp_replace(text, r"\P{L}+", ""))) & (F.col("n_words") >= 20)),
        Rule("exclaiming", (F.length(text) - F.length(F.replace(text, F.lit("!")))) * 4 > F.col("n_words")),
        Rule("wordless", (share(lambda w: w.rlike(r"\p{L}")) < 0.6) & (F.col("n_words") > 0)),
        Rule("duplicate_lines", F.col("n_dup_lines") * 2 > F.size(F.split(text, "\n", -1))),
        Rule("stutter", F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1)))) * 10 > 3 * F.col("n_words")),
        Rule("few_different_words", (F.size(F.array_distinct(words)) * 12 < F.col("n_words")) & (F.col("n_words") < 1000)),
    ]


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with words, n_words and the base counts but the repeated words."""
    counted = docs.select("doc_id", "text", split_words(F.col("text")).alias("words"))
    return counted.select("doc_id", "text", "words", F.size("words").cast("long").alias("n_words"),
                          F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                          count_symbols(F.col("text")).alias("n_symbols"), count_duplicate_lines(F.col("text")).alias("n_dup_lines"))


def order_rules(docs: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, rejected share, seconds) by rejections per second, from about ``SAMPLE_ROWS`` documents, twice that at most.

    A rule's seconds are its own: every document of the sample is judged ``REPEATS`` times in a job, jobs run once
    before they are timed, the best of ``TIMINGS`` counts, and the time of a job without a rule is taken off.
    """
    # Rows by hash, about SAMPLE_ROWS of them, picked where they lie; the limit only matters when many rows are equal.
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000_007)) < int(1_000_000_007 * share) + 1
    sample = docs.select("doc_id", "text").filter(drawn).limit(2 * SAMPLE_ROWS)
    counted = with_counts(sample).cache()
    try:
        rows = max(1, counted.count())
        # Copies come after the cache, so a rule is evaluated for each of them.
        repeated = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

        def timed(rejects: Column) -> tuple[int, float]:
            job, seconds = repeated.agg(F.count_if(rejects)), []
            for _ in range(1 + TIMINGS):
                start = time.perf_counter()
                rejected = job.first()[0]
                seconds.append(time.perf_counter() - start)
            return rejected, min(seconds[1:])

        _, empty = timed(F.col("n_words") < 0)
        measured = []
        for rule in rules:
            rejected, seconds = timed(rule.rejects)
            measured.append((rule, rejected / (rows * REPEATS), max(seconds - empty, LEAST_SECONDS)))
    finally:
        counted.unpersist()
    return sorted(measured, key=lambda m: (-m[1] / m[2], m[0].name))


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, else NULL; later rules are not evaluated then."""
    out = F.when(F.lit(False), F.lit(""))
    for rule in rules:
        out = out.when(rule.rejects, F.lit(rule.name))
    return out


def judge(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, base counts, base_failed, kept, stopped_by.

    NULL and blank texts have no words, fail the base and are not kept. Repeated rows and NULL doc_ids are
    judged like others; further columns are ignored whatever their names; an empty table gives an empty one.
    """
    rules = default_rules() if rules is None else rules
    ordered = [rule for rule, _, _ in order_rules(docs, rules)]
    base = with_counts(docs).withColumn("n_repeat_words", count_repeated_words(F.col("words")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = base.withColumn("base_failed", failed).withColumn("stopped_by", F.when(F.col("base_failed"), "base").otherwise(cascade(ordered)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         F.col("stopped_by").isNull().alias("kept"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
       list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
c AS (SELECT doc_id, text, w, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
       (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM c WHERE len(w) >= 8),
r AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS run FROM g),
t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM r) WHERE n > 1),
n AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS j FROM t) GROUP BY 1),
b AS (SELECT c.*, coalesce(n.n, 0)::BIGINT AS n_repeat_words FROM c LEFT JOIN n USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR n_symbols * 10 > n_words
  OR word_chars > 25 * n_words OR (word_chars < 2 * n_words AND n_words >= 20)
  OR (length(regexp_replace(text, '\P{Lu}+', '', 'g')) * 2 > length(regexp_replace(text, '\P{L}+', '', 'g')) AND n_words >= 20)
  OR (length(text) - length(replace(text, '!', ''))) * 4 > n_words
  OR (len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) / greatest(n_words, 1) < 0.6 AND n_words > 0)
  OR len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) * 10 > 3 * n_words
  OR n_dup_lines * 2 > len(string_split(text, chr(10))) OR (len(list_distinct(w)) * 12 < n_words AND n_words < 1000)) AS kept FROM f"""


@query(ORACLE_SQL)
def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
