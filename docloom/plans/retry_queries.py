"""Queries over attempts, work spread by weight, and landing that resumes."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import attempts, positions
from docloom.plans import fixtures as fx
from docloom.plans.table_queries import _from_row, _pages_to_land, query
from docloom.schemas import FAILED
from docloom.sources import writers
from docloom.staging import scratch_path

TARGET, WAIT, LIMIT = 20_000, 5 * 86_400, 6


@query(f"""SELECT metadata_id, size, CAST((sum(size) OVER (ORDER BY metadata_id ROWS UNBOUNDED PRECEDING) - size) // {TARGET} AS BIGINT)
          AS batch_no FROM fx_meta""", "fx_meta")
def weighted_batches(spark, sf_dir):
    rows = fx.metadata(spark, sf_dir).select("metadata_id", "size")
    return positions.weighted_batches(rows, [F.col("metadata_id")], F.col("size"), TARGET)


def _all_accepted(frame):
    for row in frame.itertuples():
        yield writers.ACCEPTED_CONTENT, row.html.encode("utf-8")


# The first run fails for some pages; the second fetches those alone.
@query("""SELECT page_id AS metadata_id, contains(url, '#') AS fetched, 'COMPLETED' AS status,
          CAST(strlen(html) AS BIGINT) AS length, sha256(html) AS digest FROM pages""")
def land_missing(spark, sf_dir):
    pages = _pages_to_land(spark, sf_dir, scratch_path(spark, "landing"))
    manifest = scratch_path(spark, "manifest")
    writers.land_missing(pages, _from_row, manifest)
    again = writers.land_missing(pages, _all_accepted, manifest, verify=True)
    return again.select("metadata_id", "fetched", "status", "length", "digest")


def _ledger(spark, sf_dir):
    """From none to six tries of the download of every document, one a day."""
    known = fx.metadata(spark, sf_dir).select("metadata_id", F.col("size").alias("s")).filter("s % 7 > 0")
    tried = known.select("metadata_id", F.explode(F.expr("sequence(1, CAST(s % 7 AS INT))")).alias("attempt"))
    start = F.lit(fx.EARLIER).cast("timestamp")
    return tried.select("metadata_id", F.lit("download").alias("stage"), "attempt", F.lit("no answer").alias("error"),
                        (start + F.make_interval(days=F.col("attempt"))).alias("tried_at"))


@query(f"""WITH t AS (SELECT *, size % 7 AS n, epoch(TIMESTAMP '{fx.NOW}' - TIMESTAMP '{fx.EARLIER}') - (size % 7) * 86400 AS since FROM fx_meta),
  j AS (SELECT *, download_status = 'FAILED' AND n >= {LIMIT} AS dead,
          download_status = 'FAILED' AND n < {LIMIT} AND (n = 0 OR since >= {WAIT} * pow(2, n - 1)) AS again FROM t)
  SELECT metadata_id, CASE WHEN dead THEN 'DEAD_LETTER' WHEN again THEN 'PENDING' ELSE download_status END AS download_status,
    CASE WHEN again THEN 'PENDING' ELSE extraction_status END AS extraction_status,
    CASE WHEN again THEN 'PENDING' ELSE index_status END AS index_status FROM j""", "fx_meta")
def requeue_backoff(spark, sf_dir):
    moved = attempts.requeue_backoff(
        fx.metadata(spark, sf_dir), _ledger(spark, sf_dir), "download", F.lit(fx.NOW), wait_seconds=WAIT, limit=LIMIT)
    return moved.select("metadata_id", "download_status", "extraction_status", "index_status")


@query("""SELECT download_status AS status, CAST(size % 7 AS INTEGER) AS attempts, count(*) AS documents
          FROM fx_meta GROUP BY ALL""", "fx_meta")
def attempt_funnel(spark, sf_dir):
    return attempts.funnel_with_attempts(fx.metadata(spark, sf_dir), _ledger(spark, sf_dir), "download")


# Every failed download tried once more: its number follows the tries before it.
@query("""SELECT metadata_id, CAST(size % 7 + 1 AS INTEGER) AS attempt, 'gone' AS error FROM fx_meta
          WHERE download_status = 'FAILED'""", "fx_meta")
def next_attempts(spark, sf_dir):
    outcome = fx.metadata(spark, sf_dir).filter(F.col("download_status") == FAILED).select("metadata_id", F.lit("gone").alias("error"))
    return attempts.next_attempts(_ledger(spark, sf_dir), outcome, "download", F.lit(fx.NOW)).select("metadata_id", "attempt", "error")
