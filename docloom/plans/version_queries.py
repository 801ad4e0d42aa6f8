"""Queries over versioned tables, the load job, and the compacted sync log."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.filters import FlatFilter
from docloom.operators import merge as mg
from docloom.operators.rules import rules_of
from docloom.plans import fixtures as fx
from docloom.plans import jobs, loads
from docloom.plans.merge_queries import _LATEST, _LOG, _changes, _shown
from docloom.plans.table_queries import query
from docloom.schemas import COMPLETED, FAILED, METADATA, VERSION_KEY
from docloom.sources.generations import VersionedTable, hashed, ranged
from docloom.staging import scratch_path
from docloom.streaming import sync_stream
from docloom.streaming.sync_log import SyncLog

WIDTH = 16
_STATE = T.StructType([METADATA[c] for c in ("metadata_id", "document_number", "download_status")])


def _table(spark, part):
    table = VersionedTable(spark, scratch_path(spark, "versioned"), _STATE, part)
    table.create()
    return table


def _toxic(spark, sf_dir):
    """Outcomes of a small batch: documents labelled toxic, and as many new ones."""
    found = fx.table(spark, sf_dir, "labels").filter("toxic = 1").select(
        F.col("doc_id").alias("metadata_id"), F.when(F.col("quality") == 1, COMPLETED).otherwise(FAILED).alias("download_status"))
    return found.unionByName(found.withColumn("metadata_id", F.col("metadata_id") + 1000000)).withColumn("document_number", F.lit("LABELLED"))


_TOXIC = """toxic AS (SELECT doc_id AS metadata_id, CASE WHEN quality = 1 THEN 'COMPLETED' ELSE 'FAILED' END AS download_status
    FROM labels WHERE toxic = 1),
  batch AS (SELECT * FROM toxic UNION ALL SELECT metadata_id + 1000000, download_status FROM toxic)"""


def _merged(table, batch):
    return mg.merge(table, batch, ["metadata_id"], [mg.Update({"download_status": F.col("src.download_status")})], mg.Insert())


# The last column says whether the row lies in a part that the batch had written anew.
@query(f"""WITH {_TOXIC} SELECT coalesce(m.metadata_id, b.metadata_id) AS metadata_id, coalesce(m.document_number, 'LABELLED')
            AS document_number, coalesce(b.download_status, m.download_status) AS download_status,
            coalesce(m.metadata_id, b.metadata_id) // {WIDTH} IN (SELECT metadata_id // {WIDTH} FROM batch) AS rewritten
          FROM fx_meta m FULL OUTER JOIN batch b ON m.metadata_id = b.metadata_id""", "fx_meta")
def merge_partitioned(spark, sf_dir):
    table = _table(spark, ranged("metadata_id", WIDTH))
    first = table.publish(fx.metadata(spark, sf_dir).select(*_STATE.names))
    batch = _toxic(spark, sf_dir)
    parts = table.touched(batch)
    second = table.publish(_merged(table.read(parts=parts), batch), parts)
    differing = table.differing(first, second).select("part", F.lit(True).alias("_differs"))
    found = table.read().withColumn("part", table.part_of()).join(differing, "part", "left")
    return found.select(*_STATE.names, F.coalesce("_differs", F.lit(False)).alias("rewritten"))


@query(f"""WITH {_TOXIC},
          s1 AS (SELECT metadata_id, download_status FROM fx_meta WHERE metadata_id % 10 <> 3),
          s2 AS (SELECT coalesce(s1.metadata_id, b.metadata_id) AS metadata_id,
            coalesce(b.download_status, s1.download_status) AS download_status
            FROM s1 FULL OUTER JOIN batch b ON s1.metadata_id = b.metadata_id),
          s3 AS (SELECT * FROM s2 WHERE download_status <> 'FAILED'),
          states AS (SELECT 1 AS version, * FROM s1 UNION ALL SELECT 2, * FROM s2 UNION ALL SELECT 3, * FROM s3)
          SELECT CAST(coalesce(n.version, o.version + 1) AS BIGINT) AS version, coalesce(n.metadata_id, o.metadata_id) AS metadata_id,
            CASE WHEN o.metadata_id IS NULL THEN 'insert' WHEN n.metadata_id IS NULL THEN 'delete' ELSE 'update' END AS change_type,
            coalesce(n.download_status, o.download_status) AS download_status
          FROM states n FULL OUTER JOIN (SELECT * FROM states WHERE version < 3) o
            ON n.version = o.version + 1 AND n.metadata_id = o.metadata_id
          WHERE n.download_status IS DISTINCT FROM o.download_status""", "fx_meta")
def change_feed(spark, sf_dir):
    """Three publishes of a table, and what changed with each of them."""
    table = _table(spark, hashed("metadata_id", 64))
    table.publish(fx.metadata(spark, sf_dir).filter("metadata_id % 10 <> 3").select(*_STATE.names))
    batch = _toxic(spark, sf_dir)
    parts = table.touched(batch)
    table.publish(_merged(table.read(parts=parts), batch), parts)
    parts = table.touched(table.read().filter(F.col("download_status") == FAILED))
    table.publish(table.read(parts=parts).filter(F.col("download_status") != FAILED), parts)
    return table.changes(0, 3, "metadata_id", ["download_status"])


WANTED = FlatFilter(units=("en", "fr"), statuses=("Approved", "Effective"))
_MIDDLE = "2024-06-15T00:00:00.000Z"


# The watermark of the first load is the latest time in its export; the second load brings everything again, and more.
@query(f"""WITH wanted AS (SELECT *, try_strptime(version_modified_date, '%Y-%m-%dT%H:%M:%S.%gZ') AS stamp FROM fx_meta
            WHERE rendition_type = 'viewable_rendition__v' AND doc_control_name IN ('en', 'fr') AND status IN ('Approved', 'Effective')),
          mark AS (SELECT max(try_strptime(version_modified_date, '%Y-%m-%dT%H:%M:%S.%gZ')) AS stamp FROM fx_meta
            WHERE metadata_id % 3 <> 0 AND version_modified_date < '{_MIDDLE}'),
          loaded AS (SELECT * FROM wanted WHERE metadata_id % 3 <> 0 AND version_modified_date < '{_MIDDLE}'
            UNION ALL SELECT * FROM wanted WHERE stamp IS NULL OR stamp >= (SELECT stamp FROM mark))
          SELECT document_number, document_minor_version, document_major_version, CAST(1 AS BIGINT) AS n FROM loaded GROUP BY ALL""", "fx_meta")
def load_incremental(spark, sf_dir):
    root = scratch_path(spark, "load")
    to = jobs.Corpus(spark, "load", root=root, as_of=F.lit(fx.NOW).cast("timestamp"), part_width=1024)
    to.create()
    meta, rules = fx.metadata(spark, sf_dir), rules_of(spark, WANTED)
    early = meta.filter((F.col("metadata_id") % 3 != 0) & (F.col("version_modified_date") < _MIDDLE))
    for part in (early, meta, meta):
        loads.load(to, fx.export(part), "landing", f"{root}/mark", rules)
    return to.read("docs_metadata").groupBy(*VERSION_KEY).agg(F.count("*").alias("n"))


@query(_LATEST, "fx_chunks_before", "fx_chunks_after")
def sync_compacted(spark, sf_dir):
    """Sync, compact, sync: the changes after the compaction go on in the same log."""
    changes, feed = _changes(spark, sf_dir), scratch_path(spark, "feed")
    kept = SyncLog(spark, scratch_path(spark, "sync-log"), T.StructType([changes.schema[c] for c in _LOG]))
    earlier = F.col("audit__updated_date") == F.lit(fx.EARLIER).cast("timestamp")
    for part in (changes.filter(earlier), changes.filter(~earlier)):
        part.write.mode("append").parquet(feed)
        kept.sync(sync_stream.change_stream(spark, feed, changes.schema))
        if kept.compacted()[0] == 0:
            kept.compact()
    return kept.read().select("chunk_id", "chunk_text", "vec_id", _shown("audit__updated_date"))
