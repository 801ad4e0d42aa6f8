"""From landed content to chunks with vectors. Decoders and models plug in as batch callables."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.text import explode_pages, tokens
from docloom.schemas import COMPLETED, FAILED, PAGE

RETRY_WAITS = (1.0, 2.0, 4.0)

Page = tuple[int, str, int]
Extractor = Callable[[object], Sequence[Page]]
Scorer = Callable[[list[str]], Sequence[Sequence[float]]]


def failure_pages(message: Column) -> Column:
    """The page array that records a failed extraction."""
    return F.array(
        F.struct(
            F.lit(-1).alias("page_number"),
            F.concat(F.lit("Error: "), message).alias("page_text"),
            F.lit(-1).alias("total_pages"),
        )
    )


def with_pages(df: DataFrame, pages: Column, reason: Column | None = None) -> DataFrame:
    """Add ``pdf_text`` and ``extraction_status`` from a page-array expression; NULL means failed."""
    message = F.lit("no content") if reason is None else reason
    return df.withColumns({
        "extraction_status": F.when(pages.isNotNull(), COMPLETED).otherwise(FAILED),
        "pdf_text": F.coalesce(pages, failure_pages(message)),
    })


def decode_pages(
    df: DataFrame, content: str, extractor: Extractor, keep: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Run a Python decoder over ``content``; a row it cannot read becomes a failure record, not a failed job."""
    schema = T.StructType(
        [df.schema[c] for c in keep]
        + [T.StructField("extraction_status", T.StringType()), T.StructField("pdf_text", T.ArrayType(PAGE))]
    )
    keep = list(keep)

    def one(value: object) -> tuple[str, list[dict]]:
        try:
            pages = [dict(zip(("page_number", "page_text", "total_pages"), p)) for p in extractor(value)]
            return COMPLETED, pages
        except Exception as error:
            return FAILED, [{"page_number": -1, "page_text": f"Error: {error}", "total_pages": -1}]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            results = [one(v) for v in frame[content]]
            out = frame[keep].copy()
            out["extraction_status"] = [r[0] for r in results]
            out["pdf_text"] = [r[1] for r in results]
            yield out

    spread = df.select(*keep, content) if content not in keep else df.select(*keep)
    if partitions:
        spread = spread.repartition(partitions)
    return spread.mapInPandas(run, schema)


def chunk_pages(documents: DataFrame) -> DataFrame:
    """One chunk row per page. Documents with a NULL or empty page array give no rows."""
    page = F.col("_page")
    return explode_pages(documents, "pdf_text", "metadata_id").select(
        "metadata_id",
        page["page_text"].alias("chunk_text"),
        page["page_number"].alias("document_page_number"),
        page["total_pages"].alias("document_total_pages"),
        F.lit(COMPLETED).alias("chunking_status"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.lit(None).cast("string").alias("embedding_status"),
    )


def chunk_outcome(documents: DataFrame) -> DataFrame:
    """Chunking status of every document, those without pages included (FAILED, 0 chunks)."""
    n = F.when(F.col("pdf_text").isNull(), 0).otherwise(F.size("pdf_text"))
    return documents.select(
        "metadata_id",
        n.cast("bigint").alias("n_chunks"),
        F.when(n > 0, COMPLETED).otherwise(FAILED).alias("chunking_status"),
    )


def embed_from_vectors(chunks: DataFrame, vectors: DataFrame, on: str) -> DataFrame:
    """Embedding by look-up of precomputed vectors; empty text or no vector gives FAILED and ``[]``.

    Chunks without a key take no part in the join, so that they never meet in one task.
    """
    usable = F.coalesce(F.length("chunk_text") > 0, F.lit(False))
    found = chunks.filter(F.col(on).isNotNull()).join(vectors.select(on, F.col("embedding").alias("_vector")), on, "left")
    none = chunks.filter(F.col(on).isNull()).withColumn("_vector", F.lit(None).cast(vectors.schema["embedding"].dataType))
    joined = found.unionByName(none)
    ok = usable & F.col("_vector").isNotNull()
    return joined.select(
        "chunk_id",
        "metadata_id",
        F.when(ok, F.col("_vector").cast("array<double>")).otherwise(F.array().cast("array<double>")).alias("embedding"),
        F.when(ok, COMPLETED).otherwise(FAILED).alias("embedding_status"),
    )


def embed_hashing(chunks: DataFrame, dimension: int) -> DataFrame:
    """Unit-length hashed term counts, computed in the JVM; stands in for a model in offline runs."""
    usable = F.size(F.coalesce("_tokens", F.array().cast("array<string>"))) > 0
    words = chunks.withColumn("_tokens", tokens(F.coalesce("chunk_text", F.lit(""))))
    counted = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dimension).transform(words)
    unit = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0).transform(counted)
    return unit.select(
        "chunk_id",
        "metadata_id",
        F.when(usable, vector_to_array("_unit", dtype="float32"))
        .otherwise(F.array().cast("array<float>"))
        .alias("embedding"),
        F.when(usable, COMPLETED).otherwise(FAILED).alias("embedding_status"),
    )


def attempt(call: Callable[[], object], waits: Sequence[float]) -> tuple[object, str | None]:
    """Call until it succeeds, pausing ``waits`` between tries; the last error comes back as text."""
    error = None
    for wait in (*waits, None):
        try:
            return call(), None
        except Exception as caught:
            error = str(caught)
            if wait:
                time.sleep(wait)
    return None, error


def embed_chunks(
    chunks: DataFrame,
    make_scorer: Callable[[], Scorer],
    partitions: int | None = None,
    waits: Sequence[float] = RETRY_WAITS,
    batch_size: int = 64,
) -> DataFrame:
    """Embed with a model client made once per partition and called in batches.

    A batch that fails is retried text by text, so one bad text cannot fail its neighbours.
    Stage the result before using it twice.
    """
    schema = "chunk_id bigint, metadata_id bigint, embedding array<double>, embedding_status string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for frame in frames:
            vectors: list[list[float] | None] = [None] * len(frame)
            usable = [i for i, text in enumerate(frame["chunk_text"]) if text]
            texts = frame["chunk_text"].tolist()
            for start in range(0, len(usable), batch_size):
                rows = usable[start:start + batch_size]
                scored, error = attempt(lambda: list(scorer([texts[i] for i in rows])), ())
                if error is not None or len(scored) != len(rows):
                    scored = []
                    for i in rows:
                        one, _ = attempt(lambda: list(scorer([texts[i]]))[0], waits)
                        scored.append(one)
                for i, vector in zip(rows, scored):
                    vectors[i] = None if vector is None else [float(x) for x in vector]
            yield pd.DataFrame({
                "chunk_id": frame["chunk_id"],
                "metadata_id": frame["metadata_id"],
                "embedding": [v or [] for v in vectors],
                "embedding_status": [COMPLETED if v else FAILED for v in vectors],
            })

    spread = chunks.select("chunk_id", "metadata_id", "chunk_text")
    if partitions:
        spread = spread.repartition(partitions)
    return spread.mapInPandas(run, schema)
