"""Queries over retrieval and chat preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import chat, inverted, search
from docloom.plans import fixtures as fx
from docloom.plans.table_queries import query
from docloom.staging import scratch_path, stage

# --- oracle pieces -------------------------------------------------------------------------

_SCORED = """scored AS (SELECT q.question_id, c.chunk_id, c.lang,
    round(list_inner_product(CAST(qe.embedding AS DOUBLE[]), CAST(ce.embedding AS DOUBLE[])), 4) AS score
  FROM fx_questions q JOIN embeddings qe ON qe.vec_id = q.vec_id
  CROSS JOIN (SELECT chunk_id, lang, vec_id FROM fx_chunks WHERE embedding_status = 'COMPLETED') c
  JOIN embeddings ce ON ce.vec_id = c.vec_id)"""


def _top(name: str, source: str, k: int, where: str = "true") -> str:
    return f"""{name} AS (SELECT * FROM (SELECT question_id, chunk_id, score, CAST(row_number() OVER (
      PARTITION BY question_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM {source} WHERE {where})
      WHERE rank <= {k})"""


def _bm25(questions: str) -> str:
    """Scores of every question and chunk that share a term."""
    return rf"""live AS (SELECT c.* FROM fx_chunks c JOIN embeddings USING (vec_id) WHERE embedding_status = 'COMPLETED'),
    words AS MATERIALIZED (SELECT chunk_id,
      unnest(regexp_extract_all(lower(chunk_text), '[\p{{L}}\p{{N}}]+')) AS term FROM live),
    lengths AS (SELECT chunk_id, count(*) AS dl FROM words GROUP BY chunk_id),
    corpus AS (SELECT (SELECT count(*) FROM live) AS n,
      (SELECT count(*) FROM words) / (SELECT count(*) FROM live)::DOUBLE AS avg_dl),
    tf AS (SELECT chunk_id, term, count(*) AS tf FROM words GROUP BY chunk_id, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    asked AS (SELECT DISTINCT question_id, term FROM (SELECT question_id,
      unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS term FROM {questions})),
    lexical AS (SELECT a.question_id, t.chunk_id, round(sum(
        ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
        / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_dl))), 4) AS score
      FROM asked a JOIN tf t USING (term) JOIN df USING (term) JOIN lengths USING (chunk_id), corpus
      GROUP BY a.question_id, t.chunk_id)"""


_LINK = """concat('https://documents.example/#doc_info/', m.document_id, '/', m.document_major_version, '/',
    m.document_minor_version, '/')"""
_DESCRIBED = f"""described AS (SELECT t.question_id, t.rank, c.chunk_text, m.document_number, m.document_title,
    {_LINK} AS link, c.document_page_number
  FROM top t JOIN fx_chunks c USING (chunk_id) JOIN fx_meta m USING (metadata_id))"""
_CONTEXT = """context AS (SELECT question_id, CAST(to_json({'chunks': list({'chunk_text': chunk_text,
    'metadata': {'document_number': document_number, 'document_title': document_title, 'document_link': link,
                 'document_page_number': document_page_number}} ORDER BY rank)}) AS VARCHAR) AS context
  FROM described GROUP BY question_id)"""


# --- retrieval -----------------------------------------------------------------------------

def _chunks(spark, sf_dir):
    return search.searchable(fx.chunks_with_vectors(spark, sf_dir))


def _index(spark, sf_dir, *columns):
    """The text index holds what the search table holds: chunks without a vector are in neither."""
    return stage(search.text_index(_chunks(spark, sf_dir), *columns), "text-index")


def _described(spark, sf_dir):
    meta = fx.metadata(spark, sf_dir).select(
        "metadata_id", "document_number", "document_title", "document_id", "document_major_version",
        "document_minor_version")
    chunks = fx.chunks(spark, sf_dir).select("chunk_id", "metadata_id", "chunk_text", "document_page_number")
    return chunks.join(meta, "metadata_id")


@query(f"WITH {_SCORED}, {_top('top', 'scored', 8)} SELECT question_id, chunk_id, score, rank FROM top",
       "fx_chunks", "fx_questions")
def knn_exact(spark, sf_dir):
    return search.vector_topk(fx.questions(spark, sf_dir), _chunks(spark, sf_dir))


def _requested(spark, sf_dir):
    """The filter a request carries: it depends on who spoke last, and a system message carries none."""
    last = fx.table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("question_id")).agg(
        F.max_by("role", "turn").alias("role"))
    allowed = (
        F.when(F.col("role") == "user", F.array(F.lit("en"), F.lit("fr")))
        .when(F.col("role") == "assistant", F.array(F.lit("de"), F.lit("es")))
    )
    return last.select("question_id", allowed.alias("allowed"))


@query(f"""WITH {_SCORED}, last AS (SELECT conv_id AS question_id, arg_max(role, turn) AS role FROM conversations
            GROUP BY conv_id), passing AS (SELECT s.* FROM scored s JOIN last USING (question_id) WHERE CASE role
            WHEN 'user' THEN lang IN ('en', 'fr') WHEN 'assistant' THEN lang IN ('de', 'es') ELSE lang IN ('en') END),
          {_top('top', 'passing', 8)} SELECT question_id, chunk_id, score, rank FROM top""",
       "fx_chunks", "fx_questions")
def knn_filtered(spark, sf_dir):
    asked = search.with_default_filter(fx.questions(spark, sf_dir), _requested(spark, sf_dir), "lang", ["en"])
    return search.vector_topk(asked, _chunks(spark, sf_dir), filters=["lang"])


@query(None)
def knn_lsh(spark, sf_dir):
    return search.lsh_topk(fx.questions(spark, sf_dir), _chunks(spark, sf_dir))


_LAST = "last AS (SELECT conv_id AS question_id, arg_max(role, turn) AS role FROM conversations GROUP BY conv_id)"
_ALLOWED = """CASE role WHEN 'user' THEN lang IN ('en', 'fr') WHEN 'assistant' THEN lang IN ('de', 'es') ELSE lang IN ('en') END"""
_FILTERED_LEXICAL = f"""{_bm25('fx_questions')}, {_LAST},
    worded AS (SELECT l.* FROM lexical l JOIN fx_chunks USING (chunk_id) JOIN last USING (question_id) WHERE {_ALLOWED})"""


@query(f"""WITH items AS (SELECT item_id AS question_id, text FROM benchmark), {_bm25('items')},
           {_top('top', 'lexical', 8)} SELECT question_id, chunk_id, score, rank FROM top""", "fx_chunks")
def bm25_topk(spark, sf_dir):
    items = fx.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), "text")
    return search.bm25_topk(items, _index(spark, sf_dir))


@query(f"""WITH items AS (SELECT item_id AS question_id, text FROM benchmark), {_bm25('items')},
           {_top('top', 'lexical', 8)} SELECT question_id, chunk_id, score, rank FROM top""", "fx_chunks")
def bm25_stored(spark, sf_dir):
    """The same answers from a stored inverted index."""
    path = scratch_path(spark, "inverted")
    inverted.build_index(_index(spark, sf_dir), path)
    items = fx.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), "text")
    return inverted.stored_topk(spark, items, path)


@query(f"""WITH {_FILTERED_LEXICAL}, {_top('top', 'worded', 8)} SELECT question_id, chunk_id, score, rank FROM top""",
       "fx_chunks", "fx_questions")
def bm25_stored_filtered(spark, sf_dir):
    """Each request's own filter over the stored index, which keeps the filter column with its postings."""
    path = scratch_path(spark, "inverted")
    inverted.build_index(_index(spark, sf_dir, "lang"), path, ["lang"])
    asked = search.with_default_filter(fx.questions(spark, sf_dir), _requested(spark, sf_dir), "lang", ["en"])
    return inverted.stored_topk(spark, asked, path, filters=["lang"])


@query(f"""WITH {_SCORED}, {_bm25('fx_questions')}, {_top('by_vector', 'scored', 40)},
           {_top('by_text', 'lexical', 40)}, fused AS (SELECT question_id, chunk_id,
             round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT question_id, chunk_id, rank FROM by_vector
             UNION ALL SELECT question_id, chunk_id, rank FROM by_text) GROUP BY question_id, chunk_id),
           {_top('top', 'fused', 8)} SELECT question_id, chunk_id, score, rank FROM top""",
       "fx_chunks", "fx_questions")
def hybrid_rrf(spark, sf_dir):
    return search.hybrid_topk(fx.questions(spark, sf_dir), _chunks(spark, sf_dir), _index(spark, sf_dir))


_FILTERED = f"""{_SCORED}, {_bm25('fx_questions')}, {_LAST},
    near AS (SELECT s.* FROM scored s JOIN last USING (question_id) WHERE {_ALLOWED}),
    worded AS (SELECT l.* FROM lexical l JOIN fx_chunks USING (chunk_id) JOIN last USING (question_id) WHERE {_ALLOWED}),
    {_top('by_vector', 'near', 40)}, {_top('by_text', 'worded', 40)}, fused AS (SELECT question_id, chunk_id,
      round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT question_id, chunk_id, rank FROM by_vector
      UNION ALL SELECT question_id, chunk_id, rank FROM by_text) GROUP BY question_id, chunk_id), {_top('top', 'fused', 8)}"""


@query(f"WITH {_FILTERED} SELECT question_id, chunk_id, score, rank FROM top", "fx_chunks", "fx_questions")
def hybrid_filtered(spark, sf_dir):
    """Hybrid search in which each request's filter, or the default one, holds for both lists."""
    asked = search.with_default_filter(fx.questions(spark, sf_dir), _requested(spark, sf_dir), "lang", ["en"])
    return search.hybrid_topk(asked, _chunks(spark, sf_dir), _index(spark, sf_dir, "lang"), filters=["lang"])


@query(f"""WITH {_SCORED}, {_top('top', 'scored', 8)}, {_DESCRIBED}, {_CONTEXT}
           SELECT question_id, context FROM context""", "fx_chunks", "fx_questions", "fx_meta")
def context_json(spark, sf_dir):
    return chat.context_json(knn_exact(spark, sf_dir), _described(spark, sf_dir))


@query(f"""WITH {_SCORED}, {_top('top', 'scored', 8)}, {_DESCRIBED}, merged AS (SELECT question_id, document_number,
            document_title, link, array_to_string(list_sort(list(DISTINCT document_page_number)), ', ') AS pages,
            min(rank) AS best FROM described GROUP BY ALL),
           numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY question_id
             ORDER BY best, document_number, document_title, link) AS INTEGER) AS citation_no FROM merged)
           SELECT question_id, citation_no, document_number, pages, concat(citation_no, ') [', document_number,
             ' (title: ', document_title, ', page(s): ', pages, ')](', link, ')') AS citation FROM numbered""",
       "fx_chunks", "fx_questions", "fx_meta")
def citations(spark, sf_dir):
    return chat.citations(knn_exact(spark, sf_dir), _described(spark, sf_dir))


# --- chat ----------------------------------------------------------------------------------

def _messages(spark, sf_dir):
    return fx.table(spark, sf_dir, "conversations")


@query("SELECT conv_id, arg_max(text, turn) AS question FROM conversations GROUP BY conv_id")
def chat_question(spark, sf_dir):
    return chat.chat_question(_messages(spark, sf_dir))


@query("""SELECT conv_id, turn, role, text AS content FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last
          FROM conversations) WHERE turn < last""")
def chat_history(spark, sf_dir):
    return chat.chat_history(_messages(spark, sf_dir))


_HISTORY = """history AS (SELECT conv_id, concat(chr(10), coalesce(string_agg(
    CASE WHEN turn < last THEN concat(role, ': ', text, chr(10)) END, '' ORDER BY turn), '')) AS history
  FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations) GROUP BY conv_id)"""


@query(f"WITH {_HISTORY} SELECT conv_id, history FROM history")
def chat_history_text(spark, sf_dir):
    return chat.chat_history_text(_messages(spark, sf_dir))


@query("""SELECT conv_id, count(*) AS n_messages, count(*) > 1 AS needs_rewrite,
          CASE WHEN count(*) <= 1 THEN arg_max(text, turn) END AS search_question FROM conversations GROUP BY conv_id""")
def rewrite_route(spark, sf_dir):
    return chat.rewrite_route(_messages(spark, sf_dir))


# Every message stands for a model reply: well-formed, fenced, cut off, of another shape, or plain text.
@query("""SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN concat('Q: ', text) WHEN 1 THEN concat('Q: ', text)
          ELSE concat('original ', conv_id) END AS question FROM conversations""")
def rewrite_parse(spark, sf_dir):
    good = F.to_json(F.struct(F.concat(F.lit("Q: "), "text").alias("question")))
    reply = (
        F.when(F.col("turn") % 5 == 0, good)
        .when(F.col("turn") % 5 == 1, F.concat(F.lit("```json\n"), good, F.lit("\n```")))
        .when(F.col("turn") % 5 == 2, F.concat(F.lit('{"question": "cut off '), F.col("conv_id").cast("string")))
        .when(F.col("turn") % 5 == 3, F.to_json(F.struct(F.col("text").alias("answer"))))
        .otherwise(F.concat(F.lit("no json "), F.col("conv_id").cast("string")))
    )
    original = F.concat(F.lit("original "), F.col("conv_id").cast("string"))
    return _messages(spark, sf_dir).select("conv_id", "turn", chat.rewrite_parse(reply, original).alias("question"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _filled(template: str, context: str | None) -> str:
    text = f"replace({_sql_text(template)}, '{{history}}', h.history)"
    if context is None:
        return text
    before, after = template.split("{context}")
    return f"concat(replace({_sql_text(before)}, '{{history}}', h.history), {context}, {_sql_text(after)})"


@query(f"""WITH {_SCORED}, {_top('top', 'scored', 8)}, {_DESCRIBED}, {_CONTEXT}, {_HISTORY}
           SELECT 'answer' AS prompt, conv_id, CAST(0 AS BIGINT) AS seq, 'system' AS role,
             {_filled(chat.SYSTEM_TEMPLATE, 'context.context')} AS content
           FROM history h JOIN context ON context.question_id = h.conv_id
           UNION ALL SELECT 'rewrite', conv_id, 0, 'system', {_filled(chat.REWRITE_TEMPLATE, None)} FROM history h
           UNION ALL SELECT prompt, conv_id, 1, 'user', q FROM (SELECT conv_id, arg_max(text, turn) AS q
             FROM conversations GROUP BY conv_id), (VALUES ('answer'), ('rewrite')) v(prompt)""",
       "fx_chunks", "fx_questions", "fx_meta")
def prompt_messages(spark, sf_dir):
    messages = _messages(spark, sf_dir)
    history, asked = chat.chat_history_text(messages), chat.chat_question(messages)
    context = context_json(spark, sf_dir).withColumnRenamed("question_id", "conv_id")
    answer = chat.prompt_messages(history, asked, chat.SYSTEM_TEMPLATE, context)
    rewrite = chat.prompt_messages(history, asked, chat.REWRITE_TEMPLATE)
    return answer.select(F.lit("answer").alias("prompt"), "*").unionByName(
        rewrite.select(F.lit("rewrite").alias("prompt"), "*"))


@query(f"""WITH {_FILTERED}, {_DESCRIBED}, {_CONTEXT}, {_HISTORY}
           SELECT h.conv_id, CAST(0 AS BIGINT) AS seq, 'system' AS role,
             {_filled(chat.SYSTEM_TEMPLATE, "coalesce(context.context, '{\"chunks\":[]}')")} AS content
           FROM history h LEFT JOIN context ON context.question_id = h.conv_id
           UNION ALL SELECT conv_id, 1, 'user', arg_max(text, turn) FROM conversations GROUP BY conv_id""",
       "fx_chunks", "fx_questions", "fx_meta")
def answer_prompts(spark, sf_dir):
    """The chain as one plan: filtered hybrid search, context of the hits, history, filled prompt."""
    messages = _messages(spark, sf_dir)
    context = chat.context_json(hybrid_filtered(spark, sf_dir), _described(spark, sf_dir))
    return chat.prompt_messages(chat.chat_history_text(messages), chat.chat_question(messages), chat.SYSTEM_TEMPLATE,
                                context.withColumnRenamed("question_id", "conv_id"))


@query(f"""SELECT conv_id, CAST(0 AS BIGINT) AS seq,
             CAST(to_json({{'role': 'system', 'content': {_sql_text(chat.TITLE_INSTRUCTION)}}}) AS VARCHAR) AS message
           FROM (SELECT DISTINCT conv_id FROM conversations)
           UNION ALL SELECT conv_id, turn + 1, CASE WHEN role = 'user'
             THEN CAST(to_json({{'role': role, 'content': text, 'name': concat('user-', conv_id)}}) AS VARCHAR)
             ELSE CAST(to_json({{'role': role, 'content': text}}) AS VARCHAR) END FROM conversations""")
def agent_messages(spark, sf_dir):
    name = F.when(F.col("role") == "user", F.concat(F.lit("user-"), F.col("conv_id").cast("string")))
    messages = _messages(spark, sf_dir).select(
        "conv_id", "turn", "role", F.col("text").alias("content"), name.alias("name"),
        F.lit(None).cast("string").alias("tool_calls"), F.lit("m1").alias("id"))
    return chat.agent_messages(messages)
