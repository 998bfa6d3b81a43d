"""Queries over documents: dedup, chunks, sparse retrieval, fusion, re-scoring, evaluation and rewriting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.functions.text import content_hash
from siltwork.operators import bm25, chunking, cost, dedup, dense, evaluate, hybrid, metrics, rewrite
from siltwork.plans.tables import hash_store, now, queries_of, read, truth
from siltwork.sources import documents as sources
from siltwork.store import stage

DOCS = "documents"


def _batch(spark, d):
    return dedup.hashed(read(spark, d, DOCS).select("doc_id", F.col("text").alias("content")))


def dedup_new_documents(spark, d):
    return dedup.new_documents(_batch(spark, d), dedup.live(hash_store(spark, d), now())).select("doc_id", "content_hash")


def dedup_within_batch(spark, d):
    return dedup.new_documents(_batch(spark, d), dedup.live(hash_store(spark, d), now()), within_batch=True).select("doc_id", "content_hash")


def dedup_stats(spark, d):
    return dedup.stats(read(spark, d, DOCS), _batch(spark, d), dedup.live(hash_store(spark, d), now()))


def ttl_hashes(spark, d):
    return dedup.live(hash_store(spark, d), now())


def hash_confirm(spark, d):
    return dedup.confirm(hash_store(spark, d), _batch(spark, d), now())


def chunk_documents(spark, d):
    return chunking.chunked(read(spark, d, DOCS).select("doc_id", "text"), "text").select(
        "doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("total_chunks").cast("long").alias("total_chunks"), F.col("token_count").cast("long").alias("token_count"), "chunk_text")


def chunks_per_source(spark, d):
    docs = read(spark, d, DOCS)
    chunks = chunking.chunked(docs.select("source", "text"), "text").groupBy("source").agg(F.count(F.lit(1)).alias("n_chunks"))
    every = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"))
    return every.join(chunks, "source", "left").select("source", "n_documents", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), F.round(F.coalesce("n_chunks", F.lit(0)) / F.col("n_documents"), 6).alias("chunks_per_document"))


def fallback_token_count(spark, d):
    return read(spark, d, DOCS).groupBy("lang").agg(F.sum(F.expr("length(text) div 4")).alias("n_tokens"))


def embedding_cost(spark, d):
    return cost.embedding_cost(read(spark, d, DOCS)).select("n_words", F.round("cost", 8).alias("cost"))


def _index(spark, d):
    return bm25.index(read(spark, d, DOCS), "doc_id", "text")


def bm25_corpus_stats(spark, d):
    ix = _index(spark, d)
    terms = ix.terms.agg(F.count(F.lit(1)).alias("n_terms"), F.count_if(F.col("df") > 1).alias("n_shared_terms"))
    return ix.stats.join(F.broadcast(terms)).select("n", F.round("avgdl", 6).alias("avgdl"), F.round("avg_idf", 6).alias("avg_idf"), "n_terms", "n_shared_terms")


def bm25_idf(spark, d):
    return _index(spark, d).terms.select("term", "df", F.round("idf", 6).alias("idf"))


def _scores(spark, d):
    return bm25.scores(_index(spark, d), queries_of(spark, d))


def _best(spark, d, k):
    return bm25.nearest(_index(spark, d), queries_of(spark, d), k)


def bm25_topk(spark, d):
    return _best(spark, d, 10).select("query_id", "id", F.round("score", 6).alias("score"), "rank")


def bm25_normalised(spark, d):
    return bm25.normalised(_scores(spark, d)).select("query_id", "id", F.round("norm", 6).alias("norm"))


def _fused(spark, d, top_k=10):
    asked = queries_of(spark, d)
    vectors = read(spark, d, "embeddings")
    probes = vectors.join(asked.select("query_id"), F.col("vec_id") == F.col("query_id")).select("query_id", "embedding")
    k_dense, k_sparse = hybrid.shares(top_k)
    near = stage(dense.top_k(vectors.select(F.col("vec_id").alias("id"), "embedding"), probes, k_dense, least=0.0), "near")
    norm = bm25.nearest(_index(spark, d), asked, k_sparse, near)
    return hybrid.fused(near, norm.filter(F.col("rank") <= k_sparse), norm, 0.3, top_k)


def hybrid_topk(spark, d):
    return _fused(spark, d).select("query_id", "id", *[F.round(c, 6).alias(c) for c in ("vector_score", "bm25_score", "combined_score")], "rank")


def _fetched(spark, d, found, asked):
    """Results, written, with their queries and their documents' texts; texts stay where they are read but for those of results."""
    found = stage(found, "fetched")
    texts = read(spark, d, DOCS).select(F.col("doc_id").alias("id"), F.col("text").alias("payload_text"))
    texts = texts.join(found.select("id").distinct(), "id", "left_semi")
    return stage(found.join(texts, "id", "left").join(asked, "query_id"), "texts").withColumn("text", F.lit(""))


def _reranked(spark, d):
    """Twice the results are fetched, and their documents' texts scored again."""
    rows = _fetched(spark, d, _fused(spark, d, 20), queries_of(spark, d))
    return rows, hybrid.reranked(rows, hybrid.lexical_score(F.col("query"), F.col("candidate_text")), 10)


def rerank_topk(spark, d):
    return _reranked(spark, d)[1].select("query_id", "id", F.round("reranker_score", 6).alias("reranker_score"), "original_rank", "rank")


def _improvement(spark, d):
    rows, ranked = _reranked(spark, d)
    return hybrid.improvement(ranked, rows)


def rerank_improvement(spark, d):
    return _improvement(spark, d).select("query_id", F.round("improvement", 6).alias("improvement"))


def rerank_histogram(spark, d):
    return metrics.histogram(_improvement(spark, d).select(F.round("improvement", 6).alias("improvement")), "improvement").select(F.col("le").cast("string").alias("le"), "n")


def answer_context(spark, d):
    found = _best(spark, d, 5).join(read(spark, d, DOCS).select(F.col("doc_id").alias("id"), "text"), "id")
    return hybrid.context(found, 5, "text").select("query_id", content_hash(F.col("context")).alias("context_hash"))


def _names(found):
    return found.select("query_id", F.concat(F.lit("doc_"), F.col("id")).alias("name"), "rank")


def _judged(spark, d):
    """All queries over the sparse results, also those of which no document is expected."""
    return evaluate.judged(_names(_best(spark, d, 10)), truth(spark, d), queries_of(spark, d))


def recall_at_k(spark, d):
    return _judged(spark, d).select("query_id", *[F.round(c, 6).alias(c) for c in ("recall_1", "recall_5", "recall_10")])


def mrr(spark, d):
    return _judged(spark, d).select("query_id", F.round("rr", 6).alias("rr"))


def _modes(spark, d):
    """The best ten of every query by each kind of search; the index is built once."""
    asked, vectors = queries_of(spark, d), read(spark, d, "embeddings")
    probes = vectors.join(asked.select("query_id"), F.col("vec_id") == F.col("query_id")).select("query_id", "embedding")
    points = vectors.select(F.col("vec_id").alias("id"), "embedding")
    nearest = stage(dense.top_k(points, probes, 10, least=0.0), "nearest")
    norm = bm25.nearest(_index(spark, d), asked, 10, nearest)

    def mixed(k):
        k_dense, k_sparse = hybrid.shares(k)
        return hybrid.fused(nearest.filter(F.col("rank") <= k_dense), norm.filter(F.col("rank") <= k_sparse), norm, 0.3, k)

    fetched = _fetched(spark, d, mixed(20), asked)
    return {"sparse": norm.filter("rank <= 10"), "dense": nearest, "hybrid": mixed(10), "rerank": hybrid.reranked(fetched, hybrid.lexical_score(F.col("query"), F.col("candidate_text")), 10)}


def eval_summary(spark, d):
    """A row for each kind of search, over all queries that were loaded."""
    expected, asked = stage(truth(spark, d), "truth"), queries_of(spark, d)
    rows = [evaluate.summary(evaluate.judged(_names(found), expected, asked)).withColumn("mode", F.lit(mode)) for mode, found in _modes(spark, d).items()]
    return reduce(DataFrame.unionByName, rows)


def quality_gate(spark, d):
    return eval_summary(spark, d).select("mode", "recall_at_5", evaluate.gate(F.col("recall_at_5")).alias("decision"), evaluate.gate(F.lit(None).cast("double")).alias("decision_without_results"))


def _user_turns(spark, d):
    return read(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", rewrite.variations(F.col("text")).alias("v"))


def rewrite_rule_based(spark, d):
    return _user_turns(spark, d).select("conv_id", "turn", F.posexplode("v").alias("position", "variation")).withColumn("position", F.col("position").cast("long"))


def rewrite_counts(spark, d):
    return _user_turns(spark, d).groupBy((F.size("v") - 1).cast("long").alias("n_added")).agg(F.count(F.lit(1)).alias("n_queries"))


def pages_to_text(spark, d):
    pages = read(spark, d, "pages")
    return pages.select("page_id", F.col("url"), "html").transform(lambda p: p.select("page_id", sources.T.html_title(F.col("html"), F.col("url")).alias("title"), sources.T.html_text(F.col("html")).alias("content")))


def document_metadata(spark, d):
    """Metadata maps merged and read with a default, and texts as bytes and back."""
    docs = sources.from_table(read(spark, d, DOCS))
    merged = docs.withColumn("m", F.map_concat("metadata", F.create_map(F.lit("size"), F.octet_length("content").cast("string"))))
    whole = F.decode(F.encode("content", "UTF-8"), "UTF-8") == F.col("content")
    return merged.select("doc_id", F.coalesce(F.element_at("m", "lang"), F.lit("none")).alias("lang"), F.element_at("m", "size").cast("long").alias("n_bytes"), F.size(F.map_keys("m")).cast("long").alias("n_keys"), F.coalesce(F.element_at("m", "owner"), F.lit("nobody")).alias("owner"), whole.alias("round_trip"))


def source_union(spark, d):
    every = sources.union(sources.from_table(read(spark, d, DOCS)), sources.from_pages(read(spark, d, "pages")))
    return every.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.sum(F.length("content")).alias("n_chars"), F.countDistinct("source_uri").alias("n_uris"))


NAMES = (
    "dedup_new_documents dedup_within_batch dedup_stats ttl_hashes hash_confirm chunk_documents chunks_per_source fallback_token_count embedding_cost bm25_corpus_stats bm25_idf bm25_topk "
    "bm25_normalised hybrid_topk rerank_topk rerank_improvement rerank_histogram answer_context recall_at_k mrr eval_summary quality_gate rewrite_rule_based rewrite_counts pages_to_text document_metadata source_union"
).split()
QUERIES = {n: globals()[n] for n in NAMES}

TOK = r"list_filter(regexp_split_to_array(lower({}), '\s+'), lambda x: x <> '')"
_STORE = """h AS (SELECT doc_id, sha256(text) AS content_hash FROM documents WHERE length(text) > 0),
s AS (SELECT h.content_hash, TIMESTAMP '2024-01-01' + (h.doc_id % 60)::INTEGER * INTERVAL 1 DAY AS confirmed_at FROM h JOIN labels l ON l.doc_id = h.doc_id),
live AS (SELECT * FROM s WHERE confirmed_at + INTERVAL 30 DAY > TIMESTAMP '2024-02-15')"""
_WORDS = r"w AS (SELECT doc_id, source, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS t FROM documents)"
_CHUNKS = f"""{_WORDS}, c AS (SELECT doc_id, source, t, ceil(len(t) / 462.0)::BIGINT AS total_chunks, unnest(range(0, ceil(len(t) / 462.0)::BIGINT)) AS chunk_index FROM w WHERE len(t) > 0)"""
_BM25 = f"""d AS (SELECT doc_id AS id, {TOK.format("text")} AS t FROM documents),
st AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM d),
po AS (SELECT id, term, count(*) AS tf, any_value(dl) AS dl FROM (SELECT id, len(t) AS dl, unnest(t) AS term FROM d) GROUP BY id, term),
raw AS (SELECT term, count(*) AS df, ln(any_value(st.n) - count(*) + 0.5) - ln(count(*) + 0.5) AS r FROM po, st GROUP BY term),
av AS (SELECT avg(r) AS avg_idf FROM raw),
te AS (SELECT term, df, CASE WHEN r < 0 THEN 0.25 * avg_idf ELSE r END AS idf FROM raw, av)"""
_SCORES = f"""{_BM25}, q AS (SELECT query_id, term, count(*) AS qf FROM (SELECT item_id AS query_id, unnest({TOK.format("text")}) AS term FROM benchmark) GROUP BY 1, 2),
sc AS (SELECT q.query_id, po.id, sum(qf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM q JOIN te ON te.term = q.term JOIN po ON po.term = q.term, st GROUP BY 1, 2),
no AS (SELECT *, CASE WHEN max(score) OVER (PARTITION BY query_id) > 0 THEN score / max(score) OVER (PARTITION BY query_id) ELSE score END AS norm FROM sc),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rank FROM no)"""


def _hybrid(top_k: int) -> str:
    k_dense, k_sparse = hybrid.shares(top_k)
    return f"""{_SCORES}, de AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rank FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score FROM embeddings a JOIN benchmark ON item_id = a.vec_id, embeddings b) WHERE score >= 0) WHERE rank <= {k_dense}),
sp AS (SELECT * FROM rk WHERE rank <= {k_sparse}),
u AS (SELECT coalesce(de.query_id, sp.query_id) AS query_id, coalesce(de.id, sp.id) AS id, coalesce(de.score, 0) AS vector_score FROM de FULL OUTER JOIN sp ON sp.query_id = de.query_id AND sp.id = de.id),
cb AS (SELECT u.query_id, u.id, vector_score, coalesce(norm, 0) AS bm25_score, 0.7 * vector_score + 0.3 * coalesce(norm, 0) AS combined_score FROM u LEFT JOIN no ON no.query_id = u.query_id AND no.id = u.id),
hy AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(combined_score, 6) DESC, id) AS rank FROM cb) WHERE rank <= {top_k})"""


_RERANK = f"""{_hybrid(20)}, qt AS (SELECT item_id AS query_id, list_distinct({TOK.format("text")}) AS q FROM benchmark),
re AS (SELECT hy.query_id, hy.id, hy.rank AS original_rank, hy.combined_score, coalesce(len(list_intersect(q, coalesce(d.t, []))) / nullif(len(q), 0), 0) AS reranker_score
  FROM hy JOIN qt ON qt.query_id = hy.query_id LEFT JOIN d ON d.id = hy.id),
rr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(reranker_score, 6) DESC, original_rank) AS rank FROM re) WHERE rank <= 10),
im AS (SELECT query_id, max(reranker_score) - any_value(f.combined_score) AS improvement FROM rr JOIN (SELECT query_id AS qi, combined_score FROM hy WHERE rank = 1) f ON f.qi = rr.query_id GROUP BY query_id)"""
_TRUTH = "tr AS (SELECT b.item_id AS query_id, x.doc_id FROM benchmark b JOIN documents x ON contains(x.text, b.text))"
_DENSE = """de AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rank FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score FROM embeddings a JOIN benchmark ON item_id = a.vec_id, embeddings b) WHERE score >= 0) WHERE rank <= 10)"""


def _judge(results: str, ranked: str) -> str:
    return f"""{results}, {_TRUTH},
ju AS (SELECT b.item_id AS query_id, count(tr.doc_id) AS n, sum(CASE WHEN r.rank <= 1 THEN 1 ELSE 0 END) AS h1, sum(CASE WHEN r.rank <= 5 THEN 1 ELSE 0 END) AS h5, sum(CASE WHEN r.rank <= 10 THEN 1 ELSE 0 END) AS h10, min(CASE WHEN r.rank <= 10 THEN r.rank END) AS f
  FROM benchmark b LEFT JOIN tr ON tr.query_id = b.item_id LEFT JOIN {ranked} r ON r.query_id = tr.query_id AND r.id = tr.doc_id GROUP BY b.item_id),
js AS (SELECT query_id, coalesce(h1 / nullif(n, 0), 0) AS recall_1, coalesce(h5 / nullif(n, 0), 0) AS recall_5, coalesce(h10 / nullif(n, 0), 0) AS recall_10, coalesce(1.0::DOUBLE / f, 0) AS rr FROM ju)"""


_JUDGED = _judge(_SCORES, "rk")
_MEANS = "count(*) AS total_queries, round(avg(recall_1), 4) AS recall_at_1, round(avg(recall_5), 4) AS recall_at_5, round(avg(recall_10), 4) AS recall_at_10, round(avg(rr), 4) AS mrr FROM js"
_SUMMARY = " UNION ALL ".join(f"SELECT * FROM (WITH {_judge(results, ranked)} SELECT '{mode}' AS mode, {_MEANS})" for mode, results, ranked in (
    ("sparse", _SCORES, "rk"), ("dense", _DENSE, "de"), ("hybrid", _hybrid(10), "hy"), ("rerank", _RERANK, "rr")))
_ACRONYMS = ", ".join(f"({i}, '{a}', '{e}')" for i, (a, e) in enumerate(rewrite.ACRONYMS))
_VARIATIONS = rf"""a(i, a, e) AS (VALUES {_ACRONYMS}),
u AS (SELECT conv_id, turn, text, lower(text) AS l, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM conversations WHERE role = 'user'),
x AS (SELECT conv_id, turn, -1 AS o, text AS v FROM u UNION ALL SELECT conv_id, turn, 2 * i, replace(l, a, e) FROM u JOIN a ON list_contains(w, a)
  UNION ALL SELECT conv_id, turn, 2 * i + 1, replace(l, a, a || ' OR ' || e) FROM u JOIN a ON list_contains(w, a)),
f AS (SELECT conv_id, turn, v, min(o) AS o FROM x GROUP BY conv_id, turn, v)"""


def _html(column: str) -> str:
    out = rf"regexp_replace({column}, '(?s)<!--.*?-->', '', 'g')"
    for tag in sources.T.PAGE_STRIP:
        out = rf"regexp_replace({out}, '(?is)<{tag}\b.*?</{tag}>', '', 'g')"
    out = rf"regexp_replace({out}, '(?s)<[^>]*>', chr(10), 'g')"
    for entity, char in sources.T.ENTITIES:
        out = f"replace({out}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return rf"regexp_replace(regexp_replace({out}, '\s*\n\s*', chr(10), 'g'), '^\s+|\s+$', '', 'g')"


_EDGES = ", ".join(f"('{e}', {e})" for e in metrics.EDGES)
ORACLES = {
    "dedup_new_documents": f"WITH {_STORE} SELECT doc_id, content_hash FROM h WHERE content_hash NOT IN (SELECT content_hash FROM live)",
    "dedup_within_batch": f"WITH {_STORE} SELECT min(doc_id) AS doc_id, content_hash FROM h WHERE content_hash NOT IN (SELECT content_hash FROM live) GROUP BY content_hash",
    "dedup_stats": f"""WITH {_STORE} SELECT (SELECT count(*) FROM documents) AS n_documents, count(*) FILTER (WHERE k IS NULL) AS n_new, count(k) AS n_skipped,
        count(k) / (SELECT count(*) FROM documents) AS hit_rate FROM h LEFT JOIN (SELECT DISTINCT content_hash AS k FROM live) ON k = content_hash""",
    "ttl_hashes": f"WITH {_STORE} SELECT content_hash, confirmed_at FROM live",
    "hash_confirm": f"WITH {_STORE} SELECT DISTINCT content_hash, TIMESTAMP '2024-02-15' AS confirmed_at FROM h WHERE content_hash NOT IN (SELECT content_hash FROM s)",
    "chunk_documents": f"WITH {_CHUNKS} SELECT doc_id, chunk_index, total_chunks, len(t[chunk_index * 462 + 1:chunk_index * 462 + 512])::BIGINT AS token_count, array_to_string(t[chunk_index * 462 + 1:chunk_index * 462 + 512], ' ') AS chunk_text FROM c",
    "chunks_per_source": f"WITH {_CHUNKS} SELECT w.source, count(DISTINCT w.doc_id) AS n_documents, count(c.doc_id) AS n_chunks, round(count(c.doc_id) / count(DISTINCT w.doc_id), 6) AS chunks_per_document FROM w LEFT JOIN c ON c.doc_id = w.doc_id GROUP BY w.source",
    "fallback_token_count": "SELECT lang, sum(length(text) // 4)::BIGINT AS n_tokens FROM documents GROUP BY lang",
    "embedding_cost": f"WITH {_WORDS} SELECT sum(len(t))::BIGINT AS n_words, round(sum(len(t))::DOUBLE * 1.3::DOUBLE / 1e6 * 0.02::DOUBLE, 8) AS cost FROM w",
    "bm25_corpus_stats": f"WITH {_BM25} SELECT any_value(n) AS n, round(any_value(avgdl), 6) AS avgdl, round(any_value(avg_idf), 6) AS avg_idf, count(*) AS n_terms, count(*) FILTER (WHERE df > 1) AS n_shared_terms FROM te, st, av",
    "bm25_idf": f"""WITH raw AS (SELECT term, count(*) AS df, ln((SELECT count(*) FROM documents) - count(*) + 0.5) - ln(count(*) + 0.5) AS r FROM (SELECT unnest(list_distinct({TOK.format("text")})) AS term FROM documents) GROUP BY term)
        SELECT term, df, round(CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM raw) ELSE r END, 6) AS idf FROM raw""",
    "bm25_topk": f"WITH {_SCORES} SELECT query_id, id, round(score, 6) AS score, rank::INTEGER AS rank FROM rk WHERE rank <= 10",
    "bm25_normalised": f"WITH {_SCORES} SELECT query_id, id, round(norm, 6) AS norm FROM no",
    "hybrid_topk": f"WITH {_hybrid(10)} SELECT query_id, id, round(vector_score, 6) AS vector_score, round(bm25_score, 6) AS bm25_score, round(combined_score, 6) AS combined_score, rank::INTEGER AS rank FROM hy",
    "rerank_topk": f"WITH {_RERANK} SELECT query_id, id, round(reranker_score, 6) AS reranker_score, original_rank::INTEGER AS original_rank, rank::INTEGER AS rank FROM rr",
    "rerank_improvement": f"WITH {_RERANK} SELECT query_id, round(improvement, 6) AS improvement FROM im",
    "rerank_histogram": f"WITH {_RERANK}, e(le, x) AS (VALUES {_EDGES}) SELECT le, count(improvement) AS n FROM e LEFT JOIN im ON round(improvement, 6) <= x GROUP BY le UNION ALL SELECT 'Infinity', count(*) FROM im",
    "answer_context": f"WITH {_SCORES} SELECT rk.query_id, sha256(string_agg(x.text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank)) AS context_hash FROM rk JOIN documents x ON x.doc_id = rk.id WHERE rank <= 5 GROUP BY rk.query_id",
    "recall_at_k": f"WITH {_JUDGED} SELECT query_id, round(recall_1, 6) AS recall_1, round(recall_5, 6) AS recall_5, round(recall_10, 6) AS recall_10 FROM js",
    "mrr": f"WITH {_JUDGED} SELECT query_id, round(rr, 6) AS rr FROM js",
    "eval_summary": _SUMMARY,
    "quality_gate": f"SELECT mode, recall_at_5, CASE WHEN recall_at_5 >= 0.75 THEN 'promote' ELSE 'rollback' END AS decision, 'rollback' AS decision_without_results FROM ({_SUMMARY})",
    "document_metadata": """SELECT doc_id, coalesce(lang, 'none') AS lang, octet_length(encode(text))::BIGINT AS n_bytes, 2::BIGINT AS n_keys, 'nobody' AS owner, decode(encode(text)) = text AS round_trip FROM documents""",
    "rewrite_rule_based": f"WITH {_VARIATIONS} SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY o) - 1 AS position, v AS variation FROM f",
    "rewrite_counts": f"WITH {_VARIATIONS} SELECT n - 1 AS n_added, count(*) AS n_queries FROM (SELECT conv_id, turn, count(*) AS n FROM f GROUP BY 1, 2) GROUP BY n",
    "pages_to_text": rf"""SELECT page_id, CASE WHEN t = '' THEN url ELSE t END AS title, content FROM (SELECT page_id, url, {_html("html")} AS content,
        regexp_replace(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1), '^\s+|\s+$', '', 'g') AS t FROM pages)""",
    "source_union": rf"""WITH a AS (SELECT coalesce(source, 'unknown') AS source, text AS content, coalesce(source, 'unknown') || '://' || doc_id AS uri FROM documents
        UNION ALL SELECT 'url', {_html("html")}, url FROM pages) SELECT source, count(*) AS n_documents, sum(length(content))::BIGINT AS n_chars, count(DISTINCT uri) AS n_uris FROM a WHERE source <> 'url' OR length(content) > 0 GROUP BY source""",
}
