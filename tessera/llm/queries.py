"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import audit, bpe, covertree, exact, lines, multiindex, neardup, packing, pieces, quality, shards, suffix, warc
from tessera.session import read_table

#: Files of public tokenizers; the operators take them as parameters.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Score from which a document counts as good.
QUALITY_AT = 0.7


def op1_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs, length=200).select(
        "_record.doc_id", F.col("_bytes").alias("n_bytes"),
        F.aggregate("_removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("_removed").cast("long").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))


def op2_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, WORD_BPE, 2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def held_out() -> Column:
    """The fold that labels are never learnt from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def quality_scores(spark: SparkSession, docs: DataFrame, sf_dir: str, out: str = "score") -> DataFrame:
    """``docs`` plus ``out``: the chance that labels.quality is 1, learnt outside the held-out fold."""
    labels = read_table(spark, sf_dir, "labels").where(~held_out())
    machine = quality.fit(docs, labels, meta=("n_chars",))
    return quality.score(docs, machine, meta=("n_chars",), out=out)


def op3_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return quality_scores(spark, docs, sf_dir).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= QUALITY_AT).cast("int").alias("predicted"))


def op4_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return exact.DigestIndex(spark).dedup(docs).select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def op5_cover_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return covertree.topk(vectors, F.col("vec_id") % 50 == 0, k=5)


def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_chunks(docs).select(
        F.col("_id").alias("doc_id"), "n_chunks", "n_removed", "lines_removed", F.sha2("text", 256).alias("text_sha256"))


def op7_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = shards.shard_by_size(sized, [F.col("text_crc32"), F.col("doc_id")], F.col("size"), 40)
    return out.select("_record.doc_id", "_record.size", "_record.text_crc32", F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return warc.derive(warc.responses(pages)).select(
        F.col("source_id").alias("page_id"), "record_id", "type", "refers_to", "uri", "date", "content_type", "content_length",
        "block_digest", "source_digest", "header", "block")


def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return neardup.near_duplicates(docs, percent=85).select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id", (F.col("_id") == F.col("component_id")).alias("kept"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, BYTE_BPE, PATTERN).select("doc_id", "ids")
    return bpe.decode(ids, BYTE_BPE).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multiindex.mine(vectors, F.col("vec_id") % 50 == 0, label)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_piece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = pieces.encode(docs, PIECE_BPE, end=True).select("doc_id", "ids")
    return pieces.decode(ids, PIECE_BPE).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_family, op2_vector_best_fit, op3_factorisation_machine, op4_digest_index, op5_cover_trees, op6_line_chunks,
    op7_sampled_splitters, op8_warc_derivatives, op9_lsh_forest, op10_byte_bpe,
    op11_multi_index, op12_filter_audit, op13_piece_rounds)}

SQL = {
    "op4_digest_index": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id) AS kept,
               text_sha256
        FROM d""",
    "op5_cover_trees": """
        WITH u AS (
            SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
        bad AS (SELECT DISTINCT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x)),
        e AS (SELECT vec_id, i, floor(256 * x)::HUGEINT AS c FROM u WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
        s AS (
            SELECT q.vec_id AS query_id, r.vec_id, sum(q.c * r.c)::BIGINT AS score
            FROM e q JOIN e r ON q.i = r.i AND q.vec_id <> r.vec_id
            WHERE q.vec_id % 50 = 0 GROUP BY ALL),
        t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM t WHERE rank <= 5""",
    "op9_lsh_forest": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        sh AS (
            SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
            FROM sh a JOIN sh b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        edge AS (
            SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
        least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM least LEFT JOIN n USING (doc_id)""",
    "op11_multi_index": """
        WITH u AS (
            SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
        bad AS (SELECT DISTINCT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x)),
        l AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id NOT IN (SELECT vec_id FROM bad)),
        e AS (SELECT vec_id, i, floor(256 * x)::HUGEINT AS c FROM u JOIN l USING (vec_id)),
        s AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, sum(a.c * r.c)::BIGINT AS score
            FROM e a JOIN e r ON a.i = r.i AND a.vec_id <> r.vec_id
            WHERE a.vec_id % 50 = 0 GROUP BY ALL),
        m AS (
            SELECT s.*, r.label = a.label AS same
            FROM s JOIN l a ON a.vec_id = anchor_id JOIN l r ON r.vec_id = s.vec_id),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM m WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY m.score DESC, m.vec_id))::INT AS rank,
               m.vec_id AS negative_id, p.positive_score, m.score AS negative_score
        FROM p JOIN m ON m.anchor_id = p.anchor_id AND NOT m.same
             AND 50 * p.positive_score <= 100 * m.score AND 100 * m.score <= 95 * p.positive_score
        QUALIFY rank <= 3""",
    "op12_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
        first AS (SELECT text, min(doc_id) AS least FROM t GROUP BY text),
        mark AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
        d AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
                   {'A': len(words) < 200,
                    'B': 100 * len(list_distinct(words)) < 50 * len(words),
                    'C': 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 3 * length(w.text),
                    'D': regexp_matches(w.text, '[#$%&*|]'),
                    'E': coalesce(least < w.doc_id, false)} AS f
            FROM w JOIN first ON first.text = w.text LEFT JOIN mark ON mark.doc_id = w.doc_id),
        bits AS (
            SELECT part, f.A::INT + 2 * f.B::INT + 4 * f.C::INT + 8 * f.D::INT + 16 * f.E::INT AS bits,
                   count(*) AS n, sum(good) AS good, sum(bad) AS bad
            FROM d GROUP BY ALL),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
        o AS (
            SELECT a.c || b.c || c.c || d.c || e.c AS filter_order,
                   [a.b, b.b, c.b, d.b, e.b] AS own, [0, a.b, a.b + b.b, a.b + b.b + c.b, a.b + b.b + c.b + d.b] AS earlier
            FROM l a, l b, l c, l d, l e
            WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
        s AS (SELECT filter_order, unnest(own) AS own, unnest(earlier) AS earlier, unnest([1, 2, 3, 4, 5])::INT AS step FROM o),
        r AS (
            SELECT part, filter_order, step, own,
                   coalesce(sum(n) FILTER (bits & (own | earlier) = 0), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (bits & earlier = 0 AND bits & own <> 0), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (bits & earlier <> 0 AND bits & own <> 0), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (bits = own), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (bits & earlier = 0 AND bits & own <> 0), 0)::BIGINT AS good_lost,
                   coalesce(sum(bad) FILTER (bits & earlier = 0 AND bits & own <> 0), 0)::BIGINT AS toxic_lost
            FROM bits, s GROUP BY ALL)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM r""",
}
