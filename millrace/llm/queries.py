"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from dataclasses import replace

from millrace.llm import htmltext, line_dedup, minhash, mixing, packing, pq, quality, secrets, spotsigs, toxicity
from millrace.llm.common import read


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_spotsigs(spark, sf_dir):
    return spotsigs.fingerprints(read(spark, sf_dir, "documents"))


def op2_secrets(spark, sf_dir):
    return secrets.scan(read(spark, sf_dir, "documents"))


def op3_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(), window=2048, end=1)


def op5_quality(spark, sf_dir):
    return quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(read(spark, sf_dir, "documents"), threshold=10)


def op7_mixing(spark, sf_dir):
    return mixing.mix_report(read(spark, sf_dir, "documents"), replace(mixing.PRODUCTION, epochs=2))


def op8_minhash(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op9_html(spark, sf_dir):
    return htmltext.extract(read(spark, sf_dir, "pages"))


def op10_pq(spark, sf_dir):
    return pq.near_vectors(read(spark, sf_dir, "embeddings"), threshold=0.9)


QUERIES = {
    "op1_spotsigs": op1_spotsigs,
    "op2_secrets": op2_secrets,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_minhash": op8_minhash,
    "op9_html": op9_html,
    "op10_pq": op10_pq,
}

ORACLES = {
    "op10_pq": """
        WITH RECURSIVE v AS (
          SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id)::BIGINT AS n_links,
               least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id)) AS component_id,
               least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id)) = e.vec_id AS kept
        FROM embeddings e""",
    "op8_minhash": r"""
        WITH RECURSIVE t AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                                  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END AS s FROM t),
        x AS (SELECT doc_id, unnest(s) AS g FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * k >= 85 * (len(sa.s) + len(sb.s) - k)),
        links AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, k.b FROM reach r JOIN links k ON r.b = k.a),
        low AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id, least(s.doc_id, coalesce(m, s.doc_id)) = s.doc_id AS kept
        FROM s LEFT JOIN low ON low.a = s.doc_id""",
    "op6_line_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        lines AS (
          SELECT r, doc_id, i, line,
                 translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
          FROM (SELECT r, doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM d) s),
        common AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10)
        SELECT any_value(l.doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
               count(c.k)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
        FROM lines l LEFT JOIN common c ON l.k = c.k
        GROUP BY l.r""",
}
