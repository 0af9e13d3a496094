"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_texts
from . import toxicity
from .decontaminate import contaminated
from .divergence import divergence
from .embedding_dedup import link_embeddings
from .exact_dedup import dedup_exact
from .html_extract import extract_pages
from .jaccard import jaccard_components
from .lm_score import score_texts
from .substring import dedup_substrings
from .suffix_dedup import dedup_suffixes
from .token_files import read_token_files, store_path, write_token_files
from .whitening import whiten


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(read(spark, sf_dir, "documents"), texts=False).drop("kept")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_suffixes(read(spark, sf_dir, "documents"), texts=False).drop("kept")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_texts(read(spark, sf_dir, "documents"), ranks, ids=False).drop("ids")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.train(docs, labels.where(~held_out))
    scored = toxicity.score(docs.select("doc_id", "text"), model, ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 10 == 0)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(read(spark, sf_dir, "embeddings"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store_path(spark)
    write_token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_token_files(spark, path, ids=False).drop("ids")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(read(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_suffix_dedup, op3_bpe, op4_decontaminate, op5_toxicity, op6_lm_score, op7_embedding_dedup,
        op8_ngram_jaccard, op9_token_files, op10_html_extract, op11_exact_dedup, op12_source_divergence, op13_embedding_whitening,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(w[s:s + 19], ' ') ORDER BY doc_id, s) AS n FROM x),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM k WHERE n > 1),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS rest FROM t ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op2_suffix_dedup": r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
x AS (SELECT doc_id, unnest(range(1, octet_length(b) - 398)) AS s, b FROM d WHERE octet_length(b) >= 400),
h AS (SELECT doc_id, s, md5(b[s:s + 399]) AS m FROM x),
g AS (SELECT doc_id, s, s - lag(s, 1, -1000) OVER (PARTITION BY doc_id ORDER BY s) > 400 AS new FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY m) AS n FROM h) WHERE n > 1),
r AS (SELECT doc_id, min(s) AS a, max(s) + 399 AS z FROM (SELECT doc_id, s, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM g) GROUP BY doc_id, run),
k AS (SELECT r.doc_id, a, z, hex(b[coalesce(lag(z) OVER (PARTITION BY r.doc_id ORDER BY a), 0) + 1:a - 1]) AS before, row_number() OVER (PARTITION BY r.doc_id ORDER BY a DESC) = 1 AS last, hex(b[z + 1:octet_length(b)]) AS after FROM r JOIN d USING (doc_id)),
c AS (SELECT doc_id, sum(z - a + 1)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(CASE WHEN last THEN before || after ELSE before END, '' ORDER BY a) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, CASE WHEN kept IS NULL THEN sha256(b) ELSE sha256(unhex(kept)) END AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
""",
    "op8_ngram_jaccard": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)
""",
    "op7_embedding_dedup": """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, c.component_id, c.vec_id = c.component_id AS kept FROM c
""",
    "op11_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d
""",
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (SELECT i, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT lang, source, term, coalesce(n, 0)::BIGINT AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT *, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang, source)::BIGINT + 2 * count(*) OVER (PARTITION BY lang, source)) AS p FROM x),
e AS (SELECT lang, term, sum(n)::BIGINT AS n FROM x GROUP BY lang, term),
q AS (SELECT *, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang)::BIGINT + 2 * count(*) OVER (PARTITION BY lang)) AS q FROM e),
a AS (SELECT x.lang, x.source, y.source AS item, coalesce((SELECT sum((m.p - o.p) * (m.p - o.p) // (m.p + o.p)) FROM p m JOIN p o ON m.lang = o.lang AND m.term = o.term WHERE m.lang = x.lang AND m.source = x.source AND o.source = y.source), 0)::BIGINT AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source),
b AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM a
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM b) WHERE rank <= 10
""",
}
