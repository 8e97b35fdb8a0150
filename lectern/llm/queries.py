"""The registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import language_id, pieces, quality, token_files, toxicity, url_filter
from lectern.llm.decontaminate import contamination
from lectern.llm.embedding_dedup import embedding_dedup
from lectern.llm.jaccard_join import jaccard_join
from lectern.llm.secrets import secret_report


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of embeddings: its links, component and whether it stays. Bad vectors link with nothing."""
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and benchmark item with a window of 0.75 or more; null and empty texts hold none."""
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents: counts and digest of base spans, and all spans. A null text is empty."""
    return secret_report(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of pages: host, path, rule and verdict. A null url fits no rule."""
    return url_filter.url_filter(_table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op5_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents: its place, length and checksum in the token files. A null text is the end id alone."""
    return token_files.token_report(_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents: ids counted and summed, and the round trip. A null text has no ids."""
    return pieces.piece_report(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents scored by a model of labels.toxic. A null text counts as empty."""
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its language. A null text is undecided."""
    return language_id.language_report(_table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents: its shingles, component and links. A null text has and links with none."""
    return jaccard_join(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents rated by a model of labels.quality. A null text counts as empty."""
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


_QUERIES = (
    op1_embedding_near_dedup,
    op2_benchmark_decontamination,
    op3_secret_scan,
    op4_url_filter,
    op5_token_id_output,
    op6_sentencepiece,
    op7_toxicity,
    op8_language_id,
    op9_ngram_jaccard_join,
    op10_quality,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


_OP1_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(id, root) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id
), component AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id), degree AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT c.id AS vec_id, coalesce(d.n, 0) AS n_links, c.component_id, c.id = c.component_id AS kept FROM component c LEFT JOIN degree d USING (id)
"""

_OP9_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words
), size AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach(id, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id
), component AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id), degree AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT c.id AS doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id, coalesce(d.n, 0) AS n_links FROM component c LEFT JOIN size z ON z.doc_id = c.id LEFT JOIN degree d ON d.id = c.id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_embedding_near_dedup": _OP1_SQL, "op4_url_filter": url_filter.SQL, "op9_ngram_jaccard_join": _OP9_SQL}
