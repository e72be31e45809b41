"""The operators of this package bound to the given tables: ``QUERIES`` holds
``opN_<name>`` and ``pipeline``, ``SQL`` the DuckDB text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import alignment, collocations, decontaminate, hnsw, kdtree, line_dedup, minhash, pieces, pii, secrets, token_counts, token_store, toxicity
from .common import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_line_dedup")
def _lines(spark, sf_dir):
    return line_dedup.line_classes(table(spark, sf_dir, "documents"), shortest=1)


@query("op2_personal_data")
def _personal(spark, sf_dir):
    return pii.digest(pii.find_personal(table(spark, sf_dir, "documents")))


@query("op3_minhash_near_dedup", sql="""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
items AS (SELECT doc_id, unnest(s) AS x, len(s) AS n FROM sets),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
sym AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach AS (SELECT doc_id AS node, doc_id AS root FROM sets UNION SELECT sym.v, reach.root FROM reach JOIN sym ON sym.u = reach.node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.root AS component_id, s.doc_id = r.root AS kept
FROM sets s JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) r ON r.node = s.doc_id""")
def _near(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query("op4_token_store")
def _store(spark, sf_dir):
    target = shared_folder(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), target, vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_store.token_digest(token_store.read_store(spark, target))


@query("op5_benchmark_decontamination")
def _leaks(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def remainder():
    """The remainder that holds documents out of all learning from labels."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))


@query("op6_toxicity")
def _toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.filter(remainder() != 0))
    return toxicity.score(docs, model).select(
        "doc_id", (remainder() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


@query("op7_sentencepiece_nbest")
def _pieces(spark, sf_dir):
    return pieces.encode_digest(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op8_token_counts")
def _counts(spark, sf_dir):
    return (token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
            .withColumn("over_limit", F.col("n_tokens") > 4096))


@query("op9_secret_scan")
def _secrets(spark, sf_dir):
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query("op10_embedding_near_dedup", sql="""
WITH RECURSIVE sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT links.v, reach.root FROM reach JOIN links ON links.u = reach.node)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE u = e.vec_id) AS n_links, r.root AS component_id, e.vec_id = r.root AS kept
FROM embeddings e JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) r ON r.node = e.vec_id""")
def _vectors(spark, sf_dir):
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


@query("op11_collocations", sql="""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS p
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS size)),
f AS (SELECT lang, size, p, count(*) AS a FROM grams GROUP BY lang, size, p),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
frequent AS (SELECT * FROM f WHERE a >= 30),
longer AS (
  SELECT lang, sub, max(a) AS most FROM (
    SELECT lang, a, unnest([p[1:2], p[2:3], p[3:size], p[1:3], p[2:size]]) AS sub, size FROM frequent WHERE size >= 3)
  WHERE len(sub) >= 2 AND len(sub) < size GROUP BY lang, sub),
kept AS (
  SELECT c.lang, c.p, c.size, c.a FROM frequent c LEFT JOIN longer s ON s.lang = c.lang AND s.sub = c.p
  WHERE c.size >= 2 AND (s.most IS NULL OR 100 * s.most < 80 * c.a)),
cuts AS (SELECT lang, p, a, size, unnest(range(1, size)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r,
    CAST(CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.k] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1:c.size]),
lowest AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN totals ON totals.lang = lowest.lang QUALIFY rank <= 2000""")
def _phrases(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_top_products", sql="""
WITH sound AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(64 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(CASE WHEN len(q.e) = 0 THEN 0 ELSE list_inner_product(q.e, c.e) END AS BIGINT) AS score
  FROM sound q JOIN sound c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20""")
def _top(spark, sf_dir):
    return kdtree.top_products(table(spark, sf_dir, "embeddings"))


@query("op13_token_alignment")
def _aligned(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query("pipeline")
def _pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
