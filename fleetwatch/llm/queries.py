"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatch.llm import ann, bloom_lm, html, idfiles, langid, lines, merkle, mix, pieces, resample, simhash, urls, warc
from fleetwatch.llm.common import id_remainder
from fleetwatch.session import literal_table, work_path

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def piece_file() -> str:
    """Place of the public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_file() -> str:
    """Place of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def language_model(docs: DataFrame) -> langid.Model:
    """Learns from documents whose crc32(doc_id) modulo 4 is not 2."""
    training = docs.where(id_remainder(F.col("doc_id"), 4) != 2)
    return langid.fit(training, langid.load_vocabulary(piece_file()))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_model(docs)
    held = (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    return docs.select("doc_id", held, langid.predict(F.col("text"), model).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_copies(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    return warc.read_warc(spark, folder).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", html.extract(F.col("html")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.judge_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = literal_table(spark, RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = id_remainder(F.col("doc_id"), 5) == 1
    model = bloom_lm.fit(docs.where(~held))
    return bloom_lm.score(docs.select("doc_id", "text", held.alias("held_out")), model, "held_out")


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", pieces.token_digests(F.col("text"), piece_file()).alias("p")).select("doc_id", "p.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, tampered=merkle.every_fifth("doc_id")).drop("source")


def op13_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "ids")
    idfiles.write_ids(table(spark, sf_dir, "documents"), folder, byte_file())
    return idfiles.read_checksums(spark, folder).withColumnRenamed("key", "doc_id")


URL_SQL = """
WITH u AS (SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT r, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
q AS (SELECT r, page_id, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM p),
h AS (SELECT r, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM q),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                            ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (SELECT r, rh || rp AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
        FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT h.page_id, h.host, h.path, fit.rule, coalesce(fit.v, 'allow') AS verdict
FROM h LEFT JOIN fit ON h.r = fit.r AND fit.k = 1"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_nearest_vectors, op3_mix_sources, op4_warc, op5_main_text, op6_line_rules, op7_url_rules,
        op8_lm_score, op9_pieces, op10_simhash,
        op11_importance_resampling, op12_merkle_manifest, op13_id_files,
    )
}
ORACLES = {"op6_line_rules": lines.oracle_sql(), "op7_url_rules": URL_SQL, "op12_merkle_manifest": merkle.oracle_sql()}
