"""The corpus pipeline: language ID, quality rules, near duplicates, source mix, SentencePiece.

Each stage reads what its predecessor kept, as written to Parquet. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatch.llm import langid, lines, mix, pieces, simhash
from fleetwatch.llm.common import where_computed
from fleetwatch.llm.queries import language_model, piece_file, table
from fleetwatch.session import work_path

MIN_SCORE = 0.5
WORK = "#work"


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose best language has a posterior below one half."""
    model = language_model(docs)
    judged = docs.select(F.struct(*_columns(docs)).alias(WORK), langid.predict(F.col("text"), model).alias("p"))
    keep = (F.col("p.lang_pred") != "und") & (F.col("p.score") >= MIN_SCORE)
    return where_computed(judged, keep).select(*[F.col(f"`{WORK}`.`{c.replace('`', '``')}`") for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rules reject, and the failing lines of the others; n_chars is that of the text left."""
    plain = docs.select(F.struct(*_columns(docs)).alias(WORK), F.col("text"))
    judged = where_computed(lines.judge_lines(plain), F.col("kept"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("cleaned").alias(c))
        elif c == "n_chars":
            columns.append(F.length("cleaned").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{WORK}`.`{c.replace('`', '``')}`").alias(c))
    return judged.select(*columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of near duplicates, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix.mix(docs)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers and digests of every document of the mix."""
    found = docs.select("doc_id", "source", pieces.token_digests(F.col("text"), piece_file()).alias("p"))
    return found.select("doc_id", "source", "p.*")


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("source_mix", mix_stage),
    ("sentencepiece", piece_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
