"""Training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and hands the reread table to the next
stage.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import byte_bpe, fm_dedup, hd_langid, mixing, simhash_cover
from flowlens.llm.queries import BPE_RANKS
from flowlens.session import checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def release_shuffles(spark: SparkSession) -> None:
    """Each stage is executed once, so its shuffle files go when it ends."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found (null or letter-less text) go."""
    release_shuffles(spark)
    rest = tuple(c for c in COLUMNS if c not in ("doc_id", "text"))
    tagged = hd_langid.language_id(docs, keep=rest)
    return tagged.where("lang_pred <> 'und'").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays, with or without an id: the first by
    doc_id (nulls last), then by the text's digest (rows that repeat it go)."""
    release_shuffles(spark)
    return simhash_cover.one_of_each_group(docs.select(*COLUMNS))


def drop_substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a 13-word window of a document with a smaller doc_id
    go; a text that loses none stays as it is, one that loses all goes."""
    release_shuffles(spark)
    left = fm_dedup.substring_dedup(docs, text=True, keep=("lang", "source"))
    return left.where("n_removed = 0 or n_removed < n_words").select(
        "doc_id", F.col("kept").alias("text"), "lang", "source",
        F.length("kept").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    release_shuffles(spark)
    rest = tuple(c for c in COLUMNS if c != "doc_id")
    mixed = mixing.mix_single(docs, keep=rest).where("taken > 0")
    copies = F.sequence(F.lit(1), F.expr("int(taken div size)"))
    return mixed.withColumn("copy", F.explode(copies)).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, decoded again and compared."""
    release_shuffles(spark)
    coded = byte_bpe.bpe_encode(docs, BPE_RANKS, public_tokenizers.PATTERN,
                                keep=("doc_id", "lang", "source"), verify=True)
    return coded.select("doc_id", "lang", "source",
                        F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_substring_duplicates),
    ("mix_sources", mix_sources),
    ("byte_bpe", tokenize),
]

#: No SQL: fingerprints, learned prototypes and tokenizing have none in DuckDB.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    top = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    base = f"{top}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
