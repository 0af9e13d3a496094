"""Corpus pipeline over `documents`: toxicity, near-duplicates, repeated passages,
benchmark leaks, token ids.

Each stage is written as Parquet and read again as the next one's documents.
All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgloom.llm import toxicity
from kgloom.llm.bpe import encode_texts
from kgloom.llm.buckets import shared_dir
from kgloom.llm.decontaminate import contaminated
from kgloom.llm.jaccard import jaccard_components
from kgloom.llm.suffix_dedup import dedup_suffixes

#: Documents at or over this score are rejected.
TOXIC = 0.3
#: Bytes of a repeated string that is cut: few enough that a passage of 51 words holds one.
PASSAGE = 250


def _spare(docs: DataFrame, name: str) -> str:
    """A column name like this one that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key by content, and its name: rows that share it are equal in all that an operator looks at."""
    key = _spare(docs, "_key")
    return docs.withColumn(key, F.xxhash64("doc_id", "text")), key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; the model learns from the labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    score = _spare(docs, "_score")
    return toxicity.score(docs, model, docs.columns, name=score).where(F.col(score) < TOXIC).drop(score)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of the n-gram Jaccard join.

    Rows without an id stay; of rows that repeat an id, and so are one document, the one
    with the smallest hash of its contents stays.
    """
    found = jaccard_components(docs)
    lost = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(lost, "doc_id", "left_anti").select(docs.columns)
    named, nameless = kept.where("doc_id IS NOT NULL"), kept.where("doc_id IS NULL")
    contents, least = F.xxhash64(*docs.columns), _spare(docs, "_least")
    twice = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(contents).alias(least), F.count("*").alias("n")).where("n > 1").drop("n")
    named = named.join(twice, "doc_id", "left").where(F.col(least).isNull() | (contents == F.col(least)))
    return named.select(docs.columns).dropDuplicates(["doc_id"]).union(nameless)  # what still shares an id is equal in all columns


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of PASSAGE bytes that occur more than once; a character cut in two goes whole.

    A document that loses nothing keeps its text, null included; one that loses all stays with an empty text.
    """
    given, key = _keyed(docs)
    kept = _spare(given, "_kept")
    cut = dedup_suffixes(given, PASSAGE, id_col=key).where("n_removed > 0").select(F.col("doc_id").alias(key), F.col("kept").alias(kept)).dropDuplicates([key])
    joined = given.join(cut, key, "left")
    changed = {"text": F.coalesce(kept, "text"), "n_chars": F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(kept).cast("long"))}
    return joined.select([changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget."""
    given, key = _keyed(docs)
    found = contaminated(given, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
    return given.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian unsigned 32-bit), with digests of the ids and of the decoded bytes."""
    return encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_near_duplicates),
    ("suffix_dedup", cut_repeated_passages),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]
#: SQL expresses neither the classifier nor the alignment; tests follow the whole pipeline stage by stage over planted rows, and hold ids against the library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is in the shared folder."""
    out, docs = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
    return docs
