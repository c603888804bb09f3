"""A corpus through toxicity, line dedup, near-duplicates, decontamination and tokens."""

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark.llm import bpe, contamination, line_dedup, ngram_join, toxicity
from devdata_spark.llm.common import join_small, shared_folder

TOXIC = 0.5
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
# Of the tokenizer's memos, some 45 MB in a worker: executors' heaps are full by then.
MEMO_ENTRIES = 60_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic.

    The chain learns from those of them that the labels table names.
    """
    chain = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, chain).filter(F.col("p.toxic") < TOXIC).select("document.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without lines that an earlier place of the corpus has."""
    others = F.struct(*[c for c in docs.columns if c != "text"])
    rows = docs.select("doc_id", "text", others.alias("document"))
    found = line_dedup.dedup(rows, keep=["document"])
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    made = {"text": F.col("text"), "n_chars": n_chars.alias("n_chars")}
    return found.select(*[made.get(c, F.col("document")[c].alias(c)) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest doc_id.

    Near-duplicates share four fifths of their five-word shingles.
    """
    classes = ngram_join.classes(docs, n=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    dropped = classes.filter("component_id <> doc_id").select("doc_id").distinct()
    return join_small(docs, dropped, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    find = contamination.finder(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), batched=False)
    found = docs.select(F.struct("*").alias("document"), find(F.col("text")).alias("found"))
    return found.filter(F.size("found") == 0).select("document.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, tokens, n_tokens and whether decoding gives the text back."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.round_trip(spark, path, public_tokenizers.PATTERN, MEMO_ENTRIES)
    text = F.coalesce("text", F.lit(""))
    encoded = docs.select("doc_id", "text", both(text).alias("made"))
    return encoded.select(
        "doc_id",
        F.col("made.ids").alias("tokens"),
        bpe.n_tokens(F.col("made.ids")).alias("n_tokens"),
        (F.col("made.decoded") == text.cast("binary")).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", drop_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

# Trained models and fuzzy matches cannot be stated in SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder; the last stage's rows.

    Each stage's result is written as Parquet to the folder that `spark.checkpoint.dir`
    names, and read again as the next stage's documents.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
