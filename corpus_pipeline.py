"""The corpus pipeline: documents through the stages below, each over all that its predecessor kept.

All stages but the last return the columns of documents, other columns of any name included. The stages after quality go by rows and not by
doc_id, so repeated rows and rows without a doc_id are treated like others: a row's number is its place in the files of its table.
An empty table gives an empty result in every stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.minhash import minhash_components
from tallyhouse.llm.mixing import mix_sources
from tallyhouse.llm.packing import pack_documents
from tallyhouse.llm.quality import fit_quality, quality_scores
from tallyhouse.llm.queries import tokenizer_path
from tallyhouse.llm.scratch import Scratch
from tallyhouse.llm.substring_dedup import substring_dedup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Longest list of files that is broadcast, at some 100 bytes each; a longer one is left to Spark.
BROADCAST_FILES = 100_000
#: The columns of documents.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage: Stage) -> Stage:
    """Columns beyond those of documents go through a stage under names of its own, so none can clash with the stage's helpers."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = [name if name in COLUMNS else f"extra_{k}" for k, name in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*inside), sf_dir).select(*inside).toDF(*docs.columns)

    return run


@keeps_columns
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the folder's labels.

    Null and empty texts are scored like others; repeated rows share a score and go or stay together, and so do texts that tie. Without
    labels nothing is rejected.
    """
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_scores(docs, model).where("predicted = 1")


def _keyed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents with the number of their row in place of doc_id, which is in `own_id`.

    Rows of a table in files are numbered where they lie: by file, in the order of the names, and place in it. Nothing is sorted or
    moved for that; only the files' names, which the driver lists anyway, are collected. Other rows are written first.
    """
    at = F.col("_metadata.row_index")
    try:
        names = [r.name for r in docs.select(F.col("_metadata.file_path").alias("name")).distinct().collect()]
        files = spark.createDataFrame(list(zip(sorted(names), range(len(names)))), "file_name string, file_number long")
        files = F.broadcast(files) if len(names) <= BROADCAST_FILES else files
        placed = docs.select("*", F.col("_metadata.file_path").alias("file_name"), at.alias("row_index")).join(files, "file_name")
        number = F.shiftleft("file_number", 40) + F.col("row_index")
    except AnalysisException:  # not a table in files
        placed = Scratch(spark, "pipeline-rows").write(docs.withColumn("row_index", F.monotonically_increasing_id()), "rows")
        number = F.col("row_index")
    return placed.withColumn("own_id", F.col("doc_id")).withColumn("doc_id", number).select(*docs.columns, "own_id")


def _unkeyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.col("own_id"))


@keeps_columns
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near-duplicates stays, whatever their doc_ids.

    Null, empty and blank texts have no words, are near to nothing and stay. Repeated rows are copies like others: one stays.
    """
    rows = _keyed(spark, docs)
    gone = minhash_components(rows, words=5, percent=80).where("NOT kept").select("doc_id")
    return _unkeyed(rows.join(gone, "doc_id", "left_anti"))


@keeps_columns
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier row holds are cut out; n_chars follows the new text.

    Null texts stay null with a null n_chars, empty ones empty; of rows with equal texts the first keeps its text.
    """
    return _unkeyed(substring_dedup(_keyed(spark, docs)).withColumn("n_chars", F.length("text").cast("long")))


@keeps_columns
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: not at all, once or twice.

    Rows without a source are a source of their own. A null, empty or blank text has no words, which decides how often it is taken; rows
    that are equal in all columns are taken each by itself.
    """
    rows = _keyed(spark, docs)
    copies = mix_sources(rows).select("doc_id", F.col("copies").cast("int").alias("copies"))
    taken = rows.join(copies, "doc_id").withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
    return _unkeyed(taken)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 ids.

    A null or empty text is the end id alone. Repeated rows and rows without a doc_id are packed each as a document of its own; other
    columns are not looked at.
    """
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("passages", passages),
    ("mix", mix),
    ("packing", packing),
]

#: Voting, random rounding and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
