"""The operators over the given tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.ann import nearest_neighbours
from tallyhouse.llm.chat import format_chat, read_back
from tallyhouse.llm.embedding_dedup import embedding_near_duplicates
from tallyhouse.llm.html_extract import extract_main_text
from tallyhouse.llm.minhash import minhash_components
from tallyhouse.llm.mixing import mix_sources
from tallyhouse.llm.packing import pack_documents
from tallyhouse.llm.quality import fit_quality, quality_scores
from tallyhouse.llm.resampling import importance_resample
from tallyhouse.llm.spelling import spelling_variants
from tallyhouse.llm.substring_dedup import substring_dedup
from tallyhouse.llm.token_counts import token_counts
from tallyhouse.llm.url_filter import Rule, labelled_urls, train_url_model, url_verdicts


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    """Where the public tokenizer lies on this machine; all machines have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = fit_quality(documents, labels.where(~_held_out()))
    scored = quality_scores(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", _held_out().alias("held_out"), "score", "predicted")


URL_RULES = [
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str, labels: str | None = None) -> DataFrame:
    """`labels` is the path of a labelled table (url, label), the general list of the module if there is none."""
    model = train_url_model(labelled_urls(spark, labels))
    return url_verdicts(_table(spark, sf_dir, "pages"), URL_RULES, model)


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(_table(spark, sf_dir, "documents"), words=2)


def op5_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substring_dedup(documents)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cut.select("doc_id", "text", F.size("removed").alias("n_removed"), gone.alias("removed_bytes"), "removed")


#: A conversation whose texts hold control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"
CONTROL_ROWS = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame(CONTROL_ROWS, "conv_id long, turn long, role string, text string"))
    read = read_back(format_chat(rows))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), tokenizer_path())


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"), misspell_every=97)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_embedding_near_dedup,
        op2_quality_classifier,
        op3_url_filter,
        op4_minhash_near_dedup,
        op5_approximate_nearest_neighbours,
        op6_packing,
        op7_source_mixing,
        op8_substring_dedup,
        op9_chat_formatting,
        op10_token_counts,
        op11_importance_resampling,
        op12_html_extraction,
        op13_spelling_variants,
    ]
    return {f.__name__: f for f in found}
