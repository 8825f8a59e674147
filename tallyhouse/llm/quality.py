"""Quality of texts by the votes of their nearest labelled neighbours in a latent-semantic space.

A text's terms are pairs of neighbouring character classes, word lengths, and how often a word repeats the one before
or any earlier one; what the words say and in which language hardly counts. The space is the leading singular
vectors of the weighted terms of a bounded sample of labelled documents. That sample is broadcast, and
every document is compared with all of it by exact products in blocks.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents that vote, at most; chosen by a hash of doc_id, so that growing tables keep the bound.
SAMPLE = 4000
DIMENSIONS = 48
NEIGHBOURS = 25
#: The weight of a neighbour is its similarity to this power.
SHARPNESS = 8
#: Texts compared with the voters at once.
BLOCK = 512

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SPACES = b" \t\n\x0b\x0c\r"
LETTER, CAPITAL, DIGIT, SPACE, LINE, CONTROL = range(6)
CLASSES = 6 + len(PUNCTUATION)
LENGTHS = 24
REPEATS = 8
TERMS = CLASSES * CLASSES + LENGTHS + 2 * REPEATS


def _class_table() -> np.ndarray:
    table = np.full(256, LETTER, dtype=np.uint16)  # bytes from 128 on are parts of letters
    table[:32] = CONTROL
    table[127] = CONTROL
    table[list(range(65, 91))] = CAPITAL
    table[list(range(48, 58))] = DIGIT
    table[list(SPACES)] = SPACE
    table[10] = LINE
    for k, c in enumerate(PUNCTUATION):
        table[c] = 6 + k
    return table


_TABLE = _class_table()
_IS_SPACE = np.isin(np.arange(256), list(SPACES))


def terms(text: str | None) -> np.ndarray:
    """Square roots of term shares, one group of terms after the other; zeros for a text without words."""
    out = np.zeros(TERMS, dtype=np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return out
    data = np.frombuffer(b" " + raw + b" ", dtype=np.uint8)
    kinds = _TABLE[data]
    pairs = np.bincount(kinds[:-1] * np.uint16(CLASSES) + kinds[1:], minlength=CLASSES * CLASSES)
    lengths = np.diff(np.flatnonzero(_IS_SPACE[data])) - 1
    lengths = np.bincount(np.minimum(lengths[lengths > 0], LENGTHS) - 1, minlength=LENGTHS)
    n = len(words)
    again = sum(map(operator.eq, words, words[1:])) / max(1, n - 1)
    known = 1 - len(set(words)) / n
    at = CLASSES * CLASSES
    out[:at] = pairs / pairs.sum()
    out[at : at + LENGTHS] = lengths / n
    for k, share in enumerate((again, known)):
        at = CLASSES * CLASSES + LENGTHS + k * REPEATS
        out[at + min(REPEATS - 1, int(share * REPEATS))] = 1
    return np.sqrt(out)


@dataclass(frozen=True)
class QualityModel:
    """idf and projection make latent vectors; `voters` are the labelled ones, unit rows, with their labels."""

    weights: np.ndarray
    projection: np.ndarray
    voters: np.ndarray
    labels: np.ndarray

    def latent(self, rows: np.ndarray) -> np.ndarray:
        found = (rows * self.weights) @ self.projection
        length = np.linalg.norm(found, axis=1, keepdims=True)
        return np.divide(found, length, out=np.zeros_like(found), where=length > 0)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The share of label 1 in the weighted votes of each row's nearest voters; rows without terms get the share among all."""
        base = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(rows), base)
        if not len(self.voters):
            return out
        k = min(NEIGHBOURS, len(self.voters))
        found = self.latent(rows)
        for at in range(0, len(rows), BLOCK):
            sims = found[at : at + BLOCK] @ self.voters.T
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(sims, near, axis=1), 0).astype(np.float64) ** SHARPNESS
            votes = (weight * self.labels[near]).sum(axis=1)
            total = weight.sum(axis=1)
            np.divide(votes, total, out=out[at : at + BLOCK], where=total > 0)
        return np.clip(out, 0, 1)


def fitted(rows: np.ndarray, labels: np.ndarray) -> QualityModel:
    """Term weights, singular vectors and voters of a sample."""
    n = len(rows)
    weights = (np.log((1 + n) / (1 + (rows > 0).sum(axis=0))) + 0.3).astype(np.float32)
    weighted = rows * weights
    if n:
        _, vectors = np.linalg.eigh(weighted.T.astype(np.float64) @ weighted)  # rising eigenvalues
        projection = np.ascontiguousarray(vectors[:, ::-1][:, :DIMENSIONS]).astype(np.float32)
    else:
        projection = np.zeros((TERMS, 1), dtype=np.float32)
    model = QualityModel(weights, projection, np.zeros((0, projection.shape[1]), dtype=np.float32), labels.astype(np.float64))
    return QualityModel(weights, projection, model.latent(rows), model.labels)


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [terms(x.as_py()).tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "label", "terms"])


def fit_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """A model from at most `sample` labelled documents.

    `labels` has doc_id and quality (0 or 1; other values and nulls are left out). A bounded sample is what
    the method broadcasts; it is drawn by a hash of doc_id. Labels without a document count for nothing, and of rows that
    repeat a doc_id one votes, the one whose text has the smallest hash.
    """
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label"))
    usable = usable.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("label", "text", "doc_id")  # `sample` rows of 12 bytes
    # One row for each id, whatever its number of rows: the sample's bound is one of rows, and each id votes once.
    rows = rows.withColumn("of", F.xxhash64("text")).groupBy("doc_id").agg(F.min(F.struct("of", "label", "text")).alias("first"))
    rows = rows.select("first.label", "first.text", "doc_id")
    found = rows.mapInArrow(_term_rows, "doc_id long, label int, terms binary").collect()
    found.sort(key=lambda r: (r["doc_id"], bytes(r["terms"])))  # the same model whatever order the rows arrive in
    matrix = np.frombuffer(b"".join(bytes(r["terms"]) for r in found), dtype=np.float32).reshape(len(found), TERMS)
    return fitted(matrix, np.array([r["label"] for r in found], dtype=np.float64))


def quality_scores(documents: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """All columns of `documents`, with score (0 to 1) and predicted (1 from `threshold` on) added; a column of such a name is replaced.

    Only `text` is looked at, the whole of it. Null, empty and blank texts have no terms and get the share of
    label 1 among the voters. Equal texts get equal scores. An empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [np.zeros(0)]
            for at in range(0, len(texts), BLOCK):
                rows = np.array([terms(x) for x in texts[at : at + BLOCK]])
                found.append(shared.value.scores(rows))
            yield pd.Series(np.concatenate(found))

    out = documents.withColumn("score", vote(F.col("text").cast("string")))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
