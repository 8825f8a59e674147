"""Importance resampling towards a target text distribution, on hashed runs of words.

Every run of 1 to `max_words` words falls into a bucket by its CRC-32. The gain of a bucket compares how common it is in the
target with how common it is in the corpus; a document weighs the mean gain of its features, and Gumbel noise by doc_id turns
the largest scores into a draw without replacement.

Most features are few words said often. A head vocabulary is broadcast: the CRC state of each frequent word, from which the CRC of
a run that begins with it goes on, and the buckets of frequent pairs. All other features take their CRC directly. Both ways give
the same buckets, so what is in the head decides the time and never the result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import Scratch

BUCKETS = 10_000
#: Entries of the head and the longest word in it: a broadcast of at most some 5 MB, whatever the corpus.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 30_000, 100_000, 48
#: Entries that one task counts before it forgets the rarer half.
TASK_ENTRIES = 300_000
#: Bytes of a text that are split into words at a time.
SLICE = 1 << 20

#: A-Z in lower case; 0-9, a-z and all bytes of characters beyond ASCII as they are; all others end a word.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size (a longer word alone excepted)."""
    raw = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES) if text else b""
    at = 0
    while at < len(raw):
        end = at + SLICE
        if end < len(raw):
            blank = raw.find(b" ", end)
            end = len(raw) if blank < 0 else blank
        if words := raw[at:end].split():
            yield words
        at = end


class Head:
    """Bucket numbers of features: frequent words and pairs by table, all others by CRC."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.buckets = buckets
        self.number = {word: k for k, word in enumerate(words)}
        self.state = [crc32(word) for word in words]
        self.bucket = dict(zip(words, (state % buckets for state in self.state)))
        both = [(self.number[a] * len(words) + self.number[b], crc32(b" " + b, self.state[self.number[a]]) % buckets) for a, b in pairs]
        both.sort()
        self.pair_keys = np.array([key for key, _ in both], dtype=np.int64)
        self.pair_buckets = np.array([bucket for _, bucket in both], dtype=np.int64)

    def singles(self, words: list[bytes]) -> np.ndarray:
        buckets, known = self.buckets, self.bucket.get
        found = [known(word) for word in words]
        if None in found:
            found = [crc32(word) % buckets if k is None else k for word, k in zip(words, found)]
        return np.array(found, dtype=np.int64)

    def pairs(self, words: list[bytes]) -> np.ndarray:
        numbers = np.array([self.number.get(word, -1) for word in words], dtype=np.int64)
        first, second = numbers[:-1], numbers[1:]
        out = np.full(len(first), -1, dtype=np.int64)
        if len(self.pair_keys):
            keys = first * len(self.number) + second
            place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            hit = (first >= 0) & (second >= 0) & (self.pair_keys[place] == keys)
            out[hit] = self.pair_buckets[place[hit]]
        for k in np.flatnonzero(out < 0):
            state = self.state[first[k]] if first[k] >= 0 else crc32(words[k])
            out[k] = crc32(b" " + words[k + 1], state) % self.buckets
        return out

    def longer(self, words: list[bytes], width: int) -> np.ndarray:
        out = []
        for k in range(len(words) - width + 1):
            at = self.number.get(words[k], -1)
            state = self.state[at] if at >= 0 else crc32(words[k])
            out.append(crc32(b" " + b" ".join(words[k + 1 : k + width]), state) % self.buckets)
        return np.array(out, dtype=np.int64)

    def features(self, text: str | None, max_words: int) -> Iterator[tuple[int, np.ndarray]]:
        """(number of words, buckets of features) of each slice of a text; runs go on across slices."""
        last: list[bytes] = []
        for words in words_of(text):
            found = [self.singles(words)]
            for width in range(2, max_words + 1):
                joined = last[len(last) - min(len(last), width - 1) :] + words
                if len(joined) >= width:
                    found.append(self.pairs(joined) if width == 2 else self.longer(joined, width))
            yield len(words), np.concatenate(found) if len(found) > 1 else found[0]
            last = (last + words)[-(max_words - 1) :] if max_words > 1 else []


def _frequent(scratch: Scratch, rows: DataFrame, width: int, size: int) -> list[bytes]:
    """The most frequent runs of `width` words by the counts of all tasks, as bytes with one blank between words.

    A task that meets more distinct runs than it may hold forgets the rarer half, so a count can fall short; that costs time only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                for words in words_of(text.as_py()):
                    if width == 1:
                        counts.update(words)
                    else:
                        counts.update(b" ".join(pair) for pair in zip(words, words[1:]))
                if len(counts) > TASK_ENTRIES:
                    counts = Counter(dict(counts.most_common(TASK_ENTRIES // 2)))
        best = [(word, n) for word, n in counts.most_common(size) if len(word) <= HEAD_BYTES * width]
        yield pa.RecordBatch.from_arrays(
            [pa.array([word for word, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())], names=["run", "n"]
        )

    counted = scratch.write(rows.select("text").mapInArrow(run, "run binary, n long").groupBy("run").agg(F.sum("n").alias("n")), "runs")
    # Counts by steps of a sixteenth of a doubling, at most some thousand rows, tell from which step on no more than `size` runs are left.
    step = F.floor(16 * F.log2("n")).cast("long")
    least, held = None, 0
    for value, n in counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if held + n > size:
            break
        least, held = value, held + n
    return [] if least is None else sorted(bytes(r.run) for r in counted.where(step >= least).select("run").collect())


def head_vocabulary(scratch: Scratch, rows: DataFrame, max_words: int, buckets: int) -> Head:
    """The head of a corpus; at most HEAD_WORDS words and HEAD_PAIRS pairs reach the driver."""
    words = _frequent(scratch, rows, 1, HEAD_WORDS)
    known = set(words)
    pairs = [tuple(pair.split(b" ")) for pair in (_frequent(scratch, rows, 2, HEAD_PAIRS) if max_words > 1 else [])]
    return Head(words, [(a, b) for a, b in pairs if a in known and b in known], buckets)


def _bucket_counts(rows: DataFrame, head, max_words: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows; each task sends one array's worth of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in head.value.features(text.as_py(), max_words):
                    np.add.at(counts, found, 1) if len(found) < 64 else np.add(counts, np.bincount(found, minlength=buckets), out=counts)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    totals = np.zeros(buckets, dtype=np.int64)
    summed = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in summed.collect():  # at most `buckets` rows
        totals[bucket] = n
    return totals


def bucket_gains(source: Iterable[int], target: Iterable[int]) -> list[int]:
    """1000 times the logarithm of the smoothed ratio of shares, rounded down, per bucket."""
    source, target = [float(n) for n in source], [float(n) for n in target]
    all_source, all_target = sum(source) + len(source), sum(target) + len(target)
    return [math.floor(1000 * math.log((t + 1) * all_source / ((s + 1) * all_target))) for s, t in zip(source, target)]


def _weights(rows: DataFrame, head, gains: list[int], max_words: int) -> DataFrame:
    table = np.array(gains, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weights = [], [], []
            for text in batch.column(1):
                words = features = total = 0
                for n, found in head.value.features(text.as_py(), max_words):
                    words, features, total = words + n, features + len(found), total + int(table[found].sum())
                n_words.append(words)
                n_features.append(features)
                weights.append(total // features if features else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weights))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise of a document: the first 8 hex digits of a SHA-256 as a place in the unit interval, through -1000 ln(-ln)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    place = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(place))).cast("long")


def _ranked(scratch: Scratch, rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with `rank` from 1 in an order over all of them: a sort over all tasks, then an offset per partition of the sort.

    Rows that are equal in the order are dealt to several tasks by the random number at its end.
    """
    placed = scratch.write(rows.orderBy(*order, F.rand(11)).withColumn("place", F.monotonically_increasing_id()), "placed")
    counts = placed.groupBy(F.shiftright("place", 33).alias("part")).count().orderBy("part").collect()  # a row per partition
    starts, at = [], 1
    for part, count in counts:
        starts.append((part, at))
        at += count
    starts = scratch.spark.createDataFrame(starts, "part long, start long")
    rank = F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(starts), "part").withColumn("rank", rank)


def importance_resample(
    documents: DataFrame,
    target: DataFrame,
    max_words: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    least_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; `rank` counts the drawn ones from 1, others have none.

    Words are A-Z in lower case and runs of letters, digits and characters beyond ASCII, over whole texts. Of the N documents with
    `least_words` words or more, floor(percent * N / 100) with the largest scores are drawn; ties go to the smaller doc_id.

    A null or empty text has no features and weight 0. Rows without a doc_id share one noise and come last among ties. Repeated rows are
    rows like others: each is counted, scored and drawn by itself. An empty target has no counts, an empty table of documents
    gives an empty result. Other columns are not looked at.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "resample")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = target.select(F.col("text").cast("string").alias("text"))
    head = spark.sparkContext.broadcast(head_vocabulary(scratch, rows, max_words, buckets))
    gains = bucket_gains(_bucket_counts(rows, head, max_words, buckets), _bucket_counts(wanted, head, max_words, buckets))
    weighed = _weights(rows, head, gains, max_words).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = scratch.write(weighed, "scored")

    eligible = scored.where(F.col("n_words") >= least_words)
    # Scores are whole numbers within some tens of thousands of each other, so their counts are a small table.
    histogram = eligible.groupBy("score").count().orderBy(F.desc("score")).collect()
    draw = percent * sum(n for _, n in histogram) // 100
    cutoff, above = None, 0
    for value, n in histogram:
        if above >= draw:
            break
        cutoff, above = value, above + n
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if cutoff is None:
        return scored.select(*columns, none)
    chosen = (F.col("n_words") >= least_words) & (F.col("score") >= cutoff)
    ranked = _ranked(scratch, scored.where(chosen), [F.desc("score"), F.asc_nulls_last("doc_id")])
    drawn = ranked.select(*columns, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank"))
    return drawn.unionByName(scored.where(~chosen).select(*columns, none))
