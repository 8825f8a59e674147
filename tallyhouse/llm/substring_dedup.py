"""Repeated passages across documents, found by content-defined chunks.

A gear hash rolls over the last 16 bytes; a chunk ends behind a white space byte where the hash is small, at one word in three, and in long
stretches without white space between two characters, some 18 bytes apart. Where chunks end depends on the last bytes only, so an
insertion moves no cut but those next to it. What is compared are windows: from each chunk on, as many chunks as hold the least number
of words of a passage, so one earlier document holds the whole window. Windows with equal 128-bit digests are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS_PER_CUT = 3
#: Without white space in the last so many bytes, so many bytes count as a word, and chunks end between characters.
STRETCH, WORD_BYTES = 48, 6
#: Bytes of a chunk at most; only text that repeats itself byte by byte gets there.
LARGEST = 4096

_GEAR = np.random.default_rng(61).integers(0, 1 << 32, size=256, dtype=np.uint32)
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def _in_stretch(space: np.ndarray) -> np.ndarray:
    """Bytes that have no white space among them and the STRETCH bytes before."""
    place = np.arange(len(space))
    last = np.maximum.accumulate(np.where(space, place, -1))
    return place - last > STRETCH


def cuts(raw: bytes) -> list[int]:
    """Where chunks end, in bytes; the last end is the end of the text, and an empty text has none."""
    if not raw:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    rolled = _GEAR[data]
    for step in (1, 2, 4, 8):
        rolled[step:] += rolled[:-step] << np.uint32(step)
    space = _IS_SPACE[data]
    wanted = space & (rolled < np.uint32((1 << 32) // WORDS_PER_CUT))
    stretch = _in_stretch(space)
    if stretch.any():
        before_character = np.r_[data[1:] & 0xC0 != 0x80, True]
        share = np.where(data < 0x80, 1 / (3 * WORD_BYTES), 1 / WORD_BYTES)  # a character beyond ASCII has two to four bytes
        wanted |= stretch & before_character & (rolled < share * (1 << 32))
    out, last = [], 0
    for end in [*(np.flatnonzero(wanted) + 1).tolist(), len(raw)]:
        while end - last > LARGEST:
            last += LARGEST
            while raw[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if end > last:
            out.append(end)
            last = end
    return out


def _digests(raw: bytes, ends: list[int]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def measures(raw: bytes, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each chunk what is before it and up to its end, in units of which a word has WORD_BYTES.

    A word counts where it begins, what is left of one at the start of a chunk as a word, and a stretch without white space by its bytes.
    """
    space = _IS_SPACE[np.frombuffer(raw, dtype=np.uint8)]
    units = WORD_BYTES * (~space & np.r_[True, space[:-1]]) + _in_stretch(space)
    begun = np.cumsum(np.r_[0, units])
    starts = np.r_[0, ends[:-1]].astype(np.int64)
    inside = ~space[starts] & (starts > 0) & ~space[starts - 1]
    return begun[starts] - WORD_BYTES * inside, begun[ends]


def windows(raw: bytes, ends: list[int], least_words: int) -> list[tuple[int, int, bytes]]:
    """(first chunk, last chunk, digest): from each chunk on, and up to the last chunk, the fewest with `least_words` words."""
    if not ends:
        return []
    before, upto = measures(raw, ends)
    least = least_words * WORD_BYTES
    last = np.searchsorted(upto, before + least)
    whole = np.flatnonzero(last < len(ends))
    spans = list(zip(whole.tolist(), last[whole].tolist(), strict=True))
    if spans:
        spans.append((int(np.flatnonzero(before <= upto[-1] - least)[-1]), len(ends) - 1))
        if spans[-1] == spans[-2]:
            spans.pop()
    digests = b"".join(_digests(raw, ends))
    return [(i, j, xxhash.xxh3_128_digest(digests[16 * i : 16 * (j + 1)])) for i, j in spans]


def window_digests(documents: DataFrame, least_words: int) -> DataFrame:
    """(high, low, doc_id): the halves of each distinct window digest of each text that has a doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, found = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                own = {digest for *_, digest in windows(raw, cuts(raw), least_words)}
                ids.append(doc_id)
                sizes.append(len(own))
                found.extend(own)
                if len(found) > 1 << 17:
                    yield _digest_rows(ids, sizes, found)
                    ids, sizes, found = [], [], []
            yield _digest_rows(ids, sizes, found)

    rows = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "high long, low long, doc_id long")


def _digest_rows(ids: list, sizes: list, found: list) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
    docs = np.repeat(np.array(ids, dtype=np.int64), sizes)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)] + [pa.array(docs)], names=["high", "low", "doc_id"]
    )


def removable(raw: bytes, repeated: set[int], least_words: int) -> list[tuple[int, int]]:
    """Byte spans that repeated windows cover; those that meet are one span."""
    ends = cuts(raw)
    starts = [0, *ends]
    spans: list[tuple[int, int]] = []
    for i, j, digest in windows(raw, ends, least_words):
        if int.from_bytes(digest[8:], "little", signed=True) in repeated:
            if spans and starts[i] <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], ends[j]))
            else:
                spans.append((starts[i], ends[j]))
    return spans


def _later_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, low) of the windows that a smaller doc_id holds too: rows sorted by digest and doc_id, so the first of a digest owns it."""
    held: tuple[int, int, int] | None = None
    for batch in batches:
        high, low, doc = (column.to_numpy() for column in batch.columns)
        if not len(high):
            continue
        begins = np.r_[held is None or (high[0], low[0]) != held[:2], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
        place = np.maximum.accumulate(np.where(begins, np.arange(len(high)), -1))
        owner = np.where(place >= 0, doc[np.maximum(place, 0)], 0 if held is None else held[2])
        later = doc > owner
        held = (high[-1], low[-1], owner[-1])
        yield pa.RecordBatch.from_arrays([pa.array(doc[later]), pa.array(low[later])], names=["doc_id", "low"])


def _unused(documents: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name.lower() in (column.lower() for column in documents.columns):
        name += "_"
    return name


def substring_dedup(documents: DataFrame, least_words: int = 28) -> DataFrame:
    """Documents without the passages that a document of smaller doc_id holds too.

    A passage is at least `least_words` words in a row that one earlier document holds in a row; passages that meet
    are cut as one. In long stretches without white space six bytes count as a word. Returns all columns, `text` without the passages, and
    removed, an array of (start, end) in bytes of the UTF-8 of the old text. Each passage stays in
    the document with the smallest doc_id; repeats inside one document stay as well. As chunks end at
    cuts inside a passage, some words at its two ends stay. Null texts stay null, and rows without a doc_id stay as
    they are and take no part. Rows that repeat a doc_id count as one document. A column
    named removed is replaced; others keep their data whatever their names. An empty table gives an empty result.

    Windows are shuffled once, by digest, and read in order: the first holder of a digest owns it, so no group is ever held in memory,
    however many documents share a passage.
    """
    held = window_digests(documents, least_words).repartition("high", "low").sortWithinPartitions("high", "low", "doc_id")
    owner_of, lows, result = (_unused(documents, name) for name in ("_repeats_of", "_repeated", "_cut"))
    repeats = held.mapInArrow(_later_holders, "doc_id long, low long").groupBy(F.col("doc_id").alias(owner_of)).agg(F.collect_set("low").alias(lows))

    @F.pandas_udf("text string, starts array<long>, ends array<long>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, repeated in batches:
            out = []
            for text, lows in zip(texts, repeated, strict=True):
                spans = []
                if lows is not None and text:
                    raw = text.encode("utf-8", "surrogatepass")
                    spans = removable(raw, set(lows.tolist()), least_words)
                    if spans:
                        kept = zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(raw)], strict=True)
                        text = b"".join(raw[a:b] for a, b in kept).decode("utf-8", "surrogatepass")
                out.append((text, [a for a, _ in spans], [b for _, b in spans]))
            yield pd.DataFrame(out, columns=["text", "starts", "ends"])

    own = F.col("doc_id").cast("long") == F.col(owner_of)
    joined = documents.join(repeats, own, "left").withColumn(result, cut(F.col("text").cast("string"), F.col(lows)))
    spans = F.arrays_zip(F.col(f"{result}.starts").alias("start"), F.col(f"{result}.ends").alias("end"))
    others = [F.col(f"{result}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in documents.columns if c != "removed"]
    return joined.select(*others, spans.alias("removed"))
