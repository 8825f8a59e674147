"""MinHash near-duplicates by a multi-index Hamming join.

A document's signature holds 65 components of one byte, each cut from the minimum of one hash over
its shingles. Two sets of Jaccard similarity s differ in a component with probability about 1 - s, so at
0.8 they differ in 13 of 65 on average, and in more than 25 less than twice in ten thousand times.

All pairs that differ in at most 25 components are found for certain: cut into 13 chunks of five,
such a pair has a chunk with at most one error (13 chunks with two each would make 26). One error is
enumerated by leaving out each of the five places in turn, so the pair shares one of 13 * 5 keys of the
other four bytes.

Copies (equal sets) are one class from the start. Within a key, members are first compared
with a few centres only, the same few for all keys as they go by one global order, and components are built from the links
that full sets confirm. What still lies in different components although it shares a key is
then compared without exception, so no link that joins two components is lost: pair by pair where few
share a key, and else in blocks of full sets, out of which only links come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.components import connected_components
from tallyhouse.llm.nndescent import whole_groups
from tallyhouse.llm.scratch import Scratch
from tallyhouse.llm.words import mixed, shingle_set

CHUNKS = 13
PLACES = 5
SYMBOLS = CHUNKS * PLACES
MAX_DISTANCE = 2 * CHUNKS - 1
CENTRES = 2
ROUNDS = 1
#: Keys with as many members or more are compared in blocks of about BLOCK documents, others pair by pair.
LARGE_KEY = 8
BLOCK = 128
#: Shingles looked at together in a block.
COLUMNS = 8192

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(1, 1 << 63, size=(SYMBOLS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 1 << 63, size=(SYMBOLS, 1), dtype=np.uint64)
_HASHED = 2048


def signature(shingles: np.ndarray) -> bytes:
    """One byte per hash function, from the least hash of the set."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _HASHED):
        np.minimum(least, (shingles[at : at + _HASHED] * _FACTORS + _OFFSETS).min(axis=1), out=least)
    return (mixed(least) & np.uint64(255)).astype(np.uint8).tobytes()


def signatures(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, digest, sig) per row; digest and sig are null for an empty set or a null doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, sigs = [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                found = shingle_set(text.as_py(), words)
                counts.append(len(found))
                linkable = len(found) and doc_id.is_valid
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if linkable else None)
                sigs.append(signature(found) if linkable else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "sig"],
            )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, digest binary, sig binary")


def chunk_keys(classes: DataFrame) -> DataFrame:
    """(key, id): for each chunk and each left-out place, a hash of the chunk, the place and the other bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mixed(np.arange(1, SYMBOLS + 1, dtype=np.uint64).reshape(1, CHUNKS, PLACES) << np.uint64(33))
        shift = np.uint64(8) * np.arange(PLACES, dtype=np.uint64)
        for batch in batches:
            n = batch.num_rows
            if n:
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(n, CHUNKS, PLACES)
                at = sig.astype(np.uint64) << shift
                rest = at.sum(axis=2, keepdims=True) - at  # the chunk with one place blank
                ids = np.repeat(batch.column(0).to_numpy(), SYMBOLS)
                keys = mixed(rest * np.uint64(0x9E3779B97F4A7C15) + salt).reshape(-1).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], names=["key", "id"])

    return classes.select("id", "sig").mapInArrow(run, "key long, id long")


def _close(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures differ in few enough components and whose set sizes allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint8).reshape(-1, SYMBOLS) for k in (2, 3))
                near = pa.array((x != y).sum(axis=1) <= MAX_DISTANCE)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(near)

    a = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    b = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    sized = pairs.join(a, "a").join(b, "b").where(F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)"))
    return sized.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(a, "a").join(b, "b").withColumn("i", F.size(F.array_intersect("x", "y")))
    return both.where(F.expr(f"100 * i >= {percent} * (size(x) + size(y) - i)")).select("a", "b")


def _sets(documents: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, shingles) for the given document ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(text.as_py(), words).view(np.int64) for text in batch.column(1)]
            if found:
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "shingles"])

    rows = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    found = rows.join(ids.select("id"), "id", "left_semi").mapInArrow(run, "id long, shingles array<long>")
    return found


def _labelled(ids: DataFrame, components: DataFrame | None) -> DataFrame:
    if components is None:
        return ids.withColumn("component", F.col("id"))
    return ids.join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))


def minhash_components(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Documents linked by the similarity of their sets of `words`-word shingles.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept (whether
    that is the document's own), one row per row of `documents`, of which only doc_id and text
    are read. Links need 100 * intersection >= percent * union; percent is 80 or more, which the signature's
    limits are made for. Null, empty and blank texts have an empty set and link with nothing; rows without a
    doc_id link with nothing, have no component and are kept. Rows that repeat a doc_id come
    back as often as they are there and count as one document; all their texts can link. An empty table
    gives an empty result.
    """
    if percent < 80:
        raise ValueError("the signature's limits are made for similarities of 80 percent or more")
    spark = documents.sparkSession
    scratch = Scratch(spark, "minhash")
    rows = scratch.write(signatures(documents, words), "signatures")
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")
    )
    classes = scratch.write(classes, "classes")
    again = scratch.write(_repeated_ids(rows, classes), "again")
    keys = chunk_keys(classes)
    shared = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    members = scratch.write(keys.join(shared.select("key"), "key").distinct(), "members")
    ids = scratch.write(members.select("id").distinct(), "ids")
    sets = scratch.write(_sets(documents, ids, words), "sets")

    links, components, mixed_keys = again, None, members
    for turn in range(ROUNDS + 1):
        labelled = _labelled(mixed_keys.select("key", "id"), components)
        spread = labelled.groupBy("key").agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            *[F.min_by("id", F.xxhash64("id", F.lit(turn * CENTRES + k))).alias(f"centre{k}") for k in range(CENTRES)],
        )
        spread = spread.where("low < high")
        labelled = labelled.join(spread.drop("high"), "key")
        last = mixed_keys if turn else None
        mixed_keys = scratch.write(labelled, "mixed")
        scratch.drop(last)
        if turn < ROUNDS:
            centres = F.array(*[F.col(f"centre{k}") for k in range(CENTRES)])
            pairs = mixed_keys.select("id", F.explode(F.array_distinct(centres)).alias("centre")).distinct()
            pairs = pairs.where("id <> centre")
        else:
            counts = mixed_keys.groupBy("key").agg(F.count("*").alias("n"))
            counted = mixed_keys.join(counts, "key")
            pairs = _cross_pairs(counted.where(f"n < {LARGE_KEY}"))
            found = scratch.write(_block_links(counted.where(f"n >= {LARGE_KEY}"), sets, scratch, percent), "links")
            links = links.unionByName(found)
        pairs = pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
        near = scratch.write(_close(pairs, classes, percent), "near")
        found = scratch.write(_confirmed(near, sets, percent), "links")
        links = links.unionByName(found)
        # Until all links are in, two rounds do: a component that is still in parts only means more to compare.
        rounds = 2 if turn < ROUNDS else None
        components = scratch.write(connected_components(links, scratch, rounds), "components")

    scratch.drop(members, ids, sets, mixed_keys)
    by_digest = classes.join(components, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    out = rows.select("doc_id", "n_shingles", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _repeated_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links from the classes of every doc_id whose rows differ in text to that doc_id."""
    differing = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    differing = differing.where("low < high").select("doc_id")
    held = rows.join(differing, "doc_id").select("doc_id", "digest").distinct().join(classes.select("digest", "id"), "digest")
    return held.select(F.least("id", "doc_id").alias("a"), F.greatest("id", "doc_id").alias("b")).where("a < b").distinct()


def _cross_pairs(mixed_keys: DataFrame) -> DataFrame:
    """All pairs of members that share a key of few members but no component."""
    here = mixed_keys.select("key", "id", "component")
    there = here.select("key", F.col("id").alias("centre"), F.col("component").alias("other"))
    return here.join(there, "key").where("component < other").select("id", "centre").distinct()


def _block_links(mixed_keys: DataFrame, sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Links between components that share a key of many members, one for each document and component at least.

    Keys with the same first centre make one bundle. Its documents are the core, those in the centre's own component,
    and the strays. Strays meet one another and the core block by block; the core need not meet itself.
    """
    lead = mixed_keys.where("id = centre0").select("key", F.col("component").alias("bundle"))
    bundles = mixed_keys.join(lead, "key").select("bundle", "id", "component").distinct()
    bundles = scratch.write(bundles.withColumn("stray", F.col("component") != F.col("bundle")), "bundles")
    count = bundles.groupBy("bundle").agg(
        F.ceil(F.count_if("stray") / BLOCK).alias("strays"), F.ceil(F.count_if(~F.col("stray")) / BLOCK).alias("cores")
    )
    block = F.pmod(F.xxhash64("id"), F.when(F.col("stray"), F.col("strays")).otherwise(F.col("cores")))
    placed = bundles.join(count, "bundle").withColumn("block", block)
    # A meeting is a block of strays (first) and a block of strays no earlier (second) or of the core (second, from `strays` on).
    blocks, firsts = F.col("strays") + F.col("cores"), F.sequence(F.lit(0).cast("long"), F.col("strays") - 1)
    as_first = placed.where("stray").withColumn("second", F.explode(F.sequence(F.col("block"), blocks - 1))).select(
        "bundle", (F.col("block") * blocks + F.col("second")).alias("meeting"), "id", "component", F.lit(True).alias("first")
    )
    own = F.when(F.col("stray"), F.col("block")).otherwise(F.col("strays") + F.col("block"))
    earlier = F.filter(firsts, lambda k: k < own)
    as_second = placed.withColumn("with", F.explode(earlier)).select(
        "bundle", (F.col("with") * blocks + own).alias("meeting"), "id", "component", F.lit(False).alias("first")
    )
    rows = as_first.unionByName(as_second).join(sets, "id").select("bundle", "meeting", "id", "component", "first", "shingles")
    rows = rows.repartition("bundle", "meeting").sortWithinPartitions("bundle", "meeting")
    return rows.mapInArrow(_meetings(percent), "a long, b long").distinct()


def _meetings(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 2, 1):
            table = table.combine_chunks()
            bundle, meeting = table.column(0).to_numpy(), table.column(1).to_numpy()
            cuts = np.flatnonzero((bundle[1:] != bundle[:-1]) | (meeting[1:] != meeting[:-1])) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(bundle)], strict=True):
                part = table.slice(a, b - a)
                ids, component, first = (part.column(k).to_numpy() for k in (2, 3, 4))
                lists = part.column(5).chunk(0)
                sizes = np.diff(lists.offsets.to_numpy())
                common = _intersections(sizes, lists.flatten().to_numpy(), first)
                total = sizes[first][:, None] + sizes[None, :] - common
                linked = (100 * common >= percent * total) & (component[first][:, None] != component[None, :])
                i, j = np.nonzero(linked)
                x, y = ids[first][i], ids[j]
                _, one = np.unique(np.stack([x, component[j]]), axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)[one]), pa.array(np.maximum(x, y)[one])], names=["a", "b"])

    return run


def _intersections(sizes: np.ndarray, shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets of `first` with all sets, by products over shared shingles."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    _, column, count = np.unique(shingles, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    rows, column = rows[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((int(first.sum()), len(sizes)), dtype=np.int64)
    for low in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        held = np.zeros((len(sizes), COLUMNS), dtype=np.float32)
        held[rows[a:b], column[a:b] - low] = 1
        out += np.rint(held[first] @ held.T).astype(np.int64)
    return out
