"""Near-duplicate vectors from a neighbour graph built by NN-descent."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.components import connected_components
from tallyhouse.llm.nndescent import decode, doubles, encode, neighbour_graph, vectors, whole_groups
from tallyhouse.llm.scratch import Scratch

#: How far a similarity of the graph may lie from the exact one.
SLACK = 0.02
#: Vectors whose links an audit finds by comparing them with every vector.
AUDIT = 256
MEMBERS = 512


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares of very large or small values stay finite
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _codes(nodes: DataFrame, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = encode(_unit(doubles(batch.column(1), dims)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], names=["id", "code"])

    return nodes.select("id", "raw").mapInArrow(run, "id long, code binary")


def _links(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose exact cosine reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = doubles(batch.column(2)), doubles(batch.column(3))
                width = max(x.shape[1], y.shape[1])
                x, y = (_unit(np.pad(m, ((0, 0), (0, width - m.shape[1])))) for m in (x, y))
                linked = pa.array(np.einsum("ij,ij->i", x, y) >= threshold)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(linked)

    a = nodes.select(F.col("id").alias("a"), F.col("raw").alias("ra"))
    b = nodes.select(F.col("id").alias("b"), F.col("raw").alias("rb"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "ra", "rb")
    return both.mapInArrow(run, "a long, b long")


def _link_counts(members: DataFrame, threshold: float, dims: int) -> DataFrame:
    """(id, n): other vectors linked directly, of `members` (component, id, raw, copies).

    Components are cut into blocks, each pair of blocks is one matrix product, and only sums leave it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 2, 1024):
            component, pair = table.column(0).to_numpy(), table.column(1).to_numpy()
            ids, block, copies = (table.column(k).to_numpy() for k in (2, 3, 5))
            units = _unit(doubles(table.column(4), dims))
            cuts = np.flatnonzero((component[1:] != component[:-1]) | (pair[1:] != pair[:-1])) + 1
            sums = np.zeros(len(ids), dtype=np.int64)
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(ids)], strict=True):
                left = a + np.flatnonzero(block[a:b] == block[a])
                right = a + np.flatnonzero(block[a:b] != block[a])
                if len(right):
                    linked = units[left] @ units[right].T >= threshold
                    sums[left] = linked @ copies[right]
                    sums[right] = linked.T @ copies[left]
                elif pair[a] < 0:  # a block with itself
                    linked = units[left] @ units[left].T >= threshold
                    linked[np.arange(len(left)), np.arange(len(left))] = False
                    sums[left] = linked @ copies[left]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums)], names=["id", "n"])

    blocks = members.groupBy("component").agg(F.ceil(F.count("*") / MEMBERS).alias("blocks"))
    cut = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    pair = F.when(F.col("block") == F.col("other"), -1 - F.col("block")).otherwise(pair)
    cut = cut.select("component", pair.alias("pair"), "id", "block", "raw", "copies")
    cut = cut.repartition("component", "pair").sortWithinPartitions("component", "pair")
    return cut.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _pairs(lists: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the entries that may reach the threshold, each pair once."""
    pairs = lists.select("id", F.explode(F.arrays_zip("nbrs", "sims")).alias("e")).where(f"e.sims >= {threshold - SLACK}")
    return pairs.select(F.least("id", "e.nbrs").alias("a"), F.greatest("id", "e.nbrs").alias("b")).distinct()


def _full(lists: DataFrame, k: int, threshold: float) -> DataFrame:
    """Lists of k entries that all may reach the threshold, so that further ones may be left out."""
    return lists.where((F.size("nbrs") >= k) & (F.element_at("sims", -1) >= threshold - SLACK))


def _joined(
    lists: DataFrame, links: DataFrame, nodes: DataFrame, dims: int, scratch: Scratch, k: int, threshold: float
) -> DataFrame:
    """Components of the links and of those that full lists leave out.

    A link that neither of its ends lists has a full list at both. So the nodes with full lists look for
    neighbours once more, outside their component only, and those whose list is full again do so outside the
    components this has joined. A list full of links has joined its component with another, so the components that
    can still miss links at least halve each time.
    """
    components = scratch.write(connected_components(links, scratch), "components")
    inside = _full(lists, k, threshold).select("id", "code", F.col("nbrs").alias("inside"))
    while True:
        full = inside.join(components, "id").select("id", "code", "component", "inside")
        full = scratch.write(full, "full")
        count, apart = full.agg(F.count("*"), F.count_distinct("component")).first()
        if apart < 2:
            return components
        own = full.select("id", "component", "inside")
        outer = neighbour_graph(full.select("id", "code"), count, dims, scratch, k, trees=4, rounds=6, least_change=0.02, inner=own)
        more = scratch.write(_links(_pairs(outer, threshold), nodes, threshold), "links")
        if more.isEmpty():
            return components
        links = links.unionByName(more)
        components = scratch.write(connected_components(links, scratch), "components")
        again = _full(outer, k, threshold).select("id", F.col("nbrs").alias("beyond"))
        inside = full.join(again, "id").select("id", "code", F.concat(F.slice("inside", 1, k), F.slice("beyond", 1, k)).alias("inside"))


def _recall(nodes: DataFrame, components: DataFrame, threshold: float, dims: int) -> float:
    """Share of the links of a vector that lie inside its component, as a mean over those of a sample that have links.

    The sample meets every vector. Each vector counts the same, so a large group does not outweigh the others.
    """
    chosen = nodes.orderBy(F.xxhash64("id", F.lit("audit")), "id").limit(AUDIT).select("id", "raw").collect()
    sample = _unit(doubles(pa.array([bytes(r["raw"]) for r in chosen]), dims))
    own = np.array([r["id"] for r in chosen], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                i, j = np.nonzero(_unit(doubles(batch.column(1), dims)) @ sample.T >= threshold)
                ids = batch.column(0).to_numpy()[i]
                other = ids != own[j]
                yield pa.RecordBatch.from_arrays([pa.array(ids[other]), pa.array(own[j][other])], names=["a", "b"])

    true = nodes.select("id", "raw").mapInArrow(run, "a long, b long")
    a = components.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = components.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    met = F.coalesce(F.expr("CAST(ca = cb AS int)"), F.lit(0))
    each = true.join(a, "a", "left").join(b, "b", "left").groupBy("b").agg(F.avg(met).alias("met"))
    mean = each.agg(F.avg("met")).first()[0]
    return 1.0 if mean is None else mean


def embedding_near_duplicates(
    table: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = 0.9,
    k: int = 24,
    least_recall: float = 0.99,
) -> DataFrame:
    """Vectors linked by a cosine of `threshold` or more.

    Returns vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable)
    and kept (vec_id = component_id), one row per row of `table`, of which only the two named columns are read.
    Equal vectors are one node of the graph. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing; rows without an id have no component and are kept. If rows repeat an id,
    the smallest of their vectors counts for all. Shorter vectors count as ending in zeros. An empty
    table gives an empty result.

    A list of k entries that all reach the threshold is full: there may be more. Its node looks for neighbours
    outside its component until that list is not full, and the links of a component are counted in blocks, so no
    list grows with a group. An audit compares a bounded sample with every vector; while the sampled vectors have
    less than `least_recall` of their links in the found components on average, lists are doubled, and a
    RuntimeError is raised if that does not help.
    """
    scratch = Scratch(table.sparkSession, "embedding-dedup")
    rows = vectors(table, id_column, vector_column)
    rows = scratch.write(rows.groupBy("id").agg(F.min("raw").alias("raw")), "vectors")
    nodes = rows.groupBy("raw").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    nodes = scratch.write(nodes, "nodes")
    count, size = nodes.agg(F.count("*"), F.max(F.length("raw"))).first()
    dims = (size or 0) // 8
    codes = scratch.write(_codes(nodes, dims), "codes")
    components = None
    for attempt in range(4):
        size = k << attempt
        lists = neighbour_graph(codes, count, dims, scratch, size, trees=4, rounds=6, least_change=0.02)
        links = scratch.write(_links(_pairs(lists, threshold), nodes, threshold), "links")
        components = _joined(lists, links, nodes, dims, scratch, size, threshold)
        recall = _recall(nodes, components, threshold, dims) if count else 1.0
        if recall >= least_recall:
            break
    else:
        raise RuntimeError(f"an audit finds {recall:.3f} of the links with lists of {size}, less than {least_recall}")
    members = nodes.join(components, "id").select("component", "id", "raw", "copies")
    counts = _link_counts(members, threshold, dims)
    judged = nodes.join(components, "id", "left").join(counts, "id", "left").select(
        "raw", F.coalesce("component", "id").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    judged = rows.join(judged, "raw").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    out = table.select(F.col(id_column).cast("long").alias("vec_id")).join(judged, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
