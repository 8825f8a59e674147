"""NN-descent: a neighbour graph refined by joins of neighbours of neighbours.

The graph starts from exact neighbours inside small cells of random hyperplanes. In each round every vector
hands its neighbours, and those that list it, to one another: the members around a node are joined
by one small matrix product, and pairs that beat a member's weakest entry become candidates of that
member. Only pairs with an entry that is new since the last round are looked at. Rounds end when hardly
any list changes.

What travels is a one-byte-per-dimension code of the unit vector, so similarities inside the graph are good to about
0.002; results are computed again on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import Scratch

#: Members joined at once around one node, and vectors compared at once in a cell; beyond, they are split.
BLOCK = 256
LISTS = "id long, code binary, nbrs array<long>, sims array<float>, fresh array<boolean>"
CANDIDATES = "id long, code binary, nbrs array<long>, sims array<float>, old boolean"


def vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, raw): the usable rows, raw being the doubles of the vector in bytes.

    Null ids and vectors that are null, empty, zero or hold null or non-finite components are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raws = [], []
            for one, vector in zip(batch.column(0), batch.column(1), strict=True):
                found = vector.values if one.is_valid and vector.is_valid else None
                if found is not None and len(found) and not found.null_count:
                    x = found.to_numpy(zero_copy_only=False)
                    if np.isfinite(x).all() and x.any():
                        ids.append(one.as_py())
                        raws.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raws, pa.binary())], names=["id", "raw"])

    rows = table.select(F.col(id_column).cast("long"), F.col(vector_column).cast("array<double>"))
    return rows.mapInArrow(run, "id long, raw binary")


def doubles(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of raw bytes as a matrix; shorter vectors end in zeros."""
    rows = [np.frombuffer(x, dtype=np.float64) for x in column.to_pylist()]
    width = width or max((len(x) for x in rows), default=0)
    out = np.zeros((len(rows), width))
    for k, x in enumerate(rows):
        out[k, : len(x)] = x
    return out


def encode(units: np.ndarray) -> list[bytes]:
    """A scale and one signed byte per dimension for each unit vector."""
    scale = np.abs(units).max(axis=1, keepdims=True) / 127
    whole = np.rint(units / scale).astype(np.int8)
    return [s.tobytes() + w.tobytes() for s, w in zip(scale.astype(np.float32), whole, strict=True)]


def decode(codes: list[bytes]) -> np.ndarray:
    """Unit vectors from codes, as float32."""
    both = np.frombuffer(b"".join(codes), dtype=np.int8).reshape(len(codes), -1)
    return both[:, 4:].astype(np.float32) * np.ascontiguousarray(both[:, :4]).view(np.float32)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, least: int = 8192) -> Iterator[pa.Table]:
    """Tables of about `least` rows or more that never cut a group; rows come sorted by the first `keys` columns."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if rows >= least:
            same = np.ones(batch.num_rows, dtype=bool)
            for k in range(keys):
                last = held[-1].column(k)[-1].as_py()
                same &= batch.column(k).to_numpy(zero_copy_only=False) == last
            cut = int(np.argmin(same)) if not same.all() else batch.num_rows
            if cut:
                held.append(batch.slice(0, cut))
            if cut < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, rows, batch = [], 0, batch.slice(cut)
            else:
                continue
        held.append(batch)
        rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def best(ids: np.ndarray, nbrs: np.ndarray, sims: np.ndarray, old: np.ndarray, k: int):
    """The k best distinct neighbours of each id, sorted by id and falling similarity; a known entry stays old."""
    order = np.lexsort((~old, nbrs, ids))
    ids, nbrs, sims, old = ids[order], nbrs[order], sims[order], old[order]
    first = np.ones(len(ids), dtype=bool)
    first[1:] = (ids[1:] != ids[:-1]) | (nbrs[1:] != nbrs[:-1])
    ids, nbrs, sims, old = ids[first], nbrs[first], sims[first], old[first]
    order = np.lexsort((nbrs, -sims, ids))
    ids, nbrs, sims, old = ids[order], nbrs[order], sims[order], old[order]
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(ids)) - np.repeat(starts, np.diff(np.r_[starts, len(ids)]))
    kept = rank < k
    return ids[kept], nbrs[kept], sims[kept], old[kept]


def _lists(ids: np.ndarray, nbrs: np.ndarray, sims: np.ndarray):
    """Runs of one id as lists: ids, and offsets into the entries."""
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, dtype=np.int64)
    offsets = pa.array(np.r_[starts, len(ids)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (nbrs, sims)]
    return ids[starts], offsets, lists


def _candidates(ids: np.ndarray, nbrs: np.ndarray, sims: np.ndarray, k: int) -> pa.RecordBatch:
    ids, nbrs, sims, _ = best(ids, nbrs, sims.astype(np.float32), np.zeros(len(ids), dtype=bool), k)
    own, _, lists = _lists(ids, nbrs, sims)
    n = len(own)
    return pa.RecordBatch.from_arrays(
        [pa.array(own), pa.nulls(n, pa.binary()), *lists, pa.array(np.zeros(n, dtype=bool))],
        names=["id", "code", "nbrs", "sims", "old"],
    )


def _cells(codes: DataFrame, trees: int, bits: int, dims: int) -> DataFrame:
    """(tree, cell, id, code): the signs of `bits` random projections name a vector's cell in each tree."""
    planes = np.random.default_rng(7).standard_normal((dims, max(1, trees * bits))).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.int64(1) << np.arange(bits, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                signs = (decode(batch.column(1).to_pylist()) @ planes > 0).reshape(-1, planes.shape[1])
                for tree in range(trees):
                    cell = signs[:, tree * bits : (tree + 1) * bits].astype(np.int64) @ weights
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(cell), tree, dtype=np.int32)), pa.array(cell), batch.column(0), batch.column(1)],
                        names=["tree", "cell", "id", "code"],
                    )

    return codes.mapInArrow(run, "tree int, cell long, id long, code binary")


def _in_groups(k: int, limit_column: bool) -> Callable:
    """The join of the members of each group; rows are (group, part, id, code[, limit, fresh[, component]]).

    Members of one component are not joined with one another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 2):
            group = table.column(0).to_numpy()
            part = table.column(1).to_numpy()
            ids = table.column(2).to_numpy()
            units = decode(table.column(3).to_pylist())
            limits = table.column(4).to_numpy() if limit_column else np.full(len(ids), -2, dtype=np.float32)
            fresh = table.column(5).to_numpy() if limit_column else np.ones(len(ids), dtype=bool)
            apart = table.column(6).to_numpy() if table.num_columns > 6 else ids
            cuts = np.flatnonzero((group[1:] != group[:-1]) | (part[1:] != part[:-1])) + 1
            found: list[tuple] = []
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(ids)], strict=True):
                for at in range(a, b, 2 * BLOCK):  # parts are about BLOCK rows; chance may make one larger
                    rows = slice(at, min(at + 2 * BLOCK, b))
                    own, new, low = ids[rows], fresh[rows], limits[rows]
                    if len(own) < 2 or not new.any():
                        continue
                    sims = units[rows] @ units[rows].T
                    sims[apart[rows][:, None] == apart[rows][None, :]] = -3
                    if len(own) > k + 1:  # no more than k from here can enter a list
                        low = np.maximum(low, np.partition(sims, len(own) - k, axis=1)[:, len(own) - k] - 1e-7)
                    i, j = np.nonzero((sims > low[:, None]) & (new[:, None] | new[None, :]))
                    found.append((own[i], own[j], sims[i, j]))
            if found:
                yield _candidates(*(np.concatenate(x) for x in zip(*found, strict=True)), k)

    return run


def _merged(k: int) -> Callable:
    """Old lists and candidates of each id as its new list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 1, 2048):
            table = table.combine_chunks()
            rows = table.column(0).to_numpy()
            lists = table.column(2).chunk(0)
            sizes = np.diff(lists.offsets.to_numpy())
            old = np.repeat(table.column(4).to_numpy(), sizes)
            ids, nbrs, sims, old = best(
                np.repeat(rows, sizes), lists.flatten().to_numpy(), table.column(3).chunk(0).flatten().to_numpy(), old, k
            )
            own = rows[np.r_[True, rows[1:] != rows[:-1]]]
            offsets = pa.array(np.searchsorted(ids, np.r_[own, np.iinfo(np.int64).max]).astype(np.int32))
            codes = table.column(1).drop_null()
            out = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (nbrs, sims, ~old)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), codes.combine_chunks(), *out], names=["id", "code", "nbrs", "sims", "fresh"]
            )

    return run


def _merge(own: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    both = own.unionByName(candidates)
    return both.repartition("id").sortWithinPartitions("id", F.col("old").desc()).mapInArrow(_merged(k), LISTS)


def _parts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A column part that splits a group of more than BLOCK rows by a hash of the member."""
    large = rows.groupBy(keys).agg(F.count("*").alias("n")).where(f"n > {BLOCK}")
    parts = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1))
    return rows.join(large, keys, "left").withColumn("part", F.pmod(F.xxhash64("id", *keys), parts)).drop("n")


def neighbour_graph(
    codes: DataFrame,
    count: int,
    dims: int,
    scratch: Scratch,
    k: int,
    trees: int = 3,
    rounds: int = 10,
    least_change: float = 0.01,
    inner: DataFrame | None = None,
) -> DataFrame:
    """(id, code, nbrs, sims, fresh): for each code its k nearest by cosine, nearest first.

    `codes` has distinct ids and their codes, `count` of them with `dims` dimensions. Rounds stop at
    `rounds`, or once no more than the share `least_change` of all entries is new.

    With `inner`, (id, component, inside) for each code, members of the own component enter no list. As
    neighbours of neighbours would then lie on one's own side again, the ids of `inside`, near ones of the own
    component, join around a node too.
    """
    around_columns = ["node", "part", "id", "code", "limit", "fresh"]
    own = codes.selectExpr("id", "code", "CAST(array() AS array<long>) AS nbrs", "CAST(array() AS array<float>) AS sims", "true AS old")
    bits = max(0, math.ceil(math.log2(max(1, count) / (BLOCK / 2))))
    cells = _parts(_cells(codes, trees, bits, dims), ["tree", "cell"])
    cells = cells.select(F.xxhash64("tree", "cell").alias("group"), "part", "id", "code")
    if inner is not None:
        around_columns.append("component")
        free = cells.withColumn("limit", F.lit(-2.0).cast("float")).withColumn("fresh", F.lit(True))
        cells = free.join(inner.select("id", "component"), "id").select("group", *around_columns[1:])
    cells = cells.repartition("group", "part").sortWithinPartitions("group", "part")
    lists = scratch.write(_merge(own, cells.mapInArrow(_in_groups(k, inner is not None), CANDIDATES), k), "lists")
    for _ in range(rounds):
        weakest = F.when(F.size("nbrs") < k, F.lit(-2.0)).otherwise(F.element_at("sims", -1)).cast("float")
        states = lists.select("id", "code", weakest.alias("limit"))
        entries = lists.select("id", "code", weakest.alias("limit"), F.explode(F.arrays_zip("nbrs", "fresh")).alias("e"))
        listing = entries.select(F.col("e.nbrs").alias("node"), "id", "code", "limit", F.col("e.fresh").alias("fresh"))
        listed = entries.select(F.col("id").alias("node"), F.col("e.nbrs").alias("id"), F.col("e.fresh").alias("fresh"))
        listed = listed.join(states, "id").select("node", "id", "code", "limit", "fresh")
        members = listing.unionByName(listed)
        if inner is not None:
            near = inner.select(F.col("id").alias("node"), F.explode("inside").alias("id"))
            near = near.join(states, "id").select("node", "id", "code", "limit", F.lit(False).alias("fresh"))
            members = members.unionByName(near).join(inner.select("id", "component"), "id")
        around = _parts(members, ["node"]).select(around_columns)
        around = around.repartition("node", "part").sortWithinPartitions("node", "part")
        found = around.mapInArrow(_in_groups(k, True), CANDIDATES)
        known = lists.select("id", "code", "nbrs", "sims", F.lit(True).alias("old"))
        before, lists = lists, scratch.write(_merge(known, found, k), "lists")
        scratch.drop(before)
        fresh = F.size(F.filter("fresh", lambda x: x))
        changed, total = lists.agg(F.sum(fresh), F.sum(F.size("nbrs"))).first()
        if not total or changed <= least_change * total:
            break
    return lists
