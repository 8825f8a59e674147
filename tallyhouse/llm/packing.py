"""Bounded-space online packing of token ids into sequences.

Each partition keeps a fixed number of open sequences. A document's whole sequences leave at once, and the
rest goes where it fits best; if it fits nowhere, the fullest sequence is filled up with its front and leaves. At the
end of a partition the open sequences are run together, which leaves less than one. These leftovers meet
in groups until one is left; it becomes sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.byte_bpe import byte_bpe
from tallyhouse.llm.scratch import Scratch

END = (1).to_bytes(4, "little")
#: Partitions whose leftovers meet in one group.
FANOUT = 32
#: A sequence_id is made of the level of the group that closed it, the group and a count.
LEVEL_BITS, GROUP_BITS = 58, 26
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, node long, place long"
_NAMES = [part.split()[0] for part in _PIECES.split(", ")]
_TYPES = [pa.binary() if part.endswith("binary") else pa.int64() for part in _PIECES.split(", ")]


class Packer:
    """Places pieces (doc_id, start, doc_tokens, ids) and gathers the rows of closed sequences."""

    def __init__(self, level: int, node: int, window: int, slots: int, keep_ids: bool):
        self.base = (level << LEVEL_BITS) + (node << GROUP_BITS)
        self.node, self.window, self.slots, self.keep_ids = node, window, slots, keep_ids
        self.closed = 0
        self.open: list[tuple[int, list]] = []
        self.rows: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        sequence, offset = self.base + self.closed, 0
        self.closed += 1
        for doc_id, start, doc_tokens, ids in pieces:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, zlib.crc32(ids), doc_tokens, sequence, offset, ids if self.keep_ids else None, None, None))
            offset += length

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, size, at = len(ids) // 4, self.window, 0
        while total - at >= size:
            self.close([(doc_id, at, total, ids[4 * at : 4 * (at + size)])])
            at += size
        while at < total:
            rest = total - at
            fits = [k for k, (used, _) in enumerate(self.open) if used + rest <= size]
            if not fits and len(self.open) < self.slots:
                self.open.append((0, []))
                fits = [len(self.open) - 1]
            k = max(fits, key=lambda k: self.open[k][0]) if fits else max(range(len(self.open)), key=lambda k: self.open[k][0])
            used, pieces = self.open[k]
            taken = min(rest, size - used)
            pieces.append((doc_id, at, total, ids[4 * at : 4 * (at + taken)]))
            at += taken
            if used + taken == size:
                self.close(pieces)
                del self.open[k]
            else:
                self.open[k] = (used + taken, pieces)

    def finish(self) -> None:
        """Run the open sequences together, and put what is left of less than one into rows without a sequence."""
        pieces = [piece for _, own in sorted(self.open, key=lambda x: -x[0]) for piece in own]
        self.open = []
        for k, (doc_id, start, doc_tokens, ids) in enumerate(self.merged(pieces)):
            row = (doc_id, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, None, None, ids, self.node, k)
            self.rows.append(row)

    def merged(self, pieces: list[tuple]) -> list[tuple]:
        held, used = [], 0
        for doc_id, start, doc_tokens, ids in pieces:
            while ids:
                part = ids[: 4 * (self.window - used)]
                held.append((doc_id, start, doc_tokens, part))
                start, used, ids = start + len(part) // 4, used + len(part) // 4, ids[len(part) :]
                if used == self.window:
                    self.close(held)
                    held, used = [], 0
        return held

    def finish_in_powers(self, pieces: list[tuple]) -> None:
        """Close everything: whole sequences, and the last ids in powers of two, the largest first."""
        held = self.merged(pieces)
        left = sum(len(ids) // 4 for *_, ids in held)
        while left:
            whole, self.window = self.window, 1 << (left.bit_length() - 1)
            held, self.window = self.merged(held), whole
            left = sum(len(ids) // 4 for *_, ids in held)

    def taken(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(_NAMES)
        out = pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, _TYPES, strict=True)], names=_NAMES)
        self.rows = []
        return out


def pack_documents(documents: DataFrame, tokenizer: str, window: int = 2048, slots: int = 16, keep_ids: bool = False) -> DataFrame:
    """Pieces of documents and their places in sequences of at most `window` ids.

    `tokenizer` is the path of a byte-level BPE file that every machine has. A document's ids are those of its
    text and then id 1; a null or empty text has that id only. Returns one row per piece: doc_id, start (its
    document's ids before it), length, ids_crc32, doc_tokens, sequence_id, offset (in its sequence), and ids (unsigned
    32-bit, little-endian) if `keep_ids` is set. Only doc_id and text are read. Repeated rows and rows without
    a doc_id are packed as they come, each as a document of its own. An empty table gives an empty result.

    Documents are not shuffled. What partitions leave over, less than one sequence each, is all that moves.
    """
    scratch = Scratch(documents.sparkSession, "packing")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer)
        packer = Packer(0, TaskContext.get().partitionId(), window, slots, keep_ids)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, encoder.ids(text.as_py() or "") + END)
                if len(packer.rows) >= 4096:
                    yield packer.taken()
        packer.finish()
        yield packer.taken()

    def merging(level: int, last: bool):
        def run(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by([("node", "ascending"), ("place", "ascending")])
            packer = Packer(level, rows.column("node")[0].as_py() // FANOUT, window, slots, keep_ids)
            pieces = list(zip(*(rows.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True))
            if last:
                packer.finish_in_powers(pieces)
            else:
                packer.open = [(0, pieces)]
                packer.finish()
            return pa.Table.from_batches([packer.taken()])

        return run

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    placed = scratch.write(rows.mapInArrow(run, _PIECES), "pieces")
    parts, level = [placed.where("sequence_id IS NOT NULL")], 0
    left = placed.where("sequence_id IS NULL")
    nodes = (left.agg(F.max("node")).first()[0] or 0) + 1
    while True:
        level, nodes = level + 1, -(-nodes // FANOUT)
        merged = left.groupBy(F.floor(F.col("node") / FANOUT)).applyInArrow(merging(level, nodes == 1), _PIECES)
        merged = scratch.write(merged, "merged")
        parts.append(merged.where("sequence_id IS NOT NULL"))
        if nodes == 1:
            break
        left = merged.where("sequence_id IS NULL")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("node", "place") if keep_ids else out.drop("node", "place", "ids")
