"""Counts of greedy word pieces by a linear longest-match automaton.

The trie holds the vocabulary's byte strings. Where a word leaves the trie, a failure link says which node stands for
the rest of what was read, and how many pieces the greedy match has finished on the way there is known from the
start. So each byte is looked at once, nothing is read twice, and no piece is ever built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.byte_bpe import vocabulary

#: Counts of words remembered by one Python worker before it starts anew, and the longest such word in bytes.
CACHE_WORDS, CACHE_LENGTH = 500_000, 64


class LongestMatch(dict):
    """Word (with the space before it) to its number of pieces; every single byte has to be a piece."""

    def __init__(self, pieces: Iterable[bytes]):
        super().__init__()
        pieces = set(pieces)
        missing = [b for b in range(256) if bytes([b]) not in pieces]
        if missing:
            raise ValueError(f"no piece for the bytes {missing[:8]}: the greedy match could fail")
        self.next: dict[int, int] = {}  # node * 256 + byte -> node
        ends, children = [False], [[]]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                if key not in self.next:
                    self.next[key] = len(ends)
                    children[node].append((byte, len(ends)))
                    ends.append(False)
                    children.append([])
                node = self.next[key]
            ends[node] = bool(piece)
        self.link = [0] * len(ends)
        self.popped = [0] * len(ends)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in children[parent]:
                queue.append(node)
                if ends[node]:
                    self.popped[node] = 1  # a whole piece; the rest starts at the root
                    continue
                at, count = self.link[parent], self.popped[parent]
                while (at << 8 | byte) not in self.next:
                    count += self.popped[at]
                    at = self.link[at]
                self.link[node], self.popped[node] = self.next[at << 8 | byte], count

    def count(self, word: bytes) -> int:
        """Number of pieces of a byte string."""
        node, count = 0, 0
        step, link, popped = self.next, self.link, self.popped
        for byte in word:
            while (key := node << 8 | byte) not in step:
                count += popped[node]
                node = link[node]
            node = step[key]
        while node:
            count += popped[node]
            node = link[node]
        return count

    def __missing__(self, word: bytes) -> int:
        found = self.count(b" " + word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found


_loaded: dict[str, LongestMatch] = {}


def longest_match(path: str) -> LongestMatch:
    """The automaton of a vocabulary file, built once by each Python worker."""
    if path not in _loaded:
        _loaded[path] = LongestMatch(vocabulary(path))
    return _loaded[path]


def token_counts(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) per row: greedy longest-match pieces of whole texts.

    `tokenizer` is the path of a byte-level vocabulary that every machine has. Words are runs of bytes other than
    space and \\x09-\\x0D; each is matched with the space before it, as the vocabulary writes pieces that begin a word, and
    white space counts for nothing else. Null, empty and blank texts have no tokens. Rows come back as
    they are, repeated ones and ones without a doc_id too. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = longest_match(tokenizer)
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1):
                own = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                words.append(len(own))
                tokens.append(sum(map(pieces.__getitem__, own)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"]
            )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
