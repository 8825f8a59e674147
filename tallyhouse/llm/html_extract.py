"""Main text of HTML pages: a bidirectional LSTM labels every block from its tag path and its words, with the whole page as context."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import lstm
from tallyhouse.llm.html_blocks import Page
from tallyhouse.llm.html_training import MARK, labelled_pages

#: Training: pages that the layouts give, sequences at a time, rounds.
TRAIN_PAGES, TRAIN_BATCH, EPOCHS, SEED = 6000, 64, 7, 12
NUMBERS = 7
#: Cells (pages times the longest one's blocks) that are labelled at a time; a longer page is labelled in pieces of that many blocks.
CELLS = 8192
CACHED = 100_000


@lru_cache(maxsize=CACHED)
def _path_id(token: str) -> int:
    return crc32(token.encode("utf-8", "surrogatepass")) % lstm.PATHS


@lru_cache(maxsize=CACHED)
def _word_id(word: str) -> int:
    return crc32(word.encode("utf-8", "surrogatepass")) % lstm.WORDS


def word_ids(text: str) -> list[int]:
    """Hashes of all words of a block, in lower case and without marks around them; never empty."""
    return [_word_id(word) if len(word) < 64 else crc32(word.encode("utf-8", "surrogatepass")) % lstm.WORDS for word in text.lower().split()] or [0]


def _numbers(page: Page, first: int, last: int) -> np.ndarray:
    """Plain inputs of blocks: length, share of links, sentence marks, digits, place in the page, one."""
    out, size = np.empty((last - first, NUMBERS), np.float32), len(page.texts)
    for row, k in enumerate(range(first, last)):
        text = page.texts[k]
        marks = sum(map(text.count, ".!?,;"))
        out[row] = (
            math.log1p(min(len(text), 1000)) / 6,
            page.linked[k] / len(text),
            min(1.0, 12 * marks / len(text)),
            float(text[-1] in ".!?\"”»…"),
            min(1.0, 3 * sum(map(text.count, "0123456789")) / len(text)),
            k / size,
            1.0,
        )
    return out


def _training_sequence(html: str):
    """Ids of path tokens and words, numbers and labels of a page's blocks; the marks themselves are left out."""
    page = Page(html)
    paths, labels = [], []
    for node in page.paths:
        ids, label = [], None
        while node >= 0:
            parent, tokens = page.nodes[node]
            marks = [token for token in tokens if token.startswith("label ")]
            label = label or (marks[0] if marks else None)
            if MARK not in tokens:
                ids += [_path_id(token) for token in tokens if not token.startswith("label ")]
            node = parent
        paths.append(ids or [0])
        labels.append(label == "label main")
    return paths, [word_ids(text) for text in page.texts], _numbers(page, 0, len(page.texts)), np.array(labels)


def train_labeller(pages: Iterable[str] | None = None, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Weights learnt from pages whose article stands below `data-label="main"`, by default TRAIN_PAGES generated ones.

    It runs on the driver over pages that the caller bounds; what it gives has a fixed size.
    """
    sequences = [s for s in map(_training_sequence, pages or labelled_pages(TRAIN_PAGES, SEED)) if s[0]]
    order = sorted(range(len(sequences)), key=lambda k: len(sequences[k][0]))
    groups = [order[k : k + TRAIN_BATCH] for k in range(0, len(order), TRAIN_BATCH)]
    np.random.default_rng(SEED).shuffle(groups)
    batches = [lstm.Sequences([sequences[k] for k in group]) for group in groups]
    weights = lstm.initial(NUMBERS, SEED)
    lstm.train(weights, batches, epochs)
    return weights


class Labeller:
    """Labels the blocks of pages with trained weights."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights
        self._sums: dict[tuple[str, ...], np.ndarray] = {}

    def _own(self, tokens: tuple[str, ...]) -> np.ndarray:
        found = self._sums.get(tokens)
        if found is None:
            if len(self._sums) >= CACHED:
                self._sums.clear()
            ids = [_path_id(token) for token in tokens if not token.startswith("label ")]
            found = self._sums[tokens] = self.weights["path"][ids].sum(0)
        return found

    def _path_sums(self, page: Page) -> np.ndarray:
        """Sum over the path of each node: its parent's and its own; a parent comes before its children."""
        sums = np.zeros((len(page.nodes), lstm.PATH_DIM), np.float32)
        for k in range(1, len(page.nodes)):
            parent, tokens = page.nodes[k]
            sums[k] = sums[parent] + self._own(tokens)
        sums[0] = self.weights["path"][0]  # a block outside any element
        return sums

    def _rows(self, page: Page, sums: np.ndarray, first: int, last: int) -> np.ndarray:
        ids = [word_ids(text) for text in page.texts[first:last]]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate([np.array(x) for x in ids])
        words = lstm.pooled(self.weights["word"], flat, np.cumsum(sizes) - sizes) / sizes[:, None]
        paths = np.tanh(sums[page.paths[first:last]])
        return np.concatenate([paths, words.astype(np.float32), _numbers(page, first, last)], axis=1)

    def _long(self, page: Page) -> np.ndarray:
        """Logits of one long page, piece by piece, each direction going on from the state of the piece before."""
        sums, size = self._path_sums(page), len(page.texts)
        logits = np.zeros(size, np.float32)
        edges = [(k, min(size, k + CELLS)) for k in range(0, size, CELLS)]
        for way, pieces in (("ahead", edges), ("back", edges[::-1])):
            state = None
            for first, last in pieces:
                rows = self._rows(page, sums, first, last)
                if way == "ahead":
                    logits[first:last] += rows @ self.weights["direct"] + self.weights["bias"]
                x = (rows if way == "ahead" else rows[::-1])[:, None, :]
                part, state = lstm.run_direction(self.weights, way, x, np.ones((last - first, 1), bool), state)
                logits[first:last] += part[:, 0] if way == "ahead" else part[::-1, 0]
        return logits

    def _together(self, pages: list[Page]) -> list[np.ndarray]:
        rows = [self._rows(page, self._path_sums(page), 0, len(page.texts)) for page in pages]
        time = max(map(len, rows))
        x = np.zeros((time, len(pages), rows[0].shape[1]), np.float32)
        mask = np.zeros((time, len(pages)), bool)
        for k, own in enumerate(rows):
            x[: len(own), k] = own
            mask[: len(own), k] = True
        ahead, _ = lstm.run_direction(self.weights, "ahead", x, mask)
        back, _ = lstm.run_direction(self.weights, "back", x[::-1], mask[::-1])
        logits = ahead + back[::-1] + x @ self.weights["direct"] + self.weights["bias"]
        return [logits[: len(own), k] for k, own in enumerate(rows)]

    def main_blocks(self, pages: list[Page]) -> list[np.ndarray]:
        """For each page, which of its blocks are the article."""
        found: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k].texts), key=lambda k: len(pages[k].texts))
        group: list[int] = []
        for place, k in enumerate(order):
            size = len(pages[k].texts)
            if size > CELLS:
                found[k] = self._long(pages[k]) > 0
                continue
            group.append(k)
            following = len(pages[order[place + 1]].texts) if place + 1 < len(order) else 0
            if not following or following * (len(group) + 1) > CELLS:
                for at, logits in zip(group, self._together([pages[at] for at in group])):
                    found[at] = logits > 0
                group = []
        return found


def main_text(page: Page, chosen: np.ndarray) -> str:
    return " ".join(text for text, main in zip(page.texts, chosen) if main)


#: Bytes of HTML whose blocks are held at a time.
HELD = 16 << 20


def extract_main_text(pages: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) per row: the article of the whole page, blocks in order with one space between.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup and reader comments are left out, as far as
    the labeller tells them apart. Character references are decoded, white space inside a block is one space.

    Null and empty pages and pages without text have an empty text. Rows come back as they are, repeated ones and ones without page_id or url
    too; an empty table gives an empty result. Other columns are not looked at.
    """
    model = pages.sparkSession.sparkContext.broadcast(weights or train_labeller())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model.value)
        for batch in batches:
            texts: list[str] = []
            held: list[Page] = []
            size = 0
            for html in batch.column(2):
                html = html.as_py()
                held.append(Page(html))
                size += len(html or "")
                if size >= HELD:
                    texts += map(main_text, held, labeller.main_blocks(held))
                    held, size = [], 0
            texts += map(main_text, held, labeller.main_blocks(held))
            counts = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts], names=["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
