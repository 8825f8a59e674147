"""Grouping of spelling variants: words one inserted, deleted or replaced code point apart, and the usual form of each.

The nodes of a trie of all words are numbered, and those of a trie of all reversed words. A word that is cut at a position is a pair
of integers: the node of what comes before and the node of what comes after. A pair stands for a text with one position left out:

* two words that share a pair after skipping one code point each differ by a replacement there;
* a word whose pair after a skip is the pair of an uncut split of another word is that word with one code point inserted.

So an exact join of integer pairs finds all neighbours. Pairs never have to be written out one against one: a pair of nodes holds at
most one word per letter of the alphabet and one shorter word, and every word needs only the size of its group and the best in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import Scratch

#: Distinct words that one task counts before it hands them on.
TASK_WORDS = 200_000
#: Code points of a text that are split into words at a time.
SLICE = 1 << 20
#: A trie node of up to this many code points is numbered by them; deeper ones are numbered by the task that holds their words.
SHALLOW = 4

#: One byte for each code point up to U+00FF: A-Z in lower case, a-z and U+00C0 to U+00FF as they are, all others end a word.
LETTER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256))


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text in Latin-1, in lists of bounded size (a longer word alone excepted)."""
    raw = text.encode("latin-1", "replace").translate(LETTER_BYTES) if text else b""
    at = 0
    while at < len(raw):
        end = at + SLICE
        if end < len(raw):
            blank = raw.find(b" ", end)
            end = len(raw) if blank < 0 else blank
        yield raw[at:end].split()
        at = end


def misspelt(word: bytes, state: int, every: int) -> bytes:
    """The word, or, if `every` divides its CRC (which goes on from `state`), the word without one code point."""
    digest = crc32(word if word.isascii() else word.decode("latin-1").encode(), state)
    if digest % every:
        return word
    at = digest % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(documents: DataFrame, least_length: int, least_count: int, every: int | None) -> DataFrame:
    """(word, n) of the distinct words of all texts, long and frequent enough."""

    def batch_of(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([word.decode("latin-1") for word in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                state = crc32(f"{doc_id.as_py()}:".encode()) if doc_id.is_valid else crc32(b":")
                for words in words_of(text.as_py()):
                    for word in words:
                        if len(word) >= least_length:
                            if every:
                                word = misspelt(word, state, every)
                                if len(word) < least_length:
                                    continue
                            counts[word] = counts.get(word, 0) + 1
                    if len(counts) >= TASK_WORDS:
                        yield batch_of(counts)
                        counts = {}
        yield batch_of(counts)

    rows = documents.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _number_nodes(words: DataFrame, key: str, out: str) -> DataFrame:
    """(id, n, `out`) with the trie nodes of all prefixes of `key`, from the empty one to the whole, as integers.

    Words are dealt by their first SHALLOW + 1 code points and sorted, so all words below a deeper node are neighbours in one task:
    a word takes over the nodes of what it shares with the word before it and numbers the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = (1 << 62) | (TaskContext.get().partitionId() << 42)
        before, nodes = "", [0]
        for batch in batches:
            flat, ends = [], [0]
            for word in batch.column(2):
                word = word.as_py()
                shared, most = 0, min(len(word), len(before))
                while shared < most and word[shared] == before[shared]:
                    shared += 1
                del nodes[shared + 1 :]
                for depth in range(shared + 1, len(word) + 1):
                    if depth <= SHALLOW:
                        nodes.append(nodes[-1] << 9 | ord(word[depth - 1]) + 1)
                    else:
                        nodes.append(fresh)
                        fresh += 1
                before = word
                flat += nodes
                ends.append(len(flat))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "n", out])

    dealt = words.select("id", "n", F.col(key).alias("key")).repartition(F.substring("key", 1, SHALLOW + 1))
    return dealt.sortWithinPartitions("key").mapInArrow(run, f"id long, n long, {out} array<long>")


def _run_starts(words: DataFrame) -> DataFrame:
    """(id, starts): for each code point of a word, whether the one before it is another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = [], [0]
            for word in batch.column(1):
                word = word.as_py()
                flat += [True, *(a != b for a, b in zip(word, word[1:]))]
                ends.append(len(flat))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "starts"])

    return words.select("id", "word").mapInArrow(run, "id long, starts array<boolean>")


_MEMBERS = "id long, n_near long, best_n long, best_id long"


def _best_in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each row's word by its group: rows sorted by pair; a pair that a batch cuts waits for the next one."""

    def settle(rows: list[np.ndarray]) -> pa.RecordBatch:
        before, after, skipped, first, n, word = rows
        order = np.lexsort((word, -n, after, before))
        before, after, skipped, first, n, word = (x[order] for x in (before, after, skipped, first, n, word))
        size = len(word)
        start = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | (after[1:] != after[:-1])])
        group = np.cumsum(np.r_[False, (before[1:] != before[:-1]) | (after[1:] != after[:-1])])
        groups, nobody = len(start), size

        def foremost(chosen: np.ndarray) -> np.ndarray:
            """Place of the first chosen row of each group; rows of a group go by frequency, then by word."""
            place = np.full(groups, nobody)
            np.minimum.at(place, group[chosen], np.flatnonzero(chosen))
            return place

        rows_skipped = np.bincount(group[skipped], minlength=groups)
        rows_longer = np.bincount(group[skipped & first], minlength=groups)
        best = foremost(skipped)
        is_best = np.zeros(size + 1, dtype=bool)
        is_best[best] = True
        second = foremost(skipped & ~is_best[:size])
        longer, whole = foremost(skipped & first), foremost(~skipped)

        other = np.where(skipped, np.where(is_best[:size], second[group], best[group]), longer[group])
        count = np.where(skipped, rows_skipped[group] - 1, rows_longer[group])
        shorter = np.where(skipped & first, whole[group], nobody)
        count = count + (shorter < nobody)
        n_of, word_of = np.r_[n, -1], np.r_[word, -1]
        near = np.minimum(other, shorter)  # the smaller place is the better word
        kept = count > 0
        found = (word[kept], count[kept], n_of[near[kept]], word_of[near[kept]])
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["id", "n_near", "best_n", "best_id"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        rows = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
        if held is not None:
            rows = [np.concatenate(pair) for pair in zip(held, rows)]
        if not len(rows[0]):
            continue
        last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
        held = [x[last] for x in rows]
        if not last.all():
            yield settle([x[~last] for x in rows])
    if held is not None:
        yield settle(held)


def near_words(scratch: Scratch, words: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best_id) of the words of (id, word, n) that have a near word; ids are in the order of words."""
    forward = _number_nodes(words, "word", "ahead")
    backward = _number_nodes(words.withColumn("mirrored", F.reverse("word")), "mirrored", "behind").drop("n")
    nodes = scratch.write(forward.join(backward, "id").join(_run_starts(words), "id"), "nodes")

    # ahead[i] is the node of the first i code points; behind, turned round, has the node of all that come after the first i.
    size = F.size("starts")
    ahead, rest = F.col("ahead"), F.reverse("behind")
    skip = F.arrays_zip(F.slice(ahead, F.lit(1), size).alias("before"), F.slice(rest, F.lit(2), size).alias("after"), F.col("starts").alias("first"))
    split = F.arrays_zip(ahead.alias("before"), rest.alias("after"))
    skips = nodes.select("id", "n", F.inline(skip).alias("before", "after", "first"))
    splits = nodes.select("id", "n", F.inline(split).alias("before", "after")).withColumn("first", F.lit(False))
    # Skipping any code point of a run of equal ones leaves the same text; `first` marks the one that stands for the run.
    skips = skips.select("before", "after", F.lit(True).alias("skipped"), "first", "n", "id")
    splits = splits.select("before", "after", F.lit(False).alias("skipped"), "first", "n", "id")
    pairs = skips.unionByName(splits).repartition("before", "after").sortWithinPartitions("before", "after")
    members = pairs.mapInArrow(_best_in_groups, _MEMBERS)
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("place"))).alias("best")
    found = members.groupBy("id").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.place")).alias("best_id"))


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(id, root) of the words with a form: the end of the chain of forms.

    Frequencies at least double from form to form, so a chain of forms is short and has no circle; each round doubles the steps taken.
    """
    chain = scratch.write(forms.select("id", F.col("form_id").alias("root")), "chain")
    while True:
        ahead = chain.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        longer = chain.join(ahead, "root", "left")
        stepped = scratch.write(longer.select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "chain")
        if stepped.where("moved").isEmpty():
            return stepped.select("id", "root")
        scratch.drop(chain)
        chain = stepped.drop("moved")
        chain.scratch_path = stepped.scratch_path


def spelling_variants(
    documents: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2, misspell_every: int | None = None
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with its count, near words and usual form.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF in whole texts, A-Z in lower case, of `least_length` code points and
    `least_count` occurrences. Two words are near if one inserted, deleted or replaced code point makes one the other. A word's
    form is its most frequent near word, the first in code-point order among equals, if that is `ratio` times as frequent; `root` ends the
    chain of forms and is the word itself without one.

    `misspell_every` plants misspellings: an occurrence loses the code point h % length if the CRC-32 h of `<doc_id>:<word>` is
    divisible by it. Null and empty texts have no words; a row without a doc_id counts with an empty one. Repeated rows are counted
    each. No words give an empty result. Other columns are not looked at.
    """
    scratch = Scratch(documents.sparkSession, "spelling")
    counted = scratch.write(word_counts(documents, least_length, least_count, misspell_every), "counts")
    # Sorted over all tasks, so that ids compare as the words do.
    words = scratch.write(counted.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "words")
    near = scratch.write(near_words(scratch, words), "near")
    usual = words.join(near, "id", "left").withColumn("form_id", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_id")))
    usual = scratch.write(usual, "usual")
    roots = _roots(scratch, usual.where("form_id IS NOT NULL"))
    name = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root_name = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    out = usual.join(roots, "id", "left").join(name, "form_id", "left").join(root_name, "root", "left")
    return out.select(
        "word",
        "form",
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )
