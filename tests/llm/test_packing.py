import zlib

import pytest
from tokenizers import Tokenizer

from tallyhouse.llm.byte_bpe import byte_bpe
from tallyhouse.llm.packing import pack_documents
from tallyhouse.llm.queries import op6_packing, tokenizer_path


def encoded(text):
    raw = byte_bpe(tokenizer_path()).ids(text or "") + (1).to_bytes(4, "little")
    return [raw[k : k + 4] for k in range(0, len(raw), 4)]


def check(pieces, docs, window):
    """Every id in one piece, pieces without gaps in documents and in sequences; returns the padding."""
    held, sequences = {}, {}
    for p in pieces:
        held.setdefault(p.doc_id, []).append((p.start, p.length, p.ids_crc32, p.doc_tokens))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert held.keys() == docs.keys()
    for doc_id, text in docs.items():
        ids, at = encoded(text), 0
        for start, length, crc, total in sorted(held[doc_id]):
            assert start == at and length > 0 and total == len(ids) and crc == zlib.crc32(b"".join(ids[start : start + length]))
            at += length
        assert at == len(ids)
    padding = 0
    for rows in sequences.values():
        used = 0
        for offset, length in sorted(rows):
            assert offset == used
            used += length
        assert used <= window
        padding += 0 if used & (used - 1) == 0 else window - used
    return padding


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert check(op6_packing(spark, sf).collect(), docs, 2048) == 0


def test_many_partitions_and_levels(spark):
    docs = {k: "word " * (k % 37) for k in range(700)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(70, "doc_id")
    pieces = pack_documents(df, tokenizer_path(), window=64, slots=3, keep_ids=True).collect()
    assert check(pieces, docs, 64) == 0
    assert len({p.sequence_id >> 58 for p in pieces}) >= 2
    assert all(zlib.crc32(bytes(p.ids)) == p.ids_crc32 for p in pieces)


def test_few_documents_are_cut_when_they_fit(spark):
    docs = {k: "word " * 20 for k in range(200)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").coalesce(1)
    pieces = pack_documents(df, tokenizer_path(), window=100, slots=4).collect()
    assert len(pieces) < 1.35 * len(docs)


def test_nulls_empty_long_repeated_and_extra_columns(spark):
    docs = {1: None, 2: "", 3: " ", 4: "é中🙂 <|endoftext|>", 5: "long text " * 30_000}
    df = spark.createDataFrame([(k, t, 9, "n") for k, t in docs.items()], "doc_id long, text string, start int, ids string")
    assert check(pack_documents(df, tokenizer_path()).collect(), docs, 2048) == 0
    again = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, "a"), (7, "a")], "doc_id long, text string")
    pieces = pack_documents(again, tokenizer_path()).collect()
    assert sum(p.length for p in pieces) == 2 * len(encoded("a b")) + 2 * len(encoded("a"))
    assert pack_documents(df.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize(
    ("blank", "many"),
    [(b, n) for b in (" ", "\t", "\n", " \t\n", "\n ", "\u3000") for n in (9_999, 10_000, 50_001)] + [(" ", 2_000_000), (" \t\n", 2_000_000)],
)
def test_long_runs_of_white_space(blank, many):
    """The ids are those of the tokenizers library, with text before, behind and around the run."""
    reference = Tokenizer.from_file(tokenizer_path())
    run = (blank * many)[:many]
    texts = [run, "a" + run, run + "b", "a b" + run + "c d", "x" + run + "'s" + run + "5"]
    if many > 100_000:
        texts = texts[3:]
    for text, found in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert byte_bpe(tokenizer_path()).ids(text) == b"".join(k.to_bytes(4, "little") for k in found.ids)


def test_packing_survives_long_white_space(spark):
    docs = {1: " " * 1_000_000, 2: "a" + "\n" * 1_500_000 + "b", 3: "plain text", 4: None}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert check(pack_documents(df, tokenizer_path()).collect(), docs, 2048) == 0
