import random

import pytest

from tallyhouse.llm.byte_bpe import byte_bpe, vocabulary
from tallyhouse.llm.queries import tokenizer_path
from tallyhouse.llm.token_counts import LongestMatch, token_counts

BYTES = [bytes([b]) for b in range(256)]


def greedy(pieces, word):
    """Longest match first, piece by piece."""
    n, at, longest = 0, 0, max(map(len, pieces))
    while at < len(word):
        size = next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces)
        at, n = at + size, n + 1
    return n


def test_counts_equal_piece_by_piece_matching():
    rng = random.Random(3)
    for _ in range(30):
        pieces = set(BYTES) | {bytes(rng.choice(b"ab c") for _ in range(rng.randint(2, 7))) for _ in range(40)}
        match = LongestMatch(pieces)
        for _ in range(60):
            word = bytes(rng.choice(b"ab c") for _ in range(rng.randint(0, 30)))
            assert match.count(word) == greedy(pieces, word)


def test_missing_bytes_are_refused():
    with pytest.raises(ValueError):
        LongestMatch([b"a", b"ab"])


def test_whole_table_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    pieces = vocabulary(tokenizer_path()).keys()
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts(spark.read.parquet(f"{sf}/documents.parquet"), tokenizer_path()).collect()}
    for doc_id, text in rows[:60]:
        words = text.encode().split()
        assert got[doc_id] == (len(words), sum(greedy(pieces, b" " + w) for w in words))
    assert len(got) == len(rows)


def test_edge_cases(spark):
    long = "x" * 300_000
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n ", 0), (None, "a b", 1), (4, "a b", 2), (4, "a b", 2), (5, long, 3), (6, "é 中 🙂", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {(r.doc_id, r.n_words): r.n_tokens for r in token_counts(df, tokenizer_path()).collect()}
    assert got[1, 0] == got[2, 0] == got[3, 0] == 0
    assert got[None, 2] == got[4, 2] == 2
    assert got[5, 1] > 1000 and got[6, 3] >= 3
    assert token_counts(df, tokenizer_path()).count() == len(rows)
    assert token_counts(df.limit(0), tokenizer_path()).count() == 0


def test_ids_equal_those_of_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path())
    reference.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["", " ", "  a  b\n c", "it's <|endoftext|> x", "\x1c a\u00a0b", "中文 é\t\t1234567", "a" * 5000]
    for text, found in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert byte_bpe(tokenizer_path()).ids(text) == b"".join(k.to_bytes(4, "little") for k in found.ids)
