import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tallyhouse.llm.spelling import misspelt, spelling_variants, words_of

SCHEMA = "doc_id long, text string"


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes one text the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_force(rows, length, count, ratio, every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= count}
    forms, found = {}, {}
    for word, n in words.items():
        others = sorted((-m, other) for other, m in words.items() if near(word, other))
        best = (others[0][1], -others[0][0]) if others and -others[0][0] >= ratio * n else (None, None)
        forms[word], found[word] = best[0], (best[1], len(others))
    out = []
    for word, n in words.items():
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, forms[word], root, n, found[word][1], found[word][0]))
    return sorted(out)


@pytest.mark.parametrize(("letters", "length"), [("ab", 1), ("abé", 2), ("abcdefgh", 5)])
def test_brute_force_over_random_words(spark, letters, length):
    rng = random.Random(len(letters))
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(250)]
    weights = [rng.paretovariate(1) for _ in vocabulary]
    rows = [(k if k % 7 else None, rng.choice([" ", "-", "1"]).join(rng.choices(vocabulary, weights, k=60))) for k in range(80)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = spelling_variants(df, length, 2, 2, 5)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, length, 2, 2, 5)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_brute_force_over_a_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(40)
    rows = [tuple(r) for r in documents.collect()]
    got = spelling_variants(spark.createDataFrame(rows, SCHEMA), misspell_every=97)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, 5, 3, 2, 97)


def test_chains_of_forms_end_in_one_root(spark):
    """aaaaab (2) - aaaabb (4) - aaabbb (8) - aabbbb (16): each one replaced letter from the next."""
    texts = [("a" * (5 - k) + "b" * (k + 1) + " ") * 2 ** (k + 1) for k in range(4)]
    got = {r.word: r for r in spelling_variants(spark.createDataFrame(list(enumerate(texts)), SCHEMA), 5, 1).collect()}
    assert {r.root for r in got.values()} == {"aabbbb"}
    assert got["aaaaab"].form == "aaaabb" and got["aaaabb"].form == "aaabbb" and got["aabbbb"].form is None


def test_equal_letters_count_once(spark):
    """Any of three equal letters can go; the pair is one pair."""
    df = spark.createDataFrame([(1, "hallloo " * 3 + "halloo " * 9 + "halooo " * 3 + "halllo " * 30)], SCHEMA)
    got = {r.word: (r.form, r.n_near, r.form_n) for r in spelling_variants(df).collect()}
    want = {w: (f, k, m) for w, f, _, _, k, m in brute_force([(1, "hallloo " * 3 + "halloo " * 9 + "halooo " * 3 + "halllo " * 30)], 5, 3, 2, None)}
    assert got == want


def test_edge_cases(spark):
    long = "x" * 30_000
    rows = [(1, None, 1, "q"), (2, "", 1, "q"), (3, "12 34", 1, "q"), (None, "Straße STRASSE ÉTÉ÷× naïve", 1, "q")]
    rows += [(5, f"{long} {long}y naïve Naïve", 1, "q")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, word string")
    got = {r.word: (r.form, r.n, r.n_near) for r in spelling_variants(df, 5, 1).collect()}
    assert got["naïve"] == (None, 7, 0) and got["straße"][1] == 1
    assert "ÉtÉ÷×" in got  # only A-Z are lower-cased; U+00D7 and U+00F7 are in the range
    assert got[long][2] == 1 and got[long + "y"][2] == 1
    assert spelling_variants(df.limit(0)).collect() == []
    assert spelling_variants(df.where("doc_id < 4")).collect() == []


def test_words_and_misspellings():
    assert list(words_of("AbĀcd É×x")) == [[b"ab", b"cd", "É×x".encode("latin-1")]]
    for doc_id in range(200):
        for word in ("naïve", "hello"):
            h = crc32(f"{doc_id}:{word}".encode())
            want = word[: h % 5] + word[h % 5 + 1 :] if h % 7 == 0 else word
            assert misspelt(word.encode("latin-1"), crc32(f"{doc_id}:".encode()), 7).decode("latin-1") == want
