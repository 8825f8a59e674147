import random

import numpy as np

from tallyhouse.llm.components import connected_components
from tallyhouse.llm.minhash import BLOCK, LARGE_KEY, _intersections, minhash_components
from tallyhouse.llm.scratch import Scratch
from tallyhouse.llm.words import shingle_set, word_hashes

SCHEMA = "doc_id long, text string"


def word_shingles(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def brute(rows, width, percent=80):
    sets = {doc_id: word_shingles(text, width) for doc_id, text in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed, bases, copies, words=(3, 80), edits=(0, 8)):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(*words))]
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(*edits)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append(" ".join(own).upper() if rng.random() < 0.1 else " ".join(own))
    rng.shuffle(rows)
    return [(3 * k + 1, text) for k, text in enumerate(rows)]


def judged(spark, rows, width, schema=SCHEMA):
    found = minhash_components(spark.createDataFrame(rows, schema), words=width).collect()
    assert len(found) == len(rows)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}


def test_components_by_brute_force(spark):
    for seed, width in ((1, 2), (2, 5)):
        rows = corpus(seed, bases=60, copies=8)
        assert judged(spark, rows, width) == brute(rows, width)


def test_large_group_of_near_copies(spark):
    """More near copies than a key compares pair by pair or a block holds; many link with a few others only."""
    rows = corpus(5, bases=1, copies=1, words=(60, 60))[:1]
    rng = random.Random(6)
    base = rows[0][1].split()
    rows = []
    for k in range(3 * BLOCK):
        own = list(base)
        for at in rng.sample(range(len(own)), rng.choice([1, 2, 4, 6, 7])):
            own[at] = f"x{rng.randrange(1000)}"
        rows.append((k, " ".join(own)))
    assert len(rows) > LARGE_KEY
    want = brute(rows, 2)
    assert 1 < len({c for _, c, _ in want.values()}) < len(rows)
    assert judged(spark, rows, 2) == want


def test_many_copies_are_one_class(spark):
    rows = [(k, "the same few words in all of them") for k in range(3000)] + [(9000, "THE same few\twords in all of  them"), (9001, "other")]
    got = judged(spark, rows, 2)
    assert all(got[k] == (7, 0, k == 0) for k, _ in rows[:-1]) and got[9001] == (1, 9001, True)


def test_nulls_blanks_long_texts_repeats_and_extra_columns(spark):
    long = " ".join(f"l{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, long), (8, long + " end"), (None, "one two"), (9, "one two")]
    got = judged(spark, [(*r, 7, b"x") for r in rows], 2, SCHEMA + ", component_id int, sig binary")
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[4] == (1, 4, True) and got[5] == (1, 4, False) and got[6] == (1, 6, True) and got[9] == (1, 6, False)
    assert got[7] == (59_999, 7, True) and got[8] == (60_000, 7, False)
    assert got[None] == (1, None, True)
    twice = minhash_components(spark.createDataFrame([(1, "a b c")] * 3 + [(0, "a b c")], SCHEMA), words=2).collect()
    assert [r.component_id for r in twice] == [0] * 4
    assert minhash_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_are_cut_at_six_bytes_only():
    assert len(word_hashes("a b c\x1cd\x0be")) == 2
    assert len(shingle_set("a b a b a b", 2)) == 2


def test_intersections_of_a_block():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(30)]
    first = rng.random(30) < 0.5
    got = _intersections(np.array([len(s) for s in sets]), np.concatenate(sets), first)
    want = [[len(np.intersect1d(a, b)) for b in sets] for a, f in zip(sets, first, strict=True) if f]
    assert (got == np.array(want)).all()


def test_components_of_chains_stars_and_nothing(spark):
    links = [(k, k + 1) for k in range(100, 400)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5), (None, 3), (7, 8), (8, 7)]
    table = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in connected_components(table, Scratch(spark, "t")).collect()}
    want = {k: 100 for k in range(100, 401)} | {k: 1000 for k in range(1000, 1300)} | {7: 7, 8: 7}
    assert got == want
    assert connected_components(table.limit(0), Scratch(spark, "t")).count() == 0


def test_rows_of_one_id_link_all_their_texts(spark):
    """(3, A) (5, A) (5, B) (7, B): one component, whichever class an id is the smallest of; an id on a third of the rows."""
    a, b, c = "one two three four", "five six seven eight", "nine ten eleven twelve"
    rows = [(3, a), (5, a), (5, b), (7, b), (8, c), (9, "x y z"), (9, "u v w"), (4, "u v w"), (None, a), (None, c)]
    found = minhash_components(spark.createDataFrame(rows, SCHEMA), words=2).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {
        (3, 3, True), (5, 3, False), (7, 3, False), (8, 8, True), (4, 4, True), (9, 4, False), (None, None, True),
    }
    many = [(50, f"text number {k} of the hot id") for k in range(400)] + [(k, f"text number {k} of the hot id") for k in range(100, 300)]
    many += [(k, f"other text with {k * k} words") for k in range(1000, 1400)]
    found = minhash_components(spark.createDataFrame(many, SCHEMA), words=2).collect()
    assert {r.component_id for r in found if r.doc_id < 1000} == {50}
    assert all(r.component_id == r.doc_id for r in found if r.doc_id >= 1000)
