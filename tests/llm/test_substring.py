import random

from pyspark.sql import functions as F

from tallyhouse.llm.substring_dedup import LARGEST, cuts, removable, substring_dedup, windows

SCHEMA = "doc_id long, text string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghiklmnopqrstu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_cuts_cover_the_text_and_resist_shifts():
    rng = random.Random(0)
    raw = prose(rng, 3000).encode()
    ends = cuts(raw)
    assert ends == sorted(set(ends)) and ends[-1] == len(raw)
    assert all(raw[e - 1 : e] == b" " for e in ends[:-1])
    shifted = cuts(b"inserted words here " + raw)
    assert len({e - 20 for e in shifted} ^ set(ends)) <= 4
    assert cuts(b"") == [] and cuts(b"x") == [1]
    for text in ("é" * 20_000, "x" * 20_000, "🙂" * 5000 + "a", " " * 9000):
        raw = text.encode()
        ends = cuts(raw)
        assert ends[-1] == len(raw) and max(b - a for a, b in zip([0, *ends], ends, strict=False)) <= LARGEST
        for a, b in zip([0, *ends], ends, strict=False):
            raw[a:b].decode()


def test_planted_passages_are_cut_and_the_rest_stays(spark):
    rng = random.Random(1)
    passage = prose(rng, 70)
    rows = [(k, prose(rng, rng.randint(30, 300))) for k in range(300)]
    holders = list(range(10, 290, 7))
    for k in holders:
        words = rows[k][1].split()
        at = rng.randrange(len(words))
        rows[k] = (k, " ".join([*words[:at], passage, *words[at:]]))
    got = {r.doc_id: r for r in substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for k, text in rows:
        if k == holders[0] or k not in holders:
            assert got[k].text == text and got[k].removed == []
        else:
            assert passage not in got[k].text
            assert len(text) - len(got[k].text) >= 0.4 * len(passage)
            raw, spans = text.encode(), got[k].removed
            assert all(raw[s.start : s.end].decode() in passage for s in spans)
            kept = b"".join(raw[a:b] for a, b in zip([0, *(s.end for s in spans)], [*(s.start for s in spans), len(raw)], strict=True))
            assert kept.decode() == got[k].text


def test_short_common_lines_stay(spark):
    rng = random.Random(2)
    rows = [(k, prose(rng, 40) + "\nLicensed under the Apache License, Version 2.0.\n" + prose(rng, 40)) for k in range(50)]
    assert substring_dedup(spark.createDataFrame(rows, SCHEMA)).where(F.size("removed") > 0).count() == 0


def test_phrases_of_different_documents_stay(spark):
    """Chunks that each occur earlier, but in no one document side by side, are no passage."""
    rng = random.Random(9)
    chunks = []
    for words in (400, 800):
        raw = prose(rng, words).encode()
        ends = cuts(raw)
        chunks.append([raw[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)][1:-1])
    short = [c for c in chunks[0] if len(c.split()) < 12]
    rows = [(k, chunks[1][k] + c + prose(rng, 30)) for k, c in enumerate(short)]
    rows += [(1000, "".join(short)), (1001, "".join(short))]
    got = {r.doc_id: r.text for r in substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got.pop(1001) == ""
    assert got == dict(rows[:-1])


def test_windows_hold_the_least_words():
    rng = random.Random(10)
    for text in (prose(rng, 300), " \n" + prose(rng, 40), prose(rng, 5), "", " "):
        raw = text.encode()
        ends = cuts(raw)
        starts = [0, *ends]
        words = lambda i, j: len(raw[starts[i] : ends[j]].split())
        n = len(ends)
        want = {(i, next(j for j in range(i, n) if words(i, j) >= 12)) for i in range(n) if words(i, n - 1) >= 12}
        want |= {(max(i for i in range(n) if words(i, n - 1) >= 12), n - 1)} if want else set()
        assert {(i, j) for i, j, _ in windows(raw, ends, 12)} == want


def test_stretches_without_white_space(spark):
    """Chinese texts, minified code: cuts between characters, passages found in other places and after one more character."""
    rng = random.Random(12)
    chinese = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    code = lambda n: "".join(rng.choice("abcdef(){};=.01") for _ in range(n))
    for make, size in ((chinese, 150), (code, 400)):
        passage = make(size)
        whole = make(6000)
        rows = [(1, make(500) + passage + make(500)), (2, make(333) + passage + make(100)), (3, whole), (4, make(1) + whole), (5, make(2000)), (6, make(60))]
        got = {r.doc_id: r.text for r in substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
        texts = dict(rows)
        assert all(got[k] == texts[k] for k in (1, 3, 5, 6))
        assert passage not in got[2] and len(texts[2]) - len(got[2]) > 0.6 * size
        assert len(got[4]) < 0.02 * len(whole)
        raw = whole.encode()
        ends = cuts(raw)
        assert 10 < len(raw) / len(ends) < 40
        for a, b in zip([0, *ends], ends, strict=False):
            raw[a:b].decode()
        shift = cuts("中文".encode() + raw)
        assert len({e - 6 for e in shift} ^ set(ends)) <= 8


def test_planted_passages_of_51_words(spark):
    """Hardly one of them stays, and texts without one stay as they are."""
    rng = random.Random(13)
    passages = [prose(rng, 51) for _ in range(400)]
    rows = [(k, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for k, passage in enumerate(passages)]
    rows += [(1000 + k, f"{prose(rng, 30)} {passage} {prose(rng, 50)}") for k, passage in enumerate(passages)]
    rows += [(2000 + k, prose(rng, 200)) for k in range(400)]
    got = {r.doc_id: r.text for r in substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(passages[k] in got[1000 + k] for k in range(400)) <= 2
    assert all(got[k] == text for k, text in rows if k < 1000 or k >= 2000)


def test_whole_copies_keep_the_first(spark):
    rng = random.Random(3)
    text = prose(rng, 200)
    got = {r.doc_id: r.text for r in substring_dedup(spark.createDataFrame([(k, text) for k in range(5, 2000)], SCHEMA)).collect()}
    assert got.pop(5) == text and set(got.values()) == {""}


def test_brute_force_over_words(spark):
    """Runs of 28 words that an earlier document holds, by sets of words alone: what is cut lies in them, and of longer ones most is cut."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    first = {}
    for doc_id, text in sorted(rows):
        words = text.split()
        for k in range(len(words) - 27):
            first.setdefault(tuple(words[k : k + 28]), doc_id)
    got = {r.doc_id: r for r in substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    long_runs = caught = 0
    for doc_id, text in rows:
        words = text.split()
        repeated = [False] * len(words)
        for k in range(len(words) - 27):
            if first[tuple(words[k : k + 28])] < doc_id:
                repeated[k : k + 28] = [True] * 28
        raw, gone = text.encode(), [False] * len(words)
        for s in got[doc_id].removed:
            before = len(raw[: s.start].split())
            for k in range(before, before + len(raw[s.start : s.end].split())):
                gone[k] = True
        # A word at the edge of a span can be the rest of one that white space other than ASCII's parts.
        assert sum(g and not r for g, r in zip(gone, repeated)) <= 2 * len(got[doc_id].removed)
        at = 0
        while at < len(words):
            end = at
            while end < len(words) and repeated[end]:
                end += 1
            if end - at > 50:
                long_runs += 1
                caught += sum(gone[at:end]) >= 0.5 * (end - at)
            at = max(end, at + 1)
    assert long_runs > 5 and caught >= 0.99 * long_runs


def test_edge_cases(spark):
    text = prose(random.Random(4), 60)
    rows = [(1, None), (2, ""), (3, " \n"), (None, text), (4, text), (4, text), (6, text), (5, "x" * 300_000), (7, "x" * 300_000)]
    df = spark.createDataFrame([(*r, k, "y") for k, r in enumerate(rows)], SCHEMA + ", removed int, owner string")
    got = substring_dedup(df).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "removed", "owner"}
    texts = sorted(((r.doc_id or 0, r.text) for r in got), key=str)
    assert (0, text) in texts and texts.count((4, text)) == 2 and (6, "") in texts and (1, None) in texts and (2, "") in texts
    assert dict(texts)[5] == "x" * 300_000 and len(dict(texts)[7]) < LARGEST  # the rest of the last piece of equal bytes
    assert substring_dedup(df.limit(0)).count() == 0
    assert removable(b"", set(), 1) == []
    names = ["_cut", "_repeated", "_repeats_of", "_CUT_"]
    df = spark.createDataFrame([(*r, *names) for r in rows], ", ".join([SCHEMA, *(f"{name} string" for name in names)]))
    assert all([r[name] for name in names] == names for r in substring_dedup(df).collect())
