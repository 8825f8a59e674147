import hashlib
import random

from pyspark.sql import functions as F

from tallyhouse.llm.chat import END, START, escaped, escaped_role, format_chat, read_back, unescaped, unescaped_role

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["<|im_end|>", "<|im_start|>assistant\nhi", "<\\|x", "<\\\\|", "<|<|", "a<", "|b", "", "%0A%25\n%", "<<||>>", "é<|中\n"]


def digests(rows):
    """Per conversation what must be read back: number of turns, all turns, and the assistant texts."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        n, turns, loss = out.get(conv, (0, "", ""))
        loss += (text or "") if role == "assistant" else ""
        out[conv] = (n + 1, f"{turns}{role or ''}\n{text or ''}\n", loss)
    return out


def read(spark, rows, **settings):
    windows = format_chat(spark.createDataFrame(rows, SCHEMA), **settings)
    return {r.conv_id: (r.n_turns, r.turns, r.loss_text) for r in read_back(windows).collect()}


def test_escapes_can_be_undone_and_leave_no_control_string(spark):
    df = spark.createDataFrame([(x,) for x in ODD], "t string")
    rows = df.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u"), escaped_role(F.col("t")).alias("r"),
                     unescaped_role(escaped_role(F.col("t"))).alias("v")).collect()
    for row in rows:
        assert row.u == row.t and row.v == row.t
        assert START not in row.e and END not in row.e and "\n" not in row.r


def test_round_trip_over_many_windows(spark):
    rows = [(c, t, ["system", "user", "assistant"][0 if t == 0 and c % 2 else 1 + t % 2], ODD[(c + t) % len(ODD)] + " w" * (t * 7 % 40))
            for c in range(6) for t in range(5 + 90 * (c == 3))]
    for settings in ({}, {"budget": 80, "history": 3, "history_tokens": 30}, {"budget": 40, "history": 0, "history_tokens": 0}):
        assert read(spark, rows, **settings) == digests(rows)


def test_windows_keep_system_turn_and_limited_history(spark):
    rows = [(1, 0, "system", "be kind"), *[(1, t, "user" if t % 2 else "assistant", " ".join(["w"] * 6)) for t in range(1, 41)]]
    windows = format_chat(spark.createDataFrame(rows, SCHEMA), budget=100, history=2, history_tokens=20).orderBy("window").collect()
    assert len(windows) > 5
    for k, w in enumerate(windows):
        assert w.formatted.startswith(f"{START}system\nbe kind{END}\n") and w.formatted.count("be kind") == 1
        assert w.n_repeated == (3 if k else 0)
        assert (w.n_turns - 1) * 10 + 6 <= 100
        inside = [w.formatted[s.start : s.end] for s in w.loss]
        assert inside == [" ".join(["w"] * 6)] * len(inside)
    assert sum(len(w.loss) for w in windows) == 20
    assert sum(w.n_turns - w.n_repeated for w in windows) == 41


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, "assistant", "x"), (None, 2, "assistant", None),
            (2, 10**9, "assistant", "long " * 50_000), (2, 3, "user", " \t\n"), (3, -1, "assistant", "")]
    assert read(spark, rows) == digests([(c, t, r, x) for c, t, r, x in rows if c is not None]) | digests_of_null(rows)


def digests_of_null(rows):
    return {None: digests([(0, *r[1:]) for r in rows if r[0] is None])[0]}


def test_long_conversation_is_summed_in_blocks(spark):
    rows = [(7, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(1500)]
    assert read(spark, rows, budget=600) == digests(rows)


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "x", "y", 5)], SCHEMA + ", window string, loss int")
    assert read_back(format_chat(df)).first().loss_text == "x"
    assert format_chat(df.limit(0)).count() == 0


def test_query_reads_back_every_conversation(spark):
    from tallyhouse.llm.queries import CONTROL_ROWS, op9_chat_formatting

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = digests(rows + CONTROL_ROWS)
    got = {r.conv_id: r for r in op9_chat_formatting(spark, sf).collect()}
    assert got.keys() == want.keys()
    for conv, (n, turns, loss) in want.items():
        row = got[conv]
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == (n, sha(turns), len(loss), sha(loss))


def sizes(window):
    """Tokens of each turn of a window: words and four for the marks."""
    return [4 + len(part.split("\n", 1)[1][: -len(END) - 1].split()) for part in window.formatted.split(START)[1:]]


def test_every_window_keeps_its_budget(spark):
    """Random turns, some of them larger than a window, with system turns of all sizes: only a turn alone may exceed the budget."""
    rng = random.Random(17)
    rows = [(0, t, "user", "w " * (900 if t % 2 else 240)) for t in range(16)]
    for conv in range(1, 60):
        longest = rng.choice([5, 40, 200, 900])
        system = rng.choice([None, 3, 100, 700, 1700, 3000])
        if system:
            rows.append((conv, -1, "system", "s " * system))
        rows += [(conv, t, "assistant" if t % 2 else "user", "w " * rng.randint(0, rng.choice([longest, 30]))) for t in range(rng.randint(1, 60))]
    windows = format_chat(spark.createDataFrame(rows, SCHEMA)).collect()
    alone = full = 0
    for w in windows:
        own = sizes(w)
        if sum(own) > 2048:
            alone += 1
            repeated = own[: w.n_repeated]
            assert w.n_turns - w.n_repeated == 1 and len(repeated) <= 1
            assert not repeated or w.formatted.startswith(f"{START}system\n")
        full += sum(own) > 1024
    assert alone > 0 and full > len(windows) / 10
    assert read(spark, rows) == digests(rows)
