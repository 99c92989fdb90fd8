from texttrend.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, turns string"


def frame(spark, conversations):
    rows = [(c, i, role, text, "x") for c, turns in conversations for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA)


def test_snapshots_collapse_into_the_longest(spark):
    a, b, c, d = ("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", "fine")
    logged = [(1, [a]), (2, [a, b]), (3, [a, b, c, d]), (4, [a, b, d]), (5, [a, b, c, d]), (6, [b]), (7, [a, c])]
    got = {r.conv_id: (r.n_turns, r.text) for r in chat.rendered(chat.maximal_conversations(frame(spark, logged))).collect()}
    assert sorted(got) == [3, 4, 6, 7]
    assert got[6] == (1, "<|im_start|>assistant\nyes<|im_end|>\n")
    assert got[7][1] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"


def test_turn_borders_count(spark):
    logged = [(1, [("user", "ab")]), (2, [("user", "a"), ("user", "b")]), (3, [("usera", "b"), ("x", "y")]), (4, [("user", "a\x1fb"), ("z", "")])]
    assert sorted(r.conv_id for r in chat.maximal_conversations(frame(spark, logged)).collect()) == [1, 2, 3, 4]


def test_nulls_repeats_ties_and_no_rows(spark):
    rows = [(1, 0, None, None, "x"), (1, 0, None, None, "x"), (2, None, "user", "a", "x"), (2, 1, "user", "b", "x"), (None, 0, "user", "c", "x"), (3, 0, "user", "a" * 100_000, "x"), (4, 0, "", "", "x")]
    got = {r.conv_id: r.n_turns for r in chat.rendered(chat.maximal_conversations(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {1: 2, 2: 2, None: 1, 3: 1}
    assert chat.maximal_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_runs(spark):
    plan = chat.rendered(chat.maximal_conversations(frame(spark, [(1, [("a", "b")])])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
