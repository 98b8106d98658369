"""Quotations: taken out, linked, ordered."""

import random
import time

from pyspark.sql import functions as F

from tickertide.llm.quotes import lines_of, passages, reply_ordered

A = "Hello all, the build is broken again. Does anybody know why that is?\n\nThe log says nothing useful at all."
B = "On Monday Ann wrote:\n> Hello all, the build is broken again. Does\n> anybody know why that is?\n\nYes, the disk of the server is full."
C = "Bob wrote:\n> > hello all,   the BUILD is broken again.\n> Yes, the disk of the server is full.\n\nThen we clean it up tonight.\nThanks"
ROWS = [
    (1, 0, "user", A), (1, 1, "user", B), (1, 2, "assistant", C), (1, 3, "user", "A new topic without any quotation here."),
    (1, 4, "user", "> Does anybody know why that is?\nI do not."), (1, 5, "user", "> never said by anyone in here\nwhat"),
    (2, 0, "user", "> The log says nothing useful at all.\nOther conversation."), (2, 1, "user", None), (2, 2, None, ""),
    (3, 0, "user", "Same line in all of it."), *[(3, t, "user", "> Same line in all of it.\nSame line in all of it.") for t in range(1, 700)],
    (None, 1, "user", A), (None, 2, "user", "> The log says nothing useful at all.\nhm"), (4, None, "user", "> x y z\nq"),
    (5, 0, "user", "> quoted before it is said here"), (5, 1, "user", "quoted before it is said here"), (1, 3, "user", "A new topic without any quotation here."),
]


def test_links(spark):
    table = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "conv_id bigint, turn bigint, role string, text string, level int, root string").repartition(4)
    rows = reply_ordered(table).collect()
    assert len(rows) == len(ROWS)
    got = {(r.conv_id, r.turn): r for r in rows}
    link = {k: (r.reply_to, r.root, r.depth) for k, r in got.items()}
    assert link[1, 0] == (None, 0, 0) and link[1, 1] == (0, 0, 1) and link[1, 2] == (1, 0, 2)
    assert link[1, 3] == (None, 3, 0) and link[1, 4] == (0, 0, 1) and link[1, 5] == (None, 5, 0)
    assert link[2, 0] == (None, 0, 0) and link[None, 2] == (None, 2, 0) and link[4, None] == (None, None, 0)
    assert link[5, 0] == (None, 0, 0)
    # Each repeats what the one before says.
    assert all(link[3, t] == (t - 1, 0, t) for t in range(1, 700))
    assert got[1, 1].text == "Yes, the disk of the server is full." and got[1, 1].n_quoted == 2
    assert got[1, 2].text == "Then we clean it up tonight.\nThanks"
    assert got[2, 1].text == "" and got[1, 0].text == A
    ordered = sorted((r for r in rows if r.conv_id == 1), key=lambda r: (r.root, r.turn))
    place = {r.turn: i for i, r in enumerate(ordered)}
    assert all(place[r.reply_to] < place[r.turn] for r in ordered if r.reply_to is not None)


def test_long_and_empty(spark):
    long = "\n".join(["> " * (i % 3) + f"line {i} of a very long message" for i in range(20000)])
    table = spark.createDataFrame([(1, 0, "user", long), (1, 1, "user", "w " * 100000)], "conv_id bigint, turn bigint, role string, text string")
    got = {r.turn: r for r in reply_ordered(table).collect()}
    assert got[0].n_quoted == sum(i % 3 > 0 for i in range(20000))
    assert reply_ordered(table.limit(0)).count() == 0


def test_short_sentences(spark):
    rows = [
        (1, 0, "Yes. I agree with the plan."), (1, 1, "No! Why not? Then we wait."), (1, 2, "> Yes.\nGood."), (1, 3, "> Why not?\nBecause."),
        (1, 4, "> No! Why not?\nHm."), (1, 5, "Yes."), (1, 6, "> Yes. I agree with the plan.\nFine."),
    ]
    table = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id bigint, turn bigint, role string, text string")
    got = {r.turn: r.reply_to for r in reply_ordered(table).collect()}
    assert got == {0: None, 1: None, 2: 0, 3: 1, 4: 1, 5: None, 6: 0}


def plain_passages(text):
    out, before = [], None
    for line in text.split("\n"):
        level = 0
        while line.lstrip(" ").startswith(">"):
            line = line.lstrip(" ")[1:]
            level += 1
        words = line.strip(" ")
        if out and before == (level, True) and words:
            out[-1] = (level, out[-1][1] + " " + words)
        elif words:
            out.append((level, words))
        before = (level, bool(words))
    return out


def test_passages(spark):
    rng = random.Random(2)
    texts = ["\n".join(rng.choice(["", ">", "> ", ">> ", "> > "]) + rng.choice(["", "a b", "c.", "d 🚀", " x"]) for _ in range(rng.randrange(9))) for _ in range(800)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", lines_of(F.col("t")).alias("l")).select("i", passages(F.col("l")).alias("p"))
    got = {r.i: [(p.level, p.words) for p in r.p] for r in rows.collect()}
    assert got == {i: plain_passages(t) for i, t in enumerate(texts)}


def test_passages_are_linear(spark):
    n = 100_000
    text = "\n".join(["> " * (i % 3) + f"line {i}" for i in range(n)]) + "\n" + "one\n" * n + "\n" * n
    table = spark.createDataFrame([(text,)], "t string").select(lines_of(F.col("t")).alias("l"))
    begin = time.time()
    # The last of the numbered lines and those of one word are one passage.
    assert table.select(F.size(passages(F.col("l"))).alias("n")).first()["n"] == n
    assert time.time() - begin < 20
