"""The language model against a plain statement of its formulas."""

from collections import Counter, defaultdict
from math import log10

import pytest
from pyspark.sql import functions as F

from tickertide.llm.ngram import discounts, score_texts

TEXTS = [
    (1, "The cat sat on the mat", False),
    (2, "the cat  ate\tthe fish\n the mat ", False),
    (3, None, False),
    (4, "", True),
    (5, "a cat sat on a unicorn", True),
    (6, "The cat sat on the mat", False),
    (7, "The cat sat on the mat", True),
    (8, "of of of of the the " * 40, False),
    (9, "É é Ünder the sea the a b c d e f g a b a b a c a c a", False),
    (10, "x" * 5000 + " the", None),
    (None, "the dog", True),
]


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def plain_model(rows, order):
    train = [words(t) for _, t, held in rows if not held]
    seen = Counter()
    for w in train:
        line = ["<s>"] * (order - 1) + w + ["</s>"]
        seen.update(tuple(line[i - order + 1 : i + 1]) for i in range(order - 1, len(line)))
    counts = {order: seen}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    rates = {k: discounts([sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]) for k, c in counts.items()}
    c1 = Counter(x for w in train for x in [*w, "</s>"])
    context = {k: defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            context[k][g[:-1]].append(n)

    def p(gram):
        if not gram:
            return 1 / (len(c1) + 1)
        k, ns = len(gram), context[len(gram)].get(gram[:-1])
        if not ns:
            return p(gram[1:])
        d = [0, *rates[k]]
        n = counts[k][gram]
        left = sum(d[min(x, 3)] for x in ns) / sum(ns)
        return (n - d[min(n, 3)]) / sum(ns) + left * p(gram[1:])

    total = sum(c1.values())
    out = {}
    for key, text, held in rows:
        w = words(text)
        line = ["<s>"] * (order - 1) + w + ["</s>"]
        toks = [*w, "</s>"]
        out[key] = (
            bool(held), len(toks), sum(c1[x] > 0 for x in toks), total,
            sum(log10((c1[x] + 1) / (total + len(c1) + 1)) for x in toks),
            sum(log10(p(tuple(line[i - order + 1 : i + 1]))) for i in range(order - 1, len(line))),
        )
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_model(spark, order):
    rows = spark.createDataFrame(TEXTS, "doc_id bigint, text string, held boolean").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in score_texts(rows, F.col("held"), order).collect()}
    want = plain_model(TEXTS, order)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k][:4] == v[:4]
        assert got[k][4:] == pytest.approx(v[4:], rel=1e-9)


def test_no_training_rows_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "a b", True, "x")], "doc_id bigint, text string, held boolean, key string")
    got = score_texts(rows, F.col("held")).collect()
    assert [tuple(r) for r in got] == [(1, True, 3, 0, 0, 0.0, 0.0)]
    assert score_texts(rows.limit(0), F.col("held")).count() == 0


def test_probabilities_sum_to_one(spark):
    import numpy as np

    from tickertide.llm.ngram import END, fit
    from tickertide.llm.words import hash_word

    model = fit(spark.createDataFrame([(t,) for _, t, _ in TEXTS], "text string"))
    vocabulary = {w for _, t, _ in TEXTS for w in words(t)}
    after = np.array([hash_word(w) for w in sorted(vocabulary)] + [int(END), 12345], np.uint64)
    for before in ("the", "cat", "unheard"):
        chance = model.probability([np.full(len(after), hash_word(before), np.uint64), after])
        assert chance.sum() == pytest.approx(1.0)


@pytest.mark.parametrize("n", [0, 1, 5, 20000])
def test_blocks_keep_their_rows(n):
    import numpy as np

    from tickertide.llm.ngram import pack, unpack

    some = np.random.default_rng(n)
    known = some.integers(0, 1 << 63, 50).astype(np.uint64)
    words = [known[some.integers(0, 50, n)] for _ in range(3)]
    numbers = [some.integers(0, 300, n), some.integers(0, 1 << 40, n)]
    got = unpack(pack(words, numbers))
    assert sorted(zip(*got[0], *got[1])) == sorted(zip(*words, *numbers))


def test_counts_beyond_32_bits():
    import numpy as np

    from tickertide.llm.ngram import narrow

    assert narrow(np.array([1, 5_000_000_000])).tolist() == [1, 5_000_000_000]
    assert narrow(np.array([255])).dtype == np.uint8 and narrow(np.zeros(0, np.int64)).dtype == np.uint8
