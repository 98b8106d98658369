"""The factorisation machine: its identity, and its use on the tables."""

import numpy as np
import pyarrow as pa

from tickertide.llm.quality import FACTORS, FEATURES, Machine, features, keep_good, score_documents
from tickertide.llm.registry import table
from tickertide.llm.words import runs


def test_sum_of_squares_identity():
    random = np.random.default_rng(0)
    m = Machine(0.3, random.normal(0, 1, FEATURES), random.normal(0, 1, (FEATURES, FACTORS)))
    texts = pa.array(["a b c | d", "", "One. two three! " * 4])
    doc, feature, value = features(texts, np.array([9.0, np.nan, 64.0]))
    got = m.margins(runs(doc), feature, value)
    for i in range(3):
        f, x = feature[doc == i], value[doc == i]
        pairs = sum(m.factors[f[a]] @ m.factors[f[b]] * x[a] * x[b] for a in range(len(f)) for b in range(a))
        assert np.isclose(got[i], 0.3 + (m.weights[f] * x).sum() + pairs, rtol=1e-4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))
    both = rows.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert len(both) > 80
    assert sum(r.predicted == r.quality for r in both) / len(both) > 0.95
    good = [r.score for r in both if r.quality == 1]
    bad = [r.score for r in both if r.quality == 0]
    assert sum(g > b for g in good for b in bad) / len(good) / len(bad) > 0.98


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good words in a row. " * 5, 1, "k"), (2, None, None, None), (3, "", 0, "k"), (None, "| | | |", 3, "k"), (4, "w " * 100000, 5, "k"), (1, "good words in a row. " * 5, 1, "k")],
        "doc_id bigint, text string, n_chars int, _id string",
    )
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (None, 1), (9, None), (4, 0), (4, 0), (2, 7)], "doc_id bigint, quality int")
    rows = score_documents(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.score == 0.5 and r.predicted == 1 for r in score_documents(docs, labels.limit(0)).collect())
    assert score_documents(docs.limit(0), labels).count() == 0
    kept = keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == 6
