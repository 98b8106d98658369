"""The trie of conversations against dictionaries of sequences."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tickertide.llm.prefixes import as_they_are, hash_ids, join_ids, prefix_trie, with_heads_of_block

SCHEMA = "conv_id bigint, turn bigint, role string, text string, d1 string, part int"


def plain_nodes(rows, blocks):
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c, seq in own.items():
        if blocks:
            h = zlib.crc32(str(c).encode()) % 6
            donor = c - c % 100 if c >= 0 else c + -c % 100
            seq = own.get(donor, [])[:h] + seq[h:]
        paths[c] = tuple(seq)
    members = defaultdict(list)
    for c, seq in paths.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in kids[s]) if kids[s] else 1
        saved[s] = (len(members[s]) - 1) * (len(s[-1][1]) if s else 0) + sum(saved[k] for k in kids[s])
    out = []
    for s, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(s))
        parent = min(members[s[:-1]]) if s else None
        out.append((min(who), len(s), parent, len(who), len(kids[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def some_rows(seed):
    pick = random.Random(seed)
    texts = ["hello", "", None, "été", "x" * 5000, "why?", "日本語"]
    rows = []
    for c in [*range(-120, 330), 5000, 5001, 5100]:
        if pick.random() < 0.2:
            continue  # also whole conversations that others take turns from
        for t in range(pick.choice([1, 2, 3, 8])):
            rows.append((c, t, pick.choice(["user", "user", None]), pick.choice(texts[: pick.choice([1, 2, 7])]), "x", 0))
    rows += [(7, t, "user", f"turn {t}", "x", 0) for t in range(100, 1500)]  # two long ones alike
    rows += [(8, t, "user", f"turn {t}", "x", 0) for t in range(100, 1500)]
    rows += [(400 + i, t, "u", f"common {t}", None, None) for i in range(300) for t in range(3)]
    rows += [(None, 1, "user", "nobody's", "x", 0), (12, None, "user", "no turn", "x", 0), (13, None, None, None, None, None)]
    return rows


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("rebuild, bits", [(with_heads_of_block, None), (with_heads_of_block, 2), (as_they_are, 8)])
def test_against_dictionaries(spark, rebuild, bits):
    rows = some_rows(1)
    got = found(prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), rebuild, bits))
    want = plain_nodes(rows, rebuild is with_heads_of_block)
    assert len(got) == len(want)
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    assert not wrong[:3]


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [(c, 1, "user", text, "x", 0) for c in (1, 2) for text in ("a", "b", "b")]
    got = found(prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert [(r[1], r[3]) for r in got] == [(0, 2), (1, 2), (2, 2), (3, 2)]
    assert got == found(prefix_trie(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)))


def test_few(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [(100, 5, "user", "only", "x", 0)]
    assert found(prefix_trie(spark.createDataFrame(one, SCHEMA), with_heads_of_block)) == plain_nodes(one, True)
    # Takes turns of a conversation that is not there, and so may have none.
    rows = [(c, 0, "user", "only", "x", 0) for c in range(101, 120)]
    got = found(prefix_trie(spark.createDataFrame(rows, SCHEMA), with_heads_of_block))
    assert got == plain_nodes(rows, True) and {r[1] for r in got} == {0, 1}


def test_ids_in_pieces(spark, monkeypatch):
    import pyarrow as pa

    from tickertide.llm import prefixes

    monkeypatch.setattr(prefixes, "PIECE_IDS", 4)
    batch = pa.record_batch([pa.array([1] * 10 + [2] * 3, pa.int64()), pa.array([5] * 13, pa.int64()), pa.array(range(-5, 8), pa.int64())], names=["d1", "d2", "conv"])
    got = [r for b in hash_ids(join_ids(iter([batch, batch.slice(10)]))) for r in b.to_pylist()]
    want = [(1, ",".join(map(str, range(-5, 5)))), (2, "5,6,7,5,6,7")]
    assert [(r["d1"], r["sha"]) for r in got] == [(d, hashlib.sha256(s.encode()).hexdigest()) for d, s in want]
