"""Templates and the items they find."""

import random
import re

from tickertide.llm.decontam import LITERALS, MATCHES, SHORTEST, UNITS, WINDOW, contamination, drop_contaminated

ITEMS = [
    (1, "Anna has 12 apples and gives 5 kg of them to her brother who already had 12 pears in the old basket. How many are left?"),
    (2, "What was the name of the treaty that ended the long war between the two northern kingdoms?"),
    (3, "too short"),
    (4, None),
    (None, "an item without any id that nobody should ever find in the corpus at all"),
    (5, "five words are an item"),
]
FILL = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor. "
DOCS = [
    (1, FILL + ITEMS[0][1] + " " + FILL),
    # The same question with other numbers, names and units.
    (2, FILL + "Once more: Maria has 30 apples and gives 7 lb of them to her brother who already had 30 pears in the old basket. How many are left? " + FILL),
    # 12 stands for 30 at first and for 31 later: not the same question.
    (3, FILL + "Maria has 30 apples and gives 7 lb of them to her brother who already had 31 pears in the old basket. How many are left? " + FILL),
    (4, FILL * 20),
    (5, "%%% " + ITEMS[1][1].upper().replace("WHAT", "what") + " &&&"),
    (6, "x***\n\n" + ITEMS[1][1].replace(" ", "\n\t") + "***y"),
    (7, " ".join(ITEMS[1][1].split()[:9])),
    (8, None),
    (9, ""),
    (10, "12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27 28 29 30 " * 30),
    (11, (FILL * 1500) + ITEMS[1][1] + (FILL * 1500)),
    (12, "Five words are an item, " + ITEMS[1][1] + " " + ITEMS[1][1]),
    (None, ITEMS[1][1]),
    (None, "an item without any id that nobody should ever find in the corpus at all"),
    (4, FILL),
]


def tables(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in DOCS], "doc_id bigint, text string, id int, item string").repartition(4)
    return docs, spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_contamination(spark):
    docs, items = tables(spark)
    rows = contamination(docs, items).collect()
    assert len(rows) == len(DOCS)
    found = {r.doc_id: (r["items"], r.reworded) for r in rows if r.contaminated and r.doc_id is not None}
    assert found == {1: ([1], False), 2: ([1], True), 5: ([2], False), 6: ([2], False), 11: ([2], False), 12: ([2, 5], False)}
    assert [r.contaminated for r in rows if r.doc_id is None] == [True, True]
    named = contamination(docs, items, nameless=False).collect()
    assert sorted(r.contaminated for r in named if r.doc_id is None) == [False, True]
    assert all(r.windows == 0 for r in rows if not r.contaminated)


def test_drop(spark):
    docs, items = tables(spark)
    left = drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["3", "4", "4", "7", "8", "9", "10"])
    left = drop_contaminated(docs, items, nameless=False)
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["3", "4", "4", "7", "8", "9", "10", "None"])


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert contamination(docs.limit(0), items).count() == 0
    assert not any(r.contaminated for r in contamination(docs, items.limit(0)).collect())


def test_many_copies_of_a_leak(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", f"concat('doc ', id, ' {FILL}', \"{ITEMS[1][1]}\") as text")
    _, items = tables(spark)
    assert contamination(docs, items).where("contaminated and size(items) = 1").count() == 3000


def found_items(spark, items, docs, **more):
    items = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    return {r.doc_id: r["items"] for r in contamination(docs, items, **more).collect()}


def test_items_of_numbers_and_short_items(spark):
    items = [(1, "Solve 3x + 5 = 20 for x"), (2, "Add 12 and 30 kg"), (3, "Compute 12 * 7 + 5 - 3 / 9 exactly now"), (4, "too short"), (5, "17 18 19 20 21 22 23 24 25 26 27 28 29 30"), (6, "..."), (None, "who of all men never had an id in here?")]
    docs = [FILL + t + ("\n" if i == 4 else " ") + FILL for i, t in items]
    docs += [FILL + "Solve 3x + 5 = 21 for x " + FILL, FILL + "Add 12 and 31 kg " + FILL, FILL + "(Too, short!) " + FILL, " ".join(str(n) for n in range(40, 80))]
    found = found_items(spark, items, docs)
    assert [found[i] for i in range(5)] == [[1], [2], [3], [4], [5]]
    assert found[5] == [] and len(found[6]) == 1
    assert all(found[i] == [] for i in (7, 8, 10)) and found[9] == [4]


def test_short_items_are_sentences(spark):
    items = [(1, "Why?"), (2, "Who is it?"), (3, "Now then, one two")]
    docs = ["the cat sat on a mat. Why so?", "the cat sat. Why?", "why", "Say why\nwhy not", "He asked: who is it? Nobody.", "who is it that sat here", "x\nNOW then one two\ny", "now then one two three", "Why"]
    found = found_items(spark, items, docs)
    assert [found[i] for i in range(9)] == [[], [1], [1], [], [2], [], [3], [], [1]]


def plain_words(text):
    """(canonical, slot) and real words of an ASCII text."""
    out, real, before = [], [], None
    for m in re.finditer(r"[^ \t-\r]+", text):
        core = re.search(r"[A-Za-z0-9](?:.*[A-Za-z0-9])?", m[0])
        if core is None:
            continue
        word = core[0].lower()
        real.append(re.sub(r"[^a-z0-9]", "", word))
        begin, end = m.start() + core.start(), m.start() + core.end()
        follows = before is not None and text[before[1] : before[1] + 1] not in tuple(".!?:") and "\n" not in text[before[1] : begin]
        if word[0].isdigit():
            kind = "#"
        elif core[0][0].isupper() and core[0][1:2].islower() and follows:
            kind = "@"
        elif before is not None and before[0] and word in UNITS:
            kind = "%"
        else:
            kind = ""
        out.append((kind or word, word if kind else None))
        before = (kind == "#", end)
    return out, real


def plain_found(item, doc):
    """Whether a document has an item, by comparing all windows at all distances."""
    (a, ra), (b, rb) = plain_words(item), plain_words(doc)
    for exact, x, y in ((False, a, b), (True, [(w, None) for w in ra], [(w, None) for w in rb])):
        size = min(WINDOW, len(x))
        if not exact and size < SHORTEST:
            continue
        literal = [exact or sum(s is None for _, s in x[i : i + size]) >= min(LITERALS, size - 1) for i in range(len(x) - size + 1)]
        for shift in range(-len(x), len(y)):
            same = [i for i, ok in enumerate(literal) if ok and i + shift >= 0 and [w for w, _ in x[i : i + size]] == [w for w, _ in y[i + shift : i + shift + size]]]
            values = {(s, y[i + shift + k][1]) for i in same for k, (_, s) in enumerate(x[i : i + size]) if s is not None}
            if same and len(same) >= min(MATCHES, sum(literal)) and len(values) == len({s for s, _ in values}):
                return True
    return False


def test_against_all_windows(spark):
    rng = random.Random(3)
    words = "the old dog ran 12 30 5 kg km Anna Bob home. and then: 7 Why? (so) x-ray".split()
    items = [(i, " ".join(rng.choices(words, k=rng.choice([5, 6, 8, 12, 14])))) for i in range(40)]
    docs = []
    for _ in range(300):
        text = rng.choice(items)[1].split()
        swap = {w: rng.choice(["12", "44", "Carl", "Bob", "kg", "m"]) for w in rng.sample(["12", "30", "Anna", "kg"], 2)} if rng.random() < 0.6 else {}
        text = [swap.get(w, w) for w in text]
        if rng.random() < 0.4:
            text[rng.randrange(len(text))] = rng.choice(words)
        docs.append(" ".join(rng.choices(words, k=rng.randrange(6)) + text + rng.choices(words, k=rng.randrange(6))))
    found = found_items(spark, items, docs)
    for i, d in enumerate(docs):
        assert found[i] == [k for k, t in items if plain_found(t, d)], d


def test_case_and_punctuation(spark):
    text = "Ñasquera lleva óscar y été. Größe misst “fünf” Wörter: Élan bleibt. Ähre steht. Öl fließt. Übung macht. Čas běží. Žena čte. Ďábel spí."
    names = "Then Anna met Bob Carl Dora Emil Fritz Gina Hans Ida Jan Kurt Lea"
    bare = "".join(c for c in text if c.isalnum() or c.isspace())
    docs = [FILL + t + " " + FILL for t in (text, bare, text.upper(), bare.lower(), names, names.lower(), names.upper(), text.replace(" ", "\n"))]
    found = found_items(spark, [(1, text), (2, names)], docs)
    assert [found[i] for i in range(8)] == [[1], [1], [1], [1], [2], [2], [2], [1]]


def test_a_slot_that_differs_once(spark):
    head, tail = "Anna has 12 apples and 12 pears.", "Now tell how many of all these fruits are left in the very old basket of her brother."
    docs = [f"{FILL} {head.replace('12 pears', '13 pears')} {tail} {FILL}", f"{FILL} {head.replace('12', '14')} {tail} {FILL}", f"{FILL} {head.replace('12', '14')} {tail} {head} {tail}"]
    rows = contamination(spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"), spark.createDataFrame([(1, f"{head} {tail}")], "item_id bigint, text string")).collect()
    assert {r.doc_id: (r["items"], r.reworded) for r in rows} == {0: ([1], True), 1: ([1], True), 2: ([1], False)}
