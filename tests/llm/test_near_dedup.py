import random
from collections import defaultdict

import pytest

from statewise.llm import near_dedup
from statewise.llm.near_dedup import keep_one_of_each, near_groups


def brute(rows, width=4, percent=80):
    sets, up = {}, {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        s = {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets[i], up[i] = s, i

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    by_shingle = defaultdict(list)
    for i in sorted(sets):
        for j in {j for s in sets[i] for j in by_shingle[s]}:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                up[y] = x
        for s in sets[i]:
            by_shingle[s].append(i)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    texts = []
    base = [word() for _ in range(80)]
    for _ in range(300):  # a hot group of near copies, many of them at the edge of 0.8
        t = list(base)
        for _ in range(r.randrange(8)):
            t[r.randrange(len(t))] = word()
        texts.append(" ".join(t))
    for _ in range(40):
        t = [word() for _ in range(r.randrange(1, 60))]
        texts += [" ".join(t)] * r.randrange(1, 4)
        t[r.randrange(len(t))] = word()
        texts.append("\t".join(t).upper())
    texts += ["", None, " \n ", "one", "ONE", "one two three", "a b c d", "x " * 50, "y " * 5000]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "part"), [(1, 1_000), (2, 100)])
def test_components_equal_brute_force(spark, monkeypatch, seed, part):
    monkeypatch.setattr(near_dedup, "PART", part)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS node", "1 AS key").repartition(7)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_groups(docs)[0].collect()}
    assert got == brute(rows)


def test_empty_null_and_repeated_rows(spark):
    assert near_groups(spark.createDataFrame([], "doc_id long, text string"))[0].collect() == []
    docs = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (7, "a b c d e"), (8, None)], "doc_id long, text string")
    got = sorted(map(tuple, near_groups(docs)[0].collect()), key=str)
    assert got == [(5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (8, 0, 8, True), (None, 2, None, True)]


def test_keep_one_of_each_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (3, None, "z"), (None, "q", "w")], "doc_id long, text string, kept string")
    assert sorted(map(tuple, keep_one_of_each(docs).collect()), key=str) == [(1, "a b c d e f", "x"), (3, None, "z"), (None, "q", "w")]


def test_a_similarity_that_the_forest_is_not_made_for_is_refused(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    with pytest.raises(ValueError, match="80"):
        near_groups(docs, percent=50)
