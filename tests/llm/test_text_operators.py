"""Fingerprints, repeated spans, language model, toxicity and licenses against brute force, and their odd inputs."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from statewise.llm import exchange
from statewise.llm import fingerprints as fp
from statewise.llm.exchange import pack, unpack
from statewise.llm.fingerprints import fingerprint_edits, sketch_groups
from statewise.llm.licenses import NOTICES, scan_licenses
from statewise.llm.lm_score import BACKOFF, score_corpus
from statewise.llm.repeats import remove_repeats
from statewise.llm.toxicity import drop_toxic, labelled_rows, score_toxicity, segments, without_copies

DOCS = "doc_id long, text string, source string, block long, row int, packed string, h long, at long"
MORE = ("x", 1, 2, "p", 3, 4)
SF = "/root/testdata/sf0.01"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *MORE) for r in rows], DOCS).repartition(parts)


def corpus(seed, n=200):
    """Texts that share passages, copies, near copies, loops, and odd ones."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghijklmnop") * r.randrange(1, 4)
    passages = [[word() for _ in range(r.randrange(5, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        t = [word() for _ in range(r.randrange(30))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(t) + 1)
            t[at:at] = r.choice(passages)
        if rows and i % 3 == 0:  # a third of all rows are copies of one text
            t = "the hot text that many documents hold and that is long enough to have windows of words".split()
            if i % 2:
                t = [*t, word()]
        rows.append((i, r.choice([" ", "\n", "\t \v"]).join(t)))
    rows += [(n, None), (n + 1, ""), (n + 2, " \r\n"), (n + 3, "loop " * 60), (n + 4, "loop " * 30), (n + 5, "é　x " * 3000)]
    r.shuffle(rows)
    return rows


# --- fingerprints -------------------------------------------------------------------------------------------------


def shingles(text):
    b = text.encode()
    return {b[i : i + 8] for i in range(len(b) - 7)} if len(b) >= 8 else {b} if b else set()


def test_fingerprints(spark, monkeypatch):
    rows = corpus(1)
    got = {r.doc_id: r for r in fingerprint_edits(frame(spark, rows)).collect()}
    text = {i: t or "" for i, t in rows}
    ids = sorted(text, reverse=True)
    errors = []
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        a, b, r = text[i], text[after], got[i]
        edited = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        assert r.n_chars == len(a) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for likeness, other in ((r.near_edited, edited), (r.near_next, b)):
            x, y = shingles(a), shingles(other)
            exact = len(x & y) / len(x | y) if x | y else 1.0
            assert abs(likeness - exact) < (0.2 if len(x | y) > fp.K else 1e-9)
            errors.append(likeness - exact)
        assert r.fingerprint == fp.to_text(fp.sketch(a))
        n = len(shingles(a))
        assert abs(r.n_shingles - n) <= (0 if n < fp.K else 0.35 * n)
    assert abs(sum(errors) / len(errors)) < 0.02


def test_fingerprints_of_odd_tables(spark):
    assert fingerprint_edits(frame(spark, [])).collect() == []
    one = fingerprint_edits(frame(spark, [(5, "abcdef")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1.0
    rows = [(None, "null id"), (3, None), (3, "three"), (9, "nine nine")]
    got = fingerprint_edits(frame(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["3", "3", "9", "None"]
    last = next(r for r in got if r.doc_id is None)  # stands last, so the first follows
    assert last.edited_sha256 == hashlib.sha256(b"null" + b"nin").hexdigest()


def test_sketches_merge(spark):
    a, b = (" ".join(str(i * n) for i in range(200)) for n in (7919, 104729))
    both = fp.merge(fp.sketch(a), fp.sketch(b))
    assert len(both) == fp.K and set(both) <= set(fp.sketch(a)) | set(fp.sketch(b))
    assert fp.resemblance(fp.sketch(a), fp.sketch(a)) == 1.0 and fp.containment(fp.sketch("abcdefgh"), fp.sketch("abcdefghi")) == 1.0
    assert list(fp.from_text(fp.to_text(both))) == list(both)
    groups = {r.source: r.fingerprint for r in sketch_groups(frame(spark, [(1, a), (2, b)]), "source").collect()}
    assert groups == {"x": fp.to_text(both)}


# --- exchange -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("width", [6, 8])
def test_keys_round_trip(width):
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    keys = np.unique(exchange.cut(keys, width))
    assert (unpack(pack(keys, width), width) == keys).all() and len(unpack(pack(keys[:0], width), width)) == 0


# --- repeats ------------------------------------------------------------------------------------------------------


def brute_repeats(rows, k):
    least = {}
    words = {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(words):
        for j in range(len(words[i]) - k + 1):
            least.setdefault(tuple(words[i][j : j + k]), i)
    out = {}
    for i, w in words.items():
        keep = [True] * len(w)
        for j in range(len(w) - k + 1):
            if least[tuple(w[j : j + k])] < i:
                keep[j : j + k] = [False] * k
        kept = [x for x, y in zip(w, keep, strict=True) if y]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize(("seed", "k", "bits"), [(1, 13, 12), (2, 4, 4)])
def test_repeats(spark, monkeypatch, seed, k, bits):
    monkeypatch.setattr(exchange, "BLOCK_BITS", bits)
    rows = corpus(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(frame(spark, rows), k).collect()}
    assert got == brute_repeats(rows, k)
    assert sum(x[1] for x in got.values()) > 500


def test_repeats_of_odd_tables(spark):
    assert remove_repeats(frame(spark, [])).collect() == []
    text = " ".join(map(str, range(14)))
    got = [(r.doc_id, r.n_removed) for r in remove_repeats(frame(spark, [(None, text), (4, text), (4, text), (2, None)])).collect()]
    assert sorted(got, key=str) == [(2, 0), (4, 0), (4, 0), (None, 14)]


# --- language model -----------------------------------------------------------------------------------------------


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(exchange, "BLOCK_BITS", 4)
    rows = corpus(3)
    got = {r.doc_id: r for r in score_corpus(frame(spark, rows)).collect()}
    tokens = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in rows}
    one, two = Counter(), Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            one.update(w)
            two.update(zip([b"\n", *w], w, strict=False))
    n, v = sum(one.values()), len(one)
    for i, w in tokens.items():
        p = [(one[x] + 0.1) / (n + 0.1 * (v + 1)) for x in w]
        score = sum(math.log10((two[h, x] + BACKOFF * q) / (one[h] + BACKOFF)) for h, x, q in zip([b"\n", *w], w, p, strict=False))
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(one[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(map(math.log10, p)), rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_model_adds_up_to_one():
    """Over all known tokens and one for all others, p(w|h) adds up to 1, as p(w) does."""
    counts, pairs = {"a": 5, "b": 2, "e": 3}, {("a", "b"): 2, ("a", "e"): 3}
    n, v = sum(counts.values()), len(counts)
    p = {w: (c + 0.1) / (n + 0.1 * (v + 1)) for w, c in counts.items()} | {"other": 0.1 / (n + 0.1 * (v + 1))}
    assert math.isclose(sum((pairs.get(("a", w), 0) + BACKOFF * q) / (counts["a"] + BACKOFF) for w, q in p.items()), 1.0)


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    rows = score_corpus(spark.read.parquet(f"{SF}/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)
    assert sum(r.score > r.base_score for r in rows) > 0.85 * len(rows)


def test_scores_of_odd_tables(spark):
    assert score_corpus(frame(spark, [])).collect() == []
    got = score_corpus(frame(spark, [(None, "a b"), (None, "a b"), (1, None)])).collect()
    assert sorted((r.n_tokens, r.held_out) for r in got)[0][0] == 1 and len(got) == 3


# --- toxicity -----------------------------------------------------------------------------------------------------


def brute_segments(x):
    """All maximal scoring segments by their definition: the best one, then the best of what is left on each side."""
    if not x or max(x) <= 0:
        return []
    best = max(((sum(x[i : j + 1]), -(j - i), -i, i, j) for i in range(len(x)) for j in range(i, len(x))))
    i, j = best[3], best[4]
    return [*brute_segments(x[:i]), (i, j), *[(a + j + 1, b + j + 1) for a, b in brute_segments(x[j + 1 :])]]


def test_segments_equal_their_definition():
    r = random.Random(6)
    for _ in range(300):
        x = [r.choice([-1.0, -1.0, -1.0, 0.7, 2.3, -3.1]) + r.random() * 1e-3 for _ in range(r.randrange(25))]
        assert [(a, b) for a, b, _ in segments(list(enumerate(x)), -1.0)] == brute_segments(x)
    assert segments([(0, 2.0), (3, 2.0), (50, 2.0)], -0.5) == [(0, 3, 3.0), (50, 50, 2.0)]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.97 * len(rows)
    assert sum(r.predicted for r in rows if r.toxic) >= 0.8 * sum(r.toxic for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_of_odd_tables(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (3, 1)], "doc_id long, toxic int")
    rows = [(1, "bad"), (2, "good"), (2, "good"), (None, "x"), (4, None), (5, "")]
    got = score_toxicity(frame(spark, rows), labels).collect()
    assert len(got) == 6 and {r.predicted for r in got if r.doc_id in (4, 5)} == {0}
    assert {r.predicted for r in score_toxicity(frame(spark, rows), labels.limit(0)).collect()} == {0}
    assert score_toxicity(frame(spark, []), labels).collect() == []
    assert drop_toxic(frame(spark, rows), labels).columns == frame(spark, rows).columns


def test_only_near_copies_of_one_label_teach_once(spark):
    r = random.Random(8)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    passage, text, other = words(60), words(100), words(100)
    rows = [(i, " ".join([*words(30), *passage, *words(30)])) for i in range(40)]  # a common passage makes no copy
    rows += [(i, " ".join([*text[: i - 100], "new", *text[i - 99 :]])) for i in range(150, 160)]  # near copies
    rows += [(i, "\n".join(other)) for i in range(200, 205)]  # exact copies, some with the other label
    rows += [(300, None), (301, ""), (302, "a b"), (303, "A  b"), (304, " ".join(text[:70]))]
    toxic = {i: int(i % 2 == 0 if i < 40 else i in (203, 204)) for i, _ in rows}
    labels = spark.createDataFrame([*toxic.items(), (200, 1)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    kept = without_copies(labelled_rows(docs, labels, docs.doc_id.isNotNull(), "doc_id", "text")).select("text", "toxic").collect()
    text_of = dict(rows)
    ids = [*range(40), 150, 200, 300, 301, 302, 304]
    want = [(text_of[i], toxic[i]) for i in ids] + [(text_of[200], 1)]
    assert Counter((x.text, x.toxic) for x in kept) == Counter(want)


# --- licenses -----------------------------------------------------------------------------------------------------


def test_licenses(spark):
    rows = [
        (1, "text\nReleased under the MIT License.\nmore text"),
        (2, "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0."),
        (3, "LICENSED UNDER THE APACHE LICENSE, VERSION 1.1."),
        (4, "this work is licensed under the GNU General Public licence, version 3."),
        (5, "a licence to kill and no permission at all"),
        (6, None),
        (7, ""),
        (8, "word " * 20_000 + "Released under the MIT License." + " word" * 20_000),
        (9, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and\nassociated documentation files (the \"Software\"), to deal in the Software without restriction"),
        (None, "Released under the MIT License."),
    ]
    found = defaultdict(list)
    for r in scan_licenses(frame(spark, rows)).orderBy("place").collect():
        text = dict(rows)[r.doc_id]
        found[r.doc_id].append((r.license, text[r.start : r.start + r.length], tuple(r.missing), tuple(r.added)))
    mit = ("MIT", "Released under the MIT License", (), ())
    assert found[1] == found[8] == found[None] == [mit]
    assert [x[0] for x in found[2]] == ["CC-BY-NC-4.0", "Apache-2.0"]
    assert [(x[0], x[2]) for x in found[4]] == [("GPL-3.0", ("license",))] and [x[0] for x in found[9]] == ["MIT"]
    assert set(found) == {1, 2, 4, 8, 9, None}
    assert scan_licenses(frame(spark, [])).collect() == []


#: Formal prose that shares many words with the long notices.
PROSE = (
    "The trustees may use the files of the society only in compliance with its rules, and any person obtaining a copy of the "
    "catalogue from the reading room may pass it on to others without restriction as long as the source of each item is named "
    "and a list of the changes is distributed with it. This work is described in the general report as published by the "
    "foundation, and the terms and conditions can be found in the first volume, which is free of charge to the public and to "
    "every later reader of these documents. ",
    " You may obtain further copies at the office, either by post or in person, subject to the terms that the board has set "
    "out. Permission is hereby given to quote from the software manual and from the associated papers, and the publisher may, "
    "at its option, release a new version of the international edition for general use in this form.",
)


def test_every_notice_is_found_in_formal_prose(spark):
    """Also those that other notices outrank by what they save."""
    rows = [(i, text.join(PROSE)) for i, (_, text) in enumerate(NOTICES)]
    got = sorted((r.doc_id, r.license, r.start) for r in scan_licenses(frame(spark, rows)).collect())
    assert got == [(i, name, len(PROSE[0])) for i, (name, _) in enumerate(NOTICES)]


def test_a_long_notice_is_not_cut_to_the_short_one_that_begins_it(spark):
    first, after = NOTICES[1][1].split(" at ")
    text = f"{first} at\n\n    {after}"
    got = [(r.license, text[r.start : r.start + r.length], r.missing, r.added) for r in scan_licenses(frame(spark, [(1, text)])).collect()]
    assert got == [("Apache-2.0", text, [], [])]


def test_a_notice_in_a_short_text_is_found_as_in_a_long_one(spark):
    """Whatever share of the text it saves."""
    sizes = (0, 60, 100, 200, 300, 400, len(PROSE[0]))
    texts = [(name, n, f"{PROSE[0][:n]} {text} {PROSE[1][: n // 3]}") for name, text in NOTICES for n in sizes]
    got = {r.doc_id: (r.license, r.start) for r in scan_licenses(frame(spark, [(i, x[2]) for i, x in enumerate(texts)])).collect()}
    assert got == {i: (name, n + 1) for i, (name, n, _) in enumerate(texts)}
