"""Suffix arrays against sorting, and removed bytes against a table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statewise.llm import induced_sorting, suffix_dedup
from statewise.llm.suffix_dedup import remove_repeated_bytes

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute_force(docs, width):
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(x[p : p + width] for _, x in data for p in range(len(x) - width + 1))
    out = []
    for i, x in data:
        gone = np.zeros(len(x) + 1, bool)
        for p in range(len(x) - width + 1):
            if seen[x[p : p + width]] > 1:
                gone[p : p + width] = True
        gone = gone[: len(x)]
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        starts = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(x) else 0
        out.append((i, len(x), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, width):
    return sorted(map(tuple, remove_repeated_bytes(df, width).select(COLUMNS).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.booleans(), st.integers(1, 6))
def test_suffix_array_and_common_prefixes(symbols, bucketed, width):
    text = np.array([*symbols, 0], np.uint8)
    held, induced_sorting.BUCKETED = induced_sorting.BUCKETED, 1024 if bucketed else 0
    try:
        sa = induced_sorting.suffix_array(text, 5)
    finally:
        induced_sorting.BUCKETED = held
    data = text.tobytes()
    assert sa.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    alike = induced_sorting.common_prefixes(text, sa, width)
    for i, j in zip(sa[1:].tolist(), sa[:-1].tolist(), strict=True):
        assert alike[i] == (data[i : i + width] == data[j : j + width] and max(i, j) + width <= len(data))


def test_long_runs_and_recursion():
    rng = random.Random(7)
    data = b"a" * 5000 + b"ab" * 3000 + bytes(rng.choices(b"abc", k=4000)) * 2
    text = np.append(np.frombuffer(data, np.uint8), np.uint8(0))
    sa = induced_sorting.suffix_array(text, 256)
    assert len(set(sa.tolist())) == len(text)
    step = [data[i : i + 9000] for i in sa[1:].tolist()]
    assert all(a <= b for a, b in zip(step, step[1:], strict=False))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=5), st.sampled_from([1, 3, 8, 20]))
def test_contexts_share_out_all_places(texts, width):
    for t in texts:
        data = t.encode()
        keys, starts, sizes = suffix_dedup.contexts(data, width)
        places = [(int(k), a + i) for k, a, n in zip(keys, starts.tolist(), sizes.tolist(), strict=True) for i in range(n)]
        assert [p for _, p in places] == list(range(max(0, len(data) - width + 1)))
        for a, n in zip(starts.tolist(), sizes.tolist(), strict=True):
            assert len({data[a + i : a + i + width] for i in range(n)}) == n
        named = {}
        assert all(named.setdefault(data[p : p + width], k) == k for k, p in places)


def planted(seed):
    rng = random.Random(seed)
    words = [
        "".join(rng.choices("abcdefghé東", k=rng.randint(1, 9))) for _ in range(300)
    ]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    line, passage = prose(12), prose(90)
    docs = [(i, f"{prose(rng.randint(0, 60))} {line} {prose(rng.randint(0, 60))}") for i in range(60)]
    docs += [(100 + i, prose(20) + passage[rng.randint(0, 200) :][: rng.randint(150, 500)] + prose(20)) for i in range(30)]
    docs += [(200 + i, docs[0][1]) for i in range(10)] + [(300, "x" * 3000), (301, "xy" * 700), (302, None), (303, ""), (None, passage), (7, passage)]
    return docs


@pytest.mark.parametrize("width", [200, 40])
def test_equals_brute_force(spark, width):
    docs = planted(width)
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, block int, key string").repartition(5)
    assert result(df, width) == brute_force(docs, width)


@pytest.mark.parametrize("anchors", [0, 2])
def test_hot_keys_are_split(spark, monkeypatch, anchors):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 3)
    monkeypatch.setattr(suffix_dedup, "MOST_ANCHORS", anchors)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2000)
    docs = planted(3)
    assert result(spark.createDataFrame(docs, "doc_id long, text string"), 60) == brute_force(docs, 60)


def test_table_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = brute_force([(r.doc_id, r.text) for r in table.collect()], 200)
    assert result(table, 200) == want and sum(r[2] for r in want) > 0


def test_whole_results_and_empty_table(spark):
    docs = planted(5)
    out = remove_repeated_bytes(spark.createDataFrame(docs, "doc_id long, text string"), 200, whole=True).collect()
    assert len(out) == len(docs)
    for r in out:
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
        assert sum(s.length for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans
    assert remove_repeated_bytes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
