"""Sharding, mixing, formatting and decontamination against brute force, and their odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from statewise.llm import decontaminate
from statewise.llm.chat_format import chat_digests, escape, format_chats, read_turns, unescape
from statewise.llm.decontaminate import drop_leaking, leaks
from statewise.llm.mixing import mix_sources, mixed_rows
from statewise.llm.queries import TRAP
from statewise.llm.sharding import shard_by_bytes

DOCS = "doc_id long, text string, source string, hot int, shard string, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed, n=600):
    r = random.Random(seed)
    texts = [" ".join(r.choice(["é", "word", "x" * 9, "　b"]) for _ in range(r.randrange(40))) for _ in range(60)]
    rows = []
    for i in range(n):
        text = texts[0] + " hot" if i % 3 == 0 else r.choice([*texts, None, "", " \t", "long " * 900])
        rows.append((i * 7, text, "big" if i % 3 == 0 else r.choice(["a", "é", "Z", None, "src" + str(i % 5)]), 1, "s", "z"))
    return rows


def test_shards(spark):
    rows = corpus(1)
    got = shard_by_bytes(spark.createDataFrame(rows, DOCS).repartition(5), 24).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    text = {r[0]: r[1] or "" for r in rows}
    size = {i: len(t.encode()) + 8 for i, t in text.items()}
    assert all(r.size == size[r.doc_id] and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "bytes" for r in got)
    slots, total = defaultdict(list), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        total[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    largest = max(size.values())
    assert max(total.values()) - min(total.values()) <= 3 * largest
    groups = defaultdict(set)
    for r in got:
        groups[text[r.doc_id]].add(r.shard)
    in_group = Counter(text.values())
    for t, shards in groups.items():  # a group that is no larger than the largest document stays whole
        if in_group[t] * (len(t.encode()) + 8) <= largest:
            assert len(shards) == 1


def test_shards_of_odd_tables(spark):
    assert shard_by_bytes(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(None, None, None, 1, "s", "z"), (1, "a", None, 1, "s", "z"), (1, "a", None, 1, "s", "z")]
    assert len(shard_by_bytes(spark.createDataFrame(rows, DOCS)).collect()) == 3


def test_mix(spark):
    rows = corpus(2)
    got = mix_sources(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    of = {r[0]: r[2] for r in rows}
    sums = Counter()
    for i, n in size.items():
        sums[of[i]] += n
    names = sorted((s for s in sums if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sums.values()))
    while free:  # clamp what is above its cap, share the rest anew
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sums[s]]
        if not above:
            target |= share
            break
        for s in above:
            target[s] = 3.0 * sums[s]
            left -= target[s]
            free.remove(s)
    taken = Counter()
    for r in got:
        s = of[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sums[s] and math.isclose(r.target, target[s], abs_tol=1e-6)
        assert r.taken == r.size * r.epochs and 0 <= r.epochs <= 3
        taken[s] += r.taken
    largest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= largest / 2 + 1 for s in names)
    again = mix_sources(spark.createDataFrame(rows[::-1], DOCS).repartition(9)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    copies = Counter(r.doc_id for r in mixed_rows(spark.createDataFrame(rows, DOCS)).collect())
    assert copies == Counter({r.doc_id: r.epochs for r in got if r.epochs})


def test_mix_of_odd_tables(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(None, None, None, 1, "s", "z"), (1, "", "a", 1, "s", "z")]
    assert {(r.size, r.target, r.taken) for r in mix_sources(spark.createDataFrame(rows, DOCS)).collect()} == {(0, 0.0, 0)}
    rows = [(1, "a b", "a", 1, "s", "z")] * 2
    assert [r.taken for r in mix_sources(spark.createDataFrame(rows, DOCS)).collect()] == [2, 2]


TURNS = "conv_id long, turn int, role string, text string, lead string, turns int"


def test_chats_round_trip(spark):
    r = random.Random(3)
    texts = ["", None, TRAP, "<|end|>\n", "\\l", "\\\\<l", "<", "\\", "é<|next|>\u0000", "a\nb"]
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "sys<tem", None]), r.choice(texts), "x", 1) for c in range(40) for t in range(r.randrange(1, 9))]
    rows += [(None, 0, "assistant", "z", "x", 1), (99, 1, "user", "b", "x", 1), (99, 1, "user", "b", "x", 1), (99, None, "user", "c", "x", 1)]
    df = format_chats(spark.createDataFrame(rows, TURNS).repartition(3))
    want = defaultdict(list)
    for c, t, role, text, *_ in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        want[c].append((role or "", text or ""))
    for row in df.withColumn("turns", read_turns(F.col("formatted"))).collect():
        assert [tuple(t) for t in row.turns] == want[row.conv_id]
    for row in chat_digests(df).collect():
        turns, learned = want[row.conv_id], "".join(t for role, t in want[row.conv_id] if role == "assistant")
        assert row.n_turns == len(turns) and row.loss_chars == len(learned)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    for row in df.collect():  # nothing but texts is under the mask
        covered = [row.formatted[s.start : s.start + s.len] for s in row.loss_spans]
        assert all("<" not in x for x in covered)
    assert format_chats(spark.createDataFrame([], TURNS)).collect() == []


def test_escape_round_trip(spark):
    r = random.Random(4)
    texts = ["".join(r.choice("\\<l|p>a") for _ in range(r.randrange(12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, back in df.select("t", escape(F.col("t")), unescape(escape(F.col("t")))).collect():
        assert back == t and "<" not in e


def weighted(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()), sum((a | b).values())


def brute_leaks(docs, items):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    shingles = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    out = {}
    for item, t in items:
        w, n = shingles(words(t)), len(words(t))
        for doc, text in docs:
            d = words(text)
            for start in range(max(1, len(d) - n + 1)):
                x = shingles(d[start : start + n])
                both, union = weighted(w, x)
                if w and x and 100 * both >= 80 * union:
                    key, value = (doc, item), (-both / union, start)
                    out[key] = min(out.get(key, value), value)
    return {(d, i, -s, at) for (d, i), (s, at) in out.items()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_leaks_equal_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    r = random.Random(5)
    word = lambda: r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
    items = [(i, " ".join(word() for _ in range(r.randrange(5, 40)))) for i in range(15)] + [(50, "la la la la la la la la"), (51, "too short"), (52, None)]
    docs = []
    for i in range(60):
        t = [word() for _ in range(r.randrange(60))]
        passage = items[r.randrange(16)][1].split()
        for _ in range(r.randrange(3)):
            passage[r.randrange(len(passage))] = word()
        at = r.randrange(len(t) + 1)
        docs.append((i, ", ".join(t[:at] + passage + t[at:]).upper()))
    docs += [(90, None), (91, ""), (92, "la " * 30), (93, items[0][1][: len(items[0][1]) * 9 // 10])]
    a = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, item_id string, p int, block int").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id, x.similarity, x.start) for x in leaks(a, b).collect()}
    want = brute_leaks(docs, items)
    assert got == want and len(want) > 20
    kept = {x.doc_id for x in drop_leaking(a, b).collect()}
    assert kept == {d for d, _ in docs} - {x[0] for x in want} and drop_leaking(a, b).columns == a.columns


def test_many_items_of_one_length_are_not_held_against_all_windows(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=20))) for i in range(5000)]
    docs = [(i, " ".join([*rng.choices(words, k=30), items[7 * i][1], *rng.choices(words, k=30)])) for i in range(200)]
    rows = []

    def spy(read, anchors, real=decontaminate._met):
        out = real(read, anchors)
        rows.append(out.count())
        return out

    monkeypatch.setattr(decontaminate, "_met", spy)
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, 7 * i) for i in range(200)]
    assert rows[0] < 10 * 200


def test_a_very_long_text_leaks_at_its_end(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = spark.createDataFrame([(1, "the same words again " * 25_000 + item), (2, "x " * 100_000)], "doc_id long, text string")
    got = leaks(docs, spark.createDataFrame([(3, item), (4, "the same words again the same words again")], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.start) for r in sorted(got, key=lambda r: r.item_id)] == [(1, 3, 100_000), (1, 4, 0)]


def test_leaks_of_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "A b c d e f"), (7, "A b c d e f")], "item_id long, text string")
    assert sorted(((x.doc_id, x.item_id, x.similarity) for x in leaks(docs, items).collect()), key=str) == [(1, 7, 1.0), (None, 7, 1.0)]
    assert leaks(docs.limit(0), items).collect() == [] and leaks(docs, items.limit(0)).collect() == []
