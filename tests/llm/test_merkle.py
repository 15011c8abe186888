"""Merkle trees against a version that holds all nodes, and the layout against its definition."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from statewise.llm import merkle
from statewise.llm.merkle import addresses, build_block, counts_of, manifest, sibling_runs, tamper, tree_size

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block string, root int"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, i):
    """For each level below the root, the place in the run and the run."""
    for level in tree[:-1]:
        yield i % 8, level[i // 8 * 8 : i // 8 * 8 + 8]
        i //= 8


def brute_force(docs):
    groups = {}
    for doc_id, text, lang, source, n_chars in docs:
        changed = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text) if changed else text
        own = leaf(doc_id, text, lang, source, n_chars)
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, own, leaf(doc_id, lower, lang, source, n_chars)))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = levels([r[2] for r in groups[name]])
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for g, name in enumerate(names):
        for i, (there, doc_id, own, found) in enumerate(groups[name]):
            steps = [*path(trees[name], i), *path(top, g)]
            proof = "".join("".join(run[:p] + run[p + 1 :]) for p, run in steps)
            for p, run in steps:
                found = sha("".join([*run[:p], found, *run[p + 1 :]]))
            root = top[-1][0]
            out.append((doc_id if there else None, own, trees[name][-1][0], root, sha(proof), found, found == root))
    return sorted(out, key=str)


def result(spark, docs):
    df = spark.createDataFrame([(i, t, g, s, n, "b", 1) for i, t, g, s, n in docs], SCHEMA)
    made = manifest(df.repartition(3), tampered=tamper(F.col("doc_id"), F.col("text")))
    return sorted(map(tuple, made.proofs().select(COLUMNS).collect()), key=str)


def documents(n, langs, seed=1):
    rng = random.Random(seed)
    texts = ["", None, "ABC abc", "É ÀB", "x" * 100_000, "Y" * 30]
    return [(rng.randrange(10 * n) - n, rng.choice(texts), rng.choice(langs), rng.choice(["web", None, "2:ab"]), rng.choice([None, 0, 7])) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65])
def test_small_tables(spark, n):
    docs = documents(n, ["de", None, "", "z"], n)
    assert result(spark, docs) == brute_force(docs)


def test_tiers_of_small_blocks(spark, monkeypatch):
    # Blocks of one and two steps, so that 700 leaves take four and two tiers; more groups than a block of the top holds.
    docs = documents(700, ["de", "de", "de", *(f"l{i}" for i in range(80))]) + [(None, "same", "de", "s", 4)] * 9 + [(5, "same", "de", "s", 4)] * 9
    want = brute_force(docs)
    for height in (1, 2):
        monkeypatch.setattr(merkle, "BLOCK_HEIGHT", height)
        monkeypatch.setattr(merkle, "BROADCAST_OFFSETS", 100_000 * (height - 1))
        assert result(spark, docs) == want


def test_empty_table_and_proofs(spark):
    empty = manifest(spark.createDataFrame([], SCHEMA))
    assert empty.root() is None and empty.proofs().count() == 0
    docs = documents(30, ["a", "b"])
    made = manifest(spark.createDataFrame([(*d, "b", 1) for d in docs], SCHEMA))
    rows = made.proofs(whole=True).collect()
    assert {r.root for r in rows} == {made.root()} and all(r.verified for r in rows)
    assert all(hashlib.sha256(r.proof.encode()).hexdigest() == r.proof_sha256 and len(r.proof) % 64 == 0 for r in rows)


def test_layout_is_van_emde_boas():
    def places(level_count):
        """Nodes (depth, index) in order, by the definition."""
        if level_count == 1:
            return [(0, 0)]
        upper = level_count // 2
        out = places(upper)
        for root in range(8**upper):
            out += [(upper + d, root * 8**d + i) for d, i in places(level_count - upper)]
        return out

    for level_count in (1, 2, 3, 4):
        want = {node: at for at, node in enumerate(places(level_count))}
        at = addresses(level_count)
        assert tree_size(level_count) == len(want)
        assert all(at[d][i] == place for (d, i), place in want.items())


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 100, 512])
def test_blocks_hold_the_tree(n):
    digests = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(n)]
    tree = levels([d.hex() for d in digests])
    height = merkle.height_of(n)
    assert height == len(tree) - 1
    nodes = build_block(digests, height)
    assert nodes[:32].hex() == tree[-1][0] and counts_of(n, height)[::-1] == [len(x) for x in tree]
    runs = sibling_runs(nodes, n, height)
    assert runs == [["".join(level[i : i + 8]) for i in range(0, len(level), 8)] for level in tree[:-1]]
