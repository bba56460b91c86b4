"""Prefix trie, Merkle manifest and sharding against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tagflow.llm import merkle, shards, trie
from tagflow.llm.common import ranked


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_ranks_within_keys(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "b", "b"]), rng.choice([None, 1, 2, 3]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    got = defaultdict(list)
    for r in ranked(df, ["k"], ["v", "i"], "at", "n").collect():
        got[r["k"]].append((r["at"], r["v"], r["i"], r["n"]))
    for key, found in got.items():
        want = sorted(((v, i) for k, v, i in rows if k == key), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        assert [(v, i) for _, v, i, _ in sorted(found)] == want
        assert [at for at, *_ in sorted(found)] == list(range(len(want))) and {n for *_, n in found} == {len(want)}


# -- trie --------------------------------------------------------------------------


def brute_trie(convs):
    """{path: row} of conversations {id: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    def below(p):
        own = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        parts = [below(k) for k in kids[p]]
        return (sum(x[0] for x in parts) or 1, own + sum(x[1] for x in parts))

    out = []
    for p, ids in members.items():
        leaves, saved = below(p)
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(p))))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(kids[p]), leaves, saved, sha(ends)))
    return sorted(out, key=lambda r: (r[0], r[1], r[3], r[7]))


def as_turns(convs):
    return [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]


def trie_rows(df, batches=trie.BATCHES):
    ids = df.where("conv_id is not null").select("conv_id").distinct()
    got = trie.prefix_trie(trie.chains(trie.turns_of(df), ids), batches).drop("node").collect()
    return sorted(map(tuple, got), key=lambda r: (r[0], r[1], r[3], r[7]))


@pytest.mark.parametrize("seed,batches", [(1, 4), (2, 8), (3, 1)])
def test_trie(spark, seed, batches):
    rng = random.Random(seed)
    convs = {}
    for c in range(70):
        base = convs[rng.choice(list(convs))] if convs and rng.random() < 0.8 else []
        convs[c] = base[: rng.randrange(len(base) + 1)] + [("u", rng.choice(["é", "b", "", "long" * 9])) for _ in range(rng.choice([0, 1, 2, 9]))]
        convs[c] = convs[c] or [("u", "x")]
    df = spark.createDataFrame(as_turns(convs), "conv_id long, turn long, role string, text string")
    assert trie_rows(df, batches) == brute_trie(convs)


def test_trie_long_edges_and_copies(spark):
    long = [("u", str(i)) for i in range(300)]
    convs = {1: long, 2: long[:7], 3: long[:150] + [("a", "z")], 4: long, 5: [("u", "other")], 6: long[:151], 7: long}
    df = spark.createDataFrame(as_turns(convs), "conv_id long, turn long, role string, text string")
    assert trie_rows(df) == brute_trie(convs)


def test_trie_edge_cases(spark):
    rows = [(1, None, None, None), (1, 2, "u", "b"), (2, 0, "", ""), (2, 5, "u", "b"), (2, 5, "u", "b"), (None, 1, "u", "lost")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, node string")
    want = {1: [("", ""), ("u", "b")], 2: [("", ""), ("u", "b"), ("u", "b")]}
    assert trie_rows(df) == brute_trie(want)
    assert trie_rows(df.limit(0)) == []
    turnless = df.where("false").select("conv_id", F.lit(1).alias("place"), F.unhex(F.lit("00")).alias("digest"), F.lit(0).cast("long").alias("size"))
    ids = spark.createDataFrame([(3,), (9,)], "conv_id long")
    assert [tuple(r) for r in trie.prefix_trie(trie.chains(turnless, ids)).drop("node").collect()] == brute_trie({3: [], 9: []})


def test_trie_of_rebuilt(spark):
    rng = random.Random(8)
    own = {c: [("u", rng.choice("ab")) for _ in range(rng.randrange(1, 8))] for c in range(40) if c not in (10, 25)}
    want = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    df = spark.createDataFrame(as_turns(own), "conv_id long, turn long, role string, text string")
    got = trie.prefix_trie(trie.chains(*trie.rebuilt(df))).drop("node").collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[1], r[3], r[7])) == brute_trie(want)


def test_two_fattest(spark):
    pairs = [(a, b) for b in range(1, 40) for a in range(b)]
    got = spark.createDataFrame(pairs, "a int, b int").select("a", "b", trie.fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for r in got:
        assert r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda x: x & -x)


# -- manifest ----------------------------------------------------------------------


def brute_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(nodes, fanout):
    """(root, proof of each leaf as a list of (before, after))."""
    proofs, groups, level = [[] for _ in nodes], [[i] for i in range(len(nodes))], nodes
    while len(level) > 1:
        above, merged = [], []
        for a in range(0, len(level), fanout):
            run = level[a : a + fanout]
            for j, members in enumerate(groups[a : a + fanout]):
                for m in members:
                    proofs[m].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(sha("".join(run)))
            merged.append([m for g in groups[a : a + fanout] for m in g])
        level, groups = above, merged
    return level[0], proofs


def brute_manifest(rows, fanout):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append(r)
    trees = {}
    for s, docs in by_source.items():
        docs.sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        trees[s] = (docs, *brute_tree([brute_leaf(r) for r in docs], fanout))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, tops = brute_tree([trees[s][1] for s in order], fanout)
    out = []
    for s, top in zip(order, tops):
        docs, sub, proofs = trees[s]
        out += [(r[0], s, brute_leaf(r), sub, root, "".join(b + a for b, a in p + top)) for r, p in zip(docs, proofs)]
    return out


DOC = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("fanout,block", [(16, 4096), (3, 9), (4, 4)])
def test_manifest(spark, fanout, block):
    rng = random.Random(fanout)
    rows = [(i, rng.choice(["big", "big", "big", "é", "z", f"s{i % 9}", None]), rng.choice([None, "de"]), i, rng.choice(["", None, "Ä b", "x" * 3000])) for i in range(260)]
    rows += [rows[5], rows[5], (None, "big", None, None, None), (7, "lone", None, None, "one"), (7, "big", None, None, "same id")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], DOC + ", place int, digest string")
    upper = F.when(F.col("doc_id") % 5 == 0, F.upper("text")).otherwise(F.col("text"))
    got = merkle.prove(df, merkle.leaf({"text": upper}), fanout=fanout, block=block)
    found = got.withColumn("proof", merkle.proof_text(F.col("path"))).collect()
    key = lambda r: tuple((x is not None, x or 0 if isinstance(x, (int, type(None))) else x) if i == 0 else str(x) for i, x in enumerate(r))
    mine = sorted(((r["doc_id"], r["source"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in found), key=key)
    assert mine == sorted(brute_manifest(rows, fanout), key=key)
    changed = {r["leaf"] for r in found if not r["verified"]}
    want = {brute_leaf(r) for r in rows if r[0] is not None and r[0] % 5 == 0 and r[4] and r[4].upper() != r[4]}
    assert changed == want and want
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in found)


def test_manifest_of_one_and_none(spark):
    one = spark.createDataFrame([(1, None, None, None, "x")], DOC)
    r = merkle.prove(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] == brute_leaf((1, None, None, None, "x")) and r["verified"] and r["path"] == []
    assert merkle.prove(one.limit(0)).collect() == []


# -- shards ------------------------------------------------------------------------


def brute_capacity(sizes, n):
    """Smallest capacity of a contiguous partition into n parts, over all capacities."""
    def parts(c):
        used, room = 1, c
        for s in sizes:
            if s > room:
                used, room = used + 1, c
            room -= s
        return used

    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if parts(mid) <= n else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed,top_bits", [(1, 3), (2, 6), (3, 16)])
def test_capacity_is_the_smallest(spark, seed, top_bits):
    rng = random.Random(seed)
    texts = ["w" * rng.choice([1, 5, 30, 200]) + str(i) for i in range(400)]
    df = spark.createDataFrame([(i, t, "a", 9) for i, t in enumerate(texts)], "doc_id long, text string, shard string, size int")
    rows = shards.assign(df, 12, top_bits=top_bits).collect()
    hashes = {r[0]: r[1] for r in df.select("text", F.xxhash64("text")).collect()}
    sizes = [len(t) + 16 for t in sorted(texts, key=hashes.get)]
    load = defaultdict(int)
    for r in rows:
        load[r["shard"]] += r["size"]
    assert max(load.values()) == brute_capacity(sizes, 12) and set(load) <= set(range(12))
    placed = {r["doc_id"]: r["shard"] for r in rows}
    assert [placed[texts.index(t)] for t in sorted(texts, key=hashes.get)] == sorted(placed.values())


def test_shards_keep_copies_together(spark):
    rng = random.Random(4)
    texts = ["copy" * 200] * 300 + ["other" * 50] * 60 + [None, "", ""] + [f"{i} " * rng.randrange(1, 60) for i in range(500)]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, texts[3]), (3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = shards.assign(df, 40).collect()
    assert len(got) == len(rows)
    shard_of, slots, load = defaultdict(set), defaultdict(list), defaultdict(int)
    text_of = dict(rows)
    for r in got:
        text = text_of[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 16 and r["text_crc32"] == zlib.crc32(text.encode())
        shard_of[text].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    (hot,), = [shard_of["copy" * 200]]
    rest = [v for k, v in load.items() if k != hot and k not in shard_of["other" * 50]]
    assert max(rest) < 1.3 * sum(rest) / len(rest)
    assert shards.assign(df.limit(0), 40).count() == 0
    assert {r["shard"] for r in shards.assign(df.where("doc_id = 3"), 40).collect()} == {0}
