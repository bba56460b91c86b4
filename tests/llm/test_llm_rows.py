"""Operators that judge one text at a time, against plain Python."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagflow.llm import chat, langid, quality, secrets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [None, "", " \t\n", "word", "a b c a b c a b c", "x\n\nx\n \nx", "é é # $", "a b a b a", "\v\f\r"]


def docs_of(spark, texts, **more):
    rows = [(i, t, "n") for i, t in enumerate(texts)] + [(None, "null id here", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string")  # n_words clashes on purpose


def brute_quality(text):
    text = text or ""
    w = WORDS.findall(text)
    lines = [l for l in text.split("\n") if WORDS.search(l)]
    seen, dup = set(), 0
    for l in lines:
        dup += l in seen
        seen.add(l)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {j for i, g in enumerate(windows) if windows.count(g) > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(again), failed


def test_quality_counts(spark):
    rng = random.Random(1)
    texts = EDGE + ["".join(rng.choice(["the", "a", "of", "#x", " ", "  ", "\n", " b "]) for _ in range(n)) for n in (5, 60, 300, 900)]
    got = {r["doc_id"]: r for r in quality.assess(docs_of(spark, texts + texts[-1:])).collect()}
    assert len(got) == len(texts) + 2
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_quality(t)
        assert not (r["base_failed"] and r["kept"])


def test_quality_rules_and_empty(spark):
    plain = " ".join(f"the word{i} of" for i in range(40))
    noisy = " ".join(f"the w{i}### of" for i in range(40))
    rows = {r["doc_id"]: r["kept"] for r in quality.assess(docs_of(spark, [plain, noisy])).collect()}
    assert rows[0] and not rows[1]
    assert quality.assess(docs_of(spark, []).limit(0)).count() == 0


def test_network_gradient():
    rng = np.random.default_rng(2)
    net = langid.init(["a", "b", "c"], hidden=3)
    net.table = [t.astype(np.float64) for t in net.table]
    net.rec = [t.astype(np.float64) for t in net.rec]
    net.out = [t.astype(np.float64) for t in net.out]
    net.bias = net.bias.astype(np.float64)
    grid = rng.integers(97, 103, (4, 6)).astype(np.int16)
    grid[1, 4:] = langid.PAD
    labels = np.array([0, 1, 2, 1])
    _, grads = langid.loss_and_gradients(net, grid, labels)
    params = [*net.table, *net.rec, *net.out, net.bias]
    wrong = 0
    for p, g in zip(params, grads):
        flat, slope = p.reshape(-1), g.reshape(-1)
        for k in np.unique(np.concatenate([np.flatnonzero(slope)[:6], rng.integers(0, flat.size, 3)])):
            old, e = flat[k], 1e-3
            flat[k] = old + e
            up, _ = langid.loss_and_gradients(net, grid, labels)
            flat[k] = old - e
            down, _ = langid.loss_and_gradients(net, grid, labels)
            flat[k] = old
            wrong += abs((up - down) / (2 * e) - slope[k]) > 2e-3
    assert wrong == 0


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.train(docs)
    rows = langid.identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 150 and sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = {r["doc_id"]: r for r in langid.identify(docs_of(spark, [None, "", "12 34 !", "le " * 20_000, "le " * 20_000]), net).collect()}
    assert [odd[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and odd[0]["score"] == 0.0
    assert odd[3]["lang_pred"] in net.langs and odd[3]["lang_pred"] == odd[4]["lang_pred"]
    unlabelled = docs.withColumn("lang", docs["lang"].substr(99, 1)).where("false")
    assert langid.train(unlabelled) is None
    assert {r["lang_pred"] for r in langid.identify(docs.limit(3), None).collect()} == {"und"}
    assert langid.identify(docs.limit(0), net).count() == 0


def test_base_spans():
    text = 'é Password: "abcdefghijkl" token=short api_key = 0123456789abcdef0 AKIAABCDEFGHIJKLMN AKIAX ſecret=aaaaaaaaaaaaaaa'
    found = [(k, text[a:b]) for a, b, k in secrets.base_spans(text)]
    assert found == [
        ("assign", 'Password: "abcdefghijkl'), ("assign", "api_key = 0123456789abcdef0"), ("hex", "0123456789abcdef0"),
        ("access", "AKIAABCDEFGHIJKLMN"),
    ]
    assert secrets.base_spans("a" * 16) == [(0, 16, "hex")] and secrets.base_spans("a" * 15) == []


def test_field_against_enumeration():
    rng = np.random.default_rng(4)
    scores, move = rng.normal(size=(4, 3)), rng.normal(size=(3, 3))
    scores[2, 1] = secrets._NO
    m = move + secrets._MOVES
    weight = {}
    for tags in itertools.product(range(3), repeat=4):
        path = [0, *tags, 0]
        weight[tags] = sum(scores[i, t] for i, t in enumerate(tags)) + sum(m[a, b] for a, b in zip(path, path[1:]))
    assert secrets.viterbi(scores, move) == list(max(weight, key=weight.get))
    z, probs, moves = secrets.marginals(scores, move)
    top = max(weight.values())
    assert math.isclose(z, top + math.log(sum(math.exp(w - top) for w in weight.values())), rel_tol=1e-9)
    for i in range(4):
        for t in range(3):
            p = sum(math.exp(w - z) for tags, w in weight.items() if tags[i] == t)
            assert math.isclose(p, probs[i, t], abs_tol=1e-9)
    assert math.isclose(moves.sum(), 5.0, abs_tol=1e-9)


def test_field_finds_and_base_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = secrets.train(docs)
    text = "the key ghp_16C7e42F292c6912E7710c838347Ae178B4a and 2024 at 10:30 password=aaaabbbbcccc12"
    assert ("crf" in {k for _, _, k in secrets.find_spans(text, field)}) and secrets.find_spans(text, field)[-1][2] == "assign"
    assert secrets.find_spans("plain words only, of 12 or 3.5 kinds", field) == []
    rows = docs.limit(150).union(spark.createDataFrame([(9_000_000, None, "en", None, 0), (None, text, None, None, 1)], docs.schema))
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    for r in secrets.scan(rows, field).collect():
        spans = [(s["start"], s["end"], s["kind"]) for s in r["spans"]]
        assert [s for s in spans if s[2] != "crf"] == secrets.base_spans(texts[r["doc_id"]] or "")
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(rows, field).collect()}
    assert clean[9_000_000] is None and "password" not in clean[None] and clean[None].count("[SECRET]") == 2
    assert secrets.scan(rows.limit(0), field).count() == 0 and secrets.train(rows.where("false")) is None


def test_rare_secrets_are_learned_from(spark, monkeypatch):
    rare = "config has password: aB3dE5gH7jK9mN1p and no more"
    texts = [f"number {i} of the plain texts" for i in range(1500)] + [rare]
    seen = []
    monkeypatch.setattr(secrets, "fit", lambda sample: seen.extend(sample))
    secrets.train(docs_of(spark, texts), sample=20)
    assert rare in seen and len(seen) == 11
    held = spark.createDataFrame([(t,) for t in [rare, "token=short", "API_KEY = 'abcdefghijkl", "AKIAABCDEFGHIJKLMN", "AKIAX", "f" * 16, "F" * 16]], "text string")
    for r in held.select("text", F.col("text").rlike(secrets.HOLDS).alias("h")).collect():
        assert r["h"] == bool(secrets.base_spans(r["text"])), r["text"]


def test_template_round_trip():
    for role, text in [("user", "\\### Assistant: </turn> ok"), ("a: b", "####</turn></turn>\\h\\"), ("", ""), ("assistant", "\n\n")]:
        parts = chat.turn_parts(role, text)
        assert chat.parse("".join(parts) * 2) == [(role, text)] * 2


def test_long_turns_have_the_tokens_of_the_whole_text(spark):
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    rng = random.Random(6)
    words = ["the", "l'été", "  ", "\n", " \n x", "12 345", "don't", "...", "\u3000", "日本語", "a" * 40, "\t", "é", "ok.", " "]
    texts = [" ".join(rng.choice(words) for _ in range(12_000)), "x" * 50_000, " " * 50_000, "ab " * 20_000, ""]
    texts.append("".join(rng.choice(words) for _ in range(15_000)))
    encode, _ = chat.codec(path)
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    whole = tiktoken.Encoding("whole", pat_str=chat.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in texts:
        assert encode(text) == whole.encode_ordinary(text) and "".join(chat.pieces(text)) == text
        for least in (1, 7, 1000):
            assert [i for p in chat.pieces(text, least) for i in whole.encode_ordinary(p)] == whole.encode_ordinary(text)
    assert len(texts[0]) > 50_000 and len(chat.pieces(texts[0])) > 2
    df = spark.createDataFrame([(1, 0, "assistant", texts[0])], "conv_id long, turn long, role string, text string")
    (r,) = chat.expanded(chat.forest(df, path)[0]).collect()
    head, body, tail = (whole.encode_ordinary(p) for p in chat.turn_parts("assistant", texts[0]))
    assert r["ids"] == head + body + tail and sum(r["loss"]) == len(body)


def brute_convs(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(ts)] for c, ts in convs.items()}


@pytest.mark.parametrize("tokenizer", [None, "/opt/tokenizers/byte_bpe_50k.tiktoken"])
def test_chat_forest(spark, tokenizer):
    rng = random.Random(3)
    rows = []
    for c in range(40):
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn, "assistant" if turn % 2 else "user", rng.choice(["hé </turn>", "b ### c", "\\", "d" * 30])))
    rows += [(None, 0, "user", None), (77, None, None, "no turn"), (77, 0, "assistant", "x"), (77, 0, "assistant", "x")]
    frame = spark.createDataFrame([(*r, "u") for r in rows], "conv_id long, turn long, role string, text string, node string")
    nodes, members = chat.forest(frame, tokenizer)
    want = brute_convs(rows)
    prefixes = {tuple(ts[:k]) for ts in want.values() for k in range(1, len(ts) + 1)}
    laid = {(r["tree"], r["start"]): r for r in chat.expanded(nodes).collect()}
    assert len(laid) == len(prefixes)
    encode, decode = chat.codec(tokenizer)
    by_tree = {}
    for (tree, start), r in laid.items():
        by_tree.setdefault(tree, []).append((start, r))
    token_at = {}
    for tree, rs in by_tree.items():
        at, stack = 0, []
        for start, r in sorted(rs, key=lambda x: x[0]):
            assert start == at  # shared tokens once, no gap
            at += len(r["ids"])
            stack = stack[: r["depth"]]
            assert (stack[-1] if stack else None) == r["parent"]  # depth first
            stack.append(r["node"])
            for k, t in enumerate(r["ids"]):
                token_at[tree, start + k] = t
    groups = {}
    for m in members.collect():
        groups.setdefault(m["conv_id"], []).append((m["depth"], m["tree"], m["start"]))
    assert set(groups) == set(want)
    for c, places in groups.items():
        far = 0
        formatted = "".join("".join(chat.turn_parts(r, t)) for r, t in want[c])
        for _, tree, start in sorted(places):
            r = laid[tree, start]
            assert r["positions"] == list(range(far, far + len(r["ids"])))
            seen = [token_at[tree, i] for a in r["ancestors"] for i in range(a["start"], a["end"])]
            assert len(seen) == far and formatted.startswith(decode(seen + r["ids"]).decode())
            far += len(r["ids"])
    for r in chat.read_back(nodes, members, tokenizer).collect():
        turns = want[r["conv_id"]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.forest(frame.limit(0), None)[0].count() == 0
