"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent units read the UTF-8 bytes of a text in pieces of `STEP` bytes, one
forward and one backward; at every byte both states give a distribution over languages.
A document's probabilities are the means of those of all its bytes.
The network is trained in numpy by backpropagation through time on a bounded sample:
`PER_GROUP` documents of each language and hash group, at most `SAMPLE_CHARS` characters
of each, cut at a place drawn from the row's hash.

Defined cases: a text that is null or has no letter gets `und` and score 0; if nothing
could be learned (no labelled row) every text gets `und` and 0; a null doc_id is held in;
repeated rows get equal answers; an empty table gives an empty result. Language, source
and doc_id are never inputs of a prediction. Columns other than doc_id, text and, for
training, lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tagflow.llm.common import text_key

HIDDEN = 8
STEP = 128
SLAB = 1024          # pieces run side by side
PAD = 256            # row of the input table for places after a text's end
SAMPLE_CHARS = 768
GROUPS = 32          # hash groups of a language, so that no task ranks a whole language
PER_GROUP = 12
EPOCHS = 12
RATE = 0.02
SEED = 11
UNKNOWN = "und"


@dataclass
class Network:
    """Per direction: input table (257 x 3H), recurrent matrix (3H x H); shared output layer."""

    langs: list[str]
    table: list[np.ndarray]
    rec: list[np.ndarray]
    out: list[np.ndarray]
    bias: np.ndarray


def pieces(texts: list[bytes], step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pieces x step bytes with PAD, number of bytes of each piece, index of its text)."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    counts = (sizes + step - 1) // step
    owner = np.repeat(np.arange(len(texts)), counts)
    out = np.full(int(counts.sum()) * step, PAD, np.int16)
    at = np.concatenate(([0], np.cumsum(counts)[:-1])) * step if len(texts) else np.zeros(0, np.int64)
    for t, a in zip(texts, at):
        out[a : a + len(t)] = np.frombuffer(t, np.uint8)
    grid = out.reshape(-1, step)
    return grid, (grid != PAD).sum(1), owner


def _run(net: Network, side: int, codes: np.ndarray, keep: bool = False):
    """Hidden states of one direction, step by step; codes are (T, B). States are 0 after the end.

    Gates are linear between 0 and 1 (hard sigmoid), candidates x / (1 + |x|).
    """
    h_size = net.rec[0].shape[1]
    order = range(len(codes)) if side == 0 else range(len(codes) - 1, -1, -1)
    h = np.zeros((h_size, codes.shape[1]), np.float32)
    ragged = bool((codes == PAD).any())
    columns = np.ascontiguousarray(net.table[side].T)
    codes = codes.astype(np.intp)
    for t in order:
        x = codes[t]
        g = columns.take(x, axis=1)
        r = net.rec[side] @ h
        gates = g[: 2 * h_size]
        gates += r[: 2 * h_size]
        np.maximum(gates, 0, out=gates)
        np.minimum(gates, 1, out=gates)
        reset, update, inner, cand = gates[:h_size], gates[h_size:], r[2 * h_size :], g[2 * h_size :]
        cand += reset * inner
        below = np.abs(cand)
        below += 1
        cand /= below
        new = h - cand
        new *= update
        new += cand
        if ragged:
            new *= x != PAD
        yield (t, h, reset, update, inner, cand, new) if keep else (t, new)
        h = new


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(0)
    return z - np.log(np.exp(z).sum(0))


def piece_scores(net: Network, grid: np.ndarray) -> np.ndarray:
    """Sum over a piece's bytes of the distribution at each: (pieces x languages)."""
    out = np.zeros((len(grid), len(net.langs)), np.float32)
    for a in range(0, len(grid), SLAB):
        codes = np.ascontiguousarray(grid[a : a + SLAB].T)
        ragged = bool((codes == PAD).any())
        forward = np.empty((len(codes), len(net.langs), codes.shape[1]), np.float32)
        for t, h in _run(net, 0, codes):
            np.matmul(net.out[0], h, out=forward[t])
        total = np.zeros((len(net.langs), codes.shape[1]), np.float32)
        for t, h in _run(net, 1, codes):
            z = forward[t]
            z += net.out[1] @ h
            z += net.bias[:, None]
            z -= z.max(0)
            np.exp(z, out=z)
            z /= z.sum(0)
            if ragged:
                z *= codes[t] != PAD
            total += z
        out[a : a + SLAB] = total.T
    return out


def predict(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the language, its probability) of every text; the pieces of one call fit in memory."""
    grid, sizes, owner = pieces(texts)
    scores = np.zeros((len(texts), len(net.langs)))
    np.add.at(scores, owner, piece_scores(net, grid))
    n = np.bincount(owner, sizes, len(texts)) if len(owner) else np.zeros(len(texts))
    p = scores / np.maximum(n, 1)[:, None]
    best = p.argmax(1)
    return best, p[np.arange(len(texts)), best]


def init(langs: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
    centre = np.repeat(np.float32([0.5, 0.5, 0]), hidden)
    return Network(
        langs, [draw(257, 3 * hidden) + centre for _ in "fb"], [draw(3 * hidden, hidden) for _ in "fb"],
        [draw(len(langs), hidden) for _ in "fb"], np.zeros(len(langs), np.float32),
    )


def loss_and_gradients(net: Network, grid: np.ndarray, labels: np.ndarray):
    """Mean cross entropy over all bytes, and its gradients by backpropagation through time."""
    codes = np.ascontiguousarray(grid.T)
    steps, batch = codes.shape
    h_size = net.rec[0].shape[1]
    runs = [list(_run(net, s, codes, keep=True)) for s in (0, 1)]
    by_time = [{r[0]: r[6] for r in run} for run in runs]
    mask = (codes != PAD).astype(np.float32)
    n = max(mask.sum(), 1.0)
    target = np.zeros((len(net.langs), batch), np.float32)
    target[labels, np.arange(batch)] = 1
    loss, dz = 0.0, [None] * steps
    d_out = [np.zeros_like(o) for o in net.out]
    d_bias = np.zeros_like(net.bias)
    for t in range(steps):
        logp = _log_softmax(net.out[0] @ by_time[0][t] + net.out[1] @ by_time[1][t] + net.bias[:, None])
        loss -= float((logp * target * mask[t]).sum()) / n
        dz[t] = (np.exp(logp) - target) * mask[t] / n
        d_bias += dz[t].sum(1)
        for s in (0, 1):
            d_out[s] += dz[t] @ by_time[s][t].T
    d_table = [np.zeros_like(x) for x in net.table]
    d_rec = [np.zeros_like(x) for x in net.rec]
    for s in (0, 1):
        dh = np.zeros((h_size, batch), np.float32)
        for t, before, reset, update, inner, cand, _ in reversed(runs[s]):
            dh = (dh + net.out[s].T @ dz[t]) * mask[t]
            d_cand = dh * (1 - update) * (1 - np.abs(cand)) ** 2
            d_update = dh * (before - cand) * ((update > 0) & (update < 1))
            d_reset = d_cand * inner * ((reset > 0) & (reset < 1))
            pre = np.concatenate([d_reset, d_update, d_cand])
            back = np.concatenate([d_reset, d_update, d_cand * reset])
            np.add.at(d_table[s], codes[t], pre.T)
            d_rec[s] += back @ before.T
            dh = dh * update + net.rec[s].T @ back
    return loss, [*d_table, *d_rec, *d_out, d_bias]


def fit(texts: list[bytes], langs: list[str], epochs: int = EPOCHS, seed: int = SEED, batch: int = 64, step: int = 64) -> Network | None:
    """Adam over pieces of the labelled texts, languages weighted equally by resampling."""
    names = sorted(set(langs))
    if not names:
        return None
    net = init(names, seed=seed)
    grid, sizes, owner = pieces(texts, step)
    label = np.array([names.index(x) for x in langs])[owner]
    full = sizes >= min(16, sizes.max(initial=0))
    grid, label = grid[full], label[full]
    if not len(grid):
        return None
    rng = np.random.default_rng(seed)
    groups = [np.flatnonzero(label == k) for k in range(len(names))]
    groups = [g for g in groups if len(g)]
    each = min(512, max(len(g) for g in groups))
    params = [*net.table, *net.rec, *net.out, net.bias]
    m, v, k = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = rng.permutation(np.concatenate([rng.choice(g, each, replace=len(g) < each) for g in groups]))
        for a in range(0, len(order), batch):
            rows = order[a : a + batch]
            _, grads = loss_and_gradients(net, grid[rows], label[rows])
            k += 1
            rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for p, g, mm, vv in zip(params, grads, m, v):
                mm += 0.1 * (g - mm)
                vv += 0.01 * (g * g - vv)
                p -= (rate * (mm / (1 - 0.9**k)) / (np.sqrt(vv / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
    return net


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, per_group: int = PER_GROUP, groups: int = GROUPS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """lang, piece: a bounded number of held-in labelled documents of each language."""
    key = text_key(F.col("text"))
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", key.alias("k"))
    group = Window.partitionBy("lang", F.pmod("k", F.lit(groups))).orderBy("k", "text")
    start = F.pmod(F.shiftright("k", 16), F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    return (
        rows.select("lang", "k", F.substring("text", start, F.lit(chars)).alias("text"))
        .withColumn("rank", F.row_number().over(group))
        .where(F.col("rank") <= per_group)
        .select("lang", F.col("text").alias("piece"))
    )


def train(docs: DataFrame) -> Network | None:
    rows = sorted((r["lang"], r["piece"]) for r in training_sample(docs).collect())
    return fit([t.encode() for _, t in rows], [lang for lang, _ in rows])


def labels(net: Network | None):
    """Column function: text to struct(lang_pred, score), whole texts, a bounded number of bytes at a time."""
    limit = SLAB * STEP * 4

    def one_batch(texts: list[bytes]) -> pd.DataFrame:
        preds, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        todo = sorted((i for i, t in enumerate(texts) if t), key=lambda i: len(texts[i])) if net is not None else []
        while todo:
            part, size = [], 0
            while todo and (not part or size + len(texts[todo[-1]]) <= limit):
                part.append(todo.pop())
                size += len(texts[part[-1]])
            best, score = predict(net, [texts[i] for i in part])
            for i, b, s in zip(part, best, score):
                preds[i], scores[i] = net.langs[b], float(min(max(s, 0.0), 1.0))
        return pd.DataFrame({"lang_pred": preds, "score": scores})

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield one_batch([t.encode() if t else b"" for t in texts])

    by_text = F.pandas_udf(run, "lang_pred string, score double")
    return lambda text: by_text(F.when(text.rlike(r"\p{L}"), text).otherwise(F.lit("")))


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, tk (text hash), held_out, lang_pred, score; one row per document row."""
    return docs.select(
        "doc_id", text_key(F.col("text")).alias("tk"), held_out().alias("held_out"), labels(net)(F.col("text")).alias("found")
    ).select("doc_id", "tk", "held_out", "found.lang_pred", "found.score")


def confident(docs: DataFrame, net: Network | None, least: float) -> DataFrame:
    """The rows whose language is named with a score of at least `least`; all columns stay."""
    found = labels(net)(F.col("text"))
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least))
