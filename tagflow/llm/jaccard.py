"""N-gram Jaccard join by MinHash banding, with pairs verified on full n-gram sets.

Texts with the same n-gram set form one class (copies), whose set is signed once. Class
signatures are cut into bands; classes sharing a band are candidates, and those that
hang together form candidate groups. A group is cut into blocks, every pair of blocks is
compared on full n-gram sets, and the links found are counted there, not listed: a group
of m near copies takes m * m / BLOCK rows. Band and row counts have the most rows a band
that reach the target recall at the threshold within MOST_HASHES.

Defined cases: words are lower-cased (A-Z) runs of letters, digits and non-ASCII
characters; a text of fewer than `n` words, but not none, has one n-gram of all of them;
a text without words (null and empty too) has no set, no links and a class of its own
per row key; rows of one doc_id with different texts are rows of their own; repeated rows
are copies of each other; a class id is the smallest doc_id of the linked documents (null
if they have none); empty tables give an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tagflow.llm.common import bloom, cut, may_hold, row_key, text_key
from tagflow.llm.components import components

N_WORDS = 5
BLOCK = 256         # classes compared with each other in one task
STRIPE = 4096       # n-grams of a block pair held as a matrix at once
THRESHOLD = 0.8
RECALL = 0.9995
MOST_HASHES = 110
SEED = 3
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def plan_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, so the fewest false candidates, whose bands reach
    the recall at the threshold within the number of hashes."""
    for rows in range(most, 0, -1):
        miss = np.log1p(-(threshold**rows)) if threshold < 1 else -np.inf
        if miss < 0 and (bands := int(np.ceil(max(np.log(1 - recall) / miss, 1)))) * rows <= most:
            return bands, rows
    raise ValueError("no banding reaches the recall within the hashes")


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """64-bit hashes of words; starts anew when it holds 65,536, to stay small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 16:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, n: int, known: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a whole text."""
    found = WORD.findall(text.encode().lower()) if text else []  # bytes: only A-Z change
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(31) + h[k : k + len(out)])
    return np.unique(out)


def multipliers(bands: int, rows: int, seed: int = SEED) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sign(hashes: np.ndarray, bands: int, rows: int, odd: np.ndarray) -> np.ndarray:
    """Band keys of a set: minima under odd multipliers, folded by band."""
    low = np.fromiter(((hashes * m).min() for m in odd), np.uint64, len(odd))
    grid = mix64(low.reshape(bands, rows))
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        key = mix64(key * np.uint64(31) + grid[:, r])
    return key.view(np.int64)


def set_key(hashes: np.ndarray) -> str | None:
    """128 bits that stand for the whole set; None for the empty one."""
    return xxhash.xxh3_128_hexdigest(hashes.tobytes()) if len(hashes) else None


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, tk, sk (set key), n (size of the set), bands (keys)."""
    wanted = docs.select("doc_id", text_key(F.col("text")).alias("tk"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, odd = WordHash(), multipliers(bands, rows)
        for batch in batches:
            keys, sizes, signed = [], [], []
            for text in batch.column("text"):
                hashes = shingle_set(text.as_py(), n, known)
                keys.append(set_key(hashes))
                sizes.append(len(hashes))
                signed.append(sign(hashes, bands, rows, odd) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tk"), pa.array(keys, pa.string()), pa.array(sizes, pa.int32()),
                 pa.array(signed, pa.list_(pa.int64()))],
                ["doc_id", "tk", "sk", "n", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return wanted.mapInArrow(run, f"doc_id {kind}, tk bigint, sk string, n int, bands array<bigint>")


def _sets(texts: DataFrame, n: int) -> DataFrame:
    """sk, grams: the full set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            found = [shingle_set(t.as_py(), n, known) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(h) for h in found], pa.string()),
                 pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))],
                ["sk", "grams"],
            )

    return texts.select("text").mapInArrow(run, "sk string, grams array<bigint>")


def candidate_groups(classes: DataFrame) -> DataFrame:
    """sk, component: classes connected by shared bands; a linked pair is in one component."""
    keys = classes.select("sk", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("sk").alias("lead"), F.max("sk").alias("last")).where("lead <> last")
    stars = keys.join(shared.select("key", "lead"), "key").select(F.col("sk").alias("a"), F.col("lead").alias("b")).where("a <> b")
    return components(stars).select(F.col("node").alias("sk"), "component")


def linked_within(sets: list[np.ndarray], threshold: float, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Boolean matrix: row i of `first` and column j of `second` reach the threshold; exact."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    values, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = count[code] > 1
    slot = np.cumsum(count > 1) - 1
    code, owner = slot[code[shared]], owner[shared]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    both = np.zeros((len(first), len(second)), np.float32)
    for low in range(0, int(code.max(initial=-1)) + 1, STRIPE):
        a, b = np.searchsorted(code, (low, low + STRIPE))
        held = np.zeros((len(sets), STRIPE), np.float32)
        held[owner[a:b], code[a:b] - low] = 1
        both += held[first] @ held[second].T
    union = sizes[first][:, None] + sizes[second][None, :] - both
    return both >= threshold * union


def links(docs: DataFrame, signed: DataFrame, classes: DataFrame, n: int, threshold: float, block: int = BLOCK) -> DataFrame:
    """sk, root, linked: for each class and block pair, a class it hangs together with and how many
    documents of other classes it is linked to there.

    The classes of a candidate component are cut into blocks by hash; every pair of blocks is
    compared on full sets in one task, which counts links instead of listing them.
    """
    grouped = cut(candidate_groups(classes))
    blocks = grouped.groupBy("component").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("k"))
    size = classes.select("sk", "size")
    members = cut(
        grouped.join(size, "sk").join(blocks, "component")
        .withColumn("mine", F.pmod(F.xxhash64("sk"), F.col("k")).cast("int"))
    )
    # One row stands for each class, so that the copies of a text do not move with it.
    one = F.min(F.struct("doc_id", "tk")).alias("one")
    of = cut(
        signed.join(grouped.select("sk"), "sk", "left_semi").groupBy("sk").agg(one)
        .select(row_key(F.col("one.doc_id"), F.col("one.tk")).alias("rk")).distinct()
    )
    texts = docs.select("text", row_key(F.col("doc_id"), text_key(F.col("text"))).alias("rk")).where(
        may_hold(bloom(of.select(F.xxhash64("rk").alias("h"))), F.xxhash64("rk"))
    )
    sets = _sets(texts.join(of, "rk", "left_semi"), n)
    sets = cut(sets.groupBy("sk").agg(F.first("grams").alias("grams")))
    dealt = members.join(sets, "sk").select(
        "component", "sk", "size", "mine", "grams", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    ).select("component", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "sk", "size", "mine", "grams")

    def compare(key, pdf: pd.DataFrame) -> pd.DataFrame:
        _, x, y = key
        found = [np.asarray(g, np.int64).view(np.uint64) for g in pdf["grams"]]
        mine, size, names = pdf["mine"].to_numpy(), pdf["size"].to_numpy(), pdf["sk"].to_numpy()
        first, second = np.flatnonzero(mine == x), np.flatnonzero(mine == y)
        if not len(first) or not len(second):
            return pd.DataFrame({"sk": [], "root": [], "linked": []})
        link = linked_within(found, threshold, first, second)
        if x == y:
            np.fill_diagonal(link, False)
        linked = np.zeros(len(pdf), np.int64)
        linked[first] += link @ size[second]
        if x != y:
            linked[second] += size[first] @ link
        root = np.arange(len(pdf))
        while True:  # the smallest index reachable, by repeated minima over links
            low = np.where(link, root[second][None, :], len(pdf)).min(1)
            new = root.copy()
            new[first] = np.minimum(new[first], low)
            high = np.where(link, new[first][:, None], len(pdf)).min(0)
            new[second] = np.minimum(new[second], high)
            if (new == root).all():
                break
            root = new
        some = linked > 0
        return pd.DataFrame({"sk": names[some], "root": names[root[some]], "linked": linked[some]})

    return dealt.groupBy("component", "x", "y").applyInPandas(compare, "sk string, root string, linked long")


def join(docs: DataFrame, n: int = N_WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, tk (text hash), class_id, n_links, group; one row per document row."""
    bands, rows = plan_bands(threshold, recall)
    signed = cut(signatures(docs, n, bands, rows))
    classes = cut(
        signed.where("sk is not null").groupBy("sk").agg(
            F.count("*").alias("size"), F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("bands").alias("bands")
        )
    )
    found = cut(links(docs, signed, classes, n, threshold))
    degree = found.groupBy("sk").agg(F.sum("linked").alias("degree")).withColumnRenamed("sk", "a")
    member = cut(components(found.select(F.col("sk").alias("a"), F.col("root").alias("b"))))
    low = (
        member.join(classes, member["node"] == classes["sk"]).groupBy("component").agg(F.min("low").alias("class_id"))
    )
    group = member.join(low, "component").select("node", "class_id", "component")
    info = (
        classes.join(degree, classes["sk"] == degree["a"], "left").join(group, classes["sk"] == group["node"], "left")
        .select(
            "sk", F.when(F.col("node").isNotNull(), F.col("class_id")).otherwise(F.col("low")).alias("class_id"),
            (F.col("size") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links"), F.coalesce("component", "sk").alias("group"),
        )
    )
    return signed.select("doc_id", "tk", "sk").join(info, "sk", "left").select(
        "doc_id", "tk", F.when(F.col("sk").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("group", row_key(F.col("doc_id"), F.col("tk"))).alias("group"),
    )


def one_of_each(docs: DataFrame, n: int = N_WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of `docs`, all columns, without all but one document of each group of linked documents.

    The one with the smallest doc_id (then text hash) stays; of repeated rows, one.
    """
    first = F.min(F.struct("doc_id", "tk")).alias("first")
    kept = join(docs, n, threshold, recall).groupBy("group").agg(first)
    key = "__row_key"
    kept = kept.select(row_key(F.col("first.doc_id"), F.col("first.tk")).alias(key))
    rows = docs.withColumn(key, row_key(F.col("doc_id"), text_key(F.col("text")))).join(kept, key, "left_semi")
    again = Window.partitionBy(key).orderBy(key)
    return rows.withColumn("__copy", F.row_number().over(again)).where(F.col("__copy") == 1).drop(key, "__copy")
