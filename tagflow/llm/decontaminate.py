"""Benchmark decontamination by a prefix-filtered join of item windows and documents.

An item stands for its windows of `size` consecutive words (a shorter item: one window
of all its words). A window is contained in a document only if all its shingles are, so
its rarest shingle alone is a necessary prefix: windows are indexed under that shingle,
rarity counted over all documents, and a document position joins only windows indexed
under the shingle that starts there. The window's place in the document must then fit
between its first and last word (position and length bound), and the words are compared.

Defined cases: a null or empty text, and a text of separators, has no words, hits
nothing and is hit by nothing; rows of one doc_id with different texts are told apart by
a text hash; repeated rows all get the same result; benchmark rows repeating an item_id
add their windows to it; a null item_id is reported like any other, but an id list
leaves it out; empty tables give no hits. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagflow.llm.common import Bloom, ascii_words, bloom, cut, let, may_hold, row_key, text_key

WINDOW = 10
SHINGLE = 3


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, win (array of words): the distinct windows of every item."""
    items = benchmark.select("item_id", ascii_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return items.select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, F.lit(size)))).alias("win")
    ).distinct()


def _hash_at(w: Column, i: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[F.get(w, i + k) for k in range(n)])


def _shingles(w: Column, n: int) -> Column:
    """Hashes of the n-word shingles of `w` by start; empty if `w` is shorter."""
    none = F.array().cast("array<bigint>")
    return F.when(F.size(w) < n, none).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: _hash_at(w, i, n))
    )


def _places(docs: DataFrame, masks: dict[int, Bloom], keep: list[str]) -> DataFrame:
    """`keep`, w, h, at: document positions whose shingle may be one of interest."""
    none = F.array().cast("array<struct<h:bigint,at:int>>")
    w = F.col("w")

    def of_length(n: int) -> Column:
        at = F.filter(
            F.sequence(F.lit(0), F.size(w) - n), lambda i: let(_hash_at(w, i, n), lambda h: may_hold(masks[n], h))
        )
        pairs = F.transform(at, lambda i: F.struct(_hash_at(w, i, n).alias("h"), i.cast("int").alias("at")))
        return F.when(F.size(w) < n, none).otherwise(pairs)

    found = [of_length(n) for n in sorted(masks)]
    places = F.concat(*found) if found else none
    # Outer, since for a plain explode the optimizer adds a filter that computes `places` again.
    return (
        docs.withColumn("places", places)
        .select(*keep, "w", F.explode_outer("places").alias("p"))
        .where(F.col("p").isNotNull())
        .select(*keep, "w", "p.h", "p.at")
    )


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tk (text hash), item_id, at (first word), len: every occurrence of a window."""
    windows = cut(item_windows(benchmark, size).select("item_id", "win", F.xxhash64("win").alias("wk")))
    texts = docs.select("doc_id", text_key(F.col("text")).alias("tk"), ascii_words(F.col("text")).alias("w"))
    lengths = [r[0] for r in windows.select(F.least(F.size("win"), F.lit(shingle)).alias("n")).distinct().collect()]
    inside = {
        n: windows.where(F.least(F.size("win"), F.lit(shingle)) == n).select(
            "item_id", "win", "wk", F.posexplode(_shingles(F.col("win"), n)).alias("off", "h")
        )
        for n in lengths
    }
    every = None
    for part in inside.values():
        every = part if every is None else every.unionByName(part)
    if every is None:
        every = windows.select("item_id", "win", "wk", F.lit(0).alias("off"), F.lit(0).cast("long").alias("h"))
    of_length = F.least(F.size("win"), F.lit(shingle))
    seen = _places(texts, {n: bloom(part) for n, part in inside.items()}, []).groupBy("h").agg(F.count("*").alias("n"))
    rarity = seen.join(every.select("h").distinct(), "h", "left_semi")
    order = Window.partitionBy("item_id", "wk", "win").orderBy(F.coalesce("n", F.lit(0)), "h", "off")
    prefix = cut(
        every.join(rarity, "h", "left")
        .withColumn("rank", F.row_number().over(order))
        .where((F.col("rank") == 1) & (F.col("n") > 0))
        .select("item_id", "win", "off", "h")
    )
    masks = {n: bloom(prefix.where(of_length == n)) for n in lengths}
    context = F.slice("w", F.greatest(F.col("at") - size + 1, F.lit(0)) + 1, F.lit(2 * size - 1))
    places = _places(texts, masks, ["doc_id", "tk"]).select(
        "doc_id", "tk", "h", "at", context.alias("near"), F.least(F.col("at"), F.lit(size - 1)).alias("before")
    )
    start = F.col("before") - F.col("off")
    return (
        places.join(prefix, "h")
        .where((start >= 0) & (start + F.size("win") <= F.size("near")))
        .where(F.slice("near", start + 1, F.size("win")) == F.col("win"))
        .select("doc_id", "tk", "item_id", (F.col("at") - F.col("off")).alias("at"), F.size("win").alias("len"))
        .distinct()
    )


def _covered(spans: Column) -> Column:
    """Words covered by (at, len) spans sorted by at."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["at"] + s["len"]).alias("end"),
            (a["n"] + F.greatest(s["at"] + s["len"] - F.greatest(a["end"], s["at"]), F.lit(0))).alias("n"),
        ),
        lambda a: a["n"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tk, n_words, n_hit, item_ids (sorted as strings), contaminated; one row per document row."""
    found = (
        hits(docs, benchmark, size, shingle)
        .groupBy("doc_id", "tk")
        .agg(
            F.collect_set(F.struct("at", "len")).alias("spans"),
            F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
        )
        .select(
            F.col("doc_id").alias("d"), F.col("tk").alias("t"),
            _covered(F.sort_array("spans")).alias("n_hit"), "item_ids",
        )
    )
    rows = docs.select(
        "doc_id", text_key(F.col("text")).alias("tk"), F.size(ascii_words(F.col("text"))).cast("long").alias("n_words")
    )
    return rows.join(found, rows["doc_id"].eqNullSafe(F.col("d")) & (rows["tk"] == F.col("t")), "left").select(
        "doc_id", "tk", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The rows of `docs`, all columns, that hold no window of any item."""
    key = "__row_key"
    found = hits(docs, benchmark, size, shingle).select(row_key(F.col("doc_id"), F.col("tk")).alias(key)).distinct()
    return docs.withColumn(key, row_key(F.col("doc_id"), text_key(F.col("text")))).join(found, key, "left_anti").drop(key)
