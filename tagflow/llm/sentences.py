"""Substring dedup by sliding sentence spans.

A text is cut into sentences (at a stop of `STOPS` that ends a word, behind a stop of
`WIDE_STOPS`, or at a line end), each with the white space behind it, so that joining
them gives the text back. A sentence of over `LONGEST` words is cut further where its
words say so: at every gap whose hash of the words beside it is the smallest of some
`WINDOW` consecutive gaps of the sentence. So every piece of it has at most WINDOW words,
and a cut depends on nothing but the WINDOW words on either side. Every run of `RUN`
consecutive pieces is hashed (128 bits, on trimmed lower-case pieces); runs are compared
over all documents; pieces covered by any run that is not the first of its kind
(smallest doc_id, then text hash, then position) are removed, if what such runs cover
without a gap has at least `LEAST_WORDS` words; so a few short sentences stay.

A passage of 49 words, alike but for case and kind of blanks, holds at least one whole run
wherever it stands: at either end at most max(LONGEST, 2 * WINDOW - 1) = 15 words can hold
no whole piece that is sure to be shared, and two pieces between them have at most
2 * LONGEST = 18. Those ends of a removed passage can stay; 49 - 2 * 15 = LEAST_WORDS
words between them go.

Defined cases: null stays null and is never changed; an empty text stays empty; a text
of fewer than `RUN` pieces has no run and stays, as does one of fewer than LEAST_WORDS
words; repeats inside one text count too;
words stand between white space, and in scripts written without spaces every character
is one; repeated rows (same doc_id and text) are one document and stay alike; a null
doc_id sorts first; an empty table gives an empty result. Columns other than doc_id and
text are not read.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagflow.llm.common import text_key
from tagflow.llm.jaccard import mix64

RUN = 3
LONGEST = 9
WINDOW = 8
# These end a sentence at the end of a word; the wide ones also with no space behind them.
STOPS = ".!?\u2026\u203c\u203d\u2047\u2048\u2049\u0589\u055c\u055e\u061e\u061f\u06d4\u0700\u0701\u0702\u0964\u0965\u104a\u104b\u1362\u1367\u1368\u166e\u17d4\u17d5\u1803\u1809\ua4ff\ua60e\ua6f3\uabeb"
WIDE_STOPS = "\u3002\uff01\uff0e\uff1f\uff61"
# First and last characters of the scripts written without spaces.
UNSPACED = ((0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF))
LEAST_WORDS = 19
# A word for the least number: in scripts without spaces, and at wide stops, every character is one.
_ALONE_CLASS = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in (*UNSPACED, (0x20000, 0x10FFFF))) + WIDE_STOPS
_BLANK_CLASS = r"\s\p{Z}\x1C-\x1F\x85"
_WORD = f"[{_ALONE_CLASS}]|[^{_ALONE_CLASS}{_BLANK_CLASS}]+"
CHUNK_BYTES = 1_000_000
_SPACE, _LINE, _STOP, _WIDE, _ALONE, _MARK = 1, 2, 4, 8, 16, 32
_TOP = 0x20000  # characters from here on are Han


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(kind, lower case) of every character below _TOP; the last kind stands for those above."""
    kind, low = np.zeros(_TOP + 1, np.uint8), np.arange(_TOP, dtype=np.uint64)
    for c in range(_TOP):
        if 0xD800 <= c < 0xE000:
            continue
        x = chr(c)
        if len(x.lower()) == 1:
            low[c] = ord(x.lower())
        if x.isspace():
            kind[c] |= _SPACE
        if unicodedata.category(x)[0] in "PM":
            kind[c] |= _MARK
    for x in "\n\r\x85\u2028\u2029":
        kind[ord(x)] |= _LINE
    for x in STOPS + WIDE_STOPS:
        kind[ord(x)] |= _STOP
    for x in WIDE_STOPS:
        kind[ord(x)] |= _WIDE
    for a, b in UNSPACED:
        kind[a : b + 1][(kind[a : b + 1] & _MARK) == 0] |= _ALONE
    kind[_TOP] = _ALONE
    return kind, low


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, code point) of each character of UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    wide = np.concatenate((data, np.zeros(3, np.uint8)))
    lead = wide[at]
    code = lead.astype(np.uint32)
    for least, most, keep, more in ((0xC0, 0xDF, 0x1F, 1), (0xE0, 0xEF, 0x0F, 2), (0xF0, 0xFF, 0x07, 3)):
        few = np.flatnonzero((lead >= least) & (lead <= most))
        if len(few):
            value = code[few] & np.uint32(keep)
            for k in range(1, more + 1):
                value = value << 6 | (wide[at[few] + k] & np.uint32(0x3F))
            code[few] = value
    return at, code


def piece_starts(data: np.ndarray, rows: np.ndarray, longest: int) -> np.ndarray:
    """The first bytes of the pieces of texts that lie one behind the other; rows: where each begins, and the end."""
    kinds, low = _tables()
    at, code = _characters(data)
    first_of_row = np.zeros(len(data) + 1, bool)
    first_of_row[rows] = True
    begins = first_of_row[at]
    kind = kinds[np.minimum(code, _TOP)]
    has = lambda k, bit: (k & bit) != 0
    before = np.concatenate((np.full(1, _SPACE, np.uint8), kind[:-1]))
    space, mark = has(kind, _SPACE), has(kind, _MARK)
    # A word begins behind a space, at and behind a character that is a word, and behind a wide stop; marks go with what they follow.
    start = ~space & (begins | has(before, _SPACE) | (~mark & (has(kind, _ALONE) | has(before, _ALONE | _WIDE))))
    edges = rows[:-1][rows[1:] > rows[:-1]]
    word = np.flatnonzero(start)
    if not len(word):
        return edges
    # Hash of each word by its characters and their places, in lower case.
    owner = np.cumsum(start) - 1
    place = np.arange(len(at)) - word[np.maximum(owner, 0)]
    small = np.where(code < _TOP, low[np.minimum(code, _TOP - 1)], code).astype(np.uint64)
    powers = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
    value = mix64(small + np.uint64(1)) * powers[np.clip(place, 0, 63)]
    value[space] = 0
    h = mix64(np.add.reduceat(value, word))
    # A sentence ends at a stop that is a word's last character, at a line end, and with the text.
    last = np.maximum.reduceat(np.where(space, 0, np.arange(len(at))), word)
    row = np.cumsum(begins)[word]
    ends = has(kind[last], _STOP) | (np.add.reduceat(has(kind, _LINE).astype(np.int64), word) > 0)
    new_row = np.append(row[1:] != row[:-1], True)
    ends |= new_row
    # Gaps inside a sentence, 0 at its end.
    gap = np.where(ends, np.uint64(0), mix64(h * np.uint64(31) + np.append(h[1:], np.uint64(0))) | np.uint64(1))
    window = max(1, min(WINDOW, longest))
    padded = np.concatenate((np.zeros(window, np.uint64), gap, np.zeros(window, np.uint64)))
    reach, n = np.ones(len(gap), np.int64), len(gap)
    for sign in (-1, 1):
        on = gap > 0
        for k in range(1, window):
            on = on & (padded[window + sign * k : window + sign * k + n] >= gap)
            reach += on
    stop_at = np.flatnonzero(ends)
    long = np.repeat(np.diff(stop_at, prepend=-1) > longest, np.diff(stop_at, prepend=-1))
    cut_behind = ends | (long & (reach >= window))
    return np.union1d(edges, at[word[1:][(cut_behind & ~new_row)[:-1]]])


def _split(texts: pa.Array, longest: int) -> pa.Array:
    """The pieces of each text; they share the texts' bytes."""
    flat = pa.array(texts.fill_null("").cast(pa.large_string()))
    _, offsets, data = flat.buffers()
    rows = np.frombuffer(offsets, np.int64)[flat.offset : flat.offset + len(flat) + 1]
    base = int(rows[0])
    data = np.frombuffer(data, np.uint8)[base : int(rows[-1])] if data is not None else np.zeros(0, np.uint8)
    rows, found, i = rows - base, [], 0
    while i < len(flat):
        j = max(i + 1, int(np.searchsorted(rows, rows[i] + CHUNK_BYTES, "right")) - 1)
        found.append(piece_starts(data[rows[i] : rows[j]], rows[i : j + 1] - rows[i], longest) + rows[i])
        i = j
    starts = np.concatenate(found) if found else np.zeros(0, np.int64)
    pieces = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, rows).astype(np.int32)), pieces)


def sentences(text: Column, longest: int = LONGEST) -> Column:
    """The pieces of a text in order; their concatenation is the text (null: none)."""

    def split(texts: pa.Array) -> pa.Array:
        return _split(texts, longest)

    return F.arrow_udf(split, "array<string>")(F.coalesce(text, F.lit("")))


# A place in a document is one number: the upper bits of the text's hash, then the position.
PLACE_BITS = 28


def _upper(text: Column) -> Column:
    return F.shiftright(text_key(text), PLACE_BITS)


def runs(docs: DataFrame, run: int = RUN, longest: int = LONGEST) -> DataFrame:
    """doc_id, at (text hash and first piece), h1, h2: every run of pieces."""
    clean = F.transform(sentences(F.col("text"), longest), lambda s: F.lower(F.trim(F.regexp_replace(s, r"\s+", " "))))
    rows = docs.select("doc_id", F.shiftleft(_upper(F.col("text")), PLACE_BITS).alias("tk"), clean.alias("s"))
    here = lambda i, seed: F.xxhash64(F.lit(seed), *[F.get("s", i + k) for k in range(run)])
    none = F.array().cast("array<struct<at:bigint,h1:bigint,h2:bigint>>")
    found = F.when(F.size("s") < run, none).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.size("s") - run),
            lambda i: F.struct((F.col("tk") + i).alias("at"), here(i, 1).alias("h1"), here(i, 2).alias("h2")),
        )
    )
    # Outer, since for a plain explode the optimizer adds a filter that computes the runs again.
    return rows.select("doc_id", F.explode_outer(found).alias("r")).where(F.col("r").isNotNull()).select("doc_id", "r.*")


def repeated(docs: DataFrame, run: int = RUN, longest: int = LONGEST) -> DataFrame:
    """doc_id, at: runs that are not the first of their kind."""
    # One exchange: the rows of a run meet once, and rank() takes them one by one, however many they are.
    kind = Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").asc_nulls_first(), "at")
    return runs(docs, run, longest).withColumn("n", F.rank().over(kind)).where("n > 1").select("doc_id", "at")


def _islands(at: Column, run: int) -> Column:
    """(first, last) piece of every stretch that the runs beginning at `at` cover without a gap."""
    none = F.array().cast("array<struct<first:int,last:int>>")
    closed = lambda a: F.when(a["first"] >= 0, F.concat(a["done"], F.array(F.struct(a["first"].alias("first"), a["last"].alias("last"))))).otherwise(a["done"])
    return F.aggregate(
        F.sort_array(at),
        F.struct(F.lit(-1).alias("first"), F.lit(-2).alias("last"), none.alias("done")),
        lambda a, i: F.struct(
            F.when(i <= a["last"] + 1, a["first"]).otherwise(i).alias("first"), (i + run - 1).alias("last"),
            F.when(i <= a["last"] + 1, a["done"]).otherwise(closed(a)).alias("done"),
        ),
        closed,
    )


def dedup(docs: DataFrame, run: int = RUN, longest: int = LONGEST, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, text (what stays), n_sentences, n_removed, removed_chars; one row per document row."""
    tk = F.shiftright("at", PLACE_BITS)
    covered = (
        repeated(docs, run, longest).groupBy("doc_id", tk.alias("tk"))
        .agg(F.collect_set((F.col("at") - F.shiftleft(tk, PLACE_BITS)).cast("int")).alias("at"))
        .select(F.col("doc_id").alias("d"), F.col("tk").alias("t"), _islands(F.col("at"), run).alias("islands"))
    )
    rows = docs.select("doc_id", "text", _upper(F.col("text")).alias("tk"))
    joined = rows.join(covered, rows["doc_id"].eqNullSafe(F.col("d")) & (rows["tk"] == F.col("t")), "left")
    marked = joined.withColumn("s", sentences(F.col("text"), longest))
    pieces = lambda a, n: F.array_join(F.slice("s", a + 1, n), "")
    n_words = lambda x: F.regexp_count(pieces(x["first"], x["last"] - x["first"] + 1), F.lit(_WORD))
    marked = marked.withColumn("gone", F.filter("islands", lambda x: n_words(x) >= least_words))
    # The islands are in order: what lies between them stays.
    keep = F.aggregate(
        "gone",
        F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("parts")),
        lambda a, x: F.struct(
            (x["last"] + 1).alias("next"), F.concat(a["parts"], F.array(pieces(a["next"], x["first"] - a["next"]))).alias("parts")
        ),
        lambda a: F.concat(F.array_join(a["parts"], ""), pieces(a["next"], F.greatest(F.size("s") - a["next"], F.lit(0)))),
    )
    removed = F.aggregate("gone", F.lit(0), lambda n, x: n + x["last"] - x["first"] + 1)
    text = F.when(F.size("gone") > 0, keep).otherwise(F.col("text"))
    return marked.select(
        "doc_id", text.alias("text"), F.size("s").cast("long").alias("n_sentences"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.length("text") - F.length(text), F.lit(0)).cast("long").alias("removed_chars"),
    )
