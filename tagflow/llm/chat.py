r"""Chat formatting as prefix trees of conversations.

Every turn is a node named by a hash of itself and all turns before it, so that
conversations with the same first turns share nodes. A node's template text is turned
into tokens once. Nodes of one tree are laid out depth first in one token sequence;
every node row carries its place there, the position id of its first token (its distance
from the conversation's start; the others count on from it), the interval of its tokens
under the loss mask, and the intervals of the sequence that its tokens may attend to
besides the causal part of their own node: its ancestors. Tokens are held once, packed in
four bytes each; `expanded` writes ids, positions and mask out token by token.

The depth-first order is the order of the conversations' paths of node names. Paths are
sorted over the cluster, a node belongs to the first path that has it, and offsets are
prefix sums in three steps (sort partitions of a tree, paths of a partition, nodes of a
path), so that a tree may hold any share of all rows.

Template: `### role: text</turn>` and a line end. In texts and roles a backslash, `###`
and `</turn>` are written `\\`, `\h` and `\t`, in roles a colon `\c`; reading undoes it.

The turns of one conversation and the nodes of its path (identifiers, no texts) are in one
row, so a single conversation has to fit in memory.

Defined cases: texts of any length are tokenized as a whole: a long one is cut only in
front of a single space between two other characters, where no token can span; turns are ordered by turn (null first), then role, then text; a null text
or role is empty; a null conv_id is a conversation of its own; a repeated row is a turn of
its own; an empty table gives empty results; columns other than the four are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import types
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tagflow.llm.common import cut

OPEN, CLOSE = "### ", "</turn>\n"
LOSS_ROLE = "assistant"
PIECE = 10_000  # characters from which on a text is cut at the next place no token spans

# Fixed value: the pattern that splits text ahead of the merges of the public rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_WRITE = [("\\", "\\\\"), ("###", "\\h"), ("</turn>", "\\t")]
_READ = {"\\": "\\", "h": "###", "t": "</turn>", "c": ":"}


def escape(text: str, role: bool = False) -> str:
    for plain, written in _WRITE:
        text = text.replace(plain, written)
    return text.replace(":", "\\c") if role else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _READ[m[1]], text)


_BORDER = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str, least: int = PIECE) -> list[str]:
    """The text in parts of at least so many characters whose tokens are those of the whole text.

    The pattern lets a token begin with a space but go on over none, and a single space
    between two other characters always begins one.
    """
    out, start = [], 0
    while (found := _BORDER.search(text, start + least)) is not None:
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    return f"{OPEN}{escape(role, True)}: ", escape(text), CLOSE


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out = []
    for part in formatted.split(CLOSE)[:-1]:
        role, _, text = part.removeprefix(OPEN).partition(": ")
        out.append((unescape(role), unescape(text)))
    return out


def codec(path: str | None) -> tuple[Callable[[str], list[int]], Callable[[list[int]], bytes]]:
    """(encode, decode) of a tokenizer's rank file; without a path tokens are UTF-8 bytes."""
    if path is None:
        return lambda t: list(t.encode()), bytes
    import tiktoken

    # A module of our own in the worker outlives a task; code that is sent by value does not.
    known = vars(sys.modules.setdefault("_chat_tokenizers", types.ModuleType("_chat_tokenizers"))).setdefault("by_path", {})
    if path not in known:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        known[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = known[path]
    return lambda text: [x for part in pieces(text) for x in own.encode_ordinary(part)], own.decode_bytes


def _chains(roles: pd.Series, texts: pd.Series) -> pd.Series:
    out = []
    for rs, ts in zip(roles, texts):
        name, path = b"", []
        for r, t in zip(rs, ts):
            h = hashlib.blake2b(name, digest_size=16)
            for part in (r.encode(), t.encode()):
                h.update(len(part).to_bytes(8, "little") + part)
            name = h.digest()
            path.append(name.hex())
        out.append(path)
    return pd.Series(out, dtype=object)


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path (node names), roles, texts by turn."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return rows.select("conv_id", F.col("t.role").alias("roles"), F.col("t.text").alias("texts")).withColumn(
        "path", F.pandas_udf(_chains, "array<string>")("roles", "texts")
    )


def packed(ids: list[int]) -> bytes:
    return np.array(ids, ">u4").tobytes()


def unpacked(data: bytes) -> list[int]:
    return np.frombuffer(data, ">u4").tolist()


def tokens(nodes: DataFrame, tokenizer: str | None) -> DataFrame:
    """node, role, ids (packed), len, loss_from, loss_to (token indexes) of nodes (node, role, text)."""

    def run(batches):
        encode, _ = codec(tokenizer)
        for pdf in batches:
            out = []
            for node, role, text in zip(pdf["node"], pdf["role"], pdf["text"]):
                head, body, tail = map(encode, turn_parts(role, text))
                at = len(head) + (len(body) if role == LOSS_ROLE else 0)
                ids = head + body + tail
                out.append((node, role, packed(ids), len(ids), len(head), at))
            yield pd.DataFrame(out, columns=["node", "role", "ids", "len", "loss_from", "loss_to"])

    return nodes.mapInPandas(run, "node string, role string, ids binary, len long, loss_from int, loss_to int")


def expanded(nodes: DataFrame) -> DataFrame:
    """The nodes with ids, positions and loss (mask) as arrays, one value a token."""
    nodes = nodes.withColumnRenamed("ids", "__packed")
    count = F.octet_length("__packed") / 4
    index = F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1)).cast("int") - 1), lambda i: i < count)
    number = lambda i: F.conv(F.hex(F.substring("__packed", i * 4 + 1, F.lit(4))), 16, 10).cast("int")
    kept = [c for c in nodes.columns if c not in ("__packed", "pos", "loss_from", "loss_to")]
    return nodes.select(
        *kept, F.transform(index, number).alias("ids"), F.transform(index, lambda i: F.col("pos") + i).alias("positions"),
        F.transform(index, lambda i: (i >= F.col("loss_from")) & (i < F.col("loss_to"))).alias("loss"),
    )


INTERVALS = "array<struct<start:bigint,end:bigint>>"


def _merge(nodes: F.Column) -> F.Column:
    """Intervals of an array of (start, len), neighbours joined."""
    none = F.array().cast(INTERVALS)
    pair = lambda a, b: F.struct(a.alias("start"), b.alias("end"))

    def add(a, x):
        end = x["start"] + x["len"]
        more = F.when(a["end"] >= 0, F.concat(a["done"], F.array(pair(a["start"], a["end"])))).otherwise(a["done"])
        joined = F.struct(a["done"].alias("done"), a["start"].alias("start"), end.alias("end"))
        fresh = F.struct(more.alias("done"), x["start"].alias("start"), end.alias("end"))
        return F.when(a["end"] == x["start"], joined).otherwise(fresh)

    zero = F.struct(none.alias("done"), F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"))
    close = lambda a: F.when(a["end"] >= 0, F.concat(a["done"], F.array(pair(a["start"], a["end"])))).otherwise(a["done"])
    return F.aggregate(nodes, zero, add, close)


def forest(conversations: DataFrame, tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, members).

    nodes: tree, node, parent, depth, start, role, ids (packed), pos (position of the first
    token), loss_from, loss_to, ancestors; the rows of a tree by start are its sequence. members: conv_id, tree, depth, start: the
    nodes of each conversation in order.
    """
    convs = cut(paths(conversations))
    turns = convs.select(F.explode(F.arrays_zip("path", "roles", "texts")).alias("t"))
    texts = turns.groupBy(F.col("t.path").alias("node")).agg(F.first("t.roles").alias("role"), F.first("t.texts").alias("text"))
    coded = cut(tokens(texts, tokenizer))

    ranked = cut(
        convs.select("path").withColumn("leaf", F.element_at("path", -1)).groupBy("leaf").agg(F.first("path").alias("path"))
        .orderBy("path").select(F.monotonically_increasing_id().alias("rank"), "path")
    )
    places = ranked.select(
        "rank", F.get("path", F.lit(0)).alias("tree"),
        F.posexplode(
            F.transform("path", lambda x, i: F.struct(x.alias("node"), F.get("path", i - 1).alias("parent")))
        ).alias("depth", "n"),
    ).select("rank", "tree", "depth", "n.node", "n.parent")
    owned = (
        places.groupBy("node").agg(F.min("rank").alias("rank"), F.first("tree").alias("tree"), F.first("depth").alias("depth"))
        .join(coded.select("node", "len"), "node")
    )
    part = F.shiftright("rank", 33)
    by_rank = owned.groupBy("tree", "rank").agg(F.sum("len").alias("new")).withColumn("part", part)
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_rank.groupBy("tree", "part").agg(F.sum("new").alias("all")).withColumn(
        "base", F.coalesce(F.sum("all").over(before("tree").orderBy("part")), F.lit(0))
    )
    bases = by_rank.withColumn(
        "inner", F.coalesce(F.sum("new").over(before("tree", "part").orderBy("rank")), F.lit(0))
    ).join(by_part.select("tree", "part", "base"), ["tree", "part"]).select(
        "rank", (F.col("base") + F.col("inner")).alias("base")
    )
    started = cut(
        owned.withColumn("own", F.coalesce(F.sum("len").over(before("rank").orderBy("depth")), F.lit(0)))
        .join(bases, "rank").select("node", F.col("rank").alias("owner"), (F.col("base") + F.col("own")).alias("start"), "len")
    )
    lines = (
        places.join(started, "node")
        .groupBy("rank", "tree")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "node", "parent", "start", "len", (F.col("owner") == F.col("rank")).alias("mine")))).alias("line"))
    )
    shared = F.filter("line", lambda x: ~x["mine"])
    mine = F.filter("line", lambda x: x["mine"])
    length = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x["len"])
    laid = (
        lines.withColumn("above", _merge(shared)).withColumn("far", length(shared)).withColumn("mine", mine)
        .select("tree", "above", "far", F.get("mine", F.lit(0))["start"].alias("first"), F.explode("mine").alias("x"))
        .select("tree", "x.node", "x.parent", "x.depth", "x.start", "above", (F.col("far") + F.col("x.start") - F.col("first")).alias("pos"), "first")
    )
    here = F.array(F.struct(F.col("first").alias("start"), F.col("len").alias("len")))
    ranges = F.transform("above", lambda r: F.struct(r["start"].alias("start"), (r["end"] - r["start"]).alias("len")))
    laid = laid.withColumn("len", F.col("start") - F.col("first"))
    ancestors = _merge(F.when(F.col("len") > 0, F.concat(ranges, here)).otherwise(ranges))
    nodes = laid.withColumn("ancestors", ancestors).drop("len").join(coded, "node").select(
        "tree", "node", "parent", "depth", "start", "role", "ids", "pos", "loss_from", "loss_to", "ancestors"
    )
    members = (
        convs.select("conv_id", F.get("path", F.lit(0)).alias("tree"), F.posexplode("path").alias("depth", "node"))
        .join(started.select("node", "start"), "node").select("conv_id", "tree", "depth", "start")
    )
    return nodes, members


def read_back(nodes: DataFrame, members: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Digests of the conversations as the token rows hold them: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    turn = F.struct("depth", "ids", "loss_from", "loss_to")
    rows = (
        members.join(nodes.select("tree", "start", "ids", "loss_from", "loss_to"), ["tree", "start"])
        .groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
        .select(F.col("conv_id").cast("string").alias("id"), "t.ids", "t.loss_from", "t.loss_to")
    )

    def run(batches):
        _, decode = codec(tokenizer)
        for pdf in batches:
            out = []
            for key, parts, starts, stops in zip(pdf["id"], pdf["ids"], pdf["loss_from"], pdf["loss_to"]):
                parts = [unpacked(p) for p in parts]
                formatted = decode([i for p in parts for i in p]).decode()
                under = decode([i for p, a, b in zip(parts, starts, stops) for i in p[a:b]]).decode()
                turns = parse(formatted)
                digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                lost = unescape(under)
                out.append((key, len(turns), digest, len(lost), hashlib.sha256(lost.encode()).hexdigest(), len(formatted)))
            yield pd.DataFrame(out, columns=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rows.mapInPandas(
        run, "id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ).select(F.col("id").cast(members.schema["conv_id"].dataType).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
