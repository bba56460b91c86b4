r"""Conversation prefix trie as a z-fast trie of Spark tables.

A conversation is the chain of its turns' hashes: the hash of depth d covers its first d
turns. A compacted node stands for an edge, the run of depths (above, extent] below its
parent, and holds the chain hashes along it. Nodes are hashed at their handle, the
two-fattest depth of their edge (the one divisible by the highest power of two).

Sequences are inserted in batches, each as large as what is there. A batch finds its exit
nodes by fat binary search: all its sequences look up the handle at the two-fattest
depth of the interval left to them in one equi-join, go below the node if it is there and
above that depth if not, so a batch takes as many joins as the bits of the longest
conversation. Where sequences leave an edge, it is split; what they add below becomes new
nodes where they branch or end.

The counts of a node come from the compacted nodes alone: sums over subtrees by pointer
doubling, after which edges are expanded into one row for each depth.

Copies of a conversation are one sequence with a count, and every join is on a hash of
whole prefixes, so no first turn or copied conversation gathers in one task. A
conversation's chain (16 bytes a turn, no texts) is one array, so the turns of a single
conversation have to fit in a row. The ids that end at one node are hashed in order by
one task as they stream by, as the digest demands; it holds one batch of ids.

Defined cases: turns are ordered by turn (null first), then by digest; null roles
and texts are empty; repeated rows are turns of their own; rows without conv_id belong
to no conversation; a conversation without turns ends at the root; texts of any length
count in whole; an empty table gives an empty result; columns other than the four are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagflow.llm.common import cut

BATCHES = 4  # the batches hold 1, 1 and 2 of so many parts, and so on, doubling
ROOT = bytes(16)
NODE = "node binary, parent binary, above int, extent int, path array<binary>, sizes array<bigint>"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest (of role and text), size (UTF-8 bytes of the text) of each turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    return rows.withColumn("place", F.row_number().over(order)).drop("turn")


def _chains(turns: pd.Series) -> pd.Series:
    out = []
    for digests in turns:
        name, path = ROOT, []
        for d in digests:
            name = hashlib.blake2b(name + bytes(d), digest_size=16).digest()
            path.append(name)
        out.append(path)
    return pd.Series(out, dtype=object)


def chains(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """conv_id, path (chain hashes), sizes (UTF-8 bytes of the texts) of each of the ids."""
    each = turns.select("conv_id", F.struct("place", "digest", "size").alias("t"))
    lines = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    lines = ids.join(lines, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col(f"t.{c}"), F.array().cast(f"array<{k}>")).alias(c) for c, k in (("digest", "binary"), ("size", "bigint"))]
    )
    return lines.select("conv_id", F.pandas_udf(_chains, "array<binary>")("digest").alias("path"), F.col("size").alias("sizes"))


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] divisible by the highest power of two."""
    zeros = F.length(F.bin(low.bitwiseXOR(high).cast("long"))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, zeros), zeros)


def _shared(y: str) -> Column:
    """How many depths of node y's edge the sequence shares; hashes of a chain match up to a point."""
    along = F.slice("path", F.col(f"{y}.above") + 1, F.col(f"{y}.extent") - F.col(f"{y}.above"))
    return F.when(F.col(f"{y}.node").isNotNull(), F.size(F.array_intersect(along, F.col(f"{y}.path")))).otherwise(0)


def locate(trie: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch (seq, path, sizes) with its exit edge: x (node, above, extent), and match, the depth it shares with the trie."""
    deepest = trie.agg(F.max("extent")).first()[0] or 0
    f = fattest(F.col("above"), F.col("extent"))
    handles = trie.select(F.get("path", f - F.col("above") - 1).alias("handle"), F.col("node").alias("hit"), F.col("extent").alias("hit_extent"))
    q = batch.select(
        "seq", "path", "sizes", F.lit(0).alias("low"), F.least(F.size("path"), F.lit(deepest)).alias("high"),
        F.lit(None).cast("binary").alias("y"),
    )
    for _ in range(int(deepest).bit_length() + 1 if deepest else 0):
        left = F.col("low") < F.col("high")
        q = q.withColumn("f", F.when(left, fattest(F.col("low"), F.col("high"))))
        q = q.withColumn("ask", F.get("path", F.col("f") - 1))
        hit = F.col("hit").isNotNull()
        q = q.join(handles, F.col("ask") == F.col("handle"), "left").select(
            "seq", "path", "sizes", F.when(hit, F.col("hit_extent")).otherwise(F.col("low")).alias("low"),
            F.when(hit | F.col("f").isNull(), F.col("high")).otherwise(F.col("f") - 1).alias("high"), F.coalesce("hit", "y").alias("y"),
        )
    edge = F.struct("node", "above", "extent", "path")
    found = q.join(trie.select(F.col("node").alias("is"), edge.alias("e")), F.col("y") == F.col("is"), "left").drop("is")
    found = found.withColumn("match", F.coalesce(F.col("e.above") + _shared("e"), F.lit(0)))
    # The whole edge matched: it may go on into a child whose handle lies further down.
    passed = F.col("match") == F.coalesce(F.col("e.extent"), F.lit(0))
    found = found.withColumn("next", F.when(passed, F.get("path", F.col("match"))))
    below = trie.select(F.get("path", F.lit(0)).alias("first"), edge.alias("c"))
    found = found.join(below, F.col("next") == F.col("first"), "left")
    went = F.col("c").isNotNull()
    return found.select(
        "seq", "path", "sizes", F.when(went, F.col("c")).otherwise(F.col("e")).alias("x"),
        F.when(went, F.col("c.above") + _shared("c")).otherwise(F.col("match")).alias("match"),
    ).select("seq", "path", "sizes", F.col("x.node").alias("x"), F.col("x.above").alias("above"), F.col("x.extent").alias("extent"), "match")


def _pieces(trie: DataFrame, found: DataFrame) -> DataFrame:
    """The nodes with their edges split where sequences of the batch leave them."""
    cuts_ = found.where("match > above and match < extent").groupBy(F.col("x").alias("of")).agg(F.collect_set("match").alias("at"))
    ends = F.sort_array(F.concat(F.coalesce("at", F.array().cast("array<int>")), F.array("extent")))
    rows = trie.join(cuts_, F.col("node") == F.col("of"), "left").withColumn("ends", ends)
    rows = rows.select("*", F.posexplode("ends").alias("i", "to")).withColumn("from", F.when(F.col("i") == 0, F.col("above")).otherwise(F.get("ends", F.col("i") - 1)))
    start, length = F.col("from") - F.col("above") + 1, F.col("to") - F.col("from")
    at = lambda depth: F.get("path", depth - F.col("above") - 1)
    return rows.select(
        at(F.col("to")).alias("node"), F.when(F.col("i") == 0, F.col("parent")).otherwise(at(F.col("from"))).alias("parent"),
        F.col("from").alias("above"), F.col("to").alias("extent"), F.slice("path", start, length).alias("path"), F.slice("sizes", start, length).alias("sizes"),
    )


def _added(found: DataFrame) -> DataFrame:
    """New nodes: where the batch branches or ends below the depth it shares with the trie."""
    depth = F.explode(F.sequence(F.col("match") + 1, F.size("path"))).alias("depth")
    rows = found.where(F.size("path") > F.col("match")).select("seq", "path", depth)
    rows = rows.select("seq", "depth", F.get("path", F.col("depth") - 1).alias("h"), F.get("path", F.col("depth")).alias("next"))
    marks = rows.groupBy("h").agg(
        F.min("seq").alias("by"), ((F.count("next") < F.count("*")) | (F.min("next") != F.max("next"))).alias("stays")
    ).where("stays").select(F.col("h").alias("mark"), "by")
    kept = rows.select("seq", "depth", "h").join(marks, F.col("h") == F.col("mark"))
    lines = kept.groupBy("seq").agg(F.sort_array(F.collect_list(F.struct("depth", (F.col("by") == F.col("seq")).alias("own")))).alias("line"))
    rows = found.join(lines, "seq").select("path", "sizes", "match", "line", F.posexplode("line").alias("i", "n")).where("n.own")
    above = F.when(F.col("i") == 0, F.col("match")).otherwise(F.get("line", F.col("i") - 1)["depth"])
    rows = rows.withColumn("above", above).withColumn("extent", F.col("n.depth"))
    length = F.col("extent") - F.col("above")
    parent = F.when(F.col("above") > 0, F.get("path", F.col("above") - 1)).otherwise(F.lit(ROOT))
    return rows.select(
        F.get("path", F.col("extent") - 1).alias("node"), parent.alias("parent"), "above", "extent",
        F.slice("path", F.col("above") + 1, length).alias("path"), F.slice("sizes", F.col("above") + 1, length).alias("sizes"),
    )


def insert(trie: DataFrame, batch: DataFrame) -> DataFrame:
    """The trie (NODE) with the sequences (seq, path, sizes) of a batch; the root is not stored."""
    found = cut(locate(trie, batch))
    return cut(_pieces(trie, found).unionByName(_added(found)))


def build(sequences: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The compacted nodes (NODE) of distinct sequences (seq, the last chain hash; path; sizes)."""
    trie = sequences.sparkSession.createDataFrame([], NODE)
    part = F.pmod(F.xxhash64("seq"), F.lit(batches))
    done = 0
    while done < batches:
        to = min(batches, max(1, 2 * done))
        trie = insert(trie, sequences.where((part >= done) & (part < to)))
        done = to
    return trie


def _doubling(nodes: DataFrame) -> list[DataFrame]:
    """For k = 0, 1, ...: (node, up), the ancestor 2 ** k nodes above, of the nodes that have one."""
    steps = [nodes.select("node", F.col("parent").alias("up")).where("up is not null")]
    while True:
        once = steps[-1]
        twice = cut(once.join(once.select(F.col("node").alias("up"), F.col("up").alias("far")), "up").select("node", F.col("far").alias("up")))
        if twice.isEmpty():
            return steps
        steps.append(twice)


def _below(values: DataFrame, steps: list[DataFrame], sums: list[str], least: list[str] = ()) -> DataFrame:
    """Sums and minima of the values over each node's subtree: after step k they cover 2 ** k levels."""
    for step in steps:
        moved = values.join(step, "node").groupBy("up").agg(
            *[F.sum(c).alias(f"_{c}") for c in sums], *[F.min(c).alias(f"_{c}") for c in least]
        )
        joined = values.join(moved, F.col("node") == F.col("up"), "left")
        values = cut(joined.select(
            "node", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums], *[F.least(c, f"_{c}").alias(c) for c in least]
        ))
    return values


def ends_digest(members: DataFrame) -> DataFrame:
    """node, ends_sha256 of members (node, conv_id): the ids in order, each task hashing its nodes' ids as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        row = lambda: pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "ends_sha256": [digest.hexdigest()]})
        for b in batches:
            names, ids = b.column("node").to_pylist(), b.column("conv_id").to_pylist()
            a = 0
            while a < len(names):
                z = a + 1
                while z < len(names) and names[z] == names[a]:
                    z += 1
                text = ",".join(map(str, ids[a:z]))
                if names[a] == node:
                    text = "," + text
                else:
                    if node is not None:
                        yield row()
                    node, digest = names[a], hashlib.sha256()
                digest.update(text.encode())
                a = z
        if node is not None:
            yield row()

    placed = members.select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
    return placed.mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(lines: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Per node of the trie of conversations (conv_id, path, sizes): conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (bytes that sharing saves below), ends_sha256, node (its hash)."""
    lines = cut(lines.withColumn("node", F.coalesce(F.element_at(F.when(F.size("path") > 0, F.col("path")), -1), F.lit(ROOT))))
    ended = cut(lines.groupBy("node").agg(F.count("*").alias("n"), F.min("conv_id").alias("least")))
    seqs = lines.where(F.size("path") > 0).groupBy(F.col("node").alias("seq")).agg(F.first("path").alias("path"), F.first("sizes").alias("sizes"))
    trie = build(cut(seqs), batches)
    none = F.array()
    root = lines.sparkSession.range(1).join(ended.limit(1).select(F.lit(0).cast("long").alias("id")), "id").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("above"), F.lit(0).alias("extent"),
        none.cast("array<binary>").alias("path"), none.cast("array<bigint>").alias("sizes"),
    )
    nodes = cut(trie.unionByName(root))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    known = cut(
        nodes.select("node", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("bytes"))
        .join(ended, "node", "left").join(children, "node", "left")
        .withColumns({"n_children": F.coalesce("n_children", F.lit(0).cast("long")), "n_convs": F.coalesce("n", F.lit(0).cast("long"))})
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
    )
    steps = _doubling(nodes)
    counted = _below(known.select("node", "n_convs", "n_leaves", "least"), steps, ["n_convs", "n_leaves"], ["least"])
    saves = counted.join(known.select("node", "bytes"), "node").select("node", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    saved = _below(cut(saves), steps, ["saved"])
    whole = (
        nodes.join(counted, "node").join(saved, "node").join(known.select("node", "n_children"), "node")
        .join(ends_digest(lines), "node", "left")
        .join(counted.select(F.col("node").alias("parent"), F.col("least").alias("parent_least")), "parent", "left")
    )
    # One row for each depth of the edge; all of them have the members of the node.
    depths = F.when(F.col("extent") > 0, F.sequence(F.col("above") + 1, F.col("extent"))).otherwise(F.array(F.lit(0)))
    rows = whole.select("*", F.explode(depths).alias("depth"))
    passed = F.aggregate(F.slice("sizes", F.lit(1), F.greatest(F.col("depth") - F.col("above") - 1, F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)
    last = F.col("depth") == F.col("extent")
    empty = hashlib.sha256().hexdigest()
    return rows.select(
        F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") - F.col("above") == 1, F.col("parent_least")).when(F.col("depth") > 0, F.col("least")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"), "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * passed).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(empty))).otherwise(F.lit(empty)).alias("ends_sha256"),
        F.when(F.col("depth") > 0, F.get("path", F.col("depth") - F.col("above") - 1)).otherwise(F.col("node")).alias("node"),
    )


def rebuilt(conversations: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) of conversations whose first turns are those of the first conversation of their group of `every`.

    The number of turns taken over is the checksum of the conversation's id modulo `most`.
    """
    turns = cut(turns_of(conversations))
    ids = turns.select("conv_id").distinct()
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    heads = ids.select("conv_id", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    first = turns.where(F.col("place") < most).select(F.col("conv_id").alias("base"), "place", "digest", "size")
    head = heads.join(first, "base").where("place <= h").select("conv_id", "place", "digest", "size")
    tail = turns.where(F.col("place") > F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)))
    return head.unionByName(tail.select("conv_id", "place", "digest", "size")), ids
