"""Merkle manifest of a document table, with inclusion proofs that are checked again.

A document's digest covers its columns, each with its length. The documents of a source
in order of their ids form a tree of fixed fan-out; the roots of all sources, in order of
the sources, form another one, whose root names the whole table.

Every level is a table of nodes with their place and the number of nodes beside them.
Windows over blocks of neighbouring nodes give each node fixed-offset `lag` and `lead`
columns; a mask on the slot within the run and on the run's length keeps those that are
siblings, and the row of each run's first child hashes the parent. A level has a
sixteenth of the nodes of the one below. Proofs come down the same levels: a node joins
its parent's path and puts its own siblings in front.

Places come from a sort over the cluster, so one source may hold any share of all rows;
blocks hold `BLOCK` nodes, so no window does. A path holds at most fan-out - 1 digests a
level.

Defined cases: a null column is `-`; a null doc_id comes first; rows of one doc_id are
ordered by digest, and repeated rows are leaves of their own; texts of any length count
in whole; a null source is a source of its own and comes first; an empty table gives an
empty result; other columns than those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagflow.llm.common import cut, ranked

FANOUT = 16
BLOCK = FANOUT**3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def leaf(columns: dict[str, Column] | None = None, names=COLUMNS) -> Column:
    """Digest of a row; `columns` takes the place of columns of the same name."""
    parts = []
    for name in names:
        value = (columns or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _siblings(parts: list[str], fanout: int) -> tuple[Column, Column]:
    """(digests left of the node in its run, digests right of it), each in one text."""
    w = Window.partitionBy(*parts).orderBy("place")
    slot = F.pmod("place", F.lit(fanout))
    run = F.least(F.lit(fanout), F.col("n") - F.col("place") + slot)
    before = [F.when(slot >= j, F.lag("digest", j).over(w)) for j in range(fanout - 1, 0, -1)]
    after = [F.when(slot + j < run, F.lead("digest", j).over(w)) for j in range(1, fanout)]
    return F.concat_ws("", *before), F.concat_ws("", *after)


def _parents(nodes: DataFrame, fanout: int, block: int) -> DataFrame:
    """The next level of trees that have several nodes left."""
    many = nodes.where("n > 1").withColumn("block", F.floor(F.col("place") / block))
    _, after = _siblings(["owner", "block"], fanout)
    hashed = many.withColumn("parent", F.when(F.pmod("place", F.lit(fanout)) == 0, F.sha2(F.concat("digest", after), 256)))
    return hashed.where("parent is not null").select(
        "owner", (F.col("place") / fanout).cast("long").alias("place"), F.ceil(F.col("n") / fanout).alias("n"), F.col("parent").alias("digest")
    )


@dataclass(frozen=True)
class Tree:
    """levels[0] are the leaves (owner, place, n, digest, and what else they carry), the next are their parents."""

    levels: list[DataFrame]
    fanout: int

    @classmethod
    def of(cls, leaves: DataFrame, fanout: int, block: int) -> Tree:
        widest = leaves.agg(F.max("n")).first()[0] or 0
        levels = [leaves]
        while widest > 1:
            levels.append(cut(_parents(levels[-1], fanout, block)))
            widest = -(-widest // fanout)
        return cls(levels, fanout)

    def roots(self) -> DataFrame:
        """owner, digest: what remains of each tree."""
        one = [x.where("n = 1").select("owner", "digest") for x in self.levels]
        out = one[0]
        for x in one[1:]:
            out = out.unionByName(x)
        return out

    def paths(self, above: DataFrame) -> DataFrame:
        """The leaves with `path`: the siblings on the way up, then the path of their tree in
        `above` (owner, path, subroot); and with its subroot."""
        top = above.select(F.col("owner").alias("of"), F.col("path").alias("up"), "subroot")
        down = None
        for level in reversed(self.levels):
            out = [*level.columns, "path", "subroot"]
            ends = level.where("n = 1").join(top, F.col("owner").eqNullSafe(F.col("of"))).withColumn("path", F.col("up")).select(*out)
            if down is not None:
                # The join and the window share one shuffle: both are by run.
                up = down.select(F.col("owner").alias("of"), F.col("place").alias("run"), F.col("path").alias("up"), "subroot")
                here = level.where("n > 1").withColumn("at", (F.col("place") / self.fanout).cast("long"))
                joined = here.join(up, F.col("owner").eqNullSafe(F.col("of")) & (F.col("at") == F.col("run")))
                before, after = _siblings(["owner", "at"], self.fanout)
                own = F.array(F.struct(before.alias("before"), after.alias("after")))
                ends = joined.withColumn("own", own).withColumn("path", F.concat("own", "up")).select(*out).unionByName(ends)
            down = ends if level is self.levels[0] else cut(ends)
        return down


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    return F.aggregate(path, digest, lambda d, x: F.sha2(F.concat(x["before"], d, x["after"]), 256))


def prove(docs: DataFrame, claimed: Column | None = None, names=COLUMNS, group: str = "source", order: str = "doc_id",
          fanout: int = FANOUT, block: int = BLOCK) -> DataFrame:
    """doc_id, source, leaf, subroot, root, path (array of before, after), folded_root, verified; a row per document.

    `claimed` is the digest that a holder of the document presents (its own by default): the
    path of the manifest must lead from it to the root.
    """
    slim = cut(docs.select(
        F.col(group).alias("owner"), F.col(order).alias("id"), leaf(names=names).alias("digest"),
        (leaf(names=names) if claimed is None else claimed).alias("claim"),
    ))
    leaves = cut(ranked(slim, ["owner"], ["id", "digest"], "place", "n"))
    tree = Tree.of(leaves, fanout, block)
    subroots = cut(tree.roots().select(F.col("owner").alias("name"), "digest"))
    top = Tree.of(cut(ranked(subroots.withColumn("owner", F.lit(0)), ["owner"], ["name"], "place", "n")), fanout, block)
    found = top.roots().first()
    root = F.lit(found["digest"] if found else None).cast("string")
    none = top.roots().select("owner", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"))
    above = top.paths(none).select(F.col("name").alias("owner"), "path", F.col("digest").alias("subroot"))
    out = tree.paths(cut(above))
    folded = fold(F.col("claim"), F.col("path"))
    return out.select(
        F.col("id").alias(order), F.col("owner").alias(group), F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path",
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_text(path: Column) -> Column:
    """All sibling digests, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), "")
