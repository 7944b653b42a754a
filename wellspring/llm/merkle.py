"""A Merkle manifest: digests that commit to every row of a dataset, with a proof for each.

Rows are leaves, numbered within their group. A slot pivot builds the tree: conditional
aggregates spread the children of a parent into ``fanout`` columns, concatenating the columns and hashing gives the
parent, and leaving out a child's own column leaves its siblings. One aggregation takes several levels at once (16
slots: 4 levels of a binary tree): the slots' own parents and grandparents are further columns of the same row, so a
tree over N leaves takes log16(N) shuffles, each a sixteenth of the one before. Positions are consecutive,
so neither a hot group nor a large one fills a task, and the group's last, shorter run is known by its empty slots.

Proofs go down again: a row's slots become its children, each with the siblings of its own levels in front of its
parent's. What they are joined on is unique, and a list has one entry for each level of the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm._stage import store, table, take
from wellspring.operators import running_totals

FANOUT, SLOTS = 2, 16
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts, concatenated, in lowercase hex."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes in front, so that no two rows read alike; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _levels(fanout: int, slots: int) -> int:
    """How many levels one pivot takes."""
    n = 1
    while fanout ** (n + 1) <= slots:
        n += 1
    return n


def _pivot(nodes: DataFrame, group: list[str], node: list[str], fanout: int, levels: int) -> DataFrame:
    """``nodes(*group, pos, hash, ...)`` to a row for each block of ``fanout ** levels`` of them: their columns ``node``
    in slots ``c0``, ``c1``, ..., the hashes of the levels above in ``h1_0``, ..., and the block's ``top``."""
    width = fanout ** levels
    slot, block = F.pmod("pos", F.lit(width)), F.floor(F.col("pos") / width).cast("long")
    packed = nodes.select(*group, block.alias("block"), slot.alias("slot"), F.struct(*node).alias("node"))
    out = packed.groupBy(*group, "block").agg(
        F.count("*").alias("filled"),
        *[F.max(F.when(F.col("slot") == j, F.col("node"))).alias(f"c{j}") for j in range(width)])
    # Only a group's first block can be its last: beyond it, another level follows anyhow.
    used = sum(((F.col("filled") > fanout ** k).cast("int") for k in range(levels)), F.lit(0))
    out = out.withColumn("used", F.when(F.col("block") > 0, F.lit(levels)).otherwise(used))
    for k in range(1, levels + 1):
        made = []
        for i in range(fanout ** (levels - k)):
            children = F.concat_ws("", *_run(k - 1, i * fanout, fanout))
            some = F.col("filled") > i * fanout ** k
            made.append(F.when(some, F.sha2(children.cast("binary"), 256)).alias(f"h{k}_{i}"))
        out = out.select("*", *made)
    tops = [F.when(F.col("used") == k, _at(k, 0)) for k in range(levels + 1)]
    return out.withColumn("top", F.coalesce(*tops))


def _at(level: int, i: int) -> Column:
    return F.col(f"h{level}_{i}") if level else F.col(f"c{i}.hash")


def _run(level: int, first: int, n: int) -> list[Column]:
    return [_at(level, i) for i in range(first, first + n)]


def _slots(fanout: int, levels: int) -> Column:
    """The slots of a block as an array: what is in each, and its siblings on the block's used levels."""
    out = []
    for j in range(fanout ** levels):
        path = []
        for k in range(levels):
            i = j // fanout ** k
            run = i - i % fanout
            path.append(F.struct(F.concat_ws("", *_run(k, run, i - run)).alias("left"),
                                 F.concat_ws("", *_run(k, i + 1, run + fanout - i - 1)).alias("right")))
        out.append(F.struct(F.lit(j).alias("slot"), F.col(f"c{j}").alias("node"),
                            F.slice(F.array(*path), F.lit(1), F.col("used")).alias("path")))
    return F.filter(F.array(*out), lambda s: s["node"].isNotNull())


def grow(nodes: DataFrame, group: list[str], carried: list[str], fanout: int = FANOUT,
         slots: int = SLOTS) -> list[DataFrame]:
    """The stored pivots of the trees over ``nodes(*group, pos, hash, *carried)``, one tree for each ``group``, from the
    leaves up. The last has one block for each tree, whose ``top`` is its root."""
    levels, steps, node = _levels(fanout, slots), [], ["hash", *carried]
    while True:
        steps.append(store(_pivot(nodes, group, node, fanout, levels), "merkle_blocks"))
        if steps[-1].filter("block > 0").isEmpty():
            return steps
        nodes = steps[-1].select(*group, F.col("block").alias("pos"), F.col("top").alias("hash"))
        node = ["hash"]


def unfold(steps: list[DataFrame], group: list[str], above: DataFrame, carried: list[str], fanout: int = FANOUT,
           slots: int = SLOTS) -> DataFrame:
    """The leaves of ``grow`` with their columns, ``carried`` columns of ``above(*group, pos, path, *carried)``, which has
    each tree's last block, 0, as ``pos``, and as ``path`` their siblings up to the root of their tree, then ``above``'s."""
    levels = _levels(fanout, slots)
    width = fanout ** levels
    for step in reversed(steps):
        up = above.select(*[F.col(c).alias("_up_" + c) for c in [*group, "pos", "path", *carried]])
        same = F.col("block") == F.col("_up_pos")
        for c in group:
            same = same & F.col(c).eqNullSafe(F.col("_up_" + c))
        both = step.join(up, same).select(
            *group, "block", *[F.col("_up_" + c).alias(c) for c in ["path", *carried]],
            F.explode(_slots(fanout, levels)).alias("s"))
        above = both.select(*group, (F.col("block") * width + F.col("s.slot")).alias("pos"), F.col("s.node").alias("node"),
                            F.concat("s.path", "path").alias("path"), *carried)
    return above.select(*group, "pos", "node.*", "path", *carried)


def manifest(rows: DataFrame, group: str = "lang", order: list[str] | None = None, carried: list[str] | None = None,
             fanout: int = FANOUT, slots: int = SLOTS) -> DataFrame:
    """``rows(leaf, group, *order, *carried)`` as leaves of one tree for each value of ``group``, whose roots, ordered by
    that value (null first, then by UTF-8 bytes), are the leaves of one more tree. Returns ``group``, ``order``,
    ``carried``, ``leaf``, ``subroot``, ``root`` and ``path``: for each level from the leaf to the root the
    digests left and right of it in its run (both empty where it stands alone).

    Within a group rows ascend by ``order`` (null first), then by leaf; rows that repeat are leaves of their own. Null is
    a group like others. A lone leaf is its group's subroot, a lone subroot the root. An empty table gives no rows.
    Columns are found by their exact names, others are left out. Nothing but one truth value a level reaches the driver.
    """
    if fanout < 2:
        raise ValueError("a tree needs a fanout of 2 or more")
    order, carried = list(order or ["doc_id"]), list(carried or [])
    kept = [*dict.fromkeys([*order, *carried])]
    # names of its own inside: the caller's may be any
    named = {c: f"_k{i}" for i, c in enumerate(kept)}
    inside = take(rows, "leaf", group, *kept).toDF("hash", "_group", *named.values())
    leaves = store(inside, "merkle_leaves")
    # The tie column parts leaves that are alike, so that many copies of a row don't meet in one range.
    tied = leaves.withColumn("_tie", F.monotonically_increasing_id())
    placed = running_totals(tied, ["_group"], [*[named[c] for c in order], "hash", "_tie"], F.lit(1).cast("bigint"),
                            "pos", "merkle_positions", write=store)
    trees = grow(placed, ["_group"], list(named.values()), fanout, slots)
    tops = trees[-1].select(F.col("_group").alias("_of"), F.col("top").alias("hash"))
    numbered = running_totals(tops, [], [F.asc_nulls_first("_of")], F.lit(1).cast("bigint"), "pos", "merkle_groups",
                              write=store)
    forest = grow(numbered, [], ["_of"], fanout, slots)
    start = forest[-1].select(F.col("block").alias("pos"), F.array().cast(_PATH).alias("path"), F.col("top").alias("root"))
    subroots = unfold(forest, [], start, ["root"], fanout, slots).select(
        F.col("_of").alias("_group"), F.lit(0).cast("long").alias("pos"), F.col("hash").alias("subroot"), "root", "path")
    found = unfold(trees, ["_group"], subroots, ["subroot", "root"], fanout, slots)
    return found.select(F.col("_group").alias(group), *[F.col(n).alias(c) for c, n in named.items() if c != group],
                        F.col("hash").alias("leaf"), "subroot", "root", "path")


def proof(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    sides = F.transform(path, lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(sides, "").cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(
        F.concat(s["left"], node, s["right"]).cast("binary"), 256))


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = take(table(spark, sf_dir, "documents"), "doc_id", "source", "lang", "n_chars", "text")
    one_more = F.col("n_chars").cast("decimal(38,0)") + 1
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = docs.select(
        "doc_id", "lang", leaf(*[F.col(c) for c in docs.columns]).alias("leaf"),
        F.when(touched, leaf(*[one_more if c == "n_chars" else F.col(c) for c in docs.columns])).alias("tampered"))
    found = manifest(rows, "lang", ["doc_id"], ["tampered"])
    refolded = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return refolded.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                           "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
