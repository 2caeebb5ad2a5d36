"""Merkle manifest of a dataset: a digest tree per group, a tree over the groups, and a proof for every row.

Rows get ranks in their group; the base-3 digits of a rank name the nodes above its leaf. Within blocks of 3^6 leaves
the digit columns are grouped away one after another, each time nesting the structs of three children in their parent.
Block digests are the leaves of the next round, so a tree of any size takes a few rounds and no task holds more than
blocks. On the way back each block meets the path above it (one row a block); transforms and explodes turn block and
path into the proofs of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.tables import stored

#: Children of a node, and the digits that are grouped away in one block.
FANOUT = 3
DIGITS = 6
#: No tree of 64-bit ranks is deeper.
MOST_DEPTH = 40
#: monotonically_increasing_id keeps the partition above these bits.
PARTITION_BITS = 33

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of a text."""
    return F.sha2(text, 256)


def leaf_digest(*values: Column) -> Column:
    """Digest of the values one after another: `-` for NULL, else the count of bytes, `:` and the value as text."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return digest(F.concat(*(part(v) for v in values)))


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with rank (from 0 in their group) and depth (levels of the group's tree) for rows of (group, h, data, ...).

    Rows are range-partitioned and sorted; a rank is the place in the partition plus what earlier partitions hold of
    the group. A number of their own keeps equal rows apart, so a run of them is split like any other.
    """
    keys = ["grp", *order, "copy"]
    spread = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(spread.select("grp", "h", "data", F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", PARTITION_BITS).alias("part")
    runs = placed.groupBy("grp", part).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("grp")
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("grp", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(own).alias("total"))
    depth = F.expr(" + ".join(f"int(total > {FANOUT**k}L)" for k in range(MOST_DEPTH)))
    met = placed.select("*", part).join(starts.select("grp", "part", "shift", depth.alias("depth")), ["grp", "part"])
    return met.select("grp", "depth", (F.col("at") + F.col("shift")).alias("rank"), "h", "data")


def _blocks(nodes: DataFrame, below: int) -> DataFrame:
    """group, block, depth, h, kids of nodes (group, depth, rank, h, data) that stand `below` levels above the leaves.

    A block's rows meet once, by (group, block); the digits are then grouped away without another shuffle. A level above
    the depth of a tree has a single node there, which passes its digest on.
    """
    digits = [f"int(rank div {FANOUT**k} % {FANOUT}) AS d{k}" for k in range(1, DIGITS)]
    child = f"named_struct('d', int(rank % {FANOUT}), 'h', h, 'rank', rank, 'data', data) AS child"
    rows = nodes.selectExpr("grp", f"rank div {FANOUT**DIGITS} AS block", "depth", *digits, child)
    rows = rows.repartition("grp", "block")
    joined = "sha2(array_join(transform(kids, kid -> kid.h), ''), 256)"
    for level in range(1, DIGITS + 1):
        left = [f"d{k}" for k in range(level, DIGITS)]
        grouped = rows.groupBy("grp", "block", "depth", *left).agg(F.sort_array(F.collect_list("child")).alias("kids"))
        made = grouped.withColumn("h", F.expr(f"if(depth >= {below + level}, {joined}, kids[0].h)"))
        if level == DIGITS:
            return made
        rows = made.select("grp", "block", "depth", *left[1:], F.struct(F.col(left[0]).alias("d"), "h", "kids").alias("child"))
    raise AssertionError


def _stepped(level: int) -> Column:
    """The kids of a node, each with what stands left and right of it in its run; nothing on levels the tree lacks."""
    left, right = (f"array_join(transform(filter(kids, s -> s.d {side} kid.d), s -> s.h), '')" for side in "<>")
    step = f"array(named_struct('left', {left}, 'right', {right}))"
    return F.expr(f"transform(kids, kid -> named_struct('kid', kid, 'step', if(depth >= {level}, {step}, cast(array() AS {PROOF}))))")


def _rollup(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of each round, bottom up; in the last one each group has a single block."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    rounds: list[DataFrame] = []
    while True:
        rounds.append(stored(_blocks(nodes, len(rounds) * DIGITS)))
        if len(rounds) * DIGITS >= deepest:
            return rounds
        nodes = rounds[-1].select("grp", "depth", F.col("block").alias("rank"), "h", F.lit(None).cast("boolean").alias("data"))


def _proofs(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """h, data, path of all leaves and the other columns of tops (group, path, ...), which hold the path above each tree."""
    more = [c for c in tops.columns if c not in ("grp", "path")]
    paths = tops.withColumn("block", F.lit(0).cast("long"))
    for k in reversed(range(len(rounds))):
        rows = rounds[k].join(paths, ["grp", "block"]).select("grp", *more, "path", "depth", "kids")
        for level in range(DIGITS, 0, -1):
            each = rows.select("grp", *more, "path", "depth", F.explode(_stepped(k * DIGITS + level)).alias("x"))
            node = ["x.kid.kids"] if level > 1 else ["x.kid.h", "x.kid.data"] if k == 0 else [F.col("x.kid.rank").alias("block")]
            rows = each.select("grp", *more, F.concat("x.step", "path").alias("path"), "depth", *node)
        paths = rows.drop("depth")
    return paths


def manifest(docs: DataFrame, **carried: Column) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof of every row, and the `carried` columns.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Leaves of a source ascend by doc_id; nodes become
    the digest of three at a time (the last run: fewer, even one) until one remains, the subroot. Subroots in the order
    of their sources give the root in the same way. proof lists, from the leaf up to the root, the digests left and
    right of the row's node in its run, each side concatenated.

    NULL values have a leaf form of their own; a NULL source is a group that comes first; NULL ids come first in their
    source; rows that agree in id are ordered by leaf, repeated rows are leaves of their own, so a result does not
    depend on the order of the input. An empty table gives an empty manifest. Other columns take no part.
    """
    values = [F.col(f"`{c}`") for c in FIELDS]
    kinds = {"doc_id": "long", "source": "string"}
    own = F.struct(*(F.col(f"`{c}`").cast(k).alias(c) for c, k in kinds.items()), *(c.alias(name) for name, c in carried.items()))
    # '' for NULL comes before '=' and a name; both compare by bytes.
    group = F.when(F.col("`source`").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("`source`").cast("string")))
    leaves = docs.select(group.alias("grp"), leaf_digest(*values).alias("h"), own.alias("data"))
    trees = _rollup(_ranked(leaves.withColumn("id", F.col("data.doc_id")), "id", "h"))
    subroots = trees[-1].select("grp", "h")
    over = _rollup(_ranked(subroots.select(F.lit("").alias("grp"), "h", F.col("grp").alias("data"), F.col("grp").alias("name")), "name"))
    top = over[-1].select("grp", F.col("h").alias("root"), F.array().cast(PROOF).alias("path"))
    tops = _proofs(over, top).select(F.col("data").alias("grp"), "root", F.col("h").alias("subroot"), "path")
    rows = _proofs(trees, tops)
    return rows.select("data.doc_id", "data.source", F.col("h").alias("leaf"), "subroot", "root", F.col("path").alias("proof"), *(f"data.{name}" for name in carried))


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda h, step: digest(F.concat(step["left"], h, step["right"])))
