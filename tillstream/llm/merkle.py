"""Merkle manifest of a dataset: built level by level, proven by a recursive climb."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.llm.common import scratch_path

FANOUT = 3  # consecutive nodes that become one
# What a climb looks up is kept once per block of leaves, so no key of its joins has more
# leaves than a block, however many share an upper node.
BLOCK_LEVELS = 7
BLOCK = FANOUT**BLOCK_LEVELS
# A node's number holds its level below the place of its first leaf: levels of a source's
# tree first, then those of the tree over the sources.
SOURCE_LEVELS, LEVEL_CODES = 39, 64
DIGEST_BYTES = 32
_NODES = "_block bigint, _node bigint, _up bigint, _place int, _digests binary"


@dataclass(frozen=True)
class Manifest:
    """The stored tree.

    ``leaves``: ``_id``, ``_digest``, ``_claimed``, its place ``_leaf``, its ``_block``,
    and its link: the node ``_up`` above it and its ``_place`` below that. ``nodes``: the
    rows to climb, one per node and block: ``_block``, ``_node``, ``_digests`` of its
    children, and its own link. ``blocks``: the ``_subroot`` of each block's source.
    ``root`` is null for an empty table.
    """

    leaves: DataFrame
    nodes: DataFrame
    blocks: DataFrame
    root: bytes | None


def field_text(column: Column) -> Column:
    """A field as it is hashed: UTF-8 byte count, colon, value; ``-`` where it is null."""
    text = column.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(counted, F.lit("-"))


def digest_of(*fields: Column) -> Column:
    """SHA-256 (binary) of the fields, one after the other."""
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _above(digests: Column) -> Column:
    """The node above a run: the hash of its digests as hex text."""
    return F.unhex(F.sha2(hex_text(digests), 256))


def _div(column: Column, by: Column | int) -> Column:
    return F.call_function("div", column, F.lit(by))


def _powers() -> Column:
    return F.array(*[F.lit(FANOUT**k).cast("bigint") for k in range(SOURCE_LEVELS)])


def _depth(count: Column) -> Column:
    """Levels above so many nodes until one is left."""
    return F.size(F.filter(_powers(), lambda p: p < count))


def _depth_of(count: int) -> int:
    depth = 0
    while FANOUT**depth < count:
        depth += 1
    return depth


def _source_node(first: Column, position: Column, level: Column | int) -> Column:
    span = F.get(_powers(), level) if isinstance(level, Column) else F.lit(FANOUT**level)
    return (first + position * span) * LEVEL_CODES + level


def _top_node(position: Column, level: Column | int) -> Column:
    span = F.get(_powers(), level) if isinstance(level, Column) else F.lit(FANOUT**level)
    return position * span * LEVEL_CODES + SOURCE_LEVELS + level


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, *order: str, name: str) -> DataFrame:
    """The rows with their place ``name`` (from 0) in the order, nulls first, and ``_task``.

    Rows are dealt out by range and sorted in their tasks; equal rows may be dealt to
    several. Only one count per task is summed up in one place. The places are those of
    the rows as written, so later steps see the same ones, whatever is lost.
    """
    keys = [*order, "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
    # Of these ids the upper bits are the task, the lower 33 the row in it.
    dealt = dealt.sortWithinPartitions(*keys).drop("_tie")
    placed = _stored(dealt.withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_task", F.shiftright("_mid", 33))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_task").agg(F.count("*").alias("_n"))
    starts = starts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_mid").bitwiseAND((1 << 33) - 1)
    # One row per task of the exchange above, so never more than it has partitions.
    return placed.join(F.broadcast(starts), "_task").select(*rows.columns, place.alias(name), "_task")


def _with_sources(leaves: DataFrame) -> DataFrame:
    """Add ``_first`` leaf, ``_count`` of leaves and ``_rank`` of each leaf's source.

    Joined by task and source, so a source with a third of all rows is no hot key.
    """
    parts = leaves.groupBy("_task", "_source").agg(
        F.min("_leaf").alias("_first"), F.count("*").alias("_count")
    )
    sources = parts.groupBy("_source").agg(
        F.min("_first").alias("_first"), F.sum("_count").alias("_count")
    )
    ranked = numbered(sources, "_source", name="_rank").select(
        F.col("_source").alias("_s"), "_first", "_count", "_rank"
    )
    parts = parts.select(F.col("_task").alias("_t"), F.col("_source").alias("_of"))
    parts = parts.join(ranked, F.col("_of").eqNullSafe(F.col("_s"))).drop("_s")
    same = (F.col("_task") == F.col("_t")) & F.col("_source").eqNullSafe(F.col("_of"))
    return leaves.join(parts, same).drop("_task", "_t", "_of")


def _runs(level: DataFrame, *by: str) -> DataFrame:
    """Every three consecutive nodes as one row: their digests, and the digest above them."""
    children = F.array_sort(F.collect_list(F.struct("_position", "_digest")))
    runs = level.groupBy(*by, _div(F.col("_position"), FANOUT).alias("_run")).agg(
        children.alias("_children")
    )
    digests = F.aggregate(
        "_children", F.lit(b""), lambda joined, child: F.concat(joined, child["_digest"])
    )
    runs = runs.select(*by, F.col("_run").alias("_position"), digests.alias("_digests"))
    return runs.withColumn("_digest", _above(F.col("_digests")))


def build_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    field_cols: Sequence[str] | None = None,
    claimed: Column | None = None,
) -> Manifest:
    """Hash every row, then every three nodes, up to one root; all levels are stored.

    A leaf is the hash of ``field_cols`` (all columns by default). The leaves of a source
    are in order of id, then of digest; the subroots in order of source; nulls first.
    ``claimed`` may give the digest that each row is claimed to have, for `prove`.

    Each level is a shuffle of a third of the one below, grouped by runs of three. Levels
    that span more than a block of leaves are repeated for each block below them, which
    adds less than one row in a hundred.

    Rows that are equal are leaves of their own, next to each other. Null ids, sources and
    fields are hashed as ``-``. A text is hashed whole, in its own task, and not shuffled:
    only digests are. An empty table has no leaves and no root.
    """
    fields = docs.columns if field_cols is None else field_cols
    own = digest_of(*[F.col(f"`{c}`") for c in fields])
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{source_col}`").alias("_source"),
        own.alias("_digest"),
        (own if claimed is None else claimed).alias("_claimed"),
    )
    placed = _with_sources(numbered(rows, "_source", "_id", "_digest", name="_leaf"))
    position = F.col("_position")
    leaves = placed.withColumn("_position", F.col("_leaf") - F.col("_first"))
    block = F.col("_first") + _div(position, BLOCK) * BLOCK
    leaves = _stored(leaves.withColumn("_block", block), "leaves")
    longest, last_rank = leaves.agg(F.max("_count"), F.max("_rank")).first()
    sources = 0 if last_rank is None else last_rank + 1
    top_levels = _depth_of(sources)

    def linked(level: DataFrame, number: int) -> DataFrame:
        """With the node above each node, and the node's place below it."""
        is_subroot = _depth(F.col("_count")) == number
        below = F.when(is_subroot, F.col("_rank")).otherwise(position)
        in_source = _source_node(F.col("_first"), _div(position, FANOUT), number + 1)
        top = _top_node(_div(F.col("_rank"), FANOUT), 1) if top_levels else F.lit(None).cast("bigint")
        return level.withColumns(
            {
                "_up": F.when(is_subroot, top).otherwise(in_source),
                "_place": F.pmod(below, F.lit(FANOUT)).cast("int"),
            }
        )

    keys = ["_first", "_count", "_rank"]
    level = leaves.select(*keys, "_position", "_digest")
    subroots = [level.filter("_count = 1").select("_rank", "_digest")]
    lower, upper = [], []
    for number in range(1, _depth_of(longest or 0) + 1):
        wanted = level.filter(_depth(F.col("_count")) >= number)
        level = _stored(_runs(wanted, *keys), f"level{number}")
        subroots.append(level.filter(_depth(F.col("_count")) == number).select("_rank", "_digest"))
        node = linked(level, number).withColumn(
            "_node", _source_node(F.col("_first"), position, number)
        )
        if number <= BLOCK_LEVELS:
            over = _div(position, FANOUT ** (BLOCK_LEVELS - number)) * BLOCK
            node = node.withColumn("_block", F.col("_first") + over)
            lower.append(node.select("_block", "_node", "_up", "_place", "_digests"))
        else:
            upper.append(node.select("_node", "_up", "_place", "_digests"))

    tops = _stored(reduce(DataFrame.unionByName, subroots), "subroots")
    level = tops.select(F.col("_rank").alias("_position"), "_digest")
    for number in range(1, top_levels + 1):
        level = _stored(_runs(level), f"top{number}")
        above = _top_node(_div(position, FANOUT), number + 1)
        node = level.select(
            _top_node(position, number).alias("_node"),
            (above if number < top_levels else F.lit(None).cast("bigint")).alias("_up"),
            F.pmod(position, F.lit(FANOUT)).cast("int").alias("_place"),
            "_digests",
        )
        upper.append(node)
    root = level.first()["_digest"] if sources else None

    starts = leaves.filter(F.col("_leaf") == F.col("_block")).select(
        "_block", *keys, "_position"
    )
    if upper:
        over = reduce(DataFrame.unionByName, upper)
        lower.append(_ancestors(starts, top_levels).join(over, "_node").select(
            "_block", "_node", "_up", "_place", "_digests"
        ))
    blocks = starts.join(tops, "_rank").select("_block", F.col("_digest").alias("_subroot"))
    linked_leaves = linked(leaves, 0).select(
        "_id", "_digest", "_claimed", "_leaf", "_block", "_up", "_place"
    )
    if lower:
        nodes = _stored(reduce(DataFrame.unionByName, lower), "nodes")
    else:
        nodes = docs.sparkSession.createDataFrame([], _NODES)
    return Manifest(linked_leaves, nodes, blocks, root and bytes(root))


def _ancestors(starts: DataFrame, top_levels: int) -> DataFrame:
    """The nodes above each block: one row per block and level."""
    first, level = F.col("_first"), F.col("_level")
    depth = _depth(F.col("_count"))
    own = starts.filter(depth > BLOCK_LEVELS).select(
        "_block", "_first", "_position", F.explode(F.sequence(F.lit(BLOCK_LEVELS + 1), depth)).alias("_level")
    )
    in_source = _source_node(first, _div(F.col("_position"), F.get(_powers(), level)), level)
    found = own.select("_block", in_source.alias("_node"))
    if top_levels:
        tops = starts.select(
            "_block", "_rank", F.explode(F.sequence(F.lit(1), F.lit(top_levels))).alias("_level")
        )
        top = _top_node(_div(F.col("_rank"), F.get(_powers(), level)), level)
        found = found.unionByName(tops.select("_block", top.alias("_node")))
    return found


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """Recursion stops at a million rows unless told otherwise."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_CLIMB = """
    with recursive climb(leaf, block, up, place, folded, siblings, step) as (
        select _leaf, _block, _up, _place, _claimed, cast('' as binary), 0 from {leaves}
        union all
        select c.leaf, c.block, n._up, n._place,
            unhex(sha2(lower(hex(concat(
                substring(n._digests, 1, {bytes} * c.place),
                c.folded,
                substring(n._digests, {bytes} * c.place + {bytes} + 1)))), 256)),
            concat(
                substring(n._digests, 1, {bytes} * c.place),
                substring(n._digests, {bytes} * c.place + {bytes} + 1)),
            c.step + 1
        from climb c join {nodes} n on n._block = c.block and n._node = c.up
    )
    select leaf, step, siblings, case when up is null then folded end as folded from climb
"""


def climb(manifest: Manifest) -> DataFrame:
    """Climb from every claimed leaf to the root: ``_leaf``, ``_siblings``, ``_folded``.

    A recursive query looks up the node above each leaf, appends the siblings found there
    and folds the claimed digest with them, until a node has none above it. It is as deep
    as the tree. The appended rows are then put together by leaf.
    """
    spark = manifest.leaves.sparkSession
    with _any_number_of_rows(spark):
        steps = _stored(
            spark.sql(_CLIMB, leaves=manifest.leaves, nodes=manifest.nodes, bytes=DIGEST_BYTES),
            "climbed",
        )
    climbed = steps.groupBy(F.col("leaf").alias("_leaf")).agg(
        F.array_sort(F.collect_list(F.struct("step", "siblings", "folded"))).alias("_steps")
    )
    siblings = F.aggregate(
        "_steps", F.lit(b""), lambda joined, step: F.concat(joined, step["siblings"])
    )
    return climbed.select(
        "_leaf", siblings.alias("_siblings"), F.element_at("_steps", -1)["folded"].alias("_folded")
    )


def prove(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof, and whether what is claimed of it leads to the root.

    Returns per row ``_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (the hash of
    the siblings on the way up), ``folded_root`` and ``verified``; digests are hex text.
    """
    leaves, found = manifest.leaves, climb(manifest)
    root = F.lit(manifest.root).cast("binary")
    return (
        leaves.select("_id", "_digest", "_leaf", "_block")
        .join(found, "_leaf")
        .join(manifest.blocks, "_block")
        .select(
            "_id",
            hex_text(F.col("_digest")).alias("leaf"),
            hex_text(F.col("_subroot")).alias("subroot"),
            hex_text(root).alias("root"),
            F.sha2(hex_text(F.col("_siblings")), 256).alias("proof_sha256"),
            hex_text(F.col("_folded")).alias("folded_root"),
            (F.col("_folded") == root).alias("verified"),
        )
    )
