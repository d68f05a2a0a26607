"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import cut, null_safe

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Documents whose fractions one task pairs at a time; the tree's fan-in.
BLOCK = 256
# Equal rows that are given out at a time.
CHUNK = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Target size of each source: its share of all, at most ``most`` times its size.

    ``sizes`` has a row per source (``_source``, ``source_size``): the windows below
    order that short table, never documents. What a source at its limit leaves over is
    shared out by weight. With sources in order of limit to weight, those at their limit
    come first, so running sums give the result of sharing again until none is above.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("_nth") % len(weights)) + 1
    )
    wide = "decimal(38,0)"
    ranked = (
        sizes.withColumn("_nth", F.row_number().over(by_name) - 1)
        .withColumn("_weight", weight.cast("decimal(18,0)"))
        .withColumn("_limit", (F.col("source_size") * most).cast("decimal(20,0)"))
    )
    order = [F.col("_limit") / F.col("_weight"), F.col("_nth")]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    total, weight_total = F.sum("source_size").over(everywhere), F.sum("_weight").over(everywhere)
    zero = F.lit(0).cast(wide)
    rest = total.cast(wide) - F.coalesce(F.sum("_limit").over(earlier), zero)
    rest_weight = weight_total - F.coalesce(F.sum("_weight").over(earlier), zero)
    shared = ranked.select(
        "*", rest.cast(wide).alias("_rest"), rest_weight.cast("decimal(18,0)").alias("_rest_weight")
    ).withColumn(
        "_at_limit",
        F.col("_limit") * F.col("_rest_weight") <= F.col("_rest").cast("decimal(20,0)") * F.col("_weight"),
    )
    # The first source below its limit says what the weight of one is worth.
    free = F.when(~F.col("_at_limit"), F.struct("_nth_free", "_rest", "_rest_weight"))
    shared = shared.withColumn("_nth_free", F.row_number().over(Window.orderBy(*order)))
    worth = F.min(free).over(everywhere)
    below = (F.col("_weight") * F.col("_worth._rest").cast("decimal(20,0)")).cast(
        "double"
    ) / F.col("_worth._rest_weight").cast("double")
    target = F.when(F.col("_at_limit"), F.col("_limit").cast("double")).otherwise(below)
    return shared.withColumn("_worth", worth).select(
        "_source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def _chance(seed: int, level: int) -> Column:
    """A number in [0, 1) that depends on the document, the seed and the level only."""
    bits = F.xxhash64(F.lit(seed), F.lit(level), "_id", "_text_hash")
    return F.shiftrightunsigned(bits, 11).cast("double") / F.lit(float(1 << 53))


def _pair_up(items: Column) -> Column:
    """Fold a block: each member meets the one still open, words move until one is whole.

    Expected words move from one to the other until either's fraction is 0 or 1, in the
    direction and with the chance that leave both expectations as they are. What one
    loses in words the other gains, so the block's expected words never change. Returns
    the place, fraction and size of the one that stays open, and the places of those
    that became one; all others became zero.
    """
    start = F.struct(
        F.lit(0.0).alias("share"),
        F.lit(1.0).alias("size"),
        F.lit(-1).alias("open"),
        F.array().cast("array<int>").alias("won"),
    )

    def meet(held: Column, new: Column) -> Column:
        # Words that can move to the held one, and words that can move away from it.
        to_held = F.least(held["size"] * (1 - held.share), new["size"] * new.share)
        to_new = F.least(held["size"] * held.share, new["size"] * (1 - new.share))
        gains = new.chance * (to_held + to_new) < to_new
        held_share = F.when(gains, held.share + to_held / held["size"]).otherwise(
            held.share - to_new / held["size"]
        )
        new_share = F.when(gains, new.share - to_held / new["size"]).otherwise(
            new.share + to_new / new["size"]
        )
        held_whole = F.when(
            gains, held["size"] * (1 - held.share) <= new["size"] * new.share
        ).otherwise(held["size"] * held.share <= new["size"] * (1 - new.share))
        # A whole one was won if it gained: the held one with ``gains``, else the new one.
        winner = F.when(held_whole & gains, held.open).when(~held_whole & ~gains, new.place)

        def bounded(share: Column) -> Column:
            return F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))

        return F.struct(
            F.when(held_whole, bounded(new_share)).otherwise(bounded(held_share)).alias("share"),
            F.when(held_whole, new["size"]).otherwise(held["size"]).alias("size"),
            F.when(held_whole, new.place).otherwise(held.open).alias("open"),
            F.when(winner.isNotNull(), F.concat(held.won, F.array(winner)))
            .otherwise(held.won)
            .alias("won"),
        )

    return F.aggregate(items, start, meet)


def _round(open_rows: DataFrame, groups: list[str], seed: int, level: int) -> DataFrame:
    """One level of the tree: per block, all but one document are decided.

    Blocks are in order of size, so words move between documents of similar size.
    """
    member = F.struct(
        (-F.col("_size")).alias("order"),
        _chance(seed, level).alias("chance"),
        F.col("_id").alias("id"),
        F.col("_text_hash").alias("text_hash"),
        F.col("_share").alias("share"),
    )
    blocks = open_rows.groupBy(*groups).agg(F.array_sort(F.collect_list(member)).alias("_items"))
    numbered = F.transform(
        "_items",
        lambda x, i: F.struct(
            i.alias("place"),
            x.share.alias("share"),
            (-x.order).cast("double").alias("size"),
            x.chance.alias("chance"),
        ),
    )
    folded = blocks.select("_source", "_items", _pair_up(numbered).alias("_end"))
    return folded.select("_source", "_end", F.posexplode("_items").alias("_place", "_item")).select(
        "_source",
        F.col("_item.id").alias("_id"),
        F.col("_item.text_hash").alias("_text_hash"),
        (-F.col("_item.order")).alias("_size"),
        F.when(F.col("_place") == F.col("_end.open"), F.col("_end.share"))
        .otherwise(F.array_contains("_end.won", F.col("_place")).cast("double"))
        .alias("_share"),
        (F.col("_place") == F.col("_end.open")).alias("_open"),
    )


def _mixed_units(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    source_col: str,
    weights: tuple[int, ...],
    most: int,
    seed: int,
) -> DataFrame:
    """How often each unit is taken: ``_rows`` rows equal in source, id and text.

    Each row is taken ``_whole`` times, and ``_extra`` of the unit's rows once more.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # Texts are read once; all that follows works on this narrow table.
    units = cut(
        docs.select(
            F.col(f"`{id_col}`").alias("_id"),
            F.col(f"`{source_col}`").alias("_source"),
            F.xxhash64(text).alias("_text_hash"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("_size"),
        )
        .groupBy("_source", "_id", "_text_hash", "_size")
        .agg(F.count("*").alias("_rows"))
    )
    sizes = units.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_rows")).alias("source_size"))
    rate = F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))
    ).otherwise(0.0)
    targets = cut(
        source_targets(sizes, weights, most)
        .withColumn("_whole", F.floor(rate))
        .withColumn("_part", rate - F.floor(rate))
    )
    # Of n equal rows n * part are expected to be taken once more; the whole part of that
    # is certain, and its fraction is the unit's share in the pairing.
    expected = F.when(F.col("_size") > 0, F.col("_rows") * F.col("_part")).otherwise(0.0)
    units = cut(
        units.join(targets, null_safe(units, targets, "_source")).select(
            units["_source"],
            "_id",
            "_text_hash",
            "_size",
            "_rows",
            "source_size",
            "target",
            F.when(F.col("_size") > 0, F.col("_whole")).otherwise(0).alias("_whole"),
            F.floor(expected).alias("_certain"),
            (expected - F.floor(expected)).alias("_share"),
        )
    )

    # Open units are blocked by source and size, as many blocks as they fill.
    banded = (
        units.filter(F.col("_share") > 0)
        .select("_source", "_id", "_text_hash", "_size", "_share")
        .withColumn("_band", F.floor(F.log2(F.col("_size").cast("double")) * 4).cast("int"))
    )
    counts = cut(
        banded.groupBy(F.struct("_source", "_band").alias("_key"))
        .agg(F.ceil(F.count("*") / BLOCK).alias("_blocks"))
        .select(F.col("_key._source").alias("_source"), F.col("_key._band").alias("_band"), "_blocks")
    )
    level_rows = banded.join(counts, null_safe(banded, counts, "_source", "_band")).select(
        banded["_source"], "_id", "_text_hash", "_size", "_share", banded["_band"], "_blocks"
    )
    spread = F.pmod(F.xxhash64(F.lit(seed), "_id", "_text_hash"), F.col("_blocks"))
    level_rows = level_rows.withColumn("_block", spread)
    groups = ["_source", "_band", "_block"]

    # At most this many stay open per source after a level.
    left = counts.groupBy("_source").agg(F.sum("_blocks").alias("_left"))
    most_left = left.agg(F.max("_left")).first()[0] or 0
    decided, level = [], 0
    while most_left:
        done = cut(_round(level_rows, groups, seed, level))
        still = done.filter("_open").select("_source", "_id", "_text_hash", "_size", "_share")
        decided.append(done.filter("not _open").drop("_open"))
        level += 1
        if most_left == 1:
            wins = (_chance(seed, level) < F.col("_share")).cast("double")
            decided.append(still.withColumn("_share", wins))
            break
        most_left = -(-most_left // BLOCK)
        spread = F.pmod(F.xxhash64(F.lit(seed + level), "_id", "_text_hash"), F.lit(most_left))
        level_rows = still.withColumn("_block", spread)
        groups = ["_source", "_block"]

    if not decided:
        return cut(units.withColumn("_extra", F.col("_certain")))
    keys = ["_source", "_id", "_text_hash"]
    union = reduce(DataFrame.unionByName, decided)
    won = union.filter(F.col("_share") == 1).select(*keys, F.lit(1).alias("_won"))
    extra = F.col("_certain") + F.coalesce("_won", F.lit(0))
    return cut(
        units.join(won, null_safe(units, won, *keys), "left").select(
            *[units[c] for c in units.columns], extra.alias("_extra")
        )
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 42,
) -> DataFrame:
    """How often a mixture by source weight takes each document.

    Sources in code point order, null last, weigh ``weights`` in turn and share the size
    of all documents, in words between blanks; a target stops at ``most`` times its
    source's size. A document's expected copies are its source's target by its source's
    size. The whole part is taken for certain. Fractions are paired: expected words move
    at random between two documents until one is whole, in blocks of bounded size, and
    what stays open goes up a tree of blocks. The one left at its root is drawn by its
    fraction, so every expectation is kept and the words taken of a source differ from
    its target by less than a document. Chances come from hashes, so a rerun takes the same.

    Returns a row per row of ``docs``: ``_id``, ``_source``, ``_text_hash`` (64-bit hash
    of the text), ``size``, ``source_size``, ``target``, ``copies`` and ``taken``. Of rows
    with the same id, source and text some may be taken once more than others, so that
    together they come as near to what is expected of them as one document does. A null
    or empty text has size 0 and is never taken; a null source is a source; a null id is
    an id. A very long text is one document: a source of few such ones misses its target
    by less than its longest. A table without words has targets of 0. An empty table
    gives an empty table.
    """
    units = _mixed_units(docs, id_col, text_col, source_col, weights, most, seed)
    # A unit's rows are made from its count, a chunk at a time, and chunks are dealt out.
    one = units.filter("_rows = 1").withColumn("_nth", F.lit(0).cast("bigint"))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_rows") - 1) / CHUNK))
    dealt = units.filter("_rows > 1").withColumn("_chunk", F.explode(chunks))
    dealt = dealt.repartition("_source", "_id", "_text_hash", "_chunk")
    first = F.col("_chunk") * CHUNK
    nth = F.explode(F.sequence(first, F.least(first + CHUNK, F.col("_rows")) - 1))
    rows = one.unionByName(dealt.withColumn("_nth", nth).drop("_chunk"))
    copies = F.col("_whole") + (F.col("_nth") < F.col("_extra")).cast("bigint")
    return rows.select(
        "_id",
        "_source",
        "_text_hash",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        copies.cast("bigint").alias("copies"),
        (copies * F.col("_size")).cast("bigint").alias("taken"),
    )


def take_mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 42,
) -> DataFrame:
    """The mixture itself: each document as often as :func:`mix_sources` takes it.

    All columns of ``docs`` come back, with ``copy`` (from 1), ``size``, ``source_size``
    and ``target`` behind them; columns of those names are replaced. Of rows with the same
    id, source and text, those that come first in their part of the input are taken more.
    """
    added = ("copy", "size", "source_size", "target")
    keys = ["_id", "_source", "_text_hash"]
    units = _mixed_units(docs, id_col, text_col, source_col, weights, most, seed)
    packed = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{source_col}`").alias("_source"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_text_hash"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("_row"),
    )

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, null_safe(left, right, *keys)).select(
            *[left[k] for k in keys],
            *[c for c in left.columns if c not in keys],
            *[c for c in right.columns if c not in keys],
        )

    uneven = (F.col("_extra") > 0) & (F.col("_extra") < F.col("_rows"))
    more = (F.col("_extra") == F.col("_rows")).cast("bigint")
    taken = joined(packed, units.filter(~uneven)).withColumn("_copies", F.col("_whole") + more)
    some = units.filter(uneven)
    if not some.isEmpty():
        # Rows are numbered in the parts they are read in; a part's rows of a unit get
        # what is left of the unit's extra copies behind the parts before it. A rerun
        # reads the same parts.
        placed = cut(
            joined(packed.withColumn("_part", F.spark_partition_id()), some).withColumn(
                "_at", F.monotonically_increasing_id()
            )
        )
        per_part = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
        before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = per_part.select(
            *keys, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
        )
        own = Window.partitionBy(*keys, "_part").orderBy("_at")
        numbered = placed.withColumn("_nth", F.row_number().over(own) - 1)
        numbered = numbered.join(starts, null_safe(numbered, starts, *keys, "_part")).select(
            *[numbered[c] for c in numbered.columns], "_before"
        )
        gets = (F.col("_before") + F.col("_nth") < F.col("_extra")).cast("bigint")
        uneven_taken = numbered.withColumn("_copies", F.col("_whole") + gets)
        taken = taken.unionByName(uneven_taken.select(*taken.columns))
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return (
        taken.filter("_copies > 0")
        .select("_row", copies.alias("copy"), F.col("_size").alias("size"), "source_size", "target")
        .select("_row.*", *added)
    )
