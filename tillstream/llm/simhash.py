"""Near-dedup by SimHash: fingerprints, tiled exact comparison, components."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import cut, null_safe

SHINGLE = 3  # words
RADIUS = 2  # bits
SEED = 42
# A fingerprint's population counts are taken by quarter: 17 ** 4 cells at most.
QUARTERS, QUARTER_BITS = 4, 16
# Fingerprints of a tile, down and across.
TILE_ROWS, TILE_COLUMNS = 4096, 16384
# Bytes of one text split into words at a time.
PIECE_BYTES = 1 << 20

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, in pieces that end at a blank.

    ``bytes.lower`` and ``bytes.split`` know ASCII only.
    """
    low = 0
    while low < len(text):
        blank = _BLANK.search(text, low + PIECE_BYTES)
        high = blank.start() if blank else len(text)
        yield text[low:high].lower().split()
        low = high


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each the majority of that bit over the hashes of all shingles.

    Words are what stands between blanks. Fewer words than a shingle make one shingle;
    no words make zero. A long text is worked on in pieces, so memory does not grow with it.
    """
    ones, count = np.zeros((8, 8), dtype=np.int64), 0

    def add(runs: Iterable[Sequence[bytes]]) -> int:
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(seed)), dtype=np.uint64
        )
        octets = hashes.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[k] += np.bincount(octets[:, k], minlength=256) @ _BITS
        return len(hashes)

    held: list[bytes] = []
    for words in _words(text):
        held = held + words if held else words
        if len(held) >= shingle:
            count += add(zip(*[held[k:] for k in range(shingle)]))
            # The words that begin shingles of the next piece.
            held = held[len(held) - shingle + 1 :]
    if count == 0:
        if not held:
            return 0
        count = add([held])
    return int.from_bytes(np.packbits(2 * ones > count, axis=1).tobytes(), "little")


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    seed: int = SEED,
) -> DataFrame:
    """``_id``, ``_text_hash`` and ``fingerprint`` (bigint) of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            prints = np.fromiter(
                (simhash(x.as_py() or b"", shingle, seed) for x in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))],
                names=["_id", "_text_hash", "fingerprint"],
            )

    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("_text_hash"),
        text.alias("_text"),
    ).mapInArrow(hashed, f"_id {kind}, _text_hash bigint, fingerprint bigint")


def _cell(fingerprint: Column) -> Column:
    """The population counts of a fingerprint's quarters as one number, base 32."""
    cell, quarter = F.lit(0), F.lit((1 << QUARTER_BITS) - 1)
    for k in range(QUARTERS):
        bits = F.shiftrightunsigned(fingerprint, k * QUARTER_BITS).bitwiseAND(quarter)
        cell = cell * 32 + F.bit_count(bits)
    return cell


def _moves(radius: int) -> list[int]:
    """How far cells can lie apart if fingerprints differ in ``radius`` bits at most."""
    steps = product(range(-radius, radius + 1), repeat=QUARTERS)
    near = [s for s in steps if sum(map(abs, s)) <= radius]
    return sorted(sum(x * 32 ** (QUARTERS - 1 - k) for k, x in enumerate(s)) for s in near)


def _stars_of_tile(
    rows: np.ndarray, columns: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """What the links between two sets of fingerprints connect, as stars.

    The sets are compared whole, row block by row block. Each linked fingerprint is
    paired with the least of all it is connected with in this tile: fewer pairs than
    there are fingerprints, however dense the tile, and no long chains.
    """
    tree = np.arange(len(columns))
    linked = np.zeros(len(columns), dtype=bool)
    linked_rows: list[int] = []
    through: list[int] = []
    step = max(1, (1 << 21) // max(len(columns), 1))
    for low in range(0, len(rows), step):
        block = rows[low : low + step, None]
        near = (np.bitwise_count(block ^ columns[None, :]) <= radius) & (block != columns[None, :])
        for k in np.flatnonzero(near.any(axis=1)):
            found = np.flatnonzero(near[k])
            trees = np.unique(tree[found])
            if len(trees) > 1:
                tree[np.isin(tree, trees)] = trees[0]
            linked[found] = True
            linked_rows.append(low + k)
            through.append(found[0])
    members = np.concatenate([rows[linked_rows], columns[linked]]).view(np.int64)
    trees = np.concatenate([tree[through], tree[linked]]).astype(np.int64)
    order = np.lexsort((members, trees))
    members, trees = members[order], trees[order]
    heads = np.flatnonzero(np.append(True, trees[1:] != trees[:-1])[: len(trees)])
    least = np.repeat(members[heads], np.diff(np.append(heads, len(members))))
    return members[members != least], least[members != least]


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (``a``, ``b``) that connect what links within ``radius`` bits connect.

    ``prints`` holds distinct fingerprints. Each belongs to the cell of its four quarter
    population counts. Two that differ in few bits lie in the same or near cells, so
    only tiles of near cells are compared; all others are skipped. A cell's fingerprints
    meet those of its near cells of no higher number, in tiles of bounded size.
    """
    cells = cut(
        prints.select("fingerprint", _cell(F.col("fingerprint")).alias("_cell"))
    )
    moves = F.array(*[F.lit(m) for m in _moves(radius) if m <= 0])
    sizes = cells.groupBy("_cell").agg(F.count("*").alias("_n"))
    visits = sizes.select("_cell", "_n", F.explode(moves).alias("_move")).select(
        (F.col("_cell") - F.col("_move")).alias("_cell"), "_n"
    )
    # At most 17 ** 4 rows whatever the input: safe to broadcast.
    grid = cut(
        sizes.join(
            visits.groupBy("_cell").agg(F.sum("_n").alias("_visits")), "_cell"
        ).select(
            F.col("_cell").alias("_at"),
            F.ceil(F.col("_n") / TILE_ROWS).cast("int").alias("_down"),
            F.ceil(F.col("_visits") / TILE_COLUMNS).cast("int").alias("_across"),
        )
    )
    down = F.pmod(F.xxhash64("fingerprint"), F.col("_down")).cast("int")
    across = F.pmod(F.xxhash64(F.lit(1), "fingerprint"), F.col("_across")).cast("int")
    rows = cells.join(F.broadcast(grid), cells["_cell"] == grid["_at"]).select(
        "_at",
        down.alias("_i"),
        F.explode(F.sequence(F.lit(0), F.col("_across") - 1)).alias("_j"),
        F.lit(True).alias("_own"),
        "fingerprint",
    )
    columns = (
        cells.select("fingerprint", "_cell", F.explode(moves).alias("_move"))
        .select("fingerprint", (F.col("_cell") - F.col("_move")).alias("_to"))
        .join(F.broadcast(grid), F.col("_to") == F.col("_at"))
        .select(
            "_at",
            F.explode(F.sequence(F.lit(0), F.col("_down") - 1)).alias("_i"),
            across.alias("_j"),
            F.lit(False).alias("_own"),
            "fingerprint",
        )
    )
    own, visiting = F.col("_own"), ~F.col("_own")
    tiles = (
        rows.unionByName(columns)
        .groupBy("_at", "_i", "_j")
        .agg(
            F.collect_list(F.when(own, F.col("fingerprint"))).alias("rows"),
            F.collect_list(F.when(visiting, F.col("fingerprint"))).alias("columns"),
        )
        # A lone fingerprint that meets itself has nothing to be compared with.
        .filter((F.size("rows") > 0) & (F.size("columns") > 0))
        .filter((F.size("rows") > 1) | (F.size("columns") > 1))
        .select("rows", "columns")
    )

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, others in zip(batch.column(0), batch.column(1), strict=True):
                ends = _stars_of_tile(
                    own.values.to_numpy(zero_copy_only=False).view(np.uint64),
                    others.values.to_numpy(zero_copy_only=False).view(np.uint64),
                    radius,
                )
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], names=["a", "b"])

    return tiles.mapInArrow(compared, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node its links lead to, for every linked node.

    Each round a node takes the least root of its neighbours, then the root of that
    root, so trees shrink fast. Each round is written to the shared folder.
    """
    both = cut(
        links.select(F.col("a").alias("node"), F.col("b").alias("to"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("to")))
        .distinct()
    )
    nearest = both.groupBy("node").agg(F.min("to").alias("to"))
    roots = cut(nearest.select("node", F.least("node", "to").alias("root")))
    total = F.sum(F.col("root").cast("decimal(38,0)"))
    before = roots.agg(total).first()[0]
    while True:
        of_neighbours = (
            both.join(roots.withColumnRenamed("node", "to"), "to")
            .select("node", "root")
            .unionByName(roots)
            .groupBy("node")
            .agg(F.min("root").alias("root"))
        )
        above = roots.select(F.col("node").alias("root"), F.col("root").alias("_above"))
        roots = cut(
            of_neighbours.join(above, "root", "left").select(
                "node", F.least("root", F.coalesce("_above", "root")).alias("root")
            )
        )
        # Roots only ever fall, so an unchanged sum means none changed.
        after = roots.agg(total).first()[0]
        if before == after:
            return roots
        before = after


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    seed: int = SEED,
) -> DataFrame:
    """Each document's SimHash and the component it is in.

    Documents link where their fingerprints differ in ``radius`` bits or fewer. Returns
    a row per row of ``docs``: ``_id``, ``_text_hash``, ``fingerprint`` (16 hex digits),
    ``component_id``, the smallest id reachable over links, its own included, and
    ``_first``, whether the row is the one of its component that stays: the smallest id,
    and of its texts the one with the smallest hash. Documents with the same fingerprint
    link, so only distinct fingerprints are compared. Null or empty texts have
    fingerprint zero and link like any other. A null id counts as larger than all others
    and is a component's id only where there is no other. Equal rows are all ``_first``
    or none is. An empty table gives an empty table.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle, seed))
    row = F.struct(F.col("_id").isNull().alias("none"), "_id", "_text_hash")
    distinct = prints.groupBy("fingerprint").agg(F.min(row).alias("_least"))
    roots = components(near_links(distinct.select("fingerprint"), radius))
    rooted = cut(
        distinct.withColumnRenamed("fingerprint", "_print")
        .join(roots.withColumnRenamed("node", "_print"), "_print", "left")
        .select("_print", "_least", F.coalesce("root", "_print").alias("_root"))
    )
    least = cut(rooted.groupBy("_root").agg(F.min("_least").alias("_least")))
    # Written out, so the join deals both sides out and adaptive execution can split a
    # fingerprint that very many documents share.
    labels = cut(rooted.select("_print", "_root").join(least, "_root").select("_print", "_least"))
    joined = prints.join(labels, prints["fingerprint"] == labels["_print"])
    first = F.col("_id").eqNullSafe(F.col("_least._id")) & (
        F.col("_text_hash") == F.col("_least._text_hash")
    )
    return joined.select(
        "_id",
        "_text_hash",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("_least._id").alias("component_id"),
        first.alias("_first"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int
) -> DataFrame:
    """The documents, one of each component: all columns of one row.

    Of rows equal in id and text one stays. See ``near_duplicates`` for which stays.
    """
    text_hash = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    found = near_duplicates(docs, id_col, text_col, **options)
    stays = found.filter("_first").select("_id", "_text_hash").distinct()
    packed = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        text_hash.alias("_text_hash"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    kept = packed.join(stays, null_safe(packed, stays, "_id", "_text_hash"), "left_semi")
    return kept.dropDuplicates(["_id", "_text_hash"]).select("_row.*")
