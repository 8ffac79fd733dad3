"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2**32 positions in ``CELLS`` cells.  A shard has ``vnodes`` virtual nodes, each in
the cell of a hash of its name; a row stands at the hash of its key.  Rows come in the order
of the ring, and each goes to the first node clockwise whose shard still has room, so what
finds its shard full continues clockwise.  A shard's room is its part of the rows: with
``slack`` 0 the parts differ by one at most and every shard ends full, so counts are at most
one apart whatever the keys are; with ``slack`` 0.2 it may hold a fifth more than the mean,
and fewer rows move when a shard is added.

All rows of an arc, the stretch before a node, walk the same way; so only the number of rows
in each cell decides, at most ``CELLS`` numbers.  Rows are numbered along the ring by ranges, a
fold over the arcs cuts these numbers into pieces, one shard each, and every row
looks up its piece by its cell.  No task holds a shard or an arc, and a key that a third of
the rows share is an arc like any other, spread over the ranges by a row number.

Only DataFrame functions run here, and texts are not shuffled.  The numbered rows are
checkpointed, so a lost executor cannot change them.

Defined cases: a null text is empty; a null id is a key of its own, before all others at its place; rows that
share an id are told apart by checksum and size, equal rows in any order; an empty table gives
none; texts of any length are measured whole; other columns are not looked at, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_rows

SHARDS, VNODES = 24, 64
CELL_BITS = 13
CELLS = 1 << CELL_BITS
# Added to a text's bytes: what a row takes besides.
ROW_BYTES = 8

_PIECE = "array<struct<arc:long,start:long,stop:long,shard:int,slot:long>>"


def _position(name: Column) -> Column:
    """Place on the ring: the first 32 bits of the name's digest."""
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long")


def _cell(position: Column) -> Column:
    return F.shiftright(position, 32 - CELL_BITS).cast("int")


def nodes(spark: SparkSession, shards: int, vnodes: int) -> DataFrame:
    """The virtual nodes: shard and cell."""
    shard = F.floor(F.col("id") / vnodes).cast("int")
    name = F.concat_ws("#", shard.cast("string"), (F.col("id") % vnodes).cast("string"))
    return spark.range(0, shards * vnodes, 1, 1).select(shard.alias("shard"), _cell(_position(name)).alias("cell"))


def _rooms(rows: Column, shards: int, slack: float) -> Column:
    """Rows each shard may hold, by its number."""
    if slack > 0:
        return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.ceil(rows * (1 + slack) / shards))
    share, rest = F.floor(rows / shards), rows % shards
    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: share + (s < rest).cast("long"))


def _walk(ring: Column, arc: Column) -> Column:
    """Shards in the order in which the arc's rows come to them."""
    at = arc.cast("int")
    return F.array_distinct(F.concat(F.slice(ring, at + 1, F.size(ring) - at), F.slice(ring, 1, at)))


def _cut(arc: Column, stop: Column, state: Column, shard: Column) -> Column:
    """The shard takes what it has room for of the arc's rows that are left."""
    left = F.get(state["rooms"], shard)
    taken = F.least(stop - state["at"], left)
    piece = F.struct(
        arc.cast("long").alias("arc"),
        state["at"].alias("start"),
        (state["at"] + taken).alias("stop"),
        shard.alias("shard"),
        F.get(state["filled"], shard).alias("slot"),
    )
    moved = lambda column, by: F.transform(column, lambda n, i: n + F.when(i == shard, by).otherwise(0))
    return F.struct(
        (state["at"] + taken).alias("at"),
        moved(state["rooms"], -taken).alias("rooms"),
        moved(state["filled"], taken).alias("filled"),
        F.when(taken > 0, F.concat(state["pieces"], F.array(piece))).otherwise(state["pieces"]).alias("pieces"),
    )


def _pieces(ring: DataFrame, shards: int, slack: float) -> DataFrame:
    """Which row numbers go to which shard: a fold over the arcs, in one row.

    ``ring`` has one row: ``ring``, the nodes' shards in order; ``upto``, the number of rows before
    each; ``rows``.
    """
    n = F.col("rows")
    first = F.struct(
        F.lit(0).cast("long").alias("at"),
        _rooms(n, shards, slack).alias("rooms"),
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.lit(0).cast("long")).alias("filled"),
        F.array().cast(_PIECE).alias("pieces"),
    )

    def step(state: Column, arc: Column) -> Column:
        stop = F.coalesce(F.get(F.col("upto"), arc), n)
        return F.aggregate(_walk(F.col("ring"), arc), state, lambda s, shard: _cut(arc, stop, s, shard))

    folded = F.aggregate(F.sequence(F.lit(0), F.size("ring")), first, step)["pieces"]
    return ring.where("rows > 0").select(F.inline(folded))


def _places(numbered: DataFrame, shards: int, vnodes: int, slack: float) -> DataFrame:
    """Cells with their pieces of row numbers; at most a row for each cell and each cut."""
    counts = numbered.groupBy(F.col("_cell").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    stops = nodes(numbered.sparkSession, shards, vnodes)
    # Rows of a node's own cell come before it; nodes of one cell follow by shard.
    along = counts.select("cell", F.lit(0).alias("node"), F.lit(None).cast("int").alias("shard"), "n").unionByName(
        stops.select("cell", F.lit(1).alias("node"), "shard", F.lit(0).cast("long").alias("n"))
    )
    order = Window.orderBy("cell", "node", "shard")
    seen = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    along = along.select(
        "*", (F.sum("node").over(seen) - F.col("node")).alias("arc"), F.sum("n").over(seen).alias("upto")
    )
    on_ring = F.array_sort(F.collect_list(F.when(F.col("node") == 1, F.struct("arc", "shard", "upto"))))
    ring = along.agg(on_ring.alias("nodes"), F.sum("n").alias("rows"))
    ring = ring.select(F.col("nodes.shard").alias("ring"), F.col("nodes.upto").alias("upto"), "rows")
    cells = along.where("node = 0").select("cell", "arc", (F.col("upto") - F.col("n")).alias("low"), F.col("upto").alias("high"))
    met = cells.join(_pieces(ring, shards, slack), "arc").where("start < high AND stop > low")
    return met.select(F.col("cell").alias("_cell"), "start", "stop", F.col("shard").alias("_shard"), F.col("slot").alias("_first"))


def assign(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0, keep: tuple[Column, ...] = ()) -> DataFrame:
    """Shard and slot of every row, with its size and the checksum of its text.

    ``slot`` counts the rows of a shard from 0 without a gap.  ``keep`` are further columns of ``docs``.
    """
    if shards < 1 or vnodes < 1 or shards * vnodes > 1 << 16:
        raise ValueError("one shard and one node at least, and not more than 65536 nodes")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    kept = [f"_keep_{i}" for i in range(len(keep))]
    rows = docs.select(
        F.col("doc_id").alias("_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("_size"),
        F.crc32(text).alias("_crc"),
        _position(name).alias("_position"),
        F.monotonically_increasing_id().alias("_row"),
        *[c.alias(n) for c, n in zip(keep, kept, strict=True)],
    ).withColumn("_cell", _cell(F.col("_position")))
    # The row number only spreads equal rows over the ranges.
    numbered = number_rows(rows, ["_position", "_id", "_crc", "_size", "_row"], "_number")
    places = F.broadcast(_places(numbered, shards, vnodes, slack))
    at = F.col("_number") - 1
    placed = numbered.join(places, "_cell").where((at >= F.col("start")) & (at < F.col("stop")))
    names = docs.select(*keep).columns if keep else []
    return placed.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"),
        (F.col("_first") + at - F.col("start")).alias("slot"),
        *[F.col(k).alias(n) for k, n in zip(kept, names, strict=True)],
    )


def digest(assigned: DataFrame) -> DataFrame:
    """The rows with the law they keep: counts at most one apart (``slack`` 0)."""
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
