"""Mixing sources to target weights (operator 5): Pfair scheduling.

Every source's rows, in a keyed random order, are cut into blocks of ``block_rows``.  Block j
(from 1) of a source with weight w is released at slot floor((j - 1) / w) and due at slot
ceil(j / w); one block is served per slot, always the released one with the earliest deadline,
ties by the Pfair successor bit, then the group deadline, then the name.  The weights sum to 1, so
every block meets its window, and after any number t of slots each source has had more than t*w - 1 and
less than t*w + 1 blocks.

The weights are the exact target fractions, whole numbers a over their sum, for the whole length of the
schedule: none is rounded to slots of a period.  The driver serves the blocks one after the other, a number of
steps that is the rows divided by ``block_rows``, keeps one entry per source and writes the slots in runs of
``CHUNK`` blocks; every row's slot follows by a join on its source and block.  No row passes through the driver
or one task.  Rows are numbered inside their source by a range partitioning on (source, hash) with per-partition
counts, so a source with a third of the rows spreads over many tasks.

Every row is scheduled.  ``on_target`` marks the slots before any source has run out, in which
the weights hold; afterwards the slots of exhausted sources fall idle and the others keep
their order.  A source's last block may be short.

Defined results: a null source is a source of its own; null ids and texts are rows like others;
repeated rows are scheduled each; sources without a weight raise an error, weights of absent sources are
ignored in full; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from itertools import islice

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.tables import BROADCAST_BYTES, saved

PERIOD = 1000
BLOCK_ROWS = 64
#: Blocks whose slots the driver holds at a time.
CHUNK = 1 << 18


def shares(targets: dict, period: int = PERIOD) -> dict:
    """Whole slots per period for positive target weights, by largest remainder, one at least each."""
    period = max(period, 2 * len(targets))
    total = sum(Fraction(w) for w in targets.values())
    exact = {s: Fraction(w) * period / total for s, w in targets.items()}
    got = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(targets, key=lambda s: (got[s] - exact[s], str(s)))
    while sum(got.values()) != period:
        step = 1 if sum(got.values()) < period else -1
        for s in order[::step]:
            if sum(got.values()) == period:
                break
            if got[s] + step >= 1:
                got[s] += step
    return got


def whole(targets: dict) -> dict:
    """Positive weights as whole numbers in exactly the same proportions."""
    exact = {s: Fraction(w) for s, w in targets.items()}
    over = math.lcm(*(w.denominator for w in exact.values()))
    out = {s: int(w * over) for s, w in exact.items()}
    least = math.gcd(*out.values())
    return {s: a // least for s, a in out.items()}


def schedule(weights: dict, blocks: dict) -> Iterator[tuple]:
    """(source, j, release, deadline, slot) of ``blocks`` blocks of each source, by earliest deadline first; ``weights``: whole numbers."""
    period = sum(weights.values())

    def window(a: int, j: int) -> tuple[int, int]:
        return (j - 1) * period // a, -(-j * period // a)

    def group_deadline(a: int, j: int) -> int:
        """End of the run of blocks that a late choice would force, for heavy sources (weight of a half or more)."""
        if 2 * a < period or a == period:
            return 0
        return -(-(-(-window(a, j)[1] * (period - a) // period)) * period // (period - a))

    ready, waiting, t = [], [(0, str(s), s, 1) for s in weights if blocks[s]], 0
    heapq.heapify(waiting)
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])  # slots in which all sources left must wait stay idle
        while waiting and waiting[0][0] <= t:
            _, name, s, j = heapq.heappop(waiting)
            r, d = window(weights[s], j)
            overlaps = j * period % weights[s] != 0
            heapq.heappush(ready, (d, not overlaps, -group_deadline(weights[s], j), name, s, j, r))
        d, _, _, name, s, j, r = heapq.heappop(ready)
        yield s, j, r, d, t
        if j < blocks[s]:
            heapq.heappush(waiting, (window(weights[s], j + 1)[0], name, s, j + 1))
        t += 1


def pattern(slots: dict) -> list[tuple]:
    """The schedule of one period: as many blocks of each source as it has slots."""
    return list(schedule(slots, slots))


def numbered(docs: DataFrame, source: str, id_col: str, seed: int) -> tuple[DataFrame, dict]:
    """Rows by source (one entry per source), and the rows as _row, with _source (text, null as a source of its own) and _n, the row's number from 0 in its source."""
    src = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))
    rows = docs.select(src.alias("_source"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.xxhash64(F.lit(seed), F.col(id_col), F.col(source)).alias("_k"), F.monotonically_increasing_id().alias("_tie"))
    width = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(width, "_source", "_k", "_tie").sortWithinPartitions("_source", "_k", "_tie")
    # Ids rise by one inside a partition: less the smallest of (partition, source) they number its rows without another exchange.
    part = saved(ordered.withColumn("_id", F.monotonically_increasing_id()).drop("_k", "_tie").withColumn("_pid", F.shiftright("_id", 33)), "ordered")
    # Fewer than partitions + sources rows, as the order is by source.
    counts = saved(part.groupBy("_source", "_pid").agg(F.count(F.lit(1)).alias("c"), F.min("_id").alias("_first")), "counts")
    sizes = {r["_source"]: r["n"] for r in counts.groupBy("_source").agg(F.sum("c").alias("n")).collect()}
    before = F.sum("c").over(Window.partitionBy("_source").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_source", "_pid", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_off"))
    return part.join(F.broadcast(offsets), ["_source", "_pid"]).select("_row", "_source", (F.col("_off") + F.col("_id")).alias("_n")), sizes


def natural_targets(sizes: dict, power: float = 0.5) -> dict:
    """Weights by size to a power: below 1 small sources gain against large ones."""
    return {s: Fraction(n ** power) for s, n in sizes.items()}


def mix(docs: DataFrame, targets: dict | None = None, source: str = "source", id_col: str = "doc_id", block_rows: int = BLOCK_ROWS,
        power: float = 0.5, seed: int = 1) -> DataFrame:
    """The columns of ``docs`` and mix_source, mix_block, mix_release, mix_deadline, mix_slot, mix_place, on_target.

    ``mix_slot`` then ``mix_place`` (place in the block) order the mix.  ``targets``: weight by source
    name (None: sizes to ``power``)."""
    spark = docs.sparkSession
    rows, sizes = numbered(docs, source, id_col, seed)
    cols = [F.col("_row").getField(c).alias(c) for c in docs.columns]
    if targets is None:
        named = natural_targets(sizes, power)
    else:
        given = {"null" if s is None else f"={s}": w for s, w in targets.items()}
        if missing := sorted(set(sizes) - set(given)):
            raise ValueError(f"no target weight for {missing}")
        named = {s: given[s] for s in sizes}
    weights = whole(named) if named else {}
    # One block more than the full ones: a short last block, or the idle slot where the source lacks a block.
    blocks = {s: sizes[s] // block_rows + 1 for s in weights}
    horizon, tables = None, []
    plan = schedule(weights, blocks)
    while not tables or chunk:
        chunk = list(islice(plan, CHUNK))
        if chunk or not tables:
            tables.append(saved(spark.createDataFrame([(s, j - 1, r, d, t) for s, j, r, d, t in chunk], "_source string, _b long, _r long, _d long, _t long"), "slots"))
        if horizon is None:  # the first idle slot: where the first source lacks a full block
            horizon = next((t for s, j, _, _, t in chunk if j == blocks[s]), None)
    table = reduce(DataFrame.unionByName, tables)
    if sum(blocks.values()) * 48 < BROADCAST_BYTES:
        table = F.broadcast(table)
    out = rows.withColumn("_b", F.floor(F.col("_n") / F.lit(block_rows)).cast("long")).join(table, ["_source", "_b"])
    name = F.when(F.col("_source") == "null", F.lit(None)).otherwise(F.substring("_source", 2, 2**31 - 1))
    return out.select(*cols, name.alias("mix_source"), F.col("_b").alias("mix_block"), F.col("_r").alias("mix_release"),
                      F.col("_d").alias("mix_deadline"), F.col("_t").alias("mix_slot"),
                      F.pmod(F.col("_n"), F.lit(block_rows)).cast("long").alias("mix_place"), (F.col("_t") < F.lit(horizon or 0)).alias("on_target"))
