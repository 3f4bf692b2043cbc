"""Interleaving sources at target weights by Pfair scheduling.

A source's documents, in an order by hash, form blocks. Block ``i`` of a source with weight ``w`` may
not come before slot ``floor(i / w)`` and must come before slot ``ceil((i + 1) / w)``; the released
block with the earliest deadline goes first. At every slot each source is then less than one block
away from its share.

Weights are not rounded: they are whole parts of their sum, in integers of any size. When a source has
no blocks left, the others keep their proportions in a new phase; there are at most as many phases as
sources. The driver plans only the end of each phase. Slots are a table: a phase is cut into pieces, and
a task plans a piece from the counts at both its ends. Counts at a cut depend on the cut alone: they are
those reached from the state that is ahead where deadlines are earliest, ``warm_up`` slots before, in
which every source gets a block. A phase shorter than that, with a source of tiny weight, is planned
whole. Nothing is dropped or repeated.

Defined results: a null source is a source of its own; sources without a positive weight come after
all others, in proportion to their blocks; the last block of a source may be short; repeated rows stay;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.shared import free_names, hashed_order, landed

#: ``PERIOD``: slots that a task plans at a time, at least.
PERIOD, BLOCK_ROWS, BUCKETS = 2048, 16, 4096
#: Deadlines beyond the range of a column are given as its end.
FARTHEST = (1 << 63) - 1
SLOT_ROWS = 65_536


def whole_parts(weights: Mapping[str, float]) -> dict[str, int]:
    """The weights, in the same proportions, as whole numbers."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * scale) for s, x in exact.items()}


def warm_up(parts: list[int]) -> int:
    """Slots in which every source gets a block."""
    return -(-sum(parts) // min(parts))


def earliest_deadline_first(
    parts: list[int], done: list[int], start: int, stop: int | None = None, until: list[int] | None = None
) -> Iterator[tuple[int, int, int]]:
    """(slot, source, block) from slot ``start`` on, where sources have had ``done`` blocks."""
    total = sum(parts)
    waiting = [(i * total // n, s, i) for s, (n, i) in enumerate(zip(parts, done, strict=True))]
    if until:
        waiting = [x for x in waiting if x[2] < until[x[1]]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    slot = start
    while stop is None or slot < stop:
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // parts[s]), s, i))
        _, s, i = heapq.heappop(ready)
        yield slot, s, i
        if not until or i + 1 < until[s]:
            heapq.heappush(waiting, ((i + 1) * total // parts[s], s, i + 1))
        slot += 1


def early_state(parts: list[int], slot: int) -> list[int]:
    """Blocks before a slot: shares rounded up where the pending deadline is earliest, else down."""
    total = sum(parts)
    done = [n * slot // total for n in parts]
    pending = [s for s, n in enumerate(parts) if n * slot % total]
    pending.sort(key=lambda s: (-(-(done[s] + 1) * total // parts[s]), s))
    for s in pending[: slot - sum(done)]:
        done[s] += 1
    return done


def state_at(parts: list[int], slot: int) -> list[int]:
    """Blocks before a slot, the same from whichever piece they are asked."""
    start = max(0, slot - warm_up(parts))
    done = early_state(parts, start)
    for _, s, _ in earliest_deadline_first(parts, list(done), start, slot):
        done[s] += 1
    return done


def piece_slots(
    parts: list[int], length: int, ends: list[int], piece: int, number: int
) -> Iterator[tuple[int, int, int]]:
    """(slot, source, block) of a piece of a phase; the last piece takes what is left."""
    last = number + 1 == max(1, length // piece)
    start, stop = number * piece, length if last else (number + 1) * piece
    until = ends if last else state_at(parts, stop)
    return earliest_deadline_first(parts, state_at(parts, start), start, stop, until)


@dataclass(frozen=True)
class Phase:
    """From ``start`` on, source ``s`` gets ``parts[s]`` of every ``period`` slots, which is not less
    than the phase; ``piece`` slots are planned at a time."""

    start: int
    period: int
    parts: dict[str, int]
    first_block: dict[str, int]
    last_block: dict[str, int]
    end: int
    piece: int

    @property
    def pieces(self) -> int:
        return max(1, (self.end - self.start) // self.piece)

    @property
    def slots(self) -> dict[str, list[int]]:
        """Slots of the phase for every source."""
        names, found = list(self.parts), {s: [] for s in self.parts}
        ends = [self.last_block[s] - self.first_block[s] for s in names]
        for number in range(self.pieces):
            planned = piece_slots(list(self.parts.values()), self.end - self.start, ends, self.piece, number)
            for slot, s, _ in planned:
                found[names[s]].append(slot)
        return found


def plan_phases(blocks: Mapping[str, int], weights: Mapping[str, float], period: int) -> list[Phase]:
    """Phases until all blocks have a slot; pieces have at least ``period`` slots."""
    phases, start, first = [], 0, dict.fromkeys(blocks, 0)
    while left := {s: n - first[s] for s, n in sorted(blocks.items()) if n > first[s]}:
        whole = whole_parts({s: weights[s] for s in left if weights.get(s, 0) > 0} or left)
        names, parts = list(whole), list(whole.values())
        total, warm = sum(parts), warm_up(parts)
        # The phase ends with the last block of the source that is first to run out: simulate its tail.
        near = min(left[s] * total // n for s, n in whole.items())
        slot = max(0, near - 2 * warm - 2)
        done = state_at(parts, slot)
        for slot, s, i in earliest_deadline_first(parts, list(done), slot):
            done[s] += 1
            if i + 1 == left[names[s]]:
                break
        length = slot + 1
        last = {s: first[s] + n for s, n in zip(names, done, strict=True)}
        scale = -(-length // total)
        scaled = {s: n * scale for s, n in whole.items()}
        own = {s: first[s] for s in names}
        phases.append(
            Phase(start, total * scale, scaled, own, last, start + length, max(period, 4 * warm))
        )
        first.update(last)
        start += length
    return phases


def slot_table(spark: SparkSession, phases: list[Phase]) -> DataFrame:
    """A row per block: ``_s`` (source), ``_block``, ``_release``, ``_deadline`` and ``_slot``."""
    kinds = "start long, length long, piece long, pieces long, names array<string>, parts array<string>"
    rows = [
        (p.start, p.end - p.start, p.piece, p.pieces, list(p.parts), [str(n) for n in p.parts.values()],
         list(p.first_block.values()), list(p.last_block.values()))
        for p in phases
    ]
    planned = spark.createDataFrame(rows, f"{kinds}, first array<long>, last array<long>")
    tasks = min(max(1, sum(p.pieces for p in phases)), 4 * spark.sparkContext.defaultParallelism)
    pieces = planned.withColumn("number", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    schema = pa.schema([("_s", pa.string())] + [
        (n, pa.int64()) for n in ("_block", "_release", "_deadline", "_slot")
    ])

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            parts, found = [int(n) for n in row["parts"]], []
            total, begin = sum(parts), row["start"]
            ends = [n - m for n, m in zip(row["last"], row["first"], strict=True)]
            for slot, s, i in piece_slots(parts, row["length"], ends, row["piece"], row["number"]):
                deadline = min(FARTHEST, begin - (-(i + 1) * total // parts[s]))
                release = begin + i * total // parts[s]
                found.append((row["names"][s], row["first"][s] + i, release, deadline, begin + slot))
                if len(found) == SLOT_ROWS:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*found))), schema=schema)
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*found))), schema=schema)

    return pieces.repartition(tasks).mapInArrow(
        plan, "_s string, _block long, _release long, _deadline long, _slot long"
    )


def _source_key(source: str) -> Column:
    return F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source)))


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    evenness: float = 0.5,
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
    id_col: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """All rows and columns, and ``block`` (number within its source), ``release``, ``deadline``,
    ``slot`` and ``row_in_block``; by (slot, row_in_block) the rows are in mixed order.

    ``weights`` are the targets per source; without them a source with ``n`` rows gets the weight
    ``n ** (1 - evenness)``: 0 keeps natural shares, 1 gives all sources the same. Added columns get a
    leading underscore where names clash.
    """
    spark = docs.sparkSession
    added = ("block", "release", "deadline", "slot", "row_in_block")
    inner = ("key", "bucket", "order", "before", "rank")
    planned = ("of_source", "of_block", "at_release", "at_deadline", "at_slot")
    free = free_names(docs.columns, *added, *inner, *planned)
    names = dict(zip(added, free, strict=False))
    key, bucket, order, before_, rank = free[5:10]
    of_source, of_block, at_release, at_deadline, at_slot = free[10:]
    keyed = docs.withColumns({key: _source_key(source), order: hashed_order(id_col)})
    keyed = keyed.withColumn(bucket, F.pmod(order, F.lit(BUCKETS)).cast("int"))

    sizes = {r[0]: r["count"] for r in keyed.groupBy(key).count().collect()}  # a row per source
    if weights is None:
        target = {s: n ** (1 - evenness) for s, n in sizes.items()}
    else:
        target = {"" if s is None else f"={s}": w for s, w in weights.items()}
    phases = plan_phases({s: -(-n // block_rows) for s, n in sizes.items()}, target, period)

    # Rank within the source: rows in earlier buckets, then rows of the own bucket.
    by_source = Window.partitionBy(key).orderBy(bucket)
    before = (
        keyed.groupBy(key, bucket)
        .count()
        .select(key, bucket, (F.sum("count").over(by_source) - F.col("count")).alias(before_))
    )
    within = Window.partitionBy(key, bucket).orderBy(order, id_col)
    ranked = keyed.withColumn(rank, F.row_number().over(within) - 1).join(before, [key, bucket])
    ranked = ranked.withColumn(rank, F.col(rank) + F.col(before_)).withColumns({
        names["block"]: F.floor(F.col(rank) / block_rows),
        names["row_in_block"]: F.pmod(rank, F.lit(block_rows)).cast("int"),
    })

    # Written once, so that its size is known: a small table is sent to every task, a large one joined.
    places = landed(slot_table(spark, phases), "slots").toDF(*free[10:])
    at_place = (F.col(key) == F.col(of_source)) & (F.col(names["block"]) == F.col(of_block))
    return ranked.join(places, at_place).select(
        *docs.columns,
        names["block"],
        F.col(at_release).alias(names["release"]),
        F.col(at_deadline).alias(names["deadline"]),
        F.col(at_slot).alias(names["slot"]),
        names["row_in_block"],
    )


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The documents, ordered across and within partitions by their mixed position."""
    slot, row = free_names(docs.columns, "block", "release", "deadline", "slot", "row_in_block")[3:]
    return mix(docs, **options).orderBy(slot, row).select(*docs.columns)


def with_position(docs: DataFrame, name: str, block_rows: int = BLOCK_ROWS, **options) -> DataFrame:
    """The documents with their mixed position; positions ascend with gaps after short blocks."""
    slot, row = free_names(docs.columns, "block", "release", "deadline", "slot", "row_in_block")[3:]
    position = F.col(slot) * block_rows + F.col(row)
    return mix(docs, block_rows=block_rows, **options).select(*docs.columns, position.alias(name))


def digest(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "source"))
