"""Mixing sources to target weights by Pfair scheduling.

Documents of a source are cut into blocks. Block j (from 1) of a source of weight w is released at floor((j-1)/w) and
due at ceil(j/w); in each slot the released block with the earliest deadline goes, so after any number of slots every
source is less than one block from its target. Weights are exact fractions, brought to whole numbers without rounding:
the schedule repeats after their sum, and what is computed of it ends with the period, or with the first source that
runs out if that comes first. Then the others go on in their own proportion: no document is dropped or repeated."""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from ._common import materialize

#: Documents of a block, and rows that one bucket of a source should hold when its documents are numbered.
BLOCK = 64
BUCKET = 5_000
NO_SOURCE = "\0none"
#: Sources are a short vocabulary: their counts are gathered.
MOST_SOURCES = 2_000
#: Most numbers in the schedule (slots that are computed, and rows of sources and phases), which is broadcast: 64 MB.
MOST_NUMBERS = 4_000_000
#: Columns beside those returned that spread rows without an id over the buckets of their source.
APART = ("lang", "n_chars")
OWN = ("block", "slot", "position")
#: Target weights of the query and of the pipeline; all other sources weigh 1.
WEIGHTS = {"src0": 12, "src1": 7, "src2": 5, "src3": 3, "src4": "2.5", "src5": "0.5"}


@dataclass(frozen=True)
class Phase:
    """Slots start..end-1. orders[source]: slots of its blocks within a period; first: its blocks before the phase."""

    start: int
    end: int
    period: int
    orders: dict[str, list[int]]
    first: dict[str, int]


def earliest_deadline_first(weights: dict[str, int], blocks: dict[str, int] | None = None, most: int | None = None) -> list[str]:
    """The source of each slot, for one period or until a source has gone ``blocks`` times. Ties go to the first name, so
    that the result is fixed. The state is one entry for each source."""
    total = sum(weights.values())
    waiting, ready, out = [(0, s, 1) for s in sorted(weights)], [], []
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * total // weights[s]), s, j))
        deadline, s, j = heapq.heappop(ready)
        if deadline < t + 1:
            raise AssertionError("a deadline was missed")
        out.append(s)
        if most is not None and len(out) > most:
            raise ValueError(f"a schedule of these weights has more than {MOST_NUMBERS} numbers: give weights with a smaller common denominator")
        if blocks is not None and j == blocks[s]:
            break
        if j < weights[s]:
            heapq.heappush(waiting, (j * total // weights[s], s, j + 1))
    return out


def whole_weights(weights: dict) -> dict[str, int]:
    """The smallest whole numbers in exactly the proportion of the weights: whole numbers, fractions, decimals as text, or
    floats, which are read as the decimal that they print as."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights must be positive")
    denominator = lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * denominator) for s, w in exact.items()}
    return {s: w // gcd(*whole.values()) for s, w in whole.items()}


def plan(blocks: dict[str, int], weights: dict[str, int]) -> list[Phase]:
    """The phases for sources with so many blocks, at most one for each source."""
    left, first = {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0)
    phases, at, numbers = [], 0, 0
    while left:
        whole = whole_weights({s: weights[s] for s in left})
        order = earliest_deadline_first(whole, left, MOST_NUMBERS - numbers)
        period = len(order)
        numbers += period + len(left)
        slots: dict[str, list[int]] = {s: [] for s in left}
        for i, s in enumerate(order):
            slots[s].append(i)
        # the first slot after some source's last block
        ends = {s: (left[s] - 1) // n * period + slots[s][(left[s] - 1) % n] + 1 for s in left if (n := len(slots[s]))}
        length = min(ends.values())
        phases.append(Phase(at, at + length, period, {s: x for s, x in slots.items() if x}, dict(first)))
        for s in list(left):
            done = length // period * len(slots[s]) + sum(x < length % period for x in slots[s])
            left[s] -= done
            first[s] += done
            if not left[s]:
                del left[s]
        at += length
    return phases


def numbered(docs: DataFrame, carried: list[str], bucket_rows: int = BUCKET) -> tuple[DataFrame, dict[str, int]]:
    """Rows with a place 0.. within their source, in the order of hashed ids; and the rows of each source.

    A source is cut into buckets by hash, as many as its size asks for, so that no task sorts a whole hot source; the
    counts of buckets are the only thing that is gathered, one number for each bucket."""
    source = F.coalesce(F.col("source"), F.lit(NO_SOURCE))
    told = F.xxhash64(F.lit(9), *[F.col(f"`{c}`") for c in docs.columns if c in carried or c in APART])
    place = F.when(F.col("doc_id").isNull(), told).otherwise(F.xxhash64(F.col("doc_id"), F.lit(9)))
    keyed = docs.select("doc_id", source.alias("source"), place.alias("place"), told.alias("told"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c in carried]).alias("row"))
    sizes = {r["source"]: r["n"] for r in keyed.groupBy("source").agg(F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()}
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    spark = docs.sparkSession
    cut = spark.createDataFrame([(s, -(-n // bucket_rows)) for s, n in sizes.items()], "source string, cuts int")
    bucket = F.least(F.floor((F.shiftrightunsigned("place", 11) / F.lit(float(1 << 53))) * F.col("cuts")).cast("int"), F.col("cuts") - 1)
    spread = keyed.join(F.broadcast(cut), "source").withColumn("bucket", bucket)  # a row per source
    counts = spread.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.Window.partitionBy("source").orderBy("bucket").rowsBetween(W.Window.unboundedPreceding, -1))
    starts = materialize(counts.select("source", "bucket", F.coalesce(before, F.lit(0)).alias("start")), "bucket-starts")
    rank = F.row_number().over(W.Window.partitionBy("source", "bucket").orderBy(F.shiftrightunsigned("place", 11), "place", F.col("doc_id").asc_nulls_first(), "told"))
    ranked = spread.withColumn("rank", rank).join(starts, ["source", "bucket"])
    return ranked.select("row", "source", (F.col("start") + F.col("rank") - 1).alias("place")), sizes


def mix(docs: DataFrame, weights: dict | None = None, block: int = BLOCK, bucket_rows: int = BUCKET, columns: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """One row per document: its ``columns``, block (within the source, from 0), slot of the block, and position, the
    document's place in the mixture (0.. in order of slot, then of place within the block).

    weights: target weight by source (see ``whole_weights``); a source that is missing there, or all if it is None, weighs
    1. The last block of a source may be short; positions leave gaps behind it. A null source is a source of its own; rows
    without an id are spread by their other columns; rows that tie in all ``columns`` are told apart by nothing, and get a
    place each; other columns are ignored, as are those named block, slot or position; an empty table gives an empty
    result. Weights whose schedule would exceed MOST_NUMBERS, and more than MOST_SOURCES sources, are errors."""
    spark = docs.sparkSession
    carried = [c for c in docs.columns if c in columns and c not in OWN]
    rows, sizes = numbered(docs, carried, bucket_rows)
    given = {s: (weights or {}).get(None if s == NO_SOURCE else s, 1) for s in sizes}
    phases = plan({s: -(-n // block) for s, n in sizes.items()}, whole_weights(given)) if sizes else []
    table = []
    for s in sizes:
        for ph in phases:
            if s in ph.orders:
                following = next((q.first[s] for q in phases if q.start >= ph.end), -(-sizes[s] // block))
                table.append((s, ph.first[s], following, ph.start, ph.period, ph.orders[s]))
    schema = T.StructType([T.StructField("source", T.StringType()), *[T.StructField(k, T.LongType()) for k in ("first", "stop", "start", "period")], T.StructField("slots", T.ArrayType(T.IntegerType()))])
    # MOST_NUMBERS bounds its rows and slots
    schedule = F.broadcast(spark.createDataFrame(table, schema))
    blocked = rows.withColumn("block", F.floor(F.col("place") / block)).alias("r")
    joined = blocked.join(schedule.alias("s"), (F.col("r.source") == F.col("s.source")) & (F.col("block") >= F.col("first")) & (F.col("block") < F.col("stop")))
    j, n = F.col("block") - F.col("first"), F.size("slots")
    slot = F.col("start") + F.floor(j / n) * F.col("period") + F.get("slots", F.pmod(j, n).cast("int"))
    return joined.select(*[F.col("row").getField(c).alias(c) for c in carried], "block", slot.alias("slot"), (slot * block + F.pmod(F.col("place"), F.lit(block))).alias("position"))
