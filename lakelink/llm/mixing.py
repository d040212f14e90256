"""Mixing sources to target weights by Pfair scheduling, in SQL functions.

Sources are cut into blocks of `block_rows` rows. A source of weight w gets its ith block (from 0) a release time
floor(i / w) and a deadline ceil((i + 1) / w), in slots of one block; among the released blocks the earliest deadline goes
first, ties to the larger weight, then the name. On one processor this meets every deadline, so at any time
a source has had w * t blocks to within less than one. Weights are whole shares of `resolution`; the schedule repeats after
that many slots, so one period is computed on the driver and every block finds its slot by arithmetic.

The schedule holds as long as every source has a block when its turn comes: `in_mix` marks those slots. Then the sources that
have run out leave it, the weights of the others become shares anew and their schedule goes on from that slot, until every block of every
source has one slot, its own, and the slots have no gap. Block order within a source is by hash of the id: a random order that is the same in every run.

Rows: a null source is a source of its own; null ids and repeated rows are kept and ordered by their hash; an
empty table gives an empty result; a source with a target but no rows is an error only if `strict`, and is left out else.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shares(weights: dict[str, float], resolution: int) -> dict[str, int]:
    """Whole shares of resolution, at least 1 each, by largest remainder."""
    total = sum(weights.values())
    exact = {k: max(resolution * w / total, 1e-12) for k, w in weights.items()}
    out = {k: max(1, int(x)) for k, x in exact.items()}
    by_rest = sorted(out, key=lambda k: (-(exact[k] - int(exact[k])), k))
    i = 0
    while sum(out.values()) < resolution:
        out[by_rest[i % len(by_rest)]] += 1
        i += 1
    while sum(out.values()) > resolution:
        out[max(out, key=lambda k: (out[k], k))] -= 1
    return out


def period(share: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, index of its block in the period, slot) of one period, by earliest deadline among released blocks."""
    n = sum(share.values())
    waiting = [(i * n // a, -(-(i + 1) * n // a), -a, s, i) for s, a in share.items() for i in range(a)]
    waiting.sort()
    ready: list[tuple[int, int, str, int]] = []
    out, k = [], 0
    for slot in range(n):
        while k < len(waiting) and waiting[k][0] <= slot:
            _, deadline, a, s, i = waiting[k]
            heapq.heappush(ready, (deadline, a, s, i))
            k += 1
        deadline, _, s, i = heapq.heappop(ready)
        assert slot < deadline, "a deadline was missed"
        out.append((s, i, slot))
    return out


def stretch(share: dict[str, int], left: dict[str, int]) -> tuple[dict[str, list[int]], int]:
    """Slots of each source's blocks in the first period, and the first slot at which a source has no block of `left` when its turn comes."""
    n = sum(share.values())
    slots: dict[str, list[int]] = {s: [] for s in share}
    later = [(0, s) for s in sorted(share)]  # release of the next block
    ready: list[tuple[int, int, str]] = []
    for slot in range(n):
        while later and later[0][0] <= slot:
            _, s = heapq.heappop(later)
            heapq.heappush(ready, (-(-(len(slots[s]) + 1) * n // share[s]), -share[s], s))
        s = heapq.heappop(ready)[2]
        if len(slots[s]) == left[s]:
            return slots, slot
        slots[s].append(slot)
        heapq.heappush(later, (len(slots[s]) * n // share[s], s))
    return slots, min(left[s] // a * n + slots[s][left[s] % a] for s, a in share.items())


def phases(blocks: dict[str, int], target: dict[str, float], resolution: int) -> list[tuple[str, int, int, int, int, int, list[int]]]:
    """(source, first block, block after the last, first slot, period, share, slots in the period) of every phase; a phase ends when a source runs out."""
    out, base, done = [], 0, dict.fromkeys(target, 0)
    while left := {s: blocks[s] - done[s] for s in target if blocks[s] > done[s]}:
        share = shares({s: target[s] for s in left}, max(resolution or max(1000, 50 * len(left)), len(left)))
        n = sum(share.values())
        slots, until = stretch(share, left)
        for s, a in share.items():
            had = until // n * a + bisect_left(slots[s], until % n)
            if had:
                out.append((s, done[s], done[s] + had, base, n, a, slots[s]))
                done[s] += had
        base += until
    return out


def tempered(counts: dict[str, int], temperature: float) -> dict[str, float]:
    """Weights in proportion to count ** temperature: 1 keeps the sizes' shares, 0 makes all equal."""
    return {k: float(n) ** temperature for k, n in counts.items()}


def mix(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", *, temperature: float = 0.5, block_rows: int = 64, resolution: int = 0, rows_per_deal: int = 2000, most_sources: int = 4096, strict: bool = False) -> DataFrame:
    """docs with block (in its source), slot, release, deadline and in_mix.

    weights: target weight by source name (others get none and are left out of the schedule: slot is null); by default
    tempered source sizes. The sources, at most most_sources, come to the driver with their counts.
    resolution: slots of a period; 0 takes 50 a source, 1000 at least.
    """
    new = ["block", "slot", "release", "deadline", "in_mix"]
    clash = set(new) & set(docs.columns)
    if clash:
        raise ValueError(f"docs has columns {sorted(clash)} already")
    spark = docs.sparkSession
    name = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))  # null: the empty name
    counts = {r.s: r.n for r in docs.groupBy(name.alias("s")).agg(F.count("*").alias("n")).limit(most_sources + 1).collect()}
    if len(counts) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    target = tempered(counts, temperature) if weights is None else {f"={k}": w for k, w in weights.items() if w > 0}
    if strict and set(target) - set(counts):
        raise ValueError(f"no rows of {sorted(set(target) - set(counts))}")
    target = {k: w for k, w in target.items() if k in counts}
    plan = phases({k: ceil(v / block_rows) for k, v in counts.items()}, target, resolution)
    # the first phase ends when the first source runs out
    until = next((x[3] for x in plan if x[3] > 0), sum(x[2] - x[1] for x in plan))
    deals = max(1, ceil(max(counts.values(), default=1) / rows_per_deal))
    h = F.xxhash64(F.col(id_col).cast("string"), F.lit(23))
    d = docs.withColumns({"_s": name, "_h": h, "_deal": F.pmod(h, F.lit(deals)).cast("int")})
    sizes = docs.select(name.alias("_s"), F.pmod(h, F.lit(deals)).cast("int").alias("_deal")).groupBy("_s", "_deal").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("_s").orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    d = d.withColumn("_row", F.row_number().over(Window.partitionBy("_s", "_deal").orderBy("_h", F.col(id_col))) - 1)
    d = d.join(before, ["_s", "_deal"]).withColumn("block", F.floor((F.col("_before") + F.col("_row")) / block_rows).cast("long"))
    rows = spark.createDataFrame(plan, "_source string, _first long, _end long, _base long, _period long, _a long, _offsets array<int>")
    block = F.col("block")
    own = (F.col("_s") == F.col("_source")) & (block >= F.col("_first")) & (block < F.col("_end"))
    d = d.join(F.broadcast(rows), own, "left").withColumn("_b", block - F.col("_first"))  # rows: one a source and phase
    out = d.withColumns({
        "slot": F.expr("_base + _b div _a * _period + _offsets[cast(_b % _a as int)]").cast("long"),
        "release": F.expr("_base + _b * _period div _a").cast("long"),
        "deadline": F.expr("_base + ((_b + 1) * _period + _a - 1) div _a").cast("long"),
    })
    return out.withColumn("in_mix", F.coalesce(F.col("slot") < until, F.lit(False))).select(*docs.columns, *new)
