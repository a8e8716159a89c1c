"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of a source, its documents in a seeded order, form one stream that
is cut into equal blocks.  A source wants ``target / block size`` blocks; all
wanted blocks are the seats of a Sainte-Laguë (highest quotients) election,
and the house-monotone election is read off at every output shard's share of
the seats, so each shard gets an integer quota per source.  Which blocks fill
the quotas is a seeded permutation of the source's blocks; beyond one epoch
the permutation starts again.

Only per-source totals reach the driver: one row per source, as many as there
are weights to state.  Documents stay narrow (id, source, size), and a block
is arithmetic on positions, never a row.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faresight.llm.common import bucketed_starts, materialize, word_count

#: Weights of the sources in code-point order, null last, repeating.
CYCLE = (3, 1, 2)
BUDGET_RATIO = 1.5
MAX_EPOCHS = 2
BLOCK_WORDS = 32
OUTPUT_SHARDS = 16
BUCKETS = 1024
SEED = 20

_PLAN = T.StructType([
    T.StructField("_null", T.BooleanType()), T.StructField("_key", T.StringType()),
    T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
    T.StructField("_blocks", T.LongType()), T.StructField("_seats", T.LongType()),
    T.StructField("_quota_ends", T.ArrayType(T.LongType())),
    T.StructField("_mult", T.LongType()), T.StructField("_shift", T.LongType())])


def cyclic_weights(sources: Sequence[str | None]) -> list[float]:
    """3, 1, 2 repeating over ``sources`` as sorted by the caller."""
    return [float(CYCLE[i % len(CYCLE)]) for i in range(len(sources))]


def capped_targets(sizes: Sequence[int], weights: Sequence[float], budget: float,
                   max_epochs: float) -> list[float]:
    """Shares of ``budget`` by weight, none above ``max_epochs`` times its size.

    What is cut off is shared again by weight among those below their limit.
    """
    limits = [max_epochs * s for s in sizes]
    targets = [0.0] * len(sizes)
    open_ = [i for i, w in enumerate(weights) if w > 0]
    left = budget
    while open_:
        total = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / total for i in open_}
        full = [i for i in open_ if share[i] > limits[i]]
        if not full:
            for i in open_:
                targets[i] = share[i]
            break
        for i in full:
            targets[i] = float(limits[i])
            left -= limits[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def sainte_lague(wanted: Sequence[float], limits: Sequence[int], house: int) -> list[int]:
    """``house`` seats by highest quotients wanted / (2 seats + 1), within limits.

    Starts at the rounded shares and corrects seat by seat, so the cost does
    not grow with the house.  Ties go to the earlier entry.
    """
    total = sum(wanted)
    house = min(house, sum(c for w, c in zip(wanted, limits, strict=True) if w > 0))
    if total <= 0 or house <= 0:
        return [0] * len(wanted)
    seats = [min(c, math.floor(w * house / total + 0.5)) for w, c in zip(wanted, limits, strict=True)]
    given = sum(seats)
    if given > house:
        heap = [(w / (2 * s - 1), -i) for i, (w, s) in enumerate(zip(wanted, seats, strict=True)) if s > 0]
        heapq.heapify(heap)
        while given > house:
            _, i = heapq.heappop(heap)
            seats[-i] -= 1
            given -= 1
            if seats[-i] > 0:
                heapq.heappush(heap, (wanted[-i] / (2 * seats[-i] - 1), i))
    heap = [(-w / (2 * s + 1), i) for i, (w, s, c) in enumerate(zip(wanted, seats, limits, strict=True))
            if s < c and w > 0]
    heapq.heapify(heap)
    while given < house and heap:
        _, i = heapq.heappop(heap)
        seats[i] += 1
        given += 1
        if seats[i] < limits[i]:
            heapq.heappush(heap, (-wanted[i] / (2 * seats[i] + 1), i))
    return seats


def _permutation(blocks: int, seed: str) -> tuple[int, int]:
    """Multiplier and shift of a seeded bijection b -> (mult b + shift) mod blocks."""
    rng = random.Random(seed)
    shift = rng.randrange(blocks) if blocks else 0
    while True:
        mult = rng.randrange(1, 1 << 20) | 1
        if math.gcd(mult, max(blocks, 1)) == 1:
            return mult, shift


def plan_mix(totals: Sequence[tuple[str | None, int]], weights: Callable = cyclic_weights,
             budget_ratio: float = BUDGET_RATIO, max_epochs: int = MAX_EPOCHS,
             block_words: int = BLOCK_WORDS, shards: int = OUTPUT_SHARDS, seed: int = SEED) -> list[dict]:
    """Targets, blocks and quotas per shard from (source, words) totals."""
    totals = sorted(totals, key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in totals]
    targets = capped_targets(sizes, weights([s for s, _ in totals]), budget_ratio * sum(sizes), max_epochs)
    blocks = [max(1, round(n / block_words)) if n else 0 for n in sizes]
    wanted = [t * b / n if n else 0.0 for t, b, n in zip(targets, blocks, sizes, strict=True)]
    limits = [max_epochs * b for b in blocks]
    house = round(sum(wanted))
    ends = [sainte_lague(wanted, limits, house * (h + 1) // shards) for h in range(shards)]
    return [{"source": s, "size": n, "target": t, "blocks": b,
             "seats": ends[-1][i], "quota_ends": [e[i] for e in ends],
             "perm": _permutation(b, f"{seed}:{s!r}")}
            for i, ((s, n), t, b) in enumerate(zip(totals, targets, blocks, strict=True))]


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text", weights: Callable = cyclic_weights,
                budget_ratio: float = BUDGET_RATIO, max_epochs: int = MAX_EPOCHS,
                block_words: int = BLOCK_WORDS, shards: int = OUTPUT_SHARDS,
                seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs`` with what the mix takes of it.

    Returns ``id_col, source_col``, the (narrow) columns named in ``carry``,
    and ``size, source_size, target, taken, picks``.
    ``picks`` are the taken spans: (shard, epoch, start, length) in words of the
    document, once per time a block is taken; ``taken`` is their total length,
    at most ``max_epochs * size``.

    Null or blank text: size 0, nothing taken.  Null source: a source of its
    own, last.  Repeated rows are rows of their own.  Sources without words
    have target 0.  An empty table gives an empty result.  Other columns are
    not read, whatever their names.
    """
    narrow = materialize(docs.select(
        *carry, F.col(id_col).alias("_id"), F.col(source_col).isNull().alias("_null"),
        F.coalesce(F.col(source_col), F.lit("")).alias("_key"),
        word_count(F.col(text_col)).alias("size"))
        .withColumn("_order", F.xxhash64(F.col("_id"), F.lit(seed)))
        .withColumn("_bucket", F.pmod("_order", F.lit(BUCKETS)).cast("int")), "mix")
    totals = [(None if r["_null"] else r["_key"], r["n"]) for r in
              narrow.groupBy("_null", "_key").agg(F.sum("size").alias("n")).collect()]
    plan = plan_mix(totals, weights, budget_ratio, max_epochs, block_words, shards, seed)
    rows = [(p["source"] is None, p["source"] or "", p["size"], p["target"], p["blocks"], p["seats"],
             p["quota_ends"], *p["perm"]) for p in plan]
    quotas = docs.sparkSession.createDataFrame(rows, _PLAN)
    placed = bucketed_starts(narrow, ["_null", "_key"], "_bucket",
                             [F.col("_order"), F.col("_id"), F.col("size"), *map(F.col, carry)], "size", "_start")
    return (placed.join(quotas, ["_null", "_key"])
            .withColumn("picks", F.expr(_picks_sql(max_epochs)))
            .select(F.col("_id").alias(id_col),
                    F.when(~F.col("_null"), F.col("_key")).alias(source_col), *carry,
                    "size", "source_size", "target",
                    F.expr("aggregate(picks, 0L, (n, p) -> n + p.length)").alias("taken"), "picks"))


def _picks_sql(max_epochs: int) -> str:
    """Spans of a document at words [_start, _start + size) of its source stream.

    The first ``rem`` blocks have one word more than the others.  Block b is the
    take number epoch * blocks + (mult b + shift) mod blocks, if below the seats;
    a take belongs to the first shard whose quota end lies beyond it.
    """
    base, rem = "(source_size div _blocks)", "(source_size % _blocks)"
    def block(x):
        return (f"IF({x} < {rem} * ({base} + 1), {x} div ({base} + 1), "
                f"{rem} + ({x} - {rem} * ({base} + 1)) div {base})")
    begin = f"(b * {base} + least(b, {rem}))"
    end = f"((b + 1) * {base} + least(b + 1, {rem}))"
    take = "(e * _blocks + (_mult * b + _shift) % _blocks)"
    span = (f"named_struct('shard', size(filter(_quota_ends, q -> q <= {take})), "
            f"'epoch', int(e), 'start', greatest({begin} - _start, 0L), "
            f"'length', least({end}, _start + size) - greatest({begin}, _start))")
    per_block = (f"transform(filter(sequence(0L, {max_epochs - 1}L), e -> {take} < _seats), e -> {span})")
    return (f"IF(size = 0, cast(array() as array<struct<shard:int,epoch:int,start:bigint,length:bigint>>), "
            f"flatten(transform(sequence({block('_start')}, {block('(_start + size - 1)')}), b -> {per_block})))")
