"""Mixing sources to target weights in equal-token blocks.

The tokens of each source, shard after shard and in seeded order within a
shard, are cut into blocks of equal length.  Blocks are apportioned among the
sources by Sainte-Laguë's highest quotients, then each source's blocks among
its shards, which gives every shard an integer quota; the shard takes its
quota as a seeded run of its blocks, going round as often as the quota asks.
"""

from __future__ import annotations

import math
from itertools import cycle

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
#: The mix's size against that of all sources, and the most copies of a source.
SHARE, MOST = 1.5, 2
BLOCK_TOKENS = 64
#: So many sources' numbers of shards are broadcast at most.
BROADCAST_SOURCES = 100_000


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Each source's share of ``share`` times all sizes by weight, at most ``most`` times its own size.

    What a source cannot take is shared out again by weight: each gets its
    weight times one level, or its bound, whichever is less.
    """
    left, rest = share * sum(sizes), sum(weights)
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    for n, i in enumerate(order):
        if most * sizes[i] * rest > weights[i] * left:
            for j in order[n:]:
                out[j] = weights[j] * left / rest
            break
        out[i] = float(most * sizes[i])
        left, rest = left - out[i], rest - weights[i]
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients votes / (2 seats + 1), none above ``most``; of equals the first.

    Seats that a common divisor already gives are set at once, the remaining
    ones one by one, so the cost does not grow with the number of seats.
    """
    votes, most = np.asarray(votes, np.float64), np.asarray(most, np.int64)
    seats = int(min(seats, most[votes > 0].sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)
    given = lambda d: np.minimum(np.floor(votes / d + 0.5), most).astype(np.int64)
    low, high = 0.0, 2.0 * votes.max() + 1
    for _ in range(200):
        middle = (low + high) / 2
        if given(middle).sum() > seats:
            low = middle
        else:
            high = middle
    out = given(high)
    for _ in range(seats - int(out.sum())):
        quotients = np.where((out < most) & (votes > 0), votes / (2 * out + 1), -1.0)
        out[int(np.argmax(quotients))] += 1
    return out


def plan_units(units: list[tuple[str | None, int, int]], seed: int, block: int = BLOCK_TOKENS, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> list[tuple]:
    """Quotas of every ``(source, shard, tokens)``.

    Returns ``(source, shard, source_size, target, start, first, base, run_start,
    run_end, wrap_end, carry)``: the place of the shard's tokens and of its
    first block in the source, how often all its blocks are taken, the run of
    those taken once more, its part beyond the shard's end gone round to the
    start, and how often the block is taken that reaches in from before.
    """
    sources = sorted({u[0] for u in units}, key=lambda s: (s is None, s or ""))
    held: dict = {s: [] for s in sources}
    for s, shard, n in units:
        held[s].append((shard, n))
    sizes = {s: sum(n for _, n in held[s]) for s in sources}
    wanted = targets([sizes[s] for s in sources], [w for w, _ in zip(cycle(weights), sources, strict=False)], share, most)
    blocks = np.array([-(-sizes[s] // block) for s in sources], np.int64)
    seats = sainte_lague(np.array(wanted), int(sum(wanted) / block + 0.5), most * blocks)
    random, out = np.random.default_rng(seed), []
    for s, target, quota in zip(sources, wanted, seats, strict=True):
        shards = sorted(held[s])
        tokens = np.array([n for _, n in shards], np.int64)
        ends = np.cumsum(tokens)
        starts = ends - tokens
        first, after = -(-starts // block), -(-ends // block)
        count = after - first
        quotas = sainte_lague(count, int(quota), most * count)
        carry = 0
        for i, (shard, _) in enumerate(shards):
            n, q = int(count[i]), int(quotas[i])
            base, rest = divmod(q, n) if n else (0, 0)
            turn = int(random.integers(n)) if n else 0
            f = int(first[i])
            out.append((s, int(shard), sizes[s], float(target), int(starts[i]), f * block, base, (f + turn) * block, (f + min(turn + rest, n)) * block, (f + max(0, turn + rest - n)) * block, carry))
            if n:
                carry = base + int((n - 1 - turn) % n < rest)
    return out


_UNIT = "source string, shard bigint, source_size bigint, target double, start bigint, first bigint, base bigint, run_start bigint, run_end bigint, wrap_end bigint, carry bigint"


def _key(source: str | Column) -> list[Column]:
    source = F.col(source) if isinstance(source, str) else source
    return [F.coalesce(source.cast("string"), F.lit("")).alias("mix_key"), source.isNull().alias("mix_none")]


def _mixed(df: DataFrame, id_col: str, source_col: str, size: Column, seed: int, block: int) -> DataFrame:
    """``(row, size, source_size, target, taken)``; ``row`` holds all columns of ``df``, so no name can clash."""
    spark = df.sparkSession
    # The turn is of the whole row, so that rows of one id, or of none, are ordered and spread as others are.
    told = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("id"), size.alias("size"), *_key(source_col), F.xxhash64(F.lit(seed), *told).alias("turn"))
    # A source has shards in proportion to its rows, so that there are about the root of all rows in all.
    held = rows.groupBy("mix_key", "mix_none").agg(F.count("*").alias("n")).collect()
    every = sum(r.n for r in held)
    counts = spark.createDataFrame([(r.mix_key, r.mix_none, max(1, r.n * math.isqrt(every) // every)) for r in held], "mix_key string, mix_none boolean, shards bigint")
    rows = rows.join(F.broadcast(counts) if len(held) <= BROADCAST_SOURCES else counts, ["mix_key", "mix_none"]).withColumn("shard", F.pmod("turn", "shards"))
    unit = ["mix_key", "mix_none", "shard"]
    units = rows.groupBy(*unit).agg(F.sum("size")).collect()
    plan = plan_units([(None if none else key, shard, n or 0) for key, none, shard, n in units], seed, block)
    fields = ("source_size", "target", "start", "first", "base", "run_start", "run_end", "wrap_end", "carry")
    table = spark.createDataFrame(plan, _UNIT).select(*_key("source"), "shard", *fields)
    before = Window.partitionBy(*unit).orderBy("turn", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0))).join(table, unit)
    x0 = F.col("start") + F.col("at")
    x1 = x0 + F.col("size")

    def overlap(low: Column | str, high: Column | str) -> Column:
        low, high = (F.col(c) if isinstance(c, str) else c for c in (low, high))
        return F.greatest(F.lit(0), F.least(x1, high) - F.greatest(x0, low))

    taken = F.col("carry") * overlap("start", "first") + F.col("base") * overlap("first", x1) + overlap("run_start", "run_end") + overlap("first", "wrap_end")
    return joined.select("row", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", seed: int = 8, block: int = BLOCK_TOKENS) -> DataFrame:
    """All rows of ``df`` with ``source_size``, ``target`` and ``taken``.

    ``size_col`` is the tokens of a row.  A source has shards in proportion to
    its rows, about the square root of all rows in all sources together, so
    both the quota table on the driver (a row for each shard) and the rows of a
    shard grow as that root.  Null sources
    are a source of their own, after all others; rows of no tokens take none;
    repeated rows are rows like any other.  The same table gives the same mix
    however it is partitioned.  Columns of ``df`` that have names of the result
    are replaced.
    """
    names = [c for c in df.columns if c not in ("source_size", "target", "taken")]
    mixed = _mixed(df, id_col, source_col, F.coalesce(F.col(size_col).cast("long"), F.lit(0)), seed, block)
    return mixed.select(*[F.col("row").getField(c).alias(c) for c in names], "source_size", "target", "taken")


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 8) -> DataFrame:
    """The documents of the mix, each as often as it is taken, to the nearest whole copy.

    Null texts have no tokens and are not taken.
    """
    from .common import word_count

    mixed = _mixed(df, id_col, source_col, word_count(text_col), seed, BLOCK_TOKENS).where("size > 0")
    copies = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))).cast("int")
    return mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))).select(*[F.col("row").getField(c).alias(c) for c in df.columns])
