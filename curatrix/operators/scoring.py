"""Multi-dimensional scores, top-k and diversity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import complexity, quality
from ..functions.vectors import cosine_distance, doubles, euclidean
from .order import numbered

WEIGHTS = {"complexity": 0.3, "quality": 0.5, "diversity": 0.2}
NEUTRAL = 5.0


def normalised(weights: dict[str, float]) -> dict[str, float]:
    total = sum(weights.values())
    return {k: v / total for k, v in weights.items()} if total > 0 else dict(weights)


def combined(weights: dict[str, float] = WEIGHTS) -> Column:
    w = normalised(weights)
    return F.col("complexity") * w["complexity"] + F.col("quality") * w["quality"] + F.col("diversity") * w["diversity"]


def score(df: DataFrame, weights: dict[str, float] = WEIGHTS, diversity: Column | None = None) -> DataFrame:
    """``complexity``, ``quality``, ``diversity`` (neutral unless given) and ``combined``."""
    df = df.withColumns({"complexity": complexity("question").cast("double"), "quality": quality("question", "answer").cast("double"), "diversity": diversity if diversity is not None else F.lit(NEUTRAL)})
    return df.withColumn("combined", combined(weights))


def top_k(df: DataFrame, k: int, by: str = "combined", order: str = "idx") -> DataFrame:
    """The ``k`` greatest by a dimension, of equals the first; a bounded heap per task."""
    if by not in ("combined", "complexity", "quality", "diversity"):
        raise ValueError(f"unknown strategy: {by}")
    return df.orderBy(F.desc(by), order).limit(k)


def score_at_least(df: DataFrame, least: float) -> DataFrame:
    return df.where(F.col("combined") >= least)


def score_summary(df: DataFrame) -> DataFrame:
    """Least, mean and greatest of each dimension, a row each."""
    names = ("complexity", "quality", "diversity", "combined")
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    return df.select(F.expr(f"stack(4, {pairs}) as (dimension, value)")).groupBy("dimension").agg(F.min("value").alias("least"), F.avg("value").alias("mean"), F.max("value").alias("greatest"))


#: Rows of smaller norm are compared with all others; the distances of the rest differ from those of unit vectors by less than the slack.
SMALL_NORM, SLACK = 1e-2, 5e-4


def _blocks(df: DataFrame, vector: str, order: str, block: int, pivots: int) -> tuple[DataFrame, int]:
    """Blocks of rows that are near each other: ``(block, center, radius, low, high, worst, rows)``; and how far apart numbers of blocks are in a bundle of a hundred or so.

    The first ``pivots`` rows are known to all tasks.  A row's distance to the
    nearest of those before it is the first bound on its least distance, and
    rows of the same nearest pivot make blocks of their own, near pivots side by
    side.  ``worst`` is the
    greatest of the rows' bounds once they have met within the block.
    """
    import numpy as np
    import pandas as pd

    from ..sources.scratch import scratch_dir

    spark = df.sparkSession
    rows = numbered(df.select(F.col(order).cast("long").alias("at"), doubles(vector).alias("v")).where("at IS NOT NULL AND v IS NOT NULL"), "at")
    path = scratch_dir(spark, "places")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    # So many that their cells fill blocks.
    pivots = max(1, min(pivots, rows.count() // block))
    first = rows.where(F.col("place") < pivots).orderBy("place").select("at", "v").collect()
    sent = spark.sparkContext.broadcast((np.array([r["at"] for r in first], np.int64), np.array([r["v"] for r in first], float)))

    def toured(unit):
        """Each pivot's place on a tour that goes on to the nearest pivot that is left."""
        place, left, at = np.zeros(len(unit), np.int64), np.ones(len(unit), bool), 0
        for k in range(len(unit)):
            place[at], left[at] = k, False
            at = int(np.where(left, unit @ unit[at], -np.inf).argmax())
        return place

    def near_pivots(frames):
        (known, p), tour = sent.value, None
        for frame in frames:
            if not len(frame):
                continue
            length = np.linalg.norm(p, axis=1)
            unit = p / np.maximum(length, 1e-300)[:, None]
            v, at = np.array(frame["v"].tolist(), float), frame["at"].to_numpy()
            norm = np.linalg.norm(v, axis=1)
            product = v @ p.T
            far = 1 - product / (norm[:, None] * length[None, :] + 1e-8)
            far[known[None, :] >= at[:, None]] = np.inf
            tour = toured(unit) if tour is None else tour
            cell = np.where(norm < SMALL_NORM, -1, tour[(v / np.maximum(norm, 1e-300)[:, None] @ unit.T).argmax(axis=1)])
            yield frame.assign(cell=cell, least=far.min(axis=1))

    marked = rows.mapInPandas(near_pivots, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema.fields)}, cell long, least double")
    laid = numbered(marked, "cell", "place", name="lay").withColumn("block", F.floor(F.col("lay") / block) * (pivots + 1) + F.col("cell") + 1)
    packed = laid.groupBy("block").agg(F.collect_list(F.struct("place", "at", "least", "v")).alias("rows"))

    def within(frames):
        for frame in frames:
            out = []
            for number, held in zip(frame["block"], frame["rows"], strict=True):
                held = sorted(held, key=lambda r: r["place"])
                place, at, v = np.array([r["place"] for r in held]), np.array([r["at"] for r in held]), np.array([r["v"] for r in held], float)
                norm = np.linalg.norm(v, axis=1)
                far = 1 - v @ v.T / (norm[:, None] * norm[None, :] + 1e-8)
                far[at[None, :] >= at[:, None]] = np.inf
                least = np.minimum(far.min(axis=1), [r["least"] for r in held])
                unit = v / np.maximum(norm, 1e-300)[:, None]
                center = unit.mean(axis=0)
                radius = 4.0 if (norm < SMALL_NORM).any() else float(np.linalg.norm(unit - center, axis=1).max())
                told = [{"place": int(q), "at": r["at"], "least": float(x), "v": r["v"]} for q, r, x in zip(place, held, least, strict=True)]
                out.append({"block": number, "center": center.tolist(), "radius": radius, "low": int(place.min()), "high": int(place.max()), "worst": float(least.max()), "rows": told})
            yield pd.DataFrame(out, columns=["block", "center", "radius", "low", "high", "worst", "rows"])

    row = "struct<place:long,at:long,least:double,v:array<double>>"
    made = packed.mapInPandas(within, f"block long, center array<double>, radius double, low long, high long, worst double, rows array<{row}>")
    path = scratch_dir(spark, "blocks")
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path), 128 * (pivots + 1)


def _near_blocks(blocks: DataFrame, bundle: int) -> DataFrame:
    """``(a, b)``: blocks whose rows may have a nearer earlier row in another block, and that one.

    Unit vectors obey the triangle inequality: rows of two blocks are at least
    as far apart as their centers less both radii.  Blocks are bundled by
    hundreds first, so that few pairs of blocks are looked at.
    """
    stats = blocks.select("block", "center", "radius", "low", "high", "worst", F.floor(F.col("block") / bundle).alias("bundle"))
    middle = stats.groupBy("bundle").agg(F.min_by("center", "block").alias("middle"))
    span = stats.join(middle, "bundle").groupBy("bundle", "middle").agg(F.max(euclidean(F.col("center"), F.col("middle")) + F.col("radius")).alias("radius"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("worst").alias("worst"))
    side = lambda frame, mark: frame.select(*[F.col(c).alias(f"{c}_{mark}") for c in frame.columns])

    def apart(center: str) -> Column:
        gap = euclidean(F.col(f"{center}_a"), F.col(f"{center}_b")) - F.col("radius_a") - F.col("radius_b")
        return (F.col("low_b") < F.col("high_a")) & ~((gap > 0) & (gap * gap / 2 > F.col("worst_a") + SLACK))

    bundles = side(span, "a").join(side(span, "b"), apart("middle")).select("bundle_a", "bundle_b")
    return bundles.join(side(stats, "a"), "bundle_a").join(side(stats, "b"), "bundle_b").where((F.col("block_a") != F.col("block_b")) & apart("center")).select(F.col("block_a").alias("a"), F.col("block_b").alias("b"))


def compared_share(df: DataFrame, vector: str = "embedding", order: str = "idx", block: int = 512, pivots: int = 256) -> DataFrame:
    """``(blocks, pairs, compared, share)``: how many pairs of blocks ``diversity_before`` compares, of all."""
    blocks, bundle = _blocks(df, vector, order, block, pivots)
    n = blocks.agg(F.count("*").alias("blocks"))
    pairs = F.col("blocks") * (F.col("blocks") - 1)
    return n.crossJoin(_near_blocks(blocks, bundle).agg(F.count("*").alias("compared"))).select("blocks", pairs.alias("pairs"), "compared", F.coalesce(F.try_divide("compared", pairs), F.lit(0.0)).alias("share"))


def diversity_before(df: DataFrame, vector: str = "embedding", order: str = "idx", block: int = 512, pivots: int = 256) -> DataFrame:
    """``diversity``: ten times the least cosine distance to all rows before, at most 10; the first row is neutral.

    Exact.  Rows near each other lie in one block and meet there first; of the
    other blocks only those are compared, as matrix products, that may hold a
    nearer row for one of the block's, by the triangle inequality.
    """
    import numpy as np
    import pandas as pd

    blocks, bundle = _blocks(df, vector, order, block, pivots)
    left = blocks.select(F.col("block").alias("a"), F.col("rows").alias("later"))
    right = blocks.select(F.col("block").alias("b"), F.col("rows").alias("earlier"))
    pairs = _near_blocks(blocks, bundle).join(left, "a").join(right, "b").select("later", "earlier")

    def run(frames):
        for frame in frames:
            found = [pd.DataFrame({"at": np.zeros(0, np.int64), "least": np.zeros(0)})]
            for later, earlier in zip(frame["later"], frame["earlier"], strict=True):
                ai, bi = np.array([r["at"] for r in later]), np.array([r["at"] for r in earlier])
                a, b = np.array([r["v"] for r in later], float), np.array([r["v"] for r in earlier], float)
                far = 1 - a @ b.T / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :] + 1e-8)
                far[bi[None, :] >= ai[:, None]] = np.inf
                least, known = far.min(axis=1), np.array([r["least"] for r in later])
                nearer = least < known
                if nearer.any():
                    found.append(pd.DataFrame({"at": ai[nearer], "least": least[nearer]}))
            yield pd.concat(found)

    own = blocks.select(F.inline("rows")).select("at", "least")
    least = own.union(pairs.mapInPandas(run, "at long, least double")).where(F.col("least") < float("inf")).groupBy("at").agg(F.min("least").alias("least"))
    joined = df.join(least, F.col(order) == F.col("at"), "left").drop("at")
    return joined.withColumn("diversity", F.when(F.col("least").isNull(), NEUTRAL).otherwise(F.least(F.lit(10.0), F.col("least") * 10))).drop("least")


def cosine_between(a: str, b: str) -> Column:
    return cosine_distance(doubles(a), doubles(b))


def seeded(key: str, seed: int = 42) -> Column:
    """A portable hash of the key and a seed, for orders that do not depend on partitions."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded portable hash of the key; all if there are fewer."""
    return df.orderBy(seeded(key, seed), key).limit(n)


def ratio_sample(df: DataFrame, ratio: float, key: str, seed: int = 42) -> DataFrame:
    return seeded_sample(df, int(df.count() * ratio), key, seed)


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(seeded(key, seed), key)


def first_of_each(df: DataFrame, column: str, order: str) -> DataFrame:
    """One row of each lower-cased, trimmed text: that of the least order, null orders last.

    Rows are ranked by digests of the text; each task keeps its first row of a
    text before anything is shuffled.  Of rows of one text and order the least
    digest of the row counts, so that reruns agree.
    """
    norm = F.lower(F.regexp_replace(F.coalesce(column, F.lit("")), r"^\s+|\s+$", ""))
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    marked = df.withColumns({"first_a": F.xxhash64(norm), "first_b": F.xxhash64(F.lit(1), norm)})
    best = Window.partitionBy("first_a", "first_b").orderBy(F.col(order).asc_nulls_last(), F.xxhash64(*plain))
    return marked.withColumn("first_rank", F.row_number().over(best)).where(F.col("first_rank") == 1).drop("first_a", "first_b", "first_rank")


def balance(df: DataFrame, ratios: dict[str, float], difficulty: str = "difficulty", rating: str = "rating", order: str = "idx") -> DataFrame:
    """Of each listed difficulty the best ``int(total * ratio)`` rows; a missing difficulty is medium."""
    level = F.coalesce(difficulty, F.lit("medium"))
    total = df.agg(F.count("*").alias("balance_total"))
    quotas = F.create_map(*[F.lit(x) for kv in ratios.items() for x in kv])
    best = Window.partitionBy(level).orderBy(F.desc(F.coalesce(rating, F.lit(0.0))), order)
    ranked = df.withColumn("balance_rank", F.row_number().over(best)).crossJoin(F.broadcast(total))
    return ranked.where(F.col("balance_rank") <= F.floor(F.col("balance_total") * F.try_element_at(quotas, level))).drop("balance_rank", "balance_total")
