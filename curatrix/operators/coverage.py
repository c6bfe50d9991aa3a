"""Cluster-based selection and how well a selection covers all vectors."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import doubles, euclidean

#: Vectors of a selection that are broadcast at most (64 MB of 64 doubles each).
BROADCAST_VECTORS = 125_000


def target_size(n: int, target: int | None = None, ratio: float = 0.2) -> int:
    return min(target, n) if target is not None else max(1, int(n * ratio))


def cluster_count(n: int, wanted: int | None = None) -> int:
    return min(wanted, n) if wanted else max(2, min(n, int(2 * math.sqrt(n))))


def kmeans(df: DataFrame, k: int, vector: str = "embedding", seed: int = 42) -> DataFrame:
    """``cluster`` and ``center`` of every row."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = df.withColumn("kmeans_features", array_to_vector(doubles(vector)))
    model = KMeans(k=k, seed=seed, maxIter=300, featuresCol="kmeans_features", predictionCol="cluster").fit(rows)
    centers = df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, center array<double>")
    return model.transform(rows).drop("kmeans_features").join(F.broadcast(centers), "cluster")


def mean_centers(df: DataFrame, vector: str = "embedding", cluster: str = "label") -> DataFrame:
    """``center``: the mean vector of each cluster, without collecting any group."""
    each = df.select(cluster, F.posexplode(doubles(vector)).alias("dim", "x")).groupBy(cluster, "dim").agg(F.avg("x").alias("x"))
    return each.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("center"))


def quotas(df: DataFrame, n: int, cluster: str = "label") -> DataFrame:
    """Rows to take of each cluster: in proportion, at least one; what is left to the largest, then the first.

    ``start`` is how many are taken before, in the order of clusters; beyond
    ``n`` rows nothing is taken.
    """
    counts = df.groupBy(cluster).agg(F.count("*").alias("cnt"))
    total = counts.agg(F.sum("cnt").alias("total"))
    first = F.least(F.greatest(F.lit(1), F.floor(F.lit(n) * F.col("cnt") / F.col("total"))), F.col("cnt"))
    base = counts.crossJoin(F.broadcast(total)).withColumn("base", first)
    left = base.agg((F.lit(n) - F.sum("base")).alias("left_over"))
    by_size = Window.orderBy(F.desc("cnt"), cluster)
    room = F.coalesce(F.sum(F.col("cnt") - F.col("base")).over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(F.col("cnt") - F.col("base"), F.col("left_over") - F.col("room")))
    out = base.crossJoin(F.broadcast(left)).withColumn("room", room).withColumn("quota", F.col("base") + extra)
    before = F.sum("quota").over(Window.orderBy(cluster).rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("start", F.coalesce(before, F.lit(0))).select(cluster, "cnt", "quota", "start")


def select_centroid(df: DataFrame, n: int, vector: str = "embedding", cluster: str = "label", order: str = "vec_id") -> DataFrame:
    """Of each cluster its quota of rows nearest to its center, in all at most ``n``."""
    centers = df.select(cluster, "center").dropDuplicates([cluster]) if "center" in df.columns else mean_centers(df, vector, cluster)
    near = df.drop("center").join(F.broadcast(centers), cluster).withColumn("distance", euclidean(doubles(vector), F.col("center")))
    rank = F.row_number().over(Window.partitionBy(cluster).orderBy(F.round("distance", 9), order))
    # No quota is above n, and a literal bound lets each task keep its best rows only.
    ranked = near.withColumn("rank", rank).where(F.col("rank") <= n).join(F.broadcast(quotas(df, n, cluster)), cluster)
    return ranked.where((F.col("rank") <= F.col("quota")) & (F.col("start") + F.col("rank") <= n)).drop("cnt", "quota", "start", "center")


def _farthest(rows: DataFrame, taken: list[int], picked: list[np.ndarray], most: int) -> DataFrame:
    """``(id, label, v, least)``: of each cluster the ``most`` rows of greatest least distance to those picked; ties go to the smaller id."""
    sent = rows.sparkSession.sparkContext.broadcast((np.array(taken, np.int64), picked))

    def run(batches):
        import pyarrow as pa

        away, near = sent.value
        held = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, labels = part.column(0).to_numpy(), part.column(1).to_pylist()
                v = np.array(part.column(2).to_pylist(), float)
                least = np.full(len(v), np.inf)
                for one in near:
                    least = np.minimum(least, np.linalg.norm(v - one, axis=1))
                groups = {}
                for i in np.flatnonzero(~np.isin(ids, away)).tolist():
                    groups.setdefault(labels[i], []).append((-least[i], int(ids[i]), i))
                for label, found in groups.items():
                    new = [(d, k, v[i].copy()) for d, k, i in found]
                    held[label] = sorted([*held.get(label, []), *new], key=lambda r: r[:2])[:most]
        for label, found in held.items():
            for at in range(0, len(found), 1024):
                some = found[at : at + 1024]
                columns = [pa.array([k for _, k, _ in some], pa.int64()), pa.array([label] * len(some), kind), pa.array([x.tolist() for _, _, x in some], pa.list_(pa.float64())), pa.array([-d for d, _, _ in some], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "v", "least"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(rows.schema["label"].dataType)
    found = rows.mapInArrow(run, f"id bigint, label {rows.schema['label'].dataType.simpleString()}, v array<double>, least double")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("least"), "id"))).where(F.col("rank") <= most).drop("rank")


def select_diverse(df: DataFrame, n: int, vector: str = "embedding", cluster: str = "label", order: str = "vec_id", candidates: int = 20_000) -> DataFrame:
    """Round-robin over clusters, each time the row farthest from all taken so far.

    Every row is a candidate.  About ``candidates`` rows, those of each cluster
    that are farthest from the rows taken, are on the driver at a time.
    Distances only shrink, so a cluster's farthest row there is its farthest
    of all until it falls behind the last that was brought; then the rows are
    looked through again.  The vectors of the rows taken are on the driver.
    """
    from pyspark import StorageLevel

    rows = df.select(F.col(order).cast("long").alias("id"), F.col(cluster).alias("label"), doubles(vector).alias("v")).where("id IS NOT NULL AND v IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = rows.groupBy("label").agg(F.count_distinct("id").alias("n"), F.min_by(F.struct("id", "v"), "id").alias("first")).collect()
        if not counts:
            return df.limit(0)
        counts.sort(key=lambda r: (r["label"] is None, r["label"]))
        names, most = [r["label"] for r in counts], max(16, candidates // len(counts))
        first = counts[0]["first"]
        taken, picked = [int(first["id"])], [np.array(first["v"], float)]
        held, turn, wanted = {}, 1, min(n, sum(r["n"] for r in counts))
        empty = 0
        while len(taken) < wanted and empty < len(names):
            name = names[turn % len(names)]
            best = None
            if name in held:
                ids, v, least, left, last = held[name]
                some = np.flatnonzero(left)
                if len(some):
                    best = int(some[np.lexsort((ids[some], -least[some]))[0]])
                # All others of the cluster are behind the last one brought.
                if last is not None and (best is None or (-least[best], ids[best]) > last):
                    held.clear()
                    continue
            else:
                brought = {}
                for r in _farthest(rows, taken, picked, most).collect():
                    brought.setdefault(r["label"], []).append((-r["least"], r["id"], r["v"]))
                for label in names:
                    found = sorted(brought.get(label, []), key=lambda r: r[:2])
                    last = found[-1][:2] if len(found) == most else None
                    held[label] = (np.array([r[1] for r in found], np.int64), np.array([r[2] for r in found], float), -np.array([r[0] for r in found]), np.ones(len(found), bool), last)
                continue
            turn += 1
            if best is None:
                empty += 1
                continue
            empty = 0
            taken.append(int(ids[best]))
            picked.append(v[best])
            for label, (some_ids, some_v, some_least, some_left, last) in held.items():
                if len(some_ids):
                    near = np.minimum(some_least, np.linalg.norm(some_v - picked[-1], axis=1))
                    held[label] = (some_ids, some_v, near, some_left & (some_ids != taken[-1]), last)
    finally:
        rows.unpersist()
    chosen = df.sparkSession.createDataFrame(list(enumerate(taken[:n])), f"pick int, `{order}` long")
    return df.join(F.broadcast(chosen), order)


def cluster_stats(df: DataFrame, selected: DataFrame, cluster: str = "label") -> DataFrame:
    """Rows and chosen rows of every cluster."""
    chosen = selected.groupBy(cluster).agg(F.count("*").alias("n_selected"))
    return df.groupBy(cluster).agg(F.count("*").alias("n_rows")).join(chosen, cluster, "left").fillna(0, ["n_selected"])


def _nearest(rows: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """Each row's distance to the nearest pick, a slice of the rows at a time."""
    out, square = np.empty(len(rows)), (picks * picks).sum(axis=1)
    step = max(1, 4_000_000 // max(1, len(picks)))
    for at in range(0, len(rows), step):
        some = rows[at : at + step]
        far = square[None, :] - 2 * some @ picks.T
        nearest = picks[far.argmin(axis=1)]
        # The product only says which is nearest; its distance is taken anew, without cancellation.
        out[at : at + step] = np.sqrt(((some - nearest) ** 2).sum(axis=1))
    return out


def coverage_score(df: DataFrame, selected: DataFrame, vector: str = "embedding") -> DataFrame:
    """``1 / (1 + mean distance to the nearest selected row)``; 0 if either side is empty.

    A selection of up to ``BROADCAST_VECTORS`` vectors is sent to the tasks,
    which give a sum and a count each.  A larger one is packed, and so are the
    distinct vectors; each two packs are compared as a matrix product.
    """
    import pyarrow as pa

    # One more row than may be sent, so that nothing unbounded is brought to the driver.
    found = selected.select(doubles(vector).alias("s")).where("s IS NOT NULL").limit(BROADCAST_VECTORS + 1).collect() if selected.limit(BROADCAST_VECTORS + 1).count() <= BROADCAST_VECTORS else None
    rows = df.select(doubles(vector).alias("v")).where("v IS NOT NULL")
    score = F.when(F.sum("n") > 0, 1 / (1 + F.sum("d") / F.sum("n"))).otherwise(0.0)
    if found is not None:
        sent = df.sparkSession.sparkContext.broadcast(np.array([r[0] for r in found], float))

        def run(batches):
            for batch in batches:
                if batch.num_rows and len(sent.value):
                    v = batch.column(0)
                    yield pa.RecordBatch.from_pydict({"d": [float(_nearest(v.flatten().to_numpy().reshape(len(v), -1), sent.value).sum())], "n": [len(v)]})

        return rows.mapInArrow(run, "d double, n bigint").agg(F.coalesce(score, F.lit(0.0)).alias("coverage"))
    keys = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2")]
    each = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.any_value("v").alias("v"))
    packs = lambda frame, key, name: frame.groupBy(F.pmod(key, F.lit(max(1, frame.count() // 2048))).alias(f"{name}_pack")).agg(F.collect_list(F.struct(*frame.columns)).alias(name))
    picks = selected.select(doubles(vector).alias("s")).where("s IS NOT NULL").distinct()

    def compared(frames):
        import pandas as pd

        for frame in frames:
            for left, right in zip(frame["left"], frame["right"], strict=True):
                d = _nearest(np.array([r["v"] for r in left], float), np.array([r["s"] for r in right], float))
                yield pd.DataFrame({"k1": [r["k1"] for r in left], "k2": [r["k2"] for r in left], "n": [r["n"] for r in left], "d": d})

    met = packs(each, F.col("k1"), "left").crossJoin(packs(picks, F.xxhash64("s"), "right")).select("left", "right")
    nearest = met.mapInPandas(compared, "k1 long, k2 long, n long, d double").groupBy("k1", "k2", "n").agg(F.min("d").alias("least"))
    return nearest.select("n", (F.col("n") * F.col("least")).alias("d")).agg(F.coalesce(score, F.lit(0.0)).alias("coverage"))


def embedding_text(df: DataFrame) -> DataFrame:
    """``embedding_text``: the fields that stand for an example, joined by spaces; the whole row as JSON if it has none.

    An instruction counts only where there is no question; a list of reasoning
    steps is joined; conversations give the contents of their turns.
    """
    have = set(df.columns)
    text = lambda c: F.when(F.length(F.col(c)) > 0, F.col(c))
    parts = [text(c) for c in ("question", "answer") if c in have]
    if "reasoning" in have:
        listed = df.schema["reasoning"].dataType.typeName() == "array"
        parts.append(F.array_join("reasoning", " ") if listed else text("reasoning"))
    if "instruction" in have:
        parts.append(F.when(F.col("question").isNull(), text("instruction")) if "question" in have else text("instruction"))
    parts += [F.array_join(F.transform(c, lambda m: m["content"]), " ") for c in ("conversations", "messages") if c in have]
    joined = F.concat_ws(" ", *parts) if parts else F.lit("")
    return df.withColumn("embedding_text", F.when(F.length(joined) > 0, joined).otherwise(F.to_json(F.struct(*df.columns))))


def embed(df: DataFrame, encoder, column: str = "embedding_text") -> DataFrame:
    """``embedding`` of every text; equal texts are encoded once.

    ``encoder`` makes, once per task, a function from a list of texts to a list of vectors.
    """
    import pandas as pd

    def run(frames):
        encode = encoder()
        for frame in frames:
            yield pd.DataFrame({column: frame[column], "embedding": [[float(x) for x in v] for v in encode(frame[column].tolist())]})

    vectors = df.select(column).where(F.col(column).isNotNull()).distinct().mapInPandas(run, f"`{column}` string, embedding array<float>")
    return df.join(vectors, column, "left")


def hash_encoder(size: int = 64):
    """An encoder that needs no model: a text's words, counted in buckets by their CRC, at unit length."""

    def make():
        import zlib

        def encode(texts: list[str]) -> list[list[float]]:
            out = np.zeros((len(texts), size))
            for k, text in enumerate(texts):
                for word in text.lower().split():
                    out[k, zlib.crc32(word.encode()) % size] += 1
            return (out / np.maximum(np.linalg.norm(out, axis=1), 1e-12)[:, None]).tolist()

        return encode

    return make


#: Encoders by name; ``ENCODERS[name]()`` is what ``embed`` takes.
ENCODERS = {"hash": hash_encoder}


def embed_cached(df: DataFrame, encoder, path: str, column: str = "embedding_text", model: str = "default", buckets: int = 64) -> DataFrame:
    """As ``embed``, with a table of vectors at ``path`` that is kept from run to run.

    The table is bucketed by a hash of model and text, so neither the search
    for new texts nor the join moves it; only texts that it lacks are encoded,
    each once, and appended.
    """
    import hashlib

    spark = df.sparkSession
    name = f"embeddings_{hashlib.md5(f'{path}:{buckets}'.encode()).hexdigest()}"  # noqa: S324
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (text_key STRING, embedding ARRAY<FLOAT>) USING parquet CLUSTERED BY (text_key) SORTED BY (text_key) INTO {buckets} BUCKETS LOCATION '{path}'")
    keyed = df.withColumn("text_key", F.when(F.col(column).isNotNull(), F.sha2(F.concat(F.lit(f"{model}:"), column), 256)))
    texts = keyed.where("text_key IS NOT NULL").groupBy("text_key").agg(F.any_value(column).alias(column))
    new = texts.join(spark.table(name), "text_key", "left_anti")

    def run(frames):
        import pandas as pd

        encode = encoder()
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"text_key": frame["text_key"], "embedding": [[float(x) for x in v] for v in encode(frame[column].tolist())]})

    new.mapInPandas(run, "text_key string, embedding array<float>").write.insertInto(name)
    spark.catalog.refreshTable(name)
    return keyed.join(spark.table(name), "text_key", "left").drop("text_key")
