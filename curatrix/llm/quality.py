"""Quality rules: document statistics and gradient-boosted trees over them.

``document_statistics`` measures whole texts.  ``fit_trees`` trains boosted
regression trees on the logistic loss, with monotone constraints on chosen
features; the trained trees are flat numpy node arrays, which score a whole
batch at once by walking all rows down all trees level by level.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import steps
from .common import small_batches

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: The six ASCII white-space characters.
WHITE = " \t\n\v\f\r"
#: Base statistics that the digest returns.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features, and whether more of one may only raise (1) or lower (-1) the score.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": -1, "digit_share": -1, "punct_share": -1, "mark_pair_share": -1, "distinct_share": 0, "letterless_share": -1, "line_words": 0,
}
MIN_WORDS = 50
_MARKS, _WHITES = np.zeros(256, bool), np.zeros(256, bool)
_MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_WHITES[list(WHITE.encode())] = True


def repeated_words(words: list, size: int = 3) -> int:
    """Words in windows of ``size`` words that occur twice or more, first occurrences included."""
    n = len(words)
    if n <= size:
        return 0
    names: dict = {}
    ids = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    keys = ids[: n - size + 1].copy()
    for k in range(1, size):
        keys = keys * len(names) + ids[k : n - size + 1 + k]
        if len(names) ** (k + 2) >= 1 << 62:
            keys = np.unique(keys, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(keys) + 1, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    marks = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + size, -1)
    return int((np.cumsum(marks)[:n] > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """Base counts and features of one whole text; a null text has no words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    white = sum(map(text.count, WHITE))
    counts = list(map(text.count, SYMBOLS))
    lines = [k for k in raw.split(b"\n") if k and not k.isspace()]
    dup_lines, repeats, symbols = len(lines) - len(set(lines)), repeated_words(words), sum(counts)
    chars = len(text) - white
    base = [n, chars, symbols, dup_lines, repeats]
    some, letters = max(n, 1), max(chars, 1)
    plain = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(plain, minlength=256)
    digits, upper = int(kinds[48:58].sum()), int(kinds[65:91].sum())
    punct = int(kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum())
    # Pairs of the same mark side by side, and words with neither a letter nor a digit.
    mark = _MARKS[plain]
    pairs = int((mark[1:] & (plain[1:] == plain[:-1])).sum())
    solid = ~_WHITES[plain]
    starts = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    letterless = int((np.add.reduceat(solid & ~mark, starts, dtype=np.int64) == 0).sum()) if len(starts) else 0
    return base, [
        np.log1p(n), chars / some, symbols / letters, dup_lines / max(len(lines), 1), repeats / some, upper / letters,
        digits / letters, punct / letters, pairs / some, len(set(words)) / some, letterless / some, n / max(len(lines), 1),
    ]


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, the five base counts, features array<double>)`` of every whole text.

    Null texts have no words; empty texts neither; repeated rows stay repeated.
    """
    kind = pa.schema([(id_col, pa.int64()), *((c, pa.int64()) for c in BASE), ("features", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 1):
                rows = [statistics(t) for t in part.column(1).to_pylist()]
                base = np.array([r[0] for r in rows], np.int64).T
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, base), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], schema=kind)

    schema = f"`{id_col}` bigint, {', '.join(f'{c} bigint' for c in BASE)}, features array<double>"
    return small_batches(df).select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


@dataclass
class FlatTrees:
    """All trees' nodes in flat arrays: leaf nodes point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of each row of ``x``."""
        x = np.asarray(x, np.float64)
        if not len(self.roots) or not len(x):
            return np.full(len(x), self.bias)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.bias + self.value[at].sum(axis=1)


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: Sequence[int], trees: int = 60, depth: int = 4, rate: float = 0.2, least: float = 2.0, penalty: float = 1.0, bins: int = 64) -> FlatTrees:
    """Boosted trees on the logistic loss over histogram bins.

    A split on a constrained feature is taken only if its leaf values are in
    the wanted order; the children of such a split are kept on their sides of
    the middle of the two values, so the whole ensemble is monotone in it.
    With no rows or a single class the trees are empty and the bias alone counts.
    """
    x, y = np.asarray(x, np.float64).reshape(len(y), len(monotone)), np.asarray(y, np.float64)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    bias = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], 1)
        scores = np.full(len(y), bias)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-scores))
            grad, hess = p - y, p * (1 - p)
            roots.append(_grow(nodes, binned, cuts, grad, hess, np.arange(len(y)), monotone, depth, least, penalty, rate, -np.inf, np.inf, scores))
    table = np.array(nodes, np.float64).reshape(-1, 5)
    return FlatTrees(*(table[:, k].astype(np.int64) if k in (0, 2, 3) else table[:, k] for k in range(5)), np.array(roots, np.int64), depth, bias)


def _grow(nodes, binned, cuts, grad, hess, rows, monotone, depth, least, penalty, rate, low, high, scores) -> int:
    """Add the subtree over ``rows`` to ``nodes`` and its values to ``scores``; returns its place."""
    value = lambda g, h: np.clip(-g / (h + penalty), low, high)
    gain = lambda g, h, v: -(g * v + 0.5 * (h + penalty) * v * v)
    g, h = grad[rows].sum(), hess[rows].sum()
    me, own = len(nodes), value(g, h)
    nodes.append([0, 0.0, me, me, own * rate])
    best = (1e-6, -1, -1, 0.0, 0.0)
    for f, c in enumerate(cuts if depth else ()):
        if not len(c):
            continue
        gl = np.cumsum(np.bincount(binned[rows, f], grad[rows], len(c) + 1))[:-1]
        hl = np.cumsum(np.bincount(binned[rows, f], hess[rows], len(c) + 1))[:-1]
        vl, vr = value(gl, hl), value(g - gl, h - hl)
        won = gain(gl, hl, vl) + gain(g - gl, h - hl, vr) - gain(g, h, own)
        won[(hl < least) | (h - hl < least) | (monotone[f] * (vr - vl) < 0)] = -np.inf
        k = int(np.argmax(won))
        if won[k] > best[0]:
            best = (won[k], f, k, vl[k], vr[k])
    _, f, k, vl, vr = best
    if f < 0:
        scores[rows] += own * rate
        return me
    goes = binned[rows, f] <= k
    middle = (vl + vr) / 2
    bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(np.sign(monotone[f]))]
    deeper = [_grow(nodes, binned, cuts, grad, hess, rows[m], monotone, depth - 1, least, penalty, rate, *b, scores) for m, b in ((goes, bounds[0]), (~goes, bounds[1]))]
    nodes[me] = [f, float(cuts[f][k]), *deeper, 0.0]
    return me


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 4000, **options) -> FlatTrees:
    """Trees that tell ``labels.quality``, fitted to a bounded sample.

    ``sample`` bounds the labels that reach the driver, are broadcast and are
    fitted: those with the smallest hashes of their ids.  Of repeated labels
    the largest counts; labels without id, quality or document are left out.
    """
    chosen = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("quality"))
    known = {r[0]: r[1] for r in chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()}
    ids = docs.sparkSession.createDataFrame([(k,) for k in known], "doc_id bigint")
    stats = document_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id"))
    rows = sorted(stats.select("doc_id", "features").collect(), key=lambda r: (r[0], r[1]))
    return fit_trees(np.array([r[1] for r in rows]).reshape(-1, len(FEATURES)), np.array([known[r[0]] for r in rows], float), list(FEATURES.values()), **options)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(df: DataFrame, trees: FlatTrees, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Statistics, ``score`` (probability of good quality), ``base_failed`` and ``kept`` of every document.

    ``kept`` is false where the base rules fail, otherwise whether the score
    reaches ``threshold``.  Nulls, empty texts and repeated rows are as in
    ``document_statistics``.
    """
    kind = pa.schema([(id_col, pa.int64()), *((c, pa.int64()) for c in BASE), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 1):
                rows = [statistics(t) for t in part.column(1).to_pylist()]
                base = np.array([r[0] for r in rows], np.int64).T
                odds = trees.score(np.array([r[1] for r in rows]))
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, base), pa.array(1 / (1 + np.exp(-odds)))], schema=kind)

    schema = f"`{id_col}` bigint, {', '.join(f'{c} bigint' for c in BASE)}, score double"
    judged = small_batches(df).select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def keep_good(df: DataFrame, trees: FlatTrees, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that ``judge`` would keep, with all their columns and no shuffle."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, at):
                base, features = zip(*map(statistics, part.column(at).to_pylist()), strict=True)
                base = np.array(base, np.int64)
                failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > 50 * base[:, 0])
                good = 1 / (1 + np.exp(-trees.score(np.array(features)))) >= threshold
                yield part.filter(pa.array(good & ~failed))

    return small_batches(df).mapInArrow(run, df.schema)
