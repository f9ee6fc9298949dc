"""Quality rules: base counts of whole texts and gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import common

# Symbols that are counted, and the base rule's limits.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 10, 20, 5

#: Labelled documents that the trees are fitted on at most, the first by hash of doc_id. Counts and scores use all documents.
SAMPLE_ROWS = 20_000
#: Share of the sample that is held back to choose the threshold.
HELD_BACK = 0.25
#: Share of good held-back documents that the threshold may reject.
MOST_GOOD_LOST = 0.002

#: Statistics that the trees see, and how the score may move as each rises (0: either way).
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols_per_word": -1, "repeated_share": -1, "dup_line_share": -1,
    "upper_share": -1, "exclamations_per_word": -1, "digit_share": 0, "distinct_share": 0, "words_per_line": 0,
    "stops_per_word": 0, "longest_run_share": -1,
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts and the features of one whole text; a null text has none of anything."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    by_byte = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    word_chars = len(text or "") - int(by_byte[list(SPACES)].sum())
    n_symbols = int(by_byte[list(SYMBOLS)].sum())
    seen: set[bytes] = set()
    n_lines = n_dup = 0
    for line in data.split(b"\n"):
        if line.strip(SPACES):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    hashes = common.word_hashes(words)
    windows = common.window_hashes(hashes, WINDOW)
    n_repeat = 0
    if len(windows):
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        at = np.flatnonzero(times[which] >= 2)
        edges = np.zeros(n + 1, dtype=np.int64)
        edges[at] += 1
        edges[at + WINDOW] -= 1
        n_repeat = int((np.cumsum(edges) > 0).sum())
    some = max(1, n)
    letters = max(1, word_chars)
    breaks = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1], [True]))) if n else np.array([0, 0])
    features = [
        float(np.log1p(n)), word_chars / some, n_symbols / some, n_repeat / some, n_dup / max(1, n_lines),
        float(by_byte[0x41:0x5B].sum()) / letters, float(by_byte[0x21]) / some, float(by_byte[0x30:0x3A].sum()) / letters,
        len(np.unique(hashes)) / some, n / max(1, n_lines), float(by_byte[[0x2E, 0x3F]].sum()) / some, float(np.diff(breaks).max()) / some,
    ]
    return [n, word_chars, n_symbols, n_dup, n_repeat], features


_ARROW = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("features", pa.list_(pa.float64()))])


def with_statistics(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(x) for x in batch.column("text").to_pylist()]
            counts = [pa.array([m[0][k] for m in made], pa.int64()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array([m[1] for m in made], pa.list_(pa.float64()))], schema=_ARROW)

    counts = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {counts}, features array<double>")


# ---- gradient-boosted trees ---------------------------------------------------------------------

@dataclass(frozen=True)
class Trees:
    """Trees as flat node arrays: leaves have feature -1 and themselves as children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float
    cut: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality of each row; all rows go down a tree level by level."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(goes_left, self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trend: list[int], rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: float = 5.0, ridge: float = 1.0) -> Trees:
    """Logistic boosting on binned features. ``trend``: +1 or -1 keeps the score monotone in that feature.

    A split on such a feature needs child values in that order; the middle of the two then bounds all that grows below,
    so no later split can break the order.
    """
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    raw = np.full(len(y), start)
    nodes: list[list] = []
    roots: list[int] = []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + ridge), low, high))

    def best_split(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, low: float, high: float):
        g, h = grad[rows].sum(), hess[rows].sum()
        gain_of = lambda g, h, v: -(g * v + 0.5 * (h + ridge) * v * v)
        best = (1e-6, None)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            gl = np.cumsum(np.bincount(binned[rows, f], grad[rows], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(binned[rows, f], hess[rows], len(e) + 1))[:-1]
            vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-(g - gl) / (h - hl + ridge), low, high)
            gain = gain_of(gl, hl, vl) + gain_of(g - gl, h - hl, vr) - gain_of(g, h, leaf(g, h, low, high))
            gain[(hl < least * 0.05) | (h - hl < least * 0.05) | (trend[f] * (vr - vl) < 0)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, k, float(vl[k]), float(vr[k])))
        return best[1]

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, level: int, low: float, high: float) -> int:
        me = len(nodes)
        nodes.append([0, np.inf, me, me, rate * leaf(grad[rows].sum(), hess[rows].sum(), low, high)])
        split = best_split(rows, grad, hess, low, high) if level < depth and len(rows) > 1 else None
        if split is None:
            raw[rows] += nodes[me][4]
            return me
        f, k, vl, vr = split
        middle = (vl + vr) / 2
        left_bounds = (low, middle) if trend[f] > 0 else (middle, high) if trend[f] < 0 else (low, high)
        right_bounds = (middle, high) if trend[f] > 0 else (low, middle) if trend[f] < 0 else (low, high)
        goes_left = binned[rows, f] <= k
        nodes[me][:2] = [f, float(edges[f][k])]
        nodes[me][2] = grow(rows[goes_left], grad, hess, level + 1, *left_bounds)
        nodes[me][3] = grow(rows[~goes_left], grad, hess, level + 1, *right_bounds)
        return me

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    return Trees(feature.astype(np.int64), threshold.astype(float), left.astype(np.int64), right.astype(np.int64), value.astype(float), np.array(roots), depth, start)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Trees fitted on at most ``sample_rows`` labelled documents, with the threshold taken from held-back ones.

    None if the labels do not have both classes; then only the base rule decides. Labels with a null id or quality, and
    ids that are labelled both ways, are left out.
    """
    clear = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other").select("doc_id", "quality")
    )
    chosen = clear.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")).join(F.broadcast(chosen), "doc_id")
    # One row per id, so the driver gets at most sample_rows rows of a dozen numbers.
    rows = sample.groupBy("doc_id").agg(F.min(F.struct("quality", "features")).alias("row")).select("doc_id", "row.*").toPandas().sort_values("doc_id")
    y = rows["quality"].to_numpy(dtype=float)
    if not 0 < y.sum() < len(y):
        return None
    x = np.array(rows["features"].tolist())
    held = np.arange(len(y)) % round(1 / HELD_BACK) == 0
    if not 0 < y[~held].sum() < (~held).sum():
        held[:] = False
    trees = fit_trees(x[~held], y[~held], list(FEATURES.values()))
    good = trees.scores(x[held & (y == 1)])
    cut = min(0.5, float(np.quantile(good, MOST_GOOD_LOST))) if len(good) else 0.5
    return Trees(**{**trees.__dict__, "cut": cut})


def base_failed() -> F.Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, the base counts, base_failed, the trees' score and kept, for every row of ``docs``.

    A null text counts as empty and fails the base rule; rows are judged one by one, so repeated rows, null ids and
    very long texts need no care; an empty table gives no rows; other columns are ignored.
    """
    @F.pandas_udf("double")
    def score(features):
        import pandas as pd

        return pd.Series(trees.scores(np.array(features.tolist(), dtype=float).reshape(len(features), -1)))

    judged = with_statistics(docs).withColumn("base_failed", base_failed())
    judged = judged.withColumn("score", score("features") if trees else F.lit(1.0))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= (trees.cut if trees else 0.0))).drop("features")


def keep_good(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are. One narrow pass, no shuffle."""
    @F.pandas_udf("boolean")
    def kept(text):
        import pandas as pd

        made = [statistics(x) for x in text]
        failed = np.array([c[0] < LEAST_WORDS or 100 * c[4] > MOST_REPEATED_PERCENT * c[0] for c, _ in made], dtype=bool)
        if trees is None or not len(made):
            return pd.Series(~failed)
        return pd.Series(~failed & (trees.scores(np.array([f for _, f in made])) >= trees.cut))

    return docs.filter(kept(F.col("text")))


def op4_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, common.table(spark, sf_dir, "labels")))
