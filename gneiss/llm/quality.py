"""Quality classifier: a sparse ensemble of rules.

Document statistics are Spark columns. Small trees fitted to a bounded labelled sample give conjunctive rules over the
statistics, lasso logistic regression weighs them, and the rules with a weight become one Spark column expression, so
scoring stays in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.llm.common import id_remainder
from gneiss.llm.rules import SYMBOLS, words_of, without

#: About so many labelled documents are learned from, at most; they are drawn by a hash of the id.
SAMPLE_ROWS = 12_000
HOLD_OUT_MODULUS, HOLD_OUT = 5, 0
THRESHOLD = 0.3
_SAMPLE_BUCKETS = 1 << 20

STATISTICS = ["n_chars", "n_words", "word_length", "upper", "digits", "symbols", "punctuation", "bangs", "bars", "distinct_words", "distinct_lines", "line_words", "repeats_before"]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs' columns (text dropped) and the STATISTICS as doubles under names with a leading ``_``."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.withColumn("_t", t).drop(text_col).withColumn("_w", words_of(F.col("_t"))).withColumn("_l", F.split("_t", "\n")).withColumn("_c", F.length("_t"))
    n, c = F.greatest(F.size("_w"), F.lit(1)), F.greatest(F.col("_c"), F.lit(1))
    found = {
        "n_chars": F.col("_c"),
        "n_words": F.size("_w"),
        "word_length": F.length(F.array_join("_w", "")) / n,
        "upper": (F.col("_c") - without(F.col("_t"), "\\p{Lu}+")) / c,
        "digits": (F.col("_c") - without(F.col("_t"), "\\p{N}+")) / c,
        "symbols": F.regexp_count("_t", F.lit(SYMBOLS)) / c,
        "punctuation": (F.col("_c") - without(F.col("_t"), "[^\\p{L}\\p{N}\\x20\\x09-\\x0D]+")) / c,
        "bangs": (F.col("_c") - F.length(F.replace(F.col("_t"), F.lit("!"), F.lit("")))) / c,
        "bars": (F.col("_c") - F.length(F.replace(F.col("_t"), F.lit("|"), F.lit("")))) / c,
        "distinct_words": F.size(F.array_distinct("_w")) / n,
        "distinct_lines": F.size(F.array_distinct("_l")) / F.size("_l"),
        "line_words": F.size("_w") / F.size("_l"),
        "repeats_before": F.size(F.filter("_w", lambda x, i: (i > 0) & (x == F.get(F.col("_w"), i - 1)))) / n,
    }
    return df.withColumns({f"_{k}": v.cast("double") for k, v in found.items()}).drop("_t", "_w", "_l", "_c")


@dataclass(frozen=True)
class Rule:
    """A conjunction: for every statistic named, low < value <= high."""

    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return reduce(np.logical_and, [(x[:, k] > low) & (x[:, k] <= high) for k, low, high in self.bounds])

    def column(self) -> Column:
        parts = []
        for k, low, high in self.bounds:
            value = F.col(f"_{STATISTICS[k]}")
            parts += [value > F.lit(float(low))] * (low > -np.inf) + [value <= F.lit(float(high))] * (high < np.inf)
        return reduce(lambda a, b: a & b, parts)


@dataclass(frozen=True)
class Model:
    intercept: float
    rules: tuple[Rule, ...] = ()
    weights: tuple[float, ...] = ()

    def score(self) -> Column:
        z = reduce(lambda a, b: a + b, [F.when(r.column(), F.lit(float(w))).otherwise(F.lit(0.0)) for r, w in zip(self.rules, self.weights, strict=True)], F.lit(float(self.intercept)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + sum((w * r.holds(x) for r, w in zip(self.rules, self.weights, strict=True)), np.zeros(len(x))))))


def _cuts(x: np.ndarray, most: int = 48) -> list[np.ndarray]:
    """Thresholds of each statistic: midpoints between neighbouring quantiles."""
    out = []
    for k in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, k], np.linspace(0, 1, most), method="nearest"))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def tree_rules(x: np.ndarray, target: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray], bins: np.ndarray, depth: int, least: int) -> list[tuple[Rule, np.ndarray, float, bool]]:
    """The nodes below the root of a least-squares tree, as (rule, rows, value, whether it is a leaf)."""
    out = []

    def grow(rows: np.ndarray, bounds: dict[int, tuple[float, float]], left: int) -> None:
        if not left or len(rows) < 2 * least:
            return
        g, h = target[rows], weight[rows]
        best, where = 1e-9, None
        whole = g.sum() ** 2 / (h.sum() + 1e-9)
        for k, c in enumerate(cuts):
            if not len(c):
                continue
            b = bins[rows, k]
            gs, hs, ns = (np.cumsum(np.bincount(b, weights=v, minlength=len(c) + 1))[:-1] for v in (g, h, np.ones(len(rows))))
            gain = gs**2 / (hs + 1e-9) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1e-9) - whole
            gain[(ns < least) | (len(rows) - ns < least)] = -1
            if gain.max() > best:
                best, where = gain.max(), (k, int(gain.argmax()))
        if where is None:
            return
        k, at = where
        cut, low_high = float(cuts[k][at]), bounds.get(k, (-np.inf, np.inf))
        for side, part in ((True, rows[bins[rows, k] <= at]), (False, rows[bins[rows, k] > at])):
            now = bounds | {k: (low_high[0], min(low_high[1], cut)) if side else (max(low_high[0], cut), low_high[1])}
            out.append((Rule(tuple((f, *v) for f, v in sorted(now.items()))), part, float(target[part].sum() / (weight[part].sum() + 1.0)), left == 1))
            grow(part, now, left - 1)

    grow(np.arange(len(x)), {}, depth)
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 5e-4, rounds: int = 400, seed: int = 7) -> Model:
    """Boosted trees on random halves give the rules; an accelerated proximal gradient fits their lasso weights."""
    n, base = len(y), (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(base / (1 - base)))
    if n < 20 or y.min() == y.max():
        return Model(prior)
    rng, z = np.random.default_rng(seed), np.full(n, prior)
    cuts = _cuts(x)
    bins = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], axis=1)
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        half = np.sort(rng.choice(n, n // 2, replace=False))
        for rule, _, value, leaf in tree_rules(x[half], (y - p)[half], (p * (1 - p))[half], cuts, bins[half], depth, max(5, n // 1000)):
            rules[rule] = None
            if leaf:
                z += 0.3 * np.clip(value, -4, 4) * rule.holds(x)
    kinds, columns = [], {}
    for r in rules:
        column = r.holds(x)
        if 0 < column.sum() < n and columns.setdefault(column.tobytes(), r) is r:
            kinds.append(r)
    if not kinds:
        return Model(prior)
    a = np.stack([r.holds(x) for r in kinds], axis=1).astype(np.float64)
    step = 4 / (np.linalg.norm(np.column_stack([a, np.ones(n)]), 2) ** 2 / n)
    w, b, v, c, t = np.zeros(a.shape[1]), prior, np.zeros(a.shape[1]), prior, 1.0
    for _ in range(rounds):
        r = (1 / (1 + np.exp(-(a @ v + c))) - y) / n
        w2 = v - step * (a.T @ r)
        w2, b2 = np.sign(w2) * np.maximum(np.abs(w2) - step * penalty, 0), c - step * r.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c, w, b, t = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b), w2, b2, t2
    used = np.flatnonzero(np.abs(w) > 1e-6)
    return Model(float(b), tuple(kinds[i] for i in used), tuple(float(w[i]) for i in used))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on about ``sample_rows`` labelled rows, drawn by a hash of the id outside the held-out fifth.

    Only the sample's ids (a bounded list) are broadcast and only its numbers come to the driver. Labels that are null
    or neither 0 nor 1, and null ids, take no part.
    """
    usable = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y")).where(F.col("_y").isin(0, 1) & (id_remainder("_id", HOLD_OUT_MODULUS) != HOLD_OUT)).distinct()
    count = usable.count()
    if not count:
        return Model(0.0)
    share = min(_SAMPLE_BUCKETS, max(1, int(_SAMPLE_BUCKETS * sample_rows / count)))
    sample = usable.where(F.pmod(F.xxhash64("_id"), F.lit(_SAMPLE_BUCKETS)) < share)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_hash"))
    rows = with_statistics(texts.join(F.broadcast(sample), "_id"), "_text")
    # Of an id's several texts always the same one, so that a task that runs again changes nothing.
    own = F.min_by(F.struct(*(f"_{s}" for s in STATISTICS)), "_hash").alias("_s")
    rows = rows.groupBy("_id", "_y").agg(own).select("_id", "_y", "_s.*").orderBy("_id", "_y").collect()
    x = np.array([r[2:] for r in rows], dtype=np.float64).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r["_y"] for r in rows], dtype=np.float64))


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs' other columns (names starting with ``_`` aside) and the score."""
    return with_statistics(docs, text_col).withColumn(out, model.score()).drop(*(f"_{s}" for s in STATISTICS))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) for every row of docs.

    A null text is scored as an empty one. held_out is null for a null id, which is scored all the same. Repeated rows
    each give a row; without any usable label every score is one half. Other columns, whatever their names, are ignored.
    An empty table gives no rows. Of a labelled id's several texts the one of the smallest hash is learned.
    """
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = score(rows, model, "text", "score")
    return out.select(F.col("id").alias(id_col), (id_remainder("id", HOLD_OUT_MODULUS) == HOLD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier accepts, with docs' columns."""
    model = train(docs, labels, id_col, text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index(text_col)]))
    # The row number, always true here, keeps the optimizer from moving the condition below the statistics, where each
    # rule would compute them again.
    kept = score(rows, model, "text", "score").withColumn("row", F.monotonically_increasing_id()).where((F.col("score") >= threshold) & (F.col("row") >= 0))
    return kept.select(*(F.col(a).alias(b) for a, b in zip(names, docs.columns, strict=True)))
