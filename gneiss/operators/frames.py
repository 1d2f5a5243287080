"""Frames as pixel arrays: input checks and features. Decoding is left to the source; rows carry height, width and RGB bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Limits of the input checks: smaller side, mean brightness, contrast, gradient energy, share of saturated pixels.
LIMITS = {"min_side": 224, "min_brightness": 30.0, "max_brightness": 225.0, "min_contrast": 12.0, "min_sharpness": 20.0, "max_glare": 0.15}
GRID = 4


def _pixels(row) -> np.ndarray:
    return np.frombuffer(row.pixels, np.uint8).reshape(row.height, row.width, 3)


def _gray(image: np.ndarray) -> np.ndarray:
    return image @ np.array([0.299, 0.587, 0.114])


def measures(image: np.ndarray) -> dict[str, float]:
    """side, brightness, contrast, sharpness (variance of the Laplacian) and glare of a frame."""
    g = _gray(image)
    inner = 4 * g[1:-1, 1:-1] - g[:-2, 1:-1] - g[2:, 1:-1] - g[1:-1, :-2] - g[1:-1, 2:]
    return {"side": float(min(g.shape)), "brightness": float(g.mean()), "contrast": float(g.std()), "sharpness": float(inner.var()) if inner.size else 0.0, "glare": float((g >= 250).mean())}


def features(image: np.ndarray) -> np.ndarray:
    """49 numbers: hue (16), saturation and value (8 each) histograms, rust shares of a 4 x 4 grid (the largest 8), moments, gradients."""
    x = image.astype(np.float64) / 255
    top, low = x.max(axis=2), x.min(axis=2)
    span = np.maximum(top - low, 1e-9)
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    hue = np.select([top == r, top == g], [((g - b) / span) % 6, (b - r) / span + 2], (r - g) / span + 4) / 6
    hue = np.where(top - low < 1e-9, 0, hue)
    saturation = np.where(top > 0, (top - low) / np.maximum(top, 1e-9), 0)
    rust = (hue < 0.12) & (saturation > 0.35) & (top > 0.15)
    share = lambda v, bins: np.histogram(v, bins=bins, range=(0, 1))[0] / v.size
    cells = np.sort([c.mean() if c.size else 0.0 for band in np.array_split(rust, GRID) for c in np.array_split(band, GRID, axis=1)])[::-1][:8]
    gray = _gray(image)
    dy, dx = np.gradient(gray) if min(gray.shape) > 1 else (np.zeros_like(gray),) * 2
    energy = np.hypot(dx, dy)
    moments = [rust.mean(), gray.mean() / 255, gray.std() / 255, saturation.mean(), saturation.std()]
    return np.concatenate([share(hue, 16), share(saturation, 8), share(top, 8), cells, moments, [energy.mean() / 255, energy.std() / 255, np.quantile(energy, 0.9) / 255, (energy > 30).mean()]]).astype(np.float32)


def frame_rows(frames: DataFrame, key: str) -> DataFrame:
    """(key, the measures, features array<float>) of frames (key, height, width, pixels)."""
    kind = dict(frames.dtypes)[key]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for row in part.itertuples(index=False):
                image = _pixels(row)
                rows.append({key: getattr(row, key), **measures(image), "features": features(image)})
            yield pd.DataFrame(rows, columns=[key, "side", "brightness", "contrast", "sharpness", "glare", "features"])

    return frames.select(key, "height", "width", "pixels").mapInPandas(run, f"{key} {kind}, side double, brightness double, contrast double, sharpness double, glare double, features array<float>")


def frame_checks(rows: DataFrame, limits: dict = LIMITS) -> DataFrame:  # noqa: B006
    """Adds failed_checks: TOO_SMALL, TOO_DARK, TOO_BRIGHT, LOW_CONTRAST, BLURRED, GLARE."""
    codes = [
        F.when(F.col("side") < limits["min_side"], "TOO_SMALL"), F.when(F.col("brightness") < limits["min_brightness"], "TOO_DARK"), F.when(F.col("brightness") > limits["max_brightness"], "TOO_BRIGHT"),
        F.when(F.col("contrast") < limits["min_contrast"], "LOW_CONTRAST"), F.when(F.col("sharpness") < limits["min_sharpness"], "BLURRED"), F.when(F.col("glare") > limits["max_glare"], "GLARE"),
    ]
    return rows.withColumn("failed_checks", F.array_compact(F.array(*codes)))


def linear_scores(rows: DataFrame, weights: np.ndarray, intercept: float, vector: str = "features") -> DataFrame:
    """Logistic scores of a small linear model; the weights (one per component) are literals of the expression."""
    products = F.zip_with(vector, F.array(*(F.lit(float(w)) for w in weights)), lambda a, b: a * b)
    z = F.aggregate(products, F.lit(float(intercept)), lambda s, x: s + x)
    return rows.withColumn("p_severe", 1 / (1 + F.exp(-z)))


def feedback(labels: DataFrame, test_frames: DataFrame, key: str, at: str) -> DataFrame:
    """The newest label of each frame, frames of the test set left out."""
    w = Window.partitionBy(key).orderBy(F.desc(at))
    newest = labels.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return newest.join(test_frames.select(key).distinct(), key, "left_anti")
