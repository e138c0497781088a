"""Perceptual hashes: distances on hex text, and hashes of pixels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGITS = 8


def halves(hash_hex: Column, parts: int = 2) -> list[Column]:
    """A hex hash as longs of 32 bits, the first digits first."""
    return [F.conv(F.substring(hash_hex, 1 + _DIGITS * i, _DIGITS), 16, 10).cast("long") for i in range(parts)]


def hamming(a: Column, b: Column, digits: int = 16) -> Column:
    """Differing bits of two hex hashes of ``digits`` digits; an error if lengths differ."""
    parts = -(-digits // _DIGITS)
    bits = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(halves(a, parts), halves(b, parts), strict=True)), F.lit(0))
    return F.when(F.length(a) == F.length(b), bits).otherwise(F.raise_error(F.lit("hashes differ in length")).cast("int"))


def _lanczos(n: int, m: int, lobes: int = 3) -> np.ndarray:
    """Weights that resample ``n`` values to ``m``."""
    scale = n / m
    wide = max(scale, 1.0)
    at = (np.arange(m) + 0.5) * scale
    x = (np.arange(n)[None, :] + 0.5 - at[:, None]) / wide
    w = np.where(np.abs(x) < lobes, np.sinc(x) * np.sinc(x / lobes), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def average_hash(pixels: np.ndarray, size: int = 8) -> str:
    """Average hash of grey pixels (rows by columns): a bit for each cell at or above the mean, as hex."""
    small = _lanczos(pixels.shape[0], size) @ pixels.astype(float) @ _lanczos(pixels.shape[1], size).T
    small = np.clip(np.rint(small), 0, 255)
    bits = "".join("1" if v else "0" for v in (small >= small.mean()).ravel())
    return format(int(bits, 2), f"0{size * size // 4}x")


def grey(pixels: np.ndarray) -> np.ndarray:
    """Luma of blue-green-red pixels, as Spark's image reader gives them."""
    return pixels if pixels.ndim == 2 else pixels[..., :3] @ np.array([0.114, 0.587, 0.299])


def hash_images(images: DataFrame, size: int = 8) -> DataFrame:
    """``(path, perceptual_hash)`` of images read by Spark's image source; null for unreadable ones."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for r in frame.itertuples():
                if r.height > 0 and r.width > 0:
                    data = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, -1)
                    found.append(average_hash(grey(data if data.shape[2] > 1 else data[..., 0]), size))
                else:
                    found.append(None)
            yield pd.DataFrame({"path": frame["path"], "perceptual_hash": found})

    flat = images.select(F.col("image.origin").alias("path"), "image.height", "image.width", "image.data")
    return flat.mapInPandas(run, "path string, perceptual_hash string")
