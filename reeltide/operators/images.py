"""Perceptual hashes of decoded images.

Spark's own image reader decodes JPEG, PNG, BMP and GIF files; binary PGM files are decoded here. Pixels are 8-bit grey values row by row; the resize to 9 x 8 is a Lanczos-3
filter over NumPy arrays in Arrow batches, and bit y * 8 + x is set where a pixel is brighter than the one to its right.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.sources.sinks import exists


@lru_cache(256)
def _weights(size: int, to: int) -> np.ndarray:
    """The (to, size) matrix of a Lanczos-3 resize, widened when it shrinks."""
    ratio = size / to
    scale = max(ratio, 1.0)
    centre = (np.arange(to) + 0.5) * ratio
    x = (np.arange(size)[None, :] + 0.5 - centre[:, None]) / scale
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(1, keepdims=True)


def resize(pixels: np.ndarray, width: int = 9, height: int = 8) -> np.ndarray:
    grey = _weights(pixels.shape[0], height) @ pixels.astype(float) @ _weights(pixels.shape[1], width).T
    return np.clip(np.rint(grey), 0, 255).astype(np.uint8)


def hash_of(pixels: np.ndarray) -> int:
    """The 64 bits as a signed number."""
    small = resize(pixels)
    bits = np.packbits((small[:, :-1] > small[:, 1:]).ravel(), bitorder="little")
    return int(bits.view(np.int64)[0])


def decode_pgm(data: bytes) -> np.ndarray:
    """An 8-bit binary grey map; other data raises ValueError."""
    m = re.match(rb"P5\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+255\s", data)
    if not m or int(m[1]) * int(m[2]) > len(data) - m.end() or not int(m[1]) * int(m[2]):
        raise ValueError("not an 8-bit binary grey map")
    return np.frombuffer(data, np.uint8, int(m[1]) * int(m[2]), m.end()).reshape(int(m[2]), int(m[1]))


def _hash(content: pd.Series) -> pd.Series:
    def one(data: bytes | None) -> int | None:
        try:
            return None if data is None else hash_of(decode_pgm(data))
        except ValueError:
            return None

    return pd.Series([one(x) for x in content], dtype="Int64")


def image_hash(content: Column) -> Column:
    """The hash of each image's bytes; null where they can't be decoded."""
    return F.pandas_udf(_hash, "long")(content)


#: What red, green and blue weigh in a grey value, in ten-thousandths.
LUMA = (2126, 7152, 722)


def _hash_pixels(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.Series:
    def one(pixels: bytes, h: int, w: int, c: int) -> int | None:
        if h <= 0 or w <= 0 or len(pixels) != h * w * c:
            return None
        x = np.frombuffer(pixels, np.uint8).reshape(h, w, c)
        if c < 3:
            return hash_of(x[:, :, 0])
        blue, green, red = (x[:, :, i].astype(np.uint32) for i in range(3))  # the reader's order
        return hash_of(((red * LUMA[0] + green * LUMA[1] + blue * LUMA[2]) // sum(LUMA)).astype(np.uint8))

    return pd.Series([one(*x) for x in zip(data, height, width, channels, strict=True)], dtype="Int64")


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """(path, hash) of all images below a folder that can be decoded."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "path string, hash long")
    i = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "true").load(folder).select("image.*")
    path = F.url_decode(F.regexp_replace(F.regexp_replace("origin", "^file:/*", "/"), r"\+", "%2B"))
    return i.select(path.alias("path"), F.pandas_udf(_hash_pixels, "long")("data", "height", "width", "nChannels").alias("hash"))
