"""Operations on decoded pictures: resize, rotate, crop, threshold, flip, in the given order."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.operators.vectors import to_arrow

# layout of Spark's image source
IMAGE_SCHEMA = T.StructType([
    T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()), T.StructField("mode", T.IntegerType()),
    T.StructField("data", T.BinaryType())])


def resize(image: np.ndarray, width: int | None = None, height: int | None = None, scale: float | None = None) -> np.ndarray:
    """Bilinear resize; one given side keeps the aspect ratio."""
    h, w = image.shape[:2]
    if scale is not None:
        width, height = max(1, round(w * scale)), max(1, round(h * scale))
    if width is None and height is None:
        raise ValueError("resize needs width, height or scale")
    width = width or max(1, round(w * height / h))
    height = height or max(1, round(h * width / w))

    def axis(new: int, old: int):
        at = np.clip((np.arange(new) + 0.5) * old / new - 0.5, 0, old - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, old - 1), at - low

    y0, y1, fy = axis(height, h)
    x0, x1, fx = axis(width, w)
    src = image.astype(np.float64)
    fx, fy = fx[None, :, None], fy[:, None, None]
    top = src[y0][:, x0] * (1 - fx) + src[y0][:, x1] * fx
    low = src[y1][:, x0] * (1 - fx) + src[y1][:, x1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def rotate(image: np.ndarray, angle: float, resize: bool = False) -> np.ndarray:
    """Rotate around the centre; with ``resize`` the canvas grows to hold the whole picture."""
    h, w = image.shape[:2]
    a = math.radians(angle)
    c, s = math.cos(a), math.sin(a)
    nw, nh = (round(abs(w * c) + abs(h * s)), round(abs(w * s) + abs(h * c))) if resize else (w, h)
    y, x = np.mgrid[0:nh, 0:nw]
    dx, dy = x - (nw - 1) / 2, y - (nh - 1) / 2
    sx = np.rint(c * dx - s * dy + (w - 1) / 2).astype(int)
    sy = np.rint(s * dx + c * dy + (h - 1) / 2).astype(int)
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    out = np.zeros((nh, nw, image.shape[2]), np.uint8)
    out[inside] = image[sy[inside], sx[inside]]
    return out


def crop(image: np.ndarray, x: int, y: int, width: int, height: int) -> np.ndarray:
    if x < 0 or y < 0 or width <= 0 or height <= 0:
        raise ValueError("crop needs a box inside the picture")
    return image[y:y + height, x:x + width]


def threshold(image: np.ndarray, value: int) -> np.ndarray:
    """Values up to ``value`` become 0."""
    return np.where(image > value, image, 0).astype(np.uint8)


def flip(image: np.ndarray, code: int) -> np.ndarray:
    """0 turns upside down, a positive code mirrors, a negative one does both."""
    if code == 0:
        return image[::-1]
    return image[:, ::-1] if code > 0 else image[::-1, ::-1]


OPERATIONS: dict[str, Callable[..., np.ndarray]] = {
    "resize": resize, "rotate": rotate, "crop": crop, "threshold": threshold, "flip": flip}


def check_operations(operations: Sequence[Mapping[str, Any]]) -> list[tuple[str, dict]]:
    """Operation list ``[{"type": ..., argument: value}]``; an unknown type is an error."""
    steps = []
    for op in operations:
        kind = str(op.get("type", "")).lower()
        if kind not in OPERATIONS:
            raise ValueError(f"unknown image operation {op.get('type')}")
        steps.append((kind, {k: v for k, v in op.items() if k != "type" and v is not None}))
    return steps


def pixels(image: Mapping[str, Any]) -> np.ndarray:
    """Row of Spark's image source as an array."""
    return np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], image["nChannels"])


def image_operations(df: DataFrame, operations: Sequence[Mapping[str, Any]], image: str = "image") -> DataFrame:
    """H08. Apply the operations in order to an image column (layout of Spark's image source)."""
    steps = check_operations(operations)
    if not steps:
        return df
    rest = [f for f in df.schema.fields if f.name != image]
    schema = T.StructType([*rest, T.StructField(image, IMAGE_SCHEMA)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow(schema)
        for batch in batches:
            out = []
            for value in batch.column(batch.schema.get_field_index(image)).to_pylist():
                if value is None:
                    out.append(None)
                    continue
                p = pixels(value)
                for kind, arguments in steps:
                    p = OPERATIONS[kind](p, **arguments)
                out.append({"height": p.shape[0], "width": p.shape[1], "nChannels": p.shape[2],
                            "mode": value["mode"], "data": np.ascontiguousarray(p).tobytes()})
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, type=target.field(image).type)], schema=target)

    return df.mapInArrow(run, schema)


def embed_images(df: DataFrame, load: Callable[[], Callable[[list], list]], image: str = "image",
                 output: str = "_vector", side: int = 224, batch_size: int = 100) -> DataFrame:
    """H07. Vectors of pictures, each resized to ``side`` x ``side`` inside the same task."""
    from plexus.operators.models import batch_infer

    def wrapped():
        model = load()
        return lambda images: model([resize(pixels(i), side, side) for i in images])

    return batch_infer(df, image, wrapped, {output: T.ArrayType(T.FloatType())}, batch_size).drop(image)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded pictures below a path (PNG, JPEG and others that the JVM reads); bad files are left out."""
    return spark.read.format("image").option("dropInvalid", True).load(path).select(
        F.col("image.origin").alias("url"), F.struct(*[F.col(f"image.{f.name}") for f in IMAGE_SCHEMA.fields]).alias("image"))
