"""Models over batches of rows. Models are plain callables ``list of inputs -> list of outputs``.

No weights are bundled. The two stand-ins are deterministic and named for what they do.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.scalars import box_floor, box_rescale
from plexus.operators.constraints import confidence_filter
from plexus.operators.segments import derived_edges
from plexus.operators.vectors import to_arrow
from plexus.session import materialise
from plexus.types import DST, ID, SRC

Model = Callable[[list], list]

# The sentence whose vector identifies a model.
FINGERPRINT_TEXT = "The quick brown fox jumps over the lazy dog"


def hashed_words(dimensions: int = 64, cancelled: str = "count") -> Callable[[], Model]:
    """Text stand-in: signed feature hashing of lower-case tokens, length 1; zero for a text without tokens.

    Where the signs of a text's tokens cancel in all places there is nothing to scale: such a text gets the vector of its tokens
    without signs (``count``), or not-a-number in the places of its tokens (``nan``), which is what the division gives.
    """
    def load() -> Model:
        from plexus.functions.text import TOKEN_PATTERN
        import regex
        find = regex.compile(TOKEN_PATTERN).findall

        @lru_cache(maxsize=200_000)
        def slot(token: str) -> tuple[int, float]:
            number = int(hashlib.md5(token.encode()).hexdigest()[:8], 16)
            return number % dimensions, 1.0 if (number // dimensions) % 2 == 0 else -1.0

        def run(texts: list) -> list:
            out = []
            for text in texts:
                v, places = np.zeros(dimensions), []
                for token in find((text or "").lower()):
                    i, sign = slot(token)
                    v[i] += sign
                    places.append(i)
                if places and not v.any():
                    np.add.at(v, places, 1.0 if cancelled == "count" else np.nan)
                n = np.linalg.norm(v) if cancelled == "count" or not np.isnan(v).any() else 0.0
                out.append(v / n if n else v)
            return out
        return run
    return load


def colour_histogram(bins: int = 4) -> Callable[[], Model]:
    """Image stand-in: joint histogram of the channels of a height x width x channels array, length 1."""
    def load() -> Model:
        def run(images: list) -> list:
            out = []
            for image in images:
                pixels = image.reshape(-1, image.shape[-1]).astype(np.int64) * bins // 256
                if pixels.shape[1] == 1:
                    pixels = np.repeat(pixels, 3, axis=1)
                index = (pixels[:, 0] * bins + pixels[:, 1]) * bins + pixels[:, 2]
                v = np.bincount(index, minlength=bins ** 3).astype(np.float64)
                n = np.linalg.norm(v)
                out.append(v / n if n else v)
            return out
        return run
    return load


def embed_texts(df: DataFrame, text: str, load: Callable[[], Model], output: str = "_vector",
                batch_size: int = 100) -> DataFrame:
    """H06. Add the vector of a text column. The model is loaded once per task and fed in batches."""
    return batch_infer(df, text, load, {output: T.ArrayType(T.FloatType())}, batch_size)


def batch_infer(df: DataFrame, column: str | Sequence[str], load: Callable[[], Model],
                outputs: Mapping[str, T.DataType], batch_size: int = 100) -> DataFrame:
    """H11. Run a model over rows and add its outputs as columns.

    With one output column the model returns values, with several it returns tuples. A list of
    input columns reaches the model as tuples.
    """
    columns = [column] if isinstance(column, str) else list(column)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in outputs.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, target = load(), to_arrow(schema)
        for whole in batches:
            for at in range(0, whole.num_rows, batch_size):
                batch = whole.slice(at, batch_size)
                values = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
                results = model(values[0] if len(values) == 1 else list(zip(*values)))
                if len(results) != batch.num_rows:
                    raise ValueError("a model must return one result per input")
                made = [results] if len(outputs) == 1 else list(zip(*results))
                arrays = [pa.array([v.tolist() if isinstance(v, np.ndarray) else v for v in m], type=target.field(n).type)
                          for n, m in zip(outputs, made)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], schema=target)

    return df.mapInArrow(run, schema)


def register_model(registry: DataFrame, name: str, dimensions: int, provider: str, model: str,
                   pretrained: str | None, load: Callable[[], Model], metric: str = "CS",
                   clean: bool = False) -> DataFrame:
    """H09. Find or create a vector set in the registry and check that it names the same model.

    NULL model properties of an existing set are filled in, different ones are an error; ``clean``
    replaces the set. The fingerprint is the SHA-256 of the model's vector of a fixed sentence.
    The registry holds one row per vector set.
    """
    spark = registry.sparkSession
    vector = np.asarray(load()([FINGERPRINT_TEXT])[0], dtype="<f4")
    if len(vector) != dimensions:
        raise ValueError(f"model gives {len(vector)} dimensions, not {dimensions}")
    mark = hashlib.sha256(vector.tobytes()).hexdigest()
    wanted = {"provider": provider, "model": model, "pretrained": pretrained, "metric": metric, "fingerprint": mark}
    existing = None if clean else registry.where(F.col("name") == name).first()
    if existing is None:
        row = spark.createDataFrame([(name, dimensions, metric, provider, model, pretrained, mark)], REGISTRY_SCHEMA)
        return registry.where(~F.col("name").eqNullSafe(F.lit(name))).unionByName(row)
    if existing["dimensions"] != dimensions:
        raise ValueError(f"set {name} has {existing['dimensions']} dimensions, not {dimensions}")
    for key, value in wanted.items():
        if value is not None and existing[key] is not None and existing[key] != value:
            raise ValueError(f"set {name}: {key} is {existing[key]}, not {value}")
    here = F.col("name") == name
    return registry.withColumns({k: F.when(here, F.coalesce(F.col(k), F.lit(v))).otherwise(F.col(k))
                                 for k, v in wanted.items() if v is not None})


REGISTRY_SCHEMA = ("name string, dimensions int, metric string, provider string, model string, pretrained string, "
                   "fingerprint string")


def detections_to_boxes(detections: DataFrame, image_id: str, classes: DataFrame | None, source: str,
                        threshold: float = 0.7, scale: float = 0.5) -> DataFrame:
    """H12. Arrays ``scores, boxes, labels`` to one row per kept box with class name and model tag.

    ``boxes`` holds corner boxes in the scaled picture. With ``classes`` (label, name) names come
    from the table, which is as small as the model's label list; without it the label is ``face``
    and coordinates are floored at 0.
    """
    rows = detections.select(image_id, F.posexplode(F.arrays_zip("scores", "boxes", "labels")).alias("box_index", "d")).select(
        image_id, "box_index", F.col("d.scores").alias("score"), F.col("d.boxes").alias("box"), F.col("d.labels").alias("label"))
    rows = confidence_filter(rows, threshold)
    corner = [F.get("box", F.lit(i)) for i in range(4)]
    if classes is None:
        placed = rows.select(image_id, "box_index", F.lit("face").alias("label"), box_floor(corner[0]).alias("x"),
                             box_floor(corner[1]).alias("y"), (corner[2] - corner[0]).cast("int").alias("width"),
                             (corner[3] - corner[1]).cast("int").alias("height"), "score")
    else:
        named = rows.join(classes.select("label", F.col("name").alias("_name")), "label")
        placed = named.select(image_id, "box_index", F.col("_name").alias("label"),
                              box_rescale(*corner, scale=scale).alias("r"), "score").select(
            image_id, "box_index", "label", "r.*", "score")
    return placed.withColumns({"model": F.lit(source), ID: F.sha1(F.concat_ws("/", F.lit(source), F.col(image_id), F.col("box_index")))})


@dataclass
class FaceTables:
    boxes: DataFrame
    vectors: DataFrame
    edges: DataFrame
    done: DataFrame


def face_vectors(images: DataFrame, image_id: str, load: Callable[[], Model], source: str, *, image: str = "image", threshold: float = 0.7,
                 batch_size: int = 100) -> FaceTables:
    """H12. Boxes of the faces kept, a vector of each face's pixels, edges image to box and box to vector, and the images done.

    ``images`` has the picture, ``scores`` and corner ``boxes``. A picture is cut where it lies: the crops of all pictures of a
    batch go to the model together, ``batch_size`` at a time, and what comes back is folded into one row per picture again, so no
    picture is copied per face. A box that lies outside its picture has no pixels and no vector. Images without a face are done too.
    """
    kept = F.filter(F.transform(F.arrays_zip("scores", "boxes"), lambda d, i: F.struct(i.alias("box_index"), d["scores"].alias("score"), d["boxes"].alias("box"))),
                    lambda d: d["score"] >= threshold)
    found = images.select(image_id, image, F.coalesce(kept, F.array()).alias("kept"))
    vector = T.ArrayType(T.FloatType())
    schema = T.StructType([images.schema[image_id], T.StructField("kept", found.schema["kept"].dataType), T.StructField("vectors", T.ArrayType(vector))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from plexus.operators.images import pixels
        model, target = load(), to_arrow(schema)
        for batch in batches:
            crops, owners = [], []
            lists = batch.column(2).to_pylist()
            out: list[list] = [[None] * len(own) for own in lists]
            for k, (picture, own) in enumerate(zip(batch.column(1), lists, strict=True)):
                whole = pixels(picture.as_py()) if own and picture.is_valid else None
                for j, face in enumerate(own if whole is not None else []):
                    x0, y0, x1, y1 = (max(0, math.floor(v)) for v in face["box"])
                    part = whole[y0:y1, x0:x1]
                    if part.size:
                        crops.append(part)
                        owners.append((k, j))
            for at in range(0, len(crops), batch_size):
                for (k, j), v in zip(owners[at:at + batch_size], model(crops[at:at + batch_size]), strict=True):
                    out[k][j] = [float(x) for x in v]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, target.field("vectors").type)], schema=target)

    # read by four tables; the model runs once
    faces = materialise(found.mapInArrow(run, schema), "faces")
    key = F.sha1(F.concat_ws("/", F.lit(source), F.col(image_id), F.col("d.kept.box_index")))
    rows = faces.select(image_id, F.explode(F.arrays_zip("kept", "vectors")).alias("d")).select(
        image_id, F.col("d.kept.box_index").alias("box_index"), F.col("d.kept.score").alias("score"), F.col("d.kept.box").alias("box"), F.col("d.vectors").alias("_vector"), key.alias(ID))
    corner = [F.get("box", F.lit(i)) for i in range(4)]
    boxes = rows.select(image_id, "box_index", F.lit("face").alias("label"), box_floor(corner[0]).alias("x"), box_floor(corner[1]).alias("y"),
                        (corner[2] - corner[0]).cast("int").alias("width"), (corner[3] - corner[1]).cast("int").alias("height"), "score", F.lit(source).alias("model"), ID)
    vectors = rows.where("_vector IS NOT NULL").select(F.sha1(F.concat_ws("/", F.lit("vector"), F.col(ID))).alias("_new"), F.col(ID).alias("box_id"), "_vector").select(
        F.col("_new").alias(ID), "box_id", "_vector", F.lit(source).alias("set"))
    edges = (derived_edges(boxes, image_id, "imageHasBox")
             .unionByName(derived_edges(vectors, "box_id", "boxHasVector")))
    done = faces.select(image_id, F.size("kept").alias("n_faces"), F.lit(True).alias(f"{source}_done"))
    return FaceTables(boxes, vectors, edges, done)


def needs_ocr(documents: DataFrame, pages: DataFrame, key: str, text: str = "text") -> DataFrame:
    """H14. Documents without any page text."""
    texted = pages.where(F.length(F.trim(F.coalesce(text, F.lit("")))) > 0).select(key).distinct()
    return documents.join(texted, key, "left_anti")


def embedding_rows(segments: DataFrame, load: Callable[[], Model], set_name: str, spec_id: str, run_id: str) -> DataFrame:
    """I17. One vector row per segment, with what retrieval needs beside it."""
    rows = segments.select(F.sha1(F.concat_ws("/", F.lit(run_id), F.col(ID))).alias("_new"), F.col(ID).alias("segment_id"),
                           "text", "url", F.col("url").alias("lc_url"), "title").withColumnRenamed("_new", ID)
    return embed_texts(rows, "text", load).withColumns(
        {"set": F.lit(set_name), "spec_id": F.lit(spec_id), "run_id": F.lit(run_id)})


def embedding_edges(rows: DataFrame) -> DataFrame:
    """I17. Edges segment to vector and run to vector."""
    return derived_edges(rows, "segment_id", "segmentHasEmbedding").unionByName(
        derived_edges(rows, "run_id", "runHasEmbedding"))


def video_frames_to_vectors(clips: DataFrame, frames: DataFrame, load: Callable[[], Model], video: str = "video",
                            frame: str = "frame", image: str = "image", batch_size: int = 250) -> DataFrame:
    """H13. Vectors of the sampled frames: each clip takes the frame it starts at.

    Frames are joined on (video, frame number), so a long video spreads over all tasks.
    """
    picked = clips.select(video, "clip", "start", "stop").join(
        frames.select(video, F.col(frame).alias("start"), image), [video, "start"])
    return batch_infer(picked, image, load, {"_vector": T.ArrayType(T.FloatType())}, batch_size).drop(image).withColumn(
        ID, F.sha1(F.concat_ws("/", F.lit("clip"), F.col(video), F.col("clip"))))


def video_edges(vectors: DataFrame, video: str = "video") -> DataFrame:
    """H13. Edges clip to vector, and video to vector with the frame range."""
    clip_id = F.concat_ws(":", F.col(video), F.col("clip"))
    none = F.lit(None).cast("bigint")
    return (vectors.select(clip_id.alias(SRC), F.col(ID).alias(DST), F.lit("ClipHasDescriptor").alias("class"),
                           none.alias("start"), none.alias("stop"))
            .unionByName(vectors.select(F.col(video).cast("string").alias(SRC), F.col(ID).alias(DST),
                                        F.lit("VideoHasDescriptor").alias("class"), "start", "stop")))

