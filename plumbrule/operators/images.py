"""Screening and preparing image files as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbrule.constants import (
    ALLOWED_IMAGE_FORMATS,
    IMAGE_SIDE,
    IMAGE_SIGNATURES,
    PIXEL_MAX,
)
from plumbrule.functions.columns import ColumnOrName, column
from plumbrule.operators.splitting import row_positions
from plumbrule.workspace import BROADCAST_ROWS, broadcast_if_small

# Bytes of prepared pixels in one frame.
FRAME_BYTES = 16 << 20


def image_format(content: ColumnOrName) -> Column:
    """Format told by the leading bytes, whatever the file is called; NULL if none is known."""
    longest = max(len(mark) for _, marks in IMAGE_SIGNATURES for mark in marks) // 2
    head = F.hex(F.substring(column(content), 1, longest))
    detected = None
    for name, marks in IMAGE_SIGNATURES:
        for mark in marks:
            starts = head.startswith(mark)
            detected = F.when(starts, name) if detected is None else detected.when(starts, name)
    return detected


def screen_images(
    files: DataFrame,
    content: str = "content",
    allowed: Sequence[str] = ALLOWED_IMAGE_FORMATS,
) -> DataFrame:
    """`files` with the detected `image_format` and the `reason` to set a file aside (NULL to keep it)."""
    detected = files.withColumn("image_format", image_format(content))
    reason = F.when(F.col("image_format").isNull(), "unknown format").when(
        ~F.col("image_format").isin(*allowed), F.concat(F.lit("format not allowed: "), F.col("image_format"))
    )
    return detected.withColumn("reason", reason)


def image_allowlist(files: DataFrame, content: str = "content") -> DataFrame:
    """Files of an allowed format. Nothing is deleted."""
    return screen_images(files, content).where(F.col("reason").isNull()).drop("reason")


def image_quarantine(files: DataFrame, content: str = "content") -> DataFrame:
    """Files set aside, with the reason."""
    return screen_images(files, content).where(F.col("reason").isNotNull())


def class_index(df: DataFrame, class_column: str) -> DataFrame:
    """`df` with `label`: the place of its class among the sorted class names.

    The class list is broadcast if it was counted to be short, as it is for any
    real set of classes; a long one is joined by a shuffle.
    """
    names = df.select(column(class_column)).where(column(class_column).isNotNull()).distinct()
    positions = row_positions(names, class_column)
    labels = positions.frame.withColumn("label", F.col("row_index").cast("int")).drop("row_index")
    if positions.rows <= BROADCAST_ROWS:
        labels = F.broadcast(labels)
    return df.join(labels, class_column, "left")


def scale_values(values: ColumnOrName, largest: float = PIXEL_MAX) -> Column:
    """Every element divided by the largest possible value."""
    return F.transform(column(values), lambda x: x.cast("double") / F.lit(float(largest)))


def value_min(values: ColumnOrName) -> Column:
    """Smallest element of an array."""
    return F.array_min(column(values))


def without_rejected(images: DataFrame, rejected: DataFrame, path: str = "path") -> DataFrame:
    """Images whose path is not among the rejected files."""
    paths = rejected.select(path)
    return images.join(broadcast_if_small(paths), path, "left_anti")


def image_prepare(
    images: DataFrame,
    keep: Sequence[str] = ("path",),
    image: str = "image",
    side: int = IMAGE_SIDE,
    rounded: bool = False,
) -> DataFrame:
    """Decoded images as `pixels`: resized to side x side, RGB, scaled to [0, 1], row by row.

    `image` is a column of Spark's image schema, which decodes in the JVM and holds BGR
    bytes. Resizing is bilinear with pixel centres at half steps. `rounded` rounds
    to whole pixel values before scaling. One image is prepared at a time; prepared images are
    handed back in frames of about `FRAME_BYTES`.
    """
    keep = tuple(keep)
    parts = [F.col(f"{image}.{name}").alias(f"__{name}") for name in ("height", "width", "nChannels", "data")]
    flat = images.select(*keep, *parts)
    kept_fields = [flat.schema[name] for name in keep]

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Self-contained, so that workers need nothing but numpy and pandas.
        import numpy as np
        import pandas as pd

        def edges(size: int):
            at = np.clip((np.arange(side) + 0.5) * size / side - 0.5, 0, size - 1)
            low = np.floor(at).astype(int)
            return low, np.minimum(low + 1, size - 1), at - low

        ready = []
        for batch in batches:
            for row in batch.to_dict("records"):
                height, width, channels = row.pop("__height"), row.pop("__width"), row.pop("__nChannels")
                bgr = np.frombuffer(row.pop("__data"), dtype=np.uint8).reshape(height, width, channels)
                bgr = np.repeat(bgr, 3, axis=2) if channels == 1 else bgr[:, :, :3]
                rgb = bgr[:, :, ::-1].astype(np.float64)
                top, bottom, down = edges(height)
                left, right, across = edges(width)
                across = across[None, :, None]
                upper = rgb[top][:, left] * (1 - across) + rgb[top][:, right] * across
                lower = rgb[bottom][:, left] * (1 - across) + rgb[bottom][:, right] * across
                resized = upper * (1 - down[:, None, None]) + lower * down[:, None, None]
                if rounded:
                    resized = np.rint(resized)
                ready.append({**row, "pixels": (resized / 255.0).ravel()})
                if len(ready) * side * side * 3 * 8 >= FRAME_BYTES:
                    yield pd.DataFrame(ready)
                    ready = []
        if ready:
            yield pd.DataFrame(ready)

    from pyspark.sql import types as T

    schema = T.StructType([*kept_fields, T.StructField("pixels", T.ArrayType(T.DoubleType()))])
    return flat.mapInPandas(prepare, schema)
