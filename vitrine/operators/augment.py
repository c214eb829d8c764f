"""Image augmentation: resize to the model's input size, random scale, crop, flip, brightness.

Every random choice is a seeded hash of the draw id (reproducible, recomputable by any task).
An image of any size is resized (bilinear) to ``scale`` times the model's input size, a window
of the input size is cut out of that at a random place, flipped from left to right by a coin
and multiplied by a random brightness. The choices are columns; the pixels are computed in
NumPy, all images of one size and target in an Arrow batch together, ``CHUNK_BYTES`` at a time.

Images are tensors, a struct (height, width, channels, data): data has the values by row, column and channel
as little-endian bytes (one a value: 0 to 255; four or eight: floating point). They are read from and
written to Arrow's own buffers; no list is made of them. ``pack`` and ``values`` go from and to flat
arrays, and only reinterpret the buffers. An augmented image has eight bytes a value. Nested arrays, rows x columns
(x channels), are taken too (``augment_images``).
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import uniform16, uniform_unit
from ..session import ship_package


@dataclass(frozen=True)
class Augmentation:
    """How training images vary, in percent, and the size they must have in the end."""

    height: int
    width: int
    flip: bool = False
    crop: float = 0                           # how much larger than needed before the crop
    scale: float = 0                          # how much larger still, at random
    brightness: float = 0

    @property
    def varies(self) -> bool:
        """Whether two draws of an image can differ; vectors of such images are not cached."""
        return self.flip or any((self.crop, self.scale, self.brightness))


def augment_params(df: DataFrame, draw_col: str, seed: str, how: Augmentation) -> DataFrame:
    """Adds scale, scaled_h, scaled_w, crop_y, crop_x, flip and brightness.

    scale = (1 + crop/100) * U(1, 1 + scale/100), of the model's size; the crop offsets are
    uniform over the places a window of the model's size has in the scaled image; brightness
    is U(1 - b/100, 1 + b/100)."""
    d = F.col(draw_col)
    scale = (F.lit(1.0 + how.crop / 100.0)
             * (F.lit(1.0) + F.lit(how.scale / 100.0) * uniform_unit(seed, d, "scale")))
    out = df.withColumn("scale", scale)
    for name, size in (("h", how.height), ("w", how.width)):
        out = out.withColumn(f"scaled_{name}", F.floor(F.col("scale") * F.lit(float(size))).cast("int"))
    for name, size, scaled in (("y", how.height, "scaled_h"), ("x", how.width, "scaled_w")):
        out = out.withColumn(f"crop_{name}", F.pmod(uniform16(seed, d, f"crop_{name}"),
                                                    F.col(scaled) - F.lit(size) + 1).cast("int"))
    bright = (F.lit(1.0 - how.brightness / 100.0)
              + F.lit(2.0 * how.brightness / 100.0) * uniform_unit(seed, d, "brightness"))
    return (out.withColumn("flip", (uniform_unit(seed, d, "flip") < F.lit(0.5)) if how.flip else F.lit(False))
            .withColumn("brightness", bright))


def resize_bilinear(images: np.ndarray, out_h: int, out_w: int) -> np.ndarray:
    """Bilinear resize of (images, rows, columns, channels), corners not aligned:
    source = dest * (in / out)."""
    in_h, in_w = images.shape[1:3]
    ys = np.arange(out_h) * (in_h / out_h)
    xs = np.arange(out_w) * (in_w / out_w)
    y0, x0 = np.floor(ys).astype(int), np.floor(xs).astype(int)
    y1, x1 = np.minimum(y0 + 1, in_h - 1), np.minimum(x0 + 1, in_w - 1)
    dy, dx = (ys - y0)[:, None, None], (xs - x0)[None, :, None]
    upper, lower = images[:, y0], images[:, y1]
    top = upper[:, :, x0] * (1 - dx) + upper[:, :, x1] * dx
    bottom = lower[:, :, x0] * (1 - dx) + lower[:, :, x1] * dx
    return top * (1 - dy) + bottom * dy


def augmented(images: np.ndarray, scaled_h: int, scaled_w: int, crop_y: np.ndarray, crop_x: np.ndarray,
              flip: np.ndarray, brightness: np.ndarray, height: int, width: int) -> np.ndarray:
    """Images of one size that are scaled to one size, each with its own crop, flip and brightness."""
    scaled = resize_bilinear(images, scaled_h, scaled_w)
    columns = np.where(flip[:, None], np.arange(width)[::-1], np.arange(width)) + crop_x[:, None]
    rows = np.arange(height) + crop_y[:, None]
    cut = scaled[np.arange(len(scaled))[:, None, None], rows[:, :, None], columns[:, None, :]]
    return cut * brightness[:, None, None, None]


PARAMS = ["scaled_h", "scaled_w", "crop_y", "crop_x", "flip", "brightness"]
TENSOR = "struct<height:int,width:int,channels:int,data:binary>"
DTYPES = {1: "u1", 4: "<f4", 8: "<f8"}       # by bytes a value
CHUNK_BYTES = 32 << 20                       # of resized images held at once


def pack(flat: Column | str, height: Column, width: Column, channels: Column) -> Column:
    """A tensor of a flat array<float> or array<double>, whose buffer becomes the tensor's; NULL for a NULL array. A
    number of values that the shape doesn't have fails the job."""
    @F.arrow_udf(TENSOR)
    def tensor(values: pa.Array, h: pa.Array, w: pa.Array, c: pa.Array) -> pa.Array:
        size = values.type.value_type.bit_width // 8
        offsets = values.offsets.to_numpy()
        shape = h.to_numpy().astype(np.int64) * w.to_numpy() * c.to_numpy()
        known = values.is_valid().to_numpy(zero_copy_only=False)
        if (np.diff(offsets)[known] != shape[known]).any():
            raise ValueError("an array without the values of its shape")
        if values.values.null_count:
            raise ValueError("a NULL among the values of an image")
        inner = values.values
        data = pa.Array.from_buffers(pa.large_binary(), len(values), [
            None, pa.py_buffer((offsets.astype(np.int64) + inner.offset) * size), inner.buffers()[1] or pa.py_buffer(b"")])
        return pa.StructArray.from_arrays([h.cast(pa.int32()), w.cast(pa.int32()), c.cast(pa.int32()), data.cast(pa.binary())],
                                          names=["height", "width", "channels", "data"], mask=pa.array(~known))

    return tensor(flat, height, width, channels)


def values(tensor: Column | str) -> Column:
    """The values of tensors with eight bytes a value (augmented ones) as a flat array<double>; NULL for NULL."""
    @F.arrow_udf("array<double>")
    def flat(tensors: pa.Array) -> pa.Array:
        data = tensors.field(3).cast(pa.large_binary())
        starts = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, 8 * data.offset) if len(data) else np.zeros(1, np.int64)
        body = data.buffers()[2]
        inner = pa.Array.from_buffers(pa.float64(), int(starts[-1] - starts[0]) // 8, [None, body.slice(int(starts[0]))] if body else [None, pa.py_buffer(b"")])
        known = tensors.is_valid().to_numpy(zero_copy_only=False)
        return pa.ListArray.from_arrays(pa.array(((starts - starts[0]) // 8).astype(np.int32)), inner, mask=pa.array(~known))

    return flat(tensor)


def augment_tensors(df: DataFrame, tensor_col: str, how: Augmentation, out_col: str = "augmented",
                    keep_cols: list[str] | None = None) -> DataFrame:
    """``keep_cols`` (default: all but the image) and the augmented tensor of each row that ``augment_params`` has
    prepared. A NULL image, or one without values, stays NULL."""
    ship_package(df.sparkSession)
    keep = [c for c in (df.columns if keep_cols is None else keep_cols) if c not in (tensor_col, out_col)]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out_col, T.StructType.fromDDL(TENSOR[7:-1]))])
    size = how.height * how.width * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            own = column[tensor_col]
            h, w, c = (own.field(i).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            p = {n: column[n].to_numpy(zero_copy_only=False) for n in PARAMS}
            data = own.field(3)
            known = (own.is_valid().to_numpy(zero_copy_only=False) & data.is_valid().to_numpy(zero_copy_only=False) & (h * w * c > 0))
            buffers = [memoryview(data[i].as_buffer()) if known[i] else b"" for i in range(len(own))]
            groups: dict[tuple, list[int]] = {}
            for i in np.flatnonzero(known):
                key = (h[i], w[i], c[i], len(buffers[i]) // (h[i] * w[i] * c[i]), p["scaled_h"][i], p["scaled_w"][i])
                groups.setdefault(key, []).append(i)
            # rows as they are, the images of each where its row's turn is
            ends = np.cumsum(np.where(known, size * c, 0))
            out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
            for (rows, columns, channels, width, sh, sw), at in groups.items():
                step = max(1, CHUNK_BYTES // int(8 * sh * sw * channels))
                for low in range(0, len(at), step):
                    some = at[low:low + step]
                    block = np.stack([np.frombuffer(buffers[i], DTYPES[int(width)], rows * columns * channels) for i in some])
                    done = augmented(block.reshape(len(some), rows, columns, channels).astype(np.float64), int(sh), int(sw),
                                     *[p[n][some] for n in PARAMS[2:]], how.height, how.width)
                    for i, image in zip(some, done):
                        out[ends[i] - size * channels:ends[i]] = np.ascontiguousarray(image, "<f8").reshape(-1).view(np.uint8)
            offsets = np.concatenate([[0], ends]).astype(np.int64)
            body = pa.Array.from_buffers(pa.large_binary(), len(own), [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.binary())
            shape = [pa.array(np.full(len(own), n, np.int32)) for n in (how.height, how.width)]
            made = pa.StructArray.from_arrays([*shape, pa.array(c.astype(np.int32)), body], names=["height", "width", "channels", "data"],
                                              mask=pa.array(~known))
            yield pa.RecordBatch.from_arrays([*[column[n] for n in keep], made], names=[*keep, out_col])

    return df.select(*dict.fromkeys([*keep, tensor_col, *PARAMS])).mapInArrow(run, schema)


def augment_images(df: DataFrame, img_col: str, how: Augmentation, out_col: str = "augmented",
                   keep_cols: list[str] | None = None) -> DataFrame:
    """The same of nested arrays, rows x columns (x channels), and back. A NULL or empty image stays NULL."""
    deep = isinstance(df.schema[img_col].dataType.elementType.elementType, T.ArrayType)
    keep = [c for c in (df.columns if keep_cols is None else keep_cols) if c not in (img_col, out_col)]
    img = F.when(F.size(img_col) > 0, F.col(img_col))
    flat = F.flatten(F.flatten(img)) if deep else F.flatten(img)
    channels = F.size(F.get(F.get(img, F.lit(0)), F.lit(0))) if deep else F.lit(1)
    shape = [F.coalesce(c, F.lit(0)).cast("int") for c in (F.size(img), F.size(F.get(img, F.lit(0))), channels)]
    packed = df.withColumn(img_col, pack(flat.cast("array<double>"), *shape))
    done = augment_tensors(packed, img_col, how, out_col, keep)
    made, n = F.col("_values"), F.col(out_col)["channels"]

    def row(r: Column) -> Column:
        if not deep:
            return F.slice(made, r * how.width + 1, how.width)
        return F.transform(F.sequence(F.lit(0), F.lit(how.width - 1)), lambda c: F.slice(made, (r * how.width + c) * n + 1, n))

    nested = F.when(made.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(how.height - 1)), row))
    return done.withColumn("_values", values(out_col)).select(*keep, nested.alias(out_col))
