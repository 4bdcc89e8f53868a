"""Pictures made in tasks: PNG files, and heatmaps beside the images they belong to."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .descriptors import upsample

_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def encode_png(rgb: np.ndarray) -> bytes:
    """Rows x columns x 3 bytes as a PNG."""
    h, w, _ = rgb.shape
    lines = np.zeros((h, 1 + 3 * w), np.uint8)
    lines[:, 1:] = np.ascontiguousarray(rgb, np.uint8).reshape(h, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return _SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def jet(x: np.ndarray) -> np.ndarray:
    """Values of 0..1 (cut there) from dark blue over green to dark red, as bytes."""
    x = np.clip(np.nan_to_num(x), 0, 1)[..., None]
    return np.round(255 * np.clip(1.5 - np.abs(4 * x - np.array([3.0, 2.0, 1.0])), 0, 1)).astype(np.uint8)


def heatmap_picture(scores: np.ndarray, low: float, high: float, rgb: np.ndarray | None = None, size: int = 224) -> np.ndarray:
    """The enlarged map on a colour scale from ``low`` to ``high``, right of the image
    (values 0..1) if there is one."""
    heat = jet((upsample(scores, size, size) - low) / max(high - low, 1e-12))
    if rgb is None:
        return heat
    image = np.stack([upsample(rgb[:, :, c], size, size) for c in range(3)], axis=2)
    return np.concatenate([np.round(255 * np.clip(image, 0, 1)).astype(np.uint8), heat], axis=1)


def heatmap_pngs(maps: DataFrame, lower: float, upper: float, size: int = 224, image: str = "image_id", rgb: str | None = None) -> DataFrame:
    """``image, png, width, height`` of maps (``h, w, values``), coloured from 0.8 of
    the band's lower bound to 1.2 of its upper one. ``rgb`` names a column of the
    image's pixels (a struct ``h, w, rgb``) to be shown beside it. What writes the
    files is :func:`inspectra.sources.sinks.write_files`."""
    kind = maps.schema[image].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = []
            for i in range(b.num_rows):
                h, w, values = (b[c][i].as_py() for c in ("h", "w", "values"))
                beside = b["beside"][i].as_py()
                beside = None if beside is None else np.asarray(beside["rgb"], float).reshape(beside["h"], beside["w"], 3)
                out.append(heatmap_picture(np.asarray(values, float).reshape(h, w), 0.8 * lower, 1.2 * upper, beside, size))
            yield pa.RecordBatch.from_arrays(
                [b["id"], pa.array([encode_png(p) for p in out], pa.binary()), pa.array([p.shape[1] for p in out], pa.int32()), pa.array([p.shape[0] for p in out], pa.int32())],
                [image, "png", "width", "height"],
            )

    beside = F.col(rgb) if rgb else F.lit(None).cast("struct<h: int, w: int, rgb: array<double>>")
    rows = maps.where("values is not null").select(F.col(image).alias("id"), "h", "w", "values", beside.alias("beside"))
    return rows.mapInArrow(run, f"{image} {kind}, png binary, width int, height int")
