"""Object keys, paths, versions and content types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of the folder scan, of the labelled scan, and content types by suffix.
SCAN_SUFFIXES = ("jpg", "jpeg", "png", "gif", "bmp", "webp", "tiff")
LABELLED_SUFFIXES = ("png", "jpg", "jpeg")
CONTENT_TYPES = {
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "gif": "image/gif",
    "bmp": "image/bmp",
    "webp": "image/webp",
    "tiff": "image/tiff",
    "txt": "text/plain",
    "json": "application/json",
    "html": "text/html",
}
FALLBACK_TYPE = "application/octet-stream"


def basename(key: Column) -> Column:
    return F.regexp_extract(key, r"([^/]*)/*$", 1)


def stem(key: Column) -> Column:
    """Last path component without its last extension; a leading dot stays."""
    return F.regexp_replace(basename(key), r"(?<=.)\.[^.]+$", "")


def suffix(key: Column) -> Column:
    """Lower-cased last extension without its dot, or empty."""
    return F.lower(F.regexp_extract(basename(key), r".\.([^.]+)$", 1))


def heatmap_key(key: Column) -> Column:
    return F.concat(F.lit("heatmap/"), stem(key), F.lit(".png"))


def content_type(key: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in CONTENT_TYPES.items() for x in kv))
    return F.coalesce(F.try_element_at(table, suffix(key)), F.lit(FALLBACK_TYPE))


def asset_content_type(name: Column) -> Column:
    return F.when(name.endswith(".txt"), "text/plain").otherwise(FALLBACK_TYPE)


def image_path(path: Column) -> Column:
    """``/bucket/key...`` as struct(bucket, object_key); null if a part lacks."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    ok = F.size(parts) >= 2
    return F.when(
        ok, F.struct(parts[0].alias("bucket"), F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "/").alias("object_key"))
    )


def semver(major: Column, minor: Column, patch: Column) -> Column:
    return F.concat_ws(".", major, minor, patch)


def new_key(extension: Column) -> Column:
    """A fresh object key: 32 hex digits and the extension."""
    return F.concat(F.replace(F.uuid(), F.lit("-"), F.lit("")), F.lit("."), extension)


def event_key(*parts: Column) -> Column:
    """A repeatable event id: redelivered messages get the same one."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *(p.cast("string") for p in parts)), 256), 1, 32)
