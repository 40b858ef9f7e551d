"""Image folders: listing metadata and encoded payloads."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import base64_line
from tidemark.sources.files import list_files

IMAGE_PATTERN = "*.{jpg,png}"


def image_listing(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Id, file name, category (parent folder), path and size in KB of the images of a folder.

    The id is a hash of the path.  ``limit`` takes the first paths only.
    """
    files = list_files(spark, path, IMAGE_PATTERN)
    if limit is not None:
        files = files.orderBy("path").limit(limit)
    parts = F.split("path", "/")
    return files.select(
        F.sha2("path", 256).alias("image_id"),
        F.element_at(parts, -1).alias("filename"),
        F.element_at(parts, -2).alias("category"),
        "path",
        F.ceil(F.col("length") / 1024).cast("string").alias("size_kb"),
    )


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Path, modification time, length and bytes of the images of a folder."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", IMAGE_PATTERN)
        .load(path)
    )


def _bounded_jpeg(side: int):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from PIL import Image

        def one(content: bytes) -> bytes | None:
            try:
                with Image.open(io.BytesIO(content)) as image:
                    if image.width > side or image.height > side:
                        image.thumbnail((side, side))
                    out = io.BytesIO()
                    image.save(out, format="JPEG")
                    return out.getvalue()
            except Exception:
                return None

        for batch in batches:
            yield batch.assign(content=batch["content"].map(one))

    return encode


def encode_images(df: DataFrame, resize: bool, side: int = 800) -> DataFrame:
    """Base64 of the images in ``content``.

    With ``resize`` images are first shrunk into a ``side`` x ``side`` box and stored as JPEG,
    and unreadable ones are left out; the executors need Pillow.  Without it the bytes
    are encoded as they are and only empty files drop.
    """
    if resize:
        df = df.mapInPandas(_bounded_jpeg(side), df.schema)
    usable = df.where(F.octet_length("content") > 0)
    return usable.withColumns({"content": base64_line("content"), "format": F.lit("base64")})
