"""Image facts from file headers, admission, and the size of a rendition. Codecs are a plug-in."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ceilings of what passes through, and of what is decoded at all.
MAX_BYTES, MAX_PIXELS, MAX_DECODED = 5_000_000, 20_000_000, 40_000_000
CODES = ("unsupported_image", "corrupt_image", "unsafe_image")


def orientation(segment: bytes) -> int:
    """The orientation, 1 to 8, that an Exif segment gives; 1 if it gives none."""
    if segment[:6] != b"Exif\0\0" or segment[6:8] not in (b"II", b"MM"):
        return 1
    tiff, order = segment[6:], "<" if segment[6:8] == b"II" else ">"
    at = struct.unpack(order + "I", tiff[4:8])[0] if len(tiff) >= 8 else len(tiff)
    entries = struct.unpack(order + "H", tiff[at : at + 2])[0] if at + 2 <= len(tiff) else 0
    for k in range(entries):
        entry = tiff[at + 2 + 12 * k : at + 14 + 12 * k]
        if len(entry) == 12 and struct.unpack(order + "H", entry[:2])[0] == 0x0112:
            value = struct.unpack(order + "H", entry[8:10])[0]
            return value if 1 <= value <= 8 else 1
    return 1


def facts(data: bytes | None) -> tuple[str | None, int, int, int]:
    """(format, width, height, frames) of a PNG, JPEG or WebP by its header, as it is shown; no format if it is none."""
    d = data or b""
    if d[:8] == b"\x89PNG\r\n\x1a\n" and d[12:16] == b"IHDR" and len(d) >= 24:
        w, h = struct.unpack(">II", d[16:24])
        at = d.find(b"acTL", 24)
        return "png", w, h, struct.unpack(">I", d[at + 4 : at + 8])[0] if at > 0 and len(d) >= at + 8 else 1
    if d[:2] == b"\xff\xd8":
        i, turned = 2, 1
        while i + 9 <= len(d):
            if d[i] != 0xFF:
                i += 1
                continue
            kind = d[i + 1]
            if kind in (0xFF, 0x01) or 0xD0 <= kind <= 0xD9:
                i += 1 if kind == 0xFF else 2
                continue
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", d[i + 5 : i + 9])
                return ("jpeg", h, w, 1) if turned >= 5 else ("jpeg", w, h, 1)
            if kind == 0xE1 and turned == 1:
                turned = orientation(d[i + 4 : i + 2 + struct.unpack(">H", d[i + 2 : i + 4])[0]])
            i += 2 + struct.unpack(">H", d[i + 2 : i + 4])[0]
        return "jpeg", 0, 0, 1
    if d[:4] == b"RIFF" and d[8:12] == b"WEBP" and len(d) >= 30:
        if d[12:16] == b"VP8X":
            return "webp", 1 + int.from_bytes(d[24:27], "little"), 1 + int.from_bytes(d[27:30], "little"), max(1, d.count(b"ANMF"))
        if d[12:16] == b"VP8 ":
            w, h = struct.unpack("<HH", d[26:30])
            return "webp", w & 0x3FFF, h & 0x3FFF, 1
        bits = int.from_bytes(d[21:25], "little")
        return "webp", 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF), 1
    return None, 0, 0, 0


def inspect(images: DataFrame, data: str = "data") -> DataFrame:
    """The frame with format, width, height and frames added."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[["format", "width", "height", "frames"]] = [facts(x) for x in pdf[data]]
            yield pdf

    schema = T.StructType([*images.schema, T.StructField("format", T.StringType()), *(T.StructField(n, T.IntegerType()) for n in ("width", "height", "frames"))])
    return images.mapInPandas(run, schema)


def problem(fmt: Column, width: Column, height: Column, frames: Column) -> Column:
    """The code of why an image cannot be used, or null."""
    pixels = width.cast("long") * height.cast("long")
    return F.when(fmt.isNull() | (frames != 1), CODES[0]).when((width < 1) | (height < 1), CODES[1]).when(pixels > MAX_DECODED, CODES[2])


def admission(size: Column, width: Column, height: Column) -> Column:
    """pass_through within both ceilings, else render."""
    return F.when((size <= MAX_BYTES) & (width.cast("long") * height.cast("long") <= MAX_PIXELS), "pass_through").otherwise("render")


def scaled(width: int, height: int, most: int = MAX_PIXELS) -> tuple[int, int]:
    """The largest size of about the same aspect within `most` pixels: root scale, floor, then the longer side is trimmed."""
    if width * height <= most:
        return width, height
    k = math.sqrt(most / (width * height))
    w, h = max(1, math.floor(width * k)), max(1, math.floor(height * k))
    while w * h > most:
        w, h = (w - 1, h) if w >= h else (w, h - 1)
    return w, h


def scaled_columns(width: Column, height: Column, most: int = MAX_PIXELS) -> tuple[Column, Column]:
    """`scaled` in Catalyst: flooring both sides keeps the product within the ceiling, unless a side was raised to 1; then the other one is all there is to trim."""
    w, h = width.cast("double"), height.cast("double")
    k = F.when(w * h > most, F.sqrt(F.lit(float(most)) / (w * h))).otherwise(1.0)
    side = lambda s, other: F.when(F.floor(other * k) < 1, F.least(F.floor(s * k), F.lit(most))).otherwise(F.greatest(F.lit(1), F.floor(s * k))).cast("int")
    return side(w, h), side(h, w)


def token_estimate(width: Column, height: Column) -> Column:
    """Ten tokens for each started tile of 28 by 28 pixels."""
    return (F.ceil(width / 28) * F.ceil(height / 28) * 10).cast("long")
