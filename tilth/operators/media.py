"""Profiles of image and audio folders from file listings and file headers."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.sources.readers import AUDIO_SUFFIXES, IMAGE_SUFFIXES, stored_files

SIZE = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])


def image_size(head: bytes | None) -> tuple[int, int] | None:
    """Width and height from a PNG, BMP, JPEG or WebP header."""
    if head is None:
        return None
    try:
        if head[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", head[16:24])
        if head[:2] == b"BM":
            w, h = struct.unpack("<ii", head[18:26])
            return abs(w), abs(h)
        if head[:4] == b"RIFF" and head[8:12] == b"WEBP":
            return _webp_size(head)
        if head[:2] == b"\xff\xd8":
            return _jpeg_size(head)
    except (struct.error, IndexError):
        return None
    return None


def _webp_size(head: bytes) -> tuple[int, int] | None:
    kind = head[12:16]
    if kind == b"VP8X":
        return (
            1 + int.from_bytes(head[24:27], "little"),
            1 + int.from_bytes(head[27:30], "little"),
        )
    if kind == b"VP8L":
        bits = int.from_bytes(head[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + ((bits >> 14) & 0x3FFF)
    if kind == b"VP8 ":
        w, h = struct.unpack("<HH", head[26:30])
        return w & 0x3FFF, h & 0x3FFF
    return None


def _jpeg_size(head: bytes) -> tuple[int, int] | None:
    at = 2
    while at + 9 <= len(head):
        if head[at] != 0xFF:
            return None
        marker = head[at + 1]
        # Frame headers hold the size; C4, C8 and CC are tables.
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", head[at + 5 : at + 9])
            return w, h
        at += 2 + struct.unpack(">H", head[at + 2 : at + 4])[0]
    return None


def wav_seconds(content: bytes | None) -> float | None:
    """Duration from the fmt and data chunks of a RIFF WAVE file; null for other codecs."""
    if content is None or content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        return None
    at, rate = 12, None
    while at + 8 <= len(content):
        size = int.from_bytes(content[at + 4 : at + 8], "little")
        if content[at : at + 4] == b"fmt ":
            rate = int.from_bytes(content[at + 16 : at + 20], "little")
        elif content[at : at + 4] == b"data":
            return size / rate if rate else None
        at += 8 + size + (size & 1)
    return None


@F.arrow_udf(SIZE)
def _sizes(content: pa.Array) -> pa.Array:
    found = [image_size(c.as_py()) or (None, None) for c in content]
    return pa.StructArray.from_arrays([pa.array([f[i] for f in found], pa.int32()) for i in (0, 1)], names=["width", "height"])


@F.arrow_udf(T.DoubleType())
def _seconds(content: pa.Array) -> pa.Array:
    return pa.array([wav_seconds(c.as_py()) for c in content], pa.float64())


# A filter on what these find would be pushed below them with a copy of each, and every copy is a Python worker more in a task.
_sizes, _seconds = _sizes.asNondeterministic(), _seconds.asNondeterministic()


#: Bytes of a file that go to Python where SQL cannot read its header; few headers are longer.
HEAD = 1 << 16


def _number(content: Column, at: int | Column, n: int, little: bool = True) -> Column:
    """An unsigned number of ``n`` bytes from byte ``at`` (1 is the first) on."""
    digits = F.hex(F.substring(content, at, n if isinstance(at, int) else F.lit(n)))
    if little:
        digits = F.concat(*[F.substring(digits, 2 * i - 1, 2) for i in range(n, 0, -1)])
    return F.conv(digits, 16, 10).cast("long")


def _is(content: Column, at: int, magic: bytes) -> Column:
    return F.substring(content, at, len(magic)) == F.lit(magic)


def plain_size(content: Column) -> Column:
    """Width and height of PNG, BMP and GIF, whose headers are fixed; null for others."""

    def size(width: Column, height: Column) -> Column:
        return F.struct(width.cast("int").alias("width"), height.cast("int").alias("height"))

    def magnitude(at: int) -> Column:
        """Of a signed number of four bytes."""
        x = _number(content, at, 4)
        return F.least(x, F.lit(1 << 32) - x)

    long = F.octet_length(content)
    return (
        F.when(_is(content, 1, b"\x89PNG\r\n\x1a\n") & (long >= 24), size(_number(content, 17, 4, False), _number(content, 21, 4, False)))
        .when(_is(content, 1, b"BM") & (long >= 26), size(magnitude(19), magnitude(23)))
        .when(_is(content, 1, b"GIF8") & (long >= 10), size(_number(content, 7, 2), _number(content, 9, 2)))
    )


def plain_seconds(content: Column) -> Column:
    """Duration of a WAVE file whose format and data chunks come first, as nearly all have them; null for others."""
    wave = _is(content, 1, b"RIFF") & _is(content, 9, b"WAVEfmt ") & (F.octet_length(content) >= 44)

    def seconds(format_size: Column) -> Column:
        at = F.when(format_size < 1 << 16, format_size + format_size % 2 + 21).cast("int")
        chunk = F.substring(content, at, F.lit(8))
        return F.when(F.substring(chunk, 1, 4) == F.lit(b"data"), F.try_divide(_number(chunk, 5, 4), _number(content, 29, 4).cast("double")))

    return F.element_at(F.transform(F.array(F.when(wave, _number(content, 17, 4))), seconds), 1)


def to_python(content: Column, known: Column, *magics: tuple[int, bytes]) -> tuple[Column, Column]:
    """What of files that SQL could not read goes to Python: their first bytes, and after that the whole of longer ones."""
    wanted = F.lit(False)
    for at, magic in magics:
        wanted = wanted | _is(content, at, magic)
    open_ = known.isNull() & wanted
    return F.when(open_, F.substring(content, 1, HEAD)), F.when(open_ & (F.octet_length(content) > HEAD), content)


IMAGES_BY_PYTHON = ((1, b"\xff\xd8"), (9, b"WEBP"))
SOUNDS_BY_PYTHON = ((9, b"WAVE"),)


def image_sizes(files: DataFrame) -> DataFrame:
    """``width`` and ``height`` of each file with a readable header."""
    content = F.col("content")
    head, whole = to_python(content, F.col("d"), *IMAGES_BY_PYTHON)
    first = files.withColumn("d", plain_size(content)).select("d", _sizes(head).alias("h"), whole.alias("whole"))
    # Only a header that the first bytes did not hold sends a whole file.
    found = first.select(F.coalesce("d", F.when(F.col("h.width").isNotNull(), F.col("h")), _sizes(F.when(F.col("h.width").isNull(), F.col("whole")))).alias("d"))
    return found.select("d.*").filter("width is not null")


def sound_seconds(files: DataFrame) -> DataFrame:
    """``seconds`` of each file whose duration its header tells."""
    content = F.col("content")
    head, whole = to_python(content, F.col("s"), *SOUNDS_BY_PYTHON)
    first = files.withColumn("s", plain_seconds(content)).select("s", _seconds(head).alias("h"), whole.alias("whole"))
    return first.select(F.coalesce("s", "h", _seconds(F.when(F.col("h").isNull(), F.col("whole")))).alias("seconds")).filter("seconds is not null")


def _chosen(files: DataFrame, sample: int | None) -> DataFrame:
    """Content of all files, or of the first ``sample`` by path.

    The names are picked without reading content; as literals they are pushed
    to the scan, so only those files are opened.
    """
    if sample is None:
        return files
    names = [r["path"] for r in files.select("path").orderBy("path").limit(sample).collect()]
    return files.filter(F.col("path").isin(names))


def class_sizes(files: DataFrame, extensions: list[str]) -> DataFrame:
    """Files per parent folder, largest first."""
    return (
        stored_files(files.select("path", "length"), extensions)
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "class")
    )


def extension_sizes(files: DataFrame, extensions: list[str]) -> DataFrame:
    """Files per extension."""
    return (
        stored_files(files.select("path", "length"), extensions)
        .groupBy("extension")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def _size_stats(files: DataFrame, extensions: list[str]) -> DataFrame:
    zero = F.lit(0)
    return stored_files(files.select("path", "length"), extensions).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("length"), zero).alias("bytes_total"),
        F.coalesce(F.round(F.avg("length"), 0), F.lit(0.0)).alias("bytes_mean"),
        F.coalesce(F.min("length"), zero).alias("bytes_min"),
        F.coalesce(F.max("length"), zero).alias("bytes_max"),
        F.count_distinct("class").alias("num_classes"),
    )


def _min_max_mean(name: str, digits: int) -> list[Column]:
    return [
        F.min(name).alias(f"{name}_min"),
        F.max(name).alias(f"{name}_max"),
        F.round(F.avg(name), digits).alias(f"{name}_mean"),
    ]


def profile_images(
    files: DataFrame, extensions: list[str] = IMAGE_SUFFIXES, sample: int | None = None
) -> DataFrame:
    """One row over (path, length, content): sizes, classes, dimensions of all files (or of the first ``sample`` by path)."""
    listing = stored_files(files, extensions)
    dims = image_sizes(_chosen(listing, sample)).agg(
        F.count(F.lit(1)).alias("count_sampled"),
        *_min_max_mean("width", 0),
        *_min_max_mean("height", 0),
        F.count_distinct("width", "height").alias("unique_sizes"),
    )
    found = dims.select(F.struct("*")).scalar()
    return _size_stats(files, extensions).select("*", *[found[c].alias(c) for c in dims.columns])


def profile_audio(
    files: DataFrame, extensions: list[str] = AUDIO_SUFFIXES, sample: int | None = None
) -> DataFrame:
    """One row over (path, length, content): sizes, classes, durations of all files (or of the first ``sample`` by path)."""
    listing = stored_files(files, extensions)
    spans = (
        sound_seconds(_chosen(listing, sample))
        .agg(F.count(F.lit(1)).alias("count_sampled"), *_min_max_mean("seconds", 2))
        .withColumns({c: F.round(c, 2) for c in ("seconds_min", "seconds_max")})
    )
    found = spans.select(F.struct("*")).scalar()
    return _size_stats(files, extensions).select("*", *[found[c].alias(c) for c in spans.columns])
