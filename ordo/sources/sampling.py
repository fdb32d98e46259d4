"""A small sample of the lines of text files, by reading a few byte ranges.

The places lie evenly over the bytes of all input files. At each the driver opens
the file through the file system that Spark reads it with, seeks, and reads one
window; nothing else of the file is touched. Of a sorted run these lines are its
quantiles. Files behind a codec cannot be entered in the middle: only the head
of such a file is read.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Bounds of a sample. The driver holds at most SAMPLE_BYTES of lines (and one line
# of at most LONG_LINE where lines are longer than a window).
SAMPLE_BYTES = 64 << 20
PLACES = 256             # places at least, where the input has room for them,
MOST_PLACES = 65_536     # and at most
PLACES_PER_RANGE = 16
WINDOW = 512, 8192       # bytes read at a place
SHARE = 1000             # of the input, one part in SHARE is read (if windows allow)
LONG_LINE = 1 << 20
FILES_LISTED = 65_536    # of more files a fixed choice by the hash of their paths
READERS = 16             # reads under way at a time

_LINE_END = re.compile(rb"\r\n|\n|\r")


@dataclass(frozen=True)
class LineSample:
    lines: list[str]      # valid UTF-8 only
    mean_bytes: float     # per line, with its end


def _files(spark: SparkSession, paths) -> list[tuple[str, int]]:
    """(path, length) of the input files, by Spark's own listing; no content."""
    listing = spark.read.format("binaryFile").load(paths if isinstance(paths, list) else [paths])
    chosen = listing.select("path", "length").orderBy(F.xxhash64("path"), "path").limit(FILES_LISTED)
    return sorted((r["path"], r["length"]) for r in chosen.collect())


def _place(spark: SparkSession, codecs, path: str, start: int, window: int) -> tuple[list[bytes], int]:
    """Whole lines of one window, and the bytes they take with their ends. Where
    the window holds no whole line, it grows until it holds one."""
    sc = spark.sparkContext
    file = sc._jvm.org.apache.hadoop.fs.Path(path)
    codec = codecs.getCodec(file)
    if codec is not None and start:
        return [], 0
    stream = file.getFileSystem(sc._jsc.hadoopConfiguration()).open(file)
    try:
        if codec is not None:
            stream = codec.createInputStream(stream)
        elif start:
            stream.seek(start)
        data, wanted = b"", window
        while True:
            more = stream.readNBytes(wanted - len(data))
            data += more
            ended = len(data) < wanted
            lines = _LINE_END.split(data)
            first = 1 if start else 0                      # what comes before the first line end is a part of a line
            whole = lines[first:] if ended and lines[-1] else lines[first:-1]
            if whole or ended or wanted >= LONG_LINE:
                break
            wanted = min(LONG_LINE, wanted * 4)
        if wanted > window:
            whole = whole[:1]
        return whole, sum(map(len, whole)) + len(whole)
    finally:
        stream.close()


def sample_lines(spark: SparkSession, paths, ranges: int) -> LineSample:
    """A sample to cut the lines of ``paths`` into ``ranges``. Lines longer than
    LONG_LINE are not in it; they count as that long."""
    files = _files(spark, paths)
    size = sum(n for _, n in files)
    places = min(MOST_PLACES, max(PLACES, PLACES_PER_RANGE * ranges))
    window = min(WINDOW[1], max(WINDOW[0], min(SAMPLE_BYTES, size // SHARE) // places))
    places = max(1, min(places, size // window))
    starts, before, at = [], 0, 0
    for path, n in files:
        while at < places and at * size // places < before + n:
            starts.append((path, at * size // places - before))
            at += 1
        before += n
    codecs = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration())
    lines, taken, counted, long = [], 0, 0, 0
    with ThreadPoolExecutor(READERS) as readers:
        for whole, n in readers.map(lambda s: _place(spark, codecs, *s, window), starts):
            counted += len(whole)
            taken += n
            long += not whole
            for line in whole:
                try:
                    lines.append(line.decode())
                except UnicodeDecodeError:
                    pass
    if lines and lines[0].startswith("﻿"):
        lines[0] = lines[0][1:]
    mean = taken / counted if counted else float(min(size, LONG_LINE) if long else 1)
    return LineSample(lines, max(1.0, mean))
