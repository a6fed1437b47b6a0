"""Which small files of a table go together."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Bytes under which a file is small, and that a packed one may have.
SMALL, TARGET = 32 << 20, 128 << 20


def file_sizes(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """(partition folder, file, bytes) of a partitioned table's files; no content is read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .load(folder)
        .select(F.col("path"), F.col("length"))
    )
    return [(unquote(r.path).rsplit("/", 2)[1], r.path, r.length) for r in listed.collect()]


def packed(
    files: Sequence[tuple[str, str, int]], target: int
) -> list[list[tuple[str, str]]]:
    """Groups of (partition folder, file) of one partition each, by first fit, largest first.

    A file that would be alone in its group is left out.
    """
    groups: list[list[tuple[str, str]]] = []
    open_groups: dict[str, list[tuple[int, list]]] = {}
    for folder, file, size in sorted(files, key=lambda f: (f[0], -f[2], f[1])):
        held = open_groups.setdefault(folder, [])
        for place, (room, group) in enumerate(held):
            if size <= room:
                group.append((folder, file))
                held[place] = (room - size, group)
                break
        else:
            group = [(folder, file)]
            groups.append(group)
            held.append((target - size, group))
    return [group for group in groups if len(group) > 1]
