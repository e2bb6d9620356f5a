"""Replacing folders of a table so that the change can be stopped anywhere, resumed, and read meanwhile.

New content is written below <table>/_swap/<mark>/new, which Spark's readers skip. Its journal, a file that lists
the parts of the change, appears in one step and is the point from which the change holds: whoever loads the
table next finishes it, and readers take a part that is between its two places from where it is. Without a
journal the table is as it was. A part is a folder or file of the table's folder, by its path there.

One writer at a time works on a table, or on one lane of it: lanes are for parts that belong to different
writers, as the tables below one root. Readers need not wait.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

JOURNAL = "journal"


def _path(spark: SparkSession, text: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(text)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _path(spark, path)
    return system.exists(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder or file; a step of the file system's directory, no data is copied on HDFS."""
    place, system = _path(spark, source)
    goal, _ = _path(spark, target)
    system.mkdirs(goal.getParent())
    if system.exists(goal) or not system.rename(place, goal):
        raise OSError(f"{source} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    place, system = _path(spark, path)
    system.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    part = f"{path}.{uuid.uuid4().hex}"
    place, system = _path(spark, part)
    out = system.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, part, path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it is not there."""
    place, system = _path(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, from the file system's listing; no file is opened."""
    place, system = _path(spark, pattern)
    return sorted(f.getPath().toString() for f in system.globStatus(place) or [])


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    place, system = _path(spark, path)
    return system.getContentSummary(place).getLength()


def home(path: str, lane: str = "") -> str:
    return f"{path}/_swap/{lane}" if lane else f"{path}/_swap"


def begin(spark: SparkSession, path: str, lane: str = "") -> str:
    """Folder of a new change of a table, after an earlier one has been finished."""
    settle(spark, path, *([lane] if lane else []))
    return f"{home(path, lane)}/{time.time_ns():020d}-{uuid.uuid4().hex}"


def commit(spark: SparkSession, change: str, parts: list[str]) -> None:
    """From here on the change holds; it is carried out by `settle`."""
    write_text(spark, f"{change}/{JOURNAL}", "".join(f"{p}\n" for p in parts))


def steps(spark: SparkSession, path: str, lane: str = "") -> Iterator[str]:
    """Carry out the changes that hold, one rename at a time; gives what has been done after each."""
    for change in listed(spark, f"{home(path, lane)}/*"):
        for part in (read_text(spark, f"{change}/{JOURNAL}") or "").splitlines():
            new, old, place = f"{change}/new/{part}", f"{change}/old/{part}", f"{path}/{part}"
            if exists(spark, new):
                if exists(spark, place):
                    move(spark, place, old)
                    yield f"{part} away"
                move(spark, new, place)
                yield f"{part} in place"
        remove(spark, f"{change}/{JOURNAL}")
        yield "journal removed"
        remove(spark, change)


def settle(spark: SparkSession, path: str, lane: str = "") -> None:
    """Finish the changes of a table that hold and drop what others have left."""
    for _ in steps(spark, path, lane):
        pass


def read(spark: SparkSession, path: str, schema, parts: list[str] | None = None) -> DataFrame:
    """The rows of a table whose folders are its partitions, also while a change is under way.

    `parts` limits what is read to those folders.
    """
    reader = lambda base: spark.read.schema(schema).option("basePath", base)
    between = []
    for change in listed(spark, f"{home(path)}/*"):
        for part in (read_text(spark, f"{change}/{JOURNAL}") or "").splitlines():
            wanted = "=" in part and not part.startswith("_") and (parts is None or part in parts)
            if wanted and not exists(spark, f"{path}/{part}"):
                between.append((f"{change}/new", f"{change}/new/{part}"))
    here = [path] if parts is None else [f"{path}/{p}" for p in parts if exists(spark, f"{path}/{p}")]
    if not here and not between:
        return spark.createDataFrame([], schema)
    if here and (not between or exists(spark, path)):
        rows = reader(path).parquet(*here)
    else:
        (base, first), *between = between
        rows = reader(base).parquet(first)
    for base, folder in between:
        rows = rows.unionByName(reader(base).parquet(folder), allowMissingColumns=True)
    return rows
