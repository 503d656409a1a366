"""Tables written in parts: a part counts from the moment its commit is written.

    <root>/<kind>/part=<id>/...     the rows of one append, of one or more kinds
    <root>/commits/                 one JSON line per commit

Readers open the folders of committed parts and no others, so what a failed job left is never
seen, however many folders it wrote. A commit is one line in one file, which appears whole or
not at all, and may take earlier parts out of use at the same time. One job writes to a table at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

COMMIT = "part string, level int, covers array<string>, replaces array<string>"


@dataclass(frozen=True)
class Parts:
    """The parts in use of a table: their level and what they cover, both the caller's to define."""

    active: dict[str, int]
    covers: dict[str, list[str]]

    @property
    def covered(self) -> set[str]:
        return {c for names in self.covers.values() for c in names}


def new_part() -> str:
    return f"p-{uuid.uuid4().hex}"


def state(spark: SparkSession, root: str) -> Parts:
    """What is committed; one row per commit is read."""
    try:
        rows = spark.read.schema(COMMIT).json(f"{root}/commits").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    replaced = {p for r in rows for p in r["replaces"]}
    used = [r for r in rows if r["part"] not in replaced]
    return Parts({r["part"]: r["level"] for r in used}, {r["part"]: r["covers"] for r in used})


def commit(
    spark: SparkSession, root: str, part: str, level: int = 0, covers: list[str] = (), replaces: list[str] = ()
) -> None:
    """Put a part in use, in place of `replaces`."""
    row = [(part, level, list(covers), list(replaces))]
    spark.createDataFrame(row, COMMIT).coalesce(1).write.mode("append").json(f"{root}/commits")


def folder(root: str, kind: str, part: str) -> str:
    return f"{root}/{kind}/part={part}"


def read(spark: SparkSession, root: str, kind: str, schema: str, parts: list[str]) -> DataFrame:
    """The rows of one kind of some parts; their folders only are listed."""
    if not parts:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{root}/{kind}")
    return reader.parquet(*[folder(root, kind, p) for p in parts]).drop("part")


def remove_stale(spark: SparkSession, root: str, kinds: list[str]) -> list[str]:
    """Delete the folders of parts that are not in use, and return them: replaced ones, and what failed
    jobs left. Not while a job writes to the table or a query reads it. Needs a folder that Arrow's file
    systems reach (local, HDFS, S3, GCS)."""
    used, gone = state(spark, root).active, []
    files, path = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    for kind in kinds:
        for found in files.get_file_info(fs.FileSelector(f"{path}/{kind}", allow_not_found=True)):
            name = found.base_name.removeprefix("part=")
            if found.type == fs.FileType.Directory and found.base_name != name and name not in used:
                files.delete_dir(found.path)
                gone.append(f"{kind}/{found.base_name}")
    return sorted(gone)
