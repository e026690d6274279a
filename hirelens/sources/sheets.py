"""Multi-sheet description source (S-10): one CSV file (or folder of part files) per sheet, in workbook
order; the first (master) sheet is skipped unless told otherwise; each file's
columns are read by its own header, by name; each sheet is deduplicated on the
description (A-6); later sheets come first (U-PRE), kept as explicit order
columns, since Spark rows have no order."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators import broadcast_if_small, first_per_key
from hirelens.session import file_system
from hirelens.sources.csvfiles import csv_by_header
from hirelens.sources.feed import union_aligned


EMPTY_AUTHORITY = "^([A-Za-z0-9+.-]+):///"


def natural_order(path: str) -> list:
    """Sort key of a file name in which 2 comes before 10."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return [(0, int(p), "") if p.isdigit() else (1, 0, p) for p in re.split(r"(\d+)", name) if p] + [(1, 0, path)]


def _files(spark: SparkSession, path: str) -> list:
    """Paths of all data files at or below ``path``."""
    fs, top = file_system(spark, path)
    files, found = fs.listFiles(top, True), []
    while files.hasNext():
        p = files.next().getPath()
        if not p.getName().startswith(("_", ".")):
            found.append(p)
    return found


def list_sheets(spark: SparkSession, folder: str) -> list[str]:
    """CSV files below ``folder`` in workbook order (numbers by value)."""
    return sorted((p.toString() for p in _files(spark, folder) if p.getName().lower().endswith(".csv")), key=natural_order)


def read_sheets(spark: SparkSession, sheets: str | list[str], *, skip: int = 1, master: str | None = None,
                text: str = "Job_Description") -> DataFrame:
    """Rows of every sheet but the first ``skip`` (or but the file named
    ``master``), all values text, a column that a sheet lacks null, with
    ``sheet`` (the whole path), ``sheet_no`` (place in the workbook) and
    ``row_no`` (grows with the row order inside a sheet).

    ``sheets`` is a list of files in workbook order, or a folder, whose files
    are taken in the order of :func:`list_sheets`. A sheet may be a folder of
    part files, whose rows follow each other by file name. All sheets are read
    in the same passes, each file by its own header, a large one by many tasks
    (:mod:`hirelens.sources.csvfiles`)."""
    paths = list_sheets(spark, sheets) if isinstance(sheets, str) else list(sheets)
    taken = [(no, p) for no, p in enumerate(paths) if (no >= skip if master is None else p.rsplit("/", 1)[-1] != master)]
    if not taken:
        raise ValueError(f"no sheet left to read of {len(paths)}")
    # a path without authority is shown with one slash or three
    files = [(re.sub(EMPTY_AUTHORITY, r"\1:/", f.toUri().toString()), p, no) for no, p in taken for f in _files(spark, p)]
    owner = broadcast_if_small(spark.createDataFrame(files, "_path string, sheet string, sheet_no int"))
    frames = []
    for one in csv_by_header(spark, [p for _, p in taken]):
        fields = [F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")).alias(c) for c in one.columns[2:]]
        one = one.withColumn("_path", F.regexp_replace("_path", EMPTY_AUTHORITY, "$1:/"))
        frames.append(one.join(owner, "_path").select(*fields, F.struct("_path", "_at").alias("row_no"), "sheet", "sheet_no"))
    if not frames:
        return spark.createDataFrame([], f"`{text}` string, row_no struct<_path:string>, sheet string, sheet_no int")
    return first_per_key(union_aligned(frames), ["sheet", text], ["row_no"])


def later_first(df: DataFrame) -> DataFrame:
    """U-PRE: later sheets first, rows of a sheet in their order."""
    return df.orderBy(F.col("sheet_no").desc(), F.col("row_no").asc())
