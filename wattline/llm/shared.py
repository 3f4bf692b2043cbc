"""What several operators need: tables that are written once, and files in the shared folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.workspace import new_folder


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, wherever they run. Once a session."""
    context = spark.sparkContext
    if not any(name.startswith("wattline-") for name in context._python_includes):
        root = Path(__file__).resolve().parents[2]
        target = f"{tempfile.mkdtemp(prefix='run-')}/wattline-{uuid.uuid4().hex}"
        context.addPyFile(shutil.make_archive(target, "zip", root, "wattline"))


def landed(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, lost executors take nothing
    with them, and readers prune columns."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], wish: str) -> str:
    """A column name that clashes with none of ``taken`` (Spark's names ignore case)."""
    used = {name.lower() for name in taken}
    while wish.lower() in used:
        wish = f"_{wish}"
    return wish


def free_names(taken: list[str], *wishes: str) -> list[str]:
    """Column names that clash neither with ``taken`` nor with each other."""
    out: list[str] = []
    for wish in wishes:
        out.append(free_name([*taken, *out], wish))
    return out


def stored_position(rows: DataFrame) -> Column | None:
    """Where each row of a table that Spark has written lies: by task, file of the task, and row.

    It ascends in the order in which a sorted table was written, with gaps between files, whose starts
    are multiples of 2**31. Files with names of another kind come in any order among each other. None
    for rows that are not read straight from files.
    """
    # Spark resolves file columns through joins and repartitioning too, where they tell no order.
    if not rows._jdf.queryExecution().analyzed().children().isEmpty():
        return None
    try:
        where = rows.metadataColumn("_metadata")
        rows.select(where["row_index"])
    except AnalysisException:
        return None
    name = where["file_name"]
    task, of_task = (
        F.regexp_extract(name, r"^part-(\d{1,6})-.*?(?:-c(\d{1,4}))?\.", i).try_cast("long") for i in (1, 2)
    )
    file = F.coalesce(task * 4096 + F.coalesce(of_task, F.lit(0)), F.pmod(F.xxhash64(name), F.lit(1 << 32)))
    return file * (1 << 31) + where["row_index"]


def hashed_order(*cols: str | Column) -> Column:
    """A fixed pseudo-random order of rows."""
    return F.xxhash64(F.lit(7919), *cols)


def write_file(folder: str, name: str, chunks) -> tuple[str, int]:
    """Write bytes to a file of this attempt alone; gives its URI and length.

    A repeated or speculative task writes another file, and only the URI that a finished task
    returned is ever read, so that half-written files do no harm.
    """
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    tail, length = f"{name}-{uuid.uuid4().hex}", 0
    with store.open_output_stream(f"{root}/{tail}", compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            length += len(chunk)
    return f"{folder}/{tail}", length


def read_range(uri: str, start: int = 0, length: int | None = None) -> bytes:
    """Bytes of a file in the shared store."""
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as file:
        return file.read_at(file.size() - start if length is None else length, start)
