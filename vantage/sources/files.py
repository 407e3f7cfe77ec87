"""Image file listings.

A folder given with a scheme that tasks can open themselves (``file://`` for a
folder all machines mount, or an object store) is walked in tasks, level by
level: the names of files never pass the driver. Any other path goes through
Spark's own file index, which holds them on the driver.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions import file_stem
from vantage.session import scratch_path

FOUND = "path string, folder boolean"


def list_images(spark: SparkSession, root: str, pattern: str = "*.png") -> DataFrame:
    """(image_id, path) for every matching file under ``root``, without files
    and folders whose names begin with "_" or ".". File contents are not read."""
    files = walked(spark, root, pattern) if _opens_in_tasks(root) else indexed(spark, root, pattern)
    return files.select(file_stem("path").alias("image_id"), "path")


def indexed(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path) by Spark's file index. Only the path is selected, so file
    contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path")
    )


def _store(root: str):
    """(file system, path in it) of a root with a scheme."""
    from urllib.parse import quote

    from pyarrow import fs

    return fs.FileSystem.from_uri(quote(root, safe=":/%"))


def _opens_in_tasks(root: str) -> bool:
    if not re.match("^[a-z0-9]+:/", root):
        return False
    try:
        _store(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _children(root: str):
    """Task body: (path, folder) of what lies in each folder of the batches."""

    def run(batches):
        from pyarrow import fs

        store, _ = _store(root)
        for b in batches:
            for folder in b.column(0).to_pylist():
                found = [x for x in store.get_file_info(fs.FileSelector(folder)) if not x.base_name.startswith(("_", "."))]
                paths = pa.array([x.path for x in found], pa.string())
                yield pa.RecordBatch.from_arrays([paths, pa.array([x.type == fs.FileType.Directory for x in found], pa.bool_())], names=["path", "folder"])

    return run


def walked(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path) by a walk over subfolders, one level a step; each level's names
    are kept in the shared folder."""
    scheme = root.split(":", 1)[0]
    folders = spark.createDataFrame([(_store(root)[1],)], "path string")
    files = None
    while True:
        path = scratch_path(spark, "listing")
        # a few folders a task: listing is waiting, so spread it widely
        folders.repartition(spark.sparkContext.defaultParallelism * 4).mapInArrow(_children(root), FOUND).write.parquet(path)
        level = spark.read.schema(FOUND).parquet(path)
        found = level.where(~F.col("folder")).select("path")
        files = found if files is None else files.unionByName(found)
        folders = level.where("folder").select("path")
        if folders.isEmpty():
            break
    files = files.where(F.regexp_extract("path", "[^/]*$", 0).rlike(_glob_regex(pattern)))
    return files.select(F.concat(F.lit("file:" if scheme == "file" else f"{scheme}://"), "path").alias("path"))


def _glob_regex(pattern: str) -> str:
    """A name pattern with *, ? and [...] as a regular expression."""
    out = []
    for part in re.findall(r"\[!?[^\]]*\]|.", pattern):
        if part in "*?":
            out.append(".*" if part == "*" else ".")
        elif len(part) > 1:
            negated = part.startswith("[!")
            inner = re.sub(r"([\[\]\\^&])", r"\\\1", part[1 + negated : -1])
            out.append(f"[{'^' if negated else ''}{inner}]")
        else:
            out.append(re.escape(part))
    return "^" + "".join(out) + "$"


def image_path_map(spark: SparkSession, roots: list[str], pattern: str = "*.png",
                   strict: bool = True) -> DataFrame:
    """Image stem -> path over several folders; a stem found twice is an
    error in strict mode."""
    out = list_images(spark, roots[0], pattern)
    for r in roots[1:]:
        out = out.unionByName(list_images(spark, r, pattern))
    if strict:
        from vantage.operators.checks import check_duplicates, enforce

        enforce(check_duplicates(out, ["image_id"]), "two image files share a stem")
        if out.isEmpty():
            raise ValueError(f"no {pattern} file under {roots}")
    return out
