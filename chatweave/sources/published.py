"""Published tables: revisions that change by one atomic commit, with messages and history.

A commit writes its rows to a folder of its own, which nobody reads yet, then a list of the
files in it, and at last moves a small manifest to its place: ``manifests/<revision>/<number>.json``.
The move succeeds for one writer of a number only. Readers take the newest manifest, so they see
the rows before or after a commit and never a part of them; folders are never
changed once a manifest names them. Manifests are rows (revision, number, parent, message,
committed_at, folder, n_files, n_rows, bytes, columns), so the history of a table is read as a table.
"""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatweave.sources.tables import path_exists

MANIFEST = (
    "revision string, number bigint, parent bigint, message string, committed_at timestamp, folder string, "
    "n_files bigint, n_rows bigint, bytes bigint, columns string"
)


class CommitConflict(RuntimeError):
    """Another commit took the number first."""


def folder_name(revision: str) -> str:
    """A revision's name as the name of a folder."""
    return re.sub(r"[^A-Za-z0-9._-]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), revision).replace("..", "%2E%2E")


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm, jvm.org.apache.hadoop.fs.Path(path)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    _, target = _hadoop(spark, path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, False)
    out.write(bytearray(text.encode()))
    out.close()


def _move_once(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file in one step, unless the target is there."""
    jvm, old = _hadoop(spark, source)
    _, new = _hadoop(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(old, new, options)
    except Exception as e:
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True


def stage(df: DataFrame, path: str) -> tuple[str, dict]:
    """Write the rows of a commit to a folder that no manifest names yet, and count its files."""
    spark = df.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    target = f"{path.rstrip('/')}/{folder}"
    df.write.parquet(target)
    rows = spark.read.schema(df.schema).parquet(target)
    place, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
    files = rows.groupBy(place.alias("file"), size.alias("bytes")).agg(F.count(F.lit(1)).alias("n_rows"))
    listed = f"{path.rstrip('/')}/files/{folder.split('/')[1]}"
    files.write.parquet(listed)
    total = spark.read.schema("file string, bytes bigint, n_rows bigint").parquet(listed).agg(
        F.count(F.lit(1)), F.sum("n_rows"), F.sum("bytes")).first()
    return folder, {"n_files": total[0], "n_rows": total[1] or 0, "bytes": total[2] or 0, "columns": df.schema.json()}


def newest(spark: SparkSession, path: str, revision: str = "main") -> int | None:
    """The number of the revision's last commit; numbers have no gaps, so it is found by doubling."""
    root = f"{path.rstrip('/')}/manifests/{folder_name(revision)}"
    if not path_exists(spark, f"{root}/0.json"):
        return None
    low, high = 0, 1
    while path_exists(spark, f"{root}/{high}.json"):
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if path_exists(spark, f"{root}/{middle}.json") else (low, middle)
    return low


def commit(spark: SparkSession, path: str, staged: tuple[str, dict], revision: str = "main", message: str = "",
           parent: int | None = None) -> int:
    """Make staged rows the next commit of a revision, after ``parent`` (none: the first one)."""
    root = f"{path.rstrip('/')}/manifests"
    number = 0 if parent is None else parent + 1
    folder, counts = staged
    manifest = {"revision": revision, "number": number, "parent": parent, "message": message,
                "committed_at": datetime.now(timezone.utc).isoformat(), "folder": folder, **counts}
    waiting = f"{root}/_waiting/{uuid.uuid4().hex}.json"
    _write_text(spark, waiting, json.dumps(manifest) + "\n")
    target = f"{root}/{folder_name(revision)}/{number}.json"
    jvm, place = _hadoop(spark, target)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place.getParent())
    if not _move_once(spark, waiting, target):
        raise CommitConflict(f"{revision} {number} is there already")
    return number


def publish_commit(df: DataFrame, path: str, revision: str = "main", message: str = "") -> int:
    """Publish ``df`` as the revision's next commit; the rows are staged once, whatever others commit meanwhile."""
    spark = df.sparkSession
    staged = stage(df, path)
    while True:
        try:
            return commit(spark, path, staged, revision, message, newest(spark, path, revision))
        except CommitConflict:
            continue


def history(spark: SparkSession, path: str) -> DataFrame:
    """All commits of all revisions, one row each."""
    root = f"{path.rstrip('/')}/manifests"
    if not path_exists(spark, root):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).option("mode", "FAILFAST").json(f"{root}/[!_]*/*.json")


def read_published(spark: SparkSession, path: str, revision: str = "main", number: int | None = None) -> DataFrame:
    """The rows of a revision as of its last commit, or of an earlier one."""
    number = newest(spark, path, revision) if number is None else number
    found = [] if number is None else spark.read.schema(MANIFEST).json(
        f"{path.rstrip('/')}/manifests/{folder_name(revision)}/{number}.json").collect()
    if not found:
        raise FileNotFoundError(f"{path}: no commit of {revision}")
    columns = StructType.fromJson(json.loads(found[0]["columns"]))
    return spark.read.schema(columns).parquet(f"{path.rstrip('/')}/{found[0]['folder']}")
