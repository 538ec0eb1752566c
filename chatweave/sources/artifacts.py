"""Artifact folders, adapter configs and card files."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatweave.schemas import ADAPTER_CONFIG


LISTED = "artifact string, name string, length bigint"


def _folders(pattern: str) -> Iterator[tuple[fs.FileSystem, str]]:
    """The folder of a path, or those that a pattern in its last part matches."""
    system, place = fs.FileSystem.from_uri(pattern if "://" in pattern else f"file://{quote(pattern, safe='/*?[]')}")
    place = unquote(place)
    parent, _, last = place.rstrip("/").rpartition("/")
    if not any(c in last for c in "*?["):
        yield system, place
        return
    for x in system.get_file_info(fs.FileSelector(parent)):
        if not x.is_file and fnmatch.fnmatchcase(x.base_name, last):
            yield system, x.path


def list_artifacts(spark: SparkSession, folders: DataFrame | list[str] | str, column: str = "path") -> DataFrame:
    """Files right in each of many artifact folders: ``(artifact, name, length)``.

    ``folders`` is a table of paths, a list, or one path; the last part of a path may be a
    pattern. Folders are listed on the workers, and every file counts, also hidden and empty
    ones. A folder without files is a row with a null name. Paths may name any file system
    that pyarrow knows.
    """
    if not isinstance(folders, DataFrame):
        named = [folders] if isinstance(folders, str) else folders
        folders = spark.createDataFrame([(f,) for f in named], f"{column} string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for system, place in chain.from_iterable(map(_folders, batch.column(0).to_pylist())):
                files = [x for x in system.get_file_info(fs.FileSelector(place)) if x.is_file]
                artifact = place.rstrip("/").rsplit("/", 1)[-1]
                rows += [(artifact, x.base_name, x.size) for x in files] or [(artifact, None, None)]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)],
                ["artifact", "name", "length"])

    return folders.select(column).filter(F.col(column).isNotNull()).mapInArrow(run, LISTED)


def read_configs(spark: SparkSession, pattern: str) -> DataFrame:
    """Adapter configs with the plain name of the folder they come from."""
    docs = spark.read.schema(ADAPTER_CONFIG).option("multiLine", True).option("mode", "FAILFAST").json(pattern)
    # Paths are URL-encoded; a plus sign in a path is a plus sign.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return docs.withColumn("artifact", F.element_at(F.split(path, "/"), -2))


def write_cards(cards: DataFrame, path: str, artifact: str = "artifact", text: str = "card",
                mode: str = "errorifexists") -> None:
    """One folder of text per artifact."""
    cards.select(artifact, F.col(text).alias("value")).write.mode(mode).partitionBy(artifact).text(path)
