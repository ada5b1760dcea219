"""What published files hold physically: their own schemas, read from Parquet footers on the executors."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = "file string, column string, kind string"


def local_or_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark names it, which escapes nothing, and the path in it."""
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/=@"))


def file_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """``file, column, kind``: every column of every Parquet file below the folder with the type the file itself names.

    Spark lists the files; a task reads the footers of its share and no data.
    """
    listed = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, base = local_or_store(path)
                with store.open_input_file(base) as file:
                    schema = pq.read_schema(file)
                columns = [[path] * len(schema), schema.names, [str(t) for t in schema.types]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["file", "column", "kind"])

    return listed.select("path").mapInArrow(work, SCHEMAS)


def published_schemas(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``file_schemas`` of a published table with the year and time of the run that wrote the file."""
    found = file_schemas(spark, f"{root.rstrip('/')}/{table}")
    part = lambda name: F.nullif(F.url_decode(F.regexp_extract("file", f"/{name}=([^/]+)/", 1)), F.lit("__HIVE_DEFAULT_PARTITION__"))
    year = F.nullif(part("year"), F.lit("")).cast("int")
    return found.withColumns({"year": year, "run_timestamp": F.nullif(part("run_timestamp"), F.lit("")).cast("timestamp")})
