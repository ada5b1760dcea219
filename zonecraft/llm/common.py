"""What the operators share: session settings, stage tables that can be dropped again, and row access by Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecraft.session import new_stage_path, stage_folder

# Rows per Arrow batch: texts can be long, so batches are kept short.
ROWS_PER_BATCH = "1000"


def prepare(spark: SparkSession) -> SparkSession:
    """Short Arrow batches, and shuffle files that go when the query that wrote them has ended."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


class Stages:
    """Tables written once to the shared folder and read back; ``drop`` removes those no later step reads."""

    def __init__(self, spark: SparkSession, name: str):
        stage_folder(spark)  # local sessions without a folder get one here
        self.spark, self.name = spark, name

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = new_stage_path(self.spark, f"{self.name}-{name}")
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table.stage_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            delete_path(self.spark, table.stage_path)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Only the named columns, cast to the types the operators count on."""
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()])


def as_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with each row in one column ``doc``, so that no name used beside it can clash with the caller's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def from_rows(rows: DataFrame, columns: list[str], changed: dict | None = None) -> DataFrame:
    """The caller's columns again, those in ``changed`` with a new value."""
    changed = changed or {}
    return rows.select(*[changed.get(c, F.col("doc").getField(c)).alias(c) for c in columns])


def map_batches(df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` where ``work`` yields dictionaries of columns instead of record batches."""
    fields = df.sparkSession.createDataFrame([], schema).schema
    names, kinds = fields.names, [_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            arrays = [
                columns[n].cast(k) if isinstance(columns[n], pa.Array) else pa.array(columns[n], type=k)
                for n, k in zip(names, kinds, strict=True)
            ]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, fields)


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def texts_of(column: pa.Array) -> pa.Array:
    """A text column with NULL as the empty text."""
    return column.fill_null("") if column.null_count else column
