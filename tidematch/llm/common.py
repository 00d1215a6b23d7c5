"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidematch.session import work_dir
from tidematch.sources.files import file_system

#: Space and the control characters from tab to carriage return part words.
GAP = r"[\x20\x09-\x0D]+"
#: Rows that a Python operator handles and returns to Spark at once, and bytes of
#: text in them; a longer text comes alone.
ROWS_OUT = 500
BYTES_OUT = 4 << 20
#: Rows that Spark sends to a Python operator at once, at most.
ROWS_IN = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read again: lineage ends
    here, and a lost executor costs no more than a read."""
    path = work_dir(df.sparkSession, f"llm/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """The stored steps of one run of an operator. Each is dropped by name as soon
    as what was made of it is written; the last one, which the result reads, stays."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = work_dir(spark, f"llm/{operator}")

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written as the step ``name`` and read again.

        Spark deletes the files of a shuffle once the driver's JVM has collected the
        plan that made it, which may be long after; asked for it here, the shuffles of
        one step do not lie on the executors' disks beside those of the next.
        """
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            files, location = file_system(self.spark, f"{self.root}/{name}")
            files.delete(location, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use``
    mentions it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def small_batches(spark: SparkSession) -> None:
    """Lowers the rows of the session's Arrow batches to ``ROWS_IN``. A batch lies in the
    executor's JVM and in its Python worker at once; of 10,000 texts, the default, it is
    a large part of both."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_IN:
        spark.conf.set(name, str(ROWS_IN))


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[list[list]], list[tuple]]],
    schema: str,
    rows_at_once: int = ROWS_OUT,
) -> DataFrame:
    """Rows through a Python function that gets columns and gives rows.

    ``make`` runs once per task and returns the function, so models and tables
    are built on the worker. Output is sent in small batches, so that memory
    follows the rows of one batch.
    """
    small_batches(df.sparkSession)
    empty = df.sparkSession.createDataFrame([], schema)
    names = empty.columns
    arrow = pa.schema([(n, _arrow_type(t)) for n, t in empty.dtypes])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in batches:
            for start, stop in _parts(batch, rows_at_once):
                part = batch.slice(start, stop - start)
                rows = call([c.to_pylist() for c in part.columns])
                columns = list(zip(*rows)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow
                )
            batch = part = None  # gone before the next comes
        pa.default_memory_pool().release_unused()  # the worker waits for other tasks

    return df.mapInArrow(run, schema)


def with_columns_of(
    df: DataFrame,
    column: str,
    make: Callable[[], Callable[[list], list[tuple]]],
    added: str,
    rows_at_once: int = ROWS_OUT,
) -> DataFrame:
    """``df`` with the columns ``added``, which a Python function makes of the values
    of ``column``, a row for each. The other columns stay in Arrow as they come, of
    whatever type they are."""
    small_batches(df.sparkSession)
    new = df.sparkSession.createDataFrame([], added)
    own, place = df.columns, df.columns.index(column)
    kinds = [_arrow_type(t) for _, t in new.dtypes]
    names = [*own, *new.columns]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in [*df.schema, *new.schema]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in batches:
            for start, stop in _parts(batch, rows_at_once):
                part = batch.slice(start, stop - start)
                made = zip(*call(part.column(place).to_pylist()))
                columns = [pa.array(c, type=t) for c, t in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=names)
            batch = part = None  # gone before the next comes
        pa.default_memory_pool().release_unused()  # the worker waits for other tasks

    return df.mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch, rows_at_once: int) -> Iterator[tuple[int, int]]:
    """Bounds of parts of a batch, limited in rows and in bytes of text."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + BYTES_OUT, side="right"))
        stop = max(start + 1, min(stop, start + rows_at_once))
        yield start, stop
        start = stop


def _arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(_arrow_type(name[6:-1]))
    if name.startswith("struct<"):
        fields = [f.split(":", 1) for f in name[7:-1].split(",")]
        return pa.struct([(n, _arrow_type(t)) for n, t in fields])
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "float": pa.float32(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
    }[name]
