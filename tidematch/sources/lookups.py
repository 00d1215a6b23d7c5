"""A small table read again only when it has changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidematch.operators.joins import LOOKUP_BYTES, LOOKUP_ROWS, attach_rows
from tidematch.operators.sizes import fits_broadcast
from tidematch.sources.files import file_system
from tidematch.sources.partitions import read_table


def table_version(spark: SparkSession, table: str) -> tuple:
    """What changes when a table does: the number of its files, their bytes, and the
    latest time one was written. One listing; a catalog table by its location."""
    location = table
    if "/" not in table:
        described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'")
        location = described.first()["data_type"]
    files, path = file_system(spark, location)
    count, size, latest = 0, 0, 0
    found = files.listFiles(path, True)
    while found.hasNext():
        status = found.next()
        if not status.getPath().getName().startswith(("_", ".")):
            count, size = count + 1, size + status.getLen()
            latest = max(latest, status.getModificationTime())
    return count, size, latest


class FreshLookup:
    """The rows of a lookup, as they are when a micro-batch runs. Call it inside
    ``foreachBatch``.

    ``query`` picks the rows from the table. They are read when the table's version
    is another than last time, and kept on the driver in between if they fit
    the bound of ``attach_rows``; larger ones are read by every micro-batch.
    """

    def __init__(self, table: str, query: Callable[[DataFrame], DataFrame]) -> None:
        self.table, self.query = table, query
        self.reads = 0
        self._version: tuple | None = None
        self._rows: list | None = None
        self._schema = None

    def __call__(self, spark: SparkSession) -> DataFrame:
        version = table_version(spark, self.table)
        if version != self._version or self._rows is None:
            rows = self.query(read_table(spark, self.table))
            self.reads += 1
            self._version, self._rows = version, None
            if not fits_broadcast(rows, LOOKUP_ROWS, LOOKUP_BYTES):
                return rows
            self._rows, self._schema = rows.collect(), rows.schema
        return spark.createDataFrame(self._rows, self._schema)


def lookup_batch(
    lookup: Callable[[SparkSession], DataFrame], write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that attaches to each record of a micro-batch the
    lookup's rows of that moment."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write(attach_rows(batch, lookup(batch.sparkSession)), batch_id)

    return run
