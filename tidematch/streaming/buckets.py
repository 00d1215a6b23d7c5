"""Keyed state handled for many keys at once.

A call of Python for every key costs far more than the key's few rows. So rows are
grouped by a hash of their key: a bucket's rows of one micro-batch come as columns,
and state is a map by key, of which only the keys that have rows are touched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidematch.session import ship_package

#: Calls of a processor in one micro-batch at most. It is part of stored state: a
#: query's checkpoint cannot be used with another number.
BUCKETS = 4096


def run(rows: DataFrame, key: str, processor: StatefulProcessor, time_mode: str = "None") -> DataFrame:
    """``processor`` over the buckets of ``key``."""
    ship_package(rows.sparkSession)  # the processors are pickled by name
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    return rows.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=processor.OUTPUT,
        outputMode="Append",
        timeMode=time_mode,
    )


def in_order(rows, key: str, by: list[str]) -> tuple[pd.DataFrame, list, np.ndarray]:
    """A bucket's rows by key and ``by``, with the key's number as ``code``; the keys
    by number; and the place of each key's first row."""
    frame = pd.concat(list(rows), ignore_index=True)
    codes, names = pd.factorize(frame[key], use_na_sentinel=False)
    frame = frame.assign(code=codes).sort_values(["code", *by], kind="stable", ignore_index=True)
    code = frame["code"].to_numpy()
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return frame, [None if pd.isna(n) else n for n in names], starts
