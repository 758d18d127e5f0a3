"""Find, for every row, the last of a bounded list of (key, time) starts before it.

Rows never move: the key's ordinal comes from a broadcast join. Key and rank of the time
among the listed times form one number line, searched in O(log starts) per row by an
Arrow-batched UDF over broadcast arrays. No candidate pairs are produced and nothing is
shuffled. Times are microseconds, as exact as the columns are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.time import epoch_micros


class Starts:
    """Distinct starts, sorted by key, then time."""

    def __init__(self, keys: pa.Array, micros: np.ndarray) -> None:
        encoded = keys.dictionary_encode()
        self.keys = encoded.dictionary
        ordinal = encoded.indices.to_numpy().astype(np.int64)
        self.times, rank = np.unique(micros, return_inverse=True)
        # A row's rank is that of the last listed time at or before it, or -1.
        self.room = len(self.times) + 1
        self.line = ordinal * self.room + rank + 1
        self.first = np.searchsorted(ordinal, np.arange(len(self.keys)))


def locate(df: DataFrame, key: str, ts: str, starts: Starts, slot: str) -> DataFrame:
    """Add ``slot``: the position of the last start of the row's key at or before it.

    Null when the key is not listed or the row lies before its first start.
    """
    if not len(starts.keys):
        return df.withColumn(slot, F.lit(None).cast("int"))
    spark = df.sparkSession
    listed = spark.createDataFrame(
        pa.table({"_key": starts.keys, "_ordinal": pa.array(range(len(starts.keys)), pa.int64())})
    )
    shared = spark.sparkContext.broadcast((starts.times, starts.room, starts.line, starts.first))

    @F.pandas_udf("int")
    def last_at_or_before(ordinal: pd.Series, micros: pd.Series) -> pd.Series:
        times, room, line, first = shared.value
        known = ordinal.notna().to_numpy()
        at = ordinal.fillna(0).to_numpy(np.int64)
        rank = np.searchsorted(times, micros.to_numpy(), side="right")
        place = np.searchsorted(line, at * room + rank, side="right") - 1
        found = known & (place >= first[at])
        return pd.Series(place).where(found).astype("Int32")

    # Called nondeterministic, it is not run again in the filters of a later join.
    search = last_at_or_before.asNondeterministic()
    placed = df.join(F.broadcast(listed), F.col(key) == F.col("_key"), "left")
    return placed.withColumn(slot, search("_ordinal", epoch_micros(ts))).drop("_key", "_ordinal")
