"""Memory of single units as keyed state of a stream: what was computed for an input is given again, and calls are charged before they are made.

State lives in the stream's own store and checkpoint, one value a unit; nothing
written before is read again, however long the stream has run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The store that keyed values need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Memory(StatefulProcessor):
    """Of a unit the binding and input last worked on, the result, and the calls that have been charged."""

    def __init__(self, keys: Sequence[str], order: str, bound: str, work: Callable[[str], str], most_calls: int):
        self.keys, self.order, self.bound, self.work, self.most_calls = list(keys), order, bound, work, most_calls

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "binding string, input string, result string, calls int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        binding, given, result, calls = self.known.get() if self.known.exists() else (None, None, None, 0)
        # a trigger's rows of one unit, in order
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        out = []
        for at, value in zip(frame[self.order], frame["input"], strict=True):
            state = "reused"
            if binding != self.bound or given != value:
                if calls >= self.most_calls:
                    out.append((*key, at, value, None, "refused"))
                    continue
                calls += 1
                self.known.update((binding, given, result, calls))  # a call that fails stays charged
                binding, given, result, state = self.bound, value, self.work(value), "computed"
                self.known.update((binding, given, result, calls))
            out.append((*key, at, value, result, state))
        yield pd.DataFrame(out, columns=[*self.keys, self.order, "input", "result", "state"])

    def close(self) -> None:
        pass


def remembered(stream: DataFrame, keys: Sequence[str], order: str, bound: str, work: Callable[[str], str], most_calls: int = 1 << 30) -> DataFrame:
    """(keys, order, input, result, state) for a stream of (keys, order, input): reused if the unit's last result is of this binding and input, computed else, refused beyond most_calls of a unit.

    A change of bound (see incremental.binding) makes all results stale. Rows of one
    unit meet in one task, in order within a trigger. Null inputs are inputs like others.
    """
    if stream.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", None) != PROVIDER:
        stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    kind = lambda c: stream.schema[c].dataType.simpleString()
    schema = ", ".join([*(f"`{k}` {kind(k)}" for k in [*keys, order]), "input string, result string, state string"])
    return stream.select(*keys, order, "input").groupBy(*keys).transformWithStateInPandas(Memory(keys, order, bound, work, most_calls), schema, "append", "none")


def drained(result: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """All that result, a stream, has to give now, as a table: (result's columns). A rerun with the same checkpoint adds what is new."""
    spark: SparkSession = result.sparkSession
    result.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(result.schema).parquet(path)
