"""Digest-keyed memory of finished work, and part-at-a-time processing."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from spanframe.functions.identity import digest


def binding(stage: str, config: Mapping[str, object], code: str = "") -> str:
    """What a result depends on besides its input row."""
    return digest({"stage": stage, "config": dict(config), "code": code})


@dataclass
class Memo:
    """Results by (uid, binding, input digest) in a Parquet folder. Writing appends; the newest result of a key counts."""

    spark: SparkSession
    path: str

    def read(self, bound: str) -> DataFrame | None:
        try:
            rows = self.spark.read.parquet(self.path).filter(F.col("binding") == bound)
        except AnalysisException:  # nothing written yet
            return None
        newest = Window.partitionBy("uid", "input").orderBy(F.desc("written"), F.desc("result"))
        return rows.withColumn("r", F.row_number().over(newest)).filter("r = 1").select("uid", "input", "result")

    def write(self, rows: DataFrame, bound: str) -> None:
        """rows: (uid, input, result)."""
        rows.select("uid", "input", "result", F.lit(bound).alias("binding"), F.lit(time.time()).alias("written")).write.mode("append").parquet(self.path)

    def computed(self, rows: DataFrame, bound: str, work: Callable[[DataFrame], DataFrame], most: int | None = None) -> DataFrame:
        """(uid, input, result) for rows (uid, input, ...): known results, and work's for the others, of which at most `most` are begun, by uid."""
        known = self.read(bound)
        todo = rows if known is None else rows.join(known.select("uid", "input"), ["uid", "input"], "left_anti")
        if most is not None:
            todo = todo.orderBy("uid").limit(most)
        self.write(work(todo).select("uid", "input", "result"), bound)
        return rows.select("uid", "input").join(self.read(bound), ["uid", "input"])


def reusable(markers: DataFrame, stage: str, input_digest: str, outputs: DataFrame) -> DataFrame:
    """Markers (stage, input, outputs map<path, sha256>) of a stage and input whose outputs all have that digest now. outputs: (path, sha256)."""
    mine = markers.filter((F.col("stage") == stage) & (F.col("input") == input_digest))
    each = mine.select("stage", "input", "outputs", F.explode_outer("outputs").alias("path", "wanted"))
    checked = each.join(outputs, "path", "left").groupBy("stage", "input", "outputs").agg(F.every(F.col("path").isNull() | F.col("sha256").eqNullSafe(F.col("wanted"))).alias("ok"))
    return checked.filter("ok").drop("ok")


def next_part(parts: DataFrame, published: DataFrame, key: str = "part", order: str = "part_index") -> DataFrame:
    """The first part in order that isn't published."""
    return parts.join(published.select(key), key, "left_anti").orderBy(order).limit(1)


def all_published(parts: DataFrame, published: DataFrame, key: str = "part") -> DataFrame:
    """(complete, left): whether every part is published, and how many aren't."""
    return parts.join(published.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("left")).select((F.col("left") == 0).alias("complete"), "left")


class Transient(Exception):
    """A failure worth another try."""


@dataclass
class Budget:
    """Seconds for a run, and calls that are charged before they are made."""

    seconds: float
    calls: int = 0
    clock: Callable[[], float] = time.monotonic
    began: float = field(init=False)

    def __post_init__(self) -> None:
        self.began = self.clock()

    def remaining(self) -> float:
        return max(0.0, self.seconds - (self.clock() - self.began))

    def reserve(self) -> bool:
        """Takes a call; an interrupted one stays taken."""
        if self.calls <= 0:
            return False
        self.calls -= 1
        return True


def bounded_retry(operation: Callable[[float], object], budget: Budget, attempts: int = 3, first_delay: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> object:
    """operation(seconds left), again after a Transient failure with doubled delays, within attempts and the budget."""
    for k in range(attempts):
        try:
            return operation(budget.remaining())
        except Transient:
            delay = first_delay * 2**k
            if k + 1 == attempts or delay >= budget.remaining():
                raise
            sleep(delay)
    raise ValueError("no attempt allowed")


def run_parts(spark: SparkSession, source: str, schema: str, checkpoint: str, process: Callable[[DataFrame, int], None]) -> int:
    """Processes new files of a folder one at a time, each once, and returns the number of batches; a rerun goes on where the last one stopped."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"])
