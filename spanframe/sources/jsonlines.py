"""Strict JSON and JSON lines."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def strict_problem(text: str) -> str | None:
    """Why a text isn't one strict JSON value: not JSON, a key twice, NaN or infinity; else None."""

    def pairs(found: list[tuple[str, object]]) -> dict:
        if len({k for k, _ in found}) != len(found):
            raise ValueError("a key stands twice")
        return dict(found)

    def constant(name: str) -> None:
        raise ValueError(f"{name} is no JSON number")

    try:
        json.loads(text, object_pairs_hook=pairs, parse_constant=constant)
    except (ValueError, RecursionError) as error:
        return str(error)
    return None


def checked(df: DataFrame, text: str = "value") -> DataFrame:
    """df with problem: null where the text is strict JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if t is None else strict_problem(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "problem"])

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", problem string")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(path, problem, value): whole files as one JSON value of the schema; a byte-order mark goes."""
    files = spark.read.format("binaryFile").load(path).select("path", F.regexp_replace(F.col("content").cast("string"), "^﻿", "").alias("value"))
    return checked(files).select("path", "problem", F.when(F.col("problem").isNull(), F.from_json("value", schema)).alias("value"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(path, line, problem, value): one object a line, numbered from 1; blank lines are counted and left out."""
    files = spark.read.format("binaryFile").load(path).select("path", F.regexp_replace(F.col("content").cast("string"), "^﻿", "").alias("text"))
    lines = files.select("path", F.posexplode(F.split("text", "\r\n|\n")).alias("line", "value")).withColumn("line", F.col("line") + 1).filter(F.trim("value") != "")
    return checked(lines).select("path", "line", "problem", F.when(F.col("problem").isNull(), F.from_json("value", schema)).alias("value"))


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Objects with sorted keys and explicit nulls, one a line; with order, ranges of it are files in ascending order."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)

