"""Identities: canonical JSON, digests, ids that follow from content."""

from __future__ import annotations

import hashlib
import hmac
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_json(*columns: str) -> Column:
    """Compact JSON with sorted keys and explicit nulls; floats in Spark's spelling."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def row_digest(*columns: str) -> Column:
    return F.sha2(canonical_json(*columns), 256)


def relation_digest(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], chunk_rows: int = 10_000) -> DataFrame:
    """(keys, n, digest): one digest of each key's ordered rows.

    Rows are digested one by one, runs of chunk_rows digests together, and the
    digests of the runs again. Rows are numbered by ranges, so a key is as many
    tasks as its rows ask for.
    """
    from spanframe.operators.ordering import numbered

    names = dict.fromkeys([*keys, *order, *columns])
    rows = numbered(df.select(*names), keys, order, "__at").select(*keys, row_digest(*columns).alias("d"), F.col("__at").alias("at"))
    rows = rows.withColumn("chunk", F.floor(F.col("at") / chunk_rows))
    joined = lambda at, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, value))), lambda r: r[value]), "")
    chunks = rows.groupBy(*keys, "chunk").agg(F.count("*").alias("rows"), F.sha2(joined("at", "d"), 256).alias("c"))
    return chunks.groupBy(*keys).agg(F.sum("rows").alias("n"), F.sha2(joined("chunk", "c"), 256).alias("digest"))


def content_uid(prefix: str, episode: Column, index: Column, *parts: Column) -> Column:
    """prefix, two-digit episode, six-digit index, and 12 hex digits of what identifies the row."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.format_string("%02d-%06d-", episode.cast("bigint"), index.cast("bigint")), F.substring(F.sha2(text, 256), 1, 12))


def digest(value: object) -> str:
    """SHA-256 of a value's canonical JSON, on the driver."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False).encode()).hexdigest()


def hmac_tag(key: bytes):
    """A function of a text column: its HMAC-SHA256 under key, in hex."""

    @F.pandas_udf("string")
    def tag(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else hmac.new(key, t.encode(), "sha256").hexdigest())

    return tag
