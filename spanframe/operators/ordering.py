"""Order without one task a key: running sums, row numbers, and greedy chains over blocks of a key's rows.

A key's rows are dealt by ranges of its order, and what a range adds to the next
ones is a small row of its own, so a key that holds a third of a table has as
many tasks as others. Chains (a group's first row decides where the next one
starts) are composed of what each block does to the rows at which it can be entered.
"""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows of a block of a chain.
BLOCK_ROWS = 50_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or what setCheckpointDir was given; on one machine without either a folder of its own."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if at is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="spanframe-checkpoints-")
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def written(df: DataFrame, label: str = "rows") -> DataFrame:
    """df as a Parquet table in the shared folder; lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/spanframe/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same_rows(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """a inner joined with b by columns, nulls being equal. Without columns b is one row, the total of all."""
    if not columns:
        return a.crossJoin(b)
    other = b.withColumnsRenamed({c: f"__b_{c}" for c in columns})
    return a.join(other, [F.col(c).eqNullSafe(F.col(f"__b_{c}")) for c in columns]).drop(*[f"__b_{c}" for c in columns])


def dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """df dealt by columns to as many tasks as there are shuffle partitions, however few bytes it has: for rows that cost much each."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def each_group(df: DataFrame, by: Sequence[str], order: Sequence[str], run: Callable[[tuple, pa.Table], list[tuple]], schema: str) -> DataFrame:
    """run(key, rows in order) of every group as one relation of schema; run gives rows as tuples.

    Groups follow each other in sorted partitions and are cut there, so that many
    small ones cost little; a task holds one group and one batch.
    """
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        key: tuple = ()

        def made(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [()] * len(kind)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

        for batch in batches:
            table, out, first = pa.Table.from_batches([batch]), [], 0
            keys = list(zip(*(table.column(c).to_pylist() for c in by), strict=True))
            for k in range(len(keys)):
                if held and first == k == 0 and keys[0] == key:
                    continue
                if k == 0 or keys[k] != keys[k - 1]:
                    if held or k:
                        out += run(key, pa.concat_tables([*held, table.slice(first, k - first)]))
                    held, first, key = [], k, keys[k]
            if keys:
                held.append(table.slice(first))
            if out:
                yield made(out)
        if held:
            yield made(run(key, pa.concat_tables(held)))

    # a number of its own keeps small tables from being one task, whatever each group costs
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *by).sortWithinPartitions(*by, *order).mapInArrow(cut, schema)


def scanned(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str], begin: Callable[[], Callable[..., tuple | None]], adds: str) -> DataFrame:
    """df with what a recurrence gives each row in the columns of adds (DDL); nulls of order come last, as do those of pandas.

    begin() makes a step for a group; step(*values, following) of the columns' values
    and those of the group's next row (None behind the last) gives a row's new
    values, or None for a row that goes. Null values are NaN for it. Groups of any number and any size
    follow each other in sorted partitions; a task holds one batch and one row.
    """
    added = to_arrow_schema(StructType.fromDDL(adds))

    def values_of(column: pa.ChunkedArray) -> list:
        return [math.nan if v is None else v for v in column.to_pylist()] if column.null_count else column.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, now, held = None, None, None

        def stepped(table: pa.Table, n: int) -> pa.Table:
            """The first n rows of table; the row behind them is only looked at."""
            nonlocal step, now
            keys = list(zip(*(table.column(c).to_pylist() for c in by), strict=True))
            rows = list(zip(*(values_of(table.column(c)) for c in columns), strict=True))
            keep, made = [], []
            for k in range(n):
                if step is None or keys[k] != now:
                    step, now = begin(), keys[k]
                new = step(*rows[k], rows[k + 1] if k + 1 < len(rows) and keys[k + 1] == now else None)
                if new is not None:
                    keep.append(k)
                    made.append(new)
            out = table.slice(0, n) if len(keep) == n else table.take(pa.array(keep, pa.int64()))
            found = list(zip(*made, strict=True)) if made else [()] * len(added)
            for f, values in zip(added, found, strict=True):
                out = out.append_column(f, pa.array(values, f.type, from_pandas=True))
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            yield from stepped(table, table.num_rows - 1).combine_chunks().to_batches()
            held = table.slice(table.num_rows - 1)
        if held is not None:
            yield from stepped(held, 1).to_batches()

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.repartition(n, *by).sortWithinPartitions(*by, *[F.col(c).asc_nulls_last() for c in order]).mapInArrow(run, f"{kinds}, {adds}")


def group_batches(df: DataFrame, by: Sequence[str], order: Sequence[str], run: Callable[[pa.Table, np.ndarray], pa.Array], name: str, kind: str) -> DataFrame:
    """df with name: run(rows of whole groups in order, where groups begin) gives its values. Nulls of order come last.

    Groups follow each other in sorted partitions; a task holds one batch and one group.
    """
    added = to_arrow_schema(StructType.fromDDL(f"`{name}` {kind}"))[0]

    def first_rows(table: pa.Table) -> np.ndarray:
        keys = list(zip(*(table.column(c).to_pylist() for c in by), strict=True))
        return np.array([k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]], np.int64)

    def made(table: pa.Table, begins: np.ndarray) -> list[pa.RecordBatch]:
        table = table.combine_chunks()
        return table.append_column(added, run(table, begins)).combine_chunks().to_batches()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # of the last group
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held and all(table.column(c)[-1] == held[0].column(c)[0] or not (table.column(c)[-1].is_valid or held[0].column(c)[0].is_valid) for c in by):
                held.append(table)
                continue
            table = pa.concat_tables([*held, table])
            begins = first_rows(table)
            if len(begins) > 1:
                yield from made(table.slice(0, begins[-1]), begins[:-1])
            held = [table.slice(begins[-1])]
        if held:
            yield from made(pa.concat_tables(held), np.zeros(1, np.int64))

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.repartition(n, *by).sortWithinPartitions(*by, *[F.col(c).asc_nulls_last() for c in order]).mapInArrow(cut, f"{kinds}, `{name}` {kind}")


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df with __range, written: rows dealt by keys and order to as many ranges as there are shuffle partitions; equal rows are in one range."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(n, *keys, *order).withColumn("__range", F.spark_partition_id()), "ranges")


def running(rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """rows (of ranged) with running sums: of a key's rows in order, up to and with each row. Rows that equal in order come in any order, so order should tell them apart."""
    by = [*keys, "__range"]
    own = {f"__s{i}": c for i, c in enumerate(sums.values())}
    valued = rows.withColumns(own)
    totals = valued.groupBy(*by).agg(*[F.sum(c).alias(c.replace("__s", "__t")) for c in own])
    # a row a key and range
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*by, *[F.coalesce(F.sum(c.replace("__s", "__t")).over(before), F.lit(0)).alias(c.replace("__s", "__b")) for c in own])
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = same_rows(valued.withColumns({c: F.sum(c).over(inside) for c in own}), base, by)
    return found.select(*rows.columns, *[(F.col(c) + F.col(c.replace("__s", "__b"))).alias(name) for c, name in zip(own, sums, strict=True)])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position", keep_range: bool = False) -> DataFrame:
    """df with each row's number, from 0, among its key's rows in order."""
    found = running(ranged(df, keys, order), keys, order, {name: F.lit(1).cast("bigint")}).withColumn(name, F.col(name) - 1)
    return found if keep_range else found.drop("__range")


def chained(df: DataFrame, keys: Sequence[str], position: str, columns: Sequence[str], step: Callable[..., int], coordinate: str, reach: int, width: int, name: str = "part") -> DataFrame:
    """df with name: the number, from 0, of the group that each row is in.

    position numbers a key's rows from 0. Row 0 opens a group, and
    step(i, n, *columns) says where, behind a row i that opens one, the next one
    opens: n if at none of the n rows given. A group holds no row that lies over
    reach behind its first by coordinate, which doesn't fall with position. A
    task sees a block of width by coordinate, and reach of what follows.
    """
    width = max(width, reach)
    lists = [coordinate, *columns]
    slim = written(df.select(*keys, F.col(position).alias("__p"), F.floor(F.col(coordinate) / width).alias("__block"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(lists)]), "chain")
    seen_before = slim.filter(F.col("__c0") - F.col("__block") * width <= reach).withColumn("__block", F.col("__block") - 1)
    both = slim.withColumn("__own", F.lit(True)).unionByName(seen_before.withColumn("__own", F.lit(False)))
    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)

    def of_block(table: pa.Table) -> tuple[int, int, list[list]]:
        """(position of the first row, rows of the block itself, columns) in order."""
        return table.column("__p")[0].as_py(), sum(table.column("__own").to_pylist()), [table.column(f"__c{i}").to_pylist() for i in range(len(lists))]

    def maps(key: tuple, table: pa.Table) -> list[tuple]:
        """Of each row at which a chain may enter the block: where it leaves it, and how many groups it opens there."""
        block = key[-1]
        first, n_own, data = of_block(table)
        # the first row, those that the block before sees, and the one behind these
        entries = range(min(n_own, 1 + sum(x - block * width <= reach for x in data[0][:n_own])))
        known: dict[int, tuple[int, int]] = {}
        for entry in reversed(entries):
            path, at = [], entry
            while at < n_own and at not in known:
                path.append(at)
                at = step(at, len(data[0]), *data[1:])
            leaves, groups = known.get(at, (at, 0))
            for p in reversed(path):
                groups += 1
                known[p] = leaves, groups
        return [(*key, first + e, first + known[e][0], known[e][1]) for e in entries]

    def entered(key: tuple, table: pa.Table) -> list[tuple]:
        """A key's chain from block to block: where each is entered, if at all, and the groups opened before."""
        hops = {e: (b, x, g) for b, e, x, g in zip(*(table.column(c).to_pylist() for c in ("block", "entry", "leaves", "groups")), strict=True)}
        first_of: dict[int, int] = {}
        for e, (b, _, _) in hops.items():
            first_of[b] = min(e, first_of.get(b, e))
        at, before, out = 0, 0, []
        for block in sorted(first_of, key=first_of.get):
            inside = at in hops and hops[at][0] == block
            out.append((*key, block, at if inside else None, before))
            if inside:
                _, at, groups = hops[at]
                before += groups
        return out

    def parts(key: tuple, table: pa.Table) -> list[tuple]:
        first, n_own, data = of_block(table)
        entry, number = table.column("__entry")[0].as_py(), table.column("__before")[0].as_py() - 1
        opens, out = n_own if entry is None else entry - first, []
        for k in range(n_own):
            if k == opens:
                number, opens = number + 1, step(k, len(data[0]), *data[1:])
            out.append((*key[:-1], first + k, number))
        return out

    block_of = [*keys, "__block"]
    hops = each_group(both, block_of, ["__p"], maps, f"{kinds}block bigint, entry bigint, leaves bigint, groups bigint")
    # of a key, what its blocks show of themselves: reach of every width
    every = hops if keys else hops.withColumn("__all", F.lit(0))
    entries = written(each_group(every, keys or ["__all"], ["entry"], entered if keys else lambda key, table: entered((), table), f"{kinds}__block bigint, __entry bigint, __before bigint"), "entries")
    found = each_group(same_rows(both, entries, block_of), block_of, ["__p"], parts, f"{kinds}__p bigint, __part bigint")
    numbers = found.withColumnRenamed("__p", position)
    return same_rows(df, numbers, [*keys, position]).withColumnRenamed("__part", name)
