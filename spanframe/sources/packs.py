"""ZIP packs of JSON lines: guarded reading on executors, deterministic writing."""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import shutil
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage


@dataclass(frozen=True)
class Guard:
    """What a pack may hold."""

    members: int = 64
    member_bytes: int = 32 << 20
    total_bytes: int = 128 << 20
    ratio: int = 250
    ratio_from: int = 1 << 20
    folders: int = 0


def member_problem(archive: zipfile.ZipFile, guard: Guard) -> str | None:
    """Why a pack isn't to be opened, None if it is."""
    found = archive.infolist()
    if len(found) > guard.members:
        return f"{len(found)} members"
    if len({m.filename for m in found}) != len(found):
        return "a name stands twice"
    if sum(m.file_size for m in found) > guard.total_bytes:
        return "too large in all"
    for m in found:
        parts = m.filename.split("/")
        if m.is_dir() or m.filename.startswith("/") or "\\" in m.filename or ".." in parts or len(parts) - 1 > guard.folders or re.match(r"^[A-Za-z]:", m.filename):
            return f"{m.filename}: not a plain name"
        if m.flag_bits & 1 or m.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            return f"{m.filename}: encrypted, or packed in another way"
        if (m.external_attr >> 16) & 0o170000 not in (0, 0o100000):
            return f"{m.filename}: not a regular file"
        if m.file_size > guard.member_bytes or m.file_size >= guard.ratio_from and m.file_size > guard.ratio * max(1, m.compress_size):
            return f"{m.filename}: too large, or packed too tightly"
    return None


def members_of(files: DataFrame, guard: Guard = Guard()) -> DataFrame:
    """files: (path, content). (path, member, sha256, content, problem): a row for each member; of a pack that the guard refuses, or that is broken, one row with the problem."""
    names = ["path", "member", "sha256", "content", "problem"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(data.as_py())) as archive:
                        why = member_problem(archive, guard)
                        if why is None and archive.testzip() is not None:
                            why = "a checksum differs"
                        rows = [(at, None, None, None, why)] if why else [(at, m, hashlib.sha256(c := archive.read(m)).hexdigest(), c, None) for m in archive.namelist()]
                except (zipfile.BadZipFile, EOFError, OSError) as error:
                    rows = [(at, None, None, None, str(error))]
                for row in rows:
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()), strict=True)], names=names)

    return files.select("path", "content").mapInArrow(run, "path string, member string, sha256 string, content binary, problem string")


def read_packs(spark: SparkSession, path: str, guard: Guard = Guard()) -> DataFrame:
    """members_of the files at a path."""
    return members_of(spark.read.format("binaryFile").load(path), guard)


def pack_lines(members: DataFrame, pattern: str = r"^batch_\d{3}\.jsonl$") -> DataFrame:
    """(path, member, line, value): the lines of members whose names match, numbered from 1; blank lines are left out."""
    rows = members.filter(F.col("problem").isNull() & F.col("member").rlike(pattern))
    lines = rows.select("path", "member", F.posexplode(F.split(F.col("content").cast("string"), "\r\n|\n")).alias("line", "value"))
    return lines.withColumn("line", F.col("line") + 1).filter(F.trim("value") != "")


def membership_issues(members: DataFrame, static: Sequence[str], batches: int) -> DataFrame:
    """(path, member, code): members that a pack of so many batches lacks or has besides."""
    wanted = F.array(*map(F.lit, [*static, *(f"batch_{k:03d}.jsonl" for k in range(1, batches + 1))]))
    # a pack has no more members than the guard lets it have
    held = members.groupBy("path").agg(F.collect_set("member").alias("held"))
    missing = held.select("path", F.explode(F.array_except(wanted, "held")).alias("member"), F.lit("missing").alias("code"))
    return missing.unionByName(held.select("path", F.explode(F.array_except("held", wanted)).alias("member"), F.lit("extra").alias("code")))


def pack_bytes(batches: Mapping[int, Sequence[str]], manifest: Mapping[str, object], extra: Mapping[str, bytes] | None = None) -> bytes:
    """A pack with a manifest that names every batch's digest; equal contents give equal bytes."""
    files = {f"batch_{k + 1:03d}.jsonl": ("\n".join(lines) + "\n").encode() for k, lines in sorted(batches.items())} | dict(extra or {})
    listed = dict(manifest) | {"members": {name: hashlib.sha256(data).hexdigest() for name, data in sorted(files.items())}}
    files["manifest.json"] = json.dumps(listed, sort_keys=True, ensure_ascii=False, indent=2).encode() + b"\n"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name in sorted(files):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type, info.external_attr = zipfile.ZIP_DEFLATED, 0o100644 << 16
            archive.writestr(info, files[name])
    return out.getvalue()


def packs(df: DataFrame, keys: Sequence[str], batch: str, order: str, columns: Sequence[str], guard: Guard = Guard()) -> DataFrame:
    """(keys, pack): one pack a key, its rows in batches. A pack is one file and so one group: keys whose rows exceed guard.total_bytes are refused before they are gathered."""
    line = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    rows = df.select(*keys, F.col(batch).cast("bigint").alias("b"), F.col(order).cast("bigint").alias("o"), line.alias("line"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found: dict[int, list[str]] = {}
        for row in sorted(table.select(["b", "o", "line"]).to_pylist(), key=lambda r: (r["b"], r["o"])):
            found.setdefault(row["b"], []).append(row["line"])
        names = {k: v.as_py() for k, v in zip(keys, key, strict=True)}
        return pa.table({k: table.column(k).slice(0, 1) for k in keys} | {"pack": pa.array([pack_bytes(found, {"key": {k: str(v) for k, v in names.items()}, "records": table.num_rows})], pa.binary())})

    sizes = rows.groupBy(*keys).agg(F.sum(F.octet_length("line") + 1).alias("__bytes"))
    fits = sizes.filter(F.when(F.col("__bytes") > guard.total_bytes, F.raise_error(F.lit("a pack would exceed its guard")).cast("boolean")).otherwise(F.lit(True)))
    return rows.join(fits.select(*keys), list(keys), "left_semi").groupBy(*keys).applyInArrow(run, ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", pack binary")


# --- packs as a data source: spark.read.format("zip_pack"), df.write.format("zip_pack") ---------

#: Bytes of members that one read task inflates, and bytes that are inflated at once.
TASK_BYTES, STEP_BYTES = 16 << 20, 1 << 20


def mounted(path: str) -> str:
    """A folder that driver and executors have mounted, as they open it; other stores are read by read_packs."""
    if path.startswith("file:"):
        return re.sub(r"^file:(//)?(?=/)", "", path)
    if "://" in path:
        raise ValueError(f"{path}: zip_pack opens files itself; read other stores by read_packs")
    return path


@dataclass
class Members(InputPartition):
    """Members of archives that one task reads: (path, member); or, without members, what is wrong with a pack."""

    found: list[tuple[str, str | None, str | None]]

    def __init__(self, found: list[tuple[str, str | None, str | None]]):
        super().__init__(None)
        self.found = found


def _inflated(path: str, member: str, guard: Guard) -> tuple[bytes | None, str | None]:
    """(content, None) or (None, problem). No more is inflated than the directory said and the guard lets pass; the archive's checksum is compared."""
    try:
        with zipfile.ZipFile(path) as archive:
            size, out = archive.getinfo(member).file_size, bytearray()
            with archive.open(member) as source:
                while part := source.read(STEP_BYTES):
                    out += part
                    if len(out) > min(size, guard.member_bytes):
                        return None, f"{member}: longer than the directory says"
            return (bytes(out), None) if len(out) == size else (None, f"{member}: shorter than the directory says")
    except (zipfile.BadZipFile, EOFError, OSError, KeyError) as error:
        return None, str(error)


class PackReader(DataSourceReader):
    """The driver reads directories only; members are inflated by tasks, some TASK_BYTES each."""

    def __init__(self, path: str, guard: Guard):
        self.path, self.guard = path, guard

    def partitions(self) -> list[InputPartition]:
        files = [self.path] if os.path.isfile(self.path) else sorted(os.path.join(top, n) for top, dirs, names in os.walk(self.path) for n in names if n.endswith(".zip") and "/_" not in top[len(self.path) :])
        out, held, size = [], [], 0
        for file in files:
            try:
                with zipfile.ZipFile(file) as archive:
                    why = member_problem(archive, self.guard)
                    found = [(file, None, why)] if why else [(file, m.filename, None) for m in archive.infolist()]
                    sizes = [0] if why else [m.file_size for m in archive.infolist()]
            except (zipfile.BadZipFile, EOFError, OSError) as error:
                found, sizes = [(file, None, str(error))], [0]
            for one, n in zip(found, sizes, strict=True):
                if held and size + n > TASK_BYTES:
                    out.append(Members(held))
                    held, size = [], 0
                held.append(one)
                size += n
        return [*out, Members(held)]

    def read(self, partition: Members) -> Iterator[tuple]:
        for path, member, why in partition.found:
            content = None
            if member is not None:
                content, why = _inflated(path, member, self.guard)
            yield path, member, None if content is None else hashlib.sha256(content).hexdigest(), content, why


@dataclass
class Written(WriterCommitMessage):
    """Packs that a task has finished below the temporary folder."""

    names: list[str]


class PackWriter(DataSourceWriter):
    """Two phases: tasks write whole packs below a temporary folder, and the driver moves them once all tasks have succeeded. What fails leaves no pack.

    Rows come by pack and member, in order; a member's rows are written one after
    the other, so a task holds one row at a time. Moving doesn't overwrite: a name that is there already fails the write.
    """

    def __init__(self, path: str, overwrite: bool, guard: Guard):
        self.path, self.overwrite, self.guard = path, overwrite, guard
        self.temporary = os.path.join(path, f"_temporary-{uuid.uuid4().hex}")

    def write(self, rows: Iterator) -> Written:
        from pyspark import TaskContext

        at = os.path.join(self.temporary, str(TaskContext.get().taskAttemptId()))
        os.makedirs(at, exist_ok=True)
        names: list[str] = []
        for pack, of_pack in groupby(rows, key=lambda r: r["pack"]):
            if pack in names or not re.fullmatch(r"[\w.-]+", pack):
                raise ValueError(f"{pack}: not a name, or its rows aren't together")
            total, seen = 0, set()
            with zipfile.ZipFile(os.path.join(at, f"{pack}.zip"), "w", zipfile.ZIP_DEFLATED) as archive:
                for member, of_member in groupby(of_pack, key=lambda r: r["member"]):
                    if member in seen or len(seen) == self.guard.members:
                        raise ValueError(f"{pack}: {member} stands twice, or too many members")
                    seen.add(member)
                    info, size = zipfile.ZipInfo(member, (1980, 1, 1, 0, 0, 0)), 0
                    info.compress_type, info.external_attr = zipfile.ZIP_DEFLATED, 0o100644 << 16
                    with archive.open(info, "w") as out:
                        for row in of_member:
                            out.write(row["content"])
                            size += len(row["content"])
                            if size > self.guard.member_bytes or total + size > self.guard.total_bytes:
                                raise ValueError(f"{pack}: {member} exceeds the guard")
                    total += size
            names.append(pack)
        return Written([os.path.join(os.path.basename(at), f"{n}.zip") for n in names])

    def commit(self, messages: list[Written]) -> None:
        moves = [(os.path.join(self.temporary, n), os.path.join(self.path, os.path.basename(n))) for m in messages if m is not None for n in m.names]
        targets = [b for _, b in moves]
        if len(set(targets)) != len(targets) or not self.overwrite and any(map(os.path.exists, targets)):
            self.abort(messages)
            raise ValueError("a pack was written twice, or is there already")
        os.makedirs(self.path, exist_ok=True)
        for a, b in moves:
            os.replace(a, b)
        shutil.rmtree(self.temporary, ignore_errors=True)

    def abort(self, messages: list[Written]) -> None:
        shutil.rmtree(self.temporary, ignore_errors=True)


class PackSource(DataSource):
    """ZIP packs. Reading gives members; writing takes (pack, member, content) rows, dealt and sorted by write_packs."""

    @classmethod
    def name(cls) -> str:
        return "zip_pack"

    def schema(self) -> str:
        return "path string, member string, sha256 string, content binary, problem string"

    def _guard(self) -> Guard:
        known = Guard()
        return Guard(**{f: int(self.options.get(f, getattr(known, f))) for f in known.__dataclass_fields__})

    def reader(self, schema) -> PackReader:
        return PackReader(mounted(self.options["path"]), self._guard())

    def writer(self, schema, overwrite: bool) -> PackWriter:
        return PackWriter(mounted(self.options["path"]), overwrite, self._guard())


def open_packs(spark: SparkSession, path: str, **guard: int) -> DataFrame:
    """(path, member, sha256, content, problem) of the packs of a mounted folder, a task for some members; of a refused pack one row with the problem. guard: fields of Guard."""
    spark.dataSource.register(PackSource)
    return spark.read.format("zip_pack").options(**guard).load(path)


def write_packs(rows: DataFrame, path: str, order: Sequence[str] = (), **guard: int) -> None:
    """Writes rows (pack, member, content binary, ...) as <path>/<pack>.zip; a member is its rows' contents in order. A pack is a file and so one task's; equal rows give equal bytes."""
    spark = rows.sparkSession
    spark.dataSource.register(PackSource)
    dealt = rows.repartition("pack").sortWithinPartitions("pack", "member", *order)
    dealt.select("pack", "member", "content").write.format("zip_pack").mode("append").options(**guard).save(path)
