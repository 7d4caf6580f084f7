"""Queries of packs: written by the sink, read by the source, held against their own rules; importing this adds them to queries.QUERIES."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanframe.plans.queries import query
from spanframe.plans.relations import table
from spanframe.plans.row_queries import folder
from spanframe.sources import packs, typed_packs

#: Conversations of one pack.
OF_PACK = 8


def _number():
    """The number of a pack, from its path."""
    return F.regexp_extract("path", r"(\d+)\.zip$", 1).cast("bigint")


def _packed(turns: DataFrame) -> DataFrame:
    return turns.withColumn("pack", F.format_string("pack_%06d", F.floor(F.col("conv_id") / OF_PACK))).withColumn("at", F.col("conv_id") * 100_000 + F.col("turn"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def pack_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A member a conversation, a line a turn; written in two phases and read member by member."""
    at = folder(spark)
    rows = _packed(table(spark, d, "conversations"))
    line = F.concat(F.to_json(F.struct("conv_id", "role", "text", "turn"), {"ignoreNullFields": "false"}), F.lit("\n"))
    member = F.format_string("batch_%03d.jsonl", F.col("conv_id") % OF_PACK + 1)
    packs.write_packs(rows.select("pack", member.alias("member"), "at", line.cast("binary").alias("content")), at, ["at"])
    lines = packs.pack_lines(packs.open_packs(spark, at))
    return lines.select(F.from_json("value", "conv_id bigint, turn bigint, role string, text string").alias("v")).select("v.*")


def correction_packs(spark: SparkSession, d: str) -> DataFrame:
    """(path, ...) members of packs of corrections: a conversation's turns by its user are utterances, the others have clips. Of five packs one is left as it is."""
    turns = _packed(table(spark, d, "conversations")).withColumn("episode", F.floor(F.col("conv_id") / OF_PACK).cast("int") + 1)
    uid = F.format_string("u-%d-%d", "conv_id", "turn")
    timed = turns.withColumns({"utterance_uid": uid, "start_ms": F.col("turn") * 1000, "end_ms": F.col("turn") * 1000 + 800, "position": F.row_number().over(_by("pack", "at")) - 1})
    clips = turns.filter("turn % 2 = 1").withColumns({"clip_start_ms": F.col("turn") * 1000, "clip_end_ms": F.col("turn") * 1000 + 3 + F.col("conv_id") % 5})
    clips = clips.withColumn("clip", typed_packs.wav(F.col("clip_start_ms"), F.col("clip_end_ms"))).withColumns({"audio_sha256": F.sha2("clip", 256), "audio_size_bytes": F.length("clip").cast("bigint"), "position": F.row_number().over(_by("pack", "at")) - 1})
    holes = clips.filter("turn % 4 = 1").withColumns({"hole_uid": F.concat(F.lit("h"), uid), "audio_member": F.concat(F.lit("hole_"), uid, F.lit(".wav"))})
    doubts = clips.filter("turn % 4 = 3").withColumns({"candidate_uid": F.concat(F.lit("c"), uid), "utterance_uid": uid, "audio_member": F.concat(F.lit("doubt_"), uid, F.lit(".wav"))})
    made = typed_packs.correction_members(timed, holes, doubts, "Correct what is wrong.", batch_rows=10)
    kind = F.regexp_extract("pack", r"(\d+)", 1).cast("bigint") % 5
    # 1: instructions are changed; 2: no list of clips; 3: something else besides; 4: a batch with a line of another kind
    broken = made.filter(~((kind == 2) & (F.col("member") == typed_packs.HOLES)))
    broken = broken.withColumn("content", F.when((kind == 1) & (F.col("member") == typed_packs.INSTRUCTIONS), F.lit(b"Do nothing.")).when((kind == 4) & (F.col("at") == 0) & F.col("member").startswith("batch_001"), F.lit(b'{"utterance_uid":"u","utterance_uid":"v"}\n')).otherwise(F.col("content")))
    extra = made.filter((kind == 3) & (F.col("member") == typed_packs.MANIFEST)).withColumns({"member": F.lit("notes.txt"), "content": F.lit(b"more")})
    at = folder(spark)
    packs.write_packs(broken.unionByName(extra), at, ["at"], members=1024)
    return packs.open_packs(spark, at, members=1024)


def _by(key: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(order)


_TURNS = f"turns AS (SELECT *, conv_id // {OF_PACK} AS pack, row_number() OVER (PARTITION BY conv_id // {OF_PACK} ORDER BY conv_id, turn) - 1 AS position, 'u-' || conv_id || '-' || turn AS uid FROM conversations)"


@query(f"""WITH {_TURNS}, ps AS (SELECT DISTINCT pack FROM turns)
SELECT pack, 'INSTRUCTIONS.md' AS member, 'digest_differs' AS code FROM ps WHERE pack % 5 = 1
UNION ALL SELECT pack, 'speech_holes.jsonl', 'missing' FROM ps WHERE pack % 5 = 2
UNION ALL SELECT DISTINCT pack, 'hole_' || uid || '.wav', 'extra' FROM turns WHERE pack % 5 = 2 AND turn % 4 = 1
UNION ALL SELECT DISTINCT pack, 'manifest.json', 'counts_differ' FROM turns WHERE pack % 5 = 2 AND turn % 4 = 1
UNION ALL SELECT pack, 'notes.txt', 'extra' FROM ps WHERE pack % 5 = 3
UNION ALL SELECT pack, 'batch_001.jsonl', unnest(['digest_differs', 'bad_line', 'ends_differ']) FROM ps WHERE pack % 5 = 4
UNION ALL SELECT pack, 'asr_hallucinations.jsonl', 'unknown_utterance' FROM turns WHERE pack % 5 = 4 AND position = 0 AND turn % 4 = 3""")
def correction_pack_issues_conversations(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with each pack of corrections."""
    return typed_packs.read_corrections(correction_packs(spark, d))["issues"].select(_number().alias("pack"), "member", "code")


@query(f"""WITH {_TURNS}
SELECT 'utterance' AS kind, pack, uid AS id, turn * 1000 AS start_ms, turn * 1000 + 800 AS end_ms, text FROM turns WHERE pack % 5 = 0
UNION ALL SELECT 'hole', pack, 'h' || uid, turn * 1000, turn * 1000 + 3 + conv_id % 5, 'hole_' || uid || '.wav' FROM turns WHERE pack % 5 = 0 AND turn % 4 = 1
UNION ALL SELECT 'candidate', pack, 'c' || uid, turn * 1000, turn * 1000 + 3 + conv_id % 5, uid FROM turns WHERE pack % 5 = 0 AND turn % 4 = 3""")
def correction_pack_rows_conversations(spark: SparkSession, d: str) -> DataFrame:
    """The three typed relations of the packs without issues."""
    found = typed_packs.read_corrections(correction_packs(spark, d))
    bad = found["issues"].select("path").distinct()
    part = lambda name, *columns: found[name].join(bad, "path", "left_anti").select(F.lit(name.removesuffix("s")).alias("kind"), _number().alias("pack"), *[F.col(c).alias(n) for c, n in zip(columns, ("id", "start_ms", "end_ms", "text"), strict=True)])
    return part("utterances", "utterance_uid", "start_ms", "end_ms", "text").unionByName(part("holes", "hole_uid", "clip_start_ms", "clip_end_ms", "audio_member")).unionByName(part("candidates", "candidate_uid", "clip_start_ms", "clip_end_ms", "utterance_uid"))


def returned_packs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(members, what was sent) of translations that come back with faults by the pack's number."""
    turns = _packed(table(spark, d, "conversations")).withColumns({"batch": F.col("conv_id") % OF_PACK + 1, "uid": F.format_string("u-%d-%d", "conv_id", "turn"), "kind": F.floor(F.col("conv_id") / OF_PACK) % 6})
    sent = turns.withColumn("position", F.row_number().over(_by("conv_id", "turn")))
    # 1: the last batch of eight is left out; 2: no report; 3: an empty translation in each first line; 4: two first uids change places; 5: a line is left out
    back = sent.filter(~((F.col("kind") == 1) & (F.col("batch") == OF_PACK)) & ~((F.col("kind") == 5) & (F.col("position") == 2)))
    back = back.withColumns({"target": F.when((F.col("kind") == 3) & (F.col("position") == 1), " ").otherwise(F.concat(F.lit("t "), F.coalesce("text", F.lit("")))), "review_required": F.lit(False), "note": F.lit("")})
    back = back.withColumn("at", F.when((F.col("kind") == 4) & F.col("position").isin(1, 2), F.col("conv_id") * 100_000 + 3 - F.col("position")).otherwise(F.col("conv_id") * 100_000 + 10 + F.col("position")))
    line = F.concat(F.to_json(F.struct("note", "review_required", "target", "uid"), {"ignoreNullFields": "false"}), F.lit("\n")).cast("binary")
    lines = back.select("pack", F.format_string("translated_batch_%03d.jsonl", "batch").alias("member"), "at", line.alias("content"))
    reports = sent.filter("kind <> 2").select("pack").distinct().select("pack", F.lit(typed_packs.REPORT).alias("member"), F.lit(0).cast("bigint").alias("at"), F.lit(b'{"passed": true}').alias("content"))
    at = folder(spark)
    packs.write_packs(lines.unionByName(reports), at, ["at"])
    members = packs.open_packs(spark, at)
    path = F.concat(F.lit(packs.mounted(at) + "/"), "pack", F.lit(".zip"))
    return members, sent.select(path.alias("path"), F.col("batch").cast("bigint").alias("batch"), "position", "uid")


@query(f"""WITH s AS (SELECT conv_id, turn, conv_id // {OF_PACK} AS pack, conv_id // {OF_PACK} % 6 AS kind, conv_id % {OF_PACK} + 1 AS batch, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
f AS (SELECT *, printf('translated_batch_%03d.jsonl', batch) AS member FROM s)
SELECT DISTINCT pack, member, 'missing' AS code FROM f WHERE kind = 1 AND batch = {OF_PACK}
UNION ALL SELECT DISTINCT pack, 'translation_report.json', 'missing' FROM f WHERE kind = 2
UNION ALL SELECT pack, member, 'empty_target' FROM f WHERE kind = 3 AND position = 1
UNION ALL SELECT pack, member, 'other_uid' FROM f WHERE kind = 4 AND position = 1 AND n > 1
UNION ALL SELECT pack, member, 'other_uid' FROM f WHERE kind = 5 AND position = 2 AND n > 2
UNION ALL SELECT pack, member, 'missing_record' FROM f WHERE kind = 5 AND position = 2""")
def translation_return_issues_conversations(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with translations that came back."""
    members, sent = returned_packs(spark, d)
    return typed_packs.read_returns(members, sent)["issues"].select(_number().alias("pack"), "member", "code")
