"""Packs with rules of their own: corrections to be made, and translations that come back.

Reading never stops at the first fault: each gives its relations and a relation of
issues (path, member, code); a pack is good if it has no row there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanframe.operators.ordering import written
from spanframe.sources import jsonlines

#: Fixed members of a correction pack.
INSTRUCTIONS, HOLES, CANDIDATES, MANIFEST, REPORT = "INSTRUCTIONS.md", "speech_holes.jsonl", "asr_hallucinations.jsonl", "manifest.json", "translation_report.json"
UTTERANCE = "utterance_uid string, start_ms bigint, end_ms bigint, text string"
HOLE = "hole_uid string, clip_start_ms bigint, clip_end_ms bigint, audio_member string, audio_sha256 string, audio_size_bytes bigint"
CANDIDATE = "candidate_uid string, utterance_uid string, clip_start_ms bigint, clip_end_ms bigint, audio_member string, audio_sha256 string, audio_size_bytes bigint"
MANIFEST_KIND = (
    "format string, format_version int, episode int, batch_count int, utterance_count int, speech_hole_count int, asr_hallucination_count int, file_sha256 map<string,string>, input_sha256 string, "
    "batches array<struct<input_file:string,output_file:string,sha256:string,utterance_count:int,first_utterance_uid:string,last_utterance_uid:string>>"
)
#: A clip is mono, 16 kHz, two bytes a sample: 32 bytes a millisecond behind a header of 44.
WAV_HEADER, WAV_BYTES_A_MS = 44, 32
#: Most clips of a pack, of each kind and of both, and their bytes in all.
MOST_CLIPS, MOST_CLIPS_OF_BOTH, MOST_CLIP_BYTES = 512, 1000, 96 << 20


def _json(*columns: str) -> Column:
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def _fields(kind: str) -> list[str]:
    return [f.split(" ")[0] for f in kind.split(", ")]


def wav(start_ms: Column, end_ms: Column) -> Column:
    """A silent clip of that length, as its bytes. For fixtures and gaps."""
    n = ((end_ms - start_ms) * WAV_BYTES_A_MS).cast("int")
    digits = lambda x: F.lpad(F.hex(x), 8, "0")
    little = lambda x: F.unhex(F.concat(*[F.substring(digits(x), k, 2) for k in (7, 5, 3, 1)]))
    head = F.concat(F.lit(b"RIFF"), little(n + 36), F.lit(b"WAVEfmt \x10\x00\x00\x00\x01\x00\x01\x00\x80\x3e\x00\x00\x00\x7d\x00\x00\x02\x00\x10\x00data"), little(n))
    return F.concat(head, F.unhex(F.repeat(F.lit("00"), n)))


def correction_members(utterances: DataFrame, holes: DataFrame, candidates: DataFrame, instructions: str, format_name: str = "correction-input", batch_rows: int = 200) -> DataFrame:
    """(pack, member, at, content) for write_packs, of utterances (pack, episode, position from 0, UTTERANCE), holes (pack, position, HOLE's, clip binary) and candidates likewise.

    The manifest names each batch with its digest, count, first and last uid. A
    batch has batch_rows rows, and so a bounded digest; a pack has a bounded
    number of clips.
    """
    line = lambda df, kind: df.select("pack", "position", _json(*_fields(kind)).alias("line"))
    batch = utterances.withColumn("batch", F.floor(F.col("position") / batch_rows) + 1)
    lines = batch.select("pack", "episode", "batch", "position", "utterance_uid", _json(*_fields(UTTERANCE)).alias("line"))
    in_order = lambda value: F.transform(F.array_sort(F.collect_list(F.struct("position", value))), lambda r: r[value])
    payload = lambda values: F.concat(F.array_join(values, "\n"), F.lit("\n"))
    batches = lines.groupBy("pack", "batch").agg(F.min("episode").alias("episode"), in_order("line").alias("lines"), F.min_by("utterance_uid", "position").alias("first_utterance_uid"), F.max_by("utterance_uid", "position").alias("last_utterance_uid"))
    named = batches.withColumns({"input_file": F.format_string("batch_%03d.jsonl", "batch"), "output_file": F.format_string("corrected_batch_%03d.jsonl", "batch"), "sha256": F.sha2(payload(F.col("lines")), 256), "utterance_count": F.size("lines")})
    own = named.groupBy("pack").agg(F.min("episode").alias("episode"), F.count("*").alias("batch_count"), F.sum("utterance_count").alias("utterance_count"), F.transform(F.array_sort(F.collect_list(F.struct("batch", "input_file", "output_file", "sha256", "utterance_count", "first_utterance_uid", "last_utterance_uid"))), lambda b: b.dropFields("batch")).alias("batches"))
    files = []
    for df, kind, member, count in ((holes, HOLE, HOLES, "speech_hole_count"), (candidates, CANDIDATE, CANDIDATES, "asr_hallucination_count")):
        of = line(df, kind).groupBy("pack").agg(in_order("line").alias("lines"))
        every = utterances.select("pack").distinct().join(of, "pack", "left").select("pack", F.coalesce("lines", F.array().cast("array<string>")).alias("lines"))
        text = F.when(F.size("lines") == 0, "").otherwise(payload(F.col("lines")))
        files.append(every.select("pack", F.lit(member).alias("member"), text.alias("text"), F.size("lines").alias(count)))
    manifest = own
    for f, count, name in zip(files, ("speech_hole_count", "asr_hallucination_count"), ("h", "c"), strict=True):
        manifest = manifest.join(f.select("pack", count, F.sha2("text", 256).alias(name)), "pack")
    manifest = manifest.withColumns({"format": F.lit(format_name), "format_version": F.lit(1), "file_sha256": F.create_map(F.lit(HOLES), "h", F.lit(CANDIDATES), "c", F.lit(INSTRUCTIONS), F.sha2(F.lit(instructions), 256))})
    manifest = manifest.withColumn("input_sha256", F.sha2(_json("episode", "batches", "file_sha256"), 256))
    texts = [manifest.select("pack", F.lit(MANIFEST).alias("member"), _json(*_fields(MANIFEST_KIND)).alias("text")), utterances.select("pack").distinct().select("pack", F.lit(INSTRUCTIONS).alias("member"), F.lit(instructions).alias("text"))]
    texts += [f.select("pack", "member", "text") for f in files]
    out = [t.select("pack", "member", F.lit(0).cast("bigint").alias("at"), F.col("text").cast("binary").alias("content")) for t in texts]
    out.append(lines.select("pack", F.format_string("batch_%03d.jsonl", "batch").alias("member"), F.col("position").cast("bigint").alias("at"), F.concat("line", F.lit("\n")).cast("binary").alias("content")))
    out += [df.select("pack", F.col("audio_member").alias("member"), F.lit(0).cast("bigint").alias("at"), F.col("clip").alias("content")) for df in (holes, candidates)]
    return reduce(DataFrame.unionByName, out)


def _lines(members: DataFrame, pattern: str, kind: str) -> DataFrame:
    """(path, member, line, problem, fields of kind): strict JSON lines; a line with other fields than kind's has a problem."""
    rows = members.filter(F.col("problem").isNull() & F.col("member").rlike(pattern)).select("path", "member", F.posexplode(F.split(F.col("content").cast("string"), "\r\n|\n")).alias("line", "value")).withColumn("line", F.col("line") + 1).filter(F.trim("value") != "")
    checked = jsonlines.checked(rows)
    same = F.array_sort(F.json_object_keys("value")) == F.array(*map(F.lit, sorted(_fields(kind))))
    problem = F.coalesce("problem", F.when(~F.coalesce(same, F.lit(False)), "other fields"))
    return checked.select("path", "member", "line", problem.alias("problem"), F.from_json("value", kind).alias("v")).select("path", "member", "line", "problem", "v.*")


def read_corrections(members: DataFrame, format_name: str = "correction-input") -> dict[str, DataFrame]:
    """manifests, utterances, holes, candidates (path, line and their own columns) and issues of correction packs; members: what open_packs or read_packs gives.

    A refused or broken pack has its problem as issue and no rows elsewhere.
    Members are read once, and written to the shared folder with what each rule asks for.
    """
    members = written(members, "members")
    sizes = members.select("path", "member", "sha256", F.length("content").cast("bigint").alias("bytes"))
    refused = members.filter("problem IS NOT NULL").select("path", "member", F.lit("refused").alias("code"))
    good = members.join(refused.select("path").distinct(), "path", "left_anti")
    text = jsonlines.checked(good.filter(F.col("member") == MANIFEST).select("path", F.col("content").cast("string").alias("value")))
    same = F.array_sort(F.json_object_keys("value")) == F.array(*map(F.lit, sorted(_fields(MANIFEST_KIND))))
    parsed = text.withColumn("m", F.from_json("value", MANIFEST_KIND)).withColumn("ok", F.col("problem").isNull() & F.coalesce(same, F.lit(False)))
    manifests = written(parsed.filter("ok").select("path", "m.*"), "manifests")
    utterances, holes, candidates = (written(_lines(good, pattern, kind), "lines") for pattern, kind in ((r"^batch_\d{3}\.jsonl$", UTTERANCE), (r"^speech_holes\.jsonl$", HOLE), (r"^asr_hallucinations\.jsonl$", CANDIDATE)))
    issue = lambda df, member, code, when: df.filter(F.coalesce(when, F.lit(True))).select("path", (member if isinstance(member, Column) else F.lit(member)).alias("member"), F.lit(code).alias("code"))
    found = [refused, issue(parsed, MANIFEST, "manifest_fields", ~F.col("ok"))]
    found.append(good.select("path").distinct().join(parsed.select("path"), "path", "left_anti").select("path", F.lit(MANIFEST).alias("member"), F.lit("missing").alias("code")))
    found.append(issue(manifests, MANIFEST, "wrong_format", (F.col("format") != format_name) | (F.col("format_version") != 1) | (F.col("episode") < 1)))
    # members: those that must be there, and no others
    clips = holes.select("path", F.col("audio_member").alias("member"), F.col("audio_sha256").alias("sha"), F.col("audio_size_bytes").alias("size"), (F.col("clip_end_ms") - F.col("clip_start_ms")).alias("ms"), F.lit("h").alias("kind")).unionByName(
        candidates.select("path", F.col("audio_member").alias("member"), F.col("audio_sha256").alias("sha"), F.col("audio_size_bytes").alias("size"), (F.col("clip_end_ms") - F.col("clip_start_ms")).alias("ms"), F.lit("c").alias("kind"))
    )
    static = F.array(*map(F.lit, [MANIFEST, INSTRUCTIONS, HOLES, CANDIDATES]))
    wanted = manifests.select("path", F.explode(F.concat(static, F.transform("batches", lambda b, k: F.format_string("batch_%03d.jsonl", k + 1)))).alias("member")).unionByName(clips.select("path", "member")).distinct()
    held = sizes.join(manifests.select("path"), "path", "left_semi")
    found.append(wanted.join(held.select("path", "member"), ["path", "member"], "left_anti").withColumn("code", F.lit("missing")))
    found.append(held.select("path", "member").join(wanted, ["path", "member"], "left_anti").withColumn("code", F.lit("extra")))
    # batches against their descriptors
    described = manifests.select("path", F.posexplode("batches").alias("k", "b")).select("path", (F.col("k") + 1).alias("k"), "b.*")
    found.append(issue(manifests, MANIFEST, "batch_count", F.size("batches") != F.col("batch_count")))
    found.append(issue(described, F.col("input_file"), "batch_names", (F.col("input_file") != F.format_string("batch_%03d.jsonl", "k")) | (F.col("output_file") != F.format_string("corrected_batch_%03d.jsonl", "k"))))
    counted = utterances.groupBy("path", "member").agg(F.count("*").alias("n"), F.min_by("utterance_uid", "line").alias("first"), F.max_by("utterance_uid", "line").alias("last"))
    both = described.join(sizes.withColumnsRenamed({"member": "input_file", "sha256": "now"}).drop("bytes"), ["path", "input_file"]).join(counted.withColumnRenamed("member", "input_file"), ["path", "input_file"], "left")
    found.append(issue(both, F.col("input_file"), "digest_differs", F.col("sha256") != F.col("now")))
    found.append(issue(both, F.col("input_file"), "count_differs", F.coalesce("n", F.lit(0)) != F.col("utterance_count")))
    found.append(issue(both.filter("n IS NOT NULL"), F.col("input_file"), "ends_differ", ~(F.col("first").eqNullSafe(F.col("first_utterance_uid")) & F.col("last").eqNullSafe(F.col("last_utterance_uid")))))
    files = manifests.select("path", F.explode("file_sha256").alias("member", "sha"))
    found.append(issue(files.join(sizes, ["path", "member"]), F.col("member"), "digest_differs", F.col("sha") != F.col("sha256")))
    found.append(issue(manifests, MANIFEST, "file_digests", F.array_sort(F.map_keys("file_sha256")) != F.array_sort(F.array(F.lit(HOLES), F.lit(CANDIDATES), F.lit(INSTRUCTIONS)))))
    # counts, ids, clips
    totals = lambda df, name: df.groupBy("path").agg(F.count("*").alias(name))
    counts = manifests.join(totals(utterances, "nu"), "path", "left").join(totals(holes, "nh"), "path", "left").join(totals(candidates, "nc"), "path", "left").fillna(0, ["nu", "nh", "nc"])
    found.append(issue(counts, MANIFEST, "counts_differ", (F.col("nu") != F.col("utterance_count")) | (F.col("nh") != F.col("speech_hole_count")) | (F.col("nc") != F.col("asr_hallucination_count"))))
    found.append(issue(counts, MANIFEST, "input_digest", F.sha2(_json("episode", "batches", "file_sha256"), 256) != F.col("input_sha256")))
    found.append(issue(counts, MANIFEST, "too_many_clips", (F.col("nh") > MOST_CLIPS) | (F.col("nc") > MOST_CLIPS) | (F.col("nh") + F.col("nc") > MOST_CLIPS_OF_BOTH)))
    for rows, key in ((utterances, "utterance_uid"), (holes, "hole_uid"), (candidates, "candidate_uid")):
        found.append(rows.filter("problem IS NOT NULL").select("path", "member", F.lit("bad_line").alias("code")))
        found.append(rows.groupBy("path", key).agg(F.count("*").alias("n"), F.min("member").alias("member")).filter(f"n > 1 OR {key} IS NULL").select("path", "member", F.lit("double_id").alias("code")))
    found.append(clips.groupBy("path", "member").count().filter("count > 1").select("path", "member", F.lit("double_clip").alias("code")))
    found.append(candidates.select("path", "member", "utterance_uid").join(utterances.select("path", "utterance_uid"), ["path", "utterance_uid"], "left_anti").select("path", "member", F.lit("unknown_utterance").alias("code")))
    heard = clips.join(good.select("path", "member", "sha256", F.length("content").alias("bytes"), (F.substring("content", 1, 4) == F.lit(b"RIFF")).alias("riff"), (F.substring("content", 9, 4) == F.lit(b"WAVE")).alias("wave")), ["path", "member"])
    found.append(issue(heard, F.col("member"), "clip_differs", (F.col("bytes") != F.col("size")) | (F.col("sha") != F.col("sha256"))))
    found.append(issue(heard, F.col("member"), "no_clip", ~F.col("riff") | ~F.col("wave") | (F.col("bytes") != WAV_HEADER + F.col("ms") * WAV_BYTES_A_MS)))
    found.append(heard.groupBy("path").agg(F.sum("bytes").alias("all")).filter(F.col("all") > MOST_CLIP_BYTES).select("path", F.lit(MANIFEST).alias("member"), F.lit("clips_too_large").alias("code")))
    found.append(issue(good.filter(F.col("member") == INSTRUCTIONS), INSTRUCTIONS, "no_instructions", F.trim(F.col("content").cast("string")) == ""))
    return {"manifests": manifests, "utterances": utterances, "holes": holes, "candidates": candidates, "issues": reduce(DataFrame.unionByName, found).distinct()}


RETURNED = "uid string, target string, review_required boolean, note string"


def read_returns(members: DataFrame, expected: DataFrame) -> dict[str, DataFrame]:
    """records (path, batch, line, RETURNED), reports (path, value) and issues of translations that came back; expected: (path, batch, position in the batch from 1, uid) of what was sent.

    A pack has the expected batches and a report, and nothing else; a batch has
    the uids that were sent in it, in their order, and no empty translation. Members are read once.
    """
    members = written(members, "members")
    refused = members.filter("problem IS NOT NULL").select("path", "member", F.lit("refused").alias("code"))
    good = members.join(refused.select("path").distinct(), "path", "left_anti")
    name = F.format_string("translated_batch_%03d.jsonl", "batch")
    batches = expected.groupBy("path", "batch").agg(F.count("*").alias("sent")).withColumn("member", name)
    here = good.select("path").distinct()
    wanted = batches.select("path", "member").unionByName(expected.select("path").distinct().select("path", F.lit(REPORT).alias("member"))).join(here, "path", "left_semi")
    held = good.select("path", "member")
    records = written(_lines(good, r"^translated_batch_\d{3}\.jsonl$", RETURNED).withColumn("batch", F.regexp_extract("member", r"(\d+)", 1).cast("bigint")), "records")
    report = jsonlines.checked(good.filter(F.col("member") == REPORT).select("path", "member", F.col("content").cast("string").alias("value")))
    compared = records.filter("problem IS NULL").select("path", "member", "batch", F.col("line").cast("bigint").alias("position"), F.col("uid").alias("got"), "target")
    sent = expected.select("path", "batch", F.col("position").cast("bigint").alias("position"), "uid")
    there = held.filter(F.col("member") != REPORT).select("path", F.regexp_extract("member", r"(\d+)", 1).cast("bigint").alias("batch"))
    placed = sent.join(there, ["path", "batch"], "left_semi").join(compared, ["path", "batch", "position"], "full_outer")
    at = F.coalesce("member", name)
    code = F.when(F.col("uid").isNull(), "extra_record").when(F.col("got").isNull(), "missing_record").when(F.col("uid") != F.col("got"), "other_uid").when(F.trim(F.coalesce("target", F.lit(""))) == "", "empty_target")
    lines_of = records.groupBy("path", "member").count()
    found = [
        refused,
        expected.select("path").distinct().join(members.select("path"), "path", "left_anti").select("path", F.lit(None).cast("string").alias("member"), F.lit("no_pack").alias("code")),
        wanted.join(held, ["path", "member"], "left_anti").withColumn("code", F.lit("missing")),
        held.join(wanted, ["path", "member"], "left_anti").withColumn("code", F.lit("extra")),
        held.join(batches, ["path", "member"], "left_semi").join(lines_of, ["path", "member"], "left_anti").withColumn("code", F.lit("empty_batch")),
        records.filter("problem IS NOT NULL").select("path", "member", F.lit("bad_line").alias("code")),
        report.filter("problem IS NOT NULL").select("path", "member", F.lit("bad_report").alias("code")),
        records.groupBy("path", "uid").agg(F.count("*").alias("n"), F.min("member").alias("member")).filter("n > 1 AND uid IS NOT NULL").select("path", "member", F.lit("double_uid").alias("code")),
        placed.withColumn("code", code).filter("code IS NOT NULL").select("path", at.alias("member"), "code"),
    ]
    return {"records": records, "reports": report.filter("problem IS NULL").select("path", "value"), "issues": reduce(DataFrame.unionByName, found).distinct()}
