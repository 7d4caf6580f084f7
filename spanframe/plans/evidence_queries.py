"""Queries of names, word gates, speakers, group statistics, repairs and remembered units; importing this adds them to queries.QUERIES."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanframe.functions import names, text
from spanframe.plans import captions, checks, semantic
from spanframe.plans.queries import USER, query
from spanframe.plans.relations import IV, event_intervals, table, union_sql
from spanframe.plans.row_queries import folder
from spanframe.sources import captions as recognised
from spanframe.streaming import incremental, memory

#: Names of a list, and how many it has at most.
MOST_NAMES = 1000


def listed_names(spark: SparkSession, d: str, most: int = MOST_NAMES) -> list[str]:
    """The first words of four letters or more, by code point, that passages of the benchmark begin sentences with or hold."""
    words = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[\p{L}]{4,}"), 0)).alias("w")).distinct()
    return [r["w"] for r in words.orderBy("w").limit(most).collect()]


@query(f"""WITH names AS (SELECT DISTINCT unnest(regexp_extract_all(coalesce(text, ''), '\\p{{L}}{{4,}}')) AS w FROM benchmark ORDER BY w LIMIT {MOST_NAMES}),
t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS w FROM documents)
SELECT doc_id, array_to_string(list(w ORDER BY w), ',') AS known FROM t JOIN names USING (w) GROUP BY doc_id""")
def known_names_documents(spark: SparkSession, d: str) -> DataFrame:
    """Which of a thousand names each text holds."""
    found = table(spark, d, "documents").select("doc_id", names.names_in(F.col("text"), listed_names(spark, d)).alias("found"))
    return found.filter("size(found) > 0").select("doc_id", F.array_join("found", ",").alias("known"))


def variant_tables(listed: list[str]) -> tuple[list[str], dict[str, list[str]], dict[str, list[str]]]:
    """(names, required variants, optional ones): of a list every third is a name, the next one a variant that must be replaced, the third one that may be."""
    own = listed[::3]
    return own, {n: [v] for n, v in zip(own, listed[1::3], strict=False)}, {n: [v, f"{v} {n}"] for n, v in zip(own, listed[2::3], strict=False)}


@query()
def name_sets_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Every reading of a turn under variants of names, and the sets of names that it may mean."""
    own, required, optional = variant_tables(listed_names(spark, d, 300))
    turns = table(spark, d, "conversations")
    found = turns.select("conv_id", "turn", names.canonical(F.col("text"), required).alias("canonical"), names.readings_of(F.col("text"), required, optional).alias("readings"), names.name_sets(F.col("text"), own, required, optional).alias("sets"))
    return found.select("conv_id", "turn", "canonical", F.array_join("readings", "\n").alias("readings"), F.array_join(F.transform("sets", lambda s: F.array_join(s, ",")), "|").alias("sets"))


@query(f"""WITH {IV}, w AS (SELECT event_id, user_id, event_type, start_ms, end_ms + 7200000 AS end_ms FROM iv WHERE event_type <> 'signup'), v AS (SELECT user_id, start_ms - 3600000 AS vs, end_ms + 3600000 AS ve FROM iv WHERE event_type = 'signup'),
h AS (SELECT w.*, vs, ve FROM w JOIN v ON v.user_id = w.user_id AND vs < end_ms AND start_ms < ve),
s AS (SELECT event_id, sum(least(end_ms, ve) - greatest(start_ms, vs)) AS overlap_ms, min(vs) AS first, arg_max(ve, (vs, ve)) AS last FROM h GROUP BY 1),
c AS (SELECT event_id, greatest(start_ms, vs) AS s, least(end_ms, ve) AS e, start_ms, end_ms FROM h),
g AS (SELECT event_id, s - coalesce(max(e) OVER (PARTITION BY event_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), start_ms) AS gap FROM c UNION ALL SELECT event_id, min(end_ms) - max(e) FROM c GROUP BY event_id),
m AS (SELECT event_id, greatest(0, max(gap)) AS outside FROM g GROUP BY 1),
r AS (SELECT w.*, CAST(coalesce(overlap_ms, 0) AS BIGINT) AS o, first, last, CAST(coalesce(outside, end_ms - start_ms) AS BIGINT) AS outside FROM w LEFT JOIN s USING (event_id) LEFT JOIN m USING (event_id))
SELECT event_id, o AS overlap_ms, o / (end_ms - start_ms) AS ratio, CASE WHEN first IS NULL THEN end_ms - start_ms ELSE greatest(first, start_ms) - start_ms END AS leading, CASE WHEN first IS NULL THEN end_ms - start_ms ELSE end_ms - least(last, end_ms) END AS trailing, outside AS longest_outside,
CASE WHEN o / (end_ms - start_ms) >= 0.5 AND outside <= 1200000 THEN 'compliant' WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'exception' ELSE 'unsafe' END AS verdict FROM r""")
def word_gate_events(spark: SparkSession, d: str) -> DataFrame:
    """Events as words, an hour around sign-ups as speech; every second view has a review that holds it."""
    ev = event_intervals(spark, d)
    words = ev.filter("event_type <> 'signup'").withColumn("end_ms", F.col("end_ms") + 7_200_000)
    vad = ev.filter("event_type = 'signup'").select("user_id", (F.col("start_ms") - 3_600_000).alias("start_ms"), (F.col("end_ms") + 3_600_000).alias("end_ms"))
    reviews = words.filter("event_type = 'view'").select("event_id", (F.col("start_ms") + F.col("event_id") % 2).alias("start_ms"), "end_ms")
    return captions.word_gate(words.select("user_id", "event_id", "start_ms", "end_ms"), vad, reviews, USER, "event_id", "event_id", most_outside=1_200_000)


@query(f"""WITH {IV}, s AS (SELECT user_id, event_id, start_ms, end_ms FROM iv WHERE event_type = 'signup'), t AS (SELECT user_id, event_type AS speaker, start_ms - 43200000 AS ts, end_ms + 43200000 AS te FROM iv WHERE event_type <> 'signup'),
c AS (SELECT s.event_id, speaker, greatest(start_ms, ts) AS start_ms, least(end_ms, te) AS end_ms FROM s JOIN t ON t.user_id = s.user_id AND ts < end_ms AND start_ms < te),
u AS ({union_sql('c', 'event_id, speaker')}), a AS (SELECT event_id, count(DISTINCT speaker) AS n, min(speaker) AS one, sum(end_ms - start_ms) AS covered FROM u GROUP BY 1)
SELECT s.event_id, CASE WHEN n = 1 AND covered >= 0.8 * (end_ms - start_ms) THEN one END AS speaker FROM s LEFT JOIN a USING (event_id)""")
def span_speakers_events(spark: SparkSession, d: str) -> DataFrame:
    ev = event_intervals(spark, d)
    turns = ev.filter("event_type <> 'signup'").select("user_id", F.col("event_type").alias("speaker"), (F.col("start_ms") - 43_200_000).alias("start_ms"), (F.col("end_ms") + 43_200_000).alias("end_ms"))
    return captions.span_speakers(ev.filter("event_type = 'signup'"), turns, USER, "event_id")


@query(f"""WITH {IV}, w AS (SELECT user_id, event_id, start_ms // 604800000 AS part, start_ms, end_ms, value / 1000 AS probability, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS segment_id, event_id % 4 = 1 OR event_id % 4 = 2 AS repaired, CASE WHEN event_id % 11 = 0 THEN 'y' WHEN event_id % 3 > 0 THEN 'x' END AS digest FROM iv),
m AS (SELECT *, start_ms - lag(end_ms) OVER o AS gap, coalesce(segment_id <> last_value(segment_id IGNORE NULLS) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS crosses FROM w WINDOW o AS (PARTITION BY user_id, part ORDER BY start_ms, end_ms)),
g AS (SELECT user_id, part, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n_words, coalesce(max(gap), 0) AS max_gap, min(probability) AS least_probability, avg(probability) AS mean_probability, count(DISTINCT segment_id) AS segments, count(*) FILTER (crosses) AS crossings, count(*) FILTER (repaired) AS repaired, count(DISTINCT digest) AS digests, count(*) FILTER (digest IS NULL) AS without_digest FROM m GROUP BY 1, 2),
v AS (SELECT user_id, event_id AS i, start_ms AS vs, end_ms AS ve FROM iv WHERE event_type = 'signup'), h AS (SELECT g.user_id, part, i, greatest(start_ms, vs) AS start_ms, least(end_ms, ve) AS end_ms FROM g JOIN v ON v.user_id = g.user_id AND vs < end_ms AND start_ms < ve),
u AS (SELECT user_id, part, sum(end_ms - start_ms) AS covered FROM ({union_sql('h', 'user_id, part')}) GROUP BY 1, 2), x AS (SELECT user_id, part, array_to_string(list(DISTINCT i ORDER BY i), ',') AS regions FROM h GROUP BY 1, 2)
SELECT g.*, least(1.0, coalesce(covered, 0) / greatest(1, end_ms - start_ms)) AS coverage, coalesce(regions, '') AS regions,
concat_ws(',', CASE WHEN crossings > 0 THEN 'decoder_segment_crossing' END, CASE WHEN repaired > 0 THEN 'repaired_word_provenance' END, CASE WHEN digests > 0 AND without_digest > 0 THEN 'partial_alignment_digest' END, CASE WHEN digests > 1 THEN 'several_alignment_digests' END) AS flags
FROM g LEFT JOIN u USING (user_id, part) LEFT JOIN x USING (user_id, part)""")
def group_statistics_events(spark: SparkSession, d: str) -> DataFrame:
    """A user's events of a week as a group of words."""
    ev = event_intervals(spark, d)
    e = F.col("event_id")
    words = ev.select(
        "user_id", F.floor(F.col("start_ms") / 604_800_000).alias("part"), "start_ms", "end_ms", (F.col("value") / 1000).alias("probability"), F.when(e % 5 != 0, F.col("event_type")).alias("segment_id"),
        F.when(e % 4 == 1, "synthetic_even").when(e % 4 == 2, " gap_repair").when(e % 4 == 3, "native").alias("timing_source"), F.when(e % 11 == 0, "Y").when(e % 3 == 1, "x").when(e % 3 == 2, " X ").otherwise(" ").alias("alignment_sha256"),
    )
    vad = ev.filter("event_type = 'signup'").withColumn("vad_region_index", e)
    found = semantic.group_statistics(words, vad, USER, "part")
    return found.withColumns({"regions": F.array_join("regions", ","), "flags": F.array_join("flags", ",")})


@query("""WITH t AS (SELECT conv_id, turn, (conv_id + turn) % 6 AS kind, list_filter(string_split_regex(coalesce(text, ''), '[\\s\\p{Z}]+'), lambda w: w <> '') AS w FROM conversations)
SELECT conv_id, turn, CASE WHEN kind IN (0, 5) THEN array_to_string(w, ' ') || CASE WHEN len(w) > 0 THEN ' ' ELSE '' END || 'M.K.' END AS repaired FROM t""")
def repaired_initialisms_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Turns that end in M.K., with timed words that have it in six ways."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"(?U)[\s\p{Z}]+"), lambda w: w != "")
    rows = table(spark, d, "conversations").select("conv_id", "turn", words.alias("w"), ((F.col("conv_id") + F.col("turn")) % 6).alias("kind"))
    last = F.when(F.col("kind") == 0, F.array(F.lit(".K."))).when(F.col("kind") == 1, F.array(F.lit("M.K."))).when(F.col("kind") == 2, F.array(F.lit(".R."))).when(F.col("kind") == 3, F.array(F.lit("K."))).when(F.col("kind") == 4, F.array(F.lit(".K."), F.lit("."))).otherwise(F.array(F.lit(".k.")))
    segment = F.array_join(F.concat("w", F.array(F.lit("M.K."))), " ")
    return rows.select("conv_id", "turn", F.array_join(text.repaired_initialisms(segment, F.concat("w", last)), " ").alias("repaired"))


@query("""SELECT conv_id, turn, CASE (conv_id * 3 + turn) % 8 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS false_hit FROM conversations""")
def known_false_hits_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Decodes of short clips in eight ways, of which two are known false hits."""
    kind = (F.col("conv_id") * 3 + F.col("turn")) % 8
    said = F.when(kind == 0, "Subtitles: M K").when(kind == 7, F.col("text")).otherwise("Thank you for watching.")
    stages = F.create_map(F.lit("blind_padded"), F.when(kind == 4, "a word").otherwise(" "), F.when(kind == 5, "other").otherwise("prompted_padded"), F.lit(""))
    stage = F.when(kind == 2, "whole").when(kind == 6, None).otherwise("exact_target_crop")
    hit = text.known_false_hit(said, ["subtitles m k"], ["thank you for watching"], stage, kind != 3, stages)
    return table(spark, d, "conversations").select("conv_id", "turn", hit.alias("false_hit"))


@query(f"""WITH names AS (SELECT list(w ORDER BY w) AS n FROM (SELECT DISTINCT unnest(regexp_extract_all(coalesce(text, ''), '\\p{{L}}{{4,}}')) AS w FROM benchmark ORDER BY w LIMIT 40)),
b AS (SELECT conv_id, turn, turn AS i, n[CAST(turn % 20 AS INT) + 1] || ' and ' || n[CAST(turn % 20 AS INT) + 21] AS source, len(n) AS ln FROM conversations, names),
m AS (SELECT conv_id, i, source, coalesce(lead(source, 2) OVER (PARTITION BY conv_id ORDER BY i), source) AS back FROM b WHERE ln = 40),
c AS (SELECT conv_id, source, count(*) AS n, min(i) AS other FROM m GROUP BY ALL)
SELECT m.conv_id, m.i AS turn, CASE WHEN near.n = 1 THEN near.other ELSE c.other END AS other FROM m LEFT JOIN c ON c.conv_id = m.conv_id AND c.source = m.back AND c.n = 1
LEFT JOIN (SELECT a.conv_id, a.i, count(*) AS n, min(b.i) AS other FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.source = a.back AND abs(a.i - b.i) <= 6 GROUP BY ALL) near ON near.conv_id = m.conv_id AND near.i = m.i
WHERE m.back <> m.source AND (near.n = 1 OR near.n IS NULL AND c.n = 1)""")
def anchor_displacements_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Blocks with two names each, whose text came back from two blocks behind."""
    from pyspark.sql import Window

    listed = listed_names(spark, d, 40)
    pair = F.concat(F.get(F.array(*map(F.lit, listed)), (F.col("turn") % 20).cast("int")), F.lit(" and "), F.get(F.array(*map(F.lit, listed)), (F.col("turn") % 20 + 20).cast("int")))
    rows = table(spark, d, "conversations").select("conv_id", "turn", pair.alias("source")) if len(listed) == 40 else table(spark, d, "conversations").select("conv_id", "turn", F.lit("").alias("source"))
    moved = rows.withColumn("back", F.coalesce(F.lead("source", 2).over(Window.partitionBy("conv_id").orderBy("turn")), F.col("source")))
    return checks.anchor_displacements(moved, ["conv_id"], "turn", "source", "back", listed)


@query("""SELECT user_id, event_id, event_type AS input, upper(event_type) AS result, CASE WHEN coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) = event_type, false) THEN 'reused' ELSE 'computed' END AS state FROM events""")
def remembered_units_events(spark: SparkSession, d: str) -> DataFrame:
    """A stream of the events, a unit a user: what the last event asked for is given again, all else is computed."""
    at = folder(spark)
    schema = table(spark, d, "events").schema
    # a stream's path is a folder or a pattern
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]").select("user_id", "event_id", F.col("event_type").alias("input"))
    found = memory.remembered(stream, ["user_id"], "event_id", incremental.binding("upper", {}), str.upper)
    return memory.drained(found, f"{at}/out", f"{at}/checkpoint")


@query(f"""WITH {IV}, u AS (SELECT user_id, event_id, start_ms - 86400000 AS start_ms, end_ms + 86400000 AS end_ms FROM iv WHERE event_type = 'signup'), f AS (SELECT user_id, start_ms AS moment, value / 500 AS p, 1 - value / 500 AS q FROM iv WHERE event_type <> 'signup'),
h AS (SELECT event_id, greatest(p, q) AS top, CASE WHEN p >= q THEN 0 ELSE 1 END AS winner FROM u JOIN f ON f.user_id = u.user_id AND moment >= start_ms AND moment < end_ms),
v AS (SELECT event_id, winner, count(*) AS n, avg(top) AS mean, max(top) AS peak FROM h GROUP BY 1, 2), r AS (SELECT *, n / sum(n) OVER (PARTITION BY event_id) AS share, row_number() OVER (PARTITION BY event_id ORDER BY n DESC, winner) AS k FROM v)
SELECT u.event_id, CASE WHEN n >= 2 AND share >= 0.6 AND mean >= 0.6 AND peak >= 0.7 THEN winner END AS winner FROM u LEFT JOIN r ON r.event_id = u.event_id AND k = 1""")
def speaker_votes_events(spark: SparkSession, d: str) -> DataFrame:
    """A day around sign-ups as utterances; other events are frames that two speakers share by value."""
    ev = event_intervals(spark, d)
    frames = ev.filter("event_type <> 'signup'").select("user_id", F.col("start_ms").alias("at_ms"), F.array(F.col("value") / 500, 1 - F.col("value") / 500).alias("probabilities"))
    utterances = ev.filter("event_type = 'signup'").select("user_id", "event_id", (F.col("start_ms") - 86_400_000).alias("start_ms"), (F.col("end_ms") + 86_400_000).alias("end_ms"))
    return captions.speaker_votes(frames, utterances, USER, "event_id", least_frames=2, least_share=0.6, least_mean=0.6, least_peak=0.7)


@query(f"""WITH {IV}, i AS (SELECT user_id, event_id, start_ms, CASE WHEN event_type = 'signup' THEN end_ms + 86400000 ELSE end_ms END AS end_ms, event_type || CASE WHEN event_type = 'signup' THEN ' view click' ELSE CASE WHEN event_id % 3 = 0 THEN 'ed' ELSE '' END END AS text FROM iv),
c AS (SELECT *, string_split(text, ' ')[1] AS t FROM i WHERE len(string_split(text, ' ')) = 1), h AS (SELECT c.user_id, c.event_id, p.event_id AS parent, p.end_ms - p.start_ms AS long, list_contains(string_split(p.text, ' '), t) AS exact, 1 - list_min(list_transform(string_split(p.text, ' '), lambda x: levenshtein(x, t) / greatest(length(x), length(t)))) AS near
 FROM c JOIN i p ON p.user_id = c.user_id AND p.event_id <> c.event_id AND p.start_ms <= c.start_ms AND c.end_ms <= p.end_ms AND p.end_ms - p.start_ms >= 2 * (c.end_ms - c.start_ms)),
s AS (SELECT *, CASE WHEN exact THEN 1.0 ELSE near END AS similarity FROM h), r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY long DESC, similarity DESC, parent) AS k FROM s WHERE similarity >= 0.65)
SELECT user_id, event_id, parent, similarity FROM r WHERE k = 1""")
def acoustic_duplicates_events(spark: SparkSession, d: str) -> DataFrame:
    """A day behind sign-ups as long texts, other events as short ones inside them."""
    ev = event_intervals(spark, d)
    signup = F.col("event_type") == "signup"
    said = F.when(signup, F.concat("event_type", F.lit(" view click"))).otherwise(F.concat("event_type", F.when(F.col("event_id") % 3 == 0, "ed").otherwise("")))
    rows = ev.select("user_id", "event_id", "start_ms", F.when(signup, F.col("end_ms") + 86_400_000).otherwise(F.col("end_ms")).alias("end_ms"), said.alias("text"))
    return captions.acoustic_duplicates(rows, USER, "event_id", most_tokens=2)


@query(r"""WITH w AS (SELECT conv_id, turn, list_filter(string_split_regex(coalesce(text, ''), '[\s\p{Z}]+'), lambda x: x <> '') AS w FROM conversations),
e AS (SELECT conv_id, turn, unnest(w) AS text, generate_subscripts(w, 1) - 1 AS i FROM w)
SELECT conv_id, text, CAST(turn * 100000 + i * 300 AS BIGINT) AS start_ms, CAST(turn * 100000 + i * 300 + 250 AS BIGINT) AS end_ms, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) - 1 AS word_index FROM e WHERE i % 7 <> 3""")
def recognised_words_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as nested output of a recogniser, read back as words in order; every seventh word lasts no time and is no word."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"(?U)[\s\p{Z}]+"), lambda w: w != "")
    second = lambda i, more: ((F.col("turn") * 100_000 + i * 300 + more) / 1000).alias("x")
    each = F.transform(words, lambda w, i: F.struct(second(i, 0).alias("start"), second(i, F.when(i % 7 == 3, 0).otherwise(250)).alias("end"), w.alias("word"), F.lit(0.5).alias("probability")))
    segments = table(spark, d, "conversations").select("conv_id", "turn", F.struct((F.col("turn") * 100).cast("double").alias("start"), (F.col("turn") * 100 + 99).cast("double").alias("end"), F.col("text"), each.alias("words")).alias("s"))
    # a conversation's turns are one document of the recogniser
    whole = segments.groupBy("conv_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("turn", "s"))), lambda x: x["s"])).alias("found"))
    return recognised.words_from_json(whole, "conv_id", "found").select("conv_id", "text", "start_ms", "end_ms", "word_index")
