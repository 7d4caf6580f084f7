"""Queries of the composite operators; importing this adds them to queries.QUERIES."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanframe.functions import text
from spanframe.operators import conflicts, intervals, sequences
from spanframe.plans import captions, checks, semantic
from spanframe.plans.queries import USER, query
from spanframe.plans.relations import IV, event_intervals, table
from spanframe.streaming import incremental


@query(f"""WITH {IV}, v AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY start_ms, event_id) - 1 AS INT) AS i, start_ms, end_ms FROM iv WHERE event_type = 'signup'),
w AS (SELECT user_id, start_ms, end_ms, event_type || ' ' || event_id AS text, CAST(row_number() OVER (PARTITION BY user_id ORDER BY start_ms, end_ms, event_type || ' ' || event_id) - 1 AS INT) AS sequence_index FROM iv WHERE event_type <> 'signup')
SELECT w.user_id, sequence_index, w.text AS normalized, min(v.i) AS region FROM w LEFT JOIN v ON w.user_id = v.user_id AND v.start_ms < w.end_ms AND w.start_ms < v.end_ms GROUP BY ALL""")
def word_timeline_events(spark, d):
    from pyspark.sql import Window

    ev = event_intervals(spark, d)
    vad = ev.filter("event_type = 'signup'").withColumn("vad_region_index", F.row_number().over(Window.partitionBy("user_id").orderBy("start_ms", "event_id")) - 1)
    words = ev.filter("event_type <> 'signup'").select("user_id", "start_ms", "end_ms", F.concat_ws(" ", "event_type", "event_id").alias("text"))
    return semantic.word_timeline(words, vad, USER).select("user_id", "sequence_index", "normalized", F.col("region.vad_region_index").alias("region"))


@query()
def semantic_windows_events(spark, d):
    ev = event_intervals(spark, d)
    words = ev.filter("event_type <> 'signup'").select("user_id", "start_ms", "end_ms", F.concat_ws(" ", "event_type", "event_id").alias("text"), F.col("event_type").alias("speaker_id"), F.lit("s").alias("scene_id"))
    vad = ev.filter("event_type = 'signup'").withColumn("vad_region_index", F.col("event_id"))
    found = semantic.semantic_windows(semantic.word_timeline(words, vad, USER), USER, hard_gap=36_000_000, longest=86_400_000)
    return found.select("user_id", "sequence_index", "window", "context_before", "context_after")


@query(f"""WITH {IV}, b AS (SELECT user_id, event_id, start_ms AS first_ms, end_ms AS last_ms, start_ms - 50 AS region_start, end_ms + 100 AS region_end, event_type AS text FROM iv),
s AS (SELECT *, least(greatest(0, greatest(first_ms - 80, region_start)), first_ms) AS start_ms, least(last_ms + 220, greatest(last_ms, region_end)) AS wanted FROM b),
n AS (SELECT *, lead(start_ms) OVER (PARTITION BY user_id ORDER BY first_ms, last_ms) AS following FROM s)
SELECT event_id, start_ms, CASE WHEN following - 80 >= last_ms THEN least(wanted, following - 80) ELSE wanted END AS end_ms FROM n""")
def final_blocks_events(spark, d):
    blocks = event_intervals(spark, d).select("user_id", "event_id", F.col("start_ms").alias("first_ms"), F.col("end_ms").alias("last_ms"), (F.col("start_ms") - 50).alias("region_start"), (F.col("end_ms") + 100).alias("region_end"), F.col("event_type").alias("text"))
    return semantic.final_blocks(blocks, USER).select("event_id", "start_ms", "end_ms")


@query()
def words_to_blocks_conversations(spark, d):
    lines = table(spark, d, "conversations").select("conv_id", "turn", "role", F.posexplode(F.split("text", r"\s+")).alias("i", "text")).filter("text <> ''")
    words = lines.select("conv_id", (F.col("turn") * 1_000_000 + F.col("i") * 350).alias("start_ms"), (F.col("turn") * 1_000_000 + F.col("i") * 350 + 300).alias("end_ms"), "text", F.col("role").alias("speaker_id"), F.lit(1.0).alias("probability"))
    return semantic.words_to_blocks(words, ["conv_id"]).select("conv_id", "speaker_id", "block", "start_ms", "last_ms", "text", "n_words", "display_end")


_SPOKEN = f"""{IV}, v AS (SELECT * FROM iv WHERE event_type = 'signup'), u AS (SELECT * FROM iv WHERE event_type <> 'signup'),
vu AS (SELECT user_id, min(start_ms) AS vs, max(end_ms) AS ve FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS k FROM
 (SELECT *, CASE WHEN start_ms <= max(end_ms) OVER (PARTITION BY user_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM v)) GROUP BY user_id, k),
o AS (SELECT u.event_id, sum(least(ve, end_ms) - greatest(vs, start_ms)) AS overlap_ms FROM u JOIN vu ON u.user_id = vu.user_id AND vs < end_ms AND start_ms < ve GROUP BY 1)"""


@query(f"""WITH {_SPOKEN}, r AS (SELECT u.event_id, value, CAST(coalesce(overlap_ms, 0) AS DOUBLE) / (end_ms - start_ms) AS overlap_ratio FROM u LEFT JOIN o USING (event_id)),
f AS (SELECT *, value > 400 AS structural, overlap_ratio = 0 AS none, overlap_ratio > 0 AND overlap_ratio <= 0.2 AS low, -value / 100 <= -0.8 AS lp, value / 200 >= 0.5 AS ns, value / 50 >= 2.4 AS cr, value > 300 AS tm FROM r)
SELECT event_id, overlap_ratio, concat_ws(',', CASE WHEN structural THEN 'structural' END, CASE WHEN none THEN 'no_overlap' END, CASE WHEN low THEN 'low_overlap' END, CASE WHEN lp THEN 'low_logprob' END, CASE WHEN ns THEN 'no_speech' END, CASE WHEN tm THEN 'temperature' END, CASE WHEN cr THEN 'compressed' END) AS reasons,
structural OR none OR low OR cr OR CAST(lp AS INT) + CAST(ns AS INT) + CAST(cr AS INT) + CAST(tm AS INT) >= 2 AS candidate FROM f""")
def doubtful_utterances_events(spark, d):
    ev = event_intervals(spark, d)
    spoken = ev.filter("event_type <> 'signup'").selectExpr("user_id", "event_id", "start_ms", "end_ms", "event_type AS text", "-value / 100 AS avg_logprob", "value / 200 AS no_speech_prob", "value / 50 AS compression_ratio", "CASE WHEN value > 300 THEN 1.0 ELSE 0.0 END AS temperature", "value > 400 AS structural")
    found = captions.doubtful_utterances(spoken, ev.filter("event_type = 'signup'").select("user_id", "start_ms", "end_ms"), USER, "event_id")
    return found.select("event_id", "overlap_ratio", F.array_join("reasons", ",").alias("reasons"), "candidate")


@query()
def orphan_captions_events(spark, d):
    ev = event_intervals(spark, d).withColumn("text", F.col("event_type"))
    caps = ev.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("caption_index"), "start_ms", "end_ms", "text")
    return captions.orphan_captions(caps, ev.filter("event_type = 'view'").select("user_id", "start_ms", "end_ms", "text"), ev.filter("event_type = 'signup'").select("user_id", "start_ms", "end_ms"), USER)


@query(f"""WITH {IV} SELECT event_id, printf('%02d:%02d:%02d,%03d', pos // 3600000, pos // 60000 % 60, pos // 1000 % 60, pos % 1000) AS stamp, pos AS parsed, greatest(0, a + shift) AS clip_start, least(80000000, b + shift) AS clip_end
FROM (SELECT *, CASE WHEN a < 0 THEN -a WHEN b > 80000000 THEN -least(b - 80000000, greatest(a, 0)) ELSE 0 END AS shift FROM (SELECT event_id, pos, pos - 750 AS a, pos + 850 AS b FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_id % 1500 ELSE start_ms % 90000000 END AS pos FROM iv)))""")
def timestamps_events(spark, d):
    at = event_intervals(spark, d).select("event_id", F.when(F.col("event_id") % 7 == 0, F.col("event_id") % 1500).otherwise(F.col("start_ms") % 90_000_000).alias("at"))
    stamp = at.withColumn("stamp", text.format_timestamp(F.col("at")))
    clip = text.clip_bounds(F.col("at"), F.col("at") + 100, F.lit(80_000_000).cast("bigint"))
    return stamp.select("event_id", "stamp", text.parse_timestamp(F.col("stamp")).alias("parsed"), clip["clip_start"].alias("clip_start"), clip["clip_end"].alias("clip_end"))


@query("""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t, text FROM documents)
SELECT doc_id, regexp_replace(text, '\\s+', '', 'g') = '' OR length(regexp_replace(regexp_replace(text, '\\s+', '', 'g'), '[^\\p{L}]', '', 'g')) < length(regexp_replace(text, '\\s+', '', 'g')) * 0.45
  OR (len(t) >= 4 AND len(list_filter(generate_series(1, greatest(len(t) - 3, 1)), lambda i: t[i] = t[i + 1] AND t[i] = t[i + 2] AND t[i] = t[i + 3])) > 0) AS strange FROM t""")
def strange_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", text.is_strange(F.col("text")).alias("strange"))


@query()
def conflict_free_options(spark, d):
    """Overlapping events of one user may stay or move behind their ends; those whose options can overlap are a component."""
    ev = event_intervals(spark, d)
    # those that overlap another one, by one window instead of a join of pairs
    busy = ev.join(sequences.interval_components(ev, USER, "event_id", "start_ms", "end_ms").select("event_id"), "event_id", "left_semi")
    word = lambda shift: F.array(F.struct((F.col("start_ms") + shift).alias("start_ms"), (F.col("end_ms") + shift).alias("end_ms"), F.col("event_type").alias("speaker_id")))
    options = F.array(*[F.struct(F.lit(i).cast("bigint").alias("option"), word(900_000 * i).alias("words"), F.array(F.lit(int(i == 0))).alias("score")) for i in range(4)])
    rows = busy.select("user_id", F.col("event_id").cast("string").alias("uid"), F.explode(options).alias("o")).select("user_id", "uid", "o.*")
    # one window over the options' words, and one union of its labels by member: no pairs are made
    words = rows.select("user_id", "uid", F.concat_ws("#", "uid", "option").alias("w"), F.explode("words").alias("t")).select("user_id", "uid", "w", "t.start_ms", "t.end_ms")
    runs = sequences.interval_components(words, USER, "w", "start_ms", "end_ms")
    labels = runs.select(F.substring_index("w", "#", 1).alias("uid"), F.concat(F.lit("run "), "component").alias("run")).distinct()
    parts = sequences.overlap_components(labels, "uid", "run").withColumnRenamed("node", "uid")
    found = conflicts.selected_options(rows.drop("user_id").join(parts, "uid"), "component", "uid", "option", "words", "score")
    return found.join(busy.select("user_id", F.col("event_id").cast("string").alias("uid")), "uid").select("user_id", "uid", "option", "solved")


@query()
def displaced_texts_conversations(spark, d):
    from pyspark.sql import Window

    rows = table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("source"))
    behind = F.coalesce(F.lead("source").over(Window.partitionBy("conv_id").orderBy("turn")), F.col("source"))
    # of some conversations the next turn comes back, of others the first half of it with a number of its own, or words that are nowhere
    numbered = F.concat(F.col("source"), F.lit(" "), F.col("turn").cast("string"))
    rows = rows.withColumn("source", F.when(F.col("conv_id") % 3 == 1, numbered).otherwise(F.col("source")))
    half = F.concat(F.array_join(F.slice(F.split("source", " "), 1, F.floor(F.size(F.split("source", " ")) / 2).cast("int") + 1), " "), F.lit(" "), (F.col("turn") + 1).cast("string"))
    moved = F.when(F.col("conv_id") % 3 == 0, behind).when((F.col("conv_id") % 3 == 1) & (F.col("turn") % 4 == 1), half).when((F.col("conv_id") % 3 == 1) & (F.col("turn") % 4 == 2), "quite unrelated xyzzy").otherwise(F.col("source"))
    return checks.displaced_texts(rows.withColumn("back", moved), ["conv_id"], "turn", "source", "back").select("conv_id", "turn", "offset", "reason")


@query()
def final_qa_conversations(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", (F.col("conv_id") * 1000 + F.col("turn")).alias("uid"), F.col("turn").alias("block_index"), (F.col("turn") * 4000).alias("start_ms"), (F.col("turn") * 4000 + 3500).alias("end_ms"), (F.col("turn") * 4000).alias("speech_start"), (F.col("turn") * 4000 + 3600).alias("speech_end"), F.col("text").alias("source"), F.col("text").alias("target"), F.lit(False).alias("review_required"))
    return checks.final_qa(rows, ["conv_id"], "uid", "source", "target")


@query("SELECT count(*) = 0 AS complete, count(*) AS \"left\" FROM orders WHERE o_orderstatus <> 'F'")
def all_published_orders(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_orderkey", "part")
    return incremental.all_published(orders, orders.filter("o_orderstatus = 'F'"))
