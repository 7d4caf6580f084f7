"""Queries of merged spans, stabilised selections and exact covers; importing this adds them to queries.QUERIES."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanframe.operators import conflicts, intervals, spans
from spanframe.plans import semantic, suspicion
from spanframe.plans.queries import USER, query
from spanframe.plans.relations import IV, event_intervals, table

DAY = 86_400_000


@query()
def budgeted_merge_events(spark, d):
    """Views and clicks of each user joined to five spans, none over ten days, and none across a sign-up."""
    ev = event_intervals(spark, d)
    rows = ev.filter("event_type IN ('view', 'click')").withColumn("types", F.array("event_type"))
    return spans.budgeted_merge(rows, USER, 5, ev.filter("event_type = 'signup'"), longest=10 * DAY, sets=["types"]).withColumn("types", F.array_join("types", ",")).withColumn("members", F.array_join("members", ","))


@query(f"""WITH RECURSIVE {IV}, o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_ms, end_ms, event_id) AS r FROM iv),
g AS (SELECT user_id, r, start_ms AS first_ms, end_ms AS reach, CAST(1 AS BIGINT) AS span FROM o WHERE r = 1
 UNION ALL SELECT o.user_id, o.r, CASE WHEN x THEN first_ms ELSE start_ms END, CASE WHEN x THEN greatest(reach, end_ms) ELSE end_ms END, g.span + CASE WHEN x THEN 0 ELSE 1 END
 FROM g JOIN o ON o.user_id = g.user_id AND o.r = g.r + 1, LATERAL (SELECT start_ms - reach <= 36000000 AND greatest(reach, end_ms) - first_ms <= 172800000 AS x))
SELECT user_id, span, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n_spans, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS reasons, max(CAST(floor(value) AS BIGINT)) AS priority, string_agg(event_id, ' ' ORDER BY r) AS ids
FROM g JOIN o USING (user_id, r) GROUP BY user_id, span""")
def capped_merge_events(spark, d):
    rows = event_intervals(spark, d).select("user_id", "event_id", "start_ms", "end_ms", F.array("event_type").alias("reasons"), F.floor("value").alias("priority"), F.col("event_id").cast("string").alias("ids"))
    found = spans.capped_merge(rows, USER, gap=36_000_000, longest=2 * DAY, ties=["event_id"], sets=["reasons"], greatest=["priority"], texts=["ids"])
    return found.withColumn("reasons", F.array_join("reasons", ","))


@query()
def suspicious_spans_conversations(spark, d):
    """Turns as segments of words with probabilities, held against the turn of the same conversation that overlaps them as a caption."""
    segments, captions = spoken_turns(table(spark, d, "conversations"))
    found = suspicion.suspicious_spans(segments, captions, ["conv_id"], "turn", names=["ra"], markers=[r"\[music"], merge_gap=400, longest=20_000)
    return found.withColumns({"reasons": F.array_join("reasons", ","), "segment_ids": F.array_join("segment_ids", ",")})


def spoken_turns(turns):
    """(segments, captions): every word of a turn lasts 300 ms and has a probability by its length; a caption is its turn in capitals, or the role's name for every fifth."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.col("turn").cast("bigint").alias("t")).withColumn("w", words)
    at = F.col("t") * 8000
    timed = F.transform("w", lambda x, i: F.struct((at + i * 300 + F.when(F.length(x) > 9, 40).otherwise(0)).alias("start_ms"), (at + i * 300 + 280).alias("end_ms"), (1.0 / (1 + F.length(x) / 4)).alias("probability")))
    segments = rows.select("conv_id", "turn", at.alias("start_ms"), (at + F.greatest(F.lit(1), F.size("w")) * 300).alias("end_ms"), "text", timed.alias("words"), (-0.1 * (F.col("t") % 12)).cast("double").alias("avg_logprob"), (F.col("t") % 10 / 10).cast("double").alias("no_speech_prob"))
    captions = rows.select("conv_id", (at + 100).alias("start_ms"), (at + 900).alias("end_ms"), F.when(F.col("t") % 5 == 4, F.col("role")).otherwise(F.upper("text")).alias("text"))
    return segments, captions


@query()
def merged_evidence_events(spark, d):
    """Views, and of clicks and sign-ups those that no view and no taken one before overlaps by half with the same tenth of value."""
    ev = event_intervals(spark, d).withColumns({"text": F.floor(F.col("value") / 25).cast("string"), "end_ms": F.col("end_ms") + 7_200_000})

    def same(a, b, overlap):
        length = lambda p: F.col(f"{p}end_ms") - F.col(f"{p}start_ms")
        return (F.col(f"{a}text") == F.col(f"{b}text")) & (overlap >= F.greatest(F.lit(1), F.floor(F.least(length(a), length(b)) / 2)))

    found = spans.merged_evidence(ev.filter("event_type = 'view'"), ev.filter("event_type <> 'view'"), USER, ["start_ms", "end_ms", "event_id"], same, ["text", "event_id"], usable=F.col("event_id") % 11 != 0)
    return found.select("event_id", "source")


def shifted_options(ev):
    """Events that last a day more, with the options of staying, or of moving by a day and some hours back or forth; all stay at first."""
    word = lambda shift: F.array(F.struct((F.col("start_ms") + shift).alias("start_ms"), (F.col("end_ms") + shift).alias("end_ms"), F.col("event_type").alias("speaker_id")))
    options = F.array(*[F.struct(word(s * 3_600_000).alias("words"), F.array(F.lit(int(s == 0)), F.lit(-abs(s))).alias("score")) for s in (0, 25, 50, -25)])
    order = intervals.Window.partitionBy("user_id").orderBy("start_ms", "event_id")
    long = ev.withColumn("end_ms", F.col("end_ms") + DAY)
    return long.select("user_id", "event_id", F.row_number().over(order).alias("position"), "start_ms", "end_ms").join(long.select("event_id", options.alias("options")), "event_id").withColumn("selected", F.lit(0))


@query()
def stabilized_options_events(spark, d):
    """Events may move so that those of one type and user no longer overlap; what has moved makes room for others in the next round."""
    rows = shifted_options(event_intervals(spark, d))
    return conflicts.stabilized(rows, USER, "event_id", "position", "start_ms", "end_ms", "options", "selected", radius=1, most_gap=3_600_000).select("event_id", "selected", "round")


def turn_windows(turns):
    """(windows, candidates): a turn's words are a window; its sentences, and runs of five words, are candidates."""
    rows = turns.select("conv_id", F.col("turn").alias("window"), F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "").alias("w"), "text")
    from spanframe.functions import text

    words = rows.select("conv_id", "window", F.posexplode("w").alias("sequence_index", "text"))
    timed = words.select("conv_id", "window", "sequence_index", text.normalized(F.col("text")).alias("normalized"), (F.col("sequence_index").cast("bigint") * 300).alias("start_ms"), (F.col("sequence_index").cast("bigint") * 300 + 280 - F.when(F.length("text") > 12, 250).otherwise(0)).alias("end_ms"), F.lit(None).cast("string").alias("speaker_id"), F.when(F.length("text") == 1, "x").alias("scene_id"))
    sentences = rows.select("conv_id", "window", F.posexplode(F.split("text", r"(?<=[.!?])\s+")).alias("candidate", "text")).withColumn("priority", F.lit(0))
    runs = rows.select("conv_id", "window", F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - 1), F.lit(5)), lambda i: F.array_join(F.slice("w", i + 1, 5), " "))).alias("candidate", "text")).withColumn("priority", F.lit(1))
    return timed, sentences.unionByName(runs)


@query()
def exact_covers_conversations(spark, d):
    windows, candidates = turn_windows(table(spark, d, "conversations"))
    return semantic.exact_results(windows, candidates, ["conv_id"], most_gap=200)
