"""Queries over the driver's tables, one or more for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanframe.functions import identity, text
from spanframe.operators import batching, intervals, select, sequences, validate
from spanframe.operators.ordering import dealt
from spanframe.plans.coverage import coverage_report
from spanframe.plans.relations import IV, REGIONS, event_intervals, items, regions, table, union_sql
from spanframe.sources import subtitles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
USER = ["user_id"]


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# --- intervals ---------------------------------------------------------------------------------


@query(f"WITH {IV} {union_sql('iv', 'user_id', 150)}")
def interval_union_events(spark, d):
    return intervals.coalesce_intervals(event_intervals(spark, d), USER, gap=150, bucket=86_400_000)


@query(f"WITH {IV} {union_sql('iv', 'user_id, event_type', -1)}")
def interval_union_strict(spark, d):
    return intervals.coalesce_intervals(event_intervals(spark, d), ["user_id", "event_type"], gap=-1)


@query(f"WITH {IV}, padded AS (SELECT user_id, greatest(0, start_ms - 120) AS start_ms, end_ms + 120 AS end_ms FROM iv) {union_sql('padded', 'user_id', 300)}")
def padded_word_union(spark, d):
    ev = event_intervals(spark, d)
    padded = ev.select("user_id", F.greatest(F.lit(0), F.col("start_ms") - 120).alias("start_ms"), (F.col("end_ms") + 120).alias("end_ms"))
    return intervals.coalesce_intervals(padded, USER, gap=300)


@query(f"WITH {REGIONS} SELECT user_id, region_start, region_end, start_ms, end_ms FROM covered")
def interval_intersection(spark, d):
    return intervals.intersect_intervals(regions(spark, d), items(spark, d), USER)


@query(f"WITH {REGIONS} SELECT * FROM gaps")
def interval_subtraction(spark, d):
    return intervals.subtract_intervals(regions(spark, d), items(spark, d), USER)


@query(f"""WITH {REGIONS}, sums AS (SELECT user_id, region_start, region_end, sum(end_ms - start_ms) AS covered_ms, count(*) AS n_pieces FROM covered GROUP BY ALL)
SELECT r.user_id, r.region_start, r.region_end, CAST(coalesce(covered_ms, 0) AS BIGINT) AS covered_ms, r.region_end - r.region_start AS region_ms, CAST(coalesce(n_pieces, 0) AS BIGINT) AS n_pieces,
  CAST(coalesce(covered_ms, 0) AS DOUBLE) / (r.region_end - r.region_start) AS ratio FROM regions r LEFT JOIN sums s USING (user_id, region_start, region_end)""")
def interval_coverage(spark, d):
    found = intervals.coverage(regions(spark, d), items(spark, d), USER)
    return found.withColumn("ratio", intervals.safe_ratio(F.col("covered_ms"), F.col("region_ms")))


@query(f"""WITH {REGIONS}, long AS (SELECT user_id, gap_start, gap_end FROM gaps WHERE gap_end - gap_start >= 230)
SELECT user_id, pos AS start_ms, least(pos + 10000, gap_end) AS end_ms FROM (SELECT user_id, gap_end, unnest(generate_series(gap_start, gap_end - 1, 10000)) AS pos FROM long)""")
def interval_gaps_chopped(spark, d):
    gaps = intervals.subtract_intervals(regions(spark, d), items(spark, d), USER).filter("gap_end - gap_start >= 230")
    return intervals.chop(gaps.select("user_id", F.col("gap_start").alias("start_ms"), F.col("gap_end").alias("end_ms")), 10_000)


_ELEMENTS = """bounds AS (SELECT user_id, start_ms AS pos, 1 AS d FROM iv UNION ALL SELECT user_id, end_ms, -1 FROM iv),
steps AS (SELECT user_id, pos, sum(d) AS d FROM bounds GROUP BY ALL),
elements AS (SELECT * FROM (SELECT user_id, pos AS start_ms, lead(pos) OVER w AS end_ms, CAST(sum(d) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n_active FROM steps WINDOW w AS (PARTITION BY user_id ORDER BY pos)) WHERE end_ms IS NOT NULL AND n_active > 0)"""


@query(f"WITH {IV}, {_ELEMENTS} SELECT * FROM elements")
def sweep_elementary_intervals(spark, d):
    return intervals.elementary_intervals(event_intervals(spark, d), USER)


@query(f"""WITH {IV}, {_ELEMENTS} SELECT e.user_id, e.start_ms, e.end_ms, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS active
FROM elements e JOIN iv i ON e.user_id = i.user_id AND i.start_ms < e.end_ms AND e.start_ms < i.end_ms GROUP BY ALL""")
def sweep_active_sets(spark, d):
    return intervals.active_sets(event_intervals(spark, d), USER, "event_id").withColumn("active", F.array_join(F.col("active").cast("array<string>"), ","))


_PAIRS = "pairs AS (SELECT r.user_id, region_start, region_end, event_id, start_ms, end_ms, least(region_end, end_ms) - greatest(region_start, start_ms) AS overlap_ms FROM regions r JOIN items i ON r.user_id = i.user_id AND start_ms < region_end AND region_start < end_ms)"


def _pairs(spark, d):
    hit = intervals.interval_join(regions(spark, d), items(spark, d).drop("event_type", "value"), USER, ("region_start", "region_end"), ("start_ms", "end_ms"))
    return hit.withColumn("overlap_ms", intervals.overlap(F.col("region_start"), F.col("region_end"), F.col("start_ms"), F.col("end_ms")))


@query(f"WITH {REGIONS}, {_PAIRS} SELECT * FROM pairs")
def interval_join_overlap(spark, d):
    return _pairs(spark, d)


@query(f"WITH {REGIONS}, {_PAIRS} SELECT user_id, region_start, event_id, overlap_ms FROM (SELECT *, row_number() OVER (PARTITION BY user_id, region_start ORDER BY overlap_ms DESC, event_id) AS r FROM pairs) WHERE r = 1")
def interval_join_best(spark, d):
    return select.top_by(_pairs(spark, d), ["user_id", "region_start"], [F.desc("overlap_ms"), F.asc("event_id")]).select("user_id", "region_start", "event_id", "overlap_ms")


@query(f"""WITH {REGIONS}, {_PAIRS} SELECT i.event_id, coalesce(string_agg(CAST(p.region_start AS VARCHAR), ',' ORDER BY p.region_start), '') AS memberships, min(p.region_start) AS first_region
FROM items i LEFT JOIN pairs p ON i.event_id = p.event_id GROUP BY i.event_id""")
def left_interval_join_collect(spark, d):
    found = _pairs(spark, d).groupBy("event_id").agg(F.array_join(F.sort_array(F.collect_list("region_start")).cast("array<string>"), ",").alias("memberships"), F.min("region_start").alias("first_region"))
    return items(spark, d).select("event_id").join(found, "event_id", "left").fillna("", ["memberships"])


@query(f"WITH {REGIONS}, {_PAIRS} SELECT event_id FROM items WHERE event_id NOT IN (SELECT event_id FROM pairs)")
def interval_anti_join(spark, d):
    return items(spark, d).select("event_id").join(_pairs(spark, d), "event_id", "left_anti")


@query(f"WITH {REGIONS} SELECT i.user_id, region_start, event_id FROM regions r JOIN items i ON r.user_id = i.user_id AND region_start <= start_ms AND end_ms <= region_end")
def interval_containment(spark, d):
    return intervals.containment_join(regions(spark, d), items(spark, d), USER, ("region_start", "region_end"), ("start_ms", "end_ms")).select("user_id", "region_start", "event_id")


@query(f"""WITH {IV}, l AS (SELECT user_id, event_id, start_ms FROM iv WHERE event_type = 'error'), r AS (SELECT user_id, event_id AS other, start_ms AS pos FROM iv WHERE event_type = 'view')
SELECT l.user_id, l.event_id, l.start_ms, (SELECT other FROM r WHERE r.user_id = l.user_id AND pos <= l.start_ms ORDER BY pos DESC, other DESC LIMIT 1) AS other FROM l""")
def asof_previous(spark, d):
    ev = event_intervals(spark, d)
    views = ev.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("other"), F.col("start_ms").alias("at"))
    return intervals.asof(ev.filter("event_type = 'error'").select("user_id", "event_id", "start_ms"), views, USER, "start_ms", "at", ["other"], order=["other"])


@query(f"""WITH {IV}, l AS (SELECT user_id, event_id, end_ms FROM iv WHERE event_type = 'error'), r AS (SELECT user_id, event_id AS other, start_ms AS pos FROM iv WHERE event_type = 'view')
SELECT l.user_id, l.event_id, l.end_ms, (SELECT other FROM r WHERE r.user_id = l.user_id AND pos >= l.end_ms ORDER BY pos, other LIMIT 1) AS other FROM l""")
def asof_next(spark, d):
    ev = event_intervals(spark, d)
    views = ev.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("other"), F.col("start_ms").alias("at"))
    return intervals.asof(ev.filter("event_type = 'error'").select("user_id", "event_id", "end_ms"), views, USER, "end_ms", "at", ["other"], direction="next", order=["other"])


@query("""WITH near AS (SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_linenumber - a.l_linenumber AS offset_, abs(a.l_extendedprice - b.l_extendedprice) AS apart
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY ALL) a JOIN (SELECT l_orderkey, l_linenumber, l_partkey, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY ALL) b
  ON a.l_orderkey = b.l_orderkey AND a.l_linenumber <> b.l_linenumber AND abs(a.l_linenumber - b.l_linenumber) <= 3)
SELECT l_orderkey, l_linenumber, l_partkey, offset_ AS "offset", apart FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey ORDER BY apart, offset_) AS r FROM near) WHERE r = 1""")
def band_join_best_neighbour(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.max("l_extendedprice").alias("l_extendedprice"))
    pairs = intervals.band_join(lines, ["l_orderkey"], "l_linenumber", 3, ["l_extendedprice"]).withColumn("apart", F.abs(F.col("l_extendedprice") - F.col("other_l_extendedprice")))
    best = select.argmax_neighbour(pairs.withColumn("score", -F.col("apart")), ["l_orderkey", "l_linenumber", "l_partkey"], "score", "offset")
    return best.select("l_orderkey", "l_linenumber", "l_partkey", "offset", "apart")


@query(f"WITH {REGIONS} SELECT i.user_id, region_start, event_id, greatest(0, start_ms - region_start) AS start_ms, least(region_end, end_ms) - region_start AS end_ms FROM regions r JOIN items i ON r.user_id = i.user_id AND start_ms < region_end AND region_start < end_ms")
def clipped_and_rebased(spark, d):
    return intervals.rebased(items(spark, d), regions(spark, d), USER, ("region_start", "region_end")).select("user_id", "region_start", "event_id", "start_ms", "end_ms")


@query("""WITH frames AS (SELECT label, vec_id, list_position(embedding, list_max(embedding)) AS winner FROM embeddings),
counted AS (SELECT label, winner, count(*) AS frames FROM frames GROUP BY ALL),
ranked AS (SELECT *, frames / sum(frames) OVER (PARTITION BY label) AS share, row_number() OVER (PARTITION BY label ORDER BY frames DESC, winner) AS r FROM counted)
SELECT label, CASE WHEN frames >= 2 THEN CAST(winner AS INT) END AS winner, frames, CAST(share AS DOUBLE) AS share FROM ranked WHERE r = 1""")
def dominant_column_vote(spark, d):
    return intervals.dominant_column(table(spark, d, "embeddings"), ["label"], "embedding", least_frames=2)


@query(f"WITH {IV} SELECT user_id, event_id, CASE WHEN lag(end_ms) OVER w > start_ms THEN 'overlaps the one before' END AS problem FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY start_ms, end_ms)")
def interval_constructor_check(spark, d):
    return intervals.require_intervals(event_intervals(spark, d), USER).select("user_id", "event_id", "problem")


def _report(spark, d):
    ev = event_intervals(spark, d)
    bounds = ["user_id", "start_ms", "end_ms"]
    return coverage_report(ev.filter("event_type = 'signup'").select(*bounds), ev.filter("event_type IN ('click', 'view')").select(*bounds), USER)


_REPORT = f"""{IV}, signups AS (SELECT * FROM iv WHERE event_type = 'signup'), items AS (SELECT * FROM iv WHERE event_type IN ('click', 'view')),
  regions AS (SELECT user_id, start_ms AS region_start, end_ms AS region_end FROM ({union_sql('signups', 'user_id', 150)})),
  padded AS (SELECT r.user_id, region_start, region_end, greatest(0, start_ms - 120) AS start_ms, end_ms + 120 AS end_ms FROM regions r JOIN items i ON r.user_id = i.user_id AND i.start_ms < region_end AND region_start < i.end_ms),
  united AS ({union_sql('padded', 'user_id, region_start, region_end', 300)}),
  covered AS (SELECT user_id, region_start, region_end, greatest(start_ms, region_start) AS start_ms, least(end_ms, region_end) AS end_ms FROM united),
  ratios AS (SELECT r.user_id, r.region_start, r.region_end, coalesce(sum(end_ms - start_ms), 0) / max(r.region_end - r.region_start) AS ratio, CAST(coalesce(sum(end_ms - start_ms), 0) AS BIGINT) AS covered_ms FROM regions r LEFT JOIN covered c USING (user_id, region_start, region_end) GROUP BY r.user_id, r.region_start, r.region_end),
  stops AS (SELECT user_id, region_start, region_end, start_ms AS gap_end, end_ms AS reach FROM covered UNION ALL SELECT user_id, region_start, region_end, region_end, region_end FROM regions),
  gaps AS (SELECT * FROM (SELECT user_id, region_start, region_end, coalesce(lag(reach) OVER (PARTITION BY user_id, region_start, region_end ORDER BY gap_end, reach), region_start) AS gap_start, gap_end FROM stops) WHERE gap_start < gap_end),
  issues AS (SELECT g.*, CASE WHEN ratio < 0.7 THEN 'low_coverage_speech_hole' ELSE 'speech_hole' END AS reason FROM gaps g JOIN ratios USING (user_id, region_start, region_end) WHERE ratio < 0.7 OR gap_end - gap_start >= 750)"""


@query(f"WITH {_REPORT} SELECT * FROM issues")
def coverage_issues(spark, d):
    return _report(spark, d).issues.select("user_id", "region_start", "region_end", "gap_start", "gap_end", "reason")


@query(f"WITH {_REPORT}, spans AS (SELECT user_id, greatest(0, gap_start - 500) AS start_ms, gap_end + 500 AS end_ms FROM issues) {union_sql('spans', 'user_id', 250)}")
def coverage_rescue_spans(spark, d):
    return _report(spark, d).rescue


@query(f"""WITH {_REPORT}, counts AS (SELECT user_id, count(*) AS n_regions, CAST(sum(covered_ms) AS BIGINT) AS covered_ms, CAST(sum(region_end - region_start) AS BIGINT) AS region_ms FROM ratios GROUP BY 1),
problems AS (SELECT user_id, count(*) AS n_issues FROM issues GROUP BY 1)
SELECT user_id, n_regions, covered_ms, region_ms, CAST(coalesce(n_issues, 0) AS BIGINT) AS n_issues FROM counts LEFT JOIN problems USING (user_id)""")
def coverage_summary(spark, d):
    return _report(spark, d).summary.filter("n_regions > 0").select("user_id", "n_regions", "covered_ms", "region_ms", "n_issues")


# --- sequences ---------------------------------------------------------------------------------

_W = "WINDOW w AS (PARTITION BY user_id ORDER BY start_ms, event_id)"
ORDER = ["start_ms", "event_id"]


@query(f"""WITH {IV} SELECT event_id, gap_ms, concat_ws(',', CASE WHEN gap_ms >= 3600000 THEN 'hard_gap' END, CASE WHEN gap_ms >= 1800000 THEN 'review_gap' END) AS reasons
FROM (SELECT event_id, start_ms - lag(end_ms) OVER w AS gap_ms FROM iv {_W})""")
def boundary_flags_events(spark, d):
    found = sequences.hard_boundaries(event_intervals(spark, d), USER, ORDER, "start_ms", "end_ms", hard_gap=3_600_000, review_gap=1_800_000)
    return found.select("event_id", "gap_ms", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {IV} SELECT event_id, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY start_ms, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM (SELECT *, CASE WHEN start_ms - lag(end_ms) OVER w > 3600000 THEN 1 ELSE 0 END AS opens FROM iv {_W})")
def gap_sessions_events(spark, d):
    return sequences.gap_sessions(event_intervals(spark, d), USER, ORDER, "start_ms", "end_ms", 3_600_000).select("event_id", "session")


@query(f"""WITH {IV} SELECT user_id, start_ms, end_ms, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM (
SELECT *, CASE WHEN start_ms - lag(end_ms) OVER w > 1000 AND start_ms > max(end_ms) OVER (PARTITION BY user_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY start_ms, end_ms))""")
def reach_sessions_events(spark, d):
    return sequences.reach_sessions(event_intervals(spark, d), USER, "start_ms", "end_ms", 1000).select("user_id", "start_ms", "end_ms", "session")


@query("""SELECT conv_id, turn, coalesce(string_agg(text, ' / ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), '') AS context_before,
coalesce(string_agg(text, ' / ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), '') AS context_after FROM conversations""")
def turn_context_conversations(spark, d):
    return sequences.with_context(table(spark, d, "conversations"), ["conv_id"], ["turn"], "text").select("conv_id", "turn", "context_before", "context_after")


@query("""WITH m AS (SELECT *, o_orderkey - row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) AS i FROM orders)
SELECT o_orderkey, min(o_orderkey) OVER w AS island, count(*) OVER w AS run_length, count(*) OVER w >= 2 AS in_run FROM m WINDOW w AS (PARTITION BY o_orderpriority, o_orderstatus, i)""")
def displacement_runs(spark, d):
    return sequences.islands(table(spark, d, "orders"), ["o_orderpriority"], "o_orderkey", "o_orderstatus").select("o_orderkey", "island", "run_length", "in_run")


@query(f"""WITH {IV}, g AS (SELECT *, start_ms - lag(end_ms) OVER w AS gap FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY start_ms, end_ms)),
n AS (SELECT *, sum(CASE WHEN gap > 7200000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS part FROM g)
SELECT user_id, CAST(part AS BIGINT) AS part, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n, string_agg(event_type, ' ' ORDER BY start_ms, end_ms, event_type) AS event_type, coalesce(bool_or(gap >= 36000000), false) AS review FROM n GROUP BY user_id, part""")
def gap_split_events(spark, d):
    return sequences.gap_split(event_intervals(spark, d), USER, "start_ms", "end_ms", "event_type", 7_200_000, 36_000_000)


@query(f"WITH {IV} SELECT event_id, coalesce(max(end_ms) OVER (PARTITION BY user_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > start_ms, false) AS overlaps FROM iv")
def active_set_overlap(spark, d):
    return sequences.overlap_before(event_intervals(spark, d), USER, "start_ms", "end_ms").select("event_id", "overlaps")


@query(f"""WITH {IV}, s AS (SELECT *, CASE WHEN value < 20 THEN NULL ELSE event_type END AS speaker FROM iv)
SELECT event_id, coalesce(event_type = lag(event_type) OVER w AND (end_ms - start_ms <= 640000 OR lag(end_ms - start_ms) OVER w <= 640000), false) AND row_number() OVER w > 1
  AND (speaker IS NULL OR lag(speaker) OVER w IS NULL OR speaker = lag(speaker) OVER w) AS duplicate FROM s {_W}""")
def adjacent_duplicate_events(spark, d):
    ev = event_intervals(spark, d).withColumn("speaker", F.when(F.col("value") >= 20, F.col("event_type")))
    return sequences.adjacent_duplicates(ev, USER, ORDER, "event_type", "speaker", "start_ms", "end_ms", 640_000).select("event_id", "duplicate")


@query(f"""WITH {IV}, t AS (SELECT *, lead(start_ms) OVER w AS following, least(greatest(end_ms + 220, start_ms + greatest(700, CAST(ceil(length(event_type) / 20.0 * 1000) AS BIGINT))), start_ms + 700000) AS wanted FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY start_ms, end_ms))
SELECT event_id, CASE WHEN following IS NULL THEN wanted ELSE least(wanted, CASE WHEN following - 80 >= end_ms THEN following - 80 ELSE following - 1 END) END AS display_end FROM t""")
def assigned_timings_events(spark, d):
    return sequences.assigned_timings(event_intervals(spark, d), USER, "start_ms", "end_ms", "event_type", longest=700_000).select("event_id", "display_end")


@query(f"""WITH {IV}, s AS (SELECT *, CASE WHEN value >= 20 THEN event_type END AS speaker FROM iv),
c AS (SELECT *, last_value(speaker IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY start_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried FROM s),
n AS (SELECT *, CAST(sum(CASE WHEN speaker <> carried THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start_ms, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM c)
SELECT event_id, session, bool_or(speaker IS NULL) OVER (PARTITION BY user_id, session) AS tainted FROM n""")
def speaker_runs_events(spark, d):
    ev = event_intervals(spark, d).withColumn("speaker", F.when(F.col("value") >= 20, F.col("event_type")))
    return sequences.speaker_runs(ev, USER, ORDER, "speaker").select("event_id", "session", "tainted")


@query(f"""WITH RECURSIVE {IV}, o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_ms, event_id) AS r FROM iv),
f AS (SELECT user_id, event_id, r, CAST(0 AS BIGINT) AS part, start_ms AS began, end_ms AS reach, 1 AS held FROM o WHERE r = 1
 UNION ALL SELECT o.user_id, o.event_id, o.r, f.part + x, CASE WHEN x = 1 THEN o.start_ms ELSE f.began END, CASE WHEN x = 1 THEN o.end_ms ELSE greatest(f.reach, o.end_ms) END, CASE WHEN x = 1 THEN 1 ELSE f.held + 1 END
 FROM f JOIN (SELECT * FROM o) o ON o.user_id = f.user_id AND o.r = f.r + 1, LATERAL (SELECT CASE WHEN o.end_ms - f.began > 86400000 OR f.held + 1 > 5 OR o.start_ms - f.reach > 40000000 THEN 1 ELSE 0 END AS x))
SELECT event_id, part FROM f""")
def capped_groups_events(spark, d):
    ev = event_intervals(spark, d).select("user_id", "event_id", "start_ms", "end_ms", F.lit(1).alias("one"))
    return sequences.capped_groups(ev, USER, ORDER, "start_ms", "end_ms", "one", 86_400_000, 5, 40_000_000).select("event_id", "part")


@query()
def optimal_groups_conversations(spark, d):
    lines = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", r"\s+")).alias("i", "word"))
    timed = lines.filter("word <> ''").withColumn("start_ms", F.col("turn") * 1_000_000 + F.col("i") * 350).withColumn("end_ms", F.col("start_ms") + 300)
    return sequences.optimal_groups(timed, ["conv_id", "turn"], ["i"], "start_ms", "end_ms", "word").select("conv_id", "turn", "i", "part")


@query(f"""WITH RECURSIVE {IV}, o AS (SELECT user_id, event_id, start_ms, end_ms, row_number() OVER (PARTITION BY user_id ORDER BY start_ms, end_ms, event_id) AS r, lead(start_ms) OVER (PARTITION BY user_id ORDER BY start_ms, end_ms, event_id) AS nxt FROM iv),
f AS (SELECT user_id, CAST(0 AS BIGINT) AS r, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS BIGINT) AS start_ms, CAST(NULL AS BIGINT) AS end_ms, CAST(NULL AS BIGINT) AS reach FROM o GROUP BY user_id
 UNION ALL SELECT o.user_id, o.r, o.event_id, b, e, CASE WHEN e > b THEN e ELSE f.reach END FROM f JOIN o ON o.user_id = f.user_id AND o.r = f.r + 1,
 LATERAL (SELECT greatest(o.start_ms, coalesce(f.reach, o.start_ms)) AS b) x, LATERAL (SELECT CASE WHEN o.end_ms - b < 400 THEN greatest(o.end_ms, least(b + 400, coalesce(o.nxt, b + 400))) ELSE o.end_ms END AS e) y)
SELECT user_id, event_id, start_ms, end_ms FROM f WHERE r > 0 AND end_ms > start_ms""")
def trimmed_overlaps_events(spark, d):
    return sequences.trimmed_overlaps(event_intervals(spark, d).select("user_id", "event_id", "start_ms", "end_ms"), USER, "start_ms", "end_ms", ties=["event_id"])


@query(f"""WITH RECURSIVE {IV}, p AS (SELECT a.event_id AS x, b.event_id AS y FROM iv a JOIN iv b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND a.start_ms < b.end_ms AND b.start_ms < a.end_ms),
reach(node, other) AS (SELECT x, x FROM p UNION SELECT node, y FROM reach JOIN p ON other = x) SELECT node, min(other) AS component FROM reach GROUP BY node""")
def overlap_components_events(spark, d):
    return sequences.interval_components(event_intervals(spark, d), USER, "event_id", "start_ms", "end_ms").withColumnRenamed("event_id", "node")


# --- selection and batches ---------------------------------------------------------------------


@query("""WITH RECURSIVE o AS (SELECT p_brand, p_partkey, p_retailprice, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part),
f AS (SELECT p_brand, CAST(0 AS BIGINT) AS r, CAST(0 AS BIGINT) AS spent, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS p_partkey, false AS chosen FROM o GROUP BY p_brand
 UNION ALL SELECT f.p_brand, o.r, f.spent + CASE WHEN f.n < 24 AND f.spent + o.p_size <= 300 THEN o.p_size ELSE 0 END, f.n + CASE WHEN f.n < 24 AND f.spent + o.p_size <= 300 THEN 1 ELSE 0 END, o.p_partkey, f.n < 24 AND f.spent + o.p_size <= 300
 FROM f JOIN o ON o.p_brand = f.p_brand AND o.r = f.r + 1)
SELECT p_brand, p_partkey, chosen FROM f WHERE r > 0""")
def budgeted_topk_skip(spark, d):
    found = select.budgeted(table(spark, d, "part"), ["p_brand"], [("p_retailprice", False), ("p_partkey", True)], "p_size", 24, 300)
    return found.select("p_brand", "p_partkey", "chosen")


@query("""WITH m AS (SELECT *, o_totalprice > 480000 AS must FROM orders),
r AS (SELECT *, greatest(1, ceil(count(*) OVER (PARTITION BY o_orderpriority) * 0.05)) - sum(CASE WHEN must THEN 1 ELSE 0 END) OVER (PARTITION BY o_orderpriority) AS cap, row_number() OVER (PARTITION BY o_orderpriority, must ORDER BY o_totalprice DESC, o_orderkey) AS r FROM m)
SELECT o_orderkey, must FROM r WHERE must OR r <= cap""")
def review_sample_capped(spark, d):
    marked = table(spark, d, "orders").withColumn("must", F.col("o_totalprice") > 480_000)
    return select.review_sample(marked, "must", "o_totalprice", "o_orderkey", keys=["o_orderpriority"]).select("o_orderkey", "must")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 100 WHEN '2-HIGH' THEN 90 ELSE 0 END AS priority FROM orders")
def reason_priorities(spark, d):
    return table(spark, d, "orders").select("o_orderkey", select.priority(F.array("o_orderpriority"), {"1-URGENT": 100, "2-HIGH": 90}).cast("int").alias("priority"))


@query("""WITH n AS (SELECT o_orderkey, o_orderpriority, count(*) OVER (PARTITION BY o_orderpriority) AS n, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS i FROM orders),
c AS (SELECT *, CASE WHEN n <= 500 THEN 1 WHEN (n + 499) // 500 <= n // 350 THEN least(greatest(CAST(round_even(n / 400.0, 0) AS BIGINT), (n + 499) // 500), n // 350) ELSE (n + 499) // 500 END AS c FROM n),
s AS (SELECT *, n // c AS small, n % c AS extra FROM c)
SELECT o_orderkey, CASE WHEN i < extra * (small + 1) THEN i // (small + 1) ELSE extra + (i - extra * (small + 1)) // small END AS batch FROM s""")
def balanced_batches_orders(spark, d):
    return batching.balanced_batches(table(spark, d, "orders"), ["o_orderpriority"], ["o_orderkey"]).select("o_orderkey", "batch")


@query("SELECT o_orderkey, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 250 AS batch FROM orders")
def fixed_batches_orders(spark, d):
    return batching.fixed_batches(table(spark, d, "orders"), ["o_orderstatus"], ["o_orderkey"], 250).select("o_orderkey", "batch")


@query("""WITH n AS (SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus) AS n, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT o_orderkey, CASE WHEN i >= 2 * n // 3 THEN 2 WHEN i >= n // 3 THEN 1 ELSE 0 END AS share FROM n""")
def contiguous_shares_orders(spark, d):
    return batching.contiguous_shares(table(spark, d, "orders"), ["o_orderstatus"], ["o_orderkey"]).select("o_orderkey", "share")


@query("""WITH RECURSIVE o AS (SELECT p_brand, p_partkey, CAST(p_retailprice AS BIGINT) * 100 AS size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM (SELECT p_brand, p_partkey, floor(p_retailprice) AS p_retailprice FROM part)),
f AS (SELECT p_brand, p_partkey, r, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS n, size AS bytes FROM o WHERE r = 1
 UNION ALL SELECT o.p_brand, o.p_partkey, o.r, f.batch + x, CASE WHEN x = 1 THEN 1 ELSE f.n + 1 END, CASE WHEN x = 1 THEN o.size ELSE f.bytes + o.size END
 FROM f JOIN (SELECT * FROM o) o ON o.p_brand = f.p_brand AND o.r = f.r + 1, LATERAL (SELECT CASE WHEN f.n >= 20 OR f.bytes + o.size > 1500000 THEN 1 ELSE 0 END AS x))
SELECT p_partkey, batch FROM f""")
def byte_batches_parts(spark, d):
    parts = table(spark, d, "part").withColumn("size", F.floor("p_retailprice") * 100)
    return batching.byte_batches(parts, ["p_brand"], "p_partkey", "size", 20, 1_500_000).select("p_partkey", "batch")


@query(f"WITH {IV}, u AS ({union_sql('iv', 'user_id')}) SELECT * FROM (SELECT user_id, end_ms AS gap_start, lead(start_ms) OVER (PARTITION BY user_id ORDER BY start_ms) AS gap_end FROM u) WHERE gap_end - gap_start >= 1000")
def silence_gaps_events(spark, d):
    return batching.silence_gaps(event_intervals(spark, d), USER)


@query()
def planned_parts_events(spark, d):
    ev = event_intervals(spark, d)
    first = ev.agg(F.min("start_ms").alias("origin"))
    own = ev.crossJoin(F.broadcast(first)).withColumn("start_ms", F.col("start_ms") - F.col("origin")).withColumn("end_ms", F.col("end_ms") - F.col("origin")).drop("origin")
    return batching.planned_parts(own, USER, own.groupBy("user_id").agg(F.max("end_ms").alias("total_ms")), target=86_400_000)


# --- text --------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), n AS (SELECT doc_id, array_to_string(regexp_extract_all(lower(line), '[\\p{L}\\p{N}]+'), ' ') AS line FROM l)
SELECT line, count(*) AS n, count(DISTINCT doc_id) AS n_docs, min(doc_id) AS first_doc, max(doc_id) - min(doc_id) AS span FROM n WHERE line <> '' GROUP BY line HAVING count(*) >= 5""")
def repeated_lines_documents(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).select("doc_id", text.lexical(F.col("line")).alias("line"))
    counted = lines.filter("line <> ''").groupBy("line").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"), F.min("doc_id").alias("first_doc"), (F.max("doc_id") - F.min("doc_id")).alias("span"))
    return counted.filter("n >= 5")


@query("""SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '\\d+(?:[.,]\\d+)*'), lambda x: CASE
 WHEN regexp_full_match(x, '\\d{1,3}([.,]\\d{3})+') OR NOT regexp_matches(x, '[.,]') THEN coalesce(nullif(ltrim(regexp_replace(x, '[.,]', '', 'g'), '0'), ''), '0')
 ELSE coalesce(nullif(ltrim(regexp_replace(regexp_replace(x, '[.,]\\d+$', ''), '[.,]', '', 'g'), '0'), ''), '0') || CASE WHEN rtrim(regexp_extract(x, '[.,](\\d+)$', 1), '0') = '' THEN '' ELSE '.' || rtrim(regexp_extract(x, '[.,](\\d+)$', 1), '0') END END), ' ') AS numbers FROM documents""")
def number_anchors_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(text.number_anchors(F.col("text")), " ").alias("numbers"))


@query("""WITH t AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), ' ') || ' ' AS t FROM documents),
b AS (SELECT item_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), ' ') || ' ' AS b FROM benchmark)
SELECT doc_id, item_id FROM t, b WHERE contains(t, b)""")
def benchmark_contiguous_match(spark, d):
    """A passage can only stand where its first eight tokens do, or all of a shorter one: an equi join, then the whole check."""
    wide = 8
    passages = table(spark, d, "benchmark").select("item_id", text.tokens(F.col("text")).alias("needle")).withColumn("head", F.xxhash64(F.slice("needle", 1, wide)))
    widths = [r[0] for r in passages.select(F.least(F.size("needle"), F.lit(wide))).distinct().collect()]
    docs = table(spark, d, "documents").select("doc_id", "text")
    of_width = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size("found") - w + 1, F.lit(1))), lambda i: F.xxhash64(F.slice("found", i, w)))
    starts = [of_width(w) for w in widths]
    # only (doc_id, head) is exploded; texts meet passages again for the few documents that share a head
    heads = docs.select("doc_id", text.tokens(F.col("text")).alias("found")).select("doc_id", F.explode(F.array_distinct(F.concat(*starts) if starts else F.array().cast("array<bigint>"))).alias("head"))
    hit = heads.join(passages, "head").select("doc_id", "item_id", "needle")
    padded = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    return hit.join(docs, "doc_id").filter(F.contains(padded(text.tokens(F.col("text"))), padded("needle"))).select("doc_id", "item_id").distinct()


@query("SELECT page_id, CAST(length(regexp_replace(html, '<[^>]*>|\\{\\\\[^}]*\\}', '', 'g')) AS INT) AS visible FROM pages")
def visible_length_pages(spark, d):
    return table(spark, d, "pages").select("page_id", text.visible_length(F.col("html")).alias("visible"))


@query("""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM documents)
SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, CAST(len(list_distinct(t)) AS INT) AS n_distinct, len(t) >= 20 AND len(list_distinct(t)) <= greatest(2, len(t) // 10) AS repetitive FROM t""")
def repetitive_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", text.tokens(F.col("text")).alias("t"))
    return docs.select("doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_distinct"), text.is_repetitive(F.col("t")).alias("repetitive"))


@query("SELECT conv_id, turn, trim(regexp_replace(nfc_normalize(text), '\\s+', ' ', 'g')) AS clean, CAST(length(regexp_replace(text, '\\s+', '', 'g')) AS INT) AS solid, greatest(700, CAST(ceil(length(text) / 20.0 * 1000) AS BIGINT)) AS needed_ms FROM conversations")
def normalised_turns(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text.collapsed(F.col("text")).alias("clean"), text.non_space_length(F.col("text")).alias("solid"), text.required_duration(F.col("text")).alias("needed_ms"))


@query("""WITH t AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM conversations), p AS (SELECT a.conv_id, a.turn, a.t AS a, b.t AS b FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, CAST(len(list_distinct(list_filter(a, lambda x: list_contains(b, x)))) AS INT) AS shared FROM p""")
def shared_tokens_of_turns(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", text.tokens(F.col("text")).alias("t"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("t").alias("b"))
    return turns.join(after, ["conv_id", "turn"]).select("conv_id", "turn", text.shared_tokens(F.col("t"), F.col("b")).alias("shared"))


@query()
def similar_turns(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("a"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    pairs = dealt(turns.join(after, ["conv_id", "turn"]), ["conv_id", "turn"])
    return pairs.select("conv_id", "turn", text.similarity(F.col("a"), F.col("b")).alias("ratio"), text.blended_similarity(F.col("a"), F.col("b")).alias("blended"), text.bigram_dice(F.col("a"), F.col("b")).alias("dice"))


@query("""WITH t AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM conversations), e AS (SELECT conv_id, turn, len(t) AS n, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS i FROM t)
SELECT conv_id, turn, CAST(i AS INT) AS i, token, turn * 60000 + 30000 * i // n AS start_ms, turn * 60000 + 30000 * (i + 1) // n AS end_ms FROM e""")
def evenly_timed_tokens(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", text.tokens(F.col("text")).alias("t")).filter(F.size("t") > 0)
    timed = text.evenly_timed(F.col("t"), F.col("turn") * 60_000, F.col("turn") * 60_000 + 30_000)
    return turns.select("conv_id", "turn", F.posexplode(timed).alias("i", "w")).select("conv_id", "turn", "i", "w.*")


# --- validation and quality ----------------------------------------------------------------------


@query("""SELECT 'missing' AS code, doc_id, CAST(0 AS BIGINT) AS n FROM (SELECT DISTINCT doc_id FROM documents) WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'extra', doc_id, count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) GROUP BY doc_id
UNION ALL SELECT 'duplicate', doc_id, count(*) FROM labels GROUP BY doc_id HAVING count(*) > 1""")
def uid_checks_missing_extra_dup(spark, d):
    return validate.key_issues(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


@query("""WITH e AS (SELECT o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS position, o_custkey AS expected FROM orders),
a AS (SELECT o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS position, o_custkey AS actual FROM orders WHERE o_orderkey % 97 <> 5)
SELECT o_orderstatus, position, expected, actual FROM e FULL JOIN a USING (o_orderstatus, position) WHERE expected IS DISTINCT FROM actual""")
def order_issues_orders(spark, d):
    orders = table(spark, d, "orders")
    return validate.order_issues(orders, orders.filter("o_orderkey % 97 <> 5"), ["o_orderstatus"], "o_orderkey", "o_custkey")


@query("""WITH a AS (SELECT * REPLACE (CASE WHEN s_suppkey % 10 = 3 THEN s_nationkey + 1 ELSE s_nationkey END AS s_nationkey) FROM supplier)
SELECT e.s_suppkey, 's_nationkey' AS field, '{"v":' || e.s_nationkey || '}' AS expected, '{"v":' || a.s_nationkey || '}' AS actual FROM supplier e JOIN a USING (s_suppkey) WHERE e.s_nationkey <> a.s_nationkey""")
def echo_issues_supplier(spark, d):
    expected = table(spark, d, "supplier")
    actual = expected.withColumn("s_nationkey", F.when(F.col("s_suppkey") % 10 == 3, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey")))
    return validate.echo_issues(expected, actual, "s_suppkey", ["s_name", "s_nationkey"])


@query("SELECT 'left' AS side, '{\"r_name\":\"' || r_name || '\",\"r_regionkey\":' || r_regionkey || '}' AS row FROM region WHERE r_regionkey = 2")
def same_relation_region(spark, d):
    return validate.same_relation(table(spark, d, "region"), table(spark, d, "region").filter("r_regionkey <> 2"))


_RULES = {"long_discount": "l_discount > 0.08", "returned": "l_returnflag = 'R'", "tiny": "l_quantity < 2", "impossible": "l_quantity < 0"}


@query("SELECT l_linestatus, count(*) FILTER (l_discount > 0.08) AS long_discount, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_quantity < 2) AS tiny, count(*) FILTER (l_quantity < 0) AS impossible, count(*) FILTER (l_discount > 0.08 OR l_returnflag = 'R' OR l_quantity < 2 OR l_quantity < 0) = 0 AS passed FROM lineitem GROUP BY l_linestatus")
def zero_gate_report(spark, d):
    return validate.counters(table(spark, d, "lineitem"), {k: F.expr(v) for k, v in _RULES.items()}, ["l_linestatus"])


@query("SELECT * FROM nation WHERE (SELECT count(*) FROM lineitem WHERE l_quantity < 0) = 0")
def gated_relation(spark, d):
    return validate.gated(table(spark, d, "nation"), validate.counters(table(spark, d, "lineitem"), {"impossible": F.expr("l_quantity < 0")}))


@query("""WITH r AS (SELECT conv_id * 1000 + turn AS uid, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position, turn FROM conversations)
SELECT uid, 'empty_text' AS code, 'error' AS severity FROM r WHERE trim(text) = '' UNION ALL SELECT uid, 'high_cps', 'warning' FROM r WHERE length(text) > 600
UNION ALL SELECT uid, 'index_mismatch', 'error' FROM r WHERE turn <> position UNION ALL SELECT uid, 'more_than_two_lines', 'error' FROM r WHERE len(string_split(text, chr(10))) > 2""")
def qa_issue_rows(spark, d):
    from pyspark.sql import Window

    rows = table(spark, d, "conversations").withColumn("uid", F.col("conv_id") * 1000 + F.col("turn")).withColumn("position", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1)
    rules = {
        "empty_text": ("error", F.trim("text") == ""),
        "high_cps": ("warning", F.length("text") > 600),
        "index_mismatch": ("error", F.col("turn") != F.col("position")),
        "more_than_two_lines": ("error", F.size(F.split("text", "\n")) > 2),
    }
    return validate.issues(rows, "uid", rules)


@query("""WITH p AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'), c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 7 THEN -1 ELSE o_custkey END AS cust FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderkey % 11 <> 4)
SELECT o_orderkey, CASE WHEN c.cust IS NULL THEN 'no_child' WHEN p.o_custkey IS NULL THEN 'no_parent' ELSE 'field_differs' END AS code FROM p FULL JOIN c USING (o_orderkey) WHERE p.o_custkey IS DISTINCT FROM c.cust""")
def link_issues_orders(spark, d):
    orders = table(spark, d, "orders")
    children = orders.filter("o_orderstatus IN ('F', 'P') AND o_orderkey % 11 <> 4").select("o_orderkey", F.when(F.col("o_orderkey") % 50 == 7, -1).otherwise(F.col("o_custkey")).alias("cust"))
    return validate.link_issues(orders, children, "o_orderkey", F.col("o_orderstatus") == "F", {"o_custkey": "cust"})


# --- identity and files --------------------------------------------------------------------------


@query("SELECT conv_id, turn, printf('BL%02d-%06d-', conv_id, turn) || substr(sha256(conv_id || '|' || turn || '|' || text), 1, 12) AS uid FROM conversations")
def block_uid_sha256(spark, d):
    uid = identity.content_uid("BL", F.col("conv_id"), F.col("turn"), F.col("conv_id"), F.col("turn"), F.col("text"))
    return table(spark, d, "conversations").select("conv_id", "turn", uid.alias("uid"))


@query("SELECT n_nationkey, sha256('{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || '}') AS digest FROM nation")
def row_digest_nation(spark, d):
    return table(spark, d, "nation").select("n_nationkey", identity.row_digest("n_name", "n_nationkey", "n_regionkey").alias("digest"))


@query("""WITH r AS (SELECT n_regionkey, n_nationkey, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || '}') AS d FROM nation)
SELECT n_regionkey, count(*) AS n, sha256(sha256(string_agg(d, '' ORDER BY n_nationkey))) AS digest FROM r GROUP BY n_regionkey""")
def relation_digest_nation(spark, d):
    return identity.relation_digest(table(spark, d, "nation"), ["n_regionkey"], ["n_nationkey"], ["n_name", "n_nationkey"])


_ENTRIES = "SELECT conv_id, turn + 1 AS \"index\", turn * 4000 AS start_ms, turn * 4000 + 3500 AS end_ms, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM conversations WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''"


def _entries(spark, d):
    clean = F.trim(F.regexp_replace("text", r"\s+", " "))
    return table(spark, d, "conversations").select("conv_id", (F.col("turn") + 1).alias("index"), (F.col("turn") * 4000).alias("start_ms"), (F.col("turn") * 4000 + 3500).alias("end_ms"), clean.alias("text")).filter("text <> ''")


@query(f"SELECT conv_id, CAST(\"index\" AS INT) AS \"index\", start_ms, end_ms, text FROM ({_ENTRIES})")
def srt_round_trip(spark, d):
    files = subtitles.render_srt(_entries(spark, d), ["conv_id"])
    return subtitles.parse_srt(files, "conv_id", "srt").filter("problem IS NULL").select("conv_id", "index", "start_ms", "end_ms", "text")


@query(f"SELECT conv_id, CAST(\"index\" - 1 AS INT) AS caption_index, start_ms, end_ms, text FROM ({_ENTRIES})")
def vtt_round_trip(spark, d):
    files = subtitles.render_vtt(_entries(spark, d), ["conv_id"])
    return subtitles.parse_vtt(files, "conv_id", "vtt")
