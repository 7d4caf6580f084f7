"""Queries of row functions, contracts and files; importing this adds them to queries.QUERIES."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from spanframe.functions import text
from spanframe.operators import intervals, select, sequences, validate
from spanframe.operators.ordering import shared_folder
from spanframe.plans import captions, contracts
from spanframe.plans.queries import ORDER, USER, query
from spanframe.plans.relations import IV, event_intervals, table
from spanframe.sources import jsonlines

TOKENS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
PADDED = f"(' ' || array_to_string({TOKENS}, ' ') || ' ')"


def folder(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/spanframe/{uuid.uuid4().hex}"


# --- predicates and text -------------------------------------------------------------------------


@query("""SELECT conv_id, turn, regexp_matches(text, '^\\s*[-–—]\\s*\\S') AS starts_turn, regexp_matches(text, '[.!?…]["''”’»)]*\\s*$') AS ends_sentence, regexp_matches(text, '[,;:]["''”’»)]*\\s*$') AS ends_clause,
coalesce(role IS NULL OR lag(role) OVER w IS NULL OR role = lag(role) OVER w, true) AS unsafe FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def turn_predicates(spark, d):
    t = F.col("text")
    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    return table(spark, d, "conversations").select("conv_id", "turn", sequences.starts_turn(t).alias("starts_turn"), sequences.ends_sentence(t).alias("ends_sentence"), sequences.ends_clause(t).alias("ends_clause"), sequences.speakers_unsafe(F.col("role"), before).alias("unsafe"))


@query(f"""SELECT doc_id, contains({PADDED}, ' of the ') OR contains({PADDED}, ' de la ') AS phrase,
regexp_matches(text, '(^|[^\\p{{L}}\\p{{N}}])The([^\\p{{L}}\\p{{N}}]|$)') AS named, len({TOKENS}) = 3 AND list_contains(['the', 'of'], {TOKENS}[1]) AND list_contains(['and', 'in'], {TOKENS}[2]) AND list_contains(['and', 'in'], {TOKENS}[3]) AS credit,
regexp_matches(text, '[0-9]') AND NOT regexp_matches(text, '!') AS failed FROM documents""")
def phrase_predicates_documents(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id",
        text.contains_phrase(t, ["of the", "de la"]).alias("phrase"),
        (F.size(text.names_present(t, ["The"])) > 0).alias("named"),
        text.is_credit(t, ["the", "of"], ["and", "in"]).alias("credit"),
        (F.size(text.rule_failures(t, t, [("digits", "[0-9]", "!")])) > 0).alias("failed"),
    )


@query(f"""SELECT conv_id, turn, array_to_string({TOKENS}, ' ') AS lexical, lower(strip_accents(translate(text, 'ıİşŞğĞçÇöÖüÜ', 'iIsSgGcCoOuU'))) AS folded,
CAST(length(regexp_replace(text, '<[^>]*>|\\{{\\\\[^}}]*\\}}', '', 'g')) AS INT) AS visible FROM conversations""")
def text_forms_conversations(spark, d):
    t = F.col("text")
    return table(spark, d, "conversations").select("conv_id", "turn", text.lexical(t).alias("lexical"), F.lower(text.ascii_folded(t)).alias("folded"), text.visible_length(t).alias("visible"))


@query("""WITH f AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(strip_accents(translate(text, 'ıİşŞğĞçÇöÖüÜ', 'iIsSgGcCoOuU'))), '[\\p{L}\\p{N}]+')) AS t FROM conversations)
SELECT conv_id, turn, array_to_string(list_sort(list_filter(t, lambda x: NOT list_contains(['the', 'of', 'and', 'de'], x) AND NOT regexp_matches(x, '^\\d+$'))), ' ') AS content FROM f""")
def content_tokens_conversations(spark, d):
    found = text.content_tokens(F.col("text"), ["the", "of", "and", "de"])
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(F.array_sort(found), " ").alias("content"))


_SENTENCES = "SELECT conv_id, turn, CAST(generate_subscripts(s, 1) - 1 AS INT) AS i, unnest(s) AS sentence FROM (SELECT conv_id, turn, string_split(text, '. ') AS s FROM conversations)"


@query(f"""WITH s AS ({_SENTENCES}), c AS (SELECT *, trim(regexp_replace(sentence, '[ \\t]+', ' ', 'g')) AS line FROM s WHERE NOT contains(sentence, chr(10)) AND trim(sentence) <> ''), w AS (SELECT *, string_split(line, ' ') AS w FROM c),
k AS (SELECT *, list_filter(list_transform(range(1, len(w)), lambda k: {{'a': array_to_string(w[1:k], ' '), 'b': array_to_string(w[k + 1:], ' ')}}), lambda x: length(x['a']) <= 84 AND length(x['b']) <= 84) AS halves FROM w),
r AS (SELECT *, list_sort(list_transform(halves, lambda x: {{'over': greatest(0, length(x['a']) - 42) + greatest(0, length(x['b']) - 42), 'top': greatest(length(x['a']), length(x['b'])), 'apart': abs(length(x['a']) - length(x['b'])), 'first': -length(x['a']), 'text': x['a'] || chr(10) || x['b']}}))[1] AS best FROM k)
SELECT conv_id, turn, i, CASE WHEN length(line) <= 42 THEN line ELSE best.text END AS layout FROM r""")
def wrapped_sentences(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", r"\. ")).alias("i", "sentence"))
    rows = rows.filter(~F.contains("sentence", F.lit("\n")) & (F.trim("sentence") != ""))
    return rows.select("conv_id", "turn", "i", text.wrap_text(F.col("sentence")).alias("layout"))


@query("""WITH t AS (SELECT conv_id, turn, text, string_split(text, ' ') AS w FROM conversations),
b AS (SELECT conv_id, turn, CAST(turn * 60000 AS BIGINT) AS start_ms, turn * 60000 + 250 * len(w) AS last_ms, text FROM t),
n AS (SELECT *, lead(start_ms) OVER (PARTITION BY conv_id ORDER BY start_ms, last_ms) AS following, least(greatest(last_ms + 220, start_ms + greatest(700, CAST(ceil(length(text) / 20.0 * 1000) AS BIGINT))), start_ms + 7000) AS wanted FROM b)
SELECT conv_id, turn, CASE WHEN following IS NULL THEN wanted ELSE least(wanted, CASE WHEN following - 80 >= last_ms THEN following - 80 ELSE following - 1 END) END AS display_end FROM n""")
def assigned_timings_conversations(spark, d):
    words = F.split("text", " ")
    rows = table(spark, d, "conversations").select("conv_id", "turn", (F.col("turn") * 60_000).alias("start_ms"), (F.col("turn") * 60_000 + 250 * F.size(words)).alias("last_ms"), "text")
    return sequences.assigned_timings(rows, ["conv_id"], "start_ms", "last_ms", "text").select("conv_id", "turn", "display_end")


@query(f"""WITH {IV}, m AS (SELECT *, start_ms - lag(end_ms) OVER w > 3600000 AND start_ms > max(end_ms) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS breaks, row_number() OVER w = 1 AS first FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY start_ms, end_ms))
SELECT event_id, CAST(sum(CASE WHEN NOT first AND coalesce(breaks, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM m""")
def reach_sessions_events(spark, d):
    return sequences.reach_sessions(event_intervals(spark, d), USER, "start_ms", "end_ms", 3_600_000).select("event_id", "session")


@query(f"""WITH {IV}, m AS (SELECT *, CASE WHEN value >= 50 THEN event_type END AS speaker FROM iv)
SELECT event_id, NOT row_number() OVER w = 1 AND coalesce(event_type = lag(event_type) OVER w AND (end_ms - start_ms <= 650000 OR lag(end_ms - start_ms) OVER w <= 650000), false)
 AND coalesce(speaker IS NULL OR lag(speaker) OVER w IS NULL OR speaker = lag(speaker) OVER w, true) AS duplicate FROM m WINDOW w AS (PARTITION BY user_id ORDER BY start_ms, event_id)""")
def adjacent_duplicates_events(spark, d):
    ev = event_intervals(spark, d).withColumn("speaker", F.when(F.col("value") >= 50, F.col("event_type")))
    return sequences.adjacent_duplicates(ev, USER, ORDER, "event_type", "speaker", "start_ms", "end_ms", 650_000).select("event_id", "duplicate")


@query(f"""WITH {IV}, w AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY start_ms, event_id) AS p, start_ms, end_ms, event_type FROM iv),
m AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY p) - p AS g FROM w)
SELECT user_id, event_type, min(p) AS island, count(*) AS n FROM m GROUP BY user_id, event_type, g HAVING count(*) >= 2""")
def type_islands_events(spark, d):
    ev = event_intervals(spark, d).withColumn("p", F.row_number().over(Window.partitionBy("user_id").orderBy("start_ms", "event_id")))
    runs = sequences.islands(ev, USER, "p", "event_type").filter("in_run")
    return runs.groupBy("user_id", "event_type", "island").agg(F.count("*").alias("n"))


# --- contracts -----------------------------------------------------------------------------------


@query("""SELECT o_orderstatus AS part, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS line, row_number() OVER (ORDER BY o_orderstatus, o_orderkey) - 1 AS position FROM orders""")
def sourced_batches_orders(spark, d):
    orders = table(spark, d, "orders")
    parts = {s: orders.filter(F.col("o_orderstatus") == s).select("o_orderkey") for s in ("F", "O", "P")}
    return contracts.sourced(parts, ["o_orderkey"])


_WORDS = f"{IV}, w AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY start_ms, event_id) - 1 AS INT) AS i, start_ms, end_ms, event_type AS speaker, value > 50 AS scene FROM iv)"


@query(f"""WITH {_WORDS}, s AS (SELECT user_id, i // 3 AS span, CAST(min(i) // 3 * 3 AS INT) AS first, CAST(min(i) // 3 * 3 + 2 AS INT) AS last FROM w GROUP BY user_id, i // 3),
g AS (SELECT s.*, w.i, speaker, scene, start_ms - lag(end_ms) OVER (PARTITION BY s.user_id, span ORDER BY w.i) AS gap FROM s JOIN w ON w.user_id = s.user_id AND w.i BETWEEN first AND last)
SELECT user_id, CAST(span AS BIGINT) AS span, first, last, count(*) = last - first + 1 AND coalesce(max(gap), 0) <= 86400000 AND count(DISTINCT speaker) <= 1 AND count(DISTINCT scene) <= 1 AS safe FROM g GROUP BY user_id, span, first, last""")
def span_safety_events(spark, d):
    ev = event_intervals(spark, d)
    words = ev.select("user_id", (F.row_number().over(Window.partitionBy("user_id").orderBy("start_ms", "event_id")) - 1).alias("i"), "start_ms", "end_ms", F.col("event_type").alias("speaker"), (F.col("value") > 50).alias("scene"))
    third = F.floor(F.col("i") / 3)
    spans = words.select("user_id", third.alias("span"), (third * 3).cast("int").alias("first"), (third * 3 + 2).cast("int").alias("last")).distinct()
    return contracts.span_safety(words, spans, USER, "i", "start_ms", "end_ms", "speaker", "scene", 86_400_000)


@query("""WITH w AS (SELECT o_orderkey, o_custkey AS lower, o_custkey + 40 AS upper FROM orders),
b AS (SELECT l_orderkey AS o_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS block, o_custkey + (l_partkey % 45) AS first, o_custkey + (l_partkey % 45) + (l_suppkey % 7) - 1 AS last FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c AS (SELECT *, max(last) OVER (PARTITION BY o_orderkey ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b JOIN w USING (o_orderkey))
SELECT o_orderkey, block, code FROM (SELECT *, CASE WHEN first > last THEN 'empty_range' WHEN first < lower OR last > upper THEN 'outside' WHEN first <= before THEN 'overlap' END AS code FROM c) WHERE code IS NOT NULL
UNION ALL SELECT o_orderkey, NULL, 'no_blocks' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def resolution_issues_orders(spark, d):
    orders = table(spark, d, "orders")
    windows = orders.select("o_orderkey", F.col("o_custkey").alias("lower"), (F.col("o_custkey") + 40).alias("upper"))
    at = F.col("o_custkey") + F.col("l_partkey") % 45
    block = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    blocks = table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", block.alias("block"), at.alias("first"), (at + F.col("l_suppkey") % 7 - 1).alias("last"))
    return contracts.resolution_issues(windows, blocks, "o_orderkey", "block", "first", "last", "lower", "upper")


@query("""WITH b AS (SELECT s_suppkey, CASE WHEN s_suppkey % 20 = 3 THEN s_suppkey + 0.5 ELSE s_suppkey END AS at FROM supplier WHERE s_suppkey % 9 <> 4),
m AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS p FROM supplier WHERE s_suppkey % 9 <> 4), t AS (SELECT s_suppkey AS got, row_number() OVER (ORDER BY CASE WHEN s_suppkey % 20 = 3 THEN s_suppkey + 1.5 ELSE s_suppkey END) AS p FROM supplier WHERE s_suppkey % 9 <> 4)
SELECT 'forbidden_column' AS code, 'start_ms' AS item UNION ALL SELECT 'unknown_column', 'note' UNION ALL SELECT 'missing_column', 's_name' UNION ALL SELECT 'missing', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 9 = 4
UNION ALL SELECT 'order', CAST(s_suppkey AS VARCHAR) FROM m JOIN t USING (p) WHERE s_suppkey <> got""")
def return_issues_supplier(spark, d):
    sent = table(spark, d, "supplier").withColumn("at", F.col("s_suppkey").cast("double"))
    back = sent.filter("s_suppkey % 9 <> 4").select("s_suppkey", F.expr("CASE WHEN s_suppkey % 20 = 3 THEN s_suppkey + 1.5 ELSE s_suppkey END").alias("at"), F.lit(0).alias("start_ms"), F.lit("").alias("note"))
    return contracts.return_issues(sent, back, "s_suppkey", "at", ["s_suppkey", "s_name", "at"], ["start_ms", "end_ms"])


@query("""WITH ok AS (SELECT o_orderstatus FROM orders GROUP BY 1 HAVING count(*) FILTER (o_totalprice > 450000) = 0), r AS (SELECT o_orderstatus, o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || '}') AS d FROM orders WHERE o_orderstatus IN (SELECT o_orderstatus FROM ok)),
n AS (SELECT *, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 10000 AS k FROM r), c AS (SELECT o_orderstatus, k, count(*) AS n, sha256(string_agg(d, '' ORDER BY o_orderkey)) AS c FROM n GROUP BY 1, 2)
SELECT o_orderstatus, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(c, '' ORDER BY k)) AS digest FROM c GROUP BY 1""")
def locked_orders(spark, d):
    orders = table(spark, d, "orders")
    report = validate.counters(orders, {"dear": F.col("o_totalprice") > 450_000}, ["o_orderstatus"])
    return contracts.locked_relation(orders, ["o_orderstatus"], ["o_orderkey"], ["o_orderkey", "o_custkey"], report)


@query("SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'gone' WHEN o_orderstatus = 'P' THEN 'count_differs' ELSE 'digest_differs' END AS code FROM (SELECT DISTINCT o_orderstatus FROM orders)")
def lock_issues_orders(spark, d):
    orders = table(spark, d, "orders")
    columns = (["o_orderstatus"], ["o_orderkey"], ["o_orderkey", "o_custkey"])
    locks = contracts.locked_relation(orders, *columns, validate.counters(orders, {"negative": F.col("o_totalprice") < 0}, ["o_orderstatus"]))
    least = orders.filter("o_orderstatus = 'P'").agg(F.min("o_orderkey").alias("__least"))
    now = orders.filter("o_orderstatus <> 'F'").crossJoin(F.broadcast(least)).filter("o_orderkey <> __least").withColumn("o_custkey", F.when(F.col("o_orderstatus") == "O", F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    return contracts.lock_issues(now, *columns, locks)


@query("""WITH a AS (SELECT r_name AS name, CAST(r_regionkey AS VARCHAR) AS actual FROM region), e(name, expected) AS (VALUES ('AFRICA', '0'), ('ASIA', '7'), ('ATLANTIS', '1'))
SELECT name, CASE WHEN actual IS NULL THEN 'missing' WHEN expected IS NULL THEN 'unknown' ELSE 'differs' END AS code, expected, actual FROM e FULL JOIN a USING (name) WHERE expected IS DISTINCT FROM actual""")
def config_issues_region(spark, d):
    return contracts.config_issues(table(spark, d, "region"), {"AFRICA": 0, "ASIA": 7, "ATLANTIS": 1}, "r_name", "r_regionkey")


@query("SELECT p_partkey, CASE WHEN p_partkey % 10 = 1 THEN 'lacking' WHEN p_partkey % 10 = 2 THEN 'extra' ELSE 'differs' END AS code FROM part WHERE p_partkey % 10 IN (1, 2, 3)")
def recomputed_issues_part(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_size", "p_brand")
    stored = parts.filter("p_partkey % 10 <> 1").withColumn("p_size", F.when(F.col("p_partkey") % 10 == 3, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return contracts.recomputed_issues(stored, parts.filter("p_partkey % 10 <> 2"), ["p_partkey"])


@query(f"""WITH {IV}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM iv), m AS (SELECT *, lag(start_ms) OVER w AS ps, max(end_ms) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM r WINDOW w AS (PARTITION BY user_id ORDER BY i))
SELECT event_id, 'order' AS code FROM m WHERE start_ms < ps UNION ALL SELECT event_id, 'overlap' FROM m WHERE start_ms < pe UNION ALL SELECT event_id, 'score' FROM m WHERE value / 100 > 1""")
def sequence_contract_events(spark, d):
    rows = event_intervals(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1)
    return contracts.sequence_contract_issues(rows, USER, "event_id", "i", "start_ms", "end_ms", {"score": ~F.col("value").between(0, 100)})


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 IN (1, 2) THEN NULL ELSE p_name END AS edited, CASE WHEN p_partkey % 7 IN (1, 2) THEN NULL WHEN p_partkey % 3 = 0 THEN 'pending' ELSE 'open' END AS status,
CASE WHEN p_partkey % 7 = 1 THEN 'field_changed' WHEN p_partkey % 7 = 2 THEN 'flags_changed' END AS code FROM part""")
def carried_edits_part(spark, d):
    parts = table(spark, d, "part")
    before = parts.select("p_partkey", "p_brand", F.array("p_type").alias("flags"))
    rest = F.col("p_partkey") % 7
    after = parts.select("p_partkey", F.when(rest == 1, "changed").otherwise(F.col("p_brand")).alias("p_brand"), F.when(rest == 2, F.array()).when(rest == 3, F.array("p_type", F.lit("late"))).otherwise(F.array("p_type")).cast("array<string>").alias("flags"))
    edits = parts.select("p_partkey", F.col("p_name").alias("edited"), F.when(F.col("p_partkey") % 3 == 0, "reviewed").otherwise("open").alias("status"))
    return contracts.carried_edits(before, edits, after, "p_partkey", "p_partkey", ["p_brand"], "flags", ["late"])


@query("""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 3 THEN 'X' ELSE o_orderstatus END AS worker FROM orders WHERE o_orderkey % 10 <> 7 UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 25 = 5),
n AS (SELECT *, count(*) OVER (PARTITION BY o_orderkey, worker) AS n FROM r)
SELECT n.o_orderkey, worker, CASE WHEN o.o_orderkey IS NULL THEN 'not_owned' WHEN n > 1 THEN 'double' ELSE 'accepted' END AS code FROM n LEFT JOIN orders o ON o.o_orderkey = n.o_orderkey AND o.o_orderstatus = n.worker
UNION ALL SELECT o_orderkey, o_orderstatus, 'missing' FROM orders o WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.o_orderkey = o.o_orderkey AND r.worker = o.o_orderstatus)""")
def collected_returns_orders(spark, d):
    orders = table(spark, d, "orders")
    owners = orders.select("o_orderkey", F.col("o_orderstatus").alias("worker"))
    back = orders.filter("o_orderkey % 10 <> 7").select("o_orderkey", F.when(F.col("o_orderkey") % 50 == 3, "X").otherwise(F.col("o_orderstatus")).alias("worker"))
    return contracts.collected_returns(owners, back.unionByName(owners.filter("o_orderkey % 25 = 5")), "o_orderkey", "worker")


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def jsonl_round_trip(spark, d):
    at = folder(spark)
    jsonlines.write_jsonl(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), at, ["s_suppkey"])
    found = jsonlines.read_jsonl(spark, at + "/*.txt", "s_suppkey bigint, s_name string, s_nationkey int")
    return found.filter("problem IS NULL").select("value.*")


@query("""WITH o AS (SELECT o_custkey, o_orderpriority AS kind, CASE o_orderkey % 3 WHEN 0 THEN 'tr' WHEN 1 THEN 'tr-' || o_orderstatus || o_orderkey % 100 ELSE 'trx' END AS code FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY kind, code <> 'tr', length(code), code) AS r FROM o WHERE code = 'tr' OR starts_with(code, 'tr-')) SELECT o_custkey, kind, code FROM r WHERE r = 1""")
def ranked_choice_orders(spark, d):
    rest = F.col("o_orderkey") % 3
    code = F.when(rest == 0, "tr").when(rest == 1, F.concat(F.lit("tr-"), "o_orderstatus", (F.col("o_orderkey") % 100).cast("string"))).otherwise("trx")
    rows = table(spark, d, "orders").select("o_custkey", F.col("o_orderpriority").alias("kind"), code.alias("code"))
    return select.ranked_choice(rows, ["o_custkey"], "kind", ["1-URGENT", "2-HIGH"], "code", "tr").select("o_custkey", "kind", "code")


@query(f"""WITH {IV}, u AS (SELECT user_id, event_id AS i, start_ms, end_ms, event_type AS text FROM iv WHERE event_type = 'view' UNION ALL SELECT user_id, event_id, start_ms, end_ms, event_type FROM iv WHERE event_type = 'click')
SELECT user_id, text, start_ms, row_number() OVER (PARTITION BY user_id ORDER BY start_ms, end_ms, text) - 1 AS utterance_index FROM u""")
def merged_utterances_events(spark, d):
    ev = event_intervals(spark, d).select("user_id", F.col("event_id").alias("utterance_index"), "start_ms", "end_ms", F.col("event_type").alias("text"))
    return captions.merged_utterances(ev.filter("text = 'view'"), ev.filter("text = 'click'"), USER).select("user_id", "text", "start_ms", "utterance_index")


@query("""WITH x AS (SELECT p_partkey, p_size, p_type LIKE '%STEEL%' AS hole FROM part), r AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN '' ELSE 'text' END AS corrected, p_size % 5 = 2 AS non_dialogue, p_size % 2 = 0 AS audio_reviewed, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 3 = 0 THEN 'dialogue' ELSE 'none' END AS disposition, hole FROM x)
SELECT p_partkey, CASE WHEN corrected IS NULL AND disposition IS NULL THEN 'pending' WHEN non_dialogue AND audio_reviewed THEN 'non_dialogue' WHEN trim(coalesce(corrected, '')) <> '' THEN 'align' WHEN hole AND audio_reviewed AND disposition = 'dialogue' THEN 'dialogue' WHEN audio_reviewed THEN 'discard' ELSE 'pending' END AS route FROM r""")
def routed_parts(spark, d):
    parts = table(spark, d, "part")
    rest = F.col("p_size") % 5
    corrections = parts.select("p_partkey", F.when(rest == 0, None).when(rest == 1, "").otherwise("text").alias("corrected"), (rest == 2).alias("non_dialogue"), (F.col("p_size") % 2 == 0).alias("audio_reviewed"), F.when(rest == 0, None).when(F.col("p_size") % 3 == 0, "dialogue").otherwise("none").alias("disposition"))
    return captions.routed(parts.select("p_partkey"), corrections, parts.filter(F.col("p_type").contains("STEEL")).select("p_partkey"), "p_partkey").select("p_partkey", "route")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'manual' ELSE o_orderstatus END AS decision, o_orderkey % 5 = 0 AS by_hand FROM orders""")
def overridden_decisions_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("decision"))
    return captions.with_overrides(orders, orders.filter("o_orderkey % 5 = 0").withColumn("decision", F.lit("manual")), "o_orderkey")


@query("""WITH w AS (SELECT o_custkey AS window_, list_distinct(list(o_orderkey)) AS owned FROM orders WHERE o_orderkey % 8 <> 3 GROUP BY 1), e AS (SELECT unnest(owned) AS item FROM w)
SELECT o_orderkey AS item, 'unowned' AS code FROM orders WHERE o_orderkey NOT IN (SELECT item FROM e)""")
def ownership_issues_orders(spark, d):
    orders = table(spark, d, "orders")
    windows = orders.filter("o_orderkey % 8 <> 3").groupBy(F.col("o_custkey").alias("window")).agg(F.collect_set("o_orderkey").alias("owned"), F.array().cast("array<bigint>").alias("context"))
    return validate.ownership_issues(windows, orders.select(F.col("o_orderkey").alias("item")), "window", "owned", "context", "item")


@query(f"""WITH {IV}, o AS (SELECT event_id, lag(event_id) OVER w AS before, user_id FROM iv WINDOW w AS (PARTITION BY user_id ORDER BY start_ms, event_id)) SELECT event_id AS part FROM o WHERE before IS NULL AND user_id NOT IN (SELECT user_id FROM iv WHERE event_type = 'signup') ORDER BY 1 LIMIT 1""")
def next_part_users(spark, d):
    from spanframe.streaming import incremental

    ev = event_intervals(spark, d)
    first = ev.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy("start_ms", "event_id"))).filter("r = 1").select("user_id", F.col("event_id").alias("part"))
    return incremental.next_part(first, ev.filter("event_type = 'signup'").select("user_id").distinct(), "user_id", "part").select("part")
