"""Checks of translations against their blocks: final quality rules and displaced texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanframe.functions import text
from spanframe.operators import intervals as iv
from spanframe.operators import sequences, validate
from spanframe.operators.ordering import dealt, written


def final_qa(blocks: DataFrame, keys: Sequence[str], uid: str, source: str, target: str, rules: Sequence[tuple[str, str, str]] = (), names: Sequence[str] = (), units: Sequence[str] = (), most_cps: float = 17.0, line_limit: int = 42, music: Sequence[str] = ()) -> DataFrame:
    """(uid, code, severity) of blocks (keys, uid, block_index, start_ms, end_ms, speech_start, speech_end, source, target, review_required)."""
    by = Window.partitionBy(*keys).orderBy("block_index")
    s, t = F.col(source), F.col(target)
    rows = blocks.withColumn("position", F.row_number().over(by) - 1).withColumn("last_end", F.lag("end_ms").over(by)).withColumn("layout", text.wrap_text(t, line_limit))
    lines = F.split(t, "\n")
    is_music = lambda c: text.lexical(c).isin(*music) if music else F.lit(False)
    numbers = lambda c: F.array_sort(text.number_anchors(c))
    found = {
        "invalid_timing": ("error", F.col("start_ms").isNull() | F.col("end_ms").isNull() | (F.col("start_ms") < 0) | (F.col("end_ms") <= F.col("start_ms"))),
        "block_index_mismatch": ("error", F.col("block_index") != F.col("position")),
        "empty_text": ("error", F.trim(F.coalesce(t, F.lit(""))) == ""),
        "more_than_two_lines": ("error", F.size(lines) > 2),
        "line_over_limit": ("error", F.col("layout").isNull() & (F.size(lines) <= 2) & (F.trim(t) != "") | F.exists(lines, lambda x: text.visible_length(x) > 2 * line_limit)),
        "high_cps": ("warning", text.chars_per_second(text.visible_length(t), F.col("start_ms"), F.col("end_ms")) > most_cps),
        "special_name_mismatch": ("error", ~text.names_present(s, names).eqNullSafe(text.names_present(t, names)) if names else F.lit(False)),
        "numeric_anchor_mismatch": ("error", numbers(s) != numbers(t)),
        "money_value_mismatch": ("error", F.size(F.array_except(text.money_anchors(s, units), text.number_anchors(t))) > 0 if units else F.lit(False)),
        "expression_mismatch": ("error", F.size(text.rule_failures(s, t, rules)) > 0),
        "music_speech_handling": ("error", is_music(s) != is_music(t)),
        "mixed_speaker_block": ("error", F.size(F.filter(lines, lambda x: sequences.starts_turn(x))) > 1),
        "translator_review_required": ("warning", F.col("review_required")),
        "subtitle_overlap": ("error", F.col("start_ms") < F.col("last_end")),
        "early_start": ("error", F.col("start_ms") < F.col("speech_start") - 80),
        "early_end": ("error", F.col("end_ms") < F.col("speech_end")),
    }
    return validate.issues(rows, uid, found)


def qa_report(issues: DataFrame, codes: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """One row: a count for each code, and passed: no error among them."""
    out = issues.agg(*[F.count_if(F.col("code") == c).alias(c) for c in codes], F.count_if(F.col("severity") == "error").alias("errors"))
    return out.withColumn("passed", F.col("errors") == 0)


def displaced_texts(blocks: DataFrame, keys: Sequence[str], index: str, source: str, back: str, width: int = 6, high: float = 0.78, margin: float = 0.18, moderate: float = 0.62, small: float = 0.10, names: Sequence[str] = (), stop_words: Sequence[str] = (), anchored: float = 0.55, unlike: float = 0.36) -> DataFrame:
    """(keys, index, offset, score, own_score, reason): texts that came back for another block.

    A text is scored against its own source and, if it isn't quite that, those up
    to width blocks away. One that is exactly one near block's source, or far better
    there than here, is flagged; so is one whose anchors (names and numbers) all
    stand in the best near source and not all here, and one without any content
    token of its own source that is hardly like it. One that is exactly the source
    of one other block anywhere in its key, or rather better near by, counts if its
    neighbour is displaced by as much. Sources are met by an equi join on the
    normalised text, so the whole key is searched. Near scores that can't count
    aren't worked out.
    """
    by = [*keys, index]
    rows = blocks.select(*by, F.col(source).alias("s"), F.col(back).alias("b"))
    anchors = lambda c: F.array_distinct(F.concat(text.names_present(F.col(c), names), text.number_anchors(F.col(c))))
    # matching costs much a row, so rows are dealt to all tasks first
    scored = dealt(rows, by).withColumn("own_score", text.blended_similarity(F.col("b"), F.col("s"))).withColumn("same", text.lexical(F.col("b"))).withColumn("itself", text.lexical(F.col("s")) == F.col("same"))
    # only these can be anywhere else; written, so that they are scored once
    own = written(scored.filter("own_score < 1"), "unlike")
    # a near score counts from here on; one that stays below is never the best that counts
    counts = F.greatest("own_score", F.when(F.size(anchors("b")) > 0, F.lit(min(anchored, moderate, high))).otherwise(F.lit(min(moderate, high))))
    offsets = F.filter(F.sequence(F.lit(-width), F.lit(width)), lambda o: o != 0)
    sources = rows.select(*keys, F.col(index).alias("__at"), F.col("s").alias("other_s"))
    pairs = own.select(*by, "b", "same", counts.alias("least"), F.explode(offsets).alias("offset")).withColumn("__at", F.col(index) + F.col("offset")).join(sources, [*keys, "__at"])
    met = written(dealt(pairs, [*by, "offset"]).select(*by, "offset", "other_s", text.blended_similarity(F.col("b"), F.col("other_s"), F.col("least")).alias("score"), (text.lexical(F.col("other_s")) == F.col("same")).alias("equal")), "near")
    near = met.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "offset"))).filter("r = 1").select(*by, F.col("offset").alias("near_offset"), F.col("score").alias("near_score"), F.col("other_s").alias("near_s"))
    exact_near = met.filter("equal").groupBy(*by).agg(F.count("*").alias("n_near"), F.min("offset").alias("exact_offset")).filter("n_near = 1").drop("n_near")
    # places are counted for each text, and only a text with one place goes on
    places = blocks.select(*keys, F.col(index).alias("at"), text.lexical(F.col(source)).alias("same")).filter("same <> ''").distinct()
    alone = places.groupBy(*keys, "same").agg(F.count("*").alias("n"), F.min("at").alias("place")).filter("n = 1").drop("n")
    exact_far = own.join(alone, [*keys, "same"]).filter(F.col("place") != F.col(index)).select(*by, (F.col("place") - F.col(index)).alias("far_offset"))
    all_ = own.join(near, by, "left").join(exact_near, by, "left").join(exact_far, by, "left")
    gain = F.col("near_score") - F.col("own_score")
    shared = lambda c: F.size(F.array_intersect(anchors("b"), anchors(c)))
    by_anchor = (F.size(anchors("b")) > 0) & (gain > 0) & (F.col("near_score") >= anchored) & (shared("near_s") == F.size(anchors("b"))) & (shared("near_s") > shared("s"))
    content = lambda c: text.content_tokens(F.when(F.col("own_score") < unlike, F.col(c)).otherwise(""), stop_words)
    told = all_.withColumn("__mine", content("s")).withColumn("__got", content("b"))
    unsupported = (F.col("own_score") < unlike) & (F.size("__mine") >= 2) & (F.size("__got") >= 2) & ~F.arrays_overlap("__mine", "__got")
    kind = (
        F.when(~F.col("itself") & F.col("exact_offset").isNotNull(), "exact_neighbour")
        .when(~F.col("itself") & F.col("far_offset").isNotNull(), "exact_elsewhere")
        .when((F.col("near_score") >= high) & (gain >= margin), "better_neighbour")
        .when(by_anchor, "anchors_of_neighbour")
        .when(unsupported, "unsupported")
        .when((F.col("near_score") >= moderate) & (gain >= small), "rather_better")
    )
    marked = told.withColumn("kind", kind).filter("kind IS NOT NULL")
    offset = F.when(F.col("kind") == "exact_neighbour", F.col("exact_offset")).when(F.col("kind") == "exact_elsewhere", F.col("far_offset")).when(F.col("kind") == "unsupported", 0).otherwise(F.col("near_offset"))
    score = F.when(F.col("kind").startswith("exact"), 1.0).when(F.col("kind") == "unsupported", F.col("own_score")).otherwise(F.col("near_score"))
    runs = sequences.islands(marked.withColumn("offset", offset).withColumn("score", score), keys, index, "offset")
    strong = F.when(~F.col("kind").isin("exact_elsewhere", "rather_better"), F.col("kind"))
    return runs.withColumn("reason", F.coalesce(strong, F.when(F.col("in_run"), "displaced_run"))).filter("reason IS NOT NULL").select(*by, "offset", "score", "own_score", "reason")


def anchor_displacements(blocks: DataFrame, keys: Sequence[str], index: str, source: str, target: str, names: Sequence[str], width: int | None = 6) -> DataFrame:
    """(keys, index, other): blocks whose target has two anchors or more, all those of exactly one source, and not those of its own.

    Sources are those up to width blocks away; where none of them has the
    anchors, those of the whole key, and with width None these from the start.
    """
    signature = lambda c: F.array_sort(F.concat(text.names_present(c, names), text.number_anchors(c)))
    rows = blocks.select(*keys, index, signature(F.col(source)).alias("own"), signature(F.col(target)).alias("got")).filter(F.size("got") >= 2).filter("own <> got")
    sources = blocks.select(*keys, F.col(index).alias("other"), signature(F.col(source)).alias("got"))
    # of a signature that many sources share, one of them and their number are enough for the whole key
    shared = sources.groupBy(*keys, "got").agg(F.count("*").alias("n"), F.min("other").alias("other")).filter("n = 1").drop("n")
    anywhere = rows.join(shared, [*keys, "got"]).select(*keys, index, "other")
    if width is None:
        return anywhere
    band = F.expr(f"sequence({index} - {width}, {index} + {width})")
    near = rows.withColumn("other", F.explode(band)).join(sources, [*keys, "other", "got"]).groupBy(*keys, index).agg(F.count("*").alias("n"), F.min("other").alias("other"))
    rest = anywhere.join(near.select(*keys, index), [*keys, index], "left_anti")
    return near.filter("n = 1").select(*keys, index, "other").unionByName(rest)
