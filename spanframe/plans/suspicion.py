"""Segments of a first recognition that deserve a second look, scored by reason and merged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanframe.functions import text
from spanframe.operators import intervals, select, spans
from spanframe.operators.ordering import dealt, written

#: What each reason weighs.
WEIGHTS = {
    "very_low_word_confidence": 100,
    "low_segment_logprob": 90,
    "caption_conflict": 80,
    "strange_text": 75,
    "large_internal_gap": 70,
    "music": 65,
    "possible_speaker_change": 60,
    "sensitive_term": 55,
    "low_word_confidence": 50,
    "high_no_speech": 45,
}


def reasons_of(segments: DataFrame, names: Sequence[str] = (), markers: Sequence[str] = (), word_probability: float = 0.55, logprob: float = -0.8, no_speech: float = 0.6, gap: int = 1500) -> Column:
    """Sorted reasons of a segment (text, words, avg_logprob, no_speech_prob, caption, caption_differs).

    words: array of (start_ms, end_ms, probability). Null values give no reason;
    a blank text only looks strange.
    """
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    least = F.array_min(F.transform("words", lambda w: w["probability"]))
    gaps = F.transform("words", lambda w, i: w["start_ms"] - F.get("words", i - 1)["end_ms"])
    said = F.coalesce("text", F.lit(""))
    rules: Mapping[str, Column] = {
        "low_word_confidence": least < word_probability,
        "very_low_word_confidence": least < max(0.25, word_probability - 0.25),
        "low_segment_logprob": F.col("avg_logprob") < logprob,
        "high_no_speech": ~blank & (F.col("no_speech_prob") > no_speech),
        "large_internal_gap": F.exists(gaps, lambda g: F.coalesce(g > gap, F.lit(False))),
        "strange_text": text.is_strange(said),
        "possible_speaker_change": said.rlike(r"(?:^|\n)\s*[-–—]\s*\S") | said.rlike(r"\s[-–—]\s"),
        "music": said.rlike("(?i)" + "|".join(markers)) if markers else F.lit(False),
        "sensitive_term": text.contains_phrase(said, names),
        "caption_conflict": ~blank & (F.col("caption") != "") & F.col("caption_differs"),
    }
    return F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in rules.items()])))


def suspicious_spans(segments: DataFrame, captions: DataFrame, keys: Sequence[str], segment_id: str, names: Sequence[str] = (), markers: Sequence[str] = (), merge_gap: int = 1200, longest: int = 45_000, similarity: float = 0.55, **bounds) -> DataFrame:
    """(keys, span, start_ms, end_ms, n_spans, reasons, segment_ids, priority, primary_text, caption_text): segments with a reason, merged under a gap and a cap.

    A span has the reasons of its segments, the greatest weight among them, and
    their texts in order. A segment's caption is what of the captions overlaps it,
    in order, without repeats; only where there is one are texts compared (it differs
    if its similarity is below the bound).
    Segments that overlap nothing, and an empty relation, do no harm.
    """
    by = [*keys, segment_id]
    over = intervals.interval_join(segments.select(*by, "start_ms", "end_ms"), captions.select(*keys, F.col("start_ms").alias("cs"), F.col("end_ms").alias("ce"), F.col("text").alias("caption")), keys, ("start_ms", "end_ms"), ("cs", "ce"))
    heard = over.groupBy(*by).agg(F.array_join(text.compacted_texts(F.transform(F.array_sort(F.collect_list(F.struct("cs", "ce", "caption"))), lambda x: x["caption"])), " ").alias("caption"))
    # matching costs much a row, so rows are dealt to all tasks first
    both = dealt(segments.select(*by, "text").join(heard.filter("caption <> ''"), by), by)
    compared = both.select(*by, "caption", text.less_similar(text.normalized(F.col("text")), text.normalized(F.col("caption")), similarity).alias("caption_differs"))
    rows = segments.join(compared, by, "left").fillna("", ["caption"])
    marked = rows.withColumn("reasons", reasons_of(rows, names, markers, **bounds)).filter(F.size("reasons") > 0)
    scored = marked.withColumns({"priority": select.priority(F.col("reasons"), WEIGHTS, 10), "segment_ids": F.array(F.col(segment_id)), "primary_text": F.trim("text"), "caption_text": F.col("caption")})
    # written with what the merge reads, since dealing by ranges would work it out twice
    slim = written(scored.select(*by, "start_ms", "end_ms", "reasons", "priority", "segment_ids", "primary_text", "caption_text"), "suspicious")
    return spans.capped_merge(slim, keys, gap=merge_gap, longest=longest, ties=[segment_id], sets=["reasons", "segment_ids"], greatest=["priority"], texts=["primary_text", "caption_text"])
