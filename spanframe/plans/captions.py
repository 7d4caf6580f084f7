"""Captions against recognised speech: orphans, doubtful recognitions, correction rows and their routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanframe.functions import text
from spanframe.operators import intervals as iv
from spanframe.operators import sequences

BOUNDS = ("start_ms", "end_ms")


def orphan_captions(captions: DataFrame, utterances: DataFrame, vad: DataFrame, keys: Sequence[str], least_coverage: float = 0.5, longest_run: int = 229, least_evidence: int = 120, trailing: int = 500, least_shared: int = 2, least_dice: float = 0.5) -> DataFrame:
    """Captions (keys, caption_index, start_ms, end_ms, text) that speech doesn't explain.

    Explained is a caption that evidence (utterances with text, and vad) covers by
    least_coverage without a bare run over longest_run; or that has
    least_evidence of it, short bare runs before and between, and a tail of at most
    trailing; or whose overlapping utterances last least_evidence and share
    words with it.
    """
    by = [*keys, "caption_index"]
    spoken = utterances.filter(F.trim("text") != "")
    evidence = iv.coalesce_intervals(spoken.select(*keys, *BOUNDS).unionByName(vad.select(*keys, *BOUNDS)), list(keys))
    own = captions.select(*by, F.col("start_ms").alias("cs"), F.col("end_ms").alias("ce"))
    covered = iv.coverage(own, evidence, list(keys), ("cs", "ce"), BOUNDS).select(*keys, "cs", "ce", "covered_ms")
    gaps = iv.subtract_intervals(own, evidence, list(keys), ("cs", "ce"), BOUNDS).withColumn("run", F.col("gap_end") - F.col("gap_start"))
    runs = gaps.groupBy(*keys, "cs", "ce").agg(F.max("run").alias("longest"), F.max(F.when(F.col("gap_end") < F.col("ce"), F.col("run"))).alias("inner"), F.max(F.when(F.col("gap_end") == F.col("ce"), F.col("run"))).alias("tail"))
    near = iv.interval_join(captions.select(*by, F.col("start_ms").alias("cs"), F.col("end_ms").alias("ce"), F.col("text").alias("caption")), spoken.select(*keys, *BOUNDS, "text"), list(keys), ("cs", "ce"), BOUNDS)
    both = near.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*BOUNDS, "text"))), lambda x: x["text"]), " ").alias("heard"))
    clipped = near.select(*by, F.greatest("cs", "start_ms").alias("start_ms"), F.least("ce", "end_ms").alias("end_ms"))
    heard_ms = iv.coalesce_intervals(clipped, by).groupBy(*by).agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("heard_ms"))
    joined = captions.withColumn("cs", F.col("start_ms")).withColumn("ce", F.col("end_ms")).join(covered.distinct(), [*keys, "cs", "ce"], "left").join(runs, [*keys, "cs", "ce"], "left").join(both, by, "left").join(heard_ms, by, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    length = F.col("ce") - F.col("cs")
    a = (zero("covered_ms") >= length * least_coverage) & (zero("longest") <= longest_run)
    b = (zero("covered_ms") >= least_evidence) & (zero("inner") <= longest_run) & (zero("tail") <= trailing)
    mine, theirs = text.tokens(F.col("text")), text.tokens(F.coalesce("heard", F.lit("")))
    c = (zero("heard_ms") >= least_evidence) & ((text.shared_tokens(mine, theirs) >= least_shared) | (text.bigram_dice(F.array_join(mine, " "), F.array_join(theirs, " ")) >= least_dice))
    return joined.filter(~(a | b | c)).select(*captions.columns)




def merged_utterances(utterances: DataFrame, extra: DataFrame, keys: Sequence[str], index: str = "utterance_index") -> DataFrame:
    """Both relations as one, numbered anew in order of time."""
    both = utterances.drop(index).unionByName(extra.drop(index), allowMissingColumns=True)
    order = Window.partitionBy(*keys).orderBy("start_ms", "end_ms", "text")
    return both.withColumn(index, F.row_number().over(order) - 1)


def doubtful_utterances(utterances: DataFrame, vad: DataFrame, keys: Sequence[str], uid: str, markers: Sequence[str] = (), requested: Sequence[str] = (), low_ratio: float = 0.20, logprob: float = -0.80, no_speech: float = 0.50, compression: float = 2.40) -> DataFrame:
    """(uid, overlap_ratio, reasons, candidate): what makes an utterance doubtful.

    utterances has avg_logprob, no_speech_prob, compression_ratio, temperature and
    structural. Candidates are structural or requested ones, those with no or little
    speech under them, strongly compressed ones, and those with two weak signs.
    """
    parts = iv.interval_join(utterances.select(*keys, uid, *BOUNDS), iv.coalesce_intervals(vad, list(keys)).select(*keys, F.col("start_ms").alias("vs"), F.col("end_ms").alias("ve")), list(keys), BOUNDS, ("vs", "ve"))
    sums = parts.groupBy(uid).agg(F.sum(iv.overlap(F.col("start_ms"), F.col("end_ms"), F.col("vs"), F.col("ve"))).alias("overlap_ms"))
    rows = utterances.join(sums, uid, "left").withColumn("overlap_ratio", iv.safe_ratio(F.coalesce("overlap_ms", F.lit(0)), F.col("end_ms") - F.col("start_ms")))
    marked = text.contains_phrase(F.col("text"), markers)
    weak = {"low_logprob": F.col("avg_logprob") <= logprob, "no_speech": F.col("no_speech_prob") >= no_speech, "temperature": F.col("temperature") > 0, "marker": marked, "compressed": F.col("compression_ratio") >= compression}
    strong = {"structural": F.col("structural"), "no_overlap": F.col("overlap_ratio") == 0, "low_overlap": (F.col("overlap_ratio") > 0) & (F.col("overlap_ratio") <= low_ratio), "repetitive": text.is_repetitive(text.tokens(F.col("text"))), "requested": F.col(uid).isin(*requested) if requested else F.lit(False)}
    flags = {name: F.coalesce(c, F.lit(False)) for name, c in {**strong, **weak}.items()}
    hits = lambda names: sum((flags[n].cast("int") for n in names), F.lit(0))
    candidate = (hits([*strong, "compressed"]) > 0) | (hits(weak) >= 2)
    return rows.select(*keys, uid, "overlap_ratio", F.array_compact(F.array(*[F.when(c, n) for n, c in flags.items()])).alias("reasons"), candidate.alias("candidate"))


def correction_utterances(words: DataFrame, captions: DataFrame, keys: Sequence[str], gap: int = 650, review_gap: int = 5000, context: int = 2) -> DataFrame:
    """(keys, utterance_index, start_ms, end_ms, text, caption_text, context_before, context_after, review) from words, split at gaps, with the captions over them."""
    parts = sequences.gap_split(words, list(keys), "start_ms", "end_ms", "text", gap, review_gap).withColumnRenamed("part", "utterance_index")
    by = [*keys, "utterance_index"]
    hit = iv.interval_join(parts.select(*by, *BOUNDS), captions.select(*keys, F.col("start_ms").alias("cs"), F.col("end_ms").alias("ce"), F.col("text").alias("caption")), list(keys), BOUNDS, ("cs", "ce"))
    over = hit.groupBy(*by).agg(F.array_join(text.compacted_texts(F.transform(F.array_sort(F.collect_list(F.struct("cs", "ce", "caption"))), lambda x: x["caption"])), " ").alias("caption_text"))
    return sequences.with_context(parts.join(over, by, "left").fillna("", ["caption_text"]), list(keys), ["utterance_index"], "text", context)


def routed(utterances: DataFrame, corrections: DataFrame, holes: DataFrame, uid: str = "utterance_uid") -> DataFrame:
    """utterances with their corrections and holes, and route: align, dialogue, non_dialogue, discard or pending.

    corrections: (uid, corrected, non_dialogue, audio_reviewed, disposition). What is
    reviewed to be no dialogue is kept apart; blank rows whose hole is reviewed are
    dialogue without text or discarded; rows not yet reviewed are pending.
    """
    both = utterances.join(corrections, uid, "left").join(holes.select(uid, F.lit(True).alias("is_hole")), uid, "left").fillna(False, ["is_hole"])
    blank = F.trim(F.coalesce("corrected", F.lit(""))) == ""
    route = (
        F.when(F.col("corrected").isNull() & F.col("disposition").isNull(), "pending")
        .when(F.col("non_dialogue") & F.col("audio_reviewed"), "non_dialogue")
        .when(~blank, "align")
        .when(F.col("is_hole") & F.col("audio_reviewed") & (F.col("disposition") == "dialogue"), "dialogue")
        .when(F.col("audio_reviewed"), "discard")
        .otherwise("pending")
    )
    return both.withColumn("route", route)


def machine_decisions(df: DataFrame, original: str, decoded: str, second: str, overlap: str, accept: float = 0.85, reject: float = 0.35) -> DataFrame:
    """df with similarity and decision: accept where the decode agrees, drop where both decodes are blank over no speech, else review."""
    likeness = text.similarity(text.normalized(F.col(original)), text.normalized(F.col(decoded)))
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    return df.withColumn("similarity", likeness).withColumn("decision", F.when(F.col("similarity") >= accept, "accept").when(blank(decoded) & blank(second) & (F.col(overlap) == 0), "drop").when(F.col("similarity") <= reject, "replace").otherwise("review"))


def with_overrides(decisions: DataFrame, overrides: DataFrame, uid: str) -> DataFrame:
    """A manual decision (uid, decision) takes the machine's place."""
    manual = overrides.select(uid, F.col("decision").alias("manual"))
    return decisions.join(manual, uid, "left").withColumn("decision", F.coalesce("manual", "decision")).withColumn("by_hand", F.col("manual").isNotNull()).drop("manual")


def acoustic_duplicates(items: DataFrame, keys: Sequence[str], uid: str, most_tokens: int = 3, longer: float = 2.0, least_ratio: float = 0.65) -> DataFrame:
    """(uid, parent, similarity): short items inside one at least `longer` times as long whose tokens stand there, or whose one token is like one there; the longest, most overlapping parent."""
    token = text.tokens(F.col("text"))
    child = items.withColumn("tokens", token).filter(F.size("tokens").between(1, most_tokens)).select(*keys, uid, *BOUNDS, "tokens")
    parent = items.select(*keys, F.col(uid).alias("parent"), F.col("start_ms").alias("ps"), F.col("end_ms").alias("pe"), token.alias("parent_tokens"))
    hit = iv.containment_join(parent, child, list(keys), ("ps", "pe"), BOUNDS).filter((F.col(uid) != F.col("parent")) & (F.col("pe") - F.col("ps") >= longer * (F.col("end_ms") - F.col("start_ms"))))
    exact = F.size(text.contiguous_matches(F.col("parent_tokens"), F.col("tokens"))) > 0
    distance = F.array_min(F.transform("parent_tokens", lambda t: F.levenshtein(t, F.get("tokens", 0)) / F.greatest(F.length(t), F.length(F.get("tokens", 0)))))
    hit = hit.withColumn("similarity", F.when(exact, 1.0).when(F.size("tokens") == 1, 1 - distance).otherwise(0.0)).filter(F.col("similarity") >= least_ratio)
    best = Window.partitionBy(*keys, uid).orderBy(F.desc(F.col("pe") - F.col("ps")), F.desc("similarity"), "parent")
    return hit.withColumn("r", F.row_number().over(best)).filter("r = 1").select(*keys, uid, "parent", "similarity")


def speaker_votes(frames: DataFrame, utterances: DataFrame, keys: Sequence[str], uid: str, at: str = "at_ms", values: str = "probabilities", least_voice: float = 0.5, least_frames: int = 5, least_share: float = 0.8, least_mean: float = 0.8, least_peak: float = 0.9) -> DataFrame:
    """(uid, winner): the column that dominates the frames whose centre lies in an utterance, by number, share, mean and peak; null otherwise."""
    centre = frames.select(*keys, F.col(at).alias("fs"), (F.col(at) + 1).alias("fe"), F.col(values).alias("p"))
    hit = iv.interval_join(utterances.select(*keys, uid, *BOUNDS), centre, list(keys), BOUNDS, ("fs", "fe")).withColumn("top", F.array_max("p")).filter(F.col("top") >= least_voice)
    voted = hit.withColumn("winner", F.array_position("p", F.col("top")).cast("int") - 1).groupBy(uid, "winner").agg(F.count("*").alias("n"), F.avg("top").alias("mean"), F.max("top").alias("peak"))
    by = Window.partitionBy(uid)
    ranked = voted.withColumn("share", F.col("n") / F.sum("n").over(by)).withColumn("r", F.row_number().over(by.orderBy(F.desc("n"), "winner"))).filter("r = 1")
    good = (F.col("n") >= least_frames) & (F.col("share") >= least_share) & (F.col("mean") >= least_mean) & (F.col("peak") >= least_peak)
    return utterances.select(uid).join(ranked.select(uid, F.when(good, F.col("winner")).alias("winner")), uid, "left")


def span_speakers(spans: DataFrame, turns: DataFrame, keys: Sequence[str], uid: str, speaker: str = "speaker", least_share: float = 0.8) -> DataFrame:
    """(uid, speaker): the one speaker whose turns overlap a span and together cover least_share of it; null if several overlap, none does, or too little is covered."""
    named = turns.select(*keys, F.col("start_ms").alias("ts"), F.col("end_ms").alias("te"), F.col(speaker).alias("__speaker"))
    hit = iv.interval_join(spans.select(*keys, uid, *BOUNDS), named, list(keys), BOUNDS, ("ts", "te"))
    clipped = hit.select(*keys, uid, "__speaker", F.greatest("start_ms", "ts").alias("start_ms"), F.least("end_ms", "te").alias("end_ms"))
    united = iv.coalesce_intervals(clipped, [*keys, uid, "__speaker"])
    sums = united.groupBy(*keys, uid).agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("covered"), F.count_distinct("__speaker").alias("n"), F.min("__speaker").alias("one"))
    both = spans.select(*keys, uid, *BOUNDS).join(sums, [*keys, uid], "left")
    return both.select(uid, F.when((F.col("n") == 1) & (F.col("covered") >= least_share * (F.col("end_ms") - F.col("start_ms"))), F.col("one")).alias(speaker))


def word_gate(words: DataFrame, vad: DataFrame, reviews: DataFrame, keys: Sequence[str], word: str, uid: str, least_ratio: float = 0.5, most_outside: int = 120) -> DataFrame:
    """(word, overlap_ms, ratio, leading, trailing, longest_outside, verdict) of each word: compliant, exception or unsafe.

    A word is compliant if vad intervals, counted each for itself, overlap it by
    least_ratio and no part over most_outside long lies outside all of them. One
    that isn't is an exception if a confirmed review (uid, start_ms, end_ms) of its
    own utterance holds it whole. Empty words overlap nothing and are unsafe.
    """
    regions = vad.select(*keys, F.col("start_ms").alias("vs"), F.col("end_ms").alias("ve"))
    hit = iv.interval_join(words.select(*keys, word, *BOUNDS), regions, list(keys), BOUNDS, ("vs", "ve"))
    sums = hit.groupBy(*keys, word).agg(F.sum(F.least("end_ms", "ve") - F.greatest("start_ms", "vs")).alias("overlap_ms"), F.min("vs").alias("first"), F.max_by("ve", F.struct("vs", "ve")).alias("last"))
    gaps = iv.subtract_intervals(words.select(*keys, F.col("start_ms").alias("ws"), F.col("end_ms").alias("we")), vad, list(keys), ("ws", "we"), BOUNDS).groupBy(*keys, F.col("ws").alias("start_ms"), F.col("we").alias("end_ms")).agg(F.max(F.col("gap_end") - F.col("gap_start")).alias("longest_outside"))
    confirmed = reviews.select(F.col(uid), F.col("start_ms").alias("rs"), F.col("end_ms").alias("re"))
    inside = words.select(word, uid, *BOUNDS).join(confirmed, uid).filter("rs <= start_ms AND end_ms <= re").select(word, F.lit(True).alias("held")).distinct()
    rows = words.join(sums, [*keys, word], "left").join(gaps, [*keys, *BOUNDS], "left").join(inside, word, "left")
    length = F.col("end_ms") - F.col("start_ms")
    overlap = F.coalesce("overlap_ms", F.lit(0)).cast("bigint")
    ratio = F.coalesce(F.try_divide(overlap, length), F.lit(0.0))
    outside = F.coalesce("longest_outside", F.lit(0)).cast("bigint")
    fine = (length > 0) & (ratio >= least_ratio) & (outside <= most_outside)
    edge = lambda c: F.when(F.col("overlap_ms").isNull(), length).otherwise(c)
    return rows.select(
        word, overlap.alias("overlap_ms"), ratio.alias("ratio"), edge(F.greatest("first", "start_ms") - F.col("start_ms")).alias("leading"), edge(F.col("end_ms") - F.least("last", "end_ms")).alias("trailing"),
        outside.alias("longest_outside"), F.when(fine, "compliant").when(F.col("held"), "exception").otherwise("unsafe").alias("verdict"),
    )
