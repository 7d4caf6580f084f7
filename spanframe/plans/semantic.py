"""Word timelines, windows, exact covers by candidate texts, and final blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spanframe.functions import text
from spanframe.operators import intervals as iv
from spanframe.operators import sequences
from spanframe.operators.ordering import scanned, written


def word_timeline(words: DataFrame, vad: DataFrame, keys: Sequence[str], quarantined: Sequence[str] = ()) -> DataFrame:
    """words (keys, start_ms, end_ms, text, speaker_id, scene_id) in order, with sequence_index, normalized, the first region over each word, and quarantine: why it is left out."""
    order = Window.partitionBy(*keys).orderBy("start_ms", "end_ms", "text")
    rows = words.withColumn("sequence_index", F.row_number().over(order) - 1).withColumn("normalized", text.normalized(F.col("text")))
    regions = vad.select(*keys, "vad_region_index", F.col("start_ms").alias("vs"), F.col("end_ms").alias("ve"))
    over = iv.interval_join(rows.select(*keys, "sequence_index", "start_ms", "end_ms"), regions, list(keys), ("start_ms", "end_ms"), ("vs", "ve")).groupBy(*keys, "sequence_index").agg(F.min(F.struct("vad_region_index", "vs", "ve")).alias("region"))
    reason = F.when(F.col("normalized") == "", "no_words").when(F.col("normalized").isin(*quarantined) if quarantined else F.lit(False), "known_non_dialogue")
    return rows.join(over, [*keys, "sequence_index"], "left").withColumn("quarantine", reason)


def semantic_windows(timeline: DataFrame, keys: Sequence[str], hard_gap: int = 1000, most_words: int = 80, longest: int = 30_000, least_words: int = 8, sentence_gap: int = 180, context: int = 12) -> DataFrame:
    """timeline with window and the texts around each window: runs that end at hard boundaries, at caps, and at sentence ends behind enough words."""
    by = Window.partitionBy(*keys).orderBy("sequence_index")
    differs = lambda c: F.coalesce(F.col(c) != F.lag(c).over(by), F.lit(False))
    rows = timeline.filter("quarantine IS NULL").withColumn("vad_region", F.col("region.vad_region_index"))
    gap = F.col("start_ms") - F.lag("end_ms").over(by)
    hard = (F.col("sequence_index") != F.lag("sequence_index").over(by) + 1) | (gap > hard_gap) | differs("speaker_id") | differs("vad_region") | differs("scene_id")
    soft = sequences.ends_sentence(F.lag("text").over(by)) & (gap >= sentence_gap)
    rows = sequences.sessions(rows.withColumn("hard", F.coalesce(hard, F.lit(False))).withColumn("soft", F.coalesce(soft, F.lit(False))), keys, ["sequence_index"], F.col("hard"), "run").drop("hard")

    def begin() -> Callable[..., tuple[int]]:
        part, n, first = 0, 0, None

        def step(s: int, e: int, soft_end: bool, following: tuple | None) -> tuple[int]:
            nonlocal part, n, first
            if n and (n >= most_words or e - first > longest or soft_end and n >= least_words):
                part, n, first = part + 1, 0, None
            n, first = n + 1, s if first is None else first
            return (part,)

        return step

    numbered = scanned(rows, [*keys, "run"], ["sequence_index"], ["start_ms", "end_ms", "soft"], begin, "part bigint")
    window = F.dense_rank().over(Window.partitionBy(*keys).orderBy("run", "part")) - 1
    near = lambda a, b: F.array_join(F.collect_list("text").over(by.rowsBetween(a, b)), " ")
    out = numbered.withColumn("window", window).withColumn("before", near(-context, -1)).withColumn("after", near(1, context))
    own = Window.partitionBy(*keys, "window").orderBy("sequence_index")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return out.withColumn("context_before", F.first("before").over(whole)).withColumn("context_after", F.last("after").over(whole)).drop("before", "after", "soft", "run", "part")


#: Modulus and base of the hashes of runs of tokens.
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class TokenIndex:
    """Where runs of tokens stand: rolling hashes of all runs of a length, worked out once a length; a place counts once its tokens are compared."""

    def __init__(self, tokens: Sequence[str]):
        self.tokens = list(tokens)
        self.numbers: dict[str, int] = {}
        self.prefix, self.powers = [0], [1]
        for t in self.tokens:
            self.prefix.append((self.prefix[-1] * _BASE + self.numbers.setdefault(t, len(self.numbers) + 1)) % _PRIME)
            self.powers.append(self.powers[-1] * _BASE % _PRIME)
        self.by_length: dict[int, dict[int, list[int]]] = {}

    def places(self, needle: Sequence[str]) -> list[int]:
        """Where needle begins; empty runs stand nowhere."""
        n = len(needle)
        if not 0 < n <= len(self.tokens) or any(t not in self.numbers for t in needle):
            return []
        if n not in self.by_length:
            found: dict[int, list[int]] = {}
            for i in range(len(self.tokens) - n + 1):
                found.setdefault((self.prefix[i + n] - self.prefix[i] * self.powers[n]) % _PRIME, []).append(i)
            self.by_length[n] = found
        value = 0
        for t in needle:
            value = (value * _BASE + self.numbers[t]) % _PRIME
        return [i for i in self.by_length[n].get(value, []) if self.tokens[i : i + n] == list(needle)]


def safe_from(gaps: Sequence[int | None], speakers: Sequence[str | None], scenes: Sequence[str | None], most_gap: int) -> list[int]:
    """Of each word the earliest first word of a span that ends at it without an inner gap over most_gap, a second speaker or a second scene. gaps: in front of each word."""
    out, low = [], 0
    last: list[tuple[str, int] | None] = [None, None]  # the speaker and scene named last, and the earliest place after any other one
    for k, gap in enumerate(gaps):
        if k and gap is not None and gap > most_gap:
            low = k
        for i, named in enumerate((speakers[k], scenes[k])):
            if named is not None:
                if last[i] is not None and last[i][0] != named:
                    low = max(low, last[i][1] + 1)
                last[i] = named, k
        out.append(low)
    return out


def exact_cover(tokens: Sequence[str], candidates: Sequence[tuple[int, int, Sequence[str]]], safe=lambda first, last: True) -> list[tuple[int, int, int]] | None:
    """The fewest candidate spans (first, last, candidate) that cover all tokens in order, long spans first; None if there are none.

    candidates: (priority, id, tokens). A candidate counts if its tokens stand
    exactly once, on a safe span; of equal spans the least priority, then id. A
    shortest path over the places between tokens: each keeps the step that led to it.
    """
    index = TokenIndex(tokens)
    spans: dict[tuple[int, int], tuple[int, int]] = {}
    for rank, name, needle in candidates:
        places = index.places(needle)
        if len(places) == 1 and safe(places[0], places[0] + len(needle) - 1):
            at = places[0], places[0] + len(needle) - 1
            spans[at] = min(spans.get(at, (rank, name)), (rank, name))
    begin: dict[int, list[int]] = {}
    for first, last in spans:
        begin.setdefault(first, []).append(last)
    steps: dict[int, tuple[int, int]] = {0: (0, -1)}  # by place: spans so far, and where the last of them begins
    for at in range(len(tokens)):
        if at in steps:
            for last in sorted(begin.get(at, []), reverse=True):
                if last + 1 not in steps or steps[at][0] + 1 < steps[last + 1][0]:
                    steps[last + 1] = steps[at][0] + 1, at
    if not tokens or len(tokens) not in steps:
        return None
    path, at = [], len(tokens)
    while at:
        first = steps[at][1]
        path.append((first, at - 1, spans[first, at - 1][1]))
        at = first
    return path[::-1]


def exact_results(windows: DataFrame, candidates: DataFrame, keys: Sequence[str], most_gap: int = 1000) -> DataFrame:
    """(keys, window, first, last, candidate): exact covers of windows by candidate texts. windows: semantic_windows; candidates: (keys, window, priority, candidate, text).

    Unresolved windows have no rows. A window's words and candidates meet in one
    small group, which the window's caps bound; of candidates of one text only the
    first by priority and id goes there.
    """
    by = [*keys, "window"]
    word = F.struct("sequence_index", "normalized", "start_ms", "end_ms", "speaker_id", "scene_id")
    own = windows.groupBy(*by).agg(F.array_sort(F.collect_list(word)).alias("words"))
    needle = candidates.withColumn("needle", F.split(text.normalized(F.col("text")), " "))
    named = needle.groupBy(*by, "needle").agg(F.min(F.struct("priority", "candidate")).alias("c")).groupBy(*by).agg(F.collect_list(F.struct("c.priority", "c.candidate", "needle")).alias("found"))

    joined = own.join(named, by).select(*by, "words", "found")
    kind = to_arrow_schema(StructType([*(joined.schema[c] for c in by), *StructType.fromDDL("first bigint, last bigint, candidate bigint").fields]))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):  # a few windows' words at once as Python's objects
                out = []
                part = batch.slice(at, 16)
                for key, words, found in zip(zip(*(c.to_pylist() for c in part.columns[:-2]), strict=True), part.column(len(by)).to_pylist(), part.column(len(by) + 1).to_pylist(), strict=True):
                    gaps = [None, *(b["start_ms"] - a["end_ms"] for a, b in zip(words, words[1:], strict=False))]
                    low = safe_from(gaps, [w["speaker_id"] for w in words], [w["scene_id"] for w in words], most_gap)
                    path = exact_cover([w["normalized"] for w in words], [(f["priority"], f["candidate"], f["needle"]) for f in found], lambda first, last, low=low: first >= low[last])
                    out += [(*key, *span) for span in path or []]
                columns = list(zip(*out, strict=True)) if out else [()] * len(kind)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    kinds = ", ".join(f"`{c}` {joined.schema[c].dataType.simpleString()}" for c in by)
    return joined.mapInArrow(cover, f"{kinds}, first bigint, last bigint, candidate bigint")


def final_blocks(blocks: DataFrame, keys: Sequence[str], lead: int = 80, tail: int = 220, guard: int = 80) -> DataFrame:
    """blocks (keys, first_ms, last_ms, region_start, region_end, text) with start_ms, end_ms and flags: early_start, early_end, overlap, too_fast."""
    by = Window.partitionBy(*keys).orderBy("first_ms", "last_ms")
    start = F.greatest(F.lit(0).cast("bigint"), F.greatest(F.col("first_ms") - lead, F.coalesce("region_start", F.lit(0).cast("bigint"))))
    wanted = F.least(F.col("last_ms") + tail, F.greatest(F.col("last_ms"), F.coalesce("region_end", F.col("last_ms") + tail)))
    rows = blocks.withColumn("start_ms", F.least(start, F.col("first_ms"))).withColumn("end_ms", wanted)
    free = F.lead("start_ms").over(by) - guard
    rows = rows.withColumn("end_ms", F.when(free >= F.col("last_ms"), F.least("end_ms", free)).otherwise(F.col("end_ms")))
    rate = text.chars_per_second(text.non_space_length(F.col("text")), F.col("start_ms"), F.col("end_ms"))
    flags = {"early_start": F.col("start_ms") < F.col("first_ms") - lead, "early_end": F.col("end_ms") < F.col("last_ms"), "overlap": F.col("end_ms") > F.lead("start_ms").over(by), "too_fast": rate > 20}
    return rows.withColumn("flags", F.array_compact(F.array(*[F.when(c, n) for n, c in flags.items()])))


def words_to_blocks(words: DataFrame, keys: Sequence[str], hard_gap: int = 1000, **limits) -> DataFrame:
    """(keys, speaker_id, block, start_ms, last_ms, text, n_words, least_probability, display_end): words cut at hard boundaries of their speaker's lane, each run grouped at least cost, timed and put in order."""
    lane = [*keys, "speaker_id"]
    rows = words.withColumn("speaker_id", F.coalesce("speaker_id", F.lit("")))
    marked = sequences.hard_boundaries(rows, lane, ["start_ms", "end_ms"], "start_ms", "end_ms", "text", hard_gap=hard_gap).withColumn("opens", F.size("reasons") > 0)
    chunks = sequences.sessions(marked, lane, ["start_ms", "end_ms"], F.col("opens"), "chunk").drop("opens", "reasons", "gap_ms")
    # written, since groups are counted before they are cut
    grouped = sequences.optimal_groups(written(chunks, "chunks"), [*lane, "chunk"], ["start_ms", "end_ms"], "start_ms", "end_ms", "text", **limits)
    blocks = grouped.groupBy(*lane, "chunk", "part").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("last_ms"), text.joined_words(F.transform(F.array_sort(F.collect_list(F.struct("start_ms", "end_ms", "text"))), lambda x: x["text"])).alias("text"), F.count("*").alias("n_words"), F.min("probability").alias("least_probability"))
    timed = sequences.assigned_timings(blocks, lane, "start_ms", "last_ms", "text")
    order = Window.partitionBy(*keys).orderBy("start_ms", "speaker_id")
    return timed.withColumn("block", F.row_number().over(order) - 1).select(*keys, "speaker_id", "block", "start_ms", "last_ms", "text", "n_words", "least_probability", "display_end")


def group_statistics(words: DataFrame, vad: DataFrame, keys: Sequence[str], group: str) -> DataFrame:
    """(keys, group, start_ms, end_ms, n_words, max_gap, least_probability, mean_probability, segments, crossings, repaired, digests, without_digest, coverage, regions, flags) of each group of words, in one aggregation and one coverage.

    words: (keys, group, start_ms, end_ms, probability, segment_id, timing_source,
    alignment_sha256). Gaps and crossings are between neighbours in order of time;
    a null segment is passed over. Null probabilities don't count. flags:
    decoder_segment_crossing, repaired_word_provenance, partial_alignment_digest,
    several_alignment_digests.
    """
    by = [*keys, group]
    order = Window.partitionBy(*by).orderBy("start_ms", "end_ms")
    before = F.last("segment_id", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    source = F.trim(F.coalesce("timing_source", F.lit("")))
    marked = words.withColumns({
        "__gap": F.col("start_ms") - F.lag("end_ms").over(order),
        "__cross": F.coalesce(F.col("segment_id") != before, F.lit(False)),
        "__repaired": F.startswith(source, F.lit("synthetic_")) | F.endswith(source, F.lit("_repair")),
        "__digest": F.when(F.trim(F.coalesce("alignment_sha256", F.lit(""))) != "", F.lower(F.trim("alignment_sha256"))),
    })
    found = marked.groupBy(*by).agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("n_words"), F.coalesce(F.max("__gap"), F.lit(0)).cast("bigint").alias("max_gap"),
        F.min("probability").alias("least_probability"), F.avg("probability").alias("mean_probability"), F.count_distinct("segment_id").alias("segments"), F.count_if("__cross").alias("crossings"),
        F.count_if("__repaired").alias("repaired"), F.count_distinct("__digest").alias("digests"), F.count_if(F.col("__digest").isNull()).alias("without_digest"),
    )
    regions = vad.select(*keys, "vad_region_index", F.col("start_ms").alias("vs"), F.col("end_ms").alias("ve"))
    hit = iv.interval_join(found.select(*by, F.col("start_ms").alias("gs"), F.col("end_ms").alias("ge")), regions, list(keys), ("gs", "ge"), ("vs", "ve"))
    indexes = hit.groupBy(*by).agg(F.array_sort(F.collect_set("vad_region_index")).alias("regions"))
    united = iv.coalesce_intervals(hit.select(*by, F.greatest("gs", "vs").alias("start_ms"), F.least("ge", "ve").alias("end_ms")), by).groupBy(*by).agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("__covered"))
    both = found.join(united, by, "left").join(indexes, by, "left")
    flags = {"decoder_segment_crossing": F.col("crossings") > 0, "repaired_word_provenance": F.col("repaired") > 0, "partial_alignment_digest": (F.col("digests") > 0) & (F.col("without_digest") > 0), "several_alignment_digests": F.col("digests") > 1}
    length = F.greatest(F.lit(1), F.col("end_ms") - F.col("start_ms"))
    return both.select(*found.columns, F.least(F.lit(1.0), F.coalesce("__covered", F.lit(0)) / length).alias("coverage"), F.coalesce("regions", F.array().cast(indexes.schema["regions"].dataType)).alias("regions"), F.array_compact(F.array(*[F.when(c, n) for n, c in flags.items()])).alias("flags"))
