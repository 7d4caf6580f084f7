"""SimHash near-duplicates: a binary trie of fingerprints, joined with itself.

Links are wanted between fingerprints that differ in 4 bits at most. Then the
upper halves differ in at most 2, or else the lower halves in at most 1. So the
trie is walked twice, once from each half, with that budget within the first
32 levels and the whole budget below them; the second walk keeps only pairs that
the first can't have. In both, a pair of nodes is followed down together with
the bits that differ so far, and dropped as soon as they exceed the budget.

The upper levels are walked by Spark joins: a node pair there is a task, nodes with
more than NODE_ROWS fingerprints being cut in blocks, so that no task holds more
than two blocks. The levels below are walked inside a task on sorted arrays. A
task returns a forest, not all its pairs, so large groups stay linear in size.

one_of_each asks for a similarity besides. Its links are those of the same walks,
confirmed by the shingles themselves. But fingerprints of texts at 0.8 differ in
about 10 bits, and a trie with such a budget is next to a comparison of all pairs;
so texts that the walks leave apart are then compared where bands of minima of the
same shingle hashes are equal, and confirmed likewise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanframe.llm.common import words_of, written
from spanframe.llm.components import connected_components, forest

SEED = 42
#: Distinct fingerprints on one side of a task.
NODE_ROWS = 1 << 15
#: Levels that Spark walks at most, and at a time; up to so many pairs of nodes are broadcast.
MOST_LEVELS, STEP, BROADCAST_PAIRS = 20, 4, 1 << 20
#: Pairs compared, and node pairs followed, at once.
AT_ONCE = 1 << 20
#: Bands of one_of_each and minima in a band: of pairs at 0.8, 1 - (1 - 0.8 ** 5) ** 24 = 0.9999 share one.
BANDS, BAND_ROWS = 24, 5

#: Texts sketched at once.
SKETCH_ROWS = 1024
#: Rows and bytes of text of a bucket's block.
BUCKET_ROWS, BUCKET_BYTES = 2048, 4 << 20
#: How many standard deviations fewer minima than expected may agree: 3 of 100,000 pairs at the threshold have fewer.
SURE = 4.0

_random = np.random.default_rng(SEED)
_factors = _random.integers(0, 2**63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_terms = _random.integers(0, 2**63, BANDS * BAND_ROWS, np.uint64)


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For runs of hashes of these sizes (0 gives 0): the bits set in over half of a run.

    Eight byte lanes are summed at once, so runs are cut where a lane could overflow.
    """
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    n = sizes[some]
    cuts = -(-n // 255)
    first_cut = np.cumsum(cuts) - cuts
    begin = np.repeat(np.cumsum(n) - n, cuts) + 255 * (np.arange(cuts.sum()) - np.repeat(first_cut, cuts))
    ones, bits = np.uint64(0x0101010101010101), np.zeros(len(some), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & ones, begin)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first_cut, axis=0)
        over = (2 * counts > n[:, None]).astype(np.uint64)
        for byte in range(8):
            bits |= over[:, byte] << np.uint64(8 * byte + k)
    out[some] = bits
    return out


def shingle_hashes(words: list[bytes], size: int) -> list[int]:
    """XXH64 of each run of size words joined by spaces, ASCII letters in lower case; of all words where there are fewer."""
    if not words:
        return []
    joined = b" ".join(words).lower()
    length = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(length + 1) - length - 1
    k = min(size, len(words))
    ends = (begin + length)[k - 1 :]
    of = xxhash.xxh64_intdigest
    return [of(joined[a:b], SEED) for a, b in zip(begin.tolist(), ends.tolist(), strict=False)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id_col, fp): fp is the fingerprint's 64 bits as a bigint. Texts without words, and null, have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hashes = [], []
            for text in batch.column(1):
                own = np.array(shingle_hashes(words_of(text.as_py()), shingle), np.uint64)
                sizes.append(len(own))
                hashes.append(own)
            fp = majority(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.array(sizes, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64), pa.int64())], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"{id_col} {kind}, fp bigint")


def trie_pairs(a: np.ndarray, b: np.ndarray | None, depth: int, near: int, total: int, least_far: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs between sorted arrays (b None: within a) of 64-bit values that agree to depth levels up to what the walk counts itself.

    A pair is kept if at most near of its upper 32 bits differ, at least
    least_far of the lower 32, and at most total in all.
    """
    own = b is None
    b = a if own else b
    found_a: list[np.ndarray] = []
    found_b: list[np.ndarray] = []
    held = 0

    def compare(p: np.ndarray, q: np.ndarray) -> None:
        nonlocal held
        x = a[p] ^ b[q]
        upper, lower = np.bitwise_count(x >> np.uint64(32)), np.bitwise_count(x & np.uint64(0xFFFFFFFF))
        ok = (upper <= near) & (lower >= least_far) & (upper + lower <= total)
        if own:
            ok &= p < q
        found_a.append(p[ok])
        found_b.append(q[ok])
        held += int(ok.sum())
        if held > 4 * AT_ONCE:  # a forest says as much
            shift = 0 if own else len(a)
            x, y = forest(np.concatenate(found_a), np.concatenate(found_b) + shift, len(a) + (0 if own else len(b)))
            found_a[:], found_b[:], held = [], [], 0
            links_x.append(x)
            links_y.append(y)

    links_x: list[np.ndarray] = []
    links_y: list[np.ndarray] = []

    def pairs(lo: np.ndarray, hi: np.ndarray, lo2: np.ndarray, hi2: np.ndarray) -> None:
        """All pairs of small node pairs."""
        for s in range(0, len(lo), AT_ONCE // 8):
            la, na, lb, nb = lo[s : s + AT_ONCE // 8], (hi - lo)[s : s + AT_ONCE // 8], lo2[s : s + AT_ONCE // 8], (hi2 - lo2)[s : s + AT_ONCE // 8]
            size = na * nb
            k = np.repeat(np.arange(len(la)), size)
            at = np.arange(len(k)) - np.repeat(np.cumsum(size) - size, size)
            compare(la[k] + at // nb[k], lb[k] + at % nb[k])

    whole = np.array([0]), np.array([len(a)]), np.array([0]), np.array([len(b)]), np.array([0])
    stack = [(0, *whole)] if len(a) and len(b) else []
    ones: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    while stack:
        level, lo, hi, lo2, hi2, differ = stack.pop()
        small = ((hi - lo) * (hi2 - lo2) <= 8) | (level == 64)
        if small.any():
            if level == 64:  # equal values fill a node; there is one of each
                compare(lo[small], lo2[small])
            else:
                pairs(lo[small], hi[small], lo2[small], hi2[small])
            lo, hi, lo2, hi2, differ = (x[~small] for x in (lo, hi, lo2, hi2, differ))
        if not len(lo):
            continue
        if level not in ones:
            bit = np.uint64(63 - level)
            count = lambda v: np.concatenate(([0], np.cumsum(((v >> bit) & np.uint64(1)).astype(np.int64))))  # noqa: E731, B023
            ones[level] = (count(a), count(a) if own else count(b))
        one_a, one_b = ones[level]
        mid, mid2 = hi - (one_a[hi] - one_a[lo]), hi2 - (one_b[hi2] - one_b[lo2])
        same = (lo == lo2) & own
        most = near if level < 32 else total
        nxt = []
        for x0, x1, y0, y1, more, skip in ((lo, mid, lo2, mid2, 0, None), (mid, hi, mid2, hi2, 0, None), (lo, mid, mid2, hi2, 1, None), (mid, hi, lo2, mid2, 1, same)):
            ok = (x1 > x0) & (y1 > y0) & (differ + more <= most)
            if skip is not None:
                ok &= ~skip
            nxt.append((x0[ok], x1[ok], y0[ok], y1[ok], differ[ok] + more))
        lo, hi, lo2, hi2, differ = (np.concatenate(x) for x in zip(*nxt, strict=True))
        for s in range(0, len(lo), AT_ONCE):
            stack.append((level + 1, *(x[s : s + AT_ONCE] for x in (lo, hi, lo2, hi2, differ))))
    shift = 0 if own else len(a)
    x = np.concatenate([*links_x, *found_a]) if links_x or found_a else np.zeros(0, np.int64)
    y = np.concatenate([*links_y, *(q + shift for q in found_b)]) if links_y or found_b else np.zeros(0, np.int64)
    return forest(x, y, len(a) + (0 if own else len(b)))


def node_pairs(nodes: DataFrame, levels: int, near: tuple[int, int]) -> DataFrame:
    """(walk, p, q), p <= q: pairs of the nodes at levels, nodes: (walk, p, ...), whose paths differ in at most near[walk] bits.

    The trie is walked from its root, STEP levels at a time: a pair gives the
    pairs of its children that exist, and goes as soon as it exceeds the budget.
    """
    pairs = nodes.sparkSession.createDataFrame([(0, 0, 0, 0), (1, 0, 0, 0)], "walk int, p int, q int, differ int")
    budget = F.when(F.col("walk") == 0, near[0]).otherwise(near[1])
    for top in range(0, levels, STEP):
        more = min(STEP, levels - top)
        there = nodes.select("walk", F.shiftright("p", levels - top - more).alias("p")).distinct()
        child = lambda side: F.explode(F.expr(f"transform(sequence(0, {(1 << more) - 1}), x -> shiftleft({side}, {more}) | x)"))  # noqa: B023, E731
        pairs = pairs.withColumn("p", child("p")).join(there, ["walk", "p"], "left_semi").withColumn("q", child("q")).filter("p <= q")
        low = F.lit((1 << more) - 1)
        pairs = pairs.withColumn("differ", F.col("differ") + F.bit_count(F.col("p").bitwiseXOR(F.col("q")).bitwiseAND(low))).filter(F.col("differ") <= budget)
        pairs = pairs.join(there.withColumnRenamed("p", "q"), ["walk", "q"], "left_semi")
    return pairs.select("walk", "p", "q")


def similar_fingerprints(reps: DataFrame, bits: int = 4) -> DataFrame:
    """reps: (fp, rep) with distinct fp and no nulls. Edges (a, b) between reps; their components are those of all links of at most bits differing bits.

    An empty table gives no edges. Equal fingerprints are the caller's to group.
    Beyond 2 ** MOST_LEVELS nodes of NODE_ROWS they grow in blocks instead.
    """
    near_a, near_b = bits // 2, (bits - 1) // 2
    n = reps.count()
    levels = min(MOST_LEVELS, max(4, (max(1, n - 1) // NODE_ROWS).bit_length() + 2))
    turned = F.expr("(shiftleft(fp, 32) | shiftrightunsigned(fp, 32))")
    both = reps.withColumn("walk", F.lit(0)).withColumn("v", F.col("fp")).unionByName(reps.withColumn("walk", F.lit(1)).withColumn("v", turned))
    both = both.withColumn("p", F.shiftrightunsigned("v", 64 - levels).cast("int"))
    blocks = written(both.groupBy("walk", "p").agg(F.ceil(F.count("*") / F.lit(float(NODE_ROWS))).cast("int").alias("n_blocks")), "nodes")  # 2 << levels rows at most
    tasks = node_pairs(blocks, levels, (near_a, near_b))
    tasks = tasks.join(blocks.select("walk", "p", F.col("n_blocks").alias("n_p")), ["walk", "p"]).join(blocks.select("walk", F.col("p").alias("q"), F.col("n_blocks").alias("n_q")), ["walk", "q"])
    tasks = written(tasks.select("walk", "p", "q", "n_p", "n_q"), "node-pairs")
    few = tasks.count() <= BROADCAST_PAIRS
    hint = F.broadcast if few else (lambda df: df)
    block = lambda many: F.expr(f"cast(pmod(xxhash64(v), {many}) as int)")
    others = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    low = both.join(hint(tasks), ["walk", "p"]).withColumn("i", block("n_p")).withColumn("j", others("n_q"))
    # within a node, blocks i and j meet once: the lower one is the left side
    own = F.col("p") == F.col("q")
    low = low.select("walk", "p", "q", F.when(own, F.least("i", "j")).otherwise(F.col("i")).alias("k3"), F.when(own, F.greatest("i", "j")).otherwise(F.col("j")).alias("k4"), (own & (F.col("i") > F.col("j"))).cast("int").alias("side"), "v", "rep")
    high = both.withColumnRenamed("p", "q").join(hint(tasks.filter("p < q")), ["walk", "q"]).withColumn("k4", block("n_q")).withColumn("k3", others("n_p"))
    sides = low.unionByName(high.select("walk", "p", "q", "k3", "k4", F.lit(1).alias("side"), "v", "rep"))
    sides = sides.select((F.col("walk") + 2 * F.col("p").cast("bigint")).alias("k1"), F.col("q").alias("k2"), "k3", "k4", "side", "v", "rep")

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        k1, k2, k3, k4 = (x.as_py() for x in key)
        v = table.column("v").to_numpy().view(np.uint64)
        rep = table.column("rep").to_numpy()
        side = table.column("side").to_numpy()
        order = np.lexsort((v, side))
        v, rep, cut = v[order], rep[order], int((side == 0).sum())
        own = k1 // 2 == k2 and k3 == k4
        near, far = ((near_a, 0), (near_b, near_a + 1))[k1 % 2]
        x, y = trie_pairs(v, None, levels, near, bits, far) if own else trie_pairs(v[:cut], v[cut:], levels, near, bits, far)
        return pa.table({"a": pa.array(rep[x], pa.int64()), "b": pa.array(rep[y], pa.int64())})

    return sides.groupBy("k1", "k2", "k3", "k4").applyInArrow(walk, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, bits: int = 4) -> DataFrame:
    """One row a row of docs: id_col, fp (bigint), component_id: the smallest id that links of at most bits differing bits reach.

    Equal fingerprints link, so repeated rows and copies share a component;
    texts without words (null, empty, white space) all have fingerprint 0 and
    link like any other. A row whose id is null gets its fingerprint's component,
    null if no other row has an id. An empty table gives an empty result. Further
    columns are not read.
    """
    fps = written(fingerprints(docs.withColumn(id_col, F.col(id_col).cast("bigint")), id_col, text_col, shingle), "fingerprints")
    reps = fps.groupBy("fp").agg(F.min(id_col).alias("rep"))
    parts = connected_components(similar_fingerprints(written(reps.filter("rep IS NOT NULL"), "reps"), bits), "simhash")
    groups = reps.join(parts, reps["rep"] == parts["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(groups, "fp").select(id_col, "fp", "component_id")


def shingle_set(text: str | None, size: int) -> set[bytes]:
    """The runs that shingle_hashes hashes, as bytes."""
    words = b" ".join(words_of(text)).lower().split()
    k = min(size, len(words))
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def jaccard(a: set[bytes], b: set[bytes]) -> float:
    """Shared shingles by all; 1 for two texts without words."""
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared) if a or b else 1.0


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of a set under each of BANDS * BAND_ROWS permutations: two sets agree on each with a probability of their similarity."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[s : s + 1024] * _factors[:, None] + _terms[:, None]).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key a band from minima: equal for two sets with probability j ** BAND_ROWS, j being their similarity."""
    keys = (least.reshape(BANDS, BAND_ROWS) >> np.uint64(11)) * _factors.reshape(BANDS, BAND_ROWS)
    return keys.sum(axis=1, dtype=np.uint64)


def sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """rows: (id, tie, text). (id, tie, digest, fp, bands, marks): the digest of the words in lower case, the fingerprint and band_keys of the shingles, and 16 bits of each of their minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, SKETCH_ROWS):
                batch = whole.slice(s, SKETCH_ROWS)
                digests, hashes, keys, marks = [], [], [], []
                for text in batch.column(2):
                    words = words_of(text.as_py())
                    digests.append(xxhash.xxh3_128_digest(b" ".join(words).lower()))
                    hashes.append(np.array(shingle_hashes(words, shingle), np.uint64))
                    least = minima(hashes[-1])
                    keys.append(band_keys(least).view(np.int64))
                    marks.append((least >> np.uint64(40)).astype("<u2").tobytes())
                fp = majority(np.concatenate(hashes), np.array(list(map(len, hashes)), np.int64))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(np.concatenate(keys), pa.int64()))
                columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(fp.view(np.int64), pa.int64()), bands, pa.array(marks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "tie", "digest", "fp", "bands", "marks"])

    return rows.mapInArrow(run, "id bigint, tie bigint, digest binary, fp bigint, bands array<bigint>, marks binary")


def likely(x: int, right: np.ndarray, band: int, keys: np.ndarray, marks: np.ndarray, enough: int) -> np.ndarray:
    """Those of right that agree with x on enough minima and, being in one bucket of this band, share none of an earlier band, where they are met already; the likeliest first."""
    agree = np.count_nonzero(marks[right] == marks[x], axis=1)
    ok = agree >= enough
    right, agree = right[ok], agree[ok]
    first = ~(keys[right, :band] == keys[x, :band]).any(axis=1)
    return right[first][np.argsort(-agree[first], kind="stable")]


def block_arrays(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Of a pair of blocks: node, part as a number from 0, band keys, minima, and the indexes of either side."""
    node, side = table.column("node").to_numpy(), table.column("side").to_numpy()
    part = np.unique(table.column("part").to_numpy(), return_inverse=True)[1]
    keys = pc.list_flatten(table.column("bands")).to_numpy().reshape(len(node), BANDS)
    marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), "<u2").reshape(len(node), BANDS * BAND_ROWS)
    return node, part, keys, marks, np.flatnonzero(side == 0), np.flatnonzero(side == 1)


def likely_rows(members: DataFrame, nodes: DataFrame, enough: int) -> DataFrame:
    """(band, key, lo, hi, side, node, part): of pairs of blocks of a bucket, the nodes that agree with one of another part on enough minima.

    members: (band, key, node, part); nodes: (node, bands, marks, n_bytes). Blocks
    are bounded in rows and in bytes of text. Rows are nodes, however many pairs they are in.
    """
    sized = members.join(nodes, "node")
    blocks = F.greatest(F.count("*") / F.lit(float(BUCKET_ROWS)), F.sum("n_bytes") / F.lit(float(BUCKET_BYTES)))
    buckets = written(sized.groupBy("band", "key").agg(F.ceil(F.greatest(blocks, F.lit(1.0))).cast("int").alias("n_blocks")), "bucket-blocks")
    rows = members.join(buckets, ["band", "key"]).withColumn("i", F.expr("cast(pmod(xxhash64(node), n_blocks) as int)"))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    rows = rows.select("band", "key", F.least("i", "k").alias("lo"), F.greatest("i", "k").alias("hi"), (F.col("i") > F.col("k")).cast("int").alias("side"), "node", "part")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, part, keys, marks, left, right = block_arrays(table)
        within = key[2].as_py() == key[3].as_py()
        met = np.zeros(table.num_rows, bool)
        for x in left:
            others = left[left > x] if within else right
            others = likely(x, others[part[others] != part[x]], key[0].as_py(), keys, marks, enough)
            met[others] = True
            met[x] |= len(others) > 0
        return table.select(["band", "key", "lo", "hi", "side", "node", "part"]).filter(pa.array(met))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.join(nodes.drop("n_bytes"), "node").groupBy("band", "key", "lo", "hi").applyInArrow(run, kinds)


def bucket_links(members: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b): links of this similarity between nodes of one bucket in different parts, as many as join what all such links join.

    members: (band, key, node, part); nodes: (node, bands, marks, n_bytes); texts:
    (node, text). The minima of a pair may agree on SURE standard deviations less
    than expected. Pairs that do are compared by their shingles inside the task that
    holds their two blocks, unless links found there join them already, so that
    pairs next to the threshold are no rows, however many a group has.
    """
    n = BANDS * BAND_ROWS
    enough = int(np.floor(n * similarity - SURE * np.sqrt(n * similarity * (1 - similarity))))
    rows = written(likely_rows(members, nodes, enough), "likely")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        node, part, keys, marks, left, right = block_arrays(table)
        text = table.column("text")
        within = key[2].as_py() == key[3].as_py()
        sets: dict[int, np.ndarray] = {}
        links: list[tuple[int, int]] = []

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = np.unique(np.array(shingle_hashes(words_of(text[i].as_py()), shingle), np.uint64))
            return sets[i]

        def alike(x: int, y: int) -> bool:
            a, b = of(x), of(y)
            if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-6 or not len(a):
                return False
            shared = np.count_nonzero(a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b)
            # hashes refuse, shingles confirm
            return shared >= similarity * (len(a) + len(b) - shared) - 1e-6 and jaccard(shingle_set(text[x].as_py(), shingle), shingle_set(text[y].as_py(), shingle)) >= similarity

        for x in left.tolist():
            others = left[left > x] if within else right
            for y in likely(x, others[part[others] != part[x]], key[0].as_py(), keys, marks, enough).tolist():
                if part[x] != part[y] and alike(x, y):
                    part[part == part[y]] = part[x]
                    links.append((min(node[x], node[y]), max(node[x], node[y])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return rows.join(nodes.select("node", "bands", "marks"), "node").join(texts.select("node", "text"), "node").groupBy("band", "key", "lo", "hi").applyInArrow(run, "a bigint, b bigint")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts, (node, text), have at least this similarity of shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [jaccard(shingle_set(x.as_py(), shingle), shingle_set(y.as_py(), shingle)) >= similarity for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def walked_pairs(reps: DataFrame, bits: int = 4) -> DataFrame:
    """reps: (node, fp). Pairs (a, b), a < b, that join what fingerprints of at most bits differing bits join: those of similar_fingerprints, and of an equal fingerprint each node with the least."""
    prints = written(reps.groupBy("fp").agg(F.min("node").alias("rep")), "prints")
    equal = reps.join(prints, "fp").filter("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    links = similar_fingerprints(prints, bits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return links.unionByName(equal).distinct()


def similar_rows(rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """rows: (id, tie, text) with no null id. (id, tie, component): id and tie of each text, once, and the component of all confirmed links.

    Links come from the trie of fingerprints first. What these leave apart are
    candidates where a band is equal. A bucket of equal bands is first
    compared with its hub, the node that shares most, which joins dense groups in
    linear work; of the others, those in different components so far are compared
    inside tasks, by their minima and, where these agree often enough, by their shingles.
    """
    own = written(sketches(rows, shingle), "sketches")
    reps = own.groupBy("digest").agg(F.min(F.struct("id", "tie", "fp", "bands", "marks")).alias("r"))
    reps = written(reps.select(F.monotonically_increasing_id().alias("node"), "r.*"), "texts")
    walked = written(walked_pairs(reps.select("node", "fp")), "walked")
    banded = reps.select("node", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    sharing = written(banded.join(shared, ["band", "key"]), "sharing")
    used = sharing.select("node").unionByName(walked.select(F.explode(F.array("a", "b")).alias("node"))).distinct().join(reps.select("node", "id", "tie"), "node")
    texts = written(rows.join(used, ["id", "tie"]).select("node", "text", F.octet_length("text").cast("bigint").alias("n_bytes")).dropDuplicates(["node"]), "candidates")
    links = written(confirmed(walked, texts, shingle, similarity), "links")
    parts = connected_components(links, "near")
    # the node that shares most buckets with most others is likely the text that the others were made from
    weight = written(sharing.groupBy("node").agg(F.sum("n").alias("w")), "weights")
    hubs = written(sharing.join(weight, "node").groupBy("band", "key").agg(F.min(F.struct(-F.col("w"), "node")).alias("h")).select("band", "key", F.col("h.node").alias("hub")), "hubs")
    hub_parts = hubs.join(parts.withColumnRenamed("node", "hub"), "hub", "left").select("band", "key", "hub", F.coalesce("component", "hub").alias("hub_part"))
    members = written(sharing.drop("n").join(hub_parts, ["band", "key"]), "buckets")
    apart = members.join(parts, "node", "left").filter(F.coalesce("component", "node") != F.col("hub_part"))
    stars = written(apart.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct(), "stars")
    links = links.unionByName(written(confirmed(stars, texts, shingle, similarity), "links"))
    parts = connected_components(links, "near")
    placed = members.join(parts, "node", "left").select("band", "key", "node", F.coalesce("component", "node").alias("part"))
    mixed = placed.groupBy("band", "key").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("band", "key")
    open_ = placed.join(written(mixed, "mixed-buckets"), ["band", "key"])
    more = bucket_links(open_, texts.select("node", "n_bytes").join(reps.select("node", "bands", "marks"), "node"), texts, shingle, similarity)
    parts = connected_components(links.unionByName(written(more, "links")), "near")
    return reps.join(parts, "node", "left").select("id", "tie", F.coalesce("component", "node").alias("component"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, similarity: float = 0.8) -> DataFrame:
    """docs with one row of each component of texts whose shingle sets have at least this similarity: that of the smallest id; of repeated rows of that id and text, one.

    Unlike texts under one id are different rows. Texts without words are alike. Rows without an id stay.
    """
    tied = docs.withColumn("__id", F.col(id_col).cast("bigint")).withColumn("__tie", F.xxhash64(F.col(text_col).cast("string")))
    some = tied.filter("__id IS NOT NULL")
    found = similar_rows(some.select(F.col("__id").alias("id"), F.col("__tie").alias("tie"), F.col(text_col).cast("string").alias("text")), shingle, similarity)
    keep = found.groupBy("component").agg(F.min(F.struct("id", "tie")).alias("r")).select(F.col("r.id").alias("__id"), F.col("r.tie").alias("__tie"))
    kept = some.join(keep, ["__id", "__tie"], "left_semi").dropDuplicates(["__id", "__tie"])
    return kept.select(*docs.columns).unionByName(docs.filter(F.col(id_col).cast("bigint").isNull()))
