"""MinHash near-dedup by ProbMinHash: classes of texts whose word shingles agree.

Texts that agree word by word are one node from the start, however many copies there are. For each
shingle of a node (five words; a shorter text is one shingle) a Poisson process of exponential
arrivals, faster for weightier shingles, sends the shingle to random registers. A register keeps the
first one; a shingle stops when its next arrival is later than every register's. Two registers agree
with the probability Jaccard similarity of the weighted shingles (weight 1 + ln of the count).

Registers are banded. A bucket of up to SMALL nodes gives all its pairs. In a larger one every node
meets the bucket's first node; buckets that these links leave in several components are joined exactly.
Sets of n and m shingles that are alike enough share one of their rarest n - ceil(least * n) + 1 and
m - ceil(least * m) + 1 shingles, in any one order of all shingles. So the nodes of such buckets meet
by such shingles: first each with the node of a shingle whose own shingles are most common, as an
original's are among its copies, and then all that are still in different components, in blocks. Every
pair is verified by the exact Jaccard similarity of its shingle sets. Classes are the connected
components of the links.

Nulls, empties, ties: a null text is an empty one; all empty texts are one class. A class is named
by its least doc_id (null if it has none), repeated rows share it. Ids may repeat or be null: the
texts count, not the ids. Other columns are passed on by `deduplicated`. No rows, no classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.llm.common import BLANKS, SPACE, small_batches, staged

WORDS = 5
BANDS, ROWS = 24, 4
SMALL = 32
PREFIX_BITS = 24
COUNTS = 1 << 20  # cells of shingle counts
BLOCK = 256

BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of MurmurHash3."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(0, n - 1), base, np.uint64)]))


UP, DOWN = powers(BASE, 1 << 12), powers(pow(BASE, -1, 1 << 64), 1 << 12)


def grown(n: int) -> None:
    global UP, DOWN
    if len(UP) < n:
        UP, DOWN = powers(BASE, 2 * n), powers(pow(BASE, -1, 1 << 64), 2 * n)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of all windows of five words (A-Z in lower case), in order; of all words, if fewer."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace").lower(), dtype=np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    grown(len(raw) + 1)
    blank = BLANK[raw]
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * UP[: len(raw)])])
    h = mixed((sums[end] - sums[start]) * DOWN[start])
    if not len(h):
        return np.empty(0, np.uint64)
    k = min(WORDS, len(h))
    out = h[: len(h) - k + 1].copy()
    for j in range(1, k):
        out = out * np.uint64(BASE) + h[j : len(h) - k + 1 + j]
    return mixed(out)


def registers(text: str | None, m: int = BANDS * ROWS) -> np.ndarray:
    """The shingle that each register keeps; 0 for a text without words."""
    h, count = np.unique(shingles(text), return_counts=True)
    first, kept = np.full(m, np.inf), np.zeros(m, np.uint64)
    rate, at, step = 1 + np.log(count), np.zeros(len(h)), 0
    while len(h):
        n = max(1, 1500 // len(h))  # arrivals of each shingle in this round
        turn = np.arange(step + 1, step + n + 1, dtype=np.uint64)
        step += n
        draw = mixed(h[:, None] ^ mixed(turn * np.uint64(BASE)))
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53) / rate[:, None]
        arrival = at[:, None] + np.cumsum(gap, axis=1)
        to = (mixed(draw + np.uint64(1)) % np.uint64(m)).astype(np.int64)
        flat, place, own = arrival.ravel(), to.ravel(), np.repeat(h, n)
        early = np.flatnonzero(flat < first[place])
        early = early[np.argsort(-flat[early], kind="stable")]
        first[place[early]], kept[place[early]] = flat[early], own[early]  # the earliest is written last
        at = arrival[:, -1]
        alive = at < first.max()
        h, rate, at = h[alive], rate[alive], at[alive]
    return kept


def bands(text: str | None) -> np.ndarray:
    kept = registers(text).reshape(BANDS, ROWS)
    out = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(BASE))
    for j in range(ROWS):
        out = mixed(out * np.uint64(BASE) + kept[:, j])
    return out.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard of two sorted arrays of different hashes; two empty ones agree."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def key_of(text: Column) -> Column:
    """Names a node: the words of a text in order."""
    return F.md5(F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " "), F.lit(BLANKS)))


@F.arrow_udf(T.ArrayType(T.LongType()))
def banded(texts: pa.Array) -> pa.Array:
    return pa.array([bands(x.as_py()) for x in texts], pa.list_(pa.int64()))


def buckets(nodes: DataFrame) -> DataFrame:
    """(h, key, n, head): the nodes of each bucket with more than one, its size and its least key."""
    entries = nodes.select("key", F.explode("bands").alias("h"))
    sizes = entries.groupBy("h").agg(F.count("*").alias("n"), F.min("key").alias("head")).where("n > 1")
    return entries.join(sizes, "h")


def candidates(held: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of small buckets, and the head of a large one with each other node."""
    small = held.where(F.col("n") <= SMALL).groupBy("h").agg(F.sort_array(F.collect_set("key")).alias("k"))
    tails = F.transform("k", lambda x, i: F.transform(F.slice("k", i + 2, SMALL), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    pairs = small.select(F.explode(F.flatten(tails)).alias("p")).select("p.a", "p.b")
    large = held.where((F.col("n") > SMALL) & (F.col("key") != F.col("head")))
    return pairs.union(large.select(F.col("head").alias("a"), F.col("key").alias("b"))).distinct()


def cell_counts(sets: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall into each of COUNTS cells; this only orders the shingles."""
    cells = COUNTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(cells, np.int64)
        for batch in batches:
            for x in batch["s"]:
                np.add.at(own, (np.frombuffer(x.as_buffer(), np.uint64) % np.uint64(cells)).astype(np.int64), 1)
        met = np.flatnonzero(own)
        for a in range(0, len(met), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(met[a : a + 100_000]), pa.array(own[met[a : a + 100_000]])], ["cell", "n"])

    summed = sets.select("s").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    out = np.ones(cells, np.int64)  # a cell of one shingle, or of none
    out[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return out


def prefixes(sets: DataFrame, least: float) -> DataFrame:
    """(key, shingle, place, n, common): the rarest shingles of each set, from place 0, as far as any
    set that is alike enough must share one; n is the set's size, common its mean log count."""
    shared = sets.sparkSession.sparkContext.broadcast(cell_counts(sets))
    cells = COUNTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for key, x in zip(batch["key"], batch["s"], strict=True):
                h = np.frombuffer(x.as_buffer(), np.uint64)
                if not len(h):
                    continue
                c = counts[(h % np.uint64(cells)).astype(np.int64)]
                size = len(h) - max(1, int(np.ceil(least * len(h) - 1e-9))) + 1
                rare = h[np.lexsort((h, c))[:size]]
                columns = [np.repeat(key.as_py(), size), rare.view(np.int64), np.arange(size), np.full(size, len(h)), np.full(size, np.log(c).mean())]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], ["key", "shingle", "place", "n", "common"])

    return sets.select("key", "s").mapInArrow(run, "key string, shingle long, place long, n long, common double")


def divided(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows of prefixes with their labels, and m, hub and hub_label of their shingle, for the shingles
    that nodes of different labels have."""
    own = rows.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    hub = F.max(F.struct("common", "key", "label"))
    met = own.groupBy("shingle").agg(F.count("*").alias("m"), F.min("label").alias("low"), F.max("label").alias("high"), hub.alias("h"))
    met = met.where("low <> high").select("shingle", "m", F.col("h.key").alias("hub"), F.col("h.label").alias("hub_label"))
    return own.join(met, "shingle")


def across(rows: DataFrame, least: float) -> DataFrame:
    """(a, b), a < b: the nodes of different labels that meet in a shingle and may be alike enough.

    A shingle's nodes are dealt into blocks, and each pair of blocks meets by itself.
    """
    blocks = F.ceil(F.col("m") / BLOCK).cast("long")
    own = rows.withColumn("block", F.pmod(F.xxhash64("key"), blocks)).withColumn("blocks", blocks)
    left = own.select("shingle", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), F.struct("key", "label", "place", "n").alias("x"))
    right = own.select("shingle", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("i"), F.col("block").alias("j"), F.struct("key", "label", "place", "n").alias("y"))
    met = left.join(right, ["shingle", "i", "j"])
    # At the first shingle that two sets share, what is left of both must be enough.
    rest = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    near = (rest * (1 + least) >= least * (F.col("x.n") + F.col("y.n")) - 1e-6) & ((F.col("i") < F.col("j")) | (F.col("x.key") < F.col("y.key")))
    met = met.where((F.col("x.label") != F.col("y.label")) & near)
    return met.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, shingles as bytes) of the nodes named in wanted (key, first), from their texts.

    A bitmap of fixed size (2^24 bits) of the wanted keys' first bits spares most other texts.
    """
    bit = F.conv(F.substring("key", 1, PREFIX_BITS // 4), 16, 10).cast("long")
    parts = wanted.groupBy(F.bitmap_bucket_number(bit).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("m")).collect()
    bitmap = {r["b"]: bytes(r["m"]) for r in parts}
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # 2 MB at most

    @F.arrow_udf("boolean")
    def likely(keys: pa.Array) -> pa.Array:
        def has(k: str) -> bool:
            v = int(k[: PREFIX_BITS // 4], 16)
            # As bitmap_bucket_number and bitmap_bit_position count, for positions from 1.
            bucket, place = (1 + (v - 1) // 32768, (v - 1) % 32768) if v > 0 else (-v // 32768, -v % 32768)
            part = shared.value.get(bucket)
            return part is not None and bool(part[place >> 3] >> (place & 7) & 1)

        return pa.array([has(x) for x in keys.to_pylist()], pa.bool_())

    @F.arrow_udf("binary")
    def blob(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique(shingles(x.as_py())).tobytes() for x in texts], pa.binary())

    # The row with a node's least id stands for it: copies have other ids, so they never meet in one task.
    rows = docs.select(F.col("doc_id").alias("first"), "text", key_of(F.col("text")).alias("key"))
    rows, only = rows.where(likely("key")), wanted.withColumnsRenamed({"key": "k", "first": "f"})
    held = rows.join(only, (F.col("key") == F.col("k")) & F.col("first").eqNullSafe(F.col("f")))
    return held.select("key", blob("text").alias("s")).groupBy("key").agg(F.any_value("s").alias("s"))


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """pairs with their exact similarity, where it is at least `least`."""

    @F.arrow_udf("double")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        each = zip(a, b, strict=True)
        return pa.array([similarity(*(np.frombuffer(x.as_buffer(), np.uint64) for x in p)) for p in each], pa.float64())

    met = pairs.join(sets.select(F.col("key").alias("b"), F.col("s").alias("sb")), "b")
    met = met.join(sets.select(F.col("key").alias("a"), F.col("s").alias("sa")), "a")
    return met.select("a", "b", alike("sa", "sb").alias("similarity")).where(F.col("similarity") >= least)


def components(links: DataFrame) -> DataFrame:
    """(key, label): the least key of each key's connected component, for keys with a link."""
    both = staged(links.select("a", "b").union(links.select("b", "a")), "links").toDF("key", "other")
    labels = staged(both.groupBy("key").agg(F.min("other").alias("m")).select("key", F.least("key", "m").alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("key").alias("other"), "label"), "other").groupBy("key").agg(F.min("label").alias("m"))
        near = labels.join(seen, "key").select("key", F.least("label", "m").alias("near"), "label")
        far = labels.select(F.col("key").alias("near"), F.col("label").alias("jump"))
        new = staged(near.join(far, "near").select("key", F.least("near", "jump").alias("label"), (F.least("near", "jump") != F.col("label")).alias("moved")), "labels")
        if new.where("moved").isEmpty():
            return new.select("key", "label")
        labels = new.select("key", "label")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(key, label) after links between labels (la, lb) were added."""
    new = components(links.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
    both = labels.join(new.select(F.col("key").alias("label"), F.col("label").alias("new")), "label", "left")
    return staged(both.select("key", F.coalesce("new", "label").alias("label")), "labels")


def completed(labels: DataFrame, held: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(key, label) with all links between nodes of large buckets."""
    # A bucket whose nodes are in one component has no link to add.
    own = held.where(F.col("n") > SMALL).select("h", "key").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    split = own.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("h")
    large = staged(own.join(split, "h").select("key").distinct(), "large")
    if large.isEmpty():
        return labels
    rows = staged(prefixes(sets.join(large, "key"), least), "prefixes")
    labels = staged(large.join(labels, "key", "full").select("key", F.coalesce("label", "key").alias("label")), "labels")
    for first in (True, False):
        split = staged(divided(rows, labels), "divided")
        if split.isEmpty():
            return labels
        hubs = split.where("label <> hub_label").select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()
        pairs = hubs if first else across(split, least)
        links = staged(verified(staged(pairs, "pairs"), sets, least), "verified")
        if not links.isEmpty():
            named = links.select("a", "b").join(labels.toDF("a", "la"), "a").join(labels.toDF("b", "lb"), "b")
            labels = merged(labels, named)
    return labels


def classes(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(key, class_id, head): for each node its class's least doc_id, and the node that has it."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id"), F.col("text"), key_of(F.col("text")).alias("key"))
    sketches = rows.select("key", "doc_id", banded("text").alias("bands"))
    nodes = staged(sketches.groupBy("key").agg(F.min("doc_id").alias("first"), F.any_value("bands").alias("bands")), "nodes")
    held = staged(buckets(nodes), "buckets")
    pairs = staged(candidates(held), "pairs")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct().join(nodes.select("key", "first"), "key")
    sets = staged(sets_of(docs, staged(wanted, "wanted")), "sets")
    linked = completed(components(staged(verified(pairs, sets, least), "verified")), held, sets, least)
    named = nodes.select("key", "first").join(linked, "key", "left").withColumn("label", F.coalesce("label", "key"))
    heads = named.groupBy("label").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "key")).alias("h"))
    return staged(named.join(heads, "label").select("key", F.col("h.first").alias("class_id"), F.col("h.key").alias("head")), "classes")


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, class_id for every row."""
    named = classes(docs, least)
    rows = docs.select("doc_id", key_of(F.col("text")).alias("key"))
    return rows.join(named, "key").select("doc_id", "class_id")


def deduplicated(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """One row of docs for each class: that with its least doc_id."""
    heads = classes(docs, least).where("key = head").select(F.col("key").alias("__key"), F.col("class_id").alias("__class"))
    own = docs.withColumn("__key", key_of(F.col("text")))
    # The id is part of the join's key, so that the copies of a text, with their texts, stay apart.
    out = own.join(heads.withColumnRenamed("__key", "__k"), (F.col("__key") == F.col("__k")) & F.col("doc_id").eqNullSafe(F.col("__class")))
    one = Window.partitionBy("__key").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if dict(docs.dtypes)[c] != "variant" and "map" not in dict(docs.dtypes)[c]]))
    return out.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
