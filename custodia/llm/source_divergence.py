"""Source divergence audit: how the words of each source differ from those of the others.

Words are counted by Arrow's own kernels inside mapInArrow: ascii_lower, split_pattern_regex,
dictionary_encode, and a hash group_by, first by row (which documents hold a word), then by group of
rows. Each task adds its batches up before it sends partial counts. Spark merges them by language and
word, with one row for each word and its counts by source as a list: a columnar shard is a batch of
such rows. A shard gives its part of every divergence between two sources, in integers, and its best
words of each source; sums and ranks over the shards are the result.

Smoothed shares of a billion, p = 1 + floor(10^9 * (count + 2) / (N + 2 V)), make all arithmetic exact;
f = floor((p - q)^2 / (p + q)) is the part of one word. V words of a language occur in min_docs of its
documents or more; N adds up their counts in a source or, for the language, in all its sources.

The driver holds one number for each pair of language and source; the result has their squares. A
language with many sources is worked on in tiles of TILE by TILE sources.

Nulls, empties, ties: null text, lang and source are ''. A text without words, empty or not, still
makes its group occur. Repeated rows are documents of their own. Equal values are ranked by the bytes of
the item. A language without kept words has pairs of value 0 and no terms; a language with one source
has no pairs. An empty table gives an empty result. Other columns are ignored; ids play no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import small_batches, staged

#: What lies between words: ASCII but for letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
TILE = 256
#: Numbers in the largest array that a shard makes.
CELLS = 1 << 21
#: Rows of partial counts that a task holds.
HELD = 400_000
TOP = 10


def batch_counts(texts: pa.Array, lang: pa.Array, source: pa.Array) -> pa.Table:
    """(lang, source, word, n, docs): occurrences, and rows that hold the word."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    word, row = pc.list_flatten(split), pc.list_parent_indices(split)
    there = pc.not_equal(word, "")
    # Of some 10,000 distinct words of a batch each is kept once; rows refer to them by number.
    coded = word.filter(there).dictionary_encode()
    each = pa.table({"row": row.filter(there), "code": coded.indices}).group_by(["row", "code"]).aggregate([([], "count_all")])
    # Groups by number as well: rows of one batch name few of them.
    groups = pa.table({"lang": lang, "source": source, "row": pa.array(np.arange(len(lang)))}).group_by(["lang", "source"]).aggregate([("row", "list")])
    of = np.empty(len(lang), np.int32)
    of[pc.list_flatten(groups["row_list"].combine_chunks()).to_numpy()] = pc.list_parent_indices(groups["row_list"].combine_chunks()).to_numpy()
    each = each.append_column("group", pa.array(of[each["row"].to_numpy()]))
    sums = each.group_by(["group", "code"]).aggregate([("count_all", "sum"), ([], "count_all")])
    return pa.table({
        "lang": groups["lang"].take(sums["group"]), "source": groups["source"].take(sums["group"]),
        "word": coded.dictionary.take(sums["code"].combine_chunks()), "n": sums["count_all_sum"], "docs": sums["count_all"],
    })


def added(parts: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(parts).group_by(["lang", "source", "word"]).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns(["lang", "source", "word", "n", "docs"])


def counted(docs: DataFrame) -> DataFrame:
    """Partial counts of all documents, several rows for a word of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, fresh, n = [], [], 0
        for batch in batches:
            if batch.num_rows:
                fresh.append(batch_counts(*(batch[k].cast(pa.string()) for k in ("text", "lang", "source"))))
                n += fresh[-1].num_rows
            if n > HELD:
                whole, fresh, n = [added(whole + fresh)], [], 0
                if whole[0].num_rows > HELD:
                    yield from whole.pop().to_batches(max_chunksize=20_000)
        if whole or fresh:
            yield from added(whole + fresh).to_batches(max_chunksize=20_000)

    return docs.mapInArrow(run, "lang string, source string, word string, n long, docs long")


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * count / total) for count <= total < 2^53, three digits at a time."""
    out, rest = np.zeros(np.broadcast(count, total).shape, np.int64), count
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def parts_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def divergences(shard: DataFrame, totals: dict[str, tuple[list[str], list[int], int]], top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value) of shards of (lang, word, sources, counts).

    totals: sources of each language in order, their N, and V. Pairs come once, the lesser source
    first, as sums to be added up; terms as the best of each shard.
    """
    shared = shard.sparkSession.sparkContext.broadcast(totals)  # a number for each language and source

    def rows(lang: str, sources: list, part: str, items: list, values: list) -> pa.RecordBatch:
        n = len(values)
        columns = [pa.array([lang] * n, pa.string()), pa.array(sources, pa.string()), pa.array([part] * n, pa.string()), pa.array(items, pa.string()), pa.array(values, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "part", "item", "value"])

    def pairs(lang: str, names: list[str], p: np.ndarray) -> Iterator[pa.RecordBatch]:
        """p: shares, one line for each source."""
        for a in range(0, len(names), TILE):
            for b in range(a, len(names), TILE):
                one, two, value = [], [], []
                for s in range(a, min(a + TILE, len(names))):
                    first = max(b, s + 1)
                    sums = parts_of(p[first : b + TILE], p[s]).sum(axis=1).tolist()
                    one += [names[s]] * len(sums)
                    two += names[first : first + len(sums)]
                    value += sums
                if value:
                    yield rows(lang, one, "pair", two, value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, dict[str, int]] = {}
        for batch in batches:
            lang, word = batch["lang"].dictionary_encode(), batch["word"]
            starts = np.asarray(batch["entries"].offsets)
            entries = batch["entries"].flatten()
            starts = starts - starts[0] if len(starts) else starts
            sources, counts = entries.field("source"), entries.field("n").to_numpy()
            codes = lang.indices.to_numpy()
            for k, name in enumerate(lang.dictionary.to_pylist()):
                names, n, v = shared.value[name]
                if name not in places:
                    places[name] = {s: i for i, s in enumerate(names)}
                total, whole = np.array(n, np.int64)[:, None] + 2 * v, sum(n) + 2 * v
                own = np.flatnonzero(codes == k)
                step = max(1, CELLS // len(names))
                for at in range(0, len(own), step):
                    mine = own[at : at + step]
                    size = (starts[1:] - starts[:-1])[mine]
                    column = np.repeat(np.arange(len(mine)), size)
                    which = starts[mine][column] + np.arange(len(column)) - np.repeat(np.cumsum(size) - size, size)
                    coded = sources.take(pa.array(which)).dictionary_encode()
                    line = np.array([places[name][s] for s in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
                    c = np.zeros((len(names), len(mine)), np.int64)
                    c[line, column] = counts[which]
                    p = shares(c + 2, total)
                    yield from pairs(name, names, p)
                    q = shares(c.sum(axis=0) + 2, np.int64(whole))
                    mine_words = word.take(pa.array(mine))
                    for s in range(len(names)):
                        above = np.flatnonzero((c[s] > 0) & (p[s] > q))
                        if not len(above):
                            continue
                        value = parts_of(p[s, above], q[above])
                        if len(above) > top:  # those that tie with the last stay
                            least = np.partition(value, -top)[-top]
                            above, value = above[value >= least], value[value >= least]
                        best = sorted(zip((-value).tolist(), [x.encode() for x in mine_words.take(pa.array(above)).to_pylist()], strict=True))[:top]
                        yield rows(name, [names[s]] * len(best), "term", [w.decode() for _, w in best], [-x for x, _ in best])

    return shard.mapInArrow(run, "lang string, source string, part string, item string, value long")


def audit(docs: DataFrame, min_docs: int = 10, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: divergences from the language's other sources, and the
    words that a source uses more than the language does."""
    small_batches(docs.sparkSession)
    text = lambda k: F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k)
    docs = docs.select(text("text"), text("lang"), text("source"))
    groups = docs.select("lang", "source").distinct()
    # One exchange by language and word serves the counts and the lists.
    dealt = counted(docs).repartition("lang", "word")
    each = dealt.groupBy("lang", "word", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    lists = each.groupBy("lang", "word").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("entries"))
    shard = staged(lists.where(F.col("docs") >= min_docs).select("lang", "word", "entries"), "words")
    sizes = shard.select("lang", F.explode("entries").alias("e")).groupBy("lang", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("n"))
    kinds = {r["lang"]: r["v"] for r in shard.groupBy("lang").agg(F.count("*").alias("v")).collect()}
    found = defaultdict(list)
    for r in groups.join(sizes, ["lang", "source"], "left").collect():  # the square of this is the result
        found[r["lang"]].append((r["source"], r["n"] or 0))
    totals = {k: ([s for s, _ in sorted(x)], [n for _, n in sorted(x)], kinds.get(k, 0)) for k, x in found.items()}
    parts = staged(divergences(shard, totals, top), "divergences")
    sums = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    one, two = groups.select("lang", "source"), groups.select("lang", F.col("source").alias("item"))
    # Sources of one language meet, not rows; where there are no kept words nothing has been summed.
    all_pairs = one.join(two, "lang").where(F.col("source") != F.col("item"))
    names = all_pairs.select("lang", "source", "item", F.least("source", "item").alias("__a"), F.greatest("source", "item").alias("__b"))
    sums = sums.select(F.col("lang").alias("__lang"), F.col("source").alias("__one"), F.col("item").alias("__two"), "value")
    pairs = names.join(sums, (F.col("lang") == F.col("__lang")) & (F.col("__a") == F.col("__one")) & (F.col("__b") == F.col("__two")), "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item").asc())
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    terms = ranked(parts.where("part = 'term'")).where(F.col("rank") <= top)
    return ranked(pairs).unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def audit_sql(min_docs: int = 10, top: int = TOP) -> str:
    return rf"""
    with docs as (
        select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
            unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as word
        from documents
    ), groups as (
        select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents
    ), kept as (
        select lang, word from docs group by all having count(distinct r) >= {min_docs}
    ), kinds as (
        select lang, count(word) as v from (select distinct lang from groups) left join kept using (lang) group by all
    ), counts as (
        select lang, source, word, count(*) as n from docs semi join kept using (lang, word) group by all
    ), grid as (
        select g.lang, g.source, k.word, coalesce(c.n, 0)::hugeint as n from groups g join kept k on g.lang = k.lang
        left join counts c on c.lang = g.lang and c.source = g.source and c.word = k.word
    ), shares as (
        select lang, source, word, n, 1 + {SCALE} * (n + 2) // (sum(n) over (partition by lang, source) + 2 * v) as p,
            1 + {SCALE} * (sum(n) over (partition by lang, word) + 2) // (sum(n) over (partition by lang) + 2 * v) as q
        from grid join kinds using (lang)
    ), pairs as (
        select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
        from shares a join shares b on a.lang = b.lang and a.word = b.word and a.source <> b.source group by all
    ), parts as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0) as value
        from groups a join groups b on a.lang = b.lang and a.source <> b.source
        left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
        union all select lang, source, 'term', word, (p - q) * (p - q) // (p + q) from shares where n > 0 and p > q
    ), ranked as (
        select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from parts
    )
    select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= {top}
    """
