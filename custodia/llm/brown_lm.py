"""LM scoring with Brown classes: a class bigram model found by exchange clustering.

P(text) is the product over its tokens of P(class | class before) * P(word | class). The UNITS most
frequent words (without the last count where only some of its words would fit) are units of their
own; while these are clustered, rarer words stand in as units by their ending. Exchange clustering
moves units between classes where that raises the likelihood of the training bigrams. One sweep is
one Spark pass over the unit bigrams, which yields what each unit exchanges with each class; moves are
then made for one half of the units and the next pass counts anew. Every rarer word then goes to the
class that makes its own neighbours in the training texts likeliest (a rarer neighbour counts by its
stand-in), and the classes of all tokens are counted anew. Word counts are exact for all words. A word
without training tokens has the class that most tokens of rarer words with its ending have.

A class's words have (count + 0.5) / (all + 0.5 * (types + 1)); the last 0.5 is for unseen words.
Class transitions are smoothed with the classes' own shares.

Nulls, empties, ties: a null text is an empty one, whose only token is its end. A null id is in the
training part. Rows are scored one by one, repeated or not. Training tokens count once per row.
With no training rows N and V are 0 and all tokens are unseen. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import small_batches, staged

END = "\n"
UNITS = 1 << 15
ENDINGS = 1024
KNOWN = 1 << 19
FLUSH = 1 << 19
CHUNKS = 512


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, lengths, words): the tokens of all texts in order as places in words, and how many each text
    has. Words have A-Z in lower case; the last of words is the end, which closes every text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    word, row = pc.list_flatten(split), pc.list_parent_indices(split)
    there = pc.not_equal(word, "")  # beside blanks at either end
    found = word.filter(there).dictionary_encode()
    lengths = np.bincount(row.filter(there).to_numpy(), minlength=len(texts)) + 1
    codes = np.full(lengths.sum(), len(found.dictionary), np.int64)
    inside = np.ones(len(codes), bool)
    inside[np.cumsum(lengths) - 1] = False
    codes[inside] = found.indices.to_numpy()
    return codes, lengths, pa.concat_arrays([found.dictionary, pa.array([END], pa.string())])


def units_of(words: pa.Array, units: dict[bytes, int], first: int) -> tuple[np.ndarray, np.ndarray]:
    """The unit of each word, and whether it is its own: rarer words stand as first + their ending."""
    raw = words.cast(pa.binary()).to_pylist()
    own = [units.get(w, -1) for w in raw]
    out = np.array([u if u >= 0 else first + ending(w) for u, w in zip(own, raw, strict=True)], np.int64)
    return out, np.array(own) >= 0


def summed(parts: list[pa.Table], keys: list[str], n: str) -> pa.Table:
    return pa.concat_tables(parts).group_by(keys).aggregate([(n, "sum")]).rename_columns([*keys, n])


def in_parts(tables: Iterator[pa.Table], keys: list[str], n: str, most: int, rows_each: int = 50_000) -> Iterator[pa.RecordBatch]:
    """The sums of tables (keys, n), as few rows for a key as fit into a task's memory."""
    whole: list[pa.Table] = []
    fresh, rows = [], 0
    for t in tables:
        fresh.append(t)
        rows += t.num_rows
        if rows > most:
            whole, fresh, rows = [summed(whole + fresh, keys, n)], [], 0
            pa.default_memory_pool().release_unused()  # two workers share an executor's memory
            if whole[0].num_rows > most:
                yield from whole.pop().combine_chunks().to_batches(max_chunksize=rows_each)
    if whole or fresh:
        yield from summed(whole + fresh, keys, n).combine_chunks().to_batches(max_chunksize=rows_each)
    whole, fresh = [], []
    pa.default_memory_pool().release_unused()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all texts; each task adds up its own first."""

    def counts(batch: pa.RecordBatch) -> pa.Table:
        codes, _, words = coded(batch["text"])
        return pa.table({"word": words, "c": np.bincount(codes, minlength=len(words))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_parts((counts(b) for b in batches if b.num_rows), ["word"], "c", FLUSH)

    # Dealt by word at once: what a task sends is added up already.
    return texts.select("text").mapInArrow(run, "word string, c long").repartition("word").groupBy("word").agg(F.sum("c").alias("c"))


def by_chunk(pair: np.ndarray, n: np.ndarray, n_units: int) -> Iterator[pa.RecordBatch]:
    """(chunk, own, other, n): bigrams as arrays, by the chunk of their first unit and once more by that of
    their second (CHUNKS more). Units are dealt to chunks in turn, so that frequent ones do not meet."""
    first, second = pair // n_units, pair % n_units
    for side, (own, other) in enumerate(((first, second), (second, first))):
        chunk = own % CHUNKS
        order = np.argsort(chunk, kind="stable")
        cuts = np.searchsorted(chunk[order], np.arange(CHUNKS + 1))
        there = np.flatnonzero(np.diff(cuts))
        if not len(there):
            continue
        columns = [pa.array(there + side * CHUNKS)]
        for values, kind in ((own, "<i4"), (other, "<i4"), (n, "<i8")):
            raw, size = values[order].astype(kind), np.dtype(kind).itemsize
            offsets = (np.append(cuts[there], cuts[-1]) * size).astype(np.int32)
            columns.append(pa.Array.from_buffers(pa.binary(), len(there), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]))
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "own", "other", "n"])


def unit_bigrams(texts: DataFrame, units: dict[bytes, int], n_units: int) -> DataFrame:
    """(chunk, own, other, n): how often units follow each other, the end standing before the first word.

    One row has all bigrams that begin with a unit of a chunk, one all that end with it. Such a row has at
    most (n_units / CHUNKS) * n_units bigrams; what tasks send for it is added up as it arrives.
    """
    shared = texts.sparkSession.sparkContext.broadcast(units)  # UNITS words at most
    first = n_units - ENDINGS

    def counts(batch: pa.RecordBatch) -> pa.Table:
        codes, _, words = coded(batch["text"])
        ids = units_of(words, shared.value, first)[0][codes]
        # Every text closes with the end, which therefore stands before the next one's first word.
        pairs = np.concatenate([[shared.value[b"\n"]], ids[:-1]]) * n_units + ids
        found = pc.value_counts(pa.array(pairs))
        return pa.table({"pair": found.field("values"), "n": found.field("counts")})

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts((counts(b) for b in batches if b.num_rows), ["pair"], "n", FLUSH, FLUSH):
            yield from by_chunk(part["pair"].to_numpy(), part["n"].to_numpy(), n_units)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merge(chunk: int) -> None:
            keys, n = (np.concatenate(x) for x in zip(*held[chunk], strict=True))
            keys, at = np.unique(keys, return_inverse=True)
            held[chunk] = [(keys, np.bincount(at, n).astype(np.int64))]

        for batch in batches:
            for k, chunk in enumerate(batch["chunk"].to_pylist()):
                own, other = (np.frombuffer(batch[c][k].as_buffer(), "<i4").astype(np.int64) for c in ("own", "other"))
                parts = held.setdefault(chunk, [])
                parts.append((own * n_units + other, np.frombuffer(batch["n"][k].as_buffer(), "<i8")))
                if len(parts) > 2 and sum(len(x) for x, _ in parts[1:]) > max(FLUSH // 10, 2 * len(parts[0][0])):
                    merge(chunk)
        for chunk in sorted(held):
            merge(chunk)
            ((keys, n),) = held.pop(chunk)
            columns = [(keys // n_units).astype("<i4"), (keys % n_units).astype("<i4"), n.astype("<i8")]
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), *[pa.array([x.tobytes()], pa.binary()) for x in columns]], ["chunk", "own", "other", "n"])

    kind = "chunk long, own binary, other binary, n binary"
    return texts.select("text").mapInArrow(sent, kind).repartition("chunk").mapInArrow(added, kind)


def exchanges(bigrams: DataFrame, classes: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """right[u, c], left[u, c]: bigrams of unit u with a following / preceding unit of class c; self[u].

    A row of bigrams has all those of its units, so nothing is shuffled.
    """
    n_units, width = len(classes), n_classes + 1
    lines = n_units // CHUNKS + 1
    shared = bigrams.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                own, other = (np.frombuffer(batch[c][k].as_buffer(), "<i4") for c in ("own", "other"))
                n, line, same = np.frombuffer(batch["n"][k].as_buffer(), "<i8"), own // CHUNKS * width, own == other
                sums = np.bincount(line + cls[other], n, lines * width) + np.bincount(line[same] + n_classes, n[same], lines * width)
                yield pa.RecordBatch.from_arrays([batch["chunk"].slice(k, 1), pa.array([sums.astype("<f8").tobytes()], pa.binary())], ["chunk", "sums"])

    tables = np.zeros((2, lines, CHUNKS, width))  # bounded by UNITS and the number of classes
    found = bigrams.mapInArrow(run, "chunk long, sums binary").toArrow()
    for chunk, sums in zip(found["chunk"].to_pylist(), found["sums"], strict=True):
        tables[chunk // CHUNKS, :, chunk % CHUNKS] = np.frombuffer(sums.as_buffer(), "<f8").reshape(lines, width)
    right, left = tables.reshape(2, -1, width)[:, :n_units]
    return right[:, :n_classes], left[:, :n_classes], right[:, n_classes]


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """The part of the training bigrams' log likelihood that the classes change."""
    return float(xlogx(table).sum() - xlogx(table.sum(axis=0)).sum() - xlogx(table.sum(axis=1)).sum())


def table_of(right: np.ndarray, classes: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, n))
    np.add.at(out, classes, right)
    return out


def moved(classes: np.ndarray, right: np.ndarray, left: np.ndarray, self_: np.ndarray, units: np.ndarray) -> np.ndarray:
    """classes after each of the units went to the class that suits it best; class 0 is the end's own."""
    classes, n = classes.copy(), right.shape[1]
    table = table_of(right, classes, n)
    for u in units:
        g, s = classes[u], self_[u]
        r, l = right[u].copy(), left[u].copy()  # noqa: E741
        r[g], l[g] = max(0, r[g] - s), max(0, l[g] - s)
        table[g, :] -= r
        table[:, g] -= l
        table[g, g] -= s
        np.maximum(table, 0, out=table)
        rows, columns = table.sum(axis=1), table.sum(axis=0)
        a, b = np.flatnonzero(r), np.flatnonzero(l)
        gain = (xlogx(table[:, a] + r[a]) - xlogx(table[:, a])).sum(axis=1) + (xlogx(table[b] + l[b, None]) - xlogx(table[b])).sum(axis=0)
        d = np.diag(table)
        gain += xlogx(d + r + l + s) - xlogx(d + r) - xlogx(d + l) + xlogx(d)
        gain -= xlogx(rows + r.sum() + s) - xlogx(rows) + xlogx(columns + l.sum() + s) - xlogx(columns)
        gain[0] = -np.inf
        k = int(np.argmax(gain))
        k = k if gain[k] > gain[g] + 1e-9 else g
        table[k, :] += r
        table[:, k] += l
        table[k, k] += s
        classes[u] = k
    return classes


def clustered(bigrams: DataFrame, n_units: int, end: int, n_classes: int, sweeps: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of units and the class bigram table of the best sweep."""
    units = np.arange(n_units)
    classes = 1 + units % (n_classes - 1)
    classes[end] = 0
    best = (-np.inf, classes, np.zeros((n_classes, n_classes)))
    for k in range(sweeps + 1):
        right, left, self_ = exchanges(bigrams, classes, n_classes)
        table = table_of(right, classes, n_classes)
        if (now := likelihood(table)) > best[0]:
            best = (now, classes, table)
        if k < sweeps:
            used = (right.sum(axis=1) + left.sum(axis=1) > 0) & (units != end)
            half = units[used & ((units * 2654435761 >> 7) % 2 == k % 2)]
            classes = moved(classes, right, left, self_, half)
    return best[1], best[2]


def transitions(table: np.ndarray, smoothing: float) -> np.ndarray:
    """log10 P(class | class before)."""
    share = (table.sum(axis=0) + 1) / (table.sum() + len(table))
    return np.log10((table + smoothing * share) / (table.sum(axis=1, keepdims=True) + smoothing))


def assigned(texts: DataFrame, units: dict[bytes, int], classes: np.ndarray, table: np.ndarray, smoothing: float) -> DataFrame:
    """(word, c, class) of all words that are no units: the class that makes their neighbours likeliest."""
    n, first, end = len(table), len(classes) - ENDINGS, units[b"\n"]
    step = transitions(table, smoothing)
    gains = np.concatenate([step - np.log10(table.sum(axis=0) + 1), step.T])  # by class before; by class after
    gains[:, 0] = -1e9  # the end's own
    shared = texts.sparkSession.sparkContext.broadcast((units, classes, gains))

    def counts(batch: pa.RecordBatch) -> pa.Table:
        known, cls, _ = shared.value
        codes, _, words = coded(batch["text"])
        unit, own = units_of(words, known, first)
        classes, rare = cls[unit][codes], np.flatnonzero(~own[codes])  # the last is the end: no rare one
        before = np.where(rare > 0, classes[rare - 1], cls[end])
        cells = np.concatenate([before, n + classes[rare + 1]])
        found = pc.value_counts(pa.array(np.tile(codes[rare], 2) * (2 * n) + cells))
        key = found.field("values").to_numpy()
        return pa.table({"word": words.take(pa.array(key // (2 * n))), "cell": key % (2 * n), "n": found.field("counts")})

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_parts((counts(b) for b in batches if b.num_rows), ["word", "cell"], "n", FLUSH)

    @F.arrow_udf("int")
    def best(cells: pa.Array) -> pa.Array:
        flat, at = cells.flatten(), np.asarray(cells.offsets)[:-1] - cells.offsets[0].as_py()
        if not len(at):
            return pa.array([], pa.int32())
        g = shared.value[2][flat.field("cell").to_numpy()] * flat.field("n").to_numpy()[:, None]
        return pa.array(np.add.reduceat(g, at, axis=0).argmax(axis=1).astype(np.int32))

    # One exchange serves both groupings. A token has one neighbour before it, so those are its count.
    cells = texts.select("text").mapInArrow(met, "word string, cell long, n long").repartition("word").groupBy("word", "cell").agg(F.sum("n").alias("n"))
    found = cells.groupBy("word").agg(F.sum(F.when(F.col("cell") < n, F.col("n"))).alias("c"), F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("x"))
    return found.select("word", "c", best("x").alias("class"))


def least_count(often: list, most: int) -> int:
    """The least count that leaves at most `most` words, from (count, number of words)."""
    out = often[0][0] + 1 if often else 1
    for c, n in often:
        if (most := most - n) < 0:
            break
        out = c
    return out


def scored(docs: DataFrame, n_classes: int = 48, sweeps: int = 8, smoothing: float = 20.0, most_units: int = UNITS, most_known: int = KNOWN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    training = rows.where(~F.col("held_out")).select("text")
    counts = staged(word_counts(training), "words")
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # Words by count: as many rows as there are different counts, less than the root of twice the tokens.
    often = sorted(((r["c"], r["n"]) for r in counts.groupBy("c").agg(F.count("*").alias("n")).collect()), reverse=True)
    own, bound = least_count(often, most_units), least_count(often, max(most_units, most_known))
    frequent = counts.where((F.col("c") >= own) | (F.col("word") == END)).collect()
    frequent.sort(key=lambda r: (-r["c"], r["word"]))
    units = {r["word"].encode(): k for k, r in enumerate(frequent)}
    units.setdefault(END.encode(), len(units))
    n_units = len(units) + ENDINGS
    bigrams = staged(unit_bigrams(training, units, n_units), "bigrams")
    classes, table = clustered(bigrams, n_units, units[b"\n"], n_classes, sweeps)
    rest = staged(assigned(training, units, classes, table, smoothing), "classes")
    # Unseen words by ending.
    of_ending = classes[n_units - ENDINGS :].copy()
    by_ending = rest.groupBy((F.crc32(F.substring(F.col("word").cast("binary"), -3, 3)) % ENDINGS).alias("e"), "class").agg(F.sum("c").alias("c")).collect()
    for r in sorted(by_ending, key=lambda r: (r["c"], -r["class"])):
        of_ending[r["e"]] = r["class"]  # the most frequent is last
    # The most frequent words as arrays: what they add to the score, and their classes.
    more = rest.where(F.col("c") >= bound).select("word", "c", "class").toArrow()
    known_words = pa.concat_arrays([pa.array([r["word"] for r in frequent], pa.string()), *more["word"].cast(pa.string()).chunks])
    known_logs = np.log10(np.concatenate([np.array([r["c"] for r in frequent], float), more["c"].to_numpy()]) + 0.5)
    known_classes = np.concatenate([classes[: len(frequent)], more["class"].to_numpy()]).astype("<i2")
    shared = spark.sparkContext.broadcast((known_words, known_logs, known_classes))  # most_known words at most
    kind = "row long, doc_id long, held_out boolean, n_tokens long, sure double, ids binary, words array<string>"
    shape = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("sure", pa.float64()), ("ids", pa.binary()), ("words", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, logs, own_class), row = shared.value, TaskContext.get().partitionId() << 40
        for part in batches:
            if not part.num_rows:
                continue
            codes, lengths, words = coded(part["text"])
            at = pc.index_in(words, value_set=known)
            missing, at = at.is_null().to_numpy(zero_copy_only=False), pc.fill_null(at, 0).to_numpy()
            log, cls = np.zeros(len(words)), np.zeros(len(words), "<i2")
            log[~missing], cls[~missing] = logs[at[~missing]], own_class[at[~missing]]
            cls[missing] = [-1 - ending(w) for w in words.filter(pa.array(missing)).cast(pa.binary()).to_pylist()]
            log, ids = log[codes], cls[codes]
            ends = np.cumsum(lengths)
            late = np.flatnonzero(missing[codes])
            cut = np.searchsorted(late, np.concatenate([[0], ends]))
            columns = [
                pa.array(row + np.arange(len(lengths))), part["doc_id"], part["held_out"], pa.array(lengths),
                pa.array(np.add.reduceat(log, ends - lengths)),
                pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(np.concatenate([[0], 2 * ends]).astype(np.int32)), pa.py_buffer(ids)]),
                pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), words.take(pa.array(codes[late]))),
            ]
            row += len(lengths)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)

    @F.arrow_udf("binary")
    def filled(ids: pa.Array, met: pa.Array) -> pa.Array:
        out = []
        for x, m in zip(ids, met, strict=True):
            own = np.frombuffer(x.as_buffer(), np.int16).copy()
            late = np.flatnonzero(own < 0)
            own[late] = of_ending[-1 - own[late].astype(np.int64)]
            if len(late) and m.is_valid:
                found = m.values.field("class")
                own[late] = np.where(found.is_valid(), found.fill_null(0), own[late])
            out.append(own.tobytes())
        return pa.array(out, pa.binary())

    seen = staged(rows.mapInArrow(run, kind), "seen")
    # Words too rare to be known to every task meet their counts and classes in a join.
    each = seen.select("row", F.posexplode("words").alias("at", "w"))
    met = each.join(rest.where(F.col("c") < bound), F.col("w") == F.col("word"), "left")
    sums = met.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"), F.sum(F.when(F.col("c") > 0, 0).otherwise(1)).alias("unseen"),
        F.sort_array(F.collect_list(F.struct("at", "class"))).alias("met"),
    )
    whole = seen.drop("words").join(sums, "row", "left")
    whole = staged(whole.select("doc_id", "held_out", "n_tokens", (F.col("n_tokens") - F.coalesce("unseen", F.lit(0))).alias("n_known"), (F.col("sure") + F.coalesce("more", F.lit(0.0))).alias("words"), filled("ids", "met").alias("ids")), "whole")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_classes * n_classes, np.int64)
        for batch in batches:
            for x in batch["ids"]:
                own = np.frombuffer(x.as_buffer(), np.int16).astype(np.int64)
                sums += np.bincount(np.concatenate([[0], own[:-1]]) * n_classes + own, minlength=len(sums))
        cell = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(sums[cell])], ["cell", "n"])

    table = np.zeros((n_classes, n_classes))
    for r in whole.where(~F.col("held_out")).select("ids").mapInArrow(pairs, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        table.ravel()[r["cell"]] = r["n"]
    kinds = np.bincount(classes[: len(frequent)], minlength=n_classes).astype(float)
    for r in rest.groupBy("class").count().collect():
        kinds[r["class"]] += r["count"]
    below = np.log10(table.sum(axis=0) + 0.5 * (kinds + 1))
    step = transitions(table, smoothing)

    @F.arrow_udf("double")
    def fixed(ids: pa.Array) -> pa.Array:
        own = [np.frombuffer(x.as_buffer(), np.int16) for x in ids]
        return pa.array([float(step[np.concatenate([[0], x[:-1]]), x].sum() - below[x].sum()) for x in own], pa.float64())

    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("words") - F.col("n_tokens") * F.log10(F.lit(total + 0.5 * (types + 1)))).alias("base_score"),
        (F.col("words") + fixed("ids")).alias("score"),
    )
