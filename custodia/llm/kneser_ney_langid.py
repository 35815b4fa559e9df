"""Language identification by interpolated Kneser-Ney character models.

A text is its letters and marks in lower case, with one blank for whatever lies between them and
three before its beginning. Each language has a model of ORDER characters: counts at the top order,
numbers of different characters before a sequence below it, one discount for each order from its
counts of counts, and what the discounts leave goes to the next shorter context, down to an even share
for every symbol. Sequences are packed into 64 bits (16 for a character; those beyond the basic plane
share PRIVATE codes) and a bijection makes them hashes; a model is one sorted array of hashes with
probabilities and one of contexts with what they leave, for each order.

Counting takes every training row, in Spark. A model keeps the most frequent sequences: all languages
and orders together have at most `size` of them, so that it can be sent to all tasks; what a context
leaves to its shorter one grows by the shares of those that are not kept, so probabilities still add
up to one. The language with the lowest cross-entropy for a character wins.

Rejection is calibrated on the training rows: for each language, how far a text's cross-entropy lies
above the language's own, times the root of its length, and the quantile `accept` of that. The score is
the winner's share when likelihoods are raised to the power, of a few, that predicts the training rows best.

Nulls, empties, ties: a null text, or one without a letter, is `und` with score 0; so is everything if
nothing can be learned from. Rows with a null lang are only predicted; a null id is in the training
part. A lang of '' is a value like any other. Of equal cross-entropies the first language by name wins.
Repeated rows are counted and predicted one by one. An empty table gives an empty result. Other columns
of the documents are ignored. Languages are taken to be few.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import small_batches, staged

ORDER = 4
BITS = 16
BLANK = 32
PRIVATE = 6400
#: Sequences in all models together, 16 bytes each and as much again for contexts at most.
SIZE = 1 << 19
#: Characters that are worked on at once.
BLOCK = 1 << 20
#: Rows of partial counts that a task holds.
HELD = 1 << 20
POWERS = (1.0, 0.5, 0.25, 0.125, 0.0625, 0.03125)
NONE = "und"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@functools.cache
def symbols() -> np.ndarray:
    """The symbol of every code point: letters and marks in lower case, all else blank."""
    out = np.full(sys.maxunicode + 1, BLANK, np.uint16)
    for k in range(sys.maxunicode + 1):
        if unicodedata.category(c := chr(k))[0] in "LM":
            low = ord(c.lower()[0])
            out[k] = low if low < 1 << BITS else 0xE000 + low % PRIVATE
    return out


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str], bool]]:
    """Rows and texts of about BLOCK characters; a longer text comes in parts, the last flag says whether it goes on."""
    rows, own, n = [], [], 0
    for k, t in enumerate(texts):
        if own and n + len(t) > BLOCK:
            yield rows, own, False
            rows, own, n = [], [], 0
        while len(t) > BLOCK:
            yield [k], [t[:BLOCK]], True
            t = t[BLOCK:]
        rows.append(k)
        own.append(t)
        n += len(t)
    if own:
        yield rows, own, False


def sequences(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, sequence): the packed last ORDER symbols at every symbol of the texts, in blocks."""
    table, going = symbols(), False
    tail = fresh = np.full(ORDER - 1, BLANK, np.uint16)
    for rows, own, more in pieces(texts):
        # A blank ends each text, so the next one begins after a blank.
        codes = np.frombuffer("".join([*[t + " " for t in own[:-1]], own[-1] + ("" if more else " ")]).encode("utf-32-le", "replace"), np.uint32)
        codes = table[codes]
        of = np.repeat(np.array(rows), [len(t) + 1 for t in own[:-1]] + [len(own[-1]) + (not more)])
        blank = codes == BLANK
        before = np.concatenate([[tail[-1] == BLANK if going else True], blank[:-1]])
        kept = ~(blank & before)
        codes, of = codes[kept], of[kept]
        line = np.concatenate([tail, codes]).astype(np.uint64)
        begins = np.flatnonzero(np.concatenate([[not going], of[1:] != of[:-1]])[: len(of)])
        packed = line[ORDER - 1 :].copy()
        for back in range(1, ORDER):
            earlier = line[ORDER - 1 - back : len(line) - back].copy()
            for j in range(back):  # nothing of another text
                at = begins + j
                at = at[at < len(of)]
                at = at[of[at] == of[begins[: len(at)]]]
                earlier[at] = BLANK
            packed |= earlier << np.uint64(BITS * back)
        if len(of):
            yield of, packed
        tail, going = np.concatenate([tail, codes])[-(ORDER - 1) :] if more else fresh, more


def hashed(packed: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits (two rounds of shift and multiply)."""
    x = packed.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def decoded(texts: pa.Array) -> list[str]:
    return [(x or b"").decode("utf-8", "replace") for x in texts.cast(pa.binary()).to_pylist()]


def counted(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) of rows (lang, text): all sequences of ORDER symbols."""

    def added(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by(["lang", "gram"]).aggregate([("n", "sum")]).rename_columns(["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, fresh, n = [], [], 0
        for batch in batches:
            lang = batch["lang"].cast(pa.string()).dictionary_encode()
            codes = lang.indices.to_numpy()
            for of, packed in sequences(decoded(batch["text"])):
                own = pa.table({"code": codes[of], "gram": packed.view(np.int64)}).group_by(["code", "gram"]).aggregate([([], "count_all")])
                fresh.append(pa.table({"lang": lang.dictionary.take(own["code"].combine_chunks()), "gram": own["gram"], "n": own["count_all"]}))
                n += own.num_rows
                if n > HELD:
                    whole, fresh, n = [added(whole + fresh)], [], 0
                    if whole[0].num_rows > HELD:
                        yield from whole.pop().to_batches(max_chunksize=50_000)
        if whole or fresh:
            yield from added(whole + fresh).to_batches(max_chunksize=50_000)

    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Table:
    """One order of a model: hashes with probabilities, hashes of contexts with what they leave."""

    hashes: np.ndarray
    chances: np.ndarray
    contexts: np.ndarray
    leaves: np.ndarray


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted hashes in sorted keys, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def mask(order: int) -> np.uint64:
    return np.uint64((1 << (BITS * order)) - 1)


def chance(tables: list[Table], packed: np.ndarray, order: int | None = None) -> np.ndarray:
    """P(last symbol | those before it) of packed sequences, by the first `order` tables."""
    order = len(tables) if order is None else order
    if order == 0:
        return np.full(len(packed), 2.0**-BITS)
    own, packed = tables[order - 1], packed & mask(order)
    at, hit = found(own.hashes, hashed(packed))
    out = np.empty(len(packed))
    out[hit] = own.chances[at[hit]]
    rest = packed[~hit]
    if len(rest):
        k, known = found(own.contexts, hashed(rest >> np.uint64(BITS)))
        left = np.where(known, own.leaves[k] if len(own.leaves) else 1.0, 1.0)
        out[~hit] = left * chance(tables, rest, order - 1)
    return out


def model_of(orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]) -> list[Table]:
    """Tables from (sequences, counts, counts of their contexts, discount) of the orders 1, 2, ..."""
    tables: list[Table] = []
    for k, (packed, n, total, discount) in enumerate(orders, 1):
        share = np.maximum(n - discount, 0) / total
        contexts, of = np.unique(packed >> np.uint64(BITS), return_inverse=True)
        leaves = np.maximum(1 - np.bincount(of, share, minlength=len(contexts)), 1e-12)
        chances = share + leaves[of] * chance(tables, packed, k - 1)
        h, c = hashed(packed), hashed(contexts)
        a, b = np.argsort(h), np.argsort(c)
        tables.append(Table(h[a], chances[a], c[b], leaves[b]))
    return tables


def discount_of(once: int, twice: int) -> float:
    """The share of one that Kneser-Ney takes from every count."""
    return min(0.95, once / (once + 2 * twice)) if once and twice else 0.5


def learned(rows: DataFrame, size: int = SIZE) -> dict[str, list[Table]]:
    """The model of each language, from rows (lang, text)."""
    top = staged(counted(rows), "sequences")
    tables = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):  # how many different symbols come before a shorter sequence
        shorter = F.col("gram").bitwiseAND(F.lit(int(mask(k))))
        tables[k] = staged(tables[k + 1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n")), f"sequences-{k}")
    # Counts of counts in steps of less than 1 %, so that their number is bounded.
    step = F.pow(F.lit(2), F.greatest(F.floor(F.log2("n")) - 7, F.lit(0))).cast("long")
    kinds: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for k, t in tables.items():
        for r in t.groupBy("lang", (F.col("n") - F.col("n") % step).alias("c")).agg(F.count("*").alias("n")).collect():
            kinds.setdefault((r["lang"], k), []).append((r["c"], r["n"]))
    langs = sorted({lang for lang, _ in kinds})
    orders: dict[tuple[str, int], tuple] = {}
    most = size // max(1, ORDER * len(langs))
    for k, t in tables.items():
        least = {}
        for lang in langs:
            left, out = most, None
            for c, n in sorted(kinds[lang, k], reverse=True):
                if (left := left - n) < 0:
                    break
                out = c
            least[lang] = sorted(kinds[lang, k])[-1][0] + (1 << 40) if out is None else out
        bound = F.create_map(*[F.lit(x) for pair in least.items() for x in pair]) if least else None
        if bound is None:
            continue
        context = F.shiftrightunsigned("gram", BITS).alias("context")
        totals = t.groupBy("lang", context).agg(F.sum("n").alias("total"))
        kept = t.select("lang", "gram", context, "n").where(F.col("n") >= bound[F.col("lang")])  # at most `size` rows in all
        own = kept.join(totals, ["lang", "context"]).select("lang", "gram", "n", "total").toArrow()
        for lang in langs:
            mine = own.filter(pc.equal(own["lang"], lang))
            counts = dict(kinds[lang, k])
            packed = mine["gram"].to_numpy().view(np.uint64)
            orders[lang, k] = (packed, mine["n"].to_numpy(), mine["total"].to_numpy(), discount_of(counts.get(1, 0), counts.get(2, 0)))
    return {lang: model_of([orders[lang, k] for k in range(1, ORDER + 1)]) for lang in langs}


def measured(rows: DataFrame, models: dict[str, list[Table]]) -> DataFrame:
    """rows (..., text) with, in place of the text, n symbols and bits for a symbol by each model, in order."""
    shared = rows.sparkSession.sparkContext.broadcast(list(models.values()))  # bounded by the models' size
    others = [c for c in rows.columns if c != "text"]
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            sums = np.zeros((batch.num_rows, len(shared.value)))
            for of, packed in sequences(decoded(batch["text"])):
                coded = pa.array(packed).dictionary_encode()
                distinct, at = coded.dictionary.to_numpy(), coded.indices.to_numpy()
                begins = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                n[of[begins]] += np.diff(np.append(begins, len(of)))
                for k, tables in enumerate(shared.value):
                    sums[of[begins], k] += np.add.reduceat(-np.log2(chance(tables, distinct))[at], begins)
            bits = (sums / np.maximum(n, 1)[:, None]).round(9)
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in others], pa.array(n), pa.array(list(bits), pa.list_(pa.float64()))], [*others, "n", "bits"])

    return rows.mapInArrow(run, f"{kind}, n long, bits array<double>")


def identified(docs: DataFrame, size: int = SIZE, accept: float = 0.999) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits (cross-entropy for a symbol) and accepted of every row.

    lang_pred is the likeliest language even where the text is like none of them: accepted tells.
    """
    small_batches(docs.sparkSession)
    text, lang = F.col("text").cast("string"), F.col("lang").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text.alias("text"), lang.alias("lang"))
    models = learned(rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text"), size)
    if not models:
        return rows.select("doc_id", "held_out", F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"), F.lit(False).alias("accepted"))
    # \p{L} is a letter; marks alone are none.
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    seen = staged(measured(rows.withColumn("letter", letter), models), "languages")
    names = list(models)
    place = F.create_map(*[F.lit(x) for k, name in enumerate(names) for x in (name, k)])
    taught = seen.where(~F.col("held_out") & F.col("letter") & (F.col("n") > 0)).select("n", "bits", place[F.col("lang")].alias("k")).where("k is not null")
    own = F.get("bits", F.col("k"))

    def share(power: float, which: Column) -> Column:
        """The share of one language when likelihoods are raised to a power."""
        of = lambda b: F.exp(-F.lit(np.log(2) * power) * F.col("n") * (b - F.array_min("bits")))
        return of(F.get("bits", which)) / F.aggregate("bits", F.lit(0.0), lambda s, b: s + of(b))

    losses = [F.avg(-F.log(F.greatest(share(p, F.col("k")), F.lit(1e-9)))).alias(f"p{i}") for i, p in enumerate(POWERS)]
    found = taught.agg(*losses).first()
    power = min(((round(found[f"p{i}"], 9) if found[f"p{i}"] is not None else 0.0), i) for i in range(len(POWERS)))[1]
    # Sums of hundred-millionths are whole numbers: the same in every order of tasks.
    whole = F.round(own * 1e8).cast("decimal(38,0)") * F.col("n").cast("decimal(38,0)")
    usual = {r["k"]: float(r["s"]) / r["n"] / 1e8 for r in taught.groupBy("k").agg(F.sum(whole).alias("s"), F.sum("n").alias("n")).collect()}
    mean = F.create_map(*[F.lit(x) for k in range(len(names)) for x in (k, usual.get(k, 0.0))])
    above = (own - mean[F.col("k")]) * F.sqrt("n")
    limits = {r["k"]: r["t"] for r in taught.groupBy("k").agg(F.percentile_approx(F.round(above, 6), accept, 100_000).alias("t")).collect()}
    limit = F.create_map(*[F.lit(x) for k in range(len(names)) for x in (k, float(limits.get(k, 0.0)))])
    out = seen.withColumn("k", F.when(F.col("letter"), F.array_position("bits", F.array_min("bits")).cast("int") - 1))
    fits = (F.get("bits", F.col("k")) - mean[F.col("k")]) * F.sqrt("n") <= limit[F.col("k")]
    return out.select(
        "doc_id", "held_out", F.coalesce(F.get(F.array(*map(F.lit, names)), F.col("k")), F.lit(NONE)).alias("lang_pred"),
        F.coalesce(F.round(share(POWERS[power], F.col("k")), 9), F.lit(0.0)).alias("score"), F.get("bits", F.col("k")).alias("bits"),
        F.coalesce(fits, F.lit(False)).alias("accepted"),
    )
