"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight for each hashed word, shared by all grades, gives a text its score s; ordered
thresholds t_1 <= t_2 <= ... give P(grade >= k) = sigmoid(s - t_k). The words that a text holds and
their beginnings count once each (an inflected word is known by its stem); a few marks of the text's
form (length, symbols, capitals, repeated words and lines) are hashed beside them.
The fit is accelerated proximal gradient descent with soft thresholding, so that most weights are exactly zero.

Nulls, empties, ties: a null text is an empty one; an empty text has no words and is scored by its
marks. Rows without doc_id are scored, never learned from. Ratings without a doc_id or grade are
ignored; a document rated more than once counts with its lowest grade; of rows that share a rated
doc_id one text is learned from, the one with the smallest feature hash. With no ratings, or ratings
of one grade alone, every document gets the top grade. Repeated rows get equal results. Other
columns of the documents are passed on as they are.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import small_batches

#: Lower case, and ASCII punctuation as blanks.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b < 128 and not (48 <= b <= 57 or 97 <= b <= 122) else b
    for b in range(256)
)
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
#: Lengths in bytes of the beginnings of a word that count beside it.
STEMS = (4, 5, 6)
#: Words that a worker remembers, about 120 bytes each.
CACHE = 200_000


def level(x: float) -> int:
    """Eight steps, fine near 0: 0, up to 1/64, 1/32, ... 1/2, above."""
    return 0 if x <= 0 else int(np.clip(7 + np.floor(np.log2(x)), 1, 7))


def marks(raw: bytes, found: list[bytes], distinct: int) -> list[bytes]:
    """What the form of a text adds to its words."""
    n = max(1, len(found))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    shares = {
        b"symbols": sum(map(raw.count, SYMBOLS)) / n,
        b"shouts": raw.count(b"!") / n,
        b"capitals": sum(len(x) > 1 and x.isupper() for x in raw.split()) / n,
        b"repeats": 1 - distinct / n,
        b"lines": 1 - len(set(lines)) / max(1, len(lines)),
    }
    long = [b"\nlength %d" % j for j in range(len(found).bit_length())]
    return long + [b"\n%s %d" % (k, j) for k, x in shares.items() for j in range(1, level(x) + 1)]


def features(text: str | None) -> set[bytes]:
    """The different words of a text and its marks."""
    raw = (text or "").encode("utf-8", "replace")
    found = raw.translate(PLAIN).split()
    distinct = set(found)
    return distinct | set(marks(raw, found, len(distinct)))


def parts(word: bytes, mask: int) -> list[int]:
    """The buckets of a word: its own and those of its beginnings."""
    own = [zlib.crc32(word) & mask]
    return own if word[:1] == b"\n" else own + [zlib.crc32(b"\r" + word[:n]) & mask for n in STEMS if len(word) > n]


def buckets(text: str | None, bits: int) -> list[int]:
    mask = (1 << bits) - 1
    return sorted({b for x in features(text) for b in parts(x, mask)})


@dataclass
class Model:
    bits: int
    weights: np.ndarray
    thresholds: np.ndarray

    @property
    def grades(self) -> int:
        return len(self.thresholds) + 1


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_rows(flat: np.ndarray, lengths: np.ndarray, grades: np.ndarray, n_grades: int, bits: int, penalty: float, steps: int, least: int) -> Model:
    """Weights and thresholds of rows of buckets, one row after the other in flat.

    Buckets of fewer than `least` rows get no weight.
    """
    none = Model(bits, np.zeros(1 << bits), np.full(n_grades - 1, -40.0))
    if len(np.unique(grades)) < 2:
        return none
    of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    often = np.bincount(flat, minlength=1 << bits) >= least
    flat, of = flat[often[flat]], of[often[flat]]
    used = np.unique(flat)
    place = np.zeros(1 << bits, dtype=np.int32)
    place[used] = np.arange(len(used))
    flat, n = place[flat], len(lengths)
    at_least = np.array([(grades >= k).mean() for k in range(1, n_grades)]).clip(1e-4, 1 - 1e-4)
    w, t = np.zeros(len(used)), -np.log(at_least / (1 - at_least))
    # The loss bends by 1/2 at most in s: a separable bound on it gives each weight its own safe step.
    bend = np.bincount(flat, np.bincount(of, minlength=n)[of], minlength=len(used)) / (2 * n)
    k, ahead, ahead_t, pace = np.arange(n_grades - 1), w, t, 1.0
    for _ in range(steps):
        s = np.bincount(of, ahead[flat], minlength=n)
        tail = np.hstack([np.ones((n, 1)), sigmoid(s[:, None] - ahead_t), np.zeros((n, 1))])  # P(grade >= 0, 1, ...)
        low, high = tail[np.arange(n), grades], tail[np.arange(n), grades + 1]
        p = np.maximum(low - high, 1e-12)
        gw = np.bincount(flat, (low + high - 1)[of], minlength=len(used)) / n
        slope = tail * (1 - tail)
        gt = (((grades[:, None] == k + 1) - 1.0 * (grades[:, None] == k)) * slope[:, 1:-1] / p[:, None]).mean(axis=0)
        new = ahead - gw / bend
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / bend, 0)
        new_t = np.maximum.accumulate(ahead_t - gt)
        if gw @ (new - w) > 0:  # overshot: forget the momentum
            pace = 1.0
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead, ahead_t = new + (pace - 1) / faster * (new - w), np.maximum.accumulate(new_t + (pace - 1) / faster * (new_t - t))
        w, t, pace = new, new_t, faster
    weights = np.zeros(1 << bits)
    weights[used] = w
    return Model(bits, weights, t)


def fit(
    docs: DataFrame, ratings: DataFrame, n_grades: int, seed: int = 9, max_fit_rows: int = 8_000,
    bits: int = 18, penalty: float = 3e-4, steps: int = 220, least: int = 5,
) -> Model:
    """Learn from ratings (doc_id, grade 0 .. n_grades - 1) of docs (doc_id, text).

    max_fit_rows bounds the rated rows that are learned from (about that many, chosen by a hash of
    the id); the fit on them is the only thing that happens on the driver.
    """
    small_batches(docs.sparkSession)
    rated = (
        ratings.where("doc_id is not null and grade is not null")
        .groupBy("doc_id").agg(F.min(F.col("grade").cast("int")).alias("grade"))
        .where(F.col("grade").between(0, n_grades - 1))
    )
    total = rated.count()
    share = min(1.0, max_fit_rows / max(1, total))
    kept = rated.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    @F.udf("array<int>", useArrow=True)
    def hashed(text):
        return buckets(text, bits)

    sample = (
        docs.select("doc_id", "text").join(F.broadcast(kept), "doc_id")  # about max_fit_rows small rows
        .withColumn("__b", hashed("text"))
        .groupBy("doc_id").agg(F.min("grade").alias("grade"), F.min_by("__b", F.xxhash64("__b")).alias("__b"))
        .select("doc_id", "grade", "__b").toArrow()
    )
    if not sample.num_rows:
        return fit_rows(np.array([], np.int32), np.array([], np.int64), np.array([], np.int64), n_grades, bits, penalty, steps, least)
    sample = sample.sort_by("doc_id").combine_chunks()
    lengths = pc.list_value_length(sample["__b"]).to_numpy()
    flat = pc.list_flatten(sample["__b"]).to_numpy()
    return fit_rows(flat, lengths, sample["grade"].to_numpy().astype(np.int64), n_grades, bits, penalty, steps, least)


def tails(model: Model, text: Column) -> Column:
    """array<double>: P(grade >= 1), P(grade >= 2), ... of a text."""
    held = {int(i): float(model.weights[i]) for i in np.flatnonzero(model.weights)}
    mask, thresholds = (1 << model.bits) - 1, model.thresholds
    memory: dict[bytes, tuple[int, ...]] = {}

    def weighted(word: bytes) -> tuple[int, ...]:
        if (found := memory.get(word)) is None:
            if len(memory) > CACHE:
                memory.clear()
            found = memory[word] = tuple(b for b in parts(word, mask) if b in held)
        return found

    @F.arrow_udf("array<double>")
    def scored(texts: pa.Array) -> pa.Array:
        own = ({b for w in features(x.as_py()) for b in weighted(w)} for x in texts)
        s = np.array([math.fsum(map(held.get, x)) for x in own])
        tail = sigmoid(s[:, None] - thresholds).round(9)
        return pa.array(list(tail), pa.list_(pa.float64()))

    return scored(text)


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """docs with tail_k = P(grade >= k) and expected_grade."""
    small_batches(docs.sparkSession)
    out = docs.withColumn("__tails", tails(model, F.col("text")))
    each = {f"tail_{k}": F.col("__tails")[k - 1] for k in range(1, model.grades)}
    each["expected_grade"] = F.round(sum(F.col("__tails")[k] for k in range(model.grades - 1)), 9)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in each]
    return out.select(*own, *[c.alias(k) for k, c in each.items()])


def grades_of(labels: DataFrame) -> DataFrame:
    """Ratings from the labels: 0 for low quality, 1 for toxic text of good quality, 2 for clean text."""
    return labels.select(
        "doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2).alias("grade")
    )


def accepted(docs: DataFrame, labels: DataFrame, at_least: float = 0.7, **settings) -> DataFrame:
    """docs with the tail probabilities and kept: the text has the top grade with this probability."""
    return graded(docs, fit(docs, grades_of(labels), 3, **settings)).withColumn("kept", F.col("tail_2") >= at_least)


def selected(docs: DataFrame, labels: DataFrame, at_least: float = 0.7, **settings) -> DataFrame:
    """The rows of docs, with their own columns, that are accepted."""
    model = fit(docs, grades_of(labels), 3, **settings)
    out = docs.withColumn("__kept", tails(model, F.col("text"))[1] >= at_least).where("__kept")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
