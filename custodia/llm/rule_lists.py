"""Quality rules: learned decision lists over text statistics.

Sequential covering: a rule is a conjunction of threshold conditions on statistics. It is grown on
two thirds of the labelled rows by the condition with the largest gain in information, then pruned
to the beginning that does best on the other third, and kept if it is precise enough there. Rows
that it covers leave, and the next rule is learned. Each step is one aggregation: counts by
statistic and bin hold all candidate conditions at once. The list becomes one conditional
expression, first rule first. Only DataFrame and SQL functions are used.

Nulls, empties, ties: a null text has no words, lines or characters; all its statistics are 0. Labels
without id or quality are ignored; of several labels of a document the lowest quality counts. Equal
gains go to the first statistic and the lowest threshold. Without labels, or with labels of one kind
alone, the list is empty and keeps everything. Repeated rows get equal results. Columns of the
documents other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import SPACE, let, staged, words

BINS = 48
MAX_RULES = 10
MAX_CONDITIONS = 3
PRECISION = 0.8
POSITION_BITS = 24


def repeat_words(w: Column) -> Column:
    """Words that lie in a window of three words found twice or more in w.

    Hashes of windows (the upper 40 bits, the window's place below) are sorted as plain numbers;
    equal neighbours are repeated windows. Where two different windows of a text share those bits,
    or a place needs more than 24 bits, whole hashes are sorted instead.
    """

    def covered(places: Column) -> Column:
        at = F.sort_array(places)
        gaps = let(at, lambda p: F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)

    def doubled(keys: Column, key, place) -> Column:
        """Places of sorted entries whose key equals a neighbour's."""
        own = F.filter(keys, lambda x, i: (key(x) == key(F.get(keys, i + 1))) | (key(x) == key(F.get(keys, i - 1))))
        return F.transform(own, place)

    def plain(h: Column) -> Column:
        packed = F.transform(h, lambda x, i: F.shiftleft(x, POSITION_BITS).bitwiseOR(i.cast("long")))
        sorted_ = F.sort_array(packed)
        mask = (1 << POSITION_BITS) - 1
        return let(sorted_, lambda s: doubled(s, lambda x: F.shiftright(x, POSITION_BITS), lambda x: x.bitwiseAND(F.lit(mask).cast("long"))))

    def whole(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i"))))
        return let(pairs, lambda s: doubled(s, lambda x: x["h"], lambda x: x["i"]))

    def places(h: Column) -> Column:
        short = F.transform(h, lambda x: F.shiftleft(x, POSITION_BITS))
        safe = (F.size(h) < 1 << POSITION_BITS) & (F.size(F.array_distinct(short)) == F.size(F.array_distinct(h)))
        return F.when(safe, plain(h)).otherwise(whole(h))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    n = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(places(h), covered)))
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(n)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the base statistics of the whole texts, with a few more for rules."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select("doc_id", text.alias("text"), words(F.col("text")).alias("w"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    left = lambda pattern: F.length(F.regexp_replace("text", pattern, "")).cast("long")
    return own.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), left(f"{SPACE}+").alias("word_chars"),
        left(r"[^#*$%&|<>]+").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(F.col("w"), repeat_words).alias("n_repeat_words"),
        left("[^A-Z]+").alias("n_capitals"), left("[^!]+").alias("n_shouts"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
    )


def measures() -> dict[str, Column]:
    """What rules put thresholds on, from the statistics."""
    words_, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words_, "capitals_per_char": F.col("n_capitals") / chars,
        "shouts_per_word": F.col("n_shouts") / words_, "repeated_share": F.col("n_repeat_words") / words_,
        "different_share": F.col("n_distinct") / words_, "chars_per_word": F.col("word_chars") / words_,
        "dup_lines_per_word": F.col("n_dup_lines") / words_, "n_words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float
    place: int
    cut: int

    def on_bins(self) -> Column:
        b = F.get("bins", self.place)
        return b > self.cut if self.above else b <= self.cut

    def on_measures(self) -> Column:
        x = measures()[self.name]
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def all_of(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def gain(p: float, n: float, p0: float, n0: float) -> float:
    """Positives kept times the information that a condition adds."""
    return 0.0 if not p else p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(stats: DataFrame, labels: DataFrame, precision: float = PRECISION, max_rules: int = MAX_RULES) -> list[Rule]:
    """Rules for low quality, from statistics (doc_id, ...) and labels (doc_id, quality)."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    names = list(measures())
    rows = stats.join(marked, "doc_id").select("doc_id", (F.col("q") == 0).alias("bad"), *[c.alias(k) for k, c in measures().items()])
    rows = staged(rows, "labelled")
    steps = F.array(*[F.lit((k + 0.5) / BINS) for k in range(BINS)])
    edges = [F.percentile_approx(F.when(which, F.col(k)), steps, 2000) for k in names for which in (F.lit(True), F.col("bad"))]
    found = rows.agg(*[e.alias(f"e{i}") for i, e in enumerate(edges)]).first()
    cuts = {k: sorted({x for e in found[2 * i : 2 * i + 2] for x in e or ()}) for i, k in enumerate(names)}

    def bin_of(k: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[k])), lambda t: t < F.col(k))) if cuts[k] else F.lit(0)

    bins = list(map(bin_of, names))
    third = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(3)) == 0
    rows = staged(rows.select("bad", third.alias("prune"), F.array(*bins).alias("bins")).groupBy("bad", "prune", "bins").agg(F.count("*").alias("n")), "binned")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows.where(~F.coalesce(all_of([~all_of([c.on_bins() for c in r]) for r in rules]) == F.lit(False), F.lit(False)))
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            own = left.where(~F.col("prune")).where(all_of([c.on_bins() for c in rule]))
            # One row for each statistic, bin and class: at most 2 * 2 * BINS of each statistic.
            counts = own.select("bad", "n", F.posexplode("bins").alias("k", "b")).groupBy("k", "b").agg(
                F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(~F.col("bad"), F.col("n")).otherwise(0)).alias("n")
            ).collect()
            best: tuple[float, Condition | None] = (1e-9, None)
            for k, name in enumerate(names):
                mine = sorted((r["b"], r["p"], r["n"]) for r in counts if r["k"] == k)
                p0, n0 = sum(x[1] for x in mine), sum(x[2] for x in mine)
                p = n = 0
                for b, dp, dn in mine[:-1]:
                    p, n = p + dp, n + dn
                    for above, gp, gn in ((False, p, n), (True, p0 - p, n0 - n)):
                        if p0 and (g := gain(gp, gn, p0, n0)) > best[0] * (1 + 1e-12):
                            best = (g, Condition(name, above, cuts[name][b], k, b))
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        # The beginning of the rule that is worth most on rows that it was not grown on.
        held = left.where("prune")
        sums = []
        for m in range(1, len(rule) + 1):
            inside = all_of([c.on_bins() for c in rule[:m]])
            sums += [F.sum(F.when(inside & F.col("bad"), F.col("n"))).alias(f"p{m}"), F.sum(F.when(inside & ~F.col("bad"), F.col("n"))).alias(f"n{m}")]
        r = held.agg(*sums).first()
        worth = [((r[f"p{m}"] or 0) - (r[f"n{m}"] or 0), (r[f"p{m}"] or 0), (r[f"n{m}"] or 0), m) for m in range(1, len(rule) + 1)]
        _, p, n, m = max(worth, key=lambda x: ((x[1] - x[2]) / max(1, x[1] + x[2]), x[1], -x[3]))
        if not p or p < precision * (p + n):
            break
        rules.append(tuple(rule[:m]))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that a row meets, from 1; null for none."""
    out = None
    for k, rule in enumerate(rules, 1):
        met = all_of([c.on_measures() for c in rule])
        out = F.when(met, k) if out is None else out.when(met, k)
    return F.lit(None).cast("int") if out is None else out


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, and the rule that rejects a document."""
    stats = staged(statistics(docs), "statistics")
    out = stats.withColumn("rule", verdict(learn(stats, labels)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & F.col("rule").isNull()).alias("kept"), "rule",
    )
