"""Mixing sources to target weights: min-cost flow from membership patterns to source quotas.

A document may belong to several sources. Documents are added up by pattern (their set of sources).
A pattern sends words to the quotas of its sources; the first time its words are used costs nothing,
each repetition more than the one before. The flow says how many words a pattern gives; they are
taken from its documents in whole rounds, and a last part of a round from documents in the order of
a seeded hash, up to a cut that a histogram of the hashes finds.

Patterns and sources are what a mixture is set up with; their sums, not documents, are all that the
driver sees.

Nulls, empties, ties: a null or empty text has size 0 and nothing is taken from it. A null source is
a source, last in order; null ids are hashed like any other, together with source and text length.
Rows that agree in id, source and size are taken alike. Without words every target is 0. Columns
named like results are replaced.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import staged, words

MAX_REPEATS = 3
BUCKET_BITS = 16


def cycling(k: int) -> float:
    """Weights 1, 2, 3, repeating, by a source's place in order."""
    return k % 3 + 1.0


def quotas(sizes: list[int], weights: list[float], repeats: int, total: int) -> list[float]:
    """Shares of the total by weight; what is above `repeats` times a size is shared out again."""
    out, open_, left = [0.0] * len(sizes), [k for k in range(len(sizes))], float(total)
    while open_:
        scale = left / (sum(weights[k] for k in open_) or 1.0)
        above = [k for k in open_ if scale * weights[k] > repeats * sizes[k]]
        if not above:
            for k in open_:
                out[k] = scale * weights[k]
            break
        for k in above:
            out[k] = float(repeats * sizes[k])
            left -= out[k]
        open_ = [k for k in open_ if k not in set(above)]
    return out


def min_cost_flow(patterns: list[tuple[tuple[int, ...], int]], needs: list[int], repeats: int) -> list[dict[int, int]]:
    """Words that each pattern (its sources, its words) sends to each source.

    Only the use of a pattern has a cost, and each further use costs more. Filling as much as can be
    with one use, then with two, and so on, rerouting along residual edges, is then cheapest: an
    augmenting path never takes a pattern's words back.
    """
    sent: list[dict[int, int]] = [{} for _ in patterns]
    left, givers = list(needs), [set() for _ in needs]

    def push(p: int, s: int, n: int) -> None:
        sent[p][s] = sent[p].get(s, 0) + n
        givers[s].add(p)
        if not sent[p][s]:
            del sent[p][s]
            givers[s].discard(p)

    for use in range(1, repeats + 1):
        supply = [use * size - sum(f.values()) for (_, size), f in zip(patterns, sent, strict=True)]
        for p in sorted(range(len(patterns)), key=lambda p: len(patterns[p][0])):
            for s in patterns[p][0]:
                n = min(supply[p], left[s])
                if n > 0:
                    push(p, s, n)
                    supply[p] -= n
                    left[s] -= n
        for p in range(len(patterns)):
            while supply[p] > 0:
                came: dict[int, tuple[int, int]] = {}  # source: the pattern and the source before it
                queue, goal = deque(), None
                for s in patterns[p][0]:
                    came[s] = (p, -1)
                    queue.append(s)
                while queue and goal is None:
                    s = queue.popleft()
                    if left[s] > 0:
                        goal = s
                        break
                    for other in givers[s]:
                        for t in patterns[other][0]:
                            if t not in came:
                                came[t] = (other, s)
                                queue.append(t)
                if goal is None:
                    break
                path, s = [], goal
                while s >= 0:
                    path.append((came[s][0], came[s][1], s))
                    s = came[s][1]
                n = min([supply[p], left[goal], *(sent[q][a] for q, a, _ in path if a >= 0)])
                for q, a, b in path:
                    push(q, b, n)
                    if a >= 0:
                        push(q, a, -n)
                supply[p] -= n
                left[goal] -= n
    return sent


def with_takes(
    docs: DataFrame, membership: Column, seed: int = 4, repeats: int = MAX_REPEATS, weight: Callable[[int], float] = cycling
) -> DataFrame:
    """docs with size, pattern, taken, and per document the sums and targets of its sources.

    membership: array<string>, the sources of a document; null stands for a source without name.
    weight: of the k-th source in code point order, null last.
    """
    spark = docs.sparkSession
    size = F.size(words(F.col("text"))).cast("long")
    spread = F.abs(F.xxhash64(F.lit(seed), "doc_id", membership, F.length("text")) % F.lit(1 << 62))
    marked = docs.withColumns({"size": size, "__pattern": F.array_sort(F.array_distinct(membership)), "__h": spread})
    narrow = staged(marked.select("__pattern", "size", "__h"), "sizes")
    sums = [(r["__pattern"], r["n"]) for r in narrow.groupBy("__pattern").agg(F.sum("size").alias("n")).collect()]
    names = sorted({s for p, _ in sums for s in p}, key=lambda s: (s is None, s or ""))
    place = {s: k for k, s in enumerate(names)}
    sizes = [0] * len(names)
    for p, n in sums:
        for s in p:
            sizes[place[s]] += n
    total = sum(n for _, n in sums)
    targets = quotas(sizes, [weight(k) for k in range(len(names))], repeats, total)
    order = sorted(sums, key=lambda x: [(s is None, s or "") for s in x[0]])
    flow = min_cost_flow([(tuple(place[s] for s in p), n) for p, n in order], [round(t) for t in targets], repeats)
    rows = []
    for (p, n), f in zip(order, flow, strict=True):
        use = sum(f.values())
        rows.append((p, use // n if n else 0, use % n if n else 0, [sizes[place[s]] for s in p], [targets[place[s]] for s in p]))
    plan = spark.createDataFrame(rows, "__p array<string>, __whole long, __part long, __sizes array<long>, __targets array<double>")
    plan = staged(plan, "plan")
    # The cut in the order of the hash: first its bucket, from sums by bucket, then the document.
    same = F.col("__pattern") == F.col("__p")
    bucket = F.shiftright("__h", 62 - BUCKET_BITS)
    by_pattern = Window.partitionBy("__pattern")
    filled = narrow.groupBy("__pattern", bucket.alias("__b")).agg(F.sum("size").alias("n"))
    filled = filled.withColumn("__end", F.sum("n").over(by_pattern.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)))
    crossed = filled.join(plan, same).where((F.col("__end") > F.col("__part")) & (F.col("__end") - F.col("n") <= F.col("__part")))
    crossed = crossed.select("__p", F.col("__b").alias("__cross"), (F.col("__part") - F.col("__end") + F.col("n")).alias("__room"))
    crossed = staged(crossed, "crossed")
    inside = narrow.where("size > 0").join(crossed, same & (bucket == F.col("__cross"))).groupBy("__pattern", "__h").agg(F.sum("size").alias("n"), F.first("__room").alias("__room"))
    inside = inside.withColumn("__end", F.sum("n").over(by_pattern.orderBy("__h").rowsBetween(Window.unboundedPreceding, 0)))
    cuts = inside.where(2 * F.col("__end") - F.col("n") <= 2 * F.col("__room")).groupBy("__pattern").agg(F.max("__h").alias("__cut"))
    floor = crossed.select("__p", (F.shiftleft(F.col("__cross"), 62 - BUCKET_BITS) - 1).alias("__floor"))
    cuts = floor.join(cuts, same, "left").select(F.col("__p").alias("__q"), F.coalesce("__cut", "__floor").alias("__cut"))
    plan = staged(plan.join(cuts, F.col("__p") == F.col("__q"), "left").drop("__q"), "cuts")
    out = marked.join(plan, same, "left")
    times = F.col("__whole") + F.when((F.col("__part") > 0) & (F.col("__h") <= F.col("__cut")), 1).otherwise(0)
    return out.withColumn("taken", F.col("size") * times)


def mixed(docs: DataFrame, seed: int = 4) -> DataFrame:
    """doc_id, size, source_size, target and taken, with one source for each document."""
    own = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    out = with_takes(own, F.array("source"), seed)
    return out.select("doc_id", "size", F.col("__sizes")[0].alias("source_size"), F.col("__targets")[0].alias("target"), "taken", "source")


def repeated(docs: DataFrame, seed: int = 4) -> DataFrame:
    """The mix itself: docs as often as they are taken."""
    hidden = {c: f"__own{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "source", "text")}
    own = docs.withColumnsRenamed(hidden)
    out = with_takes(own, F.array(F.col("source").cast("string")), seed)
    out = out.where("taken > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.expr("taken div size"))))
    return out.select(*[F.col(hidden.get(c, c)).alias(c) for c in docs.columns])
