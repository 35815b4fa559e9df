"""Packing: deficit round-robin over source queues into token windows of one length.

Each source is a queue of its documents' tokens. In every round a queue earns its share of one
window (its deficit) and sends as many quanta as the deficit holds; what is left is carried on. What
a queue has sent by the end of round r is then a plain function of r, so the deficit at any window
border is known without the windows before it: tasks start anywhere and carry on the same schedule.
The stream of all rounds is cut into windows. All documents are packed, so a queue's target is its
share of all tokens, and all queues end together. The last, partial window is cut into sequences
whose lengths are powers of two, so nothing is padded.

At most REST sources can hold 1 / REST of all tokens each; the others, worth less than a token a
window, form one queue together. It is cut into SLICES: a document goes to the slice in which its
place in its own source falls, so every small source is spread over the whole queue.

Nulls, empties, ties: a null text is an empty one, which still has the end token; a null source is
a source; null or repeated ids are carried on, rows are packed one by one. Within a queue documents
follow the order in which the tokenized table holds them. An empty table gives no pieces. Columns
other than doc_id, text and source are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import small_batches, staged

REST = 4096
SLICES = 4096
#: Chunks that a worker remembers, about 200 bytes each.
CACHE = 400_000
#: Chunks whose tokens depend on nothing but letter runs, digits and symbols (no apostrophes, no
#: special tokens, no character that normalizing could join or replace).
PLAIN = re.compile(r"[a-z0-9!-&(-/:;=-@\[-`{-~ß-öø-ÿ]+")
#: A line break that a normalizer could join with what follows it.
JOINED = re.compile(r"\n[^\x00-\xff]")
#: Its pieces: letter runs, single digits, symbol runs.
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The printable characters that byte-level vocabularies use for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Tokens:
    """Ids of texts. A chunk between blanks has the same ids everywhere, so they are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = byte_letters()
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self.chunks: dict[str, bytes] = {"": b""}  # the ids of each, as bytes

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def piece(self, x: str) -> bytes:
        """Of a letter run, a digit or a symbol run."""
        if (ids := self.chunks.get(x)) is None:
            shown = x if x.isascii() else "".join(map(self.letters.__getitem__, x.encode()))
            ids = self.chunks[x] = self.packed([t.id for t in self.model.tokenize(shown)])
        return ids

    def learn(self, x: str) -> None:
        if x.isalpha() and PLAIN.fullmatch(x):
            self.piece(x)
        elif PLAIN.fullmatch(x):
            self.chunks[x] = b"".join(map(self.piece, PIECES.findall(x)))
        else:
            self.chunks[x] = self.packed(self.whole.encode(x, add_special_tokens=False).ids)

    def ids(self, text: str, end: int) -> bytes:
        try:
            text.encode("latin-1")
            text = text.lower()  # as the tokenizer does; one character stays one character here
        except UnicodeEncodeError:
            pass
        if "\n" in text and not JOINED.search(text):  # blanks are dropped, so any of them may divide
            text = text.replace("\n", " ")
        chunks = text.split(" ")
        if len(self.chunks) > CACHE:
            self.chunks = {"": b""}
        known = self.chunks
        for x in set(chunks).difference(known):
            self.learn(x)
        return b"".join(map(known.__getitem__, chunks)) + self.packed([end])


HELD: dict[str, Tokens] = {}  # of this worker; tasks that follow use it again


def tokenizer(path: str) -> Tokens:
    if path not in HELD:
        HELD[path] = Tokens(path)
    return HELD[path]


TOKENIZED = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("part", pa.int32()), ("start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])


def tokenized(docs: DataFrame, path: str, end: int) -> DataFrame:
    """doc_id, source, part, start (tokens of the source in this part before), n, ids as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, sent = tokenizer(path), TaskContext.get().partitionId(), {}
        size = tokens.dtype.itemsize
        for batch in batches:
            sources, texts = batch["source"].to_pylist(), batch["text"]
            for a in range(0, len(sources), 500):
                own, starts = [], []
                for k in range(a, min(a + 500, len(sources))):
                    ids = tokens.ids(texts[k].as_py() or "", end)
                    starts.append(sent.get(sources[k], 0))
                    sent[sources[k]] = starts[-1] + len(ids) // size
                    own.append(ids)
                piece = batch.slice(a, len(own))
                n = pa.array([len(x) // size for x in own], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [piece["doc_id"], piece["source"], pa.array([part] * len(own), pa.int32()), pa.array(starts, pa.int64()), n, pa.array(own, pa.binary())],
                    schema=TOKENIZED,
                )

    picked = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return picked.mapInArrow(run, "doc_id long, source string, part int, start long, n long, ids binary")


class Schedule:
    """What the queues have sent by the end of each round."""

    def __init__(self, totals: list[int], window: int, quantum: int):
        self.totals, self.window, self.quantum = np.array(totals, dtype=np.int64), window, quantum
        self.total = int(self.totals.sum())
        self.rounds = max(1, -(-self.total // window))
        #: Tokens that a queue earns in a round, in units of 2^-16, rounded up so that none is left.
        self.earns = np.array([-(-(int(t) << 16) // self.rounds) for t in totals], dtype=np.int64)
        self.unit, self.half = quantum << 16, quantum << 15
        self.full = self.total // window
        left, self.tail = self.total - self.full * window, []
        while left:
            self.tail.append(1 << (left.bit_length() - 1))
            left -= self.tail[-1]

    def sent(self, r: np.ndarray) -> np.ndarray:
        """Tokens of each queue (columns) in the rounds before r (rows)."""
        out = np.minimum(self.totals, self.quantum * ((r[:, None] * self.earns + self.half) // self.unit))
        out[r <= 0] = 0
        out[r >= self.rounds] = self.totals
        return out

    def round_of(self, queue: np.ndarray, quantum: np.ndarray) -> np.ndarray:
        """The round that sends a quantum of a queue."""
        need = (quantum + 1) * self.unit - self.half
        return np.clip(-(-need // self.earns[queue]), 1, self.rounds) - 1

    def places(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Positions in the stream of all rounds of the tokens `at` of queues."""
        rounds = self.round_of(queue, at // self.quantum)
        distinct, of = np.unique(rounds, return_inverse=True)
        out = np.empty(len(at), dtype=np.int64)
        order = np.argsort(of, kind="stable")
        for a in range(0, len(distinct), 512):
            r = distinct[a : a + 512]
            before, after = self.sent(r), self.sent(r + 1)
            step = after - before
            base = before.sum(axis=1, keepdims=True) + np.cumsum(step, axis=1) - step - before
            lo, hi = np.searchsorted(of[order], [a, a + len(r)])
            own = order[lo:hi]
            out[own] = base[of[own] - a, queue[own]] + at[own]
        return out

    def pieces(self, queue: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, start, length, sequence, offset) of documents that lie at `at` in their queues."""
        q = self.quantum
        first, count = at // q, (at + n - 1) // q - at // q + 1
        row = np.repeat(np.arange(len(at)), count)
        k = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        begin = np.maximum(k * q, at[row])
        length = np.minimum((k + 1) * q, (at + n)[row]) - begin
        place = self.places(queue[row], begin)
        # Quanta that follow each other in the stream are one piece, up to the next window.
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + length[:-1])
        head = np.flatnonzero(new)
        length = np.add.reduceat(length, head) if len(head) else length
        row, begin, place = row[head], begin[head] - at[row[head]], place[head]
        borders = self.full * self.window + np.concatenate([[0], np.cumsum(self.tail)]).astype(np.int64)

        def sequence(p: np.ndarray) -> np.ndarray:
            late = np.searchsorted(borders, p, side="right") - 1
            return np.where(p < borders[0], p // self.window, self.full + np.maximum(late, 0))

        cuts = sequence(place + length - 1) - sequence(place) + 1
        source = np.repeat(np.arange(len(row)), cuts)
        s = sequence(place)[source] + np.arange(len(source)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        late = np.clip(s - self.full, 0, max(0, len(borders) - 1))
        opens = np.where(s < self.full, s * self.window, borders[late])
        closes = np.where(s < self.full, (s + 1) * self.window, borders[np.minimum(late + 1, len(borders) - 1)])
        a = np.maximum(opens, place[source])
        b = np.minimum(closes, (place + length)[source])
        return row[source], begin[source] + a - place[source], b - a, s, a - opens


def sliced(held: DataFrame, sums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """held with the slice of each document of the small sources that sums lists (-1 for others), and
    for each part, source and slice the place in the shared queue of the source's first token there.

    Only counts are summed; what one window sees are the parts of a small source, the groups of one
    slice, or the slices.
    """
    one = Window.partitionBy("source").orderBy("part")
    ahead = F.coalesce(F.sum("n").over(one.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = sums.select(F.col("part").alias("__p"), F.col("source").alias("__s"), ahead.alias("ahead"), F.sum("n").over(Window.partitionBy("source")).alias("whole"))
    spans = staged(spans, "spans")
    joined = held.join(spans, (F.col("part") == F.col("__p")) & F.col("source").eqNullSafe(F.col("__s")), "left")
    place = F.floor((F.col("ahead") + F.col("start")) * F.lit(SLICES) / F.col("whole")).cast("int")
    joined = joined.select(*held.columns, F.coalesce(place, F.lit(-1)).alias("slice"))
    groups = joined.where("slice >= 0").groupBy("slice", "part", "source").agg(F.sum("n").alias("n"), F.min("start").alias("first"))
    groups = staged(groups, "slices")
    inside = Window.partitionBy("slice").orderBy(F.xxhash64("source"), F.col("source").asc_nulls_first(), "part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # SLICES rows at most
    offsets = groups.groupBy("slice").agg(F.sum("n").alias("n")).select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    base = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)) - F.col("first")
    return joined, groups.join(offsets, "slice").select("slice", "part", "source", base.alias("base"))


PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def pack(docs: DataFrame, path: str, end: int = 1, window: int = 2048, quantum: int = 32, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: where each lies in its document and in which sequence."""
    small_batches(docs.sparkSession)
    held = staged(tokenized(docs, path, end), "tokens")
    sums = staged(held.groupBy("part", "source").agg(F.sum("n").alias("n")), "sums")
    total = sums.agg(F.sum("n")).first()[0] or 0
    kind = PACKED + (", ids array<int>" if with_ids else "")
    if not total:
        return docs.sparkSession.createDataFrame([], kind)
    large = sums.groupBy("source").agg(F.sum("n").alias("n")).where(F.col("n") * REST >= total).collect()  # REST rows at most
    large.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    totals = [r["n"] for r in large]
    totals.append(total - sum(totals))
    schedule, rest = Schedule(totals, window, quantum), len(large)
    queues = docs.sparkSession.createDataFrame([(r["source"], k) for k, r in enumerate(large)], "name string, queue int")
    at = sums.join(F.broadcast(queues), F.col("source").eqNullSafe(F.col("name")), "left").select("part", "source", "n", "queue")
    own = at.where("queue is not null")
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    own = own.select("part", "source", F.lit(-1).alias("slice"), "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if totals[-1]:
        held, shared = sliced(held, at.where("queue is null").select("part", "source", "n"))
        own = own.unionByName(shared.select("part", "source", "slice", F.lit(rest).alias("queue"), "base"))
    else:
        held = held.withColumn("slice", F.lit(-1))
    at = staged(own.select(F.col("part").alias("__part"), F.col("source").alias("__source"), F.col("slice").alias("__slice"), "queue", "base"), "queues")
    # Small enough to be broadcast or not: Spark decides by the size of the written table.
    same = (F.col("part") == F.col("__part")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("slice") == F.col("__slice"))
    placed = held.join(at, same).select("doc_id", "source", "queue", (F.col("base") + F.col("start")).alias("at"), "n", "ids")
    out = pa.schema([(c, pa.string() if c == "source" else pa.int64()) for c in PACKED.replace(",", "").split()[::2]] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = tokenizer(path).dtype
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                own = batch.slice(a, 500)
                n = own["n"].to_numpy()
                ids = [np.frombuffer(x.as_buffer(), dtype=dtype).astype("<u4") for x in own["ids"]]
                row, start, length, sequence, offset = schedule.pieces(own["queue"].to_numpy().astype(np.int64), own["at"].to_numpy(), n)
                cut = [ids[i][s : s + m] for i, s, m in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
                columns = [
                    own["doc_id"].take(pa.array(row)), start, length, np.array([zlib.crc32(x) for x in cut], dtype=np.int64),
                    n[row], sequence, offset, own["source"].take(pa.array(row)),
                ]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in columns], schema=out)

    return placed.mapInArrow(run, kind)
