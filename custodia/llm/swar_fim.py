"""Fill-in-the-middle: texts cut at code points, found in their UTF-8 bytes a word at a time.

The bytes of a batch of texts are viewed as uint64 words. Arithmetic on whole words marks the bytes
that end a code point (those before a byte that is no continuation), bitwise_count counts the marks
of a word, and their running sum ranks every word. The k-th code point of a text is found by a
search in the running sum, which gives the word, and a select inside the word: prefix sums by one
multiplication, compared in all eight bytes at once. No text is decoded, and a text's length in
bytes is of no concern to its cuts.

A text of n code points, matched left to right, is cut after the smaller and the larger of
h1 % (n + 1) and h2 % (n + 1); h1 to h4 are the first four groups of eight digits of the hex SHA-256
of "seed:id". The form is plain if the text is empty, holds a sentinel, or h3 % 100 >= rate;
otherwise spm if h4 % 100 < spm_rate, else psm.

Nulls, empties, ties: a null text is an empty one, which stays plain; a null id is hashed as an
empty string, and held as null. Equal ids are cut alike where their texts are equal. Rows stay rows,
repeated or not. An empty table gives an empty result. Columns of the documents other than doc_id and
text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ONES = np.uint64(0x0101010101010101)
TOPS = np.uint64(0x8080808080808080)


def u64(x: int) -> np.uint64:
    return np.uint64(x)


def ending_marks(raw: np.ndarray) -> np.ndarray:
    """Words whose bytes are 1 where a code point ends, 0 elsewhere; raw is padded with zeros to words.

    A continuation has its upper two bits at 10. A byte ends a code point if the next one, which may
    lie in the next word, is none; what follows the last byte counts as none.
    """
    w = raw.view("<u8")
    begins = ~((w >> u64(7)) & ~(w >> u64(6))) & ONES
    following = np.empty_like(begins)
    following[:-1], following[-1:] = begins[1:], 1
    return (begins >> u64(8)) | (following << u64(56))


class Ranks:
    """Counts of code points in the bytes of one buffer, and where the k-th ends."""

    def __init__(self, raw: np.ndarray):
        padded = np.zeros((len(raw) // 8 + 1) * 8, np.uint8)
        padded[: len(raw)] = raw
        self.marks = ending_marks(padded)
        self.sums = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)

    def before(self, at: np.ndarray) -> np.ndarray:
        """Code points that end in the bytes before `at`, which must be a border."""
        word = at >> 3
        inside = self.marks[word] & ((u64(1) << ((at & 7) * 8).astype(np.uint64)) - u64(1))
        return np.where(word > 0, self.sums[word - 1], 0) + np.bitwise_count(inside)

    def border(self, k: np.ndarray) -> np.ndarray:
        """The byte after the k-th code point of the buffer, from 1; 0 for k = 0."""
        word = np.searchsorted(self.sums, k, side="left")
        word = np.minimum(word, len(self.marks) - 1)
        rest = (k - np.where(word > 0, self.sums[word - 1], 0)).astype(np.uint64)
        prefix = self.marks[word] * ONES  # byte j: marks in bytes 0 .. j, eight at most
        reached = ((prefix | TOPS) - rest * ONES) & TOPS  # top bit of byte j: prefix >= rest
        return np.where(k > 0, word * 8 + 9 - np.bitwise_count(reached).astype(np.int64), 0)


def cuts(texts: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """(n, first, second, begin, one, two, end): code points of each text, units before the first and
    the second cut, and the bytes of the buffer where the text begins, is cut and ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    raw = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    begin, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    ranks = Ranks(raw)
    base = ranks.before(begin)
    n = ranks.before(end) - base
    a, b = h1 % (n + 1), h2 % (n + 1)
    first, second = np.minimum(a, b), np.maximum(a, b)
    one = np.where(first > 0, ranks.border(base + first), begin)
    two = np.where(second > 0, ranks.border(base + second), begin)
    return n, first, second, begin, one, two, end


def held_words(texts: pa.Array) -> np.ndarray:
    found = np.zeros(len(texts), bool)
    for x in (PREFIX, SUFFIX, MIDDLE):
        found |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
    return found


MADE = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("output", pa.string()),
])


def transformed(docs: DataFrame, seed: int = 1, rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """doc_id, n, form, prefix_chars and middle_chars (null if plain), and output of every row."""
    small_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), digest.alias("h"))
    part = lambda k: F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}")
    rows = rows.select("doc_id", "text", *map(part, range(4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch["text"].cast(pa.string())
            h1, h2, h3, h4 = (batch[f"h{k}"].to_numpy() for k in range(1, 5))
            n, first, second, begin, one, two, end = cuts(texts, h1, h2)
            plain = (n == 0) | (h3 % 100 >= rate) | held_words(texts)
            spm = ~plain & (h4 % 100 < spm_rate)
            offsets = np.frombuffer(texts.buffers()[1], np.int32)
            raw = memoryview(texts.buffers()[2] or b"")[offsets[texts.offset] :]
            pieces: list = []
            size = end - begin + np.where(plain, 0, len(p) + len(s) + len(m))
            for k, (x, a, b, z) in enumerate(zip(begin.tolist(), one.tolist(), two.tolist(), end.tolist(), strict=True)):
                if plain[k]:
                    pieces.append(raw[x:z])
                elif spm[k]:
                    pieces += (s, raw[b:z], p, raw[x:a], m, raw[a:b])
                else:
                    pieces += (p, raw[x:a], s, raw[b:z], m, raw[a:b])
            borders = np.concatenate([[0], np.cumsum(size)])
            if borders[-1] < 1 << 31:
                output = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(b"".join(pieces))])
            else:  # beyond what one array of strings holds
                output = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(borders), pa.py_buffer(b"".join(pieces))])
            form = pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string())
            columns = [batch["doc_id"], pa.array(n), form, pa.array(first, mask=plain), pa.array(second - first, mask=plain)]
            if output.type == pa.string():
                yield pa.RecordBatch.from_arrays([*columns, output], schema=MADE)
            else:
                for k in range(len(texts)):
                    yield pa.RecordBatch.from_arrays([*[c.slice(k, 1) for c in columns], output.slice(k, 1).cast(pa.string())], schema=MADE)

    kind = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, kind)


def restored(made: DataFrame) -> DataFrame:
    """made with the texts that its outputs were made of, read from output and form alone.

    A transformed text holds no sentinel of its own, and a sentinel's first character occurs in it only
    there, so that what lies beside one cannot complete another.
    """
    piece = lambda text, mark, n: F.call_function("substring_index", text, mark, F.lit(n))
    own = made.columns
    body = made.withColumn("__body", F.substr("output", F.lit(len(PREFIX) + 1)))
    second = F.when(F.col("form") == "psm", SUFFIX).otherwise(PREFIX)
    ends = body.withColumns({"__left": piece(F.col("__body"), second, 1), "__last": piece(F.col("__body"), F.lit(MIDDLE), -1)})
    n = F.length("__body") - F.length("__left") - F.length("__last") - len(SUFFIX) - len(MIDDLE)
    whole = ends.withColumn("__right", F.substr("__body", F.length("__left") + len(SUFFIX) + 1, n))
    text = F.when(F.col("form") == "plain", F.col("output")).when(F.col("form") == "psm", F.concat("__left", "__last", "__right")).otherwise(F.concat("__right", "__last", "__left"))
    return whole.select(*own, text.alias("text"))


def digest(docs: DataFrame, seed: int = 1) -> DataFrame:
    """transformed() with the hashes of the outputs and of the texts restored from them."""
    return restored(transformed(docs, seed)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("text", 256).alias("restored_sha256"),
    )


def digest_sql(seed: int = 1, rate: int = 90, spm_rate: int = 20) -> str:
    part = lambda k: f"cast('0x' || substr(h, {8 * k + 1}, 8) as bigint)"
    return f"""
    with hashed as (
        select doc_id, coalesce(text, '') as t, sha256('{seed}:' || coalesce(cast(doc_id as varchar), '')) as h from documents
    ), cut as (
        select doc_id, t, length(t) as n, {part(0)} % (length(t) + 1) as a, {part(1)} % (length(t) + 1) as b,
            case when t = '' or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}') or {part(2)} % 100 >= {rate} then 'plain'
                 when {part(3)} % 100 < {spm_rate} then 'spm' else 'psm' end as form
        from hashed
    ), pieces as (
        select doc_id, t, n, form, least(a, b) as i, greatest(a, b) as j, substr(t, 1, least(a, b)) as p,
            substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) as m, substr(t, greatest(a, b) + 1) as s
        from cut
    )
    select doc_id, n, form, case when form <> 'plain' then i end as prefix_chars, case when form <> 'plain' then j - i end as middle_chars,
        sha256(case form when 'plain' then t when 'psm' then '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
               else '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m end) as output_sha256,
        sha256(t) as restored_sha256
    from pieces
    """
