"""Fill-in-the-middle, divergence audit and language identification against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from data import KIND, SF, documents, empty, rows

from custodia.llm import kneser_ney_langid, source_divergence, swar_fim

ALPHABET = "ab \n<PSM>éßжあ𐍈🙂"


def made_texts(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choices(ALPHABET, k=r.choice([0, 1, 2, 7, 8, 9, 30, 200]))) for _ in range(n)]


def plain_fim(doc_id, text):
    t, h = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(t), "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return len(t), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(t), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fim_equals_plain_cuts(spark):
    own = [*rows(), *[(k + 1000, t, *[None] * 9) for k, t in enumerate(made_texts(600, 3))]]
    docs = spark.createDataFrame(own, KIND)
    made = swar_fim.transformed(docs)
    assert Counter(map(tuple, made.collect())) == Counter((r[0], *plain_fim(r[0], r[1])) for r in own)
    back = swar_fim.restored(made).select("doc_id", "text").collect()
    assert Counter(map(tuple, back)) == Counter((r[0], r[1] or "") for r in own)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = Counter((r[0], *plain_fim(r[0], r[1])[:4], sha(plain_fim(r[0], r[1])[4]), sha(r[1] or "")) for r in own)
    assert Counter(map(tuple, swar_fim.digest(docs).collect())) == expected
    assert swar_fim.digest(empty(spark)).count() == 0


def test_words_of_bytes_find_every_code_point():
    texts = made_texts(200, 9)
    whole = "".join(texts)
    ranks = swar_fim.Ranks(np.frombuffer(whole.encode(), np.uint8))
    borders = np.cumsum([0, *[len(c.encode()) for c in whole]])
    assert (ranks.border(np.arange(len(whole) + 1)) == borders).all()
    assert (ranks.before(borders) == np.arange(len(whole) + 1)).all()
    sliced = pa.array(texts).slice(37, 90)  # an array that does not begin where its buffer does
    n, *_, begin, one, two, end = swar_fim.cuts(sliced, np.arange(90), np.arange(90)[::-1].copy())
    assert n.tolist() == [len(t) for t in sliced.to_pylist()] and (begin <= one).all() and (one <= two).all() and (two <= end).all()
    for n in (0, 1, 8):
        empty_ranks = swar_fim.Ranks(np.full(n, 97, np.uint8))
        assert empty_ranks.before(np.array([n])).tolist() == [n]


WORDS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def plain_audit(docs, least, top=10):
    """docs: (text, lang, source)."""
    at = [((x or ""), (g or ""), (s or "")) for x, g, s in docs]
    out = []
    for lang in {g for _, g, _ in at}:
        counts, seen = defaultdict(Counter), Counter()
        for t, g, s in at:
            if g == lang:
                w = WORDS.findall(t.translate(LOWER))
                counts[s].update(w)
                seen.update(set(w))
        kept = [w for w, n in seen.items() if n >= least]
        share = lambda c, total: 1 + 10**9 * (c + 2) // (total + 2 * len(kept))
        total = {s: sum(c[x] for x in kept) for s, c in counts.items()}
        p = {s: {w: share(c[w], total[s]) for w in kept} for s, c in counts.items()}
        q = {w: share(sum(c[w] for c in counts.values()), sum(total.values())) for w in kept}
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in p:
            found = {"pair": [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in p if o != s]}
            found["term"] = sorted(((w, f(p[s][w], q[w])) for w in kept if counts[s][w] and p[s][w] > q[w]), key=lambda x: (-x[1], x[0].encode()))[:top]
            for part, x in found.items():
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(sorted(x, key=lambda x: (-x[1], x[0].encode())), 1)]
    return Counter(out)


@pytest.mark.parametrize("tile,cells", [(256, 1 << 21), (2, 9)])
def test_audit_equals_plain_counts(spark, monkeypatch, tile, cells):
    monkeypatch.setattr(source_divergence, "TILE", tile)
    monkeypatch.setattr(source_divergence, "CELLS", cells)
    monkeypatch.setattr(source_divergence, "HELD", 50)
    r = random.Random(7)
    own = [(k, " ".join(r.choices(["One", "two", "Été", "été", "x-y", "Z9z", "\x00", "é" * 3, "four_five"], k=r.randint(0, 12))), r.choice(["a", "b", "b", None]), r.choice(["s1", "s2", "", None, "ß", "🙂"])) for k in range(150)]
    own += [(1, "alone", "one source", "s"), (2, None, "no words", "s"), (3, " 12 ", "no words", "t"), (3, " 12 ", "no words", "t")]
    docs = spark.createDataFrame([(*o, k, k) for k, o in enumerate(own)], "doc_id long, text string, lang string, source string, n long, word int").repartition(3)
    for least in (1, 4):
        got = source_divergence.audit(docs, least).collect()
        assert Counter(map(tuple, got)) == plain_audit([o[1:] for o in own], least)


def test_audit_of_awkward_rows(spark):
    docs = documents(spark)
    got = source_divergence.audit(docs, 2).collect()
    assert Counter(map(tuple, got)) == plain_audit([(r.text, r.lang, r.source) for r in docs.collect()], 2)
    assert source_divergence.audit(empty(spark)).count() == 0
    assert source_divergence.audit(docs.limit(0)).columns == ["lang", "source", "part", "item", "value", "rank"]


def test_shares_are_exact():
    r = random.Random(1)
    pairs = [(2, 2), (1, 10**15), (10**15 - 1, 10**15), (2, 3)] + [(a, a + r.randrange(10**14)) for a in (r.randrange(1, 10**15) for _ in range(500))]
    got = source_divergence.shares(*(np.array(x, np.int64) for x in zip(*pairs, strict=True)))
    assert got.tolist() == [1 + 10**9 * a // b for a, b in pairs]


def symbols_of(text):
    keep = lambda c: unicodedata.category(c)[0] in "LM"
    out = []
    for c in [*(text or ""), " "]:
        s = ord(c.lower()[0]) if keep(c) else 32
        s = s if s < 1 << 16 else 0xE000 + s % 6400
        if s != 32 or (out and out[-1] != 32):
            out.append(s)
    return out


def plain_sequences(text, order=4):
    s = [32] * (order - 1) + symbols_of(text)
    return [tuple(s[i : i + order]) for i in range(len(s) - order + 1)]


class PlainKneserNey:
    """Interpolated Kneser-Ney with one discount for each order, nothing left out."""

    def __init__(self, texts, order=4):
        self.counts = {order: Counter(g for t in texts for g in plain_sequences(t, order))}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.discount, self.total, self.kinds = {}, defaultdict(int), defaultdict(int)
        for k, c in self.counts.items():
            n = Counter(c.values())
            self.discount[k] = min(0.95, n[1] / (n[1] + 2 * n[2])) if n[1] and n[2] else 0.5
            for g, m in c.items():
                self.total[g[:-1]] += m
                self.kinds[g[:-1]] += 1

    def chance(self, g):
        if not g:
            return 2.0**-16
        c = g[:-1]
        if not self.total[c]:
            return self.chance(g[1:])
        d = self.discount[len(g)]
        return max(self.counts[len(g)][g] - d, 0) / self.total[c] + d * self.kinds[c] / self.total[c] * self.chance(g[1:])


def pack(g):
    return sum(s << 16 * k for k, s in enumerate(reversed(g)))


def test_sequences_in_blocks(monkeypatch):
    texts = ["", " ", "a", "Été 12 x", "ab" * 40, " - lead", "𐍈 é", *made_texts(40, 5), ""]
    expected = [(k, pack(g)) for k, t in enumerate(texts) for g in plain_sequences(t)]
    for block in (1 << 20, 16, 5, 1):
        monkeypatch.setattr(kneser_ney_langid, "BLOCK", block)
        got = [(int(a), int(b)) for of, x in kneser_ney_langid.sequences(texts) for a, b in zip(of, x, strict=True)]
        assert got == expected, block
    x = np.random.default_rng(1).integers(0, 1 << 62, 10_000).astype(np.uint64)
    assert len(np.unique(kneser_ney_langid.hashed(x))) == len(np.unique(x))


def test_models_equal_plain_kneser_ney(spark):
    texts = {"a": ["the cat sat on the mat", "That hat!", "the THE then"], "b": ["été à la plage", "la là las 12 é", None]}
    docs = spark.createDataFrame([(g, t) for g, x in texts.items() for t in x if t is not None], "lang string, text string")
    models = kneser_ney_langid.learned(docs)
    assert sorted(models) == ["a", "b"]
    for lang, own in texts.items():
        plain = PlainKneserNey(own)
        for t in ("the cat", "là-bas", "zz zz", "𐍈", "that été"):
            grams = plain_sequences(t)
            got = kneser_ney_langid.chance(models[lang], np.array([pack(g) for g in grams], np.uint64))
            assert np.allclose(got, [plain.chance(g) for g in grams], rtol=1e-9, atol=0)


def test_small_models_are_distributions(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text")
    for size in (1 << 19, 2000, 50):
        models = kneser_ney_langid.learned(d, size)
        assert sum(len(t.hashes) for m in models.values() for t in m) <= size
        tables = models["en"]
        for context in ((32, 116, 104), (32, 32, 32), (97, 98, 99)):
            grams = np.array([pack((*context, s)) for s in range(1 << 16)], np.uint64)
            assert math.isclose(kneser_ney_langid.chance(tables, grams).sum(), 1, rel_tol=1e-6)


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet")
    out = kneser_ney_langid.identified(docs)
    both = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").selectExpr("avg(int(lang = lang_pred)) right", "avg(int(accepted)) accepted", "min(score) low", "max(score) high").first()
    assert both.right > 0.99 and both.accepted > 0.97 and 0 <= both.low <= both.high <= 1
    assert out.count() == docs.count()


def test_rejection_and_awkward_rows(spark):
    base = documents(spark)
    train = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    strange = [(10**6 + k, t, g) for k, (t, g) in enumerate([("qqxz zzkqj wwxv " * 40, "en"), ("", "en"), (None, "fr"), ("12 34 !?", "de"), ("́́", "de"), ("Ж" * 50, None)])]
    docs = train.unionByName(spark.createDataFrame(strange, "doc_id long, text string, lang string"))
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    out = {r.doc_id: r for r in kneser_ney_langid.identified(docs).collect()}
    assert all(r.held_out == held(i) for i, r in out.items())
    taught = [i for i, t, _ in strange if not held(i)]
    assert not out[10**6].accepted or 10**6 in taught
    assert [out[10**6 + k].lang_pred for k in (1, 2, 3, 4)] == ["und"] * 4 and out[10**6 + 5].lang_pred in ("de", "en", "es", "fr")
    got = kneser_ney_langid.identified(base).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in base.collect())
    assert {r.lang_pred for r in got} <= {"en", "und"} and all(0 <= r.score <= 1 for r in got)
    assert kneser_ney_langid.identified(empty(spark)).count() == 0
    nothing = kneser_ney_langid.identified(base.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)} and len(nothing) == base.count()


def test_predictions_use_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    first = {r.doc_id: (r.lang_pred, r.score) for r in kneser_ney_langid.identified(docs).collect()}
    # The labels of rows that nothing is learned from.
    other = docs.withColumn("lang", kneser_ney_langid.F.when(kneser_ney_langid.held_out(docs["doc_id"]), "xx").otherwise(docs["lang"]))
    assert first == {r.doc_id: (r.lang_pred, r.score) for r in kneser_ney_langid.identified(other).collect()}
