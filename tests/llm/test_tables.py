"""Operators on tables against brute force, and the pipeline."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from data import SF, documents, empty
from pyspark.sql import functions as F

import corpus_pipeline
from custodia.llm import drr_packing, flow_mixing, histogram_topk, merkle_fixity, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", params=["given", "awkward"])
def docs(spark, request):
    return spark.read.parquet(f"{SF}/documents.parquet") if request.param == "given" else documents(spark)


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_matches_its_check(spark, name):
    con, sf = duckdb.connect(), SF.replace("0.001", "0.01")
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    out = registry.queries()[name](spark, sf)
    expected = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(out.columns)
    assert Counter(tuple(r) for r in out.select(*[f"`{c}`" for c in names]).collect()) == Counter(expected.fetchall()) and out.count() > 0


def test_targets_and_takes(docs):
    rows = docs.collect()
    size = [len(WORD.findall(r.text or "")) for r in rows]
    total, of = sum(size), defaultdict(int)
    for r, n in zip(rows, size, strict=True):
        of[r.source] += n
    names = sorted(of, key=lambda s: (s is None, s or ""))
    weight, target, left, open_ = {s: k % 3 + 1 for k, s in enumerate(names)}, {}, total, set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * of[s]}
        target |= {s: 3 * of[s] if above else share[s] for s in above or open_}
        left -= sum(3 * of[s] for s in above)
        open_ = open_ - above if above else set()
    got = flow_mixing.mixed(docs).collect()
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter((r.doc_id, n, of[r.source]) for r, n in zip(rows, size, strict=True))
    took, largest = defaultdict(int), max(size)
    for r in got:
        assert r.taken <= 3 * r["size"] and abs(r.target - target[r.source]) < 1e-6 * max(1, total)
        took[r.source] += r.taken
    assert all(abs(took[s] - target[s]) <= largest for s in names)
    assert Counter(got) == Counter(flow_mixing.mixed(docs).collect())


def test_mix_repeats_rows(spark):
    docs = documents(spark)
    out = flow_mixing.repeated(docs)
    times = {(r.doc_id, r["size"], r.source): r.taken // r["size"] for r in flow_mixing.mixed(docs).collect() if r["size"]}
    assert out.columns == docs.columns
    seen = Counter(r.doc_id for r in out.collect() if r.doc_id is not None and r.doc_id not in (5, 6))
    assert seen == {i: n for (i, _, _), n in times.items() if n and i is not None and i not in (5, 6)}
    assert flow_mixing.mixed(empty(spark)).count() == 0 and flow_mixing.repeated(empty(spark)).count() == 0


def test_flow_is_cheapest():
    """Against all integer flows of small networks."""
    r = np.random.default_rng(2)
    for _ in range(40):
        patterns = [(p, int(r.integers(1, 3))) for p in ((0,), (0, 1), (1, 2)) if r.random() < 0.9]
        needs, repeats = [int(x) for x in r.integers(0, 4, 3)], 2
        if not patterns:
            continue
        best = (0, 0)
        choices = [[f for f in itertools.product(*[range(min(repeats * n, needs[s]) + 1) for s in p]) if sum(f) <= repeats * n] for p, n in patterns]
        for flow in itertools.product(*choices):
            got = [0] * 3
            for (p, _), f in zip(patterns, flow, strict=True):
                for s, x in zip(p, f, strict=True):
                    got[s] += x
            if all(a <= b for a, b in zip(got, needs, strict=True)):
                cost = sum(max(0, sum(f) - n) for (_, n), f in zip(patterns, flow, strict=True))
                best = max(best, (sum(got), -cost))
        mine = flow_mixing.min_cost_flow(patterns, needs, repeats)
        used = [sum(f.values()) for f in mine]
        assert (sum(used), -sum(max(0, u - n) for u, (_, n) in zip(used, patterns, strict=True))) == best


def test_packing(docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(registry.tokenizer_path())
    pieces = drr_packing.pack(docs, registry.tokenizer_path(), with_ids=True).collect()
    ids = Counter(tuple([*whole.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect())
    lengths, seqs, at = defaultdict(int), defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) > 0 and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        seqs[p.sequence_id].append((p.offset, p.length))
        at[p.doc_id].append(p)
    for x in seqs.values():
        end = 0
        for offset, length in sorted(x):
            assert offset == end
            end += length
        assert end == 2048 or end & (end - 1) == 0 and end < 2048
    assert sorted(seqs) == list(range(len(seqs)))
    for r in docs.collect():
        own = at[r.doc_id]
        if sum(p.length for p in own) == own[0].doc_tokens:  # ids that do not repeat
            made = tuple(i for p in sorted(own, key=lambda p: p.start) for i in p.ids)
            assert ids[made] > 0
        lengths[r.doc_id] += 1
    assert sum(p.length for p in pieces) == sum(len(k) * n for k, n in ids.items())


def test_every_window_has_the_mixture():
    totals = [60_000, 9_000, 400, 31_000]
    s = drr_packing.Schedule(totals, 2048, 32)
    inside = np.zeros((s.full + len(s.tail), len(totals)))
    for q, t in enumerate(totals):
        _, _, n, seq, _ = s.pieces(np.array([q]), np.array([0]), np.array([t]))
        np.add.at(inside[:, q], seq, n)
    share = np.array(totals) / sum(totals)
    assert np.abs(inside[: s.full] - 2048 * share).max() <= 3 * 32
    assert inside.sum() == sum(totals)


def test_packing_many_sources_and_none(spark):
    docs = spark.createDataFrame([(i, f"text number {i}", f"s{i}") for i in range(300)], "doc_id long, text string, source string").repartition(5)
    out = drr_packing.pack(docs, registry.tokenizer_path())
    assert out.select("doc_id").distinct().count() == 300
    assert drr_packing.pack(empty(spark), registry.tokenizer_path()).count() == 0


def vectors(spark):
    r = np.random.default_rng(4)
    v = [(i, r.normal(size=6).astype(float).tolist(), 0, i) for i in range(330)]
    v += [(i, v[7][1], 0, 0) for i in range(400, 500)]  # ties
    v += [(600, None, 0, 0), (601, [1.0, None], 0, 0), (650, [float("nan")] * 6, 0, 0), (603, [], 0, 0), (None, v[0][1], 0, 0), (700, [1.0, 2.0], 0, 0), (750, [1e200] * 6, 0, 0)]
    v += [(701, [3.0, 1.0], 1, 1), v[3], v[50], v[50]]
    return spark.createDataFrame([x for x in v if x[0] != 750], "vec_id long, embedding array<double>, score int, rank int")


def test_search(spark):
    rows = vectors(spark).collect()
    ok = [(r.vec_id, [math.floor(256 * x) for x in r.embedding]) for r in rows if r.vec_id is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)]
    expected = set()
    for q, x in {i: v for i, v in sorted(ok, reverse=True) if i % 50 == 0}.items():
        best = sorted(((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in ok if i != q and len(y) == len(x)))[:5]
        expected |= {(q, k, i, -s) for k, (s, i) in enumerate(best, 1)}
    got = histogram_topk.search(vectors(spark), F.col("vec_id") % 50 == 0).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    assert histogram_topk.search(vectors(spark).limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_fixity(spark):
    kind = "archive string, offset long, length long, digest string, kind int"
    a = [("x", 100 * k, 100, f"d{k}", 1) for k in range(5000)] + [(None, 0, 5, "n", 1)] * 2 + [("y", 0, 1, "same", 0)]
    b = list(a)
    b[10], b[4000] = ("x", 1000, 100, "other", 1), ("x", 400_000, 90, "d4000", 1)
    b.remove(("x", 200_000, 100, "d2000", 1))
    b.remove((None, 0, 5, "n", 1))
    b.append(("z", 7, 1, "new", 1))
    got = merkle_fixity.audit(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind)).collect()
    assert {(r.archive, r.offset, r.kind, r.records) for r in got} == {("x", 1000, "changed", 1), ("x", 400_000, "changed", 1), ("x", 200_000, "missing", 1), ("", 0, "missing", 1), ("z", 7, "extra", 1)}
    one = spark.createDataFrame(a, kind)
    assert merkle_fixity.audit(one, one).count() == 0 and merkle_fixity.audit(one.limit(0), one.limit(0)).count() == 0
    assert merkle_fixity.audit(one, one.limit(0)).agg({"records": "sum"}).first()[0] == len(a)


def test_only_differing_branches_are_read(spark):
    kind = "archive string, offset long, length long, digest string"
    a = [(f"a{k % 20}", 70_000 * (k // 20), 100, f"d{k}") for k in range(2000)]
    b = [(*r[:3], "bad") if r[0] == "a3" and r[1] == 70_000 * 50 else r for r in a]
    trees = [merkle_fixity.tree(spark.createDataFrame(x, kind)) for x in (a, b)]
    assert [tuple(r) for r in merkle_fixity.differing(*trees).collect()] == [("a3", 70_000 * 50 // merkle_fixity.RANGE)]


def test_records_of_awkward_pages(spark):
    rows = [(1, "u", "<p>"), (1, "u", "<p>"), (None, None, None), (None, "v", ""), (2, None, "x" * 200_000), (1999, "w", None)]
    pages = spark.createDataFrame([(*r, "own", 5) for r in rows], "page_id long, url string, html string, archive string, offset int")
    out = merkle_fixity.records(pages).collect()
    assert len(out) == len(rows) and len({(r.archive, r.offset) for r in out}) == len(rows)
    assert merkle_fixity.page_audit(pages.limit(0)).count() == 0 and merkle_fixity.page_audit(pages).count() == 0


def test_pipeline(spark):
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixture", "packing"]
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and {r.doc_id for r in out.select("doc_id").distinct().collect()} <= {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for d in (docs.limit(40), docs.limit(0)):
            assert stage(spark, d, sf).columns == names, name


def test_small_sources_are_spread_over_their_queue(spark, monkeypatch):
    monkeypatch.setattr(drr_packing, "REST", 4)
    kind = "doc_id long, text string, source string"
    rows = [(k, "word " * 40, "large" if k % 2 else (None if k % 20 == 0 else f"s{k % 20}")) for k in range(4000)]
    rows += [(-1, None, "tiny"), (None, "", "s2"), (7, "word", "s4")]
    docs = spark.createDataFrame(rows, kind).repartition(5, "source")  # each source lies in one part
    pieces = drr_packing.pack(docs, registry.tokenizer_path()).collect()
    ends, whole = {}, {}
    for p in pieces:
        ends.setdefault(p.sequence_id, []).append((p.offset, p.length))
        whole[p.source] = whole.get(p.source, 0) + p.length
    for own in ends.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    per_doc = {}
    for p in pieces:
        per_doc.setdefault(p.doc_id, []).append(p)
    assert len(per_doc) == 4002 and sum(whole.values()) == sum(p[0].doc_tokens for d, p in per_doc.items() if d != 7) + sum(p.length for p in per_doc[7])
    quarter = max(ends) // 4
    for source, n in whole.items():
        if n > 1000:
            for k in range(4):
                part = sum(p.length for p in pieces if p.source == source and k * quarter <= p.sequence_id < (k + 1) * quarter)
                assert abs(part / n - 0.25) < 0.06, (source, k)
