"""Operators on texts against brute force, on the given tables and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from data import SF, documents, empty, labels

from custodia.llm import blob_ledger, brown_lm, license_windows, ordinal_quality, probminhash_dedup, rule_lists

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", params=["given", "awkward"])
def docs(spark, request):
    return spark.read.parquet(f"{SF}/documents.parquet") if request.param == "given" else documents(spark)


def same(a, b) -> bool:
    return Counter(map(tuple, a)) == Counter(map(tuple, b))


def base_statistics(t):
    w, t = WORD.findall(t or ""), t or ""
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    covered = {i + j for x in at.values() if len(x) > 1 for i in x for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_rule_statistics(docs):
    got = rule_lists.statistics(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert same(got, [(r.doc_id, *base_statistics(r.text)) for r in docs.collect()])


def test_rules_find_low_quality(spark):
    d, lab = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in rule_lists.judged(d, lab).collect()}
    rated = [(out[r.doc_id], r.quality) for r in lab.collect()]
    good = [x.kept for x, q in rated if q == 1 and not x.base_failed]
    bad = [x.kept for x, q in rated if q == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.25


def test_rules_on_awkward_rows(spark):
    out = rule_lists.judged(documents(spark), labels(spark))
    assert out.count() == documents(spark).count() and out.where("kept is null or base_failed is null").count() == 0
    assert rule_lists.judged(empty(spark), labels(spark)).count() == 0
    assert rule_lists.judged(documents(spark), labels(spark).limit(0)).where("kept = base_failed").count() == 0


def test_secret_spans(docs):
    def brute(t):
        t, out = t or "", []
        for k, (name, (pattern, group, least)) in enumerate(blob_ledger.RULES.items()):
            out += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, t, re.ASCII) if len(m.group(group)) >= least]
        return [(n, a, b) for a, _, b, n in sorted(out)]

    expected = []
    for r in docs.collect():
        s = brute(r.text)
        base = [x for x in s if x[0] in blob_ledger.BASE_RULES]
        text = lambda s: ",".join(f"{n}:{a}:{b}" for n, a, b in s)
        n = [sum(x[0] == k for x in s) for k in blob_ledger.BASE_RULES]
        expected.append((r.doc_id, *n, hashlib.sha256(text(base).encode()).hexdigest(), text(s)))
    got = blob_ledger.digest(docs).drop("blob").collect()
    assert same(got, expected)


def test_ledger_scans_only_what_is_new(spark, folder):
    docs, ledger = documents(spark), f"{folder}/ledger"
    first = blob_ledger.digest(docs.where("doc_id < 25"), ledger).count()
    seen = spark.read.parquet(ledger)
    pairs = seen.count()
    assert first == docs.where("doc_id < 25").count() and pairs == seen.dropDuplicates(["blob", "rule", "version"]).count()
    got = blob_ledger.digest(docs, ledger).collect()
    after = spark.read.parquet(ledger)
    n = docs.select(blob_ledger.blob_of(docs["text"])).distinct().count() * len(blob_ledger.RULES)
    assert after.count() == n and pairs < n
    assert same(got, blob_ledger.digest(docs).collect())
    assert blob_ledger.unseen(docs, after, {k: blob_ledger.version(k) for k in blob_ledger.RULES}).count() == 0
    assert blob_ledger.digest(empty(spark)).count() == 0


def test_redaction_keeps_rows_and_columns(spark):
    docs = documents(spark)
    out = blob_ledger.redacted(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[11] == "[secret] and [secret]" and texts[12] == "Token: short" and texts[0] is None


def test_license_windows(docs):
    def brute(t):
        w = license_windows.template_words(t or "")
        g = [" ".join(w[i : i + license_windows.SHINGLE]) for i in range(len(w) - license_windows.SHINGLE + 1)]
        out = {}
        for name, text in license_windows.TEMPLATES.items():
            s = set(license_windows.template_shingles(text))
            scale = 1 << max(0, (len(s) - 1).bit_length())
            best = max((len(s & set(g[a : a + 2 * scale])) for a in range(0, len(g), scale)), default=0)
            if best >= 0.8 * len(s):
                out[name] = best
        return out

    got = {(r.doc_id, r.license): r.shared for r in license_windows.scan(docs).collect()}
    assert got == {(r.doc_id, k): n for r in docs.collect() for k, n in brute(r.text.lower() if r.text else r.text).items()}


def test_license_bands_and_anchors(spark):
    for scale in (1, 2, 8, 64):
        j = 0.8 * (scale // 2 + 1) / (2 * scale + 0.2 * (scale // 2 + 1))
        assert (1 - j) ** license_windows.bands_for(scale) < 1e-5
    s = license_windows.template_shingles(license_windows.TEMPLATES["GPL header"])
    words = license_windows.anchors(s, set())
    assert sum(not set(words) & set(x.split()) for x in s) < 0.8 * len(s)
    text = " ".join(f"w{i}" for i in range(333)) + " " + license_windows.TEMPLATES["MIT permission"].replace("sublicense", "x") + " tail"
    found = license_windows.scan(spark.createDataFrame([(1, text), (1, text), (2, None), (None, text)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.license) for r in found) == [(0, "MIT permission"), (1, "MIT permission")]
    assert license_windows.scan(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        license_windows.scan(empty(spark), {"short": "two words"})


def test_language_model(docs):
    rows = docs.collect()
    cut = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for r in rows if not held(r.doc_id) for w in cut(r.text))
    n, v = sum(c.values()), len(c)
    expected = [(r.doc_id, held(r.doc_id), len(cut(r.text)), sum(w in c for w in cut(r.text)), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in cut(r.text)), 4)) for r in rows]
    got = brown_lm.scored(docs, sweeps=3).collect()
    assert same([(*r[:5], round(r.base_score, 4)) for r in got], expected)
    assert all(math.isfinite(r.score) for r in got)


def test_language_model_learns(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    r = brown_lm.scored(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r.s > r.b
    assert brown_lm.scored(empty(spark), sweeps=1).count() == 0


def test_rare_words_have_their_own_classes(spark):
    """Rare words with one ending stand where nouns or where verbs stand, and get those classes."""
    text = " ".join(f"noun{i % 7} verb{i % 5}" for i in range(400))
    rare = [(k, f"noun1 v{k}same noun2 verb1 n{k}same verb2") for k in range(20)]
    training = spark.createDataFrame([(text,), *[(t,) for _, t in rare]], "text string")
    units = {w: i for i, w in enumerate([b"\n", *[b"noun%d" % i for i in range(7)], *[b"verb%d" % i for i in range(5)]])}
    classes = np.array([0, *[1] * 7, *[2] * 5, *[3] * brown_lm.ENDINGS])
    table = np.array([[0, 21, 0, 0], [0, 0, 400, 20], [21, 400, 0, 20], [0, 20, 20, 0]], float)
    got = {r.word: r["class"] for r in brown_lm.assigned(training, units, classes, table, 20.0).collect()}
    assert got == {f"n{k}same": 1 for k in range(20)} | {f"v{k}same": 2 for k in range(20)}


def test_language_model_with_few_known_words(spark):
    docs = documents(spark)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, round(r.score, 6), r.n_known)
    a, b = (sorted(map(key, brown_lm.scored(docs, sweeps=2, most_units=40, most_known=n).collect())) for n in (60, 1 << 19))
    assert a == b and brown_lm.least_count([(9, 1), (4, 2), (1, 5)], 3) == 4 and brown_lm.least_count([(9, 2)], 1) == 10


def test_class_model_is_a_distribution():
    r = np.random.default_rng(3)
    table = r.integers(0, 9, (6, 6)).astype(float)
    classes = r.integers(1, 6, 30)
    right, left = r.integers(0, 5, (30, 6)).astype(float), r.integers(0, 5, (30, 6)).astype(float)
    out = brown_lm.moved(classes, right, left, np.zeros(30), np.arange(30))
    assert ((out > 0) & (out < 6)).all() and brown_lm.likelihood(table) <= 0


def components(sets, least=0.8):
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if (not sets[i] and not sets[j]) or both and both >= least * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    return [root(i) for i in range(len(sets))]


def test_near_duplicates(docs):
    rows = docs.collect()

    def brute(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    roots = components([brute(r.text) for r in rows])
    first = defaultdict(list)
    for r, k in zip(rows, roots, strict=True):
        first[k].append(r.doc_id)
    name = {k: min((i for i in x if i is not None), default=None) for k, x in first.items()}
    expected = [(r.doc_id, name[k]) for r, k in zip(rows, roots, strict=True)]
    assert same(probminhash_dedup.near_duplicates(docs).collect(), expected)
    kept = probminhash_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(name.values())


def test_large_buckets_lose_no_link(spark):
    """600 texts in 300 close pairs, all alike enough to share buckets but not to be linked."""
    r = np.random.default_rng(8)
    common = [f"c{i}" for i in range(70)]
    rows = []
    for k in range(300):
        own = [f"o{k}x{i}" for i in range(45)]
        rows += [(2 * k, " ".join(common + own)), (2 * k + 1, " ".join(common + own[:-4] + [f"e{k}"] * 4))]
    r.shuffle(rows)
    docs = spark.createDataFrame([(int(a), b) for a, b in rows], "doc_id long, text string")
    out = {x.doc_id: x.class_id for x in probminhash_dedup.near_duplicates(docs).collect()}
    assert out == {i: i - i % 2 for i in range(600)}


def test_probability_jaccard():
    a, b = [f"w{i}" for i in range(500)], [f"w{i}" for i in range(100, 600)]
    x, y = probminhash_dedup.registers(" ".join(a), 3000), probminhash_dedup.registers(" ".join(b), 3000)
    s = probminhash_dedup.similarity(*(np.unique(probminhash_dedup.shingles(" ".join(t))) for t in (a, b)))
    assert abs((x == y).mean() - s) < 0.04
    assert probminhash_dedup.near_duplicates is not None and not probminhash_dedup.registers("").any()


def test_no_documents(spark):
    assert probminhash_dedup.near_duplicates(empty(spark)).count() == 0
    assert probminhash_dedup.deduplicated(empty(spark)).count() == 0
    assert ordinal_quality.accepted(empty(spark), labels(spark)).count() == 0


def test_grades(spark):
    d, lab = (spark.read.parquet(f"{SF.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    held = lab.where("doc_id % 5 = 0")
    out = ordinal_quality.accepted(d.select("doc_id", "text"), lab.where("doc_id % 5 <> 0"))
    got = out.join(ordinal_quality.grades_of(held), "doc_id").groupBy("grade").agg({"kept": "count", "expected_grade": "avg"}).collect()
    kept = {r.grade: r.n for r in out.where("kept").join(ordinal_quality.grades_of(held), "doc_id").groupBy("grade").count().withColumnRenamed("count", "n").collect()}
    n, mean = {r.grade: r["count(kept)"] for r in got}, {r.grade: r["avg(expected_grade)"] for r in got}
    assert kept[2] / n[2] > 0.98 and kept.get(0, 0) / n[0] < 0.05 and kept.get(1, 0) / n[1] < 0.3
    assert mean[0] < mean[1] < mean[2]


def test_grades_on_awkward_rows(spark):
    docs = documents(spark)
    out = ordinal_quality.accepted(docs, labels(spark))
    assert out.count() == docs.count() and out.where("kept is null or tail_1 < tail_2").count() == 0
    assert ordinal_quality.accepted(docs, labels(spark).limit(0)).where("not kept").count() == 0
    assert ordinal_quality.selected(docs, labels(spark)).columns == docs.columns


def test_stars_lose_no_link(spark):
    """Copies alike enough to one original to be linked, but mostly not to each other."""
    r = np.random.default_rng(11)
    rows, expected = [], {}
    for size in (150, 600, 1500):
        word, texts = [f"s{size}w{i}" for i in range(115)], []
        for k in range(size):
            own = word.copy()
            for place in r.choice(23, 3 if k % 10 == 0 else 2, replace=False):  # one in ten is not alike enough
                own[5 * place + r.integers(5)] = f"s{size}k{k}p{place}"
            texts.append(own)
        texts.insert(size // 2, word)
        at = len(rows)
        roots = components([{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts])
        least = {root: at + k for k, root in reversed(list(enumerate(roots)))}
        expected |= {at + k: least[root] for k, root in enumerate(roots)}
        rows += [(at + k, " ".join(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {x.doc_id: x.class_id for x in probminhash_dedup.near_duplicates(docs).collect()}
    wrong = sum(out[k] != v for k, v in expected.items())
    assert wrong == 0, f"{wrong} of {len(expected)} rows in another class, {len(set(out.values()))} classes for {len(set(expected.values()))}"


def test_a_scan_without_a_ledger_keeps_its_own(spark, folder, monkeypatch):
    made = []
    monkeypatch.setattr(blob_ledger, "new_place", lambda spark, name: made.append(f"{folder}/own-{name}") or made[-1])
    docs = documents(spark)
    blob_ledger.digest(docs).count()
    (place,) = made
    kept = spark.read.parquet(place)
    n = docs.select(blob_ledger.blob_of(docs["text"])).distinct().count()
    assert kept.count() == kept.select("blob", "rule").distinct().count() == n * len(blob_ledger.RULES)
    assert {(r.rule, r.version) for r in kept.select("rule", "version").distinct().collect()} == {(k, blob_ledger.version(k)) for k in blob_ledger.RULES}
