"""The pipeline's filtering stages and the learned rules against plain evaluations."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from data import SF
from test_texts import components

import corpus_pipeline
from custodia.llm import blob_ledger, ordinal_quality, rule_lists


def plain_shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_redaction(text):
    found = []
    for pattern, group, least in blob_ledger.RULES.values():
        found += [m.span() for m in re.finditer(pattern, text, re.ASCII) if len(m.group(group)) >= least]
    merged = []
    for a, b in sorted(found):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    at, out = 0, ""
    for a, b in merged:
        out, at = out + text[at:a] + "[secret]", b
    return out + text[at:]


def test_stages_equal_plain_forms(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}

    good = {r.doc_id for r in corpus_pipeline.quality(spark, docs, sf).select("doc_id").collect()}
    model = ordinal_quality.fit(docs, ordinal_quality.grades_of(labels), 3)
    score = lambda t: math.fsum(model.weights[b] for b in ordinal_quality.buckets(t, model.bits))
    tail = {i: 1 / (1 + math.exp(-(score(t) - model.thresholds[1]))) for i, t in texts.items()}
    assert all((i in good) == (p >= 0.7) for i, p in tail.items() if abs(p - 0.7) > 1e-6)
    rated = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    clean, poor = ([i for i, x in rated.items() if x == y] for y in ((1, 0), (0, 0)))
    assert sum(i in good for i in clean) > 0.97 * len(clean) and sum(i in good for i in poor) < 0.05 * len(poor)

    kept = docs.where(docs["doc_id"].isin(list(good)))
    ids = sorted(good)
    left = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, kept, sf).select("doc_id").collect()}
    classes = defaultdict(list)
    for i, root in zip(ids, components([plain_shingles(texts[i]) for i in ids]), strict=True):
        classes[root].append(i)
    assert all(sum(i in left for i in x) == 1 for x in classes.values())

    out = corpus_pipeline.secrets(spark, docs, sf)
    assert {r.doc_id: r.text for r in out.collect()} == {i: plain_redaction(t) for i, t in texts.items()}


def test_rules_equal_plain_conditions(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    stats = rule_lists.statistics(docs)
    rules = rule_lists.learn(stats, labels)
    assert 0 < len(rules) <= rule_lists.MAX_RULES
    expected = []
    for r in stats.collect():
        n, chars = max(r.n_words, 1), max(r.word_chars, 1)
        m = {
            "symbols_per_word": r.n_symbols / n, "capitals_per_char": r.n_capitals / chars, "shouts_per_word": r.n_shouts / n,
            "repeated_share": r.n_repeat_words / n, "different_share": r.n_distinct / n, "chars_per_word": r.word_chars / n,
            "dup_lines_per_word": r.n_dup_lines / n, "n_words": r.n_words,
        }
        met = [all((m[c.name] > c.threshold) == c.above for c in rule) for rule in rules]
        first = met.index(True) + 1 if any(met) else None
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        expected.append((r.doc_id, failed, not failed and first is None, first))
    got = rule_lists.judged(docs, labels).select("doc_id", "base_failed", "kept", "rule").collect()
    assert Counter(map(tuple, got)) == Counter(expected)
