"""The divergence audit against plain arithmetic."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from starblend.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, part int, n long, base long"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, least=10, k=10):
    docs = [tuple(x or "" for x in d) for d in docs]
    seen, counts, df = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        words = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        seen[lang].add(source)
        counts[lang, source].update(words)
        df[lang].update(set(words))
    out = []
    for lang, sources in seen.items():
        kept = sorted(t for t, c in df[lang].items() if c >= least)

        def parts(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])
        p, q = {s: parts(counts[lang, s]) for s in sources}, parts(whole)

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:k])):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


def audit(spark, work, docs, **more):
    frame = spark.createDataFrame([(i, *d, "x", 1, 2, 3) for i, d in enumerate(docs)], SCHEMA).repartition(6)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in divergence.audit(frame, work, **more).select(columns).collect())


def corpus(seed, n=400, words=60):
    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdeXYZé中") for _ in range(rng.randrange(1, 4))) for _ in range(words)]
    out = []
    for _ in range(n):
        source = rng.choice(["s1", "s1", "s1", "s2", "é", None, "z" * 5])
        lean = hash((source, seed)) % 7
        text = " 1-".join(rng.choice(names[: 5 + 9 * (lean if rng.random() < 0.5 else 6)]) for _ in range(rng.randrange(0, 30)))
        out.append((text, rng.choice(["en", "en", None, "de"]), source))
    return out


@pytest.mark.parametrize(("seed", "least", "k"), [(1, 10, 10), (2, 2, 3), (3, 60, 1)])
def test_audit_equals_plain_arithmetic(spark, work, seed, least, k):
    docs = [*corpus(seed), (None, None, None), ("", "en", "empty"), ("... 12", "fr", "only"), (None, "fr", "other"), *[("same words same", "es", "x")] * 12]
    assert audit(spark, work, docs, least=least, k=k) == brute(docs, least, k)


def test_counts_are_handed_on_early(spark, work, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 7)
    docs = corpus(5, 150)
    assert audit(spark, work, docs, least=3) == brute(docs, 3)


def test_skybands_merge_over_many_partitions(spark, work, monkeypatch):
    monkeypatch.setattr(divergence, "FAN_IN", 2)
    docs = corpus(6, 600, 300)
    assert audit(spark, work, docs, least=1, k=4) == brute(docs, 1, 4)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_keeps_what_fewer_than_k_dominate(k):
    rng = random.Random(k)
    rows = [(rng.randrange(30), rng.randrange(30), str(i).zfill(4).encode()) for i in range(1500)]
    rng.shuffle(rows)
    band = divergence.Skyband(k)
    kept = {r for r in sorted(rows, key=lambda r: (-r[0], r[1], r[2])) if band.offer(r[1], r[2])}
    want = {r for r in rows if sum(o[0] >= r[0] and o[1] <= r[1] and o[2] < r[2] for o in rows) < k}
    assert kept == want and len(kept) < len(rows)


def test_terms():
    assert divergence.terms("AbÉ x1y\x00z [\\]^_`{|}~\x7f中".encode()) == [w.encode() for w in ["abÉ", "x", "y", "z", "中"]]


def test_empty_table(spark, work):
    assert divergence.audit(spark.createDataFrame([], SCHEMA), work).collect() == []
