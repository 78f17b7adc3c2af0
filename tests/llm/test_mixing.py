from __future__ import annotations

import numpy as np
import pytest

from starblend.llm import mixing
from tests.llm import brute

SCHEMA = "doc_id long, text string, rate string, copies string, _key0 int, posterior int"


def solve(t, p, weight, ridge=1e-3):
    """The same problem by many plain projected gradient steps."""
    total, x = t.sum(), np.ones(len(t))
    now = (t @ p) / total
    scale = np.where(now > 1e-12, 1 / np.maximum(now, 1e-12), 0)
    for _ in range(20_000):
        e = scale * ((x * t) @ p / total - weight)
        x = np.maximum(0, x - 0.3 * (p @ e + ridge * (x - 1)))
    return x


@pytest.mark.parametrize("weight", [[0.25, 0.25, 0.25, 0.25], [0.97, 0.01, 0.01, 0.01]])
def test_rates_solve_the_problem(spark, weight):
    rng = np.random.default_rng(2)
    t = rng.integers(0, 400, 300)
    p = rng.dirichlet([0.3, 0.1, 0.1, 0.05], 300)
    rows = spark.createDataFrame([(int(n), [float(v) for v in q]) for n, q in zip(t, p)], "n_tokens long, posterior array<double>")
    found = np.array([r.rate for r in mixing.with_rates(rows, mixing.fit_rates(rows, weight, tolerance=1e-7)).collect()])
    want = np.where(t > 0, solve(t.astype(float), p, np.array(weight)), 1)
    assert found.min() >= 0 and np.abs(found - want).max() < 5e-3
    share = (found * t) @ p / t.sum()
    assert np.abs(share - ((want * t) @ p / t.sum())).max() < 1e-4


def corpus():
    words = {"a": ["alpha", "beta", "gamma"], "b": ["uno", "dos", "tres"], "c": ["ein", "zwei", "drei"]}
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        d = "aaaaabbc"[i % 8]
        rows.append((i, " ".join(rng.choice(words[d], 40)), d))
    rows.append((900, " ".join(["alpha beta"] * 8 + ["uno dos"] * 8), None))
    return rows


def test_posteriors_are_soft_and_targets_met(spark, work):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "", "", 1, 2) for i, t, _ in rows], SCHEMA)
    labelled = spark.createDataFrame([(i, d) for i, _, d in rows if d and i % 2], "doc_id long, domain string")
    targets = {"a": 0.4, "b": 0.3, "c": 0.3}
    got = {r.doc_id: r for r in mixing.rates(docs.select("doc_id", "text"), labelled, targets, work).collect()}
    assert np.allclose(got[900].posterior, [0.5, 0.5, 0], atol=0.01)
    t, p, x = (np.array([getattr(r, c) for r in got.values()], float) for c in ("n_tokens", "posterior", "rate"))
    assert np.abs((x * t) @ p / t.sum() - [0.4, 0.3, 0.3]).max() < 2e-3
    assert all(r.copies in (np.floor(r.rate), np.floor(r.rate) + 1) for r in got.values())
    out = mixing.mixed(docs, labelled, targets, work)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, r in got.items() for _ in range(r.copies))


def test_packed_ids_meet_the_targets(spark, work):
    """Domains whose words have one id and many; one text is without white space."""
    rng = np.random.default_rng(1)
    words = {"a": ["the", "and", "that", "was"], "b": ["zqxvkjwpq", "xkqzvwjqk", "qjzkxvwqz", "wvqxkzjqp"]}
    rows = [(i, " ".join(rng.choice(words["ab"[i % 2]], 30)), "ab"[i % 2]) for i in range(200)]
    rows.append((900, "zqxvkjwpq" * 400, "b"))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, d) for i, _, d in rows if i % 3], "doc_id long, domain string")
    got = {r.doc_id: r for r in mixing.rates(docs, labelled, {"a": 0.5, "b": 0.5}, work).collect()}
    packed = {i: len(brute.ids(t)) for i, t, _ in rows}
    assert {i: r.n_tokens for i, r in got.items()} == packed
    weight = {d: sum(got[i].rate * packed[i] for i, _, e in rows if e == d) for d in "ab"}
    assert abs(weight["a"] / sum(weight.values()) - 0.5) < 5e-3


def test_each_row_of_an_id_has_its_own_copies(spark, work):
    rows = corpus()
    docs = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t, d, "", 1, 2) for i, t, d in rows]
    frame = spark.createDataFrame(docs, SCHEMA)
    texts = {t: d for _, t, d, *_ in docs}
    named = spark.createDataFrame([(i, d) for i, _, d, *_ in docs if i and i != 7 and d], "doc_id long, domain string")
    targets = {"a": 0.2, "b": 0.6, "c": 0.2}
    out = mixing.mixed(frame, named, targets, work).collect()
    count = {d: 0 for d in "abc"}
    for r in out:
        assert r.rate == texts[r.text]  # the column of that name belongs to the table
        if r.rate:
            count[r.rate] += 1
    total = sum(count.values())
    assert abs(count["a"] / total - 0.2) < 0.08 and abs(count["b"] / total - 0.6) < 0.08
    own = {r.doc_id for r in out}
    assert None in own and 7 in own


def test_rates_can_be_bounded(spark, work):
    """One document of a rare domain is asked for far more often than the bound allows."""
    rows = [(i, "alpha beta gamma delta " * 10, "a") for i in range(200)] + [(900, "uno dos tres cuatro", "b")]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    named = spark.createDataFrame([(i, d) for i, _, d in rows], "doc_id long, domain string")
    targets = {"a": 0.5, "b": 0.5}
    assert max(r.rate for r in mixing.rates(docs, named, targets, work).collect()) > 50
    bounded = mixing.rates(docs, named, targets, work, most=4)
    assert max(r.rate for r in bounded.collect()) == 4
    told = {r.domain: r for r in mixing.reached(bounded, targets).collect()}
    assert told["b"].target == 0.5 and told["b"].by_rates < 0.3


def test_unfinished_fits_warn(spark):
    rows = spark.createDataFrame([(5, [0.9, 0.1]), (7, [0.2, 0.8])], "n_tokens long, posterior array<double>")
    with pytest.warns(UserWarning, match="2 rounds"):
        assert not mixing.fit_rates(rows, [0.9, 0.1], rounds=2).converged
    assert mixing.fit_rates(rows, [0.6, 0.4]).converged


def test_defined_cases(spark, work):
    rows = [(1, "alpha beta", "", "", 1, 1), (1, "alpha beta", "", "", 1, 1), (2, None, None, None, None, None), (3, "", "", "", 1, 1), (None, "uno", "", "", 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for named in ([], [(1, "a")], [(1, "a"), (None, "b"), (3, None), (2, "zz")]):
        labelled = spark.createDataFrame(named, "doc_id long, domain string")
        got = mixing.rates(docs.select("doc_id", "text"), labelled, {"a": 1.0, "b": 1.0}, work).collect()
        assert len(got) == 5 and all(r.rate >= 0 and abs(sum(r.posterior) - 1) < 1e-9 for r in got)
        assert all(r.rate == 1 and r.copies == 1 for r in got if r.n_tokens == 0)
        mixed = mixing.mixed(docs, labelled, {"a": 1.0, "b": 1.0}, work).collect()
        assert {(r.doc_id, r.text) for r in mixed} >= {(2, None), (3, "")}
    assert mixing.rates(docs.select("doc_id", "text").limit(0), labelled, {"a": 1.0}, work).collect() == []
