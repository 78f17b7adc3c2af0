from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from starblend.llm import jaccard, prefix_tree
from starblend.llm.common import word_hashes
from starblend.llm.components import components
from starblend.llm.shingles import shingle_sets
from tests.llm import brute

SCHEMA = "doc_id long, text string, fp1 string, n long"


def found(spark, work, docs):
    table = spark.createDataFrame([(d, t, "x", None) for d, t in docs], SCHEMA).repartition(3)
    return jaccard.similarity_classes(table, work)


def corpus(seed: int, groups: int = 12, single: int = 60):
    """Near copies at every distance, exact copies, one passage in many texts, short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = rng.sample(words, 60)
    texts = []
    for _ in range(groups):
        base = rng.sample(words, rng.randint(6, 120))
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts += [" ".join(copy)] * rng.choice([1, 1, 2])
    for i in range(single):
        own = rng.sample(words, rng.randint(1, 90))
        texts.append(" ".join(own + passage) if i % 2 else " \n".join(own).upper())
    texts += ["", None, "one two", "One  TWO", "one two three", "É a b c d e", "é a b c d e", " \t\n", "a b c d e", "a b c d e f"]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, work, seed):
    docs = corpus(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found(spark, work, docs).collect()}
    assert got == brute.classes(docs)


def test_split_teams_lose_nothing(spark, work, monkeypatch):
    """A tiny team size sends the hot groups through the split and across its parts."""
    monkeypatch.setattr(jaccard, "TEAM_SETS", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    base = rng.sample(words, 50)
    texts = []
    for i in range(60):  # near copies; pairs of them are below the bound as often as above
        copy = list(base)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(50)] = f"own{i}"
        texts.append(" ".join(copy))
    docs = list(enumerate(texts + ["unlike anything else in here at all"]))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found(spark, work, docs).collect()}
    assert got == brute.classes(docs)


def test_defined_cases(spark, work):
    same = "the very same words in this text"
    docs = [(None, same), (1, same), (1, same), (2, None), (3, ""), (4, same), (4, "another text of that same number altogether")]
    got = sorted((tuple(r) for r in found(spark, work, docs).collect()), key=repr)
    assert got == sorted([(None, 3, None), (1, 3, 1), (1, 3, 1), (2, 0, 2), (3, 0, 3), (4, 3, 1), (4, 3, 4)], key=repr)
    assert found(spark, work, []).collect() == []


def test_representatives(spark, work):
    same = "the very same words in this text"
    rows = [(7, same, "a", 1), (3, same, "b", 2), (3, same, "b", 2), (None, same, "c", 3), (9, "", None, None), (10, "", None, None)]
    table = spark.createDataFrame(rows, SCHEMA)
    kept = jaccard.representatives(table, work)
    assert kept.columns == table.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([rows[1], rows[3], rows[4], rows[5]], key=repr)


def test_representatives_of_an_id_with_several_texts(spark, work):
    a, b = ("the very same words in this text", " ".join(f"word{i}" for i in range(30)))
    near, other = b + " more", " ".join(f"other{i}" for i in range(30))
    rows = [
        (1, a, "", 1), (4, a, "", 2), (4, b, "", 3), (9, near, "", 4),  # the rows of 4 are of two classes
        (5, other, "", 5), (5, other + " more", "", 6), (6, other, "", 7),  # both rows of 5 are of one class
        (7, None, "", 8), (7, "", "", 9), (7, "found nowhere else at all", "", 10),
    ]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = jaccard.representatives(table, work)
    assert kept.columns == table.columns
    got = sorted((tuple(r) for r in kept.collect()), key=lambda r: r[3])
    assert got == [rows[0], rows[2], rows[4], *rows[7:]]


def test_tree_links_equal_pairs():
    rng = np.random.default_rng(4)
    sets = []
    for key in range(80):
        base = np.arange(key % 5 * 100, key % 5 * 100 + 40)
        own = np.unique(np.r_[rng.choice(base, rng.integers(30, 41), replace=False), rng.integers(600, 700, rng.integers(0, 4))])
        sets.append((key, own[::-1].astype(np.uint64), len(own)))
    root = list(range(80))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(80):
        for b in range(a):
            x, y = set(sets[a][1].tolist()), set(sets[b][1].tolist())
            if 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    want = {frozenset(k for k in range(80) if find(k) == find(j)) for j in range(80)}
    mine = list(range(80))

    def mine_find(x):
        while mine[x] != x:
            x = mine[x]
        return x

    out = prefix_tree.links(sets)
    for a, b in out:
        mine[mine_find(a)] = mine_find(b)
    assert {frozenset(k for k in range(80) if mine_find(k) == mine_find(j)) for j in range(80)} == want
    assert len(out) == 80 - len(want)  # a forest, never all pairs


def test_components_of_paths_and_stars(spark, work):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    found = components(spark.createDataFrame(edges, "a long, b long"), work).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}
    assert components(spark.createDataFrame([], "a long, b long"), work).collect() == []


def test_words_are_those_of_the_pattern():
    texts = ["a\x0bb\x1cc  d", "", "  x\xa0y ", "A a", "\n"]
    hashes, first = word_hashes([t.encode() for t in texts])
    assert np.diff(first).tolist() == [len(brute.WORD.findall(t)) for t in texts]
    assert hashes[first[3]] == hashes[first[3] + 1]


def test_long_text_is_cut_at_white_space(monkeypatch):
    text = " ".join(f"word{i % 977}" for i in range(5000)).encode()
    whole = next(shingle_sets([text]))
    from starblend.llm import common, shingles

    monkeypatch.setattr(common, "STEP_BYTES", 1000)
    monkeypatch.setattr(shingles, "STEP_BYTES", 1000)
    assert np.array_equal(whole, next(shingle_sets([text])))


def test_representatives_keep_columns_of_any_name(spark, work):
    schema = "doc_id long, text string, _n int, _fp1 string, _root long, _row int, _alone int, component_id long, count int, n long"
    docs = spark.createDataFrame([(1, "a b c d e f", 1, "x", 2, 3, 4, 5, 6, 7), (1, "g h i j k l", 1, "y", 2, 3, 4, 5, 6, 7), (2, "a b c d e f", 9, "z", 2, 3, 4, 5, 6, 7)], schema)
    out = jaccard.representatives(docs, work)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r._fp1) for r in out.collect()) == [(1, "a b c d e f", "x"), (1, "g h i j k l", "y")]


def all_links(docs):
    """Brute force: the pairs of rows with an id that link, by their places in ``docs``."""
    sets = [brute.shingles(t) if d is not None else set() for d, t in docs]
    return {(i, j) for i in range(len(sets)) for j in range(i) if sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}


def near_copies(seed: int, copies: int, words: int):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    for i in range(copies):  # pairs of them are below the bound as often as above, and of different lengths
        copy = base[: rng.randint(words * 2 // 3, words)]
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(len(copy))] = f"own{i % 9}"
        yield " ".join(copy)


@pytest.mark.parametrize("limit", [2048, 4])
def test_every_link_is_found_and_counted(spark, work, monkeypatch, limit):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", limit)
    docs = [*corpus(3, 6, 20), *enumerate(near_copies(4, 70, 60), 1000), (None, "one two three"), (1, "one two three")]
    docs += [docs[0], docs[1], *docs[-8:-2]]  # repeated rows
    want = all_links(docs)
    counts = [sum(i in pair for pair in want) for i in range(len(docs))]
    table = spark.createDataFrame([(d, t, "x", None) for d, t in docs], SCHEMA).repartition(3)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.n_links) for r in jaccard.linked_classes(table, work).collect())
    assert got == sorted((d is None, d or 0, len(brute.shingles(t)), c) for (d, t), c in zip(docs, counts, strict=True))

    rows, pairs = jaccard.similarity_links(table, work)
    size = Counter(r.set_id for r in rows.collect() if r.set_id is not None)
    pairs = [tuple(r) for r in pairs.collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    assert sum(size[a] * size[b] for a, b in pairs) + sum(c * (c - 1) // 2 for c in size.values()) == len(want)


def test_links_of_empty_and_unlike_tables(spark, work):
    for docs in ([], [(1, None), (2, "")], [(1, "a b c d e f"), (2, "g h i j k l")]):
        table = spark.createDataFrame([(d, t, "x", None) for d, t in docs], SCHEMA)
        assert [r.n_links for r in jaccard.linked_classes(table, work).collect()] == [0] * len(docs)
        rows, pairs = jaccard.similarity_links(table, work)
        assert rows.count() == len(docs) and pairs.count() == 0


def test_a_hot_token_meets_only_lengths_that_can_link(spark, work, monkeypatch):
    """One team of 400 sets of 10 to 1000 tokens: a set travels to few of its blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 8)
    rows = [(0, i, 10 + i * 990 // 399) for i in range(400)]
    team = spark.createDataFrame(rows, "team long, rid long, n long")
    team = team.selectExpr("team", "rid", "n", "false AS main", "ceil(n * 0.8) AS least", "floor(n * 1.25) AS most")
    met = jaccard._meetings(team, work).collect()
    sizes = {r: n for _, r, n in rows}
    blocks = len({m.part for m in met if m.side == 2})
    assert blocks >= 50 and len(met) < 400 * blocks / 2
    parts = defaultdict(set)
    for m in met:
        parts[m.part].add(m.rid)
    together = {frozenset((a, b)) for p in parts.values() for a in p for b in p if a < b}
    can = {frozenset((a, b)) for a in sizes for b in sizes if a < b and 4 * max(sizes[a], sizes[b]) <= 5 * min(sizes[a], sizes[b])}
    assert can <= together
