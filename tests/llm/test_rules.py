from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starblend.llm import rules
from tests.llm import brute

SCHEMA = "doc_id long, text string, n_words string, poor int, kept string"


def stats(text):
    text = text or ""
    words = brute.WORD.findall(text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if brute.WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x", None, None) for i, t in enumerate(texts)], SCHEMA)


def found(spark, texts):
    return {r.doc_id: tuple(r)[1:6] for r in rules.statistics(table(spark, texts)).collect()}


def test_statistics_of_documents(spark):
    texts = [r[1] for r in brute.rows(brute.SMALL, "documents")]
    rng = random.Random(1)
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += ["", None, " \n\t\n ", "a\x0bb\x0cc\x1cd", "x\n x\nx\nx ", "é\U0001f600 #$ |", "same " * 3000, "a b c d e f g h"]
    assert found(spark, texts) == dict(enumerate(map(stats, texts)))


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("ab \n\t#é"), max_size=120), min_size=1, max_size=40))
def test_statistics_property(spark, texts):
    assert found(spark, texts) == dict(enumerate(map(stats, texts)))


def planted(n=400):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(n):
        poor = i % 4 == 0
        longer = 0 if poor else 2
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8) + longer)) for _ in range(40)]
        if poor and i % 8 == 0:
            words = [w.upper() + "!!" for w in words]
        elif poor:
            words = [w + "##" for w in words]
        texts.append(" ".join(words))
        labels.append((i, 0 if poor else 1))
    return texts, labels


def test_learns_planted_rules(spark, work):
    texts, labels = planted()
    marked = spark.createDataFrame([*labels, (None, 0), (3, None), (5, 7)], "doc_id long, quality int")
    judged = rules.judge(table(spark, texts), marked, work).collect()
    wrong = [r.doc_id for r in judged if r.kept != bool(labels[r.doc_id][1])]
    assert not wrong and len(judged) == len(texts)


def test_verdict_is_one_ordered_case(spark, work):
    texts, labels = planted()
    learned = rules.learn(rules.statistics(table(spark, texts)), spark.createDataFrame(labels, "doc_id long, quality int"), work)
    assert 2 <= len(learned) <= 4 and all(len(r) <= 3 for r in learned)
    plan = rules.statistics(table(spark, texts)).select(rules.verdict(learned).alias("kept"))._jdf.queryExecution().toString()
    assert "CASE WHEN" in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1)], [(0, 0)]])
def test_too_few_labels_keep_what_passes_the_base_rule(spark, work, labels):
    texts = ["word%d " % i * 3 + " ".join(f"w{i}{j}" for j in range(30)) for i in range(4)] + ["short", None, "r " * 50]
    judged = rules.judge(table(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int"), work).collect()
    assert {r.doc_id: (r.base_failed, r.kept) for r in judged} == {**{i: (False, True) for i in range(4)}, **{i: (True, False) for i in (4, 5, 6)}}


def test_empty_table(spark, work):
    assert rules.judge(table(spark, []), spark.createDataFrame([], "doc_id long, quality int"), work).collect() == []
