"""The pipeline stage by stage, each judged on its own input, and the registered queries."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from starblend.llm import nbsvm, toxicity
from starblend.llm.queries import ORACLES, QUERIES
from starblend.llm.settings import DOMAIN_TARGETS
from tests import compare
from tests.llm import brute
from tests.llm.test_tokens import check_packing

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    from starblend.workspace import Workspace

    with Workspace(spark) as work:
        docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
        out = [docs]
        for name, stage in corpus_pipeline.STAGES:
            out.append(work.table(stage(spark, out[-1], FOLDER), name))
        yield out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay(stages):
    assert [s.columns for s in stages[1:5]] == [stages[0].columns] * 4


@pytest.mark.parametrize(("at", "module", "name", "keep"), [(0, nbsvm, "quality", lambda s: s >= 0.3), (1, toxicity, "toxicity", lambda s: s < 0.5)])
def test_filters_follow_the_scores(spark, stages, at, module, name, keep):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = getattr(module, name)(stages[at], labels).collect()
    assert ids(stages[at + 1]) == sorted(r.doc_id for r in scores if keep(r.score))


def test_one_document_of_each_class_stays(stages):
    texts = [(r.doc_id, r.text) for r in stages[2].collect()]
    want = brute.classes(texts)
    assert ids(stages[3]) == sorted(d for d, (_, root) in want.items() if d == root)


def test_mixing_moves_towards_the_targets(stages):
    """Shares of packed ids, by language: what the classifier goes by need not be exact, the fit of its shares is."""
    def distance(df):
        count = Counter()
        for r in df.collect():
            count[r.lang] += len(brute.ids(r.text))
        return sum(abs(count[k] / sum(count.values()) - v) for k, v in DOMAIN_TARGETS.items())

    assert distance(stages[4]) < 0.75 * distance(stages[3])
    assert set(ids(stages[4])) <= set(ids(stages[3]))


def test_rates_reach_the_targets(spark, stages):
    from starblend.llm import mixing
    from starblend.workspace import Workspace

    docs = stages[3]
    labelled = mixing.language_labels(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    with Workspace(spark) as work:
        rated = mixing.rates(docs.select("doc_id", "text"), labelled, DOMAIN_TARGETS, work)
        rows = {r.domain: r for r in mixing.reached(rated, DOMAIN_TARGETS).collect()}
    assert set(rows) == set(DOMAIN_TARGETS)
    assert all(abs(r.by_rates - r.target) < 2e-3 for r in rows.values())
    assert sum(abs(r.by_copies - r.target) for r in rows.values()) < sum(abs(r.before - r.target) for r in rows.values())


def test_everything_mixed_is_packed(stages):
    docs = Counter(r.doc_id for r in stages[4].collect())
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    per = Counter()
    for r in rows:
        per[r.doc_id] += r.length
    assert per == {d: n * len(brute.ids(texts[d])) for d, n in docs.items()}
    once = [r for r in rows if docs[r.doc_id] == 1]
    assert len({r.sequence_id for r in once}) > 0
    of = {}
    for r in rows:
        of.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in of.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 4096
    assert check_packing  # the pieces' checksums are held in test_tokens


def test_run_equals_the_stages(spark, stages):
    def key(rows):
        return sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)

    assert key(corpus_pipeline.run(spark, FOLDER).collect()) == key(stages[5].collect())


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES if q.startswith("op")}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert "pipeline" in QUERIES and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    assert compare.differences(spark, compare.duck(brute.SMALL), QUERIES[name], ORACLES[name], brute.SMALL) == []
