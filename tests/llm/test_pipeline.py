"""The pipeline's stages against brute force, and their edge cases."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.test_operators import DOCS, ODD, SF, brute_classes
from veinstone.llm import pii, quality


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage returns over the smallest tables, each stage fed with the one before."""
    from veinstone.llm.common import table, written

    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF), name)
        out.append((docs, result))
        docs = result
    return out


def test_columns(steps):
    for docs, result in steps[:-1]:
        assert result.schema.simpleString() == docs.schema.simpleString()


def test_quality_rules(spark, steps):
    docs, result = steps[0]
    measured = {r["doc_id"]: r for r in quality.judged(docs).collect()}
    kept = {r["doc_id"] for r in result.collect()}
    for r in docs.collect():
        m = measured[r["doc_id"]]
        lines = [x for x in (r["text"] or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        letters = sum(c.isalpha() for c in r["text"] or "")
        bad = m["n_words"] < 10 or 10 * m["n_symbols"] > m["n_words"] or not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"] or 2 * m["n_dup_lines"] > len(lines) or 2 * letters < m["word_chars"] or 100 * m["n_repeat_words"] > 20 * m["n_words"]
        assert (r["doc_id"] in kept) == (not bad)


def test_near_duplicates(steps):
    docs, result = steps[1]
    classes = brute_classes({r["doc_id"]: r["text"] for r in docs.collect()})
    assert sorted(r["doc_id"] for r in result.collect()) == sorted(set(classes.values()))


def test_personal_data(steps):
    docs, result = steps[2]
    before, after = ({r["doc_id"]: r for r in t.collect()} for t in (docs, result))
    assert set(before) == set(after)
    for k, r in after.items():
        found = pii.patterns(before[k]["text"])
        assert not pii.patterns(r["text"]) and (r["text"] == before[k]["text"]) <= (not found)
        assert r["n_chars"] == (len(r["text"]) if r["text"] != before[k]["text"] else before[k]["n_chars"])


def test_mixing(steps):
    docs, result = steps[3]
    own = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = result.collect()
    assert all(own[r["doc_id"]] == r["text"] for r in rows) and 0.5 * len(own) < len(rows) < 1.6 * len(own)


def test_sentencepiece(steps):
    docs, result = steps[4]
    assert result.count() == docs.count() and result.where("not round_trip").count() == 0


@pytest.mark.parametrize("data", [[], [(i, t, None, None, None, "k", "t") for i, t in enumerate(ODD)] * 2])
def test_edges(spark, data):
    docs = spark.createDataFrame(data, DOCS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(data)
