"""The pipeline, stage by stage against brute force, on the given tables."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
import test_decontaminate
import test_forest_join
import test_mixing
import test_token_planes
from tokenizers import Tokenizer

import corpus_pipeline
from martloom.llm import string_kernel, token_planes
from martloom.llm.common import table
from martloom.operators.scratch import materialize


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """documents, and what each stage made of it."""
    found = [table(spark, sf_dir, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        found.append(materialize(stage(spark, found[-1], sf_dir), name))
    return found


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_columns_stay(steps):
    for df in steps[:-1]:
        assert df.dtypes == steps[0].dtypes


def test_toxic_documents_go(spark, sf_dir, steps):
    scored = string_kernel.scored(steps[0], table(spark, sf_dir, "labels"))
    good = {r.doc_id for r in scored.collect() if r.score < string_kernel.THRESHOLD}
    assert rows(steps[1]) == Counter({r: n for r, n in rows(steps[0]).items() if r[0] in good})


def test_one_of_each_group_stays(steps):
    docs = [(r.text, r.doc_id) for r in steps[1].collect()]
    kept = {i for i, class_id, _ in test_forest_join.brute(docs) if i == class_id}
    assert rows(steps[2]) == Counter({r: n for r, n in rows(steps[1]).items() if r[0] in kept})


def test_benchmark_passages_go(spark, sf_dir, steps):
    docs = [(r.text, r.doc_id) for r in steps[2].collect()]
    items = [(r.text, r.item_id) for r in table(spark, sf_dir, "benchmark").collect()]
    clean = {r[0] for r in test_decontaminate.brute(docs, items) if not r[5]}
    assert rows(steps[3]) == Counter({r: n for r, n in rows(steps[2]).items() if r[0] in clean})


def test_sources_come_near_their_targets(steps):
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    before, after = rows(steps[3]), rows(steps[4])
    assert set(after) <= set(before) and max(after.values()) <= 2
    for row in before:
        n = test_mixing.n_words(row[1])
        sizes[row[3]] += n
        taken[row[3]] += n * after[row]
        longest[row[3]] = max(longest[row[3]], n)
    for source, target in test_mixing.brute_targets(sizes).items():
        assert abs(taken[source] - target) <= longest[source] / 2 + 1


def test_token_files(steps):
    reference = Tokenizer.from_file(token_planes.default_tokenizer())
    docs = [(r.text, r.doc_id) for r in steps[4].collect()]
    assert sorted(map(tuple, steps[5].collect()), key=lambda r: r[1]) == test_token_planes.brute(docs, reference)


def test_run_and_empty_documents(spark, sf_dir, steps):
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(steps[5])
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
