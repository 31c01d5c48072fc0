"""The stages of the pipeline against brute force, each on its own input."""

from __future__ import annotations

import itertools
from collections import Counter

import pytest

import corpus_pipeline
from sharemill.llm.bm25_decontamination import plain
from sharemill.llm.poisson_mix import poisson_mix
from sharemill.llm.tables import staged

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first and after each stage."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    found = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = staged(stage(spark, docs, DIR), "stage")
    return found


def test_stages_and_columns(spark, stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(stages[name].schema == stages[""].schema for name in names[:-1])
    run = corpus_pipeline.run(spark, DIR)
    assert sorted(map(str, run.collect())) == sorted(map(str, stages["sharding"].collect()))


def test_language_keeps_texts_of_a_language(stages):
    before, after = (Counter(stages[k].collect()) for k in ("", "language"))
    assert all(not any(c.isalpha() for c in r["text"]) for r in before - after) and not after - before


def test_one_of_each_group_stays(stages):
    before, after = stages["language"].collect(), stages["near_duplicates"].collect()
    sets = {}
    for r in before:
        w = r["text"].encode().lower().split()
        n = min(5, len(w))
        sets[r["doc_id"]] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = {k: k for k in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    assert sorted(r["doc_id"] for r in after) == sorted(set(root.values())) and set(after) <= set(before)


def test_documents_with_an_item_go(spark, stages):
    def spaced(text):
        return b" " + b" ".join(plain(text.encode())) + b" "

    items = [spaced(r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    before, after = stages["near_duplicates"].collect(), stages["decontamination"].collect()
    assert Counter(after) == Counter(r for r in before if not any(i in spaced(r["text"]) for i in items))


def test_mixing_and_sharding(stages):
    before, mixed = stages["decontamination"], stages["mixing"].collect()
    drawn = poisson_mix(before).groupBy("doc_id").count().collect()
    assert Counter(r["doc_id"] for r in mixed) == {r["doc_id"]: r["count"] for r in drawn} and set(mixed) <= set(before.collect())
    rows = stages["sharding"].collect()
    sizes = Counter(r["shard"] for r in rows)
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in mixed)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(corpus_pipeline.SHARDS)) <= 1
