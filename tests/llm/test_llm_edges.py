"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import pytest

from sharemill.llm.bm25_decontamination import contaminated, keep_clean
from sharemill.llm.compression_toxicity import toxicity
from sharemill.llm.crf_language import Fit, keep_identified, languages
from sharemill.llm.hidden_markov import Settings as HmmSettings
from sharemill.llm.hidden_markov import language_scores
from sharemill.llm.histogram_topk import top_k
from sharemill.llm.label_sharding import shard_documents
from sharemill.llm.minmax_dedup import Settings, keep_one, near_duplicates
from sharemill.llm.pii_surrogates import replace_entities
from sharemill.llm.poisson_mix import poisson_mix
from sharemill.llm.token_counts import token_counts

SCHEMA = "doc_id bigint, text string, lang string, source string, score string, rank int, shard int, copy int, component_id string, digest string, _text string, _keep int"
LONG = "all of the words in a very long text " * 40_000
ROWS = [
    (1, None, "en", "a"), (2, "", "en", None), (3, "  \t\n ", None, "a"), (4, "12 34 !?", "en", "a"), (5, LONG, "en", "a"),
    (6, "one two three four five six", "en", "b"), (6, "one two three four five six", "en", "b"), (7, "one two three four five six", "de", "b"),
    (None, "one two three four five six", "en", "b"), (8, "x" * 300_000, None, "c"), (9, "write to me@x.org", "de", "c"), (10, "Ünï çödé 日本", "de", "c"),
]
SMALL_HMM = HmmSettings(states=3, symbols=5, classes=4, counted=8, passes=(2, 1), piece=100)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "s", 1, 2, 3, "c", "d", "t", 5) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(n, n % 2, None) for n in range(1, 11)] + [(None, 1, 1), (6, None, 1)], "doc_id bigint, toxic int, text string")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (4, "!?"), (None, "日本")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def by_id(rows):
    out = {}
    for r in rows.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_surrogates(docs, empty):
    result = replace_entities(docs, "key")
    assert result.columns == [*docs.columns, "n_entities"]
    found = by_id(result)
    assert found[1][0]["text"] is None and found[2][0]["text"] == "" and found[5][0]["text"] == LONG and len(found[6]) == 2
    assert found[9][0]["n_entities"] == 1 and "me@x.org" not in found[9][0]["text"] and found[9][0]["text"].startswith("write to ")
    assert sum(map(len, found.values())) == len(ROWS) and replace_entities(empty, "key").collect() == []


def test_mixing(docs, empty):
    result = poisson_mix(docs, total=100)
    assert result.columns == [*docs.columns, "rate", "copy_", "shuffle_key"]
    found = by_id(result)
    assert {r["source"] for rows in found.values() for r in rows} == {None, "a", "b", "c"}
    assert sorted(r["copy_"] for r in found[7]) == list(range(1, len(found[7]) + 1)) and len(found[6]) % 2 == 0
    assert poisson_mix(empty).collect() == []


def test_toxicity(docs, empty, labels):
    found = by_id(toxicity(docs, labels))
    assert sum(map(len, found.values())) == len(ROWS) and found[1][0]["score"] == found[2][0]["score"] and not found[None][0]["held_out"]
    assert all(0 <= r["score"] <= 1 for rows in found.values() for r in rows)
    assert toxicity(empty, labels).collect() == [] and {r["score"] for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_sharding(docs, empty):
    rows = shard_documents(docs, 5).collect()
    sizes = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(5)]
    assert sum(map(len, sizes)) == len(ROWS) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert all(s == list(range(len(s))) for s in sizes)
    null = next(r for r in rows if r["doc_id"] == 1)
    assert (null["size"], null["text_crc32"], null["law"], null["grown_shard"]) == (1, None, "rows", None)
    assert shard_documents(empty).collect() == []


def test_top_k(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (None, [1.0, 1.0]), (6, [1.0]), (7, []), (1, [1.0, 0.5]), (50, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as rank", "'x' as score")
    found = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(vectors, vectors.where("vec_id % 50 = 0"), k=3).collect()]
    same = 256 * 256 + 128 * 128
    assert sorted(found) == [(0, 1, 1, same), (0, 2, 1, same), (0, 3, 2, same), (50, 1, 0, -65536), (50, 2, 1, -65536), (50, 3, 1, -65536)]
    assert top_k(vectors.limit(0), vectors.limit(0)).collect() == [] and top_k(vectors, vectors.limit(0)).collect() == []


def test_near_duplicates(docs, empty):
    found = by_id(near_duplicates(docs))
    assert [found[k][0]["component_id"] for k in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 2, 3, 4, 5, 6, 6, 8] and len(found[6]) == 2
    assert [found[k][0]["n_shingles"] for k in (1, 2, 3, 4, 6, 8)] == [0, 0, 0, 1, 2, 1] and found[None][0]["component_id"] is None and found[None][0]["kept"]
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 6, 8, 9, 10]
    assert near_duplicates(empty).collect() == [] and keep_one(empty).collect() == []


def test_an_id_with_several_texts_joins_their_components(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = spark.createDataFrame([(4, a), (2, a), (4, b), (7, b), (9, "other words than those that came before")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(rows, Settings(words=3)).collect()} == {2: 2, 4: 2, 7: 2, 9: 9}


def test_language_scores(docs, empty):
    found = by_id(language_scores(docs, SMALL_HMM))
    assert sum(map(len, found.values())) == len(ROWS) and found[1][0]["n_tokens"] == 1 and found[1][0]["score"] == found[2][0]["score"]
    assert all(r["score"] < 0 and r["base_score"] < 0 for rows in found.values() for r in rows)
    assert language_scores(empty, SMALL_HMM).collect() == []


def test_contaminated(docs, empty, benchmark):
    found = sorted(((r["doc_id"] or -1), (r["item_id"] or -1)) for r in contaminated(docs, benchmark).collect())
    assert found == [(-1, 1), (6, 1), (6, 1), (7, 1), (10, -1)]
    clean = keep_clean(docs, benchmark)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 3, 4, 5, 8, 9]
    assert contaminated(empty, benchmark).collect() == [] and contaminated(docs, benchmark.limit(0)).collect() == []
    assert keep_clean(docs, benchmark.limit(0)).count() == len(ROWS)


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer())
    found = by_id(token_counts(docs, tokenizer()))
    for doc_id, text, *_ in ROWS:
        assert {r["n_tokens"] for r in found[doc_id]} == {len(encoder.encode(text or "", add_special_tokens=False).ids)}
    assert sum(map(len, found.values())) == len(ROWS) and token_counts(empty, tokenizer()).collect() == []


def test_languages(docs, empty):
    found = by_id(languages(docs, fit=Fit(steps=5)))
    assert [found[k][0]["lang_pred"] for k in (1, 2, 3, 4)] == ["und"] * 4 and not found[None][0]["held_out"]
    assert {r["lang_pred"] for rows in found.values() for r in rows} <= {"und", "en", "de"} and sum(map(len, found.values())) == len(ROWS)
    kept = keep_identified(docs, fit=Fit(steps=5))
    assert kept.columns == docs.columns and not {1, 2, 3, 4} & {r["doc_id"] for r in kept.collect()}
    assert languages(empty).collect() == [] and keep_identified(empty).collect() == []
    assert {r["lang_pred"] for r in languages(docs.where("doc_id = 3")).collect()} == {"und"}
