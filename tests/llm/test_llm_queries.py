"""The registered queries: against their SQL, and what else their results must satisfy over whole tables."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
from compare import differences, sql_engine

from sharemill.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def engine(sf_dir):
    with sql_engine(sf_dir) as engine:
        yield engine


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def crc(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, sf_dir, engine, name):
    assert differences(QUERIES[name](spark, sf_dir), engine, ORACLE[name]) == []


def test_surrogates_leave_other_texts_alone(spark, sf_dir, texts):
    import re

    rows = QUERIES["op1_pii_surrogates"](spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    assert all(r["text"] == texts[r["doc_id"]] for r in rows if not r["n_entities"])
    found = 0
    for pattern in (r"\S+@\S+\.com", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"AKIA\w{16}", r"(?<=password=)\w+"):
        old = [m for t in texts.values() for m in re.findall(pattern, t)]
        new = [m for r in rows for m in re.findall(pattern, r["text"])]
        found += len(old)
        assert len(old) == len(new) and len(set(old)) == len(set(new)) and not set(old) & set(new)
    assert found


def test_toxicity_has_every_document(spark, sf_dir, texts):
    rows = QUERIES["op3_compression_toxicity"](spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(texts))
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_shards_keep_their_law(spark, sf_dir, texts):
    rows = QUERIES["op4_label_sharding"](spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(texts))
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s])) for s in sizes)
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    groups: dict[str, set[int]] = {}
    for r in rows:
        groups.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    repeated = [t for t, n in Counter(texts.values()).items() if 1 < n <= len(rows) // 8]
    assert repeated and not any(len(groups[t]) > 1 for t in repeated)


def test_base_scores_and_model(spark, sf_dir, texts):
    rows = QUERIES["op7_hidden_markov"](spark, sf_dir).collect()
    tokens = {d: [*t.encode().lower().split(), None] for d, t in texts.items()}
    counts = Counter(w for d, t in tokens.items() if crc(d) % 7 != 2 for w in t)
    norm = math.log10(sum(counts.values()) + len(counts) + 1)
    assert Counter(r["doc_id"] for r in rows) == Counter(list(texts))
    for r in rows:
        t = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (crc(r["doc_id"]) % 7 == 2, len(t), sum(counts[w] > 0 for w in t), sum(counts.values()))
        assert r["base_score"] == pytest.approx(sum(math.log10(counts[w] + 1) - norm for w in t))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)


def test_contaminated_documents_are_those_with_an_item(spark, sf_dir, texts):
    from sharemill.llm.bm25_decontamination import plain

    def spaced(text):
        return b" " + b" ".join(plain(text.encode())) + b" "

    items = {r["item_id"]: spaced(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    expected = {(d, i) for d, t in texts.items() for i, item in items.items() if item in spaced(t)}
    assert expected == {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_bm25_decontamination"](spark, sf_dir).collect()}


def test_token_counts_are_the_librarys(spark, sf_dir, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = QUERIES["op9_token_counts"](spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(texts))
    for r in rows:
        n = len(encoder.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 2048)


def test_languages_of_held_out_documents(spark, sf_dir):
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_crf_language"](spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(known))
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) for r in rows)
    assert sum(known[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)
