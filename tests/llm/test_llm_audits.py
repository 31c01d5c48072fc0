"""Source divergence and filter interaction: against brute force, on odd inputs, and their inner steps."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from sharemill.llm.filter_audit import FILTERS, common, failed, filter_audit, merged, without
from sharemill.llm.source_divergence import Audit, divergence, skyband

SCHEMA = "doc_id bigint, text string, lang string, source string, n bigint, part string, term string, value int, digest string, row int, first int"
SMALL = Audit(documents=2, terms=3, text_bytes=200, words=20, rows=12, batch=3, tile=2, cells=6)


def some_docs(seed: int, rows: int = 90) -> list[tuple]:
    random.seed(seed)
    words = ["the", "The", "of", "Ünï", "日本", "x1y", "#tag", "don't", "rare", "a", "b", "c", "DE", "é"]
    sources = ["s1", "s2", "s3", "", None, "S1"]
    out = [(i % 80, " ".join(random.choices(words, weights=range(1, 15), k=random.choice([0, 1, 3, 8, 30]))), random.choice(["en", "de", None, "", "xx"]), random.choice(sources)) for i in range(rows)]
    return [*out, (None, None, "en", "s1"), (None, None, "en", "s1"), (7, "", None, None), (900, "word " * 100_000, "de", "s2"), (901, "z" * 200_000, "de", "s2"), (5, "same", "lone", "one"), *[(950 + i, "same copies of it", "en", "s1") for i in range(30)]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", "t", 2, "d", 3, 4) for r in rows], SCHEMA).repartition(4)


def brute_divergence(rows, documents, last):
    docs = [((lang or ""), (source or ""), re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        df, n = Counter(), {}
        for _, source, words in (d for d in docs if d[0] == lang):
            df.update(set(words))
            n.setdefault(source, Counter()).update(words)
        kept = {t for t, c in df.items() if c >= documents}
        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}
        whole, own = shares(sum(n.values(), Counter())), {s: shares(c) for s, c in n.items()}
        for s, p in own.items():
            pairs = [(sum(abs(p[t] - q[t]) for t in kept), o) for o, q in own.items() if o != s]
            terms = [(p[t] - whole[t], t) for t in kept if n[s][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, last)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize("seed, audit", [(1, SMALL), (2, SMALL), (3, Audit(documents=3, terms=5))])
def test_divergence_equals_brute_force(spark, seed, audit):
    rows = some_docs(seed)
    result = divergence(frame(spark, rows), audit=audit)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in result.schema] == ["lang string", "source string", "part string", "item string", "value bigint", "rank int"]
    found = [tuple(r) for r in result.collect()]
    assert len(found) == len(set(found)) and set(found) == brute_divergence(rows, audit.documents, audit.terms)


def test_divergence_of_little(spark):
    docs = frame(spark, [(1, None, "en", "a"), (2, "few words", "en", "b"), (3, "", None, None)])
    assert {tuple(r) for r in divergence(docs).collect()} == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}
    assert divergence(docs.limit(0)).collect() == []


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=40), st.integers(1, 4))
def test_skyband_equals_its_definition(points, k):
    n, lang_n = (np.array([p[at] for p in points], np.int64) for at in (0, 1))
    spelling = np.random.default_rng(len(points)).permutation(len(points))
    def above(i, j):
        return i != j and n[i] >= n[j] and lang_n[i] <= lang_n[j] and spelling[i] < spelling[j]
    expected = {j for j in range(len(points)) if sum(above(i, j) for i in range(len(points))) < k}
    assert set(skyband(n, lang_n, spelling, k).tolist()) == expected


def brute_audit(rows, labels):
    texts = [(doc_id, text or "", source or "") for doc_id, text, _, source in rows]
    first: dict[str, int] = {}
    for doc_id, text, _ in texts:
        if doc_id is not None:
            first[text] = min(first.get(text, doc_id), doc_id)
    good, toxic = ({d for d, *marks in labels if d is not None and marks[at] == 1} for at in (0, 1))
    docs = []
    for doc_id, text, part in texts:
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": doc_id is not None and first[text] < doc_id}
        docs.append((part, {f for f in FILTERS if fails[f]}, doc_id in good, doc_id in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own, total = [d for d in docs if d[0] == part], Counter()
        for order in permutations(FILTERS):
            for step, f in enumerate(order, 1):
                earlier = set(order[: step - 1])
                removed = [d for d in own if f in d[1] and not d[1] & earlier]
                total[f] += len(removed)
                kept = sum(not d[1] & (earlier | {f}) for d in own)
                out[part, "".join(order), step] = [kept, len(removed), sum(f in d[1] for d in own) - len(removed), sum(d[1] == {f} for d in own), sum(d[2] for d in removed), sum(d[3] for d in removed)]
        for order in permutations(FILTERS):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(total[f])
    return out


def test_filter_audit_equals_brute_force(spark):
    rows = some_docs(4)
    marks = [(d, d % 2, int(d % 3 == 0)) for d in range(0, 1000, 2)] + [(None, 1, 1), (7, 1, None), (7, 0, 1), (11, None, None)]
    labels = spark.createDataFrame([(*m, "x") for m in marks], "doc_id bigint, quality int, toxic int, part string")
    result = filter_audit(frame(spark, rows), labels)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in result.schema][:3] == ["part string", "filter_order string", "step int"]
    found = {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in result.collect()}
    expected = brute_audit(rows, marks)
    assert found == expected and len(found) == 600 * 6  # null and empty sources are one part
    assert filter_audit(frame(spark, rows[:1]).limit(0), labels).collect() == []
    assert {r["good_lost"] for r in filter_audit(frame(spark, rows), labels.limit(0)).collect()} == {0}


def test_ranges_add_up(spark):
    from sharemill.llm.filter_audit import Limits

    docs, labels = frame(spark, some_docs(5)), spark.createDataFrame([(d, 1, 1) for d in range(40)], "doc_id bigint, quality int, toxic int")
    assert sorted(filter_audit(docs, labels, limits=Limits(span=3)).collect()) == sorted(filter_audit(docs, labels).collect())


SORTED = st.sets(st.integers(0, 60)).map(lambda x: np.array(sorted(x), np.int64))


@given(SORTED, SORTED, SORTED)
def test_list_operations(a, b, c):
    assert merged([a, b, c]).tolist() == sorted({*a.tolist(), *b.tolist(), *c.tolist()})
    assert without(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist())) and common(a, b) == len(set(a.tolist()) & set(b.tolist()))


def test_failed():
    assert failed(b"") == 1 and failed("é ".encode() * 300) == 2 and failed(b"A" + b"b" * 49) == 1 and failed(b"A" + b"b" * 48) == 1 | 4 and failed(b"|") == 1 | 8
