"""Surrogates against a plain search over a whole table, and the pipeline's stages on odd inputs."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from sharemill.llm.queries import QUERIES
from sharemill.llm.tables import chosen_by_text

DIR = "/root/testdata/sf0.001"

#: The kinds of entity that the given documents hold, each by a pattern of its own.
PLAIN = {
    "email": r"[\w.]+@[\w.]*\w", "phone": r"\+1 \(\d{3}\) \d{3}-\d{4}", "ip": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
    "access_key": r"\bAKIA[0-9A-Z]{16}\b", "secret": r'(?<=token = ")[0-9a-f]{40}|(?<=TOKEN = ")[0-9A-F]{40}|(?<=password=)\w{8,}', "card": r"(?<!\d)\d{16}(?!\d)",
}
ANY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PLAIN.items()))


def is_card(digits: str) -> bool:
    doubled = [int(d) * (1 + at % 2) for at, d in enumerate(reversed(digits))]
    issued = digits[0] == "4" or 51 <= int(digits[:2]) <= 55 or 2221 <= int(digits[:4]) <= 2720 or digits[:2] in ("35", "62", "65") or digits[:4] == "6011" or 644 <= int(digits[:3]) <= 649
    return issued and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def test_surrogates_equal_a_plain_search_over_the_whole_table(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op1_pii_surrogates"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    given: dict[tuple[str, str], str] = {}
    for r in rows:
        old, new = texts[r["doc_id"]], r["text"]
        found = [m for m in ANY.finditer(old) if m.lastgroup != "card" or is_card(m[0])]
        assert r["n_entities"] == len(found)
        # what lies between the entities is there as before, and each has one surrogate wherever it stands
        at = end = 0
        for k, m in enumerate(found):
            between = old[end : m.start()]
            assert new.startswith(between, at)
            at, end = at + len(between), m.end()
            after = old[end : found[k + 1].start() if k + 1 < len(found) else len(old)]
            size = len(m[0]) if m.lastgroup not in ("email", "ip") else re.compile(PLAIN[m.lastgroup]).match(new, at).end() - at
            surrogate, at = new[at : at + size], at + size
            assert new.startswith(after, at)
            unit = m.lastgroup, m[0].lower() if m.lastgroup == "email" else m[0]
            assert given.setdefault(unit, surrogate.lower() if m.lastgroup == "email" else surrogate).lower() == surrogate.lower()
            assert re.fullmatch(PLAIN[m.lastgroup].split(")", 1)[-1].split("|")[0] if m.lastgroup == "secret" and m[0].islower() and len(m[0]) == 40 else r"[\S ]+", surrogate)
            assert m.lastgroup != "card" or is_card(surrogate)
        assert new[at:] == old[end:]
    assert len({kind for kind, _ in given}) >= 4 and len({(kind, new) for (kind, _), new in given.items()}) == len(given)
    assert not {old for _, old in given} & set(given.values())


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = "score string, rank int, shard int, slot int, copy int, component_id string, digest string, _text string, _keep int, `a``b.c` string, Kept boolean, shuffle_key string"
ROWS = [
    (1, None, "en", "a", None), (2, "", "en", None, 0), (3, "  \t\n ", None, "a", 5), (4, "12 34 !?", None, "a", 8), (None, "one two three four five six", "en", "b", 26),
    (6, "one two three four five six", "en", "b", 26), (6, "one two three four five six", "en", "b", 26), (7, "one two three four five six", "de", "b", 26),
    (8, "x" * 300_000, None, "c", 300_000), (9, "all of the words in a very long text " * 20_000, "en", "c", 740_000), (10, "Ünï çödé 日本", None, None, 11),
]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, name, stage):
    """Nulls in any column, empty and long texts, repeated rows, clashing names, and no rows at all."""
    docs = spark.createDataFrame([(*r, "s", 1, 2, 3, 4, "c", "d", "t", 5, "b", True, "k") for r in ROWS], f"{COLUMNS}, {ODD}").repartition(3)
    last = name == "sharding"
    for rows in (docs, docs.limit(0)):
        result = stage(spark, rows, DIR)
        found = result.collect()
        if not last:
            assert result.columns == rows.columns
        if rows is not docs:
            assert found == []
            continue
        ids = [r["doc_id"] for r in found]
        if last:
            assert sorted(map(str, ids)) == sorted(str(r[0]) for r in ROWS) and {r["shard"] for r in found} == set(range(corpus_pipeline.SHARDS))
            continue
        given = {tuple(r) for r in docs.collect()}
        assert {tuple(r) for r in found} <= given
        if name == "language":  # texts without letters go
            assert not {1, 2, 3, 4} & set(ids) and {6, 7} <= set(ids)
        elif name == "near_duplicates":  # one of the copies stays; texts without words are no copies
            texts = [r["text"] for r in found if r["doc_id"] is not None]  # a row without id has nothing to be linked by
            assert texts.count("one two three four five six") == 1 and len(found) == len(texts) + 1 and {1, 2, 3, 8, 9, 10} <= set(ids)
        elif name == "decontamination":  # no item of the benchmark is here
            assert sorted(map(str, ids)) == sorted(str(r[0]) for r in ROWS)


def test_rows_are_chosen_a_few_texts_at_a_time_and_sent_once(spark, monkeypatch):
    rows = [(k, None if k % 40 == 7 else f"{k}" if k % 9 == 0 else "x" * (100_000 + 997 * k)) for k in range(120)] + [(120, "y" * 3_000_000)]
    docs = spark.createDataFrame(rows, "`a.id` int, `Te``xt` string").coalesce(1)
    mapped, sent = type(docs).mapInArrow, []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a: [sent.append(self.columns), mapped(self, *a)][1])

    def chooser():
        # a call's texts but its largest one are bounded, however many rows a batch has
        return lambda texts: [sum(sizes := [len(t or b"") for t in texts]) - max(sizes) <= 1 << 20 and len(t or b"") % 2 == 0 for t in texts]

    found = chosen_by_text(docs, "te`xt", chooser)
    assert found.schema == docs.schema and [tuple(r) for r in found.collect()] == [r for r in rows if len(r[1] or "") % 2 == 0]
    assert [len(names) for names in sent] == [2]
    none = spark.createDataFrame([(1, None)], "doc_id int, text string").selectExpr("doc_id", "null as text")
    assert chosen_by_text(none, "text", lambda: lambda texts: [t is None for t in texts]).count() == 1
