"""Near-duplicates by min-max hashing.

A permutation of the shingles' hashes gives two signature values, the smallest and the largest, each of which two
sets share with the probability of their similarity; so half as many permutations fill a signature. The values
are banded: sets that agree in a whole band become candidates, and candidates are confirmed on their full sets.

Nothing is enumerated within a band's bucket. All its sets are compared with one of them, the pivot; links join
sets into components; and while a bucket still spans several components, a further pivot is taken, the set with
the most links. What is left after these rounds are sets in buckets that span several components; of these, pairs
across components are compared if they share one of their rarest shingles, as any two linked sets do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharemill.llm.components import components
from sharemill.llm.shingles import mix, shingle_sets
from sharemill.llm.tables import fresh, quoted, staged
from sharemill.llm.words import utf8


@dataclass(frozen=True)
class Settings:
    """Words of a shingle; least similarity in percent; signature values of a band; chance that two sets of just
    that similarity share no band; rounds of pivots before single pairs."""

    words: int = 5
    percent: int = 80
    rows: int = 5
    miss: float = 1e-6
    pivots: int = 2

    @property
    def bands(self) -> int:
        bands = math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))
        return bands + bands * self.rows % 2  # minimum and maximum of a permutation come together


def signatures(docs: DataFrame, settings: Settings, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_shingles, digest (of the shingle set; null without shingles), bands (hashes, one per band)."""
    values, rows, size = settings.bands * settings.rows, settings.rows, settings.words
    seeds = mix(np.arange(1, values + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    flips, factors = seeds[: values // 2], seeds[values // 2 :] | np.uint64(1)
    place = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)

    def bands(sets: list[np.ndarray]) -> np.ndarray:
        joined = np.concatenate(sets)
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        drawn = np.empty((len(sets), values), np.uint64)
        for k in range(values // 2):
            permuted = (joined ^ flips[k]) * factors[k]
            drawn[:, 2 * k] = np.minimum.reduceat(permuted, starts)
            drawn[:, 2 * k + 1] = np.maximum.reduceat(permuted, starts)
        # a band takes values of different permutations
        drawn = np.concatenate([drawn[:, 0::2], drawn[:, 1::2]], axis=1).reshape(len(sets), settings.bands, rows)
        keys = mix((drawn * place).sum(axis=2, dtype=np.uint64)) + np.arange(settings.bands, dtype=np.uint64)
        return mix(keys).view(np.int64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, waiting, held = batch.column(0), [], 0
            for at, found in enumerate(shingle_sets(utf8(batch.column(1)), size)):
                waiting.append((at, found))
                held += len(found)
                if held > 200_000:
                    yield out(ids, waiting)
                    waiting, held = [], 0
            if waiting:
                yield out(ids, waiting)

    def out(ids: pa.Array, waiting: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        some = [s for _, s in waiting if len(s)]
        signed = iter(bands(some) if some else ())
        digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for _, s in waiting]
        keys = [next(signed) if len(s) else None for _, s in waiting]
        columns = [
            ids.take(pa.array([at for at, _ in waiting])), pa.array([len(s) for _, s in waiting], pa.int64()),
            pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "bands"])

    slim = docs.select(quoted(doc_id).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    return slim.mapInArrow(sign, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>")


def _linked(settings: Settings) -> Column:
    return 100 * F.col("common") >= settings.percent * (F.col("n_a") + F.col("n_b") - F.col("common"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes with n_a, n_b and the exact number of common shingles."""
    one, other = (sets.select(F.col("cid").alias(k), F.col("shingles").alias(f"set_{k}")) for k in "ab")
    # b first: its sets meet their pair once; then a, of which a pivot may have any number of pairs
    joined = pairs.join(other, "b").join(one, "a").select("a", "b", "set_a", "set_b")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (p, q) if len(p) < len(q) else (q, p)
                at = np.searchsorted(large, small)
                found.append((len(p), len(q), int((large[np.minimum(at, len(large) - 1)] == small).sum())))
            n = np.array(found, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, n.T.copy())], ["a", "b", "n_a", "n_b", "common"])

    return joined.mapInArrow(count, "a bigint, b bigint, n_a bigint, n_b bigint, common bigint")


def _sets(docs: DataFrame, classes: DataFrame, settings: Settings, doc_id: str, text: str) -> DataFrame:
    """cid and shingles (sorted hashes as bytes) of the given classes (cid, rep, digest), from the rep's text."""
    size = settings.words
    texts = docs.select(quoted(doc_id).cast("bigint").alias("rep"), quoted(text).alias("text"))
    wanted = texts.join(classes.select("rep", "cid", "digest"), "rep").select("cid", "digest", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            kept, held = [], 0
            for cid, digest, found in zip(ids, digests, shingle_sets(utf8(batch.column(2)), size), strict=True):
                raw = found.tobytes()
                if xxhash.xxh3_128_digest(raw) == digest:  # else another text under the same id
                    kept.append((cid, raw))
                    held += len(raw)
                if held > 1 << 24:
                    yield out(kept)
                    kept, held = [], 0
            yield out(kept)

    def out(kept: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in kept], pa.int64()), pa.array([r for _, r in kept], pa.binary())], ["cid", "shingles"])

    # rows repeated under one id give a set once
    return wanted.mapInArrow(build, "cid bigint, shingles binary").groupBy("cid").agg(F.max("shingles").alias("shingles"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id that links lead to, itself
    included), kept (doc_id = component_id).

    Two documents are linked if 100 * common shingles >= percent * all shingles of both. Texts without words, null
    texts and rows with a null id are linked with nothing (the latter: component_id null, kept). Rows that repeat
    an id are one document: its links are those of all its texts. Other columns are ignored; an empty table gives
    an empty table.
    """
    signed = staged(signatures(docs, settings, doc_id, text), "signatures")
    # equal sets are one class, wherever they are and however many; it goes on under its smallest id
    usable = signed.where("digest is not null and doc_id is not null")
    grouped = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.max("bands").alias("bands"))
    classes = staged(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    joined = _class_components(docs, classes, settings, doc_id, text)

    member = usable.select("doc_id", "digest").join(classes.select("digest", "rep", "cid"), "digest")
    roots = _roots(joined, classes, member)
    labelled = member.join(roots, "rep", "left").select("doc_id", F.coalesce("root", "rep").alias("component_id"))
    # one row per id that is not its own component: few, and unique
    other = labelled.where("component_id <> doc_id").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return (
        signed.select("doc_id", "n_shingles")
        .join(other, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", "kept")
    )


def _roots(joined: DataFrame, classes: DataFrame, member: DataFrame) -> DataFrame:
    """(rep, root): the smallest id each class's component holds, where that isn't its own."""
    of = classes.select("cid", "rep").join(joined.toDF("cid", "root"), "cid", "left").select("rep", F.coalesce("root", "cid").alias("component"))
    least = of.groupBy("component").agg(F.min("rep").alias("root"), F.count(F.lit(1)).alias("n")).where("n > 1")
    roots = of.join(least, "component").where("rep <> root").select(F.col("rep").alias("node"), "root")
    # an id that stands for several texts joins their classes
    several = member.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high or low < doc_id and high = doc_id")
    own = staged(member.join(several.select("doc_id"), "doc_id").select("doc_id", "rep").where("doc_id <> rep"), "several")
    if not own.isEmpty():
        roots = components(own, staged(roots, "class-roots"))
    return roots.toDF("rep", "root")


def _class_components(docs: DataFrame, classes: DataFrame, settings: Settings, doc_id: str, text: str) -> DataFrame:
    """(node, root) of the classes' components. Each round adds its links to the components of those before it."""
    percent = settings.percent
    banded = classes.select("cid", "n", F.explode("bands").alias("bucket"))
    first = banded.groupBy("bucket").agg(F.min("cid").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
    inside = staged(banded.join(first.select("bucket", "pivot"), "bucket"), "buckets")
    wanted = inside.select("cid").distinct().join(classes.select("cid", "rep", "digest"), "cid")
    sets = staged(_sets(docs, wanted, settings, doc_id, text), "sets")

    star = inside.where("cid <> pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct()
    measured = staged(_confirmed(star, sets), "pivot-pairs")
    links = measured.where(_linked(settings)).select("a", "b")
    roots = components(links)
    rest = _open_buckets(inside, roots, links)
    for _ in range(settings.pivots):
        if rest.isEmpty():
            return roots
        pairs = (
            rest.where("component <> of")
            .select(F.least("cid", "centre").alias("a"), F.greatest("cid", "centre").alias("b")).distinct()
            .join(measured.select("a", "b"), ["a", "b"], "left_anti")
        )
        more = staged(_confirmed(pairs, sets).where(_linked(settings)).select("a", "b"), "pivot-links")
        if more.isEmpty():
            break
        links, roots = links.union(more), components(more, roots)
        rest = _open_buckets(rest, roots, links)
    pairs = _rare_pairs(rest.groupBy("cid").agg(F.min("n").alias("n"), F.min("component").alias("component")), links, sets, settings)
    return components(staged(_confirmed(pairs, sets).where(_linked(settings)).select("a", "b"), "pair-links"), roots)


def _rare_pairs(open_sets: DataFrame, links: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) of sets (cid, n, component) of different components that could be linked.

    Two linked sets share one of the first n - least + 1 shingles of each in any common order, ``least`` being the
    share of n that a linked set must have in common with it (the prefix filter). Rarest first, a set that differs
    from all others has only shingles of its own there, and meets none of them. Of the sets that do meet, those
    outside the largest component there look for partners. Against its most linked set c, two sets x and y have at
    most min(|x & c|, |y & c|) + min(|x - c|, |y - c|) shingles in common, not counting those of one set alone.
    """
    percent = settings.percent

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, raw in zip(batch.column(0), batch.column(1), strict=True):
                one = np.frombuffer(raw.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(one), cid.as_py())), pa.array(one)], ["cid", "shingle"])

    held = staged(sets.join(open_sets.select("cid"), "cid", "left_semi").mapInArrow(spread, "cid bigint, shingle bigint"), "open-shingles")
    counts = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # shingles of one set alone come first and meet nobody: their number is enough
    shared = held.join(counts, "shingle").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
    least = F.ceil(F.col("n") * percent / 100.0 - 1e-9)
    first = F.col("n") - least + 1 - (F.col("n") - F.size("shared"))
    prefix = (
        open_sets.join(shared, "cid").withColumn("first", first.cast("int")).where("first > 0")
        .select("cid", "n", "component", F.size("shared").alias("usable"), F.posexplode(F.slice("shared", F.lit(1), F.col("first"))["shingle"]).alias("at", "shingle"))
        .withColumn("left", F.col("usable") - F.col("at"))
    )
    prefix = staged(prefix, "prefixes")
    sizes = prefix.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("shingle").agg(F.max(F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("several")).where("several > 1")
    marked = staged(prefix.join(main.select("shingle", F.col("main.component").alias("main")), "shingle"), "marked")
    # what every set has in common with the centres of the components it meets
    degree = links.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count(F.lit(1)).alias("degree"))
    ranked = open_sets.join(degree, "cid", "left").groupBy("component").agg(F.max(F.struct(F.coalesce("degree", F.lit(0)), (-F.col("cid")).alias("least"))).alias("best"))
    centres = ranked.select(F.col("component").alias("main"), (-F.col("best.least")).alias("centre"))
    met = marked.select("cid", "main").distinct().join(centres, "main")
    measured = _confirmed(met.select(F.col("centre").alias("a"), F.col("cid").alias("b")).distinct(), sets)
    shares = staged(met.join(measured.select(F.col("a").alias("centre"), F.col("b").alias("cid"), "common"), ["centre", "cid"]).select("cid", "main", "common"), "shares")
    held = staged(marked.join(shares, ["cid", "main"]), "measured")
    one = held.where("component <> main").select("shingle", *[F.col(c).alias(f"{c}_one") for c in ("cid", "n", "component", "usable", "common", "left")])
    beyond = F.greatest(F.least(F.col("usable") - F.col("common"), F.col("usable_one") - F.col("common_one")), F.lit(0))
    most = F.least("common", "common_one") + beyond
    # from the first shingle that two sets share there on, they share no more than either has left
    most = F.least(most, "left", "left_one")
    # sets of sizes too far apart aren't even compared: sizes whose ratio may pass lie in the same class or in neighbours
    width = 1.0001 * max(math.log(100 / percent), 1e-6)
    near = F.floor(F.log("n_one") / F.lit(width))
    one = one.withColumn("class", F.explode(F.array(near - 1, near, near + 1)))
    held = held.withColumn("class", F.floor(F.log("n") / F.lit(width)))
    pairs = (
        held.join(one, ["shingle", "class"])
        .where("component <> component_one and (component = main or cid < cid_one)")
        .where(100 * F.least("n", "n_one") >= percent * F.greatest("n", "n_one"))
        .where((100 + percent) * most >= percent * (F.col("n") + F.col("n_one")))
    )
    return pairs.select(F.least("cid", "cid_one").alias("a"), F.greatest("cid", "cid_one").alias("b")).distinct()


def _open_buckets(inside: DataFrame, roots: DataFrame, links: DataFrame) -> DataFrame:
    """The buckets that span several components: bucket, cid, n, component, and the bucket's set with the most links
    (centre) with its component (of)."""
    degree = links.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count(F.lit(1)).alias("degree"))
    marked = (
        inside.select("bucket", "cid", "n").join(roots.toDF("cid", "root"), "cid", "left").join(degree, "cid", "left")
        .select("bucket", "cid", "n", F.coalesce("root", "cid").alias("component"), F.coalesce("degree", F.lit(0)).alias("degree"))
    )
    spans = marked.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.max(F.struct("degree", (-F.col("cid")).alias("least"), "component")).alias("best"),
    )
    spans = spans.where("low < high").select("bucket", (-F.col("best.least")).alias("centre"), F.col("best.component").alias("of"))
    return staged(marked.drop("degree").join(spans, "bucket"), "open-buckets")


def keep_one(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each component: that of its smallest id.

    Of rows that repeat an id the least by all columns stays; rows with a null id all stay, since nothing links them.
    """
    found = near_duplicates(docs, settings, doc_id, text)
    # one row per id that stays, with its number of rows
    kept = found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    key, rows = fresh(docs.columns, "_kept_id"), fresh(docs.columns, "_kept_rows")
    named = kept.select(F.col("doc_id").alias(key), F.col("rows").alias(rows))
    joined = docs.join(named, quoted(doc_id).cast("bigint") == quoted(key))
    single = joined.where(quoted(rows) == 1).select(*map(quoted, docs.columns))
    repeated = joined.where(quoted(rows) > 1)
    least = repeated.groupBy(quoted(key)).agg(F.min(F.struct(*map(quoted, docs.columns))).alias("row")).select("row.*")
    return single.unionByName(least).unionByName(docs.where(quoted(doc_id).isNull()))
