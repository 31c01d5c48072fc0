"""Sharding by balanced label propagation, in DataFrame operations alone.

Rows are nodes, linked where they belong together; a shard is a label. Rows start in shards given by a hash. In
each round every linked row counts its neighbours by shard and asks to move where most of them are; a shard admits
what its quota has room for, in an order drawn by a hash. When no row finds room any more, groups that are cut though they fit
a shard move as a whole to where they do. Rows without links make room: a last step moves as few
rows as it takes, those with the fewest links inside their shard first, until sizes are as even as they can be.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sharemill.llm.components import components
from sharemill.llm.tables import merged, numbered, quoted, remove, staged, write_staged

#: Steps in which a shard's quota is handed out; how often they are made sixteen times finer when nobody gets in.
STEPS, FINER = 256, 4


def shards_by_links(nodes: DataFrame, links: DataFrame, shards: int = 8, rounds: int | None = None, seed: int = 0) -> DataFrame:
    """(node, shard) for each row of ``nodes``, which has a unique ``node`` (long) per row.

    Rows move until nobody wishes to, or no wish finds room (or for ``rounds`` rounds). Of two linked rows one moves in a
    round at most, and only to a shard with more of its neighbours, so that every move lowers the number of cut links. So does
    a group that moves as a whole.

    ``links`` has columns a and b, two nodes each; both directions count, links with itself don't. Shards' numbers of
    rows are at most one apart. A group of linked rows larger than a shard is spread over several.
    """
    spark = nodes.sparkSession
    start = nodes.select("node", F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(shards)).cast("int").alias("shard"))
    total = nodes.count()
    room = -(-total // shards)
    both = links.where("a <> b").select("a", "b")
    both = staged(both.union(both.select(F.col("b"), F.col("a"))).distinct().toDF("node", "near"), "edges")
    # only linked rows take part in the rounds
    linked = merged(start, both.select("node").distinct(), "node", "left_semi")
    path, schema = write_staged(linked, "labels"), linked.schema
    finer, roots = 0, None
    for turn in range(rounds) if rounds is not None else count():
        labels = spark.read.schema(schema).parquet(path)
        wishes = _wishes(labels, both)
        asked = write_staged(wishes, "wishes")
        queue = spark.read.schema(wishes.schema).parquet(asked)
        if queue.isEmpty():
            remove(spark, asked)
            break
        admitted = _admitted(labels, _apart(queue, both, turn, seed), room, STEPS << 4 * finer, turn, seed)
        granted = write_staged(admitted, "moves")
        moves = spark.read.schema(admitted.schema).parquet(granted)
        if none := moves.isEmpty():
            finer += 1
        else:
            finer = 0
            moved = merged(labels, moves, "node", "left").select("node", F.coalesce("target", "shard").alias("shard"))
            new = write_staged(moved, "labels")
            remove(spark, path)
            path = new
        remove(spark, asked)
        remove(spark, granted)
        if none and finer == FINER:
            roots = staged(components(both), "roots") if roots is None else roots
            gathered = _gathered(labels, roots, room, shards, seed)
            if gathered is None:
                break
            finer, new = 0, write_staged(gathered, "labels")
            remove(spark, path)
            path = new
    labels = spark.read.schema(schema).parquet(path)
    inside = merged(_neighbours(labels, both), labels, ["node", "shard"]).select("node", "links")
    placed = merged(merged(start.withColumnRenamed("shard", "first"), labels, "node", "left"), inside, "node", "left")
    placed = placed.select("node", F.coalesce("shard", "first").alias("shard"), F.coalesce("links", F.lit(0)).alias("links"))
    return _evened(placed, shards, total, seed)


def _neighbours(labels: DataFrame, both: DataFrame) -> DataFrame:
    """(node, shard, links): how many neighbours of a node are in a shard."""
    near = merged(both, labels.withColumnRenamed("node", "near"), "near")
    return near.groupBy("node", "shard").agg(F.count(F.lit(1)).alias("links"))


def _wishes(labels: DataFrame, both: DataFrame) -> DataFrame:
    """(node, target): the shard with most neighbours (the lowest of equals), where that is more than at home."""
    counts = _neighbours(labels, both)
    # the home shard's number of neighbours comes along with the best
    home = F.max(F.when(F.col("shard") == F.col("home"), F.col("links")))
    best = F.max(F.struct("links", (-F.col("shard")).alias("least")))
    found = merged(counts, labels.withColumnRenamed("shard", "home"), "node").groupBy("node", "home").agg(best.alias("best"), F.coalesce(home, F.lit(0)).alias("links"))
    return found.where(F.col("best.links") > F.col("links")).select("node", (-F.col("best.least")).cast("int").alias("target"))


def _apart(wishes: DataFrame, both: DataFrame, turn: int, seed: int) -> DataFrame:
    """Those wishes whose row comes before all wishing neighbours in the round's order, so that no two of them are linked."""
    ranked = wishes.select("node", F.struct(F.xxhash64("node", F.lit(f"order{seed}:{turn}")).alias("hash"), "node").alias("order"))
    near = ranked.toDF("near", "other")
    later = merged(merged(both, ranked, "node"), near, "near").where("order > other").select("node").distinct()
    return merged(wishes, later, "node", "left_anti")


def _admitted(labels: DataFrame, wishes: DataFrame, room: int, steps: int, turn: int, seed: int) -> DataFrame:
    """The wishes that fit: as many steps of a shard's queue as leave its linked rows within ``room``."""
    queue = wishes.withColumn("step", F.pmod(F.xxhash64("node", F.lit(f"queue{seed}:{turn}")), F.lit(steps)))
    taken = merged(labels, queue, "node", "left_anti").groupBy("shard").agg(F.count(F.lit(1)).alias("stay"))
    # a row per shard and step
    sizes = queue.groupBy("target", "step").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("target").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    fits = (
        sizes.withColumn("upto", F.sum("n").over(upto)).join(taken.withColumnRenamed("shard", "target"), "target", "left")
        .where(F.col("upto") + F.coalesce("stay", F.lit(0)) <= room)
    )
    return merged(queue, fits.select("target", "step"), ["target", "step"]).select("node", "target")


def _gathered(labels: DataFrame, roots: DataFrame, room: int, shards: int, seed: int) -> DataFrame | None:
    """Labels in which groups that fit a shard, but are cut, are whole in one that has room for the rest of them; None if
    there is no such group. ``roots`` has the smallest node of each other node's group."""
    grouped = merged(labels, roots, "node", "left").select("node", "shard", F.coalesce("root", "node").alias("root"))
    sizes = grouped.groupBy("root", "shard").agg(F.count(F.lit(1)).alias("n")).groupBy("root").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts"))
    cut = staged(merged(grouped, sizes.where((F.col("parts") > 1) & (F.col("size") <= room)).select("root", "size"), "root"), "cut")
    free = {s: room for s in range(shards)} | {r["shard"]: room - r["count"] for r in labels.groupBy("shard").count().collect()}  # a row per shard
    whole, finer = [], 0
    for turn in count():
        # a row per group with its rows by shard, then one per shard: there are few
        own = cut.groupBy("root", "size", "shard").agg(F.count(F.lit(1)).alias("n"))
        groups = own.groupBy("root", "size").agg(F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("own"))
        at = F.explode(F.array([F.struct(F.lit(s).alias("target"), F.lit(n).cast("bigint").alias("free")) for s, n in free.items()]))
        places = groups.withColumn("at", at).select("root", "size", "at.*", F.coalesce(F.try_element_at("own", F.col("at.target")), F.lit(0)).alias("here"))
        places = places.withColumn("more", F.col("size") - F.col("here")).where("more <= free")
        best = F.max_by(F.struct("target", "more", "free"), F.struct("here", F.xxhash64("root", "target", F.lit(f"gather{seed}"))))
        step = F.pmod(F.xxhash64("root", F.lit(f"gather{seed}:{turn}")), F.lit(STEPS << 4 * finer))
        queue = staged(places.groupBy("root").agg(best.alias("best")).select("root", "best.*", step.alias("step")), "queue")
        # a row per shard and step
        upto = Window.partitionBy("target").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
        fits = queue.groupBy("target", "free", "step").agg(F.sum("more").alias("more")).withColumn("upto", F.sum("more").over(upto)).where("upto <= free")
        chosen = staged(merged(queue, fits.select("target", "step"), ["target", "step"]).select("root", "target"), "chosen")
        if chosen.isEmpty():
            if queue.isEmpty() or finer == FINER:
                break
            finer += 1
            continue
        finer = 0
        moved = staged(merged(cut, chosen, "root").select("node", "shard", "target"), "gathered")
        whole.append(moved.select("node", "target"))
        for r in moved.where("shard <> target").groupBy("shard", "target").count().collect():  # a row per pair of shards
            free[r["shard"]] += r["count"]
            free[r["target"]] -= r["count"]
        cut = staged(merged(cut, chosen, "root", "left_anti"), "cut")
    if not whole:
        return None
    return merged(labels, reduce(DataFrame.union, whole), "node", "left").select("node", F.coalesce("target", "shard").alias("shard"))


def _evened(placed: DataFrame, shards: int, total: int, seed: int) -> DataFrame:
    """Move as few rows as possible from shards that are too large to those too small."""
    placed = staged(placed, "placed")
    sizes = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}  # a row per shard
    order = sorted(range(shards), key=lambda s: (-sizes.get(s, 0), s))
    quota = {s: total // shards + (at < total % shards) for at, s in enumerate(order)}
    excess = {s: sizes.get(s, 0) - quota[s] for s in range(shards)}
    if not any(excess.values()):
        return placed.select("node", "shard")
    # those to go: the least linked of each shard that is too large, found by their place in its order
    large = placed.where(F.col("shard").isin([s for s, n in excess.items() if n > 0]))
    queue = numbered(large, [F.col("shard"), F.col("links"), F.xxhash64("node", F.lit(f"even{seed}")), F.col("node")], "queue", "place")
    begin, before, gone = 0, {}, 0
    for s in sorted(s for s, n in excess.items() if n > 0):
        before[s] = (begin, gone)
        begin, gone = begin + sizes[s], gone + excess[s]
    place = F.col("place")
    going = F.lit(None).cast("bigint")
    for s, (at, earlier) in before.items():
        inside = place - at
        going = F.when((F.col("shard") == s) & (inside < excess[s]), inside + earlier).otherwise(going)
    target, reached = F.lit(None).cast("int"), 0
    bounds = []
    for s in sorted(s for s, n in excess.items() if n < 0):
        reached -= excess[s]
        bounds.append((reached, s))
    for end, s in reversed(bounds):
        target = F.when(F.col("going") < end, F.lit(s)).otherwise(target)
    moved = queue.withColumn("going", going).where("going is not null").select("node", target.alias("target"))
    return merged(placed, moved, "node", "left").select("node", F.coalesce("target", "shard").alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int | None = None, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes of the text, none for null, plus 1), text_crc32, law
    (``rows``), shard, slot (from 0, gapless in each shard, in the order of doc_id), grown_shard (null).

    Rows of equal text are linked, as a star around one of them. Null texts (text_crc32 null) are linked with nothing;
    empty texts are equal to each other. Repeated rows and ids are rows each, in places of their own; null ids come
    first. Other columns are ignored; an empty table gives an empty table.
    """
    raw = quoted(text).cast("binary")
    slim = docs.select(
        quoted(doc_id).cast("bigint").alias("doc_id"), (F.coalesce(F.octet_length(raw), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.unhex(F.md5(raw)).alias("digest"),
    )
    rows = staged(slim.withColumn("node", F.monotonically_increasing_id()), "rows")
    centres = rows.where("digest is not null").groupBy("digest").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1")
    links = merged(rows.select("node", "digest"), centres.select("digest", "centre"), "digest").where("node <> centre")
    placed = shards_by_links(rows.select("node"), links.select(F.col("centre").alias("a"), F.col("node").alias("b")), shards, rounds, seed)
    sharded = merged(rows.drop("digest"), placed, "node")
    ordered = numbered(sharded, [F.col("shard"), F.col("doc_id").asc_nulls_first(), F.col("node")], "slots", "place")
    # a row per shard
    sizes = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    begin, slot = 0, F.col("place")
    for s in sorted(sizes):
        slot = F.when(F.col("shard") == s, F.col("place") - begin).otherwise(slot)
        begin += sizes[s]
    return ordered.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
