"""Connected components of links by contraction.

Every node takes its smallest neighbour as parent. Parents are followed to the roots of the trees they make, by doubling;
links are then drawn between roots, and it starts over with these until none is left. Every step is a join or an
aggregation over the links, so that a node with any number of links is spread over tasks; the tables of a step are
written, and removed after the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharemill.llm.tables import merged, remove, write_staged


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) for every node that is linked with a smaller one: root is the smallest node it can reach.

    ``links`` has two columns of one orderable type, in either direction; links with null or with itself, and
    repeated links don't matter. Roots themselves and nodes without a link have no row. No links, no rows.
    ``known`` is the result for other links: then the result holds for both, and only ``links`` are gone through.
    """
    spark = links.sparkSession
    a, b = (F.col(f"`{name}`") for name in links.columns[:2])
    if known is not None:
        links = _moved(links.select(a.alias("a"), b.alias("b")), known)
        a, b = F.col("a"), F.col("b")
    pairs = links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    schema, path = pairs.schema, write_staged(pairs, "links")
    labels, old = known, None
    while not (now := spark.read.schema(schema).parquet(path)).isEmpty():
        roots = _followed(_parents(now))
        left = _moved(now, roots).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        new = write_staged(left, "links")
        remove(spark, path)
        path = new
        composed = roots if labels is None else _composed(labels, roots)
        written = write_staged(composed, "roots")
        if old is not None:
            remove(spark, old)
        labels = spark.read.schema(composed.schema).parquet(written)
        old = written
    return labels if labels is not None else now.toDF("node", "root")


def _parents(links: DataFrame) -> DataFrame:
    """(node, root): the smallest neighbour of each node that has a smaller one."""
    # a link's larger node is the first
    return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def _followed(parents: DataFrame) -> DataFrame:
    """(node, root) with the root of each node's tree."""
    spark, schema, path = parents.sparkSession, parents.schema, write_staged(parents, "parents")
    while True:
        now = spark.read.schema(schema).parquet(path)
        on = now.toDF("root", "next")
        if merged(now, on, "root", "left_semi").isEmpty():
            return now
        jumped = merged(now, on, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        new = write_staged(jumped, "parents")
        remove(spark, path)
        path = new


def _moved(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a, b) between the roots of their nodes."""
    one, other = roots.toDF("a", "root_a"), roots.toDF("b", "root_b")
    joined = merged(merged(links, one, "a", "left"), other, "b", "left")
    return joined.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))


def _composed(labels: DataFrame, roots: DataFrame) -> DataFrame:
    """Labels whose roots have got roots themselves; these were no nodes of the labels."""
    joined = merged(labels, roots.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return joined.unionByName(roots)
