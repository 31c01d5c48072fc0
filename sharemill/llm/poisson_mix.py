"""Mixing sources to target weights by Poisson replication.

Every document of a source gets a Poisson number of copies with the mean its source needs to reach its share of
the mixture. The number is the inverse of the Poisson distribution at a uniform value hashed from the document's
id, so it doesn't depend on partitions or reruns. The copies are then ordered by a hash, a global shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharemill.llm.tables import fresh, quoted, staged

#: Means above this are drawn as a sum of Poisson numbers with smaller means, which has the same distribution.
LARGEST_MEAN = 64.0


def uniform(*parts: Column) -> Column:
    """A value in [0, 1) from the first 52 bits of the MD5 of the parts joined by ``:``."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def target_rates(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, total: float | None = None,
    power: float = 0.5, source: str = "source",
) -> DataFrame:
    """One row per source: source, n_docs, rate (mean copies of a document).

    ``weights`` names the share of each source in the mixture (sources left out get 0, shares are divided by
    the sum over the sources present); without it a source of n documents weighs n ** power. ``total`` is the
    expected number of copies, by default as many as there are documents. Null is a source like any other.
    """
    sizes = docs.groupBy(quoted(source).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("n_docs").cast("double"), F.lit(power)))
    else:
        given = F.lit(0.0)
        for name, weight in weights.items():
            given = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(given)
        weighed = sizes.withColumn("weight", given)
    sums = weighed.agg(F.sum("weight").alias("weights"), F.sum("n_docs").alias("docs")).first()
    wanted = float(sums["docs"] or 0) if total is None else float(total)
    share = F.col("weight") / F.lit(sums["weights"]) if sums["weights"] else F.lit(0.0)
    return weighed.select("source", "n_docs", (share * F.lit(wanted) / F.col("n_docs")).alias("rate"))


def with_distribution(rates: DataFrame) -> DataFrame:
    """Rates with ``parts`` and ``cumulative``: P(N <= k) for a mean of rate / parts, k = 0, 1, ... far into the tail.

    ``cumulative`` ends where the rest is beyond a uniform value's 52 bits.
    """
    parts = F.greatest(F.ceil(F.col("rate") / F.lit(LARGEST_MEAN)), F.lit(1)).cast("int")
    mean = F.col("rate") / F.col("parts")
    last = F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 20).cast("int")
    start = F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("sums"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * F.col("mean") / k
        return F.struct(p.alias("p"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + p)).alias("sums"))

    sums = F.aggregate(F.sequence(F.lit(1), last), start, add, lambda state: state["sums"])
    return rates.withColumn("parts", parts).withColumn("mean", mean).withColumn("cumulative", sums).drop("mean")


def poisson_mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, total: float | None = None,
    power: float = 0.5, seed: int = 0, doc_id: str = "doc_id", source: str = "source", order: bool = True,
    names: tuple[str, str, str] = ("rate", "copy", "shuffle_key"),
) -> DataFrame:
    """``docs`` replicated to the target weights and globally shuffled: all columns, and rate, copy (from 1) and
    shuffle_key (in [0, 1)), renamed by ``names`` or by underscores where ``docs`` has such columns.

    Rows with the same id (also null) get the same number of copies; a document whose number is 0 is left out,
    which is the feature. Partitions hold consecutive ranges of shuffle_key and are sorted by it. An empty table
    gives an empty table. Texts play no part.
    """
    own = []
    for name in names:
        own.append(fresh([*docs.columns, *own], name))
    rate, copy, key = own
    taken = [*docs.columns, *own]
    wanted, parts, sums = fresh(taken, "_source"), fresh(taken, "_parts"), fresh(taken, "_cumulative")
    plan = with_distribution(target_rates(docs, weights, total, power, source)).select(
        F.col("source").alias(wanted), F.col("rate").alias(rate), F.col("parts").alias(parts), F.col("cumulative").alias(sums)
    )
    plan = staged(plan, "mix-rates")  # Spark knows the size of a written table: it broadcasts only a small one
    drawn = F.aggregate(
        F.sequence(F.lit(1), quoted(parts)),
        F.lit(0),
        lambda n, part: n + F.size(F.filter(quoted(sums), lambda c: c <= uniform(F.lit(f"mix{seed}"), part, quoted(doc_id)))),
    )
    joined = docs.join(plan, quoted(source).eqNullSafe(quoted(wanted)))
    copies = fresh([*taken, wanted, parts, sums], "_copies")
    counted = joined.withColumn(copies, drawn)
    numbers = F.when(quoted(copies) > 0, F.sequence(F.lit(1), quoted(copies)))
    spread = counted.withColumn(copy, F.explode(numbers)).drop(wanted, parts, sums, copies)
    keyed = spread.withColumn(key, uniform(F.lit(f"order{seed}"), quoted(copy), quoted(doc_id)))
    return keyed.repartitionByRange(quoted(key)).sortWithinPartitions(quoted(key)) if order else keyed
