"""Classification by rules that are a table: any number of them, looked up by equal joins.

A fact never meets a pattern. The distinct names are matched first, each by the rules that begin and end as it does, and
the facts look their name up in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fixed value: the text of a LIKE pattern before its first wildcard or escape.
LITERAL = r"^[^%_\\]*"


def classify_by_table(df: DataFrame, column: str, rules: DataFrame, output: str = "label") -> DataFrame:
    """Add the label of the first rule whose LIKE pattern the upper-cased name matches, else the name itself.

    ``rules`` has the columns position (unique; the lowest goes first), pattern and label. A name is compared only with
    the rules that ``rules_met`` finds for it. A NULL name stays NULL, a rule without pattern matches nothing.
    """
    names = df.select(F.upper(column).alias("_name")).where("_name is not null").distinct()
    found = (
        rules_met(names, rules)
        .where(F.expr("_name like pattern"))
        .groupBy("_name")
        .agg(F.min("_rule").alias("_first"))
        .select("_name", F.col("_first.label").alias("_label"), F.lit(True).alias("_found"))
    )
    joined = df.join(found, F.upper(column) == F.col("_name"), "left")
    return joined.withColumn(output, F.when(F.col("_found"), F.col("_label")).otherwise(F.col(column))).drop("_name", "_label", "_found")


def rules_met(names: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules that each distinct ``_name`` has to be compared with: those whose pattern begins and ends as it does.

    A pattern's text up to its first wildcard and that after its last one are the keys of an equal join. Rules that share
    a beginning are thus told apart by their ends, and a name meets few of them, however many there are. Only patterns
    that differ in nothing but what is between their wildcards (``%A%``, ``%B%``) meet the same names.
    """
    # equal patterns are one rule, the first of them
    patterns = rules.where("pattern is not null").groupBy("pattern").agg(F.min(F.struct("position", "label")).alias("_rule"))
    patterns = patterns.withColumns(
        {"_head": F.regexp_extract("pattern", LITERAL, 0), "_tail": F.reverse(F.regexp_extract(F.reverse("pattern"), LITERAL, 0))}
    )
    # without wildcards the beginning is all of it
    patterns = patterns.withColumn("_tail", F.when(F.col("_head") == F.col("pattern"), "").otherwise(F.col("_tail")))
    # the pairs of lengths that occur, as many as the longest pattern's length squared at most: a name has no other keys
    shapes = patterns.select(F.length("_head").alias("_n"), F.length("_tail").alias("_m")).distinct()
    keys = (
        names.select("_name", F.explode(F.sequence(F.lit(0), F.length("_name"))).alias("_n"))
        .join(F.broadcast(shapes), "_n")
        .where("_n + _m <= length(_name)")
        .select("_name", F.col("_name").substr(F.lit(1), F.col("_n")).alias("_head"), F.right("_name", F.col("_m")).alias("_tail"))
    )
    return keys.join(patterns, ["_head", "_tail"]).select("_name", "pattern", "_rule")


def bucket_by_table(df: DataFrame, column: str, members: DataFrame, output: str = "bucket") -> DataFrame:
    """Add the code of the list that holds the upper-cased name, NULL if none does.

    ``members`` has the columns code and name (as it is compared); of several lists that hold a name the lowest code goes
    first. Spark broadcasts the codes while they are small.
    """
    codes = members.where("name is not null").groupBy(F.col("name").alias("_name")).agg(F.min("code").alias(output))
    return df.join(codes, F.upper(column) == F.col("_name"), "left").drop("_name")
