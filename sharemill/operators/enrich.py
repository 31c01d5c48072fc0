"""Left enrichment of facts with the channel master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharemill.sources.schemas import MASTER_ATTRIBUTES


def enrich(
    facts: DataFrame,
    master: DataFrame,
    *,
    key: str = "channel",
    ignore_case: bool = False,
    trim: bool = False,
    attributes: tuple[str, ...] = MASTER_ATTRIBUTES,
) -> DataFrame:
    """Every fact row with its master attributes, NULL where the key is unknown; duplicate keys fan out.

    There is no broadcast hint: Spark broadcasts the master when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, where adaptive execution cuts
    the partitions of a hot channel into pieces.
    """
    master = master.select(F.col(key).alias("_master_key"), *attributes)

    def comparable(column: Column) -> Column:
        column = F.trim(column) if trim else column
        return F.upper(column) if ignore_case else column

    matches = comparable(F.col(key)) == comparable(F.col("_master_key"))
    return facts.join(master, matches, "left").drop("_master_key")
