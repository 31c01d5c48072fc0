"""Training and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``; a null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
