"""Which documents a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """True for the documents that are kept for measuring; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
