"""How large texts are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that a row counts for besides its text, so that many short texts are not taken for nothing.
ROW_BYTES = 64


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts and rows, counted in one pass: the size of files says how well texts compress, not how long they are."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + ROW_BYTES
    return docs.agg(F.sum(size)).first()[0] or 0
