"""Folds by the checksum of doc_id as text; a null doc_id counts as empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus
