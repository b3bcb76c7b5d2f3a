"""Task messages: JSON ``{localID, content}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPLOAD_DONE = "UPLOAD DONE-"
SCHEMA = "localID string, content string"


def encode(client: Column, content: Column) -> Column:
    return F.to_json(F.struct(client.cast("string").alias("localID"), content.alias("content")))


def decode(value: Column) -> Column:
    return F.from_json(value, SCHEMA)


def upload_total(content: Column) -> Column:
    """The number of tasks a control record announces; null for any other record."""
    return F.regexp_extract(content, f"^{UPLOAD_DONE}([0-9]+)$", 1).try_cast("bigint")
