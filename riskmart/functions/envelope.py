"""Reading change-data envelopes.

An envelope is ``{"op", "before", "after", "source": {"lsn"}}``, either bare or
wrapped in ``{"payload": ...}``. Each record is parsed once into a struct whose
leaves are text; typing happens afterwards, so that a bad value spoils one field
and not the record.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE = "_envelope"


def _envelope_ddl(fields: Iterable[str]) -> str:
    image = ", ".join(f"{name}: string" for name in fields)
    body = f"op: string, before: struct<{image}>, after: struct<{image}>, source: struct<lsn: string>"
    return f"struct<payload: struct<{body}>, {body}>"


def open_envelope(records: DataFrame, fields: Iterable[str], text: str = "raw_payload") -> DataFrame:
    """Add the parsed envelope.

    The stack of one row keeps the parser below every later filter. As a plain
    projection Catalyst would copy ``from_json`` into each pushed-down predicate
    and parse the same text once per mention.
    """
    parsed = F.from_json(text, _envelope_ddl(fields))
    return records.select("*", F.stack(F.lit(1), parsed).alias(ENVELOPE))


def _first(*paths: str) -> Column:
    return F.coalesce(*(F.col(f"{ENVELOPE}.{path}") for path in paths))


def row_image(field: str, after_only: bool = False) -> Column:
    """Field of the new row image, else of the old one (deletes carry only that).

    With ``after_only`` an update to NULL stays NULL instead of showing the old value.
    """
    new = (f"payload.after.{field}", f"after.{field}")
    old = (f"payload.before.{field}", f"before.{field}")
    return _first(*new) if after_only else _first(*new, *old)


def operation() -> Column:
    return _first("payload.op", "op")


def source_lsn() -> Column:
    return _first("payload.source.lsn", "source.lsn").try_cast("bigint")


def json_text(column: str, *paths: str) -> Column:
    """First JSON path with a value, for reading a few fields of a document."""
    return F.coalesce(*(F.get_json_object(column, path) for path in paths))
