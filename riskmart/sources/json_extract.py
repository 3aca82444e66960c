"""Identifier-free JSON extract for dashboards, published as one release."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.sources.snapshot_store import SnapshotStore


class IdentifierLeak(ValueError):
    """A section about to be published names an identifier."""


def identifier_fields(data_type: T.DataType, prefix: str = "") -> list[str]:
    """Paths of fields named ``*_id`` anywhere in a schema, nested ones included."""
    if isinstance(data_type, T.StructType):
        found = []
        for field in data_type.fields:
            path = f"{prefix}{field.name}"
            found += [path] if field.name.endswith("_id") else []
            found += identifier_fields(field.dataType, f"{path}.")
        return found
    if isinstance(data_type, T.ArrayType):
        return identifier_fields(data_type.elementType, prefix)
    if isinstance(data_type, T.MapType):
        return identifier_fields(data_type.valueType, prefix)
    return []


def reject_identifiers(sections: dict[str, DataFrame]) -> None:
    """Looks at schemas only, so nothing is computed for a section that may not leave."""
    leaks = [
        f"{name}.{path}" for name, frame in sections.items() for path in identifier_fields(frame.schema)
    ]
    if leaks:
        raise IdentifierLeak(f"identifier fields in the extract: {', '.join(leaks)}")


def json_ready(frame: DataFrame) -> DataFrame:
    """Decimals as numbers, dates and instants as ISO text."""
    formats = {T.DateType: "yyyy-MM-dd", T.TimestampType: "yyyy-MM-dd'T'HH:mm:ssXXX"}
    columns = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif type(field.dataType) in formats:
            column = F.date_format(column, formats[type(field.dataType)])
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def publish_extract(store: SnapshotStore, sections: dict[str, DataFrame]) -> None:
    """Write every section, then switch readers to all of them at once."""
    reject_identifiers(sections)
    store.publish(
        {f"extract_{name}": json_ready(frame) for name, frame in sections.items()}, file_format="json"
    )
