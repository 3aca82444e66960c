"""Contract checks: every row gets the violated rules as bits of one number, and their codes.

The number is all that filters look at. Codes are text and are built from the bits, so
Spark builds them for rows that are still there after the filter, or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.contracts import Entity
from riskmart.functions.values import fired_codes

CODES = "_quality_errors"
MASK = "_violations"
_UPSERT, _BITS = "_is_upsert", "_bits"
UPSERT = "_cdc_operation IN ('c', 'u', 'r')"
KNOWN_OPERATION = "coalesce(_cdc_operation IN ('c', 'u', 'r', 'd'), false)"


def violations(entity: Entity) -> list[tuple[str, str]]:
    """(code, violated-when) pairs, in the order the codes are reported."""
    checks = [
        ("MISSING_PRIMARY_KEY", f"{entity.key} IS NULL"),
        ("INVALID_CDC_OPERATION", f"NOT {KNOWN_OPERATION}"),
    ]
    for name, kind in entity.fields.items():
        checks.append((f"MISSING_{name.upper()}", f"{UPSERT} AND {name} IS NULL"))
        if kind == "string":
            checks.append((f"EMPTY_{name.upper()}", f"{UPSERT} AND trim({name}) = ''"))
    checks += [(rule.code, f"{UPSERT} AND {rule.violation}") for rule in entity.rules]
    if len(checks) > 63:
        raise ValueError(f"{entity.name} has {len(checks)} rules, a number holds 63")
    return checks


def _mask(entity: Entity) -> str:
    """The rules as bits of one number, over a column ``_UPSERT``.

    What only counts for upserts is asked once: asked by every rule, it makes the compiled
    code longer than the JVM translates, and all rows are interpreted.
    """
    always, upserts = [], []
    for k, (_, test) in enumerate(violations(entity)):
        scoped = test.removeprefix(f"{UPSERT} AND ")
        (always if scoped == test else upserts).append(f"if({scoped}, {1 << k}L, 0L)")
    return f"{' | '.join(always)} | if({_UPSERT}, {' | '.join(upserts) or '0L'}, 0L)"


def with_violations(rows: DataFrame, entity: Entity) -> DataFrame:
    """Typed rows with ``MASK`` (0 for a clean row) and ``CODES`` (never NULL, empty for a clean row).

    The stack of one row keeps the rules where they are. As a plain projection Catalyst
    would copy all of them, with the casts below, into every filter on the number.
    """
    known = rows.withColumn(_UPSERT, F.expr(f"coalesce({UPSERT}, false)"))
    masked = known.select(*rows.columns, F.expr(_mask(entity)).alias(_BITS))
    held = masked.select(*rows.columns, F.stack(F.lit(1), F.col(_BITS)).alias(MASK))
    return held.withColumn(CODES, codes_of(entity))


def codes_of(entity: Entity) -> Column:
    return fired_codes((code, f"({MASK} & {1 << k}L) <> 0") for k, (code, _) in enumerate(violations(entity)))


def clean(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(MASK) == 0)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(MASK) != 0)
