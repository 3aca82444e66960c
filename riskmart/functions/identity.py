"""Deterministic keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_NAMESPACE = "riskmart/replay"


def hashed_key(*parts: Column | str) -> Column:
    """SHA-256 over the parts joined by ``|``; NULL parts are left out."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def name_uuid(name: Column, namespace: uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """Version-5 UUID of a text, equal to ``uuid.uuid5(namespace, name)``."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("binary"))).cast("binary")

    def part(start: int, length: int) -> Column:
        return F.substring(digest, start, length)  # of bytes: no search for the beginning of a character

    # The variant nibble keeps its two low bits and becomes 8, 9, a or b. Character codes of
    # 0 to 9 begin at a multiple of four, those of a to f one below their value.
    code = F.ascii(part(17, 1).cast("string"))
    variant = F.substring(F.lit("89ab"), (code + F.shiftright(code, 6)).bitwiseAND(3) + 1, F.lit(1))
    dash = F.lit("-").cast("binary")
    return F.concat(
        part(1, 8), dash, part(9, 4), F.lit("-5").cast("binary"), part(14, 3), dash,
        variant.cast("binary"), part(18, 3), dash, part(21, 12),
    ).cast("string")


def entity_uuid(entity: str, key: Column, namespace: str = DEFAULT_NAMESPACE) -> Column:
    """UUID of a source key; the namespace text keeps different replays apart."""
    return name_uuid(F.concat(F.lit(f"{namespace}/{entity}/"), key))


def listing_key(product: str = "product_id", seller: str = "seller_id") -> Column:
    return F.concat_ws(":", product, seller)
