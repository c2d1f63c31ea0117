"""Keyed pseudonyms as a native expression."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def hmac_pads(secret: str) -> tuple[bytes, bytes]:
    """Inner and outer key pads of HMAC-SHA256 (RFC 2104)."""
    key = secret.encode("utf-8")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def pseudonymize(user_id: Column, secret: str) -> Column:
    """HMAC-SHA256 of the UTF-8 user id as 64 lowercase hex characters.

    Two ``sha2`` calls keep the hashing inside generated code: no Python worker.
    """
    inner_pad, outer_pad = hmac_pads(secret)
    inner = F.unhex(F.sha2(F.concat(F.lit(inner_pad), F.encode(user_id, "UTF-8")), 256))
    return F.sha2(F.concat(F.lit(outer_pad), inner), 256)
