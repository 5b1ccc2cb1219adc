"""Keyed hashes built from Spark's own ``sha2``, so they stay inside codegen."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the salt used when none is configured.
DEFAULT_SALT = "default-anonymization-salt-value"

_BLOCK = 64


def _pads(salt: str) -> tuple[str, str]:
    key = salt.encode("utf-8")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    inner = bytes(b ^ 0x36 for b in key).hex()
    outer = bytes(b ^ 0x5C for b in key).hex()
    return inner, outer


def hmac_hex(value: Column, salt: str = DEFAULT_SALT, length: int = 12) -> Column:
    """First ``length`` hex digits of HMAC-SHA256(salt, value as UTF-8)."""
    inner, outer = (F.unhex(F.lit(pad)) for pad in _pads(salt))
    first = F.unhex(F.sha2(F.concat(inner, F.encode(value, "UTF-8")), 256))
    return F.substring(F.sha2(F.concat(outer, first), 256), 1, length)


def sha256_hex(value: Column, length: int) -> Column:
    """First ``length`` hex digits of SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(F.encode(value, "UTF-8"), 256), 1, length)
