"""Salted pseudonyms, built from the JVM hash functions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from profilegate import schemas as S

_BLOCK = 64


def _pads(salt: str) -> tuple[bytes, bytes]:
    key = salt.encode()
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256(message: Column, salt: str) -> Column:
    """RFC 2104 HMAC of a text column as lower-case hex: two nested hashes over a padded key."""
    inner_pad, outer_pad = _pads(salt)
    inner = F.sha2(F.concat(F.lit(inner_pad), F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(F.lit(outer_pad), F.unhex(inner)), 256)


def pseudonym(source: Column, source_user_id: Column, salt: str | None) -> Column:
    """``sha256:<hmac of source:id>``; null where there is no id to protect."""
    if not salt:
        raise ValueError("a pseudonymization salt is required")
    message = F.concat(F.coalesce(source, F.lit("")), F.lit(":"), source_user_id)
    return F.when(source_user_id.isNotNull() & (source_user_id != ""),
                  F.concat(F.lit(S.PSEUDONYM_PREFIX), hmac_sha256(message, salt)))
