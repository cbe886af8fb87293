"""Keyed pseudonyms (HMAC-SHA256, base64) as a column expression."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def _pads(key: bytes) -> tuple[bytes, bytes]:
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def pseudonym(col: Column, key: bytes) -> Column:
    """Base64 text of HMAC-SHA256(key, utf-8 text of ``col``); NULL stays NULL.

    The key comes from the caller's configuration. It becomes part of the query plan, so keep
    plan logging off, or hash before the data reaches a shared cluster, when the key is secret.
    """
    inner, outer = _pads(key)
    text = F.encode(col.cast("string"), "UTF-8")
    first = F.unhex(F.sha2(F.concat(F.lit(inner), text), 256))
    return F.base64(F.unhex(F.sha2(F.concat(F.lit(outer), first), 256)))
