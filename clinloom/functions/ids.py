"""Deterministic and keyed identifiers as column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def hash_id(text: Column) -> Column:
    """The first 15 hex digits of the text's SHA-256 as a long."""
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def canonical_identity(ref: Column) -> Column:
    """A reference's identity: urn:uuid: is stripped; an absolute http(s) URL keeps its lower-cased scheme
    and host and its path up to _history; of anything else the last path segment stays, or the one before
    _history. Null is empty."""
    value = F.trim(F.coalesce(ref, F.lit("")))
    plain = F.regexp_replace(F.regexp_replace(value, r"[?#].*$", ""), "/+$", "")
    path = F.regexp_replace(plain, r"/_history(/.*)?$", "")
    host = F.regexp_extract(path, r"^([A-Za-z]+://[^/]+)", 1)
    url = F.concat(F.lower(host), F.substring(path, F.length(host) + 1, F.length(path)))
    local = F.trim(F.regexp_replace(F.element_at(F.split(path, "/"), -1), "urn:uuid:", ""))
    return (
        F.when(value.rlike("(?i)^urn:uuid:"), F.trim(F.substring(value, 10, 1 << 30)))
        .when(value.rlike("(?i)^https?://[^/?#]"), F.regexp_replace(url, "/+$", ""))
        .otherwise(local)
    )


def hmac_sha256(text: Column, key: bytes) -> Column:
    """HMAC-SHA256 in hex, from two nested digests."""
    import hashlib

    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    inner, outer = bytes(k ^ 0x36 for k in key), bytes(k ^ 0x5C for k in key)
    first = F.unhex(F.sha2(F.concat(F.lit(inner), text.cast("binary")), 256))
    return F.sha2(F.concat(F.lit(outer), first), 256)


def _required(text: Column, what: str) -> Column:
    return F.when(F.length(text) > 0, text).otherwise(F.raise_error(F.lit(f"{what} must not be empty")).cast("string"))


def person_id(ref: Column, key: bytes) -> Column:
    """A person's id: the keyed digest of the identity, modulo 2 ** 62. An empty identity fails."""
    return person_of(identity_digest(ref, key, "a patient's identity"))


def person_of(digest: Column) -> Column:
    # the last 62 bits: the last 15 hex digits and two bits of the one before
    low = F.conv(F.substring(digest, 50, 15), 16, 10).cast("long")
    high = F.conv(F.substring(digest, 49, 1), 16, 10).cast("long")
    return F.shiftleft(high % 4, 60).bitwiseOR(low)


def event_id(ref: Column, key: bytes) -> Column:
    """An event's id: the first 15 hex digits of the keyed digest. An empty identity fails."""
    return event_of(identity_digest(ref, key, "an event's identity"))


def identity_digest(ref: Column, key: bytes, what: str = "an identity") -> Column:
    """The keyed digest that both a person's and an event's id are made of. An empty identity fails."""
    return hmac_sha256(_required(canonical_identity(ref), what), key)


def event_of(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def payload_event_id(payload: Column, key: bytes, path: Column | None = None) -> Column:
    """An event's id from its payload, and the path of a component in it."""
    text = _required(payload, "a resource's payload")
    if path is not None:
        text = F.when(F.coalesce(F.length(path), F.lit(0)) > 0, F.concat_ws("::", text, path)).otherwise(text)
    return F.conv(F.substring(hmac_sha256(text, key), 1, 15), 16, 10).cast("long")


def fingerprint(payload: Column, key: bytes) -> Column:
    return F.concat(F.lit("hmac256:"), hmac_sha256(payload, key))


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """Version 5 UUID of a name in a namespace."""
    digest = F.sha1(F.concat(F.lit(namespace.bytes), name.cast("binary")))
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 8
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lower(F.hex(variant)), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
