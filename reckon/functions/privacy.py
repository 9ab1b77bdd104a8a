"""Refusing live payloads, blanking personal fields, and verifying signed deliveries."""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_live(payload: str) -> Column:
    """Whether a payload says anywhere that it is of live mode."""
    return F.coalesce(F.col(payload).rlike(r'"livemode"\s*:\s*true'), F.lit(False))


def blanked(payload: str, keys: Sequence[str]) -> Column:
    """The payload with the string values of the keys blanked at any depth; NULL values stay NULL."""
    names = "|".join(keys)
    return F.regexp_replace(payload, rf'("(?:{names})"\s*:\s*)"(?:[^"\\]|\\.)*"', '$1""')


#: What account ids and receipt links become (fixed values).
ACCOUNT, RECEIPT = "acct_00000000000000", "https://example.invalid/receipts/redacted"


def test_mode(payload: str) -> Column:
    """The payload; one of live mode stops the run, because nothing of it may be stored."""
    return F.when(is_live(payload), F.raise_error(F.lit("a payload of live mode is refused"))).otherwise(F.col(payload))


def redacted(payload: str, keys: Sequence[str]) -> Column:
    """The payload, refused if live, without personal values, account ids and receipt links. Nothing else changes."""
    guarded = F.when(is_live(payload), F.raise_error(F.lit("a payload of live mode is refused"))).otherwise(blanked(payload, keys))
    linkless = F.regexp_replace(guarded, r'https?://[^"\\\s/]+/receipts/[^"\\\s]*', RECEIPT)
    return F.regexp_replace(linkless, r"\bacct_[A-Za-z0-9]+", ACCOUNT)


#: What must not be published, by name (fixed values: the forms of the processor's credentials).
LEAKS = {
    "live_key": r"\b[srp]k_live_[A-Za-z0-9]+", "test_key": r"\b[sr]k_test_[A-Za-z0-9]{16,}", "signing_secret": r"\bwhsec_[A-Za-z0-9_-]{16,}", "account": r"\bacct_(?!0{14}\b)[A-Za-z0-9]{8,}",
    "receipt": r"https?://[^\"\\\s/]+/receipts/[^\"\\\s]*[?/][A-Za-z0-9]{8,}", "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
}


def leaks(text: str) -> Column:
    """The names of all that a text holds and that must not be published; empty for NULL."""
    return F.array_compact(F.array(*[F.when(F.col(text).rlike(form), F.lit(name)) for name, form in LEAKS.items()]))


def masked(text: str) -> str:
    """The text with every credential cut to its prefix."""
    return re.sub(r"\b(sk|rk|pk)_(?:live|test)_[A-Za-z0-9]+|\b(whsec)_[A-Za-z0-9_-]+", lambda m: f"{m[1] or m[2]}_***", text)


def signed(body: bytes, header: str, secrets: Sequence[str], now: int, tolerance: int = 300) -> bool:
    """Whether ``t=...,v1=...`` signs the raw bytes with one of the secrets, not too long ago.

    The signature covers the time, a full stop and the body as received.
    """
    parts = [p.split("=", 1) for p in header.split(",") if "=" in p]
    times = [v for k, v in parts if k == "t"]
    if len(times) != 1 or not times[0].isdigit() or abs(now - int(times[0])) > tolerance:
        return False
    given = [v for k, v in parts if k == "v1"]
    expected = [hmac.new(s.encode(), times[0].encode() + b"." + body, hashlib.sha256).hexdigest() for s in secrets]
    return any(hmac.compare_digest(g, e) for g in given for e in expected)
