"""Text helpers: exact number formatting, audit fingerprint, time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_int(x: Column) -> Column:
    """Round a non-negative double half-up to an integer (same in every engine)."""
    return F.floor(x + F.lit(0.5)).cast("long")


def one_decimal(x: Column) -> Column:
    """``{x:.1f}`` for a non-negative double, half-up on the binary value."""
    t = F.floor(x * 10 + F.lit(0.5)).cast("long")
    return F.concat((t / 10).cast("long").cast("string"), F.lit("."), (t % 10).cast("string"))


def cents_to_dollars_text(cents: Column) -> Column:
    """``{usd:.0f}`` from exact integer cents, half-up."""
    return F.floor((cents + F.lit(50)) / F.lit(100)).cast("long").cast("string")


def ratio_text(lo: Column, hi: Column) -> Column:
    """``{lo/hi:.2f}`` from exact integers, half-up."""
    r = F.floor((lo * 200 + hi) / (hi * 2)).cast("long")
    return F.concat((r / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((r % 100).cast("string"), 2, "0"))


def fingerprint(tid: Column, cid: Column, amount: Column, ts_ms: Column, channel: Column) -> Column:
    """SHA-256 of ``id|customer|amount|ts|channel``; amount as decimal(18,2) text."""
    parts = [tid.cast("string"), cid.cast("string"), amount.cast("decimal(18,2)").cast("string"),
             ts_ms.cast("string"), channel]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def parse_time(text: Column, *patterns: str) -> Column:
    """First pattern that parses; bad text gives null instead of an ANSI error."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])
