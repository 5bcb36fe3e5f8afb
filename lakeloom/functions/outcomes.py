"""What a fetch's outcome means, as data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: HTTP statuses worth another try.
RETRYABLE = (408, 409, 425, 429, 500, 501, 502, 503, 504, 521, 522, 523, 524)
GONE = (404, 410)


def classify_error(status: Column, kind: Column) -> Column:
    """``permanent``, ``blocked``, ``rate_limit`` or ``transient``; ``kind`` may be ``undecodable``."""
    return (
        F.when((kind == "undecodable") | status.isin(*GONE), "permanent")
        .when((status == 429) | status.between(500, 599), "rate_limit")
        .when(status == 403, "blocked")
        .otherwise("transient")
    )


def retryable(status: Column) -> Column:
    return status.isin(*RETRYABLE)


def backoff(attempt: Column, wait: float, limit: float | None = None) -> Column:
    """Doubling waits, at most ``limit``."""
    grown = F.lit(wait) * F.pow(F.lit(2.0), attempt)
    return grown if limit is None else F.least(grown, F.lit(limit))


def verified(content: Column, md5: Column, size: Column) -> Column:
    """Whether bytes have the announced digest and size."""
    return (F.md5(content) == F.lower(md5)) & (F.length(content) == size)
