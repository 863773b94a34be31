"""Durations, timestamps, retry classes and waits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.functions.text import strip, truthy


def iso_duration(seconds: Column) -> Column:
    """``12.3`` -> ``PT12.3S``; zeros after the point go."""
    text = F.regexp_replace(F.format_string("%.6f", seconds), r"0+$", "")
    return F.concat(F.lit("PT"), F.regexp_replace(text, r"\.$", ""), F.lit("S"))


def iso_timestamp(ts: Column) -> Column:
    """UTC timestamp with ``Z``; microseconds only when they are not zero."""
    return F.concat(
        F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", ""), F.lit("Z")
    )


def retry_class(status: Column, error: Column) -> Column:
    """Page fetch: ``ok``, ``transient`` (try again) or ``fatal``."""
    return (
        F.when(error.isNotNull() | status.isNull(), F.lit("transient"))
        .when((status == 429) | (status >= 500), F.lit("transient"))
        .when(status >= 400, F.lit("fatal"))
        .otherwise(F.lit("ok"))
    )


def catalogue_retry_class(status: Column, error: Column) -> Column:
    """Catalogue fetch: every 4xx is fatal; network, timeout and XML-syntax errors are transient.

    ``error`` names the kind of failure: ``network``, ``timeout``, ``xml_syntax`` or ``value``.
    """
    return (
        F.when(status.between(400, 499), F.lit("fatal"))
        .when(error.isin("network", "timeout", "xml_syntax") | (status >= 500), F.lit("transient"))
        .when(error.isNotNull(), F.lit("fatal"))
        .otherwise(F.lit("ok"))
    )


def backoff(
    attempt: Column,
    *jitter_key: Column,
    base: float = 1.0,
    factor: float = 2.0,
    cap: float = 600.0,
    jitter: bool = True,
) -> Column:
    """Seconds before the next attempt. The jitter in [0.9, 1.1) is a hash of its key, so reruns agree."""
    delay = F.lit(base) * F.pow(F.lit(factor), attempt.cast("double") - 1)
    if jitter:
        share = F.pmod(F.xxhash64(*(jitter_key or (attempt,)), attempt), F.lit(1_000_000)) / F.lit(1e6)
        delay = delay * (F.lit(0.9) + F.lit(0.2) * share)
    return F.least(delay, F.lit(cap))


def retry_after_seconds(value: Column, now: Column) -> Column:
    """Wait asked for by the server: digits, or an HTTP date measured from ``now``; null when unreadable."""
    text = strip(value)
    stamp = F.regexp_replace(F.regexp_replace(text, r"^[A-Za-z]{3},\s*", ""), r"\s*(GMT|UTC|Z)$", "")
    zoned = F.when(stamp.rlike(r"[+-][0-9]{4}$"), stamp).otherwise(F.concat(stamp, F.lit(" +0000")))
    when = F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss xx"))
    micros = F.unix_micros(when) - F.unix_micros(now)
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("double")).when(
        truthy(value).isNotNull() & micros.isNotNull(), F.greatest(micros / F.lit(1e6), F.lit(0.0))
    )


def effective_delay(local: Column, status: Column, server_wait: Column, cap: float = 600.0) -> Column:
    """The longer of the local and the server's wait, capped. Only 429 and 503 bring a server wait.

    ``status`` is the last response seen, which may be older than a later network error.
    """
    return F.when(
        status.isin(429, 503) & server_wait.isNotNull(), F.least(F.greatest(local, server_wait), F.lit(cap))
    ).otherwise(local)
