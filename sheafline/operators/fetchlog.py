"""Fetch policy over logged requests: robots rules, host delays, polite schedules, final attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafline.functions.text import unquote, url_host, url_target
from sheafline.functions.timefmt import retry_class
from sheafline.operators.scan import BLOCK_ROWS, blocked_row_number, blocked_scan, ordinal_block


def host_rules(rules: DataFrame, product: str) -> DataFrame:
    """One row per host: the rule lines and crawl delay of the group that applies to ``product``.

    ``rules``: ``host, pos, agent, allow, path, crawl_delay`` and, when known, ``entry`` (the number of the
    group within the file; without it rules of one agent are one group). The first group that names the
    product wins over the first group for ``*``. A host's rules are one robots file, so the array stays small.
    """
    agent = F.lower("agent")
    named = (agent != "*") & F.lit(product.split("/")[0].lower()).contains(agent)
    entry = F.col("entry").cast("string") if "entry" in rules.columns else agent
    lines = rules.withColumn("__named", named).filter(F.col("__named") | (agent == "*"))
    line = F.struct("pos", "__named", entry.alias("entry"), "allow", "path", "crawl_delay")
    # A set, so that a file landed many times is no larger than once.
    per_host = lines.groupBy("host").agg(F.array_sort(F.collect_set(line)).alias("lines"))
    leading = F.coalesce(F.get(F.filter("lines", lambda r: r["__named"]), F.lit(0)), F.get("lines", F.lit(0)))
    # Any named line outranks the starred ones, so the leading line's own flag tells which kind it is.
    per_host = per_host.withColumn("__lead", leading)
    chosen = F.filter(
        "lines",
        lambda r: (r["entry"] == F.col("__lead.entry")) & (r["__named"] == F.col("__lead.__named")),
    )
    return per_host.select(
        "host",
        F.transform(
            F.filter(chosen, lambda r: r["path"].isNotNull()),
            lambda r: F.struct(
                # An empty path lifts a ban: "Disallow:" alone allows everything.
                (r["allow"] | (r["path"] == "")).alias("allow"),
                r["path"].alias("path"),
            ),
        ).alias("rules"),
        F.get(F.filter(chosen, lambda r: r["crawl_delay"].isNotNull()), F.lit(0))["crawl_delay"].alias("crawl_delay"),
    )


def robots_allowed(urls: DataFrame, rules: DataFrame, product: str, respect: bool = True) -> DataFrame:
    """Add ``allowed``: the first rule whose path starts the URL's target decides; no rule allows.

    URLs meet one rule array per host, so no URL-rule pairs are built; a hot host is split by the
    adaptive skew join.
    """
    if not respect:
        return urls.withColumn("allowed", F.lit(True))
    # Host and target are columns below the join, so they are computed once per URL and not once per rule.
    keyed = urls.withColumn("__host", url_host(F.col("url"))).withColumn("__target", unquote(url_target(F.col("url"))))
    per_host = host_rules(rules, product).select(F.col("host").alias("__host"), "rules")
    hit = F.get(
        F.filter("rules", lambda r: (r["path"] == "*") | F.col("__target").startswith(r["path"])), F.lit(0)
    )
    return keyed.join(per_host, "__host", "left").select(
        *[F.col(c) for c in urls.columns], F.coalesce(hit["allow"], F.lit(True)).alias("allowed")
    )


def rate_delay(max_requests_per_second: float | None) -> float:
    """Seconds between requests of one host; no or a non-positive rate means no delay."""
    if max_requests_per_second is None or max_requests_per_second <= 0:
        return 0.0
    return 1.0 / max_requests_per_second


def host_delay(hosts: DataFrame, rules: DataFrame, product: str, max_requests_per_second: float | None) -> DataFrame:
    """Delay per host: the larger of the configured rate and the host's crawl delay."""
    per_host = host_rules(rules, product).select("host", "crawl_delay")
    base = F.lit(rate_delay(max_requests_per_second))
    return hosts.join(per_host, "host", "left").select(
        *[F.col(c) for c in hosts.columns],
        F.greatest(base, F.coalesce(F.col("crawl_delay").cast("double"), F.lit(0.0))).alias("delay"),
    )


def polite_schedule(
    requests: DataFrame,
    host: str = "host",
    arrival: str = "arrival",
    rid: str = "id",
    delay: str = "delay",
    block_micros: int = 3_600_000_000,
    id_width: int = BLOCK_ROWS,
) -> DataFrame:
    """Send time (microseconds) of every request: not before its arrival, ``delay`` after the host's previous one.

    ``send_n = max(arrival_n, send_{n-1} + delay)`` has the closed form
    ``max(arrival_i - i*delay) + n*delay``. Requests arriving together (a whole sitemap usually does)
    are first folded to one row per host and instant. That series is cut into time blocks; inside a block
    positions count from the block's start, and one row per block carries count and peak on to the next, so
    no step holds a whole host. Inside an instant requests go out in id order.

    ``arrival`` and ``delay`` are whole microseconds, ``delay`` is one value per host, ``rid`` is a unique
    whole number; for sparse numbers pass ``id_width`` from :func:`sheafline.operators.scan.ordinal_width`.
    """
    instants = requests.groupBy(host, arrival).agg(F.count(F.lit(1)).alias("__n"), F.max(delay).alias("__d"))
    blocked = instants.withColumn("__b", ordinal_block(F.col(arrival), block_micros))
    inside = Window.partitionBy(host, "__b").orderBy(arrival)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.withColumn("__k", F.sum("__n").over(upto) - F.col("__n"))
    slack = F.col(arrival) - F.col("__k") * F.col("__d")

    per_block = local.groupBy(host, "__b").agg(
        F.sum("__n").alias("__bn"), F.max(slack).alias("__bpeak"), F.max("__d").alias("__bd")
    )
    earlier = Window.partitionBy(host).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.withColumn("__off", F.coalesce(F.sum("__bn").over(earlier), F.lit(0))).select(
        host, "__b", "__off", F.max(F.col("__bpeak") - F.col("__off") * F.col("__bd")).over(earlier).alias("__carry")
    )
    peaked = local.withColumn("__peak", F.max(slack).over(upto)).join(offsets, [host, "__b"])
    first = F.greatest(F.col("__peak") - F.col("__off") * F.col("__d"), F.col("__carry")) + (
        F.col("__off") + F.col("__k")
    ) * F.col("__d")
    starts = peaked.select(host, arrival, first.alias("__first"))

    numbered = blocked_row_number(
        requests, [host, arrival], [F.col(rid)], ordinal_block(F.col(rid), id_width), name="__k"
    )
    return numbered.join(starts, [host, arrival]).select(
        *[F.col(c) for c in requests.columns],
        (F.col("__first") + (F.col("__k") - 1) * F.col(delay)).cast("bigint").alias("send_at"),
    )


def final_attempt(log: DataFrame, retries: int = 5) -> DataFrame:
    """Outcome per URL: the first success or fatal answer ends it, else the last allowed attempt."""
    result = retry_class(F.col("status"), F.col("error"))
    ends = F.col("__class") != "transient"
    used = log.withColumn("__class", result).filter(F.col("attempt") <= 1 + retries)
    row = F.struct("status", "error", F.col("__class").alias("class"), "attempt")
    folded = used.groupBy("url").agg(
        F.min_by(row, F.when(ends, F.col("attempt"))).alias("__end"), F.max_by(row, "attempt").alias("__last")
    )
    final = F.coalesce("__end", "__last")
    return folded.select(
        "url",
        final["status"].alias("status"),
        final["error"].alias("error"),
        F.when(final["class"] == "transient", F.lit("failed")).otherwise(final["class"]).alias("outcome"),
        final["attempt"].alias("attempts"),
    )


def last_response(log: DataFrame) -> DataFrame:
    """Add the latest response at or before each attempt: a network error keeps the earlier answer's wait."""
    answer = F.when(F.col("status").isNotNull(), F.struct("attempt", "status", "retry_after"))
    scanned = blocked_scan(
        log, ["url"], [F.col("attempt")], ordinal_block(F.col("attempt")), {"__seen": ("max", answer)}
    )
    return scanned.select(
        *[F.col(c) for c in log.columns],
        F.col("__seen.status").alias("seen_status"),
        F.col("__seen.retry_after").alias("seen_retry_after"),
    )
