"""Request batches, retry delays and the rolling quota."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    """Ceilings of one batch and of the rolling window."""

    max_items: int = 16
    max_tokens: int = 45_000
    max_bytes: int = 8_000_000
    concurrency: int = 2
    attempts: int = 3
    initial_backoff: float = 1.0
    max_backoff: float = 30.0
    quota_requests: int = 90
    quota_tokens: int = 90_000
    window_seconds: int = 60

    def coherent(self) -> bool:
        """Positive integers, and one full wave fits the quota."""
        values = (self.concurrency, self.max_tokens, self.quota_requests, self.quota_tokens, self.window_seconds)
        return all(type(v) is int and v > 0 for v in values) and self.concurrency <= self.quota_requests and self.concurrency * self.max_tokens <= self.quota_tokens


class Packer:
    """First-come packing of a stream of items under three ceilings."""

    def __init__(self, policy: Policy) -> None:
        self.policy, self.batch, self.used = policy, 0, (0, 0, 0)

    def place(self, tokens: int, size: int) -> int | None:
        """The batch number of the next item, from 1; None if no batch can hold it."""
        p = self.policy
        if tokens > p.max_tokens or size > p.max_bytes:
            return None
        n, t, b = self.used
        if self.batch == 0 or n + 1 > p.max_items or t + tokens > p.max_tokens or b + size > p.max_bytes:
            self.batch, self.used = self.batch + 1, (1, tokens, size)
        else:
            self.used = (n + 1, t + tokens, b + size)
        return self.batch


def pack(items: DataFrame, group: str, order: str, policy: Policy = Policy()) -> DataFrame:
    """Items (group, order, tokens, bytes) with batch_no, null where an item is over budget alone.

    Packing is sequential within a declared group; items stream through in order, nothing is collected.
    """
    kinds = {c: items.schema[c].dataType.simpleString() for c in (group, order)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, at = None, object()
        for pdf in batches:
            out = []
            for g, t, b in zip(pdf[group], pdf["tokens"], pdf["bytes"]):
                if packer is None or g != at:
                    packer, at = Packer(policy), g
                out.append(packer.place(t, b))
            yield pdf.assign(batch_no=pd.array(out, dtype="Int64"))

    given = items.select(group, order, F.col("tokens").cast("long").alias("tokens"), F.col("bytes").cast("long").alias("bytes"))
    return given.repartition(group).sortWithinPartitions(group, order).mapInPandas(run, f"`{group}` {kinds[group]}, `{order}` {kinds[order]}, tokens long, bytes long, batch_no long")


def retry_delay(attempt: Column, policy: Policy, retry_after: Column | None = None, resets: list[Column] = [], jitter: Column | None = None) -> Column:  # noqa: B006
    """min(max, max(backoff * 2^(attempt-1), Retry-After, resets) + jitter)."""
    top = F.lit(policy.max_backoff)
    waits = [F.least(top, F.lit(policy.initial_backoff) * F.pow(F.lit(2.0), attempt - 1)), *([retry_after.cast("double")] if retry_after is not None else []), *resets]
    longest = F.greatest(*waits) if len(waits) > 1 else waits[0]
    return F.least(top, longest + (jitter if jitter is not None else F.lit(0.0)))


def rolling_usage(requests: DataFrame, time: str, tokens: str, by: list[str], seconds: int = 60) -> DataFrame:
    """Requests with those of the trailing half-open window (now - seconds, now]: their number and tokens.

    Time is cut into stretches of a window's length; a row also stands in the stretch after its own, where
    it can still count but gives no result. So no group, not even that of all rows (`by` empty), is one task's.
    """
    width = seconds * 1_000_000
    w = Window.partitionBy(*by, "_stretch").orderBy("_us").rangeBetween(-(width - 1), 0)
    own = requests.withColumn("_us", F.unix_micros(F.col(time).cast("timestamp")))
    spread = own.withColumn("_late", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_stretch", F.floor(F.col("_us") / width) + F.col("_late"))
    counted = spread.withColumn("window_requests", F.count("*").over(w)).withColumn("window_tokens", F.sum(tokens).over(w))
    return counted.filter("_late = 0").drop("_us", "_late", "_stretch")


def wait_seconds(reservations: list[tuple[datetime, int]], costs: list[int], now: datetime, policy: Policy) -> float:
    """0 if a wave of requests fits the window now, else the least delay after which it does.

    A reservation expires `window_seconds` after it was made, that instant included.
    """
    if not policy.coherent():
        raise ValueError("the policy is not coherent")
    if not costs or len(costs) > min(policy.concurrency, policy.quota_requests) or any(type(c) is not int or not 0 <= c <= policy.max_tokens for c in costs) or sum(costs) > policy.quota_tokens:
        raise ValueError("the wave exceeds the policy")
    if now.tzinfo is None or any(at.tzinfo is None or at > now or type(t) is not int or t < 0 for at, t in reservations):
        raise ValueError("the reservations are not valid")
    live = sorted(reservations)
    freed = [0, *accumulate(t for _, t in live)]  # tokens that are free again after the oldest k have expired
    expire = max(0, len(live) + len(costs) - policy.quota_requests, bisect_left(freed, freed[-1] + sum(costs) - policy.quota_tokens))
    if expire > len(live):
        raise ValueError("the reservations are not valid")
    return max(0.0, (live[expire - 1][0] + timedelta(seconds=policy.window_seconds) - now).total_seconds()) if expire else 0.0


# Codes of HTTP statuses; the other ones are request_failure.
HTTP_CODES = {401: "authentication", 403: "authorization", 429: "rate_limit"}
DETERMINISTIC = (400, 404, 409, 413, 422)


def http_outcome(status: Column) -> tuple[Column, Column]:
    """(error code, retryable) of an HTTP status; both null on success."""
    code = F.when(status.between(200, 299), F.lit(None).cast("string"))
    for value, name in HTTP_CODES.items():
        code = code.when(status == value, name)
    code = code.when(status.isin(*DETERMINISTIC), "deterministic_request").when(status.between(500, 599), "transient_server").otherwise("request_failure")
    return code, F.when(code.isNotNull(), code.isin("rate_limit", "transient_server"))


# Usage counters that are kept.
USAGE = ("input_tokens", "output_tokens", "prompt_tokens", "total_tokens")


def sum_usage(exchanges: DataFrame, usage: str, by: list[str]) -> DataFrame:
    """(by, name, total) over maps of usage counters; unknown names and bad numbers are left out."""
    good = F.map_filter(usage, lambda k, v: k.isin(*USAGE) & v.isNotNull() & ~F.isnan(v.cast("double")) & (v >= 0))
    return exchanges.select(*by, F.explode(good).alias("name", "value")).groupBy(*by, "name").agg(F.sum("value").alias("total"))
