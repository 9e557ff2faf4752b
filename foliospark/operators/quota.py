"""Durable quota reservations, and what responses say about usage and limits."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.operators.batching import Policy, wait_seconds

# Bounds of response metadata that is looked at.
MAX_NODES, MAX_DEPTH, MAX_CHILDREN, MAX_STRING = 100_000, 32, 20_000, 64 << 10
MAX_TOKENS = 1_000_000_000
RATE_HEADERS = ("retry-after", "x-ratelimit-remaining-requests", "x-ratelimit-remaining-tokens", "x-ratelimit-reset-requests", "x-ratelimit-reset-tokens")


def live(reservations: DataFrame, now: Column, policy: Policy) -> DataFrame:
    """Reservations (reserved_at, tokens) that have not expired; one made exactly a window ago has."""
    return reservations.filter(F.unix_micros("reserved_at") > F.unix_micros(now) - policy.window_seconds * 1_000_000)


def within_window(reservations: DataFrame, now: datetime, policy: Policy) -> list[tuple[datetime, int]]:
    """The live reservations, oldest first; ValueError if there are more than the policy allows, which no run can have made."""
    at = lambda t: t.astimezone(UTC) if t.tzinfo else t.replace(tzinfo=UTC)
    kept = live(reservations, F.lit(now), policy).select("reserved_at", "tokens").orderBy("reserved_at").take(policy.quota_requests + 1)
    if len(kept) > policy.quota_requests:
        raise ValueError("more requests are reserved than the policy allows")
    return [(at(r.reserved_at), r.tokens) for r in kept]


def reserve(reservations: DataFrame, costs: list[int], now: datetime, policy: Policy) -> tuple[float, list[int]]:
    """(seconds to wait, tokens to reserve): all of a wave's requests or none of them. Only a window's reservations are read."""
    wait = wait_seconds(within_window(reservations, now, policy), costs, now, policy)
    return wait, [] if wait else list(costs)


class Pace:
    """Holds a stream of waves of requests to the rolling quota, and its concurrency to what the provider bears.

    Reserves before a wave is sent and gives nothing back; usage that is reported later can only raise what
    was reserved. `clock` and `sleep` can be replaced in tests.
    """

    def __init__(self, policy: Policy, made: list[tuple[datetime, int]] = [], clock: Callable[[], datetime] = lambda: datetime.now(UTC), sleep: Callable[[float], None] = time.sleep) -> None:  # noqa: B006
        self.policy, self.clock, self.sleep = policy, clock, sleep
        self.live, self.reserved, self.concurrency, self.throttles = sorted(made), [], policy.concurrency, 0

    def admit(self, costs: list[int]) -> list[int]:
        """Wait until the wave fits, reserve it, and return the numbers of its reservations."""
        while True:
            now = self.clock()
            self.live = [x for x in self.live if (now - x[0]).total_seconds() < self.policy.window_seconds]
            wait = wait_seconds(self.live, costs, now, self.policy)
            if not wait:
                break
            self.sleep(wait)
        self.live += [(now, c) for c in costs]
        self.reserved += [[now, c, None] for c in costs]
        return list(range(len(self.reserved) - len(costs), len(self.reserved)))

    def observe(self, number: int, usage: object) -> None:
        """Take note of the input tokens that a response reports."""
        seen = observed_tokens(usage)
        at, estimate, _ = self.reserved[number]
        if seen is not None:
            self.reserved[number][2] = max(seen, estimate)
            if seen > estimate:
                self.live.append((at, seen - estimate))

    def throttle(self) -> None:
        self.throttles += 1
        self.concurrency = max(1, self.concurrency // 2)


def settle_usage(estimates: dict[str, int], observed: int | None) -> dict[str, int]:
    """Reservations of one response after its usage is known: debt can only rise, and the excess goes to the least id."""
    out = dict(estimates)
    if out and observed is not None and (excess := observed - sum(out.values())) > 0:
        out[min(out)] += excess
    return out


def observed_tokens(usage: object) -> int | None:
    """The integral input tokens that a response reports, or None."""
    value = usage.get("input_tokens", usage.get("prompt_tokens")) if isinstance(usage, dict) else None
    if isinstance(value, bool) or not isinstance(value, int | float) or not math.isfinite(value) or not 0 <= value <= MAX_TOKENS or value != int(value):
        return None
    return int(value)


def seconds(value: object, now: datetime) -> float | None:
    """Seconds to wait by a number or an HTTP date with a zone; None if it is neither, or negative."""
    text = str(value).strip()
    try:
        wait = float(text)
    except ValueError:
        try:
            at = parsedate_to_datetime(text)
        except ValueError:
            return None
        if at.tzinfo is None:
            return None
        wait = max(0.0, (at - now).total_seconds())
    return wait if math.isfinite(wait) and wait >= 0 else None


def rate_headers(headers: dict, now: datetime) -> dict[str, float]:
    """The known rate headers as numbers."""
    low = {str(k).lower(): v for k, v in headers.items()}
    return {k: s for k in RATE_HEADERS if k in low and (s := seconds(low[k], now)) is not None}


def throttled(headers: dict[str, float]) -> bool:
    """Whether no requests or no tokens are left, at which the concurrency is halved."""
    return headers.get(RATE_HEADERS[1]) == 0 or headers.get(RATE_HEADERS[2]) == 0


def bounded(value: object) -> bool:
    """Whether response metadata is small enough to be kept: nodes, depth, children and strings."""
    todo, nodes = [(value, 0)], 0
    while todo:
        v, depth = todo.pop()
        nodes += 1
        if nodes > MAX_NODES or depth > MAX_DEPTH or (isinstance(v, str) and len(v.encode("utf-8", "surrogatepass")) > MAX_STRING):
            return False
        if isinstance(v, dict | list):
            if len(v) > MAX_CHILDREN:
                return False
            todo += [(x, depth + 1) for x in (v if isinstance(v, list) else [*v.keys(), *v.values()])]
    return True
