"""Retrying: which errors are worth it, how long to wait, and a helper for calls on the driver (tasks are retried by Spark itself)."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamstack.functions.scalars import backoff_seconds


class TypedError(Exception):
    """An error with a kind and a flag that says whether another attempt can help."""

    def __init__(self, kind: str, retryable: bool = True, message: str = ""):
        super().__init__(message or kind)
        self.kind, self.retryable = kind, retryable


@dataclass(frozen=True)
class RetryPolicy:
    attempts: int = 5
    initial: float = 1.0
    cap: float = 30.0
    factor: float = 2.0
    jitter: bool = True
    kinds: tuple[str, ...] = ("transient", "network", "rate_limit")

    def wants(self, error: BaseException) -> bool:
        """Only typed errors of a listed kind that are flagged as retryable."""
        return isinstance(error, TypedError) and error.kind in self.kinds and error.retryable

    def delay(self, attempt: int, u: float | None = None) -> float:
        """Seconds before the next attempt. The jitter, about 5 % either way, is added after the cap and may pass it."""
        d = min(self.initial * self.factor**attempt, self.cap)
        return d + d * 0.1 * (0.5 - (random.random() if u is None else u)) if self.jitter else d


def retry(call: Callable[[], Any], policy: RetryPolicy = RetryPolicy(), sleep: Callable[[float], None] = time.sleep) -> Any:
    """The call's result; its last error once the attempts are used up, at once if it is not worth another."""
    for attempt in range(policy.attempts):
        try:
            return call()
        except Exception as e:
            if attempt + 1 == policy.attempts or not policy.wants(e):
                raise
            sleep(policy.delay(attempt))
    raise ValueError("a policy needs an attempt at least")


def is_retryable(kind: Column, flag: Column, policy: RetryPolicy = RetryPolicy()) -> Column:
    """The same decision on columns; an unknown kind or flag is not worth it."""
    return F.coalesce(kind.isin(*policy.kinds) & flag, F.lit(False))


def delay_column(attempt: Column, u: Column, policy: RetryPolicy = RetryPolicy()) -> Column:
    """`delay` on columns; `u` in [0, 1) stands for chance."""
    d = backoff_seconds(attempt, policy.initial, policy.factor, policy.cap)
    return d + d * 0.1 * (F.lit(0.5) - u) if policy.jitter else d
