"""Scorer call outcomes, token cost, funnel class and report number formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.constants import FUNNEL_LOOSE_ABOVE, FUNNEL_TIGHT_BELOW, MODEL_PRICES

# Texts that mark a call as timed out or unreachable.
_TIMEOUT = "(?i)timeout|ETIMEDOUT|ECONNRESET|ENOTFOUND|fetch failed"
_TIMEOUT_KINDS = ["TimeoutError", "AbortError"]


def classify_error(status: Column, message: Column, kind: Column | None = None) -> Column:
    """``struct(error_class, retryable, http_status)`` of a failed scorer call."""
    timed_out = F.coalesce(message.rlike(_TIMEOUT), F.lit(False))
    if kind is not None:
        timed_out = timed_out | F.coalesce(kind.isin(_TIMEOUT_KINDS), F.lit(False))

    def outcome(error_class: str, retryable: bool, keep_status: bool) -> Column:
        return F.struct(
            F.lit(error_class).alias("error_class"),
            F.lit(retryable).alias("retryable"),
            (status if keep_status else F.lit(None)).cast("long").alias("http_status"),
        )

    return (
        F.when(status == 429, outcome("rate_limit", True, True))
        .when(status.between(500, 504), outcome("server", True, True))
        .when(status == 400, outcome("unknown", False, True))
        .when(timed_out, outcome("timeout", True, False))
        .when(status.between(401, 499), outcome("unknown", False, True))
        .otherwise(outcome("unknown", True, False))
    )


def is_retryable(status: int | None, message: str | None, kind: str | None = None) -> bool:
    """The same decision for one failed call, where it is made between calls."""
    if status is not None and (status == 429 or 500 <= status <= 504):
        return True
    if status == 400:
        return False
    if kind in _TIMEOUT_KINDS or re.search(_TIMEOUT, message or ""):
        return True
    return not (status is not None and 401 <= status <= 499)


def token_cost(
    model: Column, tokens_in: Column, tokens_out: Column, prices: list[dict] | None = None
) -> Column:
    """USD of one call; NULL for a model without a price."""
    name = F.lower(model)
    usd = F.lit(None).cast("double")
    for price in reversed(MODEL_PRICES if prices is None else prices):
        family = F.contains(name, F.lit(price["has"]))
        if price.get("lacks"):
            family = family & ~F.contains(name, F.lit(price["lacks"]))
        cost = (tokens_in / 1e6) * price["input_per_m"] + (tokens_out / 1e6) * price["output_per_m"]
        usd = F.when(family, cost).otherwise(usd)
    return usd


def funnel_tightness(stage2_of_raw: Column) -> Column:
    return (
        F.when(stage2_of_raw.isNull() | F.isnan(stage2_of_raw), "unknown")
        .when(stage2_of_raw > FUNNEL_LOOSE_ABOVE, "loose")
        .when(stage2_of_raw < FUNNEL_TIGHT_BELOW, "tight")
        .otherwise("ok")
    )


def safe_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def fmt_pct(share: Column) -> Column:
    return F.when(share.isNull(), "n/a").otherwise(F.format_string("%.1f%%", share.cast("double") * 100))


def fmt_num(value: Column, digits: int = 3) -> Column:
    return F.when(value.isNull(), "n/a").otherwise(F.format_string(f"%.{digits}f", value.cast("double")))
