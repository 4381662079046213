"""Token and cost estimates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# USD per million tokens, tokens per request besides the question.
INPUT_PRICE = 0.15
OUTPUT_PRICE = 0.60
REQUEST_OVERHEAD_TOKENS = 650
CHARS_PER_TOKEN = 4


def estimate_tokens(text: Column) -> Column:
    """Characters over four, rounded down; 0 for NULL."""
    return F.floor(F.coalesce(F.length(text), F.lit(0)) / CHARS_PER_TOKEN).cast("bigint")


def estimate_cost(
    tokens_in: Column, tokens_out: Column, price_in: float = INPUT_PRICE, price_out: float = OUTPUT_PRICE
) -> Column:
    """USD for a token count; 0 when a count is negative."""
    usd = tokens_in / F.lit(1e6) * F.lit(price_in) + tokens_out / F.lit(1e6) * F.lit(price_out)
    return F.when((tokens_in < 0) | (tokens_out < 0), 0.0).otherwise(usd)


def success_rate(total: Column, ok: Column) -> Column:
    """Percentage with guards: 0 for empty or negative counts, at most 100."""
    return (
        F.when((total == 0) | (total < 0) | (ok < 0), 0.0)
        .when(ok > total, 100.0)
        .otherwise(F.try_divide(ok.cast("double"), total.cast("double")) * 100)
    )
