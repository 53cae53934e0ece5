"""Checks on incoming quotes, and the split into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import instant
from tickloom.schemas import DEAD_LETTERS, QUOTE

# Required fields in report order, message texts, expected batch size.
REQUIRED = ("id", "symbol", "current_price")
MISSING = "Missing required fields: "
BAD_PRICE = "Invalid price: "
EXPECTED_RECORDS = 20
EMPTY_BATCH = "API returned empty list — possible rate limit or outage"
NONE_VALID = "No valid coins after quality checks"

PRICE_TEXT = "price_text"


def _missing(price: str) -> Column:
    present = {**{name: name for name in REQUIRED}, "current_price": price}
    return F.array_compact(
        F.array(*(F.when(F.col(present[n]).isNull(), F.lit(f"'{n}'")) for n in REQUIRED))
    )


def with_reason(quotes: DataFrame) -> DataFrame:
    """Add ``reason``, null for a valid quote.

    Where the quotes carry the raw ``price_text``, a price that is no number has a
    text but a null ``current_price``.
    """
    raw = PRICE_TEXT if PRICE_TEXT in quotes.columns else "current_price"
    price = F.col("current_price")
    missing = _missing(raw)
    bad_price = price.isNull() | F.isnan(price) | (price <= 0)
    reason = F.when(
        F.size(missing) > 0, F.concat(F.lit(MISSING + "["), F.array_join(missing, ", "), F.lit("]"))
    ).when(bad_price, F.concat(F.lit(BAD_PRICE), F.col(raw).cast("string")))
    return quotes.withColumn("reason", reason)


def valid_quotes(quotes: DataFrame) -> DataFrame:
    """Valid rows only."""
    return with_reason(quotes).filter(F.col("reason").isNull()).drop("reason")


def project_quote(quotes: DataFrame, *extra: str) -> DataFrame:
    """The named quote fields; a field the input lacks becomes null."""
    return quotes.select(
        *extra,
        *(
            F.col(f.name) if f.name in quotes.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in QUOTE.fields
        ),
    )


def dead_letters(
    quotes: DataFrame, run_id: Column | str, as_of: datetime | Column, payload: Column | None = None
) -> DataFrame:
    """Rejected rows with their reason and their content as JSON."""
    body = payload if payload is not None else F.to_json(F.struct(*quotes.columns))
    return (
        with_reason(quotes)
        .filter(F.col("reason").isNotNull())
        .select(
            (F.lit(run_id) if isinstance(run_id, str) else run_id).alias("run_id"),
            body.alias("payload"),
            F.col("reason").alias("error_message"),
            (instant(as_of) if isinstance(as_of, datetime) else as_of).alias("created_at"),
        )
        .select(*DEAD_LETTERS.fieldNames())
    )


def failed_batch_letter(spark, run_id: str, error_message: str, as_of: datetime) -> DataFrame:
    """One row for a batch that failed as a whole, without content."""
    row = [(run_id, None, error_message, as_of)]
    return spark.createDataFrame(row, DEAD_LETTERS)


def batch_guard(
    quotes: DataFrame, batch: Sequence[str], expected: int = EXPECTED_RECORDS
) -> DataFrame:
    """Per batch: record counts, whether it is short, and whether nothing valid is left."""
    return (
        with_reason(quotes)
        .groupBy(*batch)
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(F.col("reason").isNull()).alias("valid_records"),
        )
        .withColumns(
            {
                "below_expected": F.col("records") < expected,
                "failure": F.when(F.col("valid_records") == 0, NONE_VALID),
            }
        )
    )


def require_records(quotes: DataFrame) -> DataFrame:
    """Fail on a batch that is empty or has no valid record; else its valid rows."""
    if quotes.isEmpty():
        raise ValueError(EMPTY_BATCH)
    kept = valid_quotes(quotes)
    if kept.isEmpty():
        raise ValueError(NONE_VALID)
    return kept
