"""Column helpers shared by the operators. All of them are built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..constants import PREDICTION_KEY_PREFIX


def event_time(text: Column) -> Column:
    """ISO-8601 text to a timestamp; `Z`, offsets and fractions are accepted, anything else is NULL."""
    looks_iso = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]|$)")
    return F.when(looks_iso, F.try_to_timestamp(text))


def epoch_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("long"))


def normalised(text: Column) -> Column:
    return F.lower(F.trim(text))


def present(text: Column) -> Column:
    """The value, with the empty string read as absent."""
    return F.nullif(text, F.lit(""))


def known_customer(customer: Column) -> Column:
    """NULL for an empty or anonymous customer; compared as is, without trimming."""
    return F.when(~customer.isin("", "anonymous"), customer)


def clamped(value: Column, low: int, high: int) -> Column:
    """Bounded value; NULL stays NULL, which least/greatest would turn into a bound."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def half_up(value: Column, digits: int) -> Column:
    """Half-up rounding of the decimal value, so that the last bit of a double sum does not matter."""
    return F.round(value.cast("decimal(30,10)"), digits).cast("double")


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def valid_cohort(cohort: Column) -> Column:
    return cohort.rlike(r"^\d{4}-Q[1-4]$")


def time_slot(ts: Column, seconds: int) -> Column:
    """Start of the fixed slot a moment falls into."""
    return F.timestamp_seconds(F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)) * seconds)


def seconds_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def names_where(checks: Sequence[tuple[str, Column]]) -> Column:
    """Array of the names whose condition holds, in the order given."""
    flagged = F.array(*[F.when(condition, F.lit(name)) for name, condition in checks])
    return F.filter(flagged, lambda name: name.isNotNull())


def listed(checks: Sequence[tuple[str, Column]]) -> Column:
    """The names whose condition holds as one text; empty when none does."""
    return F.concat_ws(", ", *[F.when(condition, F.lit(name)) for name, condition in checks])


def prediction_key(customer: Column, features: Sequence[str]) -> Column:
    """Stable key of a customer and its feature values; the order of `features` does not matter."""
    payload = F.to_json(
        F.struct(customer.alias("customer_id"), F.struct(*[F.col(c) for c in sorted(features)]).alias("features")),
        {"ignoreNullFields": "false"},
    )
    return F.concat(F.lit(PREDICTION_KEY_PREFIX), F.substring(F.sha2(payload, 256), 1, 32))


def flag_count(flags: Column) -> Column:
    """How many flags of a flag map are on."""
    return F.size(F.map_filter(flags, lambda _, on: F.coalesce(on, F.lit(False))))
