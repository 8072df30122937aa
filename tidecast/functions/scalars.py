"""Scalar column expressions: cleaning, calendar arithmetic, row metrics."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS_PER_YEAR = {"monthly": 12, "quarterly": 4}


def to_number(c) -> Column:
    """Text to double: thousands commas and blanks go, anything else is null; NaN is null."""
    number = F.trim(F.replace(F.col(c) if isinstance(c, str) else c, F.lit(","), F.lit(""))).try_cast("double")
    return F.when(~F.isnan(number), number)


def clean_name(c) -> Column:
    """White space runs to one blank, runs of separators to one underscore, none at the ends."""
    text = F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"\s+", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"""[/()\[\]{},:"']+""", "_"), r"_+", "_")
    return F.regexp_replace(text, r"^[_ ]+|[_ ]+$", "")


def parse_month(c) -> Column:
    """ISO dates and `Jan-20` texts to the first day of their month, else null."""
    text = F.trim(F.col(c) if isinstance(c, str) else c)
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")))
    short = F.when(text.rlike(r"^[A-Za-z]{3}-\d{2}$"), F.try_to_timestamp(F.initcap(text), F.lit("MMM-yy")))
    long = F.when(text.rlike(r"^[A-Za-z]{3}-\d{4}$"), F.try_to_timestamp(F.initcap(text), F.lit("MMM-yyyy")))
    return F.trunc(F.coalesce(iso, short, long).cast("date"), "MM")


def month_label(c) -> Column:
    return F.date_format(c, "MMM-yyyy")


def shift_periods(date, periods, frequency: str = "monthly") -> Column:
    step = 12 // PERIODS_PER_YEAR[frequency]
    return F.add_months(date, (periods * step) if isinstance(periods, int) else (periods * F.lit(step)).cast("int"))


def scale_periods(months: int, frequency: str = "monthly", least: int = 1) -> int:
    """A size in months as periods, half to even, and at least `least`."""
    return max(least, round(months * PERIODS_PER_YEAR[frequency] / 12))


def round_to(c, places: int) -> Column:
    """Half to even at `places`, after noise beyond four more places is cut off, so
    that the order of a sum's terms can't move a tie."""
    c = F.col(c) if isinstance(c, str) else c
    fine, coarse = F.lit(10.0 ** (places + 4)), F.lit(10.0**places)
    return F.rint(F.rint(c * fine) / fine * coarse) / coarse


def safe_div(a, b) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(b != 0, a / b)


def clip_0_100(c: Column) -> Column:
    return F.when(c.isNotNull(), F.least(F.lit(100.0), F.greatest(F.lit(0.0), c)))


def row_metrics(actual: str = "actual", predicted: str = "predicted") -> dict[str, Column]:
    """abs_err, ape, mae, mse, rmse, mape, mpe, accuracy of a forecast row, rounded to
    4 places half to even before any average; percentages are null where actual is 0."""
    a, p = F.col(actual), F.col(predicted)
    error, share = F.abs(a - p), F.when(a != 0, (a - p) / a)
    ape = F.abs(share) * 100
    r = lambda x: round_to(x, 4)
    return {
        "abs_err": r(error), "ape": r(ape), "mae": r(error), "mse": r(error * error), "rmse": r(error),
        "mape": r(ape), "mpe": r(share * 100), "accuracy": r(F.when(ape.isNotNull(), F.greatest(F.lit(0.0), 100 - ape))),
    }


def direction_hit(actual, predicted, baseline) -> Column:
    """1 where forecast and actual lie on the same side of the baseline (equal counts as below)."""
    a, p, b = (F.col(x) if isinstance(x, str) else x for x in (actual, predicted, baseline))
    return F.when(a.isNotNull() & p.isNotNull() & b.isNotNull(), ((a > b) == (p > b)).cast("int"))


def cyclic(c: Column, period: int) -> tuple[Column, Column]:
    angle = c * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def tier(score: Column, high: float = 85, medium: float = 75) -> Column:
    return F.when(score >= high, "HIGH").when(score >= medium, "MEDIUM").when(score.isNotNull(), "LOW")


def is_exchange_rate(name) -> Column:
    """Names of currency drivers."""
    return (F.col(name) if isinstance(name, str) else name).rlike(r"(?i)exchange|\bfx\b|usd|eur/|currency|forex")


def signed(points: Column) -> Column:
    """A number of points with its sign and no decimals."""
    return F.concat(F.when(points < 0, "-").otherwise("+"), F.format_string("%.0f", F.abs(points)))


def one_decimal(c: Column) -> Column:
    return F.format_string("%.1f", c)
