"""Scalar rules for values that come as text: decimals, timestamps, periods, entropy, names of columns."""

from __future__ import annotations

import datetime as dt
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = dt.datetime(1970, 1, 1)
#: Endings of names of cost columns.
COST_WORDS = ("cost", "price", "amount", "rate")


def to_cost(text: Column) -> Column:
    """Decimal(38,32) of a text that may have dollar signs, commas and blanks; null if it is none or has over six
    integer digits."""
    return F.translate(text, "$, \t\n\x0b\f\r", "").try_cast("decimal(38,32)")


def to_time(text: Column) -> Column:
    """Timestamp of a text in UTC, to the second; blank gives null, what is no date gives the epoch."""
    trimmed = F.trim(text)
    plain = F.when(trimmed.contains(" UTC"), F.regexp_replace(trimmed, " UTC$", "Z")).otherwise(trimmed)
    parsed = F.when(plain.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.try_to_timestamp(plain))
    return F.when(trimmed != "", F.date_trunc("second", F.coalesce(parsed, F.lit(EPOCH).cast("timestamp"))))


def is_daily_period(start: Column, end: Column) -> Column:
    """Whether a charge period ends the day after it starts; false if either is missing."""
    return F.coalesce(F.to_date(end) == F.date_add(F.to_date(start), 1), F.lit(False))


def is_cost_field(name: str) -> bool:
    return name.lower().endswith(COST_WORDS)


def entropy(text: Column) -> Column:
    """Shannon entropy in bits of a text's characters; empty or null gives 0."""
    chars = F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != "")
    n = F.size(chars).cast("double")
    # of the sorted characters, each run's length: one pass instead of a scan for each distinct character
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    term = lambda run: F.when(run > 0, run * F.log2(run)).otherwise(0.0)

    def step(s: Column, c: Column) -> Column:
        same = c == s["last"]
        return F.struct(c.alias("last"), F.when(same, s["run"] + 1).otherwise(1.0).alias("run"), F.when(same, s["sum"]).otherwise(s["sum"] + term(s["run"])).alias("sum"))

    total = F.aggregate(F.array_sort(chars), start, step, lambda s: s["sum"] + term(s["run"]))
    return F.when(n > 0, F.greatest(F.log2(n) - total / n, F.lit(0.0))).otherwise(0.0)


@F.pandas_udf(T.StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: s if s is None or s.isascii() else unicodedata.normalize("NFKC", s))


def normalized(text: Column) -> Column:
    """NFKC and lower case. There is no built-in for NFKC; the function is one Arrow batch each way."""
    return F.lower(_nfkc(text))
