"""Record parsers for delimited lines and timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed layout of a daily stock line (comma separated):
#   exchange, stock_symbol, date, open, high, low, close, volume, adj_close
# The reference multiplies field 6 by field 7 and calls the result market cap.
STOCK_FIELDS = ["exchange", "stock_symbol", "date", "stock_price_open",
                "stock_price_high", "stock_price_low", "stock_price_close",
                "stock_volume", "stock_price_adj_close"]


def _field(parts: Column, i: int) -> Column:
    # get() is NULL past the end, where arr[i] would throw under ANSI.
    return F.get(parts, i)


def keep_parsed(parts: DataFrame, fields: list[Column], required: list[str]) -> DataFrame:
    """Rows of ``fields`` whose ``required`` fields are all non-NULL.

    A plain ``where`` would be pushed below the projection and re-evaluate
    the parse inside the filter; emitting 0 or 1 rows through ``inline``
    keeps the parse evaluated once per input row.
    """
    rec = F.struct(*fields)

    def ok(r):
        cond = F.lit(True)
        for c in required:
            cond = cond & r[c].isNotNull()
        return cond

    return parts.select(F.inline(F.filter(F.array(rec), ok)))


def parse_stock_line(df: DataFrame, line: str = "str") -> DataFrame:
    """``(exchange, symbol, market_cap)``; short or non-numeric lines dropped."""
    parts = df.select(F.split(F.col(line), ",", -1).alias("_p"))
    p = F.col("_p")
    return keep_parsed(parts, [
        _field(p, 0).alias("exchange"),
        _field(p, 1).alias("symbol"),
        (_field(p, 6).try_cast("double") * _field(p, 7).try_cast("double")).alias("market_cap"),
    ], ["symbol", "market_cap"])


def stock_watch(df: DataFrame, watch=None, line: str = "str") -> DataFrame:
    """Watched ``exchange:symbol`` rows as ``(symbol, date, high, low)``.

    ``watch`` is a list of keys (empty or None = everything) or a one-column
    DataFrame of keys, joined left-semi. The key filter runs before the
    numbers are parsed, as in the reference.
    """
    split = df.select(F.split(F.col(line), ",", -1).alias("_p"))
    keyed = split.select(
        F.concat(_field(F.col("_p"), 0), F.lit(":"), _field(F.col("_p"), 1)).alias("symbol"),
        "_p")
    if isinstance(watch, DataFrame):
        keyed = keyed.join(watch.toDF("symbol"), "symbol", "left_semi")
    elif watch:
        keyed = keyed.where(F.col("symbol").isin(list(watch)))
    p = F.col("_p")
    return keep_parsed(keyed, [
        F.col("symbol"),
        _field(p, 2).alias("date"),
        _field(p, 4).try_cast("double").alias("high"),
        _field(p, 5).try_cast("double").alias("low"),
    ], ["date", "high", "low"])


def epoch_millis(ts) -> Column:
    """Milliseconds since 1970-01-01 of a ``timestamp_ntz`` holding UTC wall
    time, independent of the session time zone (truncated, like the
    reference's millisecond clock)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MILLISECOND",
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


_EPOCH_NTZ = "1970-01-01 00:00:00"


def utc_instant(ts) -> Column:
    """``timestamp_ntz`` holding UTC wall time -> ``timestamp`` (instant),
    whatever the session time zone (watermarks need a zoned timestamp)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_micros(
        F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), ts))


def utc_wall(ts) -> Column:
    """``timestamp`` (instant) -> ``timestamp_ntz`` of its UTC wall time."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts),
                           F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def hour_of_day(ts) -> Column:
    """Hour (0-23) of a timestamp in the session time zone (UTC)."""
    return F.hour(F.col(ts) if isinstance(ts, str) else ts)
