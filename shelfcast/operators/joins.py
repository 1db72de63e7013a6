"""Left joins of sales with per-date tables.

Semantics: a sale on a date with k rows on the other side comes out k times, a sale on any other
date once, with NULLs.

The sales side can be huge and one date may hold a third of it, so it should not be shuffled by
date. The other side is first reduced to distinct rows with a count of copies, which bounds it by
the calendar rather than by its row count, and its measured size picks the plan:

1. all its rows fit: broadcast them; the hash join does the fan-out.
2. only its distinct rows fit: broadcast those, and repeat each match on the sales side.
3. neither: a shuffle join on date and a salt. There are few dates, so by date alone few tasks would
   have work; each date is spread over ``SALTS`` tasks, and the other side is repeated for each.

The other side is measured without being kept, so every plan reads it as it is when it runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from shelfcast.operators.copies import merge_copies, repeat_copies
from shelfcast.operators.filters import with_holiday_flag, with_promo_flag

BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 16  # tasks per date in the shuffle join
ROW_OVERHEAD = 24  # bytes per broadcast row besides its text


@dataclass(frozen=True)
class DateTableSize:
    """Measured bytes of a per-date table: as it is, and with equal rows merged."""

    full: int
    distinct: int


def _measure(compact: DataFrame, columns: list[str]) -> DateTableSize:
    row_bytes = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in columns])) + ROW_OVERHEAD
    size = compact.agg(
        F.sum(row_bytes * F.col("copies")).alias("full"),
        F.sum(row_bytes).alias("distinct"),
        F.count_if(F.col("date").isNull()).alias("undated"),
    ).first()
    if size["undated"]:
        raise ValueError("a table joined on date has rows without a date")
    return DateTableSize(size["full"] or 0, size["distinct"] or 0)


def left_join_on_date(
    df: DataFrame, other: DataFrame, columns: list[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``df`` left-joined with ``columns`` of ``other`` on ``date``."""
    other = other.select("date", *columns)
    compact = merge_copies(other)
    size = _measure(compact, columns)
    if size.full <= broadcast_bytes:
        return df.join(F.broadcast(repeat_copies(compact).drop("copy")), "date", "left")
    if size.distinct <= broadcast_bytes:
        return repeat_copies(df.join(F.broadcast(compact), "date", "left")).drop("copy")
    salt = fresh_name(df.columns, "salt")
    dealt = df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    repeated = other.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(repeated.hint("merge"), ["date", salt], "left").drop(salt)


def fresh_name(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until it is none of ``columns``."""
    while name in columns:
        name = "_" + name
    return name


def join_oil(df: DataFrame, oil: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Adds ``dcoilwtico``; NULL on days without a price."""
    return left_join_on_date(df, oil, ["dcoilwtico"], broadcast_bytes)


def join_holidays(
    df: DataFrame, holidays: DataFrame, dedupe: bool = False, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Adds the holiday ``type``. A date with several holidays repeats its sales rows.

    With ``dedupe`` every sale stays one row and gets the alphabetically first type.
    """
    if dedupe:
        holidays = holidays.groupBy("date").agg(F.min("type").alias("type"))
    return left_join_on_date(df, holidays, ["type"], broadcast_bytes)


def enrich(
    df: DataFrame,
    oil: DataFrame,
    holidays: DataFrame,
    dedupe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Oil price, holiday type and the two 0/1 flags; works on train and test alike."""
    joined = join_oil(df, oil, broadcast_bytes)
    joined = join_holidays(joined, holidays, dedupe, broadcast_bytes)
    return with_holiday_flag(with_promo_flag(joined))
