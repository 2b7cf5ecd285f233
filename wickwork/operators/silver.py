"""Bronze to silver: one typed table for all exchanges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork import constants as C
from wickwork.functions.candle import canonical_symbol, price, seconds_from_millis
from wickwork.sources.candles import union_days

SILVER_KEY = ["exchange", "symbol", "open_time"]


def unify(bronze: dict[str, DataFrame]) -> DataFrame:
    """All exchanges' bronze rows, each tagged with its exchange."""
    return union_days([
        df.select(F.lit(exchange).alias("exchange"), *C.BRONZE_COLUMNS)
        for exchange, df in bronze.items()
    ])


def _symbol() -> Column:
    return canonical_symbol(F.col("exchange"), F.col("symbol"))


def problems() -> dict[str, Column]:
    """Tests, by name, for a bronze value that is there but cannot be used.

    Missing values are no problem here: silver keeps and counts them.
    """
    unmatched = F.col("symbol").isNotNull() & _symbol().isNull()
    malformed = {
        f"malformed_{f}": F.col(f).isNotNull() & price(F.col(f)).isNull() for f in C.PRICE_FIELDS
    }
    return {"unmatched_symbol": unmatched} | malformed


def judged(bronze: DataFrame) -> DataFrame:
    """Every tagged bronze row in silver's types, with a flag per problem and `rejected`.

    What cannot be used is NULL.
    """
    values = {f: price(F.col(f)) for f in C.PRICE_FIELDS} | {
        "symbol": _symbol(),
        "open_time": seconds_from_millis(F.col("open_time_ms")),
        "close_time": seconds_from_millis(F.col("close_time_ms")),
    }
    columns = [values.get(c, F.col(c)).alias(c) for c in C.SILVER_COLUMNS]
    tests = problems()
    flagged = bronze.select(*columns, *[test.alias(name) for name, test in tests.items()])
    # One CASE and not an OR: Spark would split the OR and test symbols before an
    # aggregate below, once per input row in place of once per candle.
    rejected = reduce(lambda chain, name: chain.when(F.col(name), True), tests, F)
    return flagged.withColumn("rejected", rejected.otherwise(False))


def usable(bronze: DataFrame) -> DataFrame:
    """Tagged bronze rows that can be typed, as silver rows."""
    return judged(bronze).where(~F.col("rejected")).select(*C.SILVER_COLUMNS)


def rejected(bronze: DataFrame) -> DataFrame:
    """Tagged bronze rows that cannot be typed, unchanged, with the names of their problems."""
    named = F.array_compact(F.array(*[F.when(test, name) for name, test in problems().items()]))
    return bronze.withColumn("problems", named).where(F.size("problems") > 0)


def to_silver(bronze: DataFrame | dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(silver rows, rows set aside). Takes bronze per exchange, or already tagged."""
    tagged = unify(bronze) if isinstance(bronze, dict) else bronze
    return usable(tagged), rejected(tagged)
