"""Sets of minutes of the day as at most 23 words of 64 bits.

A station-day's covered minutes fit one small row, so minute rules compare files
with a fact about their day instead of joining minute by minute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MINUTES = 1440


def word_of(minute: Column) -> Column:
    return F.floor(minute / 64).cast("int")


def bit_of(minute: Column) -> Column:
    # Only the SQL form shifts by a column.
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), minute % 64)


def minute_words(rows: DataFrame, by: Sequence[str], minute: Column) -> DataFrame:
    """Covered minutes of each group: a row per word in use (NULL for no minute)."""
    return rows.groupBy(*by, word_of(minute).alias("word")).agg(
        F.bit_or(bit_of(minute)).alias("bits")
    )


def minute_sets(words: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """One set of minutes per group, from rows with `word` and `bits`."""
    return (
        words.filter(F.col("word").isNotNull())
        .groupBy(*by, "word")
        .agg(F.bit_or("bits").alias("bits"))
        .groupBy(*by)
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias(name))
    )


def has_minute(minutes: Column, minute: Column) -> Column:
    """Is the minute in the set? False for a NULL set or minute."""
    word = F.try_element_at(minutes, word_of(minute))
    return F.coalesce(word.bitwiseAND(bit_of(minute)) != 0, F.lit(False))


def lacking_minutes(minutes: Column) -> Column:
    """Minutes of the day outside the set, as an array."""
    return F.filter(
        F.sequence(F.lit(0), F.lit(MINUTES - 1)), lambda m: ~has_minute(minutes, m)
    )
