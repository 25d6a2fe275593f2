"""Column expressions over stream ids, channels and record times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Instrument letters (second letter of a channel code).
INSTRUMENTS = {
    "H": "High Gain Seismometer",
    "L": "Low Gain Seismometer",
    "N": "Accelerometer",
}


def stream_id(net="net", sta="sta", loc="loc", cha="cha") -> Column:
    return F.concat_ws(".", *[F.coalesce(F.col(c), F.lit("")) for c in (net, sta, loc, cha)])


def id_part(sid: Column, i: int) -> Column:
    """Part 1..4 (network, station, location, channel) of a dotted id."""
    return F.split_part(sid, F.lit("."), F.lit(i))


def is_stream_id(text: Column) -> Column:
    return F.rlike(text, F.lit(r"^[A-Z]{2}\."))


def component(cha: Column) -> Column:
    return F.when(F.length(cha) >= 3, F.right(cha, F.lit(1))).otherwise("Z")


def base_channel(cha: Column) -> Column:
    return F.substring(cha, 1, 2)


def is_accelerometer(cha: Column) -> Column:
    return F.substring(cha, 2, 1) == "N"


def is_zen(cha: Column) -> Column:
    return F.right(cha, F.lit(1)).isin("Z", "E", "N")


def target_id(sta: Column, cha: Column, net: str, loc: str, ch: str) -> Column:
    return F.concat(F.lit(f"{net}."), sta, F.lit(f".{loc}.{ch}"), component(cha))


def matches_channel_spec(cha: Column, spec: Column | str) -> Column:
    """`?` in a spec stands for exactly one character."""
    if isinstance(spec, str):
        return F.like(cha, F.lit(spec.replace("?", "_")))
    return (F.length(cha) == F.length(spec)) & (
        F.substring(cha, 1, 2) == F.substring(spec, 1, 2)
    )


def band_code(rate: Column, corner_period: Column) -> Column:
    """First channel letter from sampling rate (Hz) and corner period (s)."""
    short = corner_period < 10
    very_fast = (rate >= 250) & (rate < 1000)
    return (
        F.when(very_fast & short, "D")
        .when(very_fast, "C")
        .when((rate >= 80) & short, "E")
        .when(rate >= 80, "H")
        .when((rate >= 10) & short, "S")
        .when(rate >= 10, "B")
    )


def instrument_name(cha: Column) -> Column:
    letter = F.substring(cha, 2, 1)
    return F.coalesce(*[F.when(letter == code, text) for code, text in INSTRUMENTS.items()])


def end_from_samples(start: Column, n_samples: Column, rate: Column) -> Column:
    """End of a record (exclusive): start plus samples over rate."""
    micros = F.round(n_samples * F.lit(1_000_000) / rate).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, start)


def sds_path(year: Column, net: Column, sta: Column, loc: Column, cha: Column, doy: Column) -> Column:
    """Relative path of the day file a record belongs to."""
    y = year.cast("string")
    return F.concat_ws(
        "/",
        y, net, sta,
        F.concat(cha, F.lit(".D")),
        F.concat_ws(".", net, sta, loc, cha, F.lit("D"), y,
                    F.lpad(doy.cast("string"), 3, "0")),
    )
