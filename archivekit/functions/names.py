"""Column expressions over archive paths and file names.

Everything here is built from Spark SQL expressions, so it stays inside
whole-stage codegen and can be pushed, pruned or reordered by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The name grammar, the folder grammar and the strict forms.
# date, minute, optional seconds, station, optional channel, extension
NAME_GRAMMAR = (
    r"^(\d{4}-?\d{2}-?\d{2})[ _](\d{4})(?:[ _](\d{2}))?[ _]([A-Z0-9]+)"
    r"(?:_([A-Z0-9]{3}))?((?:\.[a-z]+)+)$"
)
# date and minute, delimited, at the start of a name
MINUTE_PREFIX = r"^(?:\d{4}-\d{2}-\d{2}|\d{8})[ _]\d{4}[ _]"
# station, "continuous", year, month, day, name: the last six parts of a path
DAY_FOLDER = r"^[^/]+/continuous/\d{4}/\d{1,2}/\d{1,2}/[^/]+$"
STRICT_SPACED_ECHO = r"^\d{4}-\d{2}-\d{2} \d{4} \d{2} .*\.dmx$"
STRICT_SPACED_GECKO = r"^\d{4}-\d{2}-\d{2} \d{4} \d{2} [A-Z0-9_]+\.(ms|dmx)(\.zip)?$"

# Extensions of each recorder family and of the wider sets.
EXTENSIONS = {
    "echo": (".dmx", ".dmx.gz"),
    "gecko": (".ms", ".ms.zip"),
    "archive": (".dmx", ".dmx.gz", ".ms", ".ms.zip"),
    "data": (".dmx", ".dmx.gz", ".ms", ".ms.zip", ".suds", ".suds.gz"),
    "dmx": (".dmx",),
    "uncompressed": (".dmx", ".ms"),
    "per_channel": (".mseed", ".mseed.zip"),
}

_MARK = "\x01"


def _rewritten(text: Column, pattern: str, groups: int) -> Column:
    """Groups of a matching text as an array, in one regex pass.

    A text that does not match comes back as an array of itself.
    """
    template = _MARK.join(f"${g}" for g in range(1, groups + 1))
    return F.split(F.regexp_replace(text, pattern, template), _MARK)


def _blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder(path: Column) -> Column:
    """Path of the folder holding a file (or of a folder's parent)."""
    return F.left(path, F.length(path) - F.length(base_name(path)) - 1)


def stem(name: Column) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]+$", "")


def n_underscores(name: Column) -> Column:
    return F.length(name) - F.length(F.replace(name, F.lit("_"), F.lit("")))


def n_spaces(name: Column) -> Column:
    return F.length(name) - F.length(F.replace(name, F.lit(" "), F.lit("")))


def is_spaced(name: Column) -> Column:
    return F.contains(name, F.lit(" "))


def is_underscored(name: Column) -> Column:
    return ~is_spaced(name) & (n_underscores(name) >= 2)


def style(name: Column) -> Column:
    """How the file arrived: stored locally, sent by telemetry, or unclear."""
    return (
        F.when(is_underscored(name), "underscored")
        .when(is_spaced(name), "spaced")
        .otherwise("other")
    )


def is_triggered(name: Column) -> Column:
    return F.contains(name, F.lit("trig"))


def is_compressed(name: Column) -> Column:
    return F.endswith(name, F.lit(".gz")) | F.endswith(name, F.lit(".zip"))


def is_strict_spaced_echo(name: Column) -> Column:
    return (
        F.rlike(name, F.lit(STRICT_SPACED_ECHO))
        & ~F.rlike(F.lower(name), F.lit("mseed|trig"))
    )


def is_strict_spaced_gecko(name: Column) -> Column:
    return (
        F.rlike(name, F.lit(STRICT_SPACED_GECKO))
        & ~F.rlike(F.lower(name), F.lit(r"trig|dmx|mseed\.zip|\.ss$"))
    )


def is_underscored_gecko(name: Column) -> Column:
    """Exactly two underscores and none of the triggered or ancillary kinds."""
    return (n_underscores(name) == 2) & ~F.rlike(
        F.lower(name), F.lit(r"trig|dmx|mseed\.zip|\.ss$")
    )


def has_extension(name: Column, family: str) -> Column:
    if family == "minute":
        # The wide set of the per-minute rule: any .ms* extension, and dmx.
        return F.contains(name, F.lit(".ms")) | has_extension(name, "echo")
    hit = F.lit(False)
    for ext in EXTENSIONS[family]:
        hit = hit | F.endswith(name, F.lit(ext))
    return hit


def family_of(name: Column) -> Column:
    return F.when(has_extension(name, "echo"), "echo").when(
        has_extension(name, "gecko"), "gecko"
    )


def data_kind(name: Column) -> Column:
    """`dmx` or `ms`: the side a minute file competes on."""
    return F.when(has_extension(name, "echo"), "dmx").otherwise("ms")


def is_station_token(token: Column) -> Column:
    return F.rlike(token, F.lit(r"^[A-Z0-9]+$"))


def station_token(name: Column, family: str) -> Column:
    """Last space- or underscore-separated token before the family's extension.

    Per-channel names carry a channel after the station; the station is then
    the token before it.
    """
    cut = ".dmx" if family == "echo" else ".ms"
    head = F.translate(F.split_part(name, F.lit(cut), F.lit(1)), " \t", "__")
    per_channel = F.contains(name, F.lit(".mseed")) & F.rlike(
        name, F.lit(r"[ _][A-Z0-9]+_[A-Z0-9]{3}\.mseed")
    )
    return F.when(
        per_channel, F.substring_index(F.substring_index(head, "_", -2), "_", 1)
    ).otherwise(F.substring_index(head, "_", -1))


def hhmm(name: Column) -> Column:
    """The four digits after the date; NULL where a name has none."""
    digits = F.when(F.substring(name, 5, 1) == "-", F.substring(name, 12, 4)).otherwise(
        F.substring(name, 10, 4)
    )
    return F.when(F.rlike(name, F.lit(MINUTE_PREFIX)), digits)


def minute_of_day(hhmm: Column) -> Column:
    """0..1439, NULL for four digits that are no time of day."""
    hh = F.substring(hhmm, 1, 2).try_cast("int")
    mm = F.substring(hhmm, 3, 2).try_cast("int")
    return F.when((hh < 24) & (mm < 60), hh * 60 + mm)


def stamp_underscored(name: Column, literal: bool = False) -> Column:
    """Seconds stamp of a local name: third `_` field up to its first dot.

    By default only two digits count as a stamp; `literal=True` returns the
    field as it is.
    """
    field = F.split_part(F.split_part(name, F.lit("_"), F.lit(3)), F.lit("."), F.lit(1))
    return field if literal else F.when(F.rlike(field, F.lit(r"^\d{2}$")), field)


def stamp_spaced(name: Column, literal: bool = False) -> Column:
    """Seconds stamp of a telemetered name: third space-separated field."""
    field = F.split_part(name, F.lit(" "), F.lit(3))
    return field if literal else F.when(F.rlike(field, F.lit(r"^\d{2}$")), field)


def parse_name(files: DataFrame, name: str = "name") -> DataFrame:
    """Add the parts of the name grammar; names outside it get NULLs."""
    n = F.col(name)
    part = lambda i: F.get(F.col("_parts"), F.lit(i))
    compact = F.when(F.size("_parts") == 6, F.replace(part(0), F.lit("-"), F.lit("")))
    return (
        files.withColumn("_parts", _rewritten(n, NAME_GRAMMAR, 6))
        .withColumns({
            "date": F.concat_ws(
                "-",
                F.substring(compact, 1, 4),
                F.substring(compact, 5, 2),
                F.substring(compact, 7, 2),
            ).try_cast("date"),
            "hhmm": part(1),
            "ss": _blank_to_null(part(2)),
            "station": part(3),
            "cha": _blank_to_null(part(4)),
            "ext": part(5),
            "style": style(n),
            "is_trig": is_triggered(n),
        })
        .drop("_parts")
    )


def with_path_keys(files: DataFrame, path: str = "path") -> DataFrame:
    """Add `name`, `station_dir` and `day`, taken from the folder layout.

    Paths outside `<station>/continuous/YYYY/MM/DD/` get NULL keys.
    """
    p = F.col(path)
    tail = F.substring_index(p, "/", -6)
    in_day_folder = F.rlike(tail, F.lit(DAY_FOLDER))
    ymd = F.substring_index(F.substring_index(tail, "/", 5), "/", -3)
    return files.withColumns({
        "name": base_name(p),
        "station_dir": F.when(in_day_folder, F.substring_index(tail, "/", 1)),
        "day": F.when(in_day_folder, F.replace(ymd, F.lit("/"), F.lit("-"))).try_cast("date"),
    })
