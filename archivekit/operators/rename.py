"""Pick the seismometer channels of each station-day and give them a standard identity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from archivekit.functions import streams as S
from archivekit.operators.lookup import attach
from archivekit.operators.records import IDENTITY, distinct_streams
from archivekit.params import Params

DAY = ["station_dir", "day"]


def select_channels(
    records: DataFrame, params: Params = Params(), legacy: bool = False
) -> DataFrame:
    """Up to three streams per station-day, numbered in `ord`.

    With more than three streams the accelerometers go; vertical, east and north
    components stay, first channels first. `legacy=True` drops every id holding
    an N instead and takes the first ids. The windows run over the distinct
    streams of a day.
    """
    streams = distinct_streams(records, DAY).filter(S.is_stream_id(F.col("stream_id")))
    counted = streams.withColumn(
        "n_streams", F.count(F.lit(1)).over(Window.partitionBy(*DAY))
    )
    crowded = F.col("n_streams") > 3
    if legacy:
        kept = counted.filter(~(crowded & F.contains("stream_id", F.lit("N"))))
        order = ["stream_id"]
    else:
        kept = counted.filter(
            ~(crowded & S.is_accelerometer(F.col("cha"))) & S.is_zen(F.col("cha"))
        )
        order = ["cha", "stream_id"]
    rank = F.row_number().over(Window.partitionBy(*DAY).orderBy(*order))
    return (
        kept.withColumn("ord", rank)
        .filter(F.col("ord") <= params.max_channels)
        .select(*DAY, "ord", "stream_id", *IDENTITY)
    )


def build_rename_rules(channels: DataFrame, params: Params = Params()) -> DataFrame:
    """One rule per selected stream: source id and target id."""
    return channels.select(
        *DAY,
        "ord",
        F.col("stream_id").alias("src"),
        S.target_id(F.col("sta"), F.col("cha"), params.net, params.loc, params.ch).alias("dst"),
    )


def rename_strings(channels: DataFrame, params: Params = Params()) -> DataFrame:
    """Rules of a day as one comma list, with the channel spec (at most three each)."""
    rules = build_rename_rules(channels, params)
    listed = rules.groupBy(*DAY).agg(
        F.array_sort(F.collect_list(F.struct("ord", "src", "dst"))).alias("rules")
    )
    return listed.select(
        *DAY,
        F.array_join(
            F.transform("rules", lambda r: F.concat(r["src"], F.lit(":"), r["dst"])), ","
        ).alias("rename"),
        _spec(F.get("rules", F.lit(0))["src"]).alias("spec"),
    )


def _spec(src: Column) -> Column:
    return F.concat(S.base_channel(S.id_part(src, 4)), F.lit("?"))


def channel_spec(channels: DataFrame) -> DataFrame:
    """Channel spec of each day: first two letters of the first channel and `?`."""
    return (
        channels.groupBy(*DAY)
        .agg(F.min_by("stream_id", "ord").alias("first"))
        .select(*DAY, _spec(F.col("first")).alias("spec"))
    )


def day_rules(channels: DataFrame, params: Params = Params()) -> DataFrame:
    """Channel spec and rules of each station-day in one row (at most three rules)."""
    return (
        build_rename_rules(channels, params)
        .groupBy(*DAY)
        .agg(
            F.min_by("src", "ord").alias("first"),
            F.map_from_entries(F.collect_list(F.struct("src", "dst"))).alias("rules"),
        )
        .select(*DAY, _spec(F.col("first")).alias("spec"), "rules")
    )


def rename_by_day_rules(records: DataFrame) -> DataFrame:
    """Apply the `spec` and `rules` columns: filter on the source channel, then rename."""
    matching = records.filter(S.matches_channel_spec(F.col("cha"), F.col("spec")))
    target = matching.withColumn("_dst", F.try_element_at("rules", S.stream_id()))
    return target.withColumns({
        part: F.when(F.col("_dst").isNull(), F.col(part)).otherwise(S.id_part(F.col("_dst"), i))
        for i, part in enumerate(IDENTITY, start=1)
    }).drop("_dst", "spec", "rules")


def apply_rename(
    records: DataFrame, channels: DataFrame, params: Params = Params()
) -> DataFrame:
    """Keep records that match their day's channel spec and rename those with a rule.

    A day's rules travel as one small map, so records are joined once, by day.
    """
    joined = attach(
        records, day_rules(channels, params), DAY,
        ["start_ts", "end_ts", "n_samples", "cha"], params,
    )
    return rename_by_day_rules(joined)


# --- wildcard rules given by the caller --------------------------------------

@dataclass(frozen=True)
class RenameRule:
    """Four-part pattern and four-part target.

    A pattern part is a code, or uses `*` (any text), `?` (any character) and
    `(a|b)`; a target part `-` keeps the code.
    """

    src: tuple[str, str, str, str]
    dst: tuple[str, str, str, str]

    def matches(self) -> Column:
        hit = F.lit(True)
        for part, want in zip(IDENTITY, self.src):
            code = F.coalesce(F.col(part), F.lit(""))
            if want == "*":
                continue
            if any(c in want for c in "*?|()"):
                regex = want.replace("?", ".").replace("*", ".*")
                hit = hit & F.rlike(code, F.lit(f"^(?:{regex})$"))
            else:
                hit = hit & (code == want)
        return hit


def parse_rules(text: str) -> list[RenameRule]:
    """Rules from `SRC:DST,SRC:DST`; a rule without SRC applies to every stream."""
    rules = []
    for item in filter(None, text.split(",")):
        src, _, dst = item.rpartition(":")
        parts = [tuple(p.split(".")) for p in (src or "*.*.*.*", dst)]
        if any(len(p) != 4 for p in parts):
            raise ValueError(f"not a four-part rule: {item}")
        rules.append(RenameRule(*parts))
    return rules


def apply_wildcard_rename(records: DataFrame, rules: str | list[RenameRule]) -> DataFrame:
    """Rename by the first matching rule; unmatched records keep their identity.

    The caller's rules become one expression, so nothing is joined or shuffled.
    """
    rules = parse_rules(rules) if isinstance(rules, str) else rules
    if not rules:
        return records
    first = F.coalesce(*[F.when(r.matches(), F.lit(i)) for i, r in enumerate(rules)], F.lit(-1))
    matched = records.withColumn("_rule", first)

    def renamed(pos: int) -> Column:
        value = F.col(IDENTITY[pos])
        out = value
        for i, rule in enumerate(rules):
            if rule.dst[pos] != "-":
                out = F.when(F.col("_rule") == i, F.lit(rule.dst[pos])).otherwise(out)
        return out

    return matched.withColumns(
        {part: renamed(pos) for pos, part in enumerate(IDENTITY)}
    ).drop("_rule")


def stream_targets(streams: DataFrame, rules: DataFrame) -> DataFrame:
    """Each stream's target parts by the first rule (lowest `ord`) that fits it.

    `rules` has `ord`, `src` and `dst` with the four parts each; a part of `src` is a
    code or `*`, a part `-` of `dst` keeps the code. A stream can only meet 16 patterns,
    its own codes with `*` in any of the four places, so it is joined under those keys
    instead of being tried against every rule. Streams that no rule fits have no row.
    """
    code = lambda c: F.coalesce(F.col(c), F.lit(""))
    own = streams.select(*[code(c).alias(c) for c in IDENTITY]).distinct()
    mask = F.explode(F.sequence(F.lit(0), F.lit(15)))
    masked = own.withColumn("_mask", mask).withColumns({
        f"_{c}": F.when(F.getbit("_mask", F.lit(i)) == 1, "*").otherwise(F.col(c)) for i, c in enumerate(IDENTITY)
    })
    keys = [f"_{c}" for c in IDENTITY]
    # Of rules with one pattern only the first can ever count.
    target = F.struct("ord", *[F.col(f"dst.{c}").alias(c) for c in IDENTITY])
    first = rules.groupBy(*[F.col(f"src.{c}").alias(f"_{c}") for c in IDENTITY]).agg(F.min(target).alias("_to"))
    best = masked.join(first, keys).groupBy(*IDENTITY).agg(F.min("_to").alias("_to"))
    return best.select(*IDENTITY, *[
        F.when(F.col(f"_to.{c}") == "-", F.col(c)).otherwise(F.col(f"_to.{c}")).alias(f"to_{c}") for c in IDENTITY
    ], F.col("_to.ord").alias("ord"))


def rename_by_table(records: DataFrame, rules: DataFrame, params: Params = Params()) -> DataFrame:
    """Rename by a table of rules of any size; unmatched records keep their identity.

    Rules meet the distinct streams, and the streams' targets the records, in sliced
    joins: one stream may hold a large share of all records. A NULL code is taken as an
    empty one while matching.
    """
    keys = [f"_{c}" for c in IDENTITY]
    targets = stream_targets(records.select(*IDENTITY), rules)
    facts = targets.select(*[F.col(c).alias(k) for c, k in zip(IDENTITY, keys)], *[f"to_{c}" for c in IDENTITY])
    keyed = records.withColumns({k: F.coalesce(F.col(c), F.lit("")) for c, k in zip(IDENTITY, keys)})
    joined = attach(keyed, facts, keys, ["start_ts", "n_samples"], params, "left")
    return joined.withColumns(
        {c: F.coalesce(f"to_{c}", F.col(c)) for c in IDENTITY}
    ).select(*records.columns)


def with_band_codes(records: DataFrame, corner_period: Column) -> DataFrame:
    """Add the standard band letter and the instrument behind the second letter."""
    return records.withColumns({
        "band_code": S.band_code(F.col("rate"), corner_period),
        "instrument": S.instrument_name(F.col("cha")),
    })
