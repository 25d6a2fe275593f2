"""Job parameters. Values become literals in the plans."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # Target identity of every imported seismometer stream.
    net: str = "VW"
    loc: str = "00"
    ch: str = "CH"

    # A full day is one file per minute; a day short by at most
    # `threshold_missing` files still counts as complete.
    expected: int = 1440
    threshold_missing: int = 60

    # Days holding both recorder families are decided by majority only from
    # this many files on.
    min_files: int = 100

    # Files the majority station name of a day should reach.
    min_count: int = 144

    # Smallest group of files sharing a seconds stamp that counts as continuous.
    stamp_min: int = 10

    # Streams imported per station-day.
    max_channels: int = 3

    # Log lines kept in a failure report.
    tail_lines: int = 30

    # Ancillary and triggered names, matched against the base name.
    ignore_echo: str = r"trig|\.ss|\.xml|mseed"
    ignore_gecko: str = r"trig|\.dmx|\.suds|mseed"

    # Recorder type assumed before a station's first decided day.
    first_type: str = "echo"

    # Slices a group is cut into when per-group facts are joined back to rows.
    slices: int = 16

    # Most rows of per-day facts (about 300 bytes each) sent to every executor.
    broadcast_rows: int = 200_000

    # Most year and station folders of filed records named one by one.
    folder_globs: int = 2_000

    # Buckets of a table of filed keys, fixed once it is made.
    key_buckets: int = 64

    # Most bitmaps (4 kB each) of a set of keys sent to every executor.
    bitmaps: int = 16_384

    @property
    def near_complete(self) -> int:
        return self.expected - self.threshold_missing

    def ignore(self, family: str) -> str:
        return self.ignore_echo if family == "echo" else self.ignore_gecko

    def with_(self, **changes) -> "Params":
        return replace(self, **changes)
