"""Spark jobs that catalogue, choose, rename and file continuous seismic recordings."""

from archivekit.params import Params

__all__ = ["Params"]
