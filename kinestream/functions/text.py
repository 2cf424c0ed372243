"""Names, paths and clock texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_name(name: Column) -> Column:
    """A name of letters, digits, dots, hyphens and underscores; any other character is an underscore."""
    return F.regexp_replace(name, "[^A-Za-z0-9._-]", "_")


def leads_out(path: Column) -> Column:
    """Whether a path is empty, absolute, has a backslash or a part ``..``: it might lead out of its folder."""
    return (path == "") | path.startswith("/") | F.contains(path, F.lit("\\")) | F.array_contains(F.split(path, "/", -1), "..")


def header(entity: Column, axis: str) -> Column:
    """The header of an entity's place along an axis in a track file."""
    return F.concat(entity, F.lit(f"_Pos_{axis}(mm)"))


def rounded_micros(nanoseconds: Column) -> Column:
    """Nanoseconds as microseconds, half up."""
    return F.call_function("div", nanoseconds + 500, F.lit(1000))


def fixed_zone(shown: Column, zone: str) -> Column:
    """The instant that a text yyyy-MM-dd HH:mm:ss with any fraction means in a zone of a fixed offset, like +08:00."""
    return F.to_timestamp(F.concat(shown, F.lit(zone)), "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]XXX")
