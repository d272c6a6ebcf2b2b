"""Granule names, keys and hashes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a granule's file name, in order, and what each looks like.
NAME_PARTS = {
    "product": r"\w+_\w",
    "year": r"\d{4}",
    "julian_day": r"\d{3}",
    "hour": r"\d{2}",
    "minute": r"\d{2}",
    "second": r"\d{2}",
    "orbit": r"O\d+",
    "sub_orbit_granule": r"\d{2}",
    "ground_track": r"T\d+",
    "positioning": r"\d{2}",
    "release_number": r"\d{3}",
    "granule_production_version": r"\d{2}",
    "major_version_number": r"V\d+",
}
#: Parts that follow the one before without an underscore.
_JOINED = ("julian_day", "hour", "minute", "second")
PATTERN = "".join(("" if i == 0 or n in _JOINED else "_") + f"({p})" for i, (n, p) in enumerate(NAME_PARTS.items()))


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with value worked out once, however often of uses it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def name_part(name: Column, part: str) -> Column:
    """One of NAME_PARTS; empty for a name of another form."""
    return F.regexp_extract(name, PATTERN, list(NAME_PARTS).index(part) + 1)


def name_span(name: Column, first: str, last: str) -> Column:
    """Neighbouring parts of NAME_PARTS as they stand in the name, found at once; null for a name of another form."""
    names = list(NAME_PARTS)
    texts = [("" if i == 0 or n in _JOINED else "_") + NAME_PARTS[n] for i, n in enumerate(names)]
    begin, end = names.index(first), names.index(last)
    texts[begin] = texts[begin].removeprefix("_")
    glue = "_" if begin and first not in _JOINED else ""
    found = F.regexp_extract(name, "".join(texts[:begin]) + glue + "(" + "".join(texts[begin : end + 1]) + ")" + "".join(texts[end + 1 :]), 1)
    return F.nullif(found, F.lit(""))


def parse_name(name: Column, strict: bool = False) -> Column:
    """struct of NAME_PARTS; a name of another form gives null, or with strict an error. The name is matched once and its
    parts are split at commas, which no part holds."""
    other = F.raise_error(F.concat(F.lit("not a granule name: "), F.coalesce(name, F.lit("null")))) if strict else F.lit(None)
    listed = ",".join(f"${i + 1}" for i in range(len(NAME_PARTS)))
    parts = lambda found: let(F.split(F.regexp_replace(found, PATTERN, listed), ","), lambda p: F.struct(*[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(NAME_PARTS)]))
    return let(F.regexp_extract(name, PATTERN, 0), lambda found: F.when(found != "", parts(found)).otherwise(other))


def start_time(name: Column) -> Column:
    """Timestamp of the name's year, day of the year and time."""
    return F.to_timestamp(name_span(name, "year", "second"), "yyyyDDDHHmmss")


def granule_key(name: Column) -> Column:
    """orbit_suborbit of a granule's name; null for a name of another form."""
    return name_span(name, "orbit", "sub_orbit_granule")


def hash_list(items: Column) -> Column:
    """md5 of the items, each after its length, joined by commas."""
    return F.md5(F.array_join(F.transform(items, lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x)), ",").cast("binary"))
