"""Column expressions with the semantics the features rely on.

All of them are built-in expressions: nothing here raises under ANSI mode and
nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citypulse import schemas as S


def round_half_even(value: Column, places: int) -> Column:
    """Round ties to the even neighbour (``F.round`` rounds them away from zero)."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def speed_ratio(current: Column, free: Column) -> Column:
    """Unrounded current / free-flow speed; 1.0 (clear) where there is no free-flow speed."""
    ratio = F.try_divide(current.cast("double"), free.cast("double"))
    return F.when(free > 0, ratio).otherwise(F.lit(1.0))


def congestion_ratio(current: Column, free: Column) -> Column:
    """Speed ratio to two places: 1.0 is clear road, 0.5 is half speed."""
    return round_half_even(speed_ratio(current, free), 2)


def traffic_status(ratio: Column) -> Column:
    """Band of an *unrounded* city ratio."""
    return (
        F.when(ratio < S.CONGESTED_BELOW, "congested")
        .when(ratio < S.HEAVY_BELOW, "heavy_traffic")
        .otherwise("flowing")
    )


def naive_timestamp(text: Column) -> Column:
    """Zone-free timestamp of an ISO string, null where it does not parse."""
    return text.try_cast("timestamp_ntz")


def normalise_grid_id(grid_id: Column) -> Column:
    """``0_0`` -> ``grid_0_0``; ids that carry the prefix stay as they are."""
    return F.when(grid_id.startswith("grid_"), grid_id).otherwise(F.concat(F.lit("grid_"), grid_id))


def is_road(line: Column) -> Column:
    """Case-sensitive substring test for buses and trams; null for a null line."""
    found = line.contains(S.ROAD_MARKERS[0])
    for marker in S.ROAD_MARKERS[1:]:
        found = found | line.contains(marker)
    return found


def transit_mode(line: Column) -> Column:
    """'bus', 'rail', or null for a null line. Whatever is not road counts as rail."""
    return F.when(is_road(line), "bus").when(~is_road(line), "rail")


JSON_SPACE = " \t\r\n"


def trim_json(text: Column) -> Column:
    """Text without the white space that JSON allows around a value."""
    return F.btrim(text, F.lit(JSON_SPACE))


# What is put behind a text to see whether the reader gets past it; no key of a sample is called so.
MARK = "_end_of_value"
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _marked(text: Column, mark: str) -> Column:
    return F.when(~text.contains(MARK), F.concat(F.lit("["), text, F.lit(f",{mark}]")))


def read_object(text: Column, schema: str, strict: bool = False) -> Column:
    """A text decoded once, for :func:`whole_object`; to be a column of its own, as it is looked at several times.

    The JSON reader stops behind the first value, whatever follows it. Here the text is the first element of an
    array whose second one is a mark: the reader gets to the mark, as the second element, only past one whole
    value. Text that holds the mark's name itself is not read. ``strict`` allows nothing that JSON does not.
    """
    elements = f"ARRAY<STRUCT<{schema}, {MARK}: BOOLEAN>>"
    return F.from_json(_marked(text, f'{{"{MARK}":true}}'), elements, STRICT if strict else {})


def whole_object(read: Column) -> Column:
    """The struct of a text that is one JSON object and nothing else, with the mark's field at its end, null for other text."""
    return F.when((F.size(read) == 2) & F.get(read, F.lit(1))[MARK], F.get(read, F.lit(0)))


def is_json_object(text: Column) -> Column:
    """True for text that is one JSON object and nothing else. False for other text, null for null."""
    read = F.from_json(_marked(text, f'"{MARK}"'), "array<string>", STRICT)
    # an array is equal to this one only if there is nothing else in it, and the text is looked at once
    good = F.coalesce(F.slice(read, 2, 2) == F.array(F.lit(MARK)), F.lit(False))
    return F.when(text.isNotNull(), trim_json(text).startswith("{") & good)


def whole_number(value: Column) -> Column:
    """INT where the number is integral, else null."""
    return F.when(value == F.floor(value), value.try_cast("int"))
