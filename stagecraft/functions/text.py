"""Report text: progress bar and padded thousands text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Bar glyphs and the width of the padded count text
# (a 999,999,999,999,999,999 picture is 23 characters wide).
FILLED = "⬛"
EMPTY = "⬜"
COUNT_TEXT_WIDTH = 23


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def progress_bar(percentage: Column | str, decimals: int = 2, segments: int = 10) -> Column:
    """Bar of ``segments`` squares plus the percentage with ``decimals`` places.

    Null in, null out. NaN counts as 0; values are clamped to 0..100. The
    number of filled squares is round(segments * shown percentage / 100).
    """
    if decimals < 0 or segments < 0:
        raise ValueError("decimals and segments must be >= 0")
    p = _col(percentage).cast("double")
    clamped = F.least(F.greatest(F.when(F.isnan(p), F.lit(0.0)).otherwise(p), F.lit(0.0)), F.lit(100.0))
    scale = 10 ** int(decimals)

    def text(units: Column) -> Column:
        return F.format_string("%d", units) if not decimals else F.format_string(
            f"%d.%0{int(decimals)}d", F.floor(units / scale).cast("long"), units % scale)

    def bar(shown: Column) -> Column:
        filled = F.round(F.lit(float(segments)) * shown.cast("double") / F.lit(100.0)).cast("int")
        return F.concat(F.repeat(F.lit(FILLED), filled), F.repeat(F.lit(EMPTY), F.lit(int(segments)) - filled),
                        F.lit(" "), shown, F.lit("%"))

    return F.when(p.isNotNull(), let(let(rounded_units(clamped, int(decimals)), text), bar))


def rounded_units(value: Column, decimals: int) -> Column:
    """``value`` (0 or more) in units of its last shown decimal, rounded by its exact binary value.

    1.005 lies below its decimal text, so two decimals give 100 units, not 101.
    The value is split in two halves of 26 bits: products of a half with the
    scale are exact, so the sign of the distance to a middle is, too. Exact
    middles go to the even unit.
    """
    scale = float(10 ** decimals)

    def with_value(v: Column) -> Column:
        wide = v * F.lit(134217729.0)
        high = wide - (wide - v)
        return let(F.struct(high.alias("high"), (v - high).alias("low"), F.floor(v * scale).cast("double").alias("near")), with_halves)

    def with_halves(p: Column) -> Column:
        def beyond(units: Column) -> Column:
            return (p["high"] * scale - units) + p["low"] * scale

        near = p["near"]
        base = F.when(beyond(near) < 0, near - 1).when(beyond(near + 1) >= 0, near + 1).otherwise(near)
        return let(base, lambda b: let(beyond(b + 0.5), lambda half: (
            b + F.when((half > 0) | ((half == 0) & (b % 2 == 1)), F.lit(1.0)).otherwise(F.lit(0.0))).cast("long")))

    return let(value, with_value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def progress_bar_sql(pct_sql: str, decimals: int = 2, segments: int = 10) -> str:
    """DuckDB text of the same bar (oracle side)."""
    clamped = f"least(greatest(case when isnan({pct_sql}) then 0.0 else {pct_sql} end, 0.0), 100.0)"
    shown = f"printf('%.{int(decimals)}f', {clamped})"
    filled = f"cast(round({float(segments)} * cast({shown} as double) / 100.0) as integer)"
    return (f"case when {pct_sql} is not null then repeat('{FILLED}', {filled}) || "
            f"repeat('{EMPTY}', {int(segments)} - {filled}) || ' ' || {shown} || '%' end")


def thousands_text(n: Column | str, width: int = COUNT_TEXT_WIDTH) -> Column:
    """Whole number with thousands separators, right-aligned in ``width`` characters (longer text stays whole)."""
    text = F.format_number(_col(n).cast("long"), 0)
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(" "))
