"""Colours as hex, luminance and hue."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIZES = (192, 256, 512, 1024)


def hex_of(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("#%02X%02X%02X", r, g, b)


def luminance(r: Column, g: Column, b: Column) -> Column:
    """Relative luminance of an sRGB colour of 0 to 255."""

    def channel(c: Column) -> Column:
        x = c / 255.0
        return F.when(x <= 0.03928, x / 12.92).otherwise(F.pow((x + 0.055) / 1.055, F.lit(2.4)))

    return 0.2126 * channel(r) + 0.7152 * channel(g) + 0.0722 * channel(b)


def hue_distance(a: Column, b: Column) -> Column:
    d = F.abs(a - b)
    return F.least(d, 360 - d)


def hue(r: Column, g: Column, b: Column) -> Column:
    """Degrees; 0 for greys."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    span = (top - low).cast("double")
    raw = F.when(top == r, F.pmod((g - b) / F.nullif(span, F.lit(0.0)), F.lit(6.0))).when(top == g, (b - r) / span + 2).otherwise((r - g) / span + 4)
    return F.when(span == 0, F.lit(0.0)).otherwise(raw * 60)


def dark_lightness(luminance_at, start: float = 0.45, step: float = 0.05, floor: float = 0.15, most: float = 0.6) -> Column:
    """The first lightness from start downwards whose luminance (a function of lightness) is under `most`, else the floor."""
    ladder = F.array(*[F.lit(round(start - i * step, 2)) for i in range(round((start - floor) / step) + 1)])
    return F.coalesce(F.filter(ladder, lambda x: luminance_at(x) < most)[0], F.lit(floor))


def hsl(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """Hue in degrees, saturation and lightness of 0 to 1."""
    top, low = F.greatest(r, g, b) / 255.0, F.least(r, g, b) / 255.0
    light, span = (top + low) / 2, top - low
    return hue(r, g, b), F.when(span == 0, 0.0).when(light <= 0.5, span / F.nullif(top + low, F.lit(0.0))).otherwise(span / F.nullif(2.0 - top - low, F.lit(0.0))), light


def from_hsl(h: Column, s: Column, light: Column) -> tuple[Column, Column, Column]:
    """Red, green and blue of 0 to 255, halves to even."""
    width = s * F.least(light, 1 - light)

    def channel(turn: int) -> Column:
        k = F.pmod(turn + h / 30, F.lit(12.0))
        return F.bround((light - width * F.greatest(F.lit(-1.0), F.least(k - 3, 9 - k, F.lit(1.0)))) * 255, 0).cast("int")

    return channel(0), channel(8), channel(4)


def ensure_dark(r: Column, g: Column, b: Column, most: float = 0.6, start: float = 0.45, step: float = 0.05, floor: float = 0.15) -> Column:
    """(r, g, b) as it is if its luminance is under `most`, else the same hue at the first lightness from `start` downwards where that holds."""
    h, s, _ = hsl(r, g, b)
    own = F.struct(r.cast("int").alias("r"), g.cast("int").alias("g"), b.cast("int").alias("b"))

    def darker(x: Column) -> Column:
        light = dark_lightness(lambda at: luminance(*from_hsl(x.h, x.s, at)), start, step, floor, most)
        return F.transform(F.array(light), lambda at: F.struct(*[c.alias(n) for c, n in zip(from_hsl(x.h, x.s, at), "rgb", strict=True)]))[0]

    # As a variable, hue and saturation are worked out once.
    return F.when(luminance(r, g, b) < most, own).otherwise(F.transform(F.array(F.struct(h.alias("h"), s.alias("s"))), darker)[0])


def largest_size(side: Column) -> Column:
    return F.array_max(F.filter(F.array(*map(F.lit, SIZES)), lambda s: s <= side))
