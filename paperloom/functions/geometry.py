"""Box arithmetic as column expressions; a box is a struct of x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1, y1, x2, y2) -> Column:
    return F.struct(*[F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for c, n in ((x1, "x1"), (y1, "y1"), (x2, "x2"), (y2, "y2"))])


def width(b: Column) -> Column:
    return b["x2"] - b["x1"]


def height(b: Column) -> Column:
    return b["y2"] - b["y1"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def center(b: Column) -> Column:
    return F.struct(F.floor((b["x1"] + b["x2"]) / 2).alias("x"), F.floor((b["y1"] + b["y2"]) / 2).alias("y"))


def shared_area(a: Column, b: Column) -> Column:
    across = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    down = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(across, F.lit(0)) * F.greatest(down, F.lit(0))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    both = shared_area(a, b)
    return _share(both, area(a) + area(b) - both)


def covered(small: Column, big: Column) -> Column:
    """The part of small that lies in big."""
    return _share(shared_area(small, big), area(small))


def padded(b: Column, page_width: Column, page_height: Column, ratio: float = 0.05, least: int = 4, cap: int | None = 40) -> Column:
    """b with a margin of ratio of its sides (at least least, at most cap), within the page."""

    def margin(side: Column) -> Column:
        out = F.greatest(F.lit(least), (side * ratio).cast("int"))
        return out if cap is None else F.least(F.lit(cap), out)

    x, y = margin(width(b)), margin(height(b))
    return box(F.greatest(b["x1"] - x, F.lit(0)), F.greatest(b["y1"] - y, F.lit(0)), F.least(b["x2"] + x, page_width), F.least(b["y2"] + y, page_height))


def clipped(b: Column, page_width: Column, page_height: Column) -> Column:
    """b within the page; a box without an inside becomes one pixel."""
    x1, y1 = F.greatest(F.lit(0), b["x1"]), F.greatest(F.lit(0), b["y1"])
    x2, y2 = F.least(page_width, b["x2"]), F.least(page_height, b["y2"])
    good = (x2 > x1) & (y2 > y1)
    return F.when(good, box(x1, y1, x2, y2)).otherwise(box(*[F.lit(v) for v in (0, 0, 1, 1)]))


def aligned(side: Column, step: int = 48) -> Column:
    """side as a multiple of step, halves to the even one, at least one step."""
    return F.greatest(F.lit(step), (F.bround(side / step) * step).cast("int"))


def longest_side(budget: Column, pixels: int = 784) -> Column:
    return F.sqrt(budget * pixels).cast("int")


def fitted(w: Column, h: Column, most: Column) -> Column:
    """Width and height with the longer side at most most."""
    longer = F.greatest(w, h)
    scale = F.when(longer > most, most / longer).otherwise(F.lit(1.0))
    return F.struct(F.greatest(F.lit(1), (w * scale).cast("int")).alias("width"), F.greatest(F.lit(1), (h * scale).cast("int")).alias("height"))


def scaled(b: Column, x: Column, y: Column) -> Column:
    """A template's box on a page, cut to whole pixels; null if nothing is left of it."""
    out = box((b["x1"] * x).cast("int"), (b["y1"] * y).cast("int"), (b["x2"] * x).cast("int"), (b["y2"] * y).cast("int"))
    return F.when((out["x2"] > out["x1"]) & (out["y2"] > out["y1"]), out)


def estimated_dpi(w: Column, h: Column, hint: Column) -> Column:
    """The hint, or the mean resolution at which the sides are those of A4 (210 by 297 mm), from 72 to 600."""
    down, across = (h / (297 / 25.4)).cast("int"), (w / (210 / 25.4)).cast("int")
    return F.coalesce(F.when(hint > 0, hint), F.least(F.lit(600), F.greatest(F.lit(72), F.floor((down + across) / 2).cast("int"))))


def dpi_band(dpi: Column) -> Column:
    return F.when(dpi < 150, "low").when(dpi < 250, "mid").otherwise("high")


def brightness_band(mean: Column) -> Column:
    return F.when(mean < 80, "dark").when(mean > 200, "bright").otherwise("normal")


def sauvola_window(dpi: Column) -> Column:
    """An odd window as wide as a 2.5 mm character, at least 7."""
    side = (dpi / 25.4 * 2.5).cast("int")
    return F.greatest(F.lit(7), side + F.when(side % 2 == 0, 1).otherwise(0))


def quality_score(brightness: Column, contrast: Column, sharpness: Column, ink: Column, band: Column) -> Column:
    """Mean of four scores of a page image's statistics, less for a low resolution."""
    light = F.when(brightness < 50, 0.3).when(brightness > 220, 0.6).otherwise(1.0)
    text = F.when(ink < 0.01, 0.1).when(ink > 0.8, 0.4).otherwise(1.0)
    sharp = F.least(F.lit(1.0), sharpness / F.when(band == "low", 200.0).otherwise(500.0))
    mean = (light + F.least(F.lit(1.0), contrast / 60.0) + sharp + text) / 4
    return F.round(mean * F.when(band == "low", 0.85).otherwise(1.0), 4)
