"""Where characters lie: straight, vertical, right-to-left, arc, sine and multi-line layout of one text per row.

A text's boxes are made within its row, from running sums of its glyph widths, so nothing is exploded or shuffled to lay text
out. Overlap is given in basis points, so that cursors are exact. Widths are class-based parts of the font size (a table of a
font's own widths can be joined instead, see ``quillspark.sources.fonts``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARGIN, SINE_MARGIN, ARC_MARGIN, CROP = 10, 20, 50, 10
DEG = 57.29577951308232
#: Percent of the font size that characters are wide: narrow ones, wide ones, East Asian ones, others.
NARROW, NARROW_PERCENT = "iljtfrI.,:;!'|", 35
WIDE, WIDE_PERCENT = "mwMW@%", 85
SQUARE_FROM, SQUARE_PERCENT, PLAIN_PERCENT = "⺀", 100, 60
ASCENT_PERCENT, DESCENT_PERCENT = 93, 24
HORIZONTAL = ("left_to_right", "right_to_left")
VERTICAL = ("top_to_bottom", "bottom_to_top")
BACKWARD = ("right_to_left", "bottom_to_top")


def chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def advance(ch: Column, size: Column) -> Column:
    percent = F.when(F.instr(F.lit(NARROW), ch) > 0, NARROW_PERCENT).when(F.instr(F.lit(WIDE), ch) > 0, WIDE_PERCENT).when(ch >= SQUARE_FROM, SQUARE_PERCENT).otherwise(PLAIN_PERCENT)
    return F.floor(size * percent / 100).cast("bigint")


def height(size: Column) -> Column:
    return (F.floor(size * ASCENT_PERCENT / 100) + F.floor(size * DESCENT_PERCENT / 100)).cast("bigint")


def widths(text: Column, size: Column) -> Column:
    return F.transform(chars(text), lambda c: advance(c, size))


def running(values: Column) -> Column:
    """Sums before each element, and of all at the end."""
    return F.aggregate(values, F.array(F.lit(0).cast("bigint")), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def kept(length: Column, overlap: Column) -> Column:
    """A length without what overlaps, in pixels (double)."""
    return length * (F.lit(10000) - overlap) / F.lit(10000.0)


def whole(x: Column) -> Column:
    return F.floor(x).cast("bigint")


def extent(text: Column, size: Column, overlap: Column) -> Column:
    """Width of a straight text."""
    return whole(kept(total(widths(text, size)), overlap) + 2 * MARGIN)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often and in whatever lambda it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _laid_out(text: Column, size: Column, backward: Column | None, box: Callable[[Column, Column, Column, Column, Column], Column]) -> Column:
    """box(position, character, width, width before it, facts) for each character, facts being ``n, total, widest``.

    Where backward, the text is placed from its end, but listed in its order.
    """

    def sums(w: Column) -> Column:
        n = F.size(w)
        forth = F.slice(running(w), F.lit(1), n)
        return forth if backward is None else F.when(backward, F.reverse(F.slice(running(F.reverse(w)), F.lit(1), n))).otherwise(forth)

    def over(s: Column) -> Column:
        glyphs = F.zip_with(F.zip_with(s["c"], s["w"], lambda c, w: F.struct(c.alias("c"), w.alias("w"))), sums(s["w"]), lambda g, b: F.struct(g["c"].alias("c"), g["w"].alias("w"), b.alias("b")))
        facts = F.struct(F.size(s["w"]).alias("n"), total(s["w"]).alias("total"), F.array_max(s["w"]).alias("widest"))
        return let(facts, lambda k: F.transform(glyphs, lambda g, i: box(i, g["c"], g["w"], g["b"], k)))

    return let(chars(text), lambda c: let(F.struct(c.alias("c"), F.transform(c, lambda x: advance(x, size)).alias("w")), over))


def _box(i: Column, c: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(i.alias("char_pos"), c.alias("char"), *(x.cast("bigint").alias(n) for n, x in zip(("x0", "y0", "x1", "y1"), (x0, y0, x1, y1), strict=True)))


def straight(text: Column, size: Column, overlap: Column, backward: Column | None = None) -> Column:
    """Boxes of a horizontal line; backward for right-to-left text."""

    def box(i: Column, c: Column, w: Column, before: Column, _: Column) -> Column:
        x = F.lit(MARGIN) + kept(before, overlap)
        return _box(i, c, whole(x), F.lit(MARGIN), whole(x + w), height(size) + MARGIN)

    return _laid_out(text, size, backward, box)


def vertical(text: Column, size: Column, overlap: Column, upward: Column) -> Column:
    """Boxes of a vertical line, downward or upward; characters are centred."""
    h = height(size)

    def box(i: Column, c: Column, w: Column, _: Column, k: Column) -> Column:
        left = (k["widest"] + 2 * MARGIN - w) / 2.0
        tall = whole(kept(k["n"] * h, overlap) + 2 * MARGIN)
        top = F.when(upward, tall - MARGIN - kept((i + 1) * h, overlap)).otherwise(MARGIN + kept(i * h, overlap))
        return _box(i, c, whole(left), whole(top), whole(left + w), whole(top + h))

    return _laid_out(text, size, None, box)


def _turned(cx: Column, cy: Column, w: Column, h: Column, degrees: Column) -> tuple[Column, Column, Column, Column]:
    """Bounds of a rectangle around (cx, cy) after turning."""
    c, s = F.abs(F.cos(degrees / DEG)), F.abs(F.sin(degrees / DEG))
    dx, dy = (w * c + h * s) / 2.0, (w * s + h * c) / 2.0
    return cx - dx, cy - dy, cx + dx, cy + dy


def _curve_box(i: Column, ch: Column, w: Column, h: Column, cx: Column, cy: Column, degrees: Column) -> Column:
    def around(p: Column) -> Column:
        named = [b.alias(n) for n, b in zip(("x0", "y0", "x1", "y1"), _turned(p["cx"], p["cy"], w, h, p["degrees"]), strict=True)]
        return F.struct(i.alias("char_pos"), ch.alias("char"), p["cx"].alias("cx"), p["cy"].alias("cy"), p["degrees"].alias("degrees"), *named)

    return let(F.struct(cx.alias("cx"), cy.alias("cy"), degrees.alias("degrees")), around)


def arc(text: Column, size: Column, overlap: Column, direction: Column, radius: Column, concave: Column) -> Column:
    """Exact boxes along a circle, before they are cut to whole pixels (see ``cropped``)."""
    h = height(size)
    centre = F.floor(radius * 2 + h + 2 * ARC_MARGIN) / 2.0
    half_pi = 1.5707963267948966

    def box(i: Column, c: Column, w: Column, before: Column, k: Column) -> Column:
        span = kept(k["total"], overlap) / radius
        start = F.when(direction.isin(*HORIZONTAL), F.when(concave, half_pi + span / 2.0).otherwise(-half_pi - span / 2.0)).otherwise(F.when(concave, F.lit(2 * half_pi)).otherwise(F.lit(0.0)))
        angle = start - (kept(before, overlap) + w / 2.0) / radius
        return let(angle, lambda a: _curve_box(i, c, w, h, centre + radius * F.cos(a), centre - radius * F.sin(a), -(a * DEG + 90.0) + F.when(concave, 0.0).otherwise(180.0)))

    return _laid_out(text, size, direction.isin(*BACKWARD), box)


def sine(text: Column, size: Column, overlap: Column, direction: Column, amplitude: Column, frequency: Column, phase: Column) -> Column:
    """Exact boxes along a wave, before they are cut to whole pixels."""
    h = height(size)
    flat = direction.isin(*HORIZONTAL)
    buffer = F.floor(amplitude * 2) + SINE_MARGIN

    def box(i: Column, c: Column, w: Column, before: Column, k: Column) -> Column:
        at = kept(before, overlap)
        t = frequency * (at + w / 2.0) + phase
        off = amplitude * F.sin(t)
        degrees = -F.atan(amplitude * frequency * F.cos(t)) * DEG
        middle_y, middle_x = (h + 2 * buffer) / 2.0, (k["widest"] + 2 * buffer) / 2.0
        cx = F.when(flat, F.floor(SINE_MARGIN + at)).otherwise(F.floor(middle_x - k["widest"] / 2.0 + off)) + w / 2.0
        cy = F.when(flat, F.floor(middle_y - h / 2.0 + off)).otherwise(F.floor(SINE_MARGIN + at)) + h / 2.0
        return _curve_box(i, c, w, h, cx, cy, degrees)

    return _laid_out(text, size, direction.isin(*BACKWARD), box)


def cropped(boxes: Column) -> Column:
    """Boxes cut to whole pixels and moved so that they begin CROP pixels from the edge."""
    return let(_whole_boxes(boxes), _moved_to_edge)


def _whole_boxes(boxes: Column) -> Column:
    return F.transform(boxes, lambda b: F.struct(b["char_pos"].alias("char_pos"), b["char"].alias("char"), *(F.greatest(F.lit(0), b[n].cast("bigint")).alias(n) for n in ("x0", "y0", "x1", "y1"))))


def _moved_to_edge(ints: Column) -> Column:
    left = F.greatest(F.lit(0), F.array_min(F.transform(ints, lambda b: b["x0"])) - CROP)
    top = F.greatest(F.lit(0), F.array_min(F.transform(ints, lambda b: b["y0"])) - CROP)
    edge = F.struct(left.alias("x"), top.alias("y"))
    return let(edge, lambda e: F.transform(ints, lambda b: _box(b["char_pos"], b["char"], b["x0"] - e["x"], b["y0"] - e["y"], b["x1"] - e["x"], b["y1"] - e["y"])))


def line_height(size: Column, spacing_percent: Column) -> Column:
    return F.floor(height(size) * spacing_percent / 100).cast("bigint")


def line_step(size: Column, spacing_percent: Column) -> Column:
    """Distance of vertical lines."""
    return F.floor(F.floor(size * PLAIN_PERCENT / 100) * spacing_percent * 2 / 100).cast("bigint")


def aligned(alignment: Column, room: Column, used: Column, centre: str = "center", end: tuple[str, ...] = ("right", "bottom")) -> Column:
    return F.when(alignment == centre, F.floor((room - used) / 2)).when(alignment.isin(*end), room - used).otherwise(0).cast("bigint")


def line_positions(lines: Column, size: Column, spacing: Column, alignment: Column, direction: Column) -> Column:
    """(x, y) of each line, relative to the block."""
    flat = direction.isin(*HORIZONTAL)

    def at(n: Column, i: Column, room: Column) -> Column:
        step = i * F.when(flat, line_height(size, spacing)).otherwise(line_step(size, spacing))
        side = F.when(flat & alignment.isin("top", "bottom") | ~flat & alignment.isin("left", "right"), 0).otherwise(aligned(alignment, room, n)).cast("bigint")
        return F.struct(F.when(flat, side).otherwise(step).alias("x"), F.when(flat, step).otherwise(side).alias("y"))

    long = F.transform(lines, lambda x: F.when(flat, total(widths(x, size))).otherwise(F.length(x) * height(size)))
    return let(long, lambda ns: let(F.array_max(ns), lambda room: F.transform(ns, lambda n, i: at(n, i, room))))


def multiline(lines: Column, size: Column, overlap: Column, spacing: Column, alignment: Column, direction: Column | None = None, curved: Column | None = None, laid_out: Callable[[Column], Column] | None = None) -> Column:
    """Boxes of lines with their line_index; empty lines have none but keep their place.

    laid_out makes the boxes of one line, in its direction and along its curve; without it lines are straight, from left to right.
    Vertical lines stand beside each other; others are stacked.
    """
    beside = F.lit(False) if direction is None else F.coalesce(direction.isin(*VERTICAL), F.lit(False))

    def extent_of(x: Column, boxes: Column) -> Column:
        plain = F.when(beside, whole(kept(F.size(boxes) * height(size), overlap) + 2 * MARGIN)).otherwise(extent(x, size, overlap))
        if curved is not None:
            ends = F.when(beside, F.array_max(F.transform(boxes, lambda b: b["y1"]))).otherwise(F.array_max(F.transform(boxes, lambda b: b["x1"])))
            plain = F.when(curved, ends + CROP).otherwise(plain)
        return F.when(x == "", 0).otherwise(plain).cast("bigint")

    def line(s: Column, i: Column, room: Column) -> Column:
        side = F.when(F.when(beside, alignment.isin("left", "right")).otherwise(alignment.isin("top", "bottom")), 0).otherwise(aligned(alignment, room, s["used"]))
        step = i * F.when(beside, line_step(size, spacing)).otherwise(line_height(size, spacing))
        moved = F.struct(F.when(beside, step).otherwise(side).cast("bigint").alias("dx"), F.when(beside, side).otherwise(step).cast("bigint").alias("dy"))
        return let(moved, lambda m: boxes(s["boxes"], i, m["dx"], m["dy"]))

    def boxes(laid: Column, i: Column, dx: Column, dy: Column) -> Column:
        return F.transform(
            laid,
            lambda b: F.struct(i.alias("line_index"), b["char_pos"].alias("char_pos"), b["char"].alias("char"), (b["x0"] + dx).alias("x0"), (b["y0"] + dy).alias("y0"), (b["x1"] + dx).alias("x1"), (b["y1"] + dy).alias("y1")),
        )

    of = laid_out or (lambda x: straight(x, size, overlap))
    laid = F.transform(lines, lambda x: let(of(x), lambda b: F.struct(b.alias("boxes"), extent_of(x, b).alias("used"))))
    return let(laid, lambda ls: let(F.array_max(F.transform(ls, lambda s: s["used"])), lambda room: F.flatten(F.transform(ls, lambda s, i: line(s, i, room)))))


def block_size(lines: Column, size: Column, overlap: Column, spacing: Column, direction: Column) -> Column:
    """(width, height) of a block of lines; nothing for empty lines only."""
    flat, n = direction.isin(*HORIZONTAL), F.size(lines)
    empty = F.forall(lines, lambda x: x == "")
    w = F.when(flat, F.array_max(F.transform(lines, lambda x: whole(kept(total(widths(x, size)), overlap))))).otherwise(line_step(size, spacing) * n)
    h = F.when(flat, line_height(size, spacing) * n).otherwise(F.array_max(F.transform(lines, lambda x: F.length(x) * whole(kept(height(size), overlap)))))
    return F.struct(F.when(empty, 0).otherwise(w).cast("bigint").alias("width"), F.when(empty, 0).otherwise(h).cast("bigint").alias("height"))


def glyph_color(mode: Column, palette: Column, i: Column, n: Column) -> Column:
    """The colour of character i of n: cycling through a palette, a gradient between its ends, or its only colour."""
    t = F.when(n > 1, i / (n - 1).cast("double")).otherwise(0.0)
    return (
        F.when((F.size(palette) < 1) | palette.isNull(), F.array(F.lit(0), F.lit(0), F.lit(0)).cast("array<bigint>"))
        .when(mode == "per_glyph", F.get(palette, (i % F.size(palette)).cast("int")))
        .when(mode == "gradient", F.zip_with(F.get(palette, F.lit(0)), F.get(palette, F.lit(1)), lambda a, b: (a + t * (b - a)).cast("bigint")))
        .otherwise(F.get(palette, F.lit(0)))
    )
