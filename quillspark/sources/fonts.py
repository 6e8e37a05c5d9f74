"""Advance widths and heights of TrueType fonts, read from their tables."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Metrics:
    units: int
    ascent: int
    descent: int
    advances: dict[int, int]  # by code point

    def width(self, ch: str, size: int) -> int:
        """Pixels; characters that the font lacks are three fifths of its size wide."""
        a = self.advances.get(ord(ch))
        return int(size * 0.6) if a is None else round(a * size / self.units)


def read_metrics(data: bytes) -> Metrics:
    n = struct.unpack(">H", data[4:6])[0]
    at = {data[12 + 16 * k : 16 + 16 * k].decode("latin_1"): struct.unpack(">II", data[20 + 16 * k : 28 + 16 * k]) for k in range(n)}
    if not {"head", "hhea", "hmtx", "cmap"} <= set(at):
        raise ValueError("not a TrueType font")
    units = struct.unpack(">H", data[at["head"][0] + 18 : at["head"][0] + 20])[0]
    ascent, descent = struct.unpack(">hh", data[at["hhea"][0] + 4 : at["hhea"][0] + 8])
    long = struct.unpack(">H", data[at["hhea"][0] + 34 : at["hhea"][0] + 36])[0]
    o = at["hmtx"][0]
    advance = [struct.unpack(">H", data[o + 4 * k : o + 4 * k + 2])[0] for k in range(long)]
    base = at["cmap"][0]
    tables = [struct.unpack(">HHI", data[base + 4 + 8 * k : base + 12 + 8 * k]) for k in range(struct.unpack(">H", data[base + 2 : base + 4])[0])]
    glyphs: dict[int, int] = {}
    for _, _, off in tables:
        o = base + off
        if struct.unpack(">H", data[o : o + 2])[0] == 4:
            segments = struct.unpack(">H", data[o + 6 : o + 8])[0] // 2
            row = lambda k, kind="H", o=o, segments=segments: struct.unpack(f">{segments}{kind}", data[o + k : o + k + 2 * segments])
            ends, starts = row(14), row(16 + 2 * segments)
            deltas, ranges = row(16 + 4 * segments, "h"), row(16 + 6 * segments)
            for s, (a, z, d, r) in enumerate(zip(starts, ends, deltas, ranges, strict=True)):
                for c in range(a, min(z, 0xFFFE) + 1):
                    if r:
                        p = o + 16 + 6 * segments + 2 * s + r + 2 * (c - a)
                        g = struct.unpack(">H", data[p : p + 2])[0]
                        g = (g + d) & 0xFFFF if g else 0
                    else:
                        g = (c + d) & 0xFFFF
                    if g:
                        glyphs[c] = g
    return Metrics(units, ascent, -descent, {c: advance[min(g, long - 1)] for c, g in glyphs.items()})


def glyph_metrics(spark: SparkSession, fonts: DataFrame, col: str = "font_path") -> DataFrame:
    """``font_path, char, advance_per_1000`` of every font file that can be read where the executors are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["font_path"]:
                try:
                    with open(path, "rb") as f:
                        m = read_metrics(f.read())
                except (OSError, ValueError, struct.error):
                    continue
                yield pd.DataFrame({"font_path": path, "char": [chr(c) for c in m.advances], "advance_per_1000": [round(1000 * a / m.units) for a in m.advances.values()]})

    return fonts.select(F.col(col).alias("font_path")).distinct().mapInPandas(run, "font_path string, char string, advance_per_1000 long")
