"""An HTML report from the rows of report_rows and a map of points: bars as SVG, no other file needed."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a chart and points of a map that a page shows; what is beyond is summed up, or thinned by hash.
MOST_BARS, MOST_POINTS = 30, 5000


def bars(title: str, values: list[tuple[str, int]], width: int = 420) -> str:
    """A chart of the largest values, the rest as one bar."""
    values = sorted(values, key=lambda x: (-x[1], x[0]))
    shown, rest = values[:MOST_BARS], values[MOST_BARS:]
    if rest:
        shown = [*shown, (f"{len(rest)} others", sum(n for _, n in rest))]
    top = max((n for _, n in shown), default=0) or 1
    rows = [
        f'<text x="0" y="{18 * i + 13}">{escape(name)}</text><rect x="160" y="{18 * i + 3}" width="{round(width * n / top)}" height="12"/><text x="{165 + round(width * n / top)}" y="{18 * i + 13}">{n:,}</text>'
        for i, (name, n) in enumerate(shown)
    ]
    return f'<h2>{escape(title)}</h2><svg width="{width + 260}" height="{18 * len(shown) + 6}">{"".join(rows)}</svg>'


def scatter(points: list[tuple[float, float, str]], size: int = 600) -> str:
    """Points of a map, with their hints as titles."""
    if not points:
        return ""
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    scale = lambda v, lo, hi: round(10 + (size - 20) * (v - lo) / ((hi - lo) or 1), 1)
    dots = [f'<circle cx="{scale(x, min(xs), max(xs))}" cy="{scale(y, min(ys), max(ys))}" r="2"><title>{escape(t)}</title></circle>' for x, y, t in points]
    return f'<h2>Map</h2><svg width="{size}" height="{size}">{"".join(dots)}</svg>'


def report(rows: DataFrame, points: DataFrame | None = None, title: str = "Corpus") -> str:
    """The page: a chart for each kind of (kind, key, n) rows, and a map of (x, y, hint) points, thinned by the hash of the
    hint where there are too many. Only counts and the shown points reach the driver."""
    kinds: dict[str, list[tuple[str, int]]] = {}
    for r in rows.groupBy("kind", "key").agg(F.sum("n").alias("n")).collect():
        kinds.setdefault(r["kind"], []).append(("none" if r["key"] is None else str(r["key"]), int(r["n"])))
    body = "".join(bars(kind, values) for kind, values in sorted(kinds.items()))
    if points is not None:
        some = points.where("x IS NOT NULL AND y IS NOT NULL").orderBy(F.xxhash64("hint", "x", "y")).limit(MOST_POINTS).collect()
        body += scatter([(float(r["x"]), float(r["y"]), r["hint"] or "") for r in some])
    return f"<!doctype html><html><head><meta charset=\"utf-8\"><title>{escape(title)}</title><style>body{{font:13px sans-serif}}rect,circle{{fill:#47a}}</style></head><body><h1>{escape(title)}</h1>{body}</body></html>"
