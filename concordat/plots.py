"""Small pictures with deterministic bytes; driver side, from collected summaries."""

from __future__ import annotations

import struct
import zlib
from html import escape


class Image:
    """An RGB raster."""

    def __init__(self, width: int, height: int, background=(255, 255, 255)):
        self.width, self.height = width, height
        self.rows = [bytearray(bytes(background) * width) for _ in range(height)]

    def fill(self, x: float, y: float, w: float, h: float, colour) -> None:
        a, b = max(0, round(x)), min(self.width, round(x + w))
        if b > a:
            for r in range(max(0, round(y)), min(self.height, round(y + h))):
                self.rows[r][3 * a : 3 * b] = bytes(colour) * (b - a)

    def png(self) -> bytes:
        def chunk(kind: bytes, data: bytes) -> bytes:
            return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

        head = struct.pack(">IIBBBBB", self.width, self.height, 8, 2, 0, 0, 0)
        raw = b"".join(b"\0" + bytes(r) for r in self.rows)
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 9)) + chunk(b"IEND", b"")


BAR, MATCH, CLERICAL = (70, 110, 160), (200, 60, 60), (230, 160, 40)


def histogram_png(bins: dict[int, int], lo: float, hi: float, match: float, clerical: float, n: int = 60, width: int = 600, height: int = 240) -> tuple[bytes, dict]:
    """A histogram with both thresholds, and the pixel columns of the thresholds."""
    im, top = Image(width, height), max(bins.values(), default=1)
    for b, c in bins.items():
        h = (height - 10) * c / top
        im.fill(b * width / n, height - h, width / n - 1, h, BAR)
    at = {}
    for name, x, colour in (("match", match, MATCH), ("clerical", clerical, CLERICAL)):
        at[name] = min(width - 1, max(0, int((x - lo) / (hi - lo) * width)))
        im.fill(at[name], 0, 1, height, colour)
    return im.png(), at


def alluvial_png(flows: list[tuple[str, str, int]], width: int = 600, height: int = 300) -> tuple[bytes, list[dict]]:
    """Source values at the left flow to target values at the right; also the geometry."""
    total = sum(n for *_, n in flows) or 1
    left, right = {}, {}
    for a, b, n in flows:
        left[a] = left.get(a, 0) + n
        right[b] = right.get(b, 0) + n
    scale = (height - 10) / total
    place = lambda sizes: {k: y for (k, _), y in zip(sorted(sizes.items()), _starts([sizes[k] * scale for k in sorted(sizes)]), strict=True)}
    y1, y2 = place(left), place(right)
    im, out = Image(width, height), []
    for i, (a, b, n) in enumerate(sorted(flows)):
        h = n * scale
        colour = (90 + 37 * i % 140, 90 + 71 * i % 140, 90 + 113 * i % 140)
        for x in range(40, width - 40):
            t = (x - 40) / (width - 80)
            s = t * t * (3 - 2 * t)
            im.fill(x, y1[a] + (y2[b] - y1[a]) * s, 1, h, colour)
        out.append({"from": a, "to": b, "n": n, "y_from": round(y1[a], 2), "y_to": round(y2[b], 2), "height": round(h, 2)})
        y1[a] += h
        y2[b] += h
    return im.png(), out


def _starts(heights: list[float]) -> list[float]:
    out, y = [], 5.0
    for h in heights:
        out.append(y)
        y += h
    return out


def evidence_svg(key: str, scores: list[tuple[str, float | None]]) -> str:
    """One bar per channel; a channel that could not tell has no bar but a word."""
    rows = []
    for i, (name, s) in enumerate(scores):
        y = 30 + 24 * i
        rows.append(f'<text x="8" y="{y + 12}">{escape(name)}</text>')
        rows.append(f'<text x="170" y="{y + 12}">not scored</text>' if s is None else f'<rect x="170" y="{y}" width="{200 * s:.2f}" height="16"/><text x="376" y="{y + 12}">{s:.4f}</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="440" height="{40 + 24 * len(scores)}" font-size="12"><text x="8" y="18">{escape(key)}</text>{"".join(rows)}</svg>\n'
