"""Page images as arrays of 8-bit grey, with numpy. Pixels aren't promised to equal any other library's."""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np


def grey(data: bytes, height: int, width: int, channels: int = 1) -> np.ndarray:
    """The image source's bytes as a grey page (colours are averaged)."""
    page = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return page[..., 0].copy() if channels == 1 else page[..., :3].mean(axis=2).round().astype(np.uint8)


def read_tiff(data: bytes) -> np.ndarray:
    """An uncompressed grey or 1-bit TIFF of one channel. Raises ValueError on anything else."""
    if len(data) < 8 or data[:2] not in (b"II", b"MM"):
        raise ValueError("not a TIFF")
    e = "<" if data[:2] == b"II" else ">"
    if struct.unpack(e + "H", data[2:4])[0] != 42:
        raise ValueError("not a TIFF")
    (at,) = struct.unpack(e + "I", data[4:8])
    tags: dict[int, list[int]] = {}
    try:
        (n,) = struct.unpack(e + "H", data[at : at + 2])
        for k in range(n):
            tag, kind, count, value = struct.unpack(e + "HHI4s", data[at + 2 + 12 * k : at + 14 + 12 * k])
            code, size = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4)}.get(kind, (None, 0))
            if code:
                raw = value if size * count <= 4 else data[(p := struct.unpack(e + "I", value)[0]) : p + size * count]
                tags[tag] = list(struct.unpack(f"{e}{count}{code}", raw[: size * count]))
        width, height, bits = tags[256][0], tags[257][0], tags.get(258, [1])[0]
        if tags.get(259, [1])[0] != 1 or tags.get(277, [1])[0] != 1 or bits not in (1, 8):
            raise ValueError("only uncompressed pages of one channel are read")
        raw = b"".join(data[o : o + c] for o, c in zip(tags[273], tags[279]))
    except (struct.error, KeyError, IndexError) as x:
        raise ValueError("broken TIFF") from x
    if bits == 8:
        page = np.frombuffer(raw, np.uint8, height * width).reshape(height, width)
    else:
        page = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(height, -1), axis=1)[:, :width] * np.uint8(255)
    return 255 - page if tags.get(262, [1])[0] == 0 else page.copy()


def write_png(page: np.ndarray) -> bytes:
    """A grey page as PNG."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = np.hstack([np.zeros((page.shape[0], 1), np.uint8), page.astype(np.uint8)]).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", page.shape[1], page.shape[0], 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def write_tiff(page: np.ndarray) -> bytes:
    """A grey page as an uncompressed TIFF of one strip."""
    h, w = page.shape
    tags = [(256, 4, w), (257, 4, h), (258, 3, 8), (259, 3, 1), (262, 3, 1), (273, 4, 8), (277, 3, 1), (278, 4, h), (279, 4, w * h)]
    body = page.astype(np.uint8).tobytes()
    at = 8 + len(body) + len(body) % 2
    entries = b"".join(struct.pack("<HHI", tag, kind, 1) + struct.pack("<I" if kind == 4 else "<HH", *((value,) if kind == 4 else (value, 0))) for tag, kind, value in tags)
    return b"II*\0" + struct.pack("<I", at) + body + b"\0" * (len(body) % 2) + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0)


def read_png(data: bytes) -> np.ndarray:
    """A grey 8-bit PNG without interlace. Raises ValueError on anything else."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, body = 8, b""
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            width, height, *form = struct.unpack(">IIBBBBB", part)
            if form != [8, 0, 0, 0, 0]:
                raise ValueError("only grey pages of 8 bits are read")
        body += part if kind == b"IDAT" else b""
        at += n + 12
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, width + 1)
    out = np.zeros((height + 1, width), np.uint8)
    for y, (how, *_) in enumerate(rows[:, :1]):
        line, up = rows[y, 1:], out[y]
        if how == 2:
            line = line + up
        elif how == 1:
            line = np.cumsum(line, dtype=np.uint8)
        elif how:
            now = np.zeros(width, np.uint8)
            for x in range(width):
                left, above, corner = (int(now[x - 1]) if x else 0), int(up[x]), (int(up[x - 1]) if x else 0)
                guess = (left + above) // 2 if how == 3 else min((left, above, corner), key=lambda v: abs(left + above - corner - v))
                now[x] = (int(line[x]) + guess) & 255
            line = now
        out[y + 1] = line
    return out[1:]


def otsu(page: np.ndarray) -> int:
    """The threshold that separates dark and light best; pixels above it are light."""
    n = np.bincount(page.reshape(-1), minlength=256).astype(float)
    below = np.cumsum(n)
    mass = np.cumsum(n * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return int(np.nan_to_num(between).argmax())


def binarized(page: np.ndarray) -> np.ndarray:
    return np.where(page > otsu(page), np.uint8(255), np.uint8(0))


def dark_on_light(page: np.ndarray) -> np.ndarray:
    """Inverted if the page is darker than middle grey on average."""
    return 255 - page if page.size and page.mean() < 127 else page


def resized(page: np.ndarray, width: int, height: int) -> np.ndarray:
    """Scaled down by averaging areas."""

    def shrink(a: np.ndarray, n: int) -> np.ndarray:
        edge = np.linspace(0, a.shape[0], n + 1)
        total = np.vstack([np.zeros((1, a.shape[1])), np.cumsum(a, axis=0)])
        low = np.floor(edge).astype(int)
        part = total[low] + (edge - low)[:, None] * (total[np.minimum(low + 1, a.shape[0])] - total[low])
        return np.diff(part, axis=0) / np.diff(edge)[:, None]

    return np.clip(np.rint(shrink(shrink(page.astype(float), height).T, width).T), 0, 255).astype(np.uint8)


def padded(page: np.ndarray, canvas: int = 2048) -> np.ndarray:
    """Fitted on a white square, scaled down only and centred (the numbers of ``text.letterbox``). Raises ValueError on an empty page."""
    h, w = page.shape[:2]
    if not h or not w:
        raise ValueError("empty page")
    scale = min(1.0, canvas / max(h, w))
    nw, nh = max(1, round(w * scale)), max(1, round(h * scale))
    out = np.full((canvas, canvas), 255, np.uint8)
    x, y = (canvas - nw) // 2, (canvas - nh) // 2
    out[y : y + nh, x : x + nw] = page if scale == 1 else resized(page, nw, nh)
    return out


def _shifted(a: np.ndarray, dy: int, dx: int) -> np.ndarray:
    p = np.pad(a, 1, mode="edge")
    return p[1 + dy : p.shape[0] - 1 + dy, 1 + dx : p.shape[1] - 1 + dx]


def edges(page: np.ndarray, low: float = 60, high: float = 180) -> np.ndarray:
    """Canny edges: Sobel gradients, thinning across the edge, hysteresis."""
    a = page.astype(float)
    s = {(y, x): _shifted(a, y, x) for y in (-1, 0, 1) for x in (-1, 0, 1)}
    gx = s[-1, 1] + 2 * s[0, 1] + s[1, 1] - s[-1, -1] - 2 * s[0, -1] - s[1, -1]
    gy = s[1, -1] + 2 * s[1, 0] + s[1, 1] - s[-1, -1] - 2 * s[-1, 0] - s[-1, 1]
    size = np.abs(gx) + np.abs(gy)
    sector = np.rint(np.arctan2(gy, gx) / (math.pi / 4)).astype(int) % 4
    thin = np.zeros(page.shape, bool)
    for k, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        thin |= (sector == k) & (size >= _shifted(size, dy, dx)) & (size > _shifted(size, -dy, -dx))
    weak, out = thin & (size > low), thin & (size > high)
    while True:
        grown = out.copy()
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                grown |= _shifted(out, dy, dx)
        grown &= weak
        if (grown == out).all():
            return out * np.uint8(255)
        out = grown


def deskewed(page: np.ndarray, most: float = 10.0) -> np.ndarray:
    """Turned so that its rows of ink stand out most, by at most ``most`` degrees; new corners are white."""
    ink = np.argwhere(page < 128)
    if len(ink) < 10:
        return page
    y, x = (ink - ink.mean(axis=0)).T

    def sharpness(degrees: float) -> float:
        r = math.radians(degrees)
        n = np.bincount((y * math.cos(r) - x * math.sin(r) - (y * math.cos(r) - x * math.sin(r)).min()).astype(int))
        return float((n.astype(float) ** 2).sum())

    best = max((sharpness(d), -abs(d), d) for d in np.arange(-most, most + 0.25, 0.5))[2]
    if not best:
        return page
    r, (h, w) = math.radians(best), page.shape
    yy, xx = np.mgrid[:h, :w]
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sy = np.rint(cy + (yy - cy) * math.cos(r) + (xx - cx) * math.sin(r)).astype(int)
    sx = np.rint(cx - (yy - cy) * math.sin(r) + (xx - cx) * math.cos(r)).astype(int)
    inside = (sy >= 0) & (sy < h) & (sx >= 0) & (sx < w)
    return np.where(inside, page[np.clip(sy, 0, h - 1), np.clip(sx, 0, w - 1)], np.uint8(255))


def grown_box(page: np.ndarray, box: tuple[int, int, int, int], share: float = 0.005, step: int = 512, rounds: int = 6, margin: int = 12) -> tuple[int, int, int, int]:
    """A box (x1, y1, x2, y2) grown while its border carries ink, then by a margin, within the page."""
    h, w = page.shape
    x1, y1, x2, y2 = max(0, box[0]), max(0, box[1]), min(w, box[2]), min(h, box[3])
    for _ in range(rounds):
        ink = lambda part: part.size and (part < 250).mean() > share
        new = (
            max(0, x1 - step) if ink(page[y1:y2, x1 : x1 + 1]) else x1, max(0, y1 - step) if ink(page[y1 : y1 + 1, x1:x2]) else y1,
            min(w, x2 + step) if ink(page[y1:y2, x2 - 1 : x2]) else x2, min(h, y2 + step) if ink(page[y2 - 1 : y2, x1:x2]) else y2,
        )
        if new == (x1, y1, x2, y2):
            break
        x1, y1, x2, y2 = new
    return max(0, x1 - margin), max(0, y1 - margin), min(w, x2 + margin), min(h, y2 + margin)
