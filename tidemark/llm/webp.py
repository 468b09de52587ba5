"""Lossless WebP as a column: pixel arrays to files and back.

``decode`` reads any VP8L image: prefix codes (simple and normal), meta prefix codes, back-references,
the colour cache, and the predictor, cross-colour, subtract-green and palette transforms; and animated
files, whose frames follow each other. ``encode_image`` writes one image with any of these.

``encode_frames`` and ``decode_frames`` do many small images at once by array operations: the encoder
gives each channel a complete prefix code of at most ``MOST_BITS`` bits, and the decoder steps through
all images of that form side by side, a pixel a step. Where at least ``REPEATED`` of an image's runs of
three pixels have been there before, back-references pay: such an image is encoded with them and a colour
cache, without and with each of the transforms, the smallest of these streams is kept, and the general
decoder reads it.

A text is stored as samples: its UTF-8 bytes, filled up with bytes 255 to a positive multiple of 576,
are the red, green and blue of rows of 192 pixels; ``ROWS`` rows make a frame and longer texts take
more frames. Edge cases: a null text is empty, an empty one is a white row; null doc_ids stay null;
repeated rows and equal texts give equal rows; an empty table gives an empty result; other columns
are ignored. A damaged file raises ValueError.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, table

QUERY = "op1_webp_media"
UNIT, WIDTH, ROWS = 576, 192, 16
MOST_BITS = 10
#: The share of repeated runs from which an image is encoded by back-references and transforms.
REPEATED = 0.5
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)

# Fixed values of the format.
CODE_LENGTH_ORDER = [17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
CACHE_FACTOR = 0x1E35A7BD
LENGTH_CODES, DISTANCE_CODES = 24, 40

#: Offsets (x to the left, y up) of the short distance codes: nearest first, then smaller |x|, then the left.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))
REVERSED = np.array([int(f"{i:0{MOST_BITS}b}"[::-1], 2) for i in range(1 << MOST_BITS)])


class BitReader:
    def __init__(self, data: bytes):
        self.value, self.at, self.size = int.from_bytes(data, "little"), 0, 8 * len(data)
        self.chunk, self.base = 0, -(1 << 30)

    def peek(self, n: int) -> int:
        if not 0 <= self.at - self.base <= 2048 - n:
            self.base = self.at
            self.chunk = (self.value >> self.at) & ((1 << 2048) - 1)
        return (self.chunk >> (self.at - self.base)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        got = self.peek(n)
        self.at += n
        if self.at > self.size:
            raise ValueError("the image ends early")
        return got


class BitWriter:
    def __init__(self):
        self.parts: list[tuple[int, int]] = []

    def write(self, value: int, n: int) -> None:
        self.parts.append((value, n))

    def code(self, code: tuple[int, int]) -> None:
        self.parts.append(code)

    def value(self) -> tuple[int, int]:
        """All bits as one number, and how many; joined in pairs, so that the cost stays low."""
        parts = self.parts or [(0, 0)]
        while len(parts) > 1:
            parts = [(a[0] | b[0] << a[1], a[1] + b[1]) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1 :]
        return parts[0]

    def bytes(self) -> bytes:
        value, n = self.value()
        return value.to_bytes((n + 7) // 8, "little")


# ---- prefix codes


def canonical(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """symbol -> (code with its first bit lowest, length); a lone symbol takes no bits."""
    used = sorted((n, s) for s, n in enumerate(lengths) if n)
    if len(used) == 1:
        return {used[0][1]: (0, 0)}
    code, last, out = 0, 0, {}
    for n, s in used:
        code <<= n - last
        out[s] = (int(f"{code:0{n}b}"[::-1], 2), n)
        code, last = code + 1, n
    if used and code != 1 << last:
        raise ValueError("a prefix code is not complete")
    return out


class Decoder:
    """Reads one symbol of a prefix code by a table of its first 8 bits, then bit by bit."""

    def __init__(self, lengths: list[int]):
        codes = canonical(lengths)
        self.lone = next(iter(codes)) if len(codes) == 1 else None
        self.by_code = {(n, c): s for s, (c, n) in codes.items()}
        self.most = max((n for _, n in codes.values()), default=0)
        self.quick: list[tuple[int, int] | None] = [None] * 256
        for s, (c, n) in codes.items():
            if n <= 8:
                for high in range(1 << (8 - n)):
                    self.quick[c | high << n] = (s, n)

    def read(self, bits: BitReader) -> int:
        if self.lone is not None:
            return self.lone
        got = self.quick[bits.peek(8)]
        if got:
            bits.read(got[1])
            return got[0]
        for n in range(9, self.most + 1):
            s = self.by_code.get((n, bits.peek(n)))
            if s is not None:
                bits.read(n)
                return s
        raise ValueError("no such code")


def read_code(bits: BitReader, alphabet: int) -> Decoder:
    lengths = [0] * alphabet
    if bits.read(1):
        two = bits.read(1)
        lengths[bits.read(8 if bits.read(1) else 1)] = 1
        if two:
            lengths[bits.read(8)] = 1
        return Decoder(lengths)
    own = [0] * 19
    for i in range(4 + bits.read(4)):
        own[CODE_LENGTH_ORDER[i]] = bits.read(3)
    code = Decoder(own)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    at, before = 0, 8
    while at < alphabet and left:
        left -= 1
        s = code.read(bits)
        if s < 16:
            lengths[at] = s
            at += 1
            before = s or before
            continue
        value, n = (before, 3 + bits.read(2)) if s == 16 else (0, 3 + bits.read(3)) if s == 17 else (0, 11 + bits.read(7))
        if at + n > alphabet:
            raise ValueError("too many code lengths")
        lengths[at : at + n] = [value] * n
        at += n
    return Decoder(lengths)


def code_lengths(counts: dict[int, int], alphabet: int, most: int = 15) -> list[int]:
    """Huffman code lengths of at most ``most`` bits; at least one symbol has one."""
    import heapq

    floor = 0
    while True:
        heap = [(max(n, floor), s, (s,)) for s, n in counts.items()]
        lengths = [0] * alphabet
        if len(heap) < 2:
            lengths[heap[0][1] if heap else 0] = 1
            return lengths
        heapq.heapify(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                lengths[s] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if max(lengths) <= most:
            return lengths
        floor = 2 * floor + 1 + sum(counts.values()) // (1 << most)


def write_code(out: BitWriter, lengths: list[int]) -> dict[int, tuple[int, int]]:
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and max(used) < 256:
        out.write(1, 1)
        out.write(len(used) - 1, 1)
        out.write(used[0] > 1, 1)
        out.write(used[0], 8 if used[0] > 1 else 1)
        if len(used) == 2:
            out.write(used[1], 8)
        return canonical(lengths)
    steps, i = [], 0  # (symbol, extra bits, their number)
    while i < len(lengths):
        n = next((j for j in range(i, len(lengths)) if lengths[j] != lengths[i]), len(lengths)) - i
        if lengths[i] == 0 and n >= 3:
            n = min(n, 138)
            steps.append((18, n - 11, 7) if n >= 11 else (17, n - 3, 3))
        elif n >= 4:
            n = min(n, 7)
            steps += [(lengths[i], 0, 0), (16, n - 4, 2)]
        else:
            n = 1
            steps.append((lengths[i], 0, 0))
        i += n
    own = code_lengths({s: sum(x[0] == s for x in steps) for s in {x[0] for x in steps}}, 19, 7)
    count = max(4, 1 + max(CODE_LENGTH_ORDER.index(s) for s in range(19) if own[s]))
    out.write(0, 1)
    out.write(count - 4, 4)
    for s in CODE_LENGTH_ORDER[:count]:
        out.write(own[s], 3)
    out.write(0, 1)
    codes = canonical(own)
    for s, extra, n in steps:
        out.code(codes[s])
        out.write(extra, n)
    return canonical(lengths)


def split_value(value: int) -> tuple[int, int, int]:
    """A length or distance as (prefix symbol, extra bits, their number)."""
    value -= 1
    if value < 4:
        return value, 0, 0
    n = value.bit_length() - 2
    return 2 * n + 2 + (value >> n & 1), value & ((1 << n) - 1), n


def read_value(symbol: int, bits: BitReader) -> int:
    if symbol < 4:
        return symbol + 1
    n = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << n) + bits.read(n) + 1


def near_distance(code: int, width: int) -> int:
    if code > len(NEAR):
        return code - len(NEAR)
    x, y = NEAR[code - 1]
    return max(1, x + y * width)


# ---- images of 32-bit pixels (alpha, red, green, blue from the top)


def read_pixels(bits: BitReader, width: int, height: int, top: bool) -> np.ndarray:
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("the colour cache is too large")
    blocks, shift = None, 0
    if top and bits.read(1):
        shift = bits.read(3) + 2
        blocks = read_pixels(bits, -(-width >> shift), -(-height >> shift), False) >> 8 & 0xFFFF
    groups = [[read_code(bits, n) for n in (256 + LENGTH_CODES + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_CODES)] for _ in range(int(blocks.max()) + 1 if blocks is not None else 1)]
    cache = [0] * (1 << cache_bits)
    n, out, seen = width * height, [], 0
    green, red, blue, alpha, far = groups[0]
    while len(out) < n:
        if blocks is not None:
            y, x = divmod(len(out), width)
            green, red, blue, alpha, far = groups[blocks[y >> shift, x >> shift]]
        s = green.read(bits)
        if s < 256:
            out.append(s << 8 | red.read(bits) << 16 | blue.read(bits) | alpha.read(bits) << 24)
        elif s < 256 + LENGTH_CODES:
            length = read_value(s - 256, bits)
            back = near_distance(read_value(far.read(bits), bits), width)
            start = len(out) - back
            if start < 0 or len(out) + length > n:
                raise ValueError("a back-reference leaves the image")
            if back >= length:
                out += out[start : start + length]
            else:
                out += (out[start:] * (length // back + 1))[:length]
        else:
            for p in out[seen:]:
                cache[(CACHE_FACTOR * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
            seen = len(out)
            out.append(cache[s - 256 - LENGTH_CODES])
        if cache_bits and len(out) - seen > 4096:
            for p in out[seen:]:
                cache[(CACHE_FACTOR * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
            seen = len(out)
    return np.array(out, np.uint32).reshape(height, width)


def tokens(pixels: np.ndarray, cache_bits: int, lz: bool) -> Iterator[tuple[str, int, int]]:
    """("pixel", argb, 0), ("copy", length, distance) or ("cache", index, 0), greedily."""
    flat = pixels.ravel().tolist()
    last: dict[tuple, int] = {}
    cache = [0] * (1 << cache_bits)
    i = 0
    while i < len(flat):
        length = 0
        if lz and i + 3 <= len(flat):
            j = last.get(tuple(flat[i : i + 3]))
            if j is not None:
                while i + length < len(flat) and length < 4096 and flat[j + length] == flat[i + length]:
                    length += 1
        step = max(1, length)
        if length:
            yield "copy", length, i - j
        elif cache_bits and cache[k := (CACHE_FACTOR * flat[i] & 0xFFFFFFFF) >> (32 - cache_bits)] == flat[i]:
            yield "cache", k, 0
        else:
            yield "pixel", flat[i], 0
        for k in range(i, i + step):
            if lz:
                last[tuple(flat[k : k + 3])] = k
            if cache_bits:
                cache[(CACHE_FACTOR * flat[k] & 0xFFFFFFFF) >> (32 - cache_bits)] = flat[k]
        i += step


def write_pixels(out: BitWriter, pixels: np.ndarray, top: bool, cache_bits: int = 0, lz: bool = True, blocks: np.ndarray | None = None, shift: int = 0) -> None:
    """``blocks``: the number of the group of prefix codes for each square of 2**shift pixels."""
    height, width = pixels.shape
    out.write(bool(cache_bits), 1)
    if cache_bits:
        out.write(cache_bits, 4)
    if top:
        out.write(blocks is not None, 1)
        if blocks is not None:
            out.write(shift - 2, 3)
            write_pixels(out, blocks.astype(np.uint32) << 8, False)
    plane = {x + y * width: i + 1 for i, (x, y) in reversed([*enumerate(NEAR)]) if x + y * width >= 1}
    groups, at, found = (int(blocks.max()) + 1 if blocks is not None else 1), 0, []
    counts = [[{} for _ in range(5)] for _ in range(groups)]

    def note(group, which, symbol):
        counts[group][which][symbol] = counts[group][which].get(symbol, 0) + 1

    for kind, a, b in tokens(pixels, cache_bits, lz):
        y, x = divmod(at, width)
        g = int(blocks[y >> shift, x >> shift]) if blocks is not None else 0
        if kind == "pixel":
            got = [(0, a >> 8 & 255), (1, a >> 16 & 255), (2, a & 255), (3, a >> 24)]
        elif kind == "cache":
            got = [(0, 256 + LENGTH_CODES + a)]
        else:
            (s, extra, n), (d, more, m) = split_value(a), split_value(plane.get(b, b + len(NEAR)))
            got = [(0, 256 + s), (5, (extra, n)), (4, d), (5, (more, m))]
        for which, s in got:
            if which < 5:
                note(g, which, s)
        found.append((g, got))
        at += a if kind == "copy" else 1
    sizes = (256 + LENGTH_CODES + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_CODES)
    codes = [[write_code(out, code_lengths(c, n)) for c, n in zip(group, sizes)] for group in counts]
    for g, got in found:
        for which, s in got:
            out.code(s if which == 5 else codes[g][which][s])


# ---- transforms


def channels(p: np.ndarray) -> np.ndarray:
    """Bytes (..., 4) of pixels: blue, green, red, alpha."""
    return np.ascontiguousarray(p.astype("<u4")).view(np.uint8).reshape(*p.shape, 4)


def joined(c: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(c.astype(np.uint8)).view("<u4")[..., 0].astype(np.uint32)


def predicted(mode: int, l, t, tr, tl):
    """The prediction from the pixels to the left, above, above right and above left (int arrays of channels)."""
    half = lambda a, b: (a + b) // 2
    if mode == 11:
        near_left = np.abs(t - tl).sum(-1, keepdims=True) < np.abs(l - tl).sum(-1, keepdims=True)
        return np.where(near_left, l, t)
    if mode == 12:
        return np.clip(l + t - tl, 0, 255)
    if mode == 13:
        mean = half(l, t)
        diff = mean - tl
        return np.clip(mean + np.where(diff < 0, -(-diff // 2), diff // 2), 0, 255)
    if mode == 0 or mode > 13:
        return np.broadcast_to(np.array([0, 0, 0, 255]), l.shape)
    return {1: l, 2: t, 3: tr, 4: tl, 5: half(half(l, tr), t), 6: half(l, tl), 7: half(l, t), 8: half(tl, t), 9: half(t, tr), 10: half(half(l, tl), half(t, tr))}[mode]


def predict(pixels: np.ndarray, modes: np.ndarray, shift: int, invert: bool) -> np.ndarray:
    """Add (or, to encode, subtract) the prediction of each pixel; ``modes`` has one for each block."""
    height, width = pixels.shape
    given = channels(pixels).astype(np.int64)
    if not invert:
        return joined((given - predictions(given, modes, shift)) & 255)
    out = np.zeros_like(given)
    real = out  # what predictions are made of
    for y in range(height):
        for x in range(width):
            if not (x or y):
                p = np.array([0, 0, 0, 255])
            elif not y:
                p = real[0, x - 1]
            elif not x:
                p = real[y - 1, 0]
            else:
                right = real[y - 1, x + 1] if x + 1 < width else real[y, 0]
                p = predicted(int(modes[y >> shift, x >> shift]), real[y, x - 1], real[y - 1, x], right, real[y - 1, x - 1])
            out[y, x] = (given[y, x] + p) & 255
    return joined(out)


def predictions(real: np.ndarray, modes: np.ndarray, shift: int) -> np.ndarray:
    """The predictions of all pixels of a known image (height, width, 4)."""
    height, width = real.shape[:2]
    mode = modes[np.arange(height)[:, None] >> shift, np.arange(width)[None] >> shift]
    left, above = np.zeros_like(real), np.zeros_like(real)
    left[:, 1:], above[1:] = real[:, :-1], real[:-1]
    corner, right = np.zeros_like(real), np.zeros_like(real)
    corner[1:, 1:], right[1:, :-1] = real[:-1, :-1], real[:-1, 1:]
    right[:, -1] = real[:, 0]
    out = np.zeros_like(real)
    for m in np.unique(mode):
        at = mode == m
        out[at] = predicted(int(m), left[at], above[at], right[at], corner[at])
    out[0, 1:], out[1:, 0], out[0, 0] = real[0, :-1], real[:-1, 0], [0, 0, 0, 255]
    return out


def cross_colour(pixels: np.ndarray, blocks: np.ndarray, shift: int, invert: bool) -> np.ndarray:
    height, width = pixels.shape
    c = channels(pixels).astype(np.int64)
    m = channels(blocks).view(np.int8).astype(np.int64)[np.arange(height)[:, None] >> shift, np.arange(width)[None] >> shift]
    signed = lambda v: (v + 128 & 255) - 128
    g, sign = signed(c[..., 1]), 1 if invert else -1
    red = c[..., 2] + sign * (m[..., 0] * g >> 5)
    c[..., 0] = c[..., 0] + sign * ((m[..., 1] * g >> 5) + (m[..., 2] * signed(red if invert else c[..., 2]) >> 5))
    c[..., 2] = red
    return joined(c & 255)


def subtract_green(pixels: np.ndarray, invert: bool) -> np.ndarray:
    c = channels(pixels).astype(np.int64)
    c[..., [0, 2]] += c[..., 1:2] * (1 if invert else -1)
    return joined(c & 255)


def bundle_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def unbundle(pixels: np.ndarray, colours: np.ndarray, width: int) -> np.ndarray:
    bits = bundle_bits(len(colours))
    index = pixels >> 8 & 255
    if bits:
        each = 8 >> bits
        index = (index[..., None] >> (np.arange(1 << bits, dtype=np.uint32) * each) & ((1 << each) - 1)).reshape(len(pixels), -1)[:, :width]
    full = np.zeros(256, np.uint32)
    full[: len(colours)] = colours
    return full[index]


def bundle(pixels: np.ndarray, colours: np.ndarray) -> np.ndarray:
    """The palette's indices, some to a pixel."""
    order = np.argsort(colours, kind="stable")
    index = order[np.searchsorted(colours[order], pixels)].astype(np.uint32)
    bits = bundle_bits(len(colours))
    if bits:
        index = np.pad(index, ((0, 0), (0, -index.shape[1] % (1 << bits)))).reshape(len(pixels), -1, 1 << bits)
        index = np.bitwise_or.reduce(index << (np.arange(1 << bits, dtype=np.uint32) * (8 >> bits)), axis=2)
    return index << 8 | 0xFF000000


def encode_image(pixels: np.ndarray, transforms: list[tuple] = (), cache_bits: int = 0, lz: bool = True, blocks: np.ndarray | None = None, shift: int = 0) -> bytes:
    """A VP8L stream. Transforms, in order: (PREDICTOR, modes, shift), (CROSS_COLOUR, blocks, shift), (SUBTRACT_GREEN,), (PALETTE,)."""
    height, width = pixels.shape
    out = BitWriter()
    out.write(0x2F, 8)
    out.write(width - 1, 14)
    out.write(height - 1, 14)
    out.write(int((pixels >> 24 != 255).any()), 1)
    out.write(0, 3)
    for kind, *more in transforms:
        out.write(1, 1)
        out.write(kind, 2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            out.write(more[1] - 2, 3)
            write_pixels(out, more[0].astype(np.uint32) << 8 if kind == PREDICTOR else more[0], False)
            pixels = (predict if kind == PREDICTOR else cross_colour)(pixels, *more, invert=False)
        elif kind == SUBTRACT_GREEN:
            pixels = subtract_green(pixels, invert=False)
        else:
            colours = np.unique(pixels)
            out.write(len(colours) - 1, 8)
            steps = (channels(colours).astype(np.int64) - np.vstack([np.zeros((1, 4), np.int64), channels(colours)[:-1]])) & 255
            write_pixels(out, joined(steps)[None], False)
            pixels = bundle(pixels, colours)
    out.write(0, 1)
    write_pixels(out, pixels, True, cache_bits, lz, blocks, shift)
    return out.bytes()


def decode_image(data: bytes) -> np.ndarray:
    """Pixels (height, width) of a VP8L stream."""
    bits = BitReader(data)
    if bits.read(8) != 0x2F:
        raise ValueError("not a lossless image")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    if bits.read(4) >> 1:
        raise ValueError("unknown version")
    undo, full = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in [k for k, *_ in undo]:
            raise ValueError("a transform comes twice")
        if kind in (PREDICTOR, CROSS_COLOUR):
            shift = bits.read(3) + 2
            got = read_pixels(bits, -(-width >> shift), -(-height >> shift), False)
            undo.append((kind, got >> 8 & 255 if kind == PREDICTOR else got, shift))
        elif kind == SUBTRACT_GREEN:
            undo.append((kind,))
        else:
            steps = channels(read_pixels(bits, bits.read(8) + 1, 1, False)[0])
            colours = joined(np.cumsum(steps.astype(np.int64), axis=0) & 255)
            undo.append((kind, colours, width))
            width = -(-width >> bundle_bits(len(colours)))
    pixels = read_pixels(bits, width, height, True)
    for kind, *more in reversed(undo):
        if kind == PALETTE:
            pixels = unbundle(pixels, *more)
        elif kind == SUBTRACT_GREEN:
            pixels = subtract_green(pixels, invert=True)
        else:
            pixels = (predict if kind == PREDICTOR else cross_colour)(pixels, *more, invert=True)
    return pixels


# ---- the container


def chunk(name: bytes, data: bytes) -> bytes:
    return name + len(data).to_bytes(4, "little") + data + b"\0" * (len(data) % 2)


def container(frames: list[bytes], sizes: list[tuple[int, int]]) -> bytes:
    """A WebP file of VP8L streams with their (width, height); several are an animation."""
    if len(frames) == 1:
        body = chunk(b"VP8L", frames[0])
    else:
        three = lambda n: int(n).to_bytes(3, "little")
        body = chunk(b"VP8X", b"\2\0\0\0" + three(max(w for w, _ in sizes) - 1) + three(max(h for _, h in sizes) - 1)) + chunk(b"ANIM", bytes(6))
        for data, (w, h) in zip(frames, sizes):
            body += chunk(b"ANMF", three(0) + three(0) + three(w - 1) + three(h - 1) + three(100) + b"\2" + chunk(b"VP8L", data))
    return b"RIFF" + (len(body) + 4).to_bytes(4, "little") + b"WEBP" + body


def frames_of(media: bytes) -> list[bytes]:
    """The VP8L streams of a WebP file, in order."""
    if media[:4] != b"RIFF" or media[8:12] != b"WEBP":
        raise ValueError("not a WebP file")

    def walk(data: bytes) -> Iterator[bytes]:
        at = 0
        while at + 8 <= len(data):
            name, n = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
            inner = data[at + 8 : at + 8 + n]
            if len(inner) < n:
                raise ValueError("the file ends early")
            if name == b"VP8L":
                yield inner
            elif name == b"ANMF":
                yield from walk(inner[16:])
            at += 8 + n + n % 2

    return list(walk(media[12:]))


def decode(media: bytes) -> list[np.ndarray]:
    """The pixel arrays of a WebP file, a frame each."""
    return [decode_image(f) for f in frames_of(media)]


# ---- many small images at once

# After 40 bits of mark and size: no transform, no cache, no meta codes; then the three channels' codes,
# each with all sixteen lengths in four bits and the number of lengths that follow.
_HEAD = BitWriter()
_HEAD.write(0, 1)
_HEAD.write(15, 4)
for _s in CODE_LENGTH_ORDER:
    _HEAD.write(4 if _s < 16 else 0, 3)
_HEAD.write(1, 1)
_HEAD.write(3, 3)
CODE_HEAD, CODE_HEAD_BITS = _HEAD.value()  # then 8 bits: lengths less 2
_TAIL = BitWriter()
write_code(_TAIL, [0] * 255 + [1])
write_code(_TAIL, [1] + [0] * (DISTANCE_CODES - 1))
CODE_TAIL, CODE_TAIL_BITS = _TAIL.value()
# four-bit codes of the lengths 0 to 15, first bit lowest
NIBBLE = np.array([canonical([4] * 16)[i][0] for i in range(16)], np.uint8)


def complete_lengths(counts: np.ndarray) -> np.ndarray:
    """Lengths (rows, symbols) of complete prefix codes of at most MOST_BITS bits, near the optimum.

    Each row must have two symbols at least. Lengths follow the symbols' shares, with a floor that
    bounds them; what that leaves of the code space shortens codes until nothing is left.
    """
    used = counts > 0
    total = counts.sum(1, keepdims=True)
    share = np.where(used, counts + total / (1 << (MOST_BITS - 1)), 0)
    share /= share.sum(1, keepdims=True)
    bits = np.where(used, np.ceil(-np.log2(np.where(used, share, 1)) - 1e-9), 0).astype(np.int64)
    bits[used & (bits < 1)] = 1
    left = (1 << MOST_BITS) - np.where(used, 1 << (MOST_BITS - bits), 0).sum(1)
    while (open_ := np.flatnonzero(left)).size:
        b, rest = bits[open_], left[open_]
        for n in range(2, MOST_BITS + 1):
            own = b == n
            take = own & (np.cumsum(own, axis=1) <= (rest >> (MOST_BITS - n))[:, None])
            rest = rest - (take.sum(1) << (MOST_BITS - n))
            b = b - take
        bits[open_], left[open_] = b, rest
    return bits


def _canonical_rows(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols by code, codes of the symbols with the first bit lowest) for each row of lengths."""
    order = np.argsort(np.where(bits > 0, bits, 99), axis=1, kind="stable")
    n = np.take_along_axis(bits, order, 1)
    size = np.where(n > 0, 1 << (MOST_BITS - n), 0)
    start = np.cumsum(size, axis=1) - size
    codes = np.zeros_like(bits)
    np.put_along_axis(codes, order, np.where(n > 0, REVERSED[start & ((1 << MOST_BITS) - 1)], 0), 1)
    return order, codes


def repeated(rgb: np.ndarray, frame: np.ndarray, n: int) -> np.ndarray:
    """For each image how many of its runs of three pixels are not the first of their kind."""
    p = rgb.astype(np.uint64) @ np.array([1 << 16, 1 << 8, 1], np.uint64)
    run = p * np.uint64(0x9E3779B97F4A7C15)
    for k, factor in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        run[:-k] ^= p[k:] * np.uint64(factor)
    keys = np.sort(frame.astype(np.uint64) << np.uint64(40) | run >> np.uint64(24))
    same = np.flatnonzero(keys[1:] == keys[:-1])
    return np.bincount((keys[same] >> np.uint64(40)).astype(np.int64), minlength=n)


def encode_smallest(pixels: np.ndarray) -> bytes:
    """The smallest VP8L stream with back-references and a colour cache, without and with each transform."""
    c = channels(pixels).astype(np.int64)
    height, width = pixels.shape
    shift = 5
    grid = (-(-height >> shift), -(-width >> shift))
    spread = lambda a, b: int(np.clip(round(32 * ((a - a.mean()) * (b - b.mean())).mean() / max(1e-9, a.var())), -128, 127)) & 255
    mixed = np.full(grid, 0xFF000000 | spread(c[..., 1], c[..., 0]) << 8 | spread(c[..., 1], c[..., 2]), np.uint32)
    tried = [[], [(SUBTRACT_GREEN,)], [(CROSS_COLOUR, mixed, shift)], *[[(PREDICTOR, np.full(grid, mode), shift)] for mode in (1, 2, 11)]]
    if len(np.unique(pixels)) <= 256:
        tried.append([(PALETTE,)])
    return min([encode_image(pixels, lz=False), *(encode_image(pixels, t, cache_bits=4) for t in tried)], key=len)


def encode_frames(frames: list[np.ndarray]) -> list[bytes]:
    """VP8L streams of images given as samples (height, width, 3: red, green, blue)."""
    sizes = np.array([f.shape[0] * f.shape[1] for f in frames])
    rgb = np.concatenate([f.reshape(-1, 3) for f in frames])
    frame = np.repeat(np.arange(len(frames)), sizes)
    row = frame[:, None] * 3 + np.array([0, 1, 2])  # green, red, blue
    samples = rgb[:, [1, 0, 2]]
    counts = np.bincount((row * 256 + samples).ravel(), minlength=len(frames) * 768).reshape(-1, 256)
    again = repeated(rgb, frame, len(frames)) >= REPEATED * sizes
    lone = np.flatnonzero((counts > 0).sum(1) == 1)
    counts[lone, (counts[lone].argmax(1) + 1) % 256] = 1  # a second symbol, so that each code has bits
    bits = complete_lengths(counts)
    _, codes = _canonical_rows(bits)
    value = codes.ravel()[row * 256 + samples]
    length = bits.ravel()[row * 256 + samples]
    field = value[:, 0] | value[:, 1] << length[:, 0] | value[:, 2] << (length[:, 0] + length[:, 1])
    used = length.sum(1)
    tops = 256 - (counts.reshape(-1, 768).reshape(-1, 3, 256) > 0)[:, :, ::-1].argmax(2).min(1)
    head_bits = 40 + 3 + 3 * (CODE_HEAD_BITS + 8 + 4 * tops) + CODE_TAIL_BITS
    ends = np.cumsum(used)
    firsts = np.cumsum(sizes) - sizes
    data_bits = ends[firsts + sizes - 1] - (ends[firsts] - used[firsts])
    words = (head_bits + data_bits) // 32 + 2
    base = np.cumsum(words) - words
    at = (base * 32 + head_bits - (ends[firsts] - used[firsts]))[frame] + ends - used
    shifted = field.astype(np.uint64) << (at & 31).astype(np.uint64)
    n = int(words.sum()) + 1
    buffer = np.bincount(at >> 5, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n) + np.bincount((at >> 5) + 1, (shifted >> np.uint64(32)).astype(np.float64), n)
    buffer = buffer.astype(np.uint32)
    nibbles = NIBBLE[bits].reshape(len(frames), 3, 256)
    packed = (nibbles[..., ::2] | nibbles[..., 1::2] << 4).astype(np.uint8)
    out = []
    for k, f in enumerate(frames):
        if again[k]:
            out.append(encode_smallest(to_pixels(f)))
            continue
        top = int(tops[k])
        head, size = 0x2F | (f.shape[1] - 1) << 8 | (f.shape[0] - 1) << 22, 43
        for c in range(3):
            lengths = int.from_bytes(packed[k, c].tobytes(), "little") & ((1 << 4 * top) - 1)
            head |= (CODE_HEAD | (top - 2) << CODE_HEAD_BITS | lengths << (CODE_HEAD_BITS + 8)) << size
            size += CODE_HEAD_BITS + 8 + 4 * top
        head |= CODE_TAIL << size
        a, m = int(base[k]), -(-int(head_bits[k]) // 32)
        buffer[a : a + m] |= np.frombuffer(head.to_bytes(4 * m, "little"), "<u4")
        out.append(buffer[a : a + int(words[k])].tobytes()[: -(-int(head_bits[k] + data_bits[k]) // 8)])
    return out


def _parsed(data: bytes) -> tuple[int, int, int, np.ndarray] | None:
    """(width, height, first bit of the pixels, lengths (3, 256)) of an image that encode_frames wrote plainly."""
    head = int.from_bytes(data[:512], "little")
    if head & 0xFF != 0x2F or head >> 36 & 0x7F:
        return None
    at, lengths = 43, np.zeros((3, 256), np.int64)
    for c in range(3):
        if head >> at & ((1 << CODE_HEAD_BITS) - 1) != CODE_HEAD:
            return None
        top = (head >> (at + CODE_HEAD_BITS) & 255) + 2
        at += CODE_HEAD_BITS + 8
        raw = np.frombuffer((head >> at & ((1 << 4 * top) - 1)).to_bytes(129, "little"), np.uint8)
        own = _NIBBLE_BACK[np.stack([raw & 15, raw >> 4], 1).ravel()[:top]]
        if top > 256 or own.max() > MOST_BITS or (own > 0).sum() < 2 or (1 << MOST_BITS) != (1 << (MOST_BITS - own[own > 0])).sum():
            return None
        lengths[c, :top] = own
        at += 4 * top
    if head >> at & ((1 << CODE_TAIL_BITS) - 1) != CODE_TAIL or at + CODE_TAIL_BITS > 4096:
        return None
    return (head >> 8 & 0x3FFF) + 1, (head >> 22 & 0x3FFF) + 1, at + CODE_TAIL_BITS, lengths


_NIBBLE_BACK = np.argsort(NIBBLE)


def decode_frames(streams: list[bytes]) -> list[np.ndarray]:
    """Samples (height, width, 3) of VP8L streams; those of plain form are decoded side by side."""
    parsed = [_parsed(s) for s in streams]
    out: list = [to_samples(decode_image(s)) if p is None else None for s, p in zip(streams, parsed)]
    lanes = sorted((k for k, p in enumerate(parsed) if p), key=lambda k: -parsed[k][0] * parsed[k][1])
    if not lanes:
        return out
    bits = np.concatenate([parsed[k][3] for k in lanes])
    order, _ = _canonical_rows(bits)
    n = np.take_along_axis(bits, order, 1)
    entry = (order << 4 | n).ravel()
    tables = np.repeat(entry, np.where(n > 0, 1 << (MOST_BITS - n), 0).ravel()).reshape(len(bits), -1).astype(np.uint16)[:, REVERSED].ravel()
    pads = [streams[k] + b"\0" * (-len(streams[k]) % 4 + 8) for k in lanes]
    words = np.frombuffer(b"".join(pads), "<u4").astype(np.uint64)
    words = words | np.append(words[1:], np.uint64(0)) << np.uint64(32)
    sizes = np.array([parsed[k][0] * parsed[k][1] for k in lanes])
    starts = np.cumsum([0, *(8 * len(p) for p in pads)])
    at = starts[:-1] + np.array([parsed[k][2] for k in lanes])
    limit = starts[1:]
    active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    offset = np.cumsum(sizes) - sizes
    rgb = np.zeros((int(sizes.sum()), 3), np.uint8)
    base = np.arange(len(lanes)) * (3 << MOST_BITS)
    low, one = (1 << MOST_BITS) - 1, 1 << MOST_BITS
    for step in range(int(sizes[0])):
        m = int(active[step])
        here, b = at[:m], base[:m]
        window = (words[here >> 5] >> (here & 31).astype(np.uint64)).astype(np.int64)
        g = tables[b + (window & low)].astype(np.int64)
        used = g & 15
        r = tables[b + one + (window >> used & low)].astype(np.int64)
        used = used + (r & 15)
        s = tables[b + 2 * one + (window >> used & low)].astype(np.int64)
        to = offset[:m] + step
        rgb[to, 0], rgb[to, 1], rgb[to, 2] = r >> 4, g >> 4, s >> 4
        at[:m] += used + (s & 15)
    if (at > limit).any():
        raise ValueError("an image ends early")
    for j, k in enumerate(lanes):
        out[k] = rgb[offset[j] : offset[j] + sizes[j]].reshape(parsed[k][1], parsed[k][0], 3)
    return out


def to_pixels(samples: np.ndarray) -> np.ndarray:
    s = samples.astype(np.uint32)
    return 0xFF000000 | s[..., 0] << 16 | s[..., 1] << 8 | s[..., 2]


def to_samples(pixels: np.ndarray) -> np.ndarray:
    return channels(pixels)[..., [2, 1, 0]]


# ---- texts as media


def store(payloads: list[bytes]) -> list[bytes]:
    """WebP files of payloads whose lengths are multiples of UNIT."""
    frames, owner = [], []
    for i, p in enumerate(payloads):
        rows = np.frombuffer(p, np.uint8).reshape(-1, WIDTH, 3)
        for a in range(0, len(rows), ROWS):
            frames.append(rows[a : a + ROWS])
            owner.append(i)
    parts: list[list] = [[] for _ in payloads]
    for a in range(0, len(frames), 2048):
        for i, f, data in zip(owner[a : a + 2048], frames[a : a + 2048], encode_frames(frames[a : a + 2048])):
            parts[i].append((data, (f.shape[1], f.shape[0])))
    return [container([d for d, _ in p], [s for _, s in p]) for p in parts]


def load(media: list[bytes]) -> list[list[np.ndarray]]:
    """The frames' samples of each file."""
    streams = [frames_of(m) for m in media]
    flat = [s for own in streams for s in own]
    got = []
    for a in range(0, len(flat), 2048):
        got += decode_frames(flat[a : a + 2048])
    it = iter(got)
    return [[next(it) for _ in own] for own in streams]


def payload(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT), len(raw)


def feature(frames: list[np.ndarray]) -> str:
    """Frames, rows, mean of each channel, mean step to the right, and an 8-bit average hash of eight bands."""
    rows = frames[0] if len(frames) == 1 else np.concatenate(frames)
    sums = rows.sum((0, 1), dtype=np.int64)
    size = rows.shape[0] * rows.shape[1]
    wide = rows[..., 1].astype(np.int16)
    step = int(np.abs(np.diff(wide, axis=1)).sum(dtype=np.int64)) // (rows.shape[0] * (WIDTH - 1))
    bands = wide.sum(0, dtype=np.int64).reshape(8, -1).sum(1)
    mark = sum(int(b * 8 > bands.sum()) << i for i, b in enumerate(bands.tolist()))
    return f"{len(frames)}:{rows.shape[0]}:{','.join(str(int(s) // size) for s in sums)}:{step}:{mark:02x}"


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text's samples as a WebP file."""

    def batch(b):
        got = [payload(t) for t in b.column(1).to_pylist()]
        return {"doc_id": b.column(0), "n_bytes": [n for _, n in got], "media": store([p for p, _ in got])}

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), batch, "doc_id long, n_bytes long, media binary")


def describe(media: DataFrame) -> DataFrame:
    """What the files hold: (doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature)."""

    def batch(b):
        files = b.column(2).to_pylist()
        rows = []
        for file, frames in zip(files, load(files)):
            raw = b"".join(f.tobytes() for f in frames)
            rows.append((len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:]), len(file), hashlib.sha256(file).hexdigest(), feature(frames)))
        names = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
        return {"doc_id": b.column(0), "n_bytes": b.column(1)} | dict(zip(names, map(list, zip(*rows))))

    return map_rows(media, batch, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", text=2)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe(encode_texts(table(spark, sf_dir, "documents")))
