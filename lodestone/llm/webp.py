"""Lossless WebP (VP8L): a decoder for the whole bit stream, and an encoder for 8-bit samples.

The decoder reads prefix codes, meta prefix images, back-references and the colour cache, and inverts the predictor,
cross-colour, subtract-green and palette transforms. Runs of literal grey pixels, which is what the encoder writes, are
decoded a run at a time: numpy looks up the code at every bit position, and one pass follows every fourth code length.

The encoder writes grey images: samples in green with the subtract-green transform, prefix codes of limited length, and
back-references for what is there again from ``MATCH`` samples on. It takes the palette for at most 16 different samples,
and a predictor (left or above) where the residuals' entropy is lower by ``GAIN``. Grey pixels leave nothing to gain for
the colour cache and the cross-colour transform, so these are only read.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections import Counter
from functools import lru_cache

import numpy as np

# Fixed values of the format: order of the code length codes, and the near distances (x, y) of short distance codes.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3),
    (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3),
    (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5),
    (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7),
    (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7),
    (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6),
    (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
PREDICTOR, CROSS_COLOR, SUBTRACT_GREEN, PALETTE = range(4)
MAX_SIDE = 1 << 14
MATCH, GAIN = 24, 0.98
LONGEST = 12  # bits of a code that the encoder writes; the format allows 15
_GREEN_CODES = 256 + 24


# --- prefix codes ----------------------------------------------------------------------------------------------------


def code_lengths(counts: dict[int, int], limit: int) -> dict[int, int]:
    """Lengths of an optimal prefix code of at most ``limit`` bits; counts are flattened until it fits."""
    if len(counts) == 1:
        return dict.fromkeys(counts, 1)
    while True:
        heap = sorted([c << 16 | s for s, c in counts.items()])  # of equal counts the tree with the smallest symbol
        joined: list[tuple[int, int]] = []
        tree: dict[int, int] = {}  # place in joined of the tree with this smallest symbol; a leaf has none and stands as ~symbol
        while len(heap) > 1:
            a = heapq.heappop(heap)
            b = heap[0]
            x, y = a & 0xFFFF, b & 0xFFFF
            joined.append((tree.get(x, ~x), tree.get(y, ~y)))
            if x > y:
                x, y = y, x
            tree[x] = len(joined) - 1
            heapq.heapreplace(heap, a + b - y)
        lengths, depths = {}, [0] * len(joined)
        for k in range(len(joined) - 1, -1, -1):
            n = depths[k] + 1
            for part in joined[k]:
                if part < 0:
                    lengths[~part] = n
                else:
                    depths[part] = n
        if max(lengths.values()) <= limit:
            return lengths
        counts = {s: (c >> 1) + 1 for s, c in counts.items()}


def canonical(lengths: dict[int, int]) -> dict[int, int]:
    """The canonical code of each symbol, first bit highest."""
    code, last, out = 0, 0, {}
    for n, s in sorted((n, s) for s, n in lengths.items() if n):
        code <<= n - last
        out[s], last = code, n
        code += 1
    return out


def bit_strings(lengths: dict[int, int]) -> dict[int, str]:
    return {s: format(c, f"0{lengths[s]}b") for s, c in canonical(lengths).items()}


@lru_cache(maxsize=16)
def _reversed(bits: int) -> np.ndarray:
    """Each number of so many bits with its bits in reverse."""
    out = np.zeros(1, np.intp)
    for _ in range(bits):
        out = np.concatenate([2 * out, 2 * out + 1])
    return out


class Code:
    """A prefix code as a table: at each value of the next ``bits`` bits, the symbol times 16 and its length."""

    def __init__(self, lengths: dict[int, int]) -> None:
        self.only = next(iter(lengths), 0) if len(lengths) <= 1 else None
        self.bits = 0 if self.only is not None else max(lengths.values())
        if self.only is not None:
            self.table = np.array([self.only << 4], np.uint16)
            return
        ordered = np.array(sorted([n << 16 | s for s, n in lengths.items()]))
        n = ordered >> 16
        table = np.repeat(((ordered & 0xFFFF) << 4 | n).astype(np.uint16), 1 << (self.bits - n))  # in the order of the codes
        if len(table) != 1 << self.bits:
            raise ValueError("not a whole prefix code")
        self.table = table.take(_reversed(self.bits))


class Bits:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data + bytes(8), 0

    def read(self, n: int) -> int:
        at, self.at = self.at, self.at + n
        if self.at > 8 * len(self.data):
            raise ValueError("the bit stream ends early")
        return int.from_bytes(self.data[at >> 3 : (at + n + 7) >> 3], "little") >> (at & 7) & ((1 << n) - 1)

    def symbol(self, code: Code) -> int:
        if code.only is not None:
            return code.only
        at = self.at
        k = int.from_bytes(self.data[at >> 3 : (at >> 3) + 3], "little") >> (at & 7) & ((1 << code.bits) - 1)
        entry = int(code.table[k])
        self.at += entry & 15
        return entry >> 4


@lru_cache(maxsize=512)
def _lone(symbol: int) -> Code:
    return Code({symbol: 1})


def read_code(bits: Bits, alphabet: int) -> Code:
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        symbols = [bits.read(8 if wide else 1)] + ([bits.read(8)] if two else [])
        return Code(dict.fromkeys(symbols, 1)) if two else _lone(symbols[0])
    given = [bits.read(3) for _ in range(4 + bits.read(4))]
    code = Code({s: n for s, n in zip(CODE_LENGTH_ORDER, given, strict=False) if n})
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    table, mask = code.table.tolist(), (1 << code.bits) - 1
    lengths, last, k = {}, 8, 0
    ahead = room = 0
    while k < alphabet and left:
        left -= 1
        if room < 14:  # a code of 7 bits and its 7 more
            bits.at -= room
            ahead, room = int.from_bytes(bits.data[bits.at >> 3 : (bits.at >> 3) + 64], "little") >> (bits.at & 7), 512 - (bits.at & 7)
            bits.at += room
        entry = table[ahead & mask]
        s, n = entry >> 4, entry & 15
        ahead >>= n
        room -= n
        if s < 16:
            if s:
                lengths[k] = last = s
            k += 1
            continue
        n, least = ((2, 3), (3, 3), (7, 11))[s - 16]
        times = least + (ahead & ((1 << n) - 1))
        ahead >>= n
        room -= n
        if s == 16:
            lengths |= dict.fromkeys(range(k, k + times), last)
        k += times
    bits.at -= room
    bits.read(0)  # raises behind the end
    return Code(lengths)


# --- decoding --------------------------------------------------------------------------------------------------------


def _amount(bits: Bits, prefix: int) -> int:
    if prefix < 4:
        return prefix + 1
    extra = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << extra) + bits.read(extra) + 1


_RUN, _LONGEST_RUN = 4096, 1 << 18  # symbols looked for at once, at first and at most
_EIGHT = np.tile(np.arange(8, dtype=np.uint32), 1 << 13)


def _literal_run(bits: Bits, code: Code, most: int) -> np.ndarray:
    """The literals ahead, up to ``most`` and to the first symbol that isn't one; for codes of one symbol in red, blue, alpha."""
    room = (len(bits.data) << 3) - bits.at
    begin, most = bits.at >> 3, min(most, room)
    span = min(len(bits.data) - begin - 3, (most * code.bits + 7 >> 3) + 4)
    if span <= 0:
        raise ValueError("the bit stream ends early")
    ahead = np.repeat(np.ndarray((span,), "<u4", bits.data, begin, (1,)), 8)
    ahead >>= _EIGHT[: 8 * span] if 8 * span <= len(_EIGHT) else np.tile(_EIGHT[:8], span)
    ahead &= np.uint32((1 << code.bits) - 1)
    entry = code.table.take(ahead)
    # The bits from each place to the next symbol, to the second next and to the fourth next: one pass follows every fourth
    # symbol, and the places between are filled in. What lies behind the last place is never looked at.
    one = (entry & 15).astype(np.uint8)
    here = np.arange(len(one))
    two = one + one.take(here + one, mode="clip")
    four = (two + two.take(here + two, mode="clip")).tobytes()
    at, met = bits.at & 7, bytearray(len(four))
    try:
        while True:
            met[at] = 1
            at += four[at]
    except IndexError:  # behind the bits that were looked at
        pass
    places = np.append(np.frombuffer(met, bool).nonzero()[0], at)
    for step in (two, one):
        both = np.repeat(places, 2)
        both[1::2] += step.take(places, mode="clip")
        places = both
    inside = min(most, int(places.searchsorted(len(one))))
    places, at = places[:inside], int(places[inside])
    found = entry.take(places) >> 4
    stop = np.flatnonzero(found >= 256)
    if len(stop):
        found, at = found[: stop[0]], int(places[stop[0]])
    bits.at = (begin << 3) + at
    return found


def _entropy_image(bits: Bits, width: int, height: int, top: bool) -> np.ndarray:
    """Pixels as 32-bit ARGB of an entropy-coded image; ``top``: the main image, which may have meta prefix codes."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    cache = [0] * (1 << cache_bits) if cache_bits else []
    meta, side, groups = None, 0, 1
    if top and bits.read(1):
        side = bits.read(3) + 2
        across = -(-width >> side) if width & ((1 << side) - 1) == 0 else (width >> side) + 1
        meta = (_entropy_image(bits, across, (height + (1 << side) - 1) >> side, False) >> 8 & 0xFFFF).reshape(-1, across)
        groups = int(meta.max()) + 1
    codes = [[read_code(bits, n) for n in (_GREEN_CODES + len(cache), 256, 256, 256, 40)] for _ in range(groups)]
    out, n, total = np.zeros(width * height, np.uint32), 0, width * height
    most = _RUN

    def put(pixel: int) -> None:
        nonlocal n
        out[n] = pixel
        n += 1
        if cache:
            cache[(0x1E35A7BD * pixel & 0xFFFFFFFF) >> (32 - cache_bits)] = pixel

    while n < total:
        green, red, blue, alpha, dist = codes[int(meta[n // width >> side, n % width >> side]) if meta is not None else 0]
        grey = red.only is not None and blue.only is not None and alpha.only is not None
        if grey and meta is None and not cache and green.only is None:
            start = n
            while n < total:
                run = _literal_run(bits, green, min(most, total - n))
                out[n : n + len(run)] = (alpha.only << 24 | red.only << 16 | blue.only) | run.astype(np.uint32) << 8
                n += len(run)
                if len(run) < most:
                    break
                most = min(4 * most, _LONGEST_RUN)
            most = min(64 + 2 * (n - start), _LONGEST_RUN)  # the next run is looked for as far as this one went
            if n == total:
                break
        s = bits.symbol(green)
        if s < 256:
            r, b = bits.symbol(red), bits.symbol(blue)
            put(bits.symbol(alpha) << 24 | r << 16 | s << 8 | b)
        elif s < _GREEN_CODES:
            length = _amount(bits, s - 256)
            back = _amount(bits, bits.symbol(dist))
            if back > 120:
                back -= 120
            else:
                x, y = NEAR[back - 1]
                back = max(1, x + y * width)
            if back > n or n + length > total:
                raise ValueError("a back-reference leaves the image")
            if not cache:
                at = n - back
                while length:  # what it writes is read again
                    step = min(length, n - at)
                    out[n : n + step] = out[at : at + step]
                    n += step
                    length -= step
            else:
                for _ in range(length):
                    put(int(out[n - back]))
        else:
            put(cache[s - _GREEN_CODES])
    return out


def _planes(pixels: np.ndarray) -> np.ndarray:
    """Rows of alpha, red, green, blue."""
    return np.stack([pixels >> 24, pixels >> 16 & 255, pixels >> 8 & 255, pixels & 255], axis=-1).astype(np.int32)


def _packed(planes: np.ndarray) -> np.ndarray:
    p = planes.astype(np.uint32) & 255
    return p[..., 0] << 24 | p[..., 1] << 16 | p[..., 2] << 8 | p[..., 3]


def _predicted(mode: int, left: list, top: list, corner: list, right: list) -> list:
    """The prediction (four channels) of a mode from the neighbours left, above, above left and above right."""
    mean = lambda a, b: [(x + y) >> 1 for x, y in zip(a, b, strict=True)]
    clip = lambda x: 0 if x < 0 else 255 if x > 255 else x
    if mode in (0, 14, 15):
        return [255, 0, 0, 0]
    if mode <= 4:
        return (left, top, right, corner)[mode - 1]
    if mode == 5:
        return mean(mean(left, right), top)
    if mode <= 9:
        return mean(*((left, corner), (left, top), (corner, top), (top, right))[mode - 6])
    if mode == 10:
        return mean(mean(left, corner), mean(top, right))
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(top, corner, strict=True))
        to_top = sum(abs(a - c) for a, c in zip(left, corner, strict=True))
        return left if to_left < to_top else top
    if mode == 12:
        return [clip(a + t - c) for a, t, c in zip(left, top, corner, strict=True)]
    return [clip(m + int((m - c) / 2)) for m, c in zip(mean(left, top), corner, strict=True)]


def _add_prediction(pixels: np.ndarray, width: int, side: int, modes: np.ndarray) -> np.ndarray:
    across = (width + (1 << side) - 1) >> side
    mode_of = (modes >> 8 & 15).tolist()
    if set(mode_of) in ({1}, {2}):  # all from the left, or all from above: running sums
        planes = _planes(pixels).reshape(-1, width, 4)
        planes[0, 0, 0] += 255
        planes[0] = np.cumsum(planes[0], axis=0)
        if mode_of[0] == 1:
            planes[:, 0] = np.cumsum(planes[:, 0], axis=0)
            planes[1:] = np.cumsum(planes[1:], axis=1)
        else:
            planes = np.cumsum(planes, axis=0)
        return _packed(planes.reshape(-1, 4) & 255)
    rest = _planes(pixels).tolist()
    for k, p in enumerate(rest):
        y, x = divmod(k, width)
        if k == 0:
            guess = [255, 0, 0, 0]
        elif y == 0:
            guess = rest[k - 1]
        elif x == 0:
            guess = rest[k - width]
        else:
            guess = _predicted(mode_of[(y >> side) * across + (x >> side)], rest[k - 1], rest[k - width], rest[k - width - 1], rest[k - width + 1])
        rest[k] = [(a + b) & 255 for a, b in zip(p, guess, strict=True)]
    return _packed(np.array(rest, np.int64))


def _undo_cross_color(pixels: np.ndarray, width: int, side: int, elements: np.ndarray) -> np.ndarray:
    y, x = np.divmod(np.arange(len(pixels)), width)
    e = elements[(y >> side) * ((width + (1 << side) - 1) >> side) + (x >> side)]
    signed = lambda v: (v & 255).astype(np.uint8).astype(np.int8).astype(np.int32)
    p = _planes(pixels)
    green = signed(p[:, 2])
    p[:, 1] += signed(e) * green >> 5
    p[:, 3] += (signed(e >> 8) * green >> 5) + (signed(e >> 16) * signed(p[:, 1]) >> 5)
    return _packed(p)


def _undo_palette(pixels: np.ndarray, width: int, packed_width: int, colors: np.ndarray, packing: int) -> np.ndarray:
    index = (pixels >> 8 & 255).reshape(-1, packed_width)
    if packing:
        each = 8 >> packing
        shifts = np.arange(1 << packing, dtype=np.uint32) * each
        index = (index[:, :, None] >> shifts & ((1 << each) - 1)).reshape(len(index), -1)[:, :width]
    full = np.zeros(256, np.uint32)
    full[: len(colors)] = colors
    return full[index].ravel()


def decode_vp8l(data: bytes) -> np.ndarray:
    """A (height, width) array of 32-bit ARGB pixels."""
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise ValueError("not a lossless stream")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo, coded = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (PREDICTOR, CROSS_COLOR):
            side = bits.read(3) + 2
            span = 1 << side
            undo.append((kind, coded, side, _entropy_image(bits, (coded + span - 1) >> side, (height + span - 1) >> side, False)))
        elif kind == PALETTE:
            size = bits.read(8) + 1
            colors = _packed(np.cumsum(_planes(_entropy_image(bits, size, 1, False)), axis=0))
            packing = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
            narrow = (coded + (1 << packing) - 1) >> packing
            undo.append((kind, coded, narrow, colors, packing))
            coded = narrow
        else:
            undo.append((kind,))
    pixels = _entropy_image(bits, coded, height, True)
    for kind, *more in reversed(undo):
        if kind == SUBTRACT_GREEN:
            green = pixels >> 8 & 255
            pixels = pixels & np.uint32(0xFF00FF00) | ((pixels & np.uint32(0x00FF00FF)) + (green << 16 | green)) & np.uint32(0x00FF00FF)
        else:
            pixels = {PREDICTOR: _add_prediction, CROSS_COLOR: _undo_cross_color, PALETTE: _undo_palette}[kind](pixels, *more)
    return pixels.reshape(height, width)


def decode_file(data: bytes) -> list[np.ndarray]:
    """The images of one or more RIFF files, one behind the other."""
    out, at = [], 0
    while at < len(data):
        if data[at : at + 4] != b"RIFF" or data[at + 8 : at + 12] != b"WEBP":
            raise ValueError("not a WebP file")
        end, k = at + 8 + struct.unpack_from("<I", data, at + 4)[0], at + 12
        while k < end:
            n = struct.unpack_from("<I", data, k + 4)[0]
            if data[k : k + 4] == b"VP8L":
                out.append(decode_vp8l(data[k + 8 : k + 8 + n]))
            k += 8 + n + (n & 1)
        at = end
    return out


# --- encoding --------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=4096)
def low_first(value: int, n: int) -> str:
    """A number of n bits as the stream has it, lowest bit first."""
    return format(value, f"0{n}b")[::-1] if n else ""


@lru_cache(maxsize=512)
def _write_lone(symbol: int) -> str:
    return "1" + "0" + "1" + low_first(symbol, 8)


_ZEROS = re.compile(rb"\0{3,138}")


def write_code(lengths: dict[int, int], alphabet: int) -> str:
    """The bits of a prefix code's description."""
    if len(lengths) == 1 and max(lengths) < 256:
        return _write_lone(next(iter(lengths)))
    end = max(lengths) + 1
    row = bytearray(end)
    for symbol, n in lengths.items():
        row[symbol] = n
    items: list[int] = []  # a symbol, and from the sixth bit on what follows it
    at = 0
    for m in _ZEROS.finditer(row):
        n = m.end() - m.start()
        items += row[at : m.start()]
        items.append(17 | n - 3 << 5 if n < 11 else 18 | n - 11 << 5)
        at = m.end()
    items += row[at:]
    met = Counter(items)
    counts: dict[int, int] = {}
    for item, n in met.items():
        counts[item & 31] = counts.get(item & 31, 0) + n
    own = code_lengths(counts, 7)
    if len(own) == 1:  # a code of one symbol takes no bits to write, so give it a companion
        own = {s: 1 for s in {*own, (next(iter(own)) + 1) % 16}}
    strings = bit_strings(own)
    given = [own.get(s, 0) for s in CODE_LENGTH_ORDER]
    while len(given) > 4 and not given[-1]:
        given.pop()
    head = "0" + low_first(len(given) - 4, 4) + "".join(low_first(n, 3) for n in given)
    if end < alphabet:
        size = max(2, len(items)) - 2
        half = max(0, (max(2, size.bit_length()) - 1) // 2) if size.bit_length() > 2 else 0
        width = 2 + 2 * half
        head += "1" + low_first(half, 3) + low_first(size, width)
        if len(items) < 2:
            raise ValueError("too few symbols")
    else:
        head += "0"
    written = {item: strings[item & 31] + low_first(item >> 5, {17: 3, 18: 7}.get(item & 31, 0)) for item in met}
    return head + "".join([written[item] for item in items])


@lru_cache(maxsize=1024)
def _length_prefix(length: int) -> tuple[int, int, int]:
    """Prefix code of a back-reference's length, and the number that follows it with its bits."""
    if length <= 4:
        return length - 1, 0, 0
    n = (length - 1).bit_length() - 1
    high = (length - 1) >> (n - 1) & 1
    return 2 * n + high, (length - 1) & ((1 << (n - 1)) - 1), n - 1


def _numbers(lengths: dict[int, int], alphabet: int) -> tuple[np.ndarray, np.ndarray]:
    """The code of each symbol of an alphabet as a number, first bit lowest, and its bits; for codes of two symbols or more."""
    codes, widths = np.zeros(alphabet, np.uint64), np.zeros(alphabet, np.uint64)
    ordered = np.array(sorted([n << 16 | s for s, n in lengths.items()]))
    n, s = ordered >> 16, ordered & 0xFFFF
    spans = 1 << (LONGEST - n)
    codes[s], widths[s] = _reversed(LONGEST).take(spans.cumsum() - spans), n
    return codes, widths


def _folded(values: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and their bits, neighbours put together as long as each has 56 bits at most."""
    while len(values) > 1 and bits.max() <= 28:
        if len(values) & 1:
            values, bits = np.append(values, values[:1] * 0), np.append(bits, bits[:1] * 0)
        values, bits = values[0::2] | values[1::2] << bits[0::2], bits[0::2] + bits[1::2]
    return values, bits


def _written(head: str, values: np.ndarray, bits: np.ndarray) -> bytes:
    """The stream of the head and of numbers of at most 56 bits behind it."""
    ends = bits.cumsum() + np.uint64(len(head))
    starts = ends - bits
    word, shift, total = (starts >> np.uint64(6)).astype(np.intp), starts & np.uint64(63), int(ends[-1])
    edge = np.ones(len(word) + 1, bool)
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    edges = edge.nonzero()[0]
    first, last = edges[:-1], edges[1:] - 1  # of the numbers that begin in a word of 64 bits
    out = np.zeros((total >> 6) + 2, "<u8")
    out[word[first]] = np.bitwise_or.reduceat(values << shift, first)
    out[word[last] + 1] |= values[last] >> np.uint64(1) >> (np.uint64(63) - shift[last])  # what reaches into the next word
    front = np.frombuffer(int(head[::-1], 2).to_bytes((len(head) + 7) >> 3, "little"), np.uint8)
    stream = out.view(np.uint8)
    stream[: len(front)] |= front
    return stream[: (total + 7) >> 3].tobytes()


@lru_cache(maxsize=8)
def _near_codes(width: int) -> dict[int, int]:
    """Distance in pixels to the least short distance code."""
    out: dict[int, int] = {}
    for k, (x, y) in enumerate(NEAR, 1):
        out.setdefault(x + y * width, k)
    return out


def matches(samples: np.ndarray) -> list[tuple[int, int, int]]:
    """(place, length, distance) of back-references, ascending: greedily, to the nearest earlier place of MATCH samples."""
    n = len(samples) - MATCH + 1
    if n < 2:
        return []
    # Hashes of all runs of MATCH samples, from their three words of eight.
    data = samples.tobytes()
    words = np.ndarray((n + 16,), "<u8", data, 0, (1,)).copy()
    words ^= words >> np.uint64(29)
    h = words[:n] * np.uint64(0xD6E8FEB86659FD93) + words[8 : n + 8] * np.uint64(0x9E3779B97F4A7C15) + words[16:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h = np.sort((h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64))  # the hash's high bits above the place
    same = np.flatnonzero((h[1:] ^ h[:-1]) < np.uint64(1 << 24))
    if not len(same):
        return []
    places = (h & np.uint64(0xFFFFFF)).astype(np.int64)
    later, sooner = places[same + 1], places[same]
    order = np.argsort(later)
    out, free, total = [], 0, len(samples)
    for p, q in zip(later[order].tolist(), sooner[order].tolist(), strict=True):
        if p < free:
            continue
        if p - q > (1 << 20) - 120 or data[q : q + MATCH] != data[p : p + MATCH]:
            continue
        length, step = MATCH, 64
        while p + length < total and length < 4096:
            step = min(step, total - p - length, 4096 - length)
            if data[q + length : q + length + step] == data[p + length : p + length + step]:
                length, step = length + step, step * 2
            elif step == 1:
                break
            else:
                step = max(1, step // 4)
        out.append((p, length, p - q))
        free = p + length
    return out


def _entropy(samples: np.ndarray) -> float:
    counts = np.bincount(samples, minlength=256)
    share = counts[counts > 0] / len(samples)
    return float(-(share * np.log2(share)).sum())


def _residuals(rows: np.ndarray, mode: int) -> np.ndarray:
    """Samples less their prediction from the left (1) or from above (2), along the borders as the format has it."""
    out = rows.copy()
    out[0, 1:] -= rows[0, :-1]
    out[1:, 0] -= rows[:-1, 0]
    out[1:, 1:] -= rows[1:, :-1] if mode == 1 else rows[:-1, 1:]
    return out


def _flat_image(values: list[int]) -> str:
    """An entropy-coded image of few pixels: alpha 255, red and blue 0, green as given; literals of a fixed length."""
    counts = dict.fromkeys(values, 1)
    lengths = code_lengths(counts, LONGEST)
    strings = bit_strings(lengths) if len(counts) > 1 else {values[0]: ""}
    return "0" + write_code(lengths, _GREEN_CODES) + "".join(write_code({s: 1}, 256) for s in (0, 0, 255)) + write_code({0: 1}, 40) + "".join(strings[v] for v in values)


def _palette_image(colors: np.ndarray) -> str:
    """The palette's greys, each less the one before; alpha is 255 and then 0."""
    steps = np.diff(colors, prepend=0).astype(np.uint8).tolist()
    counts: dict[int, int] = {}
    for v in steps:
        counts[v] = counts.get(v, 0) + 1
    lengths = code_lengths(counts, LONGEST)
    strings = bit_strings(lengths) if len(counts) > 1 else {steps[0]: ""}
    alpha = {255: 1} if len(steps) == 1 else {0: 1, 255: 1}
    signs = bit_strings(alpha) if len(steps) > 1 else {255: ""}
    head = "0" + write_code(lengths, _GREEN_CODES) + write_code(lengths, 256) + write_code(lengths, 256)
    head += write_code(alpha, 256) if len(steps) == 1 else "1" + "1" + "1" + low_first(0, 8) + low_first(255, 8)
    return head + write_code({0: 1}, 40) + "".join(strings[v] * 3 + signs[255 if k == 0 else 0] for k, v in enumerate(steps))


def encode_grey(samples: bytes, width: int) -> bytes:
    """A RIFF file of a grey image of whole rows; equal samples give equal bytes."""
    height, odd = divmod(len(samples), width)
    if odd or not 0 < height <= MAX_SIDE or width > MAX_SIDE:
        raise ValueError("samples don't fill an image")
    head = low_first(0x2F, 8) + low_first(width - 1, 14) + low_first(height - 1, 14) + "0" + "000"
    plain = np.frombuffer(samples, np.uint8)
    colors = np.flatnonzero(np.bincount(plain, minlength=256))
    across, alpha = width, 255
    if len(colors) <= 16:
        packing = 3 if len(colors) <= 2 else 2 if len(colors) <= 4 else 1
        each = 8 >> packing
        across = (width + (1 << packing) - 1) >> packing
        index = np.zeros((height, across << packing), np.uint8)
        index[:, :width] = np.searchsorted(colors, plain).reshape(height, width)
        plain = (index.reshape(height, across, -1) << (np.arange(1 << packing, dtype=np.uint8) * each)).sum(axis=2, dtype=np.uint8).ravel()
        head += "1" + low_first(PALETTE, 2) + low_first(len(colors) - 1, 8) + _palette_image(colors)
    else:
        rows = plain.reshape(height, width)
        # Text's neighbours are seldom near each other: only where a third are is a predictor worth its measuring.
        steps = (plain[1:] - plain[:-1], plain[width:] - plain[:-width])
        likely = [mode for mode, step in enumerate(steps, 1) if 3 * np.count_nonzero(step + np.uint8(3) <= 6) > len(step)]
        choices = [(_entropy(plain) * GAIN, 0)] + [(_entropy(_residuals(rows, mode).ravel()), mode) for mode in likely] if likely else [(0.0, 0)]
        mode = min(choices)[1]
        if mode:
            side = 9  # one mode for blocks of 512 pixels
            cells = ((width + 511) >> side) * ((height + 511) >> side)
            head += "1" + low_first(PREDICTOR, 2) + low_first(side - 2, 3) + _flat_image([mode] * cells)
            plain, alpha = _residuals(rows, mode).ravel(), 0
        head += "1" + low_first(SUBTRACT_GREEN, 2)
    found = matches(plain)
    places = np.array([p for p, _, _ in found], np.int64)
    literal = np.ones(len(plain), bool)
    for p, length, _ in found:
        literal[p : p + length] = False
    near = _near_codes(across)
    ahead = [(*_length_prefix(length), *_length_prefix(near.get(d, d + 120))) for _, length, d in found]
    counts = np.bincount(plain[literal], minlength=_GREEN_CODES)
    far: dict[int, int] = {}
    for a, _, _, b, _, _ in ahead:
        counts[256 + a] += 1
        far[b] = far.get(b, 0) + 1
    there = counts.nonzero()[0]
    green = dict(zip(there.tolist(), counts[there].tolist(), strict=True))
    if len(green) == 1:
        green[(min(green) + 1) & 255] = 1  # keep the code's bits: a code of one symbol has none
    lengths, distances = code_lengths(green, LONGEST), code_lengths(far or {0: 1}, LONGEST)
    if len(distances) == 1:
        written, back = _write_lone(next(iter(distances))), (np.zeros(40, np.uint64),) * 2  # takes no bits
    else:
        written, back = write_code(distances, 40), _numbers(distances, 40)
    head += "0" + "0" + "0"  # no more transforms; no colour cache, no meta codes
    head += write_code(lengths, _GREEN_CODES) + "".join(_write_lone(s) for s in (0, 0, alpha)) + written
    codes, widths = _numbers(lengths, _GREEN_CODES)
    # A back-reference, of MATCH samples at least, puts its two codes and what follows each in the place of its first two samples.
    slots = (places[:, None] + np.arange(2)).ravel()
    a, x, n, b, y, m = np.array(ahead, np.uint64).reshape(-1, 6).T
    a, b, far_codes, far_widths = a.astype(np.intp) + 256, b.astype(np.intp), *back
    given = np.stack([codes[a] | x << widths[a], far_codes[b] | y << far_widths[b]], axis=1).ravel()
    sizes = np.stack([widths[a] + n, far_widths[b] + m], axis=1).ravel()
    parts = []
    for k in range(0, len(plain), 1 << 16):
        part = plain[k : k + (1 << 16)]
        values, bits = codes.take(part), widths.take(part)
        if found:
            values *= literal[k : k + len(part)]
            bits *= literal[k : k + len(part)]
            here = slice(*slots.searchsorted((k, k + len(part))))
            values[slots[here] - k], bits[slots[here] - k] = given[here], sizes[here]
        parts.append(_folded(values, bits))
    stream = _written(head, *(np.concatenate(x) for x in zip(*parts, strict=True)))
    size = len(stream)
    chunk = b"VP8L" + struct.pack("<I", size) + stream + b"\0" * (size & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk
