"""Blocks of bzip2 files, found and read from any place, and the lines that start in them.

A block begins, at any bit, with a mark of 48 bits, and is decompressed by itself; its checksum tells
a true mark from chance. Blocks are followed from end to beginning, so a damaged or missing block
is an error wherever a reader started, never a gap.

A line belongs to the block in which the line break before it ends, the first line to the first block.
So every line belongs to one block, whichever blocks are read together. Line feeds, carriage
returns and both in that order are line breaks.
"""

from __future__ import annotations

import bz2
from bisect import bisect_left
from collections.abc import Iterator

#: Fixed values of the format: the marks of a block and of a stream's end, a stream's header.
BLOCK, END, HEADER = 0x314159265359, 0x177245385090, b"BZh9"
MARK_BITS, FIRST_BIT = 48, 32
#: No compressed block is longer; how much is read at once.
LONGEST, STEP = 1_250_000, 2_000_000


def marks(data: bytes) -> list[tuple[int, int]]:
    """Bits at which a mark stands in data, with the mark, in order."""
    found = []
    for mark in (BLOCK, END):
        for shift in range(8):
            whole = (mark << (8 - shift)).to_bytes(7, "big")
            inner = whole[1:6]  # bytes that the mark fills whatever stands beside it
            at = data.find(inner)
            while at >= 0:
                near = data[at - 1 : at + 6] if at else b""
                if len(near) == 7 and int.from_bytes(near, "big") >> (8 - shift) & ((1 << MARK_BITS) - 1) == mark:
                    found.append((8 * (at - 1) + shift, mark))
                at = data.find(inner, at + 1)
    return sorted(found)


def decompressed(value: int, bits: int) -> bytes | None:
    """A block of so many bits, its mark included; None if it isn't one."""
    if bits < 80:
        return None
    checksum = value >> (bits - 80) & 0xFFFFFFFF
    whole = (int.from_bytes(HEADER, "big") << bits | value) << 80 | END << 32 | checksum
    pad = -(bits + 112) % 8
    try:
        return bz2.decompress((whole << pad).to_bytes((bits + 112 + pad) // 8, "big"))
    except (OSError, ValueError):
        return None


class Blocks:
    """The blocks of an open file; `taken` counts the bytes read of it."""

    def __init__(self, file, size: int, step: int = STEP):
        self.file, self.size, self.step, self.taken = file, size, step, 0
        self.base, self.data = 0, b""
        self.marks: list[tuple[int, int]] = []
        self.marked = 0  # marks that begin before this byte are known

    def _more(self) -> bool:
        """Reads on; False at the end of the file."""
        at = self.base + len(self.data)
        if at >= self.size:
            return False
        new = self.file.read_at(min(self.step, self.size - at), at)
        self.taken += len(new)
        self.data += new
        overlap = max(0, self.marked - self.base - 1)
        for bit, mark in marks(self.data[overlap:] if overlap else b"\0" + self.data):
            bit += 8 * (self.base + overlap) if overlap else 8 * (self.base - 1)
            if bit >= 8 * self.marked and (not self.marks or bit > self.marks[-1][0]):
                self.marks.append((bit, mark))
        self.marked = max(self.marked, self.base + len(self.data) - 6)
        return True

    def _start(self, byte: int) -> None:
        self.base, self.data, self.marks, self.marked = byte, b"", [], byte

    def _forget(self, bit: int) -> None:
        """Drops what lies before a bit."""
        if (keep := bit // 8 - self.base) > STEP:
            self.data, self.base = self.data[keep:], self.base + keep
            self.marks = self.marks[bisect_left(self.marks, (bit, 0)) :]

    def _bytes(self, at: int, n: int) -> bytes:
        while self.base + len(self.data) < min(at + n, self.size) and self._more():
            pass
        return self.data[at - self.base : at - self.base + n]

    def _marks_after(self, bit: int) -> Iterator[tuple[int, int]]:
        """Marks after a bit, as far as the longest block could reach."""
        k = bisect_left(self.marks, (bit + 1, 0))
        while True:
            while k < len(self.marks):
                yield self.marks[k]
                k += 1
            if self.marked * 8 - bit > 8 * LONGEST or not self._more():
                return

    def _block(self, bit: int) -> tuple[bytes, int] | None:
        """The data of the block that begins at a bit, and the bit at which it ends."""
        for end, _ in self._marks_after(bit):
            if end - bit > 8 * LONGEST:
                break
            raw = self._bytes(bit // 8, (end + 7) // 8 - bit // 8)
            value = int.from_bytes(raw, "big") >> (-end % 8) & ((1 << (end - bit)) - 1)
            if (data := decompressed(value, end - bit)) is not None:
                return data, end
        return None

    def _mark_at(self, bit: int) -> int:
        raw = self._bytes(bit // 8, 7)
        return int.from_bytes(raw.ljust(7, b"\0"), "big") >> (8 - bit % 8) & ((1 << MARK_BITS) - 1)

    def following(self, bit: int) -> Iterator[tuple[int, bytes]]:
        """Bit and data of the block at a bit, where there must be one (or a stream's end), and of all after it."""
        while True:
            mark = self._mark_at(bit)
            if mark == END:
                at = (bit + MARK_BITS + 32 + 7) // 8
                header = self._bytes(at, 4)
                if header[:3] != HEADER[:3]:  # the file's end, or what follows the last stream
                    return
                bit = 8 * at + FIRST_BIT
                continue
            found = self._block(bit) if mark == BLOCK else None
            if found is None:
                raise OSError(f"damaged or cut off: no bzip2 block at bit {bit} of {self.size} bytes")
            yield bit, found[0]
            bit = found[1]
            self._forget(bit)

    def is_first(self, bit: int) -> bool:
        """Whether the block at a bit is the file's first; empty streams may stand before it."""
        if bit <= FIRST_BIT or bit % 8:
            return bit == FIRST_BIT
        self._start(bit // 8 - 4)
        if self._bytes(bit // 8 - 4, 3) != HEADER[:3]:
            return False
        self._start(0)
        at = FIRST_BIT
        while at < bit and self._mark_at(at) == END:
            at += 8 * ((MARK_BITS + 32) // 8) + FIRST_BIT
        return at == bit

    def lines_at(self, bit: int, end_bit: int | None = None) -> Iterator[tuple[int, int, list[bytes]]]:
        """lines_of the block at a bit, and of those after it that begin before end_bit."""
        first = self.is_first(bit)
        self._start(bit // 8)
        return lines_of(self.following(bit), end_bit, first)

    def since(self, start: int, end: int) -> Iterator[tuple[int, bytes]]:
        """Blocks from the first that begins in bytes start..end on; nothing if none does."""
        self._start(start)
        if start == 0:
            if self.size and self._bytes(0, 3) != HEADER[:3]:
                raise OSError("no bzip2 file")
            return self.following(FIRST_BIT) if self.size else iter(())
        bit = 8 * start - 1
        while True:
            if not self.marks or self.marks[-1][0] <= bit:
                if self.marked >= end or not self._more():
                    return iter(())
                continue
            bit, mark = self.marks[bisect_left(self.marks, (bit + 1, 0))]
            if bit >= 8 * end:
                return iter(())
            if mark == BLOCK and self._block(bit) is not None:
                return self.following(bit)


def lines_of(blocks: Iterator[tuple[int, bytes]], end_bit: int | None, first: bool) -> Iterator[tuple[int, int, list[bytes]]]:
    """block, row, lines: neighbouring lines of a block, the first of which is its row-th. Of the blocks
    those before end_bit count (None: all), beyond it only a last line is finished; first says whether
    the file's first block is among them."""
    pieces: list[bytes] | None = [] if first else None  # the unfinished line; None: another block's
    owner, row, held, last, count = -1, 0, False, -1, 1
    for bit, data in blocks:
        past = end_bit is not None and bit >= end_bit
        if owner < 0:
            owner = bit
        if held and data[:1] != b"\n":  # a carriage return alone ended the line, in the block before
            if pieces is not None:
                yield owner, row, [b"".join(pieces)]
            if end_bit is not None and last >= end_bit:
                return
            pieces, owner, row, count = [], last, count, count + 1
        if past and pieces is None:
            return
        held = data.endswith(b"\r")
        parts = (data[:-1] if held else data).replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
        if len(parts) == 1:
            if pieces is not None:
                pieces.append(parts[0])
            if bit != owner:
                last, count = bit, 0
            else:
                last = bit
            continue
        if pieces is not None:
            before = 1 if owner == bit else 0
            yield owner, row, [b"".join([*pieces, parts[0]])]
        else:
            before = 0
        if past:
            return
        if len(parts) > 2:
            yield bit, before, parts[1:-1]
        pieces, owner, row, last = [parts[-1]], bit, before + len(parts) - 2, bit
        count = row + 1
    if pieces is not None and (held or any(pieces)):
        yield owner, row, [b"".join(pieces)]
