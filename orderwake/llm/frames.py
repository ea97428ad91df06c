"""Texts as independent zstandard frames that can be entered at any unit."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import zstandard

from orderwake.llm.common import SPACE_CLASS

#: A unit: white space with the word after it, or what white space ends the text.
UNIT = re.compile(rf"[{SPACE_CLASS}]*[^{SPACE_CLASS}]+|[{SPACE_CLASS}]+")
#: Units of a full frame.
FRAME_UNITS = 1024
_FULL = re.compile(rf"(?:[{SPACE_CLASS}]*+[^{SPACE_CLASS}]++){{{FRAME_UNITS}}}")
_PACK = zstandard.ZstdCompressor(level=1, write_checksum=False)
_UNPACK = zstandard.ZstdDecompressor()


class Frames:
    """Frames with the units and code points up to the end of each."""

    def __init__(self, stored: list[dict] | None = None):
        stored = stored or []
        self.data: list[bytes] = [f["data"] for f in stored]
        self.units: list[int] = [f["units"] for f in stored]
        self.chars: list[int] = [f["chars"] for f in stored]

    @classmethod
    def of(cls, text: str) -> Frames:
        """A text cut into frames at unit boundaries; a unit is never cut, however long."""
        made, at = cls(), 0
        while at < len(text):
            full = _FULL.match(text, at)
            piece = text[at : full.end()] if full else text[at:]
            made.add(piece, FRAME_UNITS if full else len(UNIT.findall(piece)))
            at += len(piece)
        return made

    def add(self, piece: str, units: int) -> None:
        self.add_packed(_PACK.compress(piece.encode()), units, len(piece))

    def add_packed(self, data: bytes, units: int, chars: int) -> None:
        self.data.append(data)
        self.units.append(self.n_units + units)
        self.chars.append(self.n_chars + chars)

    @property
    def n_units(self) -> int:
        return self.units[-1] if self.units else 0

    @property
    def n_chars(self) -> int:
        return self.chars[-1] if self.chars else 0

    def stored(self) -> list[dict]:
        return [{"data": d, "units": u, "chars": c} for d, u, c in zip(self.data, self.units, self.chars)]

    def text_of(self, frame: int) -> str:
        return _UNPACK.decompress(self.data[frame]).decode()

    def _before(self, frame: int) -> tuple[int, int]:
        """Units and code points before a frame."""
        return (self.units[frame - 1], self.chars[frame - 1]) if frame else (0, 0)

    def offset(self, unit: int) -> int:
        """Code points before a unit (or the end). Only the frame that the cut falls into is unpacked."""
        frame = bisect_left(self.units, unit)
        if not unit or self.units[frame] == unit:
            return self.chars[frame] if unit else 0
        units, chars = self._before(frame)
        return chars + _unit_starts(self.text_of(frame), unit - units)

    def part(self, start: int, stop: int) -> Frames:
        """The units from `start` up to `stop`. Whole frames are taken over packed; only cut ones are unpacked."""
        made = Frames()
        if start >= stop:
            return made
        for frame in range(bisect_right(self.units, start), len(self.data)):
            before, chars = self._before(frame)
            if before >= stop:
                break
            a, b = max(start, before), min(stop, self.units[frame])
            if (a, b) == (before, self.units[frame]):
                made.add_packed(self.data[frame], b - a, self.chars[frame] - chars)
            else:
                text = self.text_of(frame)
                made.add(text[_unit_starts(text, a - before) : _unit_starts(text, b - before)], b - a)
        return made

    def extend(self, other: Frames) -> None:
        for frame, data in enumerate(other.data):
            units, chars = other._before(frame)
            self.add_packed(data, other.units[frame] - units, other.chars[frame] - chars)

    def stream(self, start: int = 0, stop: int | None = None) -> Iterator[str]:
        """The text between two code points, a frame at a time."""
        stop = self.n_chars if stop is None else stop
        for frame in range(bisect_right(self.chars, start), len(self.data)):
            _, before = self._before(frame)
            if before >= stop:
                return
            text = self.text_of(frame)
            yield text if before >= start and self.chars[frame] <= stop else text[max(start - before, 0) : stop - before]


def _unit_starts(text: str, unit: int) -> int:
    """Code points before the unit of that number in the text, or all of them if there is none."""
    if not unit:
        return 0
    for n, found in enumerate(UNIT.finditer(text), 1):
        if n == unit:
            return found.end()
    return len(text)
