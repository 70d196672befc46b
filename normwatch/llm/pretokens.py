"""Cuts texts into the pieces that byte-level tokenizers encode on their own, and remembers them.

No match of the usual patterns runs from a character that is not white space into a space: a space
can only begin a match of letters, digits or signs, or lie within white space.  So a text may be
cut before every space that follows something else than white space, and each piece may be matched
alone.  Most pieces are a word with its signs, which a task meets again and again.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Pieces and characters of them remembered by one Python worker before it starts anew; they bound its
# memory, not its results.
REMEMBERED = 350_000
REMEMBERED_LETTERS = 16 << 20
# UTF-8 bytes of the texts handled at a time, but for a single longer text.
SLICE_BYTES = 4 << 20


def text_slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices whose texts take up to ``most`` bytes (or are one row)."""
    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for at, size in enumerate(sizes):
        if total + size > most and at > begin:
            yield batch.slice(begin, at - begin)
            begin, total = at, 0
        total += int(size)
    if begin < batch.num_rows:
        yield batch.slice(begin)


class _Known(dict):
    """Numbers of pieces; a new piece gets the next number and waits to be resolved."""

    def __init__(self, owner: PieceTable, lead: str):
        self.owner, self.lead = owner, lead

    def __missing__(self, part: str) -> int:
        number = self.owner.numbered
        self.owner.numbered += 1
        self.owner.letters += len(part)
        self.owner.waiting.append(self.lead + part)
        self[part] = number
        return number


class PieceTable:
    """Values (whole numbers) of pieces, resolved once for each worker by ``resolve``.

    ``resolve`` takes pre-tokens that are not known yet and returns a list of numbers for each.  A
    piece that is one pre-token serves as its value in other pieces too, so each known word is held
    once, as text, number and values in flat arrays.
    """

    def __init__(self, pattern: str, resolve: Callable[[list[bytes]], Sequence[Sequence[int]]]):
        self.match = regex.compile(pattern).findall
        self.ragged = regex.compile(r"\s ").search
        self.resolve = resolve
        self.clear()

    def clear(self) -> None:
        self.numbered = self.letters = 0
        self.waiting: list[str] = []
        self.led, self.bare = _Known(self, " "), _Known(self, "")
        self.flat = array("i")
        self.ends = array("q", [0])

    def _settled(self, token: str) -> Sequence[int] | None:
        """The values of a pre-token that is a settled piece."""
        number = self.led.get(token[1:]) if token[0] == " " else self.bare.get(token)
        if number is None or number >= len(self.ends) - 1:
            return None
        return self.flat[self.ends[number] : self.ends[number + 1]]

    def numbers(self, text: str) -> list[int]:
        """The numbers of the pieces of a text, in order."""
        if self.ragged(text):
            bare = self.bare
            return [bare[t] for t in self.match(text)]
        first, *rest = text.split(" ")
        led = self.led
        known = [led[part] for part in rest]
        return [self.bare[first], *known] if first else known

    def settle(self) -> None:
        """Resolve the pieces that wait."""
        waiting, self.waiting = self.waiting, []
        if not waiting:
            return
        cut = [self.match(piece) for piece in waiting]
        values: dict[str, Sequence[int] | None] = {}
        for piece, tokens in zip(waiting, cut):
            for token in tokens:
                if token not in values:
                    values[token] = self._settled(token) if len(tokens) > 1 else None
        new = [token for token, known in values.items() if known is None]
        values.update(zip(new, self.resolve([t.encode() for t in new])))
        flat, ends = self.flat, self.ends
        for tokens in cut:
            for token in tokens:
                flat.extend(values[token])
            ends.append(len(flat))

    def values(self, numbers: list[list[int]]) -> Iterator[np.ndarray]:
        """The joined values of each list of piece numbers."""
        self.settle()
        flat = np.frombuffer(self.flat, np.int32) if len(self.flat) else np.zeros(0, np.int32)
        ends = np.frombuffer(self.ends, np.int64)
        for own in numbers:
            at = np.array(own, np.int64)
            begin = ends[at]
            size = ends[at + 1] - begin
            upto = np.cumsum(size)
            total = int(upto[-1]) if len(upto) else 0
            yield flat[np.repeat(begin - upto + size, size) + np.arange(total)]

    def tidy(self) -> None:
        """Forget all pieces when there are too many or too long ones.  Call between slices."""
        if self.numbered > REMEMBERED or self.letters > REMEMBERED_LETTERS:
            self.clear()
