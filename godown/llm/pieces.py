"""Words of a byte string, some at a time, so that a very long text is never held as a list of words."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes whose words are listed together; a longer word is still one word.
PIECE = 1 << 20


def word_pieces(raw: bytes, separators: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """Lists of the words of ``raw`` in order, of about ``size`` bytes each. ``separators`` is a table for
    ``bytes.translate`` that maps every separator to a white-space byte."""
    rest = b""
    for start in range(0, len(raw), size):
        part = rest + raw[start:start + size].translate(separators)
        words = part.split()
        rest = b""
        if start + size < len(raw) and words and not part[-1:].isspace():
            rest = words.pop()  # it may go on in the next piece
        yield words
    if rest:
        yield [rest]
