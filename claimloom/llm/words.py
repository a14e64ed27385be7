"""Words of whole texts as bytes, in lists of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Runs of ASCII letters and digits and of all that isn't ASCII, after bytes.lower(), which changes A-Z only.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
OTHER = re.compile(rb"[^0-9a-z\x80-\xff]")


def word_lists(text: str | None, block_bytes: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, with A-Z made small; null has none. No word is cut between two lists."""
    raw, at = (text or "").encode().lower(), 0
    while at < len(raw):
        m = OTHER.search(raw, at + block_bytes) if at + block_bytes < len(raw) else None
        end = m.start() if m else len(raw)
        yield WORD.findall(raw, at, end)
        at = end
