"""Splitting texts into words on their UTF-8 bytes.

All separators are ASCII, so no byte of a longer character is ever one of them.
"""

from __future__ import annotations

# everything ASCII but digits and letters becomes a space, A-Z becomes a-z
_ALNUM = bytes(
    (b + 32) if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def utf8(text: str | None) -> bytes:
    """The bytes of a text; null counts as empty, a lone surrogate as a question mark."""
    return b"" if text is None else text.encode("utf-8", "replace")


def alnum_words(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters and non-ASCII characters."""
    return data.translate(_ALNUM).split()


def spaced_words(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of anything but space and the controls 0x09 to 0x0D."""
    return data.lower().split()
