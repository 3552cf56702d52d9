"""Tokenisations shared by the operators, on UTF-8 bytes.

Bytes of characters beyond ASCII are all 0x80 or more, so ASCII-only rules can
work on bytes as they stand.
"""

from __future__ import annotations

_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Lower-cases A-Z and turns every other ASCII character that is no letter or digit into a space.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _ALNUM else 32 for b in range(256)
)


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and characters beyond ASCII, with A-Z lower-cased."""
    return (text or b"").translate(_LETTERS).split()


def spaced_words(text: bytes | None) -> list[bytes]:
    """What ASCII white space separates, with A-Z lower-cased."""
    return (text or b"").lower().split()
