"""Byte-class counts of whole texts, shared by the quality operators."""

from __future__ import annotations

#: classes of bytes; a multi-byte character counts once, by its lead byte
CLASSES = ("vowel", "consonant", "upper", "digit", "space", "newline", "stop",
           "exclaim", "symbol", "other_ascii", "latin", "beyond")
_MARKS = {"vowel": b"aeiouy", "space": b" \t", "newline": b"\n", "stop": b".,;:?'\"-()",
          "exclaim": b"!", "symbol": b"#*$%&|<>=_~^+@\\/{}[]"}
WHITE = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")


def class_of_byte():
    """uint8 -> index in CLASSES; continuation bytes get len(CLASSES)."""
    import numpy as np

    of = np.full(256, CLASSES.index("other_ascii"))
    of[ord("a"):ord("z") + 1] = CLASSES.index("consonant")
    of[ord("A"):ord("Z") + 1] = CLASSES.index("upper")
    of[ord("0"):ord("9") + 1] = CLASSES.index("digit")
    for name, marks in _MARKS.items():
        of[list(marks)] = CLASSES.index(name)
    of[0x80:0xC0] = len(CLASSES)
    of[0xC0:0xCA] = CLASSES.index("latin")
    of[0xCA:] = CLASSES.index("beyond")
    return of


def class_matrix():
    """256 x len(CLASSES): a byte histogram times this gives class counts."""
    import numpy as np

    return np.eye(len(CLASSES) + 1)[class_of_byte()][:, :len(CLASSES)]


def byte_counts(data: bytes):
    import numpy as np

    return np.bincount(np.frombuffer(data, np.uint8), minlength=256)


def repeat_cover(grams, k: int, n: int):
    """Mask of the ``n`` entries inside a ``k``-gram found twice or more."""
    import numpy as np

    cover = np.zeros(n, bool)
    if len(grams):
        _, at, counts = np.unique(grams, return_inverse=True, return_counts=True)
        again = counts[at] > 1
        for i in range(k):
            cover[i:i + len(again)] |= again
    return cover


def dup_lines(data: bytes) -> int:
    """``\\n``-split lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))
