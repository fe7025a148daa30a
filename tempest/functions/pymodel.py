"""Plain-Python models of the JDK string functions, for Python UDTFs and property tests."""

from __future__ import annotations

import re


def py_java_split(s: str, regex: str) -> list[str]:
    """``String.split(regex)``: trailing empty strings removed; ``""`` gives ``[""]``."""
    if s == "":
        return [""]
    parts = re.split(regex, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def py_java_length(s: str) -> int:
    """``String.length()`` in UTF-16 code units."""
    return len(s.encode("utf-16-le")) // 2


def py_java_hash(s: str) -> int:
    """``String.hashCode()``: ``h = 31*h + unit`` over UTF-16 units, as a signed 32-bit int."""
    data = s.encode("utf-16-be")
    h = 0
    for i in range(0, len(data), 2):
        h = (31 * h + ((data[i] << 8) | data[i + 1])) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h
