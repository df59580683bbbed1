"""Plain forms of what the operators work on."""

from __future__ import annotations

import re
import zlib


def words(text: str | None, lower: bool = True) -> list[str]:
    t = text or ""
    t = re.sub("[A-Z]+", lambda m: m[0].lower(), t) if lower else t
    return re.findall("[^\x20\x09-\x0d]+", t)


def crc(value) -> int:
    return zlib.crc32(str(value).encode())
