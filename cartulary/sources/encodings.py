"""Text of XML files by the encoding that they declare."""

from __future__ import annotations

import functools
from encodings.aliases import aliases

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLACEMENT = "�"
_HIGH = bytes(range(128, 256))
# Two-byte code units none of which is half of a pair; pairs cannot be checked before decoding.
_NO_PAIRS = {"FEFF": r"(?s)\A(?:[^Ø-ß].)*+\z", "FFFE": r"(?s)\A(?:.[^Ø-ß])*+\z"}


def _simple(name: str) -> str:
    """An encoding's name without case and signs."""
    return "".join(x for x in name.lower() if x.isascii() and x.isalnum())


@functools.cache
def _meanings() -> dict[str, str]:
    """What the bytes from 128 on mean in each encoding of one byte a character that keeps ASCII."""
    ascii_bytes, found = bytes(range(128)), {}
    for alias, codec in aliases.items():
        try:
            high = _HIGH.decode(codec, "replace")
            keeps = ascii_bytes.decode(codec) == ascii_bytes.decode("ascii")
        except (LookupError, UnicodeError):
            continue
        if keeps and len(high) == 128 and not codec.startswith("utf"):
            found |= dict.fromkeys((_simple(alias), _simple(codec)), high)
    return found


def decoded(content: Column) -> tuple[Column, Column]:
    """A file's text, and whether it could be decoded.

    A byte-order mark decides, then the XML declaration, then UTF-8. Bytes that an encoding does
    not have, and encodings that are not known, make a file undecodable; its text is then only
    good for showing.
    """
    latin, utf8 = F.decode(content, "ISO-8859-1"), F.make_valid_utf8(content.cast("string"))
    mark = F.hex(F.substring(content, 1, 2))
    head = F.substring_index(latin, "?>", 1)
    declared = F.when(
        F.startswith(head, F.lit("<?xml")), F.regexp_extract(head, r"\sencoding\s*=\s*[\"']\s*([A-Za-z0-9._:-]+)", 1)
    )
    name = F.regexp_replace(F.lower(F.coalesce(F.nullif(declared, F.lit("")), F.lit("utf8"))), "[^a-z0-9]", "")
    meaning = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(_meanings().items()) for x in pair]), name)
    two_bytes = [(mark == kind) & latin.rlike(pattern) for kind, pattern in _NO_PAIRS.items()]
    text = (
        F.when(two_bytes[0] | two_bytes[1], F.decode(content, "UTF-16"))
        .when(name == "utf8", utf8)
        .when(meaning.isNotNull(), F.call_function("translate", latin, F.lit(_HIGH.decode("latin-1")), meaning))
    )
    lossy = F.regexp_replace(F.coalesce(text, utf8), "^﻿", "")
    return lossy, text.isNotNull() & ~F.contains(lossy, F.lit(REPLACEMENT))
