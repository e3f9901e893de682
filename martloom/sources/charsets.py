"""Single-byte code pages on top of the character sets Spark reads by default."""

from __future__ import annotations

import codecs

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character sets that Spark's delimited reader takes, by their normalised name.
_NATIVE = {
    "utf-8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "utf-16": "UTF-16",
    "utf-16-be": "UTF-16BE",
    "utf-16-le": "UTF-16LE",
    "utf-32": "UTF-32",
    "ascii": "US-ASCII",
    "iso8859-1": "ISO-8859-1",
}
# Code pages of one byte a character whose first half is ASCII.
_CODE_PAGES = (
    "cp1250", "cp1251", "cp1252", "cp1253", "cp1254", "cp1255", "cp1256", "cp1257", "cp1258",
    "iso8859-2", "iso8859-3", "iso8859-4", "iso8859-5", "iso8859-6", "iso8859-7", "iso8859-8", "iso8859-9", "iso8859-10",
    "iso8859-11", "iso8859-13", "iso8859-14", "iso8859-15", "iso8859-16",
    "cp437", "cp850", "cp852", "cp855", "cp858", "cp866", "koi8-r", "koi8-u", "mac-roman",
)


def normal_name(charset: str) -> str:
    """The one name of a supported character set, whatever alias is given. Raises ValueError for any other."""
    try:
        name = codecs.lookup(charset).name
    except LookupError:
        raise ValueError(f"unknown character set {charset}") from None
    if name not in _NATIVE and name not in _CODE_PAGES:
        raise ValueError(f"character set {charset} is not supported")
    return name


def spark_charset(charset: str) -> str:
    """The charset to hand to Spark: its own name for it, or ISO-8859-1 as a byte-preserving carrier."""
    return _NATIVE.get(normal_name(charset), "ISO-8859-1")


def _differences(charset: str) -> tuple[str, str]:
    """Characters a code page decodes unlike ISO-8859-1: (as carried, as meant)."""
    carried, meant = [], []
    for code in range(128, 256):
        byte = bytes([code])
        try:
            wanted = byte.decode(charset)
        except UnicodeDecodeError:
            continue
        if wanted != byte.decode("iso-8859-1"):
            carried.append(byte.decode("iso-8859-1"))
            meant.append(wanted)
    return "".join(carried), "".join(meant)


def decode_text(column: Column | str, charset: str) -> Column:
    text = F.col(column) if isinstance(column, str) else column
    if normal_name(charset) in _NATIVE:
        return text
    carried, meant = _differences(charset)
    return F.translate(text, carried, meant)


def encode_text(column: Column | str, charset: str) -> Column:
    text = F.col(column) if isinstance(column, str) else column
    if normal_name(charset) in _NATIVE:
        return text
    carried, meant = _differences(charset)
    return F.translate(text, meant, carried)


def decode_strings(df: DataFrame, charset: str) -> DataFrame:
    if normal_name(charset) in _NATIVE:
        return df
    return df.select(
        *[
            decode_text(F.col(name), charset).alias(name) if kind == "string" else F.col(name)
            for name, kind in df.dtypes
        ]
    )
