"""A dictionary coder over UTF-16 units with a 65-character alphabet, and the request state that it carries.

The format is that of LZ-string, whose 16-bit units are written in base64. Nothing in Spark speaks it, so both directions are Arrow-batched functions; one coder object
serves a batch.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The alphabet of the base64 form, with its padding.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/="
_PLACE = {c: i for i, c in enumerate(ALPHABET)}


def _units(text: str) -> tuple[int, ...]:
    raw = text.encode("utf-16-le", "surrogatepass")
    return struct.unpack(f"<{len(raw) // 2}H", raw)


class _Writer:
    """Bits, the lowest of a number first, as a string of 0 and 1."""

    def __init__(self) -> None:
        self.bits: list[str] = []

    def put(self, value: int, width: int) -> None:
        self.bits.append(format(value, f"0{width}b")[::-1])


def compress(text: str) -> str:
    """Codes 0, 1 and 2 announce a new 8-bit unit, a new 16-bit unit and the end; others are phrases in order of appearance."""
    out, phrases, fresh, width, room = _Writer(), {}, set(), 2, 2

    def grown() -> None:
        nonlocal width, room
        room -= 1
        if not room:
            room, width = 1 << width, width + 1

    def emit(phrase: tuple[int, ...]) -> None:
        if phrase in fresh:
            unit = phrase[0]
            wide = unit > 255
            out.put(int(wide), width)
            out.put(unit, 16 if wide else 8)
            fresh.discard(phrase)
            grown()
        else:
            out.put(phrases[phrase], width)
        grown()

    held: tuple[int, ...] = ()
    for unit in _units(text):
        one = (unit,)
        if one not in phrases:
            phrases[one] = len(phrases) + 3
            fresh.add(one)
        longer = held + one
        if longer in phrases:
            held = longer
        else:
            emit(held)
            phrases[longer] = len(phrases) + 3
            held = one
    if held:
        emit(held)
    out.put(2, width)
    bits = "".join(out.bits)
    # The bits fill units of 16; one bit at least closes the last of them.
    bits += "0" * (16 - len(bits) % 16)
    return base64.b64encode(int(bits, 2).to_bytes(len(bits) // 8, "big")).decode()


def decompress(data: str) -> str | None:
    """None for what is not whole; characters outside the alphabet are ignored."""
    chars = [c for c in data if c in _PLACE]
    if not chars:
        return "" if not data else None
    if len(chars) % 4:
        return None
    bits = "".join(format(_PLACE[c], "06b") for c in chars if c != "=")
    at = 0

    def take(width: int) -> int:
        nonlocal at
        if at + width > len(bits):
            raise ValueError("cut off")
        value, at = int(bits[at : at + width][::-1], 2), at + width
        return value

    try:
        phrases: list[tuple[int, ...]] = [(), (), ()]
        out: list[int] = []
        width, room, before = 2, 4, None
        first = True
        while True:
            code = take(2 if first else width)
            if code == 2:
                break
            if code in (0, 1):
                phrases.append((take(16 if code else 8),))
                code = len(phrases) - 1
                room -= not first
            if first:
                width, entry = 3, phrases[code]
            else:
                if not room:
                    room, width = 1 << width, width + 1
                if code < len(phrases):
                    entry = phrases[code]
                elif code == len(phrases):
                    entry = before + before[:1]
                else:
                    return None
                phrases.append(before + entry[:1])
                room -= 1
                if not room:
                    room, width = 1 << width, width + 1
            out += entry
            before, first = entry, False
        return struct.pack(f"<{len(out)}H", *out).decode("utf-16-le", "surrogatepass")
    except (ValueError, TypeError, IndexError, UnicodeDecodeError):
        return None


def _batched(one, kind="string"):
    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(one, na_action="ignore")

    return run


def compressed(c: Column) -> Column:
    return _batched(compress)(c)


def decompressed(c: Column) -> Column:
    return _batched(decompress)(c)


def request_state(query: Column, start: Column, rows: Column, site: str, language: str = "en", search: tuple[str, str] = ("MARK_ALL,HOL", "BRAND_ALL,HOL"), facets: tuple[str, ...] = ("DS", "HOLC")) -> Column:
    """A search request as JSON; start and rows are left out unless positive. search: default fields and fields of a term."""
    positive = lambda c: F.when(c > 0, c)
    term = F.struct(F.lit("AND").alias("co"), F.lit(search[0]).alias("df"), F.lit(search[1]).alias("fi"), query.alias("te"))
    search_terms = F.struct(F.array(query).alias("raw"), F.array(term).alias("sq")).alias("search")
    page = F.struct(F.array(*map(F.lit, facets)).alias("facets"), search_terms, positive(start).alias("start"), positive(rows).alias("rows"))
    return F.to_json(F.struct(F.lit(language).alias("la"), page.alias("p"), F.lit(site).alias("type")))


def form(state: Column) -> Column:
    return F.concat(F.lit("qz="), F.url_encode(compressed(state)))
