"""Prefix-preserving anonymisation of addresses, reversible with the key.

Bit i of the output is bit i of the input, flipped by a pseudo-random function
of the i bits before it. Two addresses that share a prefix keep sharing one of
the same length. The function is a keyed hash (BLAKE2b); the flips of whole
tables are made in Arrow batches, for distinct addresses only.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_V4 = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])")
_V6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")


@lru_cache(maxsize=1 << 18)
def _flip(key: bytes, width: int, length: int, prefix: int) -> int:
    """The pseudo-random bit of a prefix."""
    data = bytes([width, length]) + prefix.to_bytes(16, "big")
    return hashlib.blake2b(data, digest_size=1, key=key).digest()[0] & 1


def anonymized_bytes(ip: bytes, key: bytes, reverse: bool = False) -> bytes:
    """Addresses of 4 or 16 bytes; others stay as they are."""
    width = 8 * len(ip)
    if width not in (32, 128):
        return ip
    number, out, prefix = int.from_bytes(ip, "big"), 0, 0
    for i in range(width):
        bit = number >> (width - 1 - i) & 1
        new = bit ^ _flip(key, width, i, prefix)
        prefix = prefix << 1 | (new if reverse else bit)  # always the original's prefix
        out = out << 1 | new
    return out.to_bytes(len(ip), "big")


def anonymized_text(text: str, key: bytes, reverse: bool = False) -> str:
    """The first address in a text, version 4 before 6."""
    for pattern in (_V4, _V6):
        m = pattern.search(text)
        if m:
            try:
                ip = ipaddress.ip_address(m[0])
            except ValueError:
                continue
            return text[: m.start()] + str(ipaddress.ip_address(anonymized_bytes(ip.packed, key, reverse))) + text[m.end() :]
    return text


def anonymized(df: DataFrame, key: bytes, addresses: tuple[str, ...] = ("SRC_IP", "DST_IP"), texts: tuple[str, ...] = (), reverse: bool = False) -> DataFrame:
    def on_bytes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            known = {v: anonymized_bytes(v, key, reverse) for v in set(map(bytes, s.dropna()))}
            yield s.map(lambda v, known=known: None if v is None else known[bytes(v)])

    def on_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda v: None if v is None else anonymized_text(v, key, reverse))

    binary, string = F.pandas_udf(on_bytes, "binary"), F.pandas_udf(on_text, "string")
    columns: dict[str, Column] = {c: binary(F.col(c)) for c in addresses} | {c: string(F.col(c)) for c in texts}
    return df.withColumns(columns)
