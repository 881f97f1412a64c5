"""IP addresses as binary columns of 4 or 16 bytes; all functions are JVM expressions.

Binary columns compare as unsigned bytes, so an address range is one BETWEEN
and the order within a version is the numeric one. Version 4 comes before 6.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIVATE = ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")


def packed(text: str) -> bytes:
    return ipaddress.ip_address(text).packed


def network(text: str) -> tuple[bytes, bytes, int, int]:
    """First and last address, prefix length and version of ``a.b.c.d/n``; bits behind the prefix are dropped."""
    n = ipaddress.ip_network(text, strict=False)
    return n.network_address.packed, n.broadcast_address.packed, n.prefixlen, n.version


def literal(data: bytes) -> Column:
    return F.lit(bytearray(data))


def version(ip: Column) -> Column:
    return F.when(F.octet_length(ip) == 4, 4).when(F.octet_length(ip) == 16, 6).otherwise(0)


def is_v4(ip: Column) -> Column:
    return F.octet_length(ip) == 4


def compare(ip: Column, op: str, data: bytes) -> Column:
    """``ip op address``, where any version 4 address is below any version 6 address."""
    other = literal(data)
    same = F.octet_length(ip) == len(data)
    smaller = F.octet_length(ip) < len(data)
    if op == "==":
        return ip == other
    if op == "!=":
        return ip != other
    below = (same & (ip < other)) | smaller
    if op == "<":
        return below
    if op == "<=":
        return below | (ip == other)
    if op == ">":
        return ~(below | (ip == other))
    return ~below


def within(ip: Column, cidr: str) -> Column:
    """Membership in a prefix; never across versions."""
    low, high, _, _ = network(cidr)
    return (F.octet_length(ip) == len(low)) & ip.between(literal(low), literal(high))


def is_private(ip: Column) -> Column:
    return within(ip, PRIVATE[0]) | within(ip, PRIVATE[1]) | within(ip, PRIVATE[2])


def v4_number(ip: Column) -> Column:
    """A version 4 address as long."""
    return F.conv(F.hex(ip), 16, 10).cast("long")


def v4_of_number(number: Column) -> Column:
    return F.unhex(F.lpad(F.hex(number), 8, "0"))


def mask(ip: Column, v4_bits: Column | int, v6_bits: Column | int | None = None) -> Column:
    """The first bits of an address, the others zero.

    Works on hex digits: whole digits are kept, the digit at the border goes
    through a table of its leading bits.
    """
    v4 = F.lit(v4_bits) if isinstance(v4_bits, int) else v4_bits
    v6 = v4 if v6_bits is None else (F.lit(v6_bits) if isinstance(v6_bits, int) else v6_bits)
    bits = F.when(is_v4(ip), v4).otherwise(v6).cast("int")
    text = F.hex(ip)
    whole = F.floor(bits / 4).cast("int")
    digit = F.conv(F.substr(text, whole + 1, F.lit(1)), 16, 10).cast("int")
    part = bits % 4
    kept = F.when(part == 1, digit.bitwiseAND(8)).when(part == 2, digit.bitwiseAND(12)).otherwise(digit.bitwiseAND(14))
    border = F.when(part == 0, F.lit("")).otherwise(F.hex(kept))
    return F.unhex(F.rpad(F.concat(F.substr(text, F.lit(1), whole), border), F.length(text), F.lit("0")))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _groups(full: Column, n: Column) -> Column:
    """The first n groups, or the last -n."""
    return F.call_function("substring_index", full, F.lit(":"), n.cast("int"))


def text(ip: Column) -> Column:
    """Dotted or (shortest, lower case) colon form; other lengths give the empty text."""

    def shortest(full: Column) -> Column:
        # zero groups as one string of flags; the longest run is the first of the longest patterns that it holds
        zeros = F.regexp_replace(F.regexp_replace(full, "[1-9a-f][0-9a-f]*", "x"), ":", "")

        def cut(z: Column) -> Column:
            length = F.lit(0)
            for run in range(2, 9):
                length = F.when(z.contains("0" * run), run).otherwise(length)
            return _let(length, lambda n: F.when(n == 0, full).otherwise(_let(F.instr(z, F.repeat(F.lit("0"), n)), lambda at: F.concat(_groups(full, at - 1), F.lit("::"), _groups(full, at + n - 9)))))

        return _let(zeros, cut)

    def written(h: Column) -> Column:
        octets = [F.conv(F.substring(h, 2 * i + 1, 2), 16, 10) for i in range(4)]
        groups = [F.regexp_replace(F.substring(h, 4 * i + 1, 4), "^0{1,3}", "") for i in range(8)]
        return F.when(F.length(h) == 8, F.concat_ws(".", *octets)).when(F.length(h) == 32, _let(F.concat_ws(":", *groups), shortest)).otherwise(F.lit(""))

    return _let(F.lower(F.hex(ip)), written)


_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_QUAD = rf"(?:{_OCTET}\.){{3}}{_OCTET}"


def _four(value: Column) -> Column:
    return _let(F.split(value, r"\."), lambda q: F.unhex(F.concat(*[F.lpad(F.hex(F.get(q, F.lit(i)).try_cast("int")), 2, "0") for i in range(4)])))


def _sixteen(colon: Column) -> Column:
    """Colon form without a dotted end, of at most four digits in a group."""

    def groups(part: Column) -> Column:
        return F.filter(F.split(part, ":"), lambda x: x != "")

    def joined(x: Column) -> Column:
        gap = 8 - F.size(x["left"]) - F.size(x["right"])
        good = F.when(x["sides"] == 2, gap >= 1).otherwise((x["sides"] == 1) & (gap == 0))
        filled = F.concat(x["left"], F.array_repeat(F.lit("0"), F.greatest(gap, F.lit(0))), x["right"])
        return F.when(good, F.unhex(F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), "")))

    def split(sides: Column) -> Column:
        right = F.when(F.size(sides) > 1, groups(F.get(sides, F.lit(1)))).otherwise(F.array().cast("array<string>"))
        return _let(F.struct(groups(F.get(sides, F.lit(0))).alias("left"), right.alias("right"), F.size(sides).alias("sides")), joined)

    clean = colon.rlike(r"^[0-9A-Fa-f:]+$") & ~colon.rlike(r"[0-9A-Fa-f]{5}|:::|^:[^:]|[^:]:$")
    return F.when(clean, _let(F.split(colon, "::"), split))


def _dotted_end(value: Column) -> Column:
    """``::ffff:1.2.3.4`` with its end as two groups."""
    quad = F.regexp_extract(value, rf"({_QUAD})$", 1)
    two = _let(F.split(quad, r"\."), lambda q: F.concat_ws(":", *[F.hex(F.get(q, F.lit(2 * i)).try_cast("int") * 256 + F.get(q, F.lit(2 * i + 1)).try_cast("int")) for i in range(2)]))
    return F.concat(F.regexp_replace(value, rf"{_QUAD}$", ""), two)


def parse(value: Column) -> Column:
    """Dotted or colon text to binary; null if it is neither."""

    def parsed(v: Column) -> Column:
        return F.when(v.rlike(rf"^{_QUAD}$"), _four(v)).when(v.rlike(rf":{_QUAD}$"), _let(_dotted_end(v), _sixteen)).when(v.contains(":"), _sixteen(v))

    return _let(value, parsed)


def mac_text(mac: Column) -> Column:
    h = F.lower(F.hex(mac))
    return F.concat_ws(":", *[F.substring(h, 2 * i + 1, 2) for i in range(6)])
