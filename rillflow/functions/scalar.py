"""Scalar functions on record fields, all as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Protocol numbers and names.
PROTOCOLS = {"icmp": 1, "igmp": 2, "tcp": 6, "udp": 17, "ipv6": 41, "gre": 47, "esp": 50, "ah": 51, "ipv6-icmp": 58, "ospf": 89, "sctp": 132}
#: Services by port and protocol.
SERVICES = {(20, 6): "ftp-data", (21, 6): "ftp", (22, 6): "ssh", (23, 6): "telnet", (25, 6): "smtp", (53, 6): "domain", (53, 17): "domain", (80, 6): "http", (110, 6): "pop3", (123, 17): "ntp", (143, 6): "imap2", (161, 17): "snmp", (389, 6): "ldap", (443, 6): "https", (443, 17): "https", (445, 6): "microsoft-ds", (514, 17): "syslog", (993, 6): "imaps", (995, 6): "pop3s", (3306, 6): "mysql", (3389, 6): "ms-wbt-server", (5060, 6): "sip", (5060, 17): "sip", (5900, 6): "vnc", (8080, 6): "http-alt"}


def seconds(time: Column) -> Column:
    """A time as seconds since 1970, with fraction."""
    return F.unix_micros(time.cast("timestamp")).cast("double") / 1e6


def whole_seconds(time: Column) -> Column:
    return F.floor(F.unix_micros(time.cast("timestamp")) / 1000000).cast("long")


def floor_to_step(second: Column, step: int) -> Column:
    return second - F.pmod(second, F.lit(step))


def duration(first: Column, last: Column) -> Column:
    return seconds(last) - seconds(first)


def _per_second(amount: Column, first: Column, last: Column) -> Column:
    span = duration(first, last)
    return F.when(span != 0, amount / F.nullif(span, F.lit(0.0))).otherwise(F.lit(0.0))


def packets_per_second(packets: Column, first: Column, last: Column) -> Column:
    return _per_second(packets.cast("double"), first, last)


def bits_per_second(octets: Column, first: Column, last: Column) -> Column:
    return _per_second(8 * octets.cast("double"), first, last)


def bytes_per_packet(octets: Column, packets: Column) -> Column:
    return F.when(packets != 0, octets.cast("double") / F.nullif(packets, F.lit(0))).otherwise(F.lit(0.0))


def minutes_text(minutes: Column) -> Column:
    """Minutes as ``[nD]HH:MM:SS``."""
    days, hours, rest = F.floor(minutes / 1440), F.floor(F.pmod(minutes, F.lit(1440)) / 60), F.pmod(minutes, F.lit(60))
    clock = F.concat(F.lpad(hours.cast("string"), 2, "0"), F.lit(":"), F.lpad(rest.cast("string"), 2, "0"), F.lit(":00"))
    return F.when(days > 0, F.concat(days.cast("string"), F.lit("D"), clock)).otherwise(clock)


def protocol_name(number: Column) -> Column:
    pairs = [x for name, n in PROTOCOLS.items() for x in (F.lit(n), F.lit(name))]
    return F.coalesce(F.create_map(*pairs)[number.cast("int")], number.cast("string"))


def service_name(port: Column, protocol: Column) -> Column:
    """The service of a port, empty if unknown."""
    pairs = [x for (p, n), name in SERVICES.items() for x in (F.lit(p * 256 + n), F.lit(name))]
    return F.coalesce(F.create_map(*pairs)[(port * 256 + protocol).cast("int")], F.lit(""))


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "?")


def icmp_type(dst_port: Column) -> Column:
    return F.shiftright(dst_port.cast("int"), 8)


def icmp_code(dst_port: Column) -> Column:
    return dst_port.cast("int").bitwiseAND(255)


def highest_bit(number: Column) -> Column:
    """Place of the highest set bit, 0 for none."""
    return F.when(number == 0, 0).otherwise(F.length(F.bin(number)) - 1)


def tcp_flags_text(flags: Column) -> Column:
    """Letters ``UAPRSF``, a dot for a bit that isn't set."""
    return F.concat(*[F.when(flags.bitwiseAND(bit) != 0, letter).otherwise(".") for bit, letter in ((32, "U"), (16, "A"), (8, "P"), (4, "R"), (2, "S"), (1, "F"))])


def bswap(number: Column, octets: int) -> Column:
    """The bytes of an integer in reverse order."""
    h = F.lpad(F.hex(number.cast("long")), 16, "0")
    own = F.substr(h, F.lit(17 - 2 * octets), F.lit(2 * octets))
    turned = F.concat(*[F.substr(own, F.lit(2 * i + 1), F.lit(2)) for i in reversed(range(octets))])
    return F.conv(turned, 16, -10 if octets == 8 else 10).cast("long")


def array_text(values: Column) -> Column:
    """``[a|b|c]``."""
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), "|"), F.lit("]"))


def text_array(text: Column, element: str) -> Column:
    inner = F.regexp_replace(text, r"^\[|\]$", "")
    return F.when(inner == "", F.array().cast(f"array<{element}>")).otherwise(F.split(inner, r"\|").cast(f"array<{element}>"))


def squashed(value: Column) -> Column:
    """tanh(x / 100): a count between 0 and 1."""
    return F.tanh(value / 100)
