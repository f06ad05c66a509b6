"""Classes of IP addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcorpus.functions.text import let

# IPv4 blocks that are private, loopback, link-local, reserved or multicast.
IPV4_BLOCKED = [
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24",
    "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24",
    "224.0.0.0/4", "240.0.0.0/4",
]
# Addresses inside those blocks that are public all the same.
IPV4_PUBLIC = ["192.0.0.9", "192.0.0.10"]

# The IPv6 ranges that are public, and the blocks inside them that are not.
IPV6_PUBLIC = ["2000::/3", "fec0::/10"]
IPV6_BLOCKED = ["2001::/23", "2001:db8::/32", "2002::/16"]
# Public blocks inside the blocked ones.
IPV6_EXCEPTIONS = ["2001:1::1/128", "2001:1::2/128", "2001:3::/32", "2001:4:112::/48",
                   "2001:20::/28", "2001:30::/28"]

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z"


def is_ipv4(ip: Column) -> Column:
    return ip.rlike(_IPV4)


def ipv4_number(ip: Column) -> Column:
    """The address as a 32-bit number held in a long; NULL when it is no IPv4 address."""
    octet = F.split(ip, r"\.")
    number = sum((F.try_element_at(octet, F.lit(4 - i)).cast("long") * 256 ** i for i in range(4)),
                 F.lit(0).cast("long"))
    return F.when(is_ipv4(ip), number)


def _sql(value: int | str) -> str:
    return f"{value}L" if isinstance(value, int) else f"'{value}'"


def _in_ranges(value: Column, ranges: list[tuple]) -> Column:
    table = "array({})".format(", ".join(
        f"named_struct('low', {_sql(low)}, 'high', {_sql(high)})" for low, high in ranges))
    return F.exists(F.expr(table), lambda r: value.between(r["low"], r["high"]))


def _ipv4_blocked(number: Column) -> Column:
    def ends(block: str) -> tuple[int, int]:
        start, bits = block.split("/")
        low = _dotted(start)
        return low, low + 2 ** (32 - int(bits)) - 1

    public = number.isin([_dotted(ip) for ip in IPV4_PUBLIC])
    return _in_ranges(number, [ends(block) for block in IPV4_BLOCKED]) & ~public


def _dotted(ip: str) -> int:
    a, b, c, d = (int(x) for x in ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def ipv6_hex(ip: Column) -> Column:
    """The address as 32 hex digits; NULL when it is no IPv6 address."""
    def groups(text: Column) -> Column:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))

    def spell(halves: Column) -> Column:
        left, right = groups(halves[0]), groups(F.coalesce(F.get(halves, 1), F.lit("")))
        gap = 8 - F.size(left) - F.size(right)
        whole = F.concat(left, F.when(F.size(halves) == 2, F.array_repeat(F.lit("0"), gap))
                                .otherwise(F.array().cast("array<string>")), right)
        legal = (F.size(halves) <= 2) & (F.size(whole) == 8) & ((F.size(halves) == 1) | (gap >= 1)) \
            & F.forall(whole, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(legal, F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), ""))

    # A dotted tail stands for the last two groups; a zone name is not part of the address.
    bare = F.lower(F.regexp_replace(ip, r"%[^%]*\z", ""))
    tail = ipv4_number(F.regexp_extract(bare, r"([0-9.]+)\z", 1))
    tail_hex = F.lpad(F.lower(F.hex(tail)), 8, "0")
    plain = F.when(
        bare.contains("."),
        F.concat(F.regexp_replace(bare, r"[0-9.]+\z", ""),
                 F.substring(tail_hex, 1, 4), F.lit(":"), F.substring(tail_hex, 5, 4)),
    ).otherwise(bare)
    return F.when(ip.contains(":"), let(plain, lambda p: let(F.split(p, "::"), spell)))


def _ipv6_in(hexed: Column, blocks: list[str]) -> Column:
    def ends(block: str) -> tuple[str, str]:
        start, bits = block.split("/")
        left, _, right = start.partition("::")
        groups = left.split(":")
        tail = right.split(":") if right else []
        groups += ["0"] * (8 - len(groups) - len(tail)) + tail
        low = int("".join(g.zfill(4) for g in groups), 16)
        return f"{low:032x}", f"{low + 2 ** (128 - int(bits)) - 1:032x}"

    return _in_ranges(hexed, [ends(block) for block in blocks])


def is_blocked(ip: Column) -> Column:
    """True unless the text is a public address: what cannot be read as one is blocked too."""
    def v6(h: Column) -> Column:
        public = _ipv6_in(h, IPV6_PUBLIC) & ~_ipv6_in(h, IPV6_BLOCKED)
        return ~(public | _ipv6_in(h, IPV6_EXCEPTIONS))

    return F.coalesce(
        F.when(ip.contains(":"), let(ipv6_hex(ip), v6))
         .otherwise(let(ipv4_number(ip), _ipv4_blocked)),
        F.lit(True))


def ip_bits(ip: Column) -> Column:
    """The address as "4" and 32, or "6" and 128 binary digits; NULL when it is no address."""
    def digits(h: Column) -> Column:
        groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.lpad(
            F.conv(F.substr(h, k * 4 + 1, F.lit(4)), 16, 2), 16, "0"))
        return F.concat(F.lit("6"), F.array_join(groups, ""))

    v4 = F.concat(F.lit("4"), F.lpad(F.bin(ipv4_number(ip)), 32, "0"))
    return F.when(ip.contains(":"), let(ipv6_hex(ip), lambda h: F.when(h.isNotNull(), digits(h)))).otherwise(v4)


def default_ranges() -> list[tuple[str, bool]]:
    """(cidr, blocked): the fixed ranges above as a table; the most specific one counts."""
    public4 = [f"{ip}/32" for ip in IPV4_PUBLIC]
    return ([("0.0.0.0/0", False), ("::/0", True)] + [(c, True) for c in IPV4_BLOCKED + IPV6_BLOCKED]
            + [(c, False) for c in public4 + IPV6_PUBLIC + IPV6_EXCEPTIONS])
