"""IPv4 and IPv6 addresses as numbers, and sets of networks searched once per row.

An address is a struct (family, hi, lo): 4 or 6, and the 128-bit number in two halves whose
sign bit is flipped, so that comparing structs orders addresses. An IPv4 address has the
number in ``lo``. A set of networks is a sorted list of disjoint intervals, merged when the
set is made; membership is a search by halving, written as nested CASE branches over the
address, which is parsed once per row whatever the size of the set.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
#: hex groups and colons, at the end perhaps a dotted IPv4 address
IPV6_SIGNS = rf"^[0-9A-Fa-f:]*:([0-9A-Fa-f]{{0,4}}|{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET})$"
_FLIP = -(1 << 63)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(octets: Column) -> Column:
    o = lambda i: F.get(octets, F.lit(i)).cast("bigint")
    return ((o(0) * 256 + o(1)) * 256 + o(2)) * 256 + o(3)


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 -> number. Anything but four octets of 0-255 (IPv6 too) is null."""
    return F.when(ip.rlike(IPV4), bind(F.split(ip, r"\."), _number))


def _parts(family: int, hi: Column, lo: Column) -> Column:
    return F.struct(F.lit(family).alias("family"), hi.alias("hi"), lo.alias("lo"))


def _ipv6(ip: Column) -> Column:
    """(6, hi, lo) of an IPv6 text; null unless it has eight groups, or fewer and one ::."""
    def tail_as_groups(number: Column) -> Column:
        low = number.bitwiseAND(F.lit(0xFFFF).cast("bigint"))
        return F.concat(F.regexp_replace(ip, r"[0-9.]+$", ""), F.hex(F.shiftright(number, 16)), F.lit(":"), F.hex(low))

    plain = F.when(F.contains(ip, F.lit(".")), bind(
        _number(F.split(F.regexp_extract(ip, r"([0-9.]+)$", 1), r"\.")), tail_as_groups)).otherwise(ip)
    groups = lambda half: F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":", -1))

    def half(digits: Column, start: int) -> Column:
        return F.conv(F.substring(digits, start, 16), 16, -10).cast("bigint").bitwiseXOR(F.lit(_FLIP).cast("bigint"))

    def numbered(g: Column) -> Column:
        known = F.size(g["left"]) + F.size(g["right"])
        fill = F.array_repeat(F.lit("0"), F.lit(8) - known)
        digits = F.array_join(F.transform(F.concat(g["left"], fill, g["right"]), lambda x: F.lpad(x, 4, "0")), "")
        whole = F.forall(F.concat(g["left"], g["right"]), lambda x: x.rlike("^[0-9A-Fa-f]{1,4}$"))
        fits = ((g["halves"] == 1) & (known == 8)) | ((g["halves"] == 2) & (known <= 7))
        return F.when(whole & fits, bind(digits, lambda d: _parts(6, half(d, 1), half(d, 17))))

    return bind(F.split(plain, "::", -1), lambda h: bind(F.struct(
        groups(F.get(h, F.lit(0))).alias("left"), groups(F.coalesce(F.get(h, F.lit(1)), F.lit(""))).alias("right"),
        F.size(h).alias("halves")), numbered))


def address(ip: Column) -> Column:
    """An IPv4 or IPv6 text as (family, hi, lo); null if it is neither."""
    zero = F.lit(0).cast("bigint")
    return (F.when(ip.rlike(IPV4), _parts(4, zero, bind(F.split(ip, r"\."), _number)))
            .when(ip.rlike(IPV6_SIGNS), _ipv6(ip)))


def _key(family: int, number: int) -> tuple[int, int, int]:
    """(family, hi, lo) of an address number, as ``address`` has it."""
    if family == 4:
        return 4, 0, number
    signed = lambda x: (x ^ (1 << 63)) - (1 << 64) if (x ^ (1 << 63)) >> 63 else x ^ (1 << 63)
    return 6, signed(number >> 64), signed(number & (1 << 64) - 1)


def literal(key: tuple[int, int, int]) -> Column:
    return _parts(key[0], F.lit(key[1]).cast("bigint"), F.lit(key[2]).cast("bigint"))


@dataclass(frozen=True)
class AddressSet:
    """Sorted, disjoint intervals (first, last) of address keys."""

    intervals: tuple[tuple[tuple[int, int, int], tuple[int, int, int]], ...]

    @classmethod
    def of(cls, networks: Iterable[str]) -> AddressSet:
        """The set of some networks ('10.1.0.0/16', '2001:db8::/32', single addresses too)."""
        nets = [ipaddress.ip_network(n, strict=False) for n in networks]
        spans = sorted((n.version, int(n.network_address), int(n.broadcast_address)) for n in nets)
        merged: list[list[int]] = []
        for family, first, last in spans:
            if merged and merged[-1][0] == family and first <= merged[-1][2] + 1:
                merged[-1][2] = max(merged[-1][2], last)
            else:
                merged.append([family, first, last])
        return cls(tuple((_key(f, a), _key(f, b)) for f, a, b in merged))

    def _search(self, a: Column, low: int, high: int) -> Column:
        """Whether ``a`` is in one of the intervals low .. high-1."""
        if high - low == 1:
            first, last = self.intervals[low]
            return (a >= literal(first)) & (a <= literal(last))
        mid = (low + high) // 2
        return F.when(a < literal(self.intervals[mid][0]), self._search(a, low, mid)).otherwise(self._search(a, mid, high))

    def holds(self, ip: Column) -> Column:
        """Whether an address text is in the set (false for null and malformed texts)."""
        if not self.intervals:
            return F.lit(False)
        return F.coalesce(bind(address(ip), lambda a: self._search(a, 0, len(self.intervals))), F.lit(False))


def prefix_mask(family: int, length: int) -> tuple[int, int]:
    """The network bits of the two halves, as signed numbers."""
    bits = (1 << 128) - (1 << (128 - length)) if family == 6 else (0xFFFFFFFF >> (32 - length) << (32 - length) if length else 0)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return (signed(bits >> 64), signed(bits & (1 << 64) - 1)) if family == 6 else (0, bits)


def network_key(network: str) -> tuple[int, int, int, int]:
    """(family, prefix length, hi, lo) of a network, masked as ``networks_of`` masks addresses."""
    net = ipaddress.ip_network(network, strict=False)
    _, hi, lo = _key(net.version, int(net.network_address))
    mask_hi, mask_lo = prefix_mask(net.version, net.prefixlen)
    return net.version, net.prefixlen, hi & mask_hi, lo & mask_lo


def networks_of(ip: Column, lengths: Iterable[tuple[int, int]]) -> Column:
    """The networks of the given (family, prefix length) that an address is in: one struct each."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(n).alias("prefix_len"),
                     F.lit(prefix_mask(f, n)[0]).cast("bigint").alias("hi"),
                     F.lit(prefix_mask(f, n)[1]).cast("bigint").alias("lo")) for f, n in sorted(set(lengths))]

    def masked(a: Column) -> Column:
        own = F.filter(F.array(*rows), lambda m: m["family"] == a["family"])
        return F.transform(own, lambda m: F.struct(
            m["family"].alias("family"), m["prefix_len"].alias("prefix_len"),
            m["hi"].bitwiseAND(a["hi"]).alias("hi"), m["lo"].bitwiseAND(a["lo"]).alias("lo")))

    return bind(address(ip), masked)
