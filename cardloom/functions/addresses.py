"""IP addresses as columns: text to a number in hexadecimal digits, and which of them are public."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

# The address blocks of the special-purpose registries, and multicast.
SPECIAL_4 = (
    "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.0.9/32", "192.0.0.10/32",
    "192.0.0.170/31", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4", "255.255.255.255/32",
)
SPECIAL_6 = (
    "::/128", "::1/128", "::ffff:0:0/96", "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:1::1/128", "2001:1::2/128", "2001:3::/32", "2001:4:112::/48",
    "2001:20::/28", "2001:30::/28", "2001:db8::/32", "2002::/16", "3fff::/20", "fc00::/7", "fe80::/10", "ff00::/8",
)
# End of fixed values.


def _closed(blocks: tuple[str, ...], digits: int) -> list[tuple[str, str]]:
    """First and last address, in hexadecimal, of the stretches that are not public.

    Blocks nest and overlap; each stretch between their borders is judged once, by the standard library.
    """
    nets = [ipaddress.ip_network(b) for b in blocks]
    kind = ipaddress.IPv4Address if digits == 8 else ipaddress.IPv6Address
    borders = sorted({0, 16**digits} | {int(n[0]) for n in nets} | {int(n[-1]) + 1 for n in nets})
    out: list[tuple[int, int]] = []
    for low, high in zip(borders, borders[1:], strict=False):
        ip = kind(low)
        if not ip.is_global or ip.is_multicast:
            out = [*out[:-1], (out[-1][0], high - 1)] if out and out[-1][1] + 1 == low else [*out, (low, high - 1)]
    return [(f"{a:0{digits}x}", f"{b:0{digits}x}") for a, b in out]


_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_QUAD = r"\.".join([_OCTET] * 4)


def ipv4_hex(text: Column) -> Column:
    """8 hexadecimal digits of a dotted address without leading zeros; null for other texts."""
    parts = [F.lpad(F.lower(F.hex(F.regexp_extract(text, rf"\A{_QUAD}\z", k).try_cast("long"))), 2, "0") for k in range(1, 5)]
    return F.when(text.rlike(rf"\A{_QUAD}\z"), F.concat(*parts))


def _let(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), 0)


def ipv6_hex(text: Column) -> Column:
    """32 hexadecimal digits of a lower-case IPv6 address, with or without a scope; null for other texts."""
    wide = lambda a: F.array_join(F.transform(a, lambda g: F.lpad(g, 4, "0")), "")

    def undotted(bare):
        quad = ipv4_hex(F.regexp_extract(bare, r"(?s):([^:]*)\z", 1))
        groups = _let(quad, lambda q: F.concat(F.substring(q, 1, 4), F.lit(":"), F.substring(q, 5, 4)))
        return F.when(bare.contains("."), F.concat(F.regexp_replace(bare, r"(?s)[^:]*\z", ""), groups)).otherwise(bare)

    def digits(s):
        n = F.size(s["left"]) + F.size(s["right"])
        fit = (s["parts"] <= 2) & F.when(s["parts"] == 2, n <= 7).otherwise(n == 8) & F.forall(F.concat(s["left"], s["right"]), lambda g: g.rlike(r"\A[0-9a-f]{1,4}\z"))
        return F.when(fit, F.concat(wide(s["left"]), F.repeat(F.lit("0"), F.greatest(8 - n, F.lit(0)) * 4), wide(s["right"])))

    def halves(h):
        groups = lambda k: _let(F.get(h, k), lambda x: F.when(x.isNull() | (x == ""), F.array().cast("array<string>")).otherwise(F.split(x, ":", -1)))
        return _let(F.struct(groups(0).alias("left"), groups(1).alias("right"), F.size(h).alias("parts")), digits)

    plain = _let(F.regexp_replace(text, r"%[^%]+\z", ""), undotted)
    return F.when(text.contains(":"), _let(F.split(plain, "::", -1), halves))


def _outside(digits: Column, ranges: list[tuple[str, str]]) -> Column:
    inside = F.lit(False)
    for low, high in ranges:
        inside = inside | digits.between(low, high)
    return ~inside


def is_global(text: Column) -> Column:
    """Whether a lower-case address is public and no multicast; null for what is no address. IPv4 inside IPv6 counts as the standard library has it."""
    inside = tuple(f"::ffff:{n[0]}/{96 + n.prefixlen}" for n in map(ipaddress.ip_network, SPECIAL_4))
    four, six = _closed(SPECIAL_4, 8), _closed(SPECIAL_6 + inside, 32)
    judged = lambda s: F.when(s["four"].isNotNull(), _outside(s["four"], four)).when(s["six"].isNotNull(), _outside(s["six"], six))
    return _let(F.struct(ipv4_hex(text).alias("four"), ipv6_hex(text).alias("six")), judged)
