"""Column expressions for addresses, flags and bin widths. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bit of a TCP flag and its letter in flag text, in text order (fixed values).
TCP_FLAGS = ((0x02, "S"), (0x10, "A"), (0x04, "R"), (0x01, "F"), (0x80, "C"), (0x20, "U"), (0x08, "P"), (0x40, "E"))


def flag_text(forward: Column, reverse: Column) -> Column:
    """16 characters: for each flag its letter if seen forward, in lower case if seen in reverse, else a dot."""
    parts = []
    for mask, letter in TCP_FLAGS:
        for side, shown in ((forward, letter), (reverse, letter.lower())):
            parts.append(F.when(side.bitwiseAND(F.lit(mask)) != 0, F.lit(shown)).otherwise(F.lit(".")))
    return F.concat(*parts)


def ipv4_text(ip: Column) -> Column:
    octet = lambda shift: F.shiftright(ip, shift).bitwiseAND(F.lit(255)).cast("string")
    return F.concat_ws(".", octet(24), octet(16), octet(8), octet(0))


def ipv4_number(text: Column) -> Column:
    """The address as a long; null for anything but four decimal parts."""
    p = F.split(text, r"\.")
    number = ((p[0].cast("long") * 256 + p[1].cast("long")) * 256 + p[2].cast("long")) * 256 + p[3].cast("long")
    return F.when(text.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), number)


def ipv6_hex(text: Column) -> Column:
    """32 lower-case hex digits of an IPv6 address, with or without ``::`` and a zone; null for anything else."""
    bare = F.lower(F.regexp_replace(text, "%.*$", ""))
    full = lambda part: F.transform(F.filter(F.split(part, ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0"))
    halves = F.split(bare, "::")
    left, right = full(halves[0]), full(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
    missing = 8 - F.size(left) - F.size(right)
    middle = F.array_repeat(F.lit("0000"), F.greatest(missing, F.lit(0)))
    good = bare.rlike("^[0-9a-f:]{2,39}$") & ~bare.rlike("[0-9a-f]{5}|:::|^:[^:]|[^:]:$") & F.when(F.size(halves) == 1, missing == 0).otherwise((F.size(halves) == 2) & (missing > 0))
    return F.when(good, F.array_join(F.concat(left, middle, right), ""))


def mac_text(mac: Column) -> Column:
    return F.lower(F.regexp_replace(F.hex(mac), "(..)(?=.)", "$1:"))


def bit_text(byte: Column) -> Column:
    """Eight bits, the highest first."""
    return F.lpad(F.bin(byte.bitwiseAND(F.lit(255)).cast("long")), 8, "0")


def is_private(address: Column) -> Column:
    """10/8, 192.168/16 and 172.16/12 by their text; anything else, IPv6 included, is not."""
    return address.startswith("10.") | address.startswith("192.168.") | address.rlike(r"^172\.(1[6-9]|2[0-9]|3[01])\.")


def network_class(address: Column) -> Column:
    """Bin of an address: its first octet below 128, else the first two, low octet first; IPv6 by its first two bytes."""
    p = F.split(address, r"\.")
    first, second = p[0].cast("long"), p[1].cast("long")
    hextet = F.lpad(F.split(address, ":")[0], 4, "0")
    v6 = F.conv(F.substring(hextet, 1, 2), 16, 10).cast("long") + F.conv(F.substring(hextet, 3, 2), 16, 10).cast("long") * 256
    return F.when(address.contains(":"), v6).when(first < 128, first).otherwise(first + second * 256)


def nice_step(low: Column, high: Column, whole: bool = True) -> Column:
    """Width of ten or so bins: 1, 2, 5 or 10 times a power of ten. Whole numbers spread below 8 get 1; no spread gets 1."""
    raw = (high - low) / F.lit(10.0)
    k = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    f = raw / k
    step = k * F.when(f < 1.5, 1.0).when(f < 3.0, 2.0).when(f < 7.5, 5.0).otherwise(10.0)
    return F.when((high == low) | ((high - low < 8) if whole else F.lit(False)), F.lit(1.0)).otherwise(step)


def bin_number(value: Column, low: Column, step: Column) -> Column:
    """Of the upper-inclusive bin that holds ``value``; times the step it is the bin's upper boundary."""
    return F.greatest(F.ceil(value / step), F.floor(low / step) + F.lit(1)).cast("long")


def risk_bits_set(bits: Column) -> Column:
    """Numbers of the set bits, lowest first."""
    return F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftrightunsigned", bits, i).bitwiseAND(F.lit(1)) == 1)
