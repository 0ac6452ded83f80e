"""Repeatable draws: a value depends only on the row's id, the seed and a label, never on partitioning."""

from __future__ import annotations

import hashlib
import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two primes just below 2^31: products of numbers below them fit a bigint.
KEY_PRIME = 2_147_483_647
DRAW_PRIME = 2_147_483_629


def factors(seed: int, label: str) -> tuple[int, ...]:
    """Five multipliers and offsets that set one use of a seed apart from another."""
    digest = hashlib.md5(f"{seed}:{label}".encode(), usedforsecurity=False).digest()
    limits = (2**31 - 64, 2**29, 2**31 - 64, 2**31 - 64, 2**31 - 64)
    return tuple(1 + int.from_bytes(digest[3 * i : 3 * i + 4], "big") % limit for i, limit in enumerate(limits))


def draw(key: Column, seed: int, label: str) -> Column:
    """A whole number below ``DRAW_PRIME``: two congruential steps with different primes.

    Plain arithmetic stays in generated code and uses every intermediate once,
    is cheaper than a digest, and unlike Spark's own hash functions can be
    repeated by any SQL engine.
    """
    low, high, shift, spread, offset = factors(seed, label)
    wide = key.cast("bigint")
    mixed = wide.bitwiseAND(F.lit(KEY_PRIME)) * low + F.shiftright(wide, 31) * high + shift
    return (F.pmod(mixed, F.lit(KEY_PRIME)) * spread + offset) % DRAW_PRIME


def sub_key(key: Column, number: Column) -> Column:
    """Key of the numbered part (0 to 15) of a row."""
    return F.shiftleft(key.cast("bigint"), 4) + number


def draw_int(key: Column, seed: int, label: str, low: int, high: int) -> Column:
    """Uniform whole number between ``low`` and ``high``, both included."""
    return F.lit(low) + (draw(key, seed, label) % (high - low + 1)).cast("int")


def draw_decimal(key: Column, seed: int, label: str, low: float, high: float, places: int) -> Column:
    """Uniform number with a fixed number of decimal places, both ends included."""
    scale = 10**places
    first, last = round(low * scale), round(high * scale)
    return (F.lit(first) + draw(key, seed, label) % (last - first + 1)).cast("double") / scale


def pick(key: Column, seed: int, label: str, values: list) -> Column:
    """One value of a list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), draw_int(key, seed, label, 1, len(values)))


def orderings(values: list[str], most: int) -> list[tuple[str, ...]]:
    """Every way to draw ``most`` different values one after another; meant for short lists."""
    return list(itertools.permutations(values, most))


def pick_some(key: Column, seed: int, label: str, values: list[str], most: int) -> Column:
    """Between none and ``most`` different values of a short list, in random order."""
    ways = orderings(values, most)
    choices = F.array(*[F.array(*map(F.lit, way)) for way in ways])
    drawn = F.element_at(choices, draw_int(key, seed, label, 1, len(ways)))
    return F.slice(drawn, 1, draw_int(key, seed, f"{label}.count", 0, most))


def days_before(key: Column, seed: int, label: str, base_date: str, low: int, high: int) -> Column:
    """Text of a date ``low`` to ``high`` days before a base date."""
    return F.date_format(F.date_sub(F.lit(base_date).cast("date"), draw_int(key, seed, label, low, high)), "yyyy-MM-dd")


def filled(template: str, *values: Column) -> Column:
    """Text with each ``{}`` replaced by a value."""
    pieces = template.split("{}")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [value.cast("string"), F.lit(piece)]
    return F.concat(*parts)


def iso_text(moment: str) -> Column:
    """ISO text of a moment without zone, with microseconds."""
    return F.date_format(F.lit(moment).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
