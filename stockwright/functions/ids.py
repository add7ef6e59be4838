"""Name-based ids and repeatable rounding built on them."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import col

# The URL namespace of RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def digest(name) -> Column:
    """SHA-1 of namespace and name as hexadecimal digits."""
    return F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(col(name), "UTF-8")))


def uuid5(name) -> Column:
    """SHA-1 of namespace and name, cut to 32 digits, with the version digit 5 and the variant digit set.

    Written with few references to the digest, so that nested use stays small for the code generator.
    """
    shape = F.regexp_replace(digest(name), r"^(.{8})(.{4}).(.{3})(.{4})(.{12}).*$", "$1-$2-5$3-$4-$5")
    variant = F.translate(F.substring(shape, 20, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.overlay(shape, variant, 20)


def uuid5_mod(name, modulus: int = 1_000_000) -> Column:
    """The id as a 128-bit number modulo a small number, by Horner's rule over 32-bit words.

    Its words are cut from the digest, which is bound to a variable: written out, it would be worked out again for each word.
    """
    shift = (1 << 32) % modulus

    def number(digest: Column) -> Column:
        cut = lambda at, n: F.substring(digest, at, n)
        variant = F.translate(cut(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
        words = [cut(1, 8), F.concat(cut(9, 4), F.lit("5"), cut(14, 3)), F.concat(variant, cut(18, 7)), cut(25, 8)]
        total = F.lit(0).cast("bigint")
        for word in words:
            total = (total * F.lit(shift) + F.conv(word, 16, 10).cast("bigint")) % F.lit(modulus)
        return total

    return F.element_at(F.transform(F.array(digest(name)), number), 1)


def named_id(*parts) -> Column:
    """Id of the parts joined by colons, for example named_id("wh_in", day, shelf)."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return uuid5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def stochastic_round(x, key) -> Column:
    """Integer whose expectation is x, decided by the key; 0 for null, non-finite or non-positive x."""
    v = col(x).cast("double")
    whole = F.floor(v)
    draw = uuid5_mod(key).cast("double") / F.lit(1_000_000.0)
    usable = v.isNotNull() & ~F.isnan(v) & (v > 0) & (v < F.lit(float("inf")))
    return F.when(usable, whole + F.when(draw < v - whole, 1).otherwise(0)).otherwise(F.lit(0)).cast("int")
