"""32-bit hashes as BIGINT column expressions: wrapping is done by masks, so ANSI overflow checks never fire."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF
#: Fixed values of the hash functions.
AP_START = 0xAAAAAAAA
RS_A, RS_B = 63689, 378551
GOLDEN = 2**0.5 - 1
UNSET = 2147483648


def signed32(c: Column) -> Column:
    """The value that the low 32 bits mean as a signed integer."""
    return ((c + F.lit(1 << 31)).bitwiseAND(MASK)) - F.lit(1 << 31)


def ap_hash(values: Column) -> Column:
    """Alternating shift hash of an array of unsigned values, unmasked 32 bits."""

    def step(s: Column, x: Column) -> Column:
        h, i = s["h"], s["i"]
        even = h.bitwiseXOR((F.shiftleft(h, 7).bitwiseXOR(x * F.shiftright(h, 3))).bitwiseAND(MASK))
        odd = h.bitwiseXOR((F.shiftleft(h, 11) + x).bitwiseXOR(F.shiftright(h, 5)).bitwiseAND(MASK).bitwiseXOR(MASK))
        return F.struct(F.when(i % 2 == 0, even).otherwise(odd).alias("h"), (i + 1).alias("i"))

    start = F.struct(F.lit(AP_START).cast("long").alias("h"), F.lit(0).alias("i"))
    return F.aggregate(values.cast("array<long>"), start, step, lambda s: s["h"])


def codes(text: Column) -> Column:
    """Code points of a string, in order."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))


def feature_hash(values: Column, bits: int = 31) -> Column:
    """ap_hash cut to its low bits, as features use it."""
    return ap_hash(values).bitwiseAND((1 << bits) - 1)


def rs_hash(values: Column) -> Column:
    """Multiplicative hash with a multiplier that grows from value to value."""

    def step(s: Column, x: Column) -> Column:
        # the product of two 32-bit values is taken in two halves to stay within 64 bits
        high = (F.shiftright(s["h"], 16) * s["a"]).bitwiseAND(0xFFFF)
        low = s["h"].bitwiseAND(0xFFFF) * s["a"]
        grown = (F.shiftleft(high, 16) + low + x).bitwiseAND(MASK)
        a = (F.shiftleft((F.shiftright(s["a"], 16) * RS_B).bitwiseAND(0xFFFF), 16) + s["a"].bitwiseAND(0xFFFF) * RS_B).bitwiseAND(MASK)
        return F.struct(grown.alias("h"), a.alias("a"))

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(RS_A).cast("long").alias("a"))
    return F.aggregate(values.cast("array<long>"), start, step, lambda s: s["h"])


def int_hash(key: Column, seed: Column | int) -> Column:
    """Seeded integer mix as a signed 32-bit value; negative results stay negative."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    k = F.floor((key.cast("long") * (seed.cast("long") + 1)).bitwiseAND(MASK) * F.lit(GOLDEN)).cast("long")
    k = signed32(k * 32768 - k - 1)
    k = k.bitwiseXOR(F.shiftright(k, 12))
    k = signed32(k * 5)
    k = k.bitwiseXOR(F.shiftright(k, 4))
    k = signed32(k * 2057)
    return k.bitwiseXOR(F.shiftright(k, 16))
