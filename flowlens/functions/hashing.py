"""The one-hash bitmap offset of the approximate unique-visitor job.

The reference folds ``h = h * seed + code(char)`` over the string in 32-bit
wrapping arithmetic and keeps the low ``bits`` bits.  Because 2**bits divides
2**32, masking after every step gives the same low bits, so the fold fits in
a bigint and stays a JVM-side higher-order expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference job: hash seed 61, bitmap of 2**30 bits.
DEFAULT_SEED = 61
DEFAULT_BITS = 30


def poly_hash(c: Column, seed: int = DEFAULT_SEED, bits: int = DEFAULT_BITS) -> Column:
    mask = (1 << bits) - 1
    chars = F.split(c.cast("string"), "")
    return F.aggregate(
        chars, F.lit(0).cast("long"),
        lambda acc, ch: (acc * seed + F.ascii(ch).cast("long")).bitwiseAND(F.lit(mask)),
    )
