"""Random draws computed from row keys.

A draw depends on its key, a salt and the seed, and on nothing else: repartitioning, retries and
lost executors leave it unchanged, which rand(seed) does not promise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(1 << 52)
DRAWS_PER_DIGEST = 8


def _text(key: Column, salt: str, seed: Column | int) -> Column:
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    return F.concat_ws(":", key.cast("string"), F.lit(salt), seed.cast("string"))


def _hex_number(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def uniform(key: Column, salt: str, seed: Column | int) -> Column:
    """Uniform on [0, 1) with 52 bits."""
    return _hex_number(F.md5(_text(key, salt, seed)), 1, 13) / F.lit(_SCALE)


def rank_draw(key: Column, salt: str, seed: Column | int) -> Column:
    """The same draw as ``uniform`` in hex: sorts like the number, and no number is parsed."""
    return F.substring(F.md5(_text(key, salt, seed)), 1, 13)


def normal(key: Column, salt: str, seed: Column | int) -> Column:
    """Standard normal by the Box-Muller formula on two uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(key, salt + "/r", seed)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(key, salt + "/a", seed))


def draw_digest(key: Column, block: Column, seed: int) -> Column:
    """A SHA-256 in hex: ``DRAWS_PER_DIGEST`` draws of 32 bits."""
    return F.sha2(F.concat_ws(":", key.cast("string"), block.cast("string"), F.lit(str(seed))), 256)


def digest_draw(digest: Column, i: int) -> Column:
    """The ``i``-th draw of a digest, an eight-digit hex text."""
    return F.substring(digest, 1 + 8 * i, 8)


def poisson_cuts(rate: float = 1.0) -> list[str]:
    """Cut points of the Poisson distribution function as eight-digit hex texts.

    They end where the function is 1 to 32 bits.
    """
    cuts, mass, total = [], math.exp(-rate), 0.0
    while (total := total + mass) * (1 << 32) < (1 << 32) - 1:
        cuts.append(f"{int(total * (1 << 32)):08x}")
        mass *= rate / len(cuts)
    return cuts


def poisson_count(draw: Column, rate: float = 1.0) -> Column:
    """Poisson count of a hex draw by inverting the distribution function.

    Hex texts of one length sort like their numbers, so no number is parsed.
    """
    cuts = poisson_cuts(rate)
    if not cuts:
        return F.lit(0).cast("bigint")
    out = F.when(draw < cuts[0], 0)
    for k, cut in enumerate(cuts[1:], start=1):
        out = out.when(draw < cut, k)
    return out.otherwise(len(cuts)).cast("bigint")
