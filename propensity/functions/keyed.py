"""Keyed randomness: draws that depend only on (row key, salt).

``u(key, salt)`` hashes ``"<key>:<salt>"`` with md5 and maps the first
``digits`` hex digits to (0, 1).  Results therefore do not depend on
partitioning, task retries or executor loss, and a plain SQL engine can
reproduce every draw.  ``F.rand(seed)`` depends on partition layout and is not
used anywhere.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def u(key, salt: str, digits: int = 8) -> Column:
    """Uniform (0, 1) from the first ``digits`` hex digits of md5(key:salt)."""
    if not 1 <= digits <= 13:
        raise ValueError("digits must be in 1..13 (52 bits fit a double exactly)")
    h = F.substring(F.md5(F.concat(_col(key).cast("string"), F.lit(f":{salt}"))), 1, digits)
    scale = float(16 ** digits)
    return (F.conv(h, 16, 10).cast("double") + F.lit(0.5)) / F.lit(scale)


def uniform(key, salt: str, low: float, high: float) -> Column:
    return F.lit(float(low)) + F.lit(float(high - low)) * u(key, salt)


def normal(key, salt1: str, salt2: str, sigma: float = 1.0) -> Column:
    """Normal(0, sigma) by Box-Muller on two keyed uniforms."""
    return (F.lit(float(sigma)) * F.sqrt(F.lit(-2.0) * F.log(u(key, salt1)))
            * F.cos(F.lit(2 * math.pi) * u(key, salt2)))


def lognormal(key, salt1: str, salt2: str, sigma: float = 1.0) -> Column:
    return F.exp(normal(key, salt1, salt2, sigma))


def hash_order(key, salt: str) -> Column:
    """Hex md5 of key:salt; a random but reproducible sort key."""
    return F.md5(F.concat(_col(key).cast("string"), F.lit(f":{salt}")))


def keyed_uniform(key, salt: str, digits: int = 8) -> float:
    """Driver-side twin of ``u`` for parameters (not data): same md5 rule."""
    h = hashlib.md5(f"{key}:{salt}".encode()).hexdigest()[:digits]
    return (int(h, 16) + 0.5) / float(16 ** digits)
