"""Column functions that stay inside the JVM: identities, ranks, fingerprints, domains, counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts joined by the unit separator; a null part counts as empty."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def hash_rank(key: Column, salt: str = "") -> Column:
    """A uniform rank in [0, 1) from the leading 64 bits of a salted SHA-256."""
    salted = F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string")
    return F.conv(F.substring(F.sha2(salted, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def domain(url: Column) -> Column:
    """Lower-case host without its port, outer dots and one leading www.; 'unknown' without a host."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    bare = F.regexp_replace(F.btrim(host, F.lit(".")), "^www\\.", "")
    return F.when(bare == "", F.lit("unknown")).otherwise(bare)


def wilson(hits: Column, total: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """The Wilson 95 % interval of a share to four places, null for no trials."""
    p, n = hits / total, total.cast("double")
    middle, spread, scale = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)), 1 + z * z / n
    clamped = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))
    return tuple(F.when(total > 0, F.round(clamped((middle + s * spread) / scale), 4)) for s in (-1, 1))
