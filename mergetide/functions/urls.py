"""Links to records of other systems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ui_origin(base: Column) -> Column:
    """Scheme and host of a base address, without the host's part "api"; null for what is no address."""
    host = F.regexp_replace(F.regexp_replace(F.parse_url(base, F.lit("HOST")), r"\.api\.", "."), r"^api\.", "")
    return F.concat(F.parse_url(base, F.lit("PROTOCOL")), F.lit("://"), host)


def link(origin: Column, path: str, **parts: Column) -> Column:
    """A link by a path with {names}, each replaced by the part of that name, encoded; null where the origin or a part is null or empty."""
    out = F.concat(F.nullif(origin, F.lit("")), F.lit(path))
    for name, value in parts.items():
        # A space is "%20" within a path.
        out = F.replace(out, F.lit("{" + name + "}"), F.replace(F.url_encode(F.nullif(value, F.lit(""))), F.lit("+"), F.lit("%20")))
    return out
