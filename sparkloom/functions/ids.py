"""Content-derived UUIDs as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the namespace of all ids.
NAMESPACE = "1170fe06-b0b0-4b95-8b7b-bb23f976da6f"


def uuid5(name: Column) -> Column:
    """UUID version 5 of a name in NAMESPACE; null for null. Runs inside generated code, no Python."""
    space = F.unhex(F.lit(NAMESPACE.replace("-", "")))
    h = F.sha1(F.concat(space, F.encode(name, "utf-8")))
    variant = F.substring(F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"), 1, 1)
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12),
    )


def stable_id(kind: str, *parts: Column) -> Column:
    """Id of a record of ``kind``: the parts joined by pipes. Null if any part is null."""
    joined = [F.lit(kind)]
    for p in parts:
        joined += [F.lit("|"), p.cast("string")]
    name = F.concat(*joined)
    return F.when(name.isNotNull(), uuid5(name))


def stable_id_sql(kind: str, *parts: str) -> str:
    """The same expression in DuckDB's SQL."""
    name = " || '|' || ".join([f"'{kind}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    h = f"sha1(unhex('{NAMESPACE.replace('-', '')}') || encode({name}))"
    return (
        f"(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
        f"translate(substr({h},17,1),'0123456789abcdef','89ab89ab89ab89ab') || substr({h},18,3) || '-' || substr({h},21,12))"
    )
