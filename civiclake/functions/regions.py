"""Region of a federal unit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five regions and their federal units.
REGIONS = {
    "Norte": "AC AM AP PA RO RR TO",
    "Nordeste": "AL BA CE MA PB PE PI RN SE",
    "Centro-Oeste": "DF GO MS MT",
    "Sudeste": "ES MG RJ SP",
    "Sul": "PR RS SC",
}


def region_of(uf: str | Column) -> Column:
    """Region of a federal unit's code; NULL for an unknown code.  Literals, so no join."""
    c = F.col(uf) if isinstance(uf, str) else uf
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for region, units in REGIONS.items():
        out = out.when(c.isin(units.split()), region)
    return out
