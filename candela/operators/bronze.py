"""Bronze: one raw table from the archive route and the live route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela import schemas as S


def conform(df: DataFrame) -> DataFrame:
    """Bronze column order; columns a route lacks become NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in S.BRONZE_COLUMNS])


def unify(*routes: DataFrame) -> DataFrame:
    """UNION ALL by name (no de-duplication here; that is the upsert's job). Works on streams."""
    out = None
    for r in routes:
        out = r if out is None else out.unionByName(r, allowMissingColumns=True)
    return conform(out)
