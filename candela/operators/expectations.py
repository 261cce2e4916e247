"""Abort-on-violation expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from candela.session import move, remove


class ExpectationError(ValueError):
    """A table was not published; ``counts`` has its rows and the violations of each expectation."""

    def __init__(self, path: str, counts: dict[str, int]):
        super().__init__(f"not published: {path}: {counts}")
        self.counts = counts


def publish(df: DataFrame, path: str, expectations: list[tuple[str, str]]) -> dict[str, int]:
    """Write a table whole or not at all. The rows go to a folder beside ``path``; their number (``n_rows``) and the violations of each
    expectation are observed by the write itself, so nothing is read twice. Without violations the folder becomes ``path`` (an earlier
    table there is replaced); otherwise it is removed and :class:`ExpectationError` raised, and the earlier table stays. A rule that is NULL counts as violated."""
    spark, beside = df.sparkSession, f"{path.rstrip('/')}.unpublished"
    seen = Observation()
    failed = [F.count_if(~F.coalesce(F.expr(f"({p})"), F.lit(False))).alias(n) for n, p in expectations]
    df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *failed).write.mode("overwrite").parquet(beside)
    counts = {k: int(v) for k, v in seen.get.items()} or dict.fromkeys(["n_rows", *(n for n, _ in expectations)], 0)
    if any(counts[n] for n, _ in expectations):
        remove(spark, beside)
        raise ExpectationError(path, counts)
    move(spark, beside, path)
    return counts


def expect_or_fail(df: DataFrame, expectations: list[tuple[str, str]]) -> DataFrame:
    """Fail the job on the first row that violates any expectation.

    The check is a filter predicate (``raise_error`` inside a projected but unused column would
    be pruned away by the optimizer); it is evaluated per row in the same codegen stage, so it
    works for batch and streaming and costs no extra pass.
    """
    cond = None
    for name, pred in expectations:
        bad = ~F.coalesce(F.expr(f"({pred})"), F.lit(False))
        check = F.when(bad, F.raise_error(F.lit(f"expectation '{name}' violated: {pred}")))
        cond = check if cond is None else cond.when(bad, F.raise_error(F.lit(f"expectation '{name}' violated: {pred}")))
    return df.filter(cond.otherwise(F.lit(True)))


def count_violations(df: DataFrame, expectations: list[tuple[str, str]]) -> dict[str, int]:
    """Violation counts per expectation in one pass (a single global aggregate)."""
    row = df.agg(*[F.count_if(~F.coalesce(F.expr(f"({p})"), F.lit(False))).alias(n)
                   for n, p in expectations]).first()
    return row.asDict()
