"""Named data-quality rules and NULL-safe routing to clean / quarantine."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela import schemas as S


@dataclass(frozen=True)
class RuleSet:
    """Ordered (name, SQL predicate) pairs. Rules are data: add or replace without touching code.

    A rule that evaluates to NULL counts as failed, so every row lands in exactly one of the
    two routes (clean + quarantine = input).
    """
    rules: tuple = field(default_factory=lambda: tuple(S.KLINE_RULES))

    def with_rule(self, name: str, predicate: str) -> "RuleSet":
        return RuleSet(tuple(r for r in self.rules if r[0] != name) + ((name, predicate),))

    def _holds(self, predicate: str) -> Column:
        return F.coalesce(F.expr(f"({predicate})"), F.lit(False))

    def passed(self) -> Column:
        out = None
        for _, p in self.rules:
            out = self._holds(p) if out is None else out & self._holds(p)
        return out

    def failed(self) -> Column:
        return ~self.passed()

    def first_failed(self) -> Column:
        out = None
        for name, p in self.rules:
            cond = ~self._holds(p)
            out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
        return out

    def all_failed(self) -> Column:
        return F.array_compact(F.array(*[F.when(~self._holds(p), F.lit(n)) for n, p in self.rules]))

    # -- routes ---------------------------------------------------------------------------
    def valid(self, staged: DataFrame) -> DataFrame:
        """Rows that pass every rule. A filter drops NULL as it drops false, so the plain predicates do, and reach the scan."""
        return staged.filter(" AND ".join(f"({p})" for _, p in self.rules)) if self.rules else staged

    def quarantine(self, staged: DataFrame, stamp: Column | None = None) -> DataFrame:
        """Rows failing any rule, with the first failed rule, all failed rules and a stamp."""
        return (staged.filter(self.failed())
                      .withColumns({
                          "quarantine_ts": stamp if stamp is not None else F.current_timestamp(),
                          "failed_rule": self.first_failed(),
                          "failed_rules": self.all_failed(),
                      }))

    def tag(self, staged: DataFrame) -> DataFrame:
        """One pass, both routes: ``is_valid`` plus the failure columns (NULL / empty when valid).

        Used by sinks that write both tables from a single read of the input.
        """
        return staged.withColumns({
            "is_valid": self.passed(),
            "failed_rule": self.first_failed(),
            "failed_rules": self.all_failed(),
        })


KLINE_RULES = RuleSet()

# Optional, off by default: NULL open or volume (unreadable or overflowing text) is not covered by
# the three rules above and would otherwise reach the clean table.
COMPLETE_MEASURES = ("complete_measures", "open IS NOT NULL AND volume IS NOT NULL")
STRICT_KLINE_RULES = KLINE_RULES.with_rule(*COMPLETE_MEASURES)


def failure_summary(quarantine: DataFrame) -> DataFrame:
    """Count of quarantined rows per first failed rule (map-side partial count, tiny shuffle)."""
    return quarantine.groupBy("failed_rule").agg(F.count(F.lit(1)).alias("n_rows"))
