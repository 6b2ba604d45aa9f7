"""Where the tables of one set of statements lie."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class StatementPaths:
    source: str
    bronze: str
    silver: str
    gold: str
    checkpoint: str
    quality_log: str
    merchant_rules: str

    @classmethod
    def under(cls, base: str, source: str) -> StatementPaths:
        """The usual places below one folder. The stream's checkpoint is beside its table."""
        base = base.rstrip("/")
        return cls(
            source=source,
            bronze=f"{base}/bronze/transactions",
            silver=f"{base}/silver/transactions",
            gold=f"{base}/gold",
            checkpoint=f"{base}/checkpoints",
            quality_log=f"{base}/gold/quality_log",
            merchant_rules=f"{base}/silver/merchant_rules",
        )

    @property
    def monthly(self) -> str:
        return f"{self.gold}/monthly_by_category"

    @property
    def stability(self) -> str:
        return f"{self.gold}/fixed_vs_variable"

    @property
    def recurring(self) -> str:
        return f"{self.gold}/recurring"
