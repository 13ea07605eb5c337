"""Rule-based risk analytics for card transactions, written as Spark DataFrame plans."""

from cardlens.config import RuleConfig
from cardlens.plans.scoring import score_transactions

__all__ = ["RuleConfig", "score_transactions"]
