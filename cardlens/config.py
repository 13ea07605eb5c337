"""Rule parameters."""

from __future__ import annotations

from dataclasses import dataclass

from cardlens.sources.scratch import BROADCAST_ROWS


@dataclass(frozen=True)
class RuleConfig:
    """Every threshold, weight and cut used by the scoring rules.

    ``card_keys`` names the columns that identify a card. The default groups by
    ``card_id`` alone; sources where ``card_id`` is only an index within a user
    should pass ``("user_id", "card_id")``.
    """

    # Calibrated defaults of the three rules and of the score.
    amount_limit: float = 300.0
    amount_std_factor: float = 3.0
    velocity_max: int = 130
    odd_hour_start: int = 0
    odd_hour_end: int = 5
    odd_hour_quantile: float = 0.90
    weight_amount: float = 2.0
    weight_velocity: float = 1.0
    weight_odd_hour: float = 1.0
    high_cut: float = 3.0
    medium_cut: float = 1.5

    card_keys: tuple[str, ...] = ("card_id",)

    # "exact" interpolates between the two neighbouring amounts; "approx" uses a
    # sketch whose rank error is 1 / quantile_accuracy.
    quantile_mode: str = "exact"
    quantile_accuracy: int = 10_000

    # What the rules learn from the data is stored before it is applied. ``lazy`` leaves
    # it in the plan of the result: fewer jobs, but a heavy card cannot be split, and the
    # exact quantile gathers the distinct amounts in one task. The rows are the same.
    lazy: bool = False
    # What was learnt is broadcast up to so many rows and joined by shuffle beyond.
    broadcast_rows: int = BROADCAST_ROWS
