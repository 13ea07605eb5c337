"""End-to-end plans: scoring, data preparation, the daily batch."""
