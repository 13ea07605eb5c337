"""Column names and types of the source, raw and curated zones."""

from __future__ import annotations

# Source header to canonical column name.
SOURCE_TO_CANONICAL = {
    "User": "user_id",
    "Card": "card_id",
    "Year": "year",
    "Month": "month",
    "Day": "day",
    "Time": "time",
    "Amount": "amount",
    "Use Chip": "use_chip",
    "Merchant Name": "merchant_id",
    "Merchant City": "merchant_city",
    "Merchant State": "merchant_state",
    "MCC": "mcc",
    "Is Fraud?": "is_fraud",
}
SOURCE_COLUMNS = tuple(SOURCE_TO_CANONICAL)

# Canonical column to type.
TRANSACTION_TYPES = {
    "user_id": "bigint",
    "card_id": "bigint",
    "year": "int",
    "month": "int",
    "day": "int",
    "time": "string",
    "amount": "double",
    "use_chip": "string",
    "merchant_id": "bigint",
    "merchant_city": "string",
    "merchant_state": "string",
    "mcc": "int",
    "is_fraud": "int",
}

# Calendar columns that partition the raw and curated zones.
DAY_COLUMNS = ("year", "month", "day")

# Flag columns of the three rules, in report order.
RULE_COLUMNS = ("r1_amount_anomaly", "r2_velocity", "r4_odd_hour")

# Risk levels from worst to best.
RISK_LEVELS = ("HIGH", "MEDIUM", "LOW")
