"""International-development statistics as tidy Spark tables."""

from devdata_spark.errors import (
    DataExtractionError,
    DataFormattingError,
    DataValidationError,
)
from devdata_spark.plans import debt, food, hdi, health, hiv, indicators, outlook, trade

__all__ = [
    "DataExtractionError",
    "DataFormattingError",
    "DataValidationError",
    "debt",
    "food",
    "hdi",
    "health",
    "hiv",
    "indicators",
    "outlook",
    "trade",
]
