"""Card-transaction risk analytics as plain Spark DataFrame functions."""

from cardvigil.config import RiskConfig

__all__ = ["RiskConfig"]
