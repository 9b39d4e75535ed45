"""volspark: option-chain and volatility-surface analytics as PySpark DataFrame operators."""

__version__ = "0.1.0"
