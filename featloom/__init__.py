"""featloom: feature building and binary classification as PySpark DataFrame operators."""

__version__ = "0.1.0"
