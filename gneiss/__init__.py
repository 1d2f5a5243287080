"""gneiss: contract-first lakehouse operators written directly on Spark DataFrames."""

__version__ = "0.1.0"
