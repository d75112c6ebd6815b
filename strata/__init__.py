"""strata: layered-warehouse operators (landing, staging decode, vault, history,
marts, data quality) written as plain PySpark DataFrame functions."""

__version__ = "0.1.0"
