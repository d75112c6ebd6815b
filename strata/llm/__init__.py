"""Operators for training-data pipelines.  Nothing else in the library imports
this subpackage; ``strata.llm.queries`` registers its queries."""
