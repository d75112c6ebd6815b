"""Query plans over the driver's tables: each registered query is a function
(spark, sf_dir) -> DataFrame built from the operators, with an equivalent
ANSI SQL text for an independent engine in ``strata.plans.oracle``."""
