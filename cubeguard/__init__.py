"""cubeguard: quality control of statistical data cubes on Apache Spark.

A cube is a DataFrame with dimension columns (area, period, sex, age band,
...) and measure columns (numerator, denominator, rate, ...).  Every check is
a lazy DataFrame-in / DataFrame-out operator built from Spark SQL expressions,
windows, joins and grouping, so it runs on the cluster and scales with it.

Layout
------
``spec``        column roles, measure priorities, totals, rounding policy
``functions``   reusable Column expressions and the weighted quantile
``sources``     cube readers, lookup builders, driver-table fixtures, sinks
``operators``   geography, levels, aggregation, flags, outliers and checks
``plans``       the comparison pipeline and the query registry
"""

from cubeguard.spec import CubeSpec, ColumnRoles, identify_coltypes  # noqa: F401

__version__ = "0.1.0"
