"""A1/A2: collapse dimensions of a cube."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.spec import DEFAULT_SPEC, CubeSpec, col, find_totals, identify_coltypes


def aggregate_cube(cube: DataFrame, dim: str, spec: CubeSpec = DEFAULT_SPEC,
                   total=..., ) -> DataFrame:
    """A1: collapse one dimension.

    When the dimension has a total level, the total rows are kept.  Otherwise
    rows are grouped by the other dimensions: measures whose name contains
    TELLER are summed (all NULL -> 0), the other measures except SPVFLAGG are
    averaged ignoring NULLs, the remaining columns take the value of the row
    with the lowest level of ``dim`` (deterministic "first row"), and ``dim``
    becomes the text "Total".  Partial aggregation happens map-side.
    """
    if dim == spec.period:
        raise ValueError(f"cannot aggregate on '{spec.period}'")
    if total is ...:
        total = find_totals(cube, [dim], spec).get(dim)
    if total is not None:
        return cube.where(col(dim).eqNullSafe(F.lit(total)))
    roles = identify_coltypes(cube, spec=spec)
    vals = [v for v in roles.vals_new if "SPVFLAGG" not in v]
    sums = [v for v in vals if "TELLER" in v]
    means = [v for v in vals if "TELLER" not in v]
    groupdims = [d for d in roles.dims_new if d != dim]
    rest = [c for c in cube.columns if c not in groupdims and c not in vals and c != dim]
    aggs = ([F.coalesce(F.sum(col(v).cast("double")), F.lit(0.0)).alias(v) for v in sums]
            + [F.avg(col(v).cast("double")).alias(v) for v in means]
            + [F.min_by(col(c), col(dim)).alias(c) for c in rest])
    out = cube.groupBy(*[col(d) for d in groupdims]).agg(*aggs).withColumn(dim, F.lit("Total"))
    return out.select(*[col(c) for c in cube.columns])


def aggregate_cube_multi(cube: DataFrame, dims, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """A2: fold A1 over ``dims`` in the given order (mean of means, T10).

    Totals of all dims are found with one profiling aggregate up front.
    """
    dims = list(dims)
    if not dims:
        return cube
    totals = find_totals(cube, dims, spec)
    out = cube
    for d in dims:
        out = aggregate_cube(out, d, spec, total=totals.get(d))
    return out
