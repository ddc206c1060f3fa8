"""Reusable Column expressions (JVM-side, codegen friendly; no Python UDFs)."""

from cubeguard.functions.exprs import (  # noqa: F401
    any_abs_above, geo_label, geo_level_from_code, parent_name, qc_round, round_half_even,
)
from cubeguard.functions.quantile import (  # noqa: F401
    order_statistics, passes_for, select_values, weighted_fences, weighted_quantiles,
)
