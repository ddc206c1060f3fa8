"""Cube schema roles and driver-side naming rules.

Everything here works on column *names* (``df.columns``) and never touches
data, except :func:`find_totals`, which runs one single-row aggregate.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's conventions)
# ---------------------------------------------------------------------------
# standard dimension columns
STANDARD_DIMS = ("GEO", "AAR", "ALDER", "KJONN", "UTDANN", "INNVKAT", "LANDBAK")
# dimensions read as numbers; all other dimensions are strings
NUMERIC_DIMS = ("GEO", "KJONN", "UTDANN", "INNVKAT", "LANDBAK")
# columns that are neither dimensions nor measures
MISC_COLS = ("origgeo", "GEOniv", "KOMMUNE", "WEIGHTS")
# suppression bookkeeping columns, excluded from measures
SUPPRESSION_PATTERN = r"^pvern$|^serieprikket$|^naboprikket"
# column renames applied when a cube is read
RENAME = {
    "antall": "TELLER",
    "Crude": "RATE",
    "Adjusted": "MEIS",
    "FLx": "MEIS",
    "smr": "SMR",
    "Utdanningsnivå": "UTDANN",
}
# first available column wins
TELLER_PRIORITY = ("sumTELLER_uprikk", "sumTELLER", "TELLER_uprikk", "TELLER")
NEVNER_PRIORITY = ("sumNEVNER_uprikk", "sumNEVNER", "NEVNER_uprikk", "NEVNER")
OUTLIER_PRIORITY = ("MEIS", "RATE", "SMR", "MALTALL")
DIFFVAL_PRIORITY = ("MEIS_diff", "RATE_diff", "SMR_diff")
# cube id: NAME_YYYY-MM-DD-hh-mm with optional .csv
CUBE_ID_PATTERN = r".*_\d{4}-\d{2}-\d{2}-\d{2}-\d{2}(\.csv)?$"
DATETAG_PATTERN = r"\d{4}-\d{2}-\d{2}-\d{2}-\d{2}"
# ---------------------------------------------------------------------------


def col(name: str):
    """Column reference safe for names with dots or spaces (``RATE.n``)."""
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class CubeSpec:
    """Configuration that the reference kept in global options."""

    dims: tuple[str, ...] = STANDARD_DIMS
    numeric_dims: tuple[str, ...] = NUMERIC_DIMS
    rename: dict = field(default_factory=lambda: dict(RENAME))
    misc_cols: tuple[str, ...] = MISC_COLS
    age_dim: str = "ALDER"
    geo: str = "GEO"
    period: str = "AAR"
    flag: str = "SPVFLAGG"

    @property
    def string_dims(self) -> tuple[str, ...]:
        return tuple(d for d in self.dims if d not in self.numeric_dims)

    def with_dims(self, *extra: str) -> "CubeSpec":
        return CubeSpec(dims=self.dims + tuple(d for d in extra if d not in self.dims),
                        numeric_dims=self.numeric_dims, rename=self.rename,
                        misc_cols=self.misc_cols)


DEFAULT_SPEC = CubeSpec()


@dataclass(frozen=True)
class ColumnRoles:
    """Result of :func:`identify_coltypes` (P1): the reference's 11 lists."""

    dims_new: list
    vals_new: list
    dims_old: list | None = None
    vals_old: list | None = None
    commondims: list | None = None
    commonvals: list | None = None
    commoncols: list | None = None
    newdims: list | None = None
    expdims: list | None = None
    newvals: list | None = None
    expvals: list | None = None


def _columns(cube) -> list[str]:
    return list(cube.columns) if isinstance(cube, DataFrame) else list(cube)


def _roles_one(cols: list[str], spec: CubeSpec) -> tuple[list, list]:
    dims = [c for c in cols if c in spec.dims]
    skip = set(dims) | set(spec.misc_cols) | {c for c in cols if re.search(SUPPRESSION_PATTERN, c)}
    vals = [c for c in cols if c not in skip]
    return dims, vals


def identify_coltypes(cube_new, cube_old=None, spec: CubeSpec = DEFAULT_SPEC) -> ColumnRoles:
    """Dimension and measure columns of one or two cubes (schema only)."""
    if cube_new is None:
        raise ValueError("cube_new must be provided")
    new_cols = _columns(cube_new)
    dims_new, vals_new = _roles_one(new_cols, spec)
    if cube_old is None:
        return ColumnRoles(dims_new=dims_new, vals_new=vals_new)
    dims_old, vals_old = _roles_one(_columns(cube_old), spec)
    commondims = [d for d in dims_new if d in dims_old]
    commonvals = [v for v in vals_new if v in vals_old]
    return ColumnRoles(
        dims_new=dims_new, vals_new=vals_new, dims_old=dims_old, vals_old=vals_old,
        commondims=commondims, commonvals=commonvals, commoncols=commondims + commonvals,
        newdims=[d for d in dims_new if d not in dims_old],
        expdims=[d for d in dims_old if d not in dims_new],
        newvals=[v for v in vals_new if v not in vals_old],
        expvals=[v for v in vals_old if v not in vals_new],
    )


def _first(candidates, available) -> str | None:
    available = set(available)
    for c in candidates:
        if c in available:
            return c
    return None


def select_teller_pri(columns) -> str | None:
    """Best numerator column."""
    return _first(TELLER_PRIORITY, columns)


def select_nevner_pri(columns) -> str | None:
    """P5: best denominator column."""
    return _first(NEVNER_PRIORITY, columns)


def select_outlier_pri(cube_new, cube_old=None, roles: ColumnRoles | None = None,
                       spec: CubeSpec = DEFAULT_SPEC) -> str | None:
    """Value used for outlier detection, from common measures when an old cube exists."""
    if cube_new is None:
        raise ValueError("cube_new must be provided")
    roles = roles or identify_coltypes(cube_new, cube_old, spec)
    pool = roles.vals_new if cube_old is None else roles.commonvals
    return _first(OUTLIER_PRIORITY, pool)


def select_diffval_pri(columns) -> str | None:
    """Best difference column of a comparison cube."""
    return _first(DIFFVAL_PRIORITY, columns)


# ----------------------------------------------------------------- totals

def find_totals(cube: DataFrame, dims, spec: CubeSpec = DEFAULT_SPEC) -> dict:
    """P8 for several dimensions at once with ONE single-row aggregate.

    Total level of a dimension: 0 when present; for the age dimension the
    band ``min(lower)_max(upper)`` when that band exists; else None.
    """
    dims = [d for d in dims if d in cube.columns]
    if not dims:
        return {}
    row = cube.agg(*_total_aggs(dims, spec)).collect()[0].asDict()
    return _totals_of(row, cube, dims, spec)


def _total_aggs(dims, spec: CubeSpec) -> list:
    """Aggregates that tell the total level of each dimension; none of them gathers levels."""
    aggs = []
    for d in dims:
        if d == spec.age_dim:
            lo, hi = (F.regexp_extract(col(d), r"^(\d*)_(\d*)$", k).try_cast("bigint") for k in (1, 2))
            plain = col(d) == F.concat_ws("_", lo.cast("string"), hi.cast("string"))
            # of the bands that begin first, the one that ends last
            widest = F.min(F.when(plain, F.struct(lo.alias("lo"), (-hi).alias("hi"))))
            aggs += [F.min(lo).alias(f"{d}__lo"), F.max(hi).alias(f"{d}__hi"), widest.alias(f"{d}__widest")]
        else:
            is_zero = col(d).cast("string").try_cast("double") == F.lit(0.0)
            aggs.append(F.max(F.when(is_zero, 1).otherwise(0)).alias(f"{d}__zero"))
    return aggs


def _totals_of(row: dict, cube: DataFrame, dims, spec: CubeSpec) -> dict:
    """The total level of each dimension (None without one) from a row of :func:`_total_aggs`."""
    out = {}
    for d in dims:
        if d == spec.age_dim:
            lo, hi, widest = row.get(f"{d}__lo"), row.get(f"{d}__hi"), row.get(f"{d}__widest")
            out[d] = f"{lo}_{hi}" if widest is not None and (widest["lo"], -widest["hi"]) == (lo, hi) else None
        else:
            out[d] = _typed_zero(cube, d) if row.get(f"{d}__zero") == 1 else None
    return out


@dataclass(frozen=True)
class CubeProfile:
    """Data facts that decide a plan's shape, from ONE single-row job."""

    totals: dict
    n_periods: int
    n_rows: int | None = None
    # upper bound of the rows of one stratum (level + dimensions but area and
    # period): with a unique cube key a stratum holds at most one row per
    # (area, period), and never more than the cube
    stratum_bound: int | None = None
    # upper bound of the distinct (dimension, level) pairs of ``dims`` (the
    # level-key table of the level joins), NULL counted as a level
    level_bound: int | None = None
    # upper bound of the strata; twice the estimate, as small municipalities
    # become a level of their own
    strata_bound: int | None = None


def _profile_aggs(cube: DataFrame, dims, spec: CubeSpec):
    aggs = _total_aggs(dims, spec)
    if spec.period in cube.columns:
        # two distinct periods exist iff min != max (NULL counts as a level)
        p = col(spec.period)
        aggs += [F.min(p).alias("__pmin"), F.max(p).alias("__pmax"),
                 F.max(F.when(p.isNull(), 1).otherwise(0)).alias("__pnull")]
    for d in dims:
        aggs.append(F.approx_count_distinct(col(d), _HLL_RSD).alias(f"{d}__nd"))
    aggs.append(F.count(F.lit(1)).alias("__n"))
    # HyperLogLog buffers are fixed-size and merged map-side
    strata = [c for c in dims if c not in (spec.geo, spec.period)] + (["GEOniv"] if "GEOniv" in cube.columns else [])
    if strata:
        aggs.append(F.approx_count_distinct(F.xxhash64(*[col(c) for c in strata]), _HLL_RSD).alias("__nst"))
    for d, name in ((spec.geo, "__ngeo"), (spec.period, "__nper")):
        if d in cube.columns:
            aggs.append(F.approx_count_distinct(col(d), _HLL_RSD).alias(name))
    return aggs


# 5% relative error keeps the HyperLogLog buffers small (512 registers); the
# bounds only choose a plan, so the 5-sigma margin (25%) is harmless
_HLL_RSD = 0.05


def _profile_parse(row: dict, cube: DataFrame, dims, spec: CubeSpec) -> CubeProfile:
    totals = _totals_of(row, cube, dims, spec)
    n_periods = 0
    if spec.period in cube.columns:
        if row.get("__pmin") is None:
            n_periods = 1 if row.get("__pnull") else 0
        else:
            n_periods = (1 if row["__pmin"] == row["__pmax"] else 2) + (1 if row.get("__pnull") else 0)
    n_rows = row.get("__n")

    def up(x):
        # five standard deviations of the estimate as margin (+1 for NULL)
        return int(x * (1 + 5 * _HLL_RSD)) + 2
    bound = n_rows
    if n_rows is not None and row.get("__ngeo") is not None and row.get("__nper") is not None:
        bound = min(n_rows, up(row["__ngeo"]) * up(row["__nper"]))
    level_bound = sum(up(row.get(f"{d}__nd") or 0) for d in dims)
    if n_rows is not None:
        level_bound = min(level_bound, n_rows * max(len(dims), 1))
    return CubeProfile(totals=totals, n_periods=min(n_periods, 2), n_rows=n_rows, stratum_bound=bound,
                       level_bound=level_bound,
                       strata_bound=2 * up(row["__nst"]) if row.get("__nst") is not None else 2)


def profile_cube(cube: DataFrame, dims, spec: CubeSpec = DEFAULT_SPEC) -> CubeProfile:
    """Totals of ``dims`` and whether the cube has 1 or >= 2 periods, in one job."""
    return profile_cubes([(cube, dims)], spec)[0]


def profile_cubes(items, spec: CubeSpec = DEFAULT_SPEC) -> list[CubeProfile]:
    """:func:`profile_cube` for several cubes in ONE job: each cube's single
    row is encoded as JSON and the rows are unioned before the collect."""
    import json
    items = [(c, [d for d in dims if d in c.columns]) for c, dims in items]
    parts = [c.agg(F.to_json(F.struct(*_profile_aggs(c, dims, spec))).alias("__p"))
             .select(F.lit(i).alias("__i"), "__p") for i, (c, dims) in enumerate(items)]
    u = parts[0]
    for p_ in parts[1:]:
        u = u.unionByName(p_)
    rows = {r["__i"]: json.loads(r["__p"]) for r in u.collect()}
    return [_profile_parse(rows[i], c, dims, spec) for i, (c, dims) in enumerate(items)]


def find_total(cube: DataFrame, dim: str, spec: CubeSpec = DEFAULT_SPEC):
    """Total level of one dimension (see :func:`find_totals`)."""
    return find_totals(cube, [dim], spec).get(dim)


def _typed_zero(cube: DataFrame, d: str):
    t = cube.schema[d].dataType.simpleString()
    if t == "string":
        return "0"
    if t in ("double", "float") or t.startswith("decimal"):
        return 0.0
    return 0


# ------------------------------------------------------------ rounding (P10)

#: Decimals of the columns whose name holds a measure's.
ROUNDING = {"SPVFLAGG": 0, "RATE.n": 0, "TELLER": 1, "NEVNER": 1, "RATE": 2, "SMR": 2, "MEIS": 2}
#: Ends of the names of fence columns, and their decimals; quantiles end in wq and two digits.
FENCE_ENDS, FENCE_DIGITS = ("MIN", "MAX", "LOW", "HIGH"), 2
#: The mark of a ratio of new to old, and its decimals, which counts take as well.
RATIO, RATIO_DIGITS = "_reldiff", 2
COUNTS = ("TELLER", "NEVNER")


def rounding_digits(name: str, spec: CubeSpec = DEFAULT_SPEC) -> int | None:
    """P10: decimals of the publication rounding for a column, the fewest that apply.

    Dimensions and columns of no known measure are not rounded (None).
    """
    if name in spec.dims:
        return None
    ratio = RATIO in name
    fence = name.endswith(FENCE_ENDS) or (name[-4:-2] == "wq" and name[-2:].isdigit())
    digits = [d for measure, d in ROUNDING.items() if measure in name and not (ratio and measure in COUNTS)]
    digits += [FENCE_DIGITS] * fence + [RATIO_DIGITS] * ratio
    return min(digits, default=None)


# ------------------------------------------------------------ cube ids

def get_cubename(filename: str) -> str:
    """The file name up to its date tag; without one, up to its extension."""
    stem = filename.removeprefix("QC_")
    tag = re.search("_" + DATETAG_PATTERN, stem)
    return stem[:tag.start()] if tag else stem.removesuffix(".csv").removesuffix(".parquet")


def get_cubedatetag(filename: str) -> str:
    m = re.search(DATETAG_PATTERN, filename)
    return m.group(0) if m else filename


def get_cubefilename(filename: str) -> str:
    return f"{get_cubename(filename)}_{get_cubedatetag(filename)}"


def check_readfiles_args(cube_new, cube_old=None, recode_new=False, recode_old=False,
                         comparecube=True, outliers=True) -> None:
    """Validate cube ids and switches before any data is read."""
    if cube_new is None or not re.match(CUBE_ID_PATTERN, cube_new):
        raise ValueError("cube_new must be provided in the format FILENAME_YYYY-MM-DD-hh-mm")
    if cube_old is not None and not re.match(CUBE_ID_PATTERN, cube_old):
        raise ValueError("cube_old must be None or provided in the format FILENAME_YYYY-MM-DD-hh-mm")
    for name, v in (("recode_new", recode_new), ("recode_old", recode_old),
                    ("comparecube", comparecube), ("outliers", outliers)):
        if not isinstance(v, bool):
            raise TypeError(f"{name} must be True/False")
