"""Design matrices: named feature blocks joined on id.

A specification such as ``topo+area+curve`` names blocks.  A block is a list of
named expressions over the tables; what it needs of a table is noted, each table is
reduced to one row an id once (tables by index are pivoted in one aggregate for all
indices), joined to the canonical ids by a left join, and the expressions follow in
one projection.  So an id without a row is seen by them as a row of nulls, and
nothing depends on physical order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflux.functions.indices import INDICES
from gridflux.functions.semantics import circular, safe_log10
from gridflux.operators.stats import STATS, array_stats, contrasts

# Fixed values.
LSP_METRICS = "sos pos eos vsos vpos veos los msp mau vmsp vmau ampl ios rog ros sw trough mos".split()
DOY_METRICS = ("sos", "pos", "eos", "msp", "mau", "trough")
QC_METRICS = ("degenerate_px_frac", "aseasonal_frac", "strength_median", "anchor_circ_sd")
TOPO_VARS = "elevation slope northness eastness heat_load tpi tri curvature".split()
STRATA = ("cover", "counts", "presence", "basal")
CONTEXT_SPEC, MAP_CONTEXT_SPEC = "topo+area", "topo_ctr+area"
AGGREGATES = ("median", "mean", "trimmed", "center")


@dataclass
class Tables:
    """Inputs by role, each keyed by ``id`` (curves also by ``index`` and ``px``, lsp by
    ``index``).  Options: px (pixel level), aggregate (of cube columns), circular
    (days of the year also as sine and cosine), steps (of curves)."""

    plots: DataFrame
    curves: DataFrame | None = None
    lsp: DataFrame | None = None
    topo: DataFrame | None = None
    cube: DataFrame | None = None
    climate: DataFrame | None = None
    options: dict = field(default_factory=dict)

    def need(self, name: str) -> DataFrame:
        table = getattr(self, name)
        if table is None:
            raise FileNotFoundError(f"block needs the table {name}, which isn't there")
        return table


def step_columns(columns: list[str]) -> list[str]:
    """s00, s01, … in the order of their numbers; an error if there are none."""
    found = sorted((c for c in columns if c[:1] == "s" and c[1:].isdigit()), key=lambda c: int(c[1:]))
    if not found:
        raise ValueError("no step columns")
    return found


def _index(index: str | None) -> str:
    if index is None:
        raise ValueError("this block needs an index")
    return index


Block = list[tuple[str, Column]]


class Frame:
    """What the blocks of a specification need of the tables; joined once each."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.parts: dict[str, set[str]] = {}

    def of(self, table: str, column: str) -> Column:
        """A column of a table with one row an id."""
        self.tables.need(table)
        self.parts.setdefault(table, set())
        return F.col(f"{table}__{column}")

    def by_index(self, table: str, index: str, column: str) -> Column:
        """A column of a table's row for an index."""
        self.tables.need("curves" if table == "stats" else table)
        self.parts.setdefault(table, set()).add(index)
        return F.col(f"{table}__{index}")[column]

    def _wide(self, table: str, indices: list[str]) -> DataFrame:
        t = self.tables
        rows = t.need("lsp") if table == "lsp" else t.need("curves").where(F.col("px") == t.options.get("px", "mean5x5"))
        rows = rows.where(F.col("index").isin(*indices))
        if table == "stats":
            rows = array_stats(rows.select("id", "index", "curve"), ["id", "index"])
        one = F.struct(*(F.col(c) for c in rows.columns if c not in ("id", "index")))
        return rows.groupBy("id").agg(*(F.first(F.when(F.col("index") == i, one), True).alias(f"{table}__{i}") for i in indices))

    def joined(self) -> DataFrame:
        t = self.tables
        out = t.plots.select("id", *(F.col(c).alias(f"plots__{c}") for c in t.plots.columns if c != "id"))
        for table, indices in self.parts.items():
            if indices:
                part = self._wide(table, sorted(indices))
            elif table != "plots":
                df = t.need(table)
                part = df.select("id", *(F.col(c).alias(f"{table}__{c}") for c in df.columns if c != "id"))
            else:
                continue
            out = out.join(part, "id", "left")
        return out


def lsp_block(f: Frame, index: str | None, centre: bool = False, prefix: str = "") -> Block:
    end = "" if centre else "_mean5x5"
    value = {m: f.by_index("lsp", _index(index), m + end).cast("double") for m in LSP_METRICS}
    out = [(f"{prefix}lsp_{m}{end}", v) for m, v in value.items()]
    if f.tables.options.get("circular", False):
        out += [(f"{prefix}lsp_{m}_{name}", c) for m in DOY_METRICS for name, c in zip(("sin", "cos"), circular(value[m]), strict=True)]
    return out


def curve_block(f: Frame, index: str | None, prefix: str = "") -> Block:
    curve = f.by_index("curves", _index(index), "curve")
    return [(f"{prefix}curve_s{k:02d}", F.get(curve, F.lit(k))) for k in range(f.tables.options.get("steps", 52))]


def qc_block(f: Frame, index: str | None) -> Block:
    of = lambda c: f.by_index("lsp", _index(index), c)
    winter = F.coalesce((of("phase_group").cast("string") == "winter_peaking").cast("double"), F.lit(0.0))
    return [*((f"qc_{c}", of(c).cast("double")) for c in QC_METRICS), ("qc_order_coherent", of("order_coherent").cast("double")), ("qc_is_winter_peaking", winter)]


def topo_block(f: Frame, centre: bool = False) -> Block:
    """An id without topography counts as flat, as one without a heat load does."""
    names = list(TOPO_VARS) if centre else [f"{v}_{s}" for v in TOPO_VARS for s in ("mean", "std")]
    flat = f.of("topo", "heat_load" if centre else "heat_load_mean").isNull().cast("double")
    return [*((f"topo_{n}", f.of("topo", n).cast("double")) for n in names), ("topo_topo_flat", flat)]


def area_block(f: Frame) -> Block:
    dummies = [(f"area_stratum_{s}", F.coalesce((f.of("plots", "stratum") == s).cast("double"), F.lit(0.0))) for s in STRATA[1:]]
    return [("area_log10", safe_log10(f.of("plots", "area_m2"))), *dummies]


def coords_block(f: Frame) -> Block:
    return [("geo_lon", f.of("plots", "lon").cast("double")), ("geo_lat", f.of("plots", "lat").cast("double")), ("geo_elevation", f.of("topo", "elevation_mean").cast("double"))]


def composite(f: Frame, index: str | None, prefix: str = "") -> Block:
    return [(f"{prefix}comp_{s}", f.by_index("stats", _index(index), s)) for s in STATS]


def contrast(f: Frame) -> Block:
    of = lambda i: (f.by_index("stats", i, "mean"), f.by_index("stats", i, "cv"))
    return [pair for a, b in combinations(INDICES, 2) for pair in contrasts(a, b, of(a), of(b))]


def _family(f: Frame, starts: str, prefix: str) -> Block:
    """Cube columns by name pattern and the chosen aggregate, whose name goes."""
    ends = "_" + f.tables.options.get("aggregate", "median")
    names = [c.removesuffix(ends) for c in f.tables.need("cube").columns if c.endswith(ends)]
    names = [c for c in names if c.startswith(starts)]
    if not names:
        raise ValueError(f"no columns {starts}*{ends}")
    return [(prefix + c, f.of("cube", c + ends)) for c in names]


def spread_block(f: Frame) -> Block:
    names = [c for c in f.tables.need("cube").columns if c.startswith(("gm_", "obs_", "seas_")) and c.endswith(("_sd", "_cv"))]
    return [("svh_" + c, f.of("cube", c)) for c in names]


def climate_block(f: Frame) -> Block:
    return [(c, f.of("climate", c)) for c in f.tables.need("climate").columns if c != "id"]


def _all(one: Callable[..., Block]) -> Callable[[Frame, str | None], Block]:
    """A block over all indices, each prefixed with its name."""
    return lambda f, _: [pair for i in INDICES for pair in one(f, i, prefix=f"{i}_")]


BLOCKS: dict[str, Callable[[Frame, str | None], Block]] = {
    "lsp": lsp_block,
    "lsp_ctr": lambda f, i: lsp_block(f, i, centre=True),
    "lsp_all": _all(lsp_block),
    "curve": curve_block,
    "curve_all": _all(curve_block),
    "qc": qc_block,
    "topo": lambda f, i: topo_block(f),
    "topo_ctr": lambda f, i: topo_block(f, centre=True),
    "area": lambda f, i: area_block(f),
    "coords": lambda f, i: coords_block(f),
    "year": lambda f, i: [("year", f.of("plots", "year").cast("double"))],
    "composite": composite,
    "composite_all": _all(composite),
    "contrast": lambda f, i: contrast(f),
    "gm": lambda f, i: _family(f, "gm_", "gmA_"),
    "obscomp": lambda f, i: _family(f, f"obs_{i}_" if i else "obs_", "oc_"),
    "obscomp_all": lambda f, i: _family(f, "obs_", "oc_"),
    "seas": lambda f, i: _family(f, f"seas_{i}_" if i else "seas_", "sea_"),
    "seas_all": lambda f, i: _family(f, "seas_", "sea_"),
    "clim": lambda f, i: climate_block(f),
    "svh": lambda f, i: spread_block(f),
}


def parse_spec(spec: str) -> list[str]:
    names = [x.strip() for x in spec.split("+") if x.strip()]
    unknown = [x for x in names if x not in BLOCKS]
    if unknown or not names:
        raise ValueError(f"unknown blocks {unknown or spec!r}")
    return names


def build_design(t: Tables, spec: str, index: str | None = None) -> DataFrame:
    """(id, features): a row for each canonical id, nulls where a block has none."""
    frame = Frame(t)
    columns = [pair for name in parse_spec(spec) for pair in BLOCKS[name](frame, index)]
    names = [n for n, _ in columns]
    twice = sorted({c for c in names if names.count(c) > 1})
    if twice:
        raise ValueError(f"columns come twice: {twice[:5]}")
    return frame.joined().select("id", *(c.alias(n) for n, c in columns))
