"""Binned historical priors: equal-frequency edges, bin assignment, the
per-cell positive fraction table, its complete grid, lookups and draws.

Exact quantile edges at scale: the value column is aggregated to
(value, count) rows, running counts come from ``prefix_sum_by_range`` (no
single-partition window), and only the order statistics the edges need are
filtered out (at most 2 per edge).  This is exact, equal to numpy's
linear-interpolated ``interp`` over the sorted column and to
``quantile_cont`` in SQL."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.param import Params
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..util import col_of, dense_number, hash_uniform, kept_table, prefix_sum_by_range
from .stages import Configured, FittedModel, param, to_bool, to_int, to_list, to_str

# Largest number of columns of the pivoted matrix (their names come to the driver).
MAX_DOMAIN = 10_000


def edge_probs(n: int, n_bins: int) -> list[float]:
    """Quantile levels of the n_bins+1 equal-frequency edges of n points:
    position n*k/n_bins of the sorted values, clamped to the last point."""
    if n < 2:
        return [0.0] * (n_bins + 1)
    return [min(1.0, n * k / (n_bins * (n - 1))) for k in range(n_bins + 1)]


def exact_quantiles(df: DataFrame, col: str, probs) -> list[float]:
    """Exact linear-interpolated quantiles of a column (nulls ignored),
    computed on the executors.  ``probs`` is a list of levels, or a function
    of the non-null count returning them (levels that depend on n)."""
    x = F.col(col).cast("double")
    counts = kept_table(df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("c")), "value-counts")
    n = counts.agg(F.sum("c")).first()[0] or 0
    levels = probs(n) if callable(probs) else list(probs)
    if n == 0:
        return [None] * len(levels)
    ranks = sorted({r for p in levels for r in _ranks(p, n)})
    cum = prefix_sum_by_range(counts, "v", {"cum": "c"}, kept=True)
    # value at 0-based rank r: the row with cum - c <= r < cum
    cond = F.exists(F.array(*[F.lit(r) for r in ranks]),
                    lambda r: (F.col("cum") - F.col("c") <= r) & (r < F.col("cum")))
    hits = cum.where(cond).select("v", "c", "cum").collect()   # <= 2 * len(levels) rows

    def at(r):
        for h in hits:
            if h["cum"] - h["c"] <= r < h["cum"]:
                return h["v"]
        raise AssertionError(r)
    out = []
    for p in levels:
        pos = p * (n - 1)
        lo = int(pos)
        frac = pos - lo
        v_lo = at(lo)
        out.append(v_lo if frac == 0 else v_lo + frac * (at(min(lo + 1, n - 1)) - v_lo))
    return out


def _ranks(p: float, n: int) -> tuple[int, int]:
    pos = p * (n - 1)
    lo = int(pos)
    return lo, min(lo + 1, n - 1)


def equal_freq_edges(df: DataFrame, col: str, n_bins: int = 5) -> list[float]:
    """n_bins+1 equal-frequency edges of ``col``."""
    return exact_quantiles(df, col, lambda n: edge_probs(n, n_bins))


def bin_assign(x, edges: list[float]) -> Column:
    """Bin number: bins are (a, b], the lowest one also taking everything at
    or below its upper edge, the last one everything above.  Repeated edges
    are dropped first, so the bin count can shrink.  A null value has no bin (null)."""
    inner = sorted(set(edges))[1:-1]
    if not inner:
        return F.when(col_of(x).isNotNull(), F.lit(0))
    arr = F.array(*[F.lit(float(e)) for e in inner])
    return F.when(col_of(x).isNotNull(), F.size(F.filter(arr, lambda e: e < col_of(x).cast("double")))).cast("int")


def _domain(df: DataFrame, col: str) -> list:
    vals = [r[0] for r in df.select(col).distinct().limit(MAX_DOMAIN + 1).collect()]
    if len(vals) > MAX_DOMAIN:
        raise ValueError(f"{col}: more than {MAX_DOMAIN} distinct values for a column each; use prior_entries")
    return sorted(vals, key=lambda v: (v is None, v))


def _domain_table(table: DataFrame, key: str, values: list | None) -> DataFrame:
    """Distinct values of a key (null is one), or the given ones, as a table."""
    kind = table.schema[key].dataType
    if values is None:
        return table.select(key).distinct()
    return table.sparkSession.createDataFrame([(v,) for v in values], T.StructType([T.StructField(key, kind)]))


def complete_grid(table: DataFrame, keys: list[str], fill: dict | None = None,
                  domains: dict[str, list] | None = None) -> DataFrame:
    """Every combination of the key values present (or of the given
    ``domains``); cells missing from ``table`` get 0 (or ``fill``).

    Each domain is numbered on the executors; the cells are the numbers of one ``range`` over the product of the
    domains' sizes, split over all tasks, and are decoded as mixed-radix numbers whose digits are joined back to the
    values.  No domain comes to the driver or into one row, and no sets are joined pairwise."""
    domains, spark = domains or {}, table.sparkSession
    numbered = {k: dense_number(_domain_table(table, k, domains.get(k)), [k], f"__i_{k}", "grid-domain") for k in keys}
    sizes = {k: t.count() for k, t in numbered.items()}
    grid, radix = spark.range(math.prod(sizes.values())), 1
    for k in reversed(keys):
        grid = grid.withColumn(f"__i_{k}", F.expr(f"id div {radix}L % {max(sizes[k], 1)}L"))
        radix *= max(sizes[k], 1)
    for k in keys:
        grid = grid.join(numbered[k], f"__i_{k}").drop(f"__i_{k}")
    grid = grid.drop("id")
    held = table.withColumnsRenamed({c: f"__k_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in keys])
    out = grid.join(held, same, "left").drop(*[f"__k_{c}" for c in keys])
    fills = fill or {c: 0 for c in table.columns if c not in keys}
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


class _PriorsParams(Params):
    discrete = param("discrete", "discrete keys", to_list)
    continuous = param("continuous", "keys that are cut into equal-frequency bins", to_list)
    label = param("label", "0/1 label", to_str)
    n_bins = param("n_bins", "bins of each continuous key", to_int)
    complete = param("complete", "whether combinations of known values that have no rows count as seen, with 0", to_bool)

    @property
    def keys(self) -> list[str]:
        return self.value("discrete") + [f"{c}_bin" for c in self.value("continuous")]

    def keyed(self, df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
        return df.withColumns({f"{c}_bin": bin_assign(c, edges[c]) for c in self.value("continuous")})


class Priors(_PriorsParams, Configured, Estimator):
    """fit: equal-frequency edges for each continuous column, then per
    (discrete..., bins...) cell: total, positives (``target``) and
    ``target_fraction`` (0 when empty).  The model's ``grid()`` adds the missing
    combinations with zeros; scoring needs only the cells that have rows."""

    def __init__(self, discrete: list[str] | None = None, continuous: list[str] | None = None, label: str | None = None,
                 n_bins: int | None = None, complete: bool | None = None):
        super().__init__()
        self._setDefault(discrete=[], continuous=[], n_bins=5, complete=True)
        self._given(discrete=discrete, continuous=continuous, label=label, n_bins=n_bins, complete=complete)

    def _fit(self, df: DataFrame) -> "PriorsModel":
        edges = {c: equal_freq_edges(df, c, self.value("n_bins")) for c in self.value("continuous")}
        table = self.keyed(df, edges).groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(col_of(self.value("label")).cast("long")).alias("target"))
        table = table.withColumn("target_fraction", F.coalesce(F.try_divide(F.col("target"), F.col("total")), F.lit(0.0)))
        return PriorsModel(self, {"edges": edges}, {"cells": kept_table(table, "priors")})


class PriorsModel(_PriorsParams, FittedModel):
    @property
    def table(self) -> DataFrame:
        """The cells that have rows."""
        return self.tables["cells"]

    @property
    def edges(self) -> dict[str, list[float]]:
        return self.state["edges"]

    def grid(self) -> DataFrame:
        """All combinations of the key values, cells without rows with zeros."""
        bins = {f"{c}_bin": list(range(len(set(e)) - 1 or 1)) for c, e in self.edges.items()}
        return complete_grid(self.table, self.keys, {"total": 0, "target": 0, "target_fraction": 0.0}, bins)

    def _transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prior_p``, ``prior_q`` = 1 - p and ``prior_missing`` (p = 0): a key combination unseen at fit or,
        with ``complete``, one with a value unseen at fit."""
        keys = self.keys
        k = self.keyed(df, self.edges)
        t = self.table.select(*keys, F.col("target_fraction").alias("__p"), F.lit(True).alias("__seen"))
        t = t.withColumnsRenamed({c: f"__k_{c}" for c in keys})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in keys])
        j = k.join(t, same, "left").drop(*[f"__k_{c}" for c in keys])   # a null key is a category of its own
        missing = F.col("__seen").isNull()
        if self.value("complete"):
            known = []
            for c in self.value("discrete"):
                values = self.table.select(F.col(c).alias("__v"), F.lit(True).alias(f"__in_{c}")).distinct()
                j = j.join(values, F.col(c).eqNullSafe(F.col("__v")), "left").drop("__v")
                known.append(F.col(f"__in_{c}").isNotNull())
            known += [F.col(f"{c}_bin").isNotNull() for c in self.value("continuous")]
            missing = missing & ~reduce(lambda a, b: a & b, known, F.lit(True))
        return (j.withColumns({"prior_p": F.coalesce(F.col("__p"), F.lit(0.0)), "prior_missing": missing})
                .withColumn("prior_q", 1 - F.col("prior_p"))
                .drop("__p", "__seen", *[f"__in_{c}" for c in self.value("discrete")]))


def prior_draw(df: DataFrame, p: str, id_col: str, seed: int = 0, out: str = "prior_draw") -> DataFrame:
    """Bernoulli draw with probability ``p``, reproducible: uniform from the
    md5 of (id, seed)."""
    return df.withColumn(out, (hash_uniform(id_col, seed=seed) < F.col(p)).cast("int"))


def prior_matrix(table: DataFrame, k0: str, k1: str, value: str = "target_fraction",
                 k1_values: list | None = None) -> DataFrame:
    """Two-key table as a matrix: one row per k0, one column per k1 value
    (explicit, size-checked pivot values, in sorted order)."""
    vals = k1_values if k1_values is not None else _domain(table, k1)
    return table.groupBy(k0).pivot(k1, vals).agg(F.first(value)).orderBy(k0)


def prior_entries(table: DataFrame, k0: str, k1: str, value: str = "target_fraction") -> DataFrame:
    """Two-key table as a sparse matrix for any number of values: (row, col, k0, k1, value) for each cell present, rows
    and columns numbered from 0 in the order of their keys."""
    rows = dense_number(table.select(k0).distinct(), [k0], "row", "matrix-rows").withColumnRenamed(k0, "__k0")
    cols = dense_number(table.select(k1).distinct(), [k1], "col", "matrix-cols").withColumnRenamed(k1, "__k1")
    cells = table.groupBy(k0, k1).agg(F.first(value).alias(value))
    return (cells.join(rows, F.col(k0).eqNullSafe(F.col("__k0"))).join(cols, F.col(k1).eqNullSafe(F.col("__k1")))
            .select("row", "col", k0, k1, value))
