"""Many-to-many (fan-out) equi-joins on one key, with the hot keys split.

Several KPI grains are products per customer (subscriptions × surveys ×
overdue invoices).  A plain sort-merge join emits the whole product of one key
from one task, and AQE's skew handling cannot split the right side of a left
outer join, so a customer holding a third of the surveys would stall the job.

Nothing here runs a Spark job: the plans stay lazy.  Which keys are hot is
found by an explicit step (:func:`side_counts` and :func:`hot_keys`; for the
marts :func:`kpiloom.plans.marts.find_hot_customers`), saved, and handed to
:func:`fanout_join` as a frame.  Without it the join is the plain join.

With hot keys a join is two joins over disjoint rows:

* **Cold rows** (and null keys) are joined plainly.  Null keys match nothing;
  a salt in the join key spreads them, which the plain join cannot.
* **Hot rows** go through a grid.  A key with ``L`` left and ``R`` right rows is
  cut into up to ``ceil(L/hot_rows) × ceil(R/hot_rows)`` cells; a row takes a slice
  from a hash of its columns and is copied to the other side's slices, and the
  join runs on ``(key, left slice, right slice)``.  Cells of ``hot_rows²`` pairs
  would copy ``2/hot_rows`` rows for each pair, so a key has no more cells than
  ``_CELLS`` for each shuffle partition, or than cells of ``DEFAULT_HOT_ROWS²`` pairs
  (or of ``hot_rows²``, if that is more) take: copies then grow with the sides, not with
  their product.  Both sides are dealt out by an explicit
  ``repartition`` and the join is held to a sort-merge join: adaptive execution
  then neither merges cells into one task nor replaces the exchange by a
  broadcast of a small side, which would leave the cells where the key was.

Identical rows of a hot key are collapsed to counted pieces first, so a key
made of copies of one row spreads as well.  The slice is a hash of the row's
contents, so a recomputed partition lands in the same cells after an executor
loss.  The output is exactly the plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key on one side that one cell may hold: a cell, and a key below
# the threshold, emits at most 5,000² = 25M pairs from one task; a typical
# customer (tens of surveys, a few invoices) stays far below it.
DEFAULT_HOT_ROWS = 5_000

# Cells of one key for each shuffle partition, enough to fill them evenly.
_CELLS = 16

# Copies of one row that a piece may hold: two pieces that meet are repeated from an
# array with an entry for each of their pairs.
_PIECE_ROWS = 512

# Over how many join keys null-keyed rows are dealt out.
_NULL_SALTS = 1024


def side_counts(key: str, **sides: DataFrame) -> DataFrame:
    """Rows per (non-null) key of each named side, in one aggregation.

    The sides' key columns are tagged and unioned, so all counts come from a
    single partial + final aggregate (one shuffle of key columns only).
    """
    tagged = None
    for name, df in sides.items():
        part = df.filter(F.col(key).isNotNull()).select(key, F.lit(name).alias("_side"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key).agg(*[F.count_if(F.col("_side") == name).alias(name)
                                     for name in sides])


def hot_keys(counts: DataFrame, key: str, left_n: str, right_n: str,
             hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """``(key, _fj_lb, _fj_rb)``, the grid of every key with left rows and more than
    ``hot_rows`` rows on one side; ``left_n`` / ``right_n`` are SQL expressions over
    ``counts`` giving the rows per key of each side.  At most rows / hot_rows keys."""
    return (counts
            .selectExpr(key, f"{left_n} AS _fj_ln", f"COALESCE({right_n}, 0) AS _fj_rn")
            .filter(f"_fj_ln > 0 AND (_fj_ln > {hot_rows} OR _fj_rn > {hot_rows})")
            .selectExpr(key, f"CAST(ceil(_fj_ln / {hot_rows}) AS BIGINT) AS _fj_lb",
                        f"greatest(CAST(ceil(_fj_rn / {hot_rows}) AS BIGINT), 1L) AS _fj_rb"))


def _sized(hot: DataFrame, hot_rows: int, partitions: int) -> DataFrame:
    """The grids of ``hot`` with no more cells than spread a key, as square as they can be,
    and what a slice of either side holds (``_fj_ls_n``, ``_fj_rs_n``)."""
    cols = [f"`{c}`" for c in hot.columns if c not in ("_fj_lb", "_fj_rb")]
    most = max(hot_rows, DEFAULT_HOT_ROWS)
    pairs = f"(CAST(_fj_lb AS DOUBLE) * _fj_rb * {float(hot_rows) ** 2})"
    cells = f"least(CAST(_fj_lb AS DOUBLE) * _fj_rb, greatest({float(_CELLS * partitions)}, {pairs} / {float(most) ** 2}))"
    # cells of that number have as many rows a side as the other
    side = f"greatest(sqrt({pairs} / {cells}), {float(hot_rows)})"
    rb = f"greatest(CAST(ceil(_fj_rb * {float(hot_rows)} / {side}) AS BIGINT), 1L)"
    lb = f"greatest(CAST(least(_fj_lb, ceil({cells} / _fj_new_rb)) AS BIGINT), 1L)"
    return (hot.selectExpr("*", f"least(_fj_rb, {rb}) AS _fj_new_rb")
            .selectExpr("*", f"{lb} AS _fj_new_lb")
            .selectExpr(*cols, "_fj_new_lb AS _fj_lb", "_fj_new_rb AS _fj_rb",
                        *[f"least(greatest(CAST(ceil(_fj_{s}b * {float(hot_rows)} / _fj_new_{s}b) AS BIGINT), "
                          f"{hot_rows}L), {max(hot_rows, _PIECE_ROWS)}L) AS _fj_{s}s_n" for s in "lr"]))


def _pieces(df: DataFrame, size: str, copies: str, piece: str) -> DataFrame:
    """Identical rows as pieces of at most ``size`` copies, a column that depends on the key."""
    cols = [f"`{c}`" for c in df.columns]
    return (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_fj_c"))
            .selectExpr(*cols, "_fj_c", f"explode(sequence(0L, (_fj_c - 1) div {size})) AS {piece}")
            .selectExpr(*cols, piece, f"least({size}, _fj_c - {piece} * {size}) AS {copies}"))


def _grid(left: DataFrame, right: DataFrame, key: str, how: str, hot: DataFrame,
          hot_rows: int) -> DataFrame:
    """The join of the rows whose key is in ``hot``, in cells."""
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _sized(hot, hot_rows, partitions)

    def dealt(df, names, extra, size, copies, piece, own, other, own_slice, other_slice):
        cols = [f"`{c}`" for c in names]
        # pieces of one row go to one slice after the other
        return (_pieces(df, size, copies, piece)
                .selectExpr(*cols, *extra, copies,
                            f"pmod(pmod(xxhash64({', '.join(cols)}), {own}) + {piece}, {own}) AS {own_slice}",
                            f"explode(sequence(0L, {other} - 1)) AS {other_slice}")
                .repartition(partitions, key, "_fj_ls", "_fj_rs"))

    cells = [key, "_fj_ls", "_fj_rs"]
    lrows, rrows = left.join(hot, key), right.join(hot, key)
    # whether the key has any right row: an empty cell is no unmatched row then
    flag = []
    if how == "left":
        lrows = lrows.join(rrows.select(key, F.lit(True).alias("_fj_any")).distinct(), key, "left")
        flag = ["_fj_any"]
    lside = dealt(lrows, left.columns, flag, "_fj_ls_n", "_fj_lc", "_fj_lp", "_fj_lb", "_fj_rb", "_fj_ls", "_fj_rs")
    rside = dealt(rrows, right.columns, [], "_fj_rs_n", "_fj_rc", "_fj_rp", "_fj_rb", "_fj_lb", "_fj_rs", "_fj_ls")
    out_cols = left.columns + [c for c in right.columns if c != key]
    out = lside.join(rside.hint("merge"), cells, how)
    if how == "left":  # keys without right rows are padded in one column of cells
        out = out.filter("_fj_rc IS NOT NULL OR (_fj_any IS NULL AND _fj_rs = 0)")
    return (out.selectExpr(*[f"`{c}`" for c in out_cols],
                           "explode(sequence(1L, _fj_lc * COALESCE(_fj_rc, 1L))) AS _fj_k").drop("_fj_k"))


def fanout_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner",
                hot: DataFrame = None, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """``left.join(right, key, how)`` for ``how`` in {inner, left}; the keys of ``hot``
    (from :func:`hot_keys`, best saved before) go through the grid.

    Column names other than ``key`` must be distinct between the sides.  The
    counts behind ``hot`` only size the grid, so an estimate is fine.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"fanout_join supports inner and left joins, not {how!r}")
    if hot is None:
        return left.join(right, key, how)
    names = hot.select(key)
    out_cols = left.columns + [c for c in right.columns if c != key]
    if how == "left":  # the salt is part of the key from the first join on
        hashed = ", ".join(f"`{c}`" for c in left.columns)
        # zero for every key, but not as a literal: the optimiser would take that
        # out of the join key again
        on, zero = [key, "_fj_null"], F.xxhash64(key) % 1
        cold = left.withColumn("_fj_null", F.expr(
            f"IF(`{key}` IS NULL, 1 + pmod(xxhash64({hashed}), {_NULL_SALTS}), 0L)"))
        cold = (cold.join(names.withColumn("_fj_null", zero), on, "left_anti")
                .join(right.withColumn("_fj_null", zero), on, "left"))
    else:
        cold = left.filter(F.col(key).isNotNull()).join(names, key, "left_anti").join(right, key)
    return cold.select(*out_cols).unionByName(_grid(left, right, key, how, hot, hot_rows))
