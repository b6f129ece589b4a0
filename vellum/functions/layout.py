"""Geometry of lines, overlaps, and differences between neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.sources.tables import in_order


def left_indent() -> Column:
    return F.when(F.col("ncols") == 1, F.col("line_x0")).when(F.col("ncols") == 2, F.col("line_x0") - F.col("block_x0")).otherwise(0)


def right_space() -> Column:
    return F.when(F.col("ncols") == 1, F.col("page_width") - F.col("line_x1")).when(F.col("ncols") == 2, F.col("block_x1") - F.col("line_x1")).otherwise(0)


def extracted_class() -> Column:
    """Table before header before footer; null for lines that are none."""
    return F.when(F.col("is_table"), 5).when(F.col("is_header"), 6).when(F.col("is_footer"), 7)


def dice(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Twice the common area by the sum of the areas of two boxes (x0, y0, x1, y1)."""
    zero = F.lit(0)
    wide = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), zero)
    high = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), zero)
    total = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1])
    return F.when(total > 0, 2 * wide * high / total).otherwise(0.0)


def apart_vertically(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return (a1 < b0) | (b1 < a0)


def change(c: Column, other: Column) -> Column:
    """1 where a value differs from its neighbour's, or there is none."""
    return F.coalesce((c != other).cast("int"), F.lit(1))


def ternary(c: Column, other: Column, threshold: float = 0.0) -> Column:
    """0 if both lack or are equal within the threshold, 1 if one lacks, else the sign of the difference."""
    return (
        F.when(c.isNull() & other.isNull(), 0).when(c.isNull() | other.isNull(), 1)
        .when(c > other + threshold, 1).when(c < other - threshold, -1).otherwise(0)
    )


def deviation(values: Column) -> Column:
    """The deviation of an array's values but nulls, taken in their order by the steps of the SQL engine (Welford's):
    values that lie on an edge fall on the side that its rounding gives them. Null if there are none."""

    def step(state: Column, v: Column) -> Column:
        x, n = v.cast("double"), state["n"] + 1
        mean = state["mean"] + (x - state["mean"]) / n
        return F.struct(n.alias("n"), mean.alias("mean"), (state["d"] + (x - state["mean"]) * (x - mean)).alias("d"))

    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("d"))
    known = F.filter(values, lambda v: v.isNotNull())
    return F.aggregate(known, start, step, lambda state: F.when(state["n"] > 0, F.sqrt(state["d"] / state["n"])))


def binned(df: DataFrame, features: list[str], key: str = "doc_id", order: str = "pdf_idx") -> DataFrame:
    """Nine bins around each feature's mean in its document, as <feature>_binned.

    One aggregation gives means, deviations and the smallest code of each feature, and is joined on the key that the
    rows are dealt by. Null takes the bin of the mean; a constant or missing feature takes bin 4."""
    steps = (-2.0, -1.0, -0.5, -0.125, 0.125, 0.5, 1.0, 2.0)

    def code(v: Column, f: str) -> Column:
        m, s = F.col(f"_m_{f}"), F.col(f"_s_{f}")
        out = F.lit(8)
        for i, k in reversed(list(enumerate(steps))):
            out = F.when(v <= m + k * s, i).otherwise(out)
        return F.when(v.isNotNull(), out)

    rows = F.sort_array(F.collect_list(F.struct(order, *features)))
    stats = df.groupBy(key).agg(rows.alias("_rows"), *(F.avg(f).alias(f"_m_{f}") for f in features), *(F.min(f).alias(f"_l_{f}") for f in features))
    stats = stats.withColumns({f"_s_{f}": deviation(F.col("_rows")[f]) for f in features})
    # the smallest value has the smallest code
    stats = stats.withColumns({f"_l_{f}": code(F.col(f"_l_{f}"), f) for f in features}).drop("_rows")
    joined = df.join(stats, key)

    def final(f: str) -> Column:
        flat = F.col(f"_s_{f}").isNull() | (F.col(f"_s_{f}") < 1e-10)
        raw = F.coalesce(code(F.col(f), f), code(F.col(f"_m_{f}"), f)) - F.col(f"_l_{f}")
        return F.when(flat, 4).otherwise(F.greatest(F.lit(0), F.least(F.lit(8), raw))).cast("int")

    return joined.select(*df.columns, *(final(f).alias(f"{f}_binned") for f in features))


def spaces() -> dict[str, Column]:
    """Distances to the lines before and after; none at page edges or where not positive."""
    above = F.col("line_y0") - F.lag("line_y0").over(in_order())
    below = F.lead("line_y0").over(in_order()) - F.col("line_y0")
    same_above, same_below = F.lag("page").over(in_order()) == F.col("page"), F.lead("page").over(in_order()) == F.col("page")
    return {"space_above": F.when(same_above & (above > 0), above), "space_below": F.when(same_below & (below > 0), below)}


def reading_order(df: DataFrame) -> DataFrame:
    """block_order of each line on its page: runs of overlapping x-centres from left to right, by y inside."""
    from pyspark.sql import Window

    page = Window.partitionBy("doc_id", "page").orderBy("x_mid", "pdf_idx")
    df = df.withColumn("x_mid", (F.col("line_x0") + F.col("line_x1")) / 2)
    reach = F.max("line_x1").over(page.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_new", F.coalesce((F.col("line_x0") > reach).cast("int"), F.lit(0)))
    df = df.withColumn("island", F.sum("_new").over(page.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    inside = Window.partitionBy("doc_id", "page").orderBy("island", "line_y0", "pdf_idx")
    return df.withColumn("block_order", F.row_number().over(inside) - 1).drop("_new", "x_mid")


def column_number(x: Column, lo: Column, hi: Column, n: Column) -> Column:
    """How many of n + 1 evenly spaced column lines from lo to hi stand left of x; 0 where there is one column."""
    lines = F.transform(F.sequence(F.lit(0), n.cast("int")), lambda i: lo + i * (hi - lo) / n)
    return F.when(n == 1, 0).otherwise(F.size(F.filter(lines, lambda v: v < x))).cast("int")
