"""Dashboard / EDA cube over cleaned city incidents.

Every view is one aggregation over the (filter-pushed-down) incident table;
the outputs are tiny (years x hours, types x districts, ...), so the small
dense axes (months 1..12, hours 0..23, Monday..Sunday) are generated from
parameters and joined, never collected. Top-N choices use
(count desc, key asc) so ties are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskbeacon.functions.expr import side_by_side
from riskbeacon.functions.sample import seeded_sample

# --- fixed values: calendar axes -------------------------------------------
DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_ORDER = list(range(1, 13))
HOUR_ORDER = list(range(24))

C_TYPE, C_DIST, C_AREA, C_LOC = "Primary Type", "District", "Community Area", "Location Description"


def c(name: str) -> Column:
    return F.col(f"`{name}`")


# ------------------------------------------------------------------ G1 -----
def apply_filters(df: DataFrame, year_range=None, districts=None, crime_types=None,
                  arrest_filter: str = "All") -> DataFrame:
    """Year range, district IN, type IN, arrest All/Arrested Only/Not Arrested Only.
    Plain column predicates, so Parquet scans receive them as pushed filters."""
    out = df
    if year_range is not None:
        out = out.filter((c("Year") >= int(year_range[0])) & (c("Year") <= int(year_range[1])))
    if districts:
        out = out.filter(c(C_DIST).isin([int(x) for x in districts]))
    if crime_types:
        out = out.filter(c(C_TYPE).isin(list(crime_types)))
    if arrest_filter == "Arrested Only":
        out = out.filter(c("Arrest") == F.lit(True))
    elif arrest_filter == "Not Arrested Only":
        out = out.filter(c("Arrest") == F.lit(False))
    return out


# ------------------------------------------------------------------ G2 -----
def filter_domains(df: DataFrame) -> DataFrame:
    """(kind, value) rows: year_min, year_max, each district, each type. One
    scan: the years and both dimensions are grouping sets of one aggregation.
    Without rows both years are null."""
    spark = df.sparkSession
    rows = df.select(c("Year").alias("year"), c(C_DIST).cast("string").alias("district"), c(C_TYPE).alias("type"))
    # a row of nulls: there is a grand total even without rows
    none = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    rows = rows.unionByName(none)
    sets = rows.groupingSets([[], [F.col("district")], [F.col("type")]], "district", "type").agg(
        F.grouping("district").alias("no_district"), F.grouping("type").alias("no_type"),
        F.min("year").cast("string").alias("low"), F.max("year").cast("string").alias("high"))
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), F.col(value).alias("value"))
    dim = F.when(F.col("no_type") == 1, pair("district", "district")).otherwise(pair("type", "type"))
    total = (F.col("no_district") == 1) & (F.col("no_type") == 1)
    out = sets.select(total.alias("total"), F.explode(F.when(total, F.array(
        pair("year_min", "low"), pair("year_max", "high"))).otherwise(F.array(dim))).alias("r"))
    return out.filter(F.col("total") | F.col("r.value").isNotNull()).select("r.kind", "r.value")


# ------------------------------------------------------------------ G5-G8 --
def counts_by(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(c(col).alias(col)).agg(F.count(F.lit(1)).alias("count"))


def _axis(spark: SparkSession, name: str, values, dtype: str) -> DataFrame:
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"ord int, `{name}` {dtype}")


def dense_counts(spark: SparkSession, df: DataFrame, col: str) -> DataFrame:
    """Counts over a fixed axis (Month 1..12, Hour 0..23, DayOfWeek Mon..Sun),
    missing buckets = 0, with the axis position as ``ord``."""
    values, dtype = {"Month": (MONTH_ORDER, "int"), "Hour": (HOUR_ORDER, "int"),
                     "DayOfWeek": (DAY_ORDER, "string")}[col]
    axis = _axis(spark, col, values, dtype)
    cnt = df.groupBy(c(col).cast(dtype).alias(col)).agg(F.count(F.lit(1)).alias("count"))
    return (F.broadcast(axis).join(cnt, col, "left")
            .select("ord", col, F.coalesce("count", F.lit(0)).cast("long").alias("count")))


# ------------------------------------------------------------------ G3/G4 --
def kpis(df: DataFrame) -> DataFrame:
    """Total, distinct types, arrest rate %, distinct districts, latest year,
    top type (ties -> smallest name) and peak hour (ties -> earliest). One
    scan: the totals and three dimensions are grouping sets of one aggregation."""
    rows = df.select(c(C_TYPE).alias("t"), c(C_DIST).alias("d"), c("Hour").cast("int").alias("h"),
                     c("Arrest").cast("double").alias("arrest"), c("Year").cast("int").alias("year"))
    dims = ["t", "d", "h"]
    sets = rows.groupingSets([[], *[[F.col(k)] for k in dims]], *dims).agg(
        F.count(F.lit(1)).alias("n"), F.sum("arrest").alias("arrests"), F.count("arrest").alias("known"),
        F.max("year").alias("year"), *[(F.grouping(k) == 0).alias(f"by_{k}") for k in dims])
    total = ~(F.col("by_t") | F.col("by_d") | F.col("by_h"))

    def first(k: str) -> Column:
        return F.min_by(F.when(F.col(f"by_{k}"), F.col(k)), F.when(F.col(f"by_{k}"), F.struct(-F.col("n"), F.col(k))))

    def distinct(k: str) -> Column:
        return F.count(F.when(F.col(f"by_{k}"), F.col(k)))

    return sets.agg(
        F.coalesce(F.max(F.when(total, F.col("n"))), F.lit(0)).alias("total"),
        distinct("t").alias("n_types"),
        F.max(F.when(total, F.try_divide(F.col("arrests"), F.col("known")) * 100)).alias("arrest_rate_pct"),
        distinct("d").alias("n_districts"),
        F.max(F.when(total, F.col("year"))).alias("latest_year"),
        first("t").alias("top_type"), first("h").alias("peak_hour"))


def yoy(df: DataFrame) -> DataFrame:
    """Latest year count, previous calendar year count (year-1, not the
    previous row) and the delta / % (NULL when the previous year is missing
    or zero)."""
    y = df.groupBy(c("Year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    latest = y.agg(F.max("year").alias("latest_year"))
    cur = y.join(latest, y.year == latest.latest_year).select("latest_year", F.col("n").alias("latest_count"))
    prev = y.select((F.col("year") + 1).alias("latest_year"), F.col("n").alias("prev_count"))
    out = cur.join(prev, "latest_year", "left")
    ok = F.col("prev_count").isNotNull() & (F.col("prev_count") != 0)
    return out.select("latest_year", "latest_count", "prev_count",
                      F.when(ok, F.col("latest_count") - F.col("prev_count")).alias("yoy_delta"),
                      F.when(ok, (F.col("latest_count") - F.col("prev_count")) * 100.0 / F.col("prev_count"))
                      .alias("yoy_delta_pct"))


# ------------------------------------------------------------------ G9-G11 -
def pivot_counts(spark: SparkSession, df: DataFrame, row: str, colname: str) -> DataFrame:
    """Row x column count matrix with a fixed column axis, 0-filled."""
    values = {"Hour": HOUR_ORDER, "Month": MONTH_ORDER}[colname]
    p = (df.groupBy(c(row).alias(row)).pivot(colname, values).agg(F.count(F.lit(1))))
    p = p.fillna(0, subset=[str(v) for v in values])
    if row == "DayOfWeek":
        axis = _axis(spark, row, DAY_ORDER, "string")
        p = F.broadcast(axis).join(p, row, "left").fillna(0, subset=[str(v) for v in values])
    return p


# ------------------------------------------------------------------ G12 ----
def compare_series(spark: SparkSession, df: DataFrame, dim: str, values, view: str = "Monthly") -> DataFrame:
    """Counts for one or two values of ``dim`` per month, hour or year, absent
    buckets as 0; the years are those of ``df``. More values are an error."""
    vals = list(values)
    if not 1 <= len(vals) <= 2:
        raise ValueError(f"compare one or two values, not {len(vals)}")
    views = {"Monthly": ("Month", MONTH_ORDER), "Hourly": ("Hour", HOUR_ORDER), "Yearly": ("Year", None)}
    if view not in views:
        raise ValueError(f"view must be one of {sorted(views)}")
    axis_col, axis_vals = views[view]
    sub = df.filter(c(dim).isin(vals))
    if axis_vals is None:  # a row per year and value
        years = df.select(F.col("Year").cast("int").alias("bucket")).filter("bucket IS NOT NULL").distinct()
        grid = years.select(F.explode(F.array(*[F.lit(str(v)) for v in vals])).alias("value"), "bucket")
    else:
        grid = spark.createDataFrame([(str(v), int(a)) for v in vals for a in axis_vals], "value string, bucket int")
    cnt = sub.groupBy(c(dim).cast("string").alias("value"), c(axis_col).cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("count"))
    return (grid.join(cnt, ["value", "bucket"], "left")
            .select("value", "bucket", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


# ------------------------------------------------------------------ G13 ----
def outliers(series: DataFrame, x: str, y: str = "count", z_threshold: float = 2.0, max_points: int = 3) -> DataFrame:
    """Points with |z| >= threshold (population std; n >= 3; std > 0), the
    ``max_points`` largest |z| kept, plus the peak (first max). The series is
    a small aggregate (one row per bucket), so a global window is bounded."""
    w_all = Window.partitionBy()
    s = (series.withColumn("__n", F.count(F.lit(1)).over(w_all))
         .withColumn("__mean", F.avg(F.col(y).cast("double")).over(w_all))
         .withColumn("__std", F.stddev_pop(F.col(y).cast("double")).over(w_all)))
    s = s.withColumn("z", F.when((F.col("__n") >= 3) & (F.col("__std") > 0),
                                 (F.col(y) - F.col("__mean")) / F.col("__std")))
    cand = F.when(F.abs(F.col("z")) >= z_threshold, F.abs(F.col("z")))
    s = s.withColumn("__r", F.row_number().over(Window.orderBy(cand.desc_nulls_last(), F.col(x))))
    s = s.withColumn("is_outlier", cand.isNotNull() & (F.col("__r") <= max_points))
    s = s.withColumn("is_peak", F.row_number().over(Window.orderBy(F.col(y).desc(), F.col(x))) == 1)
    return s.filter(F.col("is_outlier") | F.col("is_peak")).select(x, y, "z", "is_outlier", "is_peak")


# ------------------------------------------------------------------ G15/16 -
def top_n(df: DataFrame, col: str, n: int = 15, order_by: str = "count") -> DataFrame:
    """Top-N values by count (ties by key), or the first N by key when
    ``order_by='id'`` (what the original community-area panel shows)."""
    cnt = counts_by(df, col)
    order = [F.col("count").desc(), F.col(col)] if order_by == "count" else [F.col(col)]
    return cnt.orderBy(*order).limit(int(n))


# ------------------------------------------------------------------ G17 ----
def map_sample(df: DataFrame, n: int = 50000, seed: int = 42, palette_size: int = 20, keys=None) -> DataFrame:
    """Seeded sample of at most n located points; view center = mean lat/lon
    of the sample; district -> palette index."""
    samp = seeded_sample(df.dropna(subset=["Latitude", "Longitude"]), n, seed, keys)
    center = samp.agg(F.avg("Latitude").alias("center_lat"), F.avg("Longitude").alias("center_lon"))
    pal = (samp.select(c(C_DIST).alias("__d")).distinct()
           .withColumn("palette_idx", (F.dense_rank().over(Window.orderBy("__d")) - 1) % palette_size))
    return (side_by_side(samp, center)
            .join(pal, c(C_DIST) == F.col("__d"), "left").drop("__d"))


# ------------------------------------------------------------------ G18 ----
def heat_grid(df: DataFrame, cell_deg: float = 0.01) -> DataFrame:
    return (df.dropna(subset=["Latitude", "Longitude"])
            .groupBy(F.floor(F.col("Latitude") / cell_deg).cast("long").alias("lat_cell"),
                     F.floor(F.col("Longitude") / cell_deg).cast("long").alias("lon_cell"))
            .agg(F.count(F.lit(1)).alias("count")))


# ------------------------------------------------------------------ G19/20 -
def arrests_by_year(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("Year").cast("int").alias("Year")).agg(
        F.count(F.lit(1)).alias("crimes"),
        F.count_if(c("Arrest") == F.lit(True)).alias("arrests"))


def largest_gap_year(df: DataFrame) -> DataFrame:
    a = arrests_by_year(df).withColumn("gap", F.col("crimes") - F.col("arrests"))
    return a.agg(F.min_by(F.struct("Year", "gap"), F.struct(-F.col("gap"), F.col("Year"))).alias("b"),
                 F.sum("arrests").alias("total_arrests")) \
        .select(F.col("b.Year").alias("gap_year"), F.col("b.gap").alias("gap"), "total_arrests")


# ------------------------------------------------------------------ G21 ----
def arrest_rate_by_type(df: DataFrame, n: int = 15) -> DataFrame:
    """Arrest rate per type; types without any arrest are dropped (their
    ratio is undefined in the original); top N and bottom N by rate."""
    r = df.groupBy(c(C_TYPE).alias(C_TYPE)).agg(
        F.count(F.lit(1)).alias("crimes"), F.count_if(c("Arrest") == F.lit(True)).alias("arrests"))
    r = r.filter(F.col("arrests") > 0).withColumn("arrest_rate", F.col("arrests") / F.col("crimes"))
    top = r.withColumn("__r", F.row_number().over(Window.orderBy(F.col("arrest_rate").desc(), c(C_TYPE))))
    bot = r.withColumn("__r", F.row_number().over(Window.orderBy(F.col("arrest_rate").asc(), c(C_TYPE))))
    return (top.filter(F.col("__r") <= n).withColumn("side", F.lit("top"))
            .unionByName(bot.filter(F.col("__r") <= n).withColumn("side", F.lit("bottom")))
            .withColumnRenamed("__r", "rank"))


# ------------------------------------------------------------------ G22/23 -
def arrest_share(spark: SparkSession, df: DataFrame, col: str) -> DataFrame:
    """Row-normalized arrest crosstab: share of arrested / not arrested per
    value; for Hour the axis is densified with zero shares."""
    g = df.groupBy(c(col).cast("int").alias(col)).agg(F.avg(c("Arrest").cast("double")).alias("arrest_true"))
    g = g.withColumn("arrest_false", F.lit(1.0) - F.col("arrest_true"))
    if col == "Hour":
        axis = _axis(spark, col, HOUR_ORDER, "int").drop("ord")
        g = F.broadcast(axis).join(g, col, "left").fillna(0.0, subset=["arrest_true", "arrest_false"])
    return g.select(col, "arrest_false", "arrest_true")


# ------------------------------------------------------------------ G24/25 -
def _top_keys(df: DataFrame, col: str, n: int) -> DataFrame:
    return top_n(df, col, n).select(col)


def type_hour_crosstab(df: DataFrame, n_types: int = 6) -> DataFrame:
    top = _top_keys(df, C_TYPE, n_types)
    sub = df.join(F.broadcast(top), df[f"`{C_TYPE}`"] == top[f"`{C_TYPE}`"], "left_semi")
    return sub.groupBy(c(C_TYPE).alias(C_TYPE)).pivot("Hour", HOUR_ORDER).agg(F.count(F.lit(1))).fillna(0)


def type_district_composition(df: DataFrame, n: int = 15) -> DataFrame:
    """(type, district, count, share) for the top-N types x top-N districts,
    share = count / district total inside that matrix (column-normalized)."""
    tt = _top_keys(df, C_TYPE, n).withColumnRenamed(C_TYPE, "__t")
    dd = _top_keys(df, C_DIST, n).withColumnRenamed(C_DIST, "__d")
    sub = (df.join(F.broadcast(tt), c(C_TYPE) == F.col("__t"), "left_semi")
           .join(F.broadcast(dd), c(C_DIST) == F.col("__d"), "left_semi"))
    m = sub.groupBy(c(C_TYPE).alias(C_TYPE), c(C_DIST).alias(C_DIST)).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(C_DIST)
    return m.withColumn("share", F.col("count") / F.sum("count").over(w))
