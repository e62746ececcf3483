"""Cleaning of the original city export for the dashboard cube."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXPORT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"
# --- fixed values: columns the cleaning drops --------------------------------
DROP_COLUMNS = ["ID", "Case Number", "IUCR", "X Coordinate", "Y Coordinate", "Location", "Ward", "Updated On"]


def c(name: str):
    return F.col(f"`{name}`")


# ------------------------------------------------------------------ B12 ----
def clean_export(raw: DataFrame, year_range=(2015, 2025)) -> DataFrame:
    """Year range; parse Date / Updated On (bad -> NULL); split date and
    time; drop id/coordinate/update columns and Ward; Location Description
    NULL -> UNKNOWN; drop NULL District; Community Area NULL -> -1; drop NULL
    coordinates; narrow integer types."""
    ts = F.try_to_timestamp(c("Date").cast("string"), F.lit(EXPORT_TS_FORMAT))
    df = raw.filter((c("Year") >= int(year_range[0])) & (c("Year") <= int(year_range[1])))
    df = df.withColumn("__ts", ts)
    keep = [x for x in df.columns if x not in DROP_COLUMNS + ["Date", "__ts"]]
    out = df.select(
        F.to_date("__ts").alias("Date"), F.date_format("__ts", "HH:mm:ss").alias("Time"),
        *[c(x) for x in keep])
    out = (out.withColumn("Location Description", F.coalesce(c("Location Description"), F.lit("UNKNOWN")))
           .dropna(subset=["District"])
           .withColumn("Community Area", F.coalesce(c("Community Area").cast("int"), F.lit(-1)).cast("short"))
           .withColumn("District", c("District").cast("short"))
           .dropna(subset=["Latitude", "Longitude"]))
    return out


# ------------------------------------------------------------------ B13 ----
def time_features(clean: DataFrame) -> DataFrame:
    return (clean.withColumn("Month", F.month(c("Date")).cast("byte"))
            .withColumn("DayOfWeek", F.date_format(c("Date"), "EEEE"))
            .withColumn("Hour", F.hour(F.try_to_timestamp(c("Time"), F.lit("HH:mm:ss"))).cast("byte")))


# ------------------------------------------------------------------ B14 ----
def year_split(df: DataFrame, test_year: int) -> DataFrame:
    """Tag rows train (Year < test_year) / test (Year == test_year)."""
    return (df.filter(c("Year") <= int(test_year))
            .withColumn("split", F.when(c("Year") == int(test_year), F.lit("test")).otherwise(F.lit("train"))))


def split_summary(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("Date").alias("min_date"),
                                       F.max("Date").alias("max_date"))
