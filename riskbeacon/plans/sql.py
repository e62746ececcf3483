"""DuckDB oracle SQL, written independently of the Spark plans.

Each builder returns CTE text; ``with_ctes`` stitches them into a query. The
SQL runs on the driver's pre-registered views (region, nation, customer,
supplier, part, orders, lineitem, events, embeddings, ...).
"""

from __future__ import annotations

from riskbeacon.config import CRIME_GROUPS, EVAL_SEEDS, MODEL_EWMA, MODEL_PERSISTENCE, MODEL_ROLLING
from riskbeacon.sources.standin import STANDIN_EVENT_GROUPS, STANDIN_SPLIT_DATE, STANDIN_TYPE_GROUPS


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def tok(x: str) -> str:
    """Region token cleaner (B1) in SQL."""
    t = f"regexp_replace(trim(coalesce(CAST({x} AS VARCHAR), 'UNKNOWN')), '\\.0$', '')"
    return f"upper(CASE WHEN {t} IN ('', 'NAN') THEN 'UNKNOWN' ELSE {t} END)"


def case_map(x: str, pairs) -> str:
    whens = " ".join(f"WHEN {x} = '{a}' THEN '{b}'" for a, b in pairs)
    return f"CASE {whens} ELSE NULL END"


def state_of(x: str) -> str:
    s = f"split_part(upper(trim(coalesce({x}, 'UNK'))), '__', 1)"
    return f"CASE WHEN {s} IN ('', 'NAN') THEN 'UNK' ELSE {s} END"


def time_bin(d: str, w: int) -> str:
    if w == 7:
        return f"CAST(date_trunc('week', CAST({d} AS DATE)) AS DATE)"
    return (f"CAST(DATE '2015-01-01' + CAST(floor(datediff('day', DATE '2015-01-01', CAST({d} AS DATE)) / 3.0) * 3 "
            f"AS INTEGER) AS DATE)")


# ------------------------------------------------------------- events -----
def events_in(more: str = "") -> str:
    region = (f"CASE WHEN {tok('n.n_name')} <> 'UNKNOWN' THEN {tok('r.r_name')} || '__' || {tok('n.n_name')} "
              f"ELSE {tok('r.r_name')} || '__' || {tok('o.o_custkey')} END")
    return f"""SELECT * FROM (
  SELECT CAST(o.o_orderdate AS TIMESTAMP) AS event_date, {region} AS region_id,
         {case_map('p.p_type', STANDIN_TYPE_GROUPS)} AS crime_group, p.p_type AS raw_offense{more}
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN part p ON CAST(l.l_partkey AS VARCHAR) = CAST(p.p_partkey AS VARCHAR)
) x WHERE event_date IS NOT NULL AND crime_group IS NOT NULL AND region_id IS NOT NULL"""


def events_out() -> str:
    return f"""SELECT * FROM (
  SELECT CAST(l.l_shipdate AS TIMESTAMP) AS event_date, {tok('r.r_name')} || '__' || {tok('n.n_name')} AS region_id,
         {case_map('p.p_type', STANDIN_TYPE_GROUPS)} AS crime_group, p.p_type AS raw_type
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
) x WHERE event_date IS NOT NULL AND crime_group IS NOT NULL AND region_id IS NOT NULL"""


def events_short() -> str:
    return f"""SELECT * FROM (
  SELECT ts AS event_date, 'S' || CAST(user_id % 3 AS VARCHAR) || '__' || CAST(user_id % 15 AS VARCHAR) AS region_id,
         {case_map('event_type', STANDIN_EVENT_GROUPS)} AS crime_group, event_type AS raw_type
  FROM events
) x WHERE event_date IS NOT NULL AND crime_group IS NOT NULL AND region_id IS NOT NULL"""


# -------------------------------------------------------------- panel -----
def panel_ctes(ev: str, w: int, p: str = "") -> list[tuple[str, str]]:
    """CTEs {p}cnt, {p}grid, {p}panel for events CTE ``ev``."""
    grp = ",\n       ".join(f"CAST(count(*) FILTER (WHERE crime_group = '{g}') AS DOUBLE) AS count_grp_{g}"
                            for g in CRIME_GROUPS)
    fill = ", ".join(f"coalesce(c.count_grp_{g}, 0.0) AS count_grp_{g}" for g in CRIME_GROUPS)
    return [
        (f"{p}cnt", f"""SELECT region_id, {time_bin('event_date', w)} AS time_id, count(*) AS count,
       {grp}
FROM {ev} WHERE region_id IS NOT NULL GROUP BY 1, 2"""),
        (f"{p}grid", f"""SELECT r.region_id, CAST(g.t AS DATE) AS time_id
FROM (SELECT DISTINCT region_id FROM {p}cnt) r,
     (SELECT unnest(generate_series(CAST(min(time_id) AS TIMESTAMP), CAST(max(time_id) AS TIMESTAMP),
                                    INTERVAL {w} DAY)) AS t FROM {p}cnt) g"""),
        (f"{p}panel", f"""SELECT g.region_id, g.time_id, CAST(coalesce(c.count, 0) AS BIGINT) AS count, {fill}
FROM {p}grid g LEFT JOIN {p}cnt c ON g.region_id = c.region_id AND g.time_id = c.time_id"""),
    ]


def _w(frame: str = "") -> str:
    return f"(PARTITION BY region_id ORDER BY time_id {frame})"


def supervised_ctes(panel: str, w: int, p: str = "") -> list[tuple[str, str]]:
    """CTEs {p}nb, {p}ew, {p}feat, {p}sup (features + y_count, next_time)."""
    prev4 = _w("ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING")
    cum = _w("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    shares_lag = ",\n       ".join(f"lag(count_grp_{g}, 1) OVER {_w()} AS l1_{g}" for g in CRIME_GROUPS)
    lag_sum = " + ".join(f"coalesce(l1_{g}, 0.0)" for g in CRIME_GROUPS)
    shares = ",\n       ".join(
        f"CASE WHEN ({lag_sum}) > 0 THEN l1_{g} / ({lag_sum}) ELSE 0.0 END AS lag1_share_{g}" for g in CRIME_GROUPS)
    grp_cols = ", ".join(f"count_grp_{g}" for g in CRIME_GROUPS)

    def ewm(x: str) -> str:
        # closed form of the adjust=False recursion: sum_i w_{n,i} x_i
        return (f"pow(0.6, rn) * sum(CASE WHEN rn = 1 THEN {x} ELSE 0.4 * {x} END * pow(0.6, -rn)) OVER {cum}")

    return [
        (f"{p}nb", f"""SELECT *, CASE WHEN count(*) OVER ws > 1
            THEN CAST(sum(count) OVER ws - count AS DOUBLE) / greatest(count(*) OVER ws - 1, 1) ELSE 0.0 END
            AS neighbor_lag_0
FROM (SELECT *, {state_of('region_id')} AS region_state FROM {panel}) s
WINDOW ws AS (PARTITION BY region_state, time_id)"""),
        (f"{p}ew", f"""SELECT *, {ewm('CAST(count AS DOUBLE)')} AS ewm_count, {ewm('neighbor_lag_0')} AS ewm_nb
FROM (SELECT *, row_number() OVER {_w()} AS rn FROM {p}nb) r"""),
        (f"{p}feat", f"""SELECT region_id, time_id, count, {grp_cols}, region_state, neighbor_lag_0,
       CAST(count AS DOUBLE) AS lag_0,
       CAST(lag(count, 1) OVER {_w()} AS DOUBLE) AS lag_1,
       CAST(lag(count, 2) OVER {_w()} AS DOUBLE) AS lag_2,
       CAST(lag(count, 4) OVER {_w()} AS DOUBLE) AS lag_4,
       avg(CAST(count AS DOUBLE)) OVER {prev4} AS rolling_mean_4,
       CAST(sum(count) OVER {prev4} AS DOUBLE) AS rolling_sum_4,
       lag(ewm_count, 1) OVER {_w()} AS ewma_4,
       lag(neighbor_lag_0, 1) OVER {_w()} AS neighbor_lag_1,
       avg(neighbor_lag_0) OVER {prev4} AS neighbor_roll_mean_4,
       lag(ewm_nb, 1) OVER {_w()} AS neighbor_ewma_4,
       CASE WHEN neighbor_lag_0 > 0 THEN count / neighbor_lag_0 ELSE CAST(count AS DOUBLE) END
            AS self_neighbor_ratio_lag0,
       CAST(lead(count, 1) OVER {_w()} AS DOUBLE) AS y_count,
       CAST(time_id + INTERVAL {w} DAY AS DATE) AS next_time,
       CAST(month(time_id) AS DOUBLE) AS month,
       CAST(weekofyear(time_id) AS DOUBLE) AS weekofyear,
       CAST(quarter(time_id) AS DOUBLE) AS quarter,
       sin(2 * pi() * weekofyear(time_id) / 52.0) AS sin_weekofyear,
       cos(2 * pi() * weekofyear(time_id) / 52.0) AS cos_weekofyear,
       {shares_lag}
FROM {p}ew"""),
        (f"{p}sup", f"""SELECT *, {shares}
FROM {p}feat
WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_4 IS NOT NULL AND neighbor_lag_1 IS NOT NULL
  AND y_count IS NOT NULL"""),
    ]


def split_ctes(w: int) -> list[tuple[str, str]]:
    """Full in/out chain up to labelled + region-stat frames:
    train_x, test_x, out_x, thr."""

    def apply(src: str) -> str:
        return f"""SELECT s.*, CAST(s.y_count >= (SELECT threshold FROM thr) AS INTEGER) AS y,
       coalesce(st.region_train_mean, d.m) AS region_train_mean,
       coalesce(st.region_train_std, d.s) AS region_train_std,
       coalesce(st.region_train_count, d.c) AS region_train_count,
       CASE WHEN st.region_id IS NULL THEN 0.0 ELSE 1.0 END AS region_seen_in_train
FROM {src} s LEFT JOIN rstats st ON s.region_id = st.region_id,
     (SELECT avg(region_train_mean) AS m, avg(region_train_std) AS s, avg(region_train_count) AS c FROM rstats) d"""

    ctes = [("ev_in", events_in()), ("ev_out", events_out())]
    ctes += panel_ctes("ev_in", w, "i_") + supervised_ctes("i_panel", w, "i_")
    ctes += panel_ctes("ev_out", w, "o_") + supervised_ctes("o_panel", w, "o_")
    ctes += [
        ("tb", f"""SELECT min({time_bin('event_date', w)}) AS t0, max({time_bin('event_date', w)}) AS t1
FROM ev_in WHERE event_date >= TIMESTAMP '{STANDIN_SPLIT_DATE}'"""),
        ("train", "SELECT * FROM i_sup WHERE time_id < (SELECT t0 FROM tb) AND next_time < (SELECT t0 FROM tb)"),
        ("test", "SELECT * FROM i_sup WHERE time_id >= (SELECT t0 FROM tb) AND next_time <= (SELECT t1 FROM tb)"),
        ("thr", "SELECT CAST(greatest(1, ceil(quantile_cont(y_count, 0.75))) AS INTEGER) AS threshold FROM train"),
        ("rstats", """SELECT region_id, avg(lag_0) AS region_train_mean,
       coalesce(stddev_samp(lag_0), 0.0) AS region_train_std, CAST(count(lag_0) AS DOUBLE) AS region_train_count
FROM train GROUP BY region_id"""),
        ("train_x", apply("train")),
        ("test_x", apply("test")),
        ("out_x", apply("o_sup")),
    ]
    return ctes


def predictions_ctes(w: int) -> list[tuple[str, str]]:
    """split_ctes + ``preds`` (the long prediction table)."""
    specs = []
    for s in EVAL_SEEDS:
        specs += [(MODEL_PERSISTENCE, s, "lag_0"), (MODEL_ROLLING, s, "rolling_mean_4"), (MODEL_EWMA, s, "ewma_4")]

    def block(src: str, ds: str) -> str:
        parts = []
        for m, s, c in specs:
            parts.append(f"""SELECT region_id, strftime(time_id, '%Y-%m-%d') AS time_id, y, y_count, '{m}' AS model,
       '{ds}' AS dataset, CAST({c} AS DOUBLE) AS y_score,
       CAST({c} >= (SELECT threshold FROM thr) AS INTEGER) AS y_pred, {s} AS seed FROM {src}""")
        return "\nUNION ALL\n".join(parts)

    return split_ctes(w) + [("preds", block("test_x", "in_domain") + "\nUNION ALL\n" + block("out_x", "out_domain"))]


# ------------------------------------------------------------- metrics ----
def metrics_ctes(src: str, keys: list[str], p: str, y: str = "y", pred: str = "y_pred",
                 score: str = "y_score") -> list[tuple[str, str]]:
    """CTE ``{p}m``: keys + n_rows, positive_rate, precision, recall, f1, auc.
    AUC by the rank-sum formula with average ranks for ties."""
    k = ", ".join(keys)
    kj = " AND ".join(f"c.{x} IS NOT DISTINCT FROM a.{x}" for x in keys)
    return [
        (f"{p}conf", f"""SELECT {k}, count(*) AS n_rows, avg(CAST({y} AS DOUBLE)) AS positive_rate,
       sum(CASE WHEN {y} = 1 AND {pred} = 1 THEN 1 ELSE 0 END) AS tp,
       sum(CASE WHEN {y} = 0 AND {pred} = 1 THEN 1 ELSE 0 END) AS fp,
       sum(CASE WHEN {y} = 1 AND {pred} = 0 THEN 1 ELSE 0 END) AS fn
FROM {src} GROUP BY {k}"""),
        (f"{p}rk", f"""SELECT {k}, {y} AS yy,
       rank() OVER (PARTITION BY {k} ORDER BY {score}) + (count(*) OVER (PARTITION BY {k}, {score}) - 1) / 2.0 AS r
FROM {src} WHERE {score} IS NOT NULL"""),
        (f"{p}auc", f"""SELECT {k}, CASE WHEN sum(yy) > 0 AND sum(1 - yy) > 0 THEN
       (sum(CASE WHEN yy = 1 THEN r ELSE 0 END) - CAST(sum(yy) AS DOUBLE) * (sum(yy) + 1) / 2.0)
       / (CAST(sum(yy) AS DOUBLE) * sum(1 - yy)) END AS auc
FROM {p}rk GROUP BY {k}"""),
        (f"{p}m", f"""SELECT c.*, 
       CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
       CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
       a.auc
FROM {p}conf c LEFT JOIN {p}auc a ON {kj}"""),
    ]


def state_simple(x: str) -> str:
    s = f"split_part(upper(trim({x})), '__', 1)"
    return f"CASE WHEN {s} = '' THEN 'UNK' ELSE {s} END"


def month_bucket(t: str) -> str:
    return f"strftime(CAST({t} AS DATE), '%Y-%m')"


def metrics_long_ctes(w: int, p: str = "") -> list[tuple[str, str]]:
    """predictions + metrics long (overall, temporal F1, group, neighbor) as
    ``{p}mlong``; assumes ``preds`` exists (use inside predictions_ctes)."""
    ctes = []
    ctes += metrics_ctes("preds", ["seed", "dataset", "model"], f"{p}ov_")
    ctes += [(f"{p}tsrc", f"SELECT *, {month_bucket('time_id')} AS date_bucket FROM preds")]
    ctes += metrics_ctes(f"{p}tsrc", ["seed", "dataset", "model", "date_bucket"], f"{p}tm_")
    ctes += [(f"{p}nbsrc", f"""SELECT *, max(y) OVER (PARTITION BY seed, dataset, model, {state_simple('region_id')}, time_id)
       AS y_neighbor FROM preds""")]
    ctes += metrics_ctes(f"{p}nbsrc", ["seed", "dataset", "model"], f"{p}nb_", y="y_neighbor")
    ctes += [(f"{p}gsrc", f"SELECT *, {state_simple('region_id')} AS crime_group FROM preds WHERE dataset = 'out_domain'")]
    ctes += metrics_ctes(f"{p}gsrc", ["seed", "model", "crime_group"], f"{p}gm_")

    def unp(src: str, metrics: list[str], extra_cols: str, slice_name: str, filt: str = "") -> str:
        parts = []
        for m in metrics:
            parts.append(f"""SELECT {w} AS time_window_days, {extra_cols}, '{m}' AS metric,
       CAST({m} AS DOUBLE) AS value, '{slice_name}' AS slice FROM {src} {filt}""")
        return "\nUNION ALL\n".join(parts)

    base = "dataset AS domain, model, CAST(seed AS INTEGER) AS seed"
    ctes += [(f"{p}mlong", "\nUNION ALL\n".join([
        unp(f"{p}ov_m", ["auc", "f1", "recall", "precision"], base + ", '' AS crime_group, '' AS date_bucket",
            "overall"),
        unp(f"{p}tm_m", ["f1"], base + ", '' AS crime_group, date_bucket", "temporal"),
        unp(f"{p}gm_m", ["auc", "f1"],
            "'out_domain' AS domain, model, CAST(seed AS INTEGER) AS seed, crime_group, '' AS date_bucket",
            "crime_group", f"WHERE (SELECT count(DISTINCT crime_group) FROM {p}gsrc) > 1"),
        unp(f"{p}nb_m", ["auc", "f1", "recall", "precision"], base + ", '' AS crime_group, '' AS date_bucket",
            "neighbor_overall"),
    ]))]
    return ctes


# ---------------------------------------------------------------- cube -----
def city() -> str:
    return """SELECT CAST(o.o_orderdate AS DATE) AS "Date", strftime(o.o_orderdate, '%H:%M:%S') AS "Time",
       o.o_orderpriority AS "Primary Type", o.o_orderstatus AS "Description", c.c_mktsegment AS "Location Description",
       (o.o_orderstatus = 'F') AS "Arrest", (o.o_orderstatus = 'P') AS "Domestic",
       CAST(c.c_nationkey AS SMALLINT) AS "District", CAST(o.o_custkey % 77 AS SMALLINT) AS "Community Area",
       CAST(year(o.o_orderdate) AS SMALLINT) AS "Year",
       CAST(41.6 AS DOUBLE) + CAST(o.o_orderkey % 400 AS DOUBLE) / 1000.0 AS "Latitude",
       CAST(-87.9 AS DOUBLE) + CAST((o.o_orderkey * 7) % 400 AS DOUBLE) / 1000.0 AS "Longitude",
       CAST(month(o.o_orderdate) AS TINYINT) AS "Month", dayname(o.o_orderdate) AS "DayOfWeek",
       CAST(o.o_orderkey % 24 AS TINYINT) AS "Hour"
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""


# ---------------------------------------------------------------- geo ------
def label_regions() -> str:
    return f"""SELECT n.n_nationkey AS label, {tok('r.r_name')} || '__' || {tok('n.n_name')} AS region_id
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""


def geo_points() -> str:
    return """SELECT lr.region_id, CAST(e.embedding[2] AS DOUBLE) AS latitude, CAST(e.embedding[1] AS DOUBLE) AS longitude
FROM embeddings e JOIN lr ON e.label = lr.label"""


def geo_events() -> str:
    return f"""SELECT lr.region_id, CAST(e.embedding[2] AS DOUBLE) AS latitude, CAST(e.embedding[1] AS DOUBLE) AS longitude,
       o.o_orderdate AS event_date
FROM orders o JOIN embeddings e ON o.o_orderkey % 500 = e.vec_id JOIN lr ON e.label = lr.label
WHERE o.o_orderdate >= TIMESTAMP '{STANDIN_SPLIT_DATE}'"""


def knn_ctes(k: int = 3) -> list[tuple[str, str]]:
    return [
        ("lr", label_regions()), ("gp", geo_points()),
        ("cent", "SELECT region_id, median(longitude) AS lon, median(latitude) AS lat FROM gp "
                 "WHERE region_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1"),
        ("knn", f"""SELECT * FROM (
  SELECT a.region_id, b.region_id AS neighbor_id, sqrt(pow(a.lon - b.lon, 2) + pow(a.lat - b.lat, 2)) AS distance,
         CAST(row_number() OVER (PARTITION BY a.region_id ORDER BY sqrt(pow(a.lon - b.lon, 2) + pow(a.lat - b.lat, 2)),
                            b.region_id) AS INTEGER) AS nn_rank
  FROM cent a JOIN cent b ON a.region_id <> b.region_id) x WHERE nn_rank <= {k}"""),
    ]


def city_raw() -> str:
    return """SELECT o.o_orderkey AS "ID", 'C' || CAST(o.o_orderkey AS VARCHAR) AS "Case Number",
       strftime(o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)), '%m/%d/%Y %I:%M:%S %p') AS "Date",
       c.c_name AS "Block", substr(o.o_orderpriority, 1, 1) AS "IUCR", o.o_orderpriority AS "Primary Type",
       o.o_orderstatus AS "Description", c.c_mktsegment AS "Location Description",
       (o.o_orderstatus = 'F') AS "Arrest", (o.o_orderstatus = 'P') AS "Domestic", o.o_custkey % 300 AS "Beat",
       c.c_nationkey AS "District", o.o_custkey % 50 AS "Ward", o.o_custkey % 77 AS "Community Area",
       substr(o.o_orderpriority, 1, 1) AS "FBI Code", CAST(year(o.o_orderdate) AS INTEGER) AS "Year",
       CAST(41.6 AS DOUBLE) + CAST(o.o_orderkey % 400 AS DOUBLE) / 1000.0 AS "Latitude",
       CAST(-87.9 AS DOUBLE) + CAST((o.o_orderkey * 7) % 400 AS DOUBLE) / 1000.0 AS "Longitude"
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""


def eda_clean(y0: int, y1: int) -> str:
    ts = "strptime(\"Date\", '%m/%d/%Y %I:%M:%S %p')"
    return f"""SELECT CAST({ts} AS DATE) AS "Date", strftime({ts}, '%H:%M:%S') AS "Time", "Block",
       "Primary Type", "Description", coalesce("Location Description", 'UNKNOWN') AS "Location Description",
       "Arrest", "Domestic", "Beat", CAST("District" AS SMALLINT) AS "District",
       CAST(coalesce(CAST("Community Area" AS INTEGER), -1) AS SMALLINT) AS "Community Area", "FBI Code", "Year",
       "Latitude", "Longitude"
FROM craw WHERE "Year" BETWEEN {y0} AND {y1} AND "District" IS NOT NULL AND "Latitude" IS NOT NULL
  AND "Longitude" IS NOT NULL"""
