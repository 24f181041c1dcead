"""Fitted models in SQL: normal equations per seller, and K-Means step by step.

Steps that the engine runs in a loop are written out one after another here.
Whole-number sums become doubles by way of text, which rounds once.
"""

from __future__ import annotations

from oracles.parts import part


def d(expression: str) -> str:
    return f"CAST(CAST({expression} AS VARCHAR) AS DOUBLE)"


# ------------------------------------------------- one linear model per seller

VARIABLES = ("trend", "dow", "month", "lag_1", "lag_7", "week", "cents")
X, Y = range(6), 6
HORIZON = 30

part(
    "seller_series",
    ("sold",),
    """
WITH d AS (
  SELECT CAST(seller_id AS VARCHAR) AS series, purchase_date AS date,
    CAST(sum(item_revenue) * 100 AS BIGINT) AS cents
  FROM sold WHERE purchase_date IS NOT NULL GROUP BY ALL
), calendar AS (
  SELECT series, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM d GROUP BY series
)
SELECT series, date, coalesce(cents, 0) AS cents,
  CAST(count(*) OVER (PARTITION BY series) AS INTEGER) AS days,
  max(date) OVER (PARTITION BY series) AS last_date
FROM calendar LEFT JOIN d USING (series, date)""",
)
part(
    "seller_features",
    ("seller_series",),
    """
SELECT series, date > last_date - 30 AS held, date - min(date) OVER whole AS trend,
  isodow(date) - 1 AS dow, month(date) AS month, lag(cents, 1) OVER by_date AS lag_1,
  lag(cents, 7) OVER by_date AS lag_7,
  sum(cents) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS week,
  cents
FROM seller_series WHERE days >= 44
WINDOW whole AS (PARTITION BY series), by_date AS (PARTITION BY series ORDER BY date)
QUALIFY lag_7 IS NOT NULL""",
)


def moments(rows: str) -> str:
    sums = ", ".join(
        [f"sum({v}::HUGEINT) AS s{i}" for i, v in enumerate(VARIABLES)]
        + [
            f"sum({v}::HUGEINT * {VARIABLES[j]}::HUGEINT) AS p{i}_{j}"
            for i, v in enumerate(VARIABLES)
            for j in range(i, 7)
        ]
    )
    shown = ", ".join(
        [f"{d(f's{i}')} / n AS m{i}" for i in range(7)]
        + [
            d(f"n::HUGEINT * p{min(i, j)}_{max(i, j)} - s{i} * s{j}") + f" AS c{i}_{j}"
            for i in range(7)
            for j in range(7)
        ]
    )
    return f"""
SELECT series, CAST(n AS DOUBLE) AS n, {shown}
FROM (SELECT series, count(*) AS n, {sums} FROM seller_features WHERE {rows} GROUP BY series)"""


part("m_all", ("seller_features",), moments("true"))
part("m_train", ("seller_features",), moments("NOT held"))
part("m_held", ("seller_features",), moments("held"))


def solved(name: str, source: str) -> None:
    """Parts for Gauss-Jordan steps on the correlations, and at last the weights w0 to w5."""

    def correlation(i: int, j: int) -> str:
        if i == j:
            return "CAST('1.000000001' AS DOUBLE)"
        roots = f"(sqrt(c{i}_{i}) * sqrt(c{j}_{j}))"
        return f"CASE WHEN {roots} > 0 THEN c{i}_{j} / {roots} ELSE 0.0::DOUBLE END"

    first = ", ".join(f"{correlation(i, j)} AS x{i}_{j}" for i in X for j in range(7))
    part(f"{name}_0", (source,), f"SELECT series, {first} FROM {source}")
    for p in X:
        rows = [
            f"x{i}_{j} / x{p}_{p} AS x{i}_{j}" if i == p else f"x{i}_{j} - x{i}_{p} * (x{p}_{j} / x{p}_{p}) AS x{i}_{j}"
            for i in X
            for j in range(p + 1, 7)
        ]
        part(f"{name}_{p + 1}", (f"{name}_{p}",), f"SELECT series, {', '.join(rows)} FROM {name}_{p}")
    weights = ", ".join(
        f"CASE WHEN c{i}_{i} > 0 THEN x{i}_6 * sqrt(c6_6) / sqrt(c{i}_{i}) ELSE 0.0::DOUBLE END AS w{i}"
        for i in X
    )
    part(
        f"{name}_weights",
        (f"{name}_6", source),
        f"SELECT m.*, {weights} FROM {name}_6 JOIN {source} m USING (series)",
    )


solved("eq_all", "m_all")
solved("eq_train", "m_train")


def dot(values) -> str:
    total = "0.0::DOUBLE"
    for i, value in enumerate(values):
        total = f"({total} + w{i} * {value})"
    return total


LEVEL = f"(m6 - {dot(f'm{i}' for i in X)})"
FITTED = dot(dot(f"c{i}_{j}" for j in X) for i in X)
VARIANCE = (
    f"greatest((c6_6 - 2.0::DOUBLE * {dot(f'c6_{j}' for j in X)} + {FITTED}) / (n * n), 0.0::DOUBLE)"
)
part(
    "seller_models",
    ("eq_all_weights",),
    f"SELECT *, {LEVEL} AS level, sqrt({VARIANCE}) AS sigma FROM eq_all_weights",
)
part(
    "seller_quality",
    ("eq_train_weights", "m_held", "seller_series"),
    f"""
SELECT series, days, round(sqrt(mse) / 100, 4) AS rmse,
  CASE WHEN spread > 0 THEN round(1 - mse / spread, 6) END AS r2
FROM (
  SELECT series, c6_6 / (n * n) AS spread, ({LEVEL} - train_level) * ({LEVEL} - train_level) + {VARIANCE} AS mse
  FROM (
    SELECT h.*, {", ".join(f"t.w{i}" for i in X)}, t.level AS train_level
    FROM m_held h JOIN (SELECT *, {LEVEL} AS level FROM eq_train_weights) t USING (series)
  )
) JOIN (SELECT DISTINCT series, days FROM seller_series) USING (series)""",
)
AHEAD = "(last_date + step)"
INPUTS = (
    "CAST(days - 1 + step AS DOUBLE)",
    f"CAST(isodow{AHEAD} - 1 AS DOUBLE)",
    f"CAST(month{AHEAD} AS DOUBLE)",
    "hist[7]",
    "hist[1]",
    "(((((((0.0::DOUBLE + hist[1]) + hist[2]) + hist[3]) + hist[4]) + hist[5]) + hist[6]) + hist[7])",
)
part(
    "seller_start",
    ("seller_models", "seller_series"),
    """
SELECT series, days, last_date, hist, level, sigma, w0, w1, w2, w3, w4, w5
FROM seller_models JOIN (
  SELECT series, any_value(days) AS days, any_value(last_date) AS last_date,
    list(CAST(cents AS DOUBLE) ORDER BY date) AS hist
  FROM seller_series WHERE date > last_date - 7 GROUP BY series
) USING (series)""",
)
part("seller_0", ("seller_start",), "SELECT *, 1 AS step, NULL::DOUBLE AS value FROM seller_start")
for _k in range(1, HORIZON + 1):
    part(
        f"seller_{_k}",
        (f"seller_{_k - 1}",),
        f"""
SELECT * REPLACE (step + 1 AS step, value AS value, list_append(hist[2:7], value) AS hist)
FROM (SELECT * REPLACE (level + {dot(INPUTS)} AS value) FROM seller_{_k - 1})""",
    )
part(
    "seller_forecasts",
    tuple(f"seller_{k}" for k in range(1, HORIZON + 1)),
    "SELECT series, CAST(last_date + step - 1 AS DATE) AS forecast_date, round(value / 100, 2) AS predicted_revenue,"
    " round(greatest(0.0::DOUBLE, value - 1.96::DOUBLE * sigma) / 100, 2) AS lower_bound,"
    " round((value + 1.96::DOUBLE * sigma) / 100, 2) AS upper_bound, 'spark-linreg-per-series' AS model_name"
    " FROM (" + " UNION ALL ".join(f"SELECT * FROM seller_{k}" for k in range(1, HORIZON + 1)) + ")",
)

# -------------------------------------------------------------------- K-Means

PASSES = 30
Z = range(3)
PARTS_OF_ONE = "1000000000"

part(
    "km_values",
    ("rfm",),
    """
SELECT customer_unique_id AS id, CAST(recency_days * 100 AS HUGEINT) AS x0,
  CAST(frequency * 100 AS HUGEINT) AS x1, CAST(round(monetary * 100) AS HUGEINT) AS x2
FROM rfm""",
)
part(
    "km_scale",
    ("km_values",),
    "SELECT "
    + ", ".join(
        f"{d(f'sum(x{i})')} / count(*) AS m{i}, sqrt({d(f'count(*) * sum(x{i} * x{i}) - sum(x{i}) * sum(x{i})')}"
        f" / (count(*)::DOUBLE * (count(*) - 1)::DOUBLE)) AS d{i}"
        for i in Z
    )
    + " FROM km_values",
)
part(
    "km_points",
    ("km_values", "km_scale"),
    "SELECT id, "
    + ", ".join(f"CAST(floor(({d(f'x{i}')} - m{i}) / d{i} * {PARTS_OF_ONE} + 0.5) AS BIGINT) AS z{i}" for i in Z)
    + " FROM km_values, km_scale",
)


def squared(center: str = "") -> str:
    total = "0.0::DOUBLE"
    for i in Z:
        apart = f"(z{i} / {PARTS_OF_ONE}::DOUBLE - {center}c{i})"
        total = f"({total} + {apart} * {apart})"
    return total


def draw(turn: int) -> str:
    digest = f"md5(id || '|42|{turn}')"
    return f"-ln((CAST('0x' || substr({digest}, 1, 8) AS BIGINT)::DOUBLE + 1) / 4294967296::DOUBLE)"


_center = ", ".join(f"z{i} / {PARTS_OF_ONE}::DOUBLE AS c{i}" for i in Z)
part("km_start_0", ("km_points",), f"SELECT 0 AS cid, {_center} FROM km_points ORDER BY {draw(0)}, id LIMIT 1")
for _k in range(1, 4):
    part(
        f"km_start_{_k}",
        ("km_points", f"km_start_{_k - 1}"),
        f"""
SELECT * FROM km_start_{_k - 1} UNION ALL (
  SELECT {_k} AS cid, {_center} FROM (
    SELECT id, z0, z1, z2, min({squared()}) AS apart FROM km_points, km_start_{_k - 1} GROUP BY ALL
  ) WHERE apart > 0 ORDER BY {draw(_k)} / apart, id LIMIT 1)""",
    )
part("km_pass_0", ("km_start_3",), "SELECT * FROM km_start_3")


def placed(centers: str) -> str:
    return (
        f"SELECT id, z0, z1, z2, cid, {squared()} AS square FROM km_points, {centers} "
        "QUALIFY row_number() OVER (PARTITION BY id ORDER BY square, cid) = 1"
    )


for _k in range(1, PASSES + 1):
    _moved = ", ".join(f"coalesce({d(f's{i}')} / n / {PARTS_OF_ONE}, c{i}) AS c{i}" for i in Z)
    part(
        f"km_pass_{_k}",
        ("km_points", f"km_pass_{_k - 1}"),
        f"""
SELECT cid, {_moved} FROM km_pass_{_k - 1} LEFT JOIN (
  SELECT cid, count(*)::DOUBLE AS n, {", ".join(f"sum(z{i}) AS s{i}" for i in Z)}
  FROM ({placed(f"km_pass_{_k - 1}")}) GROUP BY cid
) USING (cid)""",
    )
LAST = f"km_pass_{PASSES}"
part(
    "km_names",
    (LAST,),
    f"""
WITH vip AS (SELECT cid FROM {LAST} ORDER BY c1 + c2 - c0 DESC, cid LIMIT 1),
risk AS (SELECT cid FROM {LAST} WHERE cid NOT IN (FROM vip) ORDER BY c0 DESC, cid LIMIT 1),
fresh AS (SELECT cid FROM {LAST} WHERE cid NOT IN (FROM vip) AND cid NOT IN (FROM risk) ORDER BY c1, cid LIMIT 1)
SELECT *, CASE WHEN cid IN (FROM vip) THEN 'VIP' WHEN cid IN (FROM risk) THEN 'At Risk'
  WHEN cid IN (FROM fresh) THEN 'New' ELSE 'Loyal' END AS label FROM {LAST}""",
)
part(
    "km_segments",
    ("km_points", "km_names"),
    f"""
SELECT id AS customer_unique_id, cid AS cluster_id, label AS segment_label, sqrt(square) AS distance_to_centroid
FROM ({placed(LAST)}) JOIN km_names USING (cid)""",
)
part(
    "km_clusters",
    ("km_segments", "rfm"),
    "SELECT rfm.*, cluster_id, segment_label, distance_to_centroid FROM rfm JOIN km_segments USING (customer_unique_id)",
)
part(
    "km_shares",
    ("km_segments",),
    """
SELECT segment_label, count(*) AS customer_count,
  round(count(*) / (SELECT count(*) FROM km_segments) * 100.0, 2) AS pct
FROM km_segments GROUP BY segment_label""",
)
_z = [f"(z{i} / {PARTS_OF_ONE}::DOUBLE)" for i in Z]
_product = f"(((0.0::DOUBLE + {_z[0]} * u0) + {_z[1]} * u1) + {_z[2]} * u2)"
_square = f"(({_z[0]} * {_z[0]} + {_z[1]} * {_z[1]}) + {_z[2]} * {_z[2]})"
part(
    "km_silhouette",
    ("km_points", LAST),
    f"""
WITH placed AS ({placed(LAST)}),
sums AS (
  SELECT cid AS other, count(*)::DOUBLE AS n, {", ".join(f"{d(f'sum(z{i})')} / count(*) / {PARTS_OF_ONE} AS u{i}" for i in Z)},
    {d("sum(z0::HUGEINT * z0 + z1::HUGEINT * z1 + z2::HUGEINT * z2)")} / count(*) / {PARTS_OF_ONE} / {PARTS_OF_ONE} AS q
  FROM placed GROUP BY cid
),
apart AS (SELECT id, cid, other, n, ({_square} + q) - 2.0::DOUBLE * {_product} AS mean FROM placed, sums),
pairs AS (
  SELECT id, max(CASE WHEN cid = other AND n > 1 THEN mean * (n / (n - 1)) END) AS a,
    min(CASE WHEN cid <> other THEN mean END) AS b
  FROM apart GROUP BY id
)
SELECT count(*) AS customers, round({d(f"sum(CAST(floor(coalesce((b - a) / greatest(a, b), 0) * {PARTS_OF_ONE} + 0.5) AS HUGEINT))")}
  / count(*) / {PARTS_OF_ONE}, 6) AS silhouette
FROM pairs""",
)
