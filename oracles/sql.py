"""DuckDB SQL for every registered query, over the same Parquet tables."""

from __future__ import annotations

from tallymart.operators.insights import REPORT_ROWS, SERVICE_ROWS
from tallymart.params import (
    DAY_LABELS,
    SEGMENT_CHURN_RISK,
    SEGMENT_HIGH_FREQUENCY,
    SEGMENT_HIGH_VALUE,
    SEGMENT_LOW_ACTIVITY,
    SEGMENT_POTENTIAL,
    UNKNOWN,
    WEEKEND_LABEL,
    WORKDAY_LABEL,
)

RO = """ro AS (
  SELECT 'ORD-' || l_orderkey || '-' || l_linenumber AS order_id,
         o_orderdate + to_hours(8 + l_orderkey % 15) + to_minutes(l_partkey % 60) AS order_date,
         p_type AS category, p_name AS product, r_name AS region, n_name AS city,
         o_orderpriority AS channel, 'CUST-' || o_custkey AS customer_id,
         c_mktsegment AS customer_type,
         p_retailprice::DECIMAL(12,2) AS unit_price, l_quantity::INTEGER AS quantity,
         (p_retailprice::DECIMAL(12,2) * l_quantity::INTEGER)::DECIMAL(14,2) AS total_amount,
         l_discount::DECIMAL(5,4) AS discount_rate,
         round((p_retailprice::DECIMAL(12,2) * l_quantity::INTEGER)::DECIMAL(14,2)
               * (1 - l_discount::DECIMAL(5,4)), 2)::DECIMAL(14,2) AS final_amount,
         l_returnflag || l_linestatus AS payment_method, o_orderstatus AS order_status
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey)"""

DONE = RO + ",\ndone AS (SELECT * FROM ro WHERE order_status = 'F')"

TIME = """year(order_date)::INTEGER AS year, month(order_date)::INTEGER AS month,
  quarter(order_date)::INTEGER AS quarter, weekofyear(order_date)::INTEGER AS week,
  (isodow(order_date) - 1)::INTEGER AS day_of_week, dayname(order_date) AS day_name,
  (isodow(order_date) >= 6)::INTEGER AS is_weekend,
  strftime(order_date, '%Y-%m') AS year_month, strftime(order_date, '%Y-W%U') AS year_week"""

REV = "sum(final_amount)::DOUBLE"
AVG = "(sum(final_amount)::DOUBLE / count(final_amount))"
YM = "strftime(order_date, '%Y-%m')"
DAY = "order_date::DATE"


def rnd(x: str, digits: int) -> str:
    return f"round(({x}) + sign({x}) * 1e-7, {digits})"


def rne(x: str, digits: int) -> str:
    return f"round_even(({x})::DOUBLE * {10 ** digits}, 0) / {10 ** digits}"


def quantile(values: str, p: float) -> str:
    """Linear interpolation in a sorted list, in the order of operations the engine uses."""
    at = f"((len({values}) - 1) * {p}::DOUBLE)"
    low, high = f"{values}[floor({at})::INT + 1]", f"{values}[ceil({at})::INT + 1]"
    return (
        f"CASE WHEN {low} = {high} THEN {low} "
        f"ELSE (ceil({at}) - {at}) * {low} + ({at} - floor({at})) * {high} END"
    )


def sorted_list(column: str) -> str:
    return f"list({column}::DOUBLE ORDER BY {column}) FILTER ({column} IS NOT NULL)"


def done(select: str) -> str:
    return f"WITH {DONE}\n{select}"


def grouped(keys: str, measures: str, rows: str = "done", where: str = "true") -> str:
    n = len(keys.split(" AS ")) - 1
    positions = ", ".join(str(i + 1) for i in range(n))
    return done(f"SELECT {keys}, {measures} FROM {rows} WHERE {where} GROUP BY {positions}")


# --- cleaning -------------------------------------------------------------------------------

FAULTS = """hashed AS (
  SELECT *, split_part(order_id, '-', 2)::BIGINT * 31 + split_part(order_id, '-', 3)::BIGINT * 17
            + (unit_price * 100)::BIGINT AS h
  FROM ro),
dirty AS (
  SELECT order_id, order_date, CASE WHEN h % 100 = 3 THEN NULL ELSE category END AS category,
         product, CASE WHEN h % 400 = 23 THEN 'nan' WHEN h % 200 = 5 THEN NULL ELSE region END
           AS region,
         city, channel, customer_id, customer_type,
         CASE WHEN h % 50 = 0 THEN NULL WHEN h % 333 = 11 THEN unit_price::DOUBLE * 20
              ELSE unit_price::DOUBLE END AS unit_price,
         CASE WHEN h % 67 = 1 THEN NULL WHEN h % 500 = 13 THEN -quantity ELSE quantity END
           AS quantity,
         total_amount, CASE WHEN h % 1000 = 17 THEN 1.5::DOUBLE WHEN h % 1000 = 19
           THEN 0.7::DOUBLE ELSE discount_rate::DOUBLE END AS discount_rate,
         final_amount, CASE WHEN h % 100 = 7 THEN NULL ELSE payment_method END AS payment_method,
         order_status
  FROM hashed)"""

COERCED_ROWS = """SELECT * REPLACE (nullif(region, 'nan') AS region, quantity::DOUBLE AS quantity,
                    total_amount::DOUBLE AS total_amount, final_amount::DOUBLE AS final_amount)
  FROM dirty"""

COERCED = f"""coerced AS (
  {COERCED_ROWS})"""

UNIQUE = """uniq AS (
  SELECT * FROM coerced
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY
    order_date NULLS LAST, category NULLS LAST, product NULLS LAST, region NULLS LAST,
    city NULLS LAST, channel NULLS LAST, customer_id NULLS LAST, customer_type NULLS LAST,
    unit_price NULLS LAST, quantity NULLS LAST, total_amount NULLS LAST,
    discount_rate NULLS LAST, final_amount NULLS LAST, payment_method NULLS LAST,
    order_status NULLS LAST) = 1)"""

COLUMNS = (
    "order_id order_date category product region city channel customer_id customer_type "
    "unit_price quantity total_amount discount_rate final_amount payment_method order_status"
).split()
NULLS = " + ".join(f"({c} IS NULL)::INTEGER" for c in COLUMNS)

IMPUTED = f"""med AS (
  SELECT mc, {quantile("ps", 0.5)} AS m
  FROM (SELECT category AS mc, {sorted_list("unit_price")} AS ps FROM uniq
        WHERE category IS NOT NULL GROUP BY 1)),
gmed AS (
  SELECT {quantile("ps", 0.5)} AS gm FROM (SELECT {sorted_list("unit_price")} AS ps FROM uniq)),
filled AS (
  SELECT uniq.* REPLACE (
           coalesce(unit_price, m, gm) AS unit_price,
           coalesce(TRY_CAST(quantity AS BIGINT), 1) AS quantity,
           coalesce(category, '{UNKNOWN}') AS category, coalesce(region, '{UNKNOWN}') AS region,
           coalesce(city, '{UNKNOWN}') AS city,
           coalesce(payment_method, '{UNKNOWN}') AS payment_method),
         {NULLS} AS nulls_before
  FROM uniq LEFT JOIN med ON category = mc CROSS JOIN gmed),
imputed AS (
  SELECT * EXCLUDE (total) REPLACE ({rne("total * (1 - least(greatest(discount_rate, 0), 1) - 0 * discount_rate)", 2)}
           AS final_amount, total AS total_amount)
  FROM (SELECT *, {rne("unit_price * quantity", 2)} AS total FROM filled))"""

CAPPED = f"""lim AS (
  SELECT lc, q3 + (q3 - q1) * 3 AS upper_price
  FROM (SELECT lc, {quantile("ps", 0.25)} AS q1, {quantile("ps", 0.75)} AS q3
        FROM (SELECT category AS lc, {sorted_list("unit_price")} AS ps FROM imputed GROUP BY 1))),
flagged AS (
  SELECT *, (quantity < 0) AS negative, (discount_rate > 1 OR discount_rate < 0) AS bad_discount,
         unit_price > upper_price AS too_dear, {NULLS} AS nulls_after
  FROM imputed JOIN lim ON category = lc),
tamed AS (
  SELECT * REPLACE (abs(quantity)::BIGINT AS quantity,
           CASE WHEN (SELECT bool_or(bad_discount) FROM flagged)
                THEN least(greatest(discount_rate, 0), 0.5::DOUBLE) + 0 * discount_rate ELSE discount_rate END
             AS discount_rate,
           CASE WHEN too_dear THEN upper_price ELSE unit_price END AS unit_price)
  FROM flagged),
capped AS (
  SELECT * EXCLUDE (total) REPLACE (
           TRY_CAST({rne("total * (1 - discount_rate)", 2)} AS DECIMAL(14,2)) AS final_amount,
           TRY_CAST(total AS DECIMAL(14,2)) AS total_amount)
  FROM (SELECT *, {rne("unit_price * quantity", 2)} AS total FROM tamed))"""

UNIQUE_CTES = ",\n".join([RO, FAULTS, COERCED, UNIQUE])
IMPUTED_CTES = ",\n".join([UNIQUE_CTES, IMPUTED])
CAPPED_CTES = ",\n".join([IMPUTED_CTES, CAPPED])
ORDER_LIST = ", ".join(COLUMNS)

RAW_TYPES = """SELECT order_id,
  CASE WHEN k % 97 = 5 THEN NULL WHEN k % 101 = 7 OR k % 103 = 9 THEN order_date::DATE::TIMESTAMP
       ELSE order_date END AS order_date, category, product,
  nullif(region, 'nan') AS region, city, channel, customer_id, customer_type,
  CASE WHEN k % 89 = 3 THEN NULL WHEN k % 907 = 2 OR k % 911 = 3 THEN 'Infinity'::DOUBLE
       WHEN k % 919 = 4 THEN '-Infinity'::DOUBLE ELSE unit_price END AS unit_price,
  CASE WHEN k % 83 = 4 THEN NULL WHEN k % 113 = 8 THEN 1e20::DOUBLE ELSE quantity::DOUBLE END AS quantity,
  total_amount::DOUBLE AS total_amount,
  CASE WHEN k % 79 = 6 THEN NULL ELSE discount_rate END AS discount_rate,
  final_amount::DOUBLE AS final_amount, payment_method, order_status
FROM (SELECT *, split_part(order_id, '-', 2)::BIGINT AS k FROM dirty)"""

IQR_CAP = """SELECT category, max(upper_price) AS upper_price, count(*) FILTER (too_dear) AS capped_orders
FROM flagged GROUP BY 1"""

REPORT = f"""SELECT (SELECT count(*) FROM dirty) AS rows_before, count(*) AS rows_after,
  (SELECT count(*) FROM dirty) - count(*) AS duplicates_removed,
  sum(nulls_before)::BIGINT AS nulls_before, sum(nulls_after)::BIGINT AS nulls_after,
  sum(negative::INTEGER + bad_discount::INTEGER + too_dear::INTEGER)::BIGINT AS outliers_handled,
  (SELECT {rne("count(*) FILTER (n > 1) / count(*) * 100", 1)}
   FROM (SELECT count(order_id) AS n FROM capped WHERE order_status = 'F' GROUP BY customer_id))
    AS repurchase_rate
FROM capped"""

# --- forecast -------------------------------------------------------------------------------


def holt_winters(key: str | None = None, points: str = "") -> str:
    """CTEs hw (one row per series, parameter set and day) and fit (final rows with AIC).

    ``points`` selects ds and y, and the key, where they are not the days of the orders.
    """
    k, kc, kj = (f"{key}, ", f"{key}, ", f" AND p.{key} = hw.{key}") if key else ("", "", "")
    part = f"PARTITION BY {key} " if key else ""
    by = f"GROUP BY {key}" if key else ""
    points = points or f"SELECT {kc}{DAY} AS ds, {REV} AS y FROM done GROUP BY ALL"
    ys = [f"ys[{i}]" for i in range(1, 15)]
    level = f"(({' + '.join(ys[:7])}) / 7)"
    trend = f"((({' + '.join(ys[7:])}) / 7 - {level}) / 7)"
    seasonal = ", ".join(f"ys[{i}] - lv" for i in range(1, 8))
    fitted = [f"(lv + tr + se[{i}])" for i in range(1, 8)]
    sse = " + ".join(f"(ys[{i + 1}] - {f}) * (ys[{i + 1}] - {f})" for i, f in enumerate(fitted))
    return f"""pts AS (
  SELECT {kc}ds, y, row_number() OVER ({part}ORDER BY ds, y) AS i
  FROM ({points})),
ser AS (SELECT {kc}list(y ORDER BY i) AS ys, count(*) AS n, max(ds) AS last FROM pts {by}),
sets AS (
  SELECT row_number() OVER (ORDER BY a, b, g) AS set_no, a, b, g
  FROM (SELECT unnest([0.1, 0.2, 0.3, 0.5]::DOUBLE[]) AS a),
       (SELECT unnest([0.01, 0.05, 0.1]::DOUBLE[]) AS b),
       (SELECT unnest([0.05, 0.1, 0.2, 0.3]::DOUBLE[]) AS g)),
start AS (
  SELECT *, {sse} AS sse
  FROM (SELECT *, [{seasonal}] AS se FROM (SELECT *, {level} AS lv, {trend} AS tr FROM ser))),
hw AS (
  SELECT {k}set_no, a, b, g, 7::BIGINT AS t, lv, tr, se, sse, NULL::DOUBLE AS fit
  FROM start, sets
  UNION ALL
  SELECT {k}set_no, a, b, g, t, lv, tr, se[2:7] || [sn] AS se, sse + (y - fit) * (y - fit) AS sse,
         fit
  FROM (SELECT *, lv + tr + sn AS fit
    FROM (SELECT *, g * (y - lv) + (1 - g) * se[1] AS sn
      FROM (SELECT * EXCLUDE (lv0, tr0), b * (lv - lv0) + (1 - b) * tr0 AS tr
        FROM (SELECT {"hw." + k if key else ""}set_no, a, b, g, t + 1 AS t, y, se, sse,
                     lv AS lv0, tr AS tr0,
                     a * (y - se[1]) + (1 - a) * (lv + tr) AS lv
              FROM hw JOIN pts p ON p.i = hw.t + 1{kj}))))),
fit AS (
  SELECT hw.*, n, last, n * ln(sse / n + 1e-10) + 6 AS aic
  FROM hw JOIN ser ON t = n{f" AND hw.{key} = ser.{key}" if key else ""}),
best AS (
  SELECT * FROM fit QUALIFY row_number() OVER ({part}ORDER BY aic, set_no) = 1)"""


def forecast(key: str | None = None) -> str:
    k = f"{key}, " if key else ""
    pk = f"p.{key}, " if key else ""
    on = f" AND p.{key} = {{}}.{key}" if key else ""
    start_on = f"p.{key} = start.{key}" if key else "true"
    best_on = f"p.{key} = best.{key}" if key else "true"
    return f"""history AS (
  SELECT {pk}p.ds, p.y AS actual,
         CASE WHEN p.i <= 7 THEN start.lv + start.tr + start.se[p.i] ELSE hw.fit END AS predicted
  FROM pts p JOIN start ON {start_on} JOIN best ON {best_on}
  LEFT JOIN hw ON hw.t = p.i AND p.i > 7 AND hw.set_no = best.set_no{on.format("hw")}),
future AS (
  SELECT {k}(last + h::INTEGER)::DATE AS ds, NULL::DOUBLE AS actual,
         greatest(0::DOUBLE, lv + h * tr + se[(h - 1) % 7 + 1]) AS predicted
  FROM best, range(1, 91) r(h)),
forecast AS (
  SELECT *, actual IS NULL AS is_forecast FROM (FROM history UNION ALL FROM future))"""


def with_forecast(select: str, key: str | None = None) -> str:
    return f"WITH RECURSIVE {DONE},\n{holt_winters(key)},\n{forecast(key)}\n{select}"


# --- customers ------------------------------------------------------------------------------

RFM = """snap AS (SELECT max(order_date) AS snapshot FROM done),
rfm AS (
  SELECT customer_id,
         floor(epoch(any_value(snapshot) - max(order_date)) / 86400)::BIGINT AS recency,
         count(order_id) AS frequency, sum(final_amount)::DOUBLE AS monetary,
         min({'t': order_date, 'c': customer_type}).c AS customer_type
  FROM done, snap GROUP BY customer_id)"""


def _edges(metric: str) -> str:
    levels = ", ".join(quantile(f"{metric}_list", i / 5) for i in range(6))
    return f"list_distinct([{levels}]) AS {metric[0]}_edges"


def _score(metric: str) -> str:
    edges = f"{metric[0]}_edges"
    return (
        f"CASE WHEN len({edges}) > 1 THEN greatest(1, len(list_filter({edges}, "
        f"lambda e: e < {metric}))) END"
    )


SCORES = f"""edges AS (
  SELECT {_edges("recency")}, {_edges("frequency")}, {_edges("monetary")} FROM (
    SELECT {sorted_list("recency")} AS recency_list, {sorted_list("frequency")} AS frequency_list,
           {sorted_list("monetary")} AS monetary_list FROM rfm)),
scored AS (
  SELECT rfm.*, (6 - {_score("recency")})::BIGINT AS recency_score,
         ({_score("frequency")})::BIGINT AS frequency_score,
         ({_score("monetary")})::BIGINT AS monetary_score
  FROM rfm, edges)"""

def _far(point: str, centre: str) -> str:
    parts = [f"(({point}.{a} - {centre}.{a}) / sd_{a})" for a in "rfm"]
    return " + ".join(f"{p} * {p}" for p in parts)


def _deviation(a: str) -> str:
    mean, square = f"(sum({a} * w) / sum(w))", f"(sum({a} * {a} * w) / sum(w))"
    spread = f"sqrt(greatest({square} - {mean} * {mean}, 0))"
    return f"CASE WHEN {spread} > 0 THEN {spread} ELSE 1 END AS sd_{a}"


#: Points p, seeded and moved by recursion over lists of centres; ends in ``clustered``.
CLUSTERED = f"""pts AS (
  SELECT *, row_number() OVER (ORDER BY r, f, m) AS pos, row_number() OVER (ORDER BY w DESC, r, f, m) AS heavy
  FROM (SELECT coalesce(recency_score, 1) AS r, coalesce(frequency_score, 1) AS f, coalesce(monetary_score, 1) AS m,
               count(*) AS w FROM scored GROUP BY 1, 2, 3)),
scales AS (SELECT {", ".join(map(_deviation, "rfm"))}, least(5, count(*)) AS k FROM pts),
seeds AS (
  SELECT heavy AS start, 1 AS n, [{{'r': r::DOUBLE, 'f': f::DOUBLE, 'm': m::DOUBLE}}] AS cs FROM pts WHERE heavy <= 10
  UNION ALL
  SELECT start, n + 1, list_append(any_value(cs), first({{'r': r::DOUBLE, 'f': f::DOUBLE, 'm': m::DOUBLE}} ORDER BY gain DESC, pos))
  FROM (SELECT start, n, cs, p.*, k, w * list_min(list_transform(cs, lambda c: {_far("p", "c")})) AS gain
        FROM seeds, pts AS p, scales WHERE n < k)
  GROUP BY start, n),
lloyd AS (
  SELECT start, 0 AS step, cs, false AS done FROM seeds, scales WHERE n = k
  UNION ALL
  SELECT start, step + 1, moved, moved = cs FROM (
    SELECT start, step, any_value(cs) AS cs, list(coalesce(mean, cs[i]) ORDER BY i) AS moved FROM (
      SELECT start, step, any_value(cs) AS cs, i,
             CASE WHEN sum(w) FILTER (near = i) > 0 THEN {{
               'r': sum(r * w) FILTER (near = i) / sum(w) FILTER (near = i),
               'f': sum(f * w) FILTER (near = i) / sum(w) FILTER (near = i),
               'm': sum(m * w) FILTER (near = i) / sum(w) FILTER (near = i)}} END AS mean
      FROM (SELECT start, step, cs, unnest(range(1, len(cs) + 1)) AS i, r, f, m, w,
                   list_position(fars, list_min(fars)) AS near
            FROM (SELECT start, step, cs, p.*, list_transform(cs, lambda c: {_far("p", "c")}) AS fars
                  FROM lloyd, pts AS p, scales WHERE NOT done AND step < 300))
      GROUP BY start, step, i)
    GROUP BY start, step)),
settled AS (SELECT start, arg_max(cs, step) AS cs FROM lloyd GROUP BY start),
cheapest AS (
  SELECT list_sort(cs) AS cs FROM (
    SELECT start, any_value(cs) AS cs,
           sum(w * floor(list_min(list_transform(cs, lambda c: {_far("p", "c")})) * 1000000)::BIGINT) AS cost
    FROM settled, pts AS p, scales GROUP BY start)
  ORDER BY cost, start LIMIT 1),
numbered AS (
  SELECT r, f, m, (list_position(fars, list_min(fars)) - 1)::INTEGER AS cluster
  FROM (SELECT p.*, list_transform(cs, lambda c: {_far("p", "c")}) AS fars FROM cheapest, pts AS p, scales)),
clustered AS (
  SELECT scored.*, cluster FROM scored JOIN numbered
  ON coalesce(recency_score, 1) = r AND coalesce(frequency_score, 1) = f AND coalesce(monetary_score, 1) = m)"""

IDENTITY = "customer_id || '|' || customer_type"
TILE_ORDER = f"md5({IDENTITY}) || '|' || {IDENTITY}"

PER_TYPE = """per AS (
  SELECT customer_id, customer_type, count(order_id) AS n, sum(final_amount) AS spent,
         date_diff('day', min(order_date)::DATE, max(order_date)::DATE) AS lifetime
  FROM done GROUP BY 1, 2)"""

UPLIFT = """days AS (
  SELECT order_date::DATE AS d, isodow(any_value(order_date)) >= 6 AS weekend,
         sum(final_amount) AS r FROM done GROUP BY 1),
up AS (
  SELECT coalesce(sum(r) FILTER (weekend), 0)::DOUBLE / greatest(1, count(*) FILTER (weekend))
           AS weekend_avg,
         coalesce(sum(r) FILTER (NOT weekend), 0)::DOUBLE
           / greatest(1, count(*) FILTER (NOT weekend)) AS weekday_avg FROM days),
uplift AS (
  SELECT *, (weekend_avg - weekday_avg) / greatest(1, weekday_avg) * 100 AS uplift_pct FROM up)"""


def _insights(rows, days: int = 90) -> str:
    selects = []
    for i, (kind, title, detail, suggestion) in enumerate(rows, start=1):
        measured = "{uplift}" in detail
        text = "'" + detail.replace("{days}", str(days)) + "'"
        value = rnd("uplift_pct", 1)
        if measured:
            text = f"replace({text}, '{{uplift}}', printf('%.1f', {value}))"
        selects.append(
            f"SELECT {i}::BIGINT AS position, '{kind}' AS type, '{title}' AS title, "
            f"{text} AS detail, '{suggestion}' AS suggestion, "
            f"{value if measured else 'NULL::DOUBLE'} AS uplift_pct FROM uplift"
        )
    return f"WITH {DONE},\n{UPLIFT}\n" + "\nUNION ALL\n".join(selects)


def _kpi(where: str = "true") -> str:
    return done(f"""SELECT coalesce({REV}, 0) AS total_revenue, count(*) AS total_orders,
  count(DISTINCT customer_id) AS total_customers, {rne(AVG, 2)} AS avg_order_value,
  {rne("(SELECT count(*) FILTER (n > 1) / greatest(1, count(*)) * 100 FROM (SELECT count(order_id)"
       f" AS n FROM done WHERE {where} GROUP BY customer_id))", 1)} AS repurchase_rate
FROM done WHERE {where}""")


def _share(of: str, keys: str) -> str:
    return rne(f"{of} / sum({of}) OVER ({keys}) * 100", 2)


def _weekday(where: str = "true") -> str:
    labels = ", ".join(f"'{label}'" for label in DAY_LABELS)
    return done(f"""SELECT (isodow(order_date) - 1)::INTEGER AS day_of_week,
  ([{labels}])[isodow(order_date)] AS day_name, {REV} AS revenue, count(order_id) AS orders,
  {REV} / (SELECT greatest(1, floor(epoch(max(order_date) - min(order_date)) / 86400) / 7)
           FROM done WHERE {where}) AS avg_revenue
FROM done WHERE {where} GROUP BY 1, 2""")


def _repurchase_by_type(where: str = "true") -> str:
    return done(f"""SELECT customer_type, count(*) AS total, count(*) FILTER (n > 1) AS repeat,
  {rne("count(*) FILTER (n > 1) / count(*) * 100", 1)} AS rate
FROM (SELECT customer_type, count(order_id) AS n FROM done WHERE {where}
      GROUP BY customer_id, customer_type) GROUP BY 1""")


def _trend(where: str = "true") -> str:
    return done(f"""SELECT date, r::DOUBLE AS revenue,
  sum(r) OVER w::DOUBLE / count(*) OVER w AS ma7
FROM (SELECT {DAY} AS date, sum(final_amount) AS r FROM done WHERE {where} GROUP BY 1)
WINDOW w AS (ORDER BY date ROWS 6 PRECEDING)""")


def _export_csv_columns() -> str:
    return f"SELECT {ORDER_LIST} FROM done"


SLICE = (
    "order_date >= TIMESTAMP '1996-01-01' AND order_date <= TIMESTAMP '1998-12-31' "
    "AND region = 'EUROPE'"
)


def oracles() -> dict[str, str]:
    day_sales = (
        f"{DAY} AS date",
        f"{REV} AS revenue, count(order_id) AS orders, count(DISTINCT customer_id) AS customers, "
        f"{AVG} AS avg_order_value",
    )
    cat_month = grouped(f"{YM} AS year_month, category AS category", f"{REV} AS revenue")
    clean = f"WITH {CAPPED_CTES}\nSELECT {ORDER_LIST}, {TIME} FROM capped"
    report = f"WITH {CAPPED_CTES}\n{REPORT}"
    raw_types = f"WITH {RO},\n{FAULTS}\n{RAW_TYPES}"
    region_totals = f"{REV} AS revenue, count(order_id) AS orders"
    customer_orders = grouped(
        "customer_id AS customer_id",
        "count(order_id) AS order_count, sum(final_amount)::DOUBLE AS total_spent",
    )
    q: dict[str, str] = {}

    # Sources and sinks
    q["scan_csv"] = raw_types
    breaks = raw_types.replace(
        "AS order_date, category, product,",
        """AS order_date, category, product || chr(10) || 'say "' || city || '", ' || order_id AS product,""",
    )
    q["scan_csv_breaks"] = breaks
    late_first = ", ".join(f"{c} DESC NULLS LAST" for c in ("order_date", *COLUMNS))
    q["dedup_input_order"] = f"""WITH {RO},\n{FAULTS},
late AS (SELECT * FROM dirty QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {late_first}) = 1)
SELECT {ORDER_LIST} FROM (SELECT * FROM ({COERCED_ROWS.replace("FROM dirty", "FROM late")}))"""
    q["write_clean"] = clean
    q["write_metrics"] = done(f"""SELECT * FROM (
  SELECT 'daily_sales' AS metric, count(DISTINCT {DAY}) AS records, {REV} AS revenue FROM done
  UNION ALL SELECT 'category_contribution', count(DISTINCT category), {REV} FROM done
  UNION ALL SELECT 'customer_orders', count(DISTINCT customer_id), {REV} FROM done
  UNION ALL SELECT 'monthly_region', count(DISTINCT {YM} || region), {REV} FROM done)""")
    q["write_report"] = report
    q["create_table"] = f"""WITH {RO}
SELECT {YM} AS year_month, count(*) AS records, {REV} AS revenue FROM ro
WHERE order_date >= TIMESTAMP '1997-03-15' AND order_date <= TIMESTAMP '1998-02-10' GROUP BY 1"""
    first_copy = UNIQUE[UNIQUE.index("QUALIFY"):].rstrip(")").rsplit(" = 1", 1)[0]
    q["insert_new_orders"] = f"""WITH {RO},
copies AS (SELECT *, {first_copy.removeprefix("QUALIFY ")} AS copy, order_date >= TIMESTAMP '1998-01-01' AS late FROM ro)
SELECT {YM} AS year_month, count(*) FILTER (copy = 1) AS records,
  (sum(final_amount) FILTER (copy = 1))::DOUBLE AS revenue,
  count(*) FILTER (copy > 1) + count(*) FILTER (copy > 1 AND year(order_date) = 1997) AS repeated,
  count(*) FILTER (copy = 1 AND year(order_date) = 1997) AS existing
FROM copies GROUP BY 1"""
    q["export_completed"] = done(_export_csv_columns())
    q["export_summary"] = cat_month
    q["load_orders"] = done(f"SELECT {ORDER_LIST}, {TIME} FROM done")

    # Cleaning
    q["clean_types"] = raw_types
    q["clean_dedup"] = f"WITH {UNIQUE_CTES}\nSELECT {ORDER_LIST} FROM uniq"
    q["null_profile"] = f"""WITH {CAPPED_CTES}
SELECT sum(nulls_before)::BIGINT AS nulls_before, sum(nulls_after)::BIGINT AS nulls_after
FROM capped"""
    q["impute_price"] = f"""WITH {IMPUTED_CTES}
SELECT order_id, category, unit_price FROM imputed"""
    q["clean_missing"] = f"""WITH {IMPUTED_CTES}
SELECT * REPLACE (total_amount::DECIMAL(14,2) AS total_amount,
                  final_amount::DECIMAL(14,2) AS final_amount)
FROM (SELECT {ORDER_LIST} FROM imputed)"""
    q["clean_outliers"] = f"WITH {CAPPED_CTES}\nSELECT {ORDER_LIST} FROM capped"
    q["iqr_cap"] = f"WITH {CAPPED_CTES}\n{IQR_CAP}"
    q["time_features"] = f"WITH {RO}\nSELECT order_id, order_date, product, {TIME} FROM ro"
    q["clean_report"] = report
    q["clean_orders"] = clean
    text_ctes = ",\n".join([RO, FAULTS, f"coerced AS ({RAW_TYPES})", UNIQUE, IMPUTED, CAPPED])
    q["clean_text"] = f"WITH {text_ctes}\nSELECT {ORDER_LIST}, {TIME} FROM capped"
    q["text_iqr_cap"] = f"WITH {text_ctes}\n{IQR_CAP}"

    # Filters
    q["kpi"] = _kpi()
    q["kpi_filtered"] = _kpi("category = 'PROMO' AND region = 'ASIA' AND year(order_date) = 1997")
    q["daily_sales_range"] = grouped(
        f"{DAY} AS date",
        f"{REV} AS revenue, count(order_id) AS orders",
        where="order_date >= TIMESTAMP '1996-05-01' AND order_date <= TIMESTAMP '1997-04-30'",
    )
    q["filter_values"] = f"""WITH {RO}
SELECT DISTINCT 'category' AS name, category AS value FROM ro WHERE category IS NOT NULL
UNION ALL SELECT DISTINCT 'region', region FROM ro WHERE region IS NOT NULL"""
    q["date_bounds"] = f"""WITH {RO}
SELECT min({DAY}) AS first_day, max({DAY}) AS last_day FROM ro"""
    q["dashboard_slice"] = _kpi(SLICE)
    q["dashboard_trend"] = _trend(SLICE)
    q["dashboard_weekday"] = _weekday(SLICE)
    q["dashboard_category"] = grouped("category AS category", f"{REV} AS revenue", where=SLICE)
    q["dashboard_region"] = grouped("region AS region", f"{REV} AS revenue", where=SLICE)
    q["dashboard_repurchase"] = _repurchase_by_type(SLICE)
    q["dashboard_category_trend"] = grouped(
        f"{YM} AS year_month, category AS category", f"{REV} AS revenue", where=SLICE
    )

    # Sales
    q["daily_sales"] = grouped(*day_sales)
    q["category_contribution"] = done(f"""SELECT category, revenue, orders, avg_price, customers,
  {_share("revenue", "")} AS revenue_pct
FROM (SELECT category, {REV} AS revenue, count(order_id) AS orders,
             sum(unit_price)::DOUBLE / count(unit_price) AS avg_price,
             count(DISTINCT customer_id) AS customers FROM done GROUP BY 1)""")
    q["customer_orders"] = customer_orders
    q["repurchase_overall"] = done(f"""SELECT count(*) AS customers,
  count(*) FILTER (n > 1) AS repeat_customers,
  {rne("count(*) FILTER (n > 1) / count(*) * 100", 1)} AS repurchase_rate
FROM (SELECT count(order_id) AS n FROM done GROUP BY customer_id)""")
    q["monthly_region"] = grouped(f"{YM} AS year_month, region AS region", region_totals)
    q["avg_daily_revenue"] = done(f"""SELECT sum(r)::DOUBLE / count(r) AS avg_daily_revenue
FROM (SELECT sum(final_amount) AS r FROM done GROUP BY {DAY})""")
    q["category_sales"] = done(f"""SELECT *, {_share("revenue", "")} AS revenue_pct
FROM (SELECT category, {REV} AS revenue, count(order_id) AS orders FROM done
      WHERE region = 'AMERICA' GROUP BY 1)""")
    q["region_sales"] = grouped("region AS region", region_totals, where="category = 'LARGE'")
    q["monthly_sales"] = done(f"""SELECT *,
  {rne("(revenue - lag(revenue) OVER (ORDER BY year_month))"
       " / lag(revenue) OVER (ORDER BY year_month) * 100", 2)} AS mom_growth
FROM (SELECT {YM} AS year_month, {REV} AS revenue, count(order_id) AS orders,
             count(DISTINCT customer_id) AS customers FROM done GROUP BY 1)""")
    q["repurchase_by_type"] = _repurchase_by_type()
    q["weekend_uplift"] = f"WITH {DONE},\n{UPLIFT}\nFROM uplift"
    q["weekday_average"] = _weekday()
    q["category_total"] = grouped("category AS category", f"{REV} AS revenue")
    q["category_month"] = cat_month
    q["region_multi"] = grouped("region AS region", day_sales[1])
    q["channel_sales"] = grouped("channel AS channel", region_totals)
    q["row_counts"] = f"""WITH {RO}
SELECT count(*) AS records, count(*) FILTER (order_status = 'F') AS completed_records,
       count(*) > 0 AS healthy FROM ro"""

    # Catalogue
    q["monthly_mom_yoy"] = done(f"""SELECT m.ym AS year_month, m.r AS revenue, m.orders, m.customers,
  m.aov AS avg_order_value, {rnd("(m.r - p.r) / p.r * 100", 2)} AS mom_growth_pct,
  {rnd("(m.r - y.r) / y.r * 100", 2)} AS yoy_growth_pct
FROM mon m LEFT JOIN mon p ON p.d = m.d - INTERVAL 1 MONTH
           LEFT JOIN mon y ON y.d = m.d - INTERVAL 1 YEAR""").replace(
        "\nSELECT m.ym",
        f""",
mon AS (SELECT {YM} AS ym, date_trunc('month', any_value(order_date)) AS d, {REV} AS r,
               count(order_id) AS orders, count(DISTINCT customer_id) AS customers, {AVG} AS aov
        FROM done GROUP BY 1)
SELECT m.ym""",
        1,
    )
    q["region_month_rank"] = done(f"""SELECT *,
  rank() OVER (PARTITION BY year_month ORDER BY revenue DESC) AS region_rank
FROM (SELECT region, {YM} AS year_month, {REV} AS revenue, count(order_id) AS order_count,
             count(DISTINCT customer_id) AS customer_count, {rnd(AVG, 2)} AS avg_order_value,
             {rnd(f"{REV} / count(DISTINCT customer_id)", 2)} AS revenue_per_customer
      FROM done GROUP BY 1, 2)""")
    q["category_contribution_monthly"] = done(f"""SELECT *,
  {_share("revenue", "PARTITION BY year_month")} AS contribution_pct,
  {rnd("(revenue - lag(revenue) OVER c)::DECIMAL(18,2)::DOUBLE / lag(revenue) OVER c * 100", 2)}
    AS mom_change_pct
FROM (SELECT category, {YM} AS year_month, {REV} AS revenue, count(order_id) AS order_count
      FROM done GROUP BY 1, 2)
WINDOW c AS (PARTITION BY category ORDER BY year_month)""")
    q["repurchase_ltv"] = f"""WITH {DONE},
{PER_TYPE}
SELECT customer_type, count(*) AS total_customers, count(*) FILTER (n > 1) AS repeat_customers,
  {rnd("count(*) FILTER (n > 1) / count(*) * 100", 2)} AS repurchase_rate_pct,
  {rnd("avg(n)", 2)} AS avg_orders_per_customer,
  {rnd("sum(spent)::DOUBLE / count(spent)", 2)} AS avg_lifetime_value,
  {rnd("avg(lifetime)", 1)} AS avg_lifetime_days
FROM per GROUP BY 1"""
    q["channel_month"] = grouped(
        f"channel AS channel, {YM} AS year_month",
        f"count(order_id) AS orders, {REV} AS revenue, count(DISTINCT customer_id) AS customers, "
        f"{rnd(AVG, 2)} AS avg_order_value, "
        f"{rnd('sum(discount_rate)::DOUBLE / count(discount_rate) * 100', 2)} AS avg_discount_pct",
    )
    q["weekend_vs_weekday"] = grouped(
        f"CASE WHEN isodow(order_date) >= 6 THEN '{WEEKEND_LABEL}' ELSE '{WORKDAY_LABEL}' END "
        f"AS day_type, {YM} AS year_month",
        f"count(order_id) AS order_count, {REV} AS revenue, {rnd(AVG, 2)} AS avg_order_value, "
        "count(DISTINCT customer_id) AS customer_count",
    )
    q["payment_mix"] = grouped(
        "payment_method AS payment_method",
        f"count(order_id) AS order_count, {REV} AS total_revenue, {rnd(AVG, 2)} AS avg_amount, "
        f"{rnd('count(order_id) / (SELECT count(*) FROM done) * 100', 2)} AS pct_of_orders",
    )
    q["rfm_top100"] = f"""WITH {DONE},
cust AS (
  SELECT customer_id, customer_type, count(order_id) AS frequency, sum(final_amount) AS spent,
         max(order_date)::DATE AS recency_date FROM done GROUP BY 1, 2),
aged AS (
  SELECT *, date_diff('day', recency_date, DATE '2002-01-01') AS recency_days,
         {TILE_ORDER} AS tie FROM cust)
SELECT customer_id, customer_type, frequency, spent::DOUBLE AS monetary, recency_date,
       recency_days,
       {rnd("ntile(5) OVER (ORDER BY recency_days, tie) * 0.3::DOUBLE"
            " + ntile(5) OVER (ORDER BY frequency, tie) * 0.3::DOUBLE"
            " + ntile(5) OVER (ORDER BY spent, tie) * 0.4::DOUBLE", 2)} AS rfm_score
FROM aged ORDER BY rfm_score DESC, monetary DESC, customer_id, customer_type LIMIT 100"""
    q["decline_alert"] = done(f"""SELECT category, year_month, r::DOUBLE AS revenue,
  change::DOUBLE AS month_over_month_change, falls::BIGINT AS consecutive_declines
FROM (SELECT *, count(*) FILTER (change < 0) OVER (PARTITION BY category ORDER BY year_month
                                                   ROWS 2 PRECEDING) AS falls
      FROM (SELECT *, r - lag(r) OVER (PARTITION BY category ORDER BY year_month) AS change
            FROM (SELECT category, {YM} AS year_month, sum(final_amount) AS r FROM done
                  GROUP BY 1, 2))
      WHERE change IS NOT NULL)
WHERE falls >= 2""")

    # Trends and forecast
    q["moving_average"] = done(f"""SELECT date, r::DOUBLE AS revenue, orders,
  CASE WHEN count(*) OVER w7 = 7 THEN sum(r) OVER w7::DOUBLE / 7 END AS ma7,
  CASE WHEN count(*) OVER w30 = 30 THEN sum(r) OVER w30::DOUBLE / 30 END AS ma30
FROM (SELECT {DAY} AS date, sum(final_amount) AS r, count(order_id) AS orders FROM done GROUP BY 1)
WINDOW w7 AS (ORDER BY date ROWS 6 PRECEDING), w30 AS (ORDER BY date ROWS 29 PRECEDING)""")
    q["trend_ma7"] = _trend()
    q["daily_series"] = grouped(f"{DAY} AS ds", f"{REV} AS y, count(order_id) AS order_count")
    q["hw_grid"] = f"""WITH RECURSIVE {DONE},
{holt_winters()}
SELECT a AS alpha, b AS beta, g AS gamma, aic FROM fit"""
    q["event_series_grid"] = f"""WITH RECURSIVE {holt_winters("event_type", """
  SELECT event_type, ts AS ds, value AS y FROM events WHERE ts IS NOT NULL AND value IS NOT NULL""")}
SELECT event_type, a AS alpha, b AS beta, g AS gamma, {rnd("aic", 4)} AS aic
FROM fit WHERE n >= 14"""
    q["sales_forecast_in_blocks"] = with_forecast(
        f"""SELECT category, row_number() OVER (PARTITION BY category ORDER BY ds) - 1 AS n,
  CASE WHEN NOT is_forecast THEN ds END AS t, actual, {rnd("predicted", 2)} AS predicted, is_forecast
FROM forecast""", "category")
    q["sales_forecast"] = with_forecast("FROM forecast")
    q["sales_forecast_by_category"] = with_forecast("FROM forecast", "category")
    q["forecast_total"] = with_forecast(
        f"SELECT {rnd('sum(predicted)', 2)} AS forecast_total, count(*) AS forecast_days "
        "FROM forecast WHERE is_forecast"
    )
    q["forecast_overlay"] = with_forecast("""SELECT ds AS date, actual AS revenue,
  CASE WHEN NOT is_forecast THEN sum(actual::DECIMAL(18,2)) OVER w::DOUBLE / count(actual) OVER w
  END AS ma7,
  CASE WHEN is_forecast THEN predicted END AS predicted
FROM forecast WINDOW w AS (ORDER BY ds ROWS 6 PRECEDING)""")

    # Customers
    q["rfm"] = f"WITH {DONE},\n{RFM}\nFROM rfm"
    q["rfm_scores"] = f"WITH {DONE},\n{RFM},\n{SCORES}\nFROM scored"
    profiled = """prof AS (
  SELECT {cluster} AS cluster, avg(recency) AS avg_recency, avg(frequency) AS avg_frequency,
         sum(monetary::DECIMAL(14,2))::DOUBLE / count(*) AS avg_monetary, count(*) AS count
  FROM {rows} GROUP BY 1),"""
    segments = f"""high AS (
  SELECT {quantile("ms", 0.7)} AS m, {quantile("fs", 0.7)} AS f, {quantile("rs", 0.7)} AS r,
         {quantile("fs", 0.3)} AS low_f
  FROM (SELECT {sorted_list("avg_monetary")} AS ms, {sorted_list("avg_frequency")} AS fs,
               {sorted_list("avg_recency")} AS rs FROM prof)),
named AS (SELECT prof.*, CASE WHEN avg_monetary > m THEN '{SEGMENT_HIGH_VALUE}'
  WHEN avg_frequency > f THEN '{SEGMENT_HIGH_FREQUENCY}'
  WHEN avg_recency > r THEN '{SEGMENT_CHURN_RISK}'
  WHEN avg_frequency < low_f THEN '{SEGMENT_LOW_ACTIVITY}'
  ELSE '{SEGMENT_POTENTIAL}' END AS segment
FROM prof, high)"""
    groups = profiled.format(cluster="customer_type", rows="rfm")
    named = f"WITH {DONE},\n{RFM},\n{groups}\n{segments}"
    groups = profiled.format(cluster="cluster", rows="clustered")
    clustered = f"WITH RECURSIVE {DONE},\n{RFM},\n{SCORES},\n{CLUSTERED},\n{groups}\n{segments}"
    q["customer_segments"] = f"{clustered} SELECT clustered.*, segment FROM clustered JOIN named USING (cluster)"
    q["cluster_profile"] = f"{clustered} SELECT * FROM prof"
    q["segment_summary"] = f"""{clustered}
SELECT segment, count(*) AS customer_count, avg(recency) AS avg_recency_days,
  avg(frequency) AS avg_orders, sum(monetary::DECIMAL(14,2))::DOUBLE / count(*) AS avg_lifetime_value
FROM clustered JOIN named USING (cluster) GROUP BY 1"""
    q["segment_sizes"] = f"""{clustered}
SELECT segment, count(*) AS count, sum(monetary::DECIMAL(14,2))::DOUBLE / count(*) AS avg_monetary
FROM clustered JOIN named USING (cluster) GROUP BY 1"""
    q["segment_naming"] = f"{named} SELECT * FROM named"
    q["group_profile"] = f"{named} SELECT * FROM prof"
    q["group_summary"] = f"""{named}
SELECT segment, count(*) AS customer_count, avg(recency) AS avg_recency_days,
  avg(frequency) AS avg_orders, sum(monetary::DECIMAL(14,2))::DOUBLE / count(*) AS avg_lifetime_value
FROM rfm JOIN named ON customer_type = cluster GROUP BY 1"""
    q["group_sizes"] = f"""{named}
SELECT segment, count(*) AS count, sum(monetary::DECIMAL(14,2))::DOUBLE / count(*) AS avg_monetary
FROM rfm JOIN named ON customer_type = cluster GROUP BY 1"""
    for metric in ("daily_sales", "category_contribution", "customer_orders", "monthly_region"):
        q[f"stored_{metric}"] = q[metric]
    q["insights"] = _insights(REPORT_ROWS)
    q["insights_service"] = _insights(SERVICE_ROWS)
    return q
