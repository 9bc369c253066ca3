"""The same queries as SQL, for an independent engine over the same tables."""

from __future__ import annotations

from demandkit.functions.geo import EARTH_RADIUS
from demandkit.operators.calendar import ALL_STATES, HOLIDAY_RULES

STORE_STATE = "CASE WHEN store % 2 = 0 THEN 'HE' ELSE 'RP' END"

# --- shared parts ---------------------------------------------------------------

LINES = """
lines AS (
  SELECT n_regionkey AS store, p_type AS product, CAST(l_shipdate AS DATE) AS date,
         CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE l_quantity END AS sales,
         l_extendedprice AS price, l_discount AS discount, l_returnflag AS returnflag,
         o_orderpriority AS priority, (l_linestatus = 'F') AS fulfilled
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
)"""


def _most_frequent(column: str) -> str:
    return f"""
vote_{column} AS (
  SELECT store, product, date, {column} FROM (
    SELECT store, product, date, {column},
           row_number() OVER (PARTITION BY store, product, date
                              ORDER BY count(*) DESC, ({column} IS NULL), {column}) AS place
    FROM lines GROUP BY store, product, date, {column}) WHERE place = 1
)"""


GRAIN = f"""{LINES}, {_most_frequent('returnflag')}, {_most_frequent('priority')},
grain AS (
  SELECT store, product, date, sales, price, discount, returnflag, priority, fulfilled
  FROM (SELECT store, product, date, sum(sales) AS sales, avg(price) AS price, avg(discount) AS discount,
               avg(CASE WHEN fulfilled THEN 1.0::DOUBLE ELSE 0.0 END) AS fulfilled
        FROM lines GROUP BY store, product, date)
  JOIN vote_returnflag USING (store, product, date)
  JOIN vote_priority USING (store, product, date)
)"""


def _recent_mode(column: str) -> str:
    return f"""
mode_{column} AS (
  SELECT store, product, {column} FROM (
    SELECT store, product, {column},
           row_number() OVER (PARTITION BY store, product ORDER BY count(*) DESC, {column}) AS place
    FROM recent WHERE {column} IS NOT NULL GROUP BY store, product, {column}) WHERE place = 1
)"""


PROFILE = f"""{GRAIN},
recent AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store, product ORDER BY date DESC) AS recency FROM grain)
  WHERE recency <= 3
), {_recent_mode('returnflag')}, {_recent_mode('priority')},
profile AS (
  SELECT store, product, last_date, recent_sales, price, discount, returnflag, priority, fulfilled
  FROM (SELECT store, product, max(date) AS last_date, avg(sales) AS recent_sales, avg(price) AS price,
               avg(discount) AS discount, avg(fulfilled) AS fulfilled
        FROM recent GROUP BY store, product)
  LEFT JOIN mode_returnflag USING (store, product)
  LEFT JOIN mode_priority USING (store, product)
)"""

CURATED = f"""{PROFILE},
ahead AS (
  SELECT CAST(last_date + CAST(n AS INTEGER) AS DATE) AS date, CAST(n AS INTEGER) AS day_no
  FROM (SELECT max(last_date) AS last_date FROM profile), range(1, 8) AS r(n)
),
template AS (
  SELECT store, product, date, CAST(NULL AS DOUBLE) AS sales, price, discount, returnflag, priority, fulfilled
  FROM profile, ahead
),
curated AS (
  SELECT store, product, date, sales, price, discount, returnflag, priority, fulfilled FROM grain
  UNION ALL
  SELECT store, product, date, sales, price, discount, returnflag, priority, fulfilled FROM template
)"""


def _units(expression: str) -> str:
    return f"CAST(round_even(round({expression}, 6), 0) AS BIGINT)"


def _range(low: str, high: str) -> str:
    return f"CAST({_units(low)} AS VARCHAR) || ' - ' || CAST({_units(high)} AS VARCHAR)"


ORDERS = f"""{CURATED},
predictions AS (
  SELECT store, product, date, day_no, recent_sales AS forecast,
         recent_sales * 0.85::DOUBLE AS order_from, recent_sales * 1.15::DOUBLE AS order_to
  FROM profile, ahead
),
totals AS (
  SELECT store, product,
         sum(CASE WHEN day_no = 1 THEN forecast END) AS f1, sum(CASE WHEN day_no = 1 THEN order_from END) AS a1,
         sum(CASE WHEN day_no = 1 THEN order_to END) AS b1,
         sum(CASE WHEN day_no = 2 THEN forecast END) AS f2, sum(CASE WHEN day_no = 2 THEN order_from END) AS a2,
         sum(CASE WHEN day_no = 2 THEN order_to END) AS b2,
         sum(forecast) AS f7, sum(order_from) AS a7, sum(order_to) AS b7
  FROM predictions GROUP BY store, product
),
horizons AS (
  SELECT store, product,
         {_units('f1')} AS tomorrow_order_qty, {_range('a1', 'b1')} AS tomorrow_order_range,
         {_units('f2')} AS day_after_order_qty, {_range('a2', 'b2')} AS day_after_order_range,
         {_units('f7')} AS next7_order_qty, {_range('a7', 'b7')} AS next7_order_range
  FROM totals
),
order_table AS (
  SELECT CAST(row_number() OVER (PARTITION BY store ORDER BY product) AS INTEGER) AS id, * FROM horizons
)"""

BOUNDS = f"""{CURATED},
spans AS (
  SELECT min(date) AS start, max(date) AS "end", min(CASE WHEN sales IS NULL THEN date END) AS pred_cutoff FROM curated
),
bounds AS (
  SELECT *, CAST(pred_cutoff - start AS INTEGER) AS timespan,
         CAST(floor((pred_cutoff - start) * 0.75::DOUBLE) AS INTEGER) AS train_span,
         CAST(start + CAST(floor((pred_cutoff - start) * 0.75::DOUBLE) AS INTEGER) AS DATE) AS cutoff_date
  FROM spans
)"""

SPLIT = """CASE WHEN date >= pred_cutoff THEN 'predict' WHEN date <= cutoff_date THEN 'train' ELSE 'test' END"""

# Easter by Gauss's rule with the Gregorian corrections, independent of the
# computus used in the library.
EASTER = """
easter_parts AS (
  SELECT year, year % 19 AS a, year % 4 AS b, year % 7 AS c, year // 100 AS k FROM years
),
easter_moon AS (
  SELECT *, (15 - (13 + 8 * k) // 25 + k - k // 4) % 30 AS m, (4 + k - k // 4) % 7 AS n FROM easter_parts
),
easter_days AS (
  SELECT *, (19 * a + m) % 30 AS d,
         (2 * b + 4 * c + 6 * ((19 * a + m) % 30) + n) % 7 AS e FROM easter_moon
),
easter AS (
  SELECT year,
         CAST(make_date(CAST(year AS INTEGER), 3, 22) + CAST(
           CASE WHEN d = 29 AND e = 6 THEN d + e - 7
                WHEN d = 28 AND e = 6 AND (11 * m + 11) % 30 < 19 THEN d + e - 7
                ELSE d + e END AS INTEGER) AS DATE) AS sunday
  FROM easter_days
)"""


def _holiday_sql(states) -> str:
    """Holidays of the given states in the years of a table ``years``."""
    parts = []
    for name, in_states, rule, a, b, since, until in HOLIDAY_RULES:
        chosen = [s for s in in_states if s in states]
        if not chosen:
            continue
        if rule == "fixed":
            date, priority = f"make_date(CAST(year AS INTEGER), {a}, {b})", 0
        elif rule == "easter":
            date, priority = f"CAST(sunday + ({a}) AS DATE)", 1
        else:
            limit = f"make_date(CAST(year AS INTEGER), {a}, {b})"
            date = f"CAST({limit} - CAST(((isodow({limit}) + 3) % 7 + 1) AS INTEGER) AS DATE)"
            priority = 0
        listed = ", ".join(f"'{s}'" for s in chosen)
        parts.append(
            f"SELECT unnest([{listed}]) AS state, {date} AS date, '{name}' AS holiday_name, {priority} AS priority "
            f"FROM easter WHERE year BETWEEN {since or 0} AND {until or 9999}"
        )
    union = "\n  UNION ALL ".join(parts)
    return f"""{EASTER},
all_holidays AS (
  {union}
),
holidays AS (
  SELECT state, date, holiday_name FROM (
    SELECT *, row_number() OVER (PARTITION BY state, date ORDER BY priority, holiday_name) AS place FROM all_holidays)
  WHERE place = 1
)"""


CALENDAR_FIELDS = """
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(day(date) AS INTEGER) AS day, CAST(week(date) AS INTEGER) AS week,
         CAST(isodow(date) AS INTEGER) AS weekday,
         CASE WHEN month(date) IN (3, 4, 5) THEN 'spring' WHEN month(date) IN (6, 7, 8) THEN 'summer'
              WHEN month(date) IN (9, 10, 11) THEN 'fall' ELSE 'winter' END AS season,
         holiday_name IS NOT NULL AS is_holiday, holiday_name,
         isodow(date) >= 6 AS is_weekend,
         (holiday_name IS NOT NULL OR isodow(date) >= 6) AS is_free_day,
         (holiday_name IS NOT NULL OR isodow(date) = 7) AS is_shops_closed"""

WEATHER = """
observed AS (
  SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%m/%d/%Y %H:%M:%S') AS date_time,
         value - 1 AS minimum_temperature, value + 1 AS maximum_temperature, value AS temperature,
         value / 2 AS relative_humidity, value + 2 AS heat_index, value / 4 AS wind_speed, value / 8 AS wind_gust,
         CAST(event_id % 360 AS DOUBLE) AS wind_direction, value - 3 AS wind_chill, value / 16 AS precipitation,
         CAST(user_id % 5 AS DOUBLE) AS snow_depth, CAST(user_id % 100 AS DOUBLE) AS cloud_cover,
         max(CAST(ts AS DATE)) OVER () AS last_day
  FROM events
),
sources AS (
  SELECT 1 AS source, * FROM observed WHERE day <= last_day - 6
  UNION ALL
  SELECT 0 AS source, event_id, day, date_time, temperature + 10 AS minimum_temperature,
         temperature + 10 AS maximum_temperature, temperature + 10 AS temperature, relative_humidity, heat_index,
         wind_speed, wind_gust, wind_direction, wind_chill,
         precipitation * CASE WHEN temperature / 100 >= 0.5 THEN 1 ELSE 0 END AS precipitation,
         snow_depth, cloud_cover, last_day
  FROM observed WHERE day > last_day - 7
),
hourly AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY date_time ORDER BY source DESC, event_id DESC) AS place FROM sources)
  WHERE place = 1
),
weather AS (
  SELECT day AS date, min(minimum_temperature) AS minimum_temperature,
         max(maximum_temperature) AS maximum_temperature, avg(temperature) AS temperature,
         avg(relative_humidity) AS relative_humidity, avg(heat_index) AS heat_index, avg(wind_speed) AS wind_speed,
         avg(wind_gust) AS wind_gust, avg(wind_direction) AS wind_direction, avg(wind_chill) AS wind_chill,
         avg(precipitation) AS precipitation, avg(snow_depth) AS snow_depth, avg(cloud_cover) AS cloud_cover
  FROM hourly WHERE day < last_day GROUP BY day
)"""

#: The curated columns by their type.
MODEL_CATEGORIES = ("product", "returnflag", "priority")
MODEL_NUMBERS = ("store", "price", "discount", "fulfilled")

ORDER_ENTITY = """
entity AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS totalprice, o_orderstatus AS status,
         o_orderpriority AS priority, (o_orderpriority = '1-URGENT') AS urgent FROM orders
)"""


def _day_mode(relation: str, column: str) -> str:
    return f"""
top_{relation}_{column} AS (
  SELECT date, {column} FROM (
    SELECT date, {column}, row_number() OVER (PARTITION BY date ORDER BY count(*) DESC, {column}) AS place
    FROM {relation} WHERE {column} IS NOT NULL GROUP BY date, {column}) WHERE place = 1
)"""


INVOICE_ROWS = """
  SELECT l_orderkey * 10 + l_linenumber AS "index", CAST(1 AS INTEGER) AS store, p_name AS product,
         CAST(l_shipdate AS DATE) AS date,
         CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE l_quantity END AS sales, o_totalprice AS invoice_total,
         CASE WHEN o_custkey % 7 <> 0 THEN 'cat_' || CAST(o_custkey % 5 AS VARCHAR) END AS "customerCategory_id",
         'cat_' || CAST(o_custkey % 3 AS VARCHAR) AS "tableArea_id",
         'cat_' || substr(o_orderpriority, 1, 1) AS "paymentMethod_id_x",
         'city ' || CAST(o_custkey % 13 AS VARCHAR) AS address_city, l_returnflag = 'R' AS item_retour,
         p_brand AS productgroup_name, 'clerk ' || CAST(o_custkey % 11 AS VARCHAR) AS user_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

WINDOW_START = "CAST(first + CAST(29 * ((CAST(l_shipdate AS DATE) - first) // 29) AS INTEGER) AS DATE)"
SPAN = """
span AS (
  SELECT min(CAST(l_shipdate AS DATE)) AS first, max(CAST(l_shipdate AS DATE)) + 1 AS today FROM lineitem
),
windows AS (
  SELECT CAST(first + CAST(29 * n AS INTEGER) AS DATE) AS start_date,
         CAST(first + CAST(29 * n + 28 AS INTEGER) AS DATE) AS end_date, today
  FROM span, range(0, 10000) AS r(n) WHERE first + CAST(29 * n AS INTEGER) < today
)"""
WINDOW_FILE = "'sales_' || strftime(start_date, '%Y-%m-%d') || '_' || strftime(end_date, '%Y-%m-%d') || '.csv'"

SHOWN_ORDER = "id, store, product, tomorrow_order_qty, tomorrow_order_range, day_after_order_qty, day_after_order_range, next7_order_qty, next7_order_range"


def _r(value: str, digits: int) -> str:
    """A little more than half goes up, so that the noise of additions cannot decide a tie."""
    return f"round({value} + 1e-{digits + 3}, {digits})"


def _cut(columns: str, digits: int = 6) -> str:
    return ", ".join(f"{_r(c.strip(), digits)} AS {c.strip()}" for c in columns.split(","))


WEATHER_COLUMNS = (
    "minimum_temperature, maximum_temperature, temperature, relative_humidity, heat_index, wind_speed, wind_gust, "
    "wind_direction, wind_chill, precipitation, snow_depth, cloud_cover"
)

SKEW = """CASE WHEN count(totalprice) < 3 THEN NULL WHEN min(totalprice) = max(totalprice) THEN 0.0
              ELSE skewness(totalprice) END"""

def _coverage_sql() -> str:
    """Feature definitions spelled out, each with the rows that carry a value: a
    spread needs two rows on the day, a skew three."""
    days = {"holiday_name": "with_holiday"}
    found = [(f"{p}__date", "sales", "date", p, "total") for p in ("day", "week", "month", "weekday")]
    for c in ("year", "month", "day", "week", "weekday", "season", "is_holiday", "holiday_name", "is_weekend",
              "is_free_day", "is_shops_closed"):
        found.append((f"days__{c}", "days", c, "direct", days.get(c, "total")))
    entities = {
        "sales": (("price", "discount", "fulfilled"), ("product", "returnflag", "priority"), ()),
        "orders": (("totalprice",), ("status", "priority"), ("urgent",)),
    }
    for entity, (numbers, categories, flags) in entities.items():
        found.append((f"days__count__{entity}", entity, "", "count", "total"))
        for c in numbers:
            for primitive, rows in (("sum", 1), ("std", 2), ("max", 1), ("skew", 3), ("min", 1), ("mean", 1)):
                found.append((f"days__{primitive}__{entity}__{c}", entity, c, primitive, f"{entity}_{rows}"))
        for c in categories:
            for primitive in ("num_unique", "mode"):
                found.append((f"days__{primitive}__{entity}__{c}", entity, c, primitive, f"{entity}_1"))
        for c in flags:
            found.append((f"days__percent_true__{entity}__{c}", entity, c, "percent_true", f"{entity}_1"))
    listed = " UNION ALL ".join(
        f"SELECT '{n}' AS name, '{e}' AS entity, '{c}' AS \"column\", '{p}' AS primitive, {m} AS non_null FROM measured"
        for n, e, c, p, m in found
    )
    counts = ", ".join(
        f"count(CASE WHEN {n} >= {k} THEN 1 END) AS {e}_{k}" for e, n in (("sales", "n_sales"), ("orders", "n_orders"))
        for k in (1, 2, 3)
    )
    return f"""WITH {BOUNDS}, {ORDER_ENTITY}, years AS (SELECT DISTINCT year(date) AS year FROM curated),
        {_holiday_sql(['HE', 'RP'])},
        o AS (SELECT date, count(*) AS n_orders FROM entity, bounds WHERE date BETWEEN start AND "end" GROUP BY date),
        s AS (SELECT date, count(*) AS n_sales FROM curated GROUP BY date),
        placed AS (SELECT *, {STORE_STATE} AS state FROM curated),
        measured AS (SELECT count(*) AS total, count(holiday_name) AS with_holiday, {counts}
          FROM placed LEFT JOIN holidays USING (state, date) LEFT JOIN o USING (date) LEFT JOIN s USING (date))
        {listed}"""


def oracle_sql() -> dict[str, str]:
    rows = f"{_cut('sales, price, discount')}, returnflag, priority, {_cut('fulfilled')}"
    export = {
        "order_export_tomorrow": ("tomorrow_order_qty", "Bestellung Morgen"),
        "order_export_day_after_tomorrow": ("day_after_order_qty", "Bestellung Übermorgen"),
        "order_export_next_seven_days": ("next7_order_qty", "Bestellung nächste 7 Tage"),
    }
    queries = {
        "order_plan": f"WITH {ORDERS} SELECT {SHOWN_ORDER} FROM order_table",
        "sales_grain": f"WITH {GRAIN} SELECT store, product, date, {rows} FROM grain",
        "recent_profiles": f"""WITH {PROFILE} SELECT store, product, last_date, {_cut('recent_sales, price, discount')},
            returnflag, priority, {_cut('fulfilled')} FROM profile""",
        "future_days": f"""WITH {CURATED} SELECT store, product, date, {rows} FROM template""",
        "assortment_days": f"""WITH {CURATED},
            listed AS (SELECT DISTINCT p_size % 7 AS store, p_type AS product FROM part)
            SELECT store, product, date, {_cut('price')}, returnflag
            FROM listed LEFT JOIN profile USING (store, product) CROSS JOIN ahead""",
        "curated_sales": f"WITH {CURATED} SELECT store, product, date, {rows} FROM curated",
        "grid_gaps": f"""WITH {PROFILE} SELECT count(DISTINCT store) AS stores, count(DISTINCT product) AS products,
            count(*) AS pairs, count(DISTINCT store) * count(DISTINCT product) - count(*) AS missing_pairs FROM profile""",
        "horizon_join": f"WITH {ORDERS} SELECT * FROM horizons",
        "date_dimension": f"""WITH {ORDER_ENTITY},
            days AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM entity),
            years AS (SELECT DISTINCT year(date) AS year FROM days), {_holiday_sql(['HE'])},
            counted AS (SELECT date, count(*) AS n_orders FROM entity GROUP BY date)
            SELECT 'HE' AS state, date, {CALENDAR_FIELDS}, coalesce(n_orders, 0) AS n_orders
            FROM days LEFT JOIN (SELECT date, holiday_name FROM holidays WHERE state = 'HE') USING (date)
            LEFT JOIN counted USING (date)""",
        "holiday_calendar": f"""WITH units AS (
              SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS units FROM lineitem GROUP BY 1),
            years AS (SELECT DISTINCT year(date) AS year FROM units), {_holiday_sql(ALL_STATES)}
            SELECT state, date, holiday_name, units FROM holidays JOIN units USING (date)""",
        "sales_with_calendar": f"""WITH {GRAIN}, years AS (SELECT DISTINCT year(date) AS year FROM grain),
            {_holiday_sql(['HE', 'RP'])},
            placed AS (SELECT store, product, date, sales, {STORE_STATE} AS state FROM grain)
            SELECT store, product, date, sales, state, {CALENDAR_FIELDS}
            FROM placed LEFT JOIN holidays USING (state, date)""",
        "store_context": f"""WITH {LINES},
            stores AS (SELECT r_regionkey AS store, CASE WHEN r_regionkey % 2 = 0 THEN 'HE' ELSE 'RP' END AS state,
              array_to_string(list_transform(string_split(r_name, ' '),
                lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS city,
              'Store ' || CAST(r_regionkey AS VARCHAR) AS store_name FROM region),
            sold AS (SELECT store, sum(sales) AS units, count(*) AS n_lines FROM lines GROUP BY store)
            SELECT store, units, n_lines, state, city, store_name FROM sold LEFT JOIN stores USING (store)""",
        "weather_daily": f"WITH {WEATHER} SELECT date, {_cut(WEATHER_COLUMNS, 8)} FROM weather",
        "weather_history_wins": f"""WITH {WEATHER} SELECT date_time, event_id,
            {_cut('temperature, minimum_temperature, maximum_temperature, precipitation', 8)} FROM hourly""",
        "weather_history_scan": f"""WITH {WEATHER},
            landed AS (
              SELECT day AS file_day, date_time, event_id, temperature FROM observed
              UNION ALL
              SELECT day - 1, date_time, event_id, temperature + 100 FROM observed
              WHERE minute(strptime(date_time, '%m/%d/%Y %H:%M:%S')) = 0),
            kept AS (SELECT *, row_number() OVER (PARTITION BY date_time ORDER BY file_day DESC, event_id DESC) AS place
              FROM landed)
            SELECT date_time, event_id, {_cut('temperature', 8)} FROM kept WHERE place = 1""",
        "split_bounds": f"WITH {BOUNDS} SELECT start, \"end\", pred_cutoff, timespan, train_span, cutoff_date FROM bounds",
        "split_assign": f"WITH {BOUNDS} SELECT store, product, date, sales, {SPLIT} AS split FROM curated, bounds",
        "split_sizes": f"""WITH {BOUNDS} SELECT {SPLIT} AS split, count(*) AS n_rows, min(date) AS first_date,
            max(date) AS last_date FROM curated, bounds GROUP BY 1""",
        "entity_trim": f"""WITH {BOUNDS}, {ORDER_ENTITY} SELECT {SPLIT} AS split, count(*) AS n_rows,
            min(date) AS first_date, max(date) AS last_date FROM entity, bounds
            WHERE date BETWEEN start AND "end" GROUP BY 1""",
        "entity_sizes": f"""WITH {BOUNDS},
            dated AS (
              SELECT 'sales' AS entity, date FROM curated UNION ALL SELECT 'orders', CAST(o_orderdate AS DATE) FROM orders
              UNION ALL SELECT 'events', CAST(CAST(ts AS DATE) - 9000 AS DATE) FROM events),
            found AS (
              SELECT entity, {SPLIT} AS split, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date
              FROM dated, bounds WHERE date BETWEEN start AND "end" GROUP BY 1, 2),
            wanted AS (SELECT unnest(['sales', 'orders', 'events']) AS entity, s.split FROM (SELECT unnest(['train', 'test', 'predict']) AS split) s)
            SELECT entity, split, coalesce(n_rows, 0) AS n_rows, first_date, last_date,
              CASE WHEN n_rows IS NULL AND NOT (split = 'predict' AND entity <> 'sales') THEN 'no rows'
                   WHEN split <> 'predict' AND n_rows < 10 THEN 'too few rows' END AS violation
            FROM wanted LEFT JOIN found USING (entity, split)""",
        "features_day_aggs": f"""WITH {ORDER_ENTITY}, {_day_mode('entity', 'status')}, {_day_mode('entity', 'priority')},
            plain AS (SELECT date, count(*) AS days__count__orders,
              round(sum(totalprice) + 1e-5, 2) AS days__sum__orders__totalprice,
              round(stddev_samp(totalprice) + 1e-5, 2) AS days__std__orders__totalprice,
              max(totalprice) AS days__max__orders__totalprice,
              round({SKEW} + 1e-7, 4) AS days__skew__orders__totalprice,
              min(totalprice) AS days__min__orders__totalprice,
              round(avg(totalprice) + 1e-9, 6) AS days__mean__orders__totalprice,
              count(DISTINCT status) AS days__num_unique__orders__status,
              count(DISTINCT priority) AS days__num_unique__orders__priority,
              round(avg(CASE WHEN urgent THEN 1.0::DOUBLE ELSE 0.0 END) + 1e-11, 8) AS days__percent_true__orders__urgent,
              count(CASE WHEN status = 'O' AND urgent THEN 1 END) AS days__count__orders__where_urgent_open
              FROM entity GROUP BY date)
            SELECT plain.*, s.status AS days__mode__orders__status, p.priority AS days__mode__orders__priority
            FROM plain LEFT JOIN top_entity_status s USING (date) LEFT JOIN top_entity_priority p USING (date)""",
        "features_attached": f"""WITH {BOUNDS}, {ORDER_ENTITY}, years AS (SELECT DISTINCT year(date) AS year FROM curated),
            {_holiday_sql(['HE', 'RP'])},
            trimmed AS (SELECT entity.* FROM entity, bounds WHERE date BETWEEN start AND "end"),
            {_day_mode('trimmed', 'priority')}, {_day_mode('curated', 'returnflag')},
            o AS (SELECT date, count(*) AS n, round(sum(totalprice) + 1e-5, 2) AS total, max(totalprice) AS top,
                  count(DISTINCT status) AS kinds FROM trimmed GROUP BY date),
            s AS (SELECT date, count(*) AS n_sales, round(max(discount) + 1e-11, 8) AS top_discount FROM curated GROUP BY date),
            placed AS (SELECT *, {STORE_STATE} AS state FROM curated)
            SELECT store, product, date, sales, {SPLIT} AS split, CAST(isodow(date) - 1 AS INTEGER) AS weekday__date,
              CASE WHEN month(date) IN (3, 4, 5) THEN 'spring' WHEN month(date) IN (6, 7, 8) THEN 'summer'
                   WHEN month(date) IN (9, 10, 11) THEN 'fall' ELSE 'winter' END AS days__season,
              holiday_name IS NOT NULL AS days__is_holiday, coalesce(n, 0) AS days__count__orders,
              total AS days__sum__orders__totalprice, top AS days__max__orders__totalprice,
              top_trimmed_priority.priority AS days__mode__orders__priority, kinds AS days__num_unique__orders__status,
              n_sales AS days__count__sales, top_curated_returnflag.returnflag AS days__mode__sales__returnflag,
              top_discount AS days__max__sales__discount
            FROM placed CROSS JOIN bounds LEFT JOIN holidays USING (state, date) LEFT JOIN o USING (date)
            LEFT JOIN s USING (date) LEFT JOIN top_trimmed_priority USING (date)
            LEFT JOIN top_curated_returnflag USING (date)""",
        "feature_defs": _coverage_sql(),
        "text_features": r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[^\s\x0B]+')) AS BIGINT) AS num_words,
            length(text) AS num_characters FROM documents""",
        "haversine_miles": f"""WITH routes AS (
              SELECT s_nationkey AS from_nation, c_nationkey AS to_nation, sum(l_quantity) AS units
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
              JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
            places AS (SELECT n_nationkey AS k, CAST(n_nationkey * 7 % 120 - 60 AS DOUBLE) AS lat,
              CAST(n_nationkey * 13 % 300 - 150 AS DOUBLE) AS lon FROM nation)
            SELECT from_nation, to_nation, units, round(2 * {EARTH_RADIUS['miles']} * asin(sqrt(least(1.0,
              pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat))
              * pow(sin(radians(b.lon - a.lon) / 2), 2)))), 6) AS miles
            FROM routes JOIN places a ON from_nation = a.k JOIN places b ON to_nation = b.k""",
        "lag_week": f"""WITH {CURATED} SELECT c.store, c.product, c.date, p.sales AS last_week
            FROM curated c LEFT JOIN curated p ON p.store = c.store AND p.product = c.product AND p.date = c.date - 7""",
        "lag_year": f"""WITH {CURATED} SELECT c.store, c.product, c.date, p.sales AS last_year
            FROM curated c LEFT JOIN curated p ON p.store = c.store AND p.product = c.product AND p.date = c.date - 364""",
        "rolling7": f"""WITH {CURATED} SELECT c.store, c.product, c.date, sum(p.sales) AS rolling7_sum,
            round(avg(p.sales) + 1e-11, 8) AS rolling7_mean, count(p.sales) AS rolling7_days
            FROM curated c LEFT JOIN curated p ON p.store = c.store AND p.product = c.product
              AND p.date BETWEEN c.date - 7 AND c.date - 1 GROUP BY c.store, c.product, c.date""",
        "weather_rolling7": f"""WITH {WEATHER} SELECT w.date, round(w.temperature + 1e-9, 6) AS temperature,
            round(w.precipitation + 1e-9, 6) AS precipitation, round(avg(p.temperature) + 1e-9, 6) AS past7_temperature,
            round(avg(p.precipitation) + 1e-9, 6) AS past7_precipitation, count(p.date) AS past7_days
            FROM weather w LEFT JOIN weather p ON p.date BETWEEN w.date - 7 AND w.date - 1
            GROUP BY w.date, w.temperature, w.precipitation""",
        "invoice_flatten": INVOICE_ROWS,
        "invoice_join": INVOICE_ROWS,
        "json_props": """SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
            count(*) AS n_events FROM events GROUP BY 1, 2""",
        "panel_sales": """SELECT CAST(l_suppkey % 83 AS INTEGER) AS store, p_brand AS product,
            CAST(DATE '2018-01-01' + CAST(((CAST(l_shipdate AS DATE) - DATE '1995-01-01') // 7) * 7 AS INTEGER) AS DATE) AS date,
            CAST(sum(CAST(trunc(exp(l_extendedprice / 10000)) AS BIGINT)) AS BIGINT) AS sales,
            round(avg(l_discount) + 1e-9, 6) AS price
            FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
        "source_range": f"""WITH {GRAIN} SELECT store, product, date, sales FROM grain
            WHERE date BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'""",
        "csv_folder": f"WITH {LINES} SELECT store, product, date, sum(sales) AS sales, round(avg(price) + 1e-9, 6) AS price FROM lines GROUP BY ALL",
        "csv_report": """SELECT CASE WHEN o_orderkey % 100 = 7 THEN 'rejected' ELSE 'read' END AS kind,
              CASE WHEN o_orderkey % 100 <> 7 THEN CAST(o_orderkey % 5 AS INTEGER) END AS store,
              CASE WHEN o_orderkey % 100 <> 7 THEN 'order, of' || chr(10) || o_orderpriority END AS product,
              count(*) AS n_lines, CAST(sum(o_orderkey) AS BIGINT) AS indexes FROM orders GROUP BY 1, 2, 3
            UNION ALL SELECT 'skipped', NULL, NULL, 1, NULL""",
        "batch_windows": f"""WITH {SPAN},
            sold AS (SELECT {WINDOW_START} AS start_date, sum(l_quantity) AS units FROM lineitem, span GROUP BY 1)
            SELECT start_date, end_date, {WINDOW_FILE} AS file_name, units FROM windows LEFT JOIN sold USING (start_date)""",
        "stale_windows": f"""WITH {SPAN},
            landed AS (SELECT DISTINCT {WINDOW_START} AS start_date FROM lineitem, span
              WHERE l_returnflag = 'R' AND l_quantity = 50)
            SELECT start_date, end_date, {WINDOW_FILE} AS file_name FROM windows
            WHERE NOT (end_date + 3 < today AND start_date IN (SELECT start_date FROM landed))""",
        "weather_refresh": """WITH latest AS (SELECT max(CAST(ts AS DATE)) + 12 AS today FROM events),
            newest AS (
              SELECT CAST(min(CAST(ts AS DATE)) + CAST(20 * ((max(CAST(ts AS DATE)) - min(CAST(ts AS DATE))) // 20) AS INTEGER) AS DATE) AS day
              FROM events),
            planned AS (SELECT CAST(newest.day + CAST(20 * n AS INTEGER) AS DATE) AS start_date
              FROM newest, latest, range(0, 2) AS r(n) WHERE n = 0 OR today - newest.day >= 20)
            SELECT start_date, CAST(start_date + 20 AS DATE) AS end_date,
              'weather_' || strftime(start_date, '%Y-%m-%d') || '_21d.csv' AS file_name FROM planned""",
        "forecast_for_store": f"WITH {ORDERS} SELECT {SHOWN_ORDER.replace(' store,', '')} FROM order_table WHERE store = 1",
        "order_overrides": f"""WITH {ORDERS},
            entered AS (SELECT store, product, CAST(sum(sales) AS BIGINT) AS qty FROM lines
              WHERE returnflag = 'R' AND date >= (SELECT max(CAST(l_shipdate AS DATE)) - 60 FROM lineitem)
              GROUP BY store, product)
            SELECT id, store, product, coalesce(qty, tomorrow_order_qty) AS tomorrow_order_qty, tomorrow_order_range,
              day_after_order_qty, day_after_order_range, next7_order_qty, next7_order_range
            FROM order_table LEFT JOIN entered USING (store, product)""",
        "dashboard_kpis": f"""WITH {ORDERS} SELECT store, CAST(sum(tomorrow_order_qty) AS BIGINT) AS tomorrow_total,
            count(*) AS products, CAST(7 AS INTEGER) AS forecast_days FROM order_table GROUP BY store""",
        "dashboard_bands": f"""WITH {ORDERS}, ends AS (SELECT store,
              CAST(split_part(tomorrow_order_range, ' - ', 1) AS BIGINT) AS low,
              CAST(split_part(tomorrow_order_range, ' - ', 2) AS BIGINT) AS high FROM order_table)
            SELECT store, CAST(sum(low) AS BIGINT) AS suggested, CAST(sum(high) - sum(low) AS BIGINT) AS safety_buffer
            FROM ends GROUP BY store""",
        "dashboard_chart": f"WITH {ORDERS} SELECT store, product, tomorrow_order_qty, day_after_order_qty FROM order_table",
        "table_search_page": f"""WITH {ORDERS} SELECT id, product, tomorrow_order_qty, tomorrow_order_range
            FROM order_table WHERE store = 3 AND contains(lower(CAST(id AS VARCHAR) || ' ' || product), 'a')
            ORDER BY tomorrow_order_qty DESC, id LIMIT 2 OFFSET 2""",
        "part_pages": """SELECT p_partkey AS id, p_name AS product, p_retailprice FROM part
            WHERE contains(lower(CAST(p_partkey AS VARCHAR) || ' ' || p_name), 'e')
            ORDER BY p_retailprice DESC, p_partkey LIMIT 40 OFFSET 80""",
        "part_search": """SELECT p_partkey AS id, p_name AS product, p_retailprice FROM part
            WHERE contains(lower(CAST(p_partkey AS VARCHAR) || ' ' || p_name), 'red')
              AND contains(lower(CAST(p_partkey AS VARCHAR) || ' ' || p_name), '1')
            ORDER BY p_retailprice DESC, p_partkey LIMIT 25""",
        "dup_keys": f"WITH {LINES} SELECT store, product, date, count(*) AS n_rows FROM lines GROUP BY ALL HAVING count(*) > 1",
        "dup_timestamps": f"WITH {WEATHER} SELECT date_time, count(*) AS n_rows FROM observed GROUP BY ALL HAVING count(*) > 1",
        "dup_item_ids": """SELECT l_orderkey * 10 + l_linenumber AS "index", count(*) AS n_rows FROM lineitem
            GROUP BY 1 HAVING count(*) > 1""",
        "baseline_metrics": f"""WITH {BOUNDS},
            scored AS (SELECT c.sales, (SELECT avg(p.sales) FROM curated p WHERE p.store = c.store
                AND p.product = c.product AND p.date BETWEEN c.date - 7 AND c.date - 1) AS forecast
              FROM curated c, bounds WHERE {SPLIT.replace('date >=', 'c.date >=').replace('date <=', 'c.date <=')} = 'test')
            SELECT count(*) AS n_rows,
              round(1 - sum((sales - forecast) * (sales - forecast)) / (var_pop(sales) * count(*)) + 1e-9, 6) AS r2,
              round(sqrt(avg((sales - forecast) * (sales - forecast))) + 1e-9, 6) AS rmse,
              round(avg(abs(sales - forecast)) + 1e-9, 6) AS mae
            FROM scored WHERE forecast IS NOT NULL""",
        "forecast_days": f"""WITH {CURATED} SELECT store, product, count(*) AS n_days, count(DISTINCT date) AS n_dates,
            min(date) AS first_date, max(date) AS last_date, count(*) AS n_forecasts, count(sales) AS n_known
            FROM curated WHERE sales IS NULL GROUP BY store, product""",
        "model_columns": f"""WITH {CURATED}, per AS (SELECT
              {', '.join(f"count(*) FILTER ({c} IS NULL) AS gaps_{c}, count(DISTINCT coalesce({c}, '')) AS values_{c}" for c in MODEL_CATEGORIES)},
              {', '.join(f"count(*) FILTER ({c} IS NULL) AS gaps_{c}" for c in MODEL_NUMBERS)} FROM curated)
            {" UNION ALL ".join(
                [f"SELECT '{c}' AS \"column\", 'category' AS kind, 'mean' AS encoding, gaps_{c} AS n_missing, values_{c} AS n_values FROM per" for c in MODEL_CATEGORIES]
                + [f"SELECT '{c}', 'number', 'value', gaps_{c}, NULL FROM per" for c in MODEL_NUMBERS])}""",
        "model_rows": f"""WITH {BOUNDS},
            split AS (SELECT store, product, date, {SPLIT} AS split, sales, coalesce(price, -1.0e12) AS price,
                coalesce(returnflag, '') AS returnflag, coalesce(priority, '') AS priority FROM curated, bounds),
            prior AS (SELECT avg(sales) AS prior FROM split WHERE split = 'train'),
            {', '.join(f"""by_{c} AS (
              SELECT {c}, date, sum(CASE WHEN split = 'train' THEN sales END) AS total, count(CASE WHEN split = 'train' THEN sales END) AS n
              FROM split GROUP BY {c}, date),
            until_{c} AS (
              SELECT {c}, date, coalesce(sum(total) OVER x, 0) AS total, coalesce(sum(n) OVER x, 0) AS n FROM by_{c}
              WINDOW x AS (PARTITION BY {c} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""" for c in MODEL_CATEGORIES)}
            SELECT s.store, s.product, s.date, s.split, {_r('s.sales', 6)} AS sales, {_r('s.price', 6)} AS price, s.returnflag, s.priority,
              {', '.join(f"{_r(f'(until_{c}.total + 10 * prior) / (until_{c}.n + 10)', 6)} AS mean_target__{c}" for c in MODEL_CATEGORIES)},
              split = 'test' AS held_out
            FROM split s CROSS JOIN prior {' '.join(f"JOIN until_{c} ON s.{c} = until_{c}.{c} AND s.date = until_{c}.date" for c in MODEL_CATEGORIES)}
            WHERE split <> 'predict'""",
        "stream_ingest": """SELECT event_type AS product, CAST(ts AS DATE) AS date, count(*) AS n_lines,
            round(sum(value), 2) AS sales FROM events GROUP BY 1, 2""",
        "stream_weather_daily": """SELECT CAST(ts AS DATE) AS date, round(avg(value) + 1e-11, 8) AS temperature,
            round(min(value - 1) + 1e-11, 8) AS minimum_temperature FROM events GROUP BY 1""",
        "loads_to_plan": f"""WITH {SPAN},
            come AS (SELECT DISTINCT {WINDOW_START} AS start_date FROM lineitem, span)
            SELECT start_date, end_date, {WINDOW_FILE} AS file_name FROM windows
            WHERE NOT (end_date + 3 < today AND year(start_date) < 1998 AND start_date IN (SELECT start_date FROM come))""",
        "stream_window_reload": f"""WITH {SPAN}
            SELECT CAST(l_shipdate AS DATE) AS date,
              sum(CASE WHEN year({WINDOW_START}) >= 1998 THEN l_quantity ELSE 0.0::DOUBLE END) AS sales,
              count(*) AS n_lines FROM lineitem, span GROUP BY 1""",
    }
    for name, (column, label) in export.items():
        queries[name] = f"""WITH {ORDERS} SELECT id AS "ID", product AS "Produkt", {column} AS "{label}"
            FROM order_table WHERE store = 2"""
    return queries
