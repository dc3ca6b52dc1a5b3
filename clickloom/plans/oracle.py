"""The registered queries again, as plain SQL over the same tables."""

from __future__ import annotations

from clickloom.operators.sliding import LIVE, Sliding
from clickloom.plans.queries import (
    CART_DELAY, CHECKPOINT, COARSE, END, FEED_EDGES, LONG_GAP, START)

_CLICKS = """clicks AS (
  SELECT user_id AS customer_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         CASE event_type WHEN 'view' THEN 'ITEM_DETAIL' WHEN 'click' THEN 'ADD_TO_CART'
              WHEN 'purchase' THEN 'BOOKING' ELSE upper(event_type) END AS event_name,
         ts AS event_time, CAST(event_id AS VARCHAR) AS event_id,
         CASE event_id % 4 WHEN 0 THEN 'Direct' WHEN 1 THEN 'Search' WHEN 2 THEN 'Email'
              ELSE 'Social' END AS traffic_source,
         props AS event_metadata,
         CASE WHEN event_type = 'purchase' THEN 'Success' END AS payment_status,
         CAST(NULL AS VARCHAR) AS search_keywords,
         CASE WHEN event_type = 'purchase' THEN 'B' || CAST(event_id AS VARCHAR) END
           AS booking_id,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS product_id,
         CAST(event_id % 3 + 1 AS DOUBLE) AS quantity, value AS item_price,
         value AS price_usd
  FROM events)"""

_CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name, lower(c_name) AS username,
         'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         strftime(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER),
                  '%Y-%m-%d 00:00:00') AS birthdate,
         c_mktsegment AS device_type, 'dev-' || CAST(c_custkey AS VARCHAR) AS device_id,
         'v' || CAST(c_custkey % 5 AS VARCHAR) AS device_version,
         CAST(c_custkey % 18 * 10 - 85 AS DOUBLE) AS home_location_lat,
         CAST(c_custkey % 12 * 30 - 165 AS DOUBLE) AS home_location_long,
         'city-' || CAST(c_custkey % 100 AS VARCHAR) AS home_location,
         n_name AS home_country,
         strftime(DATE '2015-01-01' + CAST(c_custkey % 3000 AS INTEGER),
                  '%Y-%m-%d 00:00:00') AS first_join_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

_PRODUCTS = """products AS (
  SELECT p_partkey AS product_id,
         CASE p_size % 3 WHEN 0 THEN 'Men' WHEN 1 THEN 'Women' ELSE 'Unisex' END
           AS product_gender,
         p_type AS mastercategory, p_brand AS subcategory,
         split_part(p_name, ' ', -1) AS articletype, split_part(p_name, ' ', 1) AS basecolour,
         CASE p_size % 4 WHEN 0 THEN 'Spring' WHEN 1 THEN 'Summer' WHEN 2 THEN 'Fall'
              ELSE 'Winter' END AS season,
         CAST(p_size % 10 + 2010 AS BIGINT) AS product_year,
         CASE p_size % 2 WHEN 0 THEN 'Casual' ELSE 'Formal' END AS usage,
         p_name AS productdisplayname
  FROM part)"""


def _enriched(customers: str = "customers", products: str = "products") -> str:
    return f"""enriched AS (
  SELECT e.customer_id, e.session_id, e.event_name, e.event_time, e.event_id,
         e.traffic_source, e.event_metadata, e.payment_status, e.search_keywords,
         e.booking_id, e.product_id, e.quantity, e.item_price, e.price_usd, c.first_name,
         c.last_name, c.username, c.email, c.gender, c.birthdate, c.device_type,
         c.device_id, c.device_version, c.home_location_lat, c.home_location_long,
         c.home_location, c.home_country, c.first_join_date, p.product_gender,
         p.mastercategory AS "masterCategory", p.subcategory AS "subCategory",
         p.articletype AS "articleType", p.basecolour AS "baseColour", p.season,
         p.product_year, p.usage, p.productdisplayname AS "productDisplayName"
  FROM clicks e
  LEFT JOIN {customers} c ON e.customer_id = c.customer_id
  LEFT JOIN {products} p ON e.product_id = p.product_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_HISTORY = _with(_CLICKS, _CUSTOMERS, _PRODUCTS, _enriched())
_IN_RANGE = f"CAST(event_time AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'"
_BOUGHT = f"event_name = 'BOOKING' AND {_IN_RANGE}"
_SALES = "event_name IN ('ADD_TO_CART', 'BOOKING')"
_AMOUNT = "price_usd * quantity"
_RANGED = f"WHERE {_IN_RANGE}"
_LAST_30 = f"""WHERE CAST(event_time AS DATE) + CAST(current_date - DATE '{END}' AS INTEGER)
  BETWEEN current_date - 30 AND current_date"""

_HISTORY_ROW = """SELECT * REPLACE (strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time)"""

_DIMENSION_GAPS = (
    "some_customers AS (SELECT * FROM customers WHERE customer_id % 7 <> 3)",
    "some_products AS (SELECT * FROM products WHERE product_id % 5 <> 1)",
)


def _key_figures(where: str = _RANGED) -> str:
    return f"""figures AS (
  SELECT count(*) FILTER (event_name = 'BOOKING') AS total_purchases,
         CAST(count(DISTINCT CASE WHEN event_name = 'BOOKING' THEN customer_id END) AS DOUBLE)
           * CAST(100 AS DOUBLE) / nullif(count(DISTINCT session_id), 0) AS conversion_rate,
         round(sum(CASE WHEN event_name = 'BOOKING' THEN {_AMOUNT} END), 6) AS total_revenue,
         round(avg(CASE WHEN event_name = 'BOOKING' THEN {_AMOUNT} END), 6)
           AS average_order_value,
         round(sum(CASE WHEN event_name = 'BOOKING' THEN {_AMOUNT} END)
           / nullif(count(DISTINCT CASE WHEN event_name = 'BOOKING' THEN customer_id END), 0),
           6) AS revenue_per_user
  FROM enriched {where})"""


def _history_with(*ctes: str) -> str:
    return _with(_CLICKS, _CUSTOMERS, _PRODUCTS, _enriched(), *ctes)


_DEVICE_SALES = f"""device_sales AS (
  SELECT device_type, traffic_source, round(sum({_AMOUNT}), 2) AS total_sales
  FROM enriched WHERE event_name = 'BOOKING' GROUP BY device_type, traffic_source)"""
_CATEGORY_SALES = f"""category_sales AS (
  SELECT "masterCategory", "subCategory", round(sum({_AMOUNT}), 6) AS total_sales
  FROM enriched WHERE {_BOUGHT} GROUP BY "masterCategory", "subCategory")"""
_GENDER_SALES = f"""gender_sales AS (
  SELECT gender, round(sum({_AMOUNT}), 6) AS total_sales
  FROM enriched WHERE event_name = 'BOOKING' GROUP BY gender)"""
_LEADERBOARD = f"""leaderboard AS (
  SELECT "productDisplayName", "masterCategory", "subCategory",
         sum(quantity) AS total_quantity, round(sum({_AMOUNT}), 6) AS total_sales
  FROM enriched WHERE {_BOUGHT}
  GROUP BY "productDisplayName", "masterCategory", "subCategory"
  ORDER BY total_sales DESC, "productDisplayName", "masterCategory", "subCategory" LIMIT 25)"""


def _subtotals(table: str, outer: str, inner: str) -> str:
    return f"""SELECT {outer}, {inner}, round(sum(total_sales), 6) AS total_sales,
  CAST(CASE WHEN grouping({outer}) = 1 THEN 2 ELSE grouping({inner}) END AS INTEGER) AS level
FROM {table} GROUP BY ROLLUP ({outer}, {inner})"""


# Sliding windows: every event joins each of its windows --------------------------------

def _windowed(s: Sliding, source: str, time: str = "event_time") -> str:
    micros = s.slide * 1_000_000
    return f"""windowed AS (
  SELECT {source}.*,
         make_timestamp((epoch_us({time}) // {micros} + 1 + i) * {micros}) AS window_end
  FROM {source} CROSS JOIN (SELECT unnest(range(0, {s.panes})) AS i))"""


def _window_start(s: Sliding) -> str:
    return f"window_end - INTERVAL {s.size} SECOND AS window_start"


_CLOSED = "window_end <= (SELECT max(ts) FROM events)"


def _funnel_cte(s: Sliding) -> str:
    def count(name: str) -> str:
        return f"count(*) FILTER (event_name = '{name}')"

    counts = {"page_view": "ITEM_DETAIL", "add_to_cart": "ADD_TO_CART", "purchase": "BOOKING"}
    columns = ", ".join(
        f"{count(name)} AS {c}_count, "
        f"round({count(name)} / count(DISTINCT session_id) * 100, 2) AS {c}_percentage"
        for c, name in counts.items())
    return f"""{_windowed(s, "clicks")}, metrics AS (
  SELECT {_window_start(s)}, window_end, count(DISTINCT session_id) AS session_count, {columns}
  FROM windowed GROUP BY window_end)"""


def _funnel(s: Sliding, select: str = "SELECT * FROM metrics") -> str:
    return _with(_CLICKS, _funnel_cte(s)) + select


def _products_cte(s: Sliding) -> str:
    return f"""sales AS (
  SELECT event_name, product_id, quantity, {_AMOUNT} AS line, event_time
  FROM clicks WHERE {_SALES}),
{_windowed(s, "sales")}, sums AS (
  SELECT {_window_start(s)}, window_end, event_name, product_id, sum(quantity) AS quantity,
         round(sum(line), 6) AS revenue,
         round(sum(quantity) * round(sum(line), 6), 6) AS amount
  FROM windowed GROUP BY window_end, event_name, product_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY window_end, event_name
    ORDER BY amount DESC, quantity DESC, product_id) AS rank FROM sums),
totals AS (
  SELECT window_start, window_end, event_name, sum(quantity) AS total_quantity,
         round(sum(revenue), 6) AS total_revenue, round(sum(amount), 6) AS total_amount
  FROM sums GROUP BY window_start, window_end, event_name)"""


def _trending(s: Sliding, select: str) -> str:
    return _with(_CLICKS, _products_cte(s)) + select


_TOP = """SELECT window_start, window_end, event_name, CAST(rank AS INTEGER) AS rank,
  product_id, quantity, revenue, amount FROM ranked WHERE rank <= 10"""


def _top_table(event_name: str) -> str:
    return f"""SELECT window_start, window_end, CAST(rank AS INTEGER) AS rank,
  product_id AS "Product ID", quantity AS "Total Quantity", amount AS "Total Sales ($)"
FROM ranked WHERE rank <= 10 AND event_name = '{event_name}'"""


def _tile(event_name: str, column: str, kind: str) -> str:
    return (f"CAST(coalesce(max(CASE WHEN event_name = '{event_name}' THEN {column} END), 0)"
            f" AS {kind}) AS {event_name.lower()}_{column}")


_TILES = f"""SELECT window_start, window_end,
  {_tile('ADD_TO_CART', 'total_quantity', 'BIGINT')},
  {_tile('ADD_TO_CART', 'total_amount', 'DOUBLE')},
  {_tile('BOOKING', 'total_quantity', 'BIGINT')},
  {_tile('BOOKING', 'total_amount', 'DOUBLE')}
FROM totals GROUP BY window_start, window_end"""


# Carts -----------------------------------------------------------------------------------

def _carts_cte(gap: int) -> str:
    return f"""flagged AS (
  SELECT *, CASE WHEN epoch_us(event_time) - lag(epoch_us(event_time)) OVER w
                      >= CAST({gap} AS BIGINT) * 1000000 THEN 1 ELSE 0 END AS opens
  FROM clicks WHERE {_SALES}
  WINDOW w AS (PARTITION BY session_id, product_id ORDER BY event_time, event_id)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY session_id, product_id
                             ORDER BY event_time, event_id) AS session_no FROM flagged),
placed AS (
  SELECT *, row_number() OVER s AS place, max(event_time) OVER (
      PARTITION BY session_id, product_id, session_no) AS last_seen,
    bool_and(event_name = 'ADD_TO_CART') OVER (
      PARTITION BY session_id, product_id, session_no) AS only_adds
  FROM numbered
  WINDOW s AS (PARTITION BY session_id, product_id, session_no ORDER BY event_time, event_id)),
carts AS (
  SELECT session_id, product_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS abandoned_time,
         price_usd AS item_price, quantity, {_AMOUNT} AS lost_sale,
         last_seen + INTERVAL {gap} SECOND - INTERVAL 1 MICROSECOND AS closed_at
  FROM placed WHERE place = 1 AND only_adds)"""


def _carts(gap: int, select: str = "SELECT * FROM carts") -> str:
    return _with(_CLICKS, _carts_cte(gap)) + select


def _abandonment(gap: int, s: Sliding, select: str = "SELECT * FROM lost") -> str:
    return _with(_CLICKS, _carts_cte(gap), _windowed(s, "carts", "closed_at"), f"""lost AS (
  SELECT {_window_start(s)}, window_end, count(*) AS abandoned_count,
         round(sum(lost_sale), 2) AS total_lost_sales
  FROM windowed GROUP BY window_end)""") + select


# Messages --------------------------------------------------------------------------------

_JSON = """messages AS (
  SELECT event_name, '{"customer_id":' || CAST(customer_id AS VARCHAR)
    || ',"session_id":"' || session_id || '","event_name":"' || event_name
    || '","event_time":"' || strftime(event_time, '%Y-%m-%d %H:%M:%S')
    || '","event_id":"' || event_id || '","traffic_source":"' || traffic_source
    || '","event_metadata":"' || replace(event_metadata, '"', '\\"') || '"'
    || coalesce(',"payment_status":"' || payment_status || '"', '')
    || coalesce(',"booking_id":"' || booking_id || '"', '')
    || ',"product_id":' || CAST(product_id AS VARCHAR)
    || ',"quantity":' || CAST(quantity AS VARCHAR)
    || ',"item_price":' || CAST(item_price AS VARCHAR)
    || ',"price_usd":' || CAST(price_usd AS VARCHAR) || '}' AS value
  FROM clicks)"""


# The feed: messages in parts, a tenth of them one part late ---------------------------------

def _fed(delay: int) -> str:
    """Events as received, with the part they come in and the watermark before it."""
    part = " + ".join(f"CAST(event_time >= TIMESTAMP '{edge}' AS INTEGER)" for edge in FEED_EDGES)
    return f"""parts AS (
  SELECT * REPLACE (date_trunc('second', event_time) AS event_time),
         least({part} + CAST(CAST(event_id AS BIGINT) % 10 = 3 AS INTEGER), {len(FEED_EDGES)}) AS part
  FROM clicks),
marks AS (
  SELECT part, max(newest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - INTERVAL {delay} SECOND AS before
  FROM (SELECT part, max(event_time) AS newest FROM parts GROUP BY part)),
final AS (SELECT max(event_time) - INTERVAL {delay} SECOND AS watermark FROM parts),
received AS (
  SELECT parts.*, before FROM parts JOIN marks USING (part))"""


_ON_TIME = "on_time AS (SELECT * FROM received WHERE before IS NULL OR event_time >= before)"


def _live_carts(select: str) -> str:
    carts = _carts_cte(300).replace("FROM clicks", "FROM on_time")
    return _with(_CLICKS, _fed(CART_DELAY), _ON_TIME, carts, "closed AS (SELECT * FROM carts "
                 "WHERE closed_at < (SELECT watermark FROM final))", _windowed(LIVE, "closed", "closed_at")) + select


def _accounts(delay: int, late: str) -> str:
    return _with(_CLICKS, _fed(delay)) + f"""SELECT CAST(part AS BIGINT) AS batch_id, count(*) AS events,
  count(*) FILTER (NOT coalesce({late}, false)) AS on_time,
  count(*) FILTER (coalesce({late}, false)) AS late, CAST(0 AS BIGINT) AS untimed
FROM received GROUP BY part"""


def registered() -> dict[str, str]:
    extract_where = (f"event_name IN ('BOOKING', 'ADD_TO_CART', 'ITEM_DETAIL') AND "
                     f"(event_time, event_id) > (TIMESTAMP '{CHECKPOINT[0]}', '{CHECKPOINT[1]}')")
    page = f"""page AS (
  SELECT event_time, event_id, session_id, event_name, price_usd FROM clicks
  WHERE {extract_where} ORDER BY event_time, event_id LIMIT 1000)"""
    key_figures = _history_with(_key_figures()) + "SELECT * FROM figures"
    latest = """latest AS (
  SELECT session_count, add_to_cart_count, purchase_count FROM metrics
  ORDER BY window_end DESC LIMIT 1)"""
    daily_counts = _HISTORY + f"""SELECT CAST(CAST(event_time AS DATE) AS TIMESTAMP) AS event_date,
  event_name, count(*) AS total_users
FROM enriched WHERE {_IN_RANGE} AND {_SALES} GROUP BY 1, 2"""
    gapped_latest = """SELECT
  coalesce(arg_max(session_count, window_end) FILTER (minute(window_end) IN (0, 30)), 0) AS session_count,
  coalesce(arg_max(add_to_cart_count, window_end) FILTER (minute(window_end) = 20), 0) AS add_to_cart_count,
  coalesce(arg_max(purchase_count, window_end) FILTER (minute(window_end) = 40), 0) AS purchase_count
FROM metrics"""
    stages = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS stage_no, '{label}' AS stage, {c} AS value, "
        f"round({c} / session_count * 100, 2) AS percent_of_initial FROM latest"
        for i, (label, c) in enumerate([
            ("Sessions", "session_count"), ("Added to Cart", "add_to_cart_count"),
            ("Purchased", "purchase_count")], start=1))
    tiles = " UNION ALL ".join(
        f"SELECT '{label}' AS label, {text} AS value FROM figures" for label, text in [
            ("Total eComm Purchases", "format('${:,.2f}', CAST(total_purchases AS DOUBLE))"),
            ("Conversion Rate", "format('{:.2f}%', conversion_rate)"),
            ("Purchase Revenue", "format('${:,.2f}', total_revenue)"),
            ("Average Order Value", "format('${:,.2f}', average_order_value)"),
            ("Revenue per User", "format('${:,.2f}', revenue_per_user)")])
    gaps = _with(_CLICKS, _CUSTOMERS, _PRODUCTS, *_DIMENSION_GAPS,
                 _enriched("some_customers", "some_products"))
    return {
        "customer_dimension": _with(_CUSTOMERS) + "SELECT * FROM customers",
        "product_dimension": _with(_PRODUCTS) + "SELECT * FROM products",
        "incremental_extract": _with(_CLICKS, page) + "SELECT * FROM page",
        "incremental_checkpoint": _with(_CLICKS, page) + """SELECT event_time, event_id
FROM page ORDER BY event_time DESC, event_id DESC LIMIT 1""",
        "extract_remaining": _with(_CLICKS) + f"""SELECT event_name, count(*) AS events
FROM clicks WHERE {extract_where} GROUP BY event_name""",
        "json_messages": _with(_CLICKS, _JSON) + "SELECT value FROM messages",
        "parsed_events": _with(_CLICKS) + """SELECT * REPLACE (
  date_trunc('second', event_time) AS event_time)
FROM clicks WHERE event_name NOT IN ('ERROR', 'SIGNUP')""",
        "dead_letters": _with(_CLICKS, _JSON) + """SELECT
  CASE event_name WHEN 'ERROR' THEN substr(value, 1, 40)
    ELSE regexp_replace(value, '"event_time":"[^"]*"', '"event_time":"soon"') END AS raw,
  CASE event_name WHEN 'ERROR' THEN 'bad_json' ELSE 'bad_event_time' END AS error
FROM messages WHERE event_name IN ('ERROR', 'SIGNUP')""",
        "lenient_events": _with(_CLICKS) + """SELECT * REPLACE (
  CASE WHEN event_name <> 'ERROR' THEN item_price END AS item_price)
FROM clicks WHERE event_name <> 'SIGNUP'""",
        "lenient_dead_letters": _with(_CLICKS) + """SELECT 'bad_json' AS error, count(*) AS messages
FROM clicks WHERE event_name = 'SIGNUP' HAVING count(*) > 0""",
        "replayed_feed": _with(_CLICKS) + """SELECT * REPLACE (date_trunc('second', event_time) AS event_time)
FROM clicks WHERE event_name IN ('BOOKING', 'ADD_TO_CART', 'ITEM_DETAIL')""",
        "enriched_events": _HISTORY + _HISTORY_ROW + " FROM enriched",
        "enriched_unmatched": gaps + _HISTORY_ROW + " FROM enriched",
        "enriched_duplicates": _with(_CLICKS, _CUSTOMERS, _PRODUCTS, """other_customers AS (
  SELECT * REPLACE (CASE WHEN customer_id % 3 = 0 THEN 'z' || coalesce(gender, '')
                         ELSE gender END AS gender) FROM customers)""",
            _enriched("other_customers")) + _HISTORY_ROW + " FROM enriched",
        "lookup_overwrites": _with(_CLICKS, _CUSTOMERS) + """SELECT e.event_id, e.customer_id,
  CASE WHEN c.customer_id IS NULL THEN e.traffic_source
       WHEN c.customer_id % 2 = 0 THEN 'dim' END AS traffic_source, c.gender
FROM clicks e LEFT JOIN (SELECT * FROM customers WHERE customer_id % 7 <> 3) c
  ON e.customer_id = c.customer_id""",
        "lookup_frozen": _with(_CLICKS, _CUSTOMERS) + """SELECT e.event_id, e.customer_id,
  e.price_usd, c.home_country, c.birthdate
FROM (SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 2 = 0 THEN customer_id END AS customer_id)
      FROM clicks) e LEFT JOIN customers c ON e.customer_id = c.customer_id""",
        "lookup_salted": _with(_CLICKS, _CUSTOMERS) + """SELECT e.event_id, e.customer_id,
  e.price_usd, c.home_country
FROM clicks e LEFT JOIN customers c ON e.customer_id = c.customer_id""",
        "total_purchases": _HISTORY + f"""SELECT count(*) AS total_purchases
FROM enriched WHERE {_BOUGHT}""",
        "conversion_rate": _history_with(_key_figures()) + "SELECT conversion_rate FROM figures",
        "purchase_revenue": _HISTORY + f"""SELECT round(sum({_AMOUNT}), 6) AS total_revenue
FROM enriched WHERE {_BOUGHT}""",
        "average_order_value": _HISTORY + f"""SELECT round(avg({_AMOUNT}), 6)
  AS average_order_value FROM enriched WHERE {_BOUGHT}""",
        "revenue_per_user": _HISTORY + f"""SELECT
  round(sum({_AMOUNT}) / count(DISTINCT customer_id), 6) AS revenue_per_user
FROM enriched WHERE {_BOUGHT}""",
        "key_figures": key_figures,
        "key_figure_tiles": _history_with(_key_figures()) + tiles,
        "key_figures_default_range": _history_with(_key_figures(_LAST_30))
        + "SELECT * FROM figures",
        "sales_by_device_and_source": _history_with(_DEVICE_SALES) + "SELECT * FROM device_sales",
        "sales_by_gender": _history_with(_GENDER_SALES) + "SELECT * FROM gender_sales",
        "daily_event_counts": daily_counts,
        "sales_by_category": _history_with(_CATEGORY_SALES) + "SELECT * FROM category_sales",
        "top_sold_products": _history_with(_LEADERBOARD) + "SELECT * FROM leaderboard",
        "sales_by_location": _HISTORY + f"""SELECT home_location_lat, home_location_long,
  round(sum({_AMOUNT}), 2) AS total_sales
FROM enriched WHERE {_BOUGHT} GROUP BY home_location_lat, home_location_long""",
        "device_source_subtotals": _history_with(_DEVICE_SALES)
        + _subtotals("device_sales", "device_type", "traffic_source"),
        "category_subtotals": _history_with(_CATEGORY_SALES)
        + _subtotals("category_sales", '"masterCategory"', '"subCategory"'),
        "gender_shares": _history_with(_GENDER_SALES) + """SELECT *,
  round(total_sales / sum(total_sales) OVER (), 6) AS share FROM gender_sales""",
        "leaderboard_axes": _history_with(_LEADERBOARD) + """SELECT
  min(total_quantity) - 5 AS x_min, max(total_quantity) + 5 AS x_max,
  min(total_sales) - 50 AS y_min, max(total_sales) + 50 AS y_max FROM leaderboard""",
        "funnel_10min": _funnel(COARSE),
        "funnel_10s": _funnel(LIVE),
        "latest_funnel": _with(_CLICKS, _funnel_cte(COARSE), latest) + "SELECT * FROM latest",
        "latest_funnel_with_gaps": _with(_CLICKS, _funnel_cte(COARSE)) + gapped_latest,
        "stream_latest_funnel": _with(_CLICKS, _funnel_cte(COARSE)) + gapped_latest,
        "stream_live_top_products": _with(_CLICKS, _fed(0), _products_cte(LIVE)
            .replace("SELECT event_name, product_id,", "SELECT before, event_name, product_id,")
            .replace("FROM clicks", "FROM received")
            .replace("FROM windowed", "FROM windowed WHERE (before IS NULL OR window_end > before)"))
        + f"{_TOP} AND window_end <= (SELECT watermark FROM final)",
        # late: the event's last window ends at or before the watermark
        "stream_live_trending_accounts": _accounts(
            0, f"""make_timestamp((epoch_us(event_time) // {COARSE.slide * 10**6} + {COARSE.panes})
                   * {COARSE.slide * 10**6}) <= before"""),
        "stream_live_abandoned_carts": _live_carts("SELECT * FROM closed"),
        "stream_live_abandonment_totals": _live_carts(f"""SELECT {_window_start(LIVE)}, window_end,
  count(*) AS abandoned_count, round(sum(lost_sale), 2) AS total_lost_sales
FROM windowed WHERE window_end <= (SELECT watermark FROM final) GROUP BY window_end"""),
        "stream_live_abandonment_accounts": _accounts(CART_DELAY, "event_time < before"),
        "funnel_stages": _with(_CLICKS, _funnel_cte(COARSE), latest) + stages,
        "top_products_10min": _trending(COARSE, _TOP),
        "top_products_by_revenue": _trending(COARSE, """SELECT window_start, window_end,
  event_name, CAST(place AS INTEGER) AS rank, product_id, quantity, revenue, amount
FROM (SELECT *, row_number() OVER (PARTITION BY window_end, event_name
        ORDER BY revenue DESC, quantity DESC, product_id) AS place FROM sums)
WHERE place <= 10"""),
        "top_products_10s": _trending(LIVE, _TOP),
        "trending_totals_10min": _trending(COARSE, "SELECT * FROM totals"),
        "trending_totals_10s": _trending(LIVE, "SELECT * FROM totals"),
        "grand_totals_10min": _trending(COARSE, """SELECT window_start, window_end,
  sum(total_quantity) AS total_quantity, round(sum(total_revenue), 6) AS total_amount
FROM totals GROUP BY window_start, window_end"""),
        "live_tiles": _trending(COARSE, _TILES),
        "live_tiles_from_messages": _trending(COARSE, _TILES),
        "top_table_add_to_cart": _trending(COARSE, _top_table("ADD_TO_CART")),
        "top_table_purchase": _trending(COARSE, _top_table("BOOKING")),
        "abandoned_carts_5min": _carts(300),
        "abandoned_carts_6h": _carts(LONG_GAP),
        "abandonment_totals_10min": _abandonment(300, COARSE),
        "abandonment_totals_10s": _abandonment(300, LIVE),
        "abandonment_trend": _abandonment(
            LONG_GAP, COARSE, "SELECT window_end, abandoned_count, total_lost_sales FROM lost"),
        "top_products_with_gaps": _with(_CLICKS, """gapped AS (
  SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 5 <> 0 THEN quantity END AS quantity)
  FROM clicks)""", _products_cte(COARSE).replace("FROM clicks", "FROM gapped")) + _TOP,
        "stream_funnel_from_messages": _funnel(COARSE, f"SELECT * FROM metrics WHERE {_CLOSED}"),
        "stream_abandoned_carts_5min": _carts(300, """SELECT * EXCLUDE (closed_at) FROM carts
WHERE closed_at < (SELECT max(ts) FROM events)"""),
        "stream_funnel": _funnel(COARSE, f"SELECT * FROM metrics WHERE {_CLOSED}"),
        "stream_top_products": _trending(COARSE, f"{_TOP} AND {_CLOSED}"),
        "stream_funnel_10s": _funnel(
            LIVE, f"SELECT * FROM metrics WHERE {_CLOSED}"),
        "stream_top_products_from_panes": _trending(
            COARSE, f"{_TOP} AND {_CLOSED}"),
        "stream_totals_from_panes": _trending(
            COARSE, f"SELECT * FROM totals WHERE {_CLOSED}"),
        "stream_abandoned_carts": _carts(LONG_GAP, """SELECT * EXCLUDE (closed_at) FROM carts
WHERE closed_at < (SELECT max(ts) FROM events)"""),
        "stream_abandonment_totals": _abandonment(
            LONG_GAP, COARSE, f"SELECT * FROM lost WHERE {_CLOSED}"),
        "stream_history": _HISTORY + _HISTORY_ROW
        + ", CAST(CAST(event_time AS DATE) AS TIMESTAMP) AS event_date FROM enriched",
        "history_key_figures": key_figures,
        "rollup_key_figures": key_figures,
        "rollup_daily_event_counts": daily_counts,
        "rollup_top_sold_products": _history_with(_LEADERBOARD) + "SELECT * FROM leaderboard",
        "rollup_sales_by_category": _history_with(_CATEGORY_SALES) + "SELECT * FROM category_sales",
        "rollup_sales_by_device_and_source": _history_with(_DEVICE_SALES) + "SELECT * FROM device_sales",
        "stream_messages": _funnel(COARSE, f"""SELECT window_end, session_count,
  add_to_cart_count, purchase_count, purchase_percentage FROM metrics WHERE {_CLOSED}"""),
    }
