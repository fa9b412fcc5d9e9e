"""SQL with the same results as the registered queries, for an independent engine to run."""

from __future__ import annotations

import re

from .inputs import RECIPES

# Title-case delimiters as a regular-expression class body.
_D = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower(trim({x})), '[^{_D}]+|[{_D}]+'), "
        "lambda t: upper(t[1]) || t[2:]), '')"
    )


def num(x: str) -> str:
    return f"TRY_CAST({x} AS DECIMAL(38,0))"


def dec(x: str) -> str:
    return f"TRY_CAST({x} AS DECIMAL(12,2))"


def day(x: str) -> str:
    return (
        f"coalesce(TRY_CAST({x} AS DATE), CAST(try_strptime({x}, '%m/%d/%Y') AS DATE), "
        f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE))"
    )


def number_by(*columns: str) -> str:
    """Row number in digest order."""
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    return f"row_number() OVER (ORDER BY md5(concat_ws(chr(31), {parts})), {order})"


def first(keys: str, order: str, *ties: str) -> str:
    order = ", ".join([order, *[f"{t} ASC NULLS LAST" for t in ties]])
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


_KINDS = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN"}


def out(columns: str) -> str:
    """``name:kind`` pairs as casts to comparable types."""
    parts = []
    for item in columns.split():
        name, kind = item.split(":")
        parts.append(f"CAST({name} AS {_KINDS[kind]}) AS {name}")
    return ", ".join(parts)


def earlier(key: str) -> str:
    return f"left(md5(CAST({key} AS VARCHAR)), 1) < 'a'"


_FIRST = "coalesce(TRY_CAST(sale_id AS BIGINT) // 10 % 10 <> 0, false)"

SALES_OUT = "sale_id:i branch_id:i staff_id:s product_id:i sale_date:s volume_sold:d price:d cost:d revenue:d"
FACT_OUT = "sale_id:i date_key:i product_key:i branch_key:i staff_key:i sale_ts:s volume_sold:d price:d cost:d revenue:d"

# -- shared tables ---------------------------------------------------------------------------------

TABLES: dict[str, str] = {
    **RECIPES,
    "cities_clean": f"""
        SELECT {num('city_id')} AS city_id, {title('city_name')} AS city_name FROM raw_cities
        WHERE city_id IS NOT NULL {first('raw_cities.city_id', 'raw_cities.city_name ASC NULLS LAST')}""",
    "branches_clean": f"""
        SELECT {num('branch_id')} AS branch_id, {title('branch_name')} AS branch_name, {title('city_name')} AS city_name
        FROM raw_branches WHERE branch_id IS NOT NULL
        {first('raw_branches.branch_id', 'raw_branches.branch_name ASC NULLS LAST', 'raw_branches.city_name')}""",
    "products_clean": f"""
        SELECT {num('product_id')} AS product_id, {title('product_name')} AS product_name, {title('category')} AS category
        FROM raw_products WHERE product_id IS NOT NULL
        {first('raw_products.product_id', 'raw_products.product_name ASC NULLS LAST', 'raw_products.category')}""",
    "staff_clean": f"""
        SELECT trim(s.staff_id) AS staff_id, trim(s.employee_id) AS employee_id, {title('e.first_name')} AS first_name,
          {title('e.last_name')} AS last_name, {title('e.role')} AS role, e.hire_date
        FROM raw_staff s LEFT JOIN raw_employees e ON CAST(e.employee_id AS VARCHAR) = CAST(s.employee_id AS VARCHAR)
        WHERE s.staff_id IS NOT NULL
        {first('s.staff_id', 'e.hire_date DESC NULLS LAST', 's.employee_id', 'e.first_name', 'e.last_name', 'e.role')}""",
    "staff_latest_assignment": f"""
        SELECT trim(staff_id) AS staff_id, {num('branch_id')} AS branch_id, start_date, end_date FROM raw_assignments
        {first('raw_assignments.staff_id', "coalesce(end_date, DATE '9999-12-31') DESC, start_date DESC NULLS FIRST", 'raw_assignments.branch_id')}""",
    "typed_sales": f"""
        SELECT {num('sale_id')} AS sale_id, {num('branch_id')} AS branch_id, trim(staff_id) AS staff_id,
          {num('product_id')} AS product_id, sale_date AS sale_ts, {dec('volume_sold')} AS volume_sold,
          {dec('price')} AS price_raw, {dec('cost')} AS cost, {dec('revenue')} AS revenue_raw
        FROM raw_sales WHERE sale_id IS NOT NULL""",
    "product_prices": f"""
        SELECT {num('product_id')} AS product_id, {dec('price')} AS product_price, product_name FROM raw_products
        {first(num('raw_products.product_id'), 'product_name ASC NULLS LAST', 'price')}""",
    "sales_clean": f"""
        SELECT s.sale_id, s.branch_id, s.staff_id, s.product_id, s.sale_ts, s.volume_sold,
          coalesce(s.price_raw, p.product_price) AS price, s.cost,
          coalesce(CAST(s.revenue_raw AS DECIMAL(25,4)),
            CAST(CAST(coalesce(s.price_raw, p.product_price) AS DECIMAL(14,2)) * CAST(s.volume_sold AS DECIMAL(14,2)) AS DECIMAL(25,4))) AS revenue
        FROM (SELECT * FROM typed_sales {first('sale_id', 'sale_ts DESC NULLS LAST', 'branch_id', 'staff_id', 'product_id',
              'volume_sold', 'price_raw', 'cost', 'revenue_raw')}) s
        LEFT JOIN product_prices p ON p.product_id = s.product_id""",
    "dates": """
        SELECT CAST(unnest(generate_series(min_d, max_d, INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT CAST(min(sale_ts) AS DATE) AS min_d, CAST(max(sale_ts) AS DATE) AS max_d FROM sales_clean)""",
    "date_keys": f"SELECT {number_by('date')} AS date_key, date FROM dates",
    "branch_keys": f"""
        SELECT {number_by('branch_id', 'city_name', 'branch_name')} AS branch_key, branch_id, city_name, branch_name
        FROM branches_clean""",
    "product_keys": f"""
        SELECT {number_by('product_id', 'product_name', 'category')} AS product_key, product_id, product_name, category
        FROM products_clean""",
    "staff_keys": f"""
        SELECT {number_by('staff_id', 'employee_id', 'first_name', 'last_name', 'role')} AS staff_key, staff_id,
          employee_id, first_name, last_name, role FROM staff_clean""",
    "fact": """
        SELECT s.sale_id, d.date_key, p.product_key, b.branch_key, st.staff_key, s.sale_ts, s.volume_sold,
          s.price, s.cost, CAST(s.revenue AS DECIMAL(12,2)) AS revenue
        FROM sales_clean s JOIN date_keys d ON d.date = CAST(s.sale_ts AS DATE)
        LEFT JOIN product_keys p ON p.product_id = s.product_id
        LEFT JOIN branch_keys b ON b.branch_id = s.branch_id
        LEFT JOIN staff_keys st ON st.staff_id = s.staff_id
        WHERE s.sale_id IS NOT NULL""",
    "holidays_clean": f"""
        SELECT md5(coalesce(CAST(d AS VARCHAR), '') || '||' || coalesce(upper(trim(n)), '')) AS holiday_key,
          d AS holiday_date, o AS observed_date, upper(trim(n)) AS holiday_name, CAST(NULL AS VARCHAR) AS local_name,
          coalesce(nullif(trim(t), ''), 'Public') AS holiday_type, year(d) AS year, month(d) AS month, day(d) AS day,
          strftime(d, '%a') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, coalesce(o <> d, false) AS is_observed
        FROM (SELECT {day('raw_date')} AS d, holiday_name AS n, holiday_type AS t, {day('observed')} AS o FROM raw_holidays)
        WHERE d IS NOT NULL
        {first('d, upper(trim(n))', 'CASE WHEN o IS NOT NULL THEN 1 ELSE 0 END DESC, o DESC NULLS LAST', "coalesce(nullif(trim(t), ''), 'Public')")}""",
    "loaded_sales": f"""
        SELECT CAST(sale_id AS DECIMAL(38,0)) AS sale_id, CAST(branch_id AS INTEGER) AS branch_id, trim(staff_id) AS staff_id,
          CAST(product_id AS INTEGER) AS product_id, sale_date, {dec('volume_sold')} AS volume_sold, {dec('price')} AS price,
          {dec('cost')} AS cost, {dec('revenue')} AS revenue
        FROM raw_sales WHERE volume_sold <> 'bad'""",
    "dirty_assignments": """
        SELECT staff_id, CAST(branch_id AS INTEGER) AS branch_id,
          CASE WHEN CAST(branch_id AS INTEGER) <> 13 THEN CAST(start_date AS TIMESTAMP) END AS start_date,
          CASE WHEN CAST(branch_id AS INTEGER) <> 21 THEN CAST(end_date AS TIMESTAMP) END AS end_date,
          CAST(branch_id AS INTEGER) = 13 AS bad
        FROM raw_assignments""",
    "upserted": f"""
        SELECT c_custkey, c_mktsegment AS s, c_name,
          CASE WHEN NOT {earlier('c_custkey')} THEN 'I' WHEN c_mktsegment <> 'MACHINERY' THEN 'U' ELSE 'K' END AS action
        FROM customer""",
}


def with_tables(select: str, **instead: str) -> str:
    """Prefix a SELECT with the shared tables it needs, each after those it reads.

    ``instead`` gives other definitions for some of them.
    """
    tables = {**TABLES, **instead}
    done: dict[str, str] = {}

    def add(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in tables and name not in done:
                body = tables[name].strip()
                add(body)
                done[name] = body

    add(select)
    if not done:
        return select.strip()
    return "WITH " + ",\n".join(f"{n} AS (\n{b}\n)" for n, b in done.items()) + "\n" + select.strip()


def _dim(key: str, key_columns: str, bk: str, table: str, update: dict[str, str], keep: dict[str, str], columns: str) -> str:
    """A keyed dimension after an earlier state and the present one were merged."""
    old = {c: f"'Old ' || {c}" for c in [*update, *keep] if (update | keep)[c]}
    names = key_columns.split()
    before = ", ".join(f"{old[c]} AS {c}" if c in old else c for c in names)
    now = ", ".join(f"o.{c}" if c in keep else f"n.{c}" for c in names)
    return f"""
        SELECT {out(columns)} FROM (
          SELECT {key}, {now} FROM (SELECT {number_by(*names)} AS {key}, * FROM (SELECT {before} FROM {table} WHERE {earlier(bk)})) o
          JOIN {table} n ON n.{bk} = o.{bk}
          UNION ALL
          SELECT (SELECT count(*) FROM {table} WHERE {earlier(bk)}) + {number_by(*names)} AS {key}, {', '.join(names)}
          FROM {table} WHERE NOT coalesce({earlier(bk)}, false))"""


_CALENDAR = """date_key, date, day(date) AS day, month(date) AS month, year(date) AS year, quarter(date) AS quarter,
          strftime(date, '%a') AS day_name, isodow(date) >= 6 AS is_weekend"""

_LOAD_CAMPAIGNS = """
    SELECT campaign_id, city_id, channel_id, impressions, clicks, conversions, nullif(spend, '\\N') AS spend, start_date,
      end_date FROM raw_campaigns"""

SELECTS: dict[str, str] = {
    # sources and loading
    "read_json_stage": "SELECT staff_id, employee_id FROM raw_staff",
    "read_csv_stage": _LOAD_CAMPAIGNS,
    "csv_ragged_rows": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
          CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN c_mktsegment ELSE c_mktsegment || ', quoted' END AS segment FROM customer""",
    "read_parquet_stage": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "file_pattern": "SELECT staff_id, employee_id FROM raw_staff",
    "load_prefix_or_file": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, 'prefix' AS origin FROM orders
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), 'named' FROM orders WHERE o_orderstatus = 'F'""",
    "json_field_project": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
          json_extract_string(props, '$.zz') AS "none" FROM events""",
    "csv_position_project": f"""
        SELECT {out('campaign_id:i impressions:i')}, CAST({dec("spend")} AS DOUBLE) AS spend, start_date FROM raw_campaigns""",
    "copy_positional": _LOAD_CAMPAIGNS,
    "copy_continue": f"""
        SELECT {out(SALES_OUT)}, 'loaded' AS status, CAST(NULL AS VARCHAR) AS error FROM loaded_sales
        UNION ALL SELECT {', '.join('NULL' for _ in range(9))}, 'rejected', 'volume_sold: not a decimal(12,2)'
        FROM raw_sales WHERE volume_sold = 'bad'""",
    "copy_abort": "SELECT 'dirty' AS files, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'clean', count(*) FROM loaded_sales",
    "copy_skip_file": f"""
        SELECT {out(SALES_OUT)} FROM loaded_sales WHERE strftime(sale_date, '%Y-%m') NOT IN
          (SELECT strftime(sale_date, '%Y-%m') FROM raw_sales WHERE volume_sold = 'bad')""",
    "strict_vs_try_cast": f"""
        SELECT {out('staff_id:s branch_id:i start_date:s end_date:s')}, 'loaded' AS status, CAST(NULL AS VARCHAR) AS error
        FROM dirty_assignments WHERE NOT bad
        UNION ALL SELECT NULL, NULL, NULL, NULL, 'rejected', 'start_date: not a timestamp_ntz' FROM dirty_assignments WHERE bad""",
    "load_branches": f"SELECT {number_by('branch_name', 'city_name')} AS branch_id, branch_name, city_name FROM raw_branches",
    "load_campaigns": _LOAD_CAMPAIGNS,
    "load_campaign_channels": f"SELECT {out('channel_id:i channel_name:s')} FROM raw_campaign_channels",
    "load_employees": f"""
        SELECT {out('employee_id:s first_name:s last_name:s email:s phone:s hire_date:s role:s')}
        FROM raw_employees WHERE role <> 'bar tender'""",
    "load_products": """
        SELECT product_id, trim(product_name) AS product_name, trim(category) AS category, price FROM raw_products""",
    "load_staff": "SELECT staff_id, employee_id FROM raw_staff",
    "load_staff_branch_assignments": f"""
        SELECT {out('staff_id:s branch_id:i start_date:s end_date:s')} FROM dirty_assignments WHERE NOT bad""",
    "load_sales": f"SELECT {out(SALES_OUT)} FROM loaded_sales",
    "load_cities": f"SELECT {number_by('city_name')} AS city_id, city_name FROM raw_cities",
    "load_history": """
        SELECT count(*) AS parsed, count(*) FILTER (volume_sold <> 'bad') AS loaded, count(*) FILTER (volume_sold = 'bad') AS rejected,
          CASE WHEN count(*) FILTER (volume_sold = 'bad') > 0 THEN 'volume_sold: not a decimal(12,2)' END AS first_error FROM raw_sales""",
    "rejected_rows": """
        SELECT sale_id, volume_sold, 'volume_sold: not a decimal(12,2)' AS error FROM raw_sales WHERE volume_sold = 'bad'""",
    "backfill_new_files": """
        SELECT product_id, trim(product_name) AS product_name, trim(category) AS category, price,
          CAST(CASE WHEN price = 'n/a' THEN 2 ELSE 1 END AS BIGINT) AS load_id FROM raw_products""",
    "read_catalog_table": "SELECT raw_date, holiday_name, holiday_type, observed FROM raw_holidays",
    # projections and filters
    "rename_passthrough": """
        SELECT raw_date AS raw_holiday_date, holiday_name AS raw_holiday_name, raw_date, holiday_name, holiday_type, observed
        FROM raw_holidays""",
    "null_placeholder": """
        SELECT raw_date, holiday_name, CAST(NULL AS VARCHAR) AS raw_local_name, CAST(NULL AS BIGINT) AS raw_year FROM raw_holidays""",
    "required_key_filter": "SELECT sale_id, product_id FROM raw_sales WHERE sale_id IS NOT NULL",
    "upper_bound_filter": f"""
        SELECT {out('staff_id:s start_date:s')} FROM raw_assignments WHERE start_date <= DATE '1998-06-30'""",
    "post_window_filter": f"""
        SELECT product_id, product_name, price FROM raw_products {first('product_id', 'product_name DESC NULLS LAST', 'price')}""",
    "boolean_flags": f"""
        SELECT raw_date, holiday_name, observed, coalesce({day('observed')} <> {day('raw_date')}, false) AS is_observed,
          coalesce(trim(holiday_type) IN ('Religious', 'Bank'), false) AS is_closed FROM raw_holidays""",
    "null_safe_case": f"""
        SELECT raw_date, holiday_name, CASE WHEN {day('raw_date')} IS NOT NULL THEN year({day('raw_date')}) END AS year FROM raw_holidays""",
    "preview_limit": """
        SELECT raw_date, holiday_name, holiday_type, observed FROM raw_holidays
        ORDER BY raw_date ASC NULLS LAST, holiday_name ASC NULLS LAST, holiday_type ASC NULLS LAST, observed ASC NULLS LAST LIMIT 5""",
    "select_all_check": "SELECT city_id, city_name FROM raw_cities",
    # joins
    "join_normalised_name": f"""
        SELECT b.branch_id, b.branch_name, CAST(c.id AS BIGINT) AS matched_city_id FROM raw_branches b LEFT JOIN (
          SELECT {title('city_name')} AS name, min({num('city_id')}) AS id FROM raw_cities GROUP BY 1) c
        ON c.name = {title('b.city_name')}""",
    "join_cast_key": """
        SELECT s.staff_id, s.employee_id, e.first_name, e.role FROM raw_staff s
        LEFT JOIN raw_employees e ON CAST(e.employee_id AS VARCHAR) = CAST(s.employee_id AS VARCHAR)""",
    "join_price_fallback": f"""
        SELECT {out('sale_id:i s.product_id:i volume_sold:d price_raw:d product_price:d').replace('AS s.product_id', 'AS product_id')},
          CAST(coalesce(price_raw, product_price) AS DOUBLE) AS price
        FROM typed_sales s LEFT JOIN product_prices p ON p.product_id = s.product_id""",
    "join_date_dim": f"""
        SELECT {out('sale_id:i date_key:i sale_ts:s')} FROM sales_clean JOIN date_keys ON date = CAST(sale_ts AS DATE)""",
    "lookup_product_key": """
        SELECT CAST(sale_id AS BIGINT) AS sale_id, CAST(s.product_id AS BIGINT) AS product_id, product_key
        FROM typed_sales s LEFT JOIN product_keys k ON k.product_id = s.product_id""",
    "lookup_branch_key": """
        SELECT CAST(sale_id AS BIGINT) AS sale_id, CAST(s.branch_id AS BIGINT) AS branch_id, branch_key
        FROM typed_sales s LEFT JOIN branch_keys k ON k.branch_id = s.branch_id""",
    "lookup_staff_key": """
        SELECT CAST(sale_id AS BIGINT) AS sale_id, s.staff_id, staff_key
        FROM typed_sales s LEFT JOIN staff_keys k ON k.staff_id = s.staff_id""",
    "stage_listing": "SELECT DISTINCT o_orderpriority AS priority, true AS has_data FROM orders",
    "lateral_generate": """
        SELECT staff_id, CAST(CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS d
        FROM (SELECT staff_id, min(start_date) AS a, max(start_date) AS b FROM raw_assignments GROUP BY 1)""",
    "merge_match_join": "SELECT c_custkey, action FROM upserted",
    # aggregations, windows, sorts
    "date_bounds": """
        SELECT CAST(CAST(min(sale_date) AS DATE) AS VARCHAR) AS min_d, CAST(CAST(max(sale_date) AS DATE) AS VARCHAR) AS max_d FROM raw_sales""",
    "row_count": "SELECT count(*) AS n FROM raw_branches",
    "merge_counts": """
        SELECT count(*) FILTER (action = 'I') AS rows_inserted, count(*) FILTER (action = 'U') AS rows_updated,
          CAST(0 AS BIGINT) AS rows_deleted FROM upserted""",
    "cities_clean_dedupe": f"""
        SELECT city_id, city_name FROM raw_cities WHERE city_id IS NOT NULL {first('city_id', 'city_name ASC NULLS LAST')}""",
    "branches_clean_dedupe": f"""
        SELECT branch_id, branch_name, city_name FROM raw_branches WHERE branch_id IS NOT NULL
        {first('branch_id', 'branch_name ASC NULLS LAST', 'city_name')}""",
    "products_clean_dedupe": f"""
        SELECT product_id, product_name, category, price FROM raw_products WHERE product_id IS NOT NULL
        {first('product_id', 'product_name ASC NULLS LAST', 'category', 'price')}""",
    "staff_latest_hire": f"""
        SELECT staff_id, s.employee_id, CAST(hire_date AS VARCHAR) AS hire_date, role
        FROM raw_staff s LEFT JOIN raw_employees e ON e.employee_id = s.employee_id
        {first('staff_id', 'e.hire_date DESC NULLS LAST', 's.employee_id', 'role')}""",
    "latest_assignment": f"""
        SELECT {out('staff_id:s branch_id:s start_date:s end_date:s')} FROM raw_assignments
        {first('raw_assignments.staff_id', "coalesce(raw_assignments.end_date, DATE '9999-12-31') DESC, raw_assignments.start_date DESC NULLS FIRST",
               'raw_assignments.branch_id')}""",
    "latest_sale": f"""
        SELECT sale_id, branch_id, staff_id, product_id, CAST(sale_date AS VARCHAR) AS sale_date, volume_sold, price, cost, revenue
        FROM raw_sales WHERE sale_id IS NOT NULL
        {first('sale_id', 'raw_sales.sale_date DESC NULLS LAST', 'branch_id', 'staff_id', 'product_id', 'volume_sold', 'price', 'cost', 'revenue')}""",
    "last_log_statement": """
        SELECT 'DAY' AS step_name, CAST(sale_date AS VARCHAR) AS started_at, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
          CAST(0 AS BIGINT) AS rows_deleted, 'day' AS notes FROM raw_sales
        WHERE sale_date = (SELECT max(sale_date) FROM raw_sales) GROUP BY sale_date""",
    "holiday_dedupe": f"""
        SELECT md5(CAST(d AS VARCHAR) || '||' || n) AS holiday_key, CAST(o AS VARCHAR) AS o, t AS holiday_type
        FROM (SELECT {day('raw_date')} AS d, upper(trim(holiday_name)) AS n, {day('observed')} AS o, holiday_type AS t FROM raw_holidays) h
        WHERE d IS NOT NULL {first('d, n', 'CASE WHEN h.o IS NOT NULL THEN 1 ELSE 0 END DESC, h.o DESC NULLS LAST', 't')}""",
    "sort_nulls_last": """
        SELECT employee_id, CAST(hire_date AS VARCHAR) AS hire_date FROM raw_employees
        ORDER BY raw_employees.hire_date DESC NULLS LAST, employee_id""",
    "sort_computed_key": f"""
        SELECT {out('staff_id:s branch_id:s start_date:s end_date:s')} FROM raw_assignments
        ORDER BY coalesce(raw_assignments.end_date, DATE '9999-12-31') DESC, raw_assignments.start_date DESC""",
    "top1": """
        SELECT sale_id, branch_id, staff_id, product_id, CAST(sale_date AS VARCHAR) AS sale_date, volume_sold, price, cost, revenue
        FROM raw_sales ORDER BY raw_sales.sale_date DESC NULLS LAST, sale_id ASC NULLS LAST, branch_id ASC NULLS LAST,
          staff_id ASC NULLS LAST, product_id ASC NULLS LAST, volume_sold ASC NULLS LAST, price ASC NULLS LAST,
          cost ASC NULLS LAST, revenue ASC NULLS LAST LIMIT 1""",
    "limit_n": """
        SELECT product_id, product_name, category, price FROM raw_products
        ORDER BY product_id ASC NULLS LAST, product_name ASC NULLS LAST LIMIT 5""",
    # scalar functions
    "try_number": f"""
        SELECT sale_id, CAST({num('sale_id')} AS BIGINT) AS sale_number, CAST({num('volume_sold')} AS BIGINT) AS volume,
          CAST({num("volume_sold || '1'")} AS BIGINT) AS volume_more, CAST({num('staff_id')} AS BIGINT) AS staff FROM raw_sales""",
    "try_decimal": f"""
        SELECT sale_id, CAST({dec('volume_sold')} AS DOUBLE) AS volume_sold, CAST({dec('cost')} AS DOUBLE) AS cost,
          CAST({dec("cost || '9'")} AS DOUBLE) AS rounded, CAST({dec("'9999999999' || cost")} AS DOUBLE) AS too_large FROM raw_sales""",
    "trim_text": "SELECT trim(staff_id) AS staff_id, employee_id FROM raw_staff",
    "title_case": f"""
        SELECT product_id, {title('product_name')} AS product_name, {title('category')} AS category FROM raw_products
        UNION ALL SELECT city_id, {title('city_name')}, NULL FROM raw_cities""",
    "upper_text": "SELECT raw_date, upper(trim(holiday_name)) AS holiday_name FROM raw_holidays",
    "null_if": """
        SELECT raw_date, nullif(trim(holiday_type), '') AS holiday_type, nullif(raw_date, 'TBC') AS known_date FROM raw_holidays""",
    "coalesce_default": """
        SELECT staff_id, branch_id, CAST(coalesce(end_date, DATE '9999-12-31') AS VARCHAR) AS end_date,
          coalesce(CAST(end_date AS VARCHAR), 'open') AS end_text FROM raw_assignments""",
    "derived_revenue": f"""
        SELECT {out('sale_id:i price:d volume_sold:d revenue:d')}, CAST(CAST(revenue AS DECIMAL(12,2)) AS DOUBLE) AS revenue_2 FROM sales_clean""",
    "cast_string": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_text, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_text FROM orders""",
    "cast_int": f"SELECT {out('campaign_id:i clicks:i')} FROM raw_campaigns",
    "cast_decimal": """
        SELECT sale_id, CAST(CAST(cost AS DECIMAL(12,2)) AS DOUBLE) AS cost, CAST(CAST(price AS DECIMAL(12,2)) AS DOUBLE) AS price FROM raw_sales""",
    "cast_date": "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events",
    "cast_timestamp_ntz": "SELECT campaign_id, CAST(CAST(start_date AS TIMESTAMP) AS VARCHAR) AS started FROM raw_campaigns",
    "try_timestamp_ntz": "SELECT raw_date, holiday_name, CAST(TRY_CAST(raw_date AS TIMESTAMP) AS VARCHAR) AS ts FROM raw_holidays",
    "try_date_multi": f"SELECT raw_date, holiday_name, CAST({day('raw_date')} AS VARCHAR) AS d FROM raw_holidays",
    "date_parts": """
        SELECT staff_id, CAST(start_date AS VARCHAR) AS start_date, day(raw_assignments.start_date) AS day, month(raw_assignments.start_date) AS month,
          year(raw_assignments.start_date) AS year, quarter(raw_assignments.start_date) AS quarter FROM raw_assignments""",
    "day_name": """
        SELECT staff_id, CAST(start_date AS VARCHAR) AS start_date, strftime(raw_assignments.start_date, '%a') AS day_name FROM raw_assignments""",
    "is_weekend_iso": """
        SELECT staff_id, CAST(end_date AS VARCHAR) AS end_date, isodow(raw_assignments.end_date) IN (6, 7) AS is_weekend FROM raw_assignments""",
    "is_weekend_sun0": """
        SELECT staff_id, CAST(end_date AS VARCHAR) AS end_date, coalesce(dayofweek(raw_assignments.end_date) IN (0, 6), false) AS is_weekend
        FROM raw_assignments""",
    "date_add_days": """
        SELECT staff_id, CAST(start_date AS VARCHAR) AS start_date,
          CAST(raw_assignments.start_date + CAST(branch_id AS INTEGER) AS VARCHAR) AS later FROM raw_assignments""",
    "hours_ago": "SELECT event_id FROM events WHERE event_id % 240 <= 120",
    "md5_key": f"""
        SELECT raw_date, holiday_name, md5(coalesce(CAST({day('raw_date')} AS VARCHAR), '') || '||' || coalesce(upper(trim(holiday_name)), ''))
          AS holiday_key FROM raw_holidays""",
    "null_safe_differs": "SELECT sale_id, price, revenue, price IS DISTINCT FROM revenue AS differs FROM raw_sales",
    "audit_timestamp": """
        SELECT staff_id, true AS has_timestamp, true AS has_time FROM raw_staff""",
    "concat_text": "SELECT raw_date, coalesce(raw_date, '') || '||' || holiday_name AS joined FROM raw_holidays",
    # table functions and keys
    "date_series": """
        SELECT CAST(CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS d
        FROM (SELECT CAST(min(sale_date) AS DATE) AS a, CAST(max(sale_date) AS DATE) AS b FROM raw_sales)""",
    "surrogate_key": f"""
        SELECT 100 + {number_by('product_id')} AS product_key, product_id FROM (SELECT DISTINCT product_id FROM raw_products)""",
    "identity_on_load": f"""
        SELECT {number_by('branch_name', 'city_name')} AS branch_id, branch_name, city_name FROM raw_branches
        UNION ALL SELECT (SELECT count(*) FROM raw_branches) + {number_by('branch_name', 'city_name')}, branch_name, city_name FROM raw_branches""",
    # merges and writes
    "merge_upsert": """
        SELECT c_custkey, CASE action WHEN 'K' THEN 'Old ' || c_name ELSE c_name END AS c_name,
          CASE action WHEN 'I' THEN s ELSE 'Old ' || s END AS c_mktsegment FROM upserted""",
    "merge_history": f"""
        SELECT CAST(1 AS BIGINT) AS version, count(*) FILTER ({earlier('city_id')}) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
          CAST(0 AS BIGINT) AS rows_deleted FROM cities_clean WHERE city_id IS NOT NULL
        UNION ALL SELECT 2, count(*) FILTER (NOT {earlier('city_id')}), count(*) FILTER ({earlier('city_id')}), 0
        FROM cities_clean WHERE city_id IS NOT NULL""",
    "dim_city": f"SELECT {out('city_id:i city_name:s')} FROM cities_clean WHERE city_id IS NOT NULL",
    "dim_branch": _dim(
        "branch_key", "branch_id city_name branch_name", "branch_id", "branches_clean",
        {"branch_name": "old"}, {"city_name": "old"}, "branch_key:i branch_id:i city_name:s branch_name:s",
    ),
    "dim_product": _dim(
        "product_key", "product_id product_name category", "product_id", "products_clean",
        {"product_name": "old", "category": "old"}, {}, "product_key:i product_id:i product_name:s category:s",
    ),
    "dim_staff": _dim(
        "staff_key", "staff_id employee_id first_name last_name role", "staff_id", "staff_clean",
        {"employee_id": "old", "role": "old"}, {}, "staff_key:i staff_id:s employee_id:s first_name:s last_name:s role:s",
    ),
    "dim_date": f"""
        SELECT {out('date_key:i date:s day:i month:i year:i quarter:i day_name:s is_weekend:b')} FROM (
          SELECT {_CALENDAR} FROM (
            SELECT {number_by('date')} AS date_key, date FROM all_days WHERE early
            UNION ALL
            SELECT (SELECT count(*) FROM all_days WHERE early) + {number_by('date')}, date FROM all_days WHERE NOT early))""",
    "fact_sales": f"SELECT {out(FACT_OUT)} FROM fact",
    "merge_if_changed": f"""
        SELECT {out('holiday_key:s holiday_date:s observed_date:s holiday_name:s local_name:s holiday_type:s year:i month:i day:i day_name:s is_weekend:b is_observed:b run:i')}
        FROM (SELECT * REPLACE (CASE WHEN state = 'kept' THEN 'before' END AS local_name), CASE WHEN state = 'kept' THEN 1 ELSE 2 END AS run
          FROM (SELECT *, CASE WHEN NOT {earlier('holiday_key')} THEN 'new' WHEN month = 1 AND holiday_type <> 'Regional' THEN 'changed'
            ELSE 'kept' END AS state FROM holidays_clean))""",
    "first_run_or_merge": f"""
        SELECT CAST(1 AS BIGINT) AS run, count(*) FILTER ({earlier('holiday_key')}) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
          CAST(0 AS BIGINT) AS rows_deleted FROM holidays_clean
        UNION ALL SELECT 2, count(*) FILTER (NOT {earlier('holiday_key')}),
          count(*) FILTER ({earlier('holiday_key')} AND month = 1 AND holiday_type <> 'Regional'), 0 FROM holidays_clean""",
    "insert_select": "SELECT city_name FROM raw_cities UNION ALL SELECT city_name FROM raw_branches",
    "create_or_replace_table": "SELECT staff_id, employee_id FROM raw_staff",
    "create_view": f"SELECT {out('city_id:i city_name:s')} FROM cities_clean",
    "etl_log_row": """
        SELECT 'LOAD_CUSTOMERS' AS step_name, count(*) FILTER (action = 'I') AS rows_inserted, count(*) FILTER (action = 'U') AS rows_updated,
          CAST(0 AS BIGINT) AS rows_deleted, 'MERGE from customers' AS notes, count(*) FILTER (action <> 'K') AS rows_affected FROM upserted""",
    "publish_snapshot": f"""
        SELECT 'dim_city' AS name, CAST(city_id AS BIGINT) AS id, city_name AS text FROM cities_clean WHERE city_id IS NOT NULL
        UNION ALL SELECT 'dim_branch', CAST(branch_id AS BIGINT), branch_name FROM branches_clean""",
    # clean views and the whole run
    "cities_clean": f"SELECT {out('city_id:i city_name:s')} FROM cities_clean",
    "branches_clean": f"""
        SELECT {out('branch_id:i branch_name:s')}, b.city_name, CAST(c.id AS BIGINT) AS matched_city_id FROM branches_clean b LEFT JOIN (
          SELECT {title('city_name')} AS name, min({num('city_id')}) AS id FROM raw_cities GROUP BY 1) c ON c.name = b.city_name""",
    "products_clean": f"SELECT {out('product_id:i product_name:s category:s')} FROM products_clean",
    "staff_clean": f"SELECT {out('staff_id:s employee_id:s first_name:s last_name:s role:s hire_date:s')} FROM staff_clean",
    "staff_latest_assignment": f"SELECT {out('staff_id:s branch_id:i start_date:s end_date:s')} FROM staff_latest_assignment",
    "sales_clean": f"""
        SELECT {out('sale_id:i branch_id:i staff_id:s product_id:i sale_ts:s volume_sold:d price:d cost:d revenue:d')} FROM sales_clean""",
    "holidays_clean": f"""
        SELECT {out('holiday_key:s holiday_date:s observed_date:s holiday_name:s local_name:s holiday_type:s year:i month:i day:i day_name:s is_weekend:b is_observed:b')}
        FROM holidays_clean""",
    "star_build": f"""
        SELECT CAST(f.sale_id AS BIGINT) AS sale_id, f.date_key, f.product_key, f.branch_key, f.staff_key,
          CAST(f.sale_ts AS VARCHAR) AS sale_ts, {out('volume_sold:d price:d cost:d revenue:d')}, p.product_name,
          strftime(d.date, '%a') AS day_name, isodow(d.date) >= 6 AS is_weekend
        FROM fact f JOIN date_keys d ON d.date_key = f.date_key LEFT JOIN product_keys p ON p.product_key = f.product_key""",
    # data quality
    "check_unique": "SELECT sale_id, count(*) AS n FROM raw_sales WHERE sale_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "check_not_null": "SELECT sale_id, price, cost FROM raw_sales WHERE price IS NULL",
    "check_accepted_values": """
        SELECT raw_date, holiday_name, holiday_type FROM raw_holidays WHERE holiday_type NOT IN ('Religious', 'Public')""",
    "check_max_length": "SELECT doc_id FROM documents WHERE length(text) > 50",
    "run_checks": """
        SELECT 'unique' AS test, 'raw_date' AS "column", count(*) AS failures
          FROM (SELECT raw_date FROM raw_holidays WHERE raw_date IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'not_null', 'holiday_type', count(*) FILTER (holiday_type IS NULL) FROM raw_holidays
        UNION ALL SELECT 'not_null', 'raw_date', count(*) FILTER (raw_date IS NULL) FROM raw_holidays
        UNION ALL SELECT 'accepted_values', 'holiday_type',
          count(*) FILTER (holiday_type NOT IN ('Religious', 'Public', 'Bank', 'Regional')) FROM raw_holidays
        UNION ALL SELECT 'max_length', 'holiday_name', count(*) FILTER (length(holiday_name) > 12) FROM raw_holidays""",
    "audited_model": """
        SELECT 'none' AS fault, true AS published, CAST(NULL AS VARCHAR) AS test, CAST(NULL AS VARCHAR) AS "column", CAST(NULL AS BIGINT) AS failures
        UNION ALL SELECT 'unique', false, 'unique', 'holiday_key', count(*) FILTER (month = 1) FROM holidays_clean
        UNION ALL SELECT 'null key', false, 'not_null', 'holiday_key', count(*) FILTER (month = 2) FROM holidays_clean
        UNION ALL SELECT 'null date', false, 'not_null', 'holiday_date', count(*) FILTER (month = 3) FROM holidays_clean
        UNION ALL SELECT 'null name', false, 'not_null', 'holiday_name', count(*) FILTER (month = 4) FROM holidays_clean
        UNION ALL SELECT 'other type', false, 'accepted_values', 'holiday_type', count(*) FILTER (month = 5) FROM holidays_clean""",
    "expire_versions": """
        SELECT 'store' AS "where", CAST(1 AS BIGINT) AS versions, CAST(city_id AS BIGINT) AS city_id, 'v2 ' || city_name AS city_name FROM cities_clean
        UNION ALL SELECT 'published', 1, CAST(city_id AS BIGINT), city_name FROM cities_clean""",
    # streaming and change capture
    "auto_ingest": f"SELECT {out(SALES_OUT)} FROM loaded_sales",
    "scheduled_copy": f"""
        SELECT {number_by('branch_name', 'city_name')} AS branch_id, branch_name, city_name FROM raw_branches WHERE city_name = 'nowhere'
        UNION ALL SELECT (SELECT count(*) FROM raw_branches WHERE city_name = 'nowhere') + {number_by('branch_name', 'city_name')},
          branch_name, city_name FROM raw_branches WHERE city_name <> 'nowhere'""",
    "resume_ingest": f"""
        SELECT CAST(CASE WHEN {_FIRST} THEN 1 ELSE 2 END AS BIGINT) AS load_id, count(*) AS parsed,
          count(*) FILTER (volume_sold <> 'bad') AS loaded, count(*) FILTER (volume_sold = 'bad') AS rejected FROM raw_sales GROUP BY 1""",
    "table_changes": f"""
        SELECT c_custkey, c_name, c_mktsegment, CASE WHEN {earlier('c_custkey')} THEN 'update' ELSE 'insert' END AS _change FROM customer
        WHERE NOT {earlier('c_custkey')} OR c_mktsegment = 'MACHINERY'
        UNION ALL SELECT -c_custkey, c_name, c_mktsegment, 'delete' FROM customer WHERE {earlier('c_custkey')} AND c_mktsegment = 'BUILDING'""",
    "version_changes": """
        SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN 'Old ' || c_name ELSE c_name END AS c_name, c_mktsegment,
          CASE WHEN c_custkey % 3 = 1 THEN 'update' ELSE 'delete' END AS _change
        FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_custkey % 3 < 2
        UNION ALL SELECT -c_custkey, c_name, c_mktsegment, 'insert' FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_custkey % 3 = 1""",
    "has_changes": """
        SELECT CAST(0 AS BIGINT) AS bookmark, count(*) > 0 AS changed FROM loaded_sales UNION ALL SELECT 1, false""",
    "merge_deltas": f"SELECT {out(FACT_OUT.replace('date_key:i ', ''))} FROM fact",
    "late_members": f"""
        SELECT {out('sale_id:i product_id:i branch_id:i staff_id:s sale_ts:s volume_sold:d price:d cost:d revenue:d')} FROM (
          SELECT f.*, p.product_id, b.branch_id, s.staff_id FROM fact f
          LEFT JOIN product_keys p ON p.product_key = f.product_key
          LEFT JOIN branch_keys b ON b.branch_key = f.branch_key
          LEFT JOIN staff_keys s ON s.staff_key = f.staff_key)""",
}

TABLES["all_days"] = """
    SELECT date, date BETWEEN (SELECT CAST(min(sale_ts) AS DATE) FROM early) AND (SELECT CAST(max(sale_ts) AS DATE) FROM early) AS early
    FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT CAST(min(sale_ts) AS DATE) AS a, CAST(max(sale_ts) AS DATE) AS b FROM typed_sales))"""
TABLES["early"] = "SELECT sale_ts FROM typed_sales WHERE sale_ts < TIMESTAMP '1998-06-01'"

ORACLES: dict[str, str] = {key: with_tables(select) for key, select in SELECTS.items()}
# Sales that came through a load lack the rows it rejects.
for _loaded in ("merge_deltas", "late_members"):
    ORACLES[_loaded] = with_tables(
        SELECTS[_loaded], raw_sales=f"SELECT * FROM ({RECIPES['raw_sales'].strip()}) WHERE volume_sold <> 'bad'"
    )
