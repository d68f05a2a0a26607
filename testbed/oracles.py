"""The SQL every registered query is compared with, on the same tables."""

from __future__ import annotations

from tillstream.schemas import ACTIONS, CURRENCIES, PAGES, PAYMENT_METHODS, REGIONS, STATUSES

# ── Bronze events: see testbed/events.py ─────────────────────────────────────
_CTES = {
    "raw_orders": """
    select 'order' event_type,
      case when l_orderkey % 97 = 0 then null
        else concat('EVT-', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) end event_id,
      concat(replace(cast(ts as varchar), ' ', 'T'), '+00:00') "timestamp",
      case when l_orderkey % 101 = 0 then null else concat('ORD-', cast(o_orderkey as varchar)) end order_id,
      concat('  cust-', cast(o_custkey as varchar), ' ') customer_id,
      concat(' ', r_name) region,
      concat('SKU-', cast(p_partkey as varchar)) product_id, p_name product_name, p_type category,
      p_retailprice unit_price,
      cast(l_quantity as integer) quantity, base subtotal, l_discount discount_pct, disc discount_amount,
      case when l_partkey % 89 = 0 then null
        when l_partkey % 83 = 0 then cast(0 as decimal(18,2))
        else cast(base - disc as decimal(18,2)) end total_amount,
      ' usd' currency, case o_orderpriority when '1-URGENT' then ' Credit_Card' when '2-HIGH' then 'PAYPAL '
        else concat(' ', o_orderpriority) end payment_method,
      case o_orderstatus when 'F' then ' Completed' when 'O' then 'PENDING ' else 'failed' end status,
      (l_partkey * 10000 + l_suppkey) * 100 + cast(l_quantity as bigint) kafka_offset,
      cast(l_orderkey % 3 as integer) kafka_partition, ts kafka_timestamp, ts event_ts
    from (
      select *, round(base * cast(l_discount as decimal(4,2)), 2) disc,
        o_orderdate + to_hours(cast(l_orderkey % 24 as integer)) ts
      from (
        select *, cast(cast(cast(round(l_extendedprice * 100) as bigint) % 60000 as double) / 100
          as decimal(18,2)) base
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
          join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
          join region on n_regionkey = r_regionkey))""",
    "raw_clicks": """
    select 'click' event_type,
      concat('CLK-', cast(event_id - (case when event_id % 11 = 0 and event_id > 0 then 1 else 0 end) as varchar)) event_id,
      concat(replace(cast(ts as varchar), ' ', 'T'), '+00:00') "timestamp",
      case when event_id % 53 = 0 then null
        else concat('SESS-', cast(user_id as varchar), '-', strftime(ts, '%Y%m%d')) end session_id,
      concat(' cust-', cast(user_id as varchar)) customer_id,
      concat(' zone ', cast(user_id % 5 as varchar), ' ') region,
      case when event_id % 59 = 0 then null else concat('SKU-', json_extract_string(props, '$.k')) end product_id,
      concat('Item ', json_extract_string(props, '$.k')) product_name,
      concat(' ', event_type, ' ') category,
      case when event_type = 'view' then ' Product_Detail' else concat(upper(event_type), ' ') end page,
      event_type in ('purchase', 'signup') added_to_cart,
      case when event_id % 7 = 0 then -cast(floor(value) as integer) else cast(floor(value) as integer) end time_on_page_sec,
      event_id kafka_offset, 0 kafka_partition, ts kafka_timestamp, ts event_ts
    from events""",
    "raw_inventory": """
    select 'inventory' event_type,
      concat('INV-', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) event_id,
      concat(replace(cast(l_shipdate as varchar), ' ', 'T'), '+00:00') "timestamp",
      case when l_orderkey % 97 = 0 then null else concat(' sku-', cast(l_partkey as varchar)) end product_id,
      p_name product_name,
      concat('wh-', cast(l_suppkey % 10 + 1 as varchar), ' ') warehouse_id,
      case when l_partkey % 89 = 0 then -1 when l_partkey % 83 = 0 then null
        else cast(l_quantity as integer) * 10 - 10 end stock_level,
      case when l_partkey % 7 = 0 then null else cast(20 + l_suppkey % 5 * 30 as integer) end reorder_threshold,
      (cast(l_quantity as integer) * 10 - 10) < 50 low_stock_alert,
      case when l_partkey % 79 = 0 then 'Lost' when l_returnflag = 'R' then ' Return'
        when l_returnflag = 'A' then 'Adjustment' else 'SALE_DEDUCTION' end action,
      (l_partkey * 10000 + l_suppkey) * 100 + cast(l_quantity as bigint) kafka_offset,
      cast(l_orderkey % 3 as integer) kafka_partition, l_shipdate kafka_timestamp, l_shipdate event_ts
    from lineitem join part on l_partkey = p_partkey""",
    # ── Validity: NULL counts as invalid ─────────────────────────────────────
    "judged_orders": """
    select *, coalesce(event_id is not null and order_id is not null and customer_id is not null
      and status is not null and total_amount > 0, false) ok from raw_orders""",
    "judged_clicks": """
    select *, coalesce(event_id is not null and session_id is not null and product_id is not null,
      false) ok from raw_clicks""",
    "judged_inventory": """
    select *, coalesce(event_id is not null and product_id is not null and stock_level >= 0,
      false) ok from raw_inventory""",
    # ── Silver ───────────────────────────────────────────────────────────────
    "clean_orders": """
    select * replace (upper(trim(customer_id)) as customer_id, trim(region) as region,
        lower(trim(status)) as status, lower(trim(payment_method)) as payment_method,
        upper(trim(currency)) as currency),
      total_amount >= 200.0 is_high_value, discount_pct > 0 is_discounted
    from judged_orders where ok
    qualify row_number() over (partition by event_id order by kafka_offset desc, kafka_partition desc) = 1""",
    "clean_clicks": """
    select * replace (upper(trim(customer_id)) as customer_id, trim(region) as region,
        trim(category) as category, lower(trim(page)) as page, abs(time_on_page_sec) as time_on_page_sec)
    from judged_clicks where ok
    qualify row_number() over (partition by event_id order by kafka_offset desc, kafka_partition desc) = 1""",
    "clean_inventory": """
    select * replace (upper(trim(product_id)) as product_id, upper(trim(warehouse_id)) as warehouse_id,
        lower(trim(action)) as action)
    from judged_inventory where ok
    qualify row_number() over (partition by event_id order by kafka_offset desc, kafka_partition desc) = 1""",
    # ── Gold; amounts as whole cents, half up ────────────────────────────────
    "completed": "select * from clean_orders where status = 'completed'",
    "hourly": """
    select date_trunc('hour', event_ts) hour_bucket, region,
      cast(sum(total_amount) as double) revenue, count(order_id) order_count,
      ((2 * cast(sum(total_amount) * 100 as bigint) + count(*)) // (2 * count(*))) / 100.0 avg_order_value,
      cast(sum(discount_amount) as double) total_discounts,
      count(distinct customer_id) unique_customers, 'hourly_revenue' kpi_type
    from completed group by 1, 2""",
    "products": """
    select product_id, product_name, category,
      cast(sum(total_amount) as double) revenue, cast(sum(quantity) as bigint) units_sold,
      ((2 * cast(sum(total_amount) * 100 as bigint) + count(*)) // (2 * count(*))) / 100.0 avg_order_value,
      count(order_id) order_count, 'top_products' kpi_type
    from completed group by 1, 2, 3""",
    "leaders": """
    select * from (select *, row_number() over (order by revenue desc, product_id, product_name, category) "rank"
      from products) where "rank" <= 10""",
    "funnel_counts": """
    select (select count(*) from clean_clicks) total_clicks,
      (select count(*) from clean_clicks where added_to_cart) added_to_cart,
      (select count(*) from completed) completed_orders""",
    "funnel": """
    select *, 'conversion' kpi_type,
      case when total_clicks > 0
        then ((20000 * completed_orders + total_clicks) // (2 * total_clicks)) / 100.0 else 0.0 end conversion_rate_pct,
      case when added_to_cart > 0
        then sign(added_to_cart - completed_orders)
          * ((20000 * abs(added_to_cart - completed_orders) + added_to_cart) // (2 * added_to_cart)) / 100.0
        else 0.0 end cart_abandonment_pct,
      case when total_clicks > 0
        then ((20000 * added_to_cart + total_clicks) // (2 * total_clicks)) / 100.0 else 0.0 end add_to_cart_rate_pct
    from funnel_counts""",
    "shelves": """
    select product_id, product_name, warehouse_id, max(stock_level) current_stock,
      max(reorder_threshold) reorder_threshold, bool_or(low_stock_alert) low_stock_alert, 'inventory' kpi_type
    from clean_inventory group by 1, 2, 3""",
    "last_shelves": """
    select product_id, product_name, warehouse_id, stock_level current_stock, reorder_threshold,
      low_stock_alert, 'inventory' kpi_type
    from clean_inventory
    qualify row_number() over (partition by product_id, product_name, warehouse_id
      order by event_ts desc, kafka_offset desc, kafka_partition desc) = 1""",
    "totals": """
    select cast(coalesce(sum(total_amount), 0) as double) total_revenue, count(*) total_orders,
      case when count(*) > 0 then
        ((2 * cast(sum(total_amount) * 100 as bigint) + count(*)) // (2 * count(*))) / 100.0
        else 0.0 end avg_order_value,
      (select count(*) from clean_clicks) total_clicks, 'summary' kpi_type
    from completed""",
    # ── Documents ────────────────────────────────────────────────────────────
    "hourly_docs": """
    select *, concat('hourly_revenue_', strftime(hour_bucket, '%Y-%m-%dT%H:%M:%S'), '_', region) id
    from hourly""",
    "shelf_docs": """
    select *, concat('inventory_', product_id, '_', product_name, '_', warehouse_id) id from shelves""",
    "last_shelf_docs": """
    select *, concat('inventory_', product_id, '_', product_name, '_', warehouse_id) id from last_shelves""",
    # ── Request log ──────────────────────────────────────────────────────────
    "log": """
    select ts, event_type endpoint, case when event_type = 'error' then 500 else 200 end status,
      value duration_sec from events""",
    "scraped": """
    select *, case when value >= last then value - last when last is not null then value end growth
    from (select *, lag(value) over (partition by endpoint order by ts) last from (
      select ts, event_type endpoint, cast(event_id % 997 as double) value from events
      where event_id % 1000 not between 300 and 400))""",
}

# The columns a bronze, silver or quarantine row is compared on, with one type each.
_AMOUNTS = """cast(subtotal as double) subtotal, discount_pct, cast(discount_amount as double) discount_amount,
  cast(total_amount as double) total_amount"""
_ORDER = f"""event_type, event_id, "timestamp", order_id, customer_id, region, product_id, product_name,
  category, unit_price, quantity, {_AMOUNTS}, currency, payment_method, status"""
_CLICK = """event_type, event_id, "timestamp", session_id, customer_id, region, product_id, product_name,
  category, page, added_to_cart, time_on_page_sec"""
_STOCK = """event_type, event_id, "timestamp", product_id, product_name, warehouse_id, stock_level,
  reorder_threshold, low_stock_alert, action"""


def _record(source: str) -> str:
    return f"kafka_offset, kafka_partition, kafka_timestamp, '{source}' source_topic"


def _layer(name: str, event: str) -> dict[str, str]:
    reason = {
        "orders": "missing_required_fields_or_invalid_amount",
        "clicks": "missing_required_click_fields",
        "inventory": "invalid_inventory_event",
    }[name]
    flags = ", is_high_value, is_discounted" if name == "orders" else ""
    return {
        f"bronze_{name}": f"select {event}, {_record(name)} from raw_{name}",
        f"silver_{name}": f"select {event}, {_record(name)}, event_ts{flags} from clean_{name}",
        f"quarantine_{name}": f"select {event}, {_record(name)}, '{reason}' quarantine_reason "
        f"from judged_{name} where not ok",
    }


def _windowed(minutes: int) -> str:
    start = f"time_bucket(interval '{minutes} minutes', ts)"
    return f"{start} window_start, {start} + interval '{minutes} minutes' window_end"


def _quantile(buckets: tuple, q: float) -> str:
    edges = [0, *buckets]
    cases = []
    for i, (low, high) in enumerate(zip(edges, buckets)):
        before = f"le{i - 1}" if i else "0"
        cases.append(
            f"when le{i} >= {q} * total then {low}.0 + {high - low}.0 * "
            f"(cast({q} as double) * total - {before}) / (le{i} - {before})"
        )
    return f"case {' '.join(cases)} else {buckets[-1]}.0 end"


def _quantiles(buckets: tuple, source: str = "") -> str:
    counts = ", ".join(
        f"count(*) filter (where duration_sec <= {le}) le{i}" for i, le in enumerate(buckets)
    )
    columns = ", ".join(
        f"round({_quantile(buckets, q)}, 6) {name}"
        for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
    )
    return (
        f"select window_start, window_end, {columns} from (select "
        f"{'window_start, window_end' if source else _windowed(5)}, {counts}, "
        f"count(duration_sec) total from {source or 'log'} group by 1, 2)"
    )


def _histogram(buckets: tuple) -> str:
    bounds = ", ".join(f"('{le}.0', {le}.0)" for le in buckets)
    counted = "count(duration_sec) filter (where duration_sec <= bound or le = '+Inf')"
    return (
        f"select {_windowed(1)}, le, {counted} requests "
        f"from log, (values {bounds}, ('+Inf', null)) b(le, bound) group by 1, 2, 3"
    )


_ERROR_RATE = (
    f"select {_windowed(5)}, "
    "cast(count(*) filter (where status between 500 and 599) as double) / count(*) * 100 error_pct "
    "from log group by 1, 2"
)

# Each row in each of the five overlapping windows it is part of.
_SLID = """(select *, window_start + interval '5 minutes' window_end from (
      select *, time_bucket(interval '1 minute', ts) - to_minutes(cast(k as integer)) window_start
      from log, range(5) r(k)))"""

_ERROR_RATE_SLIDING = (
    "select window_start, window_end, "
    "cast(count(*) filter (where status between 500 and 599) as double) / count(*) * 100 error_pct "
    f"from {_SLID} group by 1, 2"
)


def _spans(hours: int, slide: int | None = None) -> str:
    """Rows of ``log`` or ``scraped`` in each window of so many hours they are part of."""
    step = slide or hours
    start = f"time_bucket(interval '{step} hours', ts) - to_hours(cast(k * {step} as integer))"
    return (
        f"(select *, window_start + interval '{hours} hours' window_end from "
        f"(select *, {start} window_start from {{}}, range({hours // step}) r(k)))"
    )


_OFFSETS = """
  select (l_partkey * 10000 + l_suppkey) * 100 + cast(l_quantity as bigint) k
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    join part on l_partkey = p_partkey"""

_EXACT_LATENCY = (
    "select window_start, window_end, "
    + ", ".join(f"round(quantile_cont(duration_sec, {q}), 6) p{round(100 * q)}" for q in (0.5, 0.95, 0.99))
    + f" from {_spans(1).format('log')} group by 1, 2"
)


def _increase(hours: int, slide: int | None = None) -> str:
    """Growth between the first and last sample of a window, carried on to its edges."""
    def seconds(a: str, b: str) -> str:
        return f"(epoch_us({b}) - epoch_us({a}))"

    return f"""
      select * from (with held as (
        select endpoint, window_start, window_end, count(*) n, min(ts) a, max(ts) b,
          arg_min(value, ts) v, sum(growth) - arg_min(coalesce(growth, 0), ts) g
        from {_spans(hours, slide).format("scraped")} group by all having count(*) > 1
      ), edges as (
        select *, {seconds("a", "b")} span, {seconds("a", "b")} / (n - 1) mean,
          {seconds("window_start", "a")} back, {seconds("b", "window_end")} ahead from held
      ), halved as (
        select *, case when back >= mean * 1.1 then mean * 0.5 else back end back1,
          case when ahead >= mean * 1.1 then mean * 0.5 else ahead end ahead1 from edges
      ), grown as (
        select *, g * (span + case when g > 0 and v >= 0 then least(back1, span * v / g) else back1 end
          + ahead1) / span as inc from halved where span > 0
      )
      select window_start, window_end, endpoint, round(inc, 6) increase,
        round(inc / {hours * 3600}, 6) per_second from grown)"""


_PRICED = """
    select *, subtotal - discount_amount total_amount from (
      select *, cast(round(subtotal * cast(l_discount as decimal(9,4)), 2) as decimal(18,2)) discount_amount from (
        select *, concat('EVT-', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) event_id,
          (l_partkey * 10000 + l_suppkey) * 100 + cast(l_quantity as bigint) kafka_offset,
          cast(cast(((cast(round(p_retailprice * 100) as bigint) * 10 + l_partkey % 10)
            * cast(l_quantity as integer) + 5) // 10 as decimal(18,0)) * 0.01 as decimal(18,2)) subtotal
        from lineitem join part on l_partkey = p_partkey))"""

_CHECKED = f"""
    select event_id, kafka_offset,
      coalesce(stored_sub = subtotal, false) subtotal_ok,
      coalesce(stored_disc = round(stored_sub * cast(l_discount as decimal(9,4)), 2), false) discount_ok,
      coalesce(stored_total = stored_sub - stored_disc, false) total_ok
    from (select *,
        case when kafka_offset % 13 = 0 then subtotal + 0.01 else subtotal end stored_sub,
        case when kafka_offset % 17 = 0 then null else discount_amount end stored_disc,
        case when kafka_offset % 19 = 0 then 1.00 else total_amount end stored_total
      from ({_PRICED}))"""

_SOLD = """product_id, product_name, category, revenue, units_sold, avg_order_value, order_count,
  'products' kpi_type"""


def _best_products(condition: str, limit: int) -> str:
    """The leaders among all products that meet the condition."""
    order = "revenue desc, product_id, product_name, category"
    # Ids escape % and _; the given names hold neither.
    return (
        f"select {_SOLD}, concat('products_', product_id, '_', product_name, '_', category) id, "
        f'"rank" from (select *, row_number() over (order by {order}) "rank" '
        f'from products where {condition}) where "rank" <= {limit}'
    )


_HOURLY = """hour_bucket, region, revenue, order_count, avg_order_value, total_discounts,
  unique_customers, kpi_type"""
_LEADER = """product_id, product_name, category, revenue, units_sold, avg_order_value, order_count,
  "rank", kpi_type"""
_SHELF = """product_id, product_name, warehouse_id, current_stock, reorder_threshold,
  low_stock_alert, kpi_type"""
_FUNNEL = """total_clicks, added_to_cart, completed_orders, conversion_rate_pct, cart_abandonment_pct,
  add_to_cart_rate_pct, kpi_type"""


def _rules_broken() -> str:
    rules = [
        ("event_id is null", "missing_event_id"),
        ("order_id is null", "missing_order_id"),
        ("customer_id is null", "missing_customer_id"),
        ("status is null", "missing_status"),
        ("total_amount is null or total_amount <= 0", "invalid_total_amount"),
    ]
    parts = ", ".join(f"case when {test} then '{name}' end" for test, name in rules)
    return (
        "select event_id, kafka_offset, kafka_partition, "
        f"concat_ws(',', {parts}) failed_rules from judged_orders where not ok"
    )


def _values_checked(name: str, **columns: tuple[str, tuple[str, ...]]) -> str:
    parts = ", ".join(
        f"case when {value} not in {str(allowed).replace(',)', ')')} then '{column}' end"
        for column, (value, allowed) in columns.items()
    )
    return (
        "select * from (select event_id, kafka_offset, kafka_partition, "
        f"concat_ws(',', {parts}) wrong_values from raw_{name}) where wrong_values <> ''"
    )


def statements(buckets: tuple, as_of: str) -> dict[str, str]:
    """SQL by query name, without the common table expressions."""
    totals = "total_revenue, total_orders, avg_order_value, total_clicks, kpi_type"
    day = f"concat('summary_', replace('{as_of}', '-', '')) id, '{as_of}' computed_date"
    return {
        **_layer("orders", _ORDER),
        **_layer("clicks", _CLICK),
        **_layer("inventory", _STOCK),
        "quarantine_orders_rules": _rules_broken(),
        "layer_counts": " union all ".join(
            f"select '{n}' event_type, count(*) bronze_rows, count(*) filter (where ok) valid_rows, "
            f"count(*) filter (where not ok) quarantine_rows, "
            f"(select count(*) from clean_{n}) silver_rows from judged_{n}"
            for n in ("orders", "clicks", "inventory")
        ),
        "order_records": "select trim(customer_id) record_key, count(*) records, "
        "cast(sum(quantity) as bigint) units from raw_orders group by 1",
        "hourly_revenue": f"select {_HOURLY} from hourly",
        "top_products": f"select {_LEADER} from leaders",
        "conversion_funnel": f"select {_FUNNEL} from funnel",
        "summary": f"select {totals}, {day} from totals",
        "inventory_status": f"select {_SHELF} from shelves",
        "inventory_latest": f"select {_SHELF} from last_shelves",
        "kpi_summary": f"select {totals}, {day} from totals",
        "kpi_conversion": f"select {_FUNNEL}, 'conversion' id from funnel",
        "revenue_latest_hours": f"select {_HOURLY}, id from hourly_docs "
        "order by hour_bucket desc, region limit 48",
        "revenue_by_region": f"select {_HOURLY}, id from hourly_docs where region = 'EUROPE' "
        "order by hour_bucket desc, region limit 24",
        "product_revenue": f"select {_SOLD} from products",
        "products_by_revenue": _best_products("true", 5),
        "products_by_category": _best_products("category = 'PROMO'", 10),
        "products_top_50": _best_products("true", 50),
        "inventory_alerts": f"select {_SHELF}, id from shelf_docs where low_stock_alert "
        "order by coalesce(current_stock, 999), product_id, warehouse_id, product_name limit 50",
        "inventory_lowest": f"select {_SHELF}, id from shelf_docs "
        "order by coalesce(current_stock, 999), product_id, warehouse_id, product_name limit 200",
        "regions": "select distinct region from hourly where region is not null and region <> ''",
        "kpi_query": f"select {_SHELF}, id from shelf_docs where warehouse_id = 'WH-3' "
        "order by id limit 100",
        "kpi_item": f"select {_FUNNEL}, 'conversion' id from funnel",
        "revenue_envelope": "select 'ok' status, count(*) count, 'ASIA' region_filter, "
        "string_agg(id, ',' order by hour_bucket desc) ids, cast(sum(order_count) as bigint) orders from "
        "(select * from hourly_docs where region = 'ASIA' order by hour_bucket desc limit 24)",
        "kpi_upsert": f"select {_SHELF}, id from shelf_docs where id not in "
        "(select id from last_shelf_docs where low_stock_alert) "
        f"union all select {_SHELF}, id from last_shelf_docs where low_stock_alert",
        "kpi_documents": "select 'hourly_revenue' kpi_type, id, "
        "strftime(hour_bucket, '%Y-%m-%dT%H:%M:%S') hour_bucket, region, revenue, order_count, "
        "avg_order_value, total_discounts, unique_customers from hourly_docs",
        "order_amounts": "select event_id, kafka_offset, cast(subtotal as double) subtotal, "
        "cast(discount_amount as double) discount_amount, cast(total_amount as double) total_amount "
        f"from ({_PRICED})",
        "order_amount_check": f"select * from ({_CHECKED}) "
        "where not (subtotal_ok and discount_ok and total_ok)",
        "low_stock_check": "select event_id, kafka_offset, stock_level, low_stock_alert "
        "from raw_inventory where low_stock_alert is distinct from "
        "(stock_level < coalesce(reorder_threshold, 50))",
        "order_value_check": _values_checked(
            "orders",
            region=("trim(region)", REGIONS),
            currency=("upper(trim(currency))", CURRENCIES),
            payment_method=("lower(trim(payment_method))", PAYMENT_METHODS),
            status=("lower(trim(status))", STATUSES),
        ),
        "click_value_check": _values_checked(
            "clicks", region=("trim(region)", REGIONS), page=("lower(trim(page))", PAGES)
        ),
        "stock_value_check": _values_checked(
            "inventory", action=("lower(trim(action))", ACTIONS)
        ),
        "request_counts_5m": f"select {_windowed(5)}, count(*) requests from log group by 1, 2",
        "request_counts_sliding": "select window_start, window_start + interval '5 minutes' "
        "window_end, count(*) requests from (select time_bucket(interval '1 minute', ts) "
        "- to_minutes(cast(k as integer)) window_start from log, range(5) r(k)) group by 1, 2",
        "error_rate_5m": _ERROR_RATE,
        "error_rate_sliding": _ERROR_RATE_SLIDING,
        "latency_quantiles_sliding": _quantiles(buckets, _SLID),
        "store_errors_band": "select *, case when requests >= 1 then 'red' else 'green' end band "
        f"from (select {_windowed(5)}, count(*) requests from log where status = 500 group by 1, 2)",
        "error_band": "select *, case when error_pct >= 5 then 'red' when error_pct >= 1 then "
        f"'yellow' else 'green' end band from ({_ERROR_RATE})",
        "store_errors_5m": f"select {_windowed(5)}, count(*) requests from log "
        "where status = 500 group by 1, 2",
        "request_rate_1m": f"select {_windowed(1)}, endpoint, count(*) / 60.0 per_second "
        "from log group by 1, 2, 3",
        "schema_drift": f"""
            with o as ({_OFFSETS})
            select 'coupon' path, 'STRING' "type", 'undeclared' finding, count(*) "rows" from o where k % 5 = 2
            union all select 'gift', 'BOOLEAN', 'undeclared', count(*) from o where k % 3 = 0
            union all select 'product.brand', 'STRING', 'undeclared', count(*) from o where k % 4 = 1
            union all select 'quantity', 'STRING', 'unreadable', count(*) from o where k % 10 = 3""",
        "drifted_coupons": f"""
            select concat('C', k % 7) coupon, case when k % 4 = 1 then 'own' end product_brand,
              count(*) orders from ({_OFFSETS}) where k % 5 = 2 group by 1, 2""",
        "exact_latency": _EXACT_LATENCY,
        "sketched_latency": "select window_start, window_end, count(duration_sec) requests, "
        f"true within_bound from {_spans(24, 6).format('log')} group by 1, 2",
        "customers_by_day": "select cast(event_ts as date) \"day\", region, "
        "count(distinct customer_id) customers, true within_bound from clean_orders "
        "where status = 'completed' group by 1, 2",
        "counter_increase": _increase(6),
        "counter_increase_sliding": _increase(12, 3),
        "latency_histogram": _histogram(buckets),
        "latency_quantiles": _quantiles(buckets),
        "status_breakdown": f"select {_windowed(30)}, status, count(*) requests from log "
        "group by 1, 2, 3",
    }


def _needed(body: str) -> list[str]:
    """The expressions a statement uses, directly or through others, in order."""
    names: set[str] = set()
    texts = [body]
    while texts:
        text = texts.pop()
        for name, cte in _CTES.items():
            if name not in names and f" {name}" in f" {text}":
                names.add(name)
                texts.append(cte)
    return [name for name in _CTES if name in names]


def oracle_sql(buckets: tuple, as_of: str) -> dict[str, str]:
    result = {}
    for name, body in statements(buckets, as_of).items():
        ctes = ",\n".join(f"{n} as ({_CTES[n]})" for n in _needed(body))
        result[name] = f"with {ctes}\n{body}" if ctes else body
    return result
