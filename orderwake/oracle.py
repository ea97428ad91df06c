"""Independent SQL for the registered queries, written against the raw star-schema tables.

Every statement starts with the same common table expressions, which restate the clean-table views
and the stages from scratch.
"""

from __future__ import annotations

TABLES = """
lines AS (
  SELECT l.*, n.n_regionkey, o.o_orderdate, o.o_orderpriority, o.o_orderstatus
  FROM lineitem l
  LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
  LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
),
line AS (
  SELECT * FROM lines
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey::VARCHAR NULLS LAST,
    l_returnflag NULLS LAST, l_quantity NULLS LAST, l_extendedprice NULLS LAST, n_regionkey::VARCHAR NULLS LAST) = 1
),
header AS (
  SELECT o_orderkey AS doc, o_custkey AS cust, o_orderdate AS order_date,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate + INTERVAL 30 DAY END AS requested_delivery_date,
    o_totalprice AS header_value, substring(o_orderpriority, 1, 1) AS channel
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey::VARCHAR NULLS LAST,
    o_orderdate NULLS LAST, requested_delivery_date NULLS LAST, o_totalprice NULLS LAST, channel NULLS LAST) = 1
),
delivery AS (
  SELECT '100' AS client_id, l_orderkey AS number,
    CASE WHEN l_orderkey % 97 <> 0 THEN l_orderkey + 4500000000 END AS reference, l_linenumber AS item,
    l_partkey::VARCHAR AS material_number, n_regionkey::VARCHAR AS plant_code, l_quantity AS delivery_quantity,
    CASE WHEN l_partkey % 53 = 0 THEN 0 WHEN l_returnflag = 'R' THEN l_quantity / 2 ELSE l_quantity END AS quantity_delivered,
    min(l_shipdate) OVER (PARTITION BY l_orderkey) AS goods_issue_date
  FROM lines WHERE l_linestatus = 'F'
),
delivered AS (
  SELECT client_id, (reference % 100000000)::VARCHAR AS _doc, item::VARCHAR AS _item,
    coalesce(sum(delivery_quantity), 0) AS total_delivery_quantity,
    coalesce(sum(quantity_delivered), 0) AS total_quantity_delivered
  FROM delivery WHERE reference IS NOT NULL GROUP BY ALL
),
billed AS (
  SELECT '100' AS client_id, (l_orderkey % 100000000)::VARCHAR AS _doc, l_linenumber::VARCHAR AS _item,
    coalesce(sum(l_quantity), 0) AS total_billed_quantity,
    round(coalesce(sum(l_extendedprice * (1 - l_discount)), 0), 6) AS total_billed_value
  FROM lines WHERE l_returnflag <> 'N' AND l_orderkey IS NOT NULL GROUP BY ALL
),
scheduled AS (
  SELECT '100' AS client_id, l_orderkey::VARCHAR AS sales_document_number, l_linenumber::VARCHAR AS item_number,
    first(l_shipdate ORDER BY l_suppkey % 12, l_shipdate)
      FILTER (WHERE l_suppkey % 12 <> 0 AND l_shipdate IS NOT NULL) AS requested_delivery_date_schedule,
    coalesce(sum(l_quantity), 0) AS total_requested_quantity,
    coalesce(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 0) AS total_confirmed_quantity
  FROM lines WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL
),
material_images AS (
  SELECT p_partkey, p_type, p_brand FROM part UNION ALL SELECT p_partkey, p_type, 'A-' || p_brand FROM part WHERE p_partkey % 10 = 0
),
material AS (
  SELECT p_partkey::VARCHAR AS material_number, p_type AS material_type, p_brand AS material_group
  FROM material_images
  QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY p_type NULLS LAST, p_brand NULLS LAST) = 1
),
texts AS (
  SELECT p_partkey, 'A' AS language, CASE WHEN p_partkey % 5 = 0 THEN 'alt ' || p_name END AS text FROM part
  UNION ALL SELECT p_partkey, 'E', p_name FROM part
),
described AS (
  SELECT p_partkey::VARCHAR AS material_number,
    first(text ORDER BY language, text) FILTER (WHERE text IS NOT NULL) AS material_description_text
  FROM texts WHERE p_partkey IS NOT NULL GROUP BY p_partkey
),
customer_images AS (
  SELECT c_custkey, c_name, c_nationkey FROM customer
  UNION ALL SELECT c_custkey, 'Alias of ' || c_name, c_nationkey FROM customer WHERE c_custkey % 10 = 0
),
customers AS (
  SELECT c_custkey, c_name, n_name FROM customer_images LEFT JOIN nation ON n_nationkey = c_nationkey
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY n_name NULLS LAST, c_name NULLS LAST) = 1
),
master_order AS (
  SELECT '100' AS client_id, l.l_orderkey::VARCHAR AS sales_document_number, l.l_linenumber::VARCHAR AS item_number,
    l.l_partkey::VARCHAR AS material_number, t.material_description_text, m.material_type, m.material_group,
    l.l_returnflag AS item_category, h.cust::VARCHAR AS customer_number, c.c_name AS customer_name,
    c.n_name AS country_code, h.order_date, h.requested_delivery_date, s.requested_delivery_date_schedule,
    l.l_quantity AS cumulative_order_quantity, s.total_requested_quantity, s.total_confirmed_quantity,
    d.total_delivery_quantity, d.total_quantity_delivered, b.total_billed_quantity, b.total_billed_value,
    l.l_extendedprice AS net_value, h.header_value AS order_header_net_value,
    CASE WHEN h.doc IS NOT NULL THEN 'USD' END AS currency_code,
    CASE WHEN m.material_number IS NOT NULL THEN 'EA' END AS base_unit_of_measure,
    NULL::VARCHAR AS sales_organization, h.channel AS distribution_channel, NULL::VARCHAR AS division,
    l.n_regionkey::VARCHAR AS plant_code,
    CASE l.o_orderstatus WHEN 'F' THEN 'C' WHEN 'P' THEN 'B' WHEN 'O' THEN 'A' END AS delivery_status,
    NULL::VARCHAR AS billing_status, NULL::VARCHAR AS goods_movement_status
  FROM line l
  LEFT JOIN header h ON h.doc = l.l_orderkey
  LEFT JOIN customers c ON c.c_custkey = h.cust
  LEFT JOIN delivered d ON d._doc = (l.l_orderkey % 100000000)::VARCHAR AND d._item = l.l_linenumber::VARCHAR
  LEFT JOIN billed b ON b._doc = (l.l_orderkey % 100000000)::VARCHAR AND b._item = l.l_linenumber::VARCHAR
  LEFT JOIN scheduled s ON s.sales_document_number = l.l_orderkey::VARCHAR AND s.item_number = l.l_linenumber::VARCHAR
  LEFT JOIN material m ON m.material_number = l.l_partkey::VARCHAR
  LEFT JOIN described t ON t.material_number = l.l_partkey::VARCHAR
),
stock AS (
  SELECT '100' AS client_id, p.p_partkey::VARCHAR AS material_number, r.r_regionkey::VARCHAR AS plant_code,
    r.r_regionkey, loc.location::VARCHAR AS storage_location,
    CASE WHEN p.p_size % 3 <> 0
      THEN ((p.p_partkey * 37 + r.r_regionkey * 101 + loc.location * 53) % 40)::DOUBLE END AS unrestricted_stock
  FROM part p, region r, (VALUES (1), (2)) loc(location)
),
master_inventory AS (
  SELECT s.client_id, s.material_number, t.material_description_text, m.material_type, m.material_group,
    s.plant_code, r.r_name AS plant_name, s.storage_location, s.unrestricted_stock,
    CASE WHEN m.material_number IS NOT NULL THEN 'EA' END AS base_unit_of_measure
  FROM stock s
  LEFT JOIN material m ON m.material_number IS NOT DISTINCT FROM s.material_number
  LEFT JOIN described t ON t.material_number IS NOT DISTINCT FROM s.material_number
  LEFT JOIN region r ON r.r_regionkey IS NOT DISTINCT FROM s.r_regionkey
),
po_header AS (
  SELECT l_orderkey, min(l_suppkey) AS vendor, min(o_orderdate) AS po_date FROM lines
  WHERE l_orderkey % 50 <> 0 GROUP BY ALL
),
master_po AS (
  SELECT '100' AS client_id, l.l_orderkey::VARCHAR AS purchase_order_number,
    l.l_linenumber::VARCHAR AS purchase_order_item_number, l.l_partkey::VARCHAR AS material_number,
    m.material_type, m.material_group, h.vendor::VARCHAR AS vendor_number, v.s_name AS vendor_name,
    n.n_name AS country_code, l.l_quantity AS quantity,
    CASE WHEN m.material_number IS NOT NULL THEN 'EA' END AS base_unit_of_measure,
    CASE WHEN l.l_quantity <> 0 THEN l.l_extendedprice / l.l_quantity END AS net_price,
    l.l_extendedprice AS net_value, h.po_date AS purchasing_document_date,
    l.n_regionkey::VARCHAR AS plant_code
  FROM lines l
  LEFT JOIN po_header h ON h.l_orderkey IS NOT DISTINCT FROM l.l_orderkey
  LEFT JOIN supplier v ON v.s_suppkey IS NOT DISTINCT FROM h.vendor
  LEFT JOIN nation n ON n.n_nationkey = v.s_nationkey
  LEFT JOIN material m ON m.material_number IS NOT DISTINCT FROM l.l_partkey::VARCHAR
),
on_hand AS (
  SELECT material_number, coalesce(sum(unrestricted_stock), 0) AS saleable FROM master_inventory GROUP BY ALL
),
opened AS (
  SELECT o.*, coalesce(requested_delivery_date_schedule, requested_delivery_date, order_date) AS effective_shipment_date,
    greatest(coalesce(cumulative_order_quantity, 0) - coalesce(total_quantity_delivered, 0), 0) AS outstanding_qty,
    coalesce(i.saleable, 0) AS saleable_inventory
  FROM master_order o LEFT JOIN on_hand i ON i.material_number IS NOT DISTINCT FROM o.material_number
),
aged AS (
  SELECT *, outstanding_qty > 0 AS is_open,
    CASE WHEN outstanding_qty > 0 THEN greatest(outstanding_qty - saleable_inventory, 0) ELSE 0 END AS backorder_units,
    CASE WHEN outstanding_qty > 0
      THEN floor(epoch(TIMESTAMP '2001-08-01' - effective_shipment_date) / 86400) END AS backorder_aging_days
  FROM opened
),
order_metrics AS (
  SELECT *, backorder_units * CASE WHEN coalesce(cumulative_order_quantity, 0) > 0
      THEN coalesce(net_value, 0) / cumulative_order_quantity ELSE 0 END AS backorder_amount,
    CASE WHEN backorder_aging_days IS NULL OR backorder_aging_days < 0 THEN ''
      WHEN backorder_aging_days <= 7 THEN '0-7' WHEN backorder_aging_days <= 14 THEN '8-14'
      WHEN backorder_aging_days <= 30 THEN '15-30' ELSE '31+' END AS backorder_aging_bucket
  FROM aged
),
shipments AS (
  SELECT client_id, material_number, coalesce(plant_code, '') AS plant_code,
    strftime(date_trunc('week', goods_issue_date), '%Y-%m-%d') AS shipment_week,
    sum(quantity_delivered) AS quantity_shipped
  FROM delivery WHERE quantity_delivered > 0 AND goods_issue_date IS NOT NULL GROUP BY ALL
),
stock_series AS (
  SELECT client_id, material_number, plant_code, coalesce(sum(unrestricted_stock), 0) AS saleable_inventory
  FROM master_inventory GROUP BY ALL
),
open_series AS (
  SELECT client_id, material_number, coalesce(plant_code, '') AS plant_code, sum(outstanding_qty) AS open_order_qty
  FROM order_metrics WHERE is_open GROUP BY ALL
),
demand_series AS (
  SELECT client_id, material_number, plant_code, sum(quantity_shipped) / 24 AS awd
  FROM shipments
  WHERE shipment_week::DATE >= (SELECT max(shipment_week::DATE) FROM shipments) - INTERVAL 168 DAY
  GROUP BY ALL
),
net AS (
  SELECT s.*, coalesce(o.open_order_qty, 0) AS open_order_qty,
    greatest(s.saleable_inventory - coalesce(o.open_order_qty, 0), 0) AS net_available, d.awd
  FROM stock_series s
  LEFT JOIN open_series o USING (client_id, material_number, plant_code)
  LEFT JOIN demand_series d ON d.client_id = s.client_id AND d.plant_code = s.plant_code
    AND d.material_number IS NOT DISTINCT FROM s.material_number
),
coverage AS (
  SELECT *, CASE WHEN awd > 0 THEN net_available / awd END AS woc,
    coalesce(CASE WHEN awd > 0 THEN net_available / awd END <= 2, false) AS woc_low_flag
  FROM net
),
targets AS (
  SELECT *, CASE WHEN backorder_units > 0 THEN 1 ELSE 0 END AS target_backorder_risk FROM order_metrics
),
demand AS (
  SELECT client_id, material_number, plant_code, shipment_week::DATE AS week, quantity_shipped
  FROM shipments WHERE plant_code <> '' AND material_number IS NOT NULL
),
forecasts AS (
  SELECT client_id, material_number, plant_code, avg(quantity_shipped) AS demand_forecast, max(week) AS as_of
  FROM (SELECT * FROM demand
        QUALIFY row_number() OVER (PARTITION BY client_id, material_number, plant_code ORDER BY week DESC) <= 12)
  GROUP BY ALL
),
excess AS (
  SELECT client_id, material_number, plant_code, saleable_inventory, awd, woc,
    greatest(saleable_inventory - awd * 8, 0) AS excess_units
  FROM coverage WHERE awd > 0
),
categories AS (
  SELECT *, substring(coalesce(material_type, ''), 1, 20) AS type_text,
    substring(coalesce(item_category, ''), 1, 20) AS category_text
  FROM targets
),
type_codes AS (
  SELECT type_text, row_number() OVER (ORDER BY type_text) - 1 AS code FROM (SELECT DISTINCT type_text FROM categories)
),
category_codes AS (
  SELECT category_text, row_number() OVER (ORDER BY category_text) - 1 AS code
  FROM (SELECT DISTINCT category_text FROM categories)
),
encoded AS (
  SELECT client_id, sales_document_number, item_number, outstanding_qty::DOUBLE AS outstanding_qty,
    saleable_inventory::DOUBLE AS saleable_inventory,
    coalesce(cumulative_order_quantity, 0) AS cumulative_order_quantity,
    coalesce(total_quantity_delivered, 0) AS total_quantity_delivered, coalesce(net_value, 0) AS net_value,
    coalesce(backorder_aging_days, 0) AS backorder_aging_days,
    t.code AS material_type_enc, c.code AS item_category_enc, target_backorder_risk
  FROM categories JOIN type_codes t USING (type_text) JOIN category_codes c USING (category_text)
),
class_sizes AS (
  SELECT target_backorder_risk AS label, count(*) AS n, sum(count(*)) OVER () AS n_all FROM targets GROUP BY ALL
),
class_shares AS (
  SELECT label, ceil(round(n_all * 0.2, 6)) AS wanted, ceil(round(n_all * 0.2, 6)) * n / n_all AS exact FROM class_sizes
),
class_quotas AS (
  SELECT label, floor(exact) + CASE WHEN
      row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, label) <= wanted - sum(floor(exact)) OVER ()
      THEN 1 ELSE 0 END AS quota
  FROM class_shares
),
split AS (
  SELECT e.*, row_number() OVER (
      PARTITION BY target_backorder_risk
      ORDER BY md5(concat_ws('|', '42', client_id, sales_document_number, item_number))) <= q.quota AS is_test
  FROM encoded e JOIN class_quotas q ON q.label = e.target_backorder_risk
),
scored AS (
  SELECT target_backorder_risk AS label, CASE WHEN outstanding_qty >= 20 THEN 1 ELSE 0 END AS prediction,
    outstanding_qty AS score, net_value
  FROM targets
),
hits AS (
  SELECT count_if(label = 1 AND prediction = 1)::DOUBLE AS tp, count_if(label = 0 AND prediction = 1)::DOUBLE AS fp,
    count_if(label = 1 AND prediction = 0)::DOUBLE AS fn, count_if(label = 0 AND prediction = 0)::DOUBLE AS tn
  FROM scored
),
per_score AS (
  SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM scored GROUP BY ALL
),
per_value AS (
  SELECT net_value AS score, count_if(label = 1) AS pos, count_if(label = 0) AS neg
  FROM scored WHERE net_value IS NOT NULL GROUP BY ALL
),
auc_score AS (
  SELECT sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS auc
  FROM (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM per_score)
),
auc_value AS (
  SELECT sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS auc
  FROM (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM per_value)
),
curve AS (
  SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
    sum(pos) OVER () AS all_pos
  FROM per_score
),
rated AS (
  SELECT score AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, tp / (tp + fp)::DOUBLE AS precision,
    CASE WHEN all_pos > 0 THEN tp / all_pos::DOUBLE ELSE 0 END AS recall
  FROM curve
),
thresholds AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM rated
)
"""

ORDER_COLUMNS = """client_id, sales_document_number, item_number, material_number, material_description_text,
  material_type, material_group, item_category, customer_number, customer_name, country_code,
  strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date,
  strftime(requested_delivery_date, '%Y-%m-%d %H:%M:%S') AS requested_delivery_date,
  strftime(requested_delivery_date_schedule, '%Y-%m-%d %H:%M:%S') AS requested_delivery_date_schedule,
  cumulative_order_quantity, total_requested_quantity, total_confirmed_quantity, total_delivery_quantity,
  total_quantity_delivered, total_billed_quantity, total_billed_value, net_value, order_header_net_value,
  currency_code, base_unit_of_measure, sales_organization, distribution_channel, division, plant_code,
  delivery_status, billing_status, goods_movement_status"""

METRIC_COLUMNS = f"""{ORDER_COLUMNS},
  saleable_inventory::DOUBLE AS saleable_inventory,
  strftime(effective_shipment_date, '%Y-%m-%d %H:%M:%S') AS effective_shipment_date,
  outstanding_qty::DOUBLE AS outstanding_qty, is_open, backorder_units::DOUBLE AS backorder_units,
  round(backorder_amount, 6) AS backorder_amount, backorder_aging_days, backorder_aging_bucket"""

METRIC_NAMES = [
    *("client_id sales_document_number item_number material_number material_description_text material_type").split(),
    *("material_group item_category customer_number customer_name country_code order_date").split(),
    *("requested_delivery_date requested_delivery_date_schedule cumulative_order_quantity").split(),
    *("total_requested_quantity total_confirmed_quantity total_delivery_quantity total_quantity_delivered").split(),
    *("total_billed_quantity total_billed_value net_value order_header_net_value currency_code").split(),
    *("base_unit_of_measure sales_organization distribution_channel division plant_code delivery_status").split(),
    *("billing_status goods_movement_status saleable_inventory effective_shipment_date outstanding_qty").split(),
    *("is_open backorder_units backorder_amount backorder_aging_days backorder_aging_bucket").split(),
]
INVENTORY_NAMES = (
    "client_id material_number material_description_text material_type material_group plant_code plant_name "
    "storage_location unrestricted_stock base_unit_of_measure"
).split()
PURCHASE_NAMES = (
    "client_id purchase_order_number purchase_order_item_number material_number material_type material_group "
    "vendor_number vendor_name country_code quantity base_unit_of_measure net_price net_value "
    "purchasing_document_date plant_code"
).split()
METRIC_NUMBERS = (
    "cumulative_order_quantity total_requested_quantity total_confirmed_quantity total_delivery_quantity "
    "total_quantity_delivered total_billed_quantity total_billed_value net_value order_header_net_value "
    "saleable_inventory outstanding_qty backorder_units backorder_amount backorder_aging_days"
).split()
FEATURES = (
    "outstanding_qty saleable_inventory cumulative_order_quantity total_quantity_delivered net_value "
    "backorder_aging_days material_type_enc item_category_enc"
).split()
OUTLIER_COLUMNS = ["cumulative_order_quantity", "total_delivery_quantity", "net_value"]
GRAIN = "client_id, sales_document_number, item_number"
SERIES = "client_id, material_number, plant_code"


def _missing(table: str, names: list[str]) -> str:
    parts = (
        f"SELECT '{c}' AS column_name, count_if({c} IS NULL OR {c}::VARCHAR = '') AS n_missing, count(*) AS n FROM {table}"
        for c in names
    )
    union = " UNION ALL ".join(parts)
    return f"""SELECT column_name, n_missing::BIGINT AS n_missing, round(n_missing * 100.0 / n, 1)::DOUBLE AS pct
      FROM ({union}) WHERE n_missing > 0"""


def _described(column: str, table: str, name: str | None = None, skew: bool = False) -> str:
    tail = f", round(skewness({column}), 3) + 0.0 AS skew" if skew else ""
    return f"""SELECT '{name or column}' AS column_name, count({column}) AS n, round(avg({column}), 3) AS mean,
      round(stddev_samp({column}), 3) AS std, round(min({column}), 6)::DOUBLE AS min,
      round(quantile_cont({column}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({column}::DOUBLE, 0.5), 6) AS p50,
      round(quantile_cont({column}::DOUBLE, 0.75), 6) AS p75, round(max({column}), 6)::DOUBLE AS max{tail} FROM {table}"""


def _quantiles() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {p}::DOUBLE AS probability,
          round(quantile_cont({c}::DOUBLE, {p}), 6) AS value FROM order_metrics HAVING count({c}) > 0"""
        for c in OUTLIER_COLUMNS
        for p in (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
    )


def _winsorized() -> str:
    capped = ", ".join(
        f"""CASE WHEN {c} IS NOT NULL THEN
          round(least({c}, (SELECT quantile_cont({c}::DOUBLE, 0.99) FROM order_metrics)), 6) END AS {c}"""
        for c in OUTLIER_COLUMNS
    )
    return f"SELECT {GRAIN}, {capped} FROM order_metrics"


def _correlations() -> str:
    names = [*FEATURES[:6], "target_backorder_risk"]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({a}, {b}), 6) + 0.0 AS correlation FROM targets"
        for i, a in enumerate(names)
        for b in names[i + 1 :]
    )


def _scaled() -> str:
    scaled = ", ".join(
        f"""round(({c} - (SELECT avg({c}) FROM split WHERE NOT is_test)) / (SELECT CASE WHEN stddev_pop({c}) > 0
          THEN stddev_pop({c}) ELSE 1 END FROM split WHERE NOT is_test), 5) + 0.0 AS {c}"""
        for c in FEATURES
    )
    return f"SELECT {GRAIN}, {scaled} FROM split"


def _trees(n: int) -> str:
    return f"""SELECT tree::INTEGER AS tree, (SELECT count(*) FROM split WHERE NOT is_test) AS n_rows, true AS is_mean
      FROM range({n}) t(tree)"""


RATES = """rates AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r1,
    CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS r0,
    (tp + tn) / (tp + tn + fp + fn) AS acc, tn + fp AS s0, tp + fn AS s1
  FROM hits
),
f AS (
  SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1,
    CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0 FROM rates
)"""

PLANT_LOG = """plant_log AS (
  SELECT n_regionkey::VARCHAR AS plant_code, n_name AS plant_name, n_nationkey FROM nation
)"""

STAGE_TABLES = {
    "master_order_fulfillment": "master_order",
    "master_inventory_material": "master_inventory",
    "master_purchase": "master_po",
    "master_order_fulfillment_brd": "order_metrics",
    "shipment_history": "shipments",
    "master_woc": "coverage",
    "master_order_fulfillment_with_targets": "targets",
    "master_inventory_material_with_targets": "master_inventory",
}

AT_LIMIT = """at_limit AS (
        SELECT bound, count_if(label = 1 AND score >= bound)::DOUBLE AS tp, count_if(label = 0 AND score >= bound)::DOUBLE AS fp,
          count_if(label = 1 AND score < bound)::DOUBLE AS fn, count_if(label = 0 AND score < bound)::DOUBLE AS tn
        FROM scored, (VALUES (10), (20), (40)) b(bound) GROUP BY bound
      ), rated_limit AS (
        SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r
        FROM at_limit
      )"""

QUERIES: dict[str, str] = {
    "order_fulfillment": f"SELECT {ORDER_COLUMNS} FROM master_order",
    "inventory_material": f"SELECT {', '.join(INVENTORY_NAMES)} FROM master_inventory",
    "inventory_unresolved_plants": f""", {PLANT_LOG}
      SELECT s.plant_code, p.plant_name, count(*) AS n_rows, sum(s.unrestricted_stock) AS total_stock
      FROM stock s LEFT JOIN plant_log p ON p.plant_code = s.plant_code GROUP BY ALL""",
    "inventory_material_changelog": f""", {PLANT_LOG}
      SELECT s.plant_code, p.plant_name, count(*) AS n_rows, sum(s.unrestricted_stock) AS total_stock
      FROM stock s LEFT JOIN (SELECT * FROM plant_log
        QUALIFY row_number() OVER (PARTITION BY plant_code ORDER BY n_nationkey DESC) = 1) p
      ON p.plant_code = s.plant_code GROUP BY ALL""",
    "purchase": """SELECT * REPLACE (round(net_price, 9) AS net_price,
      strftime(purchasing_document_date, '%Y-%m-%d %H:%M:%S') AS purchasing_document_date) FROM master_po""",
    "delivery_agg": "SELECT * FROM delivered",
    "billing_agg": "SELECT * FROM billed",
    "schedule_agg": """SELECT * REPLACE (
      strftime(requested_delivery_date_schedule, '%Y-%m-%d %H:%M:%S') AS requested_delivery_date_schedule) FROM scheduled""",
    "material_text_first": "SELECT '100' AS client_id, * FROM described",
    "rename_roundtrip": """SELECT l_orderkey AS sales_document_number, l_linenumber AS item_number,
      l_partkey AS material_number, l_quantity AS cumulative_order_quantity, l_returnflag AS currency_code,
      l_linestatus AS currency_code_2, l_discount AS net_weight_kg FROM lineitem""",
    "latest_image_of_lines": """SELECT l_orderkey, l_linenumber,
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS record_timestamp, is_deleted, l_partkey, l_suppkey, l_quantity
      FROM (SELECT *, l_returnflag = 'R' AS is_deleted FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
          is_deleted NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST) = 1)
      WHERE is_deleted IS DISTINCT FROM true""",
    "folded_by_range_table": """SELECT l_orderkey::VARCHAR AS canonical, count(*) AS n_lines FROM lineitem GROUP BY ALL""",
    "repaired_keys": """SELECT l_orderkey::VARCHAR AS sales_document_number, count(*) AS n_lines FROM lineitem GROUP BY ALL""",
    "csv_roundtrip": f"""SELECT * REPLACE (nullif(backorder_aging_bucket, '') AS backorder_aging_bucket),
      'called "' || material_description_text || '", and more' AS told FROM (SELECT {METRIC_COLUMNS} FROM order_metrics)""",
    "pipeline_stage_rows": " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, (SELECT count(*) FROM {table}) AS n_rows, true AS is_reused" for stage, table in STAGE_TABLES.items()
    ),
    "key_collisions": """SELECT (number % 100000000)::VARCHAR AS canonical, count(*) AS n_documents
      FROM (SELECT o_orderkey AS number FROM orders WHERE o_orderkey IS NOT NULL
            UNION SELECT reference FROM delivery WHERE reference IS NOT NULL)
      GROUP BY 1 HAVING count(*) > 1""",
    "coerced_values": """SELECT l_orderkey, l_linenumber, 'K' || l_partkey AS material, 'a category of part n' AS category,
        CASE l_orderkey % 8 WHEN 0 THEN l_linenumber WHEN 1 THEN 1000 WHEN 5 THEN -2.5 END::DOUBLE AS quantity,
        CASE l_orderkey % 8 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d 00:00:00') WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d 10:30:00')
          WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d 00:00:00') END AS moment,
        CASE l_orderkey % 8 WHEN 0 THEN 1.5 ELSE 0 END::DOUBLE AS ratio
      FROM lineitem""",
    "event_weeks": """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week,
        weekofyear(ts)::INTEGER AS week_of_year,
        floor(epoch(TIMESTAMP '2024-01-15 12:00:00' - ts::TIMESTAMP) / 86400) AS days, count(*) AS n_events
      FROM events GROUP BY ALL""",
    "order_backorder_metrics": f"SELECT {METRIC_COLUMNS} FROM order_metrics",
    "backorder_aging": """SELECT backorder_aging_days, backorder_aging_bucket, count(*) AS n_lines
      FROM order_metrics WHERE is_open GROUP BY ALL""",
    "backorder_by_bucket": """SELECT is_open, backorder_aging_bucket, count(*) AS n_lines,
        sum(backorder_units)::DOUBLE AS backorder_units,
        sum(backorder_amount::DECIMAL(28, 6))::DOUBLE AS backorder_amount FROM order_metrics GROUP BY ALL""",
    "backorder_overview": """SELECT count(*) AS n_lines, round(avg(is_open::INT) * 100, 6) AS pct_open,
        count_if(backorder_units > 0)::BIGINT AS n_backordered,
        round(avg((backorder_units > 0)::INT) * 100, 6) AS pct_backordered FROM order_metrics""",
    "shipment_history": "SELECT * FROM shipments",
    "weeks_of_coverage": f"""SELECT {SERIES}, saleable_inventory, open_order_qty::DOUBLE AS open_order_qty,
        net_available::DOUBLE AS net_available, round(awd, 6) AS awd, round(woc, 6) AS woc, woc_low_flag FROM coverage""",
    "coverage_low": f"""SELECT {SERIES}, net_available::DOUBLE AS net_available, round(awd, 6) AS awd,
        round(woc, 6) AS woc FROM coverage WHERE woc_low_flag""",
    "backorder_targets": f"SELECT {GRAIN}, backorder_units::DOUBLE AS backorder_units, target_backorder_risk FROM targets",
    "overstock_targets": """SELECT i.*, round(c.woc, 6) AS woc, round(c.awd, 6) AS awd,
        CASE WHEN c.awd > 0 AND c.woc > 26 THEN 1 ELSE 0 END AS target_overstock_risk
      FROM master_inventory i LEFT JOIN coverage c ON c.client_id = i.client_id AND c.plant_code = i.plant_code
        AND c.material_number IS NOT DISTINCT FROM i.material_number""",
    "class_balance": """SELECT target_backorder_risk AS label, count(*) AS n_rows,
        round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS pct FROM targets GROUP BY ALL""",
    "demand_rolling_mean": f"""SELECT {SERIES}, strftime(week, '%Y-%m-%d') AS shipment_week, quantity_shipped,
        weekofyear(week)::INTEGER AS week_of_year,
        round(avg(quantity_shipped) OVER (PARTITION BY {SERIES} ORDER BY week
          ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS roll_mean FROM demand""",
    "demand_rolling_mean_calendar": f""", spans AS (
        SELECT {SERIES}, min(week) AS first_week, max(week) AS last_week FROM demand GROUP BY ALL
      ), weeks AS (
        SELECT {SERIES}, unnest(generate_series(first_week::TIMESTAMP, last_week::TIMESTAMP, INTERVAL 7 DAY))::DATE AS week FROM spans
      ), dense AS (
        SELECT w.*, coalesce(d.quantity_shipped, 0) AS quantity_shipped FROM weeks w
        LEFT JOIN demand d USING ({SERIES}, week)
      )
      SELECT {SERIES}, strftime(week, '%Y-%m-%d') AS shipment_week, quantity_shipped::DOUBLE AS quantity_shipped,
        weekofyear(week)::INTEGER AS week_of_year,
        round(avg(quantity_shipped) OVER (PARTITION BY {SERIES} ORDER BY week
          RANGE BETWEEN INTERVAL 77 DAY PRECEDING AND CURRENT ROW), 6) AS roll_mean FROM dense""",
    "demand_forecast": f"""SELECT {SERIES}, round(demand_forecast, 6) AS demand_forecast,
        strftime(as_of, '%Y-%m-%d') AS forecast_as_of FROM forecasts""",
    "excess_inventory": f"""SELECT {SERIES}, saleable_inventory, round(awd, 6) AS awd, round(woc, 6) AS woc,
        round(excess_units, 6) AS excess_units FROM excess""",
    "excess_top10": f"""SELECT {SERIES}, saleable_inventory, round(awd, 6) AS awd, round(woc, 6) AS woc,
        round(excess_units, 6) AS excess_units FROM excess WHERE excess_units > 0
      ORDER BY excess.excess_units DESC, {SERIES} LIMIT 10""",
    "forecast_excess_summary": """SELECT 'materials_with_forecast' AS metric,
        count(DISTINCT material_number)::DOUBLE AS value FROM forecasts
      UNION ALL SELECT 'materials_with_excess', count_if(excess_units > 0)::DOUBLE FROM excess
      UNION ALL SELECT 'total_excess_units', round(coalesce(sum(excess_units), 0), 6)::DOUBLE FROM excess""",
    "missing_summary_orders": _missing("order_metrics", METRIC_NAMES),
    "missing_summary_inventory": _missing("master_inventory", INVENTORY_NAMES),
    "missing_summary_purchase": _missing("master_po", PURCHASE_NAMES),
    "describe_orders": " UNION ALL ".join(_described(c, "order_metrics") for c in METRIC_NUMBERS),
    "quantiles_orders": _quantiles(),
    "winsorized_orders": _winsorized(),
    "order_summary_stats": " UNION ALL ".join(
        (
            _described("coalesce(cumulative_order_quantity, 0)", "master_order", "order_qty", True),
            _described("coalesce(total_quantity_delivered, 0)", "master_order", "delivered_qty", True),
            _described(
                "greatest(coalesce(cumulative_order_quantity, 0) - coalesce(total_quantity_delivered, 0), 0)",
                "master_order",
                "shortfall",
                True,
            ),
            _described("net_value", "master_order", "net_value", True),
        )
    ),
    "validity_checks": """SELECT 'negative_order_quantity' AS check_name,
        count_if(cumulative_order_quantity < 0)::BIGINT AS n_rows FROM order_metrics
      UNION ALL SELECT 'negative_delivery_quantity', count_if(total_delivery_quantity < 0)::BIGINT FROM order_metrics
      UNION ALL SELECT 'future_order_date', count_if(order_date > TIMESTAMP '2000-01-01')::BIGINT FROM order_metrics
      UNION ALL SELECT 'negative_stock', count_if(unrestricted_stock < 0)::BIGINT FROM master_inventory""",
    "duplicate_checks": """SELECT 'order' AS table_name, coalesce(sum(n - 1), 0)::BIGINT AS duplicate_rows
        FROM (SELECT count(*) AS n FROM master_order GROUP BY client_id, sales_document_number, item_number)
      UNION ALL SELECT 'inventory', coalesce(sum(n - 1), 0)::BIGINT
        FROM (SELECT count(*) AS n FROM master_inventory GROUP BY client_id, material_number, plant_code, storage_location)
      UNION ALL SELECT 'purchase', coalesce(sum(n - 1), 0)::BIGINT
        FROM (SELECT count(*) AS n FROM master_po GROUP BY client_id, purchase_order_number, purchase_order_item_number)""",
    "duplicate_keys": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, coalesce(sum(n - 1), 0)::BIGINT AS duplicate_rows "
        f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"
        for name, table, key in (
            ("sales_order_header", "orders", "o_orderkey"),
            ("delivery_header", "(SELECT DISTINCT number FROM delivery)", "number"),
            ("material_master", "material_images", "p_partkey"),
            ("customer_master", "customer_images", "c_custkey"),
            ("vendor_master", "supplier", "s_suppkey"),
            ("purchase_order_header", "po_header", "l_orderkey"),
            ("plant", "region", "r_regionkey"),
        )
    ),
    "material_overlap": """, o AS (SELECT DISTINCT material_number FROM order_metrics WHERE material_number IS NOT NULL),
      i AS (SELECT DISTINCT material_number FROM master_inventory WHERE material_number IS NOT NULL)
      SELECT (SELECT count(*) FROM o) AS order_materials, (SELECT count(*) FROM i) AS inventory_materials,
        (SELECT count(*) FROM (SELECT * FROM o INTERSECT SELECT * FROM i)) AS in_both,
        (SELECT count(*) FROM (SELECT * FROM o EXCEPT SELECT * FROM i)) AS order_only,
        (SELECT count(*) FROM (SELECT * FROM i EXCEPT SELECT * FROM o)) AS inventory_only""",
    "sql_views_sample": f"""SELECT {METRIC_COLUMNS} FROM order_metrics
      ORDER BY sales_document_number::BIGINT, item_number::INT LIMIT 5""",
    "sql_views_by_material": """, ordered AS (
        SELECT material_number, sum(outstanding_qty)::DOUBLE AS open_units FROM order_metrics WHERE is_open GROUP BY ALL),
      stocked AS (SELECT material_number, sum(unrestricted_stock)::DOUBLE AS stock_units FROM master_inventory GROUP BY ALL),
      bought AS (SELECT material_number, sum(quantity)::DOUBLE AS purchased_units FROM master_po GROUP BY ALL),
      shipped AS (SELECT material_number, sum(quantity_shipped)::DOUBLE AS shipped_units FROM shipments GROUP BY ALL),
      covered AS (SELECT material_number, round(min(woc), 6) AS least_woc FROM coverage GROUP BY ALL),
      materials AS (
        SELECT material_number FROM ordered UNION SELECT material_number FROM stocked UNION SELECT material_number FROM bought
        UNION SELECT material_number FROM shipped UNION SELECT material_number FROM covered)
      SELECT m.material_number, open_units, stock_units, purchased_units, shipped_units, least_woc FROM materials m
      LEFT JOIN ordered o ON o.material_number IS NOT DISTINCT FROM m.material_number
      LEFT JOIN stocked s ON s.material_number IS NOT DISTINCT FROM m.material_number
      LEFT JOIN bought b ON b.material_number IS NOT DISTINCT FROM m.material_number
      LEFT JOIN shipped d ON d.material_number IS NOT DISTINCT FROM m.material_number
      LEFT JOIN covered c ON c.material_number IS NOT DISTINCT FROM m.material_number""",
    "feature_correlation": _correlations(),
    "features_encoded": "SELECT * FROM encoded",
    "features_short_categories": f""", short AS (
        SELECT e.* EXCLUDE (material_type_enc, item_category_enc), left(coalesce(o.material_type, ''), 4) AS type_start,
          left(coalesce(o.item_category, ''), 4) AS category_start
        FROM encoded e JOIN order_metrics o USING ({GRAIN}) WHERE o.requested_delivery_date IS NOT NULL)
      SELECT * EXCLUDE (type_start, category_start), dense_rank() OVER (ORDER BY type_start) - 1 AS material_type_enc,
        dense_rank() OVER (ORDER BY category_start) - 1 AS item_category_enc FROM short""",
    "stratified_split": f"SELECT {GRAIN}, target_backorder_risk, is_test FROM split",
    "features_scaled": _scaled(),
    "class_weights": """SELECT target_backorder_risk AS label, count(*) AS n_rows,
        round(sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*)), 6) AS weight
      FROM split WHERE NOT is_test GROUP BY ALL""",
    "confusion_matrix": "SELECT label, prediction, count(*) AS n_rows FROM scored GROUP BY ALL",
    "classification_metrics": f""", {RATES}
      SELECT 'outstanding_quantity' AS model, round(acc, 6) AS accuracy, round(p1, 6) AS precision,
        round(r1, 6) AS recall, round(f1, 6) AS f1, round((SELECT auc FROM auc_score), 6) AS roc_auc FROM f""",
    "classification_report": f""", {RATES}
      SELECT 'No Backorder' AS class_name, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1,
        s0::BIGINT AS support FROM f
      UNION ALL SELECT 'Backorder', round(p1, 6), round(r1, 6), round(f1, 6), s1::BIGINT FROM f
      UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), (s0 + s1)::BIGINT FROM f
      UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6),
        (s0 + s1)::BIGINT FROM f
      UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6),
        round((r0 * s0 + r1 * s1) / (s0 + s1), 6), round((f0 * s0 + f1 * s1) / (s0 + s1), 6), (s0 + s1)::BIGINT FROM f""",
    "auc_exact": """SELECT 'outstanding_qty' AS score_name, round(auc, 6) AS roc_auc FROM auc_score
      UNION ALL SELECT 'net_value', round(auc, 6) FROM auc_value""",
    "threshold_curve": """SELECT threshold::DOUBLE AS threshold, tp, fp, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1, 6) AS f1 FROM thresholds""",
    "best_threshold": """SELECT threshold::DOUBLE AS threshold, tp, fp, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1, 6) AS f1 FROM thresholds ORDER BY thresholds.f1 DESC, thresholds.threshold LIMIT 1""",
    "at_risk_by_quantity": """SELECT o.client_id, o.material_number, o.plant_code,
        CASE WHEN o.risk >= 20 THEN 'Yes' ELSE 'No' END AS predicted_backorder, o.risk AS risk_score,
        round(c.woc, 6) AS woc, c.saleable_inventory
      FROM (SELECT client_id, material_number, coalesce(plant_code, '') AS plant_code,
              max(outstanding_qty)::DOUBLE AS risk FROM order_metrics GROUP BY ALL) o
      LEFT JOIN coverage c ON c.client_id = o.client_id AND c.plant_code = o.plant_code
        AND c.material_number IS NOT DISTINCT FROM o.material_number""",
    "at_risk_coverage": """SELECT o.client_id, o.material_number, o.plant_code, round(c.woc, 6) AS woc, c.saleable_inventory
      FROM (SELECT DISTINCT client_id, material_number, coalesce(plant_code, '') AS plant_code FROM order_metrics) o
      LEFT JOIN coverage c ON c.client_id = o.client_id AND c.plant_code = o.plant_code
        AND c.material_number IS NOT DISTINCT FROM o.material_number""",
    "model_comparison_by_quantity": f""", {AT_LIMIT}
      SELECT 'Quantity From ' || bound AS model, printf('%.3f', (tp + tn) / (tp + tn + fp + fn)) AS accuracy,
        printf('%.3f', p) AS precision, printf('%.3f', r) AS recall,
        printf('%.3f', CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) AS f1,
        printf('%.3f', (SELECT auc FROM auc_score)) AS roc_auc FROM rated_limit""",
    "logistic_optimality": f"""SELECT coefficient, true AS is_flat, n_rows, n_positive
      FROM (SELECT unnest({['intercept', *FEATURES]}) AS coefficient),
        (SELECT count(*) AS n_rows, sum(target_backorder_risk)::BIGINT AS n_positive FROM split WHERE NOT is_test)""",
    "json_roundtrip": f""", {AT_LIMIT}
      SELECT 'quantity_from_' || bound AS model, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(p, 6) AS precision,
        round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1,
        round((SELECT auc FROM auc_score), 6) AS roc_auc FROM rated_limit""",
    "saved_model_scores": f"SELECT {GRAIN}, true AS is_equal FROM split WHERE is_test",
    "importance_by_nodes": f"SELECT unnest({FEATURES}) AS feature, 100 AS n_trees, true AS is_equal",
    "forest_leaves": _trees(10),
    "gbt_leaves": _trees(20),
    "magnitude_gbt_leaves": _trees(20),
    "elasticnet_optimality": f"""SELECT coefficient, true AS is_flat, n_rows, n_positive
      FROM (SELECT unnest({['intercept', *FEATURES[2:]]}) AS coefficient),
        (SELECT count(*) AS n_rows, sum(target_backorder_risk)::BIGINT AS n_positive FROM split WHERE NOT is_test)""",
    "ridge_optimality": f"""SELECT coefficient, true AS is_flat, n_rows, n_positive
      FROM (SELECT unnest({['intercept', *FEATURES[2:]]}) AS coefficient),
        (SELECT count(*) AS n_rows, sum(target_backorder_risk)::BIGINT AS n_positive FROM split WHERE NOT is_test)""",
    "magnitude_by_quantity": """SELECT 'outstanding_quantity' AS model,
        round(sqrt(avg((outstanding_qty - backorder_units) ** 2)), 6) AS rmse,
        round(avg(abs(outstanding_qty - backorder_units)), 6) AS mae,
        round(1 - avg((outstanding_qty - backorder_units) ** 2) / var_pop(backorder_units), 6) AS r2
      FROM order_metrics""",
}

# Merged half by half, a log gives what it gives in one piece.
QUERIES["merged_change_log"] = QUERIES["latest_image_of_lines"]


def statements() -> dict[str, str]:
    """Complete statements by query name. A query that starts with a comma adds its own expressions."""
    return {
        name: f"WITH {TABLES}{'' if sql.lstrip().startswith(',') else ' '}{sql}" for name, sql in QUERIES.items()
    }
