"""Check queries: the expected result of each registered query, for a second SQL engine.

A text names the inputs in braces: a view, or with ``q_`` before it another check.
"""

from __future__ import annotations

from collections import Counter

from sellerbooks.plans import feeds
from sellerbooks.sources.fixtures import TABLES, VIEWS, check_text, names_in

ORDERS_SINCE = "1996-01-01"
SETTLED_SINCE = "1996-01-01"
ASSIGNED_SINCE = "1997-01-01"
LEDGER_START = "1998-01-01"
ETA_DEFAULT = "1998-10-04"
SHEET_SINCE = "1999-01-01"
SHEET_BASE = "https://sheets.example/book"
LOAD_DATE = "2024-02-01"


def half_up(num: str, num_scale: int, den: str, den_scale: int, scale: int) -> str:
    """Exact half-up quotient of two non-negative decimals, in whole-number arithmetic."""
    a = f"CAST(({num}) * {10**num_scale} AS HUGEINT) * {10 ** (scale + den_scale)}"
    b = f"(CAST(({den}) * {10**den_scale} AS HUGEINT) * {10**num_scale})"
    q = f"CAST((2 * {a} + {b}) // (2 * nullif({b}, 0)) AS BIGINT)"
    if scale == 0:
        return q
    return f"CAST({q} * CAST({10**-scale:.{scale}f} AS DECIMAL({scale + 1},{scale})) AS DECIMAL(18,{scale}))"


def on(left: str, right: str, **keys: str) -> str:
    """Equality of keys ignoring case."""
    return " AND ".join(f"lower({left}.{a}) = lower({right}.{b})" for a, b in keys.items())


def eq(left: str, right: str, *keys: str) -> str:
    return on(left, right, **{k: k for k in keys})


def low(prefix: str, *keys: str) -> str:
    return ", ".join(f"lower({prefix}{k})" for k in keys)


def shown(*keys: str) -> str:
    return ", ".join(f"min({k}) AS {k}" for k in keys)


def json(columns, **texts: str) -> str:
    """The payload of a row; ``texts`` overrides how a column is written."""
    cells = ", ".join(
        f"'{i}': {{{{'value': coalesce(CAST({texts.get(c, c)} AS VARCHAR), '')}}}}"
        for c, i in feeds.numbered_fields(columns).items()
    )
    return f"CAST(to_json({{{{{cells}}}}}) AS VARCHAR)"


DAY = "strftime({c}, '%Y-%m-%d')"
SECOND = "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S')"


def second(c: str) -> str:
    return SECOND.format(c=c)


def day(c: str) -> str:
    return DAY.format(c=c)


UNIT_PRICE = f"coalesce({half_up('item_price', 2, 'quantity', 0, 2)}, CAST(item_price AS DECIMAL(18,2)))"
FEE_TYPE = "coalesce(adjustmenttype, chargetype, feetype, promotiontype)"
SIGN = "CASE WHEN {c} < 0 THEN 'debit' ELSE 'credit' END"
TERMS = "transaction_type, amount_type, amount_description"


def expected(refund: str) -> str:
    return f"""CASE WHEN adjustmenttype IS NOT NULL THEN adjustmenttype
  WHEN chargetype IS NOT NULL AND currencyamount >= 0 THEN 'Order' WHEN chargetype IS NOT NULL AND currencyamount < 0 THEN '{refund}'
  WHEN feetype IS NOT NULL THEN feetype WHEN promotiontype IS NOT NULL THEN 'Promotion' END"""


def mapped(refund: str, fallback: str) -> str:
    return f"""SELECT f.*, s.asin, t.total_amount, CAST(t.start_date AS DATE) AS start_date, CAST(t.end_date AS DATE) AS end_date,
  coalesce(d.transaction_type, e.transaction_type) AS transaction_type, coalesce(d.amount_type, e.amount_type) AS amount_type,
  coalesce(d.amount_description, e.amount_description) AS amount_description, coalesce(CAST(f.posteddate AS DATE), CAST(t.end_date AS DATE)) AS posted_date
FROM (SELECT *, {FEE_TYPE} AS fee_type, {expected(refund)} AS expected_type, {SIGN.format(c='currencyamount')} AS credit_debit FROM {{finance_events}}) f
LEFT JOIN {{q_unique_account_sku}} s ON {on('f', 's', account_name='account_name', sellersku='sku')}
LEFT JOIN {{q_settlement_totals}} t ON {eq('f', 't', 'account_name', 'group_id')}
LEFT JOIN {{q_fee_mapping}} d ON {on('f', 'd', fee_type='fee_type', expected_type='transaction_type', credit_debit='credit_debit')}
LEFT JOIN {fallback} e ON {eq('f', 'e', 'fee_type', 'credit_debit')}"""


def record(rows: str, columns: str = "x.*") -> str:
    """Rows with upper-case product keys and the record id of the product as text."""
    return f"""SELECT {columns}, coalesce(CAST(p.record_id AS VARCHAR), '') AS record_id
FROM (SELECT * REPLACE (upper(account_name) AS account_name, upper(sku) AS sku, upper(asin) AS asin) FROM {rows}) x
LEFT JOIN {{remote_products}} p ON x.account_name IS NOT DISTINCT FROM upper(p.account_name)
  AND x.sku IS NOT DISTINCT FROM upper(p.sku) AND x.asin IS NOT DISTINCT FROM upper(p.asin)"""


def batched(rows: str, order: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in order.split(", "))
    return f"SELECT *, (row_number() OVER (ORDER BY {order}) - 1) // 1000 AS batch_id FROM {rows}"


def once(left: str, right: str, keys: str) -> str:
    """Keys that occur once in both sides together."""
    return f"""SELECT {keys} FROM (SELECT {keys} FROM {left} UNION ALL SELECT {keys} FROM {right}) GROUP BY {keys} HAVING count(*) = 1"""


def null_safe(left: str, right: str, keys: str) -> str:
    return " AND ".join(f"{left}.{k} IS NOT DISTINCT FROM {right}.{k}" for k in keys.split(", "))


def diff(source: str, published: str, keys: str, rest: str) -> str:
    """Both sides' rows whose key occurs once; the published side has keys only."""
    shown_keys = ", ".join(f"o.{k}" for k in keys.split(", "))
    return f"""SELECT {shown_keys}, {rest} FROM ({once(source, published, keys)}) o LEFT JOIN {source} s ON {null_safe('o', 's', keys)}"""


def final(published: str) -> str:
    """Published rows whose state cannot change any more."""
    states = ", ".join(f"'{s.lower()}'" for s in feeds.OPEN_SHIPMENTS)
    return f"(SELECT * FROM {published} WHERE lower(shipmentstatus) NOT IN ({states}))"


def links(kind: str, record_id: str, shipment: str, cost: str, gid: str, letter: str, rows: str) -> str:
    return f"""SELECT '{kind}' AS document_type, {record_id} AS record_id, {shipment} AS fba_shipment_id, {cost} AS cost_name,
  concat('{SHEET_BASE}#gid={gid}&range=', {letter}, CAST(r.row_index + 1 AS VARCHAR)) AS url FROM {rows}"""


def money(c: str) -> str:
    return f"coalesce(TRY_CAST(replace(replace({c}, '$', ''), ',', '') AS DECIMAL(12,2)), 0)"


def sheet_day(c: str) -> str:
    return f"CAST(coalesce(try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%Y-%m-%d')) AS DATE)"


def profile(view: str, columns) -> str:
    parts = []
    for name in columns:
        cell = f"CAST({name} AS VARCHAR)"
        text = f"CASE WHEN {name} IS NULL OR trim({cell}) IN ('nan', 'Nan') THEN '0' ELSE trim({cell}) END"
        parts.append(f"""SELECT '{name}' AS column_name, {text} AS t, {cell} AS raw FROM {{{view}}}""")
    number = r"'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$'"
    rows = " UNION ALL ".join(parts)
    return f"""SELECT column_name, is_number, decimal_depth, longest, row_count, all_zero,
  CASE WHEN is_number AND decimal_depth = 0 THEN CASE WHEN whole_length >= 10 THEN 'BIGINT' ELSE 'INTEGER' END
       WHEN is_number THEN CASE WHEN number_length <= 10 THEN concat('NUMERIC(12,', CASE WHEN decimal_depth <= 2 THEN '2' ELSE '4' END, ')')
            WHEN number_length <= 20 THEN concat('NUMERIC(20,', CASE WHEN decimal_depth <= 2 THEN '2' ELSE '4' END, ')') ELSE 'DOUBLE' END
       WHEN longest > 255 THEN 'TEXT' WHEN longest >= 100 THEN 'VARCHAR(255)' WHEN longest >= 50 THEN 'VARCHAR(100)' WHEN longest >= 25 THEN 'VARCHAR(50)'
       WHEN longest >= 15 THEN 'VARCHAR(25)' WHEN longest >= 10 THEN 'VARCHAR(15)' WHEN longest >= 5 THEN 'VARCHAR(10)' ELSE 'VARCHAR(5)' END AS target_type
FROM (SELECT column_name, bool_and(regexp_matches(t, {number})) AS is_number, max(length(decimals)) AS decimal_depth, coalesce(max(length(raw)), 0) AS longest,
        count(*) AS row_count, bool_and(coalesce(TRY_CAST(t AS DOUBLE) = 0, false)) AS all_zero, max(length(whole)) AS whole_length,
        max(length(whole) + 1 + greatest(length(decimals), 1)) AS number_length
      FROM (SELECT *, split_part(t, '.', 1) AS whole, CASE WHEN contains(t, '.') THEN rtrim(split_part(t, '.', 2), '0') ELSE '' END AS decimals FROM ({rows}))
      GROUP BY column_name)"""


PER_UNIT = ", ".join(
    f"{half_up(c, 2, 'qty', 0, 6)} AS {c}"
    for c in ("duties", "customs_fees", "demurrage", "container_cost", "trucking_cost")
)
COSTS = "duties, customs_fees, demurrage, container_cost, trucking_cost"
FEE_SUMS = {"fba_fee": "fbaperunitfulfillmentfee", "commission": "commission", "principal": "principal"}
LEDGER = "account_name, order_id, date, sku, asin, order_status, item_status, quantity"


def received(condition: str) -> str:
    return f"""SELECT p.account_name, p.record_id_num, p.fba_shipment_id, p.eta, p.sku, p.asin, 'Received' AS received, p.po_status, CAST(p.qty AS BIGINT) AS qty,
  CAST(p.unit_price AS DECIMAL(18,6)) AS unit_price, {PER_UNIT.replace('(duties)', '(p.duties)')},
  row_number() OVER (PARTITION BY lower(p.account_name), lower(p.sku) ORDER BY p.eta NULLS FIRST, p.record_id_num) AS id
FROM {{po_records}} p JOIN {{q_active_skus}} a ON {eq('p', 'a', 'account_name', 'sku')}
WHERE lower(p.po_status) = 'completed' AND p.fba_shipment_id <> '' AND {condition}"""


# What each check returns: column name to kind (t text, i whole number, n number, d day, s second, b boolean).
CHECKS: dict[str, tuple[str, str]] = {}


def check(name: str, columns: str, text: str) -> None:
    CHECKS[name] = (columns, text)


# Sources
check(
    "scan_table",
    "account_name:t sku:t asin:t itemname:t list_price:n style:t color:t size:i starting_inventory:i",
    "SELECT * FROM {product_data}",
)
check(
    "scan_filtered",
    "account_name:t amazon_order_id:t sku:t quantity:i item_price:n purchase_date:d",
    f"""SELECT account_name, amazon_order_id, sku, quantity, item_price, purchase_date FROM {{all_orders}}
WHERE purchase_date >= DATE '{ASSIGNED_SINCE}' AND purchase_date < DATE '2000-01-01' AND quantity <> 0""",
)
check(
    "daily_slices",
    "slice_date:d row_count:i quantity:i",
    f"""SELECT d.slice_date, coalesce(s.row_count, 0) AS row_count, coalesce(s.quantity, 0) AS quantity
FROM (SELECT CAST(unnest(generate_series(min(purchase_date), max(purchase_date), INTERVAL 1 DAY)) AS DATE) AS slice_date
      FROM (SELECT CAST(purchase_date AS DATE) AS purchase_date FROM {{all_orders}} WHERE purchase_date >= DATE '{ASSIGNED_SINCE}')) d
LEFT JOIN (SELECT CAST(purchase_date AS DATE) AS slice_date, count(*) AS row_count, sum(quantity) AS quantity FROM {{all_orders}}
           WHERE purchase_date >= DATE '{ASSIGNED_SINCE}' GROUP BY 1) s ON d.slice_date = s.slice_date""",
)
check(
    "unwrap_records",
    "Record_ID_Num:t Product_Brand:t Product_Type:t",
    """SELECT json_extract_string(record, '$."3"."value"') AS Record_ID_Num, json_extract_string(record, '$."6"."value"') AS Product_Brand,
  json_extract_string(record, '$."7"."value"') AS Product_Type FROM {records_raw}""",
)
check(
    "saved_report",
    "Record_ID_Num:i Is_Even:b Product_Brand:t List_Price:n Due_Day:d",
    """SELECT CAST(json_extract_string(record, '$."3"."value"') AS BIGINT) AS Record_ID_Num, CAST(json_extract_string(record, '$."9"."value"') AS BOOLEAN) AS Is_Even,
  json_extract_string(record, '$."6"."value"') AS Product_Brand, CAST(json_extract_string(record, '$."7"."value"') AS DECIMAL(12,2)) AS List_Price,
  CAST(nullif(json_extract_string(record, '$."8"."value"'), '') AS DATE) AS Due_Day FROM {report_rows}""",
)
check(
    "import_records",
    "Record_ID_Num:i Product_Brand:t Product_Type:t",
    """SELECT CAST(json_extract_string(record, '$."3"."value"') AS BIGINT) AS Record_ID_Num, json_extract_string(record, '$."6"."value"') AS Product_Brand,
  json_extract_string(record, '$."7"."value"') AS Product_Type FROM {records_raw}""",
)
check(
    "predicate_builder",
    "account_name:t amazon_order_id:t sku:t order_status:t item_status:t quantity:i",
    """SELECT account_name, amazon_order_id, sku, order_status, item_status, quantity FROM {all_orders}
WHERE (contains(lower(sku), '-1') AND lower(order_status) = 'shipped') OR lower(account_name) = 'west'""",
)
check(
    "normalize_headers",
    "seller_sku:t record_Num:i Item_Price:n",
    "SELECT seller_sku, listing_id AS record_Num, price AS Item_Price FROM {all_listings}",
)
check(
    "stamp_load_date",
    "account_name:t record_date:d msku:t event_type:t quantity:i load_date:d",
    f"SELECT account_name, date AS record_date, msku, event_type, quantity, DATE '{LOAD_DATE}' AS load_date FROM {{ledger_detail}}",
)
check(
    "pad_and_union",
    "po_type:t row_index:i sku:t unit_price:t qty:t completion_date:t eta:t customer_ref:t",
    """SELECT 'Completed' AS po_type, row_index, sku, unit_price, qty, completion_date, completion_date AS eta, NULL AS customer_ref FROM {sheet_po}
UNION ALL SELECT 'Open POs', row_index, sku, unit_price, qty, completion_date, completion_date, customer_ref FROM {sheet_po}""",
)
check("row_count", "row_count:i", "SELECT count(*) AS row_count FROM {sheet_po}")
check(
    "date_bounds",
    "start_date:d end_date:d days:i",
    f"""SELECT CAST(min(purchase_date) AS DATE) AS start_date, CAST(max(purchase_date) AS DATE) AS end_date,
  date_diff('day', CAST(min(purchase_date) AS DATE), CAST(max(purchase_date) AS DATE)) + 1 AS days
FROM {{all_orders}} WHERE purchase_date >= DATE '{ASSIGNED_SINCE}'""",
)

# Schema
check(
    "schema_profile",
    "column_name:t is_number:b decimal_depth:i longest:i row_count:i all_zero:b target_type:t",
    profile("sheet_po", ["row_index", "sku", "unit_price", "qty", "completion_date", "customer_ref"]),
)
check(
    "schema_widen",
    "column_name:t stored_type:t incoming_type:t change:t",
    f"""SELECT upper(s.column_name) AS column_name, s.target_type AS stored_type, i.target_type AS incoming_type,
  CASE WHEN s.target_type = i.target_type THEN NULL WHEN s.target_type = 'BIGINT' AND i.target_type = 'INTEGER' THEN NULL
       WHEN starts_with(s.target_type, 'VARCHAR') AND starts_with(i.target_type, 'VARCHAR') THEN
            CASE WHEN TRY_CAST(regexp_extract(i.target_type, '([0-9]+)', 1) AS INT) > TRY_CAST(regexp_extract(s.target_type, '([0-9]+)', 1) AS INT) THEN i.target_type END
       WHEN starts_with(s.target_type, 'VARCHAR') AND (starts_with(i.target_type, 'NUMERIC') OR i.target_type IN ('INTEGER', 'BIGINT', 'DATETIME', 'BOOLEAN')) THEN NULL
       WHEN i.all_zero THEN NULL ELSE i.target_type END AS change
FROM ({profile('sheet_cogs', ['row_index', 'container_num', 'sku', 'asin', 'qty', 'duties'])}) s
JOIN ({profile('sheet_po', ['row_index', 'sku', 'unit_price', 'qty', 'completion_date', 'customer_ref'])}) i ON upper(s.column_name) = upper(i.column_name)""",
)
WIDEN_STORED = ["sku", "asin", "quantity", "item_price", "purchase_date"]
WIDEN_INCOMING = ["chargetype", "currencycode", "quantity", "currencyamount", "posteddate"]


def in_every_type(view: str, columns) -> str:
    """The measured types of columns, the last of them a timestamp; numbers in every type they can be stored as."""
    *measured, stamp = columns
    return f"""(SELECT column_name, all_zero, unnest(CASE WHEN target_type LIKE 'NUMERIC%' THEN ['NUMERIC(12,2)', 'NUMERIC(12,4)', 'NUMERIC(20,2)', 'NUMERIC(20,4)',
      'FLOAT(12,2)', 'FLOAT(12,4)', 'FLOAT(20,2)', 'FLOAT(20,4)'] WHEN target_type = 'INTEGER' THEN ['INTEGER', 'BIGINT'] ELSE [target_type] END) AS t
    FROM ({profile(view, measured)}) UNION ALL SELECT '{stamp}', false, 'DATETIME')"""


check(
    "schema_widen_pairs",
    "column_name:t stored_type:t incoming_type:t change:t",
    f"""SELECT upper(s.column_name || ' ' || s.t || ' < ' || i.column_name || ' ' || i.t) AS column_name, s.t AS stored_type, i.t AS incoming_type,
  CASE WHEN s.t = i.t THEN NULL
       WHEN s.t LIKE 'VARCHAR%' AND i.t LIKE 'VARCHAR%' THEN
            CASE WHEN TRY_CAST(regexp_extract(i.t, '([0-9]+)', 1) AS INT) > TRY_CAST(regexp_extract(s.t, '([0-9]+)', 1) AS INT) THEN i.t END
       WHEN s.t LIKE 'VARCHAR%' OR (s.t = 'DATETIME' AND i.t LIKE 'VARCHAR%') THEN NULL
       WHEN (s.t = 'BIGINT' OR s.t LIKE 'FLOAT%') AND i.t = 'INTEGER' THEN NULL
       WHEN s.t IN ('NUMERIC(12,2)', 'NUMERIC(20,2)') AND i.t IN ('INTEGER', 'BIGINT') THEN NULL
       WHEN s.t LIKE '%(20,_)' AND s.t = replace(i.t, '(12,', '(20,') THEN NULL
       WHEN s.t IN ('INTEGER', 'BIGINT') AND i.t = 'DATETIME' THEN 'VARCHAR(25)'
       WHEN i.all_zero THEN NULL ELSE i.t END AS change
FROM {in_every_type('all_orders', WIDEN_STORED)} s CROSS JOIN {in_every_type('finance_events', WIDEN_INCOMING)} i""",
)
check(
    "evolve_append",
    "account_name:t sku:t asin:t list_price:n record_id:i",
    """SELECT account_name, sku, asin, list_price, NULL AS record_id FROM {product_data}
UNION ALL SELECT account_name, sku, asin, NULL, record_id FROM {remote_products}""",
)
check(
    "numeric_coerce",
    "row_index:i sku:t qty:i amount:n",
    "SELECT row_index, sku, CASE WHEN qty = '' THEN 0 ELSE CAST(qty AS BIGINT) END AS qty, CAST(replace(unit_price, '$', '') AS DECIMAL(12,2)) AS amount FROM {sheet_po}",
)
check(
    "key_violations",
    "account_name:t asin1:t seller_sku:t row_count:i",
    f"""SELECT lower(account_name) AS account_name, lower(asin1) AS asin1, lower(seller_sku) AS seller_sku, count(*) AS row_count FROM {{all_listings}} GROUP BY {low('', 'account_name', 'asin1', 'seller_sku')}
HAVING count(*) > 1 OR lower(account_name) IS NULL OR lower(asin1) IS NULL OR lower(seller_sku) IS NULL""",
)
check(
    "first_per_group",
    "account_name:t sku:t asin:t order_status:t item_status:t quantity:i item_price:n",
    f"""SELECT {shown('account_name', 'sku', 'asin', 'order_status', 'item_status', 'quantity', 'item_price')}
FROM {{all_orders}} GROUP BY {low('', 'account_name', 'sku')}""",
)

# Catalog
check(
    "latest_listing",
    "account_name:t asin:t sku:t open_date:d price:n listing_id:i line_no:i",
    f"""SELECT account_name, asin1 AS asin, seller_sku AS sku, open_date, price, listing_id, line_no
FROM (SELECT *, row_number() OVER (PARTITION BY {low('', 'asin1', 'seller_sku')} ORDER BY open_date DESC NULLS LAST, account_name NULLS FIRST,
        price NULLS FIRST, listing_id NULLS FIRST, line_no NULLS FIRST) AS n FROM {{all_listings}}) WHERE n = 1""",
)
check(
    "missing_products",
    "account_name:t asin:t sku:t open_date:d price:n listing_id:i line_no:i item_name:t",
    f"""SELECT account_name, asin, sku, open_date, price, listing_id, line_no, NULL AS item_name FROM {{q_latest_listing}}
UNION ALL SELECT account_name, asin, sku, NULL, list_price, NULL, NULL, itemname FROM {{product_data}} p
WHERE NOT EXISTS (SELECT 1 FROM {{q_latest_listing}} l WHERE {eq('p', 'l', 'account_name', 'asin', 'sku')})""",
)
check(
    "catalog",
    "account_name:t asin:t sku:t open_date:d price:n listing_id:i line_no:i item_name:t parent_asin:t style:t color:t size:i fnsku:t",
    f"""SELECT l.*, p.parent_asin, p.style, p.color, p.size, c.fnsku FROM {{q_missing_products}} l
LEFT JOIN (SELECT {shown('account_name', 'asin', 'sku')}, min(asins) AS parent_asin, {shown('style', 'color', 'size')} FROM {{products}}
           WHERE asin <> '' AND asin <> '0' GROUP BY {low('', 'account_name', 'asin', 'sku')}) p ON {eq('l', 'p', 'account_name', 'asin', 'sku')}
LEFT JOIN (SELECT {shown('account_name', 'sku', 'fnsku')} FROM {{stock}} GROUP BY {low('', 'account_name', 'sku')}) c ON {eq('l', 'c', 'account_name', 'sku')}""",
)
check(
    "unfulfillable_pivot",
    "account_name:t asin:t sku:t date:d fnsku:t title:t defective:i warehouse_damaged:i customer_damaged:i",
    f"""SELECT {shown('account_name', 'asin')}, min(msku) AS sku, {shown('date', 'fnsku', 'title')},
  {', '.join(f"CAST(sum(CASE WHEN lower(disposition) = '{d}' THEN ending_warehouse_balance END) AS BIGINT) AS {d}" for d in ('defective', 'warehouse_damaged', 'customer_damaged'))}
FROM {{stock_summary}} WHERE date = (SELECT max(date) FROM {{stock_summary}}) GROUP BY {low('', 'account_name', 'asin', 'msku')}""",
)
SNAPSHOT = (
    "account_name:t sku:t asin:t condition:t price:n mfn_listing_exists:t afn_listing_exists:t mfn_fulfillable_qty:i afn_warehouse_qty:i "
    "afn_fulfillable_qty:i afn_unsellable_qty:i defective:i warehouse_damaged:i customer_damaged:i afn_inbound_qty:i afn_inbound_working:i "
    "afn_inbound_shipped:i afn_inbound_receiving:i afn_researching_qty:i afn_reserved_qty:i afn_reserved_customer_orders:i "
    "afn_reserved_fc_transfers:i afn_reserved_fc_processing:i afn_total_qty:i"
)
check(
    "inventory_snapshot",
    SNAPSHOT,
    f"""SELECT s.account_name, s.sku, s.asin, s.condition, s.your_price AS price, s.mfn_listing_exists, s.afn_listing_exists,
  s.mfn_fulfillable_quantity AS mfn_fulfillable_qty, s.afn_warehouse_quantity AS afn_warehouse_qty, s.afn_fulfillable_quantity AS afn_fulfillable_qty,
  s.afn_unsellable_quantity AS afn_unsellable_qty, u.defective, u.warehouse_damaged, u.customer_damaged,
  coalesce(s.afn_inbound_working_quantity, 0) + coalesce(s.afn_inbound_shipped_quantity, 0) + coalesce(s.afn_inbound_receiving_quantity, 0) AS afn_inbound_qty,
  s.afn_inbound_working_quantity AS afn_inbound_working, s.afn_inbound_shipped_quantity AS afn_inbound_shipped, s.afn_inbound_receiving_quantity AS afn_inbound_receiving,
  s.afn_researching_quantity AS afn_researching_qty, r.reserved_qty AS afn_reserved_qty, r.reserved_customerorders AS afn_reserved_customer_orders,
  r.reserved_fc_transfers AS afn_reserved_fc_transfers, r.reserved_fc_processing AS afn_reserved_fc_processing, s.afn_total_quantity AS afn_total_qty
FROM {{stock}} s LEFT JOIN {{stock_reserved}} r ON {eq('s', 'r', 'account_name', 'sku', 'asin')}
LEFT JOIN {{q_unfulfillable_pivot}} u ON {eq('s', 'u', 'account_name', 'sku', 'asin')}""",
)

# Finance
check(
    "fee_types",
    "fee_type:t credit_debit:t adjustmenttype:t chargetype:t feetype:t promotiontype:t",
    f"""SELECT {shown('fee_type', 'credit_debit', 'adjustmenttype', 'chargetype', 'feetype', 'promotiontype')}
FROM (SELECT *, {FEE_TYPE} AS fee_type, {SIGN.format(c='currencyamount')} AS credit_debit FROM {{finance_events}})
WHERE fee_type IS NOT NULL GROUP BY {low('', 'fee_type', 'credit_debit')}""",
)
check(
    "fee_mapping",
    "fee_type:t credit_debit:t transaction_type:t amount_type:t amount_description:t",
    f"""SELECT min(f.fee_type) AS fee_type, min(f.credit_debit) AS credit_debit, coalesce(min(s.transaction_type), 'other-transaction') AS transaction_type,
  coalesce(min(s.amount_type), 'other-transaction') AS amount_type, coalesce(min(s.amount_description), min(f.fee_type)) AS amount_description
FROM {{q_fee_types}} f LEFT JOIN (SELECT DISTINCT {TERMS}, {SIGN.format(c='amount')} AS credit_debit FROM {{settlement_lines}}) s
  ON {on('f', 's', fee_type='amount_description', credit_debit='credit_debit')}
GROUP BY lower(f.fee_type), lower(s.transaction_type), lower(f.credit_debit)""",
)
check(
    "settlement_totals",
    "account_name:t group_id:t total_amount:n start_date:s end_date:s",
    f"""SELECT {shown('account_name', 'group_id')}, sum(currencyamount) AS total_amount, min(posteddate) AS start_date, max(posteddate) AS end_date
FROM {{finance_events}} GROUP BY {low('', 'account_name', 'group_id')}""",
)
check(
    "unique_account_sku",
    "account_name:t sku:t asin:t",
    f"""SELECT account_name, sku, asin FROM (SELECT account_name, sku, asin, row_number() OVER (PARTITION BY {low('', 'account_name', 'sku')} ORDER BY asin DESC NULLS LAST) AS n
FROM {{product_data}}) WHERE n = 1""",
)
UPLOAD = (
    "status:t account_name:t settlement_id:t settlement_start_date:d settlement_end_date:d total_amount:n transaction_type:t amount_type:t "
    "amount_description:t posted_date:d sku:t asin:t currency:t og_transaction_type:t og_fee_type:t amount:n"
)
check(
    "open_finance_upload",
    UPLOAD,
    f"""SELECT 'Open' AS status, min(account_name) AS account_name, min(group_id) AS settlement_id, start_date AS settlement_start_date, end_date AS settlement_end_date,
  total_amount, {shown('transaction_type', 'amount_type', 'amount_description')}, posted_date, min(sellersku) AS sku, min(asin) AS asin,
  min(currencycode) AS currency, min(fee_type) AS og_transaction_type, min(expected_type) AS og_fee_type, sum(currencyamount) AS amount
FROM ({mapped('Refund', '{q_fee_mapping}')})
GROUP BY {low('', 'account_name', 'group_id', 'transaction_type', 'amount_type', 'amount_description', 'sellersku', 'asin')}, start_date, end_date, total_amount, posted_date
HAVING NOT (total_amount IS NULL AND sum(currencyamount) IS NULL)""",
)
FEES = (
    "status:t account_name:t start_date:d end_date:d posted_date:d settlement_id:t transaction_type:t group_id:t order_id:t sku:t asin:t "
    "amount_description:t fba_fee:n commission:n principal:n quantity:i"
)
FEE_NAMES = ", ".join(c.split(":")[0] for c in FEES.split())
check(
    "posted_order_fees",
    FEES,
    f"""SELECT 'POSTED' AS status, g.* EXCLUDE (unused), s.asin FROM (
  SELECT {shown('account_name', 'order_id', 'sku', 'transaction_type')}, min(group_id) AS group_id, min(settlement_start_date) AS start_date, min(settlement_end_date) AS end_date,
    {shown('posted_date', 'amount_description')}, min(CAST(settlement_id AS VARCHAR)) AS settlement_id, NULL AS unused,
    {', '.join(f"CAST(sum(CASE WHEN lower(amount_description) = '{d}' THEN amount END) AS DECIMAL(18,4)) AS {c}" for c, d in FEE_SUMS.items())},
    sum(CASE WHEN lower(amount_description) = 'principal' THEN quantity_purchased END) AS quantity
  FROM (SELECT *, coalesce(shipment_id, adjustment_id) AS group_id FROM {{settlement_lines}})
  WHERE settlement_start_date >= DATE '{SETTLED_SINCE}' AND (lower(amount_description) IN ('fbaperunitfulfillmentfee', 'commission', 'principal')
     OR (lower(transaction_type) = 'order' AND lower(amount_description) = 'marketplacefacilitatortax-principal'))
  GROUP BY {low('', 'account_name', 'order_id', 'sku', 'transaction_type', 'group_id')}) g
LEFT JOIN {{q_unique_account_sku}} s ON {eq('g', 's', 'account_name', 'sku')}""",
)
check(
    "open_order_fees",
    FEES,
    f"""SELECT 'Open' AS status, *, concat('Open_', CAST(row_number() OVER (ORDER BY account_name NULLS FIRST, order_id NULLS FIRST, sku NULLS FIRST, transaction_type NULLS FIRST) AS VARCHAR)) AS group_id
FROM (SELECT {shown('account_name', 'start_date', 'end_date')}, min(CAST(posteddate AS DATE)) AS posted_date, min(group_id) AS settlement_id, min(transaction_type) AS transaction_type,
    min(amazonorderid) AS order_id, min(sellersku) AS sku, min(asin) AS asin, min(amount_description) AS amount_description,
    {', '.join(f"CAST(coalesce(sum(CASE WHEN lower(amount_description) = '{d}' THEN currencyamount END), 0) AS DECIMAL(18,4)) AS {c}" for c, d in FEE_SUMS.items())},
    coalesce(sum(CASE WHEN lower(amount_description) = 'principal' THEN quantity END), 0) AS quantity
  FROM ({mapped('Chargeback Refund', "(SELECT min(fee_type) AS fee_type, min(credit_debit) AS credit_debit, min(transaction_type) AS transaction_type, min(amount_type) AS amount_type, min(amount_description) AS amount_description FROM {q_fee_mapping} WHERE lower(transaction_type) NOT IN ('order', 'refund') GROUP BY lower(fee_type), lower(credit_debit))")})
  WHERE lower(amount_description) IN ('fbaperunitfulfillmentfee', 'commission', 'principal')
  GROUP BY {low('', 'account_name', 'amazonorderid', 'sellersku', 'transaction_type')})""",
)
check(
    "combined_order_fees",
    "ranking:i " + FEES,
    f"""SELECT ranking, * EXCLUDE (ranking) REPLACE (
    CASE lower(transaction_type) WHEN 'order' THEN 'Shipped' WHEN 'refund' THEN 'Return' WHEN 'chargeback refund' THEN 'Return' ELSE transaction_type END AS transaction_type,
    coalesce(fba_fee, 0) AS fba_fee, coalesce(commission, 0) AS commission, coalesce(principal, 0) AS principal)
FROM (SELECT *, row_number() OVER (PARTITION BY {low('', 'account_name', 'order_id', 'sku', 'transaction_type', 'group_id')} ORDER BY posted_date NULLS FIRST, status) AS ranking
      FROM (SELECT {FEE_NAMES} FROM {{q_posted_order_fees}} UNION SELECT {FEE_NAMES} FROM {{q_open_order_fees}}))""",
)

# Orders
LINES = (
    "account_name:t amazon_order_id:t sku:t order_status:t unit_price:n item_status:t quantity:i merchant_order_id:t asin:t item_price:n "
    "item_tax:n currency:t ship_city:t purchase_date:d ranking:i"
)
check(
    "order_lines",
    LINES,
    f"""SELECT *, row_number() OVER (PARTITION BY {low('', 'account_name', 'amazon_order_id', 'sku', 'order_status')}
    ORDER BY purchase_date NULLS FIRST, unit_price NULLS FIRST, lower(item_status) NULLS FIRST) AS ranking
FROM (SELECT {shown('account_name', 'amazon_order_id', 'sku', 'order_status')}, unit_price, min(item_status) AS item_status, CAST(sum(quantity) AS BIGINT) AS quantity,
    {shown('merchant_order_id', 'asin', 'item_price', 'item_tax', 'currency', 'ship_city', 'purchase_date')}
  FROM (SELECT *, {UNIT_PRICE} AS unit_price FROM {{order_items}}) WHERE purchase_date >= DATE '{ORDERS_SINCE}'
  GROUP BY {low('', 'account_name', 'amazon_order_id', 'sku', 'order_status', 'item_status')}, unit_price)""",
)
check(
    "order_unit_price",
    "account_name:t order_id:t sku:t unit_price:n weighted_unit_price:n quantity:i line_count:i",
    f"""SELECT account_name, order_id, sku, {half_up('value', 2, 'line_quantity', 0, 2)} AS unit_price, {half_up('value', 2, 'quantity', 0, 2)} AS weighted_unit_price, quantity, line_count
FROM (SELECT min(account_name) AS account_name, min(amazon_order_id) AS order_id, min(sku) AS sku, CAST(sum(quantity * CAST(unit_price AS DECIMAL(12,2))) AS DECIMAL(20,2)) AS value,
    min(quantity) AS line_quantity, CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS line_count
  FROM (SELECT * REPLACE (CAST(quantity AS INT) AS quantity) FROM {{q_order_lines}}) WHERE lower(order_status) NOT IN ('cancelled')
  GROUP BY {low('', 'account_name', 'amazon_order_id', 'sku')})""",
)
check(
    "fulfilled_lines",
    "account_name:t amazon_order_id:t sku:t shipment_id:t item_status:t item_price:n quantity:i",
    f"""SELECT {shown('account_name', 'amazon_order_id', 'sku', 'shipment_id')}, 'shipped' AS item_status, unit AS item_price, CAST(sum(quantity_shipped) AS BIGINT) AS quantity
FROM (SELECT *, {half_up('item_price', 2, 'quantity_shipped', 0, 2)} AS unit FROM {{fulfilled_shipments}})
GROUP BY {low('', 'account_name', 'amazon_order_id', 'sku', 'shipment_id')}, unit""",
)
ASSIGNED = LINES + " shipment_id:t fulfilled_quantity:i new_ranking:i id:i"
check(
    "assign_orders",
    ASSIGNED,
    f"""SELECT *, row_number() OVER (PARTITION BY {low('', 'account_name', 'amazon_order_id', 'sku', 'order_status', 'shipment_id')} ORDER BY ranking) AS new_ranking,
  row_number() OVER (ORDER BY account_name NULLS FIRST, amazon_order_id NULLS FIRST, sku NULLS FIRST, order_status NULLS FIRST, ranking, shipment_id NULLS FIRST) AS id
FROM (SELECT l.*, f.shipment_id, f.quantity AS fulfilled_quantity FROM {{q_order_lines}} l
  LEFT JOIN {{q_fulfilled_lines}} f ON {eq('l', 'f', 'account_name', 'amazon_order_id', 'sku', 'item_status')} AND l.unit_price = f.item_price
  WHERE CAST(l.purchase_date AS DATE) >= DATE '{ASSIGNED_SINCE}')""",
)
LINE_NAMES = ", ".join(c.split(":")[0] for c in LINES.split())
check(
    "repair_shipments",
    ASSIGNED,
    f"""WITH gap AS (SELECT a.*, c.group_id, c.quantity AS settled, c.ranking AS c_ranking FROM {{q_assign_orders}} a
    JOIN {{q_combined_order_fees}} c ON {on('a', 'c', account_name='account_name', amazon_order_id='order_id', sku='sku')}
    WHERE lower(a.item_status) = 'shipped' AND a.shipment_id IS NULL AND lower(c.transaction_type) = 'shipped')
SELECT {LINE_NAMES}, shipment_id, fulfilled_quantity, new_ranking, id FROM {{q_assign_orders}} WHERE id NOT IN (SELECT id FROM gap)
UNION ALL SELECT {LINE_NAMES}, group_id, settled,
  row_number() OVER (PARTITION BY {low('', 'account_name', 'amazon_order_id', 'sku', 'order_status', 'group_id')} ORDER BY id, c_ranking),
  (SELECT max(id) FROM {{q_assign_orders}}) + row_number() OVER (ORDER BY id, group_id NULLS FIRST, c_ranking) FROM gap""",
)
check(
    "final_assigned_orders",
    ASSIGNED + " fba_fee:n commission:n principal:n",
    f"""SELECT r.*, coalesce(c.fba_fee, 0) AS fba_fee, coalesce(c.commission, 0) AS commission, coalesce(c.principal, 0) AS principal FROM {{q_repair_shipments}} r
LEFT JOIN {{q_combined_order_fees}} c ON {on('r', 'c', account_name='account_name', amazon_order_id='order_id', sku='sku', order_status='transaction_type', shipment_id='group_id')}
  AND r.new_ranking = c.ranking""",
)

# Returns
UNITS = "ranking:i " + FEES + " settlement_quantity:i unit_price:n order_line_units:i"
check(
    "return_units",
    UNITS,
    f"""SELECT c.*, p.quantity AS settlement_quantity, p.unit_price,
  CASE WHEN c.principal >= 0 THEN 1 ELSE coalesce(greatest({half_up('-CAST(c.principal AS DECIMAL(18,4))', 4, 'CAST(p.unit_price AS DECIMAL(12,2))', 2, 0)}, 1), 1) END AS order_line_units
FROM {{q_combined_order_fees}} c LEFT JOIN {{q_order_unit_price}} p ON {eq('c', 'p', 'account_name', 'order_id', 'sku')} WHERE lower(c.transaction_type) = 'return'""",
)
EXPAND_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in ("posted_date", *[u.split(":")[0] for u in ("ranking:i " + FEES + " settlement_quantity unit_price order_line_units").split()])
    if c not in ("account_name", "order_id", "sku")
)
check(
    "return_expand",
    UNITS + " number:i new_ranking:i",
    f"""SELECT u.*, n.number, row_number() OVER (PARTITION BY {low('u.', 'account_name', 'order_id', 'sku')} ORDER BY {EXPAND_ORDER}, n.number) AS new_ranking
FROM {{q_return_units}} u LEFT JOIN (SELECT unnest(range(1, (SELECT max(order_line_units) FROM {{q_return_units}}) + 1)) AS number) n ON u.order_line_units >= n.number""",
)
RETURNS = (
    "ranking:i account_name:t quantity:i purchase_date:d item_price:n asin:t order_id:t merchant_order_id:t order_status:t product_name:t sku:t item_status:t"
)
check(
    "return_lines",
    RETURNS,
    f"""SELECT row_number() OVER (PARTITION BY {low('', 'account_name', 'order_id', 'sku')}
    ORDER BY return_date NULLS FIRST, asin NULLS FIRST, product_name NULLS FIRST, status NULLS FIRST, quantity NULLS FIRST) AS ranking,
  account_name, -quantity AS quantity, return_date AS purchase_date, NULL AS item_price, asin, order_id, order_id AS merchant_order_id, 'Return' AS order_status,
  product_name, sku, status AS item_status FROM {{returned_items}} WHERE return_date >= DATE '{ASSIGNED_SINCE}'""",
)
check(
    "assign_returns",
    RETURNS + " group_id:t order_line_units:i",
    f"""SELECT r.*, e.group_id, e.order_line_units FROM {{q_return_lines}} r JOIN {{q_return_expand}} e
  ON {eq('r', 'e', 'account_name', 'order_id', 'sku')} AND r.ranking = e.new_ranking WHERE e.group_id IS NOT NULL""",
)
check(
    "final_assigned_returns",
    RETURNS + " group_id:t order_line_units:i fba_fee:n commission:n principal:n",
    f"""SELECT a.*, c.fba_fee, c.commission, c.principal FROM {{q_assign_returns}} a
LEFT JOIN (SELECT * FROM {{q_combined_order_fees}} WHERE lower(transaction_type) = 'return') c ON {eq('a', 'c', 'account_name', 'order_id', 'sku', 'group_id')}""",
)

# Ledger
check(
    "po_eta_default",
    "account_name:t record_id_num:i sku:t eta:t po_status:t",
    f"""SELECT account_name, record_id_num, sku, CASE WHEN lower(po_status) = 'completed' AND eta = '' THEN '{ETA_DEFAULT}' ELSE eta END AS eta, po_status FROM {{po_records}}""",
)
check(
    "active_skus",
    "account_name:t sku:t asin:t",
    f"""SELECT {shown('account_name', 'sku', 'asin')} FROM {{product_data}}
WHERE lower(sku) IN (SELECT lower(sku) FROM {{q_po_eta_default}} WHERE TRY_CAST(eta AS DATE) >= DATE '{LEDGER_START}') GROUP BY {low('', 'account_name', 'sku')}""",
)
MEASURES = (
    "starting_warehouse_balance", "receipts", "customer_shipments", "customer_returns", "vendor_returns", "found", "lost", "damaged",
    "disposed", "other_events", "unknown_events", "ending_warehouse_balance",
)
check(
    "ledger_summary",
    "account_name:t msku:t date:d disposition:t asin:t " + " ".join(f"{m}:i" for m in MEASURES),
    f"""SELECT min(s.account_name) AS account_name, min(s.msku) AS msku, s.date, min(s.disposition) AS disposition, min(s.asin) AS asin,
  {', '.join(f'CAST(sum(s.{m}) AS BIGINT) AS {m}' for m in MEASURES)}
FROM {{stock_summary}} s JOIN {{q_active_skus}} a ON {on('s', 'a', account_name='account_name', msku='sku')}
WHERE s.date >= DATE '{LEDGER_START}' GROUP BY {low('s.', 'account_name', 'msku', 'disposition')}, s.date""",
)
check(
    "ledger_events",
    "id:i account_name:t date:d msku:t event_type:t quantity:i disposition:t ending_warehouse_balance:i ranking:i",
    f"""SELECT *, row_number() OVER (ORDER BY date DESC NULLS LAST, account_name NULLS FIRST, msku NULLS FIRST, disposition NULLS FIRST, ranking) AS id
FROM (SELECT e.account_name, e.date, e.msku, e.event_type, e.quantity, e.disposition, s.ending_warehouse_balance,
    row_number() OVER (PARTITION BY {low('e.', 'account_name', 'msku', 'disposition')}, e.date ORDER BY e.event_type NULLS FIRST, e.quantity NULLS FIRST, e.reference_id NULLS FIRST) AS ranking
  FROM {{stock_movements}} e JOIN {{q_active_skus}} a ON {on('e', 'a', account_name='account_name', msku='sku')}
  LEFT JOIN {{q_ledger_summary}} s ON {eq('e', 's', 'account_name', 'msku', 'disposition')} AND e.date = s.date
  WHERE e.date >= DATE '{LEDGER_START}' AND e.date <= (SELECT max(date) FROM {{stock_summary}}) AND lower(e.event_type) NOT IN ('whsetransfers'))""",
)
LEDGER_KINDS = "account_name:t order_id:t date:d sku:t asin:t order_status:t item_status:t quantity:i"
check(
    "order_ledger",
    LEDGER_KINDS,
    f"""SELECT min(o.account_name) AS account_name, min(o.amazon_order_id) AS order_id, CAST(min(o.purchase_date) AS DATE) AS date, min(o.sku) AS sku, min(o.asin) AS asin,
  min(o.order_status) AS order_status, min(o.item_status) AS item_status, CAST(sum(-o.quantity) AS BIGINT) AS quantity
FROM {{order_items}} o JOIN {{q_active_skus}} a ON {eq('o', 'a', 'account_name', 'sku')}
WHERE o.purchase_date >= DATE '{LEDGER_START}' AND o.purchase_date <= (SELECT max(date) FROM {{stock_summary}}) AND lower(o.amazon_order_id) NOT LIKE 's%'
  AND lower(o.order_status) <> 'cancelled' AND lower(o.item_status) NOT IN ('unshipped', 'cancelled')
GROUP BY {low('o.', 'account_name', 'amazon_order_id', 'sku')}""",
)
check(
    "return_ledger",
    LEDGER_KINDS,
    f"""SELECT min(r.account_name) AS account_name, min(r.order_id) AS order_id, r.return_date AS date, min(r.sku) AS sku, min(r.asin) AS asin,
  'Return' AS order_status, min(r.status) AS item_status, CAST(sum(r.quantity) AS BIGINT) AS quantity
FROM {{returned_items}} r JOIN {{q_active_skus}} a ON {eq('r', 'a', 'account_name', 'sku')}
WHERE lower(r.status) <> 'reimbursed' AND r.return_date >= DATE '{LEDGER_START}' GROUP BY {low('r.', 'account_name', 'order_id', 'sku')}, r.return_date""",
)
check(
    "removal_ledger",
    LEDGER_KINDS,
    f"""SELECT r.account_name, r.order_id, r.request_date AS date, r.sku, a.asin,
  CASE WHEN lower(r.removal_order_type) = 'return' THEN 'Vendor Removal' ELSE r.removal_order_type END AS order_status, r.disposition AS item_status, CAST(-r.shipped_quantity AS BIGINT) AS quantity
FROM {{removals}} r JOIN {{q_active_skus}} a ON {eq('r', 'a', 'account_name', 'sku')} WHERE r.request_date >= DATE '{LEDGER_START}' AND r.shipped_quantity <> 0""",
)
check(
    "adjustment_ledger",
    LEDGER_KINDS,
    f"""SELECT e.account_name, e.reference_id AS order_id, e.date, e.msku AS sku, e.asin, e.event_type AS order_status, e.event_type AS item_status, CAST(e.quantity AS BIGINT) AS quantity
FROM {{stock_movements}} e JOIN {{q_active_skus}} a ON {on('e', 'a', account_name='account_name', msku='sku')}
WHERE lower(e.event_type) = 'adjustments' AND e.date >= DATE '{LEDGER_START}'""",
)
check(
    "receipt_rolling",
    f"account_name:t record_id_num:i fba_shipment_id:t eta:t sku:t asin:t received:t po_status:t qty:i unit_price:n {COSTS.replace(',', ':n')}:n id:i rolling_qty:i last_rolling_qty:i",
    f"""SELECT *, coalesce(lag(rolling_qty) OVER (PARTITION BY {low('', 'account_name', 'sku')} ORDER BY id NULLS FIRST, asin NULLS FIRST), 0) AS last_rolling_qty
FROM (SELECT *, CAST(sum(qty) OVER (PARTITION BY {low('', 'account_name', 'sku', 'asin')} ORDER BY id NULLS FIRST) AS BIGINT) AS rolling_qty
  FROM (SELECT * FROM ({received(f"TRY_CAST(p.eta AS DATE) >= DATE '{LEDGER_START}'").replace('{po_records}', '{q_po_eta_default_all}')})
    UNION SELECT account_name, NULL, 'Starting Inventory', '{LEDGER_START}', sku, asin, 'Received', 'Completed', CAST(starting_inventory AS BIGINT), 0, 0, 0, 0, 0, 0, NULL
    FROM {{product_records}} WHERE starting_inventory > 0))""",
)
check(
    "po_eta_default_all",
    "",
    f"SELECT * REPLACE (CASE WHEN lower(po_status) = 'completed' AND eta = '' THEN '{ETA_DEFAULT}' ELSE eta END AS eta) FROM {{po_records}}",
)
check(
    "ledger_rows",
    "",
    " UNION ".join(
        f"SELECT {LEDGER} FROM {{q_{p}}}" for p in ("order_ledger", "return_ledger", "removal_ledger", "adjustment_ledger")
    ),
)
LEDGER_ORDER = "asin NULLS FIRST, order_status NULLS FIRST, item_status NULLS FIRST, quantity NULLS FIRST"
check(
    "ledger_detail",
    LEDGER_KINDS + " id:i",
    f"SELECT *, row_number() OVER (ORDER BY account_name NULLS FIRST, sku NULLS FIRST, date NULLS FIRST, order_id NULLS FIRST, {LEDGER_ORDER}) AS id FROM {{q_ledger_rows}}",
)
check(
    "ledger_rolling",
    LEDGER_KINDS + " rolling_qty:i last_rolling_qty:i",
    f"""SELECT *, coalesce(lag(rolling_qty) OVER (PARTITION BY {low('', 'account_name', 'sku')} ORDER BY date NULLS FIRST, lower(order_id) NULLS FIRST, {LEDGER_ORDER}), 0) AS last_rolling_qty
FROM (SELECT *, CAST(sum(-quantity) OVER (PARTITION BY {low('', 'account_name', 'sku')} ORDER BY date NULLS FIRST, lower(order_id) NULLS FIRST) AS BIGINT) AS rolling_qty FROM {{q_ledger_rows}})""",
)
FIFO = (
    LEDGER_KINDS
    + " rolling_qty:i last_rolling_qty:i starting_inventory:i product_record_id:i order_record_id:i fba_shipment_id:t po_rolling_qty:i po_last_rolling_qty:i "
    + f"record_id_num:i unit_price:n {COSTS.replace(',', ':n')}:n"
)
check(
    "fifo_assign",
    FIFO,
    f"""SELECT l.*, p.starting_inventory, p.record_id_num AS product_record_id, o.record_id_num AS order_record_id, r.fba_shipment_id, r.rolling_qty AS po_rolling_qty,
  r.last_rolling_qty AS po_last_rolling_qty, r.record_id_num, r.unit_price, {', '.join('r.' + c for c in COSTS.split(', '))}
FROM {{q_ledger_rolling}} l LEFT JOIN {{product_records}} p ON {eq('l', 'p', 'account_name', 'sku', 'asin')}
LEFT JOIN {{q_receipt_rolling}} r ON {eq('l', 'r', 'account_name', 'sku', 'asin')} AND l.rolling_qty <= r.rolling_qty AND greatest(l.rolling_qty, 0) >= r.last_rolling_qty
LEFT JOIN {{order_records}} o ON {on('l', 'o', account_name='source', order_id='amazon_order_id', asin='asin', sku='sku', order_status='order_status')}""",
)
check(
    "receipts_by_sku",
    "",
    f"""SELECT *, coalesce(lag(rolling_qty) OVER (PARTITION BY {low('', 'account_name', 'sku')} ORDER BY id), 0) AS last_rolling_qty
FROM (SELECT *, CAST(sum(qty) OVER (PARTITION BY {low('', 'account_name', 'sku')} ORDER BY id) AS BIGINT) AS rolling_qty FROM ({received('true')}))""",
)
check(
    "fifo_assign_strict",
    LEDGER_KINDS + " rolling_qty:i last_rolling_qty:i fba_shipment_id:t po_rolling_qty:i po_last_rolling_qty:i",
    f"""SELECT l.*, r.fba_shipment_id, r.rolling_qty AS po_rolling_qty, r.last_rolling_qty AS po_last_rolling_qty FROM {{q_ledger_rolling}} l
LEFT JOIN {{q_receipts_by_sku}} r ON {eq('l', 'r', 'account_name', 'sku')} AND l.rolling_qty <= r.rolling_qty AND l.rolling_qty > r.last_rolling_qty""",
)

# Publishing
check(
    "attach_record_id",
    "account_name:t sku:t asin:t itemname:t record_id:t",
    f"SELECT account_name, sku, asin, itemname, record_id FROM ({record('{product_data}')})",
)
check(
    "sync_diff",
    "account_name:t shipmentid:t shipmentname:t shipmentstatus:t",
    diff("{inbound_shipments}", "{remote_shipments}", "account_name, shipmentid", "s.shipmentname, s.shipmentstatus"),
)
check(
    "sync_new_only",
    "account_name:t shipmentid:t shipmentname:t shipmentstatus:t",
    f"""SELECT s.* FROM {{inbound_shipments}} s JOIN ({once('{inbound_shipments}', '{remote_shipments}', 'account_name, shipmentid')}) o
ON {null_safe('o', 's', 'account_name, shipmentid')}""",
)
check(
    "settlement_ids",
    "settlement_id:t",
    "SELECT settlement_id FROM {q_posted_order_fees} UNION SELECT settlement_id FROM {q_open_order_fees}",
)
check(
    "unpublished_settlements",
    "settlement_id:t",
    "SELECT settlement_id FROM {q_settlement_ids} i WHERE NOT EXISTS (SELECT 1 FROM {published_settlements} p WHERE p.settlement_id = i.settlement_id)",
)
check(
    "purge_and_reload",
    "account_name:t settlement_id:t transaction_type:t status:t",
    f"""SELECT account_name, CAST(settlement_id AS VARCHAR) AS settlement_id, transaction_type, status FROM {{published_fees}} WHERE lower(status) <> 'open'
UNION ALL SELECT account_name, settlement_id, transaction_type, status FROM {{q_open_finance_upload}}""",
)
check(
    "upsert_records",
    "account_name:t sku:t asin:t list_price:n itemname:t",
    """SELECT p.account_name, p.sku, p.asin, p.list_price, p.itemname FROM {product_data} p
WHERE NOT EXISTS (SELECT 1 FROM {q_latest_listing} l WHERE lower(l.account_name) = lower(p.account_name) AND lower(l.sku) = lower(p.sku) AND lower(l.asin) = lower(p.asin))
UNION ALL SELECT account_name, sku, asin, price, NULL FROM {q_latest_listing}""",
)
check(
    "payload_json",
    "account_name:t sku:t payload:t",
    f"SELECT account_name, sku, {json(['account_name', 'sku', 'asin', 'itemname', 'list_price', 'size'])} AS payload FROM {{product_data}}",
)
check(
    "global_sequence",
    "account_name:t asin1:t seller_sku:t listing_id:i line_no:i sequence:i",
    """SELECT account_name, asin1, seller_sku, listing_id, line_no,
  row_number() OVER (ORDER BY account_name NULLS FIRST, seller_sku NULLS FIRST, open_date NULLS FIRST, listing_id NULLS FIRST, line_no NULLS FIRST, asin1 NULLS FIRST, price NULLS FIRST) AS sequence
FROM {all_listings}""",
)
check(
    "payload_batches",
    "account_name:t sku:t batch_id:i",
    batched("(SELECT account_name, seller_sku AS sku, open_date, listing_id, line_no, asin1, price FROM {all_listings})", "account_name, sku, open_date, listing_id, line_no, asin1, price"),
)
check(
    "upsert_changes",
    "outcome:t account_name:t sku:t asin:t list_price:n itemname:t",
    f"""SELECT CASE WHEN sku LIKE '%1' THEN 'deleted' WHEN size % 3 = 0 THEN 'changed' ELSE 'unchanged' END AS outcome, account_name, sku, asin,
  CASE WHEN sku NOT LIKE '%1' AND size % 3 = 0 THEN list_price + 1 ELSE list_price END AS list_price, itemname FROM {{product_data}}
UNION ALL SELECT 'created', account_name, sku, asin, price, NULL FROM {{q_latest_listing}} l
WHERE NOT EXISTS (SELECT 1 FROM {{product_data}} p WHERE {eq('l', 'p', 'account_name', 'sku', 'asin')})""",
)
check("stored_import", "Record_ID_Num:i Product_Brand:t Product_Type:t", "SELECT * FROM {q_import_records}")
check(
    "stored_listing",
    "outcome:t asin:t sku:t account_name:t listing_id:i refused:i",
    """SELECT 'stored' AS outcome, asin, sku, account_name, listing_id, NULL AS refused FROM {q_latest_listing}
UNION ALL SELECT 'refused', asin1, seller_sku, NULL, NULL, count(*) - 1 FROM {all_listings} GROUP BY asin1, seller_sku HAVING count(*) > 1""",
)
check(
    "evolved_profile",
    "column_name:t is_number:b decimal_depth:i longest:i row_count:i all_zero:b target_type:t",
    profile("q_evolve_append", ["account_name", "sku", "asin", "list_price", "record_id"]),
)
check(
    "published_days",
    "slice_date:d amazon_order_id:t sku:t quantity:i",
    f"""WITH o AS (SELECT *, CAST(purchase_date AS DATE) AS slice_date FROM {{all_orders}}),
last AS (SELECT DISTINCT slice_date FROM o ORDER BY slice_date DESC LIMIT 3)
SELECT slice_date, amazon_order_id, sku, CASE WHEN slice_date IN (SELECT slice_date FROM last) THEN 2 * quantity ELSE quantity END AS quantity
FROM o WHERE slice_date >= DATE '{ASSIGNED_SINCE}'""",
)
check(
    "published_batches",
    "batch_id:i account_name:t sku:t asin:t payload:t",
    "SELECT batch_id, account_name, sku, asin, "
    + json(["account_name", "sku", "asin", "list_price"])
    + " AS payload FROM ("
    + batched("(SELECT account_name, sku, asin, list_price FROM {product_data})", "account_name, sku, asin")
    + ")",
)
check(
    "logged_steps",
    "script:t query:t row_count:i in_order:b",
    "\nUNION ALL ".join(
        f"SELECT 'catalog' AS script, 'logged_{step}' AS query, count(*) AS row_count, true AS in_order FROM {{q_{step}}}"
        for step in ("latest_listing", "missing_products", "catalog")
    ),
)
check(
    "sheet_export",
    "Row_Index:t Sku:t Unit_Price:t Qty:t Completion_Date:t Customer_Ref:t Remarks:t",
    """SELECT CAST(row_index AS VARCHAR) AS Row_Index, sku AS Sku, unit_price AS Unit_Price, qty AS Qty, completion_date AS Completion_Date, customer_ref AS Customer_Ref,
  CASE row_index % 4 WHEN 3 THEN 'kept' ELSE '' END AS Remarks FROM {sheet_po}""",
)
check(
    "sheet_sort",
    "row_index:i sku:t unit_price:t qty:t",
    "SELECT row_index, sku, unit_price, qty FROM {sheet_po} UNION ALL SELECT max(row_index) + 1, 'New', '$1.00', '1' FROM {sheet_po}",
)
check(
    "product_feed",
    "account_name:t sku:t asin:t payload:t",
    "SELECT account_name, sku, asin, "
    + json(feeds.PRODUCT_FIELDS, open_date=second("open_date"), price="CAST(price AS DECIMAL(12,2))")
    + " AS payload FROM ("
    + diff(
        "(SELECT * REPLACE (upper(account_name) AS account_name, upper(asin) AS asin) FROM {q_catalog})",
        "{remote_products}",
        "account_name, sku, asin",
        "s.* EXCLUDE (account_name, sku, asin)",
    )
    + ")",
)
check(
    "sales_feed",
    "sale_day:d payload:t",
    "SELECT CAST(purchase_date AS DATE) AS sale_day, "
    + json(
        feeds.SALES_FIELDS,
        purchase_date=second("purchase_date"),
        order_type="'Sale'",
        fba_fee="CAST(fba_fee AS DECIMAL(18,4))",
        commission="CAST(commission AS DECIMAL(18,4))",
        item_price="CAST(item_price AS DECIMAL(12,2))",
        item_tax="CAST(item_tax AS DECIMAL(12,2))",
    )
    + f" AS payload FROM ({record('{q_final_assigned_orders}')}) WHERE purchase_date >= DATE '{ASSIGNED_SINCE}'",
)
check(
    "returns_feed",
    "batch_id:i payload:t",
    batched(
        "(SELECT *, "
        + json(
            feeds.RETURN_FIELDS,
            purchase_date=second("purchase_date"),
            order_type="'Return'",
            **{c: f"CAST({c} AS DECIMAL(18,4))" for c in ("principal", "fba_fee", "commission")},
        )
        + f" AS payload FROM ({record('{q_final_assigned_returns}')}) WHERE purchase_date >= DATE '{ASSIGNED_SINCE}')",
        "account_name, order_id, sku, ranking, group_id, payload",
    ),
)
check(
    "order_fee_feed",
    "settlement_id:t batch_id:i payload:t",
    "SELECT settlement_id, batch_id, "
    + json(
        feeds.ORDER_FEE_FIELDS,
        fba_fee="CAST(fba_fee AS DECIMAL(18,4))",
        commission="CAST(commission AS DECIMAL(18,4))",
        **{c: day(c) for c in ("start_date", "end_date", "posted_date")},
    )
    + " AS payload FROM ("
    + record(
        "(SELECT *, (row_number() OVER (PARTITION BY lower(settlement_id) ORDER BY account_name NULLS FIRST, order_id NULLS FIRST, sku NULLS FIRST, "
        "transaction_type NULLS FIRST, group_id NULLS FIRST, ranking) - 1) // 1000 AS batch_id FROM {q_combined_order_fees} f "
        "WHERE NOT EXISTS (SELECT 1 FROM {published_settlements} p WHERE p.settlement_id = f.settlement_id AND lower(p.status) <> 'open'))"
    )
    + ")",
)
FEE_TEXTS = {
    **{c: second(c) for c in ("settlement_start_date", "settlement_end_date", "posted_date")},
    "amount": "CAST(amount AS DECIMAL(18,4))",
}
check(
    "finance_fee_feed",
    "batch_id:i payload:t",
    batched(
        "(SELECT *, "
        + json(feeds.FEE_FIELDS, total_amount="CAST(total_amount AS DECIMAL(18,4))", **FEE_TEXTS)
        + f" AS payload FROM ({record('{q_open_finance_upload}')}) WHERE settlement_start_date IS NOT NULL)",
        "account_name, settlement_id, sku, payload",
    ),
)
SETTLED = "account_name, settlement_id, settlement_start_date, settlement_end_date, total_amount, transaction_type, amount_type, amount_description, posted_date, sku"
check(
    "settlement_fee_feed",
    "settlement_id:t payload:t",
    "SELECT settlement_id, "
    + json(feeds.FEE_FIELDS, total_amount="CAST(total_amount AS DECIMAL(16,4))", **FEE_TEXTS)
    + " AS payload FROM ("
    + record(
        f"""(SELECT 'Posted' AS status, g.*, s.asin FROM (SELECT {shown('account_name', 'sku', 'transaction_type', 'amount_type', 'amount_description', 'currency')},
  settlement_id, settlement_start_date, settlement_end_date, total_amount, posted_date, sum(amount) AS amount FROM {{settlement_lines}}
  WHERE settlement_id IN (SELECT settlement_id FROM {{settlement_lines}} WHERE settlement_start_date >= DATE '{ASSIGNED_SINCE}')
    AND CAST(settlement_id AS VARCHAR) NOT IN (SELECT settlement_id FROM {{published_settlements}})
  GROUP BY {low('', 'account_name', 'sku', 'transaction_type', 'amount_type', 'amount_description')}, settlement_id, settlement_start_date, settlement_end_date, total_amount, posted_date) g
LEFT JOIN {{q_unique_account_sku}} s ON {eq('g', 's', 'account_name', 'sku')})"""
    )
    + ")",
)
check(
    "shipment_feed",
    "account_name:t shipmentid:t payload:t",
    f"""SELECT s.account_name, s.shipmentid, {json(['account_name', 'shipmentid', 'shipmentname', 'shipmentstatus'], account_name='s.account_name', shipmentid='s.shipmentid')} AS payload
FROM {{inbound_shipments}} s JOIN ({once('{inbound_shipments}', final('{published_shipments}'), 'account_name, shipmentid')}) o ON {null_safe('o', 's', 'account_name, shipmentid')}""",
)
DETAIL_KEYS = "account_name, shipmentid, sku, fnsku"
check(
    "shipment_details",
    "",
    f"""SELECT upper(d.account_name) AS account_name, d.shipmentid, upper(d.sellersku) AS sku, d.fulfillmentnetworksku AS fnsku,
  upper(coalesce(c.asin, CASE WHEN lower(d.fulfillmentnetworksku) LIKE 'b%' THEN d.fulfillmentnetworksku END)) AS asin,
  d.quantityshipped, d.quantityreceived, d.quantityincase, d.releasedate
FROM {{inbound_details}} d LEFT JOIN {{product_data}} c ON {on('d', 'c', account_name='account_name', sellersku='sku')}""",
)
check(
    "shipment_detail_feed",
    "account_name:t shipmentid:t sku:t fnsku:t payload:t",
    f"SELECT {DETAIL_KEYS}, "
    + json(
        ["account_name", "shipmentid", "sku", "fnsku", "asin", "quantityshipped", "quantityreceived", "quantityincase", "releasedate", "record_id"],
        releasedate=day("releasedate"),
    )
    + " AS payload FROM ("
    + record(
        "("
        + diff("{q_shipment_details}", final("{published_details}"), DETAIL_KEYS, "s.* EXCLUDE (account_name, shipmentid, sku, fnsku)")
        + ")"
    )
    + ")",
)
check(
    "tracking_feed",
    "account_name:t shipmentid:t payload:t",
    "SELECT account_name, shipmentid, "
    + json(
        ["account_name", "shipmentid", "shipmenttype", "trackingid", "transportstatus", "carriername", "value", "currencycode", "weight_value", "weight_unit", "packagestatus"]
    )
    + " AS payload FROM ("
    + diff("{inbound_transport}", final("{published_shipments}"), "account_name, shipmentid", "s.* EXCLUDE (account_name, shipmentid)")
    + ")",
)
check(
    "receiving_rows",
    "",
    f"""SELECT r.account_name, r.shipmentid, r.sellersku AS sku, c.asin, r.quantityshipped, r.quantityreceived, r.shipmentstatus, r.value, r.date AS received_date, r.quantity, r.shipmentname,
  r.cost_per_unit, r.running_quantity, r.receipt_cost
FROM {{inbound_report}} r LEFT JOIN (SELECT * FROM (SELECT account_name, sku, asin, row_number() OVER (PARTITION BY {low('', 'account_name', 'sku')}
    ORDER BY parent_asin DESC NULLS LAST, asin NULLS FIRST) AS n FROM {{q_catalog}}) WHERE n = 1) c ON {on('r', 'c', account_name='account_name', sellersku='sku')}
WHERE r.shipmentstatus IS NOT NULL AND r.quantityreceived <> 0 AND r.date IS NOT NULL""",
)
check(
    "receiving_feed",
    "account_name:t shipmentid:t sku:t payload:t",
    "SELECT account_name, shipmentid, sku, "
    + json(
        [
            "account_name", "shipmentid", "sku", "asin", "quantityshipped", "quantityreceived", "shipmentstatus", "value",
            "received_date", "quantity", "shipmentname", "cost_per_unit", "running_quantity", "receipt_cost",
            "shipment_record_id", "record_id", "detail_record_id",
        ],
        received_date=day("received_date"),
    )
    + f""" AS payload FROM (SELECT y.*, h.record_id AS shipment_record_id, d.record_id AS detail_record_id FROM ({record('{q_receiving_rows}')}) y
LEFT JOIN {{q_shipment_records}} h ON y.account_name = upper(h.account_name) AND y.shipmentid = h.shipmentid
LEFT JOIN {{remote_details}} d ON y.account_name = d.account_name AND y.sku = d.sku AND y.asin = d.asin AND y.shipmentid = d.shipmentid)""",
)
check(
    "shipment_records",
    "",
    "SELECT account_name, shipmentid, CAST(substr(shipmentid, 3) AS BIGINT) AS record_id FROM {remote_shipments}",
)
check(
    "inventory_feed",
    "account_name:t sku:t asin:t payload:t",
    "SELECT account_name, sku, asin, "
    + json([*[c.split(":")[0] for c in SNAPSHOT.split()], "record_id"], price="CAST(price AS DECIMAL(12,2))")
    + f" AS payload FROM ({record('{q_inventory_snapshot}')})",
)
check(
    "unit_ledger_feed",
    "batch_id:i payload:t",
    batched(
        "(SELECT *, "
        + json(
            [c.split(":")[0] for c in FIFO.split()],
            date=day("date"),
            **{c: f"CAST({c} AS DECIMAL(18,6))" for c in ("unit_price", *COSTS.split(", "))},
        )
        + " AS payload FROM (SELECT * REPLACE (upper(account_name) AS account_name, upper(sku) AS sku, upper(asin) AS asin, upper(fba_shipment_id) AS fba_shipment_id) FROM {q_fifo_assign}))",
        "account_name, sku, date, order_id, rolling_qty, payload",
    ),
)

# Sheets
check(
    "po_sheet_clean",
    "po_type:t row_index:i sku:t unit_price:n qty:i completion_date:d eta:d customer_ref:t ready:b",
    f"""SELECT po_type, row_index, upper(sku) AS sku, {money('unit_price')} AS unit_price, CAST({money('qty')} AS INT) AS qty,
  {sheet_day("CASE WHEN regexp_matches(done, '[A-Za-z]') THEN '' ELSE done END")} AS completion_date, eta, coalesce(customer_ref, '') AS customer_ref,
  regexp_matches(done, '^[A-Za-z]+$') AS ready
FROM (SELECT * EXCLUDE (eta), {sheet_day("replace(eta, '.', '/')")} AS eta,
    trim(replace(replace(replace(replace(completion_date, '.', '/'), 'Ready', ''), '; no confirmation', ''), '  ', ' ')) AS done FROM {{q_pad_and_union}})
WHERE qty IS NOT NULL AND qty <> '' AND (eta >= DATE '{SHEET_SINCE}' OR po_type = 'Open POs')""",
)
check(
    "po_cost_attach",
    "account_name:t record_id_num:i container_num:t sku:t asin:t qty:i sheet_duties:n",
    f"""SELECT p.account_name, p.record_id_num, p.container_num, p.sku, p.asin, p.qty, {money('c.duties')} AS sheet_duties
FROM {{po_records}} p LEFT JOIN {{sheet_cogs}} c ON lower(p.container_num) = lower(trim(c.container_num)) AND lower(p.sku) = lower(trim(c.sku))
  AND lower(p.asin) = lower(trim(c.asin)) AND CAST(p.qty AS VARCHAR) = trim(c.qty)""",
)
FACTORY_ACCOUNT = "North"
FACTORY = (
    "po_type", "record_id", "account_name", "sku", "asin", "qty", "unit_price", "invoice_amount", "deposit_sent", "balance_owed", "order_placed", "date_paid",
    "etd", "eta", "completion_date", "ready", "container_num", "remarks", "sheet_duties",
)
check(
    "factory_rows",
    "",
    f"""WITH both_sheets AS (SELECT 'Completed' AS po_type, * REPLACE (NULL AS remarks) FROM {{sheet_factory}}
  UNION ALL SELECT 'Open POs', * REPLACE (nullif(remarks, 'FALSE') AS remarks) FROM {{sheet_factory}}),
cleaned AS (SELECT * REPLACE (upper(sku) AS sku, {money('unit_price')} AS unit_price, CAST({money('qty')} AS INT) AS qty, {money('invoice_amount')} AS invoice_amount,
    {money('deposit_sent')} AS deposit_sent, {money('balance_owed')} AS balance_owed, {sheet_day("replace(eta, '.', '/')")} AS eta, {sheet_day("replace(etd, '.', '/')")} AS etd,
    {sheet_day("replace(order_placed, '.', '/')")} AS order_placed, {sheet_day("replace(date_paid, '.', '/')")} AS date_paid, coalesce(remarks, '') AS remarks,
    {sheet_day("CASE WHEN regexp_matches(done, '[A-Za-z]') THEN '' ELSE done END")} AS completion_date),
    coalesce(regexp_matches(done, '^[A-Za-z]+$'), false) AS ready
  FROM (SELECT *, trim(replace(replace(replace(replace(completion_date, '.', '/'), 'Ready', ''), '; no confirmation', ''), '  ', ' ')) AS done FROM both_sheets) WHERE qty <> ''),
kept AS (SELECT * FROM cleaned WHERE eta >= DATE '{SHEET_SINCE}' OR po_type = 'Open POs')
SELECT k.* EXCLUDE (done), '{FACTORY_ACCOUNT.upper()}' AS account_name, coalesce(CAST(p.record_id AS VARCHAR), '') AS record_id, coalesce(p.asin, '') AS asin, {money('c.duties')} AS sheet_duties
FROM kept k LEFT JOIN {{remote_products}} p ON lower(p.account_name) = lower('{FACTORY_ACCOUNT}') AND lower(p.sku) = lower(k.sku)
LEFT JOIN {{sheet_cogs}} c ON lower(k.container_num) = lower(trim(c.container_num)) AND lower(k.sku) = lower(trim(c.sku))
  AND lower(coalesce(p.asin, '')) = lower(trim(c.asin)) AND CAST(k.qty AS VARCHAR) = trim(c.qty)""",
)
check(
    "factory_po_feed",
    "account_name:t sku:t row_index:i payload:t",
    f"""SELECT account_name, sku, row_index, NULL AS payload FROM {{published_factory}} WHERE lower(account_name) <> lower('{FACTORY_ACCOUNT}')
UNION ALL SELECT account_name, sku, row_index, """
    + json(
        FACTORY,
        **{c: f"CAST({c} AS DECIMAL(12,2))" for c in ("unit_price", "invoice_amount", "deposit_sent", "balance_owed", "sheet_duties")},
        **{c: day(c) for c in ("order_placed", "date_paid", "etd", "eta", "completion_date")},
    )
    + " AS payload FROM {q_factory_rows}",
)
check(
    "split_refs",
    "row_index:i sku:t reference:t",
    """SELECT row_index, sku, trim(unnest(CASE WHEN contains(customer_ref, ',') THEN string_split(customer_ref, ',') ELSE string_split(customer_ref, '|') END)) AS reference FROM {sheet_po}""",
)


def document_rows(cogs: str, refs: str, freight: str) -> str:
    parts = [
        links(
            "COGS", "p.record_id_num", "p.fba_shipment_id", "k.cost_name", "0", "k.letter",
            cogs + """ r JOIN {po_records} p ON lower(p.container_num) = lower(trim(r.container_num)) AND lower(p.sku) = lower(trim(r.sku))
  AND lower(p.asin) = lower(trim(r.asin)) AND CAST(p.qty AS VARCHAR) = trim(r.qty)
CROSS JOIN (VALUES ('DUTIES', 'G'), ('CUSTOMS_FEES', 'J'), ('DEMURRAGE', 'K'), ('CONTAINER_COST', 'R'), ('TRUCKING_COST', 'S')) AS k(cost_name, letter)""",
        ),
        links("Freight Out", "NULL", "r.reference", "NULL", "1", "'I'", refs + " r"),
        links("Freight In", "p.record_id_num", "NULL", "NULL", "2", "'H'", freight + " r JOIN {po_records} p ON lower(p.container_num) = lower(r.customer_ref)"),
    ]
    return " UNION ALL ".join(parts)


DOCUMENT_COLUMNS = "document_type:t record_id:i fba_shipment_id:t cost_name:t url:t"
check("document_links", DOCUMENT_COLUMNS, document_rows("{sheet_cogs}", "{q_split_refs}", "{sheet_freight}"))

# The same sheets with rows numbered by their order in the file.
check(
    "sheet_cogs_numbered",
    "",
    """SELECT * REPLACE (row_number() OVER (ORDER BY row_index, container_num, sku, asin, qty, duties NULLS FIRST) - 1 AS row_index) FROM {sheet_cogs}""",
)
check(
    "sheet_refs_numbered",
    "",
    """SELECT row_index, trim(unnest(CASE WHEN contains(customer_ref, ',') THEN string_split(customer_ref, ',') ELSE string_split(customer_ref, '|') END)) AS reference
FROM (SELECT customer_ref, row_number() OVER (ORDER BY row_index) - 1 AS row_index FROM {sheet_po})""",
)
check("sheet_freight_numbered", "", "SELECT customer_ref, row_number() OVER (ORDER BY row_index) - 1 AS row_index FROM {sheet_freight}")
check("sheet_links", DOCUMENT_COLUMNS, document_rows("{q_sheet_cogs_numbered}", "{q_sheet_refs_numbered}", "{q_sheet_freight_numbered}"))

KINDS = {
    "t": "CAST({c} AS VARCHAR)",
    "i": "CAST({c} AS BIGINT)",
    "n": "CAST({c} AS DOUBLE)",
    "d": "CAST(CAST({c} AS DATE) AS VARCHAR)",
    "s": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
    "b": "CAST({c} AS BOOLEAN)",
}


def columns_of(name: str) -> dict[str, str]:
    return dict(c.split(":") for c in CHECKS[name][0].split())


def check_sql(name: str) -> str:
    """The check as one statement: its inputs as common table expressions, then the result."""
    parts: dict[str, str] = {}
    uses: Counter[str] = Counter()

    def resolve(key: str) -> str:
        if key in TABLES:
            return key
        name = f"v_{key}" if not key.startswith("q_") else key
        if name not in parts:
            text = CHECKS[key[2:]][1] if key.startswith("q_") else check_text(key)
            names = {n: resolve(n) for n in names_in(text)}
            uses.update(names[n] for n in names_in(text))
            parts[name] = text.format(**names)
        return name

    last = resolve(f"q_{name}")
    # A part that is named more than once is computed once.
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if uses[n] > 1 else ''}({t})" for n, t in parts.items())
    shown_columns = ", ".join(f"{KINDS[k].format(c=c)} AS {c}" for c, k in columns_of(name).items())
    return f"WITH {ctes}\nSELECT {shown_columns} FROM {last}"
