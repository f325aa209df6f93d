"""Input views over the given tables, as one SQL text that Spark and the check engine both run.

Names in braces are other views or the given tables. Rows that the other side lacks
(unpublished products, unmatched shipments) have a key of their own; no table is cut.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from sellerbooks.sources.tables import scan

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_PART_ACCOUNT = "CASE {k} % 3 WHEN 0 THEN 'North' WHEN 1 THEN 'South' ELSE 'West' END"
# An order of seven spells its account in capitals, inside the group of the others.
_VARIED = "CASE WHEN l_linenumber % 7 = 3 THEN upper({account}) ELSE {account} END"
_L_ACCOUNT = _PART_ACCOUNT.replace("{k}", "l_partkey")
_P_ACCOUNT = _PART_ACCOUNT.replace("{k}", "p_partkey")
_S_ACCOUNT = _PART_ACCOUNT.replace("{k}", "s_suppkey")
_NAMED = "CASE account_name WHEN 'acct0' THEN 'North' WHEN 'acct1' THEN 'South' ELSE 'West' END"
_SHEET_DAY = "concat(CAST(month({c}) AS STRING), '/', CAST(day({c}) AS STRING), '/', CAST(year({c}) AS STRING))"
_PRODUCT_OF = "concat('b0', CAST(CAST(substr({sku}, 5) AS BIGINT) % 5 AS STRING))"
_FEE_KINDS = ("Principal", "Commission", "FBAPerUnitFulfillmentFee", "ShippingTax")

VIEWS: dict[str, str] = {
    "all_listings": f"""
SELECT {_L_ACCOUNT} AS account_name, concat('b0', CAST(l_suppkey % 4 AS STRING)) AS asin1,
       concat('Sku-', CAST(l_partkey AS STRING)) AS seller_sku, CAST(l_shipdate AS DATE) AS open_date,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_orderkey AS listing_id, l_linenumber AS line_no
FROM {{lineitem}}""",
    "product_data": f"""
SELECT {_P_ACCOUNT} AS account_name, concat('Sku-', CAST(p_partkey AS STRING)) AS sku,
       concat('b0', CAST(p_partkey % 5 AS STRING)) AS asin, p_name AS itemname,
       CAST(p_retailprice AS DECIMAL(12,2)) AS list_price, p_type AS style, p_brand AS color, p_size AS size,
       CASE WHEN p_partkey % 7 = 0 THEN p_size ELSE 0 END AS starting_inventory
FROM {{part}}""",
    "remote_products": f"""
SELECT p_partkey AS record_id, upper({_P_ACCOUNT}) AS account_name,
       concat(CASE WHEN p_partkey % 4 = 0 THEN 'Other-' WHEN p_partkey % 3 = 0 THEN 'SKU-' ELSE 'Sku-' END, CAST(p_partkey AS STRING)) AS sku,
       upper(concat('b0', CAST(p_partkey % 5 AS STRING))) AS asin
FROM {{part}}""",
    "all_orders": f"""
SELECT {_VARIED.format(account=_L_ACCOUNT)} AS account_name,
       CASE WHEN l_orderkey % 50 = 0 THEN concat('S', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END AS amazon_order_id,
       concat('Sku-', CAST(l_partkey AS STRING)) AS sku, concat('b0', CAST(l_partkey % 5 AS STRING)) AS asin,
       CASE o_orderstatus WHEN 'F' THEN 'Shipped' WHEN 'O' THEN 'shipped' ELSE 'Cancelled' END AS order_status,
       CASE l_linestatus WHEN 'F' THEN 'Shipped' ELSE 'Unshipped' END AS item_status,
       CAST(l_quantity AS INT) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS item_price, o_orderdate AS purchase_date
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "fulfilled_shipments": f"""
SELECT {_VARIED.format(account=_L_ACCOUNT)} AS account_name,
       CASE WHEN l_orderkey % 5 = 0 THEN concat('X', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END AS amazon_order_id,
       concat('Sku-', CAST(l_partkey AS STRING)) AS sku, concat('SH', CAST(l_suppkey AS STRING)) AS shipment_id,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS item_price, CAST(l_quantity AS INT) AS quantity_shipped
FROM {{lineitem}} WHERE l_linestatus = 'F'""",
    "settlements": f"""
SELECT {_VARIED.format(account=_L_ACCOUNT)} AS account_name, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS settlement_id,
       CAST(l_orderkey AS STRING) AS order_id, concat('Sku-', CAST(l_partkey AS STRING)) AS sku,
       CASE l_returnflag WHEN 'N' THEN 'Order' WHEN 'R' THEN 'Refund' ELSE 'Chargeback Refund' END AS transaction_type,
       CASE WHEN l_returnflag = 'N' THEN concat('SH', CAST(l_suppkey AS STRING)) END AS shipment_id,
       concat('ADJ', CAST(l_suppkey AS STRING)) AS adjustment_id, CAST(l_shipdate AS DATE) AS posted_date,
       k.amount_description, CAST(l_quantity AS INT) AS quantity_purchased,
       CAST(CASE WHEN (k.amount_description = 'Principal') = (l_returnflag = 'N') THEN 1 ELSE -1 END
         * CAST(l_extendedprice AS DECIMAL(12,2)) * CASE WHEN l_orderkey % 97 = 0 THEN 3 ELSE 1 END
         * CASE k.amount_description WHEN 'Principal' THEN CAST(1 AS DECIMAL(4,2)) WHEN 'Commission' THEN CAST(l_discount AS DECIMAL(4,2)) ELSE CAST(l_tax AS DECIMAL(4,2)) END
         AS DECIMAL(16,4)) AS amount
FROM {{lineitem}} @FEE_KINDS@""",
    "finances": """
SELECT concat('acct', CAST(user_id % 3 AS STRING)) AS account_name, concat(CASE WHEN event_id % 8 = 0 THEN 'g' ELSE 'G' END, CAST(user_id % 20 AS STRING)) AS group_id,
       CASE WHEN event_type = 'error' THEN 'Reimbursement' END AS adjustmenttype,
       CASE WHEN event_type = 'purchase' THEN 'Principal' END AS chargetype,
       CASE WHEN event_type = 'click' THEN 'Commission' END AS feetype,
       CASE WHEN event_type = 'signup' THEN 'PromoDiscount' END AS promotiontype,
       CAST(CASE WHEN event_type IN ('click') OR event_id % 9 = 0 THEN -value ELSE value END AS DECIMAL(12,2)) AS currencyamount,
       ts AS posteddate, concat('Sku-', CAST(user_id AS STRING)) AS sellersku, CAST(event_id % 400 AS STRING) AS amazonorderid
FROM {events}""",
    "ledger_detail": """
SELECT concat('acct', CAST(user_id % 3 AS STRING)) AS account_name, CAST(ts AS DATE) AS date, concat('Sku-', CAST(user_id AS STRING)) AS msku,
       CASE event_type WHEN 'error' THEN 'Adjustments' WHEN 'purchase' THEN 'Shipments' WHEN 'view' THEN 'WhseTransfers' WHEN 'click' THEN 'Receipts' ELSE 'CustomerReturns' END AS event_type,
       CASE event_id % 4 WHEN 0 THEN CASE WHEN event_id % 8 = 0 THEN 'Defective' ELSE 'DEFECTIVE' END WHEN 1 THEN 'WAREHOUSE_DAMAGED' WHEN 2 THEN 'CUSTOMER_DAMAGED' ELSE 'SELLABLE' END AS disposition,
       CAST(event_id % 7 AS INT) - 3 AS quantity, CAST(event_id AS STRING) AS reference_id
FROM {events}""",
    "fba_returns": f"""
SELECT {_VARIED.format(account=_L_ACCOUNT)} AS account_name, CAST(l_orderkey AS STRING) AS order_id,
       concat('Sku-', CAST(l_partkey AS STRING)) AS sku, concat('b0', CAST(l_partkey % 5 AS STRING)) AS asin,
       CAST(l_shipdate AS DATE) AS return_date,
       CASE WHEN l_linenumber = 1 THEN 'Reimbursed' ELSE 'Unit returned to inventory' END AS status, CAST(l_quantity AS INT) AS quantity
FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "removals": f"""
SELECT {_L_ACCOUNT} AS account_name, CAST(l_orderkey AS STRING) AS order_id, concat('Sku-', CAST(l_partkey AS STRING)) AS sku,
       CAST(l_shipdate AS DATE) AS request_date, CASE WHEN l_linenumber % 2 = 0 THEN 'Return' ELSE 'Disposal' END AS removal_order_type,
       'Sellable' AS disposition, CAST(l_quantity AS INT) - 1 AS shipped_quantity
FROM {{lineitem}} WHERE l_returnflag = 'A' AND l_linestatus = 'F'""",
    "po_data": f"""
SELECT {_L_ACCOUNT} AS account_name, l_orderkey * 10 + l_linenumber AS record_id_num,
       concat('Sku-', CAST(l_partkey AS STRING)) AS sku, concat('b0', CAST(l_partkey % 5 AS STRING)) AS asin,
       CASE WHEN l_linenumber = 7 THEN '' ELSE concat('FBA', CAST(l_suppkey AS STRING)) END AS fba_shipment_id,
       CASE WHEN l_orderkey % 11 = 0 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS eta,
       CASE WHEN l_linenumber % 5 = 0 THEN 'Open POs' ELSE 'Completed' END AS po_status,
       CAST(l_quantity AS INT) * 3 AS qty, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price, CAST(l_tax * 100 AS DECIMAL(12,2)) AS duties
FROM {{lineitem}} WHERE l_linestatus = 'O' AND l_returnflag = 'N'""",
    "sheet_po": """
SELECT o_orderkey AS row_index, concat('Sku-', CAST(o_custkey AS STRING)) AS sku, concat('$', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)) AS unit_price,
       CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE CAST(o_custkey % 90 AS STRING) END AS qty,
       CASE o_orderkey % 5 WHEN 0 THEN 'Ready' WHEN 1 THEN '' WHEN 2 THEN concat(CAST(month(o_orderdate) AS STRING), '.', CAST(day(o_orderdate) AS STRING), '.', CAST(year(o_orderdate) AS STRING))
            WHEN 3 THEN concat(CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING)) ELSE '13/45/2020' END AS completion_date,
       CASE o_orderkey % 3 WHEN 0 THEN concat('FBA', CAST(o_custkey AS STRING), ', FBA', CAST(o_orderkey AS STRING))
            WHEN 1 THEN concat('FBA', CAST(o_custkey AS STRING), '|FBA', CAST(o_orderkey AS STRING)) ELSE concat(' FBA', CAST(o_custkey AS STRING)) END AS customer_ref
FROM {orders}""",
    "ledger_summary": """
SELECT account_name, date, concat('FN', msku) AS fnsku, concat('b0', CAST(length(msku) AS STRING)) AS asin, msku, disposition,
       SUM(quantity * 2) AS starting_warehouse_balance,
       SUM(CASE WHEN event_type = 'Receipts' THEN quantity ELSE 0 END) AS receipts,
       SUM(CASE WHEN event_type = 'Adjustments' AND quantity < 0 THEN quantity ELSE 0 END) AS vendor_returns,
       SUM(CASE WHEN event_type = 'Adjustments' AND quantity > 0 THEN quantity ELSE 0 END) AS found,
       SUM(CASE WHEN quantity = -1 THEN 1 ELSE 0 END) AS lost, SUM(CASE WHEN quantity = -2 THEN 1 ELSE 0 END) AS damaged,
       SUM(CASE WHEN quantity = -3 THEN 1 ELSE 0 END) AS disposed, SUM(CASE WHEN event_type = 'WhseTransfers' THEN quantity ELSE 0 END) AS other_events,
       CAST(NULL AS BIGINT) AS unknown_events,
       SUM(CASE WHEN event_type = 'Shipments' THEN quantity ELSE 0 END) AS customer_shipments,
       SUM(CASE WHEN event_type = 'CustomerReturns' THEN quantity ELSE 0 END) AS customer_returns,
       SUM(quantity) AS ending_warehouse_balance
FROM {ledger_detail} GROUP BY account_name, date, msku, disposition""",
    "inventory": """
SELECT DISTINCT concat('acct', CAST(user_id % 3 AS STRING)) AS account_name, concat('Sku-', CAST(user_id AS STRING)) AS sku,
       concat('b0', CAST(length(concat('Sku-', CAST(user_id AS STRING))) AS STRING)) AS asin, 'New' AS condition,
       CASE WHEN user_id % 4 = 0 THEN NULL ELSE user_id END AS afn_inbound_working_quantity,
       CASE WHEN user_id % 5 = 0 THEN NULL ELSE 2 END AS afn_inbound_shipped_quantity, 1 AS afn_inbound_receiving_quantity,
       user_id + 10 AS afn_total_quantity
FROM {events}""",
    "reserved_inventory": """
SELECT account_name, CASE WHEN afn_total_quantity % 3 = 0 THEN concat('No', sku) ELSE sku END AS sku, sku AS stock_sku, asin, afn_total_quantity - 9 AS reserved_qty
FROM {inventory}""",
    "records_raw": """
SELECT p_partkey AS record_id, concat('{{"3":{{"value":"', CAST(p_partkey AS STRING), '"}},"6":{{"value":"', p_brand, '"}},"7":{{"value":',
       CASE WHEN p_partkey % 9 = 0 THEN 'null' ELSE concat('"', p_type, '"') END, '}}}}') AS record
FROM {part}""",
    # Rows of a saved report, a field of each type; cells are missing, blank, numbers, days and flags.
    "report_rows": """
SELECT p_partkey AS record_id, concat('{{"3":{{"value":', CAST(p_partkey AS STRING), '}},"6":{{"value":"', p_brand, '"}},"7":{{"value":',
       CASE WHEN p_partkey % 9 = 0 THEN 'null' ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) END, '}},"8":{{"value":"',
       CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('20', CAST(10 + p_size % 15 AS STRING), '-0', CAST(1 + p_size % 9 AS STRING), '-1', CAST(p_size % 9 AS STRING)) END,
       '"}},"9":{{"value":', CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END, '}}}}') AS record
FROM {part}""",
    "sheet_cogs": """
SELECT l_orderkey * 10 + l_linenumber AS row_index, concat(CASE WHEN l_orderkey % 3 = 0 THEN ' C' ELSE ' D' END, CAST(l_suppkey AS STRING), ' ') AS container_num, concat('Sku-', CAST(l_partkey AS STRING), ' ') AS sku,
       concat('b0', CAST(l_partkey % 5 AS STRING)) AS asin, CAST(CAST(l_quantity AS INT) * 3 AS STRING) AS qty,
       CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE concat('$1,', CAST(200 + l_linenumber AS STRING), '.50') END AS duties
FROM {lineitem} WHERE l_linestatus = 'O' AND l_returnflag = 'N'""",
    "sheet_factory": f"""
SELECT l_orderkey * 10 + l_linenumber AS row_index, concat('Sku-', CAST(l_partkey AS STRING)) AS sku, concat('$', CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)) AS unit_price,
       CASE WHEN l_orderkey % 13 = 0 THEN '' ELSE CAST(CAST(l_quantity AS INT) * 3 AS STRING) END AS qty,
       CASE l_orderkey % 3 WHEN 0 THEN 'Ready' WHEN 1 THEN 'pending' ELSE {_SHEET_DAY.format(c="l_shipdate")} END AS completion_date,
       {_SHEET_DAY.format(c="l_shipdate")} AS eta, CASE WHEN l_orderkey % 7 = 0 THEN 'soon' ELSE replace({_SHEET_DAY.format(c="l_shipdate")}, '/', '.') END AS etd,
       {_SHEET_DAY.format(c="l_shipdate")} AS order_placed, CASE WHEN l_linenumber = 2 THEN NULL ELSE {_SHEET_DAY.format(c="l_shipdate")} END AS date_paid,
       concat('$1,', CAST(100 + l_linenumber AS STRING), '.25') AS invoice_amount, CASE WHEN l_linenumber = 3 THEN 'free' ELSE '$50' END AS deposit_sent, '' AS balance_owed,
       concat('C', CAST(l_suppkey AS STRING)) AS container_num, CASE WHEN l_linenumber = 4 THEN 'FALSE' ELSE 'by sea' END AS remarks
FROM {{lineitem}} WHERE l_linestatus = 'O' AND l_returnflag = 'N'""",
    "published_factory": """
SELECT account_name, sku, record_id_num AS row_index FROM {po_data}""",
    "published_settlements": """
SELECT DISTINCT CASE WHEN settlement_id % 2 = 0 THEN CAST(settlement_id AS STRING) ELSE concat('other-', CAST(settlement_id AS STRING)) END AS settlement_id,
       CASE WHEN settlement_id % 3 = 0 THEN 'Open' ELSE 'Posted' END AS status FROM {settlements}""",
    "inbound_shipments": f"""
SELECT {_S_ACCOUNT} AS account_name, concat('SH', CAST(s_suppkey AS STRING)) AS shipmentid, s_name AS shipmentname,
       CASE s_suppkey % 4 WHEN 0 THEN 'WORKING' WHEN 1 THEN 'SHIPPED' WHEN 2 THEN 'CLOSED' ELSE 'RECEIVING' END AS shipmentstatus
FROM {{supplier}} UNION ALL
SELECT 'North', 'SH0', 'same-side duplicate', 'CLOSED' FROM {{supplier}} WHERE s_suppkey = 0""",
    "remote_shipments": f"""
SELECT {_S_ACCOUNT} AS account_name, concat('SH', CAST(s_suppkey * 2 AS STRING)) AS shipmentid FROM {{supplier}}""",
    # Published shipments with the state they were published in; some may still change.
    "published_shipments": """
SELECT r.account_name, r.shipmentid, CASE CAST(substr(r.shipmentid, 3) AS BIGINT) % 3 WHEN 0 THEN 'CLOSED' WHEN 1 THEN 'Receiving' ELSE 'WORKING' END AS shipmentstatus
FROM {remote_shipments} r""",
    # Wider inputs: the views above with the remaining columns the plans read.
    "products": """
SELECT account_name, sku, asin, concat('par', CAST(size % 9 AS STRING)) AS asins, itemname, list_price, style, color, size
FROM {product_data}""",
    "product_records": """
SELECT account_name, sku, asin, CAST(substr(sku, 5) AS BIGINT) AS record_id_num, starting_inventory FROM {product_data}""",
    "stock": f"""
SELECT {_NAMED} AS account_name, sku, {_PRODUCT_OF.format(sku="sku")} AS asin, concat('FN', sku) AS fnsku, condition,
       CAST(afn_total_quantity * 2 AS DECIMAL(12,2)) AS your_price, 'No' AS mfn_listing_exists, 'Yes' AS afn_listing_exists,
       0 AS mfn_fulfillable_quantity, afn_total_quantity - 1 AS afn_warehouse_quantity, afn_total_quantity - 2 AS afn_fulfillable_quantity,
       1 AS afn_unsellable_quantity, afn_inbound_working_quantity, afn_inbound_shipped_quantity, afn_inbound_receiving_quantity,
       0 AS afn_researching_quantity, afn_total_quantity
FROM {{inventory}}""",
    "stock_reserved": f"""
SELECT {_NAMED} AS account_name, sku, {_PRODUCT_OF.format(sku="stock_sku")} AS asin, reserved_qty, reserved_qty - 1 AS reserved_customerorders,
       1 AS reserved_fc_transfers, 0 AS reserved_fc_processing
FROM {{reserved_inventory}}""",
    "stock_summary": f"""
SELECT {_NAMED} AS account_name, date, fnsku, {_PRODUCT_OF.format(sku="msku")} AS asin, msku, concat('Title ', msku) AS title, disposition,
       starting_warehouse_balance, receipts, customer_shipments, customer_returns, vendor_returns, found, lost, damaged, disposed, other_events,
       unknown_events, ending_warehouse_balance
FROM {{ledger_summary}}""",
    "stock_movements": f"""
SELECT {_NAMED} AS account_name, date, msku, {_PRODUCT_OF.format(sku="msku")} AS asin, event_type, disposition, quantity, reference_id
FROM {{ledger_detail}}""",
    "finance_events": f"""
SELECT {_NAMED} AS account_name, group_id, adjustmenttype, chargetype, feetype, promotiontype, 'USD' AS currencycode, currencyamount,
       CASE WHEN chargetype IS NOT NULL THEN length(sellersku) - 4 END AS quantity, posteddate, sellersku, amazonorderid
FROM {{finances}}""",
    "settlement_lines": """
SELECT account_name, settlement_id, order_id, sku, transaction_type, shipment_id, adjustment_id, posted_date, amount_description,
       CASE WHEN amount_description IN ('Commission', 'FBAPerUnitFulfillmentFee') THEN 'ItemFees' ELSE 'ItemPrice' END AS amount_type,
       'USD' AS currency, CAST(settlement_id AS DECIMAL(16,4)) AS total_amount, quantity_purchased, amount,
       CAST(concat(substr(CAST(settlement_id AS STRING), 1, 4), '-', substr(CAST(settlement_id AS STRING), 5, 2), '-01') AS DATE) AS settlement_start_date,
       last_day(posted_date) AS settlement_end_date
FROM {settlements}""",
    "order_items": """
SELECT account_name, amazon_order_id, concat('M', amazon_order_id) AS merchant_order_id, sku, asin, order_status, item_status, quantity, item_price,
       CAST(quantity AS DECIMAL(12,2)) AS item_tax, 'USD' AS currency, concat('City ', asin) AS ship_city, purchase_date
FROM {all_orders}""",
    "returned_items": """
SELECT account_name, order_id, sku, asin, concat('Name ', sku) AS product_name, return_date, status, quantity FROM {fba_returns}""",
    "po_records": """
SELECT account_name, record_id_num, sku, asin, fba_shipment_id, eta, po_status, qty, unit_price, duties,
       CAST(duties + 1 AS DECIMAL(12,2)) AS customs_fees, CAST(duties + 2 AS DECIMAL(12,2)) AS demurrage,
       CAST(duties + 3 AS DECIMAL(12,2)) AS container_cost, CAST(duties + 4 AS DECIMAL(12,2)) AS trucking_cost,
       CASE WHEN fba_shipment_id = '' THEN NULL ELSE concat('C', substr(fba_shipment_id, 4)) END AS container_num
FROM {po_data}""",
    "order_records": """
SELECT account_name AS source, amazon_order_id, asin, sku, order_status, CAST(min(quantity) * 1000 + count(*) AS BIGINT) AS record_id_num
FROM {all_orders} GROUP BY account_name, amazon_order_id, asin, sku, order_status""",
    "inbound_details": """
SELECT account_name, shipment_id AS shipmentid, sku AS sellersku,
       CASE WHEN min(quantity_shipped) > 25 THEN concat('B0', substr(sku, 5)) ELSE concat('X0', substr(sku, 5)) END AS fulfillmentnetworksku,
       CAST(sum(quantity_shipped) AS BIGINT) AS quantityshipped, CAST(count(*) AS BIGINT) AS quantityreceived, min(quantity_shipped) AS quantityincase,
       CASE WHEN min(quantity_shipped) > 40 THEN NULL ELSE CAST('1999-05-01' AS DATE) END AS releasedate
FROM {fulfilled_shipments} GROUP BY account_name, shipment_id, sku""",
    "remote_details": """
SELECT upper(d.account_name) AS account_name, d.shipmentid, upper(d.sellersku) AS sku, d.fulfillmentnetworksku AS fnsku,
       concat('B0', CAST(CAST(substr(d.sellersku, 5) AS BIGINT) % 5 AS STRING)) AS asin, CAST(substr(d.sellersku, 5) AS BIGINT) + 7 AS record_id
FROM {inbound_details} d JOIN {remote_shipments} r ON lower(d.account_name) = lower(r.account_name) AND d.shipmentid = r.shipmentid""",
    "published_details": """
SELECT d.account_name, d.shipmentid, d.sku, d.fnsku, p.shipmentstatus
FROM {remote_details} d JOIN (SELECT DISTINCT account_name, shipmentid, shipmentstatus FROM {published_shipments}) p
  ON lower(d.account_name) = lower(p.account_name) AND d.shipmentid = p.shipmentid""",
    "inbound_transport": """
SELECT account_name, shipmentid, 'SP' AS shipmenttype, concat('TRK', shipmentid) AS trackingid, shipmentstatus AS transportstatus,
       CASE WHEN shipmentstatus = 'CLOSED' THEN NULL ELSE 'Carrier' END AS carriername, CAST(length(shipmentname) AS DECIMAL(12,2)) AS value,
       'USD' AS currencycode, length(shipmentid) AS weight_value, 'POUNDS' AS weight_unit, shipmentstatus AS packagestatus
FROM {inbound_shipments}""",
    "inbound_report": """
SELECT f.account_name, f.shipment_id AS shipmentid, f.sku AS sellersku, concat('FN', f.sku) AS fulfillmentnetworksku,
       f.quantity_shipped AS quantityshipped, f.quantity_shipped - 1 AS quantityreceived, s.shipmentstatus, f.item_price AS value,
       CASE WHEN f.quantity_shipped = 7 THEN NULL ELSE CAST('1999-01-01' AS DATE) END AS date, f.quantity_shipped AS quantity, s.shipmentname,
       CAST(f.quantity_shipped + 1 AS DECIMAL(12,2)) AS cost_per_unit, f.quantity_shipped * 2 AS running_quantity, CAST(f.item_price AS DECIMAL(12,2)) AS receipt_cost
FROM {fulfilled_shipments} f LEFT JOIN {inbound_shipments} s
  ON lower(f.account_name) = lower(s.account_name) AND f.shipment_id = s.shipmentid AND s.shipmentname <> 'same-side duplicate'""",
    "published_fees": """
SELECT DISTINCT account_name, settlement_id, transaction_type, CASE WHEN transaction_type = 'Order' THEN 'Posted' ELSE 'Open' END AS status
FROM {settlements}""",
    "sheet_freight": """
SELECT s_suppkey AS row_index, concat('C', CAST(s_suppkey AS STRING)) AS customer_ref FROM {supplier}""",
}

_KIND_ROWS = ", ".join(f"('{k}')" for k in _FEE_KINDS)
_KIND_LIST = ", ".join(f"'{k}'" for k in _FEE_KINDS)


def names_in(text: str) -> list[str]:
    return [field for _, field, _, _ in string.Formatter().parse(text) if field]


def spark_text(view: str) -> str:
    # One generator per row; the other engine spells the same as a join with a value list.
    return VIEWS[view].replace("@FEE_KINDS@", f"LATERAL VIEW explode(array({_KIND_LIST})) k AS amount_description")


def check_text(view: str) -> str:
    return VIEWS[view].replace("@FEE_KINDS@", f"CROSS JOIN (VALUES {_KIND_ROWS}) AS k(amount_description)")


class Inputs:
    """The views of one data folder, each built once and lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._built = spark, folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEWS and name not in TABLES:
            raise AttributeError(name)
        if name not in self._built:
            if name in TABLES:
                self._built[name] = scan(self.spark, self.folder, name)
            else:
                text = spark_text(name)
                parts = {n: getattr(self, n) for n in names_in(text)}
                self._built[name] = self.spark.sql(text, **parts)
        return self._built[name]
