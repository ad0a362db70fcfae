"""SQL building blocks of the independent checks, in DuckDB's dialect.

``sql`` closes a body over the named relations it uses and fixes the output types.
"""

from __future__ import annotations

import re


def rnd(x: str, digits: int) -> str:
    """Half-up on the shortest decimal form of a double."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def title(x: str) -> str:
    runs = f"regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)')"
    return f"array_to_string(list_transform({runs}, lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || w[2:]), '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def zip5(x: str) -> str:
    return f"CASE WHEN length({x}) < 5 THEN lpad({x}, 5, '0') ELSE {x} END"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


REL: dict[str, str] = {
    # ---- star schema over the given tables ----------------------------------------------
    "fact": """
        SELECT l_orderkey AS order_id, l_linenumber AS item, l_partkey AS product, l_suppkey AS seller,
               o_custkey AS customer, o_orderdate AS day,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS dkey,
               CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS ym,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS status,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'boleto'
                    WHEN '3' THEN 'voucher' WHEN '4' THEN 'debit_card' ELSE 'not_defined' END AS paytype,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS freight,
               CAST(o_totalprice AS DECIMAL(18,2)) AS paid,
               CAST(ceil(l_quantity / 10) AS INTEGER) AS score,
               CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS days
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "done": "SELECT * FROM fact WHERE status = 'delivered'",
    "cust": "SELECT c_custkey AS customer, c_mktsegment AS city, n_name AS state FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
    "sell": "SELECT s_suppkey AS seller, s_name AS city, n_name AS state FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey",
    "months": """
        SELECT ym, ym // 100 AS y, ym % 100 AS m, strftime(min(day), '%Y-%m') AS label,
               SUM(price) AS rev, COUNT(DISTINCT order_id) AS n
        FROM done GROUP BY ym""",
    "persons": """
        SELECT customer, MIN(ym) AS first_ym, MIN(dkey) AS first_key, MAX(dkey) AS last_key, MAX(day) AS last_day,
               COUNT(DISTINCT order_id) AS n, SUM(price) AS spent
        FROM done JOIN cust USING (customer) GROUP BY customer""",
    "active": """
        SELECT d.customer, d.ym, p.first_ym, SUM(d.price) AS rev
        FROM done d JOIN persons p ON p.customer = d.customer GROUP BY ALL""",
    "grid": """
        SELECT first_ym AS cohort, (ym // 100 - first_ym // 100) * 12 + ym % 100 - first_ym % 100 AS age,
               COUNT(*) AS n, SUM(rev) AS rev
        FROM active
        WHERE first_ym IN (SELECT DISTINCT first_ym FROM persons ORDER BY 1 LIMIT 12)
        GROUP BY ALL HAVING age BETWEEN 0 AND 11""",
    "sellers": """
        SELECT seller, s.city, s.state, SUM(price) AS rev
        FROM done JOIN sell s USING (seller) GROUP BY ALL HAVING SUM(price) > 0""",
    "products": """
        SELECT p_partkey AS product, coalesce(p_type, p_brand, 'Unknown') AS category, SUM(price) AS rev
        FROM done JOIN part ON p_partkey = product GROUP BY ALL""",
    "pareto": """
        SELECT seller, city, state, rev, ROW_NUMBER() OVER w AS place,
               SUM(rev) OVER (w ROWS UNBOUNDED PRECEDING) AS cum, SUM(rev) OVER () AS total,
               PERCENT_RANK() OVER (ORDER BY rev DESC) AS pr
        FROM sellers WINDOW w AS (ORDER BY rev DESC, seller)""",
    "gaps": """
        SELECT order_id, SUM(price) + SUM(freight) AS inv, MAX(paid) AS paid, COUNT(*) AS n,
               MAX(paid) - (SUM(price) + SUM(freight)) AS delta
        FROM fact GROUP BY order_id""",
    # ---- raw datasets ----------------------------------------------------------------------
    "lines": """
        SELECT l_orderkey AS ok, l_linenumber AS ln, MIN(l_partkey) AS part, MIN(l_suppkey) AS supp,
               MIN(l_shipdate) AS shipped, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount,
               MIN(l_discount) AS disc, MIN(l_tax) AS tax, MIN(l_returnflag) AS flag, MIN(l_linestatus) AS ls,
               MAX(l_quantity) AS qty,
               CAST(ROUND(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) * CAST(MIN(l_tax) AS DECIMAL(4,2)), 2) AS DECIMAL(28,2)) AS freight
        FROM lineitem GROUP BY ALL""",
    "raw_items": """
        SELECT 'o' || ok AS order_id, ln AS item, 'p' || part AS product_id, 's' || supp AS seller_id,
               strftime(shipped, '%Y-%m-%d 00:00:00') AS limit_date,
               CASE WHEN flag = 'A' AND disc = 0.1 THEN -amount ELSE amount END AS price, freight
        FROM lines""",
    "raw_pays": """
        SELECT 'o' || ok AS order_id, ln AS seq,
               CASE WHEN flag = 'A' AND tax = 0.08 THEN 'bitcoin' WHEN flag = 'A' AND ls = 'F' THEN ' credit_card'
                    WHEN flag = 'A' THEN 'debit_card ' WHEN flag = 'N' THEN 'boleto' ELSE 'voucher' END AS kind,
               CAST(ceil(qty / 10) AS INTEGER) AS inst,
               CASE WHEN qty = 1 THEN 0 ELSE amount + freight +
                    CASE disc WHEN 0.0 THEN -15.50 WHEN 0.01 THEN 0.50 WHEN 0.02 THEN 0.01 WHEN 0.03 THEN 25.00
                              WHEN 0.04 THEN 75.00 WHEN 0.05 THEN -5.00 WHEN 0.06 THEN -0.50 ELSE 0 END END AS val
        FROM lines""",
    "raw_reviews": """
        SELECT 'r' || event_id AS review_id, 'o' || user_id AS order_id, CAST(floor(value / 40) AS INTEGER) AS score,
               CASE WHEN event_type <> 'click' THEN '  ' || event_type || ' ' END AS title,
               CASE WHEN event_type IN ('view', 'purchase') THEN props END AS message,
               strftime(ts, '%Y-%m-%d 00:00:00') AS created, strftime(ts, '%Y-%m-%d %H:%M:%S') AS answered
        FROM events""",
    "raw_orders": """
        SELECT 'o' || o_orderkey AS order_id, 'c' || o_orderkey AS customer_id,
               CASE WHEN o_orderstatus = 'F' THEN ' delivered ' WHEN o_orderstatus = 'O' THEN 'shipped'
                    WHEN o_orderpriority = '5-LOW' THEN 'lost' WHEN o_orderpriority = '1-URGENT' THEN 'canceled'
                    ELSE 'processing' END AS status,
               strftime(o_orderdate, '%Y-%m-%d 10:30:00') AS bought,
               CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN 'n/a'
                    ELSE strftime(o_orderdate, '%Y-%m-%d 11:00:00') END AS approved,
               CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d 08:00:00') END AS carrier,
               CASE WHEN o_orderstatus = 'F' THEN
                    strftime(o_orderdate + to_days(CAST(o_custkey % 40 + 3 AS INTEGER)), '%Y-%m-%d 18:45:30') END AS arrived,
               strftime(o_orderdate + INTERVAL 20 DAY, '%Y-%m-%d 00:00:00') AS estimated
        FROM orders""",
    "raw_customers": """
        SELECT 'c' || o_orderkey AS customer_id, 'u' || o_custkey AS person,
               CAST(CAST(floor(sqrt(c_custkey)) AS BIGINT) + CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS VARCHAR) AS zip,
               '  ' || lower(n_name) || ' ' || chr(9) AS city, lower(left(c_mktsegment, 2)) AS state
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "raw_geo": """
        SELECT CAST(CAST(floor(sqrt(c_custkey)) AS BIGINT) AS VARCHAR) AS zip,
               c_acctbal / 200.0::DOUBLE - 30.0::DOUBLE AS lat, c_acctbal / -300.0::DOUBLE - c_nationkey AS lng,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN ' ' || lower(n_name) END AS city,
               lower(left(c_mktsegment, 2)) AS state
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "raw_products": """
        SELECT 'p' || p_partkey AS product_id, CASE WHEN p_type <> 'PROMO' THEN ' ' || lower(p_type) END AS category,
               CASE WHEN p_size <= 45 THEN CAST(length(p_name) AS DOUBLE) END AS name_len,
               CASE WHEN p_size >= 3 THEN p_size * 10.0::DOUBLE END AS desc_len,
               CASE WHEN p_size <= 40 THEN CAST(p_size AS DOUBLE) END AS photos,
               CASE WHEN p_size <> 7 THEN p_retailprice END AS weight,
               p_size + 0.5::DOUBLE AS length, CASE WHEN p_size >= 10 THEN p_size / 2.0::DOUBLE END AS height,
               p_retailprice / 10.0::DOUBLE AS width
        FROM part""",
    "raw_sellers": """
        SELECT 's' || s_suppkey AS seller_id, CAST(CAST(floor(sqrt(s_suppkey)) AS BIGINT) + 30 AS VARCHAR) AS zip,
               lower(n_name) || '  ' AS city, lower(left(n_name, 2)) AS state
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "raw_names": """
        SELECT DISTINCT lower(p_type) AS pt, lower(p_type) || '_en' AS en FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')""",
    # ---- cleaned datasets ----------------------------------------------------------------------
    "orders2": f"""
        SELECT order_id, customer_id, {strip('status')} AS status, TRY_CAST(bought AS TIMESTAMP) AS bought,
               TRY_CAST(approved AS TIMESTAMP) AS approved, TRY_CAST(carrier AS TIMESTAMP) AS carrier,
               TRY_CAST(arrived AS TIMESTAMP) AS arrived, TRY_CAST(estimated AS TIMESTAMP) AS estimated
        FROM raw_orders
        WHERE {strip('status')} IN ('delivered', 'shipped', 'canceled', 'unavailable', 'invoiced', 'processing', 'created', 'approved')""",
    "items2": """
        SELECT order_id, item, product_id, seller_id, limit_date, CASE WHEN price < 0 THEN 0 ELSE price END AS price,
               CASE WHEN freight < 0 THEN 0 ELSE freight END AS freight FROM raw_items""",
    "pays2": f"""
        SELECT order_id, seq, {strip('kind')} AS kind, inst, CASE WHEN val < 0 THEN 0 ELSE val END AS val
        FROM raw_pays WHERE {strip('kind')} IN ('credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined')""",
    "reviews2": f"""
        SELECT review_id, order_id, LEAST(GREATEST(score, 1), 5) AS score, coalesce({strip('title')}, '') AS title,
               coalesce({strip('message')}, '') AS message, CAST(created AS TIMESTAMP) AS created,
               CAST(answered AS TIMESTAMP) AS answered
        FROM raw_reviews""",
    "customers2": f"SELECT customer_id, person, {zip5('zip')} AS zip, {title(strip('city'))} AS city, upper(state) AS state FROM raw_customers",
    "sellers2": f"SELECT seller_id, {zip5('zip')} AS zip, {title(strip('city'))} AS city, upper(state) AS state FROM raw_sellers",
    "places": f"SELECT {zip5('zip')} AS zip, lat, lng, {title(strip('city'))} AS city, upper(state) AS state FROM raw_geo",
    "geo2": """
        SELECT z.zip, la.v AS lat, lo.v AS lng, coalesce(c.v, 'unknown') AS city, coalesce(s.v, 'unknown') AS state
        FROM (SELECT DISTINCT zip FROM places) z
        LEFT JOIN (SELECT zip, MIN(x) + (MAX(x) - MIN(x)) * 0.5 AS v FROM
                   (SELECT zip, lat AS x, ROW_NUMBER() OVER (PARTITION BY zip ORDER BY lat) AS i, COUNT(*) OVER (PARTITION BY zip) AS n FROM places)
                   WHERE i IN ((n + 1) // 2, n // 2 + 1) GROUP BY zip) la ON la.zip = z.zip
        LEFT JOIN (SELECT zip, MIN(x) + (MAX(x) - MIN(x)) * 0.5 AS v FROM
                   (SELECT zip, lng AS x, ROW_NUMBER() OVER (PARTITION BY zip ORDER BY lng) AS i, COUNT(*) OVER (PARTITION BY zip) AS n FROM places)
                   WHERE i IN ((n + 1) // 2, n // 2 + 1) GROUP BY zip) lo ON lo.zip = z.zip
        LEFT JOIN (SELECT zip, city AS v FROM places WHERE city IS NOT NULL GROUP BY zip, city
                   QUALIFY ROW_NUMBER() OVER (PARTITION BY zip ORDER BY COUNT(*) DESC, city) = 1) c ON c.zip = z.zip
        LEFT JOIN (SELECT zip, state AS v FROM places WHERE state IS NOT NULL GROUP BY zip, state
                   QUALIFY ROW_NUMBER() OVER (PARTITION BY zip ORDER BY COUNT(*) DESC, state) = 1) s ON s.zip = z.zip""",
    "named": f"""
        SELECT product_id, coalesce({strip('category')}, 'unknown') AS pt, coalesce(en, 'unknown') AS en,
               name_len, desc_len, photos, weight, length, height, width
        FROM raw_products LEFT JOIN raw_names ON pt = {strip('category')}""",
    "products2": """
        SELECT product_id, pt, en,
               coalesce(name_len, (SELECT median(name_len) FROM named)) AS name_len,
               coalesce(desc_len, (SELECT median(desc_len) FROM named)) AS desc_len,
               coalesce(photos, (SELECT median(photos) FROM named)) AS photos,
               coalesce(weight, (SELECT median(weight) FROM named)) AS weight,
               coalesce(length, (SELECT median(length) FROM named)) AS length,
               coalesce(height, (SELECT median(height) FROM named)) AS height,
               coalesce(width, (SELECT median(width) FROM named)) AS width
        FROM named""",
    # ---- warehouse ---------------------------------------------------------------------------
    "dates": """
        SELECT DISTINCT CAST(unnest([bought, approved, carrier, arrived, estimated]) AS DATE) AS d FROM orders2""",
    "dim_geo": "SELECT ROW_NUMBER() OVER (ORDER BY zip) AS geo_key, * FROM geo2",
    "dim_cust": """
        SELECT ROW_NUMBER() OVER (ORDER BY customer_id) AS customer_key, customer_id, person, geo_key, c.city, c.state
        FROM customers2 c LEFT JOIN dim_geo g ON g.zip = c.zip""",
    "dim_sell": """
        SELECT ROW_NUMBER() OVER (ORDER BY seller_id) AS seller_key, seller_id, geo_key, s.city, s.state
        FROM sellers2 s LEFT JOIN dim_geo g ON g.zip = s.zip""",
    "dim_prod": "SELECT ROW_NUMBER() OVER (ORDER BY product_id) AS product_key, * FROM products2",
    "pay_mode": """
        SELECT order_id, kind FROM pays2 GROUP BY order_id, kind
        QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY COUNT(*) DESC, kind) = 1""",
    "pay_sum": "SELECT order_id, SUM(val) AS paid FROM pays2 GROUP BY order_id",
    "last_review": """
        SELECT order_id, score FROM reviews2
        QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY created DESC NULLS LAST, answered DESC NULLS LAST, review_id DESC) = 1""",
    "wfact": """
        SELECT i.order_id, i.item, CAST(strftime(o.bought, '%Y%m%d') AS INTEGER) AS dkey, c.customer_key, s.seller_key,
               p.product_key, c.geo_key AS cgeo, s.geo_key AS sgeo, o.status, i.price, i.freight, ps.paid, pm.kind, r.score,
               date_diff('second', o.bought, o.arrived) / 86400.0::DOUBLE AS days,
               date_diff('second', o.bought, o.estimated) / 86400.0::DOUBLE AS est
        FROM items2 i
        LEFT JOIN orders2 o ON o.order_id = i.order_id
        LEFT JOIN pay_sum ps ON ps.order_id = i.order_id
        LEFT JOIN pay_mode pm ON pm.order_id = i.order_id
        LEFT JOIN last_review r ON r.order_id = i.order_id
        LEFT JOIN dim_cust c ON c.customer_id = o.customer_id
        LEFT JOIN dim_sell s ON s.seller_id = i.seller_id
        LEFT JOIN dim_prod p ON p.product_id = i.product_id""",
    "wgaps": """
        SELECT order_id, status, kind, SUM(price) + SUM(freight) AS inv, MAX(paid) AS paid, COUNT(*) AS n,
               MAX(paid) - (SUM(price) + SUM(freight)) AS delta
        FROM wfact GROUP BY order_id, status, kind""",
    "rgaps": """
        SELECT i.order_id, i.inv, p.paid, p.paid - i.inv AS delta, p.inst, m.kind
        FROM (SELECT order_id, SUM(price) + SUM(freight) AS inv FROM raw_items GROUP BY order_id) i
        JOIN (SELECT order_id, SUM(val) AS paid, MAX(inst) AS inst FROM raw_pays GROUP BY order_id) p ON p.order_id = i.order_id
        JOIN (SELECT order_id, kind FROM raw_pays GROUP BY order_id, kind
              QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY COUNT(*) DESC, kind) = 1) m ON m.order_id = i.order_id""",
}

_WORD = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)", re.I)
_KIND = {"b": "BIGINT", "d": "DOUBLE", "s": "VARCHAR"}


def _needs(text: str, seen: list[str], own: str | None = None) -> None:
    for name in _WORD.findall(text):
        if name in REL and name != own and name not in seen:
            _needs(REL[name], seen, name)
            seen.append(name)


def sql(columns: str, body: str) -> str:
    """``columns`` is ``type name, ...`` with types b (bigint), d (double) and s (text)."""
    used: list[str] = []
    _needs(body, used)
    parts = [f"{name} AS ({REL[name]})" for name in used] + [f"answer AS ({body})"]
    out = []
    for c in columns.split(","):
        kind, name = c.split()
        out.append(f'CAST("{name}" AS {_KIND[kind]}) AS "{name}"')
    return f"WITH {', '.join(parts)} SELECT {', '.join(out)} FROM answer"
