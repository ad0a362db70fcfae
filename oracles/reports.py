"""SQL twins of views, dashboard reports, exercises, course queries and indicators."""

from oracles.base import div, rnd, sql

SQL: dict[str, str] = {}


def add(name: str, columns: str, body: str) -> None:
    SQL[name] = sql(columns, body)


# ---- views ------------------------------------------------------------------------

MONTH = "b year, b month, s month_label, d monthly_revenue, b monthly_orders, d avg_basket"
month_rows = f"SELECT y AS year, m AS month, label AS month_label, rev AS monthly_revenue, n AS monthly_orders, {rnd(div('rev', 'n'), 2)} AS avg_basket FROM months"
add("v1_monthly_sales", MONTH, month_rows)
add(
    "v2_customer_cohorts",
    "b customer_unique_id, b first_month, b total_orders, d total_spent, s first_month_label",
    """SELECT customer AS customer_unique_id, first_ym AS first_month, n AS total_orders, spent AS total_spent,
       substr(first_ym::VARCHAR, 1, 4) || '-' || substr(first_ym::VARCHAR, 5) AS first_month_label FROM persons""",
)
ENRICHED = """
    SELECT order_id, item, status, day, c.customer, c.city, c.state, coalesce(p_type, p_brand, 'Unknown') AS category,
           price, freight, score, days
    FROM fact f LEFT JOIN cust c ON c.customer = f.customer LEFT JOIN part ON p_partkey = f.product"""
add(
    "v3_orders_enriched",
    "b order_id, b order_item_id, s order_status, s order_date, b year, b month, s day_name, b is_weekend, b customer_unique_id,"
    " s customer_city, s customer_state, s product_category, d price, d freight_value, b review_score, d delivery_days, d delivery_delta_days",
    f"""SELECT order_id, item AS order_item_id, status AS order_status, strftime(day, '%Y-%m-%d') AS order_date, year(day) AS year,
        month(day) AS month, dayname(day) AS day_name, CASE WHEN isodow(day) > 5 THEN 1 ELSE 0 END AS is_weekend,
        customer AS customer_unique_id, city AS customer_city, state AS customer_state, category AS product_category,
        price, freight AS freight_value, score AS review_score, days AS delivery_days, days - 30 AS delivery_delta_days
        FROM ({ENRICHED})""",
)
add("s5_views_by_name", "s month_label, d monthly_revenue", "SELECT label AS month_label, rev AS monthly_revenue FROM months")
add(
    "s6_parametrised_sql",
    "s customer_state, b nb_items",
    "SELECT state AS customer_state, COUNT(*) AS nb_items FROM fact JOIN cust USING (customer) WHERE status = 'shipped' AND price >= 50000 GROUP BY 1",
)

# ---- dashboard ------------------------------------------------------------------------

KPIS = f"""SELECT (SELECT COUNT(DISTINCT order_id) FROM done) AS total_orders, (SELECT SUM(price) FROM done) AS total_revenue,
    (SELECT {rnd(div('SUM(score)', 'COUNT(score)'), 2)} FROM fact) AS avg_review,
    (SELECT {rnd(div('SUM(days)', 'COUNT(days)'), 1)} FROM done) AS avg_delivery_days"""
add("d1_overview_kpis", "b total_orders, d total_revenue, d avg_review, d avg_delivery_days", KPIS)
add("d2_monthly_revenue", "b year, b month, s month_label, d monthly_revenue", month_rows)


def growth(now: str, before: str, digits: int = 1) -> str:
    return rnd(div(f"(({now}) - ({before})) * 100", before), digits)


TREND = f"""SELECT label AS month_label, rev AS monthly_revenue, n AS monthly_orders,
    {growth('rev', 'LAG(rev) OVER w')} AS growth_pct, SUM(rev) OVER (w ROWS UNBOUNDED PRECEDING) AS running_total
    FROM months WINDOW w AS (ORDER BY ym)"""
add("d3_trends_monthly", "s month_label, d monthly_revenue, b monthly_orders, d growth_pct, d running_total", TREND)
add("d4_basket_avg", "s month_label, d monthly_revenue, b monthly_orders, d avg_basket", month_rows)
YEARS = f"""SELECT year, rev AS annual_revenue, n AS annual_orders, prev AS prev_revenue, {growth('rev', 'prev')} AS yoy_growth_pct
    FROM (SELECT y AS year, SUM(rev) AS rev, SUM(n) AS n, LAG(SUM(rev)) OVER (ORDER BY y) AS prev FROM months GROUP BY y)"""
add("d5_yearly_revenue", "b year, d annual_revenue, b annual_orders, d prev_revenue, d yoy_growth_pct", YEARS)
CATEGORIES = f"""SELECT ROW_NUMBER() OVER (ORDER BY SUM(price) DESC, category) AS product_rank, category AS category_name,
    SUM(price) AS total_revenue, COUNT(DISTINCT order_id) AS nb_orders, {rnd(div('SUM(price)', 'COUNT(price)'), 2)} AS avg_price
    FROM ({ENRICHED}) WHERE status = 'delivered' GROUP BY category ORDER BY 1 LIMIT 10"""
add("d6_top_categories", "b product_rank, s category_name, d total_revenue, b nb_orders, d avg_price", CATEGORIES)
SHARE = rnd(div("cum * 100", "total"), 2)
SHOWN = f"""SELECT place AS seller_rank, seller AS seller_id, city AS seller_city, state AS seller_state, rev AS total_revenue,
    cum AS cumulative_revenue, {SHARE} AS cumulative_pct, {rnd('pr', 4)} AS pct_rank,
    CASE WHEN {SHARE} <= 80 THEN '80%' ELSE '20%' END AS pareto_group FROM pareto WHERE place <= 100"""
add(
    "d7_pareto_sellers",
    "b seller_rank, b seller_id, s seller_city, s seller_state, d total_revenue, d cumulative_revenue, d cumulative_pct, d pct_rank, s pareto_group",
    SHOWN,
)


def scores(rounded: bool) -> str:
    def maybe(x: str, digits: int) -> str:
        return rnd(x, digits) if rounded else x

    on_time = "CAST(COUNT(*) FILTER (days <= 30) AS DOUBLE) / COUNT(*) * 100"
    metrics = f"""SELECT seller, s.city, s.state, SUM(price) AS rev, COUNT(DISTINCT order_id) AS n,
        {maybe(div('SUM(score)', 'COUNT(score)'), 2)} AS rv, {maybe(div('SUM(days)', 'COUNT(days)'), 1)} AS dd,
        {maybe(on_time, 1)} AS ot FROM done JOIN sell s USING (seller) GROUP BY ALL"""
    return f"""SELECT *, a + b + c + d + e AS total FROM (SELECT *,
        NTILE(5) OVER (ORDER BY rev NULLS FIRST, seller) AS a, NTILE(5) OVER (ORDER BY n NULLS FIRST, seller) AS b,
        NTILE(5) OVER (ORDER BY rv NULLS FIRST, seller) AS c, NTILE(5) OVER (ORDER BY dd DESC NULLS LAST, seller) AS d,
        NTILE(5) OVER (ORDER BY ot NULLS FIRST, seller) AS e FROM ({metrics}))"""


SCORING = f"""SELECT seller AS seller_id, city AS seller_city, state AS seller_state, rev AS total_revenue, n AS nb_orders,
    rv AS avg_review, dd AS avg_delivery_days, ot AS on_time_pct, a AS revenue_score, b AS volume_score, c AS review_score_ntile,
    d AS delivery_score, e AS ontime_score, total AS total_score, RANK() OVER (ORDER BY total DESC) AS seller_rank,
    DENSE_RANK() OVER (ORDER BY total DESC) AS seller_dense_rank
    FROM ({scores(True)}) ORDER BY total DESC, seller LIMIT 50"""
add(
    "d8_seller_scoring",
    "b seller_id, s seller_city, s seller_state, d total_revenue, b nb_orders, d avg_review, d avg_delivery_days, d on_time_pct,"
    " b revenue_score, b volume_score, b review_score_ntile, b delivery_score, b ontime_score, b total_score, b seller_rank, b seller_dense_rank",
    SCORING,
)
RFM = """SELECT *, CASE WHEN r > 3 AND f > 3 THEN 'Champions' WHEN r < 3 AND f > 2 THEN 'At Risk' WHEN f > 2 THEN 'Loyal'
    WHEN r < 3 THEN 'Lost' WHEN r > 3 AND f = 1 THEN 'New' ELSE 'Others' END AS segment
    FROM (SELECT *, NTILE(5) OVER (ORDER BY rec DESC, customer) AS r, NTILE(5) OVER (ORDER BY n, customer) AS f,
          NTILE(5) OVER (ORDER BY spent, customer) AS m
          FROM (SELECT *, date_diff('day', last_day, (SELECT MAX(day) FROM fact)) AS rec FROM persons))"""
SEGMENTS = f"""SELECT segment, COUNT(*) AS nb_customers, {rnd(div('SUM(spent)', 'COUNT(spent)'), 2)} AS avg_monetary,
    {rnd(div('SUM(n)', 'COUNT(n)'), 2)} AS avg_frequency FROM ({RFM}) GROUP BY segment"""
add("d9_rfm_segmentation", "s segment, b nb_customers, d avg_monetary, d avg_frequency", SEGMENTS)
add(
    "d9_rfm_scores",
    "b customer_unique_id, b recency, b frequency, d monetary, b r_score, b f_score, b m_score, s segment",
    f"SELECT customer AS customer_unique_id, rec AS recency, n AS frequency, spent AS monetary, r AS r_score, f AS f_score, m AS m_score, segment FROM ({RFM})",
)
RETENTION = "SELECT cohort AS cohort_month, age AS months_since_first, n AS nb_customers FROM grid"
add("d10_cohorts_retention", "b cohort_month, b months_since_first, b nb_customers", RETENTION)
LTV = f"""SELECT g.cohort AS cohort_month, g.age AS months_since_first, g.n AS nb_customers, g.rev AS cohort_revenue,
    SUM(e.rev) AS cumulative_revenue, {rnd(div('SUM(e.rev)', 'MAX(CASE WHEN e.age = 0 THEN e.n END)'), 2)} AS ltv_per_customer
    FROM grid g JOIN grid e ON e.cohort = g.cohort AND e.age <= g.age GROUP BY g.cohort, g.age, g.n, g.rev"""
add(
    "d11_ltv_cohorts",
    "b cohort_month, b months_since_first, b nb_customers, d cohort_revenue, d cumulative_revenue, d ltv_per_customer",
    LTV,
)
LABEL = "substr(ym::VARCHAR, 1, 4) || '-' || substr(ym::VARCHAR, 5)"
NEWREC = f"""SELECT {LABEL} AS month_label, COUNT(*) FILTER (ym = first_ym) AS new_customers, COUNT(*) FILTER (ym <> first_ym) AS recurring,
    COUNT(*) AS total, {rnd(div('COUNT(*) FILTER (ym = first_ym) * 100', 'COUNT(*)'), 1)} AS new_pct FROM active GROUP BY ym"""
add("d12_new_vs_recurring", "s month_label, b new_customers, b recurring, b total, d new_pct", NEWREC)

# ---- exercises ------------------------------------------------------------------------------

add(
    "x1_delivered_items_of_year",
    "b order_id, s order_date, d price",
    "SELECT order_id, strftime(day, '%Y-%m-%d') AS order_date, price FROM done WHERE year(day) = 1997",
)
add(
    "x2_top_categories_inner",
    "s category, d total_revenue",
    "SELECT category, SUM(rev) AS total_revenue FROM products GROUP BY category ORDER BY 2 DESC, 1 LIMIT 5",
)
add(
    "x3_revenue_by_state",
    "s state, d total_revenue, b nb_orders",
    "SELECT state, SUM(price) AS total_revenue, COUNT(DISTINCT order_id) AS nb_orders FROM fact JOIN cust USING (customer) GROUP BY state",
)
BACK = div("(rev - LAG(rev, {k}) OVER w)", "LAG(rev, {k}) OVER w") + " * 100"
add(
    "x4_revenue_vs_12_rows_back",
    "b year, b month, d revenue, d revenue_previous_year, d yoy_growth_pct",
    f"""SELECT y AS year, m AS month, rev AS revenue, LAG(rev, 12) OVER w AS revenue_previous_year,
        {BACK.format(k=12)} AS yoy_growth_pct FROM months WINDOW w AS (ORDER BY ym)""",
)
add(
    "x5_customer_quintiles",
    "b customer_id, d total_spent, b quintile",
    "SELECT customer AS customer_id, spent AS total_spent, NTILE(5) OVER (ORDER BY spent DESC, customer) AS quintile FROM persons",
)
add(
    "x6_running_revenue",
    "s month, d monthly_revenue, d cumulative_revenue",
    "SELECT a.label AS month, a.rev AS monthly_revenue, SUM(b.rev) AS cumulative_revenue FROM months a JOIN months b ON b.ym <= a.ym GROUP BY a.label, a.rev",
)
add(
    "x7_top_products_share",
    "b product_id, d revenue, d pct_of_total",
    f"SELECT product AS product_id, rev AS revenue, {div('rev * 100', '(SELECT SUM(price) FROM fact)')} AS pct_of_total FROM products ORDER BY rev DESC, product LIMIT 10",
)
add("x8_customers_with_two_orders", "b customer_id, b nb_orders", "SELECT customer AS customer_id, n AS nb_orders FROM persons WHERE n >= 2")
add(
    "x9_top_sellers_per_state",
    "s state, b seller_id, d revenue, b rank_in_state",
    "SELECT state, seller AS seller_id, rev AS revenue, ROW_NUMBER() OVER (PARTITION BY state ORDER BY rev DESC, seller) AS rank_in_state FROM sellers QUALIFY rank_in_state <= 3",
)

# ---- course -----------------------------------------------------------------------------------

add(
    "k1_repeat_rate",
    "b total_customers, b repeat_customers, d repeat_rate_pct",
    f"""SELECT COUNT(*) AS total_customers, COUNT(*) FILTER (again) AS repeat_customers,
        {rnd(div('COUNT(*) FILTER (again) * 100', 'COUNT(*)'), 1)} AS repeat_rate_pct
        FROM (SELECT p.customer, EXISTS (SELECT 1 FROM done d WHERE d.customer = p.customer AND d.dkey > p.first_key) AS again FROM persons p)""",
)
add("k2_seller_total_scores", "b seller_id, b total_score", f"SELECT seller AS seller_id, total AS total_score FROM ({scores(False)})")
add(
    "k3_new_vs_later",
    "s month_label, b new_customers, b recurring_customers",
    f"SELECT {LABEL} AS month_label, COUNT(DISTINCT CASE WHEN ym = first_ym THEN customer END) AS new_customers, COUNT(DISTINCT CASE WHEN ym > first_ym THEN customer END) AS recurring_customers FROM active GROUP BY ym",
)
add(
    "k4_inactive_customers",
    "b customer_id, b days_since_last_order",
    "SELECT customer AS customer_id, date_diff('day', last_day, TIMESTAMP '2001-12-31') AS days_since_last_order FROM persons WHERE days_since_last_order > 180",
)
add(
    "k5_first_month_flags",
    "b customer_id, b order_month, b is_first_order",
    "SELECT customer AS customer_id, ym AS order_month, CASE WHEN ym = first_ym THEN 1 ELSE 0 END AS is_first_order FROM active",
)
add(
    "k6_revenue_share_by_quintile",
    "b quintile, d segment_revenue, d pct_of_total",
    f"""SELECT q AS quintile, SUM(rev) AS segment_revenue, {div('SUM(rev) * 100', 'SUM(SUM(rev)) OVER ()')} AS pct_of_total
        FROM (SELECT rev, NTILE(5) OVER (ORDER BY rev DESC, seller) AS q FROM sellers) GROUP BY q""",
)
add(
    "k7_mean_price_per_customer",
    "b customer_unique_id, d avg_order",
    f"SELECT c_custkey AS customer_unique_id, (SELECT {div('SUM(price)', 'COUNT(price)')} FROM fact WHERE customer = c_custkey) AS avg_order FROM customer",
)
add(
    "k8_orders_per_customer",
    "b customer_id, b nb_orders",
    "SELECT c_custkey AS customer_id, COUNT(DISTINCT order_id) AS nb_orders FROM customer LEFT JOIN fact ON customer = c_custkey GROUP BY 1",
)
add(
    "k9_extreme_customers",
    "b customer_key, d total",
    """SELECT customer AS customer_key, SUM(price) AS total FROM fact GROUP BY 1 HAVING SUM(price) > 2000000
       UNION ALL SELECT customer, SUM(price) FROM fact GROUP BY 1 HAVING SUM(price) < 500000""",
)
add(
    "k10_month_over_month",
    "s month, d revenue, d prev_month, d growth_pct",
    f"SELECT label AS month, rev AS revenue, LAG(rev, 1) OVER w AS prev_month, {BACK.format(k=1)} AS growth_pct FROM months WINDOW w AS (ORDER BY ym)",
)
add(
    "k11_next_purchase",
    "b customer_key, b order_id, b order_item_id, b date_key, b next_date_key",
    """SELECT customer AS customer_key, order_id, item AS order_item_id, dkey AS date_key,
       LEAD(dkey) OVER (PARTITION BY customer ORDER BY dkey, order_id, item, product, seller, price, days) AS next_date_key FROM fact""",
)
add(
    "k12_rank_in_category",
    "s category, b product_id, d revenue, b rank_in_category",
    "SELECT category, product AS product_id, rev AS revenue, RANK() OVER (PARTITION BY category ORDER BY rev DESC) AS rank_in_category FROM products",
)
add(
    "k13_states_over_100_orders",
    "s state, b nb",
    "SELECT state, COUNT(DISTINCT order_id) AS nb FROM done JOIN cust USING (customer) GROUP BY state HAVING COUNT(DISTINCT order_id) > 100",
)
add("k14_items_and_orders", "b total_items, b total_orders", "SELECT COUNT(*) AS total_items, COUNT(DISTINCT order_id) AS total_orders FROM fact")
add("k15_delivered_item_count", "b nb_items", "SELECT COUNT(*) AS nb_items FROM done")
FACT_COLUMNS = (
    "b order_id, b order_item_id, b date_key, b customer_key, b seller_key, b product_key, s order_status, d price, d freight_value,"
    " d order_payment_total, s payment_type, b review_score, d delivery_days, d estimated_days, d delivery_delta_days"
)
FACT_ROWS = """SELECT order_id, item AS order_item_id, dkey AS date_key, customer AS customer_key, seller AS seller_key, product AS product_key,
    status AS order_status, price, freight AS freight_value, paid AS order_payment_total, paytype AS payment_type, score AS review_score,
    days AS delivery_days, 30 AS estimated_days, days - 30 AS delivery_delta_days FROM fact"""
LATEST = " ORDER BY dkey DESC NULLS LAST, order_id, item, product, seller, price LIMIT 1000"
add("k16_latest_rows", FACT_COLUMNS, FACT_ROWS + LATEST)
add("k16_latest_rows_projected", "b order_id, s order_status, d price", "SELECT order_id, status AS order_status, price FROM fact" + LATEST)
add(
    "k17_items_with_status_mean",
    "b order_id, d price, d avg_status_value",
    f"SELECT order_id, price, {div('SUM(price) OVER (PARTITION BY status)', 'COUNT(price) OVER (PARTITION BY status)')} AS avg_status_value FROM fact",
)
add("k18_first_delivered_rows", "b order_id, b date_key, d price", "SELECT order_id, dkey AS date_key, price FROM done ORDER BY dkey, order_id, price LIMIT 10")
add("k18_status_revenue", "s order_status, d revenue", "SELECT status AS order_status, SUM(price) AS revenue FROM done GROUP BY status")
add(
    "k19_top_products_per_category",
    "s category, b product_id, d revenue, b rank",
    "SELECT category, product AS product_id, rev AS revenue, ROW_NUMBER() OVER (PARTITION BY category ORDER BY rev DESC, product) AS rank FROM products QUALIFY rank <= 3",
)
add(
    "k20_rows_with_month_total",
    "b month, b order_id, b order_item_id, d price, d monthly_total",
    "SELECT ym AS month, order_id, item AS order_item_id, price, SUM(price) OVER (PARTITION BY ym) AS monthly_total FROM fact",
)
add(
    "k21_score_bands",
    "s segment, b nb_items, d revenue",
    "SELECT CASE WHEN score >= 4 THEN 'Premium' WHEN score = 3 THEN 'Standard' ELSE 'At Risk' END AS segment, COUNT(*) AS nb_items, SUM(price) AS revenue FROM fact GROUP BY 1",
)
add("k22_rows_of_one_day", FACT_COLUMNS, FACT_ROWS + " WHERE day = TIMESTAMP '1997-06-15'")
add("k22_rows_from_day_on", FACT_COLUMNS, FACT_ROWS + " WHERE day >= TIMESTAMP '2000-01-01'")

# ---- indicators ---------------------------------------------------------------------------------

CURVE = [f"{div(f'MAX(CASE WHEN age = {i} THEN n END)', 'MAX(CASE WHEN age = 0 THEN n END)')} * 100 AS m{i}" for i in range(1, 12)]
MATRIX = f"""SELECT cohort AS cohort_month, MAX(CASE WHEN age = 0 THEN n END) AS cohort_size, {', '.join(CURVE)}
    FROM grid GROUP BY cohort HAVING MAX(CASE WHEN age = 0 THEN n END) >= 15"""
add("i1_retention_matrix", "b cohort_month, b cohort_size, " + ", ".join(f"d m{i}" for i in range(1, 12)), MATRIX)
add(
    "i2_retention_summary",
    "d mean_month1, b best_cohort, d best_month1",
    f"""SELECT {div('SUM(m)', 'COUNT(m)')} AS mean_month1, arg_max(cohort_month, m * 1000000 - cohort_month) AS best_cohort, MAX(m) AS best_month1
        FROM (SELECT cohort_month, CAST(CAST(m1 AS VARCHAR) AS DECIMAL(28,12)) AS m FROM ({MATRIX}) WHERE m1 IS NOT NULL)""",
)
add(
    "i2_cohort_sizes",
    "b cohort_month, b customers",
    "SELECT cohort AS cohort_month, n AS customers FROM grid WHERE age = 0 AND n >= 15",
)
add(
    "i3_acquisition_summary",
    "b new_customers, b recurring, d recurring_pct, s peak_month, b peak_new",
    f"""SELECT SUM(new_customers) AS new_customers, SUM(recurring) AS recurring,
        coalesce({div('SUM(recurring) * 100', 'SUM(new_customers) + SUM(recurring)')}, 0) AS recurring_pct,
        (SELECT month_label FROM ({NEWREC}) WHERE total >= 50 ORDER BY new_customers DESC, month_label LIMIT 1) AS peak_month,
        MAX(new_customers) AS peak_new FROM ({NEWREC}) WHERE total >= 50""",
)
# no cohort of the given tables reaches 500 customers, so the six largest are shown below sf 0.1
CHOSEN = """SELECT cohort FROM grid WHERE age = 0 AND (n >= 500 OR (SELECT MAX(n) FROM grid WHERE age = 0) < 500)
    QUALIFY n >= 500 OR ROW_NUMBER() OVER (ORDER BY n DESC, cohort) <= 6"""
LINES = f"""SELECT *, substr(cohort_month::VARCHAR, 1, 4) || '-' || substr(cohort_month::VARCHAR, 5) AS cohort_label
    FROM ({LTV}) WHERE cohort_month IN ({CHOSEN})"""
add(
    "i4_ltv_selection",
    "b cohort_month, b months_since_first, b nb_customers, d cohort_revenue, d cumulative_revenue, d ltv_per_customer, s cohort_label",
    LINES,
)
add(
    "i4_best_ltv",
    "s best_cohort, d best_ltv",
    f"""SELECT cohort_label AS best_cohort, ltv_per_customer AS best_ltv FROM ({LINES})
        QUALIFY ROW_NUMBER() OVER (PARTITION BY cohort_label ORDER BY months_since_first DESC) = 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
CAPPED = "CAST(CASE WHEN growth_pct < -100 THEN -100 WHEN growth_pct > 100 THEN 100 ELSE growth_pct END AS DECIMAL(18,1))"
add(
    "i5_trend_summary",
    "b months, d last_total, d mean_growth, s trend",
    f"""SELECT *, CASE WHEN mean_growth > 5 THEN 'rising' ELSE 'stable' END AS trend FROM (SELECT COUNT(*) AS months, MAX(running_total) AS last_total,
        coalesce({div(f'SUM({CAPPED})', f'COUNT({CAPPED})')}, 0) AS mean_growth FROM ({TREND}) WHERE monthly_revenue >= 10000)""",
)
add(
    "i6_basket_summary",
    "d mean_basket, s best_month, d best_basket",
    f"""SELECT {div('SUM(CAST(avg_basket AS DECIMAL(18,2)))', 'COUNT(*)')} AS mean_basket,
        (SELECT month_label FROM ({month_rows}) WHERE monthly_orders >= 60 ORDER BY avg_basket DESC, month_label LIMIT 1) AS best_month,
        MAX(avg_basket) AS best_basket FROM ({month_rows}) WHERE monthly_orders >= 60""",
)
add(
    "i7_satisfaction",
    "b total_orders, d total_revenue, d avg_review, d avg_delivery_days, s satisfaction",
    f"SELECT *, CASE WHEN avg_review >= 4 THEN 'excellente' WHEN avg_review >= 3 THEN 'correcte' ELSE 'a ameliorer' END AS satisfaction FROM ({KPIS})",
)
add(
    "i7_month_summary",
    "s best_month, d best_revenue, s last_month, d last_revenue",
    """SELECT b.label AS best_month, b.rev AS best_revenue, z.label AS last_month, z.rev AS last_revenue
       FROM (SELECT * FROM months ORDER BY rev DESC, label LIMIT 1) b, (SELECT * FROM months ORDER BY ym DESC LIMIT 1) z""",
)
for name, source in (("i8_pareto_threshold", "pareto"), ("i8_pareto_threshold_shown", "(SELECT * FROM pareto WHERE place <= 100)")):
    add(
        name,
        "b threshold_rank, b sellers, d last_pct, d pct_sellers",
        f"""SELECT MIN(CASE WHEN {SHARE} >= 80 THEN place END) AS threshold_rank, COUNT(*) AS sellers, MAX({SHARE}) AS last_pct,
            {div(f'MIN(CASE WHEN {SHARE} >= 80 THEN place END) * 100', 'COUNT(*)')} AS pct_sellers FROM {source}""",
    )
add(
    "i9_segment_summary",
    "s dominant_segment, b dominant_customers, d dominant_pct, b at_risk_customers",
    f"""SELECT (SELECT segment FROM ({SEGMENTS}) ORDER BY nb_customers DESC, segment LIMIT 1) AS dominant_segment,
        MAX(nb_customers) AS dominant_customers, {div('MAX(nb_customers) * 100', 'SUM(nb_customers)')} AS dominant_pct,
        SUM(CASE WHEN segment IN ('At Risk', 'Lost') THEN nb_customers ELSE 0 END) AS at_risk_customers FROM ({SEGMENTS})""",
)
AXES = "[revenue_score, volume_score, review_score_ntile, delivery_score, ontime_score]"
NAMES = "['Revenue', 'Volume', 'Avis', 'Livraison', 'Ponctualite']"
add(
    "i10_seller_profile",
    "b seller_id, b total_score, s strongest_axis, s weakest_axis",
    f"""SELECT seller_id, total_score, {NAMES}[list_position({AXES}, list_max({AXES}))] AS strongest_axis,
        {NAMES}[list_position({AXES}, list_min({AXES}))] AS weakest_axis FROM ({SCORING}) ORDER BY seller_rank, seller_id LIMIT 1""",
)
add(
    "i10_seller_radar",
    "b seller_rank, s seller_city, b revenue_score, b volume_score, b review_score_ntile, b delivery_score, b ontime_score",
    f"SELECT * FROM ({SCORING}) ORDER BY seller_rank, seller_id LIMIT 5",
)
add(
    "i10_seller_table",
    "b seller_rank, s seller_city, s seller_state, d total_revenue, b nb_orders, d avg_review, d avg_delivery_days, d on_time_pct, b total_score",
    f"SELECT * FROM ({SCORING}) ORDER BY seller_rank, seller_id LIMIT 20",
)
add(
    "i11_category_concentration",
    "s top_category, d top1_revenue, d top3_revenue, d top10_revenue, d top3_pct",
    f"""SELECT MAX(CASE WHEN product_rank = 1 THEN category_name END) AS top_category, SUM(total_revenue) FILTER (product_rank = 1) AS top1_revenue,
        SUM(total_revenue) FILTER (product_rank <= 3) AS top3_revenue, SUM(total_revenue) AS top10_revenue,
        {div('SUM(total_revenue) FILTER (product_rank <= 3) * 100', 'SUM(total_revenue)')} AS top3_pct FROM ({CATEGORIES})""",
)
add(
    "i11_year_summary",
    "b best_year, d best_revenue, d latest_yoy_pct",
    f"""SELECT (SELECT year FROM ({YEARS}) ORDER BY annual_revenue DESC, year LIMIT 1) AS best_year, MAX(annual_revenue) AS best_revenue,
        (SELECT yoy_growth_pct FROM ({YEARS}) WHERE yoy_growth_pct IS NOT NULL ORDER BY year DESC LIMIT 1) AS latest_yoy_pct FROM ({YEARS})""",
)
