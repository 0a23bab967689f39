"""SQL that answers every registered query on the same tables, for the correctness check."""

from __future__ import annotations

import datetime as dt

from martloom import rules as r
from martloom.sources.order_lines import BASE_COST_PCT, ORDER_RULES


def half_up(x: str, digits: int = 2) -> str:
    k = 10**digits
    return f"(sign({x}) * floor(abs({x}) * {k}.0 + 0.5) / {k}.0)"


def half_even(x: str, digits: int = 2) -> str:
    k = f"CAST({10**digits} AS DOUBLE)"
    return f"(round_even(({x}) * {k}, 0) / {k})"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def div(top: str, bottom: str) -> str:
    return f"({dbl(top)} / nullif({dbl(bottom)}, 0))"


def _case(on: str, names: dict) -> str:
    arms = " ".join(f"WHEN {on} = {k} THEN '{v}'" for k, v in names.items())
    return f"CASE {arms} END"


def _labels(day: str) -> str:
    """Calendar columns of a date expression."""
    fy = f"(year({day}) - CASE WHEN month({day}) < 4 THEN 1 ELSE 0 END)"
    return f"""
        CAST(year({day}) AS INTEGER) AS year,
        CAST(month({day}) AS INTEGER) AS month,
        strftime({day}, '%B') AS month_name,
        CAST(quarter({day}) AS INTEGER) AS quarter,
        CAST(isodow({day}) - 1 AS INTEGER) AS day_of_week,
        CAST(CASE WHEN isodow({day}) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
        'FY' || {fy} || '-' || lpad(CAST(({fy} + 1) % 100 AS VARCHAR), 2, '0') AS fiscal_year,
        CAST(((month({day}) - 4) % 12 + 12) % 12 + 1 AS INTEGER) AS fiscal_month,
        {_case(f"month({day})", r.SEASON_BY_MONTH)} AS season"""


_PHYSICAL = ", ".join(f"'{c}'" for c in ORDER_RULES.physical_channels)

# The transactions, stores and star schema every statement starts from.
BASE = f"""
tx AS (
    SELECT *, CAST(round(net_amount * cost, 2) AS DECIMAL(18,2)) AS cogs FROM (
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         strftime(l_shipdate, '%Y%m%d')) AS transaction_id,
               CAST(o_orderdate AS DATE) AS date_key,
               l_suppkey AS store_id, o_custkey AS customer_id,
               p_type AS category, o_orderpriority AS channel,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS DECIMAL(18,2))
                   AS unit_price,
               CAST(abs(l_discount) AS DECIMAL(5,4)) AS discount_pct,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
                    * (1 - CAST(l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(18,2)) AS net_amount,
               CAST({BASE_COST_PCT} + p_size AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2)) AS cost
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN part ON l_partkey = p_partkey)
),
stores AS (
    SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS city
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
dim_date AS (
    SELECT date_key, {_labels("date_key")}
    FROM (SELECT CAST(unnest(generate_series(min(date_key), max(date_key), INTERVAL 1 DAY))
                 AS DATE) AS date_key FROM tx)
),
dim_category AS (
    SELECT CAST(row_number() OVER (ORDER BY category) AS INTEGER) AS category_id, category,
           CASE WHEN mid >= {ORDER_RULES.premium_from} THEN 'Premium'
                WHEN mid >= {ORDER_RULES.mid_from} THEN 'Mid' ELSE 'Value' END AS price_band
    FROM (SELECT category, median({dbl("unit_price")}) AS mid FROM tx GROUP BY category)
),
dim_channel AS (
    SELECT CAST(row_number() OVER (ORDER BY channel) AS INTEGER) AS channel_id, channel,
           CAST(CASE WHEN channel IN ({_PHYSICAL}) THEN 1 ELSE 0 END AS INTEGER) AS is_physical
    FROM (SELECT DISTINCT channel FROM tx)
),
dim_customer AS (
    SELECT customer_id, min(date_key) AS first_purchase, max(date_key) AS last_purchase,
           count(DISTINCT transaction_id) AS lifetime_orders,
           {dbl("sum(net_amount)")} AS lifetime_value
    FROM tx GROUP BY customer_id
),
fact AS (
    SELECT transaction_id, date_key, store_id, category_id, channel_id, customer_id, quantity,
           unit_price, discount_pct, net_amount, cogs, net_amount - cogs AS gross_margin
    FROM tx JOIN dim_category USING (category) JOIN dim_channel USING (channel)
),
detail AS (
    SELECT f.*, d.* EXCLUDE (date_key), s.store_name, c.category, c.price_band,
           ch.channel, ch.is_physical
    FROM fact f JOIN dim_date d USING (date_key) JOIN stores s USING (store_id)
    JOIN dim_category c USING (category_id) JOIN dim_channel ch USING (channel_id)
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {BASE}{ctes}\n{select}"


_AVG_DISCOUNT = half_up(f"({div('sum(discount_pct)', 'count(discount_pct)')} * 100.0)")
_GM_PCT = half_up(f"({dbl('sum(gross_margin)')} * 100.0 / {dbl('sum(net_amount)')})")


_KPI = f"""
    SELECT fiscal_year, year, month, month_name, season,
           count(DISTINCT transaction_id) AS bills, count(DISTINCT customer_id) AS customers,
           CAST(sum(quantity) AS BIGINT) AS units, {dbl("sum(net_amount)")} AS revenue,
           {dbl("sum(gross_margin)")} AS gross_margin, {_GM_PCT} AS gm_pct,
           {half_up(div("sum(net_amount)", "count(DISTINCT transaction_id)"))} AS avg_bill_value,
           {_AVG_DISCOUNT} AS avg_discount_pct
    FROM detail GROUP BY ALL"""

_MIX_SHARE = half_up(
    f"({dbl('sum(net_amount)')} * 100.0"
    f" / {dbl('sum(sum(net_amount)) OVER (PARTITION BY fiscal_year)')})"
)
_MIX = f"""
    SELECT fiscal_year, channel, {dbl("sum(net_amount)")} AS revenue,
           {_MIX_SHARE} AS pct_of_revenue, {_GM_PCT} AS gm_pct,
           {_AVG_DISCOUNT} AS avg_discount_pct, count(DISTINCT customer_id) AS customers
    FROM detail GROUP BY fiscal_year, channel"""

_DECILES = """,
ltv AS (SELECT customer_id, sum(net_amount) AS ltv FROM detail GROUP BY customer_id),
deciles AS (
    SELECT CAST(decile AS INTEGER) AS decile, count(*) AS customers, sum(ltv) AS revenue
    FROM (SELECT ltv, ntile(10) OVER (ORDER BY ltv DESC, customer_id) AS decile FROM ltv)
    GROUP BY decile
)"""
_DECILE_SHARE = half_up(f"({dbl('revenue')} * 100.0 / {dbl('sum(revenue) OVER ()')})")
_CUM = "OVER (ORDER BY decile ROWS UNBOUNDED PRECEDING)"
_CUM_SHARE = half_up(
    f"({dbl(f'sum(revenue) {_CUM}')} * 100.0 / {dbl('sum(revenue) OVER ()')})"
)


def _plan(prior: str, year: str, keys: str = "") -> str:
    units, price = "CAST(sum(quantity) AS BIGINT)", half_even(div("sum(net_amount)", "sum(quantity)"))
    return f""",
planned AS (
    SELECT *, CAST({half_even("budget_qty * price")} AS DECIMAL(18,2)) AS budget_revenue FROM (
        SELECT {keys} '{year}' AS fiscal_year, month, category,
               CAST({half_even(f"{units} * CAST({r.PLAN_UPLIFT} AS DOUBLE)", 0)} AS BIGINT)
                   AS budget_qty, {price} AS price
        FROM detail WHERE fiscal_year = '{prior}' GROUP BY {keys} month, category)
)"""


def _variance(prior: str, year: str, keys: str = "") -> str:
    on = f"USING ({keys} category)"
    part = f"PARTITION BY {keys.rstrip(', ')}" if keys else ""
    money = lambda x: f"CAST({half_even(x)} AS DECIMAL(28,2))"
    return f"""{_plan(prior, year, keys)},
actual AS (
    SELECT {keys} category, CAST(sum(quantity) AS BIGINT) AS actual_qty,
           sum(net_amount) AS actual_revenue
    FROM detail WHERE fiscal_year = '{year}' GROUP BY {keys} category
),
budgeted AS (
    SELECT {keys} category, CAST(sum(budget_qty) AS BIGINT) AS budget_qty,
           sum(budget_revenue) AS budget_revenue
    FROM planned GROUP BY {keys} category
),
paired AS (
    SELECT {keys} category, coalesce(budget_qty, 0) AS qb, coalesce(actual_qty, 0) AS qa,
           coalesce(budget_revenue, 0) AS rb, coalesce(actual_revenue, 0) AS ra
    FROM budgeted FULL JOIN actual {on}
),
priced AS (
    SELECT *, coalesce({div("rb", "qb")}, 0) AS pb, coalesce({div("ra", "qa")}, 0) AS pa,
           coalesce({div("qb", "qb_all")}, 0) AS mb, coalesce({div("qa", "qa_all")}, 0) AS ma
    FROM (SELECT *, CAST(sum(qb) OVER ({part}) AS BIGINT) AS qb_all,
                 CAST(sum(qa) OVER ({part}) AS BIGINT) AS qa_all FROM paired)
),
variances AS (
    SELECT {keys} category, qb AS budget_qty, qa AS actual_qty, {money("pb")} AS budget_price,
           {money("pa")} AS actual_price, rb AS budget_revenue, ra AS actual_revenue,
           ra - rb AS total_variance, {money("qa * (pa - pb)")} AS price_variance,
           {money("pb * mb * (qa_all - qb_all)")} AS volume_variance,
           {money("pb * qa_all * (ma - mb)")} AS mix_variance,
           {half_even(f"{div('ra', 'rb')} * 100.0", 1)} AS achievement_pct
    FROM priced
),
sums AS (
    SELECT {keys} sum(budget_revenue) AS b, sum(price_variance) AS p,
           sum(volume_variance) AS v, sum(mix_variance) AS m
    FROM variances {f"GROUP BY {keys.rstrip(', ')}" if keys else ""}
),
bridge AS (
    SELECT {keys} 1 AS step_no, '{r.STEP_BUDGET}' AS step, b AS value, 'total' AS kind FROM sums
    UNION ALL SELECT {keys} 2, '{r.STEP_PRICE}', p, 'delta' FROM sums
    UNION ALL SELECT {keys} 3, '{r.STEP_VOLUME}', v, 'delta' FROM sums
    UNION ALL SELECT {keys} 4, '{r.STEP_MIX}', m, 'delta' FROM sums
    UNION ALL SELECT {keys} 5, '{r.STEP_ACTUAL}', b + p + v + m, 'total' FROM sums
)"""


_VARIANCE_SELECT = f"""category, budget_qty, actual_qty, {dbl("budget_price")} AS budget_price,
    {dbl("actual_price")} AS actual_price, {dbl("budget_revenue")} AS budget_revenue,
    {dbl("actual_revenue")} AS actual_revenue, {dbl("total_variance")} AS total_variance,
    {dbl("price_variance")} AS price_variance, {dbl("volume_variance")} AS volume_variance,
    {dbl("mix_variance")} AS mix_variance, achievement_pct FROM variances"""


def _waterfall(keys: str = "") -> str:
    """Deltas stand on the first total plus the deltas before them."""
    part = f"PARTITION BY {keys.rstrip(', ')}" if keys else ""
    before = f"OVER ({part} ORDER BY step_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
    SELECT {keys} step_no, step, CASE WHEN kind = 'total' THEN 0.0
        ELSE {dbl(f"sum(value) {before}")} / 1e7 END AS bottom,
        {dbl("value")} / 1e7 AS height,
        CASE WHEN kind = 'total' THEN 'total' WHEN value >= 0 THEN 'up' ELSE 'down' END AS direction
    FROM bridge"""


def _score(order: str) -> str:
    rank = f"row_number() OVER (ORDER BY {order}, customer_id)"
    return f"CAST(greatest(1, (5 * ({rank} - 1) + (n - 2)) // greatest(n - 1, 1)) AS INTEGER)"


def _rfm(as_of: str = "max(last_purchase) OVER ()") -> str:
    return f""",
history AS (
    SELECT customer_id, max(date_key) AS last_purchase, min(date_key) AS first_purchase,
           count(DISTINCT transaction_id) AS frequency, sum(net_amount) AS monetary
    FROM detail GROUP BY customer_id
),
paced AS (
    SELECT *, CAST(as_of - last_purchase AS INTEGER) AS recency_days,
           CAST(as_of - first_purchase AS INTEGER) AS tenure_days,
           {div("as_of - first_purchase", "frequency - 1")} AS avg_gap_days
    FROM (SELECT *, {as_of} AS as_of, count(*) OVER () AS n FROM history)
),
usual AS (
    SELECT avg(avg_gap_days) AS gap
    FROM (SELECT avg_gap_days, row_number() OVER (ORDER BY avg_gap_days) AS pos,
                 count(*) OVER () AS gaps FROM paced WHERE avg_gap_days IS NOT NULL)
    WHERE pos IN ((gaps + 1) // 2, gaps // 2 + 1)
),
scored AS (
    SELECT *, coalesce(avg_gap_days, (SELECT gap FROM usual)) AS expected_gap,
           {_score("last_purchase")} AS R, {_score("frequency")} AS F, {_score("monetary")} AS M
    FROM paced
),
rfm AS (
    SELECT *, R + F + M AS rfm_score,
           {half_even(div("monetary", "frequency"))} AS avg_order_value,
           CASE WHEN R >= 4 AND F >= 4 AND M >= 4 THEN '{r.SEGMENT_CHAMPIONS}'
                WHEN M >= 4 AND overdue_ratio >= {r.OVERDUE_FROM} THEN '{r.SEGMENT_OVERDUE}'
                WHEN R >= 4 AND F <= 2 THEN '{r.SEGMENT_NEW}'
                WHEN F >= 4 AND R <= 2 THEN '{r.SEGMENT_SLIPPING}'
                WHEN R <= 2 AND M <= 2 THEN '{r.SEGMENT_DORMANT}'
                WHEN M >= 4 THEN '{r.SEGMENT_BIG_SPENDER}'
                ELSE '{r.SEGMENT_MIDDLE}' END AS segment
    FROM (SELECT *, CASE WHEN expected_gap = 0 AND recency_days <> 0
                         THEN sign(recency_days) * CAST('inf' AS DOUBLE)
                         ELSE {half_even(div("recency_days", "expected_gap"))} END AS overdue_ratio
          FROM scored)
),
segments AS (
    SELECT segment, count(*) AS customers, sum(monetary) AS revenue,
           {half_even(div("sum(CAST(avg_order_value AS DECIMAL(28,2)))", "count(avg_order_value)"))}
               AS avg_order_value,
           {half_even(div("sum(frequency)", "count(*)"))} AS avg_orders,
           {half_even(dbl("median(recency_days)"))} AS median_days_since
    FROM rfm GROUP BY segment
),
shares AS (
    SELECT segment, customers, {dbl("revenue")} AS revenue, avg_order_value, avg_orders,
           median_days_since,
           {half_even(f"{div('customers', 'sum(customers) OVER ()')} * 100.0", 1)}
               AS pct_of_customers,
           {half_even(f"{div('revenue', 'sum(revenue) OVER ()')} * 100.0", 1)} AS pct_of_revenue,
           {half_even(div("revenue", "customers"), 0)} AS revenue_per_customer
    FROM segments
)"""


def _series(keys: str = "") -> str:
    return f""",
series AS (
    SELECT {keys} CAST(date_trunc('month', date_key) AS DATE) AS period,
           sum(net_amount) AS revenue
    FROM detail GROUP BY ALL
)"""


def _indices(name: str, source: str, keys: str = "") -> str:
    by = keys.rstrip(", ")
    part = f"PARTITION BY {by}" if keys else ""
    frame = f"OVER ({part} ORDER BY period ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)"
    return f""",
{name} AS (
    SELECT {keys} month, {half_even(f"mean / avg(mean) OVER ({part})", 4)} AS seasonal FROM (
        SELECT {keys} month, avg(ratio) AS mean FROM (
            SELECT {keys} CAST(month(period) AS INTEGER) AS month,
                   CASE WHEN count(revenue) {frame} >= 6 THEN {dbl("revenue")}
                        / nullif({dbl(f"sum(revenue) {frame}")}
                                 / count(revenue) {frame}, 0) END AS ratio
            FROM {source})
        GROUP BY {keys} month HAVING avg(ratio) IS NOT NULL)
)"""


def _forecast(name: str, source: str, horizon: int, keys: str = "") -> str:
    """CTEs ending in ``name`` with (keys, step, period, forecast, lower_80, upper_80)."""
    by = keys.rstrip(", ")
    part = f"PARTITION BY {by}" if keys else ""
    group = f"GROUP BY {by}" if keys else ""
    join = f"JOIN {name}_line USING ({by})" if keys else f"CROSS JOIN {name}_line"
    spread = f"JOIN {name}_sigma USING ({by})" if keys else f"CROSS JOIN {name}_sigma"
    return f"""{_indices(f"{name}_idx", source, keys)},
{name}_flat AS (
    SELECT s.*, i.seasonal, {dbl("s.revenue")} / nullif(i.seasonal, 0) AS flat FROM (
        SELECT *, CAST(month(period) AS INTEGER) AS month,
               {dbl(f"row_number() OVER ({part} ORDER BY period) - 1")} AS x FROM {source}) s
    LEFT JOIN {name}_idx i USING ({keys} month)
),
{name}_line AS (
    SELECT {keys} CASE WHEN count(*) = count(flat) THEN regr_slope(flat, x) END AS slope,
           CASE WHEN count(*) = count(flat) THEN regr_intercept(flat, x) END AS intercept,
           count(*) AS n, max(period) AS last_period
    FROM {name}_flat {group}
),
{name}_sigma AS (
    SELECT {keys} stddev_samp({dbl("revenue")} - (intercept + slope * x) * seasonal) AS sigma
    FROM {name}_flat {join} {group}
),
{name} AS (
    SELECT {keys} step, period, {half_even("point")} AS forecast,
           {half_even(f"point - CAST({r.BAND_SIGMAS} AS DOUBLE) * sigma")} AS lower_80,
           {half_even(f"point + CAST({r.BAND_SIGMAS} AS DOUBLE) * sigma")} AS upper_80
    FROM (SELECT a.*, (intercept + slope * {dbl("n - 1 + step")}) * i.seasonal AS point
          FROM (SELECT *, CAST(last_period + to_months(CAST(step AS INTEGER)) AS DATE) AS period,
                       CAST(month(last_period + to_months(CAST(step AS INTEGER))) AS INTEGER)
                           AS month
                FROM {name}_line {spread}, range(1, {horizon + 1}) AS steps(step)) a
          LEFT JOIN {name}_idx i USING ({keys} month))
)"""


def _backtest(holdout: int, keys: str = "") -> str:
    by = keys.rstrip(", ")
    part = f"PARTITION BY {by}" if keys else ""
    mape = lambda x: f"avg(abs(({x})) ) * 100.0"
    seen = lambda x: f"count({x}) FILTER (actual <> 0)"
    error = lambda guess: f"(actual - {guess}) / nullif(actual, 0)"
    return f"""{_series(keys)},
placed AS (
    SELECT *, row_number() OVER ({part} ORDER BY period DESC) AS back,
           count(*) OVER ({part}) AS months, {dbl("revenue")} AS actual
    FROM series
),
train AS (SELECT {keys} period, revenue FROM placed
          WHERE months > {holdout} + 12 AND back > {holdout}),
test AS (SELECT {keys} period, actual, {holdout} + 1 - back AS step FROM placed
         WHERE months > {holdout} + 12 AND back <= {holdout}){_forecast("fc", "train", holdout, keys)},
year_ago AS (SELECT {keys} CAST(period + INTERVAL 12 MONTH AS DATE) AS period,
                    {dbl("revenue")} AS naive FROM series),
errors AS (
    SELECT {keys} count(*) FILTER (actual <> 0) AS due, {seen("forecast")} AS model_months,
           {seen("naive")} AS naive_months,
           CASE WHEN {seen("forecast")} = count(*) FILTER (actual <> 0)
                THEN {mape(error("forecast"))} END AS model,
           {mape(error("naive"))} AS base, count(*) AS tested
    FROM test LEFT JOIN (SELECT {keys} step, forecast FROM fc) USING ({keys} step)
    LEFT JOIN year_ago USING ({keys} period)
    {f"GROUP BY {by}" if keys else ""}
),
bt AS (
SELECT {keys} CASE WHEN due = model_months THEN '{r.STATUS_OK}' ELSE '{r.STATUS_NO_FORECAST}' END
           AS status, {holdout} AS holdout_months, model_months, naive_months,
       {half_even("model")} AS model_mape_pct, {half_even("base")} AS seasonal_naive_mape_pct,
       {half_even("base - model")} AS improvement_pct_points,
       CASE WHEN model < base THEN '{r.VERDICT_MODEL}'
            WHEN due = model_months THEN '{r.VERDICT_NAIVE}' END AS verdict
FROM errors WHERE tested > 0
UNION ALL
SELECT {keys} '{r.STATUS_TOO_SHORT}', NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM placed WHERE months <= {holdout} + 12 {f"GROUP BY {by}" if keys else "GROUP BY months"}
)"""


def _extract_checks() -> str:
    columns = (
        "transaction_id transaction_date store_id customer_id category channel quantity"
        " unit_price discount_pct net_amount cogs"
    ).split()
    rules = {f"{c} is null": f"{c} IS NULL".replace("transaction_date", "date_key") for c in columns}
    rules |= {f"{c} <= 0": f"{c} <= 0" for c in ("quantity", "unit_price", "net_amount")}
    rules["discount_pct outside [0, 1)"] = "discount_pct < 0 OR discount_pct >= 1"
    return " UNION ALL ".join(
        f"SELECT 'transactions.{name}' AS \"check\", count(*) AS violations FROM tx WHERE {bad}"
        for name, bad in rules.items()
    )


def _contracts(prior: str, year: str) -> str:
    fact_columns = (
        "transaction_id date_key store_id category_id channel_id customer_id quantity "
        "unit_price discount_pct net_amount cogs gross_margin"
    ).split()
    rules = [
        (f"fact_sales.{c} is null", f"SELECT count(*) FROM fact WHERE {c} IS NULL")
        for c in fact_columns
    ]
    rules += [
        (f"fact_sales.{c} <= 0", f"SELECT count(*) FROM fact WHERE {c} <= 0")
        for c in ("quantity", "unit_price", "net_amount")
    ]
    rules.append(
        (
            "fact_sales.discount_pct outside [0, 1)",
            "SELECT count(*) FROM fact WHERE discount_pct < 0 OR discount_pct >= 1",
        )
    )
    rules.append(
        (
            "fact_sales.transaction_id repeats",
            "SELECT count(transaction_id) - count(DISTINCT transaction_id) FROM fact",
        )
    )
    dims = {
        "dim_date": ("dim_date", "date_key"),
        "dim_store": ("stores", "store_id"),
        "dim_category": ("dim_category", "category_id"),
        "dim_channel": ("dim_channel", "channel_id"),
        "dim_customer": ("dim_customer", "customer_id"),
    }
    for name, (table, key) in dims.items():
        rules += [
            (
                f"fact_sales.{key} not in {name}",
                f"SELECT count(*) FROM fact f LEFT JOIN {table} d ON d.{key} = f.{key}"
                f" WHERE d.{key} IS NULL",
            ),
            (f"{name} key is null", f"SELECT count(*) FROM {table} WHERE {key} IS NULL"),
            (f"{name} key repeats", f"SELECT count({key}) - count(DISTINCT {key}) FROM {table}"),
        ]
    required = {
        "dim_date": "dim_date", "dim_store": "stores", "dim_category": "dim_category",
        "dim_channel": "dim_channel",
    }
    columns = {
        "dim_date": "year month month_name quarter day_of_week is_weekend fiscal_year"
        " fiscal_month season",
        "dim_store": "store_name city",
        "dim_category": "category price_band",
        "dim_channel": "channel is_physical",
    }
    for name, table in required.items():
        missing = " OR ".join(f"{c} IS NULL" for c in columns[name].split())
        rules.append((f"{name} has a null", f"SELECT count(*) FROM {table} WHERE {missing}"))
    rules.append(
        (
            "budget has a null",
            "SELECT count(*) FROM planned WHERE budget_qty IS NULL OR price IS NULL"
            " OR budget_revenue IS NULL",
        )
    )
    plan_keys = "fiscal_year IS NULL OR month IS NULL OR category IS NULL"
    rules += [
        ("budget key is null", f"SELECT count(*) FROM planned WHERE {plan_keys}"),
        (
            "budget key repeats",
            "SELECT count(*) - count(DISTINCT (fiscal_year, month, category)) FROM planned"
            f" WHERE NOT ({plan_keys})",
        ),
        (
            "budget revenue without units",
            "SELECT count(*) FROM planned WHERE budget_qty = 0 AND budget_revenue > 0",
        ),
        (
            "monthly_kpi revenue differs from fact_sales",
            "SELECT count(*) FROM (SELECT sum(net_amount) AS a FROM fact),"
            " (SELECT sum(net_amount) AS b FROM detail) WHERE abs(a - b) > 1",
        ),
        (
            "transactions not in fact_sales",
            "SELECT (SELECT count(*) FROM tx) - (SELECT count(*) FROM fact)",
        ),
        (
            "channel_mix shares do not add to 100",
            "SELECT count(*) FROM (SELECT sum(pct_of_revenue) AS share FROM mix"
            " GROUP BY fiscal_year) WHERE abs(share - 100) >= 0.1",
        ),
        (
            "dim_date fiscal calendar is off",
            "SELECT count(*) FROM dim_date WHERE (month = 4) <> (fiscal_month = 1)"
            " OR CAST(substr(fiscal_year, 3, 4) AS INTEGER) <>"
            " CASE WHEN month < 4 THEN year - 1 ELSE year END",
        ),
    ]
    rules += [
        (f"{t}.{c} repeats", f"SELECT count({c}) - count(DISTINCT {c}) FROM {t}")
        for t, c in (("dim_category", "category"), ("dim_channel", "channel"))
    ]
    body = "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"check\", CAST(({count}) AS BIGINT) AS violations"
        for name, count in rules
    )
    return _with(f"{_plan(prior, year)}, mix AS ({_MIX})", body)


def statements(year: str, prior: str, as_of: dt.date) -> dict[str, str]:
    store = "store_id, "
    by_cat = "category, "
    gap = _variance(prior, year)
    gap_store = _variance(prior, year, store)
    miss = f"SELECT {_VARIANCE_SELECT} ORDER BY variances.total_variance, category LIMIT 1"
    stored = "dim_date dim_category dim_channel dim_customer".split()
    table_rows = [(t, t) for t in stored] + [
        ("dim_store", "stores"), ("fact_sales", "fact"), ("budget", "planned"),
    ]
    fact_money = ", ".join(
        f"{dbl(c)} AS {c}"
        for c in ("unit_price", "discount_pct", "net_amount", "cogs", "gross_margin")
    )
    grain = "fiscal_year, year, month, month_name, season, store_name, category, price_band, channel"
    grain_rows = _with(
        "",
        f"SELECT {grain}, count(DISTINCT transaction_id) AS bills,"
        f" CAST(sum(quantity) AS BIGINT) AS units, {dbl('sum(net_amount)')} AS revenue,"
        f" {dbl('sum(gross_margin)')} AS gross_margin FROM detail GROUP BY ALL",
    )
    decile_rows = _with(
        _DECILES,
        f"SELECT decile, customers, {dbl('revenue')} AS revenue,"
        f" {_DECILE_SHARE} AS pct_of_revenue FROM deciles",
    )
    budget_rows = _with(
        _plan(prior, year),
        f"SELECT fiscal_year, month, category, budget_qty, price AS budget_price,"
        f" {dbl('budget_revenue')} AS budget_revenue FROM planned",
    )
    rfm_select = (
        f"SELECT customer_id, last_purchase, first_purchase, frequency,"
        f" {dbl('monetary')} AS monetary, recency_days, tenure_days, avg_gap_days,"
        " expected_gap, overdue_ratio, R, F, M, rfm_score, avg_order_value, segment FROM rfm"
    )
    filled = lambda end: f"""SELECT store_id, period, coalesce({dbl("revenue")}, 0) AS revenue FROM (
                SELECT store_id, CAST(unnest(generate_series(
                    min(period), {end}, INTERVAL 1 MONTH)) AS DATE) AS period
                FROM series WHERE last_day(period) <= (SELECT max(date_key) FROM detail)
                GROUP BY store_id)
            LEFT JOIN series USING (store_id, period)"""  # noqa: E731
    last_whole = """(SELECT max(period) FROM series
        WHERE last_day(period) <= (SELECT max(date_key) FROM detail))"""
    totals = _with(
        "", f"SELECT count(*) AS fact_rows, {dbl('sum(net_amount)')} AS revenue FROM tx"
    )
    return {
        "dim_date": _with("", "SELECT * FROM dim_date"),
        "dim_store": _with("", "SELECT * FROM stores"),
        "dim_category": _with("", "SELECT * FROM dim_category"),
        "dim_channel": _with("", "SELECT * FROM dim_channel"),
        "dim_customer": _with("", "SELECT * FROM dim_customer"),
        "fact_sales": _with(
            "",
            "SELECT transaction_id, date_key, store_id, category_id, channel_id, customer_id,"
            f" quantity, {fact_money} FROM fact",
        ),
        "sales_detail": _with(
            "",
            "SELECT transaction_id, date_key, year, month, month_name, fiscal_year, fiscal_month,"
            " season, is_weekend, store_name, category, price_band, channel, is_physical,"
            f" customer_id, quantity, {fact_money} FROM detail",
        ),
        "load_totals": totals,
        "stored_load_totals": totals,
        "stored_tables": _with(
            _plan(prior, year),
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS rows FROM {table}"
                for name, table in table_rows
            ),
        ),
        "stored_year_sales": _with(
            "",
            "SELECT fiscal_year, category, price_band, channel, count(*) AS lines,"
            f" {dbl('sum(net_amount)')} AS revenue FROM detail"
            f" WHERE fiscal_year = '{year}' GROUP BY ALL",
        ),
        "extract_report": _with("", _extract_checks()),
        "contract_report": _contracts(prior, year),
        "monthly_kpi": _with("", _KPI),
        "channel_mix": _with("", _MIX),
        "customer_concentration": decile_rows,
        "exported_concentration": decile_rows,
        "exported_monthly_kpi": _with("", _KPI),
        "concentration_cumulative": _with(
            _DECILES,
            f"SELECT decile, CAST(sum(customers) {_CUM} AS BIGINT) AS cum_customers,"
            f" {dbl(f'sum(revenue) {_CUM}')} AS cum_revenue,"
            f" {_CUM_SHARE} AS cum_pct_of_revenue FROM deciles",
        ),
        "monthly_grain": grain_rows,
        "monthly_grain_stored": grain_rows,
        "exported_monthly_grain": grain_rows,
        "exported_channel_mix": _with("", _MIX),
        "csv_transactions": _with(
            "",
            "SELECT transaction_id, date_key AS transaction_date, CAST(store_id AS VARCHAR) AS"
            " store_id, CAST(customer_id AS VARCHAR) AS customer_id, category, channel, quantity,"
            f" {dbl('unit_price')} AS unit_price, {dbl('discount_pct')} AS discount_pct,"
            f" {dbl('net_amount')} AS net_amount, {dbl('cogs')} AS cogs FROM tx",
        ),
        "csv_stores": _with(
            "", "SELECT CAST(store_id AS VARCHAR) AS store_id, store_name, city FROM stores"
        ),
        "csv_budget": budget_rows,
        "season_rollup": _with(
            "", f"SELECT season, {dbl('sum(net_amount)')} AS revenue FROM detail GROUP BY season"
        ),
        "budget_plan": budget_rows,
        "actuals_by_category": _with(
            gap,
            f"SELECT category, actual_qty, {dbl('actual_revenue')} AS actual_revenue FROM actual",
        ),
        "budget_by_category": _with(
            gap,
            f"SELECT category, budget_qty, {dbl('budget_revenue')} AS budget_revenue"
            " FROM budgeted",
        ),
        "variance_by_category": _with(gap, f"SELECT {_VARIANCE_SELECT}"),
        "variance_by_store": _with(gap_store, f"SELECT store_id, {_VARIANCE_SELECT}"),
        "variance_bridge": _with(
            gap, f"SELECT step_no, step, {dbl('value')} AS value, kind FROM bridge"
        ),
        "bridge_by_store": _with(
            gap_store, f"SELECT store_id, step_no, step, {dbl('value')} AS value, kind FROM bridge"
        ),
        "variance_reconciliation": _with(
            gap,
            "SELECT CAST(abs(sum(price_variance + volume_variance + mix_variance)"
            " - sum(total_variance)) AS DOUBLE) AS reconciliation_error FROM variances",
        ),
        "largest_miss": _with(gap, miss),
        "waterfall_frame": _with(gap, _waterfall()),
        "waterfall_by_store": _with(gap_store, _waterfall(store)),
        "rfm_customers": _with(
            _rfm(),
            rfm_select,
        ),
        "rfm_customers_as_of": _with(_rfm(f"DATE '{as_of}'"), rfm_select),
        "rfm_segments": _with(_rfm(), "SELECT * FROM shares"),
        "segment_shares": _with(
            _rfm(), "SELECT segment, pct_of_customers, pct_of_revenue FROM shares"
        ),
        "monthly_series": _with(
            _series(), f"SELECT period, {dbl('revenue')} AS revenue FROM series"
        ),
        "seasonal_indices": _with(_series() + _indices("idx", "series"), "SELECT * FROM idx"),
        "weakest_month": _with(
            _series() + _indices("idx", "series"),
            "SELECT month, seasonal FROM idx ORDER BY seasonal, month LIMIT 1",
        ),
        "revenue_forecast": _with(
            _series() + _forecast("fc", "series", r.HORIZON_MONTHS),
            "SELECT * EXCLUDE (step) FROM fc",
        ),
        "forecast_backtest": _with(_backtest(r.HOLDOUT_MONTHS), "SELECT * FROM bt"),
        "history_and_forecast": _with(
            _series() + _forecast("fc", "series", r.HORIZON_MONTHS),
            f"SELECT period, 'actual' AS kind, {dbl('revenue')} AS revenue,"
            " CAST(NULL AS DOUBLE) AS forecast, CAST(NULL AS DOUBLE) AS lower_80,"
            " CAST(NULL AS DOUBLE) AS upper_80 FROM series"
            " UNION ALL SELECT period, 'forecast', NULL, forecast, lower_80, upper_80 FROM fc",
        ),
        "forecast_by_category": _with(
            _series(by_cat) + _forecast("fc", "series", r.HORIZON_MONTHS, by_cat),
            "SELECT * EXCLUDE (step) FROM fc",
        ),
        "backtest_by_category": _with(_backtest(r.HOLDOUT_MONTHS, by_cat), "SELECT * FROM bt"),
        "indices_by_category": _with(
            _series(by_cat) + _indices("idx", "series", by_cat), "SELECT * FROM idx"
        ),
        "forecast_by_store": _with(
            _series(store) + _forecast("fc", "series", r.HORIZON_MONTHS, store),
            "SELECT * EXCLUDE (step) FROM fc",
        ),
        "backtest_by_store": _with(_backtest(r.HOLDOUT_MONTHS, store), "SELECT * FROM bt"),
        "filled_series_by_store": _with(_series(store), filled("max(period)")),
        "filled_series_to_common_end": _with(_series(store), filled(last_whole)),
        "revenue_forecast_year": _with(
            _series() + _forecast("fc", "series", 12), "SELECT * EXCLUDE (step) FROM fc"
        ),
        "run_summary": _with(
            f"{gap}{_backtest(r.HOLDOUT_MONTHS)}",
            f"SELECT '{year}' AS fiscal_year, (SELECT CAST(abs(sum(price_variance + volume_variance"
            " + mix_variance) - sum(total_variance)) AS DOUBLE) FROM variances)"
            " AS reconciliation_error_inr, CAST(step_no - 1 AS INTEGER) AS place, step,"
            f" {dbl('value')} AS value, kind, status, CAST(holdout_months AS BIGINT) AS holdout_months,"
            " model_mape_pct, seasonal_naive_mape_pct, improvement_pct_points, verdict"
            " FROM bridge, bt",
        ),
        "channel_by_month_sql": _with(
            "",
            "SELECT fiscal_year, fiscal_month, month_name, category, channel,"
            f" CAST(sum(quantity) AS BIGINT) AS units, {dbl('sum(net_amount)')} AS revenue"
            " FROM detail GROUP BY ALL",
        ),
    }
