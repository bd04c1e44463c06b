"""The same results in plain SQL, straight from the star-schema tables.

Each statement is independent of the Spark code: ranks are window functions, ranges are plain joins.
``half_even`` rounds like NumPy: scale, nearest even integer (the cast to BIGINT), scale back.
"""

from __future__ import annotations

MAX_DAY, CAL_END, HALF, CUTOFF, PRE_WEEKS = 2405, 1202, 601, 2040, 26


def half_even(x: str, digits: int) -> str:
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(CAST(CAST({x} AS DOUBLE) * {scale} AS BIGINT) / {scale})"


def mean(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / count({x}))"


def total(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE)"


CTE: dict[str, str] = {}
CTE["txn"] = """
SELECT o_custkey AS household_key, o_orderkey AS basket_id, day,
       CAST((day - 1) // 7 + 1 AS INTEGER) AS week_no,
       l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
       price * (1 - rate) AS sales_value, -(price * rate * (o_custkey % 5)) AS retail_disc
FROM (SELECT o_custkey, o_orderkey, l_partkey, l_quantity,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
             CAST(l_discount AS DECIMAL(4,2)) AS rate,
             CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS INTEGER)
               AS day
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
CTE["basket"] = """
SELECT household_key, basket_id, day, week_no,
       CAST(DATE '1995-01-01' + (day - 1) AS DATE) AS date,
       sum(sales_value) AS spend, CAST(sum(quantity) AS BIGINT) AS n_items
FROM txn GROUP BY ALL"""
CTE["disc"] = f"""
SELECT household_key, sum(retail_disc) AS disc, sum(abs(retail_disc)) AS disc_abs
FROM txn WHERE day <= {CAL_END} GROUP BY household_key"""
CTE["spend"] = f"""
SELECT household_key, sum(spend) AS total_spend, count(*) AS n_baskets,
       CAST(sum(spend) AS DOUBLE) / count(*) AS avg_basket,
       min(day) AS first_day, max(day) AS last_day, max(day) - min(day) AS tenure_days,
       {MAX_DAY} - max(day) AS recency_days,
       count(*) / (CAST({MAX_DAY} AS DOUBLE) / 7) AS weekly_freq,
       coalesce(sum(spend) FILTER (day <= {CAL_END}), 0) AS y1_spend,
       coalesce(sum(spend) FILTER (day > {CAL_END}), 0) AS y2_spend,
       CAST(max(day) < {CUTOFF} AS INTEGER) AS is_churned,
       strftime(DATE '1995-01-01' + (min(day) - 1), '%Y-%m') AS first_month
FROM basket GROUP BY household_key"""
CTE["seg"] = """
SELECT *, CASE WHEN rfm_score >= 13 THEN 'Champions' WHEN rfm_score >= 10 THEN 'Loyal'
               WHEN rfm_score >= 7 THEN 'At Risk' ELSE 'Lost' END AS rfm_segment,
       y1_spend AS predicted_clv, recency_days / CAST(2405 AS DOUBLE) AS churn_probability
FROM (SELECT *, r_score + f_score + m_score AS rfm_score
      FROM (SELECT *,
                   CAST(6 - greatest(1, (5 * (rr - 1) + n - 2) // (n - 1)) AS INTEGER) AS r_score,
                   CAST(greatest(1, (5 * (fr - 1) + n - 2) // (n - 1)) AS INTEGER) AS f_score,
                   CAST(greatest(1, (5 * (mr - 1) + n - 2) // (n - 1)) AS INTEGER) AS m_score
            FROM (SELECT *, count(*) OVER () AS n,
                         row_number() OVER (ORDER BY recency_days, household_key) AS rr,
                         row_number() OVER (ORDER BY n_baskets, household_key) AS fr,
                         row_number() OVER (ORDER BY total_spend, household_key) AS mr
                  FROM spend)))"""
CTE["assign"] = """
SELECT c_custkey AS household_key, CAST(c AS INTEGER) AS campaign,
       CASE WHEN c IN (8, 13, 18, 26, 30) THEN 'TypeA'
            WHEN c IN (3, 6, 14, 15, 20, 27) THEN 'TypeC' ELSE 'TypeB' END AS description
FROM customer, range(1, 31) AS r(c)
WHERE (c_custkey * 31 + c * 17) % 5 = 0 AND c_custkey % 10 < 7"""
CTE["camp"] = """
SELECT campaign, description, 100 + 70 * campaign AS start_day,
       100 + 70 * campaign + 32 + (7 * campaign) % 33 AS end_day
FROM (SELECT CAST(c AS INTEGER) AS campaign,
             CASE WHEN c IN (8, 13, 18, 26, 30) THEN 'TypeA'
                  WHEN c IN (3, 6, 14, 15, 20, 27) THEN 'TypeC' ELSE 'TypeB' END AS description
      FROM range(1, 31) AS r(c))"""
CTE["redeem"] = """
SELECT o_custkey AS household_key,
       datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS day
FROM orders WHERE o_orderpriority = '1-URGENT'"""
CTE["demo"] = """
SELECT c_custkey AS household_key,
       ['19-24', '25-34', '35-44', '45-54', '55-64', '65+'][(c_custkey // 3) % 6 + 1] AS age_desc,
       ['Under 15K', '15-24K', '25-34K', '35-49K', '50-74K', '75-99K', '100-124K', '125-149K',
        '150-174K', '175-199K', '200-249K', '250K+'][band + 1] AS income_desc,
       ['A', 'B', 'U'][(c_custkey // 3) % 3 + 1] AS marital_status_code,
       c_mktsegment AS hh_comp_desc,
       ['Homeowner', 'Renter'][(c_custkey // 3) % 2 + 1] AS homeowner_desc,
       ['1', '2', '3', '4', '5+'][(c_custkey // 3) % 5 + 1] AS household_size_desc,
       [21.5, 29.5, 39.5, 49.5, 59.5, 70.0][(c_custkey // 3) % 6 + 1] AS age_val,
       [12.5, 19.5, 29.5, 42, 62, 87, 112, 137, 162, 187, 224, 275][band + 1] AS income_val
FROM (SELECT *, CAST(least(11, greatest(0, floor((c_acctbal + 1000) / 917))) AS INTEGER) AS band
      FROM customer)"""
CTE["dept"] = """
SELECT household_key, p_type AS department, p_brand AS brand, sum(sales_value) AS sales_value
FROM txn LEFT JOIN part ON product_id = p_partkey GROUP BY ALL"""
CTE["windows"] = f"""
SELECT a.household_key, a.campaign, a.description AS campaign_type, c.start_day,
       c.end_day, greatest(c.start_day - 7 * {PRE_WEEKS}, 1) AS pre_start,
       greatest((c.end_day - c.start_day) / CAST(7 AS DOUBLE), 1.0::DOUBLE) AS dur_weeks
FROM assign a JOIN camp c ON a.campaign = c.campaign"""
CTE["upl"] = f"""
SELECT campaign, campaign_type, household_key, {half_even('pre_w', 2)} AS pre_weekly_spend,
       {half_even('dur_w', 2)} AS during_weekly_spend,
       {half_even('dur_w - pre_w', 2)} AS uplift_weekly, dur_weeks,
       {half_even('(dur_w - pre_w) * dur_weeks', 2)} AS total_uplift
FROM (SELECT campaign, campaign_type, w.household_key, dur_weeks,
             CAST(sum(spend) FILTER (day < start_day) AS DOUBLE) / CAST({PRE_WEEKS} AS DOUBLE)
               AS pre_w,
             CAST(coalesce(sum(spend) FILTER (day >= start_day), 0) AS DOUBLE) / dur_weeks AS dur_w
      FROM windows w JOIN basket b
        ON w.household_key = b.household_key AND day BETWEEN pre_start AND end_day
      GROUP BY campaign, campaign_type, w.household_key, dur_weeks
      HAVING coalesce(sum(spend) FILTER (day < start_day), 0) <> 0)"""
_D2 = "CAST({} AS DECIMAL(18,2))"
CTE["bytype"] = f"""
SELECT campaign_type, count(*) AS n_rows, count(DISTINCT household_key) AS n_households,
       {mean(_D2.format('pre_weekly_spend'))} AS pre,
       {mean(_D2.format('during_weekly_spend'))} AS during,
       {mean(_D2.format('uplift_weekly'))} AS uplift, avg(dur_weeks) AS duration,
       {total(_D2.format('total_uplift'))} AS total_uplift, stddev_samp(uplift_weekly) AS sd,
       CASE campaign_type WHEN 'TypeA' THEN 1.5::DOUBLE WHEN 'TypeB' THEN 0.8::DOUBLE
                          ELSE 0.5::DOUBLE END AS unit_cost
FROM upl GROUP BY campaign_type"""
# Two-sided p-value as the regularised incomplete beta function of v / (v + t * t) at (v / 2, 1 / 2),
# from its continued fraction; of the two equal forms the one that converges fast.
CTE["tstat"] = """
SELECT campaign_type, n_rows, uplift, sd, t_stat, x,
       CASE WHEN flip THEN 1 - x ELSE x END AS y, flip,
       CASE WHEN flip THEN 0.5::DOUBLE ELSE v / 2 END AS a, CASE WHEN flip THEN v / 2 ELSE 0.5::DOUBLE END AS b
FROM (SELECT *, v / (v + t_stat * t_stat) AS x,
             v / (v + t_stat * t_stat) >= (v / 2 + 1) / (v / 2 + 2.5) AS flip
      FROM (SELECT campaign_type, n_rows, uplift, sd, uplift / (sd / sqrt(n_rows)) AS t_stat,
                   CAST(n_rows - 1 AS DOUBLE) AS v FROM bytype))"""
CTE["fraction"] = """
SELECT campaign_type, 0 AS m, a, b, y, 1.0::DOUBLE AS c, 1 / (1 - (a + b) * y / (a + 1)) AS d,
       1 / (1 - (a + b) * y / (a + 1)) AS h FROM tstat
UNION ALL
SELECT campaign_type, m, a, b, y, 1 + odd / even_c, 1 / (1 + odd * even_d),
       even_h * (1 + odd / even_c) / (1 + odd * even_d)
FROM (SELECT *, h * even_c * even_d AS even_h,
             -(a + m) * (a + b + m) * y / ((a + 2 * m) * (a + 1 + 2 * m)) AS odd
      FROM (SELECT campaign_type, m, a, b, y, h, 1 + even / c AS even_c, 1 / (1 + even * d) AS even_d
            FROM (SELECT *, m * (b - m) * y / ((a - 1 + 2 * m) * (a + 2 * m)) AS even
                  FROM (SELECT * REPLACE (m + 1 AS m) FROM fraction WHERE m < 300))))"""
CTE["ttest"] = """
SELECT t.*, CASE WHEN flip THEN 1 - part ELSE part END AS p_value
FROM tstat t JOIN (
  SELECT campaign_type AS ct, h / a * exp(a * ln(y) + b * ln(1 - y)
    + lgamma(a + b) - lgamma(a) - lgamma(b)) AS part
  FROM fraction WHERE m = 300) ON ct = campaign_type"""
CTE["roi"] = f"""
SELECT campaign_type, n_households, {half_even('pre', 2)} AS avg_pre_weekly_spend,
       {half_even('during', 2)} AS avg_during_weekly_spend,
       {half_even('b.uplift', 2)} AS avg_uplift_weekly,
       {half_even('duration', 1)} AS avg_duration_weeks,
       {half_even('total_uplift', 2)} AS total_incremental_rev,
       {half_even('n_households * unit_cost', 2)} AS total_mailer_cost,
       {half_even('total_uplift * 0.27::DOUBLE', 2)} AS gross_profit,
       {half_even('total_uplift / (n_households * unit_cost)', 2)} AS revenue_roi,
       {half_even('total_uplift * 0.27::DOUBLE / (n_households * unit_cost)', 2)} AS net_roi,
       {half_even('p_value', 4)} AS p_value, CAST(p_value < 0.05 AS INTEGER) AS significant,
       unit_cost AS mailer_cost_per_hh
FROM bytype b JOIN ttest USING (campaign_type)"""
CTE["engaged"] = """
SELECT s.*, CAST(a.household_key IS NOT NULL AS INTEGER) AS campaign_engaged
FROM seg s LEFT JOIN (SELECT DISTINCT household_key FROM assign) a USING (household_key)"""
CTE["master"] = f"""
SELECT s.*, coalesce(n_campaigns, 0) AS n_campaigns, coalesce(n_redemptions, 0) AS n_redemptions,
       coalesce(y1_redemptions, 0) AS y1_redemptions,
       coalesce(n_departments, 0) AS n_departments,
       CAST(coalesce(income_val, median(income_val) OVER ()) AS DOUBLE) AS income_val,
       CAST(coalesce(age_val, median(age_val) OVER ()) AS DOUBLE) AS age_val,
       CAST(coalesce(n_campaigns, 0) > 0 AS INTEGER) AS campaign_engaged
FROM spend s
LEFT JOIN (SELECT household_key, count(*) AS n_campaigns FROM assign GROUP BY 1)
  USING (household_key)
LEFT JOIN (SELECT household_key, count(*) AS n_redemptions,
                  count(*) FILTER (day <= {CAL_END}) AS y1_redemptions
           FROM redeem GROUP BY 1) USING (household_key)
LEFT JOIN (SELECT household_key, count(DISTINCT department) AS n_departments
           FROM dept GROUP BY 1) USING (household_key)
LEFT JOIN (SELECT household_key, income_val, age_val FROM demo) USING (household_key)"""
CTE["y1"] = f"""
SELECT b.household_key, sum(spend) AS sp, count(*) AS n,
       CAST(sum(spend) AS DOUBLE) / count(*) AS av,
       coalesce(stddev_samp(CAST(spend AS DOUBLE)), 0) AS sd, min(day) AS d0, max(day) AS d1,
       coalesce(sum(spend) FILTER (day <= {HALF}), 0) AS h1,
       coalesce(sum(spend) FILTER (day > {HALF}), 0) AS h2,
       coalesce(sum(spend) FILTER (day >= {CAL_END} - 28), 0) AS last4
FROM basket b WHERE day <= {CAL_END} GROUP BY b.household_key"""
CTE["features"] = f"""
SELECT m.household_key,
       coalesce(CAST(sp AS DOUBLE), 0) AS y1_total_spend,
       coalesce(CAST(n AS DOUBLE), 0) AS y1_n_baskets, coalesce(av, 0) AS y1_avg_basket,
       coalesce(sd, 0) AS y1_std_basket,
       coalesce(CASE WHEN av > 0 THEN sd / av ELSE 0 END, 0) AS y1_spend_cv,
       CAST(coalesce({CAL_END} - d1, 0) AS DOUBLE) AS y1_recency,
       CAST(coalesce(d1 - d0, 0) AS DOUBLE) AS y1_tenure,
       coalesce(CAST(h1 AS DOUBLE), 0) AS y1_spend_h1,
       coalesce(CAST(h2 AS DOUBLE), 0) AS y1_spend_h2,
       CASE WHEN n IS NULL THEN 0 WHEN h1 > 0 THEN CAST(h2 AS DOUBLE) / CAST(h1 AS DOUBLE)
            ELSE 1 END AS y1_spend_trend,
       coalesce(CAST(last4 AS DOUBLE), 0) AS y1_last4wk_spend,
       CASE WHEN sp > 0 THEN CAST(abs(disc) AS DOUBLE) / CAST(sp AS DOUBLE) ELSE 0 END
         AS y1_disc_ratio,
       CAST(n_departments AS DOUBLE) AS n_departments,
       CAST(campaign_engaged AS DOUBLE) AS campaign_engaged,
       CAST(y1_redemptions AS DOUBLE) AS y1_redemptions, income_val, age_val,
       CAST(y2_spend AS DOUBLE) AS y2_spend
FROM master m LEFT JOIN y1 USING (household_key) LEFT JOIN disc USING (household_key)"""
CTE["coh"] = f"""
SELECT first_month AS first_quarter, count(*) AS n_customers, {mean('total_spend')} AS avg_spend,
       {mean('n_baskets')} AS avg_baskets, {mean('predicted_clv')} AS avg_clv,
       {mean('is_churned')} AS churn_rate, {mean('campaign_engaged')} AS pct_campaign
FROM engaged GROUP BY first_month HAVING count(*) >= 20"""
CTE["activity"] = """
SELECT cohort, months_since, count(DISTINCT household_key) AS n_active
FROM (SELECT household_key, strftime(min(date) OVER w, '%Y-%m') AS cohort,
             datediff('month', min(date) OVER w, date) AS months_since
      FROM basket WINDOW w AS (PARTITION BY household_key))
GROUP BY ALL"""
CTE["retention"] = f"""
SELECT s.cohort AS cohort_month, CAST(m.months_since AS INTEGER) AS months_since,
       {half_even('coalesce(a.n_active, 0) / s.n_active * 100', 1)} AS retention_pct
FROM (SELECT * FROM activity WHERE months_since = 0 AND n_active >= 20) s
CROSS JOIN (SELECT DISTINCT months_since FROM activity) m
LEFT JOIN activity a ON a.cohort = s.cohort AND a.months_since = m.months_since"""
CTE["weekly"] = f"""
SELECT week_no, {half_even(total('spend'), 2)} AS total_spend, count(*) AS n_baskets,
       count(DISTINCT household_key) AS n_households,
       {half_even(total('spend') + ' / count(*)', 2)} AS avg_basket
FROM basket GROUP BY week_no"""
CTE["ranges"] = """
SELECT campaign, description, CAST((start_day - 1) // 7 + 1 AS INTEGER) AS start_week,
       CAST((end_day - 1) // 7 + 1 AS INTEGER) AS end_week, start_day, end_day FROM camp"""
CTE["catseg"] = f"""
SELECT rfm_segment, department, {total('sales_value')} AS total_spend,
       count(DISTINCT household_key) AS n_households,
       {half_even(total('sales_value') + ' / count(DISTINCT household_key)', 2)}
         AS avg_spend_per_hh
FROM dept JOIN seg USING (household_key) WHERE department IS NOT NULL GROUP BY ALL"""
CTE["sens"] = f"""
SELECT rfm_segment, disc_bucket, count(*) AS n_customers,
       {half_even(mean('total_spend'), 2)} AS avg_2yr_spend,
       {half_even(mean('predicted_clv'), 2)} AS avg_clv, {half_even('avg(ratio)', 2)}
         AS avg_disc_ratio
FROM (SELECT s.*, ratio, CASE WHEN ratio < 0 THEN NULL WHEN ratio <= 0.05::DOUBLE THEN '<5%'
             WHEN ratio <= 0.1::DOUBLE THEN '5-10%' WHEN ratio <= 0.15::DOUBLE THEN '10-15%'
             WHEN ratio <= 0.2::DOUBLE THEN '15-20%' WHEN ratio <= 1.01::DOUBLE THEN '20%+' END
               AS disc_bucket
      FROM seg s JOIN (SELECT household_key, CAST(disc_abs AS DOUBLE) / CAST(sp AS DOUBLE) AS ratio
                       FROM y1 JOIN disc USING (household_key) WHERE sp <> 0) USING (household_key))
WHERE disc_bucket IS NOT NULL GROUP BY ALL"""
CTE["catspend"] = """
SELECT p_type AS department, count(DISTINCT basket_id) AS n_baskets,
       CAST(round(sum(sales_value), 2) AS DOUBLE) AS total_spend,
       ((2 * CAST(sum(sales_value) * 10000 AS HUGEINT) + 100 * count(*)) // (200 * count(*)))
         / 100.0::DOUBLE AS avg_item_spend,
       count(DISTINCT household_key) AS n_households
FROM txn JOIN part ON product_id = p_partkey GROUP BY p_type"""
CTE["summary"] = f"""
SELECT household_key, count(DISTINCT basket_id) AS n_baskets,
       CAST(round(sum(spend), 2) AS DOUBLE) AS total_spend,
       ((2 * CAST(sum(spend) * 10000 AS HUGEINT) + 100 * count(*)) // (200 * count(*)))
         / 100.0::DOUBLE AS avg_basket,
       min(day) AS first_day, max(day) AS last_day, max(day) - min(day) AS tenure_days,
       {MAX_DAY} - max(day) AS recency_days
FROM basket GROUP BY household_key"""
CTE["buyers"] = """
SELECT s.household_key, total_spend, n_baskets,
       CASE WHEN a.household_key IS NOT NULL THEN 'Campaign' ELSE 'Organic' END AS buyer_type
FROM summary s LEFT JOIN (SELECT DISTINCT household_key FROM assign) a
  ON s.household_key = a.household_key"""
CTE["scen"] = f"""
SELECT scenario, n_households, CAST(cost AS BIGINT) AS mailer_cost,
       CAST(gained AS BIGINT) AS incremental_revenue,
       {half_even('CASE WHEN cost > 0 THEN gained / cost ELSE 0 END', 2)} AS revenue_roi,
       CAST(blanket - cost AS BIGINT) AS cost_saving, gained, cost
FROM (SELECT unnest([
        {{'scenario': 'Blanket TypeA', 'n_households': n, 'cost': n * 1.5::DOUBLE, 'gained': ga * n}},
        {{'scenario': 'Targeted (RFM)', 'n_households': k + r,
          'cost': r * 1.5::DOUBLE + k * 0.8::DOUBLE, 'gained': ga * r + gb * k}},
        {{'scenario': 'CLV-Gated', 'n_households': g, 'cost': g * 1.5::DOUBLE, 'gained': ga * g}}],
        recursive := true), n * 1.5::DOUBLE AS blanket
      FROM (SELECT count(*) AS n, count(*) FILTER (rfm_segment IN ('Champions', 'Loyal')) AS k,
                   count(*) FILTER (rfm_segment = 'At Risk') AS r,
                   count(*) FILTER (predicted_clv > 3) AS g FROM seg),
           (SELECT max(avg_uplift_weekly * avg_duration_weeks) FILTER (campaign_type = 'TypeA') AS ga,
                   max(avg_uplift_weekly * avg_duration_weeks) FILTER (campaign_type = 'TypeB') AS gb
            FROM roi))"""
CTE["risk"] = """
SELECT count(*) AS n_households, count(*) FILTER (churn_probability >= 0.7) AS n_high_risk,
       CAST(coalesce(sum(predicted_clv) FILTER (churn_probability >= 0.7), 0) AS DOUBLE)
         AS revenue_at_risk
FROM seg"""


# Logistic regression by Newton steps: sums of the training rows as an augmented matrix, eliminated
# pivot by pivot. The features are standardised on the training rows.
_CHURN = ["n_baskets", "total_spend", "avg_basket", "tenure_days", "campaign_engaged",
          "n_departments", "income_val", "age_val", "weekly_freq"]
NEWTON_STEPS = 12
CTE["churnsplit"] = f"""
SELECT household_key, r <= greatest(1, CAST(n * 0.2::DOUBLE AS BIGINT)) AS in_test
FROM (SELECT household_key, count(*) OVER (PARTITION BY is_churned) AS n,
             row_number() OVER (PARTITION BY is_churned
               ORDER BY ((household_key % 2147483648) * {(2654435761 + 42 * 97003657) % 4294967296 | 1} % 4294967291),
                        household_key) AS r FROM spend)"""
CTE["churnraw"] = (
    "SELECT household_key, m.is_churned AS y, in_test, "
    + ", ".join(f"coalesce(CAST(m.{c} AS DOUBLE), 0) AS f{k}" for k, c in enumerate(_CHURN, 1))
    + " FROM master m JOIN churnsplit USING (household_key)"
)
CTE["churnstats"] = (
    "SELECT count(*) AS n, sum(y) AS positives, "
    + ", ".join(f"avg(f{k}) AS a{k}, stddev_pop(f{k}) AS s{k}" for k in range(1, 10))
    + " FROM churnraw WHERE NOT in_test"
)
CTE["churnrows"] = (
    "SELECT household_key, y, in_test, 1.0::DOUBLE AS x1, "
    "CASE WHEN y = 1 THEN n / (2 * positives) ELSE n / (2 * (n - positives)) END AS w, "
    + ", ".join(
        f"(f{k} - a{k}) / CASE WHEN s{k} > 0 THEN s{k} ELSE 1 END AS x{k + 1}" for k in range(1, 10)
    )
    + " FROM churnraw, churnstats"
)
CTE["beta0"] = "SELECT list_transform(range(0, 10), lambda i: 0.0::DOUBLE) AS b"


def _linear(names: list[str]) -> str:
    return " + ".join(f"b[{k}] * {x}" for k, x in enumerate(names, 1))


_X = [f"x{k}" for k in range(1, 11)]
for _k in range(1, NEWTON_STEPS + 1):
    _lines = ", ".join(
        "[" + ", ".join(
            f"sum(h * {x} * {z}){' + 1' if x == z and x != 'x1' else ''}" for z in _X
        ) + f", sum(g * {x}){'' if x == 'x1' else f' + any_value(b[{i}])'}]"
        for i, x in enumerate(_X, 1)
    )
    CTE[f"sums{_k}"] = (
        f"SELECT 0 AS done, [{_lines}] AS m FROM (SELECT *, w * (p - y) AS g, w * p * (1 - p) AS h"
        f" FROM (SELECT *, 1 / (1 + exp(-({_linear(_X)}))) AS p FROM churnrows, beta{_k - 1}"
        " WHERE NOT in_test))"
    )
    CTE[f"solved{_k}"] = f"""
SELECT done, m FROM sums{_k} UNION ALL
SELECT done + 1, list_transform(m, lambda row, i: CASE
  WHEN i = done + 1 THEN list_transform(row, lambda v: v / row[done + 1])
  ELSE list_transform(list_zip(row, m[done + 1]),
         lambda q: q[1] - row[done + 1] / m[done + 1][done + 1] * q[2]) END)
FROM solved{_k} WHERE done < 10"""
    CTE[f"beta{_k}"] = (
        f"SELECT list_transform(range(1, 11), lambda i: b[i] - m[i][11]) AS b"
        f" FROM solved{_k}, beta{_k - 1} WHERE done = 10"
    )
CTE["churned"] = (
    f"SELECT household_key, y, in_test, 1 / (1 + exp(-({_linear(_X)}))) AS p"
    f" FROM churnrows, beta{NEWTON_STEPS}"
)


def statement(body: str) -> str:
    """Prefix the named parts a statement uses, directly or through other parts."""
    import re

    used: list[str] = []
    open_parts: set[str] = set()

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN|,)\s+\(?\s*([a-z0-9]+)\b", text)):
            if word in CTE and word not in used and word not in open_parts:
                open_parts.add(word)
                visit(CTE[word])
                used.append(word)

    visit(body)
    parts = ",\n".join(f"{name} AS ({CTE[name]})" for name in used)
    return f"WITH RECURSIVE {parts}\n{body}" if parts else body


def by_segment(columns: str, source: str = "seg") -> str:
    return f"SELECT rfm_segment, {columns} FROM {source} GROUP BY rfm_segment"


def histogram(source: str, value: str, top: float | str, bins: int = 30) -> str:
    return f"""
SELECT CAST(b AS INTEGER) AS bin, low + b * width AS low, low + (b + 1) * width AS high,
       count(i) AS n
FROM (SELECT CASE WHEN lo < hi THEN lo ELSE lo - 0.5 END AS low,
             ((CASE WHEN lo < hi THEN hi ELSE hi + 0.5 END)
              - (CASE WHEN lo < hi THEN lo ELSE lo - 0.5 END)) / CAST({bins} AS DOUBLE) AS width
      FROM (SELECT min(least(CAST({value} AS DOUBLE), {top}::DOUBLE)) AS lo,
                   max(least(CAST({value} AS DOUBLE), {top}::DOUBLE)) AS hi FROM {source}))
CROSS JOIN range(0, {bins}) AS r(b)
LEFT JOIN (SELECT least(CAST({value} AS DOUBLE), {top}::DOUBLE) AS i FROM {source})
  ON least(floor((i - low) / width), {bins - 1}) = b
GROUP BY ALL"""


def pivot_columns(label: str, value: str, pairs: list[tuple[str, str]], default: str = "") -> str:
    cells = [
        f"max(CASE WHEN {label} = {key} THEN {value} END)" for key, _ in pairs
    ]
    if default:
        cells = [f"coalesce({c}, {default})" for c in cells]
    return ", ".join(f'{c} AS "{name}"' for c, (_, name) in zip(cells, pairs))


_SEG_NAMES = [
    ("'Champions'", "champions"), ("'Loyal'", "loyal"), ("'At Risk'", "at_risk"),
    ("'Lost'", "lost"),
]


def _hash(seed: int) -> str:
    multiplier = (2654435761 + seed * 97003657) % 4294967296 | 1
    return f"((household_key % 2147483648) * {multiplier} % 4294967291)"


def _detail(name: str) -> str:
    return f"""SELECT rfm_segment, {name}, count(*) AS n_households
FROM seg JOIN demo USING (household_key) WHERE {name} IS NOT NULL GROUP BY ALL"""


_MEASURES = [
    "total_spend", "n_baskets", "avg_basket", "first_day", "last_day", "tenure_days", "recency_days",
    "is_churned", "weekly_freq", "y1_spend", "y2_spend", "n_campaigns", "n_redemptions",
    "y1_redemptions", "n_departments", "income_val", "age_val", "campaign_engaged",
]

_BODIES = {
    "customer_summary": "SELECT * FROM summary",
    "campaign_summary": """SELECT description, count(DISTINCT household_key) AS n_households,
count(DISTINCT campaign) AS n_campaigns FROM assign GROUP BY description""",
    "weekly_spend": """SELECT household_key, week_no,
CAST(round(sum(sales_value), 2) AS DOUBLE) AS weekly_spend, count(DISTINCT basket_id) AS n_baskets
FROM txn GROUP BY household_key, week_no""",
    "category_spend": "SELECT * FROM catspend",
    "buyer_segments": "SELECT * FROM buyers",
    "basket_fact": """SELECT household_key, basket_id, day, week_no, date,
CAST(spend AS DOUBLE) AS spend, n_items FROM basket""",
    "load_summary": f"""SELECT count(*) AS n_baskets, count(DISTINCT household_key) AS n_households,
min(date) AS first_date, max(date) AS last_date, {total('spend')} AS total_revenue,
{total('spend')} / count(*) AS avg_basket, count(*) FILTER (day <= {CAL_END}) AS n_baskets_y1,
count(*) FILTER (day > {CAL_END}) AS n_baskets_y2 FROM basket""",
    "customer_master": """SELECT household_key, CAST(total_spend AS DOUBLE) AS total_spend, n_baskets,
avg_basket, first_day, last_day, tenure_days, recency_days, is_churned, weekly_freq,
CAST(y1_spend AS DOUBLE) AS y1_spend, CAST(y2_spend AS DOUBLE) AS y2_spend, n_campaigns,
n_redemptions, y1_redemptions, n_departments, income_val, age_val, campaign_engaged FROM master""",
    "master_summary": f"""SELECT count(*) AS n_households, {mean('total_spend')} AS avg_spend,
{mean('n_baskets')} AS avg_baskets, CAST(sum(campaign_engaged) AS BIGINT) AS n_engaged,
{mean('campaign_engaged')} * 100 AS pct_engaged, count(*) FILTER (n_redemptions > 0) AS n_redeemers
FROM master""",
    "churn_label": "SELECT household_key, last_day, is_churned FROM spend",
    "y1_features": f"""SELECT * REPLACE ({half_even('y1_std_basket', 6)} AS y1_std_basket,
{half_even('y1_spend_cv', 6)} AS y1_spend_cv) FROM features""",
    "naive_baseline": f"""SELECT count(*) AS n,
{half_even('avg(abs(y1_spend::DOUBLE - y2_spend::DOUBLE))', 4)} AS naive_mae,
{half_even('median(abs(y1_spend::DOUBLE - y2_spend::DOUBLE))', 4)} AS naive_median_ae,
{half_even('avg(abs((SELECT median(y2_spend::DOUBLE) FROM spend) - y2_spend::DOUBLE))', 4)}
  AS constant_mae
FROM spend""",
    "top20_precision_naive": """SELECT k AS top_n, count(*) FILTER (a <= k AND p <= k) AS both,
count(*) FILTER (a <= k AND p <= k) / k AS precision
FROM (SELECT row_number() OVER (ORDER BY y2_spend DESC, household_key) AS a,
             row_number() OVER (ORDER BY y1_spend DESC, household_key) AS p,
             greatest(1, CAST(floor(count(*) OVER () * 0.2::DOUBLE) AS BIGINT)) AS k
      FROM spend) GROUP BY k""",
    "model_splits": f"""SELECT household_key, CAST({_hash(0)} % 5 AS INTEGER) AS fold,
CAST({_hash(43)} % 100 < 15 AS INTEGER) AS early,
CAST({_hash(44)} % 100 < 20 AS INTEGER) AS in_test_set FROM spend""",
    "churn_split": f"""SELECT household_key, is_churned, CAST(r <= greatest(1,
  CAST(n * 0.2::DOUBLE AS BIGINT)) AS INTEGER) AS in_test
FROM (SELECT household_key, is_churned, count(*) OVER (PARTITION BY is_churned) AS n,
  row_number() OVER (PARTITION BY is_churned ORDER BY {_hash(42)}, household_key) AS r
  FROM spend)""",
    "rfm_segments": """SELECT household_key, rfm_segment, rfm_score, r_score, f_score, m_score,
recency_days, n_baskets, CAST(total_spend AS DOUBLE) AS total_spend, avg_basket, tenure_days,
campaign_engaged, is_churned FROM engaged""",
    "rfm_profile": by_segment(f"""count(*) AS n, {half_even(mean('total_spend'), 2)} AS avg_spend,
{half_even(mean('n_baskets'), 2)} AS avg_baskets,
{half_even(mean('avg_basket'), 2)} AS avg_basket_size,
{half_even(mean('recency_days'), 2)} AS avg_recency, {half_even(mean('rfm_score'), 2)} AS avg_rfm"""),
    "rfm_share": by_segment("count(*) AS n, count(*) / sum(count(*)) OVER () * 100 AS pct"),
    "rfm_score_box": by_segment("""min(rfm_score) AS low, quantile_cont(rfm_score, 0.25) AS q1,
median(rfm_score) AS median, quantile_cont(rfm_score, 0.75) AS q3, max(rfm_score) AS high"""),
    "segment_dashboard": by_segment(f"""count(*) AS customers,
{half_even(mean('total_spend'), 1)} AS avg_spend, {half_even(mean('n_baskets'), 1)} AS avg_baskets,
{half_even(mean('avg_basket'), 1)} AS avg_basket,
{half_even(mean('recency_days'), 1)} AS recency_days,
{half_even(mean('is_churned'), 1)} AS churn_rate"""),
    "segment_stats": by_segment(f"""count(*) AS n, {mean('predicted_clv')} AS avg_clv,
{mean('total_spend')} AS avg_spend, {mean('is_churned')} AS churn_rate"""),
    "segment_norms": f"""SELECT rfm_segment, s / max(s) OVER () * 5 AS monetary_norm,
b / max(b) OVER () * 5 AS frequency_norm FROM (
{by_segment(half_even(mean('total_spend'), 2) + ' AS s, ' + half_even(mean('n_baskets'), 2) + ' AS b')})""",
    "churn_by_segment": by_segment(f"{mean('is_churned')} AS churn_rate"),
    "campaign_uplift_detail": "SELECT * FROM upl",
    "campaign_roi": "SELECT * FROM roi",
    "campaign_ttest": f"""SELECT campaign_type, n_rows AS n, {half_even('uplift', 6)} AS mean,
{half_even('sd', 6)} AS sd, {half_even('t_stat', 6)} AS t_stat, {half_even('p_value', 6)} AS p_value
FROM ttest""",
    "campaign_totals": """SELECT CAST(sum(CAST(total_incremental_rev AS DECIMAL(18,2))) AS DOUBLE)
AS total_incremental_rev, CAST(sum(n_households) AS BIGINT) AS n_households FROM roi""",
    "campaign_week_ranges": """SELECT r.*,
(SELECT count(DISTINCT household_key) FROM assign a WHERE a.campaign = r.campaign) AS n_households
FROM ranges r""",
    "campaign_active_weeks": """SELECT week_no, total_spend, count(campaign) AS n_active,
count(*) FILTER (description = 'TypeA') AS n_typea,
count(*) FILTER (description = 'TypeB') AS n_typeb,
count(*) FILTER (description = 'TypeC') AS n_typec
FROM weekly LEFT JOIN ranges ON week_no BETWEEN start_week AND end_week GROUP BY ALL""",
    "uplift_box": """SELECT campaign_type, min(uplift_weekly) AS low,
quantile_cont(uplift_weekly, 0.25) AS q1, quantile_cont(uplift_weekly, 0.5) AS median,
quantile_cont(uplift_weekly, 0.75) AS q3, max(uplift_weekly) AS high
FROM upl GROUP BY campaign_type""",
    "coupon_day_uplift": """SELECT coupon_avg, regular_avg, coupon_avg - regular_avg AS uplift
FROM (SELECT CAST(sum(spend) FILTER (d.day IS NOT NULL) AS DOUBLE)
               / count(*) FILTER (d.day IS NOT NULL) AS coupon_avg,
             CAST(sum(spend) FILTER (d.day IS NULL) AS DOUBLE)
               / count(*) FILTER (d.day IS NULL) AS regular_avg
      FROM basket b LEFT JOIN (SELECT DISTINCT household_key, day FROM redeem) d
        ON b.household_key = d.household_key AND b.day = d.day)""",
    "coupon_redemption_rate": """SELECT a AS campaign_households, r AS redeeming_households,
r * 100.0::DOUBLE / a AS redemption_rate
FROM (SELECT count(DISTINCT household_key) AS a FROM assign),
     (SELECT count(DISTINCT household_key) AS r FROM redeem)""",
    "cohort_results": "SELECT * FROM coh",
    "cohort_extremes": """SELECT first(first_quarter ORDER BY avg_spend DESC, first_quarter)
AS best_cohort, max(avg_spend) AS best_avg_spend,
first(first_quarter ORDER BY avg_spend, first_quarter) AS worst_cohort,
min(avg_spend) AS worst_avg_spend FROM coh""",
    "cohort_metrics_wide": """SELECT first_quarter, 'avg_spend' AS metric, avg_spend AS value FROM coh
UNION ALL SELECT first_quarter, 'avg_baskets', avg_baskets FROM coh
UNION ALL SELECT first_quarter, 'avg_clv', avg_clv FROM coh
UNION ALL SELECT first_quarter, 'churn_rate', churn_rate FROM coh""",
    "cohort_retention": "SELECT * FROM retention",
    "retention_matrix": "SELECT cohort_month, " + pivot_columns(
        "months_since", "retention_pct", [(str(m), f"m{m}") for m in range(13)]
    ) + " FROM retention GROUP BY cohort_month",
    "retention_avg": """SELECT count(DISTINCT cohort_month) AS n_cohorts,
coalesce(CAST(sum(CAST(retention_pct AS DECIMAL(6,1))) FILTER (months_since = 3) AS DOUBLE)
  / count(*) FILTER (months_since = 3), 0) AS avg_m3,
coalesce(CAST(sum(CAST(retention_pct AS DECIMAL(6,1))) FILTER (months_since = 12) AS DOUBLE)
  / count(*) FILTER (months_since = 12), 0) AS avg_m12 FROM retention""",
    "acquisition_trend": f"""SELECT first_month AS first_cal_month, count(*) AS n_new,
{half_even(mean('predicted_clv'), 2)} AS avg_clv, {half_even(mean('total_spend'), 2)} AS avg_spend
FROM seg GROUP BY first_month""",
    "acquisition_by_segment": """SELECT first_month AS first_cal_month, rfm_segment,
count(*) AS n_new FROM seg GROUP BY ALL""",
    "weekly_trend": "SELECT * FROM weekly",
    "peak_week": """SELECT first(week_no ORDER BY total_spend DESC, week_no) AS peak_week,
max(total_spend) AS peak_spend FROM weekly""",
    "monthly_segment_spend": f"""SELECT strftime(date, '%Y-%m') AS cal_month, rfm_segment,
{half_even(total('spend'), 2)} AS total_spend
FROM basket JOIN seg USING (household_key) GROUP BY ALL""",
    "demographics_income": _detail("income_desc"),
    "demographics_age": _detail("age_desc"),
    "demographics_hh_comp": _detail("hh_comp_desc"),
    "demographics_detail": """SELECT household_key, rfm_segment, income_desc, age_desc,
marital_status_code, hh_comp_desc, homeowner_desc, household_size_desc
FROM seg LEFT JOIN demo USING (household_key)""",
    "income_segment_pct": "SELECT income_desc, " + ", ".join(
        half_even(f"count(*) FILTER (rfm_segment = {k}) / count(*) * 100", 1) + f" AS {n}"
        for k, n in _SEG_NAMES
    ) + " FROM seg JOIN demo USING (household_key) GROUP BY income_desc",
    "clv_by_income": f"""SELECT income_desc, {half_even(mean('predicted_clv'), 2)} AS avg_clv,
{half_even(mean('total_spend'), 2)} AS avg_spend, count(*) AS n
FROM seg JOIN demo USING (household_key) WHERE income_desc IS NOT NULL GROUP BY income_desc""",
    "brand_by_segment": f"""SELECT rfm_segment, brand, s AS sales_value, seg_total,
{half_even('s / seg_total * 100', 2)} AS pct
FROM (SELECT rfm_segment, brand, {total('sales_value')} AS s,
             CAST(sum(sum(sales_value)) OVER (PARTITION BY rfm_segment) AS DOUBLE) AS seg_total
      FROM dept JOIN seg USING (household_key) WHERE brand IS NOT NULL
      GROUP BY rfm_segment, brand)""",
    "category_by_segment": "SELECT * FROM catseg",
    "category_pivot": "SELECT department, " + pivot_columns(
        "rfm_segment", "avg_spend_per_hh", _SEG_NAMES, "0.0"
    ) + """ FROM catseg WHERE department IN (SELECT department FROM catseg GROUP BY department
ORDER BY sum(total_spend) DESC, department LIMIT 10) GROUP BY department""",
    "top_departments": "SELECT * FROM catspend ORDER BY total_spend DESC, department LIMIT 10",
    "department_revenue": f"""SELECT department, {total('sales_value')} AS sales_value FROM dept
WHERE department IS NOT NULL GROUP BY department ORDER BY sales_value DESC, department LIMIT 10""",
    "brand_revenue": f"""SELECT brand, {total('sales_value')} AS sales_value FROM dept
WHERE brand IS NOT NULL GROUP BY brand""",
    "discount_sensitivity": "SELECT * FROM sens",
    "discount_pivot": "SELECT rfm_segment, " + pivot_columns("disc_bucket", "n_customers", [
        ("'<5%'", "under_5"), ("'5-10%'", "from_5_to_10"), ("'10-15%'", "from_10_to_15"),
        ("'15-20%'", "from_15_to_20"), ("'20%+'", "over_20"),
    ], "0") + " FROM sens GROUP BY rfm_segment",
    "spend_histogram": histogram("spend", "total_spend", 6_000_000.0),
    "basket_histogram": histogram("spend", "n_baskets", 300.0),
    "basket_size_histogram": histogram("basket", "spend", 600_000.0),
    "clv_histogram": f"SELECT bin, {half_even('low', 4)} AS low, {half_even('high', 4)} AS high, n "
    f"FROM ({histogram('spend', 'y1_spend', '(SELECT quantile_cont(y1_spend::DOUBLE, 0.99) FROM spend)')})",
    "churn_histogram": histogram("seg", "churn_probability", 1e9),
    "spend_medians": " UNION ALL ".join(
        f"SELECT '{name}' AS measure, {half_even(f'quantile_cont({col}::DOUBLE, {q})', 4)} AS value "
        f"FROM {src}"
        for name, col, q, src in [
            ("total_spend", "total_spend", 0.5, "spend"), ("n_baskets", "n_baskets", 0.5, "spend"),
            ("basket_spend", "spend", 0.5, "basket"),
            ("total_spend_p99", "total_spend", 0.99, "spend"),
        ]
    ),
    "spend_describe": " UNION ALL ".join(
        f"SELECT '{m}' AS measure, count({m}) AS n, "
        + ", ".join(
            half_even(expr, 4) + f" AS {name}" for expr, name in [
                (f"avg({m}::DOUBLE)", "mean"), (f"stddev_samp({m}::DOUBLE)", "sd"),
                (f"min({m})", "low"), (f"max({m})", "high"),
                (f"quantile_cont({m}::DOUBLE, 0.25)", "q1"),
                (f"quantile_cont({m}::DOUBLE, 0.5)", "median"),
                (f"quantile_cont({m}::DOUBLE, 0.75)", "q3"),
            ]
        ) + " FROM master"
        for m in _MEASURES
    ),
    "household_sample": f"""SELECT household_key, CAST(y1_spend AS DOUBLE) AS y1_spend,
CAST(y2_spend AS DOUBLE) AS y2_spend FROM spend
ORDER BY {_hash(42)}, household_key LIMIT 500""",
    "clv_top20": """SELECT household_key, CAST(predicted_clv AS DOUBLE) AS predicted_clv,
CAST(y2_spend AS DOUBLE) AS actual_y2_spend,
CAST(abs(predicted_clv - y2_spend) AS DOUBLE) AS abs_error, 1 AS in_test_set
FROM seg ORDER BY predicted_clv DESC, household_key LIMIT 20""",
    "financial_scenarios": "SELECT * EXCLUDE (gained, cost) FROM scen",
    "uplift_retained": """SELECT
CASE WHEN b.gained > 0 THEN t.gained / b.gained ELSE 0 END * 100 AS rev_retained_pct,
b.cost - t.cost AS cost_saving,
CASE WHEN b.cost > 0 THEN (b.cost - t.cost) / b.cost ELSE 0 END * 100 AS cost_saving_pct
FROM scen b JOIN scen t ON b.scenario = 'Blanket TypeA' AND t.scenario = 'Targeted (RFM)'""",
    "risk_summary": """SELECT *, CASE WHEN n_high_risk > 0 THEN revenue_at_risk / n_high_risk
ELSE 0 END AS risk_per_household FROM risk""",
    "reengagement_economics": """SELECT n_high_risk, revenue_at_risk,
revenue_at_risk * 0.05::DOUBLE AS saved_revenue, n_high_risk * 1.5::DOUBLE AS total_cost,
CASE WHEN n_high_risk > 0 THEN revenue_at_risk * 0.05::DOUBLE / (n_high_risk * 1.5::DOUBLE)
ELSE 0 END AS roi FROM risk""",
    "high_risk_stand_in": """SELECT household_key, churn_probability,
CAST(predicted_clv AS DOUBLE) AS predicted_clv, rfm_segment FROM seg
WHERE churn_probability >= 0.7 ORDER BY predicted_clv DESC, household_key LIMIT 20""",
    "kpi_summary": """SELECT s.n_households, mean_clv, revenue_at_risk, n_high_risk, churn_rate_pct,
champion_pct, lost_pct, best_campaign, best_revenue_roi, best_n_households,
CASE WHEN b.revenue_roi > 0 THEN t.revenue_roi / b.revenue_roi ELSE 0 END AS roi_improvement,
b.mailer_cost - t.mailer_cost AS cost_saving,
CASE WHEN b.mailer_cost > 0 THEN (b.mailer_cost - t.mailer_cost) / b.mailer_cost ELSE 0 END * 100
  AS saving_pct
FROM (SELECT count(*) AS n_households, CAST(sum(predicted_clv) AS DOUBLE) / count(*) AS mean_clv,
             sum(is_churned) / count(*) * 100 AS churn_rate_pct,
             count(*) FILTER (rfm_segment = 'Champions') / count(*) * 100 AS champion_pct,
             count(*) FILTER (rfm_segment = 'Lost') / count(*) * 100 AS lost_pct
      FROM seg) s
CROSS JOIN (SELECT n_high_risk, revenue_at_risk FROM risk)
CROSS JOIN (SELECT campaign_type AS best_campaign, revenue_roi AS best_revenue_roi,
                   n_households AS best_n_households
            FROM roi ORDER BY revenue_roi DESC, campaign_type LIMIT 1)
JOIN scen b ON b.scenario = 'Blanket TypeA' JOIN scen t ON t.scenario = 'Targeted (RFM)'""",
    "top_customers": """SELECT household_key, rfm_segment, CAST(total_spend AS DOUBLE) AS total_spend,
CAST(predicted_clv AS DOUBLE) AS predicted_clv, CAST(y2_spend AS DOUBLE) AS actual_y2_spend,
round(CAST(predicted_clv AS DOUBLE) - CAST(y2_spend AS DOUBLE), 2) AS prediction_error
FROM seg ORDER BY predicted_clv DESC, household_key LIMIT 20""",
    "preset_campaign_roi": """SELECT campaign_type, n_households,
avg_pre_weekly_spend AS pre_weekly_spend, avg_during_weekly_spend AS during_weekly_spend,
avg_uplift_weekly AS uplift_per_week, round(total_incremental_rev, 0) AS total_uplift, revenue_roi,
net_roi AS net_roi_margin_adj, p_value, significant FROM roi""",
    "preset_high_risk": """SELECT household_key, churn_probability,
CAST(predicted_clv AS DOUBLE) AS predicted_clv, rfm_segment,
CAST(total_spend AS DOUBLE) AS total_spend, n_baskets, recency_days FROM seg
WHERE churn_probability >= 0.7 ORDER BY predicted_clv DESC, household_key LIMIT 30""",
    "preset_rfm_summary": by_segment("""count(*) AS n_customers,
round(avg(CAST(total_spend AS DOUBLE)), 2) AS avg_2yr_spend, round(avg(n_baskets), 1) AS avg_baskets,
round(avg(recency_days), 0) AS avg_recency_days,
round(avg(CAST(predicted_clv AS DOUBLE)), 2) AS avg_predicted_clv,
round(avg(is_churned) * 100, 1) AS churn_rate_pct"""),
    "preset_cohorts": """SELECT first_quarter, n_customers, round(avg_spend, 2) AS avg_2yr_spend,
round(avg_baskets, 1) AS avg_baskets, round(avg_clv, 2) AS avg_predicted_clv,
round(churn_rate * 100, 1) AS churn_rate_pct FROM coh""",
    "preset_scenarios": """SELECT scenario, n_households, mailer_cost, incremental_revenue,
revenue_roi, cost_saving FROM scen""",
    "preset_top_categories": """SELECT department, n_households, total_spend, avg_item_spend,
n_baskets FROM catspend ORDER BY total_spend DESC, department LIMIT 10""",
    "buyer_comparison": """SELECT buyer_type, count(*) AS n_households,
round(avg(total_spend), 2) AS avg_spend, round(avg(n_baskets), 1) AS avg_baskets
FROM buyers GROUP BY buyer_type""",
}

_CLASSES = "(VALUES (0, 'Active'), (1, 'Churned')) AS c(k, class)"
_BODIES |= {
    "churn_scores": f"""SELECT household_key, {half_even('p', 6)} AS churn_probability, is_churned, rfm_segment
FROM churned JOIN seg USING (household_key)""",
    "churn_coefficients": f"""SELECT feature, {half_even('b[k]', 6)} AS coefficient,
CASE WHEN b[k] > 0 THEN 'raises churn' ELSE 'lowers churn' END AS effect
FROM beta{NEWTON_STEPS}, (VALUES {', '.join(f"({k}, '{c}')" for k, c in enumerate(_CHURN, 2))}) AS f(k, feature)""",
    "churn_gradient": "SELECT unnest([" + ", ".join(f"'{c}'" for c in ["intercept", *_CHURN])
    + "]) AS feature, 0.0::DOUBLE AS gradient",
    "churn_metrics": f"""SELECT class, {half_even('"precision"', 6)} AS "precision", {half_even('recall', 6)} AS recall,
{half_even('CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END', 6)} AS f1,
support, {half_even('accuracy', 6)} AS accuracy, {half_even('auc', 6)} AS auc
FROM (SELECT class, count(*) FILTER (y = k) AS support,
        coalesce(count(*) FILTER (y = k AND g = k) / nullif(count(*) FILTER (g = k), 0), 0) AS "precision",
        coalesce(count(*) FILTER (y = k AND g = k) / nullif(count(*) FILTER (y = k), 0), 0) AS recall,
        count(*) FILTER (y = g) / count(*) AS accuracy
      FROM (SELECT y, CAST(p > 0.5 AS INTEGER) AS g FROM churned WHERE in_test), {_CLASSES}
      GROUP BY k, class),
     (SELECT sum(CASE WHEN a.p > z.p THEN 1.0::DOUBLE WHEN a.p = z.p THEN 0.5::DOUBLE ELSE 0 END) / count(*) AS auc
      FROM churned a, churned z WHERE a.in_test AND z.in_test AND a.y = 1 AND z.y = 0)""",
    "sql_segment_reach": """SELECT rfm_segment, buyer_type, count(*) AS households,
CAST(sum(s.total_spend) AS DOUBLE) AS spend, max(s.n_baskets) AS most_baskets
FROM seg s JOIN buyers b ON s.household_key = b.household_key GROUP BY ALL""",
    "sql_spend_bands": """SELECT band, rfm_segment, households, freshest,
CAST(row_number() OVER (PARTITION BY band ORDER BY households DESC, rfm_segment) AS INTEGER) AS place
FROM (SELECT CASE WHEN rfm_score >= 12 THEN 'high' WHEN rfm_score >= 7 THEN 'middle' ELSE 'low' END AS band,
             rfm_segment, count(*) AS households, min(recency_days) AS freshest FROM seg GROUP BY ALL)""",
    "sql_campaign_margin": """SELECT campaign_type, gross_profit - total_mailer_cost AS margin,
total_mailer_cost, (SELECT count(*) FROM catspend) AS departments FROM roi""",
}
ORACLES = {name: statement(body) for name, body in _BODIES.items()}
