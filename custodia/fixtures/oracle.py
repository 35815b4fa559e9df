"""Check SQL for the star-schema reports, for DuckDB on the same Parquet tables.

Each text states its query independently of the Spark code. Averages and rates
are exact: whole hundredths are added up, divided once and rounded half away
from zero.
"""

from __future__ import annotations

from custodia import config

AS_OF = "DATE '2021-08-02'"


def _text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_text(v) for v in row) + ")" for row in rows)


def rate(part: str, whole: str, digits: int = 1, factor: int = 100) -> str:
    scale = 10**digits
    return f"round({factor * scale}e0 * ({part}) / nullif({whole}, 0)) / {scale}e0"


def avg(x: str, digits: int) -> str:
    scale = 10**digits
    cents = f"sum(CAST(round(({x}) * 100) AS BIGINT))"
    return f"round({scale}e0 * {cents} / nullif(count({x}) * 100, 0)) / {scale}e0"


def whole(x: str) -> str:
    return f"round(round({x}, 4))"


def quantile(x: str, p: float) -> str:
    """A percentile of an amount with two decimals, to one decimal."""
    return f"round(round(quantile_cont(CAST(round(({x}) * 100) AS BIGINT), {p}), 4) / 10e0) / 10e0"


_J = "CASE {k} % 4 WHEN 0 THEN 'NYC' WHEN 1 THEN 'LA' WHEN 2 THEN 'DC' ELSE 'MD' END"


def j(key: str) -> str:
    return _J.format(k=key)


CHARGES = (
    "chg(charge_key, charge_description, charge_class, charge_category, is_violent,"
    " is_poverty_linked, is_addiction_related, jurisdiction, penal_law_section) AS (VALUES "
    + values(
        [
            tuple(
                row[name]
                for name in (
                    "charge_key", "charge_description", "charge_class", "charge_category",
                    "is_violent", "is_poverty_linked", "is_addiction_related", "jurisdiction",
                    "penal_law_section",
                )
            )
            for row in config.taxonomy_rows()
        ]
    )
    + ")"
)

GEOGRAPHY = f"""geo AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS geo_key,
    lpad(CAST(10001 + n_nationkey * 371 AS VARCHAR), 5, '0') AS zip_code,
    n_name AS city, {j('n_nationkey')} AS jurisdiction,
    CAST(28000 + n_nationkey * 3500 AS DOUBLE) AS median_household_income,
    round((28000 + n_nationkey * 3500) / 365e0, 2) AS median_daily_income,
    CAST(33 - n_nationkey AS DOUBLE) AS poverty_rate_pct,
    CAST(10 + (n_nationkey * 5) % 50 AS DOUBLE) AS pct_children_single_parent,
    CAST(8 + (n_nationkey * 11) % 35 AS DOUBLE) AS pct_severely_rent_burdened,
    CAST((n_nationkey * 13) % 80 AS DOUBLE) AS pct_black,
    CASE WHEN n_nationkey % 11 <> 10 THEN CAST(1 + (n_nationkey * 3) % 9 AS DOUBLE) END
      AS eviction_rate_per_100,
    CAST(20000 + n_nationkey * 900 AS BIGINT) AS total_population
  FROM nation)"""

FACILITY = f"""fac AS (
  SELECT s_suppkey + 1 AS facility_key, s_name AS facility_name,
    {j('s_suppkey')} AS jurisdiction,
    CASE s_suppkey % 3 WHEN 0 THEN 'Pretrial' WHEN 1 THEN 'Sentenced' ELSE 'Mixed' END
      AS facility_type,
    150 + s_suppkey * 15 AS rated_capacity,
    s_suppkey % 4 = 0 AS federal_oversight,
    CASE WHEN s_suppkey % 4 = 0 THEN 'court order' END AS oversight_reason,
    s_suppkey % 5 AS deaths_in_custody_ytd,
    (s_suppkey * 17) % 90 AS use_of_force_incidents_ytd,
    CASE WHEN s_suppkey % 4 <> 3 THEN 5 + s_suppkey * 3 END AS solitary_population
  FROM supplier)"""

INMATE = """inm AS (
  SELECT c_custkey + 1 AS inmate_key,
    sha256(concat('salt:', upper(trim(c_name)))) AS inmate_id_hash,
    CASE WHEN a < 18 THEN '<18' WHEN a < 25 THEN '18-24' WHEN a < 35 THEN '25-34'
      WHEN a < 45 THEN '35-44' WHEN a < 55 THEN '45-54' WHEN a < 65 THEN '55-64'
      ELSE '65+' END AS age_bucket,
    CASE WHEN c_custkey % 5 = 0 THEN 'F' ELSE 'M' END AS gender,
    c_mktsegment AS race_ethnicity
  FROM (SELECT *, 16 + c_custkey % 60 AS a FROM customer))"""

FACT = f"""fact AS (
  SELECT f.*, release_date - booking_date AS days,
    bail IS NOT NULL AND bail_paid IS NOT TRUE AS held,
    round(10e0 * round(bail * 100) / round(g.median_daily_income * 100)) / 10e0 AS work_days
  FROM (
    SELECT o_orderkey + 1 AS detention_key, o_custkey + 1 AS inmate_key,
      o_orderkey % (SELECT count(*) FROM supplier) + 1 AS facility_key, c_nationkey + 1 AS home_geo_key,
      (o_orderkey * 7 + o_custkey) % 54 + 1 AS charge_key,
      {j('o_orderkey')} AS jurisdiction,
      CAST(o_orderdate AS DATE) + 7305 AS booking_date,
      CASE WHEN (o_orderkey + 1) % 9 <> 0
        THEN CAST(o_orderdate AS DATE) + 7305 + CAST((o_orderkey + 1) * 13 % 500 AS INTEGER) END
        AS release_date,
      CASE WHEN o_orderkey % 7 <> 0 THEN floor(o_totalprice / 60) END AS bail,
      CASE o_orderpriority[1] WHEN '1' THEN 'Remand' WHEN '2' THEN 'Cash' WHEN '3' THEN 'Bond'
        WHEN '4' THEN 'ROR'
        ELSE CASE WHEN o_orderkey % 4 = 3
            AND CAST(o_orderdate AS DATE) + 7305 >= DATE '2017-07-01'
          THEN 'No Bail (MD Reform)' ELSE 'Supervised Release' END END AS bail_type,
      CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS bail_paid,
      CASE o_custkey % 8 WHEN 0 THEN 'Guilty Plea' WHEN 1 THEN 'Trial - Guilty'
        WHEN 2 THEN 'Trial - Not Guilty' WHEN 3 THEN 'Dismissed' WHEN 4 THEN 'Nolle Prosequi'
        WHEN 5 THEN 'ACD' WHEN 6 THEN 'Unknown' END AS disposition
    FROM orders JOIN customer ON c_custkey = o_custkey) f
  JOIN geo g ON g.geo_key = f.home_geo_key)"""

STAR = ",\n".join([CHARGES, GEOGRAPHY, FACILITY, INMATE, FACT])

HELD_DAYS = "CASE WHEN held THEN days END"
PAID_BAIL = "CASE WHEN bail > 0 THEN bail END"
EXONERATED = "disposition IN ('Trial - Not Guilty', 'Dismissed', 'Nolle Prosequi', 'ACD')"
CASH = "bail_type IN ('Cash', 'Bond')"
NO_CASH = "bail_type IN ('ROR', 'No Bail (MD Reform)', 'Supervised Release')"
WINDOW = (
    "f.jurisdiction = 'MD' AND booking_date >= DATE '2015-07-01'"
    " AND booking_date <= DATE '2019-06-30'"
)
PERIOD = "CASE WHEN booking_date < DATE '2017-07-01' THEN 'Pre-Reform' ELSE 'Post-Reform' END"
TIME_HELD = """CASE WHEN days <= 7 THEN '01: 0-7 days' WHEN days <= 30 THEN '02: 8-30 days'
  WHEN days <= 90 THEN '03: 1-3 months' WHEN days <= 180 THEN '04: 3-6 months'
  WHEN days <= 365 THEN '05: 6-12 months' WHEN days > 365 THEN '06: Over a year'
  ELSE 'Unknown' END"""
ZIP_COLS = """g.zip_code, g.jurisdiction, g.city, g.median_household_income,
  g.median_daily_income, g.poverty_rate_pct, g.pct_black, g.eviction_rate_per_100"""

M1 = f"""m1 AS (
  SELECT {ZIP_COLS}, count(*) AS total_bookings,
    count(*) FILTER (WHERE held) AS pretrial_detained,
    {rate('count(*) FILTER (WHERE held)', 'count(*)', 2)} AS pretrial_rate_pct,
    {avg(PAID_BAIL, 0)} AS avg_bail_amount,
    {avg('work_days', 1)} AS avg_work_days_to_bail,
    {quantile('work_days', 0.5)} AS median_work_days_to_bail,
    {avg('days', 0)} AS avg_detention_days
  FROM fact f JOIN geo g ON g.geo_key = f.home_geo_key
  GROUP BY ALL)"""

M2 = f"""m2 AS (
  SELECT jurisdiction, count(*) AS total_detained,
    count(*) FILTER (WHERE held) AS legally_innocent,
    {rate('count(*) FILTER (WHERE held)', 'count(*)')} AS pct_legally_innocent,
    count(*) FILTER (WHERE held AND bail <= 500) AS held_under_500_bail,
    count(*) FILTER (WHERE held AND bail <= 1000) AS held_under_1000_bail,
    {avg(HELD_DAYS, 0)} AS avg_pretrial_days,
    {whole(f'quantile_cont({HELD_DAYS}, 0.5)')} AS median_pretrial_days
  FROM fact GROUP BY jurisdiction)"""

Q01 = f"""
SELECT *, {rate('legally_innocent', 'total_detained')} AS pct_legally_innocent,
  {rate('held_under_500', 'legally_innocent')} AS pct_held_under_500,
  {rate('held_under_1000', 'legally_innocent')} AS pct_held_under_1000,
  {rate('over_6_months_pretrial', 'legally_innocent')} AS pct_over_6_months,
  {rate('over_1_year_pretrial', 'legally_innocent')} AS pct_over_1_year
FROM (
  SELECT jurisdiction, count(*) AS total_detained,
    count(*) FILTER (WHERE held) AS legally_innocent,
    count(*) FILTER (WHERE held AND bail > 0 AND bail <= 500) AS held_under_500,
    count(*) FILTER (WHERE held AND bail > 0 AND bail <= 1000) AS held_under_1000,
    count(*) FILTER (WHERE bail_type = 'Remand') AS held_on_remand,
    {avg(HELD_DAYS, 0)} AS avg_days_waiting,
    {whole(f'quantile_cont({HELD_DAYS}, 0.5)')} AS median_days_waiting,
    count(*) FILTER (WHERE held AND days > 180) AS over_6_months_pretrial,
    count(*) FILTER (WHERE held AND days > 365) AS over_1_year_pretrial
  FROM fact WHERE booking_date >= {AS_OF} - INTERVAL 1 YEAR GROUP BY jurisdiction)"""

_HELD_YEAR = f"f.held AND f.booking_date >= {AS_OF} - INTERVAL 1 YEAR"

Q02 = f"""
SELECT charge_category, is_violent, is_poverty_linked, is_addiction_related, f.jurisdiction,
  count(*) AS total_pretrial, {avg('bail', 0)} AS avg_bail_set,
  {avg('days', 0)} AS avg_days_detained, {avg('work_days', 1)} AS avg_work_days_to_bail,
  rank() OVER (PARTITION BY f.jurisdiction ORDER BY count(*) DESC) AS pretrial_volume_rank
FROM fact f JOIN chg USING (charge_key) WHERE {_HELD_YEAR}
GROUP BY 1, 2, 3, 4, 5"""

Q03 = f"""
SELECT age_bucket, f.jurisdiction, count(*) AS pretrial_count, {avg('bail', 0)} AS avg_bail,
  {avg('days', 0)} AS avg_days_detained,
  {rate('count(*) FILTER (WHERE is_poverty_linked)', 'count(*)')} AS pct_poverty_charges,
  {rate('count(*) FILTER (WHERE is_addiction_related)', 'count(*)')} AS pct_addiction_charges
FROM fact f JOIN inm USING (inmate_key) JOIN chg USING (charge_key) WHERE {_HELD_YEAR}
GROUP BY 1, 2"""

Q04 = f"""
SELECT {TIME_HELD} AS time_in_cage, f.jurisdiction, charge_category, count(*) AS total_cases,
  count(*) FILTER (WHERE disposition = 'Guilty Plea') AS guilty_pleas,
  {rate("count(*) FILTER (WHERE disposition = 'Guilty Plea')", 'count(*)')} AS guilty_plea_rate,
  count(*) FILTER (WHERE {EXONERATED}) AS exonerated_or_dismissed,
  {rate(f'count(*) FILTER (WHERE {EXONERATED})', 'count(*)')} AS exoneration_rate,
  {avg('bail', 0)} AS avg_bail, {avg('work_days', 1)} AS avg_work_days_to_bail,
  {avg('g.median_household_income', 0)} AS avg_neighborhood_income,
  {rate('count(*) FILTER (WHERE is_poverty_linked)', 'count(*)')} AS pct_poverty_charges
FROM fact f JOIN chg USING (charge_key) JOIN geo g ON g.geo_key = f.home_geo_key
WHERE held AND disposition IS NOT NULL AND booking_date >= DATE '2018-01-01'
GROUP BY 1, 2, 3"""

Q05 = f"""
SELECT f.jurisdiction, charge_category, charge_description, count(*) AS wrongly_detained,
  {avg('days', 0)} AS avg_days_wrongly_detained,
  {whole('quantile_cont(days, 0.5)')} AS median_days_wrongly_detained,
  max(days) AS max_days_wrongly_detained, {avg('bail', 0)} AS avg_bail_that_kept_them_in,
  CAST(sum(days) AS BIGINT) AS total_person_days_lost,
  {rate('sum(days)', '365', 1, 1)} AS years_of_life_lost
FROM fact f JOIN chg USING (charge_key)
WHERE held AND {EXONERATED} AND days > 0 AND booking_date >= DATE '2018-01-01'
GROUP BY 1, 2, 3 HAVING count(*) >= 10"""

Q06 = f"""
SELECT income_quintile, jurisdiction,
  ['Poorest 20%', 'Lower-Middle 20%', 'Middle 20%', 'Upper-Middle 20%', 'Wealthiest 20%']
    [income_quintile] AS income_group,
  {avg('income', 0)} AS avg_income_in_group, count(*) AS cases, {avg('bail', 0)} AS avg_bail,
  {avg('work_days', 1)} AS avg_work_days_to_bail, {avg('days', 0)} AS avg_days_detained,
  {rate("count(*) FILTER (WHERE disposition = 'Guilty Plea')", 'count(*)')} AS guilty_plea_rate,
  {rate('count(*) FILTER (WHERE is_poverty_linked)', 'count(*)')} AS pct_poverty_charges
FROM (
  SELECT f.*, is_poverty_linked, g.median_household_income AS income,
    ntile(5) OVER (PARTITION BY f.jurisdiction ORDER BY g.median_household_income,
      detention_key % 65521, detention_key) AS income_quintile
  FROM fact f JOIN chg USING (charge_key) JOIN geo g ON g.geo_key = f.home_geo_key
  WHERE held AND booking_date >= DATE '2018-01-01')
GROUP BY 1, 2"""

_ADDICTION_3Y = f"is_addiction_related AND booking_date >= {AS_OF} - INTERVAL 3 YEAR"

Q07 = f"""
SELECT f.jurisdiction, charge_description, charge_class, count(*) AS people_locked_up,
  count(*) FILTER (WHERE held) AS held_pretrial,
  {rate('count(*) FILTER (WHERE held)', 'count(*)')} AS pct_held_pretrial,
  {avg(PAID_BAIL, 0)} AS avg_bail_set, {avg('days', 0)} AS avg_days_detained,
  {whole('quantile_cont(days, 0.5)')} AS median_days_detained,
  {whole('quantile_cont(days, 0.9)')} AS p90_days_detained,
  {avg('work_days', 1)} AS avg_work_days_to_bail,
  {avg('g.median_household_income', 0)} AS avg_neighborhood_income,
  rank() OVER (PARTITION BY f.jurisdiction ORDER BY count(*) DESC) AS volume_rank
FROM fact f JOIN chg USING (charge_key) JOIN geo g ON g.geo_key = f.home_geo_key
WHERE {_ADDICTION_3Y} GROUP BY 1, 2, 3 HAVING count(*) >= 20"""

Q08 = f"""
SELECT *, rank() OVER (PARTITION BY jurisdiction ORDER BY addiction_arrests DESC)
    AS addiction_arrest_rank,
  round((median_household_income - avg(median_household_income) OVER area)
    / nullif(stddev_samp(median_household_income) OVER area, 0), 2) AS income_z_score
FROM (
  SELECT {ZIP_COLS}, count(*) AS addiction_arrests,
    count(*) FILTER (WHERE held) AS pretrial_detained, {avg(PAID_BAIL, 0)} AS avg_bail,
    {avg('work_days', 1)} AS avg_work_days_to_bail, {avg('days', 0)} AS avg_days_detained
  FROM fact f JOIN chg USING (charge_key) JOIN geo g ON g.geo_key = f.home_geo_key
  WHERE {_ADDICTION_3Y} GROUP BY ALL HAVING count(*) >= 10)
WINDOW area AS (PARTITION BY jurisdiction)"""

Q09 = f"""
SELECT jurisdiction, age_bucket, gender, race_ethnicity,
  count(*) FILTER (WHERE n >= 2) AS people_in_cycle,
  count(*) FILTER (WHERE n >= 4) AS people_deep_in_cycle,
  {avg('n', 1)} AS avg_bookings_per_person,
  {avg('CASE WHEN n >= 2 THEN lifetime END', 0)} AS avg_lifetime_days_detained,
  {avg('CASE WHEN n >= 2 THEN cycle END', 0)} AS avg_days_in_cycle,
  rank() OVER (ORDER BY avg(n) DESC) AS cycle_severity_rank
FROM (
  SELECT inmate_id_hash, age_bucket, gender, race_ethnicity, f.jurisdiction, count(*) AS n,
    max(booking_date) - min(booking_date) AS cycle, sum(days) AS lifetime
  FROM fact f JOIN inm USING (inmate_key) JOIN chg USING (charge_key)
  WHERE is_addiction_related GROUP BY 1, 2, 3, 4, 5)
GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5"""

Q10 = f"""
SELECT * EXCLUDE (tenths),
  rank() OVER (PARTITION BY jurisdiction ORDER BY avg_work_days_to_bail DESC NULLS FIRST)
    AS bail_gap_rank,
  round((tenths - avg(tenths) OVER area) / nullif(stddev_samp(tenths) OVER area, 0), 2)
    AS bail_gap_z_score,
  coalesce(poverty_rate_pct > 25 AND avg_work_days_to_bail > 30 AND eviction_rate_per_100 > 5,
    false) AS compounded_disadvantage_zone
FROM (
  SELECT {ZIP_COLS}, g.pct_children_single_parent, g.pct_severely_rent_burdened,
    {avg('bail', 0)} AS avg_bail_set, {avg('work_days', 1)} AS avg_work_days_to_bail,
    CAST(round(10 * {avg('work_days', 1)}) AS BIGINT) AS tenths,
    {quantile('work_days', 0.5)} AS median_work_days_to_bail,
    {quantile('work_days', 0.9)} AS p90_work_days_to_bail,
    {rate('count(*) FILTER (WHERE held)', 'count(*)')} AS pretrial_detention_rate,
    {rate('count(*) FILTER (WHERE is_poverty_linked)', 'count(*)')} AS pct_poverty_charges,
    {rate('count(*) FILTER (WHERE is_addiction_related)', 'count(*)')} AS pct_addiction_charges,
    {avg(HELD_DAYS, 0)} AS avg_pretrial_days, count(*) AS total_bail_cases
  FROM fact f JOIN geo g ON g.geo_key = f.home_geo_key JOIN chg USING (charge_key)
  WHERE bail > 0 AND g.median_daily_income > 0 AND booking_date >= DATE '2020-01-01'
  GROUP BY ALL HAVING count(*) >= 20)
WINDOW area AS (PARTITION BY jurisdiction)"""


def _fixed(amount: int) -> str:
    cents = "sum(CAST(round(median_daily_income * 100) AS BIGINT))"
    return f"round({amount}e3 * count(median_daily_income) / nullif({cents}, 0)) / 10e0"


Q11 = f"""
SELECT jurisdiction, count(DISTINCT zip_code) AS zip_codes_analyzed,
  {avg('median_household_income', 0)} AS jurisdiction_avg_income,
  {avg('median_daily_income', 2)} AS jurisdiction_avg_daily_income,
  {_fixed(500)} AS work_days_for_500_bail, {_fixed(1000)} AS work_days_for_1000_bail,
  {_fixed(5000)} AS work_days_for_5000_bail,
  8.6e0 AS work_days_at_min_wage_for_500, 17.2e0 AS work_days_at_min_wage_for_1000
FROM m1 GROUP BY jurisdiction"""

Q12 = """
SELECT g.zip_code, g.jurisdiction, g.eviction_rate_per_100, g.median_household_income,
  g.pct_severely_rent_burdened, avg_work_days_to_bail, pretrial_rate_pct, total_bookings,
  rank() OVER (PARTITION BY g.jurisdiction ORDER BY g.eviction_rate_per_100 DESC)
    AS eviction_rank,
  rank() OVER (PARTITION BY g.jurisdiction ORDER BY avg_work_days_to_bail DESC NULLS FIRST)
    AS bail_gap_rank,
  coalesce(g.eviction_rate_per_100 >= quantile_cont(g.eviction_rate_per_100, 0.75)
      OVER (PARTITION BY g.jurisdiction)
    AND round(avg_work_days_to_bail * 10) >= quantile_cont(round(avg_work_days_to_bail * 10), 0.75)
      OVER (PARTITION BY g.jurisdiction), false) AS housing_to_jail_pipeline_zone
FROM geo g JOIN m1 ON m1.zip_code = g.zip_code WHERE g.eviction_rate_per_100 IS NOT NULL"""

_Q13_STATS = f"""
  SELECT {PERIOD} AS reform_period, count(*) AS total_bookings,
    count(*) FILTER (WHERE {CASH}) AS cash_bail_set,
    {rate(f'count(*) FILTER (WHERE {CASH})', 'count(*)')} AS pct_cash_bail,
    count(*) FILTER (WHERE {NO_CASH}) AS no_cash_required,
    {rate(f'count(*) FILTER (WHERE {NO_CASH})', 'count(*)')} AS pct_no_cash,
    count(*) FILTER (WHERE bail_type = 'Remand') AS remand_count,
    {rate("count(*) FILTER (WHERE bail_type = 'Remand')", 'count(*)')} AS pct_remand,
    count(*) FILTER (WHERE held) AS pretrial_detained,
    {rate('count(*) FILTER (WHERE held)', 'count(*)')} AS pretrial_rate,
    {avg(HELD_DAYS, 0)} AS avg_pretrial_days,
    {whole(f'quantile_cont({HELD_DAYS}, 0.5)')} AS median_pretrial_days,
    {avg(PAID_BAIL, 0)} AS avg_bail_amount,
    {rate('count(*) FILTER (WHERE is_poverty_linked)', 'count(*)')} AS pct_poverty_charges
  FROM fact f JOIN chg USING (charge_key) JOIN geo g ON g.geo_key = f.home_geo_key
  WHERE {WINDOW} GROUP BY 1"""

Q13 = f"""
SELECT *, lag(pretrial_rate) OVER (ORDER BY reform_period DESC) AS comparison_pretrial_rate,
  round(10 * (pretrial_rate - lag(pretrial_rate) OVER (ORDER BY reform_period DESC))) / 10e0
    AS pretrial_rate_change
FROM ({_Q13_STATS})"""

Q14 = f"""
SELECT *, {rate('pretrial_detained', 'bookings')} AS pretrial_rate,
  CASE WHEN booking_month >= DATE '2017-07-01' THEN 'Post-Reform' ELSE 'Pre-Reform' END AS period,
  round(10 * round(avg(100e0 * pretrial_detained / bookings) OVER (ORDER BY booking_month
    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6)) / 10e0 AS rolling_pretrial_rate,
  pretrial_detained - lag(pretrial_detained) OVER m AS pretrial_change_mom,
  {rate('pretrial_detained - lag(pretrial_detained, 12) OVER m',
        'lag(pretrial_detained, 12) OVER m')} AS pretrial_change_yoy_pct,
  CAST(sum(no_cash_bail) OVER (ORDER BY booking_month ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS cumulative_no_cash_bail
FROM (
  SELECT CAST(date_trunc('month', booking_date) AS DATE) AS booking_month, count(*) AS bookings,
    count(*) FILTER (WHERE {CASH}) AS cash_bail, count(*) FILTER (WHERE {NO_CASH}) AS no_cash_bail,
    count(*) FILTER (WHERE bail_type = 'Remand') AS remand,
    count(*) FILTER (WHERE held) AS pretrial_detained, {avg(HELD_DAYS, 0)} AS avg_pretrial_days
  FROM fact f WHERE {WINDOW} GROUP BY 1)
WINDOW m AS (ORDER BY booking_month)"""

Q15 = f"""
SELECT CASE WHEN g.median_household_income < 35000 THEN '1: Under $35k'
    WHEN g.median_household_income < 55000 THEN '2: $35k-$55k'
    WHEN g.median_household_income < 80000 THEN '3: $55k-$80k' ELSE '4: Over $80k' END
    AS income_tier,
  {PERIOD} AS period, count(*) AS bookings,
  {rate('count(*) FILTER (WHERE held)', 'count(*)')} AS pretrial_rate,
  {rate("count(*) FILTER (WHERE bail_type = 'Remand')", 'count(*)')} AS remand_rate,
  {avg(HELD_DAYS, 0)} AS avg_pretrial_days, {avg(PAID_BAIL, 0)} AS avg_bail_set
FROM fact f JOIN geo g ON g.geo_key = f.home_geo_key WHERE {WINDOW} GROUP BY 1, 2"""

Q16 = f"""
SELECT facility_name, jurisdiction, facility_type, rated_capacity, federal_oversight,
  oversight_reason, deaths_in_custody_ytd, use_of_force_incidents_ytd, solitary_population,
  n AS current_population, capacity_pct,
  CASE WHEN capacity_pct > 130 THEN 'CRITICAL OVERCROWDING' WHEN capacity_pct > 110
    THEN 'Overcrowded' WHEN capacity_pct > 90 THEN 'Near Capacity' ELSE 'Within Capacity' END
    AS capacity_status,
  {rate('pretrial', 'n')} AS pct_pretrial_in_facility, alos_days,
  {rate('deaths_in_custody_ytd', 'n', 2, 1000)} AS deaths_per_1000_detainees
FROM (
  SELECT fac.*, n, pretrial, alos_days, {rate('n', 'rated_capacity')} AS capacity_pct
  FROM fac JOIN (
    SELECT fac.facility_key,
      count(detention_key) FILTER (WHERE release_date IS NULL) AS n,
      count(detention_key) FILTER (WHERE release_date IS NULL AND held) AS pretrial,
      {avg('days', 0)} AS alos_days
    FROM fac LEFT JOIN fact f ON f.facility_key = fac.facility_key GROUP BY 1)
  USING (facility_key))"""

Q17 = """
SELECT facility_name, fac.jurisdiction, age_bucket, gender, race_ethnicity, charge_category,
  is_violent, is_poverty_linked, is_addiction_related, held AS pretrial_detention_flag,
  bail AS bail_set_amount, CAST(days AS INTEGER) AS days_detained_before_death, bail_type,
  CASE WHEN held THEN 'Legally Innocent' ELSE 'Post-Conviction' END AS conviction_status_at_death
FROM fact f JOIN fac USING (facility_key) JOIN inm USING (inmate_key) JOIN chg USING (charge_key)
WHERE release_date IS NULL"""

Q18 = f"""
SELECT facility_name, jurisdiction, rated_capacity, census_date, population_estimate,
  {rate('population_estimate', 'rated_capacity')} AS capacity_pct,
  round(avg(population_estimate) OVER (PARTITION BY facility_key ORDER BY census_date
    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) AS rolling_7day_population,
  max(population_estimate) OVER (PARTITION BY facility_key ORDER BY census_date
    ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30day_peak,
  CAST(sum(CASE WHEN population_estimate > rated_capacity THEN 1 ELSE 0 END) OVER (
    PARTITION BY facility_key ORDER BY census_date
    ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS days_overcrowded_last_30
FROM fac JOIN (
  SELECT facility_key, booking_date AS census_date,
    count(*) FILTER (WHERE release_date IS NULL OR release_date > booking_date)
      AS population_estimate
  FROM fact WHERE booking_date >= {AS_OF} - 180 GROUP BY 1, 2) USING (facility_key)"""

Q19 = f"""
SELECT facility_name, jurisdiction, solitary_population,
  {rate('solitary_population', 'n')} AS pct_population_in_solitary,
  pretrial AS pretrial_in_facility, commonest AS most_common_charge_category, avg_alos
FROM fac JOIN (
  SELECT facility_key, count(*) FILTER (WHERE release_date IS NULL) AS n,
    count(*) FILTER (WHERE release_date IS NULL AND held) AS pretrial, {avg('days', 0)} AS avg_alos
  FROM fact JOIN chg USING (charge_key) GROUP BY 1) USING (facility_key)
JOIN (
  SELECT facility_key, charge_category AS commonest,
    row_number() OVER (PARTITION BY facility_key ORDER BY count(*) DESC, charge_category) AS place
  FROM fact JOIN chg USING (charge_key) GROUP BY 1, 2) USING (facility_key)
WHERE place = 1 AND solitary_population IS NOT NULL"""

Q20 = """
SELECT charge_category, count(*) AS total_charges,
  count(*) FILTER (WHERE is_poverty_linked) AS poverty_linked,
  count(*) FILTER (WHERE is_addiction_related) AS addiction_related,
  count(*) FILTER (WHERE is_violent) AS violent, CAST(sum(coalesce(n, 0)) AS BIGINT) AS bookings
FROM chg LEFT JOIN (SELECT charge_key, count(*) AS n FROM fact GROUP BY 1) USING (charge_key)
GROUP BY 1"""

DEATHS = f"""deaths AS (
  SELECT event_id AS death_id, 'Facility ' || (event_id % 8) AS facility_name,
    {j('user_id')} AS jurisdiction, CAST(ts AS DATE) AS death_date,
    ['Natural', 'Suicide', 'Homicide', 'Accident', 'Unknown'][event_id % 5 + 1] AS manner_of_death,
    ['Pretrial', 'Sentenced', 'Unknown'][event_id % 3 + 1] AS conviction_status,
    CAST(floor(value) AS INTEGER) AS days_detained
  FROM events)"""

C01 = """
SELECT jurisdiction, 'Pretrial' AS status, legally_innocent AS people FROM m2
UNION ALL
SELECT jurisdiction, 'Post-conviction', total_detained - legally_innocent FROM m2"""

C02 = f"""
SELECT CASE WHEN bail <= 500 THEN '1: $0-$500' WHEN bail <= 1000 THEN '2: $500-$1k'
  WHEN bail <= 5000 THEN '3: $1k-$5k' ELSE '4: $5k+' END AS bail_bucket,
  count(*) AS pretrial_detainees
FROM fact f WHERE {_HELD_YEAR} GROUP BY 1"""

C03 = f"""
SELECT charge_category, count(*) AS total_pretrial,
  {rate('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_total
FROM fact f JOIN chg USING (charge_key) WHERE {_HELD_YEAR} GROUP BY 1"""

C04 = f"""
SELECT zip_code, jurisdiction, median_household_income, avg_bail_amount, avg_work_days_to_bail,
  eviction_rate_per_100, total_bookings,
  coalesce(housing_to_jail_pipeline_zone, false) AS pipeline_zone
FROM m1 LEFT JOIN (SELECT zip_code, housing_to_jail_pipeline_zone FROM ({Q12})) USING (zip_code)"""

C05 = f"""
SELECT jurisdiction, amount AS bail_amount,
  CASE amount WHEN 500 THEN work_days_for_500_bail WHEN 1000 THEN work_days_for_1000_bail
    ELSE work_days_for_5000_bail END AS work_days,
  {rate('amount', '58', 1, 1)} AS work_days_at_min_wage
FROM ({Q11}) CROSS JOIN (VALUES (500::BIGINT), (1000), (5000)) a(amount)"""

_FLOW = f"""flow AS (
  SELECT CASE WHEN {CASH} THEN 'Bail Set - Cash' WHEN {NO_CASH} THEN 'ROR / No Cash'
      WHEN bail_type = 'Remand' THEN 'Remand' ELSE 'Other' END AS b,
    CASE WHEN bail_paid THEN 'Bail Paid - Released' ELSE 'Bail Not Paid - Detained' END AS p,
    CASE WHEN days <= 7 THEN '0-7 days' WHEN days <= 30 THEN '8-30 days'
      WHEN days <= 90 THEN '1-3 months' WHEN days <= 365 THEN '3-12 months'
      WHEN days > 365 THEN '1+ year' ELSE 'Still held' END AS h,
    coalesce(disposition, 'Open') AS o
  FROM fact)"""

C06 = """
SELECT 1::BIGINT AS stage, 'Arrested' AS source, b AS target, count(*) AS people FROM flow GROUP BY b
UNION ALL SELECT 2, b, p, count(*) FROM flow GROUP BY b, p
UNION ALL SELECT 3, p, h, count(*) FROM flow GROUP BY p, h
UNION ALL SELECT 4, h, o, count(*) FROM flow GROUP BY h, o"""

C07 = f"""
SELECT time_in_cage, coalesce(jurisdiction, 'ALL') AS jurisdiction,
  CAST(sum(total_cases) AS BIGINT) AS total_cases, CAST(sum(guilty_pleas) AS BIGINT) AS guilty_pleas,
  {rate('sum(guilty_pleas)', 'sum(total_cases)')} AS guilty_plea_rate
FROM ({Q04}) GROUP BY GROUPING SETS ((time_in_cage, jurisdiction), (time_in_cage))"""

C08 = """
SELECT year(booking_date) AS year, count(*) AS addiction_bookings
FROM fact JOIN chg USING (charge_key)
WHERE is_addiction_related AND booking_date >= DATE '2018-01-01' GROUP BY 1"""

C09 = """
SELECT jurisdiction, CASE WHEN n >= 5 THEN '5+' ELSE CAST(n AS VARCHAR) END AS bookings,
  count(*) AS people
FROM (SELECT inmate_key, f.jurisdiction, count(*) AS n FROM fact f JOIN chg USING (charge_key)
  WHERE is_addiction_related GROUP BY 1, 2 HAVING count(*) >= 2)
GROUP BY 1, 2"""

C10 = f"""
SELECT z.zip_code, z.jurisdiction, z.median_household_income, addiction_arrests,
  {rate('addiction_arrests', 'total_population', 2, 1000)} AS arrests_per_1000,
  {rate('pretrial_detained', 'addiction_arrests')} AS pct_pretrial
FROM ({Q08}) z JOIN geo USING (zip_code)"""

C11 = f"""
SELECT facility_name, jurisdiction, census_date, population_estimate, capacity_pct
FROM ({Q18}) WHERE census_date >= {AS_OF} - 90"""

C12 = """
SELECT death_id, death_date, jurisdiction, manner_of_death, conviction_status, days_detained
FROM deaths WHERE conviction_status = 'Pretrial'"""

C13 = f"""
SELECT facility_name, jurisdiction, capacity_pct, current_population,
  {rate('use_of_force_incidents_ytd', 'current_population', 2, 100)} AS force_per_100_detainees
FROM ({Q16})"""

C14 = f"""
SELECT figure, max(value) FILTER (WHERE reform_period = 'Pre-Reform') AS pre_reform,
  max(value) FILTER (WHERE reform_period = 'Post-Reform') AS post_reform
FROM (
  SELECT reform_period, 'Cash Bail Rate' AS figure, pct_cash_bail AS value FROM ({_Q13_STATS})
  UNION ALL SELECT reform_period, 'Remand Rate', pct_remand FROM ({_Q13_STATS})
  UNION ALL SELECT reform_period, 'Avg Pretrial Days', avg_pretrial_days FROM ({_Q13_STATS}))
GROUP BY figure"""

C15 = f"""
SELECT income_tier, max(pretrial_rate) FILTER (WHERE period = 'Pre-Reform') AS pre_reform_rate,
  max(pretrial_rate) FILTER (WHERE period = 'Post-Reform') AS post_reform_rate
FROM ({Q15}) GROUP BY income_tier"""

C16 = f"""
SELECT booking_month, period, pretrial_rate, {rate('cash_bail', 'bookings')} AS cash_bail_rate,
  {rate('remand', 'bookings')} AS remand_rate
FROM ({Q14})"""

C17 = f"""
SELECT count(*) AS bookings,
  {rate('count(*) FILTER (WHERE held)', 'count(*)')} AS pct_legally_innocent,
  {avg(HELD_DAYS, 0)} AS avg_days_pretrial,
  count(*) FILTER (WHERE held AND bail > 0 AND bail <= 1000) AS held_under_1000,
  {avg('work_days', 1)} AS avg_work_days
FROM fact WHERE year(booking_date) = 2020"""


def star_checks() -> dict[str, str]:
    """Full check SQL per report ID."""
    extra = {"M1": [M1], "M2": [M2], "Q11": [M1], "Q12": [M1], "C01": [M2], "C04": [M1],
             "C05": [M1], "C06": [_FLOW]}
    bodies = {name: text for name, text in globals().items()
              if name[0] in "QC" and name[1:].isdigit()}
    bodies |= {"M1": "SELECT * FROM m1", "M2": "SELECT * FROM m2"}
    checks = {
        name: "WITH " + ",\n".join([STAR, *extra.get(name, [])]) + body
        if body.startswith("\n") else "WITH " + ",\n".join([STAR, *extra.get(name, [])]) + "\n" + body
        for name, body in bodies.items()
    }
    checks["C12"] = f"WITH {DEATHS}{C12}"
    return checks
