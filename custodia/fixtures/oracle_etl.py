"""Check SQL for the source, transform and load steps, for DuckDB on the same Parquet tables."""

from __future__ import annotations

from custodia import config
from custodia.fixtures.oracle import AS_OF, CHARGES, DEATHS, GEOGRAPHY, avg, j, quantile, rate, values

AT = "'2021-08-02T00:00:00'"
BATCH = "'batch-1'"
CUT = "DATE '2015-01-04'"
CUSTODY, DISCHARGES, LA, MD, DC = [f"'{source.name}'" for source in config.SOURCES]

_SHIFTED = "CAST(o_orderdate AS DATE) + 7305"

INTAKE = f"""base AS (
  SELECT *, {j('o_orderkey')} AS jurisdiction, {_SHIFTED} AS day, o_orderkey // 4 AS turn
  FROM orders JOIN customer ON c_custkey = o_custkey),
seen AS (
  SELECT *, {CUSTODY} AS source_system FROM base WHERE jurisdiction = 'NYC'
  UNION ALL SELECT *, {DISCHARGES} FROM base WHERE jurisdiction = 'NYC' AND o_orderstatus = 'F'
  UNION ALL SELECT *, CASE jurisdiction WHEN 'LA' THEN {LA} WHEN 'MD' THEN {MD} ELSE {DC} END
    FROM base WHERE jurisdiction <> 'NYC'),
intake AS (
  SELECT CASE WHEN o_custkey % 50 = 0 THEN '  ' WHEN o_custkey % 50 = 1 THEN NULL
      WHEN o_orderkey % 3 = 0 THEN ' ' || lower(c_name) || ' ' ELSE c_name END AS inmate_id,
    CASE WHEN o_orderkey % 101 = 0 THEN 'bad-date'
      ELSE strftime(day, '%Y-%m-%d') || CASE WHEN jurisdiction = 'NYC' THEN 'T00:00:00.000' ELSE '' END
      END AS booking_date,
    CASE WHEN o_orderstatus = 'F' AND source_system <> {CUSTODY} THEN
      strftime(CASE WHEN o_orderkey % 211 = 0 THEN day - 5
        ELSE day + CAST(o_orderkey * 13 % 500 AS INTEGER) END, '%Y-%m-%d')
      || CASE WHEN jurisdiction = 'NYC' THEN 'T00:00:00.000' ELSE '' END END AS release_date,
    c_mktsegment AS race_ethnicity,
    CASE WHEN o_custkey % 5 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN o_custkey % 97 = 0 THEN 'n/a'
      WHEN o_custkey % 10 = 3 THEN (16 + o_custkey % 60) || '.5'
      ELSE CAST(16 + o_custkey % 60 AS VARCHAR) END AS age,
    [' DE ', 'DEP', 'DNS', 'CS', 'CSP', 'SSR', 'DPV', NULL][turn % 8 + 1] AS detention_status_code,
    ['220.03', '220', '165.15', '155', 'PL 140.10', NULL, '999.99'][turn % 7 + 1] AS charge_code_raw,
    CASE WHEN source_system = {CUSTODY} THEN ['MIN', 'MED', 'MAX'][o_orderkey % 3 + 1] END
      AS custody_level,
    CASE WHEN source_system = {CUSTODY} THEN ['N', 'Y'][o_orderkey % 2 + 1] END AS infraction_flag,
    CASE WHEN source_system = {CUSTODY} THEN 'N' END AS sealed_flag,
    CASE WHEN jurisdiction = 'NYC' THEN NULL WHEN o_orderkey % 13 = 0 THEN 'none'
      WHEN o_orderkey % 17 = 0 THEN 'NaN' WHEN o_orderkey % 199 = 0 THEN '-100'
      ELSE CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR) END AS bail_set_amount,
    CASE WHEN jurisdiction <> 'NYC' THEN ['Remand', 'Cash', 'Bond', 'ROR', 'Supervised Release']
      [CAST(o_orderpriority[1] AS INTEGER)] END AS bail_type,
    CASE WHEN jurisdiction <> 'NYC' THEN
      CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END END AS bail_paid,
    CASE WHEN jurisdiction <> 'NYC' THEN ['Guilty Plea', 'Trial - Guilty', 'Trial - Not Guilty',
      'Dismissed', 'Nolle Prosequi', 'ACD', 'Unknown', NULL][o_custkey % 8 + 1] END
      AS case_disposition,
    CASE WHEN jurisdiction <> 'NYC' THEN ' ' || (601 + c_nationkey * 371) || ' ' END AS zip_code,
    CASE WHEN jurisdiction <> 'NYC' AND o_orderkey % 10 <> 9 THEN
      CASE WHEN o_orderkey % 5 = 4 THEN 'County Detention and Intake Center'
        ELSE 'Facility ' || (o_orderkey % 5) END END AS facility,
    jurisdiction, source_system
  FROM seen)"""


def _figures(earlier: bool) -> str:
    from custodia.fixtures.intake import CENSUS_FIGURES

    columns = []
    for code, name in config.CENSUS_VARIABLES.items():
        base, step = CENSUS_FIGURES[code]
        text = f"CAST({base} + n_nationkey * {step} AS VARCHAR)"
        if code == "B19013_001E":
            text = f"CAST({base - 1000 if earlier else base} + n_nationkey * {step} AS VARCHAR)"
            text = f"CASE WHEN n_nationkey % 10 = 9 THEN '-666666666' ELSE {text} END"
        elif code == "B17001_001E":
            text = f"CASE WHEN n_nationkey = 3 THEN '0' ELSE {text} END"
        elif code == "B09002_008E":
            text = f"CASE WHEN n_nationkey % 6 <> 5 THEN {text} END"
        elif code == "B09002_011E":
            text = f"CASE WHEN n_nationkey % 7 = 6 THEN 'x' ELSE {text} END"
        columns.append(f"{text} AS {name}")
    return ", ".join(columns)


def _context(suffix: str, earlier: bool) -> str:
    typed = ", ".join(
        f"CASE WHEN TRY_CAST({n} AS DOUBLE) >= 0 THEN TRY_CAST({n} AS DOUBLE) END AS {n}"
        for n in config.CENSUS_VARIABLES.values()
    )
    single = "coalesce(children_single_mother_hh, 0) + coalesce(children_single_father_hh, 0)"
    return f"""acs{suffix} AS (
  SELECT {_figures(earlier)}, lpad(CAST(601 + n_nationkey * 371 AS VARCHAR), 5, '0') AS zip_code
  FROM nation),
typed{suffix} AS (SELECT zip_code, {typed} FROM acs{suffix}),
ctx{suffix} AS (
  SELECT zip_code, total_population, median_household_income,
    {rate('median_household_income', '365', 2, 1)} AS median_daily_income,
    {rate('people_below_poverty_line', 'poverty_universe_total', 2)} AS poverty_rate_pct,
    {rate(single, 'children_total', 2)} AS pct_children_single_parent,
    {rate('rent_burdened_50pct_plus', 'renter_universe_total', 2)} AS pct_severely_rent_burdened,
    {rate('bachelors_degree_count', 'education_universe_total', 2)} AS pct_bachelors_or_higher,
    {rate('black_alone', 'total_population', 2)} AS pct_black,
    {rate('white_alone', 'total_population', 2)} AS pct_white,
    {rate('hispanic_or_latino', 'total_population', 2)} AS pct_hispanic
  FROM typed{suffix})"""


def _hash(x: str) -> str:
    return (
        f"CASE WHEN trim(coalesce({x}, '')) = '' THEN 'UNKNOWN'"
        f" ELSE sha256('salt:' || upper(trim({x}))) END"
    )


def _number(x: str) -> str:
    return f"CASE WHEN isfinite(TRY_CAST({x} AS DOUBLE)) THEN TRY_CAST({x} AS DOUBLE) END"


def _day(x: str) -> str:
    return f"TRY_CAST(substr({x}, 1, 10) AS DATE)"


def _zip(x: str) -> str:
    return f"CASE WHEN trim({x}) <> '' THEN lpad(substr(trim({x}), 1, 5), 5, '0') END"


_AGE = """CASE WHEN TRY_CAST(age AS DOUBLE) IS NULL THEN 'Unknown'
  WHEN TRY_CAST(age AS DOUBLE) < 18 THEN '<18' WHEN TRY_CAST(age AS DOUBLE) < 25 THEN '18-24'
  WHEN TRY_CAST(age AS DOUBLE) < 35 THEN '25-34' WHEN TRY_CAST(age AS DOUBLE) < 45 THEN '35-44'
  WHEN TRY_CAST(age AS DOUBLE) < 55 THEN '45-54' WHEN TRY_CAST(age AS DOUBLE) < 65 THEN '55-64'
  ELSE '65+' END"""
_PRETRIAL = "coalesce(jurisdiction = 'NYC' AND trim(detention_status_code) IN ('DE', 'DEP', 'DNS'), false)"


def _enriched(suffix: str, where: str = "true") -> str:
    return f"""clean{suffix} AS (
  SELECT * EXCLUDE (inmate_id, age, zip_code), {_hash('inmate_id')} AS inmate_id_hash,
    {_AGE} AS age_bucket, {_zip('zip_code')} AS zip_code, {_PRETRIAL} AS pretrial_derived,
    {_number('bail_set_amount')} AS bail_set_amount_num,
    {_day('booking_date')} AS booking_date_parsed, {_day('release_date')} AS release_day
  FROM intake WHERE {where}),
enriched{suffix} AS (
  SELECT c.*, x.* EXCLUDE (zip_code),
    round(10e0 * round(bail_set_amount_num * 100) / nullif(round(median_daily_income * 100), 0)) / 10e0
      AS work_days_to_bail,
    coalesce(jurisdiction = 'MD' AND booking_date_parsed >= DATE '2017-07-01', false)
      AS is_md_reform_case, {BATCH} AS etl_batch_id, {AT} AS etl_loaded_at
  FROM clean{suffix} c LEFT JOIN ctx{suffix} x ON x.zip_code = c.zip_code)"""


BASE = f"{INTAKE},\n{_context('', False)},\n{_enriched('')}"
_FIRST = f"coalesce({_day('booking_date')} < {CUT}, false)"
TWO_BATCHES = ",\n".join([
    INTAKE, _context("1", True), _enriched("1", _FIRST), _context("2", False),
    _enriched("2", f"NOT {_FIRST}"),
])
_WHEN = "coalesce(booking_date_parsed, DATE '9999-12-31')"
_FIGURES = [
    "median_household_income", "median_daily_income", "poverty_rate_pct",
    "pct_children_single_parent", "pct_severely_rent_burdened", "pct_bachelors_or_higher",
    "total_population", "pct_black", "pct_white", "pct_hispanic",
]


def _zips(source: str) -> str:
    return f"""SELECT zip_code, jurisdiction, {', '.join(_FIGURES)} FROM (
  SELECT *, row_number() OVER (PARTITION BY zip_code ORDER BY {_WHEN}, source_system) AS place
  FROM {source} WHERE zip_code IS NOT NULL) WHERE place = 1"""


def _people(source: str) -> str:
    return f"""SELECT inmate_id_hash, age_bucket, gender, race_ethnicity FROM (
  SELECT *, row_number() OVER (PARTITION BY inmate_id_hash
    ORDER BY {_WHEN}, source_system, age_bucket, gender, race_ethnicity) AS place
  FROM {source}) WHERE place = 1"""


_DEFAULTS = values(config.DEFAULT_FACILITIES)


def _facilities(source: str) -> str:
    return f"""SELECT facility_id, min(facility_name) AS facility_name,
    min(jurisdiction) AS jurisdiction FROM (
  SELECT jurisdiction || '-' || substr(facility, 1, 30) AS facility_id,
    facility AS facility_name, jurisdiction FROM {source} WHERE facility IS NOT NULL
  UNION ALL SELECT * FROM (VALUES {_DEFAULTS})) GROUP BY 1"""


def _dimensions(n: str, earlier: str | None = None) -> str:
    """Dimension rows with keys for batch ``n``, going on from the keys of ``earlier``."""
    parts = []
    for name, rows, natural, key in [
        ("zips", _zips(f"enriched{n}"), "zip_code", "geo_key"),
        ("people", _people(f"enriched{n}"), "inmate_id_hash", "inmate_key"),
        ("places", _facilities(f"enriched{n}"), "facility_id", "facility_key"),
    ]:
        start, new = "0", ""
        if earlier is not None:
            start = f"(SELECT coalesce(max({key}), 0) FROM {name}{earlier})"
            new = f"WHERE {natural} NOT IN (SELECT {natural} FROM {name}{earlier})"
        fresh = f"SELECT *, {start} + row_number() OVER (ORDER BY {natural}) AS {key} FROM ({rows}) {new}"
        if earlier is not None:
            fresh = f"SELECT * FROM {name}{earlier} UNION ALL BY NAME {fresh}"
        parts.append(f"{name}{n} AS ({fresh})")
    return ",\n".join(parts)


LOOKUP = """codes AS (
  SELECT section, max(charge_key) AS primary_charge_key FROM (
    SELECT substr(penal_law_section, 4) AS section, charge_key FROM chg
    WHERE penal_law_section IS NOT NULL) GROUP BY 1
  UNION ALL
  SELECT split_part(substr(penal_law_section, 4), '.', 1), min(charge_key) FROM chg
  WHERE penal_law_section IS NOT NULL AND split_part(substr(penal_law_section, 4), '.', 1)
    NOT IN (SELECT substr(penal_law_section, 4) FROM chg WHERE penal_law_section IS NOT NULL)
  GROUP BY 1)"""

_DETAILS = [
    "jurisdiction", "zip_code", "facility", "charge_code_raw", "release_date", "bail_set_amount",
    "bail_type", "bail_paid", "case_disposition", "work_days_to_bail", "is_md_reform_case",
    "pretrial_derived",
]


def _text(name: str) -> str:
    if name in ("bail_set_amount", "work_days_to_bail"):
        return f"coalesce(CAST(CAST(round({name} * 100) AS BIGINT) AS VARCHAR), '')"
    return f"coalesce(CAST({name} AS VARCHAR), '')"


def _events(n: str) -> str:
    person = ", ".join(_text(c) for c in ["inmate_id_hash", "booking_date", "source_system", "charge_code_raw", "facility", "bail_set_amount"])
    details = ", ".join(_text(c) for c in _DETAILS)
    filled = ["release_date", "bail_paid", "case_disposition"]
    order = ", ".join([f"{c} IS NULL" for c in filled] + [f"{c} NULLS FIRST" for c in _DETAILS])
    return f"""shaped{n} AS (
  SELECT inmate_id_hash, jurisdiction, source_system, zip_code, facility, charge_code_raw,
    booking_date_parsed AS booking_date, release_day AS release_date,
    bail_set_amount_num AS bail_set_amount, bail_type, CAST(bail_paid AS BOOLEAN) AS bail_paid,
    case_disposition, work_days_to_bail, is_md_reform_case, pretrial_derived
  FROM enriched{n}),
events{n} AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {order}) AS place FROM (
      SELECT *, sha256(CASE WHEN inmate_id_hash = 'UNKNOWN'
        THEN concat_ws('|', {person}, {details}) ELSE concat_ws('|', {person}) END) AS event_id
      FROM shaped{n})) WHERE place = 1)"""


def _keyed(n: str, dims: str | None = None) -> str:
    d = n if dims is None else dims
    return f"""keyed{n} AS (
  SELECT e.*, CAST(z.geo_key AS BIGINT) AS home_geo_key, CAST(p.inmate_key AS BIGINT) AS inmate_key,
    CAST(coalesce(f.facility_key, d.facility_key) AS BIGINT) AS facility_key,
    primary_charge_key, e.release_date - e.booking_date AS days,
    bail_set_amount IS NOT NULL AND bail_paid IS NOT TRUE AS held
  FROM events{n} e
  LEFT JOIN zips{d} z ON z.zip_code = e.zip_code
  LEFT JOIN people{d} p ON p.inmate_id_hash = e.inmate_id_hash
  LEFT JOIN places{d} f ON f.facility_id = e.jurisdiction || '-' || substr(e.facility, 1, 30)
  LEFT JOIN places{d} d ON d.facility_id = e.jurisdiction || '-DEFAULT'
  LEFT JOIN codes ON section = CASE WHEN charge_code_raw LIKE 'PL %' THEN substr(charge_code_raw, 4)
    ELSE charge_code_raw END),
judged{n} AS (
  SELECT *, CASE WHEN booking_date IS NULL THEN 'booking_date_missing'
    WHEN release_date < booking_date THEN 'release_before_booking'
    WHEN bail_set_amount < 0 THEN 'negative_bail' END AS reason FROM keyed{n})"""


ONE_LOAD = ",\n".join([BASE, _dimensions(""), CHARGES, LOOKUP, _events(""), _keyed("")])
TWO_LOADS = ",\n".join([
    TWO_BATCHES, _dimensions("1"), _dimensions("2", "1"), CHARGES, LOOKUP, _events("1"),
    _events("2"), _keyed("1"), _keyed("2"),
    """loaded1 AS (SELECT *, row_number() OVER (ORDER BY event_id) AS detention_key
  FROM judged1 WHERE reason IS NULL)""",
    """loaded AS (SELECT * FROM loaded1 UNION ALL
  SELECT *, (SELECT coalesce(max(detention_key), 0) FROM loaded1) + row_number() OVER (ORDER BY event_id)
  FROM judged2 WHERE reason IS NULL AND event_id NOT IN (SELECT event_id FROM loaded1))""",
])

_CUSTODY_RAW = """inmate_id AS inmateid, booking_date AS admitted_dt, race_ethnicity AS race, gender,
  age, detention_status_code AS inmate_status_code, charge_code_raw AS top_charge, custody_level,
  infraction_flag AS infraction, sealed_flag AS sealed"""
_COURT = ", ".join(config.COURT_COLUMNS)
_UNION = """inmate_id, booking_date, release_date, race_ethnicity, gender, age,
  detention_status_code, charge_code_raw, custody_level, infraction_flag, sealed_flag,
  bail_set_amount, bail_type, bail_paid, case_disposition, zip_code, facility, jurisdiction,
  source_system"""

COUNTIES = """counties AS (
  SELECT year, CASE WHEN n < 9 THEN ['36005', '36047', '36061', '36081', '36085', '06037', '11001',
      '24510', '24033'][n + 1] ELSE lpad(CAST(1001 + n * 2 AS VARCHAR), 5, '0') END AS county_fips,
    'County ' || n AS county_name, ['NY', 'CA', 'DC', 'MD', 'TX'][n % 5 + 1] AS state_abbr,
    ['urban', 'rural'][n % 2 + 1] AS urbanicity,
    CASE WHEN n <> 4 THEN CAST(500 + n * 40 + (year - 1970) * 10 AS DOUBLE) END AS total_jail_pop,
    CAST(300 + n * 25 + (year - 1970) * 6 AS DOUBLE) AS total_pretrial_custody,
    CAST(150 + n * 10 + (year - 1970) * 3 AS DOUBLE) AS total_sentenced_custody,
    CAST(100 + n * 9 AS DOUBLE) AS black_jail_pop, CAST(80 + n * 7 AS DOUBLE) AS latinx_jail_pop,
    CAST(90 + n * 8 AS DOUBLE) AS white_jail_pop,
    CASE WHEN n = 8 THEN 0e0 ELSE CAST(800 + n * 30 AS DOUBLE) END AS jail_rated_capacity,
    CAST(2000 + n * 3 AS DOUBLE) AS total_jail_admits,
    CAST(1990 + n * 3 AS DOUBLE) AS total_jail_discharges
  FROM (SELECT DISTINCT c_nationkey AS n, CAST(1970 + c_custkey % 53 AS INTEGER) AS year
    FROM customer))"""
_TARGETS = f"(VALUES {values(config.TARGET_COUNTIES)}) t(county_fips, jurisdiction_label)"
_TARGETED = f"SELECT * FROM counties JOIN {_TARGETS} USING (county_fips)"


def _shares(area: str) -> str:
    tenths = "CAST(round(pretrial_share * 10) AS BIGINT)"

    def around(condition: str) -> str:
        part = f"CASE WHEN {condition} THEN {tenths} END"
        return (
            f"round(10e0 * (sum({part}) OVER (PARTITION BY {area}))"
            f" / nullif((count({part}) OVER (PARTITION BY {area})) * 10, 0)) / 10e0"
        )

    return f"""
SELECT *, {around('year < 2017')} AS mean_before_reform, {around('year >= 2017')} AS mean_since_reform
FROM (
  SELECT {area}, year, {rate('sum(total_pretrial_custody)', 'sum(total_jail_pop)')} AS pretrial_share,
    {rate('sum(black_jail_pop)', 'sum(total_jail_pop)')} AS black_share,
    {rate('sum(latinx_jail_pop)', 'sum(total_jail_pop)')} AS latinx_share,
    {rate('sum(white_jail_pop)', 'sum(total_jail_pop)')} AS white_share
  FROM counties GROUP BY 1, 2)"""


def _since(days: int) -> str:
    return f"{_day('booking_date')} >= {AS_OF} - {days}"


def _count(columns: str) -> str:
    return f"SELECT {columns}, count(*) AS bookings FROM enriched GROUP BY ALL"


_FACT_OUT = """event_id, inmate_key, facility_key, home_geo_key, primary_charge_key"""


def checks() -> dict[str, str]:
    """Full check SQL per operator ID."""

    def on(prelude: str, body: str) -> str:
        return f"WITH {prelude}\n{body}"

    tag = f"jurisdiction, source_system, {AT} AS extracted_at"
    custody = f"SELECT {_CUSTODY_RAW}, {tag} FROM intake WHERE source_system = {CUSTODY}"
    court = f"SELECT {_COURT}, {tag} FROM intake WHERE source_system ="
    acs = f"acs AS (SELECT {_figures(False)}, lpad(CAST(601 + n_nationkey * 371 AS VARCHAR), 5, '0') AS zip_code FROM nation)"
    ctx = _context("", False)
    return {
        "S01": on(INTAKE, custody),
        "S02": on(INTAKE, f"{court} {DC}"),
        "S03": on(INTAKE, f"{custody} AND {_since(400)}"),
        "S04": on(INTAKE, f"SELECT * FROM ({custody}) ORDER BY {_day('admitted_dt')}"),
        "S05": on(INTAKE, f"""SELECT source_system, count(*) AS bookings FROM intake
            WHERE source_system IN ({CUSTODY}, {DISCHARGES}, {DC}) GROUP BY 1"""),
        "S06": on(INTAKE, f"""SELECT {tag}, count(*) AS bookings FROM intake
            WHERE source_system = {DISCHARGES} GROUP BY ALL"""),
        "S07": on(INTAKE, f"SELECT {_UNION}, {AT} AS extracted_at FROM intake WHERE source_system <> {MD}"),
        "S08": on(INTAKE, "SELECT inmate_id, booking_date, zip_code AS \"home-zip\" FROM intake"),
        "S09": on(COUNTIES, "SELECT * FROM counties"),
        "S10": on(COUNTIES, """SELECT year, state_abbr, sum(total_jail_pop) AS total_jail_pop,
            sum(total_pretrial_custody) AS total_pretrial_custody FROM counties GROUP BY 1, 2"""),
        "S11": on(acs, "SELECT * FROM acs"),
        "S12": on(DEATHS, "SELECT *, 'Marshall Project' AS source FROM deaths"),
        "S13": on(GEOGRAPHY, """SELECT zip_code, city, jurisdiction, median_household_income,
            CASE WHEN n % 6 <> 1 THEN CAST(1 + n * 3 % 9 AS DOUBLE) END AS eviction_rate_per_100,
            CAST(2 + n * 5 % 11 AS DOUBLE) AS eviction_filing_rate
            FROM (SELECT *, CAST(geo_key - 1 AS INTEGER) AS n FROM geo)"""),
        "S14": on(BASE, """SELECT copy, jurisdiction, count(*) AS bookings, count(work_days_to_bail) AS with_bail_gap
            FROM enriched CROSS JOIN (VALUES ('snapshot'), ('latest')) c(copy) GROUP BY 1, 2"""),
        "S15": on(COUNTIES, _TARGETED),
        "S16": on(BASE, _count("jurisdiction, source_system, age_bucket")),
        "S17": on(CHARGES, """SELECT chg.* REPLACE (CAST(charge_key AS BIGINT) AS charge_key), coalesce(n, 0) AS bookings FROM chg LEFT JOIN (
            SELECT (o_orderkey * 7 + o_custkey) % 54 + 1 AS charge_key, count(*) AS n
            FROM orders GROUP BY 1) USING (charge_key)"""),
        "T01": on(INTAKE, f"""SELECT inmate_id, booking_date, release_date, race_ethnicity, gender, age,
            detention_status_code, charge_code_raw, jurisdiction, source_system FROM intake
            WHERE source_system = {DISCHARGES}"""),
        "T02": on(INTAKE, f"SELECT {_UNION} FROM intake WHERE age <> 'n/a'"),
        "T03": on(INTAKE, f"SELECT {_hash('inmate_id')} AS person, count(*) AS bookings FROM intake GROUP BY 1"),
        "T04": on(INTAKE, f"""SELECT {_hash('inmate_id')} AS inmate_id_hash,
            {_hash('facility')} AS address_hash, jurisdiction, count(*) AS bookings
            FROM intake GROUP BY ALL"""),
        "T05": on(INTAKE, f"SELECT age, {_AGE} AS age_bucket, count(*) AS bookings FROM intake GROUP BY ALL"),
        "T06": on(INTAKE, f"SELECT {_AGE} AS age_bucket, jurisdiction, count(*) AS bookings FROM intake GROUP BY ALL"),
        "T07": on(BASE, """SELECT jurisdiction, count(*) AS bookings, count(DISTINCT inmate_id_hash) AS people,
            0::BIGINT AS personal_columns FROM enriched GROUP BY 1"""),
        "T08": on(BASE, _count("jurisdiction, detention_status_code, pretrial_derived")),
        "T09": on(INTAKE, """SELECT detention_status_code, CASE
            WHEN trim(detention_status_code) IN ('DE', 'DEP', 'DNS') THEN 'pretrial'
            WHEN trim(detention_status_code) IN ('CS', 'CSP', 'SSR') THEN 'sentenced'
            WHEN trim(detention_status_code) = 'DPV' THEN 'parole' ELSE 'unknown' END AS custody_status,
            count(*) AS bookings FROM intake GROUP BY ALL"""),
        "T10": on(BASE, _count("zip_code")),
        "T11": on(INTAKE, f"""SELECT DISTINCT {_zip('zip_code')} AS zip_code FROM intake
            WHERE trim(zip_code) <> ''"""),
        "T12": on(ctx, "SELECT * FROM typed"),
        "T13": on(ctx, """SELECT zip_code, median_daily_income, poverty_rate_pct, pct_children_single_parent,
            pct_severely_rent_burdened, pct_bachelors_or_higher, pct_black, pct_white, pct_hispanic
            FROM ctx"""),
        "T14": on(ctx, "SELECT * FROM ctx"),
        "T15": on(BASE, f"""SELECT inmate_id_hash, booking_date, source_system, zip_code,
            {', '.join(_FIGURES)} FROM enriched"""),
        "T16": on(BASE, """SELECT inmate_id_hash, booking_date, bail_set_amount, bail_set_amount_num,
            median_daily_income, work_days_to_bail FROM enriched"""),
        "T17": on(BASE, _count("jurisdiction, booking_date, booking_date_parsed, is_md_reform_case")),
        "T18": on(BASE, _count("etl_batch_id, etl_loaded_at")),
        "T19": on(BASE, f"""SELECT count(*) AS rows,
            {rate('count(work_days_to_bail)', 'count(*)')} AS bail_gap_coverage_pct,
            {quantile('work_days_to_bail', 0.5)} AS median_work_days_to_bail,
            {rate('count(median_household_income)', 'count(*)')} AS census_coverage_pct FROM enriched"""),
        "T20": on(BASE, f"""SELECT jurisdiction, count(*) AS rows,
            {rate('count(*) FILTER (WHERE pretrial_derived)', 'count(*)')} AS pct_pretrial_derived,
            count(*) FILTER (WHERE jurisdiction = 'MD' AND booking_date_parsed < DATE '2017-07-01')
              AS pre_reform,
            count(*) FILTER (WHERE is_md_reform_case) AS post_reform,
            {avg('work_days_to_bail', 1)} AS avg_work_days_to_bail FROM enriched GROUP BY 1"""),
        "T21": on(COUNTIES, _TARGETED),
        "T22": on(COUNTIES, f"""SELECT jurisdiction_label, year, total_jail_pop, total_pretrial_custody,
            black_jail_pop, {rate('total_pretrial_custody', 'total_jail_pop')} AS pretrial_pct,
            {rate('total_jail_pop', 'jail_rated_capacity')} AS capacity_pct
            FROM ({_TARGETED}) WHERE year = (SELECT max(year) FROM counties)"""),
        "T23": on(COUNTIES, """SELECT count(*) AS rows, count(DISTINCT county_fips) AS counties,
            min(year) AS first_year, max(year) AS last_year FROM counties"""),
        "T24": on(BASE, f"""SELECT h.inmate_id_hash, h.booking_date_parsed AS booking_day, release_day,
            CAST(release_day - h.booking_date_parsed AS INTEGER) AS days_detained
            FROM (SELECT inmate_id_hash, booking_date_parsed FROM enriched
              WHERE source_system = {CUSTODY}) h
            LEFT JOIN (SELECT inmate_id_hash, booking_date_parsed, max(release_day) AS release_day
              FROM enriched WHERE source_system = {DISCHARGES} AND inmate_id_hash <> 'UNKNOWN'
                AND booking_date_parsed IS NOT NULL GROUP BY 1, 2) r
            ON r.inmate_id_hash = h.inmate_id_hash AND r.booking_date_parsed = h.booking_date_parsed"""),
        "T25": on(INTAKE, custody),
        "T26": f"""SELECT jurisdiction, year, coalesce(a, 0) AS register_deaths,
            coalesce(b, 0) AS other_deaths, coalesce(a, 0) - coalesce(b, 0) AS gap
            FROM (SELECT {j('user_id')} AS jurisdiction, year(ts) AS year, count(*) AS a FROM events
              WHERE event_id % 2 = 0 GROUP BY 1, 2)
            FULL JOIN (SELECT {j('user_id')} AS jurisdiction, year(ts) AS year, count(*) AS b FROM events
              WHERE event_id % 2 = 1 GROUP BY 1, 2) USING (jurisdiction, year)""",
        "T27": on(COUNTIES, _shares("county_fips")),
        "W01": on(f"{TWO_BATCHES},\n{_dimensions('1')},\n{_dimensions('2', '1')}", f"""
            SELECT CAST(g.geo_key AS BIGINT) AS geo_key, zip_code, g.jurisdiction,
              {', '.join(f'CASE WHEN n.zip_code IS NULL THEN g.{c} ELSE n.{c} END AS {c}' for c in _FIGURES[:3])},
              {', '.join(f'g.{c}' for c in _FIGURES[3:])}, 2022::SMALLINT AS census_vintage
            FROM zips2 g LEFT JOIN ({_zips('enriched2')}) n USING (zip_code)"""),
        "W02": on(f"{TWO_BATCHES},\n{_dimensions('1')},\n{_dimensions('2', '1')}",
                  "SELECT * REPLACE (CAST(inmate_key AS BIGINT) AS inmate_key) FROM people2"),
        "W03": on(f"{TWO_BATCHES},\n{_dimensions('1')},\n{_dimensions('2', '1')}",
                  """SELECT facility_id, facility_name, jurisdiction,
                  CAST(facility_key AS BIGINT) AS facility_key, false AS federal_oversight FROM places2"""),
        "W04": on(INTAKE, f"""SELECT facility_id, facility_name, count(*) AS bookings
            FROM intake JOIN (VALUES {_DEFAULTS}) d(facility_id, facility_name, jurisdiction)
            USING (jurisdiction) WHERE facility IS NULL GROUP BY 1, 2"""),
        "W05": on(f"{INTAKE},\n{CHARGES},\n{LOOKUP}", """SELECT charge_code_raw, primary_charge_key, count(*) AS bookings
            FROM intake LEFT JOIN codes ON section = CASE WHEN charge_code_raw LIKE 'PL %'
              THEN substr(charge_code_raw, 4) ELSE charge_code_raw END GROUP BY ALL""".replace(
                "primary_charge_key,", "CAST(primary_charge_key AS BIGINT) AS primary_charge_key,", 1)),
        "W06": on(ONE_LOAD, f"""SELECT {_FACT_OUT.replace('primary_charge_key',
            'CAST(primary_charge_key AS BIGINT) AS primary_charge_key')} FROM keyed"""),
        "W07": on(ONE_LOAD, """SELECT jurisdiction, facility IS NULL AS defaulted, facility_key,
            count(*) AS bookings FROM keyed GROUP BY ALL"""),
        "W08": on(f"{BASE},\n{_events('')}", "SELECT *, NULL::VARCHAR AS sentence_type FROM shaped"),
        "W09": on(",\n".join([BASE, f"early AS (SELECT * FROM enriched WHERE booking_date_parsed < {CUT})",
                              f"known AS ({_people('early')})", _events("")]),
                  """SELECT jurisdiction, count(*) AS kept FROM events
                  WHERE inmate_id_hash IN (SELECT inmate_id_hash FROM known) GROUP BY 1"""),
        "W10": on(TWO_LOADS, "SELECT event_id, detention_key, jurisdiction FROM loaded"),
        "W11": on(f"{BASE},\n{_events('')}", """SELECT event_id, booking_date, release_date, bail_set_amount, bail_paid,
            CAST(release_date - booking_date AS INTEGER) AS detention_length_days,
            bail_set_amount IS NOT NULL AND bail_paid IS NOT TRUE AS pretrial_detention_flag
            FROM events"""),
        "W12": on(f"{BASE},\n{_events('')}",
                  "SELECT event_id, row_number() OVER (ORDER BY event_id) AS detention_key FROM events"),
        "W13": on(ONE_LOAD, "SELECT jurisdiction, reason, count(*) AS bookings FROM judged GROUP BY ALL"),
        "W14": on(ONE_LOAD, """
            SELECT 'fact booking_date not null' AS rule, count(*) FILTER (WHERE booking_date IS NULL)
              AS violations FROM keyed
            UNION ALL SELECT 'raw person unique', count(*) - count(DISTINCT inmate_id_hash) FROM enriched
            UNION ALL SELECT 'person hash unique', 0
            UNION ALL SELECT 'fact charge known', 0
            UNION ALL SELECT 'raw facility known', count(*) FROM enriched WHERE facility IS NOT NULL
              AND facility NOT IN (SELECT facility_id FROM places)"""),
        "W15": on(BASE, """SELECT coalesce(bail_type, 'No Bail Set') AS bail_type, false AS federal_oversight,
            2022 AS census_vintage, count(*) AS bookings FROM enriched GROUP BY ALL"""),
        "W16": on(TWO_LOADS, """SELECT jurisdiction, count(*) AS bookings, min(detention_key) AS first_key,
            max(detention_key) AS last_key FROM (
              SELECT *, row_number() OVER (ORDER BY event_id) AS detention_key
              FROM judged2 WHERE reason IS NULL) GROUP BY 1"""),
        "W17": on(ONE_LOAD, f"""SELECT jurisdiction, count(*) AS total_detained,
            count(*) FILTER (WHERE held) AS legally_innocent,
            {rate('count(*) FILTER (WHERE held)', 'count(*)')} AS pct_legally_innocent,
            count(*) FILTER (WHERE held AND bail_set_amount <= 500) AS held_under_500_bail,
            count(*) FILTER (WHERE held AND bail_set_amount <= 1000) AS held_under_1000_bail,
            {avg('CASE WHEN held THEN days END', 0)} AS avg_pretrial_days,
            round(round(quantile_cont(CASE WHEN held THEN days END, 0.5), 4)) AS median_pretrial_days
            FROM judged WHERE reason IS NULL GROUP BY 1"""),
    }
