"""Code sets, column lists, the source registry and the charge taxonomy.

Everything in this file has to match the published data sources and the
published taxonomy, so it is kept together and stated as plain text.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# --- jurisdictions and reform -------------------------------------------------
JURISDICTIONS = ["NYC", "LA", "DC", "MD"]
REFORM_JURISDICTION = "MD"
REFORM_DATE = date(2017, 7, 1)
REFORM_WINDOW = (date(2015, 7, 1), date(2019, 6, 30))
PLEA_SINCE = date(2018, 1, 1)
BAIL_GAP_SINCE = date(2020, 1, 1)
MIN_WAGE_PER_DAY = 58.0

# --- fixed values: fact domains -----------------------------------------------
CASH_BAIL_TYPES = ["Cash", "Bond"]
NO_CASH_BAIL_TYPES = ["ROR", "No Bail (MD Reform)", "Supervised Release"]
REMAND = "Remand"
GUILTY_PLEA = "Guilty Plea"
EXONERATING = ["Trial - Not Guilty", "Dismissed", "Nolle Prosequi", "ACD"]
AGE_BUCKETS = ["<18", "18-24", "25-34", "35-44", "45-54", "55-64", "65+", "Unknown"]
AGE_BUCKET_STARTS = [18, 25, 35, 45, 55, 65]

# --- fixed values: custody status codes ---------------------------------------
PRETRIAL_CODES = ["DE", "DEP", "DNS"]
SENTENCED_CODES = ["CS", "CSP", "SSR"]
PAROLE_CODES = ["DPV"]

# --- fixed values: column names that carry personal data ----------------------
PII_COLUMNS = [
    "inmateid", "inmtid", "inmate_id", "name", "first_name", "last_name", "full_name",
    "nysid", "book_case_id", "booking_number", "arrest_id", "defendant_id", "person_id",
    "dob", "date_of_birth", "address", "street_address", "phone", "phone_number",
    "social_security", "ssn",
]
AGE_COLUMNS = ["age", "age_at_booking", "defendant_age"]
UNKNOWN_PERSON = "UNKNOWN"

# --- fixed values: candidate column names, first present wins -----------------
ZIP_CANDIDATES = [
    "zip_code", "zipcode", "zip", "home_zip", "booking_zip", "residence_zip", "addr_zip",
]
FACILITY_CANDIDATES = ["facility", "facility_id", "facility_name", "housed_in_facility"]
BOOKING_DATE_CANDIDATES = ["booking_date", "admitted_dt", "book_date"]
RELEASE_DATE_CANDIDATES = ["release_date", "discharge_date"]
BAIL_AMOUNT_CANDIDATES = ["bail_set_amount", "bail_amount", "bond_amount"]
BAIL_TYPE_CANDIDATES = ["bail_type", "bond_type"]

# --- fixed values: default facility per jurisdiction --------------------------
DEFAULT_FACILITIES = [
    ("NYC-DEFAULT", "NYC DOC", "NYC"),
    ("LA-DEFAULT", "LA County Jail", "LA"),
    ("DC-DEFAULT", "DC DOC", "DC"),
    ("MD-DEFAULT", "Maryland Pretrial", "MD"),
]

# --- fixed values: census variables -------------------------------------------
CENSUS_VINTAGE = 2022
CENSUS_ZIP_HEADER = "zip code tabulation area"
CENSUS_VARIABLES = {
    "B19013_001E": "median_household_income",
    "B17001_002E": "people_below_poverty_line",
    "B17001_001E": "poverty_universe_total",
    "B15003_022E": "bachelors_degree_count",
    "B15003_001E": "education_universe_total",
    "B15003_002E": "no_schooling_count",
    "B09002_002E": "children_married_couple_hh",
    "B09002_008E": "children_single_mother_hh",
    "B09002_011E": "children_single_father_hh",
    "B09002_001E": "children_total",
    "B25070_010E": "rent_burdened_50pct_plus",
    "B25070_001E": "renter_universe_total",
    "B25002_003E": "vacant_housing_units",
    "B01003_001E": "total_population",
    "B02001_002E": "white_alone",
    "B02001_003E": "black_alone",
    "B02001_004E": "native_alone",
    "B02001_005E": "asian_alone",
    "B03001_003E": "hispanic_or_latino",
}
CENSUS_OUTPUTS = [
    "zip_code", "total_population", "median_household_income", "median_daily_income",
    "poverty_rate_pct", "pct_children_single_parent", "pct_severely_rent_burdened",
    "pct_bachelors_or_higher", "pct_black", "pct_white", "pct_hispanic",
]

# --- fixed values: counties followed in the trend data ------------------------
TARGET_COUNTIES = [
    ("36005", "Bronx, NY"),
    ("36047", "Brooklyn, NY"),
    ("36061", "Manhattan, NY"),
    ("36081", "Queens, NY"),
    ("36085", "Staten Island, NY"),
    ("06037", "Los Angeles, CA"),
    ("11001", "Washington, DC"),
    ("24510", "Baltimore City, MD"),
    ("24033", "Prince George's County, MD"),
]
REFORM_YEAR = 2017
DEATHS_SOURCE = "Marshall Project"
COVERAGE_WARNING_PCT = {"work_days_to_bail": 30.0, "median_household_income": 50.0}

# --- source registry ----------------------------------------------------------
UNVERIFIED = "NEEDS_VERIFICATION"


@dataclass(frozen=True)
class Source:
    """One landed data set. ``kind`` is 'records' (flat rows) or 'features' (pages)."""

    name: str
    jurisdiction: str
    dataset_id: str
    date_field: str
    kind: str = "records"
    column_map: dict[str, str] = field(default_factory=dict)

    @property
    def verified(self) -> bool:
        return self.dataset_id != UNVERIFIED


# Raw field name -> schema name. The keys are also the fields that are read at all.
SOURCES = [
    Source(
        "NYC Daily Inmates In Custody", "NYC", "7479-ugqb", "admitted_dt",
        column_map={
            "inmateid": "inmate_id",
            "admitted_dt": "booking_date",
            "race": "race_ethnicity",
            "gender": "gender",
            "age": "age",
            "inmate_status_code": "detention_status_code",
            "top_charge": "charge_code_raw",
            "custody_level": "custody_level",
            "infraction": "infraction_flag",
            "sealed": "sealed_flag",
        },
    ),
    Source(
        "NYC Inmate Discharges", "NYC", "94ri-3ium", "admitted_dt",
        column_map={
            "inmateid": "inmate_id",
            "admitted_dt": "booking_date",
            "discharged_dt": "release_date",
            "race": "race_ethnicity",
            "gender": "gender",
            "age": "age",
            "inmate_status_code": "detention_status_code",
            "top_charge": "charge_code_raw",
        },
    ),
    Source("LA County Jail — PENDING VERIFICATION", "LA", UNVERIFIED, "booking_date"),
    Source("MD Jail Data — AGGREGATE ONLY", "MD", UNVERIFIED, "year"),
    Source("DC DOC Population (Aggregate)", "DC", "population-statistics", "report_date", kind="features"),
]
# Daily custody and, once released, the discharge of the same admission.
CUSTODY_SOURCE, DISCHARGE_SOURCE = SOURCES[0].name, SOURCES[1].name
# Fields of booking records obtained from courts or by records request (already schema names).
COURT_COLUMNS = [
    "inmate_id", "booking_date", "release_date", "race_ethnicity", "gender", "age",
    "detention_status_code", "charge_code_raw", "bail_set_amount", "bail_type", "bail_paid",
    "case_disposition", "zip_code", "facility",
]

# --- fixed values: charge taxonomy --------------------------------------------
# (description, class, jurisdiction, statute section), grouped by category and flag.
# Keys run 1..54 in this order.
_TAXONOMY = {
    ("Violent", "violent"): [
        ("Murder / Homicide", "Felony A", "ALL", "PL 125"),
        ("Manslaughter", "Felony B", "ALL", "PL 125"),
        ("Rape / Sexual Assault", "Felony B", "ALL", "PL 130"),
        ("Robbery (Armed)", "Felony B", "ALL", "PL 160"),
        ("Robbery (Unarmed)", "Felony C", "ALL", "PL 160"),
        ("Assault (Felony)", "Felony C", "ALL", "PL 120"),
        ("Assault (Misdemeanor)", "Misd A", "ALL", "PL 120"),
        ("Kidnapping", "Felony A", "ALL", "PL 135"),
        ("Arson", "Felony B", "ALL", "PL 150"),
        ("Burglary (Occupied)", "Felony B", "ALL", "PL 140"),
        ("Domestic Violence - Assault", "Misd A", "ALL", "PL 120"),
        ("Weapons Possession (w/ intent)", "Felony C", "ALL", "PL 265"),
    ],
    ("Property", None): [
        ("Grand Larceny (over $1,000)", "Felony E", "ALL", "PL 155"),
        ("Grand Larceny (over $3,000)", "Felony D", "ALL", "PL 155"),
        ("Identity Theft", "Felony E", "ALL", "PL 190"),
        ("Fraud / Forgery", "Felony E", "ALL", "PL 170"),
        ("Auto Theft", "Felony D", "ALL", "PL 155"),
        ("Burglary (Unoccupied)", "Felony C", "ALL", "PL 140"),
        ("Criminal Mischief", "Misd A", "ALL", "PL 145"),
    ],
    ("Drug", "addiction"): [
        ("Criminal Possession Controlled Substance 7th", "Misd A", "NYC", "PL 220.03"),
        ("Criminal Possession Controlled Substance 5th", "Felony D", "NYC", "PL 220.06"),
        ("Criminal Possession Controlled Substance 4th", "Felony C", "NYC", "PL 220.09"),
        ("Possession of Drug Paraphernalia", "Infraction", "ALL", None),
        ("Possession of Marijuana (small amt)", "Infraction", "ALL", None),
        ("Possession of Marijuana (felony)", "Felony E", "ALL", None),
        ("Possession of Heroin", "Felony D", "ALL", None),
        ("Possession of Cocaine", "Felony D", "ALL", None),
        ("Possession of Fentanyl", "Felony C", "ALL", None),
        ("Possession of Methamphetamine", "Felony D", "ALL", None),
        ("Public Intoxication", "Infraction", "ALL", None),
        ("Driving Under Influence (first)", "Misd A", "ALL", None),
    ],
    ("Drug", None): [
        ("Criminal Sale Controlled Substance", "Felony B", "NYC", "PL 220.39"),
        ("Drug Trafficking", "Felony A", "ALL", None),
    ],
    ("Poverty-Linked", "poverty"): [
        ("Fare Evasion / Theft of Services", "Infraction", "NYC", "PL 165.15"),
        ("Trespassing (Misdemeanor)", "Misd B", "ALL", "PL 140.05"),
        ("Loitering", "Infraction", "ALL", None),
        ("Disorderly Conduct", "Infraction", "ALL", "PL 240.20"),
        ("Petit Larceny (under $250)", "Misd A", "ALL", "PL 155.25"),
        ("Petit Larceny ($250-$1000)", "Misd A", "ALL", "PL 155.25"),
        ("Panhandling / Aggressive Begging", "Infraction", "ALL", None),
        ("Sleeping in Public / Vagrancy", "Infraction", "ALL", None),
        ("Urinating in Public", "Infraction", "ALL", None),
        ("Open Container", "Infraction", "ALL", None),
        ("Criminal Trespass (Housing)", "Misd B", "ALL", "PL 140.10"),
        ("Bench Warrant - Failure to Appear", "Misd A", "ALL", None),
        ("Failure to Pay Fine", "Infraction", "ALL", None),
        ("Probation Violation (technical)", "Misd A", "ALL", None),
    ],
    ("Other", None): [
        ("Weapons Possession (unlicensed)", "Felony E", "ALL", "PL 265"),
        ("Resisting Arrest", "Misd A", "ALL", "PL 205.30"),
        ("Obstruction of Justice", "Misd A", "ALL", None),
        ("Contempt of Court", "Misd A", "ALL", None),
        ("Immigration Hold (ICE Detainer)", "Administrative", "ALL", None),
        ("Mental Health Hold", "Civil", "ALL", None),
        ("Unknown / Not Specified", None, "ALL", None),
    ],
}


def taxonomy_rows() -> list[dict]:
    """The 54 classified charges as records, keyed in order."""
    listed = [(group, charge) for group, charges in _TAXONOMY.items() for charge in charges]
    return [
        {
            "charge_key": key,
            "charge_code": None,
            "charge_description": description,
            "charge_class": charge_class,
            "charge_category": category,
            "is_violent": flag == "violent",
            "is_poverty_linked": flag == "poverty",
            "is_addiction_related": flag == "addiction",
            "jurisdiction": jurisdiction,
            "penal_law_section": section,
        }
        for key, ((category, flag), (description, charge_class, jurisdiction, section))
        in enumerate(listed, start=1)
    ]
