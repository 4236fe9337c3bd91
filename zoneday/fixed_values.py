"""Values that have to equal the published study's for results to agree.

Fixed values: study window, vintages, plausibility ranges, code maps, search
terms, column names, formula constants.  They are data, not logic; every
operator takes them as arguments and only defaults to them.
"""

from __future__ import annotations

from datetime import date

# Study window and geography counts.
WINDOW_START = date(2010, 1, 1)
WINDOW_END = date(2026, 3, 17)
STATE_PREFIX = "48"
STATE_NAME = "Texas"
N_COUNTIES = 254
N_COMMUTING_ZONES = 49
ZONE_COUNT_BAND = (1900, 2100)
ROW_COUNT_BAND = (8_000_000, 15_000_000)

# Weather variables, in panel order.
COUNTY_VARIABLES = ("ppt", "tmax", "tmin", "tmean", "tdmean")
POSTAL_VARIABLES = ("tmax", "tmin", "tmean", "tdmean")
HUMIDITY_VARIABLES = ("rh_mean", "vpd_mean")

# Postal-area vintages: (name, first day, last day, id column).
VINTAGES = (
    ("zcta510", date(2010, 1, 1), date(2019, 12, 31), "ZCTA5CE10"),
    ("zcta520", date(2020, 1, 1), date(2026, 3, 17), "ZCTA5CE20"),
)

# Inclusive plausible range per variable.
PLAUSIBLE_RANGES = {
    "ppt": (-0.1, 800.0),
    "tmax": (-30.0, 55.0),
    "tmin": (-35.0, 40.0),
    "tmean": (-30.0, 50.0),
    "tdmean": (-40.0, 35.0),
    "rh_mean": (0.0, 100.0),
    "vpd_mean": (0.0, 10.0),
    "vpdmin": (0.0, 10.0),
    "vpdmax": (0.0, 80.0),
}

# Days after which a value counts as final, and as provisional.
STABLE_AFTER_DAYS = 180
PROVISIONAL_AFTER_DAYS = 14

# Saturation vapour pressure over water (Magnus form), kPa.
MAGNUS = (0.6108, 17.27, 237.3)

# Ages kept, inclusive, and days per year.
AGE_BAND = (14, 95)
DAYS_PER_YEAR = 365.25

# Marital and gender codes.
MARITAL_LABELS = {
    "I": "Single",
    "K": "Unknown",
    "M": "Married",
    "S": "Separated",
    "U": "Widowed",
}
GENDER_LABELS = {"F": "Female", "M": "Male"}
UNKNOWN = "Unknown"

# Heat-illness dictionary search.
HEAT_TERMS = (
    "heat",
    "sunstroke",
    "sun stroke",
    "hyperthermia",
    "sunburn",
    "sun burn",
    "dehydration",
    "volume depletion",
)
HEAT_EXCLUSIONS = ("sheath", "theater", "heating", "anesthesia", "newborn")
TARGET_ZONE_NAMES = ("Austin", "Dallas")
FALLBACK_DESCRIPTIONS = {"M54.5": "Low back pain"}

# Years left out of rates and means, and the last open day of the series.
EXCLUDED_YEARS = (2020, 2021)
SERIES_FIRST_YEAR = 2010
SERIES_END = date(2024, 2, 1)
FULL_YEARS = (2010, 2024)
SUMMER_MONTHS = (6, 8)

# Employment sheet selection and its twelve monthly columns.
OWNERSHIP_TOTAL = "total covered"
INDUSTRY_TOTAL = "total, all industries"
MONTH_COLUMNS = (
    "january_employment",
    "february_employment",
    "march_employment",
    "april_employment",
    "may_employment",
    "june_employment",
    "july_employment",
    "august_employment",
    "september_employment",
    "october_employment",
    "november_employment",
    "december_employment",
)
EMPLOYMENT_COLUMNS = ("st", "cnty", "year", "qtr", "ownership", "industry", "status_code", *MONTH_COLUMNS)
MONTH_LABELS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Claim columns after name repair, and the short name used here.
CLAIM_COLUMNS = {
    "Bill.Selection.Date": "bill_date",
    "Bill.ID": "bill_id",
    "Employee.Mailing.Postal.Code": "zip",
    "Employee.Date.of.Birth": "dob_my",
    "Employee.Gender.Code": "gender",
    "Employee.Marital.Status.Code": "marital",
    "Employee.Date.of.Injury": "injury_date",
    "Total.Charge.Per.Bill": "charge",
    "First.ICD.9CM.or.ICD.10CM.Diagnosis.Code": "icd1",
    "Second.ICD.9CM.or.ICD.10CM.Diagnosis.Code": "icd2",
    "Third.ICD.9CM.or.ICD.10CM.Diagnosis.Code": "icd3",
    "Fourth.ICD.9CM.or.ICD.10CM.Diagnosis.Code": "icd4",
    "Fifth.ICD.9CM.or.ICD.10CM.Diagnosis.Code": "icd5",
    "Facility.Postal.Code": "facility_zip",
}
CODE_COLUMNS = ("icd1", "icd2", "icd3", "icd4", "icd5")

# Longitude cuts between the three regions.
REGION_CUTS = ((-101.0, "West Texas"), (-97.0, "Central Texas"))
REGION_ELSE = "East Texas"

# Raster conventions.
GRID_NODATA = -9999.0
CLIP_BOX = (-106.75, 25.75, -93.4, 36.6)
MIN_RASTER_BYTES = 30 * 1024 * 1024
MIN_RASTER_SHAPE = (1200, 1000)

# State Albers equal-area plane (EPSG:3083) on GRS80.
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
ALBERS_LAT0 = 18.0
ALBERS_LON0 = -100.0
ALBERS_PARALLELS = (27.5, 35.0)
ALBERS_FALSE_ORIGIN = (1_500_000.0, 6_000_000.0)

# National Weather Service heat index: steady-state form, regression, limits.
HEAT_INDEX_COLD_F = 40.0
HEAT_INDEX_SIMPLE_MAX_F = 79.0
HEAT_INDEX_REGRESSION = (
    -42.379,
    2.04901523,
    10.14333127,
    -0.22475541,
    -0.00683783,
    -0.05481717,
    0.00122874,
    0.00085282,
    -0.00000199,
)

# Gate tolerances.
ROLLUP_TOLERANCE = 1e-6
CROSS_PANEL_TOLERANCE_C = 1.5
MAX_VIOLATION_SHARE = 0.01
COVERAGE_FLOOR_COUNTY = 99.5
COVERAGE_FLOOR_POSTAL = 99.0
CLIMATOLOGY_ZONE = ("219", 7, 28.0, 38.0)
SPOT_ZONE = ("77002", date(2011, 8, 1), date(2011, 8, 7), 30.0, 42.0)
