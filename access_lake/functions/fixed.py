"""Fixed values of the product.

These values must equal the published product's for its results to match,
so they are written out plainly, in their natural order, in one place.
Everything else in the package takes them as default parameters.
"""

# ---------------------------------------------------------------- fixed values
# Facility-type classifier: first rule whose text occurs in the lower-cased
# type name wins; anything else is "Other".
FACILITY_TYPE_RULES = [
    ("hospital", "Hospital"),
    ("health centre", "Health Centre"),
    ("dispensary", "Dispensary"),
    ("clinic", "Clinic"),
]
FACILITY_TYPE_DEFAULT = "Other"
FACILITY_TYPES = ["Hospital", "Health Centre", "Dispensary", "Clinic", "Other"]

# Capacity weights per facility type; every other type weighs 1.
TYPE_WEIGHTS = {"Hospital": 4, "Health Centre": 2}
TYPE_WEIGHT_DEFAULT = 1

# Service keywords: a flag is true when any keyword occurs in the service
# names joined with one space and lower-cased.
SERVICE_KEYWORDS = {
    "has_maternity": ["matern", "obstet", "gynaecol", "midwif", "antenatal",
                      "postnatal", "delivery", "birth"],
    "has_art": ["antiretroviral", "art ", " art,", "hiv", "vct",
                "voluntary counsel"],
    "has_tb": ["tubercul", "tb ", "tb,", "tb-", "dots"],
    "has_emergency": ["emergency", "casualty", "trauma", "accident"],
    "has_outpatient": ["outpatient", "opd", "out-patient"],
    "has_family_planning": ["family planning", "contracepti", "long acting",
                            "short acting", "implant", "iud"],
    "has_immunisation": ["immunis", "immuniz", "vaccination", "epi "],
    "has_lab": ["laborator", "lab service", "patholog"],
    "has_pharmacy": ["pharmac", "dispensing"],
}

# Infrastructure keywords (any element contains one of them).
ELECTRICITY_KEYWORDS = ["grid", "solar", "electric"]
WATER_KEYWORDS = ["water"]

# Census standardisation: alias columns tried in this order, and the name
# values that mark header or total rows.
CENSUS_NAME_COLUMNS = ["county", "county_name", "name"]
CENSUS_POPULATION_COLUMNS = ["total_population19", "total", "population",
                             "total_population"]
CENSUS_CODE_COLUMNS = ["county_code", "code"]
CENSUS_HOUSEHOLD_COLUMNS = ["households", "number_of_households"]
CENSUS_MALE_COLUMN = "male_populatio_2019"
CENSUS_FEMALE_COLUMN = "female_population_2019"
CENSUS_TOTAL_WORDS = ["nan", "total", "kenya"]
CENSUS_YEAR = 2019

# Boundary features: property names and the "no name" marker.
FEATURE_NAME_PROPERTY = "COUNTY_NAM"
FEATURE_CODE_PROPERTY = "COUNTY_COD"
FEATURE_AREA_PROPERTY = "Shape_Area"
FEATURE_UNNAMED = "none"

# Service-gap thresholds: flag when the count is below the value
# (emergency: when the count is zero).
MATERNITY_GAP_BELOW = 3
ART_GAP_BELOW = 2
TB_GAP_BELOW = 2

# Severity score: density band points, then points per gap flag.
DENSITY_BANDS = [(1, 4), (2, 3), (5, 2)]
DENSITY_BAND_DEFAULT = 1
SEVERITY_WEIGHTS = {
    "maternity_gap_flag": 2,
    "art_gap_flag": 2,
    "tb_gap_flag": 1,
    "no_emergency_flag": 3,
}

# Facilities per 10,000 people that count as the baseline.
BASELINE_PER_10K = "2.0"

# Rates are per 10,000 (density) and per 100,000 (services), two decimals.
DENSITY_PER = 10000
SERVICE_PER = 100000

# Boundary names spelled differently from the registry, lower-cased.
GEO_NAME_ALIASES = [
    ("elegeyo-marakwet", "elgeyo marakwet"),
    ("murang'a", "muranga"),
    ("tharaka - nithi", "tharaka nithi"),
]

# Severity labels used by the ranking chart.
SEVERITY_LABELS = [(3, "critical"), (2, "high")]

# History: key and the columns whose change opens a new version.
HISTORY_KEY = "facility_id"
HISTORY_CHECK_COLUMNS = [
    "facility_name", "facility_type", "operation_status", "county_name",
    "sub_county_name", "has_maternity", "has_art", "has_tb", "has_emergency",
    "has_outpatient", "latitude", "longitude",
]

# Data-quality expectation: number of areas in the density mart.
EXPECTED_AREA_COUNT = 47

# Staging keeps only this operation status (compared lower-cased).
OPERATIONAL_STATUS = "operational"
# ------------------------------------------------------------ end fixed values
