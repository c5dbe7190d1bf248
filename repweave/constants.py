"""Fixed values that published outputs must reproduce exactly.

FIXED VALUES: labels, names, metric lists and date ranges below are part of
the published output format and are kept verbatim, in their natural order.
"""

# --- FIXED VALUES: race/ethnicity labels (hisp_rrace) ----------------------
RACE_LABEL_WHITE = "White alone, not Hispanic"
RACE_LABEL_BLACK = "Black alone, not Hispanic"
RACE_LABEL_ASIAN = "Asian alone, not Hispanic"
RACE_LABEL_OTHER = "Two or more races + Other races, not Hispanic"
RACE_LABEL_HISPANIC = "Hispanic or Latino (may be of any race)"

# race indicator name -> substring that marks membership in hisp_rrace
RACE_PATTERNS = {
    "black": "Black alone",
    "white": "White",
    "hispanic": "Latino",
    "asian": "Asian",
    "other": "Two or",
}

# --- FIXED VALUES: estimate grid domains ------------------------------------
METRICS = [
    "uninsured",
    "insured_public",
    "inc_loss",
    "expect_inc_loss",
    "rent_not_conf",
    "mortgage_not_conf",
    "rent_not_paid",
    "mortgage_not_paid",
    "food_insufficient",
    "classes_cancelled",
    "depression_anxiety_signs",
    "stimulus_expenses",
    "spend_credit",
    "spend_ui",
    "spend_stimulus",
    "spend_savings",
]
RACE_INDICATORS = ["black", "asian", "hispanic", "white", "other", "total"]
RACE_GROUPS = RACE_INDICATORS[:-1]

# --- FIXED VALUES: metro areas (full title, short name, published sheet name) -
METRO_AREAS = [
    ("Atlanta-Sandy Springs-Roswell, GA", "Atlanta", "Atlanta_Metro_Area"),
    ("Boston-Cambridge-Newton, MA-NH", "Boston", "Boston_Metro_Area"),
    ("Chicago-Naperville-Elgin, IL-IN-WI", "Chicago", "Chicago_Metro_Area"),
    ("Dallas-Fort Worth-Arlington, TX", "Dallas/Fort Worth", "Dallas_Metro_Area"),
    ("Detroit-Warren-Dearborn, MI", "Detroit", "Detroit_Metro_Area"),
    ("Houston-The Woodlands-Sugar Land, TX", "Houston", "Houston_Metro_Area"),
    ("Los Angeles-Long Beach-Anaheim, CA", "Long Beach", "Los.Angeles_Metro_Area"),
    ("Miami-Fort Lauderdale-West Palm Beach, FL", "Miami/Fort Lauderdale", "Miami_Metro_Area"),
    ("New York-Newark-Jersey City, NY-NJ-PA", "New York", "New.York_Metro_Area"),
    ("Philadelphia-Camden-Wilmington, PA-NJ-DE-MD", "Philadelphia", "Philadelphia_Metro_Area"),
    ("Phoenix-Mesa-Scottsdale, AZ", "Phoenix", "Phoenix_Metro_Area"),
    ("Riverside-San Bernardino-Ontario, CA", "Riverside", "Riverside_Metro_Area"),
    ("San Francisco-Oakland-Hayward, CA", "San Francisco/Oakland", "San.Francisco_Metro_Area"),
    ("Seattle-Tacoma-Bellevue, WA", "Seattle", "Seattle_Metro_Area"),
    ("Washington-Arlington-Alexandria, DC-VA-MD-WV", "Washington DC", "Washington.DC_Metro_Area"),
]

# --- FIXED VALUES: interval date labels (en dash between the two dates) -----
INTERVAL_DATES = [
    ("wk1_2", "4/23–5/12"),
    ("wk2_3", "5/7–5/19"),
    ("wk3_4", "5/14–5/26"),
    ("wk4_5", "5/21–6/2"),
    ("wk5_6", "5/28–6/9"),
    ("wk6_7", "6/4–6/16"),
    ("wk7_8", "6/11–6/23"),
    ("wk8_9", "6/18–6/30"),
    ("wk9_10", "6/25–7/7"),
    ("wk10_11", "7/2–7/14"),
    ("wk11_12", "7/9–7/21"),
]

# --- FIXED VALUES: statistical constants ------------------------------------
Z_95 = 1.96            # two-sided 95 % normal quantile used for margins and flags
SE_MULTIPLIER = 2.0    # published SEs are twice the BRR replicate SE
N_REPLICATES = 80      # replicate weights pweight1..pweight80
QC_TOLERANCE = 0.002   # published-table comparison tolerance (named 0.001 upstream)

# --- FIXED VALUES: columns that are absent from early weekly files ----------
DRIFT_COLUMNS = ["eip", "spndsrc1", "spndsrc2", "spndsrc3", "spndsrc4",
                 "spndsrc5", "spndsrc6", "spndsrc7"]
DRIFT_FIRST_WEEK = 7
