"""Literal lookup tables and label maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# States (and DC) by census region.
STATES_BY_REGION = {
    "Northeast": "Connecticut, Maine, Massachusetts, New Hampshire, New Jersey, New York, Pennsylvania, "
                 "Rhode Island, Vermont",
    "North Central": "Illinois, Indiana, Iowa, Kansas, Michigan, Minnesota, Missouri, Nebraska, North Dakota, "
                     "Ohio, South Dakota, Wisconsin",
    "South": "Alabama, Arkansas, Delaware, District of Columbia, Florida, Georgia, Kentucky, Louisiana, "
             "Maryland, Mississippi, North Carolina, Oklahoma, South Carolina, Tennessee, Texas, Virginia, "
             "West Virginia",
    "West": "Alaska, Arizona, California, Colorado, Hawaii, Idaho, Montana, Nevada, New Mexico, Oregon, Utah, "
            "Washington, Wyoming",
}
# Coded answers of the survey.
REGION_CODES = {1: "Northeast", 2: "North Central", 3: "South", 4: "West"}
MARITAL_CODES = {1: "M", 2: "W", 3: "D", 4: "D", 5: "S"}
MARITAL_DEFAULT = "S"
MARITAL_LABELS = {"M": "Married", "W": "Widowed", "D": "Divorced", "S": "Single"}
SEX_CODES = {1: "M", 2: "F"}
SEX_LABELS = {1: "Male", 2: "Female"}
# Race and ethnicity groups.
HISPANIC = "HISPANIC"
WHITE = "NON-HISPANIC WHITE ONLY"
BLACK = "NON-HISPANIC BLACK ONLY"
ASIAN = "NON-HISPANIC ASIAN ONLY"
OTHER_RACE = "NON-HISPANIC OTHER RACE OR MULTIPLE RACE"
RACE_CODES = {1: HISPANIC, 2: WHITE, 3: BLACK, 4: ASIAN}
RACE_NAMES = {"white": WHITE, "black": BLACK, "asian": ASIAN}
RACE_LABELS = {
    1: "Hispanic", 2: "Non-Hispanic White Only", 3: "Non-Hispanic Black Only",
    4: "Non-Hispanic Asian Only", 5: "Non-Hispanic Other Race Or Multiple Race",
}
# Insurance classes.
PRIVATE_UNDER_65 = "<65 ANY PRIVATE"
PUBLIC_UNDER_65 = "<65 PUBLIC ONLY"
NONE_UNDER_65 = "<65 UNINSURED"
MEDICARE = "65+ EDITED MEDICARE ONLY"
MEDICARE_PRIVATE = "65+ EDITED MEDICARE AND PRIVATE"
MEDICARE_PUBLIC = "65+ EDITED MEDICARE AND OTH PUB ONLY"
NONE_65 = "65+ UNINSURED"
NO_MEDICARE_65 = "65+ NO MEDICARE AND ANY PUBLIC/PRIVATE"
INSURANCE_CODES = {
    1: PRIVATE_UNDER_65, 2: PUBLIC_UNDER_65, 3: NONE_UNDER_65, 4: MEDICARE, 5: MEDICARE_PRIVATE,
    6: MEDICARE_PUBLIC, 7: NONE_65, 8: NO_MEDICARE_65,
}
INSURANCE_DEFAULT = "UNINSURED"
# Chronic condition indicator.
CHRONIC_LABELS = {"A": "Acute", "C": "Chronic", "B": "Both", "N": "N/A"}

# Comorbidity classes with their description and van Walraven weight.
COMORBIDITIES = {
    "chf": ("Congestive heart failure", 7),
    "carit": ("Cardiac arrhythmias", 5),
    "valv": ("Valvular disease", -1),
    "pcd": ("Pulmonary circulation disorders", 4),
    "pvd": ("Peripheral vascular disorders", 2),
    "hypunc": ("Hypertension, uncomplicated", 0),
    "hypc": ("Hypertension, complicated", 0),
    "para": ("Paralysis", 7),
    "ond": ("Other neurological disorders", 6),
    "cpd": ("Chronic pulmonary disease", 3),
    "diabunc": ("Diabetes, uncomplicated", 0),
    "diabc": ("Diabetes, complicated", 0),
    "hypothy": ("Hypothyroidism", 0),
    "rf": ("Renal failure", 5),
    "ld": ("Liver disease", 11),
    "pud": ("Peptic ulcer disease, excluding bleeding", 0),
    "aids": ("AIDS/HIV", 0),
    "lymph": ("Lymphoma", 9),
    "metacanc": ("Metastatic cancer", 12),
    "solidtum": ("Solid tumour, without metastasis", 4),
    "rheumd": ("Rheumatoid arthritis/collaged vascular disease", 0),
    "coag": ("Coagulopathy", 3),
    "obes": ("Obesity", -4),
    "wloss": ("Weight loss", 6),
    "fed": ("Electrolyte disorders", 5),
    "blane": ("Blood loss anaemia", -2),
    "dane": ("Deficiency anaemia", -2),
    "alcohol": ("Alcohol abuse", 0),
    "drug": ("Drug abuse", -7),
    "psycho": ("Psychoses", 0),
    "depre": ("Depression", -3),
}
SCORE_LABEL = "Elixhauser risk score"

# Code prefixes per comorbidity class (Quan et al. 2005, Medical Care 43(11)), where
# "a-b" is an inclusive run. Check against the paper before medical use.
COMORBIDITY_PREFIXES = {
    "chf": "I099 I110 I130 I132 I255 I420 I425-I429 I43 I50 P290",
    "carit": "I441-I443 I456 I459 I47-I49 R000 R001 R008 T821 Z450 Z950",
    "valv": "A520 I05-I08 I091 I098 I34-I39 Q230-Q233 Z952-Z954",
    "pcd": "I26 I27 I280 I288 I289",
    "pvd": "I70 I71 I731 I738 I739 I771 I790 I792 K551 K558 K559 Z958 Z959",
    "hypunc": "I10",
    "hypc": "I11-I13 I15",
    "para": "G041 G114 G801 G802 G81 G82 G830-G834 G839",
    "ond": "G10-G13 G20-G22 G254 G255 G312 G318 G319 G32 G35-G37 G40 G41 G931 G934 R470 R56",
    "cpd": "I278 I279 J40-J47 J60-J67 J684 J701 J703",
    "diabunc": "E100 E101 E109 E110 E111 E119 E120 E121 E129 E130 E131 E139 E140 E141 E149",
    "diabc": "E102-E108 E112-E118 E122-E128 E132-E138 E142-E148",
    "hypothy": "E00-E03 E890",
    "rf": "I120 I131 N18 N19 N250 Z490-Z492 Z940 Z992",
    "ld": "B18 I85 I864 I982 K70 K711 K713-K715 K717 K72-K74 K760 K762-K769 Z944",
    "pud": "K257 K259 K267 K269 K277 K279 K287 K289",
    "aids": "B20-B22 B24",
    "lymph": "C81-C85 C88 C96 C900 C902",
    "metacanc": "C77-C80",
    "solidtum": "C00-C26 C30-C34 C37-C41 C43 C45-C58 C60-C76 C97",
    "rheumd": "L940 L941 L943 M05 M06 M08 M120 M123 M30 M310-M313 M32-M35 M45 M461 M468 M469",
    "coag": "D65-D68 D691 D693-D696",
    "obes": "E66",
    "wloss": "E40-E46 R634 R64",
    "fed": "E222 E86 E87",
    "blane": "D500",
    "dane": "D508 D509 D51-D53",
    "alcohol": "F10 E52 G621 I426 K292 K700 K703 K709 T51 Z502 Z714 Z721",
    "drug": "F11-F16 F18 F19 Z715 Z722",
    "psycho": "F20 F22-F25 F28 F29 F302 F312 F315",
    "depre": "F204 F313-F315 F32 F33 F341 F412 F432",
}


def expand_prefixes(runs: str) -> list[str]:
    """Prefixes of a list in which "I05-I08" stands for I05, I06, I07, I08."""
    out = []
    for item in runs.split():
        low, _, high = item.partition("-")
        digits = len(low) - 1
        last = int((high or low)[1:])
        out += [f"{low[0]}{n:0{digits}d}" for n in range(int(low[1:]), last + 1)]
    return out


def comorbidity_prefixes() -> dict[str, list[str]]:
    return {name: expand_prefixes(runs) for name, runs in COMORBIDITY_PREFIXES.items()}


def comorbidity_weights() -> dict[str, int]:
    return {name: weight for name, (_, weight) in COMORBIDITIES.items()}


def state_regions(spark: SparkSession) -> DataFrame:
    """51 rows: state, region."""
    rows = [(s.strip(), region) for region, states in STATES_BY_REGION.items() for s in states.split(",")]
    return spark.createDataFrame(rows, "state string, region string")


def comorbidity_descriptions(spark: SparkSession) -> DataFrame:
    """32 rows: the classes, and the score with no weight of its own."""
    rows = [(name, text, weight) for name, (text, weight) in COMORBIDITIES.items()]
    return spark.createDataFrame(
        [*rows, ("score", SCORE_LABEL, None)], "Field_Name string, Field_DSC_Short string, vw_weights int"
    )
