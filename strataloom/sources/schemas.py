"""Explicit schemas of the input tables. Ids and codes are strings."""

from __future__ import annotations

from collections.abc import Iterable


def ddl(strings: str = "", ints: str = "", doubles: str = "", dates: str = "", timestamps: str = "") -> str:
    groups = (("string", strings), ("int", ints), ("double", doubles), ("date", dates), ("timestamp", timestamps))
    return ", ".join(f"`{c}` {kind}" for kind, names in groups for c in names.split())


# Common names of the yearly person file; YY stands for the two digits of the year.
PERSON_COLUMNS = (
    "DUPERSID DUID PID FAMIDYY MARRYYYX SPOUIDYY DOBMM DOBYY AGELAST REGIONYY SEX RACETHX OTHLGSPK WHTLGSPK "
    "HWELLSPK BORNUSA YRSINUS HIDEG POVLEVYY POVCATYY INSURCYY PERWTYYF TTLPYYX RXEXPYY TOTEXPYY TOTSLFYY "
    "ERTOTYY IPNGTDYY IPDISYY HHTOTDYY RXTOTYY VARSTR VARPSU"
).split()
PERSON_DRUG_COLUMNS = "DUPERSID RXTOTYY RXEXPYY RXSLFYY VARPSU VARSTR PERWTYYF RACETHX AGEYYX SEX PANEL".split()
FILL_COLUMNS = "DUPERSID RXNAME RXBEGYRX RXRECIDX RXNDC RXSFYYX RXXPYYX".split()
PERSON_STRINGS = {"DUPERSID", "DUID", "PID", "FAMIDYY", "SPOUIDYY", "RXNAME", "RXRECIDX", "RXNDC"}
PERSON_DOUBLES = {"POVLEVYY", "PERWTYYF", "TTLPYYX", "RXEXPYY", "TOTEXPYY", "TOTSLFYY", "RXSLFYY", "RXSFYYX",
                  "RXXPYYX"}


def yearly(columns: Iterable[str], year: int) -> str:
    """Schema of one year's file, with the digits of the year in its column names."""
    digits = f"{year % 100:02d}"
    kept = {"DOBYY"}
    parts = []
    for c in columns:
        kind = "string" if c in PERSON_STRINGS else "double" if c in PERSON_DOUBLES else "int"
        at = {"MARRYYYX": 5}.get(c, c.find("YY"))
        name = c if c in kept or at < 0 else c[:at] + digits + c[at + 2 :]
        parts.append(f"{name} {kind}")
    return ", ".join(parts)


LINKAGE = ddl(strings="DUPERSID", ints="PANEL STRA9621 PSU9621")
CONDITION_FLAGS = {2021: ("ERCOND", "IPCOND", "OPCOND"), 2020: ("ERNUM", "IPNUM", "OPNUM"),
                   2019: ("ERNUM", "IPNUM", "OPNUM")}


def conditions(year: int) -> str:
    return ddl(strings="DUPERSID ICD10CDX CCSR1X CCSR2X CCSR3X",
               ints="AGEDIAG CONDN " + " ".join(CONDITION_FLAGS[year]))


CROSSWALK = ", ".join(
    f"`{c}` string" for c in (
        "ICD-10-CM CODE", "ICD-10-CM CODE DESCRIPTION",
        "CCSR CATEGORY 1", "CCSR CATEGORY 1 DESCRIPTION",
        "CCSR CATEGORY 2", "CCSR CATEGORY 2 DESCRIPTION",
        "CCSR CATEGORY 3", "CCSR CATEGORY 3 DESCRIPTION",
    )
)
CROSSWALK_NAMES = {
    "ICD-10-CM CODE": "ICD10CM", "ICD-10-CM CODE DESCRIPTION": "ICD10_DSC",
    "CCSR CATEGORY 1": "CCSR1X", "CCSR CATEGORY 1 DESCRIPTION": "CCSR1X_DSC",
    "CCSR CATEGORY 2": "CCSR2X", "CCSR CATEGORY 2 DESCRIPTION": "CCSR2X_DSC",
    "CCSR CATEGORY 3": "CCSR3X", "CCSR CATEGORY 3 DESCRIPTION": "CCSR3X_DSC",
}
CHRONIC = "`ICD-10-CM CODE` string, `ICD-10-CM CODE DESCRIPTION` string, `CHRONIC INDICATOR` string"
FREQUENCIES = "ICDCMCode string, TotalDiag long"

PATIENTS = ddl(
    strings="Id RACE ETHNICITY GENDER MARITAL STATE PREFIX FIRST LAST SUFFIX MAIDEN ADDRESS CITY COUNTY ZIP",
    ints="INCOME", doubles="LAT LON", dates="BIRTHDATE",
)
PAYERS = ddl(strings="Id NAME OWNERSHIP")
PAYER_TRANSITIONS = ddl(strings="PATIENT PAYER SECONDARY_PAYER", timestamps="START_DATE END_DATE")
FACES = (
    "filename string, age double, gender_woman double, gender_man double, dominant_gender string, "
    "dominant_race string, race_white double, race_black double, race_asian double, "
    "`race_latino hispanic` double"
)
STATE_POPULATION = "state string, pop long"
