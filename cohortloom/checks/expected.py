"""Fixed values the checking SQL expects, written out apart from the code that is checked."""

from __future__ import annotations

GENDER = {"m": 8507, "male": 8507, "f": 8532, "female": 8532}
RACE = {
    "white": 8527, "black": 8516, "african american": 8516, "asian": 8515, "native": 8657,
    "american indian": 8657, "alaska native": 8657, "hawaiian": 8557, "other": 38003613,
}
ETHNICITY = {
    "hispanic": 38003563, "hispanic or latino": 38003563, "nonhispanic": 38003564,
    "not hispanic or latino": 38003564,
}
PROVIDER_GENDER = {"M": 8507, "F": 8532}
VISIT_CLASS = {
    "inpatient": 9201, "outpatient": 9202, "wellness": 9202, "ambulatory": 38004207,
    "emergency": 9203, "urgentcare": 8782,
}
MEASUREMENT_TYPE = {"laboratory": "LP29693-6", "vital-signs": "LP30605-7", "exam": "LP7801-6"}
OBSERVATION_TYPE = {"health indicator": "723111000000104"}
QUALITY = {"QOLS": "LP156440-2", "QALY": "273724008", "DALY": "D000087509"}
COUNTRY, COUNTRY_CONCEPT = "Ireland", 4330438
PLACE_OF_SERVICE, SPECIALTY = 38004446, 4216158
FROM_RECORD, FROM_ENCOUNTERS = 32817, 32827
NO_ENCOUNTER = "3637e207-a102-5065-71b0-7420e18b1b5f"
NO_REASON = "Unknown"
CONDITION_CODES = ["SNOMED", "ICD10CM", "ICD9CM"]
PROCEDURE_CODES = ["SNOMED", "CPT4", "HCPCS"]
PROCEDURE_SOURCES = ["SNOMED", "HemOnc", "NAACCR"]
DRUG_CODES = ["RxNorm", "CVX", "RxNorm Extension"]
DRUG_SOURCES = ["RxNorm", "CVX", "RxNorm Extension", "HCPCS", "CPT4", "HemOnc", "NAACCR"]
DETAIL_CODES = ["SNOMED"]
MEASUREMENT_CODES = ["SNOMED", "LOINC"]
OBSERVATION_CODES = ["LOINC", "SNOMED", "MeSH"]
