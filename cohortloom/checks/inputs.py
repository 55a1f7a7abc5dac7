"""Clinical extracts made of the given tables.

Each extract is one projection, written in SQL that Spark and the checking database read
alike; ``{table}`` stands for a given table. Nulls, blanks, unreadable texts and inverted
intervals are put in by rules over the keys, because the given tables have none.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from cohortloom.session import staged

_EVENT = """
    'pt-' || CAST(o_custkey AS STRING) AS patient,
    'enc-' || CAST(o_orderkey AS STRING) AS encounter,
    CAST(l_partkey AS STRING) AS code,
    'Item ' || l_returnflag || l_linestatus AS description"""
_EVENT_FROM = "FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
_EVENT_DATES = """
    CASE WHEN l_quantity = 7 THEN NULL ELSE CAST(o_orderdate AS STRING) END AS start,
    CASE WHEN l_quantity = 9 THEN NULL WHEN l_quantity = 7 AND l_linenumber = 1 THEN 'open'
         ELSE CAST(l_shipdate AS STRING) END AS stop"""

EXTRACTS: dict[str, str] = {
    "patients": """
        SELECT 'pt-' || CAST(c_custkey AS STRING) AS id,
            CASE c_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN ' Male ' WHEN 2 THEN 'F'
                WHEN 3 THEN 'FEMALE' WHEN 4 THEN 'U' WHEN 5 THEN '' END AS gender,
            CASE c_mktsegment WHEN 'BUILDING' THEN 'white' WHEN 'AUTOMOBILE' THEN 'Black'
                WHEN 'MACHINERY' THEN ' Asian' WHEN 'HOUSEHOLD' THEN 'unlisted' END AS race,
            CASE c_custkey % 5 WHEN 0 THEN 'Hispanic' WHEN 1 THEN 'nonhispanic '
                WHEN 2 THEN 'Not Hispanic or Latino' WHEN 3 THEN '?' END AS ethnicity,
            CASE WHEN c_custkey % 97 = 5 THEN 'unknown' WHEN c_custkey % 89 = 7 THEN NULL
                ELSE CAST(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INT) AS STRING)
                END AS birthdate,
            CASE c_custkey % 11
                WHEN 0 THEN CAST(DATE '1996-01-01' + CAST(c_custkey % 3000 AS INT) AS STRING)
                WHEN 1 THEN '1939-06-01' WHEN 2 THEN 'n/a' END AS deathdate,
            CASE WHEN c_acctbal > 5000 THEN 'cause ' || c_mktsegment END AS cause_of_death,
            CASE WHEN c_custkey % 13 = 12 THEN NULL
                ELSE n_name || '-' || CAST(c_custkey % 40 AS STRING) END AS zip,
            c_mktsegment AS city, n_name AS state
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "providers": """
        SELECT s_name AS id, 'Dr ' || s_name AS name,
            CASE s_suppkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'x' END AS gender,
            'GENERAL PRACTICE' AS speciality,
            'Org#' || CAST(s_suppkey % 20 AS STRING) AS organization,
            n_name || '-' || CAST(s_suppkey % 40 AS STRING) AS zip
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "encounters": """
        SELECT 'enc-' || CAST(o_orderkey AS STRING) AS id,
            'pt-' || CAST(o_custkey AS STRING) AS patient,
            'Supplier#' || lpad(CAST(o_orderkey % 120 AS STRING), 9, '0') AS provider,
            'Org#' || CAST(o_orderkey % 23 AS STRING) AS organization,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'emergency' WHEN '2-HIGH' THEN 'urgentcare'
                WHEN '3-MEDIUM' THEN 'outpatient' WHEN '4-NOT SPECIFIED' THEN 'ambulatory'
                WHEN '5-LOW' THEN 'virtual' END AS encounterclass,
            CASE WHEN o_orderkey % 50 = 3 OR o_orderkey % 100 = 20 THEN NULL
                ELSE CAST(o_orderdate AS STRING) END AS start,
            CASE o_orderkey % 10 WHEN 0 THEN NULL
                WHEN 1 THEN CAST(o_orderdate - INTERVAL '2' DAY AS STRING)
                ELSE CAST(o_orderdate + INTERVAL '7' HOUR * (o_orderkey % 10) AS STRING)
                END AS stop,
            CAST(o_custkey AS STRING) AS code,
            'Encounter ' || o_orderpriority AS description,
            CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS STRING) || '.0' END AS reasoncode,
            CASE WHEN o_orderkey % 3 = 0
                THEN 'A reason that is longer than the fifty characters kept ' || o_orderstatus
                END AS reasondescription
        FROM {orders}""",
    "conditions": f"SELECT {_EVENT}, {_EVENT_DATES} {_EVENT_FROM}",
    "procedures": f"SELECT {_EVENT}, {_EVENT_DATES} {_EVENT_FROM}",
    "medications": f"SELECT {_EVENT}, l_quantity AS quantity, {_EVENT_DATES} {_EVENT_FROM}",
    "immunizations": f"""
        SELECT {_EVENT},
            CASE WHEN l_quantity = 11 THEN NULL ELSE CAST(l_shipdate AS STRING) END AS date
        {_EVENT_FROM}""",
    "observations": """
        SELECT 'pt-' || CAST(user_id AS STRING) AS patient,
            CASE WHEN event_id % 3 = 0 THEN NULL
                ELSE 'enc-' || CAST(event_id AS STRING) END AS encounter,
            CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(ts AS STRING) END AS date,
            CASE event_type WHEN 'click' THEN 'laboratory' WHEN 'view' THEN 'Vital-Signs '
                WHEN 'purchase' THEN 'survey' WHEN 'signup' THEN 'procedure'
                WHEN 'error' THEN 'health indicator' END AS category,
            CASE event_id % 9 WHEN 0 THEN 'QOLS' WHEN 1 THEN ' qaly' WHEN 2 THEN NULL
                ELSE CAST(event_id % 2500 AS STRING) END AS code,
            'Observed ' || event_type AS description,
            CASE WHEN event_id % 101 = 7 THEN '0.0005' WHEN event_id % 101 = 8 THEN '0.00001'
                WHEN event_id % 101 = 9 THEN '12345678.5' WHEN event_id % 101 = 10 THEN '25000000'
                WHEN event_id % 101 = 11 THEN '1e16' WHEN event_id % 6 = 0 THEN 'high'
                WHEN event_id % 6 = 1 THEN NULL ELSE CAST(value AS STRING) END AS value,
            CASE event_id % 4 WHEN 0 THEN 'mg' WHEN 1 THEN ' ' WHEN 2 THEN NULL
                ELSE 'score' END AS units
        FROM {events}""",
    "concept": """
        SELECT p_partkey + 1 AS concept_id,
            CASE p_partkey WHEN 1 THEN 'LP29693-6' WHEN 2 THEN 'LP30605-7'
                WHEN 3 THEN '723111000000104' WHEN 4 THEN 'LP156440-2'
                ELSE CAST(p_partkey AS STRING) END AS concept_code,
            CASE p_size % 7 WHEN 0 THEN 'SNOMED' WHEN 1 THEN 'RxNorm' WHEN 2 THEN 'ICD10CM'
                WHEN 3 THEN 'LOINC' WHEN 4 THEN 'CPT4' WHEN 5 THEN 'CVX'
                ELSE 'HemOnc' END AS vocabulary_id,
            CASE p_size % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'C' END AS standard_concept
        FROM {part}
        UNION ALL
        SELECT p_partkey + 50000000, CAST(p_partkey AS STRING),
            CASE WHEN p_size > 25 THEN 'SNOMED' ELSE 'MeSH' END,
            CASE WHEN p_size % 5 = 0 THEN 'S' END
        FROM {part}""",
    "concept_relationship": """
        SELECT p_partkey + 1 AS concept_id_1, p_partkey + p_size AS concept_id_2,
            CASE WHEN p_size % 2 = 0 THEN 'Maps to' ELSE 'Is a' END AS relationship_id
        FROM {part}
        UNION ALL
        SELECT p_partkey + 50000000, p_partkey + 1, 'Maps to' FROM {part}""",
    # With line breaks, quotes and separators inside, and an order that its columns do not give.
    "remarks": """
        SELECT CAST(event_id AS STRING) AS id,
            CASE event_id % 4 WHEN 0 THEN 'first line' || chr(10) || 'second "line", quoted'
                WHEN 1 THEN event_type || ', ' || CAST(user_id AS STRING)
                WHEN 2 THEN '"' || event_type || '"' END AS remark,
            CAST(event_id * 7919 % 1009 AS STRING) AS rank,
            CAST(user_id AS STRING) AS author
        FROM {events}""",
    "reviewed_map": """
        SELECT CAST(p_partkey AS STRING) AS source_code,
            CASE WHEN p_size = 13 THEN NULL ELSE CAST(p_size AS BIGINT) END AS source_concept_id,
            CASE WHEN p_size = 17 THEN NULL ELSE p_name END AS source_code_description,
            p_partkey + 1 AS target_concept_id
        FROM {part}""",
    "source_to_concept_map": """
        SELECT CAST(p_partkey AS STRING) AS source_code,
            CAST(p_size AS BIGINT) AS source_concept_id,
            CASE WHEN p_size = 19 THEN NULL ELSE upper(p_name) END AS source_code_description,
            p_partkey + 2 AS target_concept_id
        FROM {part} WHERE p_type = 'ECONOMY'""",
    "exposures": """
        SELECT o_custkey AS person_id, l_partkey % 5 AS drug_concept_id,
            CAST(o_orderdate AS DATE) AS drug_exposure_start_date,
            CAST(l_shipdate AS DATE) AS drug_exposure_end_date
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "open_exposures": """
        SELECT CASE WHEN l_tax = 0.08 THEN NULL ELSE l_suppkey END AS person_id,
            l_partkey % 40 AS drug_concept_id,
            CASE WHEN l_discount = 0.01 OR l_suppkey % 31 = 4 THEN NULL
                ELSE CAST(l_shipdate AS DATE) END AS drug_exposure_start_date,
            CASE WHEN l_discount = 0.02 OR l_suppkey % 37 = 4 THEN NULL
                ELSE CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) - 10
                END AS drug_exposure_end_date,
            CASE WHEN l_tax = 0.01 THEN NULL WHEN l_linenumber < 4 THEN '5'
                WHEN l_quantity = 13 THEN '0.0005' WHEN l_quantity = 14 THEN '0.00001'
                WHEN l_quantity = 15 THEN '12345678.5' WHEN l_quantity = 16 THEN '25000000'
                WHEN l_quantity = 17 THEN '1e16' ELSE '10.50' END AS quantity,
            CASE WHEN l_tax = 0.02 THEN NULL ELSE CAST(l_linenumber % 2 AS BIGINT)
                END AS dose_unit_concept_id
        FROM {lineitem}""",
    "open_conditions": """
        SELECT l_suppkey AS person_id, l_partkey % 40 AS condition_concept_id,
            CASE WHEN l_discount = 0.01 OR l_suppkey % 31 = 4 THEN NULL
                ELSE CAST(l_shipdate AS DATE) END AS condition_start_date,
            CASE WHEN l_discount = 0.02 OR l_suppkey % 37 = 4 THEN NULL
                ELSE CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT)
                END AS condition_end_date
        FROM {lineitem}""",
    "stays": """
        SELECT event_id, user_id AS person_id,
            CASE event_type WHEN 'click' THEN 'inpatient' WHEN 'view' THEN 'outpatient'
                WHEN 'purchase' THEN 'emergency' WHEN 'signup' THEN 'wellness'
                ELSE 'other' END AS encounterclass,
            ts AS start,
            CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN ts - INTERVAL '1' HOUR
                ELSE ts + INTERVAL '1' MINUTE * CAST(floor(value) AS INT) END AS stop,
            CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'dr ' || CAST(user_id % 9 AS STRING)
                END AS provider
        FROM {events}""",
    "order_spans": """
        SELECT o_orderkey AS row_id, o_custkey AS person_id, CAST(o_orderdate AS DATE) AS start,
            CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT) AS stop
        FROM {orders}""",
}

_TABLE = re.compile(r"\{(\w+)\}")
# The extracts of one join as one table: the texts of the dates are made once for all of them.
_EVENT_EXTRACTS = ("conditions", "procedures", "medications", "immunizations")
_GIVEN = re.search(r"(CASE WHEN l_quantity = 11 .*? END) AS date", EXTRACTS["immunizations"]).group(1)
_EVENTS = f"SELECT {_EVENT}, l_quantity AS quantity, {_EVENT_DATES}, {_GIVEN} AS date {_EVENT_FROM}"


class Inputs:
    """Given tables and extracts of one data folder, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A given table."""
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return self._selected(EXTRACTS[name])

    def _selected(self, text: str) -> DataFrame:
        used = sorted(set(_TABLE.findall(text)))
        return self.spark.sql(text, **{t: self.table(t) for t in used})

    def together(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """The named extracts, for a caller that reads them all: events are joined once and staged, all their rows."""
        found = {name: self[name] for name in names}
        joined = [name for name in _EVENT_EXTRACTS if name in found]
        if len(joined) > 1:
            events = staged(self._selected(_EVENTS))
            found |= {name: events.select(*found[name].columns) for name in joined}
        return found


def extract_sql(name: str) -> str:
    return _TABLE.sub(r"\1", EXTRACTS[name])
