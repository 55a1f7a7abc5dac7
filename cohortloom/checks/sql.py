"""Building blocks of the checking SQL, written independently of the Spark plans.

Pseudonyms only ever serve as join keys, so the SQL joins on the cleaned keys instead.
"""

from __future__ import annotations

import re
import uuid

from cohortloom.checks.inputs import EXTRACTS, extract_sql


def sid(text: str, source_type: str) -> str:
    """Surrogate id of a text expression, from the two 64-bit halves of the UUID."""
    namespace = uuid.uuid5(uuid.NAMESPACE_DNS, source_type).hex
    h = f"sha1(unhex('{namespace}') || encode({text}))"
    nibble = f"('0x' || substr({h}, 17, 1))::INT"
    high = f"('0x' || substr({h}, 1, 12) || '5' || substr({h}, 14, 3))::UBIGINT"
    low = f"('0x' || substr('89ab89ab89ab89ab', {nibble} + 1, 1) || substr({h}, 18, 15))::UBIGINT"
    return (
        f"CAST((({high})::HUGEINT % 1000000000 * 709551616 + ({low})::HUGEINT) % 1000000000 "
        "AS BIGINT)"
    )


def clean(text: str) -> str:
    return f"regexp_replace({text}, '[^a-zA-Z0-9]+', '', 'g')"


def lower(text: str) -> str:
    return f"lower(trim(coalesce({text}, '')))"


def ts(text: str) -> str:
    return f"TRY_CAST({text} AS TIMESTAMP)"


def cases(text: str, values: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items())
    return f"CASE {text} {arms} ELSE {default} END"


def first_by(source: str, key: str, order: str) -> str:
    """First row per key; nulls come first in the order."""
    ordered = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    return (
        f"SELECT * FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {ordered}) = 1"
    )


def eras(
    name: str,
    source: str,
    keys: list[str],
    stem: str,
    window: int = 30,
    fill: bool = True,
    person_end: bool = True,
    dose: bool = False,
) -> dict[str, str]:
    """Named subqueries that end in ``name``_eras: fill, lag, running sum, first and last."""
    start, end = f"{stem}_start_date", f"{stem}_end_date"
    ks = ", ".join(keys)
    last = "b.l," if person_end else ""
    prefix = "condition" if stem == "condition" else ("dose" if dose else "drug")
    parts = [
        f"CAST({k} AS VARCHAR)" for k in keys
    ] + ["strftime(s, '%Y-%m-%d')", "strftime(e, '%Y-%m-%d')"]
    era_id = sid(" || '_' || ".join(parts), f"{prefix} era")
    ctes = {}
    if fill:
        ctes |= {
            f"{name}_bounds": f"""SELECT person_id, min({start}) AS f, max({end}) AS l
                FROM {source} GROUP BY person_id""",
            f"{name}_known": f"""SELECT t.*, {start} IS NULL AS late,
                coalesce({start}, b.f, {end} - 30) AS s1, {last} b.f
                FROM {source} t LEFT JOIN {name}_bounds b ON t.person_id = b.person_id""",
            f"{name}_median": f"""SELECT DATE '1970-01-01' + CAST(floor(median(
                date_diff('day', DATE '1970-01-01', s1))) AS INT) AS m FROM {name}_known""",
            f"{name}_dated": f"""SELECT {ks}, late, coalesce(s1, m) AS s,
                coalesce({end}, {'l,' if person_end else ''} coalesce(s1, m) + 30) AS e
                FROM {name}_known, {name}_median""",
        }
    else:
        ctes[f"{name}_dated"] = (
            f"SELECT {ks}, false AS late, {start} AS s, {end} AS e FROM {source}"
        )
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    ctes |= {
        f"{name}_ranked": f"""SELECT *, row_number() OVER (PARTITION BY {ks}
            ORDER BY late, s, e) AS rn FROM {name}_dated WHERE {present}""",
        f"{name}_lagged": f"""SELECT *, lag(e) OVER (PARTITION BY {ks} ORDER BY rn) AS pe
            FROM {name}_ranked""",
        f"{name}_numbered": f"""SELECT *, sum(CASE WHEN pe IS NULL OR s - pe > {window}
            THEN 1 ELSE 0 END) OVER (PARTITION BY {ks} ORDER BY rn) AS era
            FROM {name}_lagged""",
        f"{name}_spans": f"""SELECT {ks}, arg_min(s, rn) AS s, arg_max(e, rn) AS e
            FROM {name}_numbered GROUP BY {ks}, era""",
        f"{name}_ids": f"""SELECT {era_id} AS {prefix}_era_id, {ks},
            s AS {prefix}_era_start_date, e AS {prefix}_era_end_date FROM {name}_spans""",
        f"{name}_eras": first_by(
            f"{name}_ids",
            f"{prefix}_era_id",
            f"{ks}, {prefix}_era_start_date, {prefix}_era_end_date",
        ),
    }
    return ctes


def with_parts(query: str, parts: dict[str, str]) -> str:
    """The query with those named subqueries and extracts it needs, directly or not."""
    known = {name: extract_sql(name) for name in EXTRACTS} | parts
    needed: list[str] = []

    def visit(text: str, seen: tuple[str, ...]) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_][a-z_0-9]*\b", text)):
            if word in known and word not in seen and word not in needed:
                visit(known[word], (*seen, word))
                needed.append(word)

    visit(query, ())
    if not needed:
        return query
    listed = ",\n".join(f"{name} AS ({known[name]})" for name in needed)
    return f"WITH {listed}\n{query}"
