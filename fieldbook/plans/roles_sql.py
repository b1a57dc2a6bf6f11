"""The survey role tables as DuckDB SQL, for the oracle side of every check.

Each definition mirrors :mod:`fieldbook.sources.roles` expression for
expression; :func:`with_roles` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

import re

ROLE_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "location": ((), """
        SELECT c.c_custkey AS location_id, c.c_name AS address, n.n_name AS town_name,
               r.r_name AS province_name, c.c_mktsegment AS location_type
        FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "employee": ((), """
        SELECT s.s_suppkey AS assigned_employee_id,
               replace(s.s_name, '#', ' ') AS employee_name,
               '+99' || lpad(CAST(s.s_suppkey AS VARCHAR), 9, '0')
                     || CASE WHEN s.s_suppkey % 2 = 0 THEN ' ' ELSE '' END AS phone_number,
               n.n_name AS town_name
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    "water_source": ((), """
        SELECT p_partkey AS source_id,
               CASE WHEN p_type = 'ECONOMY' THEN 'river'
                    WHEN p_type = 'LARGE' THEN 'shared_tap'
                    WHEN p_type = 'MEDIUM' THEN 'tap_in_home'
                    WHEN p_type = 'PROMO' THEN 'tap_in_home_broken'
                    ELSE 'well' END AS type_of_water_source,
               CAST(p_size * 10 AS INTEGER) AS number_of_people_served
        FROM part"""),
    "well_pollution": (("water_source",), """
        SELECT source_id,
               CASE WHEN source_id % 5 = 0 THEN 'Clean'
                    WHEN source_id % 5 = 1 THEN 'Clean Bacteria: E. coli'
                    WHEN source_id % 5 = 2 THEN 'Clean Bacteria: Giardia Lamblia'
                    ELSE 'Bacteria: Cholera' END AS description,
               CASE WHEN source_id % 5 < 4 THEN 'Clean'
                    WHEN source_id % 2 = 0 THEN 'Contaminated: Chemical'
                    ELSE 'Contaminated: Biological' END AS results,
               CASE WHEN source_id % 5 = 0 THEN CAST(0 AS DOUBLE)
                    ELSE CAST(source_id % 7 + 1 AS DOUBLE) / CAST(100 AS DOUBLE) END AS biological
        FROM water_source WHERE type_of_water_source = 'well'"""),
    "visits": ((), """
        SELECT event_id AS record_id, user_id AS location_id, event_id % (SELECT count(*) FROM part) AS source_id,
               ts AS time_of_record,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS visit_count,
               CAST(floor(value) AS INTEGER) AS time_in_queue,
               event_id % (SELECT count(*) FROM supplier) AS assigned_employee_id
        FROM events"""),
    "water_quality": (("visits",), """
        SELECT record_id, visit_count,
               CAST(CASE WHEN assigned_employee_id IN (3, 7) OR (record_id * 19) % 100 < 15
                         THEN (location_id + 3) % 10 + 1 ELSE location_id % 10 + 1 END AS INTEGER)
                   AS subjective_quality_score
        FROM visits"""),
    "auditor_report": (("visits", "water_source"), """
        SELECT c.c_custkey AS location_id, fv.type_of_water_source,
               CAST(c.c_custkey % 10 + 1 AS INTEGER) AS true_water_source_score,
               CASE WHEN c.c_custkey % 3 = 0 THEN 'Villagers mentioned Cash exchange'
                    ELSE 'No concerns' END AS statements
        FROM customer c
        LEFT JOIN (SELECT v.location_id, ws.type_of_water_source
                   FROM visits v JOIN water_source ws ON v.source_id = ws.source_id
                   WHERE v.visit_count = 1) fv ON fv.location_id = c.c_custkey
        WHERE c.c_custkey % 4 <> 0"""),
    "global_water_access": ((), """
        SELECT n_name AS name, CAST(n_nationkey + 1 AS DOUBLE) * 0.5 AS pop_n
        FROM nation, (VALUES (1), (2)) copies(k)"""),
}

_ORDER = ["location", "employee", "water_source", "well_pollution", "visits",
          "water_quality", "auditor_report", "global_water_access"]


def _needed(names: set[str]) -> list[str]:
    todo = set(names)
    changed = True
    while changed:
        changed = False
        for n in list(todo):
            for dep in ROLE_SQL[n][0]:
                if dep not in todo:
                    todo.add(dep)
                    changed = True
    return [n for n in _ORDER if n in todo]


def roles_used(sql: str) -> set[str]:
    return {n for n in ROLE_SQL if re.search(rf"\b{n}\b", sql)}


def with_roles(sql: str, extra_ctes: str = "") -> str:
    """Prefix ``sql`` with the role-table CTEs it mentions (and their dependencies).

    ``sql`` may start with its own ``WITH``; its CTEs are appended after the roles.
    """
    body = sql.strip()
    needed = _needed(roles_used(body + extra_ctes))
    ctes = [f"{n} AS ({ROLE_SQL[n][1]}\n)" for n in needed]
    if extra_ctes:
        ctes.append(extra_ctes.strip())
    if body[:4].upper() == "WITH":
        rest = body[4:].lstrip()
        return "WITH " + ",\n".join(ctes + [rest]) if ctes else body
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
