"""DuckDB SQL with the same results as the queries of the same name."""

from __future__ import annotations

# The same periods, entity and category as in the queries.
YEAR_A, YEAR_B = 1996, 1997
ENTITY, CODE = "NATION_3", "Brand#12"


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- the five tables ------------------------------------------------------------------------------------------------


def _cube(where: str = "TRUE") -> str:
    return f"""cube AS (
  SELECT o.n_name AS origin, d.n_name AS destination, p_brand AS code, year(l_shipdate) AS period,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation o ON o.n_nationkey = s_nationkey JOIN nation d ON d.n_nationkey = c_nationkey
  WHERE {where} GROUP BY ALL)"""


_DIMS = (
    "ent AS (SELECT DISTINCT n_name AS entity FROM nation)",
    "cat AS (SELECT p_brand AS code, min(p_type) AS description FROM part GROUP BY 1)",
)


def _tables(source: str = "cube", suffix: str = "") -> tuple[str, ...]:
    """Long tables with NULL for cells without data."""

    def cells(name: str, entity: str, condition: str) -> str:
        return f"""{name}{suffix} AS (
  SELECT c.code, c.description, e.entity, s.value FROM cat c CROSS JOIN ent e LEFT JOIN (
    SELECT code, {entity} AS entity, sum(value) AS value FROM {source} WHERE {condition} GROUP BY 1, 2
  ) s ON s.code = c.code AND s.entity = e.entity)"""

    return (
        f"""matrix{suffix} AS (
  SELECT o.entity AS origin, d.entity AS destination, s.value FROM ent o CROSS JOIN ent d LEFT JOIN (
    SELECT origin, destination, sum(value) AS value FROM {source} GROUP BY 1, 2
  ) s ON s.origin = o.entity AND s.destination = d.entity)""",
        f"""summary{suffix} AS (
  SELECT c.code, c.description, s.value FROM cat c LEFT JOIN (
    SELECT code, sum(value) AS value FROM {source} GROUP BY 1) s ON s.code = c.code)""",
        cells("outward", "origin", "origin <> destination"),
        cells("inward", "destination", "origin <> destination"),
        cells("internal", "origin", "origin = destination"),
    )


ALL = (_cube(), *_DIMS, *_tables())
BOTH = (
    _cube(f"year(l_shipdate) IN ({YEAR_A}, {YEAR_B})"),
    f"cube_a AS (SELECT * FROM cube WHERE period = {YEAR_A})",
    f"cube_b AS (SELECT * FROM cube WHERE period = {YEAR_B})",
    *_DIMS,
    *_tables("cube_a", "_a"),
    *_tables("cube_b", "_b"),
)

REPORTED = """reported AS (
  SELECT 'summary' AS table_name, 'GRAND' AS axis, 'GRAND' AS entity, coalesce(sum(value), 0) AS value FROM summary
  UNION ALL SELECT 'outward', 'COLUMN', entity, coalesce(sum(value), 0) FROM outward GROUP BY entity
  UNION ALL SELECT 'inward', 'COLUMN', entity, coalesce(sum(value), 0) FROM inward GROUP BY entity
  UNION ALL SELECT 'inward', 'ROW', code, coalesce(sum(value), 0) FROM inward GROUP BY code
  UNION ALL SELECT 'inward', 'GRAND', 'GRAND', coalesce(sum(value), 0) FROM inward
  UNION ALL SELECT 'internal', 'COLUMN', entity, coalesce(sum(value), 0) FROM internal GROUP BY entity
  UNION ALL SELECT 'internal', 'ROW', code, coalesce(sum(value), 0) FROM internal GROUP BY code
  UNION ALL SELECT 'internal', 'GRAND', 'GRAND', coalesce(sum(value), 0) FROM internal)"""


def _r(expression: str, name: str | None = None, digits: int = 2) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits}) AS {name or expression}"


# --- reconciliation -------------------------------------------------------------------------------------------------

NATIONAL = """national AS (SELECT
  (SELECT coalesce(sum(value), 0) FROM matrix) AS m, (SELECT coalesce(sum(value), 0) FROM summary) AS s,
  (SELECT coalesce(sum(value), 0) FROM outward) AS o, (SELECT coalesce(sum(value), 0) FROM inward) AS i,
  (SELECT coalesce(sum(value), 0) FROM internal) AS t,
  (SELECT coalesce(sum(value), 0) FROM matrix WHERE origin = destination) AS d)"""

MARGINS = """margins AS (SELECT e.entity,
  (SELECT coalesce(sum(value), 0) FROM matrix x WHERE x.origin = e.entity) AS origin_total,
  (SELECT coalesce(sum(value), 0) FROM matrix x WHERE x.destination = e.entity) AS destination_total,
  (SELECT coalesce(sum(value), 0) FROM matrix x WHERE x.origin = e.entity AND x.destination = e.entity) AS diagonal,
  (SELECT count(value) FROM matrix x WHERE x.origin = e.entity AND x.destination = e.entity) AS filled,
  (SELECT coalesce(sum(value), 0) FROM outward x WHERE x.entity = e.entity) AS outward,
  (SELECT coalesce(sum(value), 0) FROM inward x WHERE x.entity = e.entity) AS inward,
  (SELECT coalesce(sum(value), 0) FROM internal x WHERE x.entity = e.entity) AS internal
  FROM ent e)"""

_CASES = {
    "do01": "SELECT 'REC-DO01' AS rule_code, 'NATIONAL' AS dimension, 'NATIONAL' AS entity, s AS e, m AS o FROM national",
    "do02": "SELECT 'REC-DO02' AS rule_code, 'OUTWARD_INWARD_TOTAL' AS dimension, 'NATIONAL' AS entity, i AS e, o AS o FROM national",
    "do03": """SELECT 'REC-DO03' AS rule_code, 'OUTWARD_INTERNAL_PARTITION' AS dimension, 'NATIONAL' AS entity, s AS e, o + t AS o FROM national
  UNION ALL SELECT 'REC-DO03', 'INWARD_INTERNAL_PARTITION', 'NATIONAL', s, i + t FROM national""",
    "do04": "SELECT 'REC-DO04' AS rule_code, 'ORIGIN_MARGINAL' AS dimension, entity, outward + internal AS e, origin_total AS o FROM margins",
    "do05": "SELECT 'REC-DO05' AS rule_code, 'DESTINATION_MARGINAL' AS dimension, entity, inward + internal AS e, destination_total AS o FROM margins",
    "do06": "SELECT 'REC-DO06' AS rule_code, 'DIAGONAL_VS_INTERNAL' AS dimension, entity, internal AS e, diagonal AS o FROM margins",
    "do06_moved": """SELECT 'REC-DO06' AS rule_code, 'DIAGONAL_VS_INTERNAL' AS dimension, entity, internal AS e,
    diagonal + CASE WHEN entity IN ('NATION_3', 'NATION_5') THEN 1000000 * filled ELSE 0 END AS o FROM margins""",
}


def _reconciled(*names: str, source: tuple[str, ...] = ALL) -> str:
    cases = "\n  UNION ALL ".join(_CASES[n] for n in names)
    return _with(
        *source,
        NATIONAL,
        MARGINS,
        f"cases AS ({cases})",
        "sized AS (SELECT rule_code, dimension, entity, CAST(e AS DOUBLE) AS e, CAST(o AS DOUBLE) AS o FROM cases)",
        """judged AS (SELECT *, abs(o - e) AS gap, abs(o - e) / nullif(abs(e), 0) AS rel,
          coalesce(abs(o - e) <= 1e-4, FALSE) OR coalesce(abs(o - e) / nullif(abs(e), 0) <= 1e-7, FALSE) AS ok FROM sized)""",
        body=f"""SELECT rule_code, dimension, entity, {_r('e', 'expected_value')}, {_r('o', 'observed_value')},
  {_r('gap', 'absolute_difference')}, {_r('rel', 'relative_difference', 9)},
  CASE WHEN ok THEN 'PASS' WHEN rule_code = 'REC-DO06' AND entity = '{ENTITY}' THEN 'UNRESOLVED' ELSE 'WARNING' END AS status,
  CASE WHEN ok THEN 'INFO' ELSE 'WARNING' END AS severity FROM judged""",
    )


# --- check rows -----------------------------------------------------------------------------------------------------


def _check(check_id: str, table: str, bad: str, severity: str, expected: str, observed: str, source: str = "", status: str = "FAIL") -> str:
    """One check row; ``bad`` counts what is wrong, ``expected`` and ``observed`` are SQL text."""
    return f"""SELECT {check_id} AS check_id, {table} AS table_name,
  CASE WHEN {bad} = 0 THEN 'PASS' ELSE '{status}' END AS status,
  CASE WHEN {bad} = 0 THEN 'INFO' ELSE '{severity}' END AS severity,
  CAST({expected} AS VARCHAR) AS expected, CAST({observed} AS VARCHAR) AS observed,
  CAST({bad} AS DOUBLE) AS difference, CAST({bad} AS BIGINT) AS affected_records {source}"""


def _number_checks(number: int, table: str, key: str, value: str, relation: str, nulls: int | None, code: str | None = None,
                   pattern: str = "", text: bool = False) -> str:
    """UNQ, DOM-03, NUM-01..03 and NUM-05 of one relation."""
    parsed = f"CASE WHEN regexp_full_match({value}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') THEN TRY_CAST({value} AS DOUBLE) END" if text else value
    counts = f"""(SELECT count(*) AS n, count(*) FILTER ({value} IS NOT NULL AND ({parsed}) IS NULL) AS non,
      count(*) FILTER (({parsed}) < 0) AS neg, count(*) FILTER ({value} IS NULL) AS nul,
      {f"count(*) FILTER (NOT coalesce(regexp_matches({code}, '{pattern}'), FALSE))" if code else '0'} AS bad,
      (SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM {relation} GROUP BY {key}) WHERE c > 1) AS dup
      FROM {relation}) x"""
    source = f"FROM {counts}"
    rows = [
        _check(f"'UNQ-{number:02d}'", f"'{table}'", "dup", "CRITICAL", "'0 duplicates'", "CAST(dup AS BIGINT) || ' duplicates'", source),
        _check(f"'NUM-01-{table}'", f"'{table}'", "non", "ERROR", "'number or NULL'", "non || ' non-numeric'", source),
        _check(f"'NUM-02-{table}'", f"'{table}'", "neg", "ERROR", "'>= 0'", "neg || ' negative'", source),
        _check(f"'NUM-03-{table}'", f"'{table}'", "0", "CRITICAL", "'0 infinite'", "'0 infinite'", source),
    ]
    if code:
        rows.append(_check(f"'DOM-03-{table}'", f"'{table}'", "bad", "ERROR", f"'{pattern}'", "bad || ' invalid'", source))
    if nulls is not None:
        rows.append(
            _check(f"'NUM-05-{table}'", f"'{table}'", f"abs(nul - {nulls})", "WARNING", f"'{nulls} NULLs'", "nul || ' NULLs'", source, "WARNING")
        )
    return "\nUNION ALL ".join(rows)


def _negative_message(table: str, value: str, relation: str) -> str:
    return f"""SELECT 'NUM-02-{table}' AS check_id, CASE WHEN n = 0 THEN 'No value is negative.'
    ELSE n || ' values are negative, lowest ' || low || '.' END AS message
  FROM (SELECT count(*) FILTER ({value} < 0) AS n, CAST(min(CAST({value} AS DECIMAL(18,2))) FILTER ({value} < 0) AS VARCHAR) AS low FROM {relation})"""


_PART_DOM = ("part", "p_partkey, p_brand", "p_retailprice", "part", 0, "p_brand", "^Brand#[0-9]$")
SOURCE_CHECKS = "\nUNION ALL ".join(
    [
        _number_checks(1, "lineitem", "l_orderkey, l_linenumber", "l_extendedprice", "lineitem", 0),
        _number_checks(2, "orders", "o_orderkey", "o_totalprice", "orders", 0),
        _number_checks(3, "events", "event_id", "value", "events", 0),
        _number_checks(4, "customer", "c_custkey", "c_acctbal", "customer", 0),
        _number_checks(5, "supplier", "s_suppkey", "s_acctbal", "supplier", 3),
        _number_checks(6, *_PART_DOM),
    ]
)
TEXT_CHECKS = "\nUNION ALL ".join(
    [
        _number_checks(1, "events_props", "event_id", "value", "(SELECT event_id, json_extract_string(props, '$.k') AS value FROM events)", None, text=True),
        _number_checks(2, "orders_priority", "o_orderkey", "value", "(SELECT o_orderkey, o_orderpriority AS value FROM orders)", None, text=True),
        _number_checks(3, "customer_staged", "c_custkey", "value",
                       "(SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS value FROM customer)", None, text=True),
    ]
)

_NULLS = {"matrix": 0, "summary": 0, "outward": 5, "inward": 0, "internal": 100}
NULL_AUDIT = _with(
    *ALL,
    body="\nUNION ALL ".join(
        _check(f"'NUM-05-{t}'", f"'{t}'", f"abs(n - {k})", "WARNING", f"'{k} NULLs'", "n || ' NULLs'",
               f"FROM (SELECT count(*) FILTER (value IS NULL) AS n FROM {t}) x", "WARNING")
        for t, k in _NULLS.items()
    ),
)

_SIZES = "(SELECT count(*) FROM ent)", "(SELECT count(*) FROM cat)"
_EXPECTED = {
    "matrix": f"{_SIZES[0]} * {_SIZES[0]}",
    "summary": _SIZES[1],
    "outward": f"{_SIZES[1]} * {_SIZES[0]}",
    "inward": f"{_SIZES[1]} * {_SIZES[0]}",
    "internal": f"{_SIZES[1]} * {_SIZES[0]}",
}


def _count_check(number: int, table: str, relation: str) -> str:
    return _check(f"'CMP-{number:02d}'", f"'{table}'", "abs(n - e)", "CRITICAL", "e", "n",
                  f"FROM (SELECT count(*) AS n, {_EXPECTED[table]} AS e FROM {relation}) x")


COUNT_CHECKS = _with(
    *ALL,
    body="\nUNION ALL ".join(
        [
            *[_count_check(n, t, t) for n, t in enumerate(_EXPECTED, 1)],
            _count_check(9, "internal", "(SELECT * FROM internal WHERE value IS NOT NULL)"),
        ]
    ),
)


def _label_set(check_id: str, table: str, observed: str, domain: str, symmetric: bool, severity: str) -> str:
    extra = f"(SELECT count(*) FROM (SELECT DISTINCT l FROM ({observed}) WHERE l IS NULL OR l NOT IN (SELECT l FROM ({domain}))))" if symmetric else "0"
    absent = f"(SELECT count(*) FROM ({domain}) WHERE l NOT IN (SELECT l FROM ({observed}) WHERE l IS NOT NULL))"
    return _check(f"'{check_id}'", f"'{table}'", "(a + x)", severity, "n || ' labels'", "a || ' missing, ' || x || ' unexpected'",
                  f"FROM (SELECT {absent} AS a, {extra} AS x, (SELECT count(*) FROM ({domain})) AS n) q")


def _membership(table: str, observed: str, domain: str) -> str:
    row = _check(f"'DOM-01-{table}'", f"'{table}'", "n", "ERROR", "'subset of the domain'", "n || ' invalid labels'", "")
    return f"""{row}, CASE WHEN n = 0 THEN 'All labels belong to the domain.' ELSE 'Invalid labels: ' || array_to_string(ls[:3], ', ') || '.' END AS message
  FROM (SELECT count(*) AS n, list(l ORDER BY l) AS ls
    FROM (SELECT DISTINCT coalesce(l, 'NULL') AS l FROM ({observed}) WHERE l IS NULL OR l NOT IN ({domain}))) q"""


def _preserved(table: str, kept: str, corrected: str) -> str:
    return _check("'DOM-02'", f"'{table}'", "(CASE WHEN a AND NOT b THEN 0 ELSE 1 END)", "ERROR", f"'{kept}'",
                  f"CASE WHEN b THEN '{corrected}' WHEN a THEN '{kept}' ELSE 'neither' END",
                  f"FROM (SELECT bool_or(event_type = '{kept}') AS a, bool_or(event_type = '{corrected}') AS b FROM events) q")


_LABELS = "SELECT origin AS l FROM cube UNION ALL SELECT destination FROM cube"
_SHORT = ", ".join(f"'NATION_{i}'" for i in range(20))


def _conservation(table: str, rows: str, name: str) -> str:
    height = "(SELECT count(*) FROM ent)" if table == "matrix" else "(SELECT count(*) FROM cat)"
    return _check("'STR-01'", f"'{name}'", "abs(c - n)", "CRITICAL", "c", "n",
                  f"FROM (SELECT {height} * (SELECT count(*) FROM ent) AS c, (SELECT count(*) FROM {rows}) AS n) q")


def _summary_present(table: str) -> str:
    return _check(f"'STR-02-{table}'", f"'{table}'", "(CASE WHEN n > 0 THEN 0 ELSE 1 END)", "ERROR", "'grand total'", "n || ' found'",
                  f"FROM (SELECT count(*) FILTER (table_name = '{table}' AND axis = 'GRAND' AND value IS NOT NULL) AS n FROM reported) q")


def _schema_row(check_id: str, table: str, bad: int, severity: str, expected: str, observed: str, status: str = "FAIL", affected: int | None = None) -> str:
    ok = bad == 0
    difference = "CAST(NULL AS DOUBLE)" if bad < 0 else f"CAST({bad} AS DOUBLE)"
    seen = "CAST(NULL AS VARCHAR)" if observed is None else f"'{observed}'"
    return f"""SELECT '{check_id}' AS check_id, '{table}' AS table_name, '{'PASS' if ok else status}' AS status,
  '{'INFO' if ok else severity}' AS severity, '{expected}' AS expected, {seen} AS observed, {difference} AS difference,
  CAST({max(bad, 0)} AS BIGINT) AS affected_records"""


_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
SCHEMA_CHECKS = "\nUNION ALL ".join(
    [
        _schema_row("SCH-01", "source", 1, "CRITICAL", "nation, region, customer, orders, invoices", "customer, nation, orders, region"),
        _schema_row("SCH-02-nation", "nation", 0, "", "n_nationkey, n_name, n_regionkey", "n_nationkey, n_name, n_regionkey"),
        _schema_row("SCH-03-nation", "nation", 0, "", "", ""),
        _schema_row("SCH-02-region", "region", 0, "", "r_regionkey, r_name", "r_regionkey, r_name"),
        _schema_row("SCH-03-region", "region", 0, "", "", ""),
        _schema_row("SCH-02-customer", "customer", 1, "CRITICAL", "c_custkey, c_name, c_nationkey, c_phone",
                    "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"),
        _schema_row("SCH-03-customer", "customer", 2, "WARNING", "", "c_acctbal, c_mktsegment", "WARNING"),
        _schema_row("SCH-02-orders", "orders", 0, "", _ORDER_COLS, _ORDER_COLS),
        _schema_row("SCH-03-orders", "orders", 0, "", "", ""),
        _schema_row("SCH-02-invoices", "invoices", -1, "CRITICAL", "i_key", None),
        _check("'SCH-04-nation'", "'nation'", "n", "ERROR", "'string'", "'int'", "FROM (SELECT count(n_nationkey) AS n FROM nation) q"),
        _check("'SCH-04-customer'", "'customer'", "n", "ERROR", "'string'", "'bigint'", "FROM (SELECT count(c_custkey) AS n FROM customer) q"),
        _check("'SCH-04-region'", "'region'", "n", "ERROR", "'string'", "'string'", "FROM (SELECT count(*) * 0 AS n FROM region) q"),
        _check("'SCH-04-orders'", "'orders'", "n", "ERROR", "'string'", "'string'", "FROM (SELECT count(*) * 0 AS n FROM orders) q"),
    ]
)

# --- totals ---------------------------------------------------------------------------------------------------------


def _printed() -> str:
    """Totals as a publisher prints them: straight from the movements, without the cells of any table."""
    total = "coalesce(sum(value), 0)"

    def by(table: str, axis: str, dimension: str, label: str, key: str, condition: str) -> str:
        return f"""SELECT '{table}' AS table_name, '{axis}' AS axis, d.{label} AS entity, coalesce(s.v, 0) AS value FROM {dimension} d
    LEFT JOIN (SELECT {key} AS k, sum(value) AS v FROM cube WHERE {condition} GROUP BY 1) s ON s.k = d.{label}"""

    def grand(table: str, condition: str = "TRUE") -> str:
        return f"SELECT '{table}', 'GRAND', 'GRAND', {total} FROM cube WHERE {condition}"

    away, home = "origin <> destination", "origin = destination"
    parts = [
        by("outward", "COLUMN", "ent", "entity", "origin", away), grand("summary"),
        by("inward", "COLUMN", "ent", "entity", "destination", away), by("inward", "ROW", "cat", "code", "code", away), grand("inward", away),
        by("internal", "COLUMN", "ent", "entity", "origin", home), by("internal", "ROW", "cat", "code", "code", home), grand("internal", home),
    ]
    return "printed AS (" + "\n  UNION ALL ".join(parts) + ")"


# Two printed totals are off: one entity's outward total and the corner of the inward table.
_ALTERED = f"""altered AS (SELECT table_name, axis, entity, value
    + CASE WHEN table_name = 'outward' AND axis = 'COLUMN' AND entity = '{ENTITY}' THEN 500 WHEN table_name = 'inward' AND axis = 'GRAND' THEN 7 ELSE 0 END AS value
  FROM printed)"""
COMPUTED = """computed AS (
  SELECT 'summary' AS table_name, 'GRAND' AS axis, 'GRAND' AS entity, coalesce(sum(value), 0) AS value FROM summary
  UNION ALL SELECT 'outward', 'COLUMN', entity, coalesce(sum(value), 0) FROM outward GROUP BY entity
  UNION ALL SELECT 'inward', 'COLUMN', entity, coalesce(sum(value), 0) FROM inward GROUP BY entity
  UNION ALL SELECT 'inward', 'ROW', code, coalesce(sum(value), 0) FROM inward GROUP BY code
  UNION ALL SELECT 'internal', 'COLUMN', entity, coalesce(sum(value), 0) FROM internal GROUP BY entity
  UNION ALL SELECT 'internal', 'ROW', code, coalesce(sum(value), 0) FROM internal GROUP BY code)"""


def _met(source: str = "printed") -> tuple[str, ...]:
    """Both sides of every checked total, and every cross-foot, of printed or altered totals."""
    return (
        _printed(),
        _ALTERED,
        COMPUTED,
        f"""met AS (SELECT table_name, axis, entity, coalesce(c.value, 0) AS computed, r.value AS reported, abs(coalesce(c.value, 0) - r.value) AS gap,
    coalesce(abs(coalesce(c.value, 0) - r.value) <= 1e-4, FALSE) AS within
  FROM computed c FULL JOIN (SELECT * FROM {source} r WHERE EXISTS (SELECT 1 FROM computed x WHERE x.table_name = r.table_name AND x.axis = r.axis)) r
    USING (table_name, axis, entity))""",
        f"""feet AS (SELECT table_name, r.axis, sum(r.value) AS summed, max(g.value) AS grand, abs(sum(r.value) - max(g.value)) AS gap,
    coalesce(abs(sum(r.value) - max(g.value)) <= 1e-4, FALSE) AS within
  FROM {source} r JOIN {source} g USING (table_name) WHERE g.axis = 'GRAND' AND r.axis <> 'GRAND' GROUP BY 1, 2)""",
    )


def _differences(axis: str) -> str:
    return _with(
        *ALL,
        *_met(),
        body=f"""SELECT table_name, axis, entity, {_r('computed')}, {_r('reported')}, {_r('gap', 'difference')}, within FROM met WHERE axis = '{axis}'""",
    )


_TOTAL_IDS = """ids AS (SELECT * FROM (VALUES ('summary', 'GRAND', 'REC-V01'), ('outward', 'COLUMN', 'REC-V02'), ('inward', 'COLUMN', 'REC-V03'),
   ('inward', 'ROW', 'REC-V04'), ('internal', 'COLUMN', 'REC-V06'), ('internal', 'ROW', 'REC-V07')) t(table_name, axis, check_id))"""
TOTAL_ROWS = """total_rows AS (
  SELECT check_id, table_name, count(*) FILTER (NOT within) AS bad, CAST(max(gap) AS DOUBLE) AS worst FROM met JOIN ids USING (table_name, axis) GROUP BY 1, 2
  UNION ALL SELECT CASE table_name WHEN 'inward' THEN 'REC-V05-' ELSE 'REC-V08-' END || axis, table_name, CASE WHEN within THEN 0 ELSE 1 END,
    CAST(gap AS DOUBLE) FROM feet)"""
_TOTAL_STATUS = """CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CASE WHEN bad = 0 THEN 'INFO' ELSE 'CRITICAL' END AS severity"""


def _total_checks(source: str) -> str:
    return _with(
        *ALL,
        *_met(source),
        _TOTAL_IDS,
        TOTAL_ROWS,
        body=f"""SELECT check_id, table_name, {_TOTAL_STATUS}, 'totals' AS expected, 'sums' AS observed, round(worst, 4) AS difference,
  CAST(bad AS BIGINT) AS affected_records FROM total_rows""",
    )


TOTAL_CHECKS = _total_checks("printed")


def _cross_foot(source: str) -> str:
    return _with(
        *ALL,
        *_met(source),
        body=f"SELECT table_name, axis, {_r('summed')}, {_r('grand')}, {_r('gap', 'difference')}, within FROM feet",
    )


CROSS_FOOT = _cross_foot("printed")

_ORDER_DIFF = """diff AS (
  SELECT CAST(coalesce(o_orderkey, k) AS VARCHAR) AS entity, coalesce(s, 0) AS computed, CAST(o_totalprice AS DECIMAL(18,2)) AS reported
  FROM orders FULL JOIN (SELECT l_orderkey AS k, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY 1) ON o_orderkey = k)"""
ORDER_TOTALS = _with(
    _ORDER_DIFF,
    body=f"""SELECT entity, {_r('computed')}, {_r('reported')}, {_r('abs(computed - reported)', 'difference')},
  coalesce(abs(computed - reported) <= 1e-4, FALSE) AS within FROM diff""",
)
ORDER_TOTAL_CHECK = _with(
    _ORDER_DIFF,
    """m AS (SELECT count(*) AS n, count(*) FILTER (NOT coalesce(abs(computed - reported) <= 1e-4, FALSE)) AS bad,
      max(abs(computed - reported)) AS worst FROM diff)""",
    body=f"""SELECT 'REC-ORD' AS check_id, 'orders' AS table_name, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  CASE WHEN bad = 0 THEN 'INFO' ELSE 'CRITICAL' END AS severity, 'sums match published totals' AS expected,
  bad || ' of ' || n || ' totals differ' AS observed, {_r('worst', 'difference', 4)}, CAST(bad AS BIGINT) AS affected_records FROM m""",
)

# --- snapshot statistics --------------------------------------------------------------------------------------------

_KINDS = ("outward", "inward", "internal")
PAIRS = (
    "pairs AS ("
    + "\n  UNION ALL ".join(
        [
            "SELECT 'CATEGORY_NATIONAL' AS dimension, a.code, CAST(NULL AS VARCHAR) AS entity, a.value AS reference, b.value AS comparison FROM summary_a a JOIN summary_b b USING (code)",
            *[
                f"SELECT 'CATEGORY_ENTITY_{k.upper()}', a.code, a.entity, a.value, b.value FROM {k}_a a JOIN {k}_b b USING (code, entity)"
                for k in _KINDS
            ],
            *[
                f"SELECT 'ENTITY_{k.upper()}', NULL, a.entity, sum(a.value), sum(b.value) FROM {k}_a a JOIN {k}_b b USING (code, entity) GROUP BY a.entity"
                for k in _KINDS
            ],
        ]
    )
    + ")"
)
PAIR_SAMPLES = """samples AS (
  SELECT dimension, 'ref' AS side, CAST(reference AS DOUBLE) AS value FROM pairs WHERE reference IS NOT NULL
  UNION ALL SELECT dimension, 'comp', CAST(comparison AS DOUBLE) FROM pairs WHERE comparison IS NOT NULL)"""
LINE_SAMPLES = f"""samples AS (
  SELECT l_returnflag AS dimension, CASE WHEN year(l_shipdate) = {YEAR_A} THEN 'ref' ELSE 'comp' END AS side, l_extendedprice AS value
  FROM lineitem WHERE year(l_shipdate) IN ({YEAR_A}, {YEAR_B}) AND l_extendedprice IS NOT NULL)"""

KS_CTES = (
    """counts AS (SELECT dimension, value, count(*) FILTER (side = 'ref') AS r, count(*) FILTER (side = 'comp') AS c FROM samples GROUP BY 1, 2)""",
    """running AS (SELECT dimension, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER t AS nr, sum(c) OVER t AS nc FROM counts
      WINDOW w AS (PARTITION BY dimension ORDER BY value), t AS (PARTITION BY dimension))""",
    """ks AS (SELECT dimension, CAST(max(nr) AS BIGINT) AS n, CAST(max(nc) AS BIGINT) AS m,
      max(abs(CAST(cr AS DOUBLE) / nullif(nr, 0) - CAST(cc AS DOUBLE) / nullif(nc, 0))) AS d FROM running GROUP BY 1)""",
)
SERIES = (
    "eff AS (SELECT *, round_even(CAST(n AS DOUBLE) * m / (n + m), 0) AS en, least(n, m) >= 5 AS enough FROM ks)",
    "arg AS (SELECT *, sqrt(en) * d + 1.0 / (6.0 * sqrt(en)) + (sqrt(en) * d - 1.0) / (4.0 * en) AS x FROM eff)",
    """tested AS (SELECT *, CASE WHEN NOT enough THEN NULL WHEN d <= 0 OR x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
      2.0 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * x * x))))) END AS p FROM arg)""",
)
# Share of the lattice paths that stay inside the bound, step by step.
EXACT = (
    "sized AS (SELECT *, least(n, m) >= 5 AS enough, CAST(round(d * n * m) AS BIGINT) AS bound FROM ks)",
    """walk(dimension, t, i, mass) AS (
      SELECT dimension, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS DOUBLE) FROM sized WHERE enough AND bound > 0
      UNION ALL
      SELECT w.dimension, w.t + 1, w.i + s.step, sum(w.mass * CASE WHEN s.step = 1 THEN n - w.i ELSE m - (w.t - w.i) END / (n + m - w.t))
      FROM walk w JOIN sized z ON z.dimension = w.dimension, (VALUES (CAST(0 AS BIGINT)), (CAST(1 AS BIGINT))) s(step)
      WHERE w.t < n + m AND w.i + s.step <= n AND w.t + 1 - w.i - s.step <= m AND abs((w.i + s.step) * m - (w.t + 1 - w.i - s.step) * n) < bound
      GROUP BY w.dimension, w.t, w.i + s.step)""",
    "stayed AS (SELECT w.dimension, sum(mass) AS mass FROM walk w JOIN sized z ON z.dimension = w.dimension AND w.t = n + m GROUP BY 1)",
    """tested AS (SELECT z.*, CASE WHEN NOT enough THEN NULL WHEN bound <= 0 THEN 1.0 ELSE least(1.0, greatest(0.0, 1.0 - coalesce(mass, 0.0))) END AS p
      FROM sized z LEFT JOIN stayed y ON y.dimension = z.dimension)""",
)
_KS_STATUS = """CASE WHEN NOT enough THEN 'INSUFFICIENT_DATA' WHEN p < 0.05 THEN 'STATISTICALLY_DIFFERENT'
  ELSE 'NO_MATERIAL_STATISTICAL_CHANGE' END"""
_KS_SELECT = f"""SELECT dimension, n AS n_reference, m AS n_comparison, {_r('CASE WHEN enough THEN d END', 'statistic', 9)},
  {_r('p', 'p_value', 6)}, {_KS_STATUS} AS status FROM tested"""


def _edges(bins: str) -> tuple[str, ...]:
    """Quantile edges of the reference values by linear interpolation."""
    return (
        "refs AS (SELECT dimension, list_sort(list(value)) AS v, count(*) AS n FROM samples WHERE side = 'ref' GROUP BY 1)",
        f"""pos AS (SELECT dimension, v, unnest(list_transform(CASE WHEN {bins} = 5 THEN [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]::DOUBLE[]
      ELSE [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]::DOUBLE[] END, lambda q: (n - 1) * q)) AS p FROM refs)""",
        """near AS (SELECT dimension, v[CAST(floor(p) AS BIGINT) + 1] AS lo, v[CAST(ceil(p) AS BIGINT) + 1] AS hi, p - floor(p) AS g FROM pos)""",
        """edges AS (SELECT dimension, list_sort(list_distinct(list(CASE WHEN g >= 0.5 THEN hi - (hi - lo) * (1.0 - g) ELSE lo + (hi - lo) * g END))) AS e
      FROM near GROUP BY 1)""",
    )


PSI_CTES = (
    """wide AS (SELECT dimension, list_transform(e, lambda x, i: CASE WHEN i = 1 THEN x - 1e-6 WHEN i = len(e) THEN x + 1e-6 ELSE x END) AS e
      FROM edges WHERE len(e) >= 2)""",
    """bins AS (SELECT dimension, i, e[i] AS lo, e[i + 1] AS hi, i = len(e) - 1 AS is_last FROM wide, unnest(range(1, len(e))) t(i))""",
    """hist AS (SELECT b.dimension, b.i, count(*) FILTER (s.side = 'ref') + 1e-4 AS x, count(*) FILTER (s.side = 'comp') + 1e-4 AS a
      FROM bins b LEFT JOIN samples s ON s.dimension = b.dimension AND s.value >= b.lo AND (s.value < b.hi OR (b.is_last AND s.value <= b.hi))
      GROUP BY 1, 2)""",
    "shares AS (SELECT dimension, x / sum(x) OVER (PARTITION BY dimension) AS x, a / sum(a) OVER (PARTITION BY dimension) AS a FROM hist)",
    "psi AS (SELECT dimension, sum((a - x) * ln(a / x)) AS psi FROM shares GROUP BY 1)",
    """psi_rows AS (SELECT s.dimension, s.n, s.m, least(s.n, s.m) >= 5 AS enough, p.psi
      FROM (SELECT dimension, count(*) FILTER (side = 'ref') AS n, count(*) FILTER (side = 'comp') AS m FROM samples GROUP BY 1) s
      LEFT JOIN psi p ON p.dimension = s.dimension)""",
)
_PSI_STATUS = """CASE WHEN NOT enough OR psi IS NULL THEN 'INSUFFICIENT_DATA' WHEN psi >= 0.10 THEN 'STATISTICALLY_DIFFERENT'
  ELSE 'NO_MATERIAL_STATISTICAL_CHANGE' END"""
_PSI_SELECT = f"""SELECT dimension, n AS n_reference, m AS n_comparison, {_r('CASE WHEN enough THEN coalesce(psi, 0.0) END', 'psi_value', 6)},
  CAST(0.25 AS DOUBLE) AS psi_threshold, {_PSI_STATUS} AS status FROM psi_rows"""
_SUITE_BINS = "(CASE WHEN starts_with(dimension, 'ENTITY_') THEN 5 ELSE 10 END)"
_BINS = "10"

YOY = """yoy AS (SELECT dimension || '_YOY' AS dimension, coalesce(entity, code) AS metric, CAST(comparison AS DOUBLE) - CAST(reference AS DOUBLE) AS chg,
    (CAST(comparison AS DOUBLE) - CAST(reference AS DOUBLE)) / nullif(CAST(reference AS DOUBLE), 0) * 100.0 AS pct
  FROM pairs WHERE NOT starts_with(dimension, 'CATEGORY_ENTITY_'))"""
_YOY_STATUS = """CASE WHEN pct IS NULL THEN 'NOT_APPLICABLE' WHEN abs(pct) <= 25.0 THEN 'NO_MATERIAL_STATISTICAL_CHANGE'
  ELSE 'STATISTICALLY_DIFFERENT' END"""


def _yoy(condition: str) -> str:
    return _with(*BOTH, PAIRS, YOY, body=f"""SELECT dimension, metric, {_r('chg', 'statistic')}, {_r('pct', 'pct_change', 6)},
  {_YOY_STATUS} AS status FROM yoy WHERE {condition}""")  # fmt: skip


AUDIT_CTE = f"""audit AS (SELECT
  (SELECT coalesce(sum(value), 0) FROM matrix_a WHERE origin = '{ENTITY}' AND destination = '{ENTITY}') AS da,
  (SELECT coalesce(sum(value), 0) FROM internal_a WHERE entity = '{ENTITY}') AS ia,
  (SELECT coalesce(sum(value), 0) FROM matrix_b WHERE origin = '{ENTITY}' AND destination = '{ENTITY}') AS db,
  (SELECT coalesce(sum(value), 0) FROM internal_b WHERE entity = '{ENTITY}') AS ib)"""


_MOVED = f"1000000 * (SELECT count(value) FROM matrix_b WHERE origin = '{ENTITY}' AND destination = '{ENTITY}')"


def _audit_row(moved: str) -> str:
    gap = f"abs(CAST(db + {moved} AS DOUBLE) - CAST(ib AS DOUBLE))"
    return f"""'CROSS_PERIOD_AUDIT' AS dimension, '{ENTITY}_DIAGONAL_INTERNAL' AS metric, 'CROSS_PERIOD_OBSERVATION' AS test_method,
  %s {_r(gap, 'statistic')}, %s CASE WHEN greatest(abs(CAST(da AS DOUBLE) - CAST(ia AS DOUBLE)), {gap}) <= 1e-4
  THEN 'NO_MATERIAL_STATISTICAL_CHANGE' ELSE 'STATISTICALLY_DIFFERENT' END AS status FROM audit"""


_NONE = "CAST(NULL AS DOUBLE)"
STAT_SUITE = _with(
    *BOTH, PAIRS, PAIR_SAMPLES, *KS_CTES, *SERIES, *_edges(_SUITE_BINS), *PSI_CTES, YOY, AUDIT_CTE,
    body=f"""SELECT dimension, dimension || '_DISTRIBUTION' AS metric, 'KS_TEST' AS test_method, n AS n_reference, m AS n_comparison,
  {_r('CASE WHEN enough THEN d END', 'statistic')}, {_r('p', 'p_value', 6)}, {_NONE} AS psi_value, {_NONE} AS pct_change, {_KS_STATUS} AS status FROM tested
UNION ALL SELECT dimension, dimension || '_STABILITY', 'PSI', n, m, NULL, NULL, {_r('CASE WHEN enough THEN coalesce(psi, 0.0) END', 'psi_value', 6)}, NULL, {_PSI_STATUS} FROM psi_rows
UNION ALL SELECT dimension, metric, 'YOY_CHANGE', NULL, NULL, {_r('chg', 'statistic')}, NULL, NULL, {_r('pct', 'pct_change', 6)}, {_YOY_STATUS} FROM yoy
UNION ALL SELECT {_audit_row('0') % ('NULL, NULL,', 'NULL, NULL, NULL,')}""",
)
STAT_SUITE = f"SELECT *, '{YEAR_A}' AS reference_period, '{YEAR_B}' AS comparison_period FROM ({STAT_SUITE})"

# --- order checks ---------------------------------------------------------------------------------------------------

CHECKED = (
    """sums AS (SELECT l_orderkey, count(*) AS n_lines, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS line_sum FROM lineitem GROUP BY 1)""",
    """gaps AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS total, CAST(abs(coalesce(line_sum, 0) - CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS gap
      FROM orders LEFT JOIN sums ON o_orderkey = l_orderkey)""",
    """checked AS (SELECT 'run-' || year(o_orderdate) AS run_id, 'TOT-' || substr(o_orderpriority, 1, 1) || '-' || o_orderstatus AS check_id,
      o_orderpriority AS check_category, 'Order total' AS check_name, 'orders_' || o_orderstatus AS table_name, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS entity,
      CASE WHEN gap <= 50000 THEN 'PASS' WHEN gap <= 100000 THEN 'WARNING' ELSE 'FAIL' END AS status,
      CASE WHEN gap <= 50000 THEN 'INFO' WHEN gap <= 100000 THEN 'WARNING' WHEN gap <= 200000 THEN 'ERROR' ELSE 'CRITICAL' END AS severity,
      CAST(total AS VARCHAR) AS expected, CAST(CAST(coalesce(line_sum, 0) AS DECIMAL(18,2)) AS VARCHAR) AS observed, gap AS difference,
      coalesce(n_lines, 0) AS affected_records, gap / nullif(CAST(total AS DOUBLE), 0) * 100.0 AS share FROM gaps)""",
    """recs AS (SELECT run_id, 'REC-' || substr(check_category, 1, 1) AS rule_code, table_name AS dimension, entity,
      CASE WHEN severity = 'CRITICAL' THEN 'UNRESOLVED' WHEN status = 'PASS' THEN 'PASS' ELSE 'WARNING' END AS status, difference FROM checked)""",
    """stats AS (SELECT run_id, check_category AS dimension, entity AS metric,
      CASE table_name WHEN 'orders_F' THEN 'KS_TEST' WHEN 'orders_O' THEN 'PSI' ELSE 'YOY_CHANGE' END AS test_method,
      CASE WHEN share IS NULL THEN 'NOT_APPLICABLE' WHEN share <= 25.0 THEN 'NO_MATERIAL_STATISTICAL_CHANGE' ELSE 'STATISTICALLY_DIFFERENT' END AS status,
      share AS pct_change FROM checked)""",
    """failed AS (SELECT *, CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'ERROR' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END AS rank FROM checked WHERE status = 'FAIL')""",
    """placed AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY rank, check_id, table_name, entity) AS pos FROM failed)""",
    """ids AS (SELECT run_id, check_id, row_number() OVER (PARTITION BY run_id ORDER BY min(rank), check_id) AS k FROM failed GROUP BY 1, 2)""",
    """incidents AS (SELECT f.run_id, p.severity, p.table_name AS source_table, p.check_id, p.check_name, p.expected AS expected_value, p.observed AS observed_value,
      p.difference, sum(f.affected_records) AS affected_record_count, count(*) AS n_failures FROM failed f JOIN placed p ON p.run_id = f.run_id AND p.pos = 1 GROUP BY ALL)""",
)
RUNS = (
    """ev AS (SELECT 'run-' || user_id AS run_id, ts, CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'purchase' THEN 'COMPLETED' ELSE 'FAILED' END AS status
      FROM events WHERE event_type IN ('signup', 'purchase', 'error'))""",
    """states AS (SELECT run_id, arg_max(status, ts) AS status, min(ts) AS created_at, max(ts) FILTER (status IN ('COMPLETED', 'FAILED')) AS completed_at FROM ev GROUP BY 1)""",
    "timed AS (SELECT *, round((epoch_us(completed_at) - epoch_us(created_at)) / 1e6, 2) AS duration_seconds FROM states)",
)
INCIDENTS = """inc AS (SELECT 'INC-' || c_custkey AS incident_id, 'run-' || c_nationkey AS run_id,
  CASE WHEN c_acctbal < 1000 THEN 'CRITICAL' WHEN c_acctbal < 3000 THEN 'ERROR' ELSE 'WARNING' END AS severity,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'RESOLVED' ELSE 'OPEN' END AS status, c_mktsegment AS source_table, c_custkey AS detected_at
  FROM customer WHERE c_acctbal < 5000)"""
ALERTS = """alerts AS (SELECT 'INC-' || o_custkey AS incident_id, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'SENT' ELSE 'FAILED' END AS outcome
  FROM orders)"""


def _checked(body: str) -> str:
    return _with(*CHECKED, body=body)


def _share(part: str, name: str) -> str:
    return f"round({part} * 100.0 / nullif(count(*), 0), 1) AS {name}"


_P, _W, _F = (f"count(*) FILTER (status = '{s}')" for s in ("PASS", "WARNING", "FAIL"))


# --- faults ---------------------------------------------------------------------------------------------------------

def _fault(letter: str, kind: str, target: str, expected: str, signals: str, advisory: bool = False) -> str:
    """One row of the detection matrix. ``signals`` yields (detector, fired, blocking, n)."""
    return f"""SELECT 'FAULT-{letter}' AS scenario_id, '{kind}' AS corruption_type, '{target}' AS target, '{expected}' AS expected_detectors,
  coalesce(string_agg(DISTINCT detector, ', ' ORDER BY detector) FILTER (n > 0), '') AS actual_detectors,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS evidence, coalesce(sum(n), 0) > 0 AS detected, coalesce(bool_or(n > 0 AND blocking), FALSE) AS blocked,
  {str(advisory).upper()} AS advisory FROM ({signals}) q"""


_CELL = f"code = '{CODE}' AND entity = '{ENTITY}'"
_WHERE = f"code={CODE}, entity={ENTITY}"
_FULL_SIZE = f"{_SIZES[1]} * {_SIZES[0]}"
_OUT_SUM = "(SELECT coalesce(sum(value), 0) FROM outward_a)"
_IN_SUM = "(SELECT coalesce(sum(value), 0) FROM inward_a)"
_LOST = f"(SELECT coalesce(sum(value), 0) FROM outward_a WHERE entity = '{ENTITY}')"


def _outside(gap: str, base: str) -> str:
    return f"(CASE WHEN {gap} > 1e-4 AND ({base} = 0 OR CAST({gap} AS DOUBLE) / abs({base}) > 1e-7) THEN 1 ELSE 0 END)"


_FILLED = f"(SELECT count(value) FROM outward_a WHERE {_CELL})"
_SHIFT = f"({_FILLED} * 1000000)"
_FAULTS = {
    "A": _fault("A", "MISSING_RECORD", f"outward {_WHERE}", "CMP-03",
                f"SELECT 'CMP-03' AS detector, TRUE AS blocking, CASE WHEN (SELECT count(*) FROM outward_a WHERE NOT ({_CELL})) <> {_FULL_SIZE} THEN 1 ELSE 0 END AS n"),
    "B": _fault("B", "DUPLICATE_RECORD", f"outward {_WHERE}", "UNQ-03",
                f"""SELECT 'UNQ-03' AS detector, TRUE AS blocking, least(1, (SELECT count(*) FROM (SELECT code, entity FROM
    (SELECT code, entity FROM outward_a UNION ALL SELECT code, entity FROM outward_a WHERE {_CELL}) GROUP BY ALL HAVING count(*) > 1))) AS n"""),
    "C": _fault("C", "INVALID_DOMAIN", f"summary code={CODE}", "DOM-03-summary",
                f"""SELECT 'DOM-03-summary' AS detector, TRUE AS blocking, least(1, (SELECT count(*) FROM (SELECT CASE WHEN code = '{CODE}' THEN '999' ELSE code END AS code FROM summary_a)
    WHERE NOT regexp_matches(code, '^Brand#[0-9]{{1,2}}$'))) AS n"""),
    "D": _fault("D", "ALTERED_NUMERIC", f"outward {_WHERE}", "REC-V02, REC-DO02, REC-DO03, REC-DO04",
                f"""SELECT 'REC-V02' AS detector, TRUE AS blocking, CASE WHEN {_SHIFT} > 1e-4 THEN 1 ELSE 0 END AS n
    UNION ALL SELECT 'REC-DO02', FALSE, {_outside(_SHIFT, _IN_SUM)}
    UNION ALL SELECT 'REC-DO03', FALSE, {_outside(_SHIFT, '(SELECT coalesce(sum(value), 0) FROM summary_a)')}
    UNION ALL SELECT 'REC-DO04', FALSE, {_outside(_SHIFT, f"((SELECT coalesce(sum(value), 0) FROM matrix_a WHERE origin = '{ENTITY}') + {_SHIFT})")}"""),
    "E": _fault("E", "MISSING_ENTITY", f"outward entity={ENTITY}", "CMP-03, REC-DO02",
                f"""SELECT 'CMP-03' AS detector, TRUE AS blocking, CASE WHEN (SELECT count(*) FROM outward_a WHERE entity <> '{ENTITY}') <> {_FULL_SIZE} THEN 1 ELSE 0 END AS n
    UNION ALL SELECT 'REC-DO02', FALSE, {_outside(f'abs({_OUT_SUM} - {_LOST} - {_IN_SUM})', _IN_SUM)}"""),
    "F": _fault("F", "NUMERIC_TO_TEXT", f"internal {_WHERE}", "NUM-01-internal",
                f"SELECT 'NUM-01-internal' AS detector, TRUE AS blocking, least(1, (SELECT count(*) FROM internal_a WHERE {_CELL})) AS n"),
    "G": _fault("G", "DISTRIBUTION_SHIFT", "outward values x100", "KS_TEST, PSI",
                """SELECT 'KS_TEST' AS detector, FALSE AS blocking, (SELECT count(*) FROM tested WHERE enough AND p < 0.05) AS n
    UNION ALL SELECT 'PSI', FALSE, (SELECT count(*) FROM psi_rows WHERE enough AND psi >= 0.10)""", True),
}
_SCALED = """pairs AS (SELECT 'ENTITY_OUTWARD' AS dimension, CAST(NULL AS VARCHAR) AS code, a.entity, sum(a.value) AS reference, sum(b.value) * 100 AS comparison
  FROM outward_a a JOIN outward_b b USING (code, entity) GROUP BY a.entity)"""
_FAULT_CTES = (*BOTH, _SCALED, PAIR_SAMPLES, *KS_CTES, *SERIES, *_edges(_SUITE_BINS), *PSI_CTES)


def _faults(letters: str) -> str:
    return _with(*_FAULT_CTES, body="\nUNION ALL ".join(_FAULTS[letter] for letter in letters))


# --- validation suite -----------------------------------------------------------------------------------------------


def _suite_row(check_id: str, category: str, table: str, bad: str, severity: str, source: str, status: str = "FAIL") -> str:
    return f"""SELECT '{check_id}' AS check_id, '{category}' AS check_category, '{table}' AS table_name,
  CASE WHEN {bad} = 0 THEN 'PASS' ELSE '{status}' END AS status, CASE WHEN {bad} = 0 THEN 'INFO' ELSE '{severity}' END AS severity,
  CAST({bad} AS DOUBLE) AS difference, CAST({bad} AS BIGINT) AS affected_records {source}"""


def _suite_rows(source: str = "printed") -> str:
    rows = [_suite_row("SCH-01", "SCHEMA", "source", "n", "CRITICAL", "FROM (SELECT count(*) * 0 AS n FROM matrix) q")]
    keys = {"matrix": "origin, destination", "summary": "code"}
    for number, table in enumerate(_EXPECTED, 1):
        key = keys.get(table, "code, entity")
        zero = f"FROM (SELECT count(*) * 0 AS n FROM {table}) q"
        rows += [
            _suite_row(f"SCH-02-{table}", "SCHEMA", table, "n", "CRITICAL", zero),
            _suite_row(f"SCH-03-{table}", "SCHEMA", table, "n", "WARNING", zero),
            _suite_row(f"CMP-{number:02d}", "COMPLETENESS", table, "n", "CRITICAL", f"FROM (SELECT abs(count(*) - {_EXPECTED[table]}) AS n FROM {table}) q"),
            _suite_row(f"UNQ-{number:02d}", "UNIQUENESS", table, "n", "CRITICAL",
                       f"FROM (SELECT coalesce(sum(c), 0) AS n FROM (SELECT count(*) AS c FROM {table} GROUP BY {key} HAVING count(*) > 1)) q"),
            _suite_row(f"NUM-01-{table}", "NUMERIC", table, "n", "ERROR", zero),
            _suite_row(f"NUM-02-{table}", "NUMERIC", table, "n", "ERROR", f"FROM (SELECT count(*) FILTER (value < 0) AS n FROM {table}) q"),
            _suite_row(f"NUM-03-{table}", "NUMERIC", table, "n", "CRITICAL", f"FROM (SELECT count(*) FILTER (isinf(CAST(value AS DOUBLE))) AS n FROM {table}) q"),
            _suite_row(f"NUM-05-{table}", "NUMERIC", table, "n", "WARNING", f"FROM (SELECT count(*) FILTER (value IS NULL) AS n FROM {table}) q", "WARNING"),
        ]
        if table != "matrix":
            rows.append(_suite_row(f"SCH-04-{table}", "SCHEMA", table, "n", "ERROR", zero))
            rows.append(_suite_row(f"DOM-03-{table}", "DOMAIN", table, "n", "ERROR",
                                   f"FROM (SELECT count(*) FILTER (NOT regexp_matches(code, '^Brand#[0-9]{{1,2}}$') OR code NOT IN (SELECT code FROM cat)) AS n FROM {table}) q"))
        if table != "summary":
            label = "origin" if table == "matrix" else "entity"
            rows.append(_suite_row(f"DOM-01-{table}", "DOMAIN", table, "n", "ERROR",
                                   f"FROM (SELECT count(DISTINCT {label}) FILTER ({label} NOT IN (SELECT entity FROM ent)) AS n FROM {table}) q"))
    rows += [
        _suite_row("CMP-06", "COMPLETENESS", "summary", "n", "ERROR", "FROM (SELECT count(*) AS n FROM cat WHERE code NOT IN (SELECT code FROM summary)) q"),
        _suite_row("CMP-07", "COMPLETENESS", "matrix", "n", "CRITICAL", "FROM (SELECT count(*) AS n FROM ent WHERE entity NOT IN (SELECT origin FROM matrix)) q"),
        _suite_row("DOM-02", "DOMAIN", "matrix", "n", "ERROR", f"FROM (SELECT CASE WHEN bool_or(origin = '{ENTITY}') THEN 0 ELSE 1 END AS n FROM matrix) q"),
        _suite_row("STR-01", "STRUCTURAL", "matrix", "n", "CRITICAL", f"FROM (SELECT abs(count(*) - {_EXPECTED['matrix']}) AS n FROM matrix) q"),
        *[_suite_row(f"STR-02-{t}", "STRUCTURAL", t, "n", "ERROR",
                     f"FROM (SELECT 1 - count(*) AS n FROM {source} WHERE table_name = '{t}' AND axis = 'GRAND' AND value IS NOT NULL) q") for t in ("inward", "internal")],
        _suite_row("STR-03-outward", "STRUCTURAL", "outward", "n", "INFO", "FROM (SELECT count(*) * 0 AS n FROM outward) q", "WARNING"),
        f"""SELECT check_id, 'SOURCE_TOTAL' AS check_category, table_name, {_TOTAL_STATUS}, round(worst, 4) AS difference,
  CAST(bad AS BIGINT) AS affected_records FROM total_rows""",
    ]
    return "\nUNION ALL ".join(rows)


def _suite() -> str:
    return _with(*ALL, *_met(), _TOTAL_IDS, TOTAL_ROWS, body=_suite_rows())


# Runs over sheets: without the row that counts documented columns, the kept label and the NULL audit.
_RUN_ROWS = "check_id NOT LIKE 'NUM-05%' AND check_id NOT IN ('DOM-02', 'STR-03-outward')"


def _run_rows(name: str) -> str:
    """All rows of the suite over printed or altered totals."""
    source = "altered" if name == "faulty" else "printed"
    ctes = ",\n".join([*_met(source)[3:], _TOTAL_IDS, TOTAL_ROWS])
    return f"""{name} AS (WITH {ctes}
SELECT '{name}' AS run_name, * FROM ({_suite_rows(source)}) s WHERE {_RUN_ROWS})"""


_RUNS = (*ALL, _printed(), _ALTERED, COMPUTED, _run_rows("clean"), _run_rows("faulty"))
_FAILED = "SELECT * FROM faulty WHERE status = 'FAIL'"
PIPELINE_RESULTS = _with(*_RUNS, body="SELECT * FROM clean UNION ALL SELECT * FROM faulty")
PIPELINE_DECISION = _with(
    *_RUNS,
    body=f"""SELECT run_name, run_name AS source_name, CASE WHEN n = 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status, n AS n_failures,
  CASE WHEN n = 0 THEN CAST({' + '.join(f'(SELECT count(*) FROM {t})' for t in _EXPECTED)} AS BIGINT) END AS published_rows,
  CASE WHEN n = 0 THEN TRUE END AS has_matrix
FROM (SELECT run_name, count(*) FILTER (status = 'FAIL') AS n FROM (SELECT * FROM clean UNION ALL SELECT * FROM faulty) GROUP BY 1)""",
)
PIPELINE_INCIDENT = _with(
    *_RUNS,
    body=f"""SELECT run_name, check_id, table_name, (SELECT min(check_id) FROM ({_FAILED}) WHERE severity = 'CRITICAL') AS leading_check,
  'CRITICAL' AS incident_severity, (SELECT count(*) FROM ({_FAILED})) AS n_failures,
  (SELECT CAST(sum(affected_records) AS BIGINT) FROM ({_FAILED})) AS affected_record_count FROM ({_FAILED})""",
)

_LONG = "SELECT code, description, entity, " + _r("value") + " FROM {}"
_ROWS_ONE = "SELECT code, entity, value, row_number() OVER (PARTITION BY entity ORDER BY code) AS r FROM inward"

ORACLE: dict[str, str] = {
    "unpivot_matrix_nulls_kept": _with(*ALL, body=f"SELECT origin, destination, {_r('value')} FROM matrix"),
    "unpivot_category_entity": _with(*ALL, body=_LONG.format("internal")),
    "flat_summary": _with(*ALL, body=f"SELECT code, description, {_r('value')} FROM summary"),
    "unified_fact": _with(*ALL, body="\nUNION ALL ".join(
        f"SELECT '{k.upper()}' AS movement_type, entity, count(*) AS n_cells, count(value) AS n_filled, {_r('sum(value)', 'value')} FROM {k} GROUP BY entity" for k in _KINDS)),
    "densify_cells": _with(*ALL, body=f"SELECT code, entity, {_r('value')} FROM internal"),
    "canonical_labels": """SELECT o_orderpriority AS label, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'LOW' WHEN '5-LOW' THEN 'LOW'
  WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'HIGH' ELSE o_orderpriority END AS canonical_label, count(*) AS n FROM orders GROUP BY 1, 2""",
    "canonical_labels_by_table": f"""SELECT r_name AS canonical_label, n_name, {_r('sum(CAST(c_acctbal AS DECIMAL(18,2)))', 'balance')}
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "reported_totals_long": _with(*ALL, REPORTED, body=f"SELECT table_name, axis, entity, {_r('value')} FROM reported"),
    "pivot_category_status": _checked(f'SELECT check_category, {_P} AS "PASS", {_W} AS "WARNING", {_F} AS "FAIL" FROM checked GROUP BY 1'),
    "staged_cells": _with(*ALL, "numbered AS (SELECT code, row_number() OVER (ORDER BY code) AS r FROM cat)",
                          "headed AS (SELECT entity, row_number() OVER (ORDER BY entity) + 2 AS c FROM ent)",
                          body=f"""SELECT 'inward' AS table_name, i.code, i.entity, {_r('value')}, FALSE AS is_summary, r AS source_row, c AS source_col
  FROM inward i JOIN numbered USING (code) JOIN headed USING (entity)
  UNION ALL SELECT 'inward', i.code, 'TOTAL', {_r('coalesce(sum(value), 0)', 'value')}, TRUE, r, (SELECT count(*) FROM ent) + 3 FROM inward i JOIN numbered USING (code) GROUP BY i.code, r"""),
    "staged_metadata": _with(*ALL, body="\nUNION ALL ".join([
        f"SELECT 'matrix' AS table_name, {_SIZES[0]} AS row_count, 1 + {_SIZES[0]} AS column_count, count(*) FILTER (value IS NULL) AS null_cells_count, {_NONE} AS reported_total, {_NONE} AS reported_entity_sum FROM matrix",
        f"SELECT 'summary', {_SIZES[1]}, 3, count(*) FILTER (value IS NULL), {_r('coalesce(sum(value), 0)', 'x')}, NULL FROM summary",
        f"SELECT 'outward', {_SIZES[1]}, 2 + {_SIZES[0]}, count(*) FILTER (value IS NULL), NULL, {_r('coalesce(sum(value), 0)', 'x')} FROM outward",
        *[f"SELECT '{t}', {_SIZES[1]}, 3 + {_SIZES[0]}, count(*) FILTER (value IS NULL), {_r('coalesce(sum(value), 0)', 'x')}, {_r('coalesce(sum(value), 0)', 'y')} FROM {t}" for t in ("inward", "internal")],
    ])),
    "src_total_grand": _differences("GRAND"),
    "src_total_columns": _differences("COLUMN"),
    "src_total_rows": _differences("ROW"),
    "src_total_checks": TOTAL_CHECKS,
    "cross_foot_both_axes": CROSS_FOOT,
    "order_total_vs_lines": ORDER_TOTALS,
    "order_total_check": ORDER_TOTAL_CHECK,
    "rec_do01_national": _reconciled("do01"),
    "rec_do02_out_in": _reconciled("do02"),
    "rec_do03_partition": _reconciled("do03"),
    "rec_do04_origin_marginals": _reconciled("do04"),
    "rec_do05_dest_marginals": _reconciled("do05"),
    "rec_do06_diagonal_exceptions": _reconciled("do06_moved"),
    "rec_all": _reconciled("do01", "do02", "do03", "do04", "do05", "do06"),
    "rec_profile": _with(*ALL, NATIONAL, body=f"""SELECT {_r('m', 'matrix_total')}, {_r('s', 'summary_total')}, {_r('o', 'outward_total')}, {_r('i', 'inward_total')},
  {_r('t', 'internal_total')}, {_r('d', 'diagonal_total')}, {_r('m - s', 'matrix_minus_summary')}, {_r('o - i', 'outward_minus_inward')},
  {_r('o + t - s', 'parts_minus_summary')}, {_r('d - t', 'diagonal_minus_internal')} FROM national"""),
    "sch_columns": SCHEMA_CHECKS,
    "cmp_counts": COUNT_CHECKS,
    "cmp_missing_keys": _with(*ALL, body="SELECT code, entity FROM internal WHERE value IS NULL"),
    "cmp_category_set": _label_set("CMP-06", "part", "SELECT p_brand AS l FROM part WHERE p_type <> 'PROMO'",
                                   "SELECT DISTINCT p_brand AS l FROM part WHERE regexp_matches(p_brand, '[02468]$')", True, "ERROR"),
    "cmp_entity_set": _label_set("CMP-07", "supplier", "SELECT n_name AS l FROM supplier JOIN nation ON s_nationkey = n_nationkey",
                                 "SELECT DISTINCT n_name AS l FROM nation", False, "CRITICAL"),
    "unq_natural_key": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "dom_membership": _with(_cube(), body="\nUNION ALL ".join([
        _membership("flow", _LABELS, "SELECT n_name FROM nation"), _membership("flow_short", _LABELS, _SHORT),
        _membership("events", "SELECT event_type AS l FROM events", "'view', 'click'")])),
    "dom_label_preserved": "\nUNION ALL ".join([_preserved("events", "signup", "sign-up"), _preserved("events_corrected", "view", "click"), _preserved("events_missing", "Views", "Clicks")]),
    "dom_code_format": f"SELECT * FROM ({_number_checks(6, *_PART_DOM)}) WHERE check_id LIKE 'DOM%'",
    "num_checks_fused": SOURCE_CHECKS,
    "num_negative_messages": "\nUNION ALL ".join([_negative_message("customer", "c_acctbal", "customer"), _negative_message("orders", "o_totalprice", "orders")]),
    "num_text_cells": TEXT_CHECKS,
    "num_null_audit": NULL_AUDIT,
    "str_reshape_conservation": _with(*ALL, body="\nUNION ALL ".join([
        *[_conservation(t, t, t) for t in ("matrix", *_KINDS)], _conservation("internal", "(SELECT * FROM internal WHERE value > 10000)", "internal_large")])),
    "str_summary_present": _with(*ALL, REPORTED, body="\nUNION ALL ".join(_summary_present(t) for t in _EXPECTED)),
    "fk_orphans": "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "constraint", count({k}) AS n_rows, count(*) FILTER ({k} NOT IN (SELECT {pk} FROM {p})) AS n_orphans,
  count(DISTINCT {k}) FILTER ({k} NOT IN (SELECT {pk} FROM {p})) AS n_orphan_keys FROM {c}"""
        for name, c, k, p, pk in (("lineitem_order", "lineitem", "l_orderkey", "orders", "o_orderkey"), ("order_lineitem", "orders", "o_orderkey", "lineitem", "l_orderkey"),
                                  ("customer_order", "customer", "c_custkey", "orders", "o_custkey"), ("document_label", "documents", "doc_id", "labels", "doc_id"))),
    "validation_suite_all": _suite(),
    "pipeline_results": PIPELINE_RESULTS,
    "pipeline_decision": PIPELINE_DECISION,
    "pipeline_incident": PIPELINE_INCIDENT,
    "src_totals_failing": _total_checks("altered"),
    "cross_foot_failing": _cross_foot("altered"),
    "comparable_pairs": _with(*BOTH, PAIRS, body=f"SELECT dimension, code, entity, {_r('reference')}, {_r('comparison')} FROM pairs"),
    "yoy_entity": _yoy("starts_with(dimension, 'ENTITY_')"),
    "yoy_category": _yoy("NOT starts_with(dimension, 'ENTITY_')"),
    "yoy_macro": _with(*BOTH, PAIRS, """macro AS (SELECT dimension, CAST(sum(reference) AS DOUBLE) AS r, CAST(sum(comparison) AS DOUBLE) AS c FROM pairs
      WHERE NOT starts_with(dimension, 'CATEGORY_ENTITY_') GROUP BY 1)""",
                       body=f"SELECT dimension, {_r('r', 'reference')}, {_r('c', 'comparison')}, {_r('c - r', 'change')}, {_r('(c - r) / nullif(r, 0) * 100.0', 'pct_change', 6)} FROM macro"),
    "pair_snapshots_parts": f"""SELECT l_partkey AS part, {_r(f'sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (year(l_shipdate) = {YEAR_A})', 'reference')},
  {_r(f'sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (year(l_shipdate) = {YEAR_B})', 'comparison')} FROM lineitem WHERE year(l_shipdate) IN ({YEAR_A}, {YEAR_B}) GROUP BY 1""",
    "ks_by_dimension": _with(*BOTH, PAIRS, PAIR_SAMPLES, *KS_CTES, *SERIES, body=_KS_SELECT),
    "ks_exact_p": _with(*BOTH, PAIRS, PAIR_SAMPLES, *KS_CTES, *EXACT, body=_KS_SELECT).replace("WITH", "WITH RECURSIVE", 1),
    "psi_by_dimension": _with(*BOTH, PAIRS, PAIR_SAMPLES, *_edges(_SUITE_BINS), *PSI_CTES, body=_PSI_SELECT),
    "ks_line_prices": _with(LINE_SAMPLES, *KS_CTES, *SERIES, body=_KS_SELECT),
    "psi_line_prices": _with(LINE_SAMPLES, *_edges(_BINS), *PSI_CTES, body=_PSI_SELECT),
    "psi_bin_edges": _with(LINE_SAMPLES, *_edges(_BINS), body=f"SELECT dimension, i - 1 AS bin, {_r('e[i]', 'edge', 6)} FROM edges, unnest(range(1, len(e) + 1)) t(i)"),
    "cross_period_exception_audit": _with(*BOTH, AUDIT_CTE, body="SELECT " + _audit_row(_MOVED) % ("", "")),
    "stat_suite_all": STAT_SUITE,
    "gate_decision": _checked(f"""SELECT run_id, count(*) AS n_results, {_F} AS n_failures, count(*) FILTER (status = 'FAIL' AND severity IN ('CRITICAL', 'ERROR')) AS n_blocking,
  CASE WHEN {_F} > 0 THEN 'INCIDENT' ELSE 'PROMOTE' END AS decision FROM checked GROUP BY 1"""),
    "failures_by_suite": _checked("SELECT run_id, check_category, count(*) AS n FROM checked WHERE status = 'FAIL' AND severity = 'CRITICAL' GROUP BY 1, 2"),
    "blocking_failures": _checked(f"SELECT run_id, check_id, entity, severity, {_r('difference')}, affected_records FROM checked WHERE status = 'FAIL' AND severity IN ('CRITICAL', 'ERROR')"),
    "incident_aggregate": _checked(f"""SELECT 'INC-' || i.run_id AS incident_id, i.run_id, severity, 'DATA_INTEGRITY_FAILURE' AS failure_type, source_table, i.check_id, check_name,
  expected_value, observed_value, {_r('difference')}, CAST(affected_record_count AS BIGINT) AS affected_record_count, n_failures,
  'Held back by ' || (SELECT string_agg(check_id, ', ' ORDER BY k) FROM ids WHERE ids.run_id = i.run_id AND k <= 3)
    || (SELECT CASE WHEN count(*) > 3 THEN ' (+' || (count(*) - 3) || ' more)' ELSE '' END FROM ids WHERE ids.run_id = i.run_id) AS title,
  n_failures || ' checks stop run ' || i.run_id || '; gravest: ' || i.check_id || ' on ' || source_table || '. Nothing was published.' AS description, 'OPEN' AS status FROM incidents i"""),
    "incident_failures": _checked(f"SELECT 'INC-' || run_id AS incident_id, check_id, entity, severity, {_r('difference')} FROM failed"),
    "alert_excerpt": _checked("SELECT 'INC-' || run_id AS incident_id, pos AS position, check_id, entity, severity FROM placed WHERE pos <= 5"),
    "alerts_pending": _with(INCIDENTS, ALERTS, body="SELECT incident_id, run_id, severity FROM inc WHERE incident_id NOT IN (SELECT incident_id FROM alerts WHERE outcome = 'SENT')"),
    "alert_outcomes": _with(INCIDENTS, ALERTS, body="""SELECT CASE WHEN incident_id IN (SELECT incident_id FROM alerts WHERE outcome = 'SENT') THEN 'SKIPPED_DUPLICATE' ELSE 'READY' END AS outcome,
  count(*) AS n FROM inc GROUP BY 1"""),
    "run_log_latest": _with(*RUNS, body="SELECT run_id, status FROM states"),
    "run_durations": _with(*RUNS, body="SELECT run_id, duration_seconds FROM timed"),
    "runs_recent": _with(*RUNS, body="SELECT run_id, status FROM states ORDER BY created_at DESC, run_id DESC LIMIT 5"),
    "latest_run": _with(*RUNS, body="SELECT run_id, status, duration_seconds FROM timed ORDER BY created_at DESC, run_id DESC LIMIT 1"),
    "results_page": _checked(f"""SELECT CAST((n - 1) // 40 + 1 AS INTEGER) AS page, CAST((n - 1) % 40 + 1 AS INTEGER) AS place, check_id, table_name, entity, {_r('difference')}
      FROM (SELECT *, row_number() OVER (ORDER BY check_id, table_name, entity) AS n FROM checked) WHERE n <= 120"""),
    "snapshot_changed_rows": """WITH ends AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders),
  later AS (SELECT CASE WHEN o_orderdate = a THEN -o_orderkey ELSE o_orderkey END AS k, CASE WHEN o_totalprice < 5000 THEN round(o_totalprice) ELSE o_totalprice END AS price
    FROM orders, ends WHERE o_orderdate < z)
SELECT coalesce(o_orderkey, k) AS o_orderkey, CASE WHEN o_orderkey IS NULL THEN 'ADDED' WHEN k IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change,
  CAST(o_orderkey IS NOT NULL AS BIGINT) AS rows_before, CAST(k IS NOT NULL AS BIGINT) AS rows_after
FROM orders FULL JOIN later ON o_orderkey = k WHERE o_orderkey IS NULL OR k IS NULL OR o_totalprice <> price""",
    "results_filtered": _checked(f"SELECT check_id, entity, severity, {_r('difference')} FROM checked WHERE run_id = 'run-1997' AND table_name = 'orders_F' AND check_category = '1-URGENT' AND status = 'FAIL'"),
    "rec_results_filtered": _checked(f"SELECT rule_code, dimension, entity, status, {_r('difference')} FROM recs WHERE run_id = 'run-1996' AND rule_code = 'REC-2'"),
    "stat_results_filtered": _checked(f"SELECT run_id, metric, {_r('pct_change', digits=6)} FROM stats WHERE dimension = '5-LOW' AND test_method = 'PSI' AND status = 'STATISTICALLY_DIFFERENT'"),
    "incidents_newest": _with(INCIDENTS, body="SELECT incident_id, run_id, source_table, detected_at FROM inc WHERE severity = 'CRITICAL' AND status = 'OPEN'"),
    "overview_kpis": _checked("""SELECT c.run_id, c.p AS checks_passed, c.n AS checks_total, coalesce(r.u, 0) AS unresolved, coalesce(s.d, 0) AS shifted, coalesce(i.o, 0) AS open_incidents,
  CAST(coalesce(c.t, 0) AS BIGINT) AS promoted_rows FROM (SELECT run_id, count(*) AS n, count(*) FILTER (status = 'PASS') AS p, sum(affected_records) FILTER (status = 'PASS') AS t FROM checked GROUP BY 1) c
  LEFT JOIN (SELECT run_id, count(*) FILTER (status = 'UNRESOLVED') AS u FROM recs GROUP BY 1) r USING (run_id)
  LEFT JOIN (SELECT run_id, count(*) FILTER (status = 'STATISTICALLY_DIFFERENT') AS d FROM stats GROUP BY 1) s USING (run_id)
  LEFT JOIN (SELECT run_id, count(*) AS o FROM incidents GROUP BY 1) i USING (run_id)"""),
    "category_health": _checked(f"""SELECT check_category, count(*) AS total, {_P} AS passed, {_W} AS warnings, {_F} AS failed,
  CASE WHEN {_F} > 0 THEN 'FAIL' WHEN {_W} > 0 THEN 'WARNING' ELSE 'HEALTHY' END AS health FROM checked GROUP BY 1"""),
    "validation_summary": _checked(f"""SELECT count(*) AS total, {_P} AS passed, {_W} AS warnings, {_F} AS failed,
  count(DISTINCT table_name) FILTER (status <> 'PASS') AS affected_tables, CAST(coalesce(sum(affected_records) FILTER (status <> 'PASS'), 0) AS BIGINT) AS affected_records,
  {_share(_P, 'passed_pct')}, {_share(_W, 'warnings_pct')}, {_share(_F, 'failed_pct')} FROM checked"""),
    "validation_metrics": _checked(f"SELECT count(*) AS total, {_P} AS passed, {_F} AS failed, {_W} AS warnings FROM checked"),
    "reconciliation_summary": _checked("SELECT rule_code, status, count(*) AS n FROM recs GROUP BY 1, 2"),
    "reconciliation_metrics": _checked(f"SELECT count(*) AS total, {_P} AS passed, count(*) FILTER (status = 'UNRESOLVED') AS unresolved, {_F} AS failed FROM recs"),
    "statistical_summary": _checked("""SELECT "grouping", name, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM stats), 1) AS pct FROM (
  SELECT 'METHOD' AS "grouping", test_method AS name FROM stats UNION ALL SELECT 'STATUS', status FROM stats) GROUP BY 1, 2"""),
    "statistical_metrics": _checked("""SELECT count(*) AS total, count(*) FILTER (status = 'NO_MATERIAL_STATISTICAL_CHANGE') AS stable,
  count(*) FILTER (status = 'STATISTICALLY_DIFFERENT') AS shifted, count(*) FILTER (status NOT IN ('NO_MATERIAL_STATISTICAL_CHANGE', 'STATISTICALLY_DIFFERENT')) AS other FROM stats"""),
    "incident_metrics": _with(INCIDENTS, body="""SELECT count(*) AS total, count(*) FILTER (status = 'OPEN') AS open, count(*) FILTER (severity = 'CRITICAL') AS critical,
  count(*) FILTER (source_table = 'MACHINERY') AS alerted FROM inc"""),
    "trusted_counts": """SELECT 'run-' || year(l_shipdate) AS run_id, 'lineitem' AS table_name, count(*) AS n_rows FROM lineitem GROUP BY 1
  UNION ALL SELECT 'run-' || year(o_orderdate), 'orders', count(*) FROM orders GROUP BY 1""",
    "lineage_counts": _checked("""SELECT 'run-1998' AS run_id, 'raw_lineitem' AS table_name, count(*) AS n_rows FROM lineitem WHERE year(l_shipdate) = 1998
  UNION ALL SELECT 'run-1998', 'validation_results', count(*) FROM checked WHERE run_id = 'run-1998' UNION ALL SELECT 'run-1998', 'reconciliation_results', count(*) FROM recs WHERE run_id = 'run-1998'
  UNION ALL SELECT 'run-1998', 'trusted_orders', count(*) FROM checked WHERE run_id = 'run-1998' AND status = 'PASS'"""),
    "status_classes": _checked("""SELECT status, severity, CASE status WHEN 'PASS' THEN 'good' WHEN 'FAIL' THEN 'bad' ELSE 'warn' END AS status_class,
  CASE severity WHEN 'CRITICAL' THEN 'bad' WHEN 'INFO' THEN 'info' ELSE 'warn' END AS severity_class, count(*) AS n FROM checked GROUP BY 1, 2"""),
    "fault_isolation": """SELECT 'orders' AS table_name, count(*) AS rows_before, count(*) AS rows_after, TRUE AS unchanged FROM orders
  UNION ALL SELECT 'customer', count(*), count(*), TRUE FROM customer
  UNION ALL SELECT 'supplier', count(*), count(*) FILTER (s_suppkey <> 1), count(*) = count(*) FILTER (s_suppkey <> 1) FROM supplier""",
    **{name: _faults(letter) for name, letter in (("fault_a_missing", "A"), ("fault_b_duplicate", "B"), ("fault_c_code", "C"), ("fault_d_altered", "D"),
                                                  ("fault_e_entity", "E"), ("fault_f_text", "F"), ("fault_g_scale", "G"), ("detection_matrix", "ABCDEFG"))},
    "detection_summary": f"""SELECT count(*) AS n_scenarios, count(*) FILTER (detected) AS n_detected, count(*) FILTER (NOT detected) AS n_missed, count(*) FILTER (blocked) AS n_blocked,
  count(*) FILTER (detected AND advisory) AS n_advisory, count(*) FILTER (detected) / count(*) * 100.0 AS detected_pct, count(*) FILTER (blocked) / count(*) * 100.0 AS blocked_pct
  FROM ({_faults('ABCDEFG')})""",
}


# --- profiles -------------------------------------------------------------------------------------------------------

# Columns of the test tables, as far as the profile queries need them.
_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _table_profile(table: str) -> str:
    columns = _COLUMNS[table].split()
    nulls = " + ".join(f'count(*) FILTER ("{c}" IS NULL)' for c in columns)
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows, CAST({len(columns)} AS BIGINT) AS n_columns, CAST({nulls} AS BIGINT) AS n_null FROM {table}"


def _cell_types(table: str) -> str:
    columns = _COLUMNS[table].split()
    cells = " UNION ALL ".join(f"SELECT CAST({c} AS VARCHAR) AS v FROM {table}" for c in columns)
    number = "regexp_full_match(trim(v), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')"
    return f"""SELECT '{table}' AS table_name, CASE WHEN v IS NULL OR trim(v) = '' THEN 'empty' WHEN {number} THEN 'number' ELSE 'text' END AS cell_type,
  count(*) AS n_cells FROM ({cells}) GROUP BY 1, 2"""


def _column_profile() -> str:
    """Blank cells per column of the five wide tables; footer and body rows count."""
    with_footer = f"{_SIZES[1]} + 1"
    rows = [
        f"SELECT 'matrix' AS table_name, 'destination' AS column_name, {_SIZES[0]} AS n_rows, CAST(0 AS BIGINT) AS n_null",
        f"SELECT 'matrix', origin, {_SIZES[0]}, count(*) FILTER (value IS NULL) FROM matrix GROUP BY origin",
    ]
    rows += [f"SELECT 'summary', '{c}', {with_footer}, 0" for c in ("code", "description", "row_role")]
    rows.append(f"SELECT 'summary', 'value', {with_footer}, count(*) FILTER (value IS NULL) FROM summary")
    for kind in _KINDS:
        fixed = ["code", "description", "row_role"] + ([] if kind == "outward" else ["TOTAL"])
        rows += [f"SELECT '{kind}', '{c}', {with_footer}, 0" for c in fixed]
        rows.append(f"SELECT '{kind}', entity, {with_footer}, count(*) FILTER (value IS NULL) FROM {kind} GROUP BY entity")
    return _with(*ALL, body="\nUNION ALL ".join(rows))


_PLACES = (
    "numbered AS (SELECT code, row_number() OVER (ORDER BY code) AS r FROM cat)",
    "headed AS (SELECT entity, row_number() OVER (ORDER BY entity) + 2 AS c FROM ent)",
    "placed AS (SELECT value, r, c FROM inward JOIN numbered USING (code) JOIN headed USING (entity))",
)
_YEARLY = f"""yearly AS (SELECT o_custkey, year(o_orderdate) AS y, max(o_orderpriority) AS priority, max(o_orderstatus) AS status, count(*) AS n_orders
  FROM orders WHERE year(o_orderdate) IN ({YEAR_A}, {YEAR_B}) GROUP BY 1, 2)"""

ORACLE.update(
    {
        "table_profile": "\nUNION ALL ".join(_table_profile(t) for t in _COLUMNS),
        "cell_type_distribution": "\nUNION ALL ".join(_cell_types(t) for t in _COLUMNS),
        "column_profile": _column_profile(),
        "cell_bounding_box": _with(
            *ALL, *_PLACES,
            body="SELECT 'inward' AS table_name, min(r) AS min_row, max(r) AS max_row, min(c) AS min_col, max(c) AS max_col FROM placed WHERE value IS NOT NULL",
        ),
        "cell_empty_lines": _with(
            *ALL, *_PLACES,
            body="""SELECT 'inward' AS table_name, 'ROW' AS axis, r AS line FROM placed GROUP BY r HAVING count(*) FILTER (value > 1500000) = 0
  UNION ALL SELECT 'inward', 'COLUMN', c FROM placed GROUP BY c HAVING count(*) FILTER (value > 1500000) = 0""",
        ),
        "snapshot_label_diff": f"""SELECT o_custkey AS label, bool_or(year(o_orderdate) = {YEAR_A}) AS in_reference, bool_or(year(o_orderdate) = {YEAR_B}) AS in_comparison
  FROM orders WHERE year(o_orderdate) IN ({YEAR_A}, {YEAR_B}) GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) = 1""",
        "snapshot_attribute_diff": _with(
            _YEARLY,
            f"""sides AS (SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, a.o_custkey IS NULL AS no_a, b.o_custkey IS NULL AS no_b,
      concat_ws(',', CASE WHEN a.priority IS DISTINCT FROM b.priority THEN 'priority' END, CASE WHEN a.status IS DISTINCT FROM b.status THEN 'status' END,
        CASE WHEN a.n_orders IS DISTINCT FROM b.n_orders THEN 'n_orders' END) AS attributes
      FROM (SELECT * FROM yearly WHERE y = {YEAR_A}) a FULL JOIN (SELECT * FROM yearly WHERE y = {YEAR_B}) b ON a.o_custkey = b.o_custkey)""",
            body="""SELECT o_custkey, CASE WHEN no_a THEN 'ADDED' WHEN no_b THEN 'REMOVED' ELSE 'CHANGED' END AS change, attributes
  FROM sides WHERE no_a OR no_b OR attributes <> ''""",
        ),
        "label_positions": _with(
            *ALL,
            "m AS (SELECT code, entity, row_number() OVER (PARTITION BY code ORDER BY entity) AS position FROM outward)",
            "i AS (SELECT code, entity, row_number() OVER (PARTITION BY code ORDER BY entity) AS position FROM inward)",
            "s AS (SELECT code, entity, row_number() OVER (PARTITION BY code ORDER BY entity) AS position FROM internal WHERE value IS NOT NULL)",
            body="""SELECT code, position, m.entity AS outward, i.entity AS inward, s.entity AS sparse,
  coalesce(m.entity = i.entity AND m.entity = s.entity, FALSE) AS all_equal
  FROM m JOIN i USING (code, position) LEFT JOIN s USING (code, position)""",
        ),
        "snapshot_null_sparsity": _with(
            *BOTH,
            body="\nUNION ALL ".join(
                f"SELECT '{t}_{y}' AS table_name, count(*) AS n_cells, count(*) FILTER (value IS NULL) AS n_null, {_r('count(*) FILTER (value IS NULL) / count(*)', 'null_share', 6)} FROM {t}_{s}"
                for t in _EXPECTED
                for s, y in (("a", YEAR_A), ("b", YEAR_B))
            ),
        ),
    }
)


# --- content fingerprints -------------------------------------------------------------------------------------------

_FINGERPRINTED = {
    "region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_name", "n_regionkey"), "benchmark": ("item_id", "text"),
    "labels": ("doc_id", "quality", "toxic"), "conversations": ("conv_id", "turn", "role", "text"),
    "documents": ("doc_id", "text", "lang", "source", "n_chars"), "pages": ("page_id", "url", "html"),
}


def _fingerprint(table: str, source: str | None = None) -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in _FINGERPRINTED[table]]
    cells = " || ".join(f"coalesce(CAST(length({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts)
    sums = " || '-' || ".join(f"CAST(coalesce(sum(CAST('0x' || substr(md5({cells}), {at}, 15) AS HUGEINT)), 0) AS VARCHAR)" for at in (1, 16))
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows, {sums} AS fingerprint FROM {source or table}"


_FLIPPED = "(SELECT doc_id, CASE WHEN doc_id = (SELECT min(doc_id) FROM labels) THEN 1 - quality ELSE quality END AS quality, toxic FROM labels) f"
ORACLE |= {
    "content_fingerprint": "\nUNION ALL ".join(_fingerprint(t) for t in _FINGERPRINTED),
    "content_unchanged": _with(
        f"b AS ({' UNION ALL '.join(_fingerprint(t) for t in _FINGERPRINTED)})",
        f"a AS ({' UNION ALL '.join(_fingerprint(t, _FLIPPED if t == 'labels' else None) for t in _FINGERPRINTED)})",
        body="SELECT table_name, a.fingerprint = b.fingerprint AND a.n_rows = b.n_rows AS unchanged FROM a JOIN b USING (table_name)",
    ),
}

# --- published sheets -----------------------------------------------------------------------------------------------

_SHEET_ROWS = {"matrix": "ent", "summary": "cat", "outward": "cat", "inward": "cat", "internal": "cat"}
_SHEET_COLUMNS = {"matrix": "1 + n", "summary": "3", "outward": "2 + n", "inward": "3 + n", "internal": "3 + n"}
ORACLE |= {
    "sheet_layouts": _with(
        *_DIMS,
        "s AS (SELECT count(*) AS n FROM ent)",
        body="\nUNION ALL ".join(
            f"""SELECT '{name}' AS table_name, 'Table {name}, all periods' AS title, 3 AS header_row, 4 AS data_start_row,
  3 + count(*) AS data_end_row, {'CAST(NULL AS BIGINT)' if name == 'matrix' else '4 + count(*)'} AS footer_row, 3 AS first_col,
  2 + max({_SHEET_COLUMNS[name]}) AS last_col FROM {rows}, s"""
            for name, rows in _SHEET_ROWS.items()
        ),
    ),
    "sheet_body": _with(*ALL, body=f"""SELECT 'matrix' AS table_name, destination AS row_label, origin AS entity, {_r('value')} FROM matrix
UNION ALL SELECT 'summary', code, 'value', {_r('value')} FROM summary
UNION ALL SELECT 'outward', code, entity, {_r('value')} FROM outward
UNION ALL SELECT 'inward', code, entity, {_r('value')} FROM inward
UNION ALL SELECT 'internal', code, entity, {_r('value')} FROM internal"""),
    "sheet_totals": ORACLE["reported_totals_long"],
    "files_unchanged": _with(*ALL, """doubled AS (SELECT code, entity, CASE WHEN code = (SELECT min(code) FROM cat) THEN value * 2 ELSE value END AS value FROM inward)""",
        body="""SELECT 'outward' AS file_name, TRUE AS unchanged
UNION ALL SELECT 'inward', NOT EXISTS (SELECT code, entity, value FROM inward EXCEPT SELECT code, entity, value FROM doubled)"""),
    "flow_unresolved": """
WITH x AS (
  SELECT l_extendedprice AS price, p_partkey IS NULL AS part, s_suppkey IS NULL AS supplier, o_orderkey IS NULL AS orders, o_orderkey IS NOT NULL AND c_custkey IS NULL AS customer,
         s_suppkey IS NOT NULL AND so.n_nationkey IS NULL AS origin, c_custkey IS NOT NULL AND cn.n_nationkey IS NULL AS destination
  FROM lineitem LEFT JOIN (SELECT DISTINCT p_partkey FROM part WHERE p_size <= 40) p ON l_partkey = p_partkey
       LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0 LEFT JOIN nation so ON so.n_nationkey = s_nationkey LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey)
SELECT r.reason AS reason, count(*) FILTER (r.missing) AS n_lines, round(CAST(coalesce(sum(CAST(price AS DECIMAL(18,2))) FILTER (r.missing), 0) AS DOUBLE), 2) AS value
FROM (SELECT price, unnest([{'reason': 'part', 'missing': part}, {'reason': 'supplier', 'missing': supplier}, {'reason': 'order', 'missing': orders},
  {'reason': 'customer', 'missing': customer}, {'reason': 'origin', 'missing': origin}, {'reason': 'destination', 'missing': destination}]) AS r FROM x)
GROUP BY r.reason""",
}
