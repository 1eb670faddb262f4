"""The same queries as SQL for DuckDB. Areas of squares are counted in unit cells or worked out by formula."""

from __future__ import annotations

from landcarbon.functions.categories import (
    CATEGORIES,
    CATEGORY_COLUMNS,
    CLASSES,
    CONDITION_COLUMNS,
    CONDITIONS,
    HECTARE_LABELS,
    OUTSIDE_GROUPS,
    PROJECT_AREA,
)
from landcarbon.functions.factors import TOTAL_FACTORS
from landcarbon.operators.attributes import DRAINED_BY_TECHNIQUES, GUESSED_FORESTED, NOT_PROVIDED, WARNING
from standins.inputs import CONDITION_OF_EVENT, MAPPING

CLASS_COLUMNS = [c.column for c in CLASSES]
ALL_CLASSES = [*CLASS_COLUMNS, PROJECT_AREA]


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def doubles(columns: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


LABEL_PARTS = [label.split(" - ") for label in CATEGORIES]


def label_columns(index: str) -> str:
    """Three label columns for a category number from 0; the second is NULL past the last category."""
    names = ("lc_level2", "lc_level3", "condition")
    out = []
    for i, name in enumerate(names):
        other = "NULL" if name == "lc_level3" else "'Unknown'"
        values = listed([p[i] for p in LABEL_PARTS])
        out.append(f"CASE WHEN {index} < {len(LABEL_PARTS)} THEN {values}[CAST({index} AS INT) + 1] ELSE {other} END AS {name}")
    return ", ".join(out)


EVENT_CONDITION = "CASE event_type " + " ".join(
    f"WHEN {text(k)} THEN {text(v)}" for k, v in CONDITION_OF_EVENT.items()
) + " END"

ORD = """ord AS (
  SELECT o_orderkey AS fid, CAST(o_custkey AS VARCHAR) AS grant_id, o_custkey, o_orderstatus, o_orderpriority,
         year(o_orderdate) AS financial_year_end, CAST(o_totalprice AS DECIMAL(20,2)) AS project_area,
         CAST(o_orderpriority[1] AS INT) AS priority
  FROM orders)"""

AREAS = f"""{ORD}, item_index AS (
  SELECT o.fid, o.grant_id, o.financial_year_end, o.project_area, CAST(l_extendedprice AS DECIMAL(12,2)) AS area,
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 10 ELSE 20 END
         + CASE l_linestatus WHEN 'F' THEN 0 ELSE 5 END + o.priority - 1 AS idx
  FROM lineitem JOIN ord o ON o.fid = l_orderkey),
parted AS (SELECT *, {label_columns('idx')} FROM item_index),
areas AS (SELECT *, lc_level2 || ' - ' || lc_level3 || ' - ' || condition AS category FROM parted)"""

DRAFT = f"""{AREAS}, draft0 AS (
  SELECT fid, grant_id, financial_year_end, project_area,
         {", ".join(f"coalesce(sum(area) FILTER (WHERE category = {text(k)}), 0) AS {c}" for k, c in CATEGORIES.items())}
  FROM areas GROUP BY ALL),
draft AS (SELECT *, CAST({" + ".join(CATEGORY_COLUMNS)} - project_area AS DECIMAL(20,2)) AS difference FROM draft0)"""

SHARES = f"""shares AS (
  SELECT user_id, {", ".join(
      f"CAST(count(*) FILTER (WHERE condition = {text(k)}) * 100 // count(*) AS INT) AS {c}" for k, c in CONDITIONS.items()
  )}
  FROM (SELECT user_id, {EVENT_CONDITION} AS condition FROM events) GROUP BY user_id)"""

WIDE = f"""{DRAFT}, {SHARES}, wide AS (
  SELECT d.*, CASE o.o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS forestry,
         {", ".join(f"coalesce(s.{c}, 0) AS {c}" for c in CONDITION_COLUMNS)}
  FROM draft d JOIN ord o USING (fid) LEFT JOIN shares s ON s.user_id = o.o_custkey // 10)"""


def allocated(source: str) -> str:
    splits = ", ".join(
        f"CAST(-difference * (({' + '.join(f'coalesce({m}, 0)' for m in members)}) * 0.01) AS DECIMAL(24,4)) AS {name}"
        for name, members in OUTSIDE_GROUPS.items()
    )
    return f"""split AS (SELECT *, {splits} FROM {source}),
rest AS (SELECT *, CAST(-difference - ({" + ".join(OUTSIDE_GROUPS)}) AS DECIMAL(24,4)) AS unspecified FROM split),
alloc AS (SELECT *,
    CASE WHEN forestry THEN unspecified ELSE 0 END AS unspecified_to_forest,
    CAST(CASE WHEN NOT forestry THEN unspecified * 0.85 ELSE 0 END AS DECIMAL(26,6)) AS unspecified_to_modified,
    CAST(CASE WHEN NOT forestry THEN unspecified * 0.15 ELSE 0 END AS DECIMAL(26,6)) AS unspecified_to_eroding
  FROM rest)"""


ALLOC = f"{WIDE}, {allocated('wide')}"


def class_sums(legacy: bool = False) -> str:
    def part(member: str, weight) -> str:
        scaled = member if weight == 1 else f"{member} * {weight}"
        return f"CAST(coalesce({scaled}, 0) AS DECIMAL(26,6))"

    out, everything = {}, []
    for c in CLASSES:
        terms = [part(m, w) for m, w in c.members.items()]
        everything += terms
        out[c.column] = " + ".join(terms)
        if legacy and c.column == "drained_modified_bog":
            rest = " + ".join(part(m, w) for m, w in c.members.items() if m != "eroded")
            out[c.column] = f"coalesce(CAST(eroded * 0.85 AS DECIMAL(26,6)), {rest})"
    out[PROJECT_AREA] = " + ".join(everything)
    return ", ".join(f"{value} AS {name}" for name, value in out.items())


M2 = f"""{ALLOC}, classes AS (SELECT fid, grant_id, {class_sums()} FROM alloc),
m2 AS (SELECT grant_id, {", ".join(f"sum({c}) AS {c}" for c in ALL_CLASSES)} FROM classes GROUP BY grant_id)"""

YEAR = f"""{ALLOC}, m2 AS (SELECT financial_year_end AS year, {class_sums(legacy=True)} FROM alloc)"""


def hectares(key: str) -> str:
    rounded = ", ".join(f"round(sum({c}) / 10000, 0) AS {c}" for c in ALL_CLASSES)
    return f"ha AS (SELECT {key}, {rounded} FROM m2 GROUP BY {key})"


def emissions(key: str) -> str:
    factors = ", ".join(f"({text(n)}, {a}, {b})" for n, _, a, b in TOTAL_FACTORS)
    pairs = ", ".join(f"({text(HECTARE_LABELS[c])}, {text(a)}, {text(b)})" for c, (a, b) in MAPPING.items())
    branches = " UNION ALL ".join(
        f"SELECT {key}, {text(HECTARE_LABELS[c])} AS category, CAST({c} AS DECIMAL(20,0)) AS area FROM ha" for c in CLASS_COLUMNS
    )
    sums = ", ".join(
        f"sum(area * CAST({side}.{b} AS DECIMAL(12,4))) AS {side}_emissions_{b}" for side in ("pre", "post") for b in ("break1", "break2")
    )
    return f"""{hectares(key)}, long AS ({branches}),
factors(name, break1, break2) AS (VALUES {factors}),
mapping(category, emission_factor_pre, emission_factor_post) AS (VALUES {pairs}),
calcs AS (
  SELECT *, pre_emissions_break1 - post_emissions_break1 AS diff_break1,
         pre_emissions_break2 - post_emissions_break2 AS diff_break2
  FROM (SELECT {key}, emission_factor_pre, emission_factor_post, {sums}
        FROM long JOIN mapping USING (category)
        JOIN factors pre ON pre.name = emission_factor_pre JOIN factors post ON post.name = emission_factor_post
        GROUP BY ALL))"""


MEASURES = [f"{a}_{b}" for a in ("pre_emissions", "post_emissions", "diff") for b in ("break1", "break2")]


def savings(key: str) -> str:
    names = {m: m.replace("emissions", "emission").replace("diff", "savings") for m in MEASURES}
    sums = ", ".join(f"CAST(sum({m}) AS DOUBLE) AS {n}" for m, n in names.items())
    return f"SELECT {key}, {sums} FROM calcs GROUP BY {key}"


BOXES = """boxes AS (
  SELECT o_orderkey AS fid, CAST(o_custkey AS VARCHAR) AS grant_id, year(o_orderdate) AS financial_year_end,
         o_custkey * 13 AS minx, o_orderkey % 1000 AS miny,
         CAST(floor(o_totalprice / 10000) AS BIGINT) + 5 AS w, minx + w AS maxx, miny + w AS maxy
  FROM orders)"""
CELLS = f"""{BOXES}, columns_ AS (SELECT *, unnest(range(minx, maxx)) AS x FROM boxes),
cells AS (SELECT fid, grant_id, financial_year_end, x, unnest(range(miny, maxy)) AS y FROM columns_)"""
ITEMS = """items AS (
  SELECT *, row_number() OVER () AS id FROM (
    SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_partkey * 10.0 AS minx, l_suppkey * 10.0 AS miny,
           l_partkey * 10 + l_quantity AS maxx, l_suppkey * 10 + l_quantity AS maxy
    FROM lineitem))"""
TILES = f"""tile_map AS (
  SELECT l_partkey AS p, l_suppkey AS s, lc_level2 || ' - ' || lc_level3 || ' - ' || condition AS category
  FROM (SELECT *, {label_columns('(l_partkey + l_suppkey) % 30')} FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)))"""
# Whole metres on both sides: a tile is touched from ten metres before a box to its end.
TOUCHED = """touched AS (
  SELECT DISTINCT fid, category FROM boxes JOIN tile_map
  ON p BETWEEN (minx - 1) // 10 AND maxx // 10 AND s BETWEEN (miny - 1) // 10 AND maxy // 10)"""
MEET = "a.minx <= b.maxx AND b.minx <= a.maxx AND a.miny <= b.maxy AND b.miny <= a.maxy"
INTERIORS = MEET.replace("<=", "<")
COVERS = "{b}.minx <= {a}.minx AND {b}.miny <= {a}.miny AND {b}.maxx >= {a}.maxx AND {b}.maxy >= {a}.maxy"
OVERLAPS = f"{INTERIORS} AND NOT ({COVERS.format(a='a', b='b')}) AND NOT ({COVERS.format(a='b', b='a')})"
POINTS = f"""points AS (
  SELECT {EVENT_CONDITION} AS condition, user_id * 130 + event_id % 260 / 2 AS x, event_id * 7 % 1000 AS y FROM events)"""

TECHNIQUES = """tech AS (
  SELECT p_partkey, replace(replace(CASE WHEN p_type <> 'SMALL' THEN replace(p_name, 'ring', 'Access TRACK') END,
         'rod', 'tree felling'), 'gear', 'Stump') AS restoration_technique
  FROM part)"""
SITES = """site_rows AS (
  SELECT l_partkey AS grant_id, CASE WHEN l_suppkey <> 1 THEN CAST(l_suppkey AS VARCHAR) END AS site_id,
         CASE WHEN l_returnflag = 'A' THEN 'A' ELSE 'R' END AS source FROM lineitem),
present AS (SELECT DISTINCT concat(grant_id, '--', site_id) AS k FROM site_rows WHERE source = 'A')"""
MISSING = """SELECT grant_id, site_id, source FROM site_rows
WHERE source = 'R' AND concat(grant_id, '--', site_id) NOT IN (SELECT k FROM present)"""
FEATURES = """features AS (
  SELECT l_orderkey AS centroid, CAST(l_suppkey AS VARCHAR) AS id FROM lineitem GROUP BY ALL),
joined_ids AS (SELECT centroid, string_agg(id, ',' ORDER BY id) AS grant_id FROM features GROUP BY centroid),
attrs AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_nationkey > 4 THEN s_name || '/' || s_nationkey END AS name
  FROM supplier)"""
ATTRS = """attrs0 AS (
  SELECT p_partkey, CASE WHEN p_size > 10 THEN split_part(p_name, ' ', 1) END AS c0, p_name, p_type, p_brand FROM part),
attrs AS (
  SELECT p_partkey,
         CASE WHEN p_name = 'red ring' THEN 'Old FOREST edge' WHEN c0 = 'hot' THEN 'Yes' WHEN c0 = 'old' THEN 'Y' ELSE c0 END AS cond,
         CASE WHEN p_type = 'PROMO' THEN 'Forestry' ELSE p_type END AS use,
         CASE p_brand WHEN 'Brand#2' THEN 'dams, ditch blocking' WHEN 'Brand#3' THEN 'tree felling' END AS techniques
  FROM attrs0),
flagged AS (
  SELECT *, coalesce(cond ILIKE '%forest%', false) OR coalesce(use ILIKE '%forest%', false)
            OR coalesce(regexp_matches(techniques, 'forest|stump|tree|smooth|mulching|regen|furrow|felling|scrub'), false) AS forestry
  FROM attrs)"""
CHANGES = """all_rows AS (
  SELECT o_orderkey AS fid, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS VARCHAR) END AS grant_id,
         o_custkey || '-' || o_orderpriority AS centroid, year(o_orderdate) AS fy FROM orders),
prev AS (SELECT grant_id, centroid FROM all_rows WHERE fy < 1997 AND grant_id IS NOT NULL)"""


# Two runs of orders by (customer, priority), and the status of each key by comparing its rows as sorted lists.
KEYED = """base AS (
  SELECT CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS customer, o_orderpriority[1] AS priority, o_orderkey,
         CAST(year(o_orderdate) AS INT) AS year, CAST(o_totalprice AS DECIMAL(20,2)) AS price FROM orders),
early AS (SELECT * FROM base WHERE year > 1992),
late AS (SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN price END AS price) FROM base WHERE year % 2 = 0 OR o_orderkey % 11 > 3),
a AS (SELECT customer, priority, count(*) AS n, list_sort(list({'k': o_orderkey, 'y': year, 'p': price})) AS r FROM early GROUP BY ALL),
b AS (SELECT customer, priority, count(*) AS n, list_sort(list({'k': o_orderkey, 'y': year, 'p': price})) AS r FROM late GROUP BY ALL),
compared AS (
  SELECT coalesce(a.customer, b.customer) AS customer, coalesce(a.priority, b.priority) AS priority,
         CASE WHEN a.n IS NULL THEN 'new' WHEN b.n IS NULL THEN 'gone' WHEN a.r IS NOT DISTINCT FROM b.r THEN 'same' ELSE 'changed' END AS status,
         coalesce(a.n, 0) AS n_before, coalesce(b.n, 0) AS n_after
  FROM a FULL JOIN b ON a.customer IS NOT DISTINCT FROM b.customer AND a.priority = b.priority)"""


def grid_reference(x: str, y: str, digits: int) -> str:
    half = digits // 2
    e, n = f"({x} // 100000)", f"({y} // 100000)"
    letters = "'ABCDEFGHJKLMNOPQRSTUVWXYZ'"
    first = f"(19 - {n}) - (19 - {n}) % 5 + ({e} + 10) // 5"
    second = f"((19 - {n}) * 5) % 25 + {e} % 5"
    figures = "".join(f" || lpad(CAST(({v} % 100000) // {10 ** (5 - half)} AS VARCHAR), {half}, '0')" for v in (x, y))
    inside = f"{e} >= 0 AND {e} < 7 AND {n} >= 0 AND {n} < 13"
    return f"CASE WHEN {inside} THEN substr({letters}, CAST({first} + 1 AS INT), 1) || substr({letters}, CAST({second} + 1 AS INT), 1){figures} END"


# What is left of a row of squares: x from and to, counted from the plot's corner. On plots without a map all squares stay.
PLOTS = """plots AS (
  SELECT o_orderkey AS fid, o_orderstatus AS status, CAST(o_orderpriority[1] AS INT) AS priority, year(o_orderdate) AS year,
         o_orderkey % 1000 * 250 AS x, o_orderkey // 1000 * 250 AS y, CAST(floor(o_totalprice / 10000) AS BIGINT) * 2 + 6 AS w
  FROM orders),
pieces AS (
  SELECT *, CASE WHEN status = 'F' THEN fid || 'a,' || fid || 'b' ELSE fid || 'a' END AS grant_id,
         0 AS x0, CASE WHEN status = 'O' THEN w // 2 ELSE w END AS x1, 0 AS later FROM plots
  UNION ALL SELECT *, fid || 'c', CASE WHEN status = 'F' THEN w ELSE w // 2 END,
         CASE WHEN status = 'F' THEN w ELSE w // 2 END + w, 1 FROM plots WHERE status IN ('F', 'O'))"""

POLYGON_32 = "16 * {r} * {r} * sin(2 * pi() / 32)"
X, Y = "(o_custkey * 397 + 1000)", "(fid * 83 + 2000)"
USE_CODES = listed(["5,4", "x 5,4", "1,3,4", "3,4,1 y", "4", "1,4", "1,2", "14", "5,4,1,4"])
USE = f"{USE_CODES}[CAST(fid % 9 AS INT) + 1]"
for _old, _new in (("5,4", "Forestry"), ("1,3,4", ""), ("3,4,1", ""), ("1,4", ""), ("1,", "")):
    USE = f"replace({USE}, '{_old}', '{_new}')"

ORACLE: dict[str, str] = {
    "category_area": f"WITH {AREAS} SELECT fid, category, CAST(sum(area) AS DOUBLE) AS category_area FROM areas GROUP BY ALL",
    "category_label": f"WITH {AREAS} SELECT lc_level2, lc_level3, condition, category, CAST(sum(area) AS DOUBLE) AS area FROM areas GROUP BY ALL",
    "pivoted_categories": f"WITH {DRAFT} SELECT fid, grant_id, {doubles(CATEGORY_COLUMNS)} FROM draft",
    "category_difference": f"WITH {DRAFT} SELECT fid, {doubles(['project_area', 'difference'])} FROM draft",
    "outside_map_split": f"WITH {ALLOC} SELECT fid, {doubles(list(OUTSIDE_GROUPS))} FROM alloc",
    "unspecified_allocation": f"""WITH {ALLOC} SELECT fid, {doubles(
        ['unspecified', 'unspecified_to_forest', 'unspecified_to_modified', 'unspecified_to_eroding'])} FROM alloc""",
    "report_classes": f"WITH {M2} SELECT fid, {doubles(ALL_CLASSES)} FROM classes",
    "report_classes_exact": f"WITH {M2} SELECT fid, {doubles(ALL_CLASSES)} FROM classes",
    "report_classes_legacy": f"""WITH {WIDE}, unmapped AS (
      SELECT * REPLACE ({", ".join(f"CASE WHEN {' + '.join(CATEGORY_COLUMNS)} <> 0 THEN {c} END AS {c}" for c in CATEGORY_COLUMNS)})
      FROM wide), {allocated('unmapped')}, classes AS (SELECT fid, {class_sums(legacy=True)} FROM alloc)
      SELECT fid, {doubles(ALL_CLASSES)} FROM classes""",
    "rollup_m2_by_grant": f"WITH {M2} SELECT grant_id, {doubles(ALL_CLASSES)} FROM m2",
    "rollup_ha_by_grant": f"WITH {M2}, {hectares('grant_id')} SELECT grant_id, {doubles(ALL_CLASSES)} FROM ha",
    "rollup_ha_by_year": f"WITH {YEAR}, {hectares('year')} SELECT CAST(year AS INT) AS year, {doubles(ALL_CLASSES)} FROM ha",
    "unpivot_classes": f"WITH {M2}, {emissions('grant_id')} SELECT grant_id, category, CAST(area AS DOUBLE) AS area FROM long",
    "emission_calcs": f"""WITH {M2}, {emissions('grant_id')}
      SELECT grant_id, emission_factor_pre, emission_factor_post, {doubles(MEASURES)} FROM calcs""",
    "emission_calcs_by_year": f"""WITH {YEAR}, {emissions('year')}
      SELECT CAST(year AS INT) AS year, emission_factor_pre, emission_factor_post, {doubles(MEASURES)} FROM calcs""",
    "savings_by_grant": f"WITH {M2}, {emissions('grant_id')} {savings('grant_id')}",
    "savings_by_year": f"WITH {YEAR}, {emissions('year')} {savings('year')}",
    "factor_fanout": f"""WITH {M2}, {emissions('grant_id')}
      SELECT category, emission_factor_pre, emission_factor_post, count(*) AS n
      FROM mapping JOIN factors pre ON pre.name = emission_factor_pre JOIN factors post ON post.name = emission_factor_post
      WHERE category IN (SELECT category FROM long WHERE area <> 0) GROUP BY ALL HAVING count(*) > 1""",
    "condition_share_int": f"WITH {SHARES} SELECT * FROM shares",
    "condition_share_exact": f"""SELECT user_id, {", ".join(
        f"round(count(*) FILTER (WHERE condition = {text(k)}) * 100.0 / count(*), 6) AS {c}" for k, c in CONDITIONS.items())}
      FROM (SELECT user_id, {EVENT_CONDITION} AS condition FROM events) GROUP BY user_id""",
    "sliver_filter": """SELECT project_area, count(*) AS n
      FROM (SELECT CASE WHEN l_quantity <> 50 THEN l_quantity * 10 END AS project_area FROM lineitem)
      WHERE project_area >= 133 OR project_area IS NULL GROUP BY ALL""",
    "qc_totals": f"""WITH {ORD} SELECT CAST(CAST(round(sum(project_area), -2) / 10000 AS DECIMAL(20,2)) AS DOUBLE) AS total_ha,
      count(*) AS n_rows FROM ord""",
    "eligible_grants": f"""WITH {ORD} SELECT fid, grant_id FROM ord
      WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) > 2000)""",
    "not_track_filter": f"WITH {TECHNIQUES} SELECT * FROM tech WHERE restoration_technique NOT ILIKE '%Track%'",
    "stem_match": f"""WITH {TECHNIQUES} SELECT * FROM tech
      WHERE regexp_matches(restoration_technique, 'forest|stump|tree|smooth|mulching|regen|furrow|felling|scrub')""",
    "priority_sources": f"""WITH {ORD} SELECT DISTINCT grant_id, o_orderpriority FROM ord WHERE o_orderstatus = 'F'
      UNION SELECT grant_id, o_orderpriority FROM ord
        WHERE o_orderstatus = 'O' AND grant_id NOT IN (SELECT grant_id FROM ord WHERE o_orderstatus = 'F')
      UNION SELECT grant_id, o_orderpriority FROM ord
        WHERE o_orderstatus = 'P' AND grant_id NOT IN (SELECT grant_id FROM ord WHERE o_orderstatus IN ('F', 'O'))""",
    "null_aware_not_in": f"""WITH {ORD}, rows_ AS (SELECT fid, CASE WHEN priority <> 1 THEN grant_id END AS grant_id FROM ord)
      SELECT fid, 'known' AS list FROM rows_
        WHERE grant_id NOT IN (SELECT grant_id FROM ord WHERE financial_year_end >= 2001 AND priority = 2)
      UNION ALL SELECT fid, 'holds_null' FROM rows_ WHERE grant_id NOT IN (SELECT grant_id FROM rows_)
      UNION ALL SELECT fid, 'empty' FROM rows_ WHERE grant_id NOT IN (SELECT grant_id FROM rows_ WHERE fid IS NULL)""",
    "composite_not_in": f"WITH {SITES} {MISSING}",
    "append_missing": f"WITH {SITES} SELECT grant_id, site_id, source FROM site_rows WHERE source = 'A' UNION ALL {MISSING}",
    "enrich_by_key": f"""WITH {ORD}, firsts AS (
        SELECT grant_id, financial_year_end, o_orderpriority AS project_name,
               row_number() OVER (PARTITION BY grant_id ORDER BY financial_year_end, o_orderpriority) AS k FROM ord)
      SELECT CAST(c_custkey AS VARCHAR) AS grant_id, c_mktsegment, CAST(financial_year_end AS INT) AS financial_year_end, project_name
      FROM customer LEFT JOIN firsts ON grant_id = CAST(c_custkey AS VARCHAR) AND k = 1""",
    "enrich_by_id_list": f"""WITH {FEATURES}, named AS (
        SELECT centroid, string_agg(DISTINCT name, ',' ORDER BY name) AS project_name FROM features JOIN attrs USING (id) GROUP BY centroid)
      SELECT centroid, grant_id, project_name FROM joined_ids LEFT JOIN named USING (centroid)""",
    "first_id_fallback": f"""WITH {FEATURES}
      SELECT centroid, grant_id, name AS project_name FROM joined_ids LEFT JOIN attrs ON id = split_part(grant_id, ',', 1)""",
    "fy_range": """SELECT l_partkey AS centroid, CAST(min(year(o_orderdate)) AS INT) AS from_year, CAST(max(year(o_orderdate)) AS INT) AS to_year
      FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY l_partkey""",
    "max_fy": f"WITH {ORD} SELECT grant_id, CAST(max(financial_year_end) AS INT) AS financial_year_end FROM ord GROUP BY grant_id",
    "technique_list": """SELECT grant_id, string_agg(DISTINCT technique, ', ' ORDER BY technique) AS techniques
      FROM (SELECT l_orderkey AS grant_id, CASE WHEN p_brand = 'Brand#1' THEN p_type ELSE p_name END AS technique
            FROM lineitem JOIN part ON p_partkey = l_partkey) GROUP BY grant_id""",
    "clean_use_codes": f"""WITH {ORD} SELECT fid, CASE WHEN u = '4' THEN 'Deer Management' ELSE u END AS pa_current_use
      FROM (SELECT fid, {USE} AS u FROM ord)""",
    "forestry_flag": f"""WITH {ATTRS} SELECT p_partkey, forestry, coalesce(cond ILIKE '%forest%', false) AS forestry_by_name FROM flagged""",
    "fix_conditions": f"""WITH {ATTRS} SELECT p_partkey,
        CASE WHEN c2 IN ('Yes', 'Y') THEN 'Not provided' ELSE c2 END AS pa_condition_category
      FROM (SELECT p_partkey, CASE WHEN techniques = 'dams, ditch blocking' THEN 'Drained'
                                   WHEN cond IS NULL AND forestry THEN 'Forested previously forested' ELSE cond END AS c2 FROM flagged)""",
    "text_or_notes_clean": r"""WITH t AS (
        SELECT p_partkey, CASE WHEN p_size > 25 THEN 'OTHER: ' ELSE '' END || p_name || ' (""' || p_type || ';^' || p_brand || '), ok!' AS txt,
               CASE WHEN p_size <> 30 THEN p_type END AS notes FROM part),
      c AS (SELECT *, regexp_replace(txt, '[^\w\s^,]', '', 'g') AS clean FROM t)
      SELECT p_partkey, CASE WHEN txt ILIKE '%Other%' THEN clean || ' - ' || notes ELSE clean END AS current_use FROM c""",
    "warnings": f"""WITH {FEATURES} SELECT centroid, grant_id,
        CASE WHEN s_suppkey IS NOT NULL THEN 'It could contain boundaries derived from point centroids or site boundaries instead of the restoration footprint' END AS warning
      FROM joined_ids LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = grant_id AND s_acctbal > 2000""",
    "changes_since_snapshot": f"""WITH {CHANGES}, flagged AS (
        SELECT fid, grant_id, centroid, CASE WHEN grant_id IN (SELECT grant_id FROM prev) THEN false
               WHEN grant_id NOT IN (SELECT grant_id FROM prev) THEN true END AS new_site
        FROM all_rows WHERE fy >= 1997)
      SELECT fid, grant_id, centroid, CAST(new_site AS VARCHAR) AS new_site,
             coalesce(NOT new_site AND centroid NOT IN (SELECT centroid FROM prev), false) AS changed FROM flagged""",
    "changed_keys": f"WITH {KEYED} SELECT * FROM compared",
    "rows_of_changed_keys": f"""WITH {KEYED} SELECT late.* FROM late JOIN compared c
      ON late.customer IS NOT DISTINCT FROM c.customer AND late.priority = c.priority WHERE status IN ('new', 'changed')""",
    "newest_snapshot": f"""WITH {ORD} SELECT fid, grant_id, CAST(financial_year_end AS INT) AS financial_year_end
      FROM ord WHERE financial_year_end >= 2000""",
    "snapshot_runs": f"""WITH {ORD}, counted AS (
        SELECT '20240904' AS run, count(*) AS n, sum(fid) AS fids FROM ord WHERE financial_year_end < 2000
        UNION ALL SELECT '20251212_083000', count(*), sum(fid) FROM ord WHERE financial_year_end >= 2000)
      SELECT run, n, CAST(fids AS BIGINT) AS fids FROM counted
      UNION ALL SELECT '20260101', NULL, NULL UNION ALL SELECT 'newest', NULL, NULL""",
    "recreated_table": f"""WITH {ORD} SELECT fid, grant_id, CAST(financial_year_end AS INT) AS financial_year_end
      FROM ord WHERE financial_year_end >= 2000""",
    "grid_references": f"""WITH {ORD} SELECT fid, {", ".join(f"{grid_reference(X, Y, n)} AS ref_{n}" for n in (10, 6, 2))} FROM ord""",
    "box_area": f"WITH {ITEMS} SELECT (maxx - minx) * (maxy - miny) AS project_area, count(*) AS n FROM items GROUP BY ALL",
    "circle_radius": "SELECT round(sqrt(l_quantity * 10000 / 3.14), 6) AS radius, count(*) AS n FROM lineitem GROUP BY ALL",
    "point_buffer_area": f"""SELECT condition, round({POLYGON_32.format(r=30)}, 4) AS area, count(*) AS n
      FROM (SELECT {EVENT_CONDITION} AS condition FROM events) GROUP BY ALL""",
    "conditional_buffer": f"""WITH {BOXES}, d AS (
        SELECT b.fid, w, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 30 END AS r FROM boxes b JOIN orders o ON o_orderkey = b.fid)
      SELECT fid, round(w * w + 4 * r * w + {POLYGON_32.format(r='r')}, 3) AS area FROM d""",
    "geometry_types": """SELECT geom_type, sum(n)::BIGINT AS n FROM (
        SELECT 'Polygon' AS geom_type, count(*) AS n FROM orders
        UNION ALL SELECT 'MultiPolygon', count(DISTINCT o_custkey) FROM orders
        UNION ALL SELECT 'Point', count(*) FROM events) GROUP BY geom_type""",
    "explode_parts": f"WITH {BOXES} SELECT grant_id, count(*) AS n, CAST(sum(w * w) AS DOUBLE) AS area FROM boxes GROUP BY grant_id",
    "box_clip_area": f"""WITH {CELLS}, {TILES}, {TOUCHED},
      clipped AS (SELECT fid, category, count(*) AS area FROM cells JOIN tile_map ON p = x // 10 AND s = y // 10 GROUP BY ALL)
      SELECT t.fid, t.category, CAST(coalesce(area, 0) AS DOUBLE) AS category_area
      FROM touched t LEFT JOIN clipped c ON c.fid = t.fid AND c.category IS NOT DISTINCT FROM t.category""",
    "clip_report": f"""WITH {CELLS}, {TILES}, {TOUCHED}, met AS (SELECT DISTINCT fid FROM touched),
      clipped AS (SELECT fid, category, count(*) AS area FROM cells JOIN tile_map ON p = x // 10 AND s = y // 10 GROUP BY ALL)
      SELECT DISTINCT grant_id, {doubles(['minx', 'miny', 'maxx', 'maxy'])}, CAST(w * w AS DOUBLE) AS project_area,
             {", ".join(f"CAST(coalesce(max(area) FILTER (WHERE category = {text(k)}), 0) AS DOUBLE) AS {c}" for k, c in CATEGORIES.items())}
      FROM boxes JOIN met USING (fid) LEFT JOIN clipped USING (fid) GROUP BY fid, grant_id, minx, miny, maxx, maxy, w""",
    "unmapped_boxes": f"""WITH {BOXES}, {ITEMS} SELECT fid, grant_id FROM boxes a
      WHERE NOT EXISTS (SELECT 1 FROM items b WHERE {MEET})""",
    "points_in_boxes": f"""WITH {BOXES}, {POINTS}, inside AS (
        SELECT fid, condition, true AS found FROM boxes JOIN points ON x > minx AND x < maxx AND y > miny AND y < maxy)
      SELECT fid, {", ".join(
        f"CAST(count(*) FILTER (WHERE condition = {text(k)}) * 100 // count(*) AS INT) AS {c}" for k, c in CONDITIONS.items())}
      FROM boxes LEFT JOIN inside USING (fid) GROUP BY fid""",
    "intersecting_boxes": f"""WITH {BOXES} SELECT a.fid, count(*) AS n FROM boxes a JOIN boxes b ON {MEET} AND a.fid <> b.fid GROUP BY a.fid""",
    "covered_boxes": f"""WITH {ITEMS} SELECT l_orderkey, l_linenumber, {doubles(['minx', 'miny', 'maxx', 'maxy'])} FROM items a
      WHERE NOT EXISTS (SELECT 1 FROM items b WHERE {COVERS.format(a='a', b='b')} AND a.id <> b.id)""",
    "overlap_flag": f"""WITH {BOXES}, hits AS (
        SELECT a.fid, bool_or(a.financial_year_end = b.financial_year_end) AS same FROM boxes a JOIN boxes b ON {OVERLAPS} GROUP BY a.fid)
      SELECT fid, CAST(CASE WHEN same IS NULL THEN 0 WHEN same THEN 1 END AS DOUBLE) AS overlap FROM boxes LEFT JOIN hits USING (fid)""",
    "overlap_flag_any": f"""WITH {BOXES}, hits AS (SELECT DISTINCT a.fid FROM boxes a JOIN boxes b ON {OVERLAPS})
      SELECT fid, CAST(CASE WHEN fid IN (SELECT fid FROM hits) THEN 1 ELSE 0 END AS SMALLINT) AS overlap FROM boxes""",
    "equal_boxes": f"WITH {ITEMS} SELECT DISTINCT {doubles(['minx', 'miny', 'maxx', 'maxy'])}, CAST(1 AS BIGINT) AS n FROM items",
    "dissolve_boxes": f"WITH {CELLS} SELECT grant_id, CAST(count(DISTINCT (x, y)) AS DOUBLE) AS area FROM cells GROUP BY grant_id",
    "dissolve_by_year": f"""WITH {CELLS} SELECT CAST(financial_year_end AS INT) AS financial_year_end, CAST(count(DISTINCT (x, y)) AS DOUBLE) AS area
      FROM cells GROUP BY financial_year_end""",
    "priority_subtract": f"""WITH {CELLS}, last AS (SELECT x, y, max(financial_year_end) AS fy FROM cells GROUP BY x, y)
      SELECT grant_id, CAST(financial_year_end AS INT) AS financial_year_end,
             CAST(sum(CASE WHEN fy <= financial_year_end THEN 1 ELSE 0 END) AS DOUBLE) AS area
      FROM cells JOIN last USING (x, y) GROUP BY grant_id, financial_year_end""",
    # The representative point of a square is its centre. Parts are linked by common ground or a common border.
    "overlap_dissolve": f"""WITH RECURSIVE {CELLS}, hits AS (
        SELECT a.fid, bool_or(a.financial_year_end = b.financial_year_end) AS same FROM boxes a JOIN boxes b ON {OVERLAPS} GROUP BY a.fid),
      flagged AS (SELECT * FROM boxes WHERE fid IN (SELECT fid FROM hits WHERE same)),
      edges AS (SELECT a.fid AS a, b.fid AS b FROM flagged a JOIN flagged b
        ON a.financial_year_end = b.financial_year_end AND {MEET}
           AND (least(a.maxx, b.maxx) > greatest(a.minx, b.minx) OR least(a.maxy, b.maxy) > greatest(a.miny, b.miny))),
      reach(fid, root) AS (
        SELECT fid, fid FROM flagged UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.fid),
      part AS (SELECT fid, min(root) AS part FROM reach GROUP BY fid),
      members AS (SELECT * FROM flagged JOIN part USING (fid)),
      found AS (SELECT DISTINCT m.part, p.grant_id FROM members m JOIN flagged p
        ON p.minx + p.w / 2 BETWEEN m.minx AND m.maxx AND p.miny + p.w / 2 BETWEEN m.miny AND m.maxy),
      ground AS (SELECT part, count(DISTINCT (x, y)) AS area FROM cells JOIN part USING (fid) GROUP BY part),
      named AS (SELECT part, string_agg(grant_id, ',' ORDER BY grant_id) AS grant_id FROM found GROUP BY part)
      SELECT grant_id, CAST(financial_year_end AS INT) AS financial_year_end, CAST(area AS DOUBLE) AS area
      FROM named JOIN ground USING (part) JOIN (SELECT DISTINCT part, financial_year_end FROM members) USING (part)
      UNION ALL SELECT grant_id, CAST(financial_year_end AS INT), CAST(w * w AS DOUBLE) FROM boxes
      WHERE fid NOT IN (SELECT fid FROM flagged)""",
    "footprint_by_grant": f"""WITH {CELLS} SELECT grant_id, CAST(financial_year_end AS VARCHAR) AS site_id, CAST(count(DISTINCT (x, y)) AS DOUBLE) AS area
      FROM cells GROUP BY grant_id, financial_year_end""",
    "resolved_plots": f"""WITH {PLOTS} SELECT grant_id, count(*) AS n, CAST(sum((x1 - x0) * w) AS DOUBLE) AS area
      FROM pieces GROUP BY grant_id""",
}


def ground(areas: str) -> str:
    """Sum per category from rows (category, area)."""
    return ", ".join(f"coalesce(sum({areas}) FILTER (WHERE category = {text(k)}), 0) AS {c}" for k, c in CATEGORIES.items())


# Boxes of one grant that are equal are one row; boxes below 33 square metres are left out.
APPLICATION = f"""{CELLS}, {TILES}, {TOUCHED}, {POINTS}, met AS (SELECT DISTINCT fid FROM touched),
work AS (SELECT grant_id, minx, miny, w, min(fid) AS fid FROM boxes JOIN met USING (fid) WHERE w * w >= 33 GROUP BY ALL),
clipped AS (SELECT fid, category, count(*) AS area FROM cells JOIN tile_map ON p = x // 10 AND s = y // 10 GROUP BY ALL),
mapped AS (SELECT fid, {ground('area')} FROM work LEFT JOIN clipped USING (fid) GROUP BY fid),
inside AS (SELECT fid, condition FROM work JOIN points ON x > minx AND x < minx + w AND y > miny AND y < miny + w),
shared AS (SELECT fid, {", ".join(
    f"count(*) FILTER (WHERE condition = {text(k)}) * 100.0 / count(*) AS {c}" for k, c in CONDITIONS.items())} FROM inside GROUP BY fid),
years AS (SELECT grant_id, min(financial_year_end) AS financial_year_end FROM boxes GROUP BY grant_id),
wide AS (
  SELECT w.grant_id, w.minx, w.miny, w.minx + w AS maxx, w.miny + w AS maxy, CAST(w * w AS DECIMAL(20,2)) AS project_area,
         {", ".join(CATEGORY_COLUMNS)}, CAST({" + ".join(CATEGORY_COLUMNS)} - w * w AS DECIMAL(20,2)) AS difference,
         CASE CAST(w.grant_id AS BIGINT) % 3 WHEN 0 THEN 'Old Forest' WHEN 1 THEN 'Moor' END AS project_name,
         CAST(financial_year_end AS INT) AS financial_year_end, CAST(w.grant_id AS BIGINT) % 3 = 0 AS forestry,
         '2025-12-12' AS version, {", ".join(f"coalesce({c}, 0) AS {c}" for c in CONDITION_COLUMNS)},
         CAST(floor(minx + w / 2) AS BIGINT) AS cx, CAST(floor(miny + w / 2) AS BIGINT) AS cy
  FROM work w JOIN mapped USING (fid) JOIN years USING (grant_id) LEFT JOIN shared USING (fid))"""
ORACLE["application_report"] = f"""WITH {APPLICATION}
  SELECT grant_id, {doubles(['minx', 'miny', 'maxx', 'maxy', 'project_area', 'difference', *CATEGORY_COLUMNS])},
         {", ".join(f"round({c}, 6) AS {c}" for c in CONDITION_COLUMNS)},
         project_name, financial_year_end, forestry, version, {grid_reference('cx', 'cy', 10)} AS centroid
  FROM wide"""
PUBLISHED = f"""{APPLICATION}, {allocated('wide')}, classes AS (SELECT grant_id, {class_sums()} FROM alloc),
m2 AS (SELECT grant_id, {", ".join(f"sum({c}) AS {c}" for c in ALL_CLASSES)} FROM classes GROUP BY grant_id)"""
ORACLE["published_savings"] = f"WITH {PUBLISHED}, {emissions('grant_id')} {savings('grant_id')}"

# Attributes of a row follow from the squares in it: only square a has uses, conditions and techniques.
_SHARE = {c: 50 for k, c in CONDITIONS.items() if k in ("Modified", "Drained: Hagg/gully")}
FINAL = f"""{PLOTS}, shapes AS (
  SELECT * EXCLUDE (later), year + later AS fy, true AS mapped, grant_id LIKE '%a%' AS has_a, grant_id LIKE '%b' AS has_b,
         CAST((x1 - x0) * w AS DOUBLE) AS size FROM pieces WHERE fid % 5 > 0
  UNION ALL SELECT *, 0, w, year, false, true, false, w * w FROM (SELECT *, fid || 'a' FROM plots WHERE fid % 5 = 0)
  UNION ALL SELECT *, w // 2, w // 2 + w, year, false, false, true, w * w FROM (SELECT *, fid || 'b' FROM plots WHERE fid % 5 = 0 AND status = 'F')
  UNION ALL SELECT *, w // 2, w // 2 + w, year + 1, false, false, false, w * w FROM (SELECT *, fid || 'c' FROM plots WHERE fid % 5 = 0 AND status = 'O')
  UNION ALL SELECT *, w, w * 2, year + 1, false, false, false, w * w FROM (SELECT *, fid || 'c' FROM plots WHERE fid % 5 = 0 AND status = 'F')
  UNION ALL SELECT *, 0, 0, NULL, false, false, false, 16 * (fid % 5 * 100 / 3.14) * sin(2 * pi() / 32)
    FROM (SELECT *, fid || 'd' FROM plots WHERE fid % 5 > 0 AND status = 'P' AND priority <= 3)),
strips AS (
  SELECT *, CASE WHEN mapped THEN greatest(least(x1, w // 2) - x0, 0) * w END AS first_strip,
         CASE WHEN mapped THEN greatest(x1 - greatest(x0, w // 2), 0) * w END AS second_strip FROM shapes WHERE round(size, 2) >= 33),
areas AS (SELECT *, {", ".join(
    f"CASE WHEN mapped THEN CASE {i} WHEN fid % 30 THEN first_strip WHEN (fid + 7) % 30 THEN second_strip ELSE 0 END END AS {c}"
    for i, c in enumerate(CATEGORIES.values()))} FROM strips),
told AS (
  SELECT *, x1 = 0 AS circle, nullif(concat_ws(',', CASE WHEN has_b AND fid % 2 = 0 THEN 'B' || priority END,
                           CASE WHEN has_a AND priority <> 5 THEN 'P' || priority END), '') AS project_name,
         CASE WHEN x1 = 0 THEN 'grouse' WHEN has_a AND fid % 4 = 0 THEN 'Forestry' WHEN has_a THEN 'grazing' END AS pa_current_use,
         CASE WHEN x1 = 0 OR has_a AND priority = 1 THEN 'Yes' WHEN has_a AND priority = 2 THEN 'Old forest' END AS cond,
         CASE WHEN has_a AND fid % 3 = 0 THEN {text(DRAINED_BY_TECHNIQUES[0])} WHEN has_a AND fid % 3 = 1 THEN 'tree felling' END AS techniques
  FROM areas),
signs AS (
  SELECT *, coalesce(cond = 'Old forest', false) OR coalesce(pa_current_use = 'Forestry', false)
            OR coalesce(techniques = 'tree felling', false) AS forestry,
         CAST(floor(CASE WHEN circle THEN x + 60 ELSE x + (x0 + x1) / 2 END) AS BIGINT) AS cx,
         CAST(floor(CASE WHEN circle THEN y + 160 ELSE y + w / 2 END) AS BIGINT) AS cy
  FROM told)"""
ORACLE["final_report"] = f"""WITH {FINAL}
  SELECT grant_id, round(size, 2) AS project_area, {doubles(CATEGORY_COLUMNS)},
         CAST(CAST({" + ".join(f"coalesce({c}, 0)" for c in CATEGORY_COLUMNS)} - round(size, 2) AS DECIMAL(20,2)) AS DOUBLE) AS difference,
         project_name, pa_current_use, techniques, forestry, CAST(fy AS DOUBLE) AS financial_year_end, '2025-12-12' AS version,
         CASE WHEN techniques = {text(DRAINED_BY_TECHNIQUES[0])} THEN {text(DRAINED_BY_TECHNIQUES[1])}
              WHEN cond = 'Yes' THEN {text(NOT_PROVIDED[1])}
              WHEN cond IS NULL AND forestry THEN {text(GUESSED_FORESTED)} ELSE cond END AS pa_condition_category,
         {", ".join(f"CAST(CASE WHEN has_a AND fid % 2 = 0 THEN {_SHARE.get(c, 0)} ELSE 0 END AS DOUBLE) AS {c}" for c in CONDITION_COLUMNS)},
         CASE WHEN circle THEN {grid_reference('cx', 'cy', 6)} ELSE {grid_reference('cx', 'cy', 10)} END AS centroid,
         CASE WHEN circle OR (status = 'P' AND priority <= 3 AND fid % 5 > 0) THEN {text(WARNING)} END AS warning,
         CAST(NOT (grant_id = fid || 'a' AND fid % 3 = 0) AS VARCHAR) AS new_site, grant_id = fid || 'a' AND fid % 3 = 0 AS changed
  FROM signs"""


# Widening all shapes of a row by r is the same as widening their union by r.
def row_area(length: str, height: str, r: str) -> str:
    return f"({length}) * ({height}) + 2 * {r} * (({length}) + ({height})) + {POLYGON_32.format(r=r)}"


def footprint_area(r: str, bare: bool) -> str:
    line, square = row_area("2 * w", "0", r), row_area("w + w // 2", "w", r)
    areas = f"CASE WHEN fid % 3 = 0 THEN (w + w // 2) * w ELSE {square} END"
    total = f"{line} + {POLYGON_32.format(r=r)} + {areas} + (w + w // 2) * w"
    return f"{total} + {square}" if bare else total


ORACLE["application_footprint"] = f"""WITH {PLOTS} SELECT CAST(fid AS VARCHAR) AS grant_id, status AS site_id,
    CAST(5 AS BIGINT) AS n, round({footprint_area('30', bare=True)}, 2) AS area FROM plots WHERE year > 1998"""
ORACLE["final_footprint"] = f"""WITH {PLOTS} SELECT CAST(fid AS VARCHAR) AS grant_id, status AS site_id,
    CAST(4 AS BIGINT) AS n, round({footprint_area('50', bare=False)}, 2) AS area FROM plots
  UNION ALL SELECT CAST(fid AS VARCHAR), 'old', 1, w * w FROM plots"""
ORACLE["savings_from_files"] = f"SELECT *, 't CO2e ha-1 yr-1' AS unit FROM ({ORACLE['savings_by_grant']})"
ORACLE["source_tables"] = f"""WITH {BOXES} SELECT 'map' AS source, what, count(*) AS n, CAST(count(*) * 100 AS DOUBLE) AS area
    FROM (SELECT lc_level3 AS what FROM (SELECT {label_columns('(l_partkey + l_suppkey) % 30')}
      FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))) GROUP BY what
  UNION ALL SELECT 'points', {EVENT_CONDITION} AS condition, count(*), 0 FROM events GROUP BY condition
  UNION ALL SELECT 'projects', CAST(fid AS VARCHAR)[1] AS first, count(*), sum(w * w) FROM boxes GROUP BY first"""
ORACLE["uses_and_conditions"] = f"""WITH {PLOTS} SELECT DISTINCT * FROM (
    SELECT fid || 'a' AS grant_id, 'use' AS kind, CASE WHEN fid % 4 = 0 THEN '5,4' ELSE 'grazing' END AS value FROM plots
    UNION ALL SELECT fid || 'a', 'condition', CASE priority WHEN 1 THEN 'Yes' WHEN 2 THEN 'Old forest' END FROM plots
    UNION ALL SELECT fid || 'a', unnest(['use', 'condition']), NULL FROM plots WHERE status = 'P'
    UNION ALL SELECT fid || 'd', unnest(['use', 'condition']), unnest(['grouse', 'Yes']) FROM plots WHERE status = 'P')"""
ORACLE["equal_shapes"] = f"""WITH {PLOTS} SELECT CAST(fid AS VARCHAR) AS grant_id, CAST(2 AS BIGINT) AS n,
    CAST(w * w + w * (w + 1) AS DOUBLE) AS area FROM plots"""
ORACLE["repaired_rings"] = f"""WITH {PLOTS} SELECT fid, unnest(['bow', 'twice', 'valid']) AS ring,
    CAST(unnest([2, 7, 1]) * w * w AS DOUBLE) AS area FROM plots"""
ORACLE["mixed_widths"] = f"""WITH squares AS (
    SELECT 'o' || o_orderkey AS id, o_custkey * 13 AS minx, o_orderkey % 1000 AS miny, minx + 5 AS maxx, miny + 5 AS maxy FROM orders
    UNION ALL SELECT 'n' || n_nationkey, n_nationkey * 7000 AS x, n_nationkey - 15000 AS y,
      x + 30000 + n_regionkey * 5000, y + 30000 + n_regionkey * 5000 FROM nation)
  SELECT a.id, count(*) AS n FROM squares a JOIN squares b ON {MEET} AND a.id <> b.id GROUP BY a.id"""
ORACLE["stored_map_clip"] = ORACLE["box_clip_area"]
ORACLE["clipped_map"] = ORACLE["box_clip_area"]
ORACLE["latest_rollup"] = ORACLE["published_savings"]
ORACLE["report_order"] = f"SELECT grant_id, row_number() OVER (ORDER BY grant_id NULLS FIRST) AS position FROM ({ORACLE['savings_by_grant']})"
