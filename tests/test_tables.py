"""Keys, attributes, change flags, snapshots and readers on small hand-made tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landcarbon.functions.factors import TOTAL_FACTORS, total_factors
from landcarbon.functions.text import (
    clean_current_use,
    distinct_concat,
    grid_reference,
    names_forestry_technique,
    technique_or_notes,
    text_or_notes,
)
from landcarbon.operators import attributes, emissions, keys
from landcarbon.operators.allocation import allocate, to_report_classes
from landcarbon.operators.categories import CATEGORY_COLUMNS, category_label, pivot_categories, with_difference
from landcarbon.operators.changes import track_changes
from landcarbon.functions.categories import CATEGORIES, CONDITION_COLUMNS
from landcarbon.plans.reporting import in_report_order
from landcarbon.sources import snapshots, tables


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_not_in_null_rules(spark):
    df = frame(spark, [(1, "a"), (2, "b"), (3, None)], "id int, k string")
    lists = frame(spark, [("a",), (None,)], "k string")
    assert ids(keys.not_in(df, "k", lists)) == []
    assert ids(keys.not_in(df, "k", lists.filter("k is not null"))) == [2]
    assert ids(keys.not_in(df, "k", lists.filter("false"))) == [1, 2, 3]


def test_not_in_plan_needs_no_whole_copy(spark):
    df = frame(spark, [(1, "a")], "id int, k string")
    plan = keys.not_in(df, "k", df.select("k"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_composite_keys_take_null_as_empty(spark):
    df = frame(spark, [("a", None), ("a", "s"), (None, None)], "grant_id string, site_id string")
    present = frame(spark, [("a", ""), ("b", "s")], "grant_id string, site_id string")
    left = keys.composite_not_in(df, present, ["grant_id", "site_id"])
    assert {tuple(r) for r in left.collect()} == {("a", "s"), (None, None)}


def test_prefer_sources(spark):
    a, b, c = (
        frame(spark, rows, "grant_id string, v int")
        for rows in ([("x", 1), ("x", 1), ("x", 2)], [("x", 3), ("y", 4)], [("x", 5), ("y", 6), ("z", 7)])
    )
    assert sorted(map(tuple, keys.prefer_sources([a, b, c], "grant_id").collect())) == [
        ("x", 1), ("x", 2), ("y", 4), ("z", 7)
    ]


def test_prefer_sources_has_the_null_rules_of_not_in(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int")
    full, null = frame([("a", 1), ("b", 2)]), frame([(None, 3), ("a", 4), ("c", 5)])
    for sources in ([full, null, frame([("d", 6), ("b", 7)])], [frame([]), null, full], [frame([]), frame([]), null]):
        chosen = sources[0]
        for n, source in enumerate(sources[1:], start=1):
            listed = keys.union_all(sources[:n]).select("k")
            chosen = chosen.union(keys.not_in(source, "k", listed))
        assert sorted(map(repr, keys.prefer_sources(sources, "k").collect())) == sorted(map(repr, chosen.distinct().collect()))


def test_prefer_sources_lists_the_keys_of_all_sources_in_one_join(spark):
    sources = [spark.range(9 * n).select(F.col("id").alias("k"), F.lit(n).alias("v")) for n in range(1, 5)]
    plan = keys.prefer_sources(sources, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_lookup_rejects_several_values(spark):
    df = frame(spark, [("a",), ("b",)], "k string")
    right = frame(spark, [("a", "A"), ("c", "C"), ("c", "D")], "k2 string, v string")
    found = {r.k: r.n for r in keys.lookup(df, right, F.col("k"), "k2", "v", "n").collect()}
    assert found == {"a": "A", "b": None}
    with pytest.raises(Exception, match="more than one v for c"):
        keys.lookup(frame(spark, [("c",)], "k string"), right, F.col("k"), "k2", "v", "n").collect()


def test_enrich_takes_one_whole_row(spark):
    attrs = frame(spark, [("a", 2, "x"), ("a", 1, "z")], "k string, u int, v string")
    rows = keys.enrich(frame(spark, [("a",), ("b",)], "k string"), attrs, "k", ["u", "v"]).collect()
    assert {tuple(r) for r in rows} == {("a", 1, "z"), ("b", None, None)}


def test_filters(spark):
    df = frame(spark, [(1, "New TRACK"), (2, None), (3, "dams")], "id int, restoration_technique string")
    assert ids(df.filter(keys.not_track())) == [3]
    areas = frame(spark, [(1, 32.99), (2, 33.0), (3, None)], "id int, project_area double")
    assert ids(keys.drop_slivers(areas)) == [2, 3]
    grants = frame(spark, [(1, 2025), (2, 2026), (3, None)], "grant_id int, financial_year_end int")
    assert ids(keys.eligible_grants(grants, 2025), "grant_id") == ["2"]


def test_text_rules(spark):
    df = frame(
        spark,
        [(1, "Grazing; (Other)", "sheep"), (2, "other", None), (3, "Ché^vre, 2!", "n"), (4, None, "n")],
        "id int, t string, n string",
    )
    got = {r.id: r.x for r in df.select("id", text_or_notes("t", "n").alias("x")).collect()}
    assert got == {1: "Grazing Other - sheep", 2: None, 3: "Ché^vre, 2", 4: None}
    techniques = frame(spark, [("Other (please specify in Notes)", "n"), ("other (please", "n")], "t string, n string")
    assert [r.x for r in techniques.select(technique_or_notes("t", "n").alias("x")).collect()] == ["n", "other (please"]
    uses = {"5,4": "Forestry", "x 5,4": "x Forestry", "4": "Deer Management", "14": "14", "1,2": "2", "1,3,4": "", "3,4,1": ""}
    rows = frame(spark, [(u,) for u in uses], "u string").select("u", clean_current_use("u").alias("c")).collect()
    assert {r.u: r.c for r in rows} == uses
    stems = frame(spark, [("tree felling",), ("Tree",), ("dams",), (None,)], "t string")
    flags = stems.select("t", names_forestry_technique("t").alias("f")).collect()
    assert {r.t: r.f for r in flags} == {"tree felling": True, "Tree": False, "dams": False, None: None}


def test_distinct_concat_is_null_without_values(spark):
    df = frame(spark, [(1, "b"), (1, "a"), (1, "b"), (2, None)], "id int, v string")
    got = {r.id: r.c for r in df.groupBy("id").agg(distinct_concat("v").alias("c")).collect()}
    assert got == {1: "a,b", 2: None}


def test_grid_reference(spark):
    # Public examples of British National Grid references.
    cases = [(651409, 313177, 10, "TG5140913177"), (216600, 771200, 6, "NN166712"), (530000, 180000, 2, "TQ38"),
             (0, 0, 0, "SV"), (-1, 0, 10, None), (0, 1_300_000, 10, None)]
    for x, y, digits, want in cases:
        assert spark.range(1).select(grid_reference(F.lit(x), F.lit(y), digits)).first()[0] == want


def test_attributes_over_joined_ids(spark):
    df = frame(spark, [("A,B", "p"), ("B", "q"), ("C", "r"), ("D", "p"), ("", "s")], "grant_id string, centroid string")
    attrs = frame(spark, [("A", "x"), ("B", "y"), ("B", "w"), ("D", "x"), ("C", None)], "grant_id string, v string")
    got = {(r.grant_id, r.centroid): r.v2 for r in attributes.enrich_by_id_list(df, attrs, "v", "v2").collect()}
    # Features at one place share their values.
    assert got == {("A,B", "p"): "w,x,y", ("D", "p"): "w,x,y", ("B", "q"): "w,y", ("C", "r"): None, ("", "s"): None}
    years = frame(spark, [("A", 2020), ("B", 2018), ("B", 2023)], "grant_id string, financial_year_end int")
    got = {r.centroid: (r.from_year, r.to_year) for r in attributes.fy_range(df, years).collect()}
    assert got == {"p": (2018, 2023), "q": (2018, 2023), "r": (None, None)}
    names = frame(spark, [("A", "Moor"), ("B", None)], "grant_id string, project_name string")
    got = {r.centroid: r.project_name for r in attributes.project_names(df.filter("centroid <> 'p'"), names).collect()}
    assert got == {"q": None, "r": None, "s": None}


def test_conditions_and_forestry(spark):
    rows = [
        (1, None, "FORESTRY", None), (2, "Yes", None, "dams"), (3, "Y", None, "dams, ditch blocking"),
        (4, "deforested", None, None), (5, None, None, None), (6, None, None, "stump flipping"),
    ]
    df = frame(spark, rows, "id int, pa_condition_category string, pa_current_use string, techniques string")
    df = df.withColumn("forestry", attributes.flag_forestry_by_attributes())
    got = {r.id: (r.forestry, r.c) for r in df.select("id", "forestry", attributes.fix_conditions().alias("c")).collect()}
    assert got == {
        1: (True, "Forested previously forested"), 2: (False, "Not provided"), 3: (False, "Drained"),
        4: (True, "deforested"), 5: (False, None), 6: (True, "Forested previously forested"),
    }


def test_warning_needs_the_whole_id(spark):
    df = frame(spark, [("A",), ("A,B",)], "grant_id string")
    got = {r.grant_id: r.warning for r in attributes.with_warning(df, frame(spark, [("A",), ("A",)], "g string")).collect()}
    assert got == {"A": attributes.WARNING, "A,B": None}


def test_changes(spark):
    cur = frame(spark, [("A", "p"), ("A", "z"), ("N", "p"), (None, "p")], "grant_id string, centroid string")
    prev = frame(spark, [("A", "p"), ("A", "p"), ("B", "q")], "grant_id string, centroid string")

    def flags(previous):
        return {(r.grant_id, r.centroid): (r.new_site, r.changed) for r in track_changes(cur, previous).collect()}

    assert flags(prev) == {
        ("A", "p"): (False, False), ("A", "z"): (False, True), ("N", "p"): (True, False), (None, "p"): (None, False)
    }
    with_null = prev.unionAll(frame(spark, [(None, None)], "grant_id string, centroid string"))
    assert flags(with_null) == {
        ("A", "p"): (False, False), ("A", "z"): (False, False), ("N", "p"): (None, False), (None, "p"): (None, False)
    }
    assert set(flags(prev.filter("false")).values()) == {(True, False)}


def test_pivot_and_difference(spark):
    parts = [("Conifer", "Conifer", "Forest", 1.005), ("Conifer", "Conifer", "Forest", 2.0), ("Eroding", None, "Eroded", 9.0),
             ("Unheard", "of", "x", 4.0)]
    df = frame(spark, [("f", *p) for p in parts] + [("g", "Eroding", None, "Eroded", 1.0)],
               "fid string, lc_level2 string, lc_level3 string, condition string, area double")
    df = df.withColumn("category", category_label())
    for as_double in (False, True):
        rows = {r.fid: r for r in pivot_categories(df, ["fid"], as_double=as_double).collect()}
        assert float(rows["f"].conifer) == 3.01 and rows["f"].eroded == 0
        assert [rows["g"][c] for c in CATEGORY_COLUMNS] == [0] * 18
    wide = pivot_categories(df, ["fid"]).withColumn("project_area", F.when(F.col("fid") == "f", F.lit(5.0)))
    assert {r.fid: r.difference for r in with_difference(wide).collect()} == {"f": Decimal("-1.99"), "g": Decimal("0.00")}


def test_legacy_bog_falls_back_without_a_mapped_area(spark):
    values = {c: F.lit(None).cast("double") for c in CATEGORIES.values()} | {"heather": F.lit(7.0)}
    shares = {c: F.lit(0) for c in CONDITION_COLUMNS} | {"pct_modified": F.lit(50)}
    df = spark.range(1).withColumns({**values, **shares, "difference": F.lit(-10.0), "forestry": F.lit(False)})
    allocated = allocate(df)
    fixed, legacy = (to_report_classes(allocated, ["id"], flag).first() for flag in (False, True))
    # 7 mapped, 5 modified outside the map, 85 % of the remaining 5.
    assert fixed.drained_modified_bog == legacy.drained_modified_bog == pytest.approx(16.25)
    mapped = allocated.withColumn("eroded", F.lit(100.0))
    fixed, legacy = (to_report_classes(mapped, ["id"], flag).first() for flag in (False, True))
    assert (fixed.drained_modified_bog, legacy.drained_modified_bog) == pytest.approx((101.25, 85.0))
    assert fixed.project_area_class == legacy.project_area_class == pytest.approx(117.0)


@pytest.mark.parametrize(("m2", "ha"), [(25_000.0, 3), (4_999.996, 0), (255_000.0, 26), (-25_000.0, -3), (254_999.99999999997, 26)])
def test_hectares_round_halves_away_from_zero(spark, m2, ha):
    df = spark.range(1).select(F.lit("k").alias("k"), *(F.lit(m2).alias(c) for c in [*emissions.CLASS_COLUMNS, "project_area_class"]))
    assert emissions.rollup_ha(df, "k").first().eroding == ha
    assert emissions.hectares_of(df, "k").first().eroding == ha


def test_factor_fanout_is_kept_and_reported(spark):
    mapping = frame(spark, [("c", "Rewetted Bog", "Rewetted Bog"), ("d", "Forest", "Near Natural Fen")],
                    "category string, emission_factor_pre string, emission_factor_post string")
    areas = frame(spark, [("k", "c", 10), ("k", "d", 10), ("k", "e", 99)], "k string, category string, area int")
    calcs = {r.emission_factor_pre: r for r in emissions.emission_calcs(areas, mapping, total_factors(spark), "k").collect()}
    assert calcs["Rewetted Bog"].pre_emissions_break1 == Decimal("134.6")
    assert calcs["Forest"].diff_break1 == Decimal("60.7") and calcs["Forest"].diff_break2 == Decimal("12.0")
    assert [tuple(r) for r in emissions.factor_duplicates(mapping, total_factors(spark)).collect()] == [
        ("c", "Rewetted Bog", "Rewetted Bog", 4)
    ]


def test_qc(spark):
    row = emissions.qc_totals(frame(spark, [(10_050.0,), (99.0,), (None,)], "project_area double")).first()
    assert (row.total_ha, row.n_rows) == (Decimal("1.01"), 3)


def test_readers(spark, tmp_path):
    header = ",".join(f.name for f in tables.FACTOR_SCHEMA)
    body = "\n".join(f'"{n}",{s},x,1,1,0,0,0,0,0,"{a} (± 1)",{a},{b},1' for n, s, a, b in TOTAL_FACTORS)
    (tmp_path / "f.csv").write_text("﻿" + header + "\n" + body + "\n", encoding="utf-8")
    factors = tables.read_factors(spark, str(tmp_path / "f.csv"))
    assert factors.columns[0] == "peat_condition"
    same = factors.select(*total_factors(spark).columns)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, total_factors(spark).collect()))
    assert factors.filter("total_break1 <> total_break2").select("peat_condition").first()[0] == "Forest"
    (tmp_path / "u.csv").write_text("drainage_status,units\ndirect_ch4,kg CH4 ha-1 y-1\n")
    assert tables.read_units(spark, str(tmp_path / "u.csv")).columns == ["factor_column", "units"]

    path = str(tmp_path / "layer")
    frame(spark, [("G", "s", "t", "n", b"x", 1)], "grant_id string, site_id string, restoration_technique string, "
          "notes string, geom binary, other int").write.parquet(path)
    assert "other" not in tables.read_layer(spark, path, "restoration_points").columns
    bounds = tables.read_boundaries(frame(spark, [(7, b"x")], "ref int, shape binary"), "ref", "shape").first()
    assert (bounds.grant_id, bytes(bounds.geom)) == ("7", b"x")
    assert tables.conform(frame(spark, [("1", "2")], "a string, b string"), tables.T.StructType(
        [tables.T.StructField("x", tables.T.IntegerType()), tables.T.StructField("y", tables.T.StringType())]
    )).dtypes == [("x", "int"), ("y", "string")]


def test_snapshots(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(LookupError, match="no snapshot of report"):
        snapshots.latest_snapshot(spark, base, "report")
    df = spark.range(3)
    for n, day in enumerate([date(2024, 9, 4), date(2025, 12, 12), date(2025, 2, 1)]):
        snapshots.write_snapshot(df.withColumn("n", F.lit(n)), base, "report", day)
    assert snapshots.run_ids(spark, base, "report") == ["20240904", "20250201", "20251212"]
    assert snapshots.latest_snapshot(spark, base, "report").first().n == 1
    # A repeated run replaces itself only.
    snapshots.write_snapshot(spark.range(1).withColumn("n", F.lit(9)), base, "report", date(2025, 12, 12))
    assert [r.n for r in snapshots.latest_snapshot(spark, base, "report").collect()] == [9]
    assert snapshots.read_snapshot(spark, base, "report", "20240904").count() == 3
    view = snapshots.publish_latest(spark, base, "report")
    assert view == "report_latest" and spark.table(view).columns == ["id", "n"]
    assert snapshots.run_id_of(datetime(2025, 1, 2, 3, 4, 5)) == "20250102_030405"
    assert snapshots.write_table(df, f"{base}/t").count() == snapshots.write_table(df, f"{base}/t").count() == 3


def test_a_run_without_rows_is_a_run(spark, tmp_path):
    base, df = str(tmp_path), spark.range(3)
    snapshots.write_snapshot(df, base, "report", date(2024, 9, 4))
    snapshots.write_snapshot(df.filter("id < 0"), base, "report", date(2025, 9, 4))
    assert snapshots.latest_snapshot(spark, base, "report").count() == 0
    snapshots.write_snapshot(df.filter("id < 0"), base, "report", date(2024, 9, 4))
    assert snapshots.read_snapshot(spark, base, "report", "20240904").count() == 0
    (tmp_path / "report" / "run_id=20260101").mkdir()  # a write that did not end
    assert snapshots.run_ids(spark, base, "report") == ["20240904", "20250904"]


def test_report_order(spark):
    df = frame(spark, [("b", "y"), ("a", "z"), ("a", "x")], "grant_id string, emission_factor_pre string")
    assert [tuple(r) for r in in_report_order(df).collect()] == [("a", "x"), ("a", "z"), ("b", "y")]


def test_parts_of_an_input_are_bounded(spark, tmp_path, monkeypatch):
    from standins import inputs

    spark.range(200_000).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    monkeypatch.setattr(inputs, "PART_BYTES", 50_000, raising=False)
    df = inputs.table(spark, str(tmp_path), "t")
    assert df.select(F.spark_partition_id()).distinct().count() > spark.sparkContext.defaultParallelism
    assert df.count() == 200_000


def test_orders_are_dealt_into_parts_that_follow_the_items(spark, monkeypatch):
    """The sums per order and category are made in parts of a bounded number of items."""
    from standins import inputs, queries

    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(inputs, "PART_BYTES", 4096)
    parts = inputs.parts_of(spark.read.parquet(f"{folder}/lineitem.parquet"))
    assert parts > 8
    plan = queries.REGISTRY["category_difference"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning(fid" in line and f", {parts})" in line]
    # Nothing after them brings the orders together in another number of parts.
    later = plan[: plan.index(dealt[0])]
    assert dealt and "Exchange" not in later
