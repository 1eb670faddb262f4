"""Published runs: seen by other sessions, whole or not at all."""

import json
from pathlib import Path

import pytest

from landcarbon.sources import manifest
from landcarbon.sources.snapshots import write_snapshot


def publish(spark, base, run, names, moment, fail=False):
    for i, name in enumerate(names):
        if fail and i:
            raise RuntimeError("broken off")
        write_snapshot(spark.range(run * 10, run * 10 + 3).withColumnRenamed("id", f"{name}_id"), base, name, moment)
    manifest.publish_manifest(spark, base, "rollup", moment.strftime("%Y%m%d"), names)


def test_another_session_sees_the_newest_whole_run(spark, tmp_path):
    from datetime import date

    base, names = str(tmp_path), ["m2", "ha"]
    other = spark.newSession()
    with pytest.raises(LookupError, match="never published"):
        manifest.open_latest(other, base, "rollup")
    publish(spark, base, 1, names, date(2025, 1, 1))
    publish(spark, base, 2, names, date(2025, 2, 1))
    assert manifest.open_latest(other, base, "rollup") == ["m2_latest", "ha_latest"]
    assert other.table("m2_latest").columns == ["m2_id"] and sorted(r[0] for r in other.table("ha_latest").collect()) == [20, 21, 22]

    # A publish that breaks off between two tables: both are still those of the run before.
    with pytest.raises(RuntimeError):
        publish(spark, base, 3, names, date(2025, 3, 1), fail=True)
    seen = manifest.latest_tables(spark.newSession(), base, "rollup")
    assert {t: sorted(r[0] for r in df.collect()) for t, df in seen.items()} == {"m2": [20, 21, 22], "ha": [20, 21, 22]}
    # An older run can be made the newest again, and no draft is left.
    manifest.publish_manifest(spark, base, "rollup", "20250101", names)
    assert manifest.read_manifest(spark, base, "rollup")["run"] == "20250101"
    assert [p.name for p in Path(base).iterdir() if "rollup" in p.name and not p.name.endswith(".crc")] == ["rollup.manifest"]


def test_changed_files_and_missing_runs_are_noticed(spark, tmp_path):
    from datetime import date

    base = str(tmp_path)
    publish(spark, base, 1, ["m2"], date(2025, 1, 1))
    with pytest.raises(manifest.BrokenSnapshot):
        manifest.publish_manifest(spark, base, "rollup", "20990101", ["m2"])
    assert manifest.read_manifest(spark, base, "rollup")["run"] == "20250101"
    write_snapshot(spark.range(5).withColumnRenamed("id", "m2_id"), base, "m2", date(2025, 1, 1))
    with pytest.raises(manifest.BrokenSnapshot, match="not as it was published"):
        manifest.latest_tables(spark, base, "rollup")
    about = json.loads((tmp_path / "rollup.manifest").read_text())
    assert about["tables"]["m2"]["schema"]["fields"][0]["name"] == "m2_id"
