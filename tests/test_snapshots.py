"""Snapshots behind a pointer: what is refused, and what a manifest tells."""

import pytest

from catloom.sources import snapshots
from catloom.sources.snapshots import Relation, read_latest, read_manifest, resolve_pointer, snapshot_verdicts, write_snapshot

REL = Relation("coin", "country_id", "country", "id")


def entities(spark, n=3):
    country = spark.createDataFrame([(i, f"c{i}") for i in range(n)], "id long, name string")
    coin = spark.createDataFrame([(10, 0), (11, 0), (12, 7), (13, None)], "id long, country_id long")
    return {"country": country, "coin": coin}


def test_pointer_names_the_last_finished_snapshot(spark, tmp_path):
    root = str(tmp_path / "s")
    assert resolve_pointer(spark, root) is None and read_latest(spark, root, "coin") is None
    write_snapshot(spark, root, "one", entities(spark), [REL])
    write_snapshot(spark, root, "two", entities(spark, 5) | {"coin": entities(spark)["coin"].limit(0)}, [REL])
    assert resolve_pointer(spark, root) == "two" and read_latest(spark, root, "country").count() == 5
    rows = {r["name"]: r for r in read_manifest(spark, root, "one").collect()}
    assert (rows["*"]["rows"], rows["coin"]["rows"], rows["country"]["rows"]) == (7, 4, 3)
    r = rows[REL.name]
    assert (r["rows"], r["parents"], r["orphans"], r["childless"]) == (3, 3, 1, 2)
    assert {r["name"]: r["rows"] for r in read_manifest(spark, root, "two").collect()}["coin"] == 0
    assert snapshot_verdicts(spark, root, "one", [REL]).collect() == []
    with pytest.raises(Exception, match="(?i)exist"):
        write_snapshot(spark, root, "one", entities(spark))
    snapshots.point(spark, root, "one")  # back to an older one
    assert resolve_pointer(spark, root) == "one"


def test_half_written_snapshots_change_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    write_snapshot(spark, root, "one", entities(spark))
    with monkeypatch.context() as m:
        m.setattr(snapshots, "snapshot_manifest", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            write_snapshot(spark, root, "two", entities(spark))
    assert resolve_pointer(spark, root) == "one"
    snapshots.point(spark, root, "two")  # a pointer to what was never finished
    with pytest.raises(ValueError, match="finished"):
        resolve_pointer(spark, root)


@pytest.mark.parametrize("text", ["../elsewhere", "/etc", "", "  \n", "..", "a/b", "a\\b", "s3://x"])
def test_pointers_outside_the_root_are_refused(spark, tmp_path, text):
    (tmp_path / "LATEST").write_text(text)
    with pytest.raises(ValueError, match="pointer"):
        resolve_pointer(spark, str(tmp_path))
    with pytest.raises(ValueError, match="name"):
        write_snapshot(spark, str(tmp_path), text, entities(spark))


def test_plain_pointer_file_and_wrong_figures(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(spark, f"{root}/made", "one", entities(spark), [REL])
    (tmp_path / "made" / "x").mkdir()
    entities(spark)["country"].limit(1).write.mode("append").parquet(f"{root}/made/one/entities/country")
    entities(spark)["coin"].selectExpr("id + 1 as id", "country_id").write.mode("overwrite").parquet(f"{root}/made/one/entities/coin")
    got = {(r["kind"], r["name"]): r["problem"] for r in snapshot_verdicts(spark, f"{root}/made", "one", [REL]).collect()}
    assert got == {("entity", "country"): "number of rows", ("entity", "coin"): "checksum", ("totals", "*"): "number of rows", ("relation", REL.name): "parents"}
    plain = tmp_path / "plain"
    (plain / "one" / "manifest").mkdir(parents=True)
    (plain / "LATEST").write_text("one\n")
    with pytest.raises(ValueError, match="finished"):
        resolve_pointer(spark, str(plain))
    read_manifest(spark, f"{root}/made", "one").coalesce(1).write.mode("overwrite").json(str(plain / "one" / "manifest"))
    assert resolve_pointer(spark, str(plain)) == "one"
