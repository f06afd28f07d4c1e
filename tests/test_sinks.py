import pytest

from courierlake.operators import sinks, snapshots
from courierlake.operators.sinks import read_target, replace_table
from courierlake.session import scratch_path


def test_replace_append_fail_and_guard(spark):
    target = scratch_path(spark, "sink-test") + "/t"
    a = spark.range(3)
    assert replace_table(a, target) is True
    assert read_target(spark, target).count() == 3
    replace_table(spark.range(5), target, mode="replace")
    assert read_target(spark, target).count() == 5
    replace_table(spark.range(2), target, mode="append")
    assert read_target(spark, target).count() == 7
    with pytest.raises(FileExistsError):
        replace_table(spark.range(1), target, mode="fail")
    assert replace_table(spark.range(0), target, skip_if_empty=True) is False
    assert read_target(spark, target).count() == 7
    with pytest.raises(ValueError):
        replace_table(a, target, mode="upsert")


def test_replace_own_input(spark):
    target = scratch_path(spark, "sink-self") + "/t"
    replace_table(spark.range(4), target)
    src = read_target(spark, target)
    replace_table(src.where("id > 0"), target)
    assert sorted(r.id for r in read_target(spark, target).collect()) == [1, 2, 3]


def test_replace_catalog_table_from_itself(spark):
    name = "courierlake_sink_selftest"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    replace_table(spark.range(5), name)
    replace_table(spark.table(name).where("id % 2 = 0"), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 2, 4]
    replace_table(spark.range(0), name, skip_if_empty=True)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_replace_own_input_in_a_path_with_a_blank(spark, tmp_path):
    target = str(tmp_path / "a b" / "t")
    replace_table(spark.range(4), target)
    replace_table(read_target(spark, target).where("id > 1"), target)
    assert sorted(r.id for r in read_target(spark, target).collect()) == [2, 3]
    assert [p.name for p in (tmp_path / "a b").iterdir()] == ["t"]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_failed_replace_keeps_the_old_rows(spark, kind, tmp_path):
    target = str(tmp_path / "t") if kind == "path" else "courierlake_sink_failtest"
    replace_table(spark.range(3), target)
    read = lambda: read_target(spark, target)
    with pytest.raises(Exception):
        replace_table(read().selectExpr("if(id = 2, raise_error('stop'), id) AS id"), target)
    assert read().count() == 3
    if kind == "table":
        spark.sql(f"DROP TABLE {target}")


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["write_snapshot", "publish", "vacuum"])
@pytest.mark.parametrize("after", [False, True])
def test_stop_between_any_two_steps(spark, tmp_path, monkeypatch, step, after):
    """A job that stops before or after any step leaves the old or the new
    version, whole, and the next job goes on from there."""
    target = str(tmp_path / "t")
    replace_table(spark.range(3), target)
    real = getattr(snapshots, step)

    def stopped(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Stopped

    monkeypatch.setattr(snapshots, step, stopped)
    with pytest.raises(Stopped):
        replace_table(spark.range(10, 15), target)
    committed = step == "vacuum" or (step == "publish" and after)
    assert sorted(r.id for r in read_target(spark, target).collect()) == (list(range(10, 15)) if committed else [0, 1, 2])
    monkeypatch.undo()
    replace_table(read_target(spark, target).selectExpr("id + 1 AS id"), target)
    assert read_target(spark, target).count() == (5 if committed else 3)


def test_a_reader_keeps_its_version(spark, tmp_path):
    target = str(tmp_path / "t")
    replace_table(spark.range(3), target)
    early = read_target(spark, target)
    replace_table(spark.range(9), target)
    assert early.count() == 3 and read_target(spark, target).count() == 9
    replace_table(spark.range(2), target)
    assert len(snapshots._names(spark, target + "/_snapshots")) == 2
    assert snapshots.read_snapshot(spark, target, version=2).count() == 9


def test_two_writers_of_one_version(spark, tmp_path):
    target = str(tmp_path / "t")
    replace_table(spark.range(3), target)
    folder = snapshots.write_snapshot(spark.range(4), target)
    replace_table(spark.range(5), target)
    with pytest.raises(snapshots.CommitConflict):
        snapshots.publish(spark, target, 2, "parquet", [folder])
    assert read_target(spark, target).count() == 5


def test_plain_folder_becomes_a_version(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.range(4).write.parquet(target)
    assert read_target(spark, target).count() == 4
    replace_table(read_target(spark, target).where("id > 0"), target)
    assert sorted(r.id for r in read_target(spark, target).collect()) == [1, 2, 3]
    with pytest.raises(FileNotFoundError):
        read_target(spark, str(tmp_path / "none"))


def test_partitioned_target(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(6).selectExpr("id", "id % 2 AS k")
    replace_table(rows, target, partition_by=["k"])
    replace_table(rows.selectExpr("id + 6 AS id", "k"), target, mode="append", partition_by=["k"])
    assert read_target(spark, target).where("k = 1").count() == 6


@pytest.mark.parametrize("change", ["same", "columns", "partitioned"])
@pytest.mark.parametrize("step", ["stage_table", "point_table", "drop_folder"])
def test_table_replacement_stopped(spark, monkeypatch, change, step):
    name = f"courierlake_sink_{change}_{step}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    replace_table(spark.range(3), name)
    new = {"same": spark.range(5), "columns": spark.range(5).selectExpr("id", "'x' AS t"),
           "partitioned": spark.range(5).selectExpr("id", "id % 2 AS k")}[change]
    by = ["k"] if change == "partitioned" else None

    def stopped(*args, **kwargs):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(sinks, step, stopped)
        with pytest.raises(Stopped):
            replace_table(new, name, partition_by=by)
    assert spark.table(name).count() == (5 if step == "drop_folder" else 3)
    replace_table(new, name, partition_by=by)
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(5))
    assert spark.table(name).columns == new.columns
    spark.sql(f"DROP TABLE {name}")


def test_table_rename_fails_and_the_old_name_returns(spark, monkeypatch):
    name = "courierlake_sink_rename"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    replace_table(spark.range(3), name)
    real, seen = type(spark).sql, []

    def sql(self, text, *args, **kwargs):
        if "__new_" in text and "RENAME" in text:
            seen.append(text)
            raise Stopped
        return real(self, text, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", sql)
        with pytest.raises(Stopped):
            replace_table(spark.range(2).selectExpr("id", "1 AS other"), name)
    assert seen and spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")
