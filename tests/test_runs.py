"""Batches that are run again, pools, and what dead runs leave."""

import json
from threading import Barrier

import pytest
from conftest import SF, rows

from tableferry import leases
from tableferry.operators import load
from tableferry.plans import move
from tableferry.session import scratch_path, scratch_root
from tableferry.sources import catalog
from tableferry.sources.files import list_children, path_exists, write_text
from tableferry.sources.log_table import write_log_table
from tableferry.streaming import append


def lake(spark, root, names):
    for name in names:
        write_log_table(spark.read.parquet(f"{SF}/{name}.parquet"), f"{root}/{name}")


def config(root, schema, names, **extra):
    path = f"{root}/batch-{len(extra)}.json"
    entries = [{"source_path": f"{root}/{n}", "schema": schema, "table": n, "stage_root": f"{root}/stage", **extra.get(n, {})} for n in names]
    with open(path, "w") as out:
        json.dump(entries, out)
    return path


def test_only_what_failed_is_moved_again(spark, schema, tmp_path, monkeypatch):
    root, names = str(tmp_path), ["nation", "region", "supplier"]
    lake(spark, root, ["nation", "supplier"])
    ran = []
    real = move.run_job
    monkeypatch.setattr(move, "run_job", lambda spark, job, **flags: (ran.append(job.table), real(spark, job, **flags))[1])
    batch, ledger = config(root, schema, names), f"{root}/ledger"
    first = move.move_all(spark, batch, parallel=2, ledger=ledger)
    assert [r.status for r in first.collect()] == ["SUCCESS", "FAILED", "SUCCESS"] and sorted(ran) == names
    lake(spark, root, ["region"])
    ran.clear()
    second = move.move_all(spark, batch, ledger=ledger)
    assert ran == ["region"] and [r.status for r in second.collect()] == ["SUCCESS"] * 3
    assert [r for r in rows(second) if r[0] != "region"] == [r for r in rows(first) if r[0] != "region"]
    ran.clear()
    move.move_all(spark, config(root, schema, names, nation={"mode": "append"}), ledger=ledger)
    assert ran == ["nation"], "an entry that changed is another job"
    ran.clear()
    move.move_all(spark, batch)
    assert sorted(ran) == names, "without a ledger everything is moved"


def test_unverified_tables_are_not_done(spark, schema, tmp_path, monkeypatch):
    root = str(tmp_path)
    lake(spark, root, ["nation"])
    batch, ledger = config(root, schema, ["nation"]), f"{root}/ledger"
    with monkeypatch.context() as patched:
        patched.setattr(move, "_verify", lambda *a: (False, 0))
        move.move_all(spark, batch, ledger=ledger)
    assert move.finished_jobs(spark, ledger) == {}
    move.move_all(spark, batch, ledger=ledger)
    assert [o["verified"] for o in move.finished_jobs(spark, ledger).values()] == [True]


def test_every_table_has_its_pool(spark, schema, tmp_path, monkeypatch):
    root, names = str(tmp_path), ["nation", "region"]
    lake(spark, root, names)
    pools = {}

    def look(spark, job, **flags):
        pools[job.table] = spark.sparkContext.getLocalProperty(move.POOL)
        return dict(table=job.table, status="SUCCESS")

    monkeypatch.setattr(move, "run_job", look)
    move.move_all(spark, config(root, schema, names), parallel=2)
    assert pools == {"nation": "nation", "region": "region"}
    assert spark.sparkContext.getLocalProperty(move.POOL) is None
    assert spark.sparkContext.getConf().get("spark.scheduler.mode") == "FAIR"


def test_tables_side_by_side_keep_their_pools(spark, schema, tmp_path, monkeypatch):
    root, names = str(tmp_path), ["nation", "region"]
    lake(spark, root, names)
    both, pools = Barrier(2, timeout=60), {}

    def look(spark, job, **flags):
        both.wait()  # every pool is set
        pools[job.table] = spark.sparkContext.getLocalProperty(move.POOL)
        both.wait()  # and none is set back
        return dict(table=job.table, status="SUCCESS")

    monkeypatch.setattr(move, "run_job", look)
    move.move_all(spark, config(root, schema, names), parallel=2)
    assert pools == {"nation": "nation", "region": "region"}


@pytest.fixture
def dead(spark, tmp_path, monkeypatch):
    """Another application's run: makes things under its own name, then ends without a word."""

    def make(name, work):
        with monkeypatch.context() as patched:
            patched.setattr(leases, "_own_name", lambda spark: f"run-{name}")
            work()
            leases.end_lease(spark)

    return make


def test_sweep_removes_what_dead_runs_left(spark, dead, tmp_path, monkeypatch):
    root = str(tmp_path)
    lake(spark, root, ["nation"])
    made = {}

    def killed():
        class Killed(BaseException):
            pass

        def stop(*args, **kwargs):
            raise Killed

        made["scratch"] = scratch_path(spark, "x")
        spark.range(3).write.parquet(made["scratch"])
        leases.note(spark, "schema", "dead_workspace")
        catalog.create_schema(spark, "dead_workspace", f"{root}/dead")
        spark.range(3).write.saveAsTable("dead_workspace.t")
        job = move.Job(f"{root}/nation", table="n", schema="dead_workspace", stage_root=f"{root}/stage")
        with monkeypatch.context() as patched:
            patched.setattr(load, "write_table", stop)
            patched.setattr(move, "remove_stage", stop)  # dies before it can clean up
            with pytest.raises(Killed):
                move.run_job(spark, job)

    dead("gone", killed)
    staged = list_children(spark, f"{root}/stage/dead_workspace")
    assert len(staged) == 1
    own = scratch_path(spark, "own")
    spark.range(1).write.parquet(own)
    assert leases.sweep(spark) == [], "its lease is young"
    removed = leases.sweep(spark, hours=0)
    assert "dead_workspace" in removed
    assert not path_exists(spark, made["scratch"]) and not spark.catalog.databaseExists("dead_workspace")
    assert list_children(spark, f"{root}/stage/dead_workspace") == []
    assert path_exists(spark, own) and leases.sweep(spark, hours=0) == []


def test_live_runs_are_never_touched(spark, dead, monkeypatch):
    made = {}
    dead("busy", lambda: made.update(path=scratch_path(spark, "x")))
    spark.range(1).write.parquet(made["path"])
    old = [(n, t - 10 * 3_600_000) for n, t in list_children(spark, made["path"].rsplit("/", 1)[0])]
    with monkeypatch.context() as patched:
        real = leases.list_children
        patched.setattr(leases, "list_children", lambda s, p: old if p.endswith("run-busy") else real(s, p))
        assert leases.sweep(spark, hours=11) == [] and path_exists(spark, made["path"])
    # a lease that is renewed is young, whenever the run began
    write_text(spark, f"{scratch_root(spark)}/run-busy/{leases.LEASE}", "now")
    assert leases.sweep(spark, hours=0.5) == [] and path_exists(spark, made["path"])
    leases.sweep(spark, hours=0)


def test_leases_are_renewed(spark, monkeypatch):
    monkeypatch.setattr(leases, "RENEW_SECONDS", 0.05)
    monkeypatch.setattr(leases, "_own_name", lambda spark: "run-renewing")
    folder = leases.run_folder(spark)
    first = dict(list_children(spark, folder))[leases.LEASE]
    deadline = leases.time.time() + 20
    while dict(list_children(spark, folder))[leases.LEASE] == first and leases.time.time() < deadline:
        leases.time.sleep(0.1)
    assert dict(list_children(spark, folder))[leases.LEASE] > first
    leases.end_lease(spark)


def test_kept_stages_are_not_swept(spark, schema, dead, tmp_path):
    root = str(tmp_path)
    lake(spark, root, ["nation"])
    job = move.Job(f"{root}/nation", table="n", schema=schema, stage_root=f"{root}/stage")
    kept = {}
    dead("keeping", lambda: kept.update(move.run_job(spark, job, cleanup=False)))
    assert kept["status"] == "SUCCESS"
    leases.sweep(spark, hours=0)
    assert path_exists(spark, kept["staged_path"])
    again = move.run_job(spark, move.Job(kept["staged_path"], table="again", schema=schema))
    assert again["verified"] and rows(spark.table(f"{schema}.again"), "n_nationkey") == rows(spark.table(f"{schema}.n"), "n_nationkey")


def test_stream_progress_outlives_its_run(spark, schema, dead, tmp_path):
    """Progress below the scratch root belongs to the target, not to a run."""
    folder = str(tmp_path / "in")
    frame = spark.range(5)

    def run():
        frame.write.mode("append").parquet(folder)
        append.append_available(append.new_files(spark, folder, frame.schema), f"{schema}.t", key=["id"])

    dead("streaming", run)
    leases.sweep(spark, hours=0)
    run()
    assert rows(spark.table(f"{schema}.t"), "id") == [(i,) for i in range(5)]


@pytest.mark.parametrize("switch", [False, True])
def test_rejected_rows_are_set_aside_once(spark, schema, tmp_path, switch):
    """A keyed append with rejects, repeated and with new rows: verified every time, each bad row aside once."""
    path = str(tmp_path / "t")
    kinds = "id int, day string"
    write_log_table(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-31"), (3, "soon"), (None, "2024-01-01"), (4, None)], kinds), path)
    job = move.Job(path, table="t", schema=schema, mode="append", key=("id",), rejects=f"{schema}.bad", date_columns=("day",), switch=switch)
    first = move.run_job(spark, job)
    assert (first["status"], first["verified"], first["source_rows"]) == ("SUCCESS", True, 3)
    again = move.run_job(spark, job)
    assert again["verified"] and spark.table(f"{schema}.bad").count() == 2
    write_log_table(spark.createDataFrame([(5, "2024-03-01"), (6, "never")], kinds), path, "append")
    third = move.run_job(spark, job)
    assert third["verified"] and spark.table(f"{schema}.bad").count() == 3
    assert {r.id for r in spark.table(f"{schema}.t").collect()} == {None, 1, 4, 5}


def test_missing_keys_are_still_found(spark, schema, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_log_table(spark.createDataFrame([(1, "2024-01-01"), (2, "never")], "id int, day string"), path)
    job = move.Job(path, table="t", schema=schema, mode="append", key=("id",), rejects=f"{schema}.bad", date_columns=("day",))
    real = load.write_table
    monkeypatch.setattr(load, "write_table", lambda df, target, *a, **k: real(df.limit(0) if target.endswith(".t") else df, target, *a, **k))
    assert move.run_job(spark, job)["verified"] is False
