"""Only committed runs are seen; runs may be logged at the same time."""
from concurrent.futures import ThreadPoolExecutor

import pytest

from tabsmith.plans.runs import RunLog


def test_a_run_broken_before_its_commit_is_invisible(spark, tmp_path, monkeypatch):
    log = RunLog(spark, str(tmp_path / "log"))
    assert log.runs().count() == 0 and log.params().count() == 0 and log.metrics().count() == 0
    kept = log.log_run("a", "xgboost", "baseline", {"depth": 3, "none": None}, {"f1": 0.5, "no": None}, {"model": "m"})

    def broken(self, run_id, record):
        raise OSError("the driver died here")

    with monkeypatch.context() as m:
        m.setattr(RunLog, "_commit", broken)
        with pytest.raises(OSError):
            log.log_run("b", "mlp", "baseline", {"depth": 9}, {"f1": 0.9})
    with monkeypatch.context() as m:
        m.setattr(RunLog, "_write", broken)
        with pytest.raises(TypeError):
            log.log_run("c", "mlp", "baseline", {"depth": 9}, {"f1": 0.9})
    assert [(r.run_id, r.run_name, r.version) for r in log.runs().collect()] == [(kept, "a", "baseline")]
    assert sorted(tuple(r) for r in log.params().collect()) == [(kept, "artifact.model", "m"), (kept, "depth", "3")]
    assert [tuple(r) for r in log.metrics().collect()] == [(kept, "f1", 0.5)]
    assert log.runs().first().started_at is not None


def test_several_writers_at_once(spark, tmp_path):
    def write(i):
        return RunLog(spark, str(tmp_path / "log")).log_run(f"run{i}", "mlp", "tuned", {"i": i}, {"f1": i / 10})

    with ThreadPoolExecutor(4) as pool:
        ids = list(pool.map(write, range(8)))
    log = RunLog(spark, str(tmp_path / "log"))
    assert {r.run_id for r in log.runs().collect()} == set(ids)
    assert sorted((r.run_id, r.v) for r in log.params().collect()) == sorted((run, str(i)) for i, run in enumerate(ids))
    assert log.metrics().count() == 8
