"""A batch that fails goes on where it stopped."""

import json
from pathlib import Path

import pytest
from conftest import as_rows

from basket_marts.plans import batch
from basket_marts.plans.quality import ContractViolation
from basket_marts.plans.stages import Stage, StageLog
from basket_marts.queries import QUERIES, _raw_drop
from basket_marts.sinks import to_parquet
from basket_marts.sources import SharedTables

NAMES = ["clean", "marts", "checks", "publish"]


@pytest.fixture(scope="module")
def raw(spark, folder, tmp_path_factory):
    root = tmp_path_factory.mktemp("drop") / "raw"
    for file, rows in _raw_drop(SharedTables(spark, folder), dirty=False).items():
        rows.write.csv(f"{root}/{file}", header=True)
    return str(root)


def broken(stages, name, error):
    def fail():
        raise error

    return [Stage(s.name, s.inputs, s.outputs, fail, s.settings) if s.name == name else s for s in stages]


def test_each_stage_can_fail_and_finished_ones_do_not_run_again(spark, folder, raw, tmp_path):
    lake, writer = f"{tmp_path}/lake", to_parquet(f"{tmp_path}/published")
    stages, log = batch.batch_stages(spark, raw, lake, writer), StageLog(spark, f"{lake}/stages")
    for done, name in enumerate(NAMES):
        error = ContractViolation({"x": 1}) if name == "checks" else RuntimeError(name)
        with pytest.raises(type(error)):
            log.run(broken(stages, name, error))
        assert [s.name for s in stages if log.is_finished(s)] == NAMES[:done]
        # What the broken run did not finish is all that runs now; one stage at a time.
        assert log.run(stages[: done + 1]) == [name]
    assert log.run(stages) == []
    published = spark.read.parquet(f"{tmp_path}/published/mart_department_kpis")
    assert as_rows(published) == as_rows(QUERIES["mart_department_kpis"](spark, folder))
    assert log.manifest("checks").figures == {"passed": 13}
    assert batch.run_batch(spark, raw, lake, writer, resume=True) == log.manifest("publish").figures


def counted(name, inputs, outputs, ran, **settings):
    def run():
        ran.append(name)
        for path in outputs:
            Path(path).mkdir(exist_ok=True)
            (Path(path) / "part").write_text(f"{len(ran)}")
        return {"rows": len(ran)}

    return Stage(name, inputs, outputs, run, settings)


def test_changed_inputs_outputs_and_settings_run_a_stage_again(spark, tmp_path):
    source, middle, last = (str(tmp_path / n) for n in ("source", "middle", "last"))
    Path(source).mkdir()
    (Path(source) / "a.csv").write_text("1")
    ran, log = [], StageLog(spark, f"{tmp_path}/log")

    def stages(**settings):
        return [counted("first", [source], [middle], ran, **settings), counted("second", [middle], [last], ran)]

    assert log.run(stages()) == ["first", "second"]
    assert log.run(stages()) == []
    (Path(source) / "_SUCCESS").write_text("")
    assert log.run(stages()) == []
    (Path(source) / "b.csv").write_text("2")
    assert log.run(stages()) == ["first", "second"]
    (Path(last) / "part").unlink()
    assert log.run(stages()) == ["second"]
    assert log.run(stages(files=3)) == ["first", "second"]
    log.forget("second")
    assert log.run(stages(files=3)) == ["second"]


def test_a_stage_that_fails_again_is_not_finished(spark, tmp_path):
    log, ran = StageLog(spark, f"{tmp_path}/log"), []
    stage = counted("only", [], [str(tmp_path / "out")], ran)
    log.run([stage])
    with pytest.raises(RuntimeError):
        log.run(broken([Stage("only", [str(tmp_path)], stage.outputs, stage.run)], "only", RuntimeError()))
    assert log.manifest("only") is None and not log.is_finished(stage)


def test_manifests_are_plain_documents(spark, tmp_path):
    log = StageLog(spark, f"{tmp_path}/log")
    log.run([counted("one", [], [], [])])
    document = json.loads(Path(tmp_path, "log", "one.json").read_text())
    assert document["stage"] == "one" and document["figures"] == {"rows": 1}
    assert sorted(p.name for p in Path(tmp_path, "log").glob("[!.]*")) == ["one.json"]
