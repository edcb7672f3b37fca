"""The periodic report from cells in state: ticks, repeats, late rows, compaction."""

from __future__ import annotations

import os

import pytest

from duelist.plans import fixtures
from duelist.plans.periodic import report_by_period, with_period
from duelist.streaming.period_cells import PeriodCells, run_tick
from duelist.streaming.scored_log import scored_rows


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    rows = with_period(fixtures.scored_events(spark, sf_dir), "ts")
    return rows.selectExpr("event_id", "ts", "period_start", "ab_group", "is_error", "score", "prediction")


def rows_of(df):
    columns = sorted(c for c in df.columns if c != "auc_se")
    return sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("bins,compact_every", [(None, 2), (50, 24)])
def test_three_ticks_one_repeated(spark, scored, folder, bins, compact_every):
    state = PeriodCells(folder, "is_error", bins, compact_every)
    parts = [scored.filter(f"event_id % 3 = {k}") for k in range(3)]
    parts[1] = parts[1].unionByName(scored.selectExpr(
        "event_id", "ts", "cast(NULL AS timestamp) AS period_start", "ab_group", "is_error", "score", "prediction").limit(5))
    for k in (0, 1, 1, 2, 2):
        state.absorb(parts[k], k)
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    from duelist.operators.decision import ab_report

    want = rows_of(ab_report(every, "is_error", ["period_start"], bins=bins))
    assert rows_of(state.current(spark)) == want == rows_of(state.recomputed(spark))


def test_a_tick_reads_cells_of_its_periods_only(spark, scored, folder):
    state = PeriodCells(folder, "is_error", compact_every=2)
    day = "period_start >= timestamp'2024-01-10 00:00:00'"
    state.absorb(scored.filter(f"NOT {day}"), 0)
    state.absorb(scored.filter(f"{day} AND event_id % 2 = 0"), 1)
    state.absorb(scored.filter(f"{day} AND event_id % 2 = 1"), 2)
    plan = state.touched_report(spark, 2)
    files = plan.inputFiles()
    assert files and all("/cells/batch_id=2/" in f or "/snapshot/upto=1/" in f for f in files)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(period_start" in text  # the bounds of the touched periods reach the scan
    touched = {r["period_start"] for r in spark.read.parquet(f"{folder}/reports/batch_id=2").collect()}
    assert touched == {r["period_start"] for r in scored.filter(f"{day} AND event_id % 2 = 1").select("period_start").distinct().collect()}
    assert len(touched) < state.current(spark).count()


def test_uncommitted_folders_do_not_count(spark, scored, folder):
    state = PeriodCells(folder, "is_error", compact_every=1)
    state.absorb(scored.filter("event_id % 2 = 0"), 0)
    before = rows_of(state.current(spark))
    # a snapshot whose writer was lost before it committed
    scored.limit(0).select("period_start").write.parquet(f"{folder}/elsewhere")
    os.makedirs(f"{folder}/snapshot/upto=7")
    assert state._snapshot(spark, None) == -1 and rows_of(state.recomputed(spark)) == before
    state.absorb(scored.filter("event_id % 2 = 1"), 1)
    assert state._snapshot(spark, None) == 0
    assert rows_of(state.current(spark)) == rows_of(report_by_period(scored.drop("period_start"), "ts", "is_error"))
    with pytest.raises(ValueError):
        PeriodCells(f"{folder}/none", "is_error").cells(spark)
    with pytest.raises(ValueError):
        PeriodCells(folder, "is_error", compact_every=0)


def test_stream_of_files(spark, sf_dir, folder):
    """Ticks of a file stream with late rows, an empty tick, and a batch whose commit was lost, so that it runs again."""
    events = fixtures.table(spark, sf_dir, "events")
    models = fixtures.rule_models("event_id", "is_error")
    state = PeriodCells(f"{folder}/state", "is_error")

    def tick():
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        rows = stream.selectExpr("event_id", "ts", "cast(event_type = 'error' AS int) AS is_error")
        run_tick(scored_rows(rows, "event_id", "ts", "is_error", *models), state, f"{folder}/checkpoint")

    for k in range(3):
        events.filter(f"event_id % 3 = {k}").write.mode("append").parquet(f"{folder}/in")
        tick()
    tick()
    commit = f"{folder}/checkpoint/commits/2"
    assert os.path.exists(commit)
    os.remove(commit)
    os.remove(f"{folder}/checkpoint/commits/.2.crc")
    tick()
    assert os.path.exists(commit)
    assert rows_of(state.current(spark)) == rows_of(report_by_period(fixtures.scored_events(spark, sf_dir), "ts", "is_error"))
