"""Deliveries whose headers differ."""

import os

import pytest

from sigflow.schemas import RAW_SCHEMA
from sigflow.sources.table import TableConfig
from sigflow.streaming import ingest_drifting_csv, read_drift_report, read_drift_table, read_drifting_csv
from sigflow.streaming import drift

T, A, W, P, D = RAW_SCHEMA.names
FILES = {
    "a.csv": f"{T},{A},{W},{P},{D}\n01 01 2024 00:00,1,2,3,4\n\n01 01 2024 00:10,5,,7,8\n",
    "b.csv": f'﻿"{D}",Note,{P},{W},{A},"{T}"\r\n4,"x, y",3,2,1,02 01 2024 00:00\r\n',
    "c.csv": f"{T},{A},{W},{P}\n01 01 2024 00:00,1,2,3\n",
    "d.csv": f"{T},{A},{A},{W},{P},{D}\n01 01 2024 00:00,1,1,2,3,4\n",
    "e.csv": "01 01 2024 00:00,1,2,3,4\n",
    "f.csv": f"{T},{A},{W},{P},{D}\n",
    "g.csv": f"{D},{T},{A},{W},{P}\n4,03 01 2024 00:00,much,2,3\n{D},{T},{A},{W},{P}\n9,03 01 2024 00:10\n",
    "h.csv": "",
}
ROWS = [
    ("01 01 2024 00:00", 1.0, 2.0, 3.0, 4.0, None),
    ("01 01 2024 00:10", 5.0, None, 7.0, 8.0, None),
    ("02 01 2024 00:00", 1.0, 2.0, 3.0, 4.0, None),
    ("03 01 2024 00:00", None, 2.0, 3.0, 4.0, "4,03 01 2024 00:00,much,2,3"),
    ("03 01 2024 00:10", None, None, None, 9.0, None),
]
REASONS = {"a": None, "b": None, "c": f"missing: {D}", "d": f"twice: {A}", "e": f"missing: {T}, {A}, {W}, {P}, {D}", "f": None, "g": None}


@pytest.fixture()
def inbox(scratch):
    folder = os.path.join(scratch, "inbox")
    os.makedirs(folder)
    for name, text in FILES.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return folder


def reasons(report):
    return {r.file.rsplit("/", 1)[-1][0]: r.reason for r in report.collect()}


def rows(table):
    return sorted((tuple(r)[:6] for r in table.collect()), key=str)


def test_batch(spark, inbox):
    table, report = read_drifting_csv(spark, inbox)
    assert rows(table) == ROWS and reasons(report) == REASONS


@pytest.mark.parametrize("files", [1, 3])
def test_stream(spark, inbox, scratch, files):
    table, report = (TableConfig(path=os.path.join(scratch, n)) for n in ("raw", "report"))
    run = lambda: ingest_drifting_csv(spark, inbox, table, report, os.path.join(scratch, "checkpoint"), max_files_per_trigger=files)
    run()
    run()
    assert rows(read_drift_table(spark, table)) == ROWS
    assert reasons(read_drift_report(spark, report)) == REASONS


def test_a_batch_that_failed_half_way_runs_again(spark, inbox, scratch, monkeypatch):
    table, report = (TableConfig(path=os.path.join(scratch, n)) for n in ("raw", "report"))
    write, calls = drift.overwrite_partitions, []

    def stop(frame, cfg):
        calls.append(cfg.path)
        if len(calls) == 2:
            raise RuntimeError("stopped between the table and the report")
        write(frame, cfg)

    monkeypatch.setattr(drift, "overwrite_partitions", stop)
    with pytest.raises(Exception, match="stopped between"):
        ingest_drifting_csv(spark, inbox, table, report, os.path.join(scratch, "checkpoint"), max_files_per_trigger=100)
    ingest_drifting_csv(spark, inbox, table, report, os.path.join(scratch, "checkpoint"), max_files_per_trigger=100)
    assert rows(read_drift_table(spark, table)) == ROWS
    assert reasons(read_drift_report(spark, report)) == REASONS


def test_only_quarantined_files(spark, inbox, scratch):
    for name in FILES:
        if name not in ("c.csv", "e.csv"):
            os.remove(os.path.join(inbox, name))
    table, report = (TableConfig(path=os.path.join(scratch, n)) for n in ("raw", "report"))
    ingest_drifting_csv(spark, inbox, table, report, os.path.join(scratch, "checkpoint"))
    assert rows(read_drift_table(spark, table)) == []
    assert reasons(read_drift_report(spark, report)) == {k: REASONS[k] for k in "ce"}
