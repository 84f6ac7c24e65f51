import os

import pytest

from sigflow.schemas import ACTIVE_POWER, DATE_TIME, RAW_SCHEMA
from sigflow.sources.csv import read_raw_csv
from sigflow.sources.mapping import mapping_frame, mapping_from_json

HEADER = "Date/Time,LV ActivePower (kW),Wind Speed (m/s),Theoretical_Power_Curve (KWh),Wind Direction (°)"


def write(path, text, bom=False, crlf=False):
    if crlf:
        text = text.replace("\n", "\r\n")
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as fh:
        fh.write(text)


def test_bom_crlf_and_stray_file(spark, scratch):
    folder = os.path.join(scratch, "csv")
    os.makedirs(folder)
    write(os.path.join(folder, "x.csv"), f"{HEADER}\n01 01 2018 00:00,1.5,2,3,4\n", bom=True, crlf=True)
    write(os.path.join(folder, "x.csv.old"), f"{HEADER}\n01 01 2018 00:10,9,9,9,9\n")
    df = read_raw_csv(spark, folder)
    rows = df.collect()
    assert len(rows) == 1  # the .csv.old sibling is not read
    assert rows[0][DATE_TIME] == "01 01 2018 00:00" and rows[0][ACTIVE_POWER] == 1.5
    assert df.schema == RAW_SCHEMA


def test_infer_schema_matches_fixed(spark, scratch):
    path = os.path.join(scratch, "a.csv")
    write(path, f"{HEADER}\n01 01 2018 00:00,1.5,2.0,3.0,4.0\n", bom=True, crlf=True)
    inferred = read_raw_csv(spark, path, infer_schema=True, glob=None)
    assert [(f.name, f.dataType.simpleString()) for f in inferred.schema] == [
        (f.name, f.dataType.simpleString()) for f in RAW_SCHEMA
    ]


def test_header_swap_fails(spark, scratch):
    path = os.path.join(scratch, "swap.csv")
    cols = HEADER.split(",")
    write(path, ",".join([cols[0], cols[2], cols[1], cols[3], cols[4]]) + "\n01 01 2018 00:00,1,2,3,4\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, path, glob=None).collect()


def test_mapping_sources(spark):
    inline = {r.sig_name: r.sig_mapping_name for r in mapping_frame(spark).collect()}
    parsed = mapping_from_json(spark)
    assert parsed.count() == 4
    assert {r.sig_name: r.sig_mapping_name for r in parsed.collect()} == inline


def test_clustered_write_one_range_per_task(spark, scratch):
    import glob

    from conftest import SF001
    from sigflow.sources.table import TableConfig, read_table, write_table
    from sigflow.sources.testdata import events_telemetry, read_events

    tel = events_telemetry(read_events(spark, SF001).repartition(8))
    plain = TableConfig(path=os.path.join(scratch, "plain"))
    clustered = TableConfig(path=os.path.join(scratch, "clustered"))
    write_table(tel, plain)
    write_table(tel, clustered, cluster_by=("signal_date", "signal_ts"), num_partitions=8)
    n_plain = len(glob.glob(os.path.join(plain.path, "*", "*.parquet")))
    n_clustered = len(glob.glob(os.path.join(clustered.path, "*", "*.parquet")))
    assert n_clustered < n_plain
    assert n_clustered <= 8 + 30  # at most one extra file per range boundary
    a, b = read_table(spark, plain), read_table(spark, clustered)
    assert a.count() == b.count() == 1000
    cols = ["signal_date", "signal_ts"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0


def test_rebalanced_write_keeps_rows(spark, scratch):
    from conftest import SF001
    from sigflow.sources.table import TableConfig, read_table, write_table
    from sigflow.sources.testdata import events_telemetry, read_events

    tel = events_telemetry(read_events(spark, SF001))
    cfg = TableConfig(path=os.path.join(scratch, "rebalanced"))
    write_table(tel, cfg, rebalance=True)
    out = read_table(spark, cfg)
    cols = ["signal_date", "signal_ts"]
    assert out.count() == 1000
    assert out.select(cols).exceptAll(tel.select(cols)).count() == 0


def test_mapping_frame_rejects_conflicting_duplicates(spark):
    assert mapping_frame(spark, [("a", "x"), ("a", "x")]).count() == 1
    with pytest.raises(ValueError):
        mapping_frame(spark, [("a", "x"), ("a", "y")])


def test_mapping_json_conflict_fails(spark):
    text = '[{"sig_name": "a", "sig_mapping_name": "x"}, {"sig_name": "a", "sig_mapping_name": "y"}]'
    with pytest.raises(Exception):
        mapping_from_json(spark, text).collect()
    ok = '[{"sig_name": "a", "sig_mapping_name": "x"}, {"sig_name": "a", "sig_mapping_name": "x"}]'
    assert mapping_from_json(spark, ok).count() == 1


def test_mapping_json_malformed_fails_clearly(spark):
    with pytest.raises(Exception, match="not an array"):
        mapping_from_json(spark, "{not json").collect()
    assert mapping_from_json(spark, "[]").count() == 0
