from pyspark.sql import functions as F

from sigflow.operators.ingest import decode_messages, encode_messages, quarantine_split, shape_telemetry
from sigflow.schemas import ACTIVE_POWER, DATE_TIME, RAW_SCHEMA, TELEMETRY_SCHEMA, WIND_SPEED, same_fields

ROW = ("01 01 2018 00:00", 380.047790527343, 5.31133604049682, 416.328907824861, 259.994903564453)


def _messages(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_encode_uses_raw_names_and_omits_nulls(spark):
    raw = spark.createDataFrame([ROW, ("01 01 2018 00:10", None, 1.0, 2.0, 3.0)], RAW_SCHEMA)
    values = [r.value for r in encode_messages(raw).collect()]
    assert values[0].startswith('{"Date/Time":"01 01 2018 00:00","LV ActivePower (kW)":380.047790527343')
    assert "Wind Direction (°)" in values[0]
    assert ACTIVE_POWER not in values[1]


def test_decode_permissive(spark):
    msgs = _messages(
        spark,
        [
            '{"Date/Time":"01 01 2018 00:00","LV ActivePower (kW)":1.5,"row_id":7}',
            "{bad",
            '{"Date/Time":"01 01 2018 00:10","LV ActivePower (kW)":"x","Wind Speed (m/s)":2.0}',
            '{"Date/Time":"01 01 2018 00:20","extra":1}',
        ],
    )
    rows = decode_messages(msgs).collect()
    assert decode_messages(msgs).columns == [f.name for f in RAW_SCHEMA.fields]
    assert rows[0][ACTIVE_POWER] == 1.5
    assert all(v is None for v in rows[1])
    assert rows[2][ACTIVE_POWER] is None and rows[2][WIND_SPEED] == 2.0
    assert rows[3][DATE_TIME] == "01 01 2018 00:20" and rows[3][ACTIVE_POWER] is None


def test_decode_accepts_binary_value(spark):
    msgs = spark.createDataFrame([(bytearray(b'{"Date/Time":"x"}'),)], "value binary")
    assert decode_messages(msgs).first()[DATE_TIME] == "x"


def test_shape_schema_and_values(spark):
    raw = spark.createDataFrame([ROW, ("xx", None, 1.0, 2.0, 3.0)], RAW_SCHEMA)
    tel = shape_telemetry(decode_messages(encode_messages(raw)))
    assert same_fields(tel.schema, TELEMETRY_SCHEMA)
    rows = tel.orderBy(F.col("signal_ts").asc_nulls_last()).collect()
    assert str(rows[0].signal_date) == "2018-01-01"
    assert rows[0].signals[ACTIVE_POWER] == "380.047790527343"
    # bad time text: row kept with null time and date; null value stays null in the map
    assert rows[1].signal_ts is None and rows[1].signal_date is None
    assert rows[1].signals[ACTIVE_POWER] is None
    assert rows[1].create_ts is not None


def test_malformed_message_row_and_quarantine(spark):
    tel = shape_telemetry(decode_messages(_messages(spark, ["{bad", '{"Date/Time":"01 01 2018 00:00"}'])))
    good, bad = quarantine_split(tel)
    assert good.count() == 1 and bad.count() == 1
    b = bad.first()
    assert b.signal_date is None and all(v is None for v in b.signals.values())
