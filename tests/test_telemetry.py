from pyspark.sql import functions as F

from tagstream import schemas as S
from tagstream.operators import telemetry as TM


def _polls(spark, regs, bits=None):
    rows = [(i, "water_plant", r, b) for i, (r, b) in enumerate(zip(regs, bits or [[]] * len(regs)))]
    return spark.createDataFrame(rows, "pid int, device_class string, registers array<int>, bits array<boolean>")


def test_decode_registers_with_defaults(spark):
    # G13
    m = TM.register_map(spark, {"water_plant": S.WATER_PLANT_REGISTERS})
    p = _polls(spark, [[2250, 350, 280, 1500, 720], [2250]])
    out = {(r.pid, r.tag): (r.value, r.is_default) for r in TM.decode_registers_default(p, m, ["pid"]).collect()}
    assert out[(0, "temperature")] == (22.5, False) and out[(0, "flow_rate")] == (150.0, False)
    assert out[(0, "ph_level")] == (7.2, False) and out[(0, "timestamp")] == (0.0, True)
    assert out[(1, "inlet_pressure")] == (0.0, True)
    present = TM.decode_registers(p, m, ["pid"]).where("pid = 1").collect()
    assert [(r.tag, r.value) for r in present] == [("temperature", 22.5)]


def test_bits_and_alarms(spark):
    # G14
    bits = [[True, True, False, True, True, False, False, True],
            [True, True, False, True, False, False, False, True],
            [True, True, False, True, False]]
    p = _polls(spark, [[]] * 3, bits)
    st = TM.decode_bits(p, S.WATER_PLANT_BITS, ["pid"])
    got = {r.pid: r.alarm_text for r in TM.alarm_list(st, ["pid"]).collect()}
    assert got == {0: "HIGH TEMPERATURE", 1: S.ALL_NORMAL, 2: "SYSTEM NOT HEALTHY"}


def test_encode_truncates(spark):
    # 1.239 -> 123, -1.239 -> -123
    df = spark.createDataFrame([(0, 1.239), (1, -1.239)], "i int, v double")
    got = [r.registers for r in TM.encode_registers(df, [("v", 100)], ["i"]).orderBy("i").collect()]
    assert got == [[123], [-123]]


def test_unpivot_units_and_thresholds(spark):
    wide = spark.createDataFrame([(1, 31.0, 4.5, 60.0, True)],
                                 "pid int, temperature double, inlet_pressure double, flow_rate double, pump_status boolean")
    long = TM.unpivot_readings(wide, ["pid"], ["temperature", "inlet_pressure", "flow_rate", "pump_status"],
                               dict(S.POLL_UNITS))
    got = {r.sensor: (r.value, r.unit) for r in long.collect()}
    assert got["pump_status"] == (1.0, "boolean") and got["temperature"] == (31.0, "celsius")
    alarms = sorted(r.label for r in TM.threshold_alarms(long, spark, S.THRESHOLD_RULES).collect())
    assert alarms == ["flow_high", "pressure_alarm", "temp_alarm"]


def test_aliases_union_latest_dashboard(spark):
    df = spark.createDataFrame([("PhLevel",), ("Other",)], "tag string")
    assert [r.tag for r in TM.normalize_tags(df, S.TAG_ALIASES).collect()] == ["PhRatio", "Other"]
    a = spark.createDataFrame([("tank", 1.0, 2.0)], "device string, temperature double, pressure double")
    b = spark.createDataFrame([("dis", 3.0)], "device string, uv double")
    u = TM.union_devices([a, b])
    assert set(u.columns) == {"device", "temperature", "pressure", "uv"} and u.count() == 2
    r = spark.createDataFrame([("d", "t", 1.0, 1, 1), ("d", "t", 2.0, 2, 2), ("d", "t", 3.0, 2, 1)],
                              "device string, sensor string, value double, ts long, seq long")
    snap = TM.latest_snapshot(r, ["device", "sensor"], ["value"], ["ts", "seq"]).collect()[0]
    assert snap.value == 2.0
    sens = spark.createDataFrame([("d1", 1.0), ("d2", 2.0)], "device string, temperature double")
    stat = spark.createDataFrame([("d1", True)], "device string, pump_running boolean")
    sp = spark.createDataFrame([("d9", 5.0)], "device string, temp_setpoint double")
    d = TM.dashboard(sens, stat, sp, "device").collect()
    assert [(x.device, x.temp_setpoint) for x in d] == [("d1", None)]
    assert sorted(r.device for r in TM.device_list(sens).collect()) == ["d1", "d2"]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-300, 300, allow_nan=False), min_size=1, max_size=30), st.sampled_from([10, 100]))
def test_encode_decode_within_one_step(spark, values, factor):
    # SURVEY 5 property: decode(encode(v)) is within 1/factor of v
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    enc = TM.encode_registers(df, [("v", factor)], ["i"]).withColumn("device_class", F.lit("x"))
    m = TM.register_map(spark, {"x": [(0, "v", float(factor), "u")]})
    dec = {r.i: r.value for r in TM.decode_registers(enc, m, ["i"]).collect()}
    assert all(abs(dec[i] - v) < 1.0 / factor + 1e-9 for i, v in enumerate(values))
