"""DuckDB oracle SQL for the gallery, one statement per query key.

Independent formulations of the same results over the same parquet views
(``events``, ``documents``, ``orders`` ...).  Windows align to the Unix epoch
with ``time_bucket(..., TIMESTAMP '1970-01-01')``; sums of 2-decimal values
are DECIMAL(18,2); counts BIGINT.
"""

from __future__ import annotations

EPOCH = "TIMESTAMP '1970-01-01'"


def _tb(size: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{size}', {ts}, {EPOCH})"


READINGS = """(SELECT CAST(user_id AS VARCHAR) AS device,
       'line_' || CAST(user_id % 2 + 1 AS VARCHAR) AS area,
       event_type AS sensor, value, 'u_' || event_type AS unit, ts, event_id AS seq
  FROM events)"""

SENSOR_LINES = """(SELECT event_id AS seq,
  CASE WHEN event_id % 17 = 0 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || event_type || '|n/a|u_' || event_type
       WHEN event_id % 29 = 0 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || event_type || '|' || printf('%.3f', value) || '|u_' || event_type || '|x'
       WHEN event_id % 31 = 0 THEN 'T' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || event_type || '|' || printf('%.3f', value) || '|u_' || event_type
       ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || event_type || '|' || printf('%.3f', value) || '|u_' || event_type
  END AS value
  FROM events)"""

LEVEL = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END"

LOG_LINES = f"""(SELECT event_id AS seq,
  CASE WHEN event_id % 17 = 0 THEN {LEVEL} || ' | x | Message no. ' || CAST(event_id AS VARCHAR)
       WHEN event_id % 29 = 0 THEN {LEVEL} || ' | ' || CAST(epoch_us(ts) // 1000 AS VARCHAR)
       ELSE {LEVEL} || ' | ' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || ' | Message no. ' || CAST(event_id AS VARCHAR)
  END AS value
  FROM events)"""

# Parsed log lines (accepted only), as a relation.
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"

PARSED_LOGS = f"""(SELECT seq, trim(p[1], {WS}) AS level, CAST(trim(p[2], {WS}) AS BIGINT) AS ts_ms,
       trim(p[3], {WS}) AS message, 1 AS n
  FROM (SELECT seq, string_split(value, '|') AS p FROM {LOG_LINES})
  WHERE len(p) = 3 AND TRY_CAST(trim(p[2], {WS}) AS BIGINT) IS NOT NULL)"""

JSON_MESSAGES = """(SELECT event_id AS seq, user_id, ts, event_type, value,
  CASE WHEN event_id % 19 = 0 THEN NULL
       WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS shape
  FROM events)"""

DOC_LINES = """(SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"""

# Lower-cased whitespace tokens with their position in the line.
DOC_WORDS = f"""(SELECT doc_id, line_no, w.pos AS pos, w.word AS word FROM (
  SELECT doc_id, line_no,
         unnest(list_transform(toks, lambda x, i: {{'pos': CAST(i - 1 AS INTEGER), 'word': x}})) AS w
  FROM (SELECT doc_id, line_no,
               list_filter(regexp_split_to_array(lower(line), '\\s+'), lambda x: x <> '') AS toks
        FROM {DOC_LINES})))"""

LINE_METRICS = f"""(SELECT doc_id, line_no, CAST(length(line) AS INTEGER) AS n_chars,
       CAST(len(list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '')) AS INTEGER) AS n_words
  FROM {DOC_LINES})"""


ORACLE: dict[str, str] = {}

ORACLE["tumbling_avg"] = f"""
SELECT sensor, {_tb('1 hour')} AS window_start, {_tb('1 hour')} + INTERVAL '1 hour' AS window_end,
       CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) / count(*) AS avg_value, count(*) AS cnt, max(ts) AS max_ts
FROM {READINGS} GROUP BY ALL"""

ORACLE["tumbling_pairwise_avg"] = f"""
WITH r AS (SELECT *, {_tb('1 hour')} AS ws FROM {READINGS}),
k AS (SELECT *, row_number() OVER (PARTITION BY sensor, ws ORDER BY ts, seq) AS rn,
             count(*) OVER (PARTITION BY sensor, ws) AS n FROM r)
SELECT sensor, ws AS window_start, ws + INTERVAL '1 hour' AS window_end,
       CAST(floor(sum(value * pow(2.0, CASE WHEN rn = 1 THEN 1 - n ELSE rn - n - 1 END)) * 1000 + 0.3137) AS BIGINT)
         AS pairwise_avg_milli,
       max(ts) AS max_ts, count(*) AS cnt, arg_min(unit, (ts, seq)) AS first_unit
FROM k GROUP BY sensor, ws"""

ORACLE["tumbling_sum_count_avg"] = f"""
SELECT sensor, {_tb('30 minutes')} AS window_start, {_tb('30 minutes')} + INTERVAL '30 minutes' AS window_end,
       max(ts) AS max_ts, sum(CAST(value AS DECIMAL(18,2))) AS sum_value, count(*) AS cnt,
       CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) / count(*) AS avg_value
FROM {READINGS} GROUP BY ALL"""

ORACLE["tumbling_area_avg"] = f"""
SELECT area, {_tb('1 hour')} AS window_start, {_tb('1 hour')} + INTERVAL '1 hour' AS window_end,
       CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) / count(*) AS avg_value, count(*) AS cnt, max(ts) AS max_ts
FROM {READINGS} GROUP BY ALL"""

ORACLE["tumbling_first_over_count"] = f"""
SELECT area, {_tb('1 hour')} AS window_start, {_tb('1 hour')} + INTERVAL '1 hour' AS window_end,
       arg_min(value, (ts, seq)) / count(*) AS first_over_count,
       max(ts) AS max_ts, count(*) AS cnt, arg_min(sensor, (ts, seq)) AS first_sensor
FROM {READINGS} GROUP BY ALL"""

ORACLE["tumbling_count"] = f"""
SELECT event_type, {_tb('6 hours')} AS window_start, {_tb('6 hours')} + INTERVAL '6 hours' AS window_end,
       CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k, max(ts) AS max_ts
FROM events GROUP BY ALL"""

ORACLE["tumbling_log_levels"] = f"""
SELECT level, {_tb('1 hour', 'epoch_ms(ts_ms)')} AS window_start,
       {_tb('1 hour', 'epoch_ms(ts_ms)')} + INTERVAL '1 hour' AS window_end,
       max(ts_ms) AS max_ts_ms, arg_min(message, (epoch_ms(ts_ms), seq)) AS first_message,
       count(*) AS cnt
FROM {PARSED_LOGS} GROUP BY ALL"""

ORACLE["tumbling_class_count"] = f"""
SELECT class, {_tb('10 minutes')} AS window_start, {_tb('10 minutes')} + INTERVAL '10 minutes' AS window_end,
       count(*) AS cnt, max(ts) AS max_ts
FROM (SELECT ts, CASE WHEN contains(lower(event_type), 'purchase') THEN 'BUY'
                      WHEN contains(lower(event_type), 'click') THEN 'NAVIGATION'
                      WHEN contains(lower(event_type), 'view') THEN 'NAVIGATION'
                      ELSE 'OTHER' END AS class FROM events)
GROUP BY ALL"""

ORACLE["tumbling_word_count"] = f"""
SELECT event_type, {_tb('20 minutes')} AS window_start, {_tb('20 minutes')} + INTERVAL '20 minutes' AS window_end,
       count(*) AS cnt, max(ts) AS max_ts
FROM events GROUP BY ALL"""

ORACLE["sliding_count"] = f"""
SELECT event_type, ws AS window_start, ws + INTERVAL '10 minutes' AS window_end, count(*) AS cnt
FROM (SELECT event_type, {_tb('2 minutes')} - i * INTERVAL '2 minutes' AS ws
      FROM (SELECT event_type, ts, unnest(range(5)) AS i FROM events))
GROUP BY ALL"""

ORACLE["hopping_gapped"] = f"""
SELECT event_type, {_tb('5 minutes')} AS window_start, {_tb('5 minutes')} + INTERVAL '2 minutes' AS window_end,
       count(*) AS cnt, max(ts) AS max_ts
FROM events WHERE ts - {_tb('5 minutes')} < INTERVAL '2 minutes'
GROUP BY ALL"""

ORACLE["event_time"] = """
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, epoch_ms(epoch_us(ts) // 1000) AS event_ts FROM events"""

ORACLE["keyed_sum"] = """
SELECT user_id, sum(CAST(value AS DECIMAL(18,2))) AS total, count(*) AS cnt FROM events GROUP BY user_id"""

ORACLE["running_sum"] = """
SELECT event_id AS seq, event_type AS sensor, value,
       sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total
FROM events"""

ORACLE["row_count"] = "SELECT count(*) AS n_rows FROM events"

ORACLE["global_line_stats"] = f"""
SELECT sum(n_chars) / count(*) AS avg_chars, sum(n_words) / count(*) AS avg_words, count(*) AS n_lines
FROM {LINE_METRICS}"""

ORACLE["running_global_stats"] = f"""
SELECT doc_id, line_no,
       count(*) OVER w AS n_lines,
       sum(n_chars) OVER w / count(*) OVER w AS avg_chars,
       sum(n_words) OVER w / count(*) OVER w AS avg_words
FROM {LINE_METRICS}
WINDOW w AS (ORDER BY doc_id, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

ORACLE["text_lines"] = f"SELECT doc_id, line_no, line FROM {DOC_LINES}"

ORACLE["line_metrics"] = f"SELECT * FROM {LINE_METRICS}"

ORACLE["word_tokens"] = f"SELECT doc_id, line_no, pos, word FROM {DOC_WORDS} WHERE length(word) > 2"

ORACLE["word_count"] = f"SELECT word, count(*) AS cnt FROM {DOC_WORDS} WHERE length(word) > 2 GROUP BY word"

ORACLE["stopword_filter"] = f"""
SELECT word, count(*) AS cnt FROM {DOC_WORDS}
WHERE length(word) > 2 AND word NOT IN ('the', 'and', 'for', 'that', 'with') GROUP BY word"""

ORACLE["classify_lines"] = f"""
SELECT doc_id, line_no,
       CASE WHEN contains(lower(line), 'docker') THEN 'DOCKER'
            WHEN contains(lower(line), 'ls') THEN 'NAVIGATION'
            WHEN contains(lower(line), 'cd') THEN 'NAVIGATION'
            ELSE 'OTHER' END AS class
FROM {DOC_LINES}"""

ORACLE["distinct_lines"] = f"""
SELECT DISTINCT l AS line FROM (SELECT trim(line, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) AS l FROM {DOC_LINES})
WHERE l <> ''"""

ORACLE["parse_lines"] = f"""
SELECT seq, CAST(p[1] AS BIGINT) AS ts_ms, p[2] AS sensor, CAST(p[3] AS DOUBLE) AS value, p[4] AS unit, 1 AS n
FROM (SELECT seq, string_split(value, '|') AS p FROM {SENSOR_LINES})
WHERE len(p) = 4 AND TRY_CAST(p[1] AS BIGINT) IS NOT NULL AND TRY_CAST(p[3] AS DOUBLE) IS NOT NULL"""

ORACLE["parse_rejects"] = f"""
SELECT seq, value AS raw,
       CASE WHEN len(p) <> 4 THEN 'field_count'
            WHEN TRY_CAST(p[1] AS BIGINT) IS NULL THEN 'bad_ts'
            ELSE 'bad_value' END AS reason
FROM (SELECT seq, value, string_split(value, '|') AS p FROM {SENSOR_LINES})
WHERE NOT (len(p) = 4 AND TRY_CAST(p[1] AS BIGINT) IS NOT NULL AND TRY_CAST(p[3] AS DOUBLE) IS NOT NULL)"""

ORACLE["parse_logs"] = f"SELECT seq, level, ts_ms, message, n FROM {PARSED_LOGS}"

ORACLE["parse_json"] = f"""
SELECT seq,
       CASE WHEN shape = 'A' THEN event_type ELSE upper(event_type) END AS sensor,
       CASE WHEN shape = 'A' THEN 'line_' || CAST(user_id % 2 + 1 AS VARCHAR) END AS area,
       value, epoch_us(ts) // 1000 AS ts_ms,
       CASE WHEN shape = 'B' THEN 1 END AS count
FROM {JSON_MESSAGES} WHERE shape IS NOT NULL"""

ORACLE["format_report"] = f"""
SELECT sensor, window_start,
       printf('Sensor: %s | Avg: %.2f %s | Count: %d | Window: %s', sensor,
              sign(m) * ((abs(m) * 2 + cnt * 10000) // (cnt * 20000)) / 100.0, unit, cnt,
              strftime(max_ts, '%H:%M:%S')) AS line
FROM (SELECT sensor, {_tb('1 hour')} AS window_start, sum(CAST(round(value * 1000000) AS HUGEINT)) AS m,
             count(*) AS cnt, max(ts) AS max_ts, any_value(unit) AS unit
      FROM {READINGS} GROUP BY ALL)"""


# ---------------------------------------------------------------------------
# Projection, recode, JSON encode
# ---------------------------------------------------------------------------

ORACLE["filter_project"] = "SELECT event_id, user_id, value FROM events WHERE value > 40"

ORACLE["conditional_recode"] = """
SELECT event_id, CASE WHEN event_type = 'signup' THEN 'register' ELSE event_type END AS event_type, value
FROM events"""

ORACLE["db_row_projection"] = f"""
SELECT seq, CASE WHEN shape = 'A' THEN 'line_' || CAST(user_id % 2 + 1 AS VARCHAR) END AS area,
       CASE WHEN shape = 'A' THEN event_type ELSE upper(event_type) END AS sensor_id, value AS avg_value, 1 AS cnt, epoch_us(ts) // 1000 AS ts
FROM {JSON_MESSAGES} WHERE shape IS NOT NULL"""

ORACLE["encode_json"] = """
SELECT event_id AS seq, event_type AS key,
       CAST(json_object('sensor_id', event_type, 'area', 'line_' || CAST(user_id % 2 + 1 AS VARCHAR),
                        'value', value, 'timestamp', epoch_us(ts) // 1000) AS VARCHAR) AS value
FROM events"""

# ---------------------------------------------------------------------------
# Joins and top-k (readings := orders, oee := lineitem, locations := supplier)
# ---------------------------------------------------------------------------

ORACLE["left_join_fanout"] = """
SELECT o_orderkey AS sensor, o_orderdate AS record_time, o_totalprice AS value,
       l_linenumber AS line, l_quantity AS up_time, l_suppkey AS location
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"""

ORACLE["left_join_chain"] = """
SELECT l_orderkey AS sensor_id, l_linenumber AS line, l_suppkey AS location, s_name AS site_name,
       s_nationkey AS address_number, n_name
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey"""

ORACLE["report_top6"] = """
SELECT o_orderkey AS sensor, l_suppkey AS location, s_name AS site_name, s_nationkey AS address_number,
       o_totalprice AS value, o_orderpriority AS unit, l_quantity AS up_time, o_orderdate AS record_time
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
ORDER BY o_orderdate DESC, o_orderkey DESC, l_linenumber ASC NULLS FIRST LIMIT 6"""

ORACLE["top_words"] = f"""
SELECT word, count(*) AS cnt FROM {DOC_WORDS} WHERE length(word) > 2
GROUP BY word ORDER BY cnt DESC, word ASC LIMIT 25"""

ORACLE["top_words_sql"] = ORACLE["top_words"]

ORACLE["tail_n"] = f"SELECT doc_id, line_no, line FROM {DOC_LINES} ORDER BY doc_id DESC, line_no DESC LIMIT 10"

ORACLE["top_n_per_key"] = """
SELECT sensor, seq, value FROM (
  SELECT event_type AS sensor, event_id AS seq, value,
         row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id ASC) AS rn FROM events)
WHERE rn <= 3"""

# ---------------------------------------------------------------------------
# Table maintenance and constraints
# ---------------------------------------------------------------------------

ORACLE["upsert_readings"] = f"""
WITH h AS (SELECT event_type AS sensor, 'u_' || event_type AS unit,
                  TRY_CAST(round(value, 2) AS DECIMAL(5,2)) AS value,
                  {_tb('1 hour')} AS record_time, event_id, ts FROM events),
stored AS (SELECT sensor, record_time, arg_min(unit, event_id) AS unit, arg_min(value, event_id) AS value
           FROM h WHERE ts < TIMESTAMP '2024-01-16' GROUP BY sensor, record_time),
batch AS (SELECT sensor, record_time, arg_max(unit, event_id) AS unit, arg_max(value, event_id) AS value
          FROM h WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY sensor, record_time)
SELECT sensor, record_time, unit, value FROM stored s
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.sensor = s.sensor AND b.record_time = s.record_time)
UNION ALL SELECT sensor, record_time, unit, value FROM batch"""

ORACLE["upsert_oee"] = """
WITH stored AS (SELECT o_custkey AS sensor_id, o_orderdate AS record_time,
                       arg_min(o_totalprice, o_orderkey) AS up_time, arg_min(o_orderpriority, o_orderkey) AS location
                FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY ALL),
batch AS (SELECT o_custkey AS sensor_id, o_orderdate AS record_time,
                 arg_max(o_totalprice, o_orderkey) AS up_time, arg_max(o_orderpriority, o_orderkey) AS location
          FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY ALL)
SELECT * FROM stored s
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.sensor_id = s.sensor_id AND b.record_time = s.record_time)
UNION ALL SELECT * FROM batch"""

ORACLE["insert_ignore"] = """
WITH stored AS (SELECT o_custkey AS location_code, arg_min(o_orderpriority, o_orderkey) AS site_name,
                       min(o_orderkey) AS address_number
                FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY ALL),
batch AS (SELECT o_custkey AS location_code, arg_min(o_orderpriority, o_orderkey) AS site_name,
                 min(o_orderkey) AS address_number
          FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY ALL)
SELECT * FROM stored
UNION ALL SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.location_code = b.location_code)"""

ORACLE["pk_violations"] = f"""
SELECT event_type, {_tb('1 minute')} AS minute, count(*) AS n,
       (event_type IS NULL OR {_tb('1 minute')} IS NULL) AS has_null
FROM events GROUP BY ALL HAVING count(*) > 1 OR bool_or(event_type IS NULL)"""

ORACLE["decimal_fit"] = """
SELECT l_orderkey, l_linenumber, TRY_CAST(round(l_extendedprice, 2) AS DECIMAL(5,2)) AS price_5_2,
       TRY_CAST(round(l_extendedprice, 2) AS DECIMAL(5,2)) IS NOT NULL AS fits
FROM lineitem"""

ORACLE["length_check"] = """
SELECT page_id, CAST(length(url) AS INTEGER) AS url_len, (url IS NULL OR length(url) <= 40) AS url_ok FROM pages"""

# ---------------------------------------------------------------------------
# Telemetry (lineitem rows as device polls).  Map tables are rendered from
# the same fixed layouts the Spark side uses.
# ---------------------------------------------------------------------------

from tagstream import schemas as _S  # noqa: E402

_LAYOUTS = {"water_plant": _S.WATER_PLANT_REGISTERS, "tank": _S.TANK_REGISTERS, "belt": _S.BELT_REGISTERS}


def _values(rows, names):
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) t({', '.join(names)}))"


def _lit(v):
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


REGMAP = _values([(c, p, t, float(d), u) for c, lay in _LAYOUTS.items() for p, t, d, u in lay],
                 ["device_class", "pos", "tag", "divisor", "unit"])

ENCODED = """(SELECT l_orderkey, l_linenumber, l_suppkey AS device, l_shipdate AS ts,
  CASE l_suppkey % 3 WHEN 0 THEN 'water_plant' WHEN 1 THEN 'tank' ELSE 'belt' END AS device_class,
  [CAST(trunc(l_quantity * 100) AS INTEGER), CAST(trunc(l_discount * 1000) AS INTEGER),
   CAST(trunc(l_tax * 1000) AS INTEGER), CAST(trunc(l_extendedprice * CAST(0.1 AS DOUBLE)) AS INTEGER),
   CAST(l_partkey % 1400 AS INTEGER), CAST((epoch_us(l_shipdate) // 1000000) % 65535 AS INTEGER)] AS registers,
  [l_returnflag = 'R', l_linestatus = 'O', l_discount > 0.05, l_quantity > 25, l_tax > 0.04,
   l_returnflag = 'A', l_quantity < 3, l_discount < 0.09] AS bits
  FROM lineitem)"""

SHORT_POLLS = f"""(SELECT l_orderkey, l_linenumber, device, ts, device_class,
  registers[1:least(6, l_linenumber + 1)] AS registers, bits[1:least(8, l_linenumber + 3)] AS bits FROM {ENCODED})"""


def _wide_regs(layout, src="registers"):
    return ", ".join(f"coalesce({src}[{p + 1}], 0) / CAST({float(d)!r} AS DOUBLE) AS {t}" for p, t, d, _u in layout)


def _bits(names, src="bits"):
    return ", ".join(f"coalesce({src}[{i + 1}], false) AS {n}" for i, n in enumerate(names))


BITS_DECODED = f"(SELECT l_orderkey, l_linenumber, {_bits(_S.WATER_PLANT_BITS)} FROM {ENCODED})"

_STATUS_AS = [("pump_running", "pump_status"), ("valve_open", "valve_status"), ("heater_on", "heater_status"),
              ("temp_alarm", "temp_alarm"), ("pressure_alarm", "pressure_alarm")]

WIDE_POLL = f"""(SELECT l_orderkey, l_linenumber, {_wide_regs(_S.WATER_PLANT_REGISTERS[:5])},
  {", ".join(f"CAST(coalesce(bits[{_S.WATER_PLANT_BITS.index(a) + 1}], false) AS DOUBLE) AS {b}" for a, b in _STATUS_AS)}
  FROM {ENCODED})"""

_UNIT_CASE = "CASE sensor " + " ".join(f"WHEN '{t}' THEN '{u}'" for t, u in _S.POLL_UNITS) + " END"

LONG_READINGS = f"""(SELECT l_orderkey, l_linenumber, sensor, round(value, 3) AS value, {_UNIT_CASE} AS unit
  FROM (UNPIVOT {WIDE_POLL} ON {", ".join(t for t, _u in _S.POLL_UNITS)} INTO NAME sensor VALUE value))"""

ORACLE["encode_registers"] = f"SELECT l_orderkey, l_linenumber, registers FROM {ENCODED}"

ORACLE["decode_registers"] = f"""
SELECT l_orderkey, l_linenumber, tag, raw, raw / divisor AS value, unit
FROM (SELECT l_orderkey, l_linenumber, device_class, unnest(registers) AS raw,
             unnest(range(len(registers))) AS pos FROM {ENCODED}) x
JOIN {REGMAP} m USING (device_class, pos)"""

ORACLE["decode_registers_default"] = f"""
SELECT l_orderkey, l_linenumber, tag, coalesce(registers[pos + 1], 0) / divisor AS value, unit,
       registers[pos + 1] IS NULL AS is_default
FROM {SHORT_POLLS} p JOIN {REGMAP} m USING (device_class)"""

ORACLE["decode_bits"] = f"""
SELECT l_orderkey, l_linenumber, {_bits(_S.WATER_PLANT_BITS)}, CAST(coalesce(len(bits), 0) AS INTEGER) AS bits_read
FROM {SHORT_POLLS}"""

_ALARM_PARTS = ", ".join(f"CASE WHEN {b} = {str(pol).lower()} THEN '{txt}' END" for b, pol, txt in _S.ALARM_TEXTS)

ORACLE["alarm_list"] = f"""
SELECT l_orderkey, l_linenumber, a AS alarms,
       CASE WHEN len(a) = 0 THEN '{_S.ALL_NORMAL}' ELSE array_to_string(a, '; ') END AS alarm_text
FROM (SELECT l_orderkey, l_linenumber, list_filter([{_ALARM_PARTS}], lambda x: x IS NOT NULL) AS a
      FROM {BITS_DECODED})"""

ORACLE["unpivot_readings"] = f"SELECT * FROM {LONG_READINGS}"

RULES = _values(_S.THRESHOLD_RULES, ["sensor", "op", '"limit"', "label"])

ORACLE["threshold_alarms"] = f"""
SELECT r.l_orderkey, r.l_linenumber, r.sensor, r.value, r.unit, t."limit" AS "limit", t.label
FROM {LONG_READINGS} r JOIN {RULES} t ON r.sensor = t.sensor
WHERE CASE t.op WHEN '>' THEN r.value > t."limit" WHEN '>=' THEN r.value >= t."limit"
                WHEN '<' THEN r.value < t."limit" WHEN '<=' THEN r.value <= t."limit" ELSE false END"""

ORACLE["latest_snapshot"] = """
SELECT CAST(user_id AS VARCHAR) AS device, event_type AS sensor, arg_max(value, (ts, event_id)) AS value,
       max(ts) AS latest_ts
FROM events GROUP BY ALL"""

ORACLE["dashboard"] = f"""
WITH last AS (SELECT device, arg_max(registers, (ts, l_orderkey, l_linenumber, registers, bits)) AS registers,
                     arg_max(bits, (ts, l_orderkey, l_linenumber, registers, bits)) AS bits
              FROM {ENCODED} GROUP BY device),
sp AS (SELECT s_suppkey AS device, [CAST(trunc(s_acctbal) AS INTEGER), CAST(s_nationkey * 100 AS INTEGER),
                                    CAST(s_suppkey % 1000 AS INTEGER)] AS spr
       FROM supplier)
SELECT last.device AS device, {_wide_regs(_S.WATER_PLANT_REGISTERS)}, {_bits(_S.WATER_PLANT_BITS)},
       CASE WHEN sp.device IS NOT NULL THEN coalesce(spr[1], 0) / 100.0::DOUBLE END AS temp_setpoint,
       CASE WHEN sp.device IS NOT NULL THEN coalesce(spr[2], 0) / 100.0::DOUBLE END AS pressure_setpoint,
       CASE WHEN sp.device IS NOT NULL THEN coalesce(spr[3], 0) / 10.0::DOUBLE END AS flow_setpoint
FROM last LEFT JOIN sp ON last.device = sp.device"""

ORACLE["normalize_tags"] = """
SELECT event_id, event_type AS original,
       CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'tap' ELSE event_type END AS tag
FROM events"""

ORACLE["multi_device_union"] = """
SELECT 'tank_' || CAST(s_suppkey AS VARCHAR) AS device, s_acctbal AS temperature,
       CAST(s_nationkey AS DOUBLE) AS pressure FROM supplier
UNION ALL BY NAME
SELECT 'disinfection_' || CAST(c_custkey AS VARCHAR) AS device, c_acctbal AS uv,
       CAST(c_nationkey AS DOUBLE) AS chlorine, CAST(length(c_name) AS DOUBLE) AS turbidity FROM customer"""

ORACLE["device_list"] = "SELECT DISTINCT l_suppkey AS device FROM lineitem"

# ---------------------------------------------------------------------------
# Scalar projections
# ---------------------------------------------------------------------------

ORACLE["scalar_text"] = """
SELECT event_id, lower(event_type) AS lower_type, upper(event_type) AS upper_type,
       CAST(length(props) AS INTEGER) AS props_len,
       trim('  ' || event_type || ' ', ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) AS trimmed,
       contains(props, '9') AS has_nine, event_type IN ('click', 'view') AS in_list,
       trim(replace(string_split(props, ':')[2], '}', ''), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) AS k_text
FROM events"""

ORACLE["scalar_numeric"] = """
SELECT l_orderkey, l_linenumber,
       TRY_CAST(CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS INTEGER) AS qty_parsed,
       greatest(l_quantity, l_tax * 1000) AS max_of_two,
       round(l_discount * 100, 0) AS discount_pct,
       CAST(l_returnflag = 'R' AS DOUBLE) AS returned_num,
       CAST(l_linenumber % 2 AS BOOLEAN) AS odd_line,
       CAST(trunc(l_tax * 100) AS INTEGER) AS tax_x100
FROM lineitem"""

ORACLE["scalar_time"] = """
SELECT event_id, strftime(ts, '%H:%M:%S') AS hhmmss, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime_text,
       (epoch_us(ts) // 1000000) % 65535 AS clock16, epoch_us(ts) // 1000 AS ts_ms
FROM events"""


# ---------------------------------------------------------------------------
# Streams (results equal the batch formulation)
# ---------------------------------------------------------------------------

ORACLE["stream_tumbling"] = ORACLE["tumbling_avg"]

ORACLE["file_sink_roundtrip"] = f"""
SELECT printf('%s | %s | Value: %.2f | Ts: %d',
              CASE WHEN shape = 'A' THEN 'line_' || CAST(user_id % 2 + 1 AS VARCHAR) ELSE '-' END,
              CASE WHEN shape = 'A' THEN event_type ELSE upper(event_type) END,
              value, epoch_us(ts) // 1000) AS value
FROM {JSON_MESSAGES} WHERE shape IS NOT NULL"""

ORACLE["running_sum_stream"] = """
SELECT event_id AS seq, event_type AS sensor, value,
       round(sum(value) OVER (PARTITION BY event_type ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running_total
FROM events"""

ORACLE["distinct_lines_stream"] = ORACLE["distinct_lines"]

ORACLE["kafka_json_stream"] = ORACLE["parse_json"]

ORACLE["running_sum_stream_batches"] = ORACLE["running_sum_stream"]

ORACLE["area_window_report_stream"] = f"""
WITH r AS (SELECT seq, CASE WHEN shape = 'A' THEN 'line_' || CAST(user_id % 2 + 1 AS VARCHAR) ELSE '-' END AS area,
                  CASE WHEN shape = 'A' THEN event_type ELSE upper(event_type) END AS sensor, value,
                  epoch_us(ts) // 1000 AS ts_ms
           FROM {JSON_MESSAGES} WHERE shape IS NOT NULL),
g AS (SELECT area, {_tb('1 hour', 'epoch_ms(ts_ms)')} AS window_start, arg_min(sensor, (ts_ms, seq)) AS first_sensor,
             count(*) AS cnt, max(ts_ms) AS max_ts_ms, sum(CAST(round(value * 1000000) AS HUGEINT)) AS m
      FROM r GROUP BY ALL)
SELECT area, window_start,
       printf('%s | %s | Avg. Value: %.2f | Count: %d | Ts: %d', area, first_sensor,
              sign(m) * ((abs(m) * 2 + cnt * 10000) // (cnt * 20000)) / 100.0, cnt, max_ts_ms) AS line
FROM g"""

ORACLE["upsert_partitioned"] = ORACLE["upsert_readings"]

ORACLE["distinct_lines_exact_stream"] = ORACLE["distinct_lines"]

ORACLE["log_levels_stream"] = ORACLE["tumbling_log_levels"]

ORACLE["sensor_lines_stream"] = f"""
WITH ok AS (SELECT seq, CAST(p[1] AS BIGINT) AS ts_ms, p[2] AS sensor, CAST(p[3] AS DOUBLE) AS value
            FROM (SELECT seq, string_split(value, '|') AS p FROM {SENSOR_LINES})
            WHERE len(p) = 4 AND TRY_CAST(p[1] AS BIGINT) IS NOT NULL AND TRY_CAST(p[3] AS DOUBLE) IS NOT NULL)
SELECT sensor, {_tb('1 hour', 'epoch_ms(ts_ms)')} AS window_start,
       CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) / count(*) AS avg_value,
       count(*) AS cnt, max(ts_ms) AS max_ts_ms
FROM ok GROUP BY ALL"""

ORACLE["row_count_stream"] = ORACLE["row_count"]

ORACLE["tumbling_pairwise_stream"] = ORACLE["tumbling_pairwise_avg"]


# ---------------------------------------------------------------------------
# Arrival-time windows, reject tables, defaults, the second rule set
# ---------------------------------------------------------------------------

ORACLE["ingest_mean_report"] = f"""
WITH g AS (SELECT sensor, {_tb('30 minutes', 'epoch_ms(ts_ms + seq % 97 * 1000)')} AS window_start,
                  sum(CAST(round(value * 1000000) AS HUGEINT)) AS m, count(*) AS cnt, max(ts_ms) AS max_ts_ms
           FROM ({ORACLE["parse_json"]}) GROUP BY ALL)
SELECT sensor, window_start,
       printf('%d | Sensor: %s | Avg Value: %.2f | Count: %d', max_ts_ms, sensor,
              sign(m) * ((abs(m) * 2 + cnt * 10000) // (cnt * 20000)) / 100.0, cnt) AS line
FROM g"""

ORACLE["ingest_log_report"] = f"""
WITH g AS (SELECT level, {_tb('30 minutes', 'epoch_ms(ts_ms + seq % 97 * 1000)')} AS window_start,
                  max(ts_ms) AS max_ts_ms, count(*) AS cnt
           FROM {PARSED_LOGS} GROUP BY ALL)
SELECT level, window_start, printf('%s | Count: %d | TS: %d', level, cnt, max_ts_ms) AS line FROM g"""

ORACLE["words_with_ingest"] = f"""
SELECT doc_id, word, 1 AS n, epoch_ms(doc_id * 1000) AS ingest_ts FROM {DOC_WORDS} WHERE length(word) > 2"""

ORACLE["ingest_word_count"] = f"""
SELECT word, {_tb('5 minutes', 'ingest_ts')} AS window_start,
       {_tb('5 minutes', 'ingest_ts')} + INTERVAL '5 minutes' AS window_end, count(*) AS cnt
FROM ({ORACLE["words_with_ingest"]}) GROUP BY ALL"""

ORACLE["ingest_word_sliding"] = f"""
SELECT word, window_start, window_start + INTERVAL '10 minutes' AS window_end, count(*) AS cnt
FROM (SELECT word, {_tb('5 minutes', 'ingest_ts')} - to_minutes(unnest([0, 5])) AS window_start
      FROM ({ORACLE["words_with_ingest"]}))
GROUP BY ALL"""

ORACLE["parse_rejects_logs"] = f"""
SELECT seq, value AS raw, CASE WHEN len(string_split(value, '|')) <> 3 THEN 'field_count' ELSE 'bad_ts' END AS reason
FROM {LOG_LINES}
WHERE seq NOT IN (SELECT seq FROM {PARSED_LOGS})"""

ORACLE["parse_rejects_json"] = f"""
SELECT seq, '{{bad ' || CAST(seq AS VARCHAR) AS raw, 'malformed' AS reason
FROM {JSON_MESSAGES} WHERE shape IS NULL"""

ORACLE["pk_violations_single"] = """
SELECT o_custkey AS location_code, count(*) AS n, o_custkey IS NULL AS has_null
FROM orders GROUP BY o_custkey HAVING count(*) > 1 OR o_custkey IS NULL"""

ORACLE["default_timestamps"] = """
SELECT event_id, CASE WHEN event_type <> 'signup' THEN ts ELSE TIMESTAMP '2024-02-01' END AS record_time
FROM events"""

ORACLE["threshold_alarms_second"] = ORACLE["threshold_alarms"].replace(
    RULES, _values(_S.SECOND_THRESHOLD_RULES, ["sensor", "op", '"limit"', "label"]))

ORACLE["stream_static_join"] = """
SELECT event_id, user_id, value, c_name, c_nationkey
FROM events LEFT JOIN customer ON user_id = c_custkey"""


# ---------------------------------------------------------------------------
# Growing files, general folds, recovery, late rows, live state
# ---------------------------------------------------------------------------

ORACLE["follow_growing_files"] = f"SELECT doc_id, line_no, line FROM {DOC_LINES}"

ORACLE["exponential_mean"] = f"""
SELECT sensor, {_tb('1 hour')} AS window_start,
       CAST(floor(list_reduce(list(value ORDER BY ts, seq), lambda acc, v: acc * 0.8 + v * 0.2) * 1000 + 0.3137) AS BIGINT) AS ema_milli,
       count(*) AS cnt, max(ts) AS max_ts, arg_min(unit, (ts, seq)) AS first_unit
FROM {READINGS} GROUP BY ALL"""

ORACLE["exponential_mean_stream"] = ORACLE["exponential_mean"]

ORACLE["recovered_windows"] = ORACLE["tumbling_avg"]

ORACLE["late_rows"] = f"""
SELECT sensor, count(*) AS rows_kept, (SELECT count(*) FROM events) AS rows_counted FROM {READINGS} GROUP BY sensor"""

ORACLE["live_snapshot"] = ORACLE["latest_snapshot"]

ORACLE["top_words_stream"] = ORACLE["top_words"]

ORACLE["point_lookup"] = f"""
SELECT seq, sensor, ts, value FROM {READINGS} ORDER BY value DESC, seq LIMIT 100"""

ORACLE["upsert_bucketed"] = ORACLE["upsert_readings"]

ORACLE["versioned_join"] = """
SELECT event_id, user_id, value,
       CASE WHEN event_id * 8 < 4 * (SELECT max(event_id) + 1 FROM events) THEN c_name ELSE upper(c_name) END AS c_name,
       c_nationkey
FROM events LEFT JOIN customer ON user_id = c_custkey"""

ORACLE["snapshot_table"] = "SELECT event_id AS seq, event_type AS sensor, value FROM events"

ORACLE["catalog_table"] = f"""
SELECT area, sensor AS sensor_id, CAST(sum(CAST(value AS DECIMAL(24,6))) AS DOUBLE) / count(*) AS avg_value,
       CAST(count(*) AS INTEGER) AS cnt, max(epoch_us(ts) // 1000) AS ts
FROM {READINGS} GROUP BY ALL"""

ORACLE["fan_out_stream"] = """
SELECT event_type AS sensor, count(*) AS rows_stored, max(value) AS max_value, count(*) AS rows_counted
FROM events GROUP BY event_type"""
