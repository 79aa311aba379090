"""DuckDB SQL that must give the same rows as each registered query."""

from __future__ import annotations

CUTOFF = "DATE '1996-12-01'"
ELIGIBLE = f"o_orderdate < {CUTOFF} AND o_orderkey % 10 BETWEEN 0 AND 9 AND o_orderstatus IN ('F', 'P')"


def worker(key: str) -> str:
    """Digits 0-3, 4-6, 7-9."""
    return f"CAST(CASE WHEN {key} % 10 <= 3 THEN 0 WHEN {key} % 10 <= 6 THEN 1 ELSE 2 END AS INTEGER)"


NUMBERED = f"""
numbered AS (
  SELECT o_orderkey, {worker('o_orderkey')} AS worker,
         CAST((row_number() OVER (PARTITION BY {worker('o_orderkey')} ORDER BY o_orderkey) - 1) // 20 + 1 AS BIGINT) AS batch_no
  FROM orders WHERE {ELIGIBLE})"""

LEDGER = NUMBERED + """,
lines AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
counted AS (
  SELECT worker, batch_no, count(*) AS roots, CAST(count(*) + coalesce(sum(n), 0) AS BIGINT) AS records
  FROM numbered LEFT JOIN lines ON l_orderkey = o_orderkey GROUP BY worker, batch_no),
ledger AS (SELECT 'run-1' AS run_id, worker, batch_no, roots, records, records * 1000 + roots AS duration_us FROM counted)"""


def clock(us: str) -> str:
    """Microseconds as HH:MM:SS with the fraction, if any, without trailing zeros."""
    return (f"printf('%02d:%02d:%02d', CAST({us} // 3600000000 AS BIGINT), CAST({us} // 60000000 % 60 AS BIGINT), "
            f"CAST({us} // 1000000 % 60 AS BIGINT)) || CASE WHEN {us} % 1000000 > 0 THEN "
            f"'.' || rtrim(printf('%06d', CAST({us} % 1000000 AS BIGINT)), '0') ELSE '' END")


def stamp(us: str) -> str:
    return f"strftime(TIMESTAMP '1998-01-01 10:55:00' + to_microseconds(CAST({us} AS BIGINT)), '%Y-%m-%d %H:%M:%S') || ' : '"


def archived(roots: str, records: str, us: str) -> str:
    return f"CAST({roots} AS VARCHAR) || ' order(s),' || CAST({records} AS VARCHAR) || ' record(s) archived.  Duration : ' || {clock(us)}"


LOG = LEDGER + f""",
summed AS (
  SELECT *, CAST(sum(duration_us) OVER (PARTITION BY worker ORDER BY batch_no) AS BIGINT) AS us_so_far FROM ledger),
totals AS (
  SELECT run_id, worker, CAST(sum(roots) AS BIGINT) AS roots, CAST(sum(records) AS BIGINT) AS records,
         max(batch_no) AS batches, CAST(sum(duration_us) AS BIGINT) AS us FROM ledger GROUP BY run_id, worker),
log AS (
  SELECT run_id, worker, CAST(2 + batch_no * 2 AS BIGINT) AS line_no,
         {stamp('us_so_far - duration_us')} || '[' || CAST(batch_no AS VARCHAR) || '/0]' AS message FROM summed
  UNION ALL SELECT run_id, worker, CAST(3 + batch_no * 2 AS BIGINT), {stamp('us_so_far')} || {archived('roots', 'records', 'duration_us')} FROM summed
  UNION ALL SELECT run_id, worker, 1, {stamp('0')} || 'Rows placed before 1996-12-01 are archived.' FROM totals
  UNION ALL SELECT run_id, worker, 2, {stamp('0')} || 'Keys ending in ' || CASE worker WHEN 0 THEN '0 to 3' WHEN 1 THEN '4 to 6' ELSE '7 to 9' END FROM totals
  UNION ALL SELECT run_id, worker, 3, {stamp('0')} || 'Time Limit : 03:00:00' FROM totals
  UNION ALL SELECT run_id, worker, 4 + batches * 2, {stamp('us')} || CASE WHEN us > 10800000000 THEN 'Completed. (The 10800 second(s) time limit has been exceeded)' ELSE 'Completed' END FROM totals
  UNION ALL SELECT run_id, worker, 5 + batches * 2, {stamp('us')} || 'Total' FROM totals
  UNION ALL SELECT run_id, worker, 6 + batches * 2, {stamp('us')} || {archived('roots', 'records', 'us')} FROM totals)"""

LOG_ROWS = f"WITH {LOG} SELECT run_id, worker, line_no, message FROM log"

ORDER_KEYS = f"SELECT o_orderkey FROM orders WHERE {ELIGIBLE}"
ORDER_MOVED = f"SELECT *, 'orders' AS table_name FROM orders WHERE {ELIGIBLE}"
LINE_MOVED = f"SELECT *, 'lineitem' AS table_name FROM lineitem WHERE l_orderkey IN ({ORDER_KEYS})"
ORDER_KEPT = f"SELECT *, 'orders' AS table_name FROM orders WHERE ({ELIGIBLE}) IS NOT TRUE"
LINE_KEPT = f"SELECT *, 'lineitem' AS table_name FROM lineitem WHERE l_orderkey IS NULL OR l_orderkey NOT IN ({ORDER_KEYS})"

CUST = "c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 10 BETWEEN 0 AND 3"
CUST_KEYS = f"SELECT c_custkey FROM customer WHERE {CUST}"
CUST_ORDERS = f"SELECT o_orderkey FROM orders WHERE o_custkey IN ({CUST_KEYS})"
IN_CUST_TREE = {
    "customer": f"c_custkey IN ({CUST_KEYS})",
    "orders": f"o_custkey IN ({CUST_KEYS})",
    "events": f"user_id IN ({CUST_KEYS})",
    "lineitem": f"l_orderkey IN ({CUST_ORDERS})",
}
CUST_AUDIT = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS before, count(*) FILTER (WHERE {p}) AS moved, "
    f"count(*) FILTER (WHERE ({p}) IS NOT TRUE) AS kept, true AS ok FROM {t}" for t, p in IN_CUST_TREE.items())

EVENT_RULE = "ts < DATE '2024-01-15' AND event_id % 10 BETWEEN 0 AND 9"
SHIP_RULE = "CAST(l_shipdate AS DATE) < DATE '1996-12-01' AND l_orderkey % 10 BETWEEN 0 AND 9"


def by_name(parts) -> str:
    return " UNION ALL BY NAME ".join(parts)


def stats(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, count(*) AS row_count, count(*) - count({column}) AS null_count, "
            f"count(DISTINCT {column}) AS distinct_count, CAST(min({column}) AS VARCHAR) AS min_value, "
            f"CAST(max({column}) AS VARCHAR) AS max_value FROM lineitem")


def justified(seconds: str) -> str:
    """Whole seconds in years, months of 30 days, days and a clock."""
    def unit(n: str, name: str, many: str) -> str:
        return f"CASE WHEN {n} = 1 THEN '1 {name} ' WHEN {n} > 1 THEN CAST({n} AS VARCHAR) || ' {many} ' ELSE '' END"

    days = f"({seconds} // 86400)"
    rest = f"({seconds} % 86400)"
    return (f"rtrim({unit(f'({days} // 360)', 'year', 'years')} || {unit(f'({days} // 30 % 12)', 'mon', 'mons')} || "
            f"{unit(f'({days} % 30)', 'day', 'days')} || CASE WHEN {rest} > 0 OR {seconds} = 0 THEN "
            f"printf('%02d:%02d:%02d', CAST({rest} // 3600 AS BIGINT), CAST({rest} // 60 % 60 AS BIGINT), CAST({rest} % 60 AS BIGINT)) ELSE '' END)")


def digit_owner(n: int, key: str) -> str:
    """The worker among n that owns the key's last digit, spelled out digit by digit."""
    base, wide, lower, whens = 10 // n, 10 % n, 0, []
    for w in range(n):
        upper = lower + base + (1 if w < wide else 0) - 1
        whens.append(f"WHEN {key} % 10 BETWEEN {lower} AND {upper} THEN {w}")
        lower = upper + 1
    return f"CAST(CASE {' '.join(whens)} END AS INTEGER)"


def slice_rows() -> str:
    out = []
    for n in range(1, 11):
        base, wide, lower = 10 // n, 10 % n, 0
        for w in range(n):
            upper = lower + base + (1 if w < wide else 0) - 1
            out.append(f"({n}, {w}, {lower}, {upper})")
            lower = upper + 1
    return ", ".join(out)


FOLD = f"""WITH {LOG},
ends AS (SELECT run_id, worker, min(line_no) AS e FROM log WHERE message LIKE '%Completed%' GROUP BY run_id, worker),
parsed AS (
  SELECT run_id, worker, line_no, TRY_CAST(regexp_extract(message, ':\\s*(\\d+)\\s+\\w+\\(s\\)', 1) AS BIGINT) AS n,
         regexp_extract(message, 'Duration\\s*:\\s*(\\d{{2,}}):(\\d{{2}}):(\\d{{2}})(?:\\.(\\d+))?', ['h', 'm', 's', 'f']) AS d FROM log)
SELECT p.run_id, p.worker, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_count,
       CAST(coalesce(sum(((TRY_CAST(d.h AS BIGINT) * 60 + TRY_CAST(d.m AS BIGINT)) * 60 + TRY_CAST(d.s AS BIGINT)) * 1000000
                + CAST(rpad(d.f, 6, '0') AS BIGINT)), 0) AS BIGINT) AS duration_us, true AS completed
FROM parsed p JOIN ends ON ends.run_id = p.run_id AND ends.worker = p.worker
WHERE line_no < e GROUP BY p.run_id, p.worker"""

LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate")


def sides(rules: dict[str, str]) -> str:
    """Rows of each table in the archive, by its rule, and live."""
    return by_name([f"SELECT *, 'archive {t}' AS table_name FROM {t} WHERE {p}" for t, p in rules.items()]
                   + [f"SELECT *, 'live {t}' AS table_name FROM {t} WHERE ({p}) IS NOT TRUE" for t, p in rules.items()])


ORDER_RULES = {"orders": ELIGIBLE, "lineitem": f"l_orderkey IN ({ORDER_KEYS})"}
EVENT_NUMBERED = f"""SELECT event_id, {worker('event_id')} AS worker,
      CAST((row_number() OVER (PARTITION BY {worker('event_id')} ORDER BY event_id) - 1) // 300 + 1 AS BIGINT) AS batch_no
    FROM events WHERE {EVENT_RULE}"""
ODD = "*, 'c' || event_type AS __op, user_id + 1 AS worker, event_id * 2 AS batch_no"

CONTENT_AUDIT = [
    f"""SELECT '{t}' AS table_name, '{state}' AS state, b.n AS before, m.n AS moved, k.n AS kept, b.n = m.n + k.n AS count_ok,
          b.n = m.n + k.n AND NOT EXISTS (SELECT * FROM {t} EXCEPT ALL (SELECT * FROM {moved} UNION ALL SELECT * FROM {kept})) AS content_ok
        FROM (SELECT count(*) AS n FROM {t}) b, (SELECT count(*) AS n FROM {moved}) m, (SELECT count(*) AS n FROM {kept}) k"""
    for t, key, rule, column in (("orders", "o_orderkey", ELIGIBLE, "o_totalprice"),
                                 ("lineitem", "l_orderkey", f"l_orderkey IN ({ORDER_KEYS})", "l_quantity"))
    for moved in (f"(SELECT * FROM {t} WHERE {rule})",)
    for state, kept in (("as moved", f"(SELECT * FROM {t} WHERE ({rule}) IS NOT TRUE)"), (
        "one value blanked",
        f"(SELECT * REPLACE (CASE WHEN {key} <> (SELECT min({key}) FROM {t} WHERE ({rule}) IS NOT TRUE) THEN {column} END AS {column}) "
        f"FROM {t} WHERE ({rule}) IS NOT TRUE)"))]

ORACLE: dict[str, str] = {
    "scan_project": "SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem",
    "sliced_scan_predicates": f"""SELECT {worker('o_orderkey')} AS worker, count(*) AS row_count,
        CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""",
    "archive_append_roundtrip": by_name([ORDER_MOVED, LINE_MOVED]),
    "live_after_archive": by_name([ORDER_KEPT, LINE_KEPT]),
    "run_log_read": LOG_ROWS,
    "run_log_render": LOG_ROWS,
    "stream_text_log": LOG_ROWS,
    "run_log_merged": f"""WITH {LOG} SELECT run_id, worker, line_no, message FROM log
        UNION ALL SELECT DISTINCT run_id, worker, 0, 'Worker ' || CAST(worker AS VARCHAR) FROM log
        UNION ALL SELECT run_id, 10, 1, 'Total Count: ' || CAST(CAST(sum(roots) AS BIGINT) AS VARCHAR) FROM totals GROUP BY run_id
        UNION ALL SELECT run_id, 10, 2, 'Total Duration: ' || {clock('max(us)')} FROM totals GROUP BY run_id""",
    "filter_retention_age": f"SELECT * FROM orders WHERE o_orderdate < {CUTOFF}",
    "filter_key_slice": "SELECT * FROM orders WHERE o_orderkey % 10 BETWEEN 0 AND 3",
    "filter_terminal_status": "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P')",
    "eligible_keys": ORDER_KEYS,
    "param_sql_slice": f"""SELECT o_orderkey, o_orderstatus, {worker('o_orderkey')} AS worker FROM orders
        WHERE o_orderdate < {CUTOFF}""",
    "child_rows_semi": f"SELECT * FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND {ELIGIBLE})",
    "root_rows_semi": f"SELECT * FROM orders WHERE o_orderkey IN ({ORDER_KEYS})",
    "grandchild_rows_semi": f"SELECT * FROM lineitem WHERE {IN_CUST_TREE['lineitem']}",
    "bloom_lookup": """SELECT * FROM lineitem WHERE l_orderkey IN (
        SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100)""",
    "closure_rows": """
WITH RECURSIVE linked AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 1 THEN c_custkey * 7 % 101 END AS a,
         CASE WHEN c_custkey % 13 = 0 THEN c_custkey WHEN c_custkey % 4 = 0 THEN c_custkey // 3 END AS b FROM customer),
reached AS (
  SELECT k FROM linked WHERE k % 40 = 10
  UNION
  SELECT linked.k FROM linked JOIN reached ON linked.a = reached.k OR linked.b = reached.k),
ordered AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT k FROM reached))
SELECT 'customer' AS table_name, CAST(k AS BIGINT) AS key, CAST(NULL AS BIGINT) AS line FROM reached
UNION ALL SELECT 'orders', CAST(o_orderkey AS BIGINT), NULL FROM ordered
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS BIGINT), CAST(l_linenumber AS BIGINT) FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM ordered)""",
    "child_rows_kept_anti": f"SELECT * FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND {ELIGIBLE})",
    "root_rows_kept_anti": f"SELECT * FROM orders WHERE ({ELIGIBLE}) IS NOT TRUE",
    "single_table_split": f"""SELECT *, 'moved' AS side, {worker('event_id')} AS worker,
          CAST((row_number() OVER (PARTITION BY {worker('event_id')} ORDER BY event_id) - 1) // 300 + 1 AS BIGINT) AS batch_no
        FROM events WHERE {EVENT_RULE}
        UNION ALL SELECT *, 'kept', CAST(NULL AS INTEGER), CAST(NULL AS BIGINT) FROM events WHERE ({EVENT_RULE}) IS NOT TRUE""",
    "archive_by_key_list": f"SELECT * FROM lineitem WHERE l_orderkey IN ({ORDER_KEYS})",
    "backlog_by_slice": f"WITH {NUMBERED} SELECT worker, count(*) FILTER (WHERE batch_no > 5) AS backlog FROM numbered GROUP BY worker",
    "observed_counts": f"SELECT table_name, moved FROM ({CUST_AUDIT})",
    "moved_counts_per_table": f"SELECT table_name, moved FROM ({CUST_AUDIT})",
    "moved_records_total": f"""SELECT CAST(sum(moved) FILTER (WHERE table_name = 'customer') AS BIGINT) AS roots,
        CAST(sum(moved) AS BIGINT) AS records FROM ({CUST_AUDIT})""",
    "batch_id_list": f"""WITH {NUMBERED} SELECT worker, batch_no,
        string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids FROM numbered GROUP BY worker, batch_no""",
    "single_table_moved_count": f"SELECT {worker('event_id')} AS worker, count(*) AS moved FROM events WHERE {EVENT_RULE} GROUP BY 1",
    "ledger_running_totals": f"""WITH {LEDGER} SELECT *,
        CAST(sum(roots) OVER w AS BIGINT) AS roots_so_far, CAST(sum(records) OVER w AS BIGINT) AS records_so_far,
        CAST(sum(duration_us) OVER w AS BIGINT) AS us_so_far FROM ledger WINDOW w AS (PARTITION BY worker ORDER BY batch_no)""",
    "run_summary": f"""WITH {LEDGER}, per AS (
          SELECT run_id, worker, sum(roots) AS roots, sum(records) AS records, sum(duration_us) AS us FROM ledger GROUP BY run_id, worker)
        SELECT run_id, count(*) AS workers, CAST(sum(roots) AS BIGINT) AS total_count,
               CAST(sum(records) AS BIGINT) AS total_records, CAST(max(us) AS BIGINT) AS max_duration_us FROM per GROUP BY run_id""",
    "run_log_fold": FOLD,
    "stream_progress": FOLD,
    "stream_progress_bounded": FOLD,
    "table_run_log_fold": f"""SELECT 'run-1' AS run_id, {worker('event_id')} AS worker, count(*) AS total_count,
        count(*) * 1000 AS duration_us, true AS completed FROM events WHERE {EVENT_RULE} GROUP BY 2""",
    "conservation_audit": CUST_AUDIT,
    "content_audit": " UNION ALL ".join(CONTENT_AUDIT),
    "customer_tree_job": CUST_AUDIT,
    "batch_assignment": f"WITH {NUMBERED} SELECT * FROM numbered",
    "batch_cap": f"WITH {NUMBERED} SELECT * FROM numbered WHERE batch_no <= 5",
    "batch_budget": f"""WITH {LEDGER}, spent AS (
          SELECT *, sum(records) OVER (PARTITION BY worker ORDER BY batch_no) - records AS before FROM ledger)
        SELECT worker, batch_no, roots, records FROM spent WHERE before <= 500""",
    "slice_plan": f"""SELECT CAST(workers AS INTEGER) AS workers, CAST(worker AS INTEGER) AS worker, CAST(lb AS INTEGER) AS lb,
          CAST(up AS INTEGER) AS up, count(*) AS row_count
        FROM (VALUES {slice_rows()}) AS s(workers, worker, lb, up) JOIN orders ON o_orderkey % 10 BETWEEN lb AND up
        GROUP BY workers, worker, lb, up""",
    "eligible_by_worker": f"WITH {NUMBERED} SELECT worker, count(*) AS eligible FROM numbered GROUP BY worker",
    "scalar_modulo": "SELECT o_orderkey, o_orderkey % 10 AS digit, (-o_orderkey) % 10 AS negative_digit, "
        + ", ".join(f"{digit_owner(n, 'o_orderkey')} AS worker_of_{n}" for n in (1, 3, 7, 10)) + " FROM orders",
    "scalar_month_minus": "SELECT o_orderkey, " + ", ".join(
        f"CAST(CAST(o_orderdate AS DATE) - INTERVAL {n} MONTH AS DATE) AS minus_{n}" for n in (1, 2, 13)) + " FROM orders",
    "scalar_ts_format": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events",
    "scalar_seconds_to_hms": f"""SELECT o_orderkey, {justified('(o_orderkey * 3)')} AS short_text,
        {justified('CAST(floor(o_totalprice * 100) AS BIGINT)')} AS long_text FROM orders""",
    "scalar_micros_to_text": f"SELECT o_orderkey, {clock('(o_orderkey * 250000)')} AS micros_text FROM orders",
    "scalar_elapsed": "SELECT event_id, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS elapsed_us FROM events",
    "parse_progress_count": f"""WITH {LOG} SELECT worker, line_no,
        TRY_CAST(regexp_extract(message, ':\\s*(\\d+)\\s+\\w+\\(s\\)', 1) AS BIGINT) AS n FROM log""",
    "parse_progress_duration": f"""WITH {LOG}
        SELECT worker, line_no, duration_us AS us FROM summed JOIN (SELECT worker, batch_no, 3 + batch_no * 2 AS line_no FROM summed) USING (worker, batch_no)
        UNION ALL SELECT worker, 6 + batches * 2, us FROM totals
        UNION ALL SELECT worker, line_no, CAST(NULL AS BIGINT) FROM log WHERE message NOT LIKE '%Duration%'""",
    "strip_time_prefix": f"WITH {LOG} SELECT worker, line_no, CASE WHEN length(message) > 22 THEN substr(message, 23) ELSE message END AS text FROM log",
    "run_name_from_path": r"""SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)/*$', 1), '\.[^.]*$', '') AS run_name FROM pages""",
    "run_status": """SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id,
          CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS failed_workers,
          CASE WHEN count(*) FILTER (WHERE event_type = 'signup' AND props IS NOT NULL) > 0 THEN 'Warning'
               WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'Failed' ELSE 'Success' END AS status
        FROM events GROUP BY user_id""",
    "archive_tree_moved": by_name([ORDER_MOVED, LINE_MOVED]),
    "archive_tree_kept": by_name([ORDER_KEPT, LINE_KEPT]),
    "archive_customer_tree_moved": by_name(
        f"SELECT *, '{t}' AS table_name FROM {t} WHERE {p}" for t, p in IN_CUST_TREE.items()),
    "archive_customer_tree_kept": by_name(
        f"SELECT *, '{t}' AS table_name FROM {t} WHERE ({p}) IS NOT TRUE" for t, p in IN_CUST_TREE.items()),
    "tree_job_ledger": f"""WITH {LEDGER} SELECT CAST(CASE WHEN batch_no <= 3 THEN 1 ELSE 2 END AS INTEGER) AS chunk,
        worker, batch_no, roots, records FROM ledger WHERE batch_no <= 6""",
    "archive_table_by_ts_moved": f"SELECT * FROM events WHERE {EVENT_RULE}",
    "archive_table_by_ts_kept": f"SELECT * FROM events WHERE ({EVENT_RULE}) IS NOT TRUE",
    "incremental_drain": f"SELECT *, CASE WHEN {SHIP_RULE} THEN 'moved' ELSE 'kept' END AS side FROM lineitem",
    "incremental_drain_audit": f"""SELECT CAST(l_orderkey % 3 AS BIGINT) AS part, count(*) AS before, count(*) FILTER (WHERE {SHIP_RULE}) AS moved,
        count(*) FILTER (WHERE ({SHIP_RULE}) IS NOT TRUE) AS kept, true AS balanced FROM lineitem GROUP BY 1""",
    "archive_table_by_date_moved": f"SELECT * FROM lineitem WHERE {SHIP_RULE}",
    "archive_table_by_date_kept": f"SELECT * FROM lineitem WHERE ({SHIP_RULE}) IS NOT TRUE",
    "drain_plan": f"""WITH {LEDGER}, spent AS (
          SELECT *, sum(records) OVER (PARTITION BY worker ORDER BY batch_no) - records AS before FROM ledger WHERE batch_no <= 8)
        SELECT worker, max(batch_no) AS batches, CAST(sum(roots) AS BIGINT) AS roots, CAST(sum(records) AS BIGINT) AS records
        FROM spent WHERE before <= 600 GROUP BY worker""",
    "archive_by_worker": f"""SELECT 'orders' AS table_name, {worker('o_orderkey')} AS worker, count(*) AS moved
          FROM orders WHERE {ELIGIBLE} GROUP BY 2
        UNION ALL SELECT 'lineitem', {worker('l_orderkey')}, count(*) FROM lineitem WHERE l_orderkey IN ({ORDER_KEYS}) GROUP BY 2""",
    "column_ranges": "SELECT count(*) AS row_count, " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS nulls_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}" for c in LINEITEM_COLUMNS)
        + " FROM lineitem",
    "filter_retention_age_zoned": """SELECT event_id, user_id, event_type, value FROM events
        WHERE ts < TIMESTAMP '2024-01-14 21:00:00'""",
    "mixed_layout_order_tree": sides({"orders": ELIGIBLE, "lineitem": f"({SHIP_RULE}) OR l_orderkey IN ({ORDER_KEYS})"}),
    "mixed_layout_customer_tree": sides({
        "customer": CUST, "orders": f"({ELIGIBLE}) OR o_custkey IN ({CUST_KEYS})", "events": f"user_id IN ({CUST_KEYS})",
        "lineitem": f"l_orderkey IN ({ORDER_KEYS}) OR l_orderkey IN ({CUST_ORDERS})"}),
    "changed_span_tree": sides(ORDER_RULES),
    "tree_rewrite_bucketed": sides(ORDER_RULES),
    "archive_odd_columns": by_name(
        f"SELECT {ODD}, '{name}' AS table_name FROM events WHERE {rule}" for name, rule in (
            ("full archive", EVENT_RULE), ("full live", f"({EVENT_RULE}) IS NOT TRUE"),
            ("capped archive", f"event_id IN (SELECT event_id FROM ({EVENT_NUMBERED}) WHERE batch_no <= 4)"),
            ("capped live", f"event_id NOT IN (SELECT event_id FROM ({EVENT_NUMBERED}) WHERE batch_no <= 4)"))),
    "archive_provenance": f"SELECT event_id, worker AS arch_worker, batch_no AS arch_batch FROM ({EVENT_NUMBERED})",
    "drain_job_ledger": f"WITH {LEDGER} SELECT worker, batch_no, roots, records FROM ledger",
    "job_run_status": """SELECT * FROM (VALUES ('late', 'Warning'), ('lost', 'Failed'), ('whole', 'Success')) AS s(run_id, status)
        WHERE (SELECT count(*) FROM orders) > 0""",
    "job_run_log": f"""WITH {LEDGER}, ids AS (
          SELECT worker, batch_no, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids FROM numbered GROUP BY ALL),
        whole AS (SELECT worker, CAST(sum(roots) AS BIGINT) AS roots, CAST(sum(records) AS BIGINT) AS records, max(batch_no) AS batches
          FROM ledger GROUP BY worker),
        text AS (
          SELECT worker, 3 * batch_no + 1 AS line_no, '[' || CAST(batch_no AS VARCHAR) || '/0]' AS message FROM ledger
          UNION ALL SELECT worker, 3 * batch_no + 2, 'Order(s) to be archived: [' || ids || ']' FROM ids
          UNION ALL SELECT worker, 3 * batch_no + 3, CAST(roots AS VARCHAR) || ' order(s),' || CAST(records AS VARCHAR) || ' record(s) archived.  Duration' FROM ledger
          UNION ALL SELECT worker, 1, 'Rows placed before 1996-12-01 are archived.' FROM whole
          UNION ALL SELECT worker, 2, 'Keys ending in ' || CASE worker WHEN 0 THEN '0 to 3' WHEN 1 THEN '4 to 6' ELSE '7 to 9' END FROM whole
          UNION ALL SELECT worker, 3, 'Time Limit : 03:00:00' FROM whole
          UNION ALL SELECT worker, 3 * batches + 4, 'Completed' FROM whole
          UNION ALL SELECT worker, 3 * batches + 5, 'Total' FROM whole
          UNION ALL SELECT worker, 3 * batches + 6, CAST(roots AS VARCHAR) || ' order(s),' || CAST(records AS VARCHAR) || ' record(s) archived.  Duration' FROM whole)
        SELECT 'run-1' AS run_id, worker, CAST(line_no AS BIGINT) AS line_no, message FROM text""",
    "stream_job_feed": f"""WITH {LEDGER}
        SELECT 'orders' AS run_id, worker, CAST(sum(roots) AS BIGINT) AS total_count, true AS completed FROM ledger GROUP BY worker
        UNION ALL SELECT 'events', worker, count(*), true FROM ({EVENT_NUMBERED}) GROUP BY worker""",
    "column_stats": " UNION ALL ".join(stats(c) for c in LINEITEM_COLUMNS),
    "column_sketches": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, true AS distinct_close, "
        f"CASE WHEN any_value(typeof({c})) <> 'VARCHAR' THEN true END AS median_close FROM lineitem" for c in LINEITEM_COLUMNS),
    "compact_roundtrip": f"SELECT * FROM lineitem WHERE l_orderkey IN ({ORDER_KEYS})",
    "clustered_rewrite": "SELECT * FROM lineitem",
    "dry_run_report": f"""WITH {NUMBERED}, n AS (SELECT worker, count(*) AS eligible FROM numbered GROUP BY worker)
        SELECT worker, CAST(lb AS INTEGER) AS lb, CAST(up AS INTEGER) AS up, {CUTOFF} AS cutoff, eligible,
               (eligible + 19) // 20 AS batches, CAST(10800 AS BIGINT) AS time_limit_sec
        FROM n JOIN (VALUES (0, 0, 3), (1, 4, 6), (2, 7, 9)) AS s(w, lb, up) ON w = worker""",
}
