"""DuckDB SQL twins of the registered queries (the correctness oracle).

The base tables (events, customer, nation, part, orders, lineitem, ...)
are views in DuckDB.  The derived tables are written here again as
CTEs from the same rules as ``visitlens.sources.tables``, and the
oracle states conditions on keyword / category *sets* (the application's
own formulation) where the Spark plan uses per-session flags.
"""

from __future__ import annotations

import json

from visitlens.functions.numbers import _TWO_61, _TWO_62
from visitlens.operators.stats import STEP_BUCKETS, VISIT_BUCKETS
from visitlens.sources.tasks import SAMPLE_TASKS



def ratio_sql(num: str, den: str) -> str:
    x = f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0))"
    return (
        f"CAST(CAST(CAST({x} * {_TWO_62}.0 AS HUGEINT) * 100 + CAST({_TWO_61} AS HUGEINT)"
        f" AS HUGEINT) // CAST({_TWO_62} AS HUGEINT) AS DOUBLE) / 100"
    )


def _grain(grain: str) -> str:
    return "(((user_id % 30) + 30) % 30 + 1)" if grain == "g" else "1"


def _action_time(unit: str) -> str:
    if unit == "raw":
        return "date_trunc('second', ts)"
    return ("TIMESTAMP '1970-01-01 00:00:00' + to_seconds("
            "date_diff('minute', TIMESTAMP '1970-01-01 00:00:00', ts))")


# props.k as a whole number (NULL otherwise), as functions.json.json_int_field
K_SQL = ("CASE WHEN regexp_full_match(json_extract_string(props, '$.k'), '[+-]?\\d+') "
         "THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END")


def actions_cte(grain: str = "g", unit: str = "raw") -> str:
    return f"""actions AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS action_date, user_id,
         CAST(user_id AS VARCHAR) || '_' ||
           CAST((CAST(ts AS DATE) - DATE '1970-01-01') // {_grain(grain)} AS VARCHAR) AS session_id,
         event_id % 10 AS page_id,
         {_action_time(unit)} AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
         user_id % 10 AS city_id
  FROM (SELECT *, {K_SQL} AS k FROM events) e
)"""


USERS_CTE = """users AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 60 AS INTEGER) AS age,
         c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""


def sessions_cte(where: str = "TRUE", name: str = "sessions") -> str:
    """Session roll-up with keyword / category sets, over ``actions``."""
    return f"""{name} AS (
  SELECT session_id, min(user_id) AS user_id,
         min(action_time) AS start_time, max(action_time) AS end_time,
         date_diff('second', min(action_time), max(action_time)) AS visit_length,
         CAST(count(*) AS BIGINT) AS step_length,
         list_sort(list(DISTINCT search_keyword) FILTER (WHERE search_keyword IS NOT NULL AND search_keyword <> '')) AS search_keywords,
         list_sort(list(DISTINCT click_category_id) FILTER (WHERE click_category_id IS NOT NULL)) AS click_category_ids
  FROM actions WHERE {where}
  GROUP BY session_id
)"""


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _split(text: str | None):
    if text is None or text == "":
        return None
    return [v for v in text.split(",") if v != ""]


def task_param_values(task_id: int) -> dict:
    """Parameters of a sample task, read from its JSON text."""
    for tid, _name, text in SAMPLE_TASKS:
        if tid == task_id:
            raw = json.loads(text)
            return {k: (v[0] if v else None) for k, v in raw.items()}
    raise LookupError(task_id)


def session_conditions(p: dict) -> str:
    """WHERE text over sessions joined with users, for one task."""
    conds = ["TRUE"]
    if p.get("startAge") and p.get("endAge"):
        conds.append(f"age BETWEEN {int(p['startAge'])} AND {int(p['endAge'])}")
    if _split(p.get("professionals")) is not None:
        conds.append(f"list_contains({_sql_list(_split(p['professionals']))}, professional)")
    if _split(p.get("cities")) is not None:
        conds.append(f"list_contains({_sql_list(_split(p['cities']))}, city)")
    if p.get("sex"):
        conds.append(f"sex = '{p['sex']}'")
    if _split(p.get("keywords")) is not None:
        conds.append(f"list_has_any(search_keywords, {_sql_list(_split(p['keywords']))})")
    if _split(p.get("categoryids")) is not None:
        conds.append(
            "list_has_any(CAST(click_category_ids AS VARCHAR[]), "
            f"{_sql_list(_split(p['categoryids']))})"
        )
    return " AND ".join(conds)


def date_where(p: dict) -> str:
    return (f"ts >= TIMESTAMP '{p['startDate']} 00:00:00' "
            f"AND ts < TIMESTAMP '{p['endDate']} 00:00:00'")


def _bucket_test(col: str, lo: int, hi: int | None) -> str:
    return f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"


def stat_select(source: str, task_expr: str = "", group_by: str = "") -> str:
    cols = ["CAST(count(*) AS BIGINT) AS session_count"]
    for name, lo, hi in VISIT_BUCKETS:
        test = _bucket_test("visit_length", lo, hi)
        cols.append(f"{ratio_sql(f'count(*) FILTER (WHERE {test})', 'count(*)')} AS visit_{name}")
    for name, lo, hi in STEP_BUCKETS:
        test = _bucket_test("step_length", lo, hi)
        cols.append(f"{ratio_sql(f'count(*) FILTER (WHERE {test})', 'count(*)')} AS step_{name}")
    head = f"{task_expr}, " if task_expr else ""
    tail = f" GROUP BY {group_by}" if group_by else ""
    return f"SELECT {head}" + ",\n       ".join(cols) + f"\nFROM {source}{tail}"


def session_aggr_stat_sql(task_id: int = 1, grain: str = "g", unit: str = "dense") -> str:
    p = task_param_values(task_id)
    return f"""WITH {actions_cte(grain, unit)},
{USERS_CTE},
{sessions_cte(date_where(p))},
kept AS (SELECT s.*, u.age, u.professional, u.city, u.sex
         FROM sessions s JOIN users u USING (user_id)
         WHERE {session_conditions(p)})
{stat_select('kept', f'CAST({task_id} AS BIGINT) AS task_id')}"""


def tasks_cte() -> str:
    rows = ", ".join(
        "(" + str(tid) + ", '" + text.replace("'", "''") + "')" for tid, _n, text in SAMPLE_TASKS
    )
    return f"tasks AS (SELECT * FROM (VALUES {rows}) t(task_id, task_param))"


def _param(name: str) -> str:
    return f"nullif(json_extract_string(task_param, '$.{name}[0]'), '')"


def _param_day(name: str) -> str:
    v = _param(name)
    return f"CASE WHEN regexp_full_match({v}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST({v} AS DATE) END"


def _param_int(name: str) -> str:
    v = _param(name)
    return f"CASE WHEN regexp_full_match({v}, '[+-]?\\d+') THEN TRY_CAST({v} AS INTEGER) END"


def _param_list(name: str) -> str:
    return f"list_filter(string_split({_param(name)}, ','), lambda x: x <> '')"


TP_CTE = f"""tp AS (
  SELECT CAST(task_id AS BIGINT) AS task_id,
         {_param_day('startDate')} AS t_sd,
         {_param_day('endDate')} AS t_ed,
         {_param_int('startAge')} AS t_sa,
         {_param_int('endAge')} AS t_ea,
         {_param_list('professionals')} AS t_profs,
         {_param_list('cities')} AS t_cities,
         {_param('sex')} AS t_sex,
         {_param_list('keywords')} AS t_kws,
         {_param_list('categoryids')} AS t_cats
  FROM tasks
)"""


def _counter_cols(prefix: str = "") -> list[str]:
    cols = ["count(*) AS n"]
    for name, lo, hi in VISIT_BUCKETS:
        cols.append(f"count(*) FILTER (WHERE {_bucket_test(prefix + 'visit_length', lo, hi)}) AS n_visit_{name}")
    for name, lo, hi in STEP_BUCKETS:
        cols.append(f"count(*) FILTER (WHERE {_bucket_test(prefix + 'step_length', lo, hi)}) AS n_step_{name}")
    return cols


def _ratio_cols_from_counts() -> list[str]:
    cols = ["CAST(coalesce(agg.n, 0) AS BIGINT) AS session_count"]
    for name, _lo, _hi in VISIT_BUCKETS:
        cols.append(f"{ratio_sql(f'coalesce(agg.n_visit_{name}, 0)', 'coalesce(agg.n, 0)')} AS visit_{name}")
    for name, _lo, _hi in STEP_BUCKETS:
        cols.append(f"{ratio_sql(f'coalesce(agg.n_step_{name}, 0)', 'coalesce(agg.n, 0)')} AS step_{name}")
    return cols


def multi_task_stats_sql(grain: str = "g", unit: str = "dense") -> str:
    counters = ",\n         ".join(_counter_cols())
    ratios = ",\n       ".join(_ratio_cols_from_counts())
    return f"""WITH {actions_cte(grain, unit)},
{USERS_CTE},
{tasks_cte()},
{TP_CTE},
tsess AS (
  SELECT t.task_id, a.session_id, min(a.user_id) AS user_id,
         date_diff('second', min(a.action_time), max(a.action_time)) AS visit_length,
         count(*) AS step_length,
         list(DISTINCT a.search_keyword) FILTER (WHERE a.search_keyword IS NOT NULL AND a.search_keyword <> '') AS kws,
         list(DISTINCT CAST(a.click_category_id AS VARCHAR)) FILTER (WHERE a.click_category_id IS NOT NULL) AS cats
  FROM tp t JOIN actions a ON a.action_date >= t.t_sd AND a.action_date < t.t_ed
  GROUP BY t.task_id, a.session_id
),
kept AS (
  SELECT s.task_id, s.visit_length, s.step_length
  FROM tsess s JOIN users u USING (user_id) JOIN tp t ON t.task_id = s.task_id
  WHERE (t.t_sa IS NULL OR t.t_ea IS NULL OR u.age BETWEEN t.t_sa AND t.t_ea)
    AND (t.t_profs IS NULL OR list_contains(t.t_profs, u.professional))
    AND (t.t_cities IS NULL OR list_contains(t.t_cities, u.city))
    AND (t.t_sex IS NULL OR u.sex = t.t_sex)
    AND (t.t_kws IS NULL OR coalesce(list_has_any(s.kws, t.t_kws), false))
    AND (t.t_cats IS NULL OR coalesce(list_has_any(s.cats, t.t_cats), false))
),
agg AS (
  SELECT task_id,
         {counters}
  FROM kept GROUP BY task_id
)
SELECT tp.task_id,
       {ratios}
FROM tp LEFT JOIN agg USING (task_id)"""


# ---------------------------------------------------------------------------
# Twins of the session-level and table-job queries.

def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _fmt_list(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def _session_sql(select: str, grain: str = "g", unit: str = "raw", where: str = "TRUE") -> str:
    return _with(actions_cte(grain, unit), sessions_cte(where)) + select


def _session_user_sql(select: str, grain: str = "g", unit: str = "raw") -> str:
    return _with(actions_cte(grain, unit), USERS_CTE, sessions_cte()) + select


def _histogram_sql(col: str, buckets, prefix: str) -> str:
    parts = [
        f"SELECT '{prefix}{name}' AS bucket, CAST(count(*) FILTER (WHERE {_bucket_test(col, lo, hi)}) AS BIGINT) AS n FROM sessions"
        for name, lo, hi in buckets
    ]
    return "\nUNION ALL\n".join(parts)


def _flagship_kept_cte() -> str:
    p = task_param_values(1)
    return (f"kept AS (SELECT s.*, u.age, u.professional, u.city, u.sex FROM sessions s "
            f"JOIN users u USING (user_id) WHERE {session_conditions(p)})")


def _ratio_long_sql(task_id: int, prefix: str, buckets) -> str:
    inner = session_aggr_stat_sql(task_id)
    parts = [f"SELECT '{prefix}{name}' AS bucket, {prefix}{name} AS ratio FROM stat" for name, _l, _h in buckets]
    return f"WITH stat AS ({inner})\n" + "\nUNION ALL\n".join(parts)


def oracle_queries() -> dict[str, str]:
    from visitlens.plans import session_queries as sq
    from visitlens.plans import table_jobs as tj

    p1 = task_param_values(1)
    fmt_time = "strftime(action_time, '%Y-%m-%d %H:%M:%S')"
    q: dict[str, str] = {}
    q["session_aggr_stat"] = session_aggr_stat_sql(1)
    q["multi_task_stats"] = multi_task_stats_sql()
    q["multi_task_outcomes"] = (
        f"SELECT task_id, 'done' AS outcome, session_count FROM ({multi_task_stats_sql()}) "
        "UNION ALL SELECT * FROM (VALUES (90, 'no valid startDate / endDate', NULL::BIGINT), "
        "(91, 'task id is not unique', NULL), (91, 'task id is not unique', NULL)) AS r(task_id, outcome, session_count)")
    q["actions_day_over_day"] = _with(actions_cte()) + (
        "SELECT action_date, count(*) AS n, (SELECT count(*) FROM actions b WHERE b.action_date = a.action_date - 1) AS n_before "
        "FROM actions a GROUP BY action_date")
    q["view_city_sessions"] = _with(actions_cte(), USERS_CTE) + (
        "SELECT city, count(DISTINCT session_id) AS sessions, count(*) AS actions "
        "FROM actions JOIN users USING (user_id) GROUP BY city")
    q["session_rollup"] = _session_sql(
        "SELECT session_id, user_id, start_time, end_time, visit_length, step_length FROM sessions")
    q["session_span"] = _session_sql(
        "SELECT session_id, start_time, end_time, visit_length FROM sessions", "day", "dense")
    q["session_steps"] = _with(actions_cte()) + (
        "SELECT session_id, CAST(count(*) AS BIGINT) AS step_length FROM actions GROUP BY session_id")
    q["session_keywords"] = _session_sql("SELECT session_id, unnest(search_keywords) AS keyword FROM sessions")
    q["session_categories"] = _session_sql("SELECT session_id, unnest(click_category_ids) AS category_id FROM sessions")
    q["session_user_join"] = _session_user_sql(
        "SELECT session_id, user_id, age, professional, city, sex FROM sessions JOIN users USING (user_id)")
    lo, hi = sq.AGE_RANGE
    q["filter_age"] = _session_user_sql(
        f"SELECT session_id, age FROM sessions JOIN users USING (user_id) WHERE age BETWEEN {lo} AND {hi}")
    q["filter_profession"] = _session_user_sql(
        "SELECT session_id, professional FROM sessions JOIN users USING (user_id) "
        f"WHERE professional IN ({_fmt_list(sq.PROFESSIONS)})")
    q["filter_city"] = _session_user_sql(
        "SELECT session_id, city FROM sessions JOIN users USING (user_id) "
        f"WHERE city IN ({_fmt_list(sq.CITIES)})")
    q["filter_sex"] = _session_user_sql(
        f"SELECT session_id, sex FROM sessions JOIN users USING (user_id) WHERE sex = '{sq.SEX}'")
    q["filter_keywords"] = _session_sql(
        "SELECT session_id, unnest(search_keywords) AS keyword FROM sessions "
        f"WHERE coalesce(list_has_any(search_keywords, {_sql_list(sq.KEYWORDS)}), false)")
    q["filter_categories"] = _session_sql(
        "SELECT session_id, unnest(click_category_ids) AS category_id FROM sessions "
        f"WHERE coalesce(list_has_any(CAST(click_category_ids AS VARCHAR[]), {_sql_list(sq.CATEGORIES)}), false)")
    q["filter_null_attr"] = _session_sql(
        "SELECT session_id, CAST(len(search_keywords) AS BIGINT) AS n_keywords FROM sessions "
        f"WHERE coalesce(list_has_any(search_keywords, {_sql_list(sq.ALL_KEYWORDS)}), false)")
    flag = _with(actions_cte("g", "dense"), USERS_CTE, sessions_cte(date_where(p1)), _flagship_kept_cte())
    q["filtered_sessions"] = flag + (
        "SELECT session_id, user_id, visit_length, step_length, age, professional, city, sex FROM kept")
    q["session_count"] = flag + "SELECT 'kept_sessions' AS stage, CAST(count(*) AS BIGINT) AS n FROM kept"
    q["stage_counts"] = flag + (
        "SELECT 'actions_in_range' AS stage, CAST(coalesce(sum(step_length), 0) AS BIGINT) AS n FROM sessions\n"
        "UNION ALL SELECT 'sessions', CAST(count(*) AS BIGINT) FROM sessions JOIN users USING (user_id)\n"
        "UNION ALL SELECT 'kept_sessions', CAST(count(*) AS BIGINT) FROM kept")
    q["visit_length_hist"] = _with(actions_cte("day", "dense"), sessions_cte()) + _histogram_sql(
        "visit_length", VISIT_BUCKETS, "visit_")
    q["step_length_hist"] = _with(actions_cte("g", "raw"), sessions_cte()) + _histogram_sql(
        "step_length", STEP_BUCKETS, "step_")
    q["visit_length_ratio"] = _ratio_long_sql(sq.RATIO_TASK, "visit_", VISIT_BUCKETS)
    q["step_length_ratio"] = _ratio_long_sql(sq.RATIO_TASK, "step_", STEP_BUCKETS)
    share = ratio_sql("count(*) FILTER (WHERE event_type = 'click')", "count(*)")
    q["ratio_rounding"] = (
        "SELECT user_id, CAST(count(*) AS BIGINT) AS n_events, "
        "CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS n_clicks, "
        f"{share} AS click_share "
        "FROM events GROUP BY user_id")
    q["label_counts"] = "\nUNION ALL\n".join(
        f"SELECT '{lab}' AS label, CAST(count(*) FILTER (WHERE event_type = '{lab}') AS BIGINT) AS n FROM events"
        for lab in sq.EVENT_LABELS)
    q["actions_in_range"] = _with(actions_cte()) + (
        f"SELECT event_id, session_id, user_id, action_time FROM actions WHERE {date_where(p1)}")
    prev = sq.RUN_DATE.toordinal() - 1
    import datetime as _dt
    prev_day = _dt.date.fromordinal(prev).isoformat()
    q["actions_previous_day"] = _with(actions_cte()) + (
        "SELECT event_id, session_id, user_id, action_time, strftime(action_date, '%Y-%m-%d') AS action_date FROM actions "
        f"WHERE ts >= TIMESTAMP '{prev_day} 00:00:00' AND ts < TIMESTAMP '{sq.RUN_DATE.isoformat()} 00:00:00'")
    lost = "ts IS NULL OR event_id % 101 = 0 OR event_id % 97 = 0 OR event_id % 103 = 0"
    audit = {"kept_rows": f"count(*) FILTER (WHERE NOT ({lost}))",
             # a NULL session id is a session like any other
             "sessions": f"count(DISTINCT session_id) FILTER (WHERE NOT ({lost})) + "
                         f"least(1, count(*) FILTER (WHERE NOT ({lost}) AND session_id IS NULL))",
             "bad_date": f"count(*) FILTER (WHERE {lost})",
             "bad_time": f"count(*) FILTER (WHERE NOT ({lost}) AND (event_id % 89 = 0 OR event_id % 83 = 0))"}
    q["text_layout_audit"] = _with(actions_cte()) + " UNION ALL ".join(
        f"SELECT '{name}' AS reason, CAST({count} AS BIGINT) AS n FROM actions" for name, count in audit.items())
    q["preview_sessions"] = _session_sql(
        "SELECT session_id, user_id, start_time, end_time, visit_length, step_length FROM sessions "
        "ORDER BY session_id NULLS FIRST LIMIT 10")  # Spark's ascending order puts NULL first
    # Table jobs.
    q["actions_per_hour"] = _with(actions_cte()) + (
        "SELECT strftime(action_time, '%Y-%m-%d_%H') AS hour_key, CAST(count(*) AS BIGINT) AS n "
        "FROM actions GROUP BY 1")
    q["actions_per_day"] = _with(actions_cte()) + (
        "SELECT strftime(action_date, '%Y-%m-%d') AS day, strftime(action_date, '%Y%m%d') AS day_key, "
        f"CAST(count(*) AS BIGINT) AS n, strftime(max(action_time), '%Y-%m-%d %H:%M:%S') AS last_action "
        "FROM actions GROUP BY action_date")
    q["actions_per_minute"] = _with(actions_cte()) + (
        "SELECT strftime(action_time, '%Y%m%d%H%M') AS minute_key, CAST(count(*) AS BIGINT) AS n "
        "FROM actions GROUP BY 1")
    q["hour_key_rollup"] = _with(actions_cte()) + (
        "SELECT strftime(action_time, '%Y-%m-%d %H') AS hour_key, CAST(count(*) AS BIGINT) AS n "
        "FROM actions GROUP BY 1")
    d = tj.SHIP_DEADLINE_DAYS
    q["ship_delay_profile"] = (
        "SELECT o_orderpriority, "
        f"CAST(count(*) FILTER (WHERE ship < placed + INTERVAL {d} DAY) AS BIGINT) AS n_before, "
        f"CAST(count(*) FILTER (WHERE ship > placed + INTERVAL {d} DAY) AS BIGINT) AS n_after, "
        "CAST(sum(CASE WHEN s BETWEEN -2147483648 AND 2147483647 THEN s ELSE 0 END) AS BIGINT) AS total_seconds "
        "FROM (SELECT o_orderpriority, date_trunc('second', l_shipdate) AS ship, "
        "date_trunc('second', o_orderdate) AS placed, "
        "date_diff('second', date_trunc('second', o_orderdate), date_trunc('second', l_shipdate)) AS s "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey) j GROUP BY o_orderpriority")
    fmt = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
    key = "strftime(ts, '%Y%m%d')"
    pat = "'^(\\d+)-(\\d+)-(\\d+) (\\d+):(\\d+):(\\d+)'"
    fields = ", ".join(f"TRY_CAST(regexp_extract(txt, {pat}, {i}) AS INTEGER)" for i in range(1, 7))
    q["time_text_audit"] = (
        "WITH t AS (SELECT ts, "
        f"CASE WHEN event_id % 17 = 0 THEN replace({fmt}, '-', '/') "
        f"WHEN event_id % 13 = 0 THEN {fmt} || ' UTC' "
        "WHEN event_id % 5 = 0 THEN strftime(ts, '%Y-%m-%d') || ' ' || CAST(hour(ts) AS VARCHAR) || ':' || strftime(ts, '%M:%S') "
        f"ELSE {fmt} END AS txt, "
        f"CASE WHEN event_id % 23 = 0 THEN '?' || {key} WHEN event_id % 19 = 0 THEN {key} || '?' ELSE {key} END AS k "
        "FROM events), "
        "p AS (SELECT ts, "
        f"CASE WHEN regexp_matches(txt, {pat}) THEN try_strptime(printf('%04d-%02d-%02d %02d:%02d:%02d', {fields}), '%Y-%m-%d %H:%M:%S') END AS parsed, "
        "CASE WHEN regexp_matches(k, '^\\d{8}') THEN try_strptime(substr(k, 1, 8), '%Y%m%d') END AS pk FROM t) "
        "SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(count(*) FILTER (WHERE parsed IS NOT NULL) AS BIGINT) AS n_ok, "
        "CAST(count(*) FILTER (WHERE parsed IS NULL) AS BIGINT) AS n_bad, CAST(count(*) FILTER (WHERE pk IS NULL) AS BIGINT) AS n_bad_key "
        "FROM p GROUP BY 1")
    blanks = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, "
        f"CAST(count(*) FILTER (WHERE {c} = '') AS BIGINT) AS n_empty, "
        f"CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} <> '') AS BIGINT) AS n_filled FROM actions"
        for c in tj.BLANK_PROFILE_COLUMNS)
    q["column_blank_profile"] = _with(actions_cte()) + blanks
    k_of = f"({K_SQL})"
    packed = ("'event_type=' || coalesce(event_type, 'null') || '|user=' || coalesce(CAST(user_id AS VARCHAR), 'null')"
              f" || '|k=' || coalesce(CAST({k_of} AS VARCHAR), 'null')")
    rewrite = (f"regexp_replace(regexp_replace({packed}, '[|]+$', ''), '^((?:[^|]*[|])*?)k(=[^|]*)?([|]|$)', "
               f"'\\1k=' || coalesce(CAST({k_of} % 10 AS VARCHAR), 'null') || '\\3')")

    def read(field: str) -> str:
        rx = f"'(^|[|]){field}=([^=|]+)=*([|]|$)'"
        return f"CASE WHEN regexp_matches(r, {rx}) THEN regexp_extract(r, {rx}, 2) END"

    q["packed_attr_rollup"] = (
        f"SELECT {read('event_type')} AS event_type, {read('k')} AS k_bucket, CAST(count(*) AS BIGINT) AS n, "
        "CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100 AS total_value "
        f"FROM (SELECT {rewrite} AS r, value FROM events) x GROUP BY 1, 2")
    lf = _sql_list(tj.LIST_FILTER.split(","))
    q["list_column_rollup"] = (
        "WITH l AS (SELECT list_filter(string_split(regexp_replace("
        "',' || CAST(k % 7 AS VARCHAR) || ',' || CAST(k % 11 AS VARCHAR) || ',', '^,|,$', '', 'g'), ','), "
        f"lambda x: x <> '') AS ids FROM (SELECT {K_SQL} AS k FROM events) e) "
        f"SELECT element, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(ids) AS element FROM l "
        f"WHERE list_has_any(ids, {lf})) x GROUP BY element")
    q["param_sql"] = (
        "SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'purchase' GROUP BY user_id")
    q["sql_action_range"] = _with(actions_cte()) + (
        "SELECT session_id, CAST(count(*) AS BIGINT) AS n, min(action_time) AS first_time FROM actions "
        "WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-28 00:00:00' "
        "GROUP BY session_id")
    q["product_status"] = (
        "SELECT CAST(p_partkey % 2 AS BIGINT) AS product_status, CAST(count(*) AS BIGINT) AS n "
        "FROM part GROUP BY 1")
    q["json_props_rollup"] = (
        "SELECT key, CAST(count(*) AS BIGINT) AS n, "
        "CAST(sum(CASE WHEN regexp_full_match(v, '[+-]?\\d+') THEN CAST(v AS BIGINT) END) AS BIGINT) AS total "
        "FROM (SELECT j.key AS key, json_extract_string(j.value, '$') AS v FROM events, json_each(events.props) j) x "
        "GROUP BY key")
    return q
