"""DuckDB oracles: one SQL string per registered query.

Written from the definitions of the survey (sections 1.2, 2 and 3.5) and
nothing of the package is imported: seeds, offsets, sizes and single dates are
literals here, and the backfills find their dates in the data themselves.
User statistics and pair statistics are separate grouped relations joined
together; in training every search row carries the number of label-day routes
it is joined to.  The test tables' search logs, orders and tags are derived
from ``events`` by the rules of FIXTURES.md.
"""

from __future__ import annotations

RUN_DATE, PUBLISH_DT, LABEL_DATE = "20240130", "20240129", "20240120"
N_SAMPLE, N_TRAIN, SLICE_SIZE, SLICE_PRED_SIZE, HOLDOUT_N = 50, 50, 40, 10, 200

VALID = "{u} IS NOT NULL AND {u} NOT IN ('', 'NULL', 'null')"

FIXTURE = """
ev AS (
  SELECT event_id, ts, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE user_id % 50 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN 'null' WHEN 3 THEN NULL
              ELSE 'u' || CAST(user_id AS VARCHAR) END AS username,
         CAST(floor(value) AS INTEGER) AS pre_days,
         strftime(ts, '%Y%m%d') AS dt
  FROM events
),
evc AS (
  SELECT *, 'D' || CAST(k % 4 AS VARCHAR) AS dep_city,
         CASE WHEN k >= 96 THEN NULL ELSE 'A' || CAST(k // 25 AS VARCHAR) END AS arr_city
  FROM ev
),
list_log AS (
  SELECT username, dep_city, arr_city, pre_days, strftime(ts, '%Y-%m-%d') AS search_date,
         strftime(ts, '%H:%M:%S') AS search_time, dt
  FROM evc WHERE event_type = 'view'
),
ota_log AS (
  SELECT username, dep_city, arr_city, pre_days, strftime(ts, '%Y-%m-%d') AS search_date,
         strftime(ts, '%H:%M:%S') AS search_time, dt
  FROM evc WHERE event_type = 'click'
),
order_src AS (
  SELECT username, dep_city, arr_city,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time,
         CASE WHEN event_id % 10 = 0 THEN 0 ELSE 1 END AS pay_ok, dt
  FROM evc WHERE event_type = 'purchase'
),
user_tag_src AS (
  SELECT username AS key,
         CASE WHEN k % 40 = 0 THEN 'is_student' WHEN k % 40 = 1 THEN 'is_trader' ELSE 'other' END AS tag
  FROM ev WHERE event_type = 'signup'
),
tag AS (
  SELECT key, max(CASE WHEN tag = 'is_trader' THEN 1 ELSE 0 END) AS is_trader,
         max(CASE WHEN tag = 'is_student' THEN 1 ELSE 0 END) AS is_student
  FROM user_tag_src WHERE tag IN ('is_trader', 'is_student') GROUP BY key
),
searches AS (
  SELECT username, dep_city || '-' || arr_city AS search_route, dep_city, arr_city,
         pre_days, search_date || ' ' || search_time AS log_time, 'list' AS process, dt
  FROM list_log WHERE """ + VALID.format(u="username") + """
  UNION ALL
  SELECT username, dep_city || '-' || arr_city AS search_route, dep_city, arr_city,
         pre_days, search_date || ' ' || search_time AS log_time, 'ota' AS process, dt
  FROM ota_log WHERE """ + VALID.format(u="username") + """
),
paid AS (
  SELECT username, dep_city || '-' || arr_city AS order_route, dep_city, arr_city, create_time, dt
  FROM order_src WHERE pay_ok = 1 AND """ + VALID.format(u="username") + """
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def _window(anchor_days: str, history_back: int, history_near: int, output: int) -> str:
    """CTE ``anchors``: each anchor date with its windows; ``anchor_days`` is SQL for one DATE column d."""
    def day(offset: int) -> str:
        return f"strftime(d - INTERVAL {offset} DAY, '%Y%m%d')"
    return f"""
anchors AS (
  SELECT {day(0)} AS anchor_dt, {day(2)} AS s_lo, {day(1)} AS s_hi, {day(2)} AS r_lo, {day(1)} AS r_hi,
         {day(history_back)} AS h_lo, {day(history_near)} AS h_hi, {day(output)} AS out_dt
  FROM ({anchor_days})
)"""


def _days(first: int, last: int) -> str:
    """All days from ``first`` days after the first event to ``last`` days after the last one."""
    return ("SELECT unnest(generate_series(date_trunc('day', min(ts)) + INTERVAL "
            f"{first} DAY, date_trunc('day', max(ts)) + INTERVAL {last} DAY, INTERVAL 1 DAY)) AS d FROM events")


def _day(dt: str) -> str:
    return f"SELECT strptime('{dt}', '%Y%m%d') AS d"


def _serving_anchors(days: str) -> str:
    return _window(days, 731, 3, 1)


def _training_anchors(days: str) -> str:
    return _window(days, 732, 1, 0)


RUNS, RUN = _serving_anchors(_days(1, 2)), _serving_anchors(_day(RUN_DATE))
LABELS, LABEL = _training_anchors(_days(2, 0)), _training_anchors(_day(LABEL_DATE))


def _features(src: str, label: bool) -> str:
    """Feature rows of the weighted search rows ``src``: anchor_dt, username, search_route, dep_city,
    arr_city, pre_days, process, times (how often the row counts), in_label if ``label``."""
    def times(process: str, more: str = "") -> str:
        return f"coalesce(sum(times) FILTER (WHERE process = '{process}'{more}), 0)"

    def lead(process: str) -> dict[str, str]:
        own = f"FILTER (WHERE process = '{process}')"
        return {"max": f"max(pre_days) {own}", "min": f"min(pre_days) {own}",
                "avg": f"CAST(sum(times * pre_days) {own} AS DOUBLE) / "
                       f"nullif(CAST({times(process, ' AND pre_days IS NOT NULL')} AS DOUBLE), 0)"}
    search, ota = lead("list"), lead("ota")
    return f"""
user_stats AS (
  SELECT anchor_dt, username, {times('list')} AS searches, {times('ota')} AS otas,
         count(DISTINCT dep_city) AS dep_cities, count(DISTINCT arr_city) AS arr_cities,
         count(DISTINCT coalesce(search_route, '')) AS routes
  FROM {src} GROUP BY anchor_dt, username
),
pair_stats AS (
  SELECT anchor_dt, username, search_route, {times('list')} AS searches, {times('ota')} AS otas,
         {search['max']} AS s_max, {search['min']} AS s_min, {search['avg']} AS s_avg,
         {ota['max']} AS o_max, {ota['min']} AS o_min, {ota['avg']} AS o_avg
         {", max(CASE WHEN in_label THEN 1 ELSE 0 END) AS label" if label else ""}
  FROM {src} GROUP BY anchor_dt, username, search_route
),
bought_before AS (
  SELECT DISTINCT anchor_dt, username, order_route AS search_route, 1 AS bought
  FROM paid, anchors WHERE dt BETWEEN h_lo AND h_hi AND order_route IS NOT NULL
),
feat AS (
  SELECT p.anchor_dt, a.out_dt, p.username, CAST(u.routes AS INTEGER) AS route_cnt, p.search_route,
    CAST(u.searches AS INTEGER) AS search_route_cnt, CAST(p.searches AS INTEGER) AS search_route_single_cnt,
    CAST(p.searches AS DOUBLE) / nullif(CAST(u.searches AS DOUBLE), 0) AS search_rate,
    CAST(u.otas AS INTEGER) AS ota_route_cnt, CAST(p.otas AS INTEGER) AS ota_route_single_cnt,
    CAST(p.otas AS DOUBLE) / nullif(CAST(u.otas AS DOUBLE), 0) AS ota_rate,
    CAST(s_max AS DOUBLE) AS search_pre_days_max, CAST(s_min AS DOUBLE) AS search_pre_days_min,
    s_avg AS search_pre_days_avg,
    CAST(coalesce(o_max, s_max) AS DOUBLE) AS ota_pre_days_max,
    CAST(coalesce(o_min, s_min) AS DOUBLE) AS ota_pre_days_min,
    coalesce(o_avg, s_avg) AS ota_pre_days_avg,
    CAST(u.dep_cities AS INTEGER) AS dep_city_cnt, CAST(u.arr_cities AS INTEGER) AS arr_city_cnt,
    coalesce(b.bought, 0) AS has_history_route, tag.is_student, tag.is_trader
    {", CAST(p.label AS INTEGER) AS label" if label else ""}
  FROM pair_stats p
  JOIN user_stats u USING (anchor_dt, username)
  JOIN anchors a USING (anchor_dt)
  LEFT JOIN bought_before b USING (anchor_dt, username, search_route)
  LEFT JOIN tag ON tag.key = p.username
)"""


FEATURE_SELECT = """username, route_cnt, search_route, search_route_cnt, search_route_single_cnt,
  search_rate, ota_route_cnt, ota_route_single_cnt, ota_rate, search_pre_days_max, search_pre_days_min,
  search_pre_days_avg, ota_pre_days_max, ota_pre_days_min, ota_pre_days_avg, dep_city_cnt, arr_city_cnt,
  has_history_route, is_student, is_trader"""


def serving_ctes(anchors: str) -> str:
    """CTE chain ending in ``feat`` (serving features of every run date)."""
    return _with(FIXTURE, anchors, """
kept AS (
  SELECT a.anchor_dt, s.*, 1 AS times FROM searches s JOIN anchors a ON s.dt BETWEEN a.s_lo AND a.s_hi
  WHERE NOT EXISTS (SELECT 1 FROM paid p WHERE p.username = s.username AND p.dt BETWEEN a.r_lo AND a.r_hi)
)""", _features("kept", label=False))


def training_ctes(anchors: str) -> str:
    """CTE chain ending in ``feat`` (training rows with label)."""
    return _with(FIXTURE, anchors, """
day_routes AS (
  SELECT anchor_dt, username, order_route, max(create_time) AS last_time, CAST(count(*) AS INTEGER) AS orders
  FROM paid JOIN anchors ON dt = anchor_dt GROUP BY anchor_dt, username, order_route HAVING count(*) < 20
),
label_routes AS (
  SELECT d.* FROM day_routes d JOIN anchors a USING (anchor_dt)
  WHERE NOT EXISTS (SELECT 1 FROM paid p WHERE p.username = d.username AND p.dt BETWEEN a.r_lo AND a.r_hi)
),
numbered AS (
  SELECT row_number() OVER () AS id, a.anchor_dt, s.* FROM searches s JOIN anchors a ON s.dt BETWEEN a.s_lo AND a.s_hi
),
counted AS (
  SELECT id, count(*) FILTER (WHERE r.last_time >= log_time) AS times,
         coalesce(bool_or(r.order_route = n.search_route), false) AS in_label
  FROM numbered n JOIN label_routes r USING (anchor_dt, username) GROUP BY id
),
weighted AS (SELECT n.*, times, in_label FROM numbered n JOIN counted USING (id) WHERE times > 0)
""", _features("weighted", label=True))


def _serving(anchors: str, select: str) -> str:
    return serving_ctes(anchors) + "\n" + select


def _training(anchors: str, select: str) -> str:
    return training_ctes(anchors) + "\n" + select


SERVING_ALL = f"SELECT {FEATURE_SELECT}, out_dt AS dt FROM feat"
TRAINING_ALL = f"SELECT {FEATURE_SELECT}, label, anchor_dt AS label_dt FROM feat"
#: The 18 model inputs.
MODEL_INPUTS = [c.strip() for c in FEATURE_SELECT.replace("\n", " ").split(",") if c.strip() not in ("username", "search_route")]
HEURISTIC = "0.5 * coalesce(search_rate, 0.0) + 0.5 * CAST(coalesce(has_history_route, 0) AS DOUBLE)"
KEY = "username, search_route, label_dt"


def _hash(purpose: str) -> str:
    """Hash of a row's key for one draw; ``purpose`` names the draw and its seed."""
    return (f"md5(concat_ws('|', coalesce(username, '\\N'), coalesce(search_route, '\\N'), "
            f"coalesce(label_dt, '\\N'), '{purpose}'))")


def _imputed_training(anchors) -> str:
    """CTE ``tr``: training rows with the 18 inputs null-filled with 0."""
    cols = []
    for c in FEATURE_SELECT.replace("\n", " ").split(","):
        c = c.strip()
        cols.append(c if c in ("username", "search_route") else f"coalesce({c}, 0) AS {c}")
    return (training_ctes(anchors) + f""",
tr AS (SELECT {', '.join(cols)}, label, anchor_dt AS label_dt FROM feat),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY
           CASE WHEN label = 1 THEN {_hash('sample-pos:1')} ELSE {_hash('sample-neg:43')} END) AS rk
  FROM tr
),
sample AS (SELECT * EXCLUDE (rk) FROM ranked WHERE rk <= {N_SAMPLE}),
holdout AS (SELECT * EXCLUDE (rk) FROM ranked WHERE rk > {N_SAMPLE}),
split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY {_hash('split:43')}) <= {N_TRAIN} THEN 'train' ELSE 'test' END AS split
  FROM sample
)""")


def _scored_training(anchors) -> str:
    return training_ctes(anchors) + f""",
sc AS (
  SELECT username, search_route, anchor_dt AS label_dt, label, {HEURISTIC} AS score,
         CASE WHEN {HEURISTIC} > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM feat
),
cm AS (
  SELECT count(CASE WHEN prediction = 1 AND label = 1 THEN 1 END) AS tp,
         count(CASE WHEN prediction = 1 AND label = 0 THEN 1 END) AS fp,
         count(CASE WHEN prediction = 0 AND label = 1 THEN 1 END) AS fn,
         count(CASE WHEN prediction = 0 AND label = 0 THEN 1 END) AS tn
  FROM sc
),
rates AS (
  SELECT *,
    coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0.0) AS p1,
    coalesce(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0.0) AS r1,
    coalesce(CAST(tn AS DOUBLE) / NULLIF(CAST(tn + fn AS DOUBLE), 0), 0.0) AS p0,
    coalesce(CAST(tn AS DOUBLE) / NULLIF(CAST(tn + fp AS DOUBLE), 0), 0.0) AS r0,
    tp + fp + fn + tn AS total
  FROM cm
),
f AS (
  SELECT *,
    coalesce(2 * p1 * r1 / NULLIF(p1 + r1, 0), 0.0) AS f1_1,
    coalesce(2 * p0 * r0 / NULLIF(p0 + r0, 0), 0.0) AS f1_0
  FROM rates
)"""


def _split_gains() -> str:
    """Penalised gain of every midpoint cut at margin 0: g = 1/2 - label and h = 1/4 a row, L1 = L2 = 1, least child weight 0.8."""
    values = ", ".join(f"{{'feature': '{c}', 'value': CAST({c} AS DOUBLE)}}" for c in MODEL_INPUTS)
    soft = "sign({g}) * greatest(abs({g}) - 1, 0)"
    best = "CASE WHEN {h} >= 0.8 THEN pow(" + soft + ", 2) / ({h} + 1) ELSE 0 END"
    left, right, both = (best.format(g=g, h=h) for g, h in (("g_left", "h_left"), ("g_right", "h_right"),
                                                            ("(g_left + g_right)", "(h_left + h_right)")))
    return f""",
long AS (SELECT label, u.feature, u.value FROM (SELECT label, unnest([{values}]) AS u FROM split WHERE split = 'train')),
steps AS (SELECT feature, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS next
          FROM (SELECT DISTINCT feature, value FROM long)),
cuts AS (SELECT feature, (value + next) / 2 AS cut FROM steps WHERE next IS NOT NULL),
sums AS (
  SELECT c.feature, cut, sum(0.5 - label) FILTER (WHERE value < cut) AS g_left, 0.25 * count(*) FILTER (WHERE value < cut) AS h_left,
         sum(0.5 - label) FILTER (WHERE value >= cut) AS g_right, 0.25 * count(*) FILTER (WHERE value >= cut) AS h_right
  FROM cuts c JOIN long l ON c.feature = l.feature GROUP BY c.feature, cut)
SELECT feature, cut, CAST(g_left AS DOUBLE) AS g_left, CAST(h_left AS DOUBLE) AS h_left, CAST(g_right AS DOUBLE) AS g_right,
  CAST(h_right AS DOUBLE) AS h_right,
  round(CASE WHEN h_left >= 0.8 AND h_right >= 0.8 THEN CAST({left} + {right} - {both} AS DOUBLE) ELSE 0 END, 9) AS gain
FROM sums"""


def _published_serving(select: str) -> str:
    return _serving(RUNS, select)


def oracle_sql() -> dict[str, str]:
    runs, run, labels_, label, dt = RUNS, RUN, LABELS, LABEL, PUBLISH_DT
    h_lo, h_hi = "20220129", "20240127"  # 731 and 3 days before the run date
    pair_select = ("SELECT username, anchor_dt AS run_dt, search_route, {cols} FROM kept_all "
                   "GROUP BY username, anchor_dt, search_route")
    log_all = _with(FIXTURE, runs, """
kept_all AS (SELECT a.anchor_dt, s.* FROM searches s JOIN anchors a ON s.dt BETWEEN a.s_lo AND a.s_hi)""")
    user_select = ("SELECT username, anchor_dt AS run_dt, {cols} FROM kept_all "
                   "GROUP BY username, anchor_dt")
    q = {
        "serving_features": _serving(runs, SERVING_ALL),
        "serving_features_day": _serving(run, SERVING_ALL),
        "unified_search_log": _with(FIXTURE) + "\nSELECT * FROM searches",
        "valid_user_filter": _with(FIXTURE) + """
SELECT source, u AS username, count(*) AS row_cnt FROM (
  SELECT 'list' AS source, username AS u FROM list_log
  UNION ALL SELECT 'ota', username FROM ota_log
  UNION ALL SELECT 'orders', username FROM order_src
) x WHERE """ + VALID.format(u="u") + " GROUP BY source, u",
        "paid_orders_window": _with(FIXTURE) + f"\nSELECT * FROM paid WHERE dt >= '{h_lo}' AND dt <= '{h_hi}'",
        "recent_buyers": _with(FIXTURE, labels_) + """
SELECT DISTINCT p.username, a.anchor_dt AS label_dt
FROM paid p JOIN anchors a ON p.dt BETWEEN a.r_lo AND a.r_hi""",
        "order_history_routes": _with(FIXTURE) + f"""
SELECT username, order_route FROM paid WHERE dt >= '{h_lo}' AND dt <= '{h_hi}'
GROUP BY username, order_route""",
        "user_tag_flags": _with(FIXTURE) + "\nSELECT key, is_trader, is_student FROM tag",
        "date_window_bounds": _with(FIXTURE) + """,
days AS (SELECT DISTINCT dt AS anchor_dt, strptime(dt, '%Y%m%d') AS d FROM searches)
SELECT anchor_dt,
  strftime(d - INTERVAL 2 DAY, '%Y%m%d') AS search_lo, strftime(d - INTERVAL 1 DAY, '%Y%m%d') AS search_hi,
  strftime(d - INTERVAL 2 DAY, '%Y%m%d') AS recent_lo, strftime(d - INTERVAL 1 DAY, '%Y%m%d') AS recent_hi,
  strftime(d - INTERVAL 731 DAY, '%Y%m%d') AS serving_history_lo,
  strftime(d - INTERVAL 3 DAY, '%Y%m%d') AS serving_history_hi,
  strftime(d - INTERVAL 1 DAY, '%Y%m%d') AS output_dt,
  strftime(d - INTERVAL 732 DAY, '%Y%m%d') AS training_history_lo,
  strftime(d - INTERVAL 1 DAY, '%Y%m%d') AS training_history_hi
FROM days""",
        "exclude_recent_buyers_pairs": _serving(runs, """
SELECT username, anchor_dt AS run_dt, search_route, search_route_single_cnt, ota_route_single_cnt FROM feat"""),
        "exclude_recent_buyers_log": serving_ctes(runs) + """
SELECT username, search_route, dep_city, arr_city, pre_days, log_time, process, dt, anchor_dt AS run_dt
FROM kept""",
        "pair_counts": log_all + "\n" + pair_select.format(cols="""
  CAST(count(CASE WHEN process = 'list' THEN 1 END) AS INTEGER) AS search_route_single_cnt,
  CAST(count(CASE WHEN process = 'ota' THEN 1 END) AS INTEGER) AS ota_route_single_cnt"""),
        "lead_days_stats": log_all + "\n" + pair_select.format(cols="""
  CAST(max(CASE WHEN process = 'list' THEN pre_days END) AS DOUBLE) AS search_pre_days_max,
  CAST(min(CASE WHEN process = 'list' THEN pre_days END) AS DOUBLE) AS search_pre_days_min,
  avg(CASE WHEN process = 'list' THEN pre_days END) AS search_pre_days_avg,
  CAST(max(CASE WHEN process = 'ota' THEN pre_days END) AS DOUBLE) AS ota_pre_days_max,
  CAST(min(CASE WHEN process = 'ota' THEN pre_days END) AS DOUBLE) AS ota_pre_days_min,
  avg(CASE WHEN process = 'ota' THEN pre_days END) AS ota_pre_days_avg"""),
        "user_totals": log_all + "\n" + user_select.format(cols="""
  CAST(count(CASE WHEN process = 'list' THEN 1 END) AS INTEGER) AS search_route_cnt,
  CAST(count(CASE WHEN process = 'ota' THEN 1 END) AS INTEGER) AS ota_route_cnt"""),
        "user_city_counts": log_all + "\n" + user_select.format(cols="""
  CAST(count(DISTINCT dep_city) AS INTEGER) AS dep_city_cnt,
  CAST(count(DISTINCT arr_city) AS INTEGER) AS arr_city_cnt"""),
        "user_route_cnt": log_all + "\n" + user_select.format(cols="""
  CAST(count(DISTINCT search_route) + max(CASE WHEN search_route IS NULL THEN 1 ELSE 0 END) AS INTEGER)
    AS route_cnt"""),
        "pair_rates": _serving(runs, "SELECT username, search_route, out_dt AS dt, search_rate, ota_rate FROM feat"),
        "lead_days_fallback": _serving(runs, "SELECT username, search_route, out_dt AS dt, "
                                             "ota_pre_days_max, ota_pre_days_min, ota_pre_days_avg FROM feat"),
        "history_route_flag": _serving(runs, "SELECT username, search_route, out_dt AS dt, "
                                             "has_history_route FROM feat"),
        "attach_user_tags": _serving(runs, "SELECT username, search_route, out_dt AS dt, "
                                           "is_student, is_trader FROM feat"),
        "impute_constant": _serving(runs, "SELECT " + ", ".join(
            c.strip() if c.strip() in ("username", "search_route") else f"coalesce({c.strip()}, 0) AS {c.strip()}"
            for c in FEATURE_SELECT.replace("\n", " ").split(",")) + ", out_dt AS dt FROM feat"),
        "label_day_orders": training_ctes(labels_) + """
SELECT username, anchor_dt AS label_dt, order_route, last_time AS create_time_max, orders AS order_cnt,
  CAST(count(order_route) OVER (PARTITION BY username, anchor_dt) AS INTEGER) AS route_set_cnt
FROM day_routes""",
        "exclude_recent_buyers_orders": training_ctes(labels_) + """
SELECT username, anchor_dt AS label_dt, order_route, last_time AS create_time_max, orders AS order_cnt
FROM label_routes""",
        "pre_order_searches": training_ctes(labels_) + """
SELECT username, anchor_dt AS label_dt, log_time, search_route, dep_city, arr_city, pre_days, process,
  CAST(sum(times) AS INTEGER) AS fanout, max(CASE WHEN in_label THEN 1 ELSE 0 END) AS in_label
FROM weighted GROUP BY username, anchor_dt, log_time, search_route, dep_city, arr_city, pre_days, process""",
        "pair_label": training_ctes(labels_) + "\nSELECT username, search_route, anchor_dt AS label_dt, label FROM feat",
        "training_set": _training(labels_, TRAINING_ALL),
        "training_set_day": _training(label, TRAINING_ALL),
        "feature_matrix": _training(labels_, "SELECT " + ", ".join(
            f"coalesce({c.strip()}, 0) AS {c.strip()}" for c in FEATURE_SELECT.replace("\n", " ").split(",")
            if c.strip() not in ("username", "search_route")) + ", label FROM feat"),
        "balanced_sample": _imputed_training(labels_) + f"\nSELECT {KEY}, label FROM sample",
        "balanced_slices": _imputed_training(labels_) + f""",
sl AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_hash('slices:0')}) AS rk FROM tr)
SELECT {KEY}, label, CASE WHEN rk <= {SLICE_SIZE} THEN 'train' ELSE 'predict' END AS slice
FROM sl WHERE rk <= {SLICE_SIZE + SLICE_PRED_SIZE}""",
        "holdout_complement": _imputed_training(labels_) + f"\nSELECT {KEY}, label FROM holdout",
        "holdout_sample": _imputed_training(labels_) + f"""
SELECT {KEY}, label FROM holdout ORDER BY {_hash('holdout:90')} LIMIT {HOLDOUT_N}""",
        "train_test_split": _imputed_training(labels_) + f"\nSELECT {KEY}, label, split FROM split",
        "split_counts": _imputed_training(labels_) + """
SELECT split, label, count(*) AS count FROM (
  SELECT split, label FROM split UNION ALL SELECT 'holdout', label FROM holdout
) x GROUP BY split, label""",
        "label_distribution": training_ctes(labels_) + "\nSELECT label, count(*) AS count FROM feat GROUP BY label",
        "class_ratio": training_ctes(labels_) + """
SELECT count(CASE WHEN label = 1 THEN 1 END) AS n_pos, count(CASE WHEN label = 0 THEN 1 END) AS n_neg,
  CAST(count(CASE WHEN label = 0 THEN 1 END) AS DOUBLE) / NULLIF(CAST(count(CASE WHEN label = 1 THEN 1 END) AS DOUBLE), 0)
    AS scale_pos_weight
FROM feat""",
        "threshold_class": _scored_training(labels_) + f"""
SELECT {KEY}, label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred_gt,
  CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred_ge FROM sc""",
        "confusion_matrix": _scored_training(labels_) + """
SELECT prediction, count(CASE WHEN label = 0 THEN 1 END) AS true_0, count(CASE WHEN label = 1 THEN 1 END) AS true_1
FROM sc GROUP BY prediction""",
        "binary_metrics": _scored_training(labels_) + """
SELECT tp, fp, fn, tn, coalesce(CAST(tp + tn AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0), 0.0) AS accuracy,
  p1 AS precision, r1 AS recall, f1_1 AS f1 FROM f""",
        "classification_report": _scored_training(labels_) + """
SELECT '0' AS class, p0 AS precision, r0 AS recall, f1_0 AS f1_score, CAST(tn + fp AS BIGINT) AS support FROM f
UNION ALL SELECT '1', p1, r1, f1_1, CAST(tp + fn AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, coalesce(CAST(tp + tn AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0), 0.0),
  CAST(total AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, CAST(total AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg',
  coalesce((p0 * (tn + fp) + p1 * (tp + fn)) / NULLIF(CAST(total AS DOUBLE), 0), 0.0),
  coalesce((r0 * (tn + fp) + r1 * (tp + fn)) / NULLIF(CAST(total AS DOUBLE), 0), 0.0),
  coalesce((f1_0 * (tn + fp) + f1_1 * (tp + fn)) / NULLIF(CAST(total AS DOUBLE), 0), 0.0),
  CAST(total AS BIGINT) FROM f""",
        "auc_hard_label": _scored_training(labels_) + """
SELECT (CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0)
      + CAST(tn AS DOUBLE) / NULLIF(CAST(tn + fp AS DOUBLE), 0)) / 2 AS auc FROM cm""",
        "score_histogram": _scored_training(labels_) + """
SELECT label, least(CAST(floor(score * 20) AS INTEGER), 19) AS bin, count(*) AS count FROM sc GROUP BY 1, 2""",
        "auc_score": _scored_training(labels_) + """,
g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS neg_below FROM g)
SELECT round(sum(pos * (neg_below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0), 10) AS auc FROM c""",
        "publish_features": _published_serving(SERVING_ALL),
        "feature_partition_extract": _published_serving(SERVING_ALL + f" WHERE out_dt = '{dt}'"),
        "drop_partition": _published_serving(SERVING_ALL + f" WHERE out_dt <> '{dt}'"),
        "overwrite_partition_empty": _published_serving(
            f"SELECT out_dt AS dt, count(*) AS count FROM feat WHERE out_dt <> '{dt}' GROUP BY out_dt"),
        "drop_table": _published_serving("SELECT 'route_features' AS tables, count(*) AS rows FROM feat"),
        "partition_counts_latest": _published_serving(
            "SELECT out_dt AS dt, count(*) AS count FROM feat GROUP BY out_dt ORDER BY out_dt DESC LIMIT 5"),
        "tsv_roundtrip": _published_serving(SERVING_ALL + f" WHERE out_dt = '{dt}'"),
        "publish_scores": _published_serving(f"""
SELECT username, search_route, {HEURISTIC} AS q_ratio, out_dt AS dt FROM feat WHERE out_dt = '{dt}'"""),
        "publish_model_scores": _published_serving(f"""
SELECT username, search_route, out_dt AS dt, true AS is_probability, 2 AS refused FROM feat WHERE out_dt = '{dt}'"""),
        "publish_features_orc": _published_serving(SERVING_ALL),
        "history_state_routes": _with(FIXTURE) + f"""
SELECT DISTINCT username, order_route FROM paid WHERE dt >= '{h_lo}' AND dt <= '{h_hi}' AND order_route IS NOT NULL""",
        "serving_features_stored": _serving(run, SERVING_ALL),
        "colocated_flags": _published_serving(f"""
SELECT username, search_route, out_dt AS dt, is_student, is_trader, has_history_route FROM feat WHERE out_dt = '{dt}'"""),
        "peek_counts": _published_serving(f"""
SELECT least(count(*), 5) AS n_shown, least(count(*), 5) AS n_held FROM feat WHERE out_dt = '{dt}'"""),
        "gbt_split_gains": _imputed_training(labels_) + _split_gains(),
        "gbt_score_ranges": _serving(run, "SELECT username, search_route, out_dt AS dt, true AS is_probability FROM feat"),
        "gbt_first_trees": _serving(run, "SELECT username, search_route, out_dt AS dt, true AS same FROM feat"),
        "model_roundtrip": _serving(run, "SELECT username, search_route, out_dt AS dt, true AS same FROM feat"),
        "gbt_holdout_counts": _imputed_training(labels_) + """
SELECT count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg FROM holdout""",
    }
    return q
