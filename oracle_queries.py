"""The registered queries once more, as SQL for an independent engine.

Written from the rules, with row numbers and windows instead of mergeable aggregates.
"""

_LOG = """
log AS (
  SELECT event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'CUSTOMER' WHEN 'view' THEN 'SITE_VISIT'
                         WHEN 'click' THEN 'IMAGE' WHEN 'purchase' THEN 'ORDER' ELSE 'OTHER' END AS type,
         CASE WHEN event_type = 'click' THEN 'UPLOAD' WHEN event_type = 'view' THEN 'NEW'
              WHEN k % 3 = 0 THEN 'UPDATE' ELSE 'NEW' END AS verb,
         CASE event_type WHEN 'signup' THEN user_id WHEN 'purchase' THEN (user_id // 2) * 10 + k % 7
                         ELSE event_id // 2 END AS key,
         user_id AS customer_id,
         ts,
         CASE WHEN k % 19 <> 0 THEN CAST(ts AS DATE) END AS event_date,
         CASE WHEN event_type = 'purchase' AND k % 17 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS amount,
         CASE WHEN event_type = 'signup' AND k % 7 <> 0 THEN 'Name' || k END AS last_name,
         CASE WHEN event_type = 'signup' AND k % 11 <> 0 THEN 'City' || (k % 10) END AS adr_city,
         CASE WHEN event_type = 'signup' THEN 'State' || (k % 5) END AS adr_state,
         CASE WHEN event_type = 'view' THEN
              CASE WHEN event_id % 2 = 0 THEN props ELSE '[' || props || ']' END END AS tags,
         CASE WHEN event_type = 'click' AND k % 4 <> 0 THEN 'Make' || (k % 4) END AS camera_make,
         CASE WHEN event_type = 'click' THEN 'Model' || (k % 9) END AS camera_model,
         k
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) AS e
)"""


def _fold(skip: bool = False) -> str:
    dropped = "AND NOT (type = 'SITE_VISIT' AND event_date IS NULL)" if skip else ""
    return f"""{_LOG},
valid AS (
  SELECT *, (type IN ('SITE_VISIT', 'IMAGE') OR verb = 'NEW') AS opens
  FROM log
  WHERE type <> 'OTHER' AND NOT (type = 'ORDER' AND amount IS NULL) {dropped}
),
placed AS (
  SELECT *, min(CASE WHEN opens THEN seq END) OVER (PARTITION BY type, key) AS first_seq FROM valid
),
state AS (
  SELECT *, seq AS last_seq
  FROM placed
  WHERE seq = first_seq OR (NOT opens AND seq > first_seq)
  QUALIFY row_number() OVER (PARTITION BY type, key ORDER BY seq DESC) = 1
)"""


def _scores(source: str, weeks: str = "weeks") -> str:
    """Three-stage half-up rounding in whole cents over (visits, weeks, revenue)."""
    return f"""
rated AS (
  SELECT *,
         CASE WHEN visits > 0
              THEN (CAST(revenue * 10000 AS HUGEINT) + 50 * visits) // (100 * visits) ELSE 0 END AS rpv_c,
         CASE WHEN {weeks} > 0 THEN (200 * visits + {weeks}) // (2 * {weeks}) ELSE 0 END AS vpw_c
  FROM {source}
),
scored AS (
  SELECT *,
         CAST(rpv_c AS DOUBLE) / 100 AS revenue_per_visit,
         CAST(vpw_c AS DOUBLE) / 100 AS visits_per_week,
         CAST((52 * rpv_c * vpw_c + 5) // 10 AS DOUBLE) / 100 AS ltv
  FROM rated
)"""


_WEEK_U = "CAST(strftime(event_date, '%U') AS INT)"
_WEEK_START = "event_date - CAST(dayofweek(event_date) AS INT)"


def _metrics(facts: str, week: str, unknown: str = "-1") -> str:
    return f"""
metrics AS (
  SELECT customer_id,
         count(*) FILTER (WHERE type = 'SITE_VISIT') AS visits,
         count(DISTINCT coalesce({week}, {unknown})) FILTER (WHERE type = 'SITE_VISIT') AS weeks,
         sum(CASE WHEN type = 'ORDER' THEN amount END) AS revenue
  FROM {facts}
  WHERE type IN ('SITE_VISIT', 'ORDER')
  GROUP BY customer_id
)"""


_PEOPLE = """
people AS (
  SELECT key AS customer_id, last_name, adr_city, adr_state, first_seq, last_seq
  FROM state WHERE type = 'CUSTOMER'
),
joined AS (
  SELECT p.*, coalesce(m.visits, 0) AS visits, coalesce(m.weeks, 0) AS weeks, coalesce(m.revenue, 0) AS revenue
  FROM people AS p LEFT JOIN metrics AS m ON m.customer_id = p.customer_id
)"""

_FOLDED = f"WITH {_fold()}, {_metrics('state', _WEEK_U)}, {_PEOPLE}, {_scores('joined')}"
_RESULT = "customer_id, last_name, adr_city, adr_state, revenue_per_visit, visits_per_week, ltv"

_SQL_SCORED = """
sql_scored AS (
  SELECT v.customer_id,
         coalesce(52 * (CAST(s.total_amount AS DOUBLE) / v.total_visits)
                     * (CAST(v.total_visits AS DOUBLE) / nullif(v.distinct_weeks, 0)) * 10, 0) AS ltv
  FROM (SELECT customer_id, count(*) AS total_visits, count(DISTINCT week(event_date)) AS distinct_weeks
        FROM state WHERE type = 'SITE_VISIT' GROUP BY customer_id) AS v
  LEFT JOIN (SELECT customer_id, sum(amount) AS total_amount
             FROM state WHERE type = 'ORDER' GROUP BY customer_id) AS s ON s.customer_id = v.customer_id
),
sql_ranked AS (SELECT *, dense_rank() OVER (ORDER BY ltv DESC) AS rnk FROM sql_scored)"""

_SQL_PEOPLE = """
SELECT c.c_custkey AS customer_id, c.c_name AS last_name, CAST(c.c_nationkey AS VARCHAR) AS adr_city,
       c.c_mktsegment AS adr_state, r.ltv AS ltv"""

_TOUCH = f"""
WITH {_fold()},
owned AS (SELECT *, CASE WHEN type = 'CUSTOMER' THEN key ELSE customer_id END AS owner FROM valid),
born AS (
  SELECT owner, min(seq) AS born_seq FROM owned
  WHERE type = 'SITE_VISIT' OR (type = 'CUSTOMER' AND verb = 'NEW') GROUP BY owner
),
alive AS (SELECT o.* FROM owned AS o JOIN born AS b ON o.owner = b.owner WHERE o.seq >= b.born_seq),
sales AS (
  SELECT *, min(CASE WHEN verb = 'NEW' THEN seq END) OVER (PARTITION BY owner, key) AS placed_seq
  FROM alive WHERE type = 'ORDER'
),
accepted AS (SELECT * FROM sales WHERE seq = placed_seq OR (verb = 'UPDATE' AND seq > placed_seq)),
touched AS (
  SELECT owner, event_date, seq FROM alive WHERE type = 'CUSTOMER'
  UNION ALL
  (SELECT owner, event_date, seq FROM alive WHERE type IN ('SITE_VISIT', 'IMAGE')
   QUALIFY row_number() OVER (PARTITION BY owner, type, key ORDER BY seq) = 1)
  UNION ALL
  SELECT owner, event_date, seq FROM accepted
),
amounts AS (
  SELECT owner, amount FROM accepted QUALIFY row_number() OVER (PARTITION BY owner, key ORDER BY seq DESC) = 1
),
joined AS (
  SELECT t.owner AS customer_id, t.first_seq, t.visits, t.weeks, coalesce(a.revenue, 0) AS revenue
  FROM (SELECT owner, min(seq) AS first_seq, count(*) AS visits, count(DISTINCT coalesce({_WEEK_U}, -1)) AS weeks
        FROM touched GROUP BY owner) AS t
  LEFT JOIN (SELECT owner, sum(amount) AS revenue FROM amounts GROUP BY owner) AS a ON a.owner = t.owner
), {_scores('joined')}"""


def _cross_year(week: str, unknown: str = "-1") -> str:
    return f"""
facts AS (
  SELECT 'SITE_VISIT' AS type, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS event_date,
         CAST(NULL AS DECIMAL(18,4)) AS amount FROM orders
  UNION ALL
  SELECT 'ORDER' AS type, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS event_date,
         CAST(o_totalprice AS DECIMAL(18,4)) AS amount FROM orders
), {_metrics('facts', week, unknown)},
joined AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS last_name, n.n_name AS adr_city, c.c_mktsegment AS adr_state,
         coalesce(m.visits, 0) AS visits, coalesce(m.weeks, 0) AS weeks, coalesce(m.revenue, 0) AS revenue
  FROM customer AS c LEFT JOIN nation AS n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN metrics AS m ON m.customer_id = c.c_custkey
), {_scores('joined')}"""


def _bad_time(skip: bool) -> str:
    return f"""
WITH {_fold(skip)}, {_metrics('state', _WEEK_U)}, {_scores('metrics')}
SELECT customer_id, visits, weeks, visits_per_week FROM scored"""


def _dispositions(skip: bool = False) -> str:
    bad_time = "WHEN type = 'SITE_VISIT' AND event_date IS NULL THEN 'INVALID_EVENT_TIME'" if skip else ""
    return f"""
{_LOG},
faulty AS (
  SELECT *, (type IN ('SITE_VISIT', 'IMAGE') OR verb = 'NEW') AS opens,
         CASE WHEN type = 'OTHER' THEN 'IGNORED_TYPE'
              WHEN type = 'ORDER' AND amount IS NULL THEN 'INVALID_AMOUNT' {bad_time} END AS fault
  FROM log
),
placed AS (
  SELECT *, min(CASE WHEN opens AND fault IS NULL THEN seq END) OVER (PARTITION BY type, key) AS first_seq
  FROM faulty
),
judged AS (
  SELECT *, CASE WHEN fault IS NOT NULL THEN fault
                 WHEN opens AND seq = first_seq THEN 'APPLIED'
                 WHEN type IN ('SITE_VISIT', 'IMAGE') THEN 'DUPLICATE_KEY'
                 WHEN opens THEN 'DUPLICATE_NEW'
                 WHEN seq > first_seq THEN 'APPLIED'
                 ELSE 'UPDATE_WITHOUT_KEY' END AS disposition
  FROM placed
)"""


_BY_TYPE_VERB = f"WITH {_LOG} SELECT type, verb, count(*) AS events FROM log GROUP BY type, verb"
_TOP10 = f"{_FOLDED} SELECT {_RESULT} FROM scored ORDER BY ltv DESC, first_seq LIMIT 10"

_AS_TEXT = f"""{_FOLDED}
        SELECT CAST(customer_id AS VARCHAR) AS customer_id, last_name, adr_city, adr_state,
               revenue_per_visit, visits_per_week, ltv FROM scored"""

ORACLES: dict[str, str] = {
    "ltv_fold_all": f"{_FOLDED} SELECT {_RESULT} FROM scored",
    "ltv_fold_top10": _TOP10,
    "ltv_fold_dense_rank_top10": f"""{_FOLDED}
        SELECT customer_id, ltv, rnk AS rank
        FROM (SELECT *, dense_rank() OVER (ORDER BY ltv DESC) AS rnk FROM scored) AS r WHERE rnk <= 10""",
    "ltv_sql_all": f"""WITH {_fold()}, {_SQL_SCORED} {_SQL_PEOPLE}
        FROM customer AS c JOIN sql_scored AS r ON r.customer_id = c.c_custkey""",
    "ltv_sql_rank_all": f"""WITH {_fold()}, {_SQL_SCORED} {_SQL_PEOPLE}, r.rnk AS rank
        FROM customer AS c JOIN sql_ranked AS r ON r.customer_id = c.c_custkey""",
    "ltv_sql_dense_rank_top10": f"""WITH {_fold()}, {_SQL_SCORED} {_SQL_PEOPLE}, r.rnk AS rank
        FROM customer AS c JOIN sql_ranked AS r ON r.customer_id = c.c_custkey WHERE r.rnk <= 10""",
    "ltv_sql_customer_events_top10": f"""WITH {_fold()}, {_SQL_SCORED}
        SELECT c.key AS customer_id, c.last_name, c.adr_city, c.adr_state, r.ltv AS ltv, r.rnk AS rank
        FROM log AS c JOIN sql_ranked AS r ON r.customer_id = c.key WHERE c.type = 'CUSTOMER' AND r.rnk <= 10""",
    "ltv_touch_all": f"{_TOUCH} SELECT customer_id, visits, weeks, ltv FROM scored",
    "ltv_touch_top10": f"{_TOUCH} SELECT customer_id, ltv FROM scored ORDER BY ltv DESC, first_seq LIMIT 10",
    "touch_customer_profiles": f"""{_TOUCH}
        SELECT customer_id, last_name, adr_city, adr_state
        FROM (SELECT j.customer_id, a.last_name, a.adr_city, a.adr_state, a.seq
              FROM joined AS j LEFT JOIN alive AS a ON a.owner = j.customer_id AND a.type = 'CUSTOMER') AS p
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq DESC) = 1""",
    "ltv_timeframe": f"""WITH {_fold()}, {_metrics('state', _WEEK_U)}, {_PEOPLE},
        frame AS (SELECT date_diff('day', min({_WEEK_START}), max({_WEEK_START})) // 7 + 1 AS frame_weeks
                  FROM state WHERE type <> 'CUSTOMER'),
        framed AS (SELECT * FROM joined, frame), {_scores('framed', 'frame_weeks')}
        SELECT {_RESULT} FROM scored""",
    "ltv_cross_year_u": f"WITH {_cross_year(_WEEK_U)} SELECT {_RESULT} FROM scored",
    "ltv_cross_year_iso": f"WITH {_cross_year('week(event_date)')} SELECT {_RESULT} FROM scored",
    "ltv_cross_year_calendar": f"""WITH {_cross_year(f'({_WEEK_START})', "DATE '0001-01-01'")}
        SELECT {_RESULT} FROM scored""",
    "bad_time_null_week": _bad_time(False),
    "bad_time_skip": _bad_time(True),
    "customer_current": f"WITH {_fold()}, {_metrics('state', _WEEK_U)}, {_PEOPLE} SELECT * FROM people",
    "order_current": f"""WITH {_fold()}
        SELECT key AS order_id, customer_id, CAST(amount AS DOUBLE) AS amount, first_seq, last_seq
        FROM state WHERE type = 'ORDER'""",
    "site_visit_current": f"""WITH {_fold()}
        SELECT key AS page_id, customer_id, strftime(event_date, '%Y-%m-%d') AS event_date, tags
        FROM state WHERE type = 'SITE_VISIT'""",
    "image_current": f"""WITH {_fold()}
        SELECT key AS image_id, customer_id, camera_make, camera_model FROM state WHERE type = 'IMAGE'""",
    "event_dispositions": f"WITH {_dispositions()} SELECT seq, type, verb, key, disposition FROM judged",
    "dispositions_skip_bad_time": f"""WITH {_dispositions(True)}
        SELECT type, disposition, count(*) AS events FROM judged GROUP BY type, disposition""",
    "rejects_by_reason": f"""WITH {_dispositions()}
        SELECT disposition AS reason, count(*) AS events FROM judged
        WHERE disposition <> 'APPLIED' GROUP BY disposition""",
    "rejected_events": f"""WITH {_dispositions()}
        SELECT disposition AS reason, type, key, seq FROM judged WHERE disposition <> 'APPLIED'""",
    "ingest_summary": f"""WITH {_fold()}
        SELECT (SELECT count(*) FROM log) AS total_events,
               (SELECT count(*) FROM state WHERE type = 'CUSTOMER') AS distinct_customers""",
    "events_by_type_verb": _BY_TYPE_VERB,
    "weekly_visit_histogram": f"""WITH {_fold()}
        SELECT customer_id, coalesce({_WEEK_U}, -1) AS week, count(*) AS visits
        FROM state WHERE type = 'SITE_VISIT' GROUP BY ALL""",
    "visit_week_map": f"""WITH {_fold()},
        weekly AS (SELECT customer_id, coalesce({_WEEK_U}, 54) AS wk, count(*) AS visits
                   FROM state WHERE type = 'SITE_VISIT' GROUP BY ALL)
        SELECT customer_id, string_agg(wk || ':' || visits, ',' ORDER BY wk) AS weeks
        FROM weekly GROUP BY customer_id""",
    "visits_per_customer": f"""WITH {_fold()}
        SELECT customer_id, count(*) AS visits FROM state WHERE type = 'SITE_VISIT' GROUP BY customer_id""",
    "revenue_per_customer": f"""WITH {_fold()}
        SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS revenue
        FROM state WHERE type = 'ORDER' GROUP BY customer_id""",
    "visits_per_week": f"{_FOLDED} SELECT customer_id, visits, weeks, visits_per_week FROM scored",
    "revenue_per_visit": f"""{_FOLDED}
        SELECT customer_id, CAST(revenue AS DOUBLE) AS revenue, visits, revenue_per_visit FROM scored""",
    "orphan_facts": f"""WITH {_fold()}
        SELECT customer_id, count(*) FILTER (WHERE type = 'SITE_VISIT') AS visits,
               count(*) FILTER (WHERE type = 'ORDER') AS orders
        FROM state
        WHERE type IN ('SITE_VISIT', 'ORDER')
          AND customer_id NOT IN (SELECT key FROM state WHERE type = 'CUSTOMER')
        GROUP BY customer_id""",
    "orphan_facts_of_segment": f"""WITH {_fold()}
        SELECT customer_id, count(*) FILTER (WHERE type = 'SITE_VISIT') AS visits,
               count(*) FILTER (WHERE type = 'ORDER') AS orders
        FROM state
        WHERE type IN ('SITE_VISIT', 'ORDER')
          AND customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
        GROUP BY customer_id""",
    "customers_without_visits": f"""WITH {_fold()}
        SELECT c.c_custkey AS customer_id, CAST(coalesce(sum(s.amount), 0) AS DOUBLE) AS revenue
        FROM customer AS c LEFT JOIN state AS s ON s.customer_id = c.c_custkey AND s.type = 'ORDER'
        WHERE c.c_custkey NOT IN (SELECT customer_id FROM state WHERE type = 'SITE_VISIT')
        GROUP BY c.c_custkey""",
    "top_per_segment": f"""WITH {_cross_year(_WEEK_U)}
        SELECT adr_state AS segment, customer_id, ltv,
               row_number() OVER (PARTITION BY adr_state ORDER BY ltv DESC, customer_id) AS position
        FROM scored QUALIFY position <= 5""",
    "ltv_rollup_region": f"""WITH {_cross_year(_WEEK_U)}
        SELECT r.r_name AS region, n.n_name AS nation, count(*) AS customers,
               CAST(sum(CAST(ltv AS DECIMAL(24,2))) AS DOUBLE) AS total_ltv, max(ltv) AS top_ltv,
               CAST(grouping(r.r_name, n.n_name) AS BIGINT) AS level
        FROM scored AS s LEFT JOIN nation AS n ON n.n_name = s.adr_city
        LEFT JOIN region AS r ON r.r_regionkey = n.n_regionkey
        GROUP BY ROLLUP (r.r_name, n.n_name)""",
    "tags_normalised": f"""WITH {_LOG} SELECT seq, 'k' AS name, CAST(k AS VARCHAR) AS value
        FROM log WHERE type = 'SITE_VISIT'""",
    "week_functions": f"""
        SELECT strftime(event_date, '%Y-%m-%d') AS day, count(*) AS orders, {_WEEK_U} AS sunday_u,
               week(event_date) AS iso, strftime({_WEEK_START}, '%Y-%m-%d') AS sunday_calendar
        FROM (SELECT CAST(o_orderdate AS DATE) AS event_date FROM orders) AS o GROUP BY event_date""",
    "parsed_amounts": f"""WITH {_LOG}
        SELECT verb, count(amount) AS readable, count(*) - count(amount) AS junk,
               CAST(sum(amount) AS DOUBLE) AS total
        FROM log WHERE type = 'ORDER' GROUP BY verb""",
    "json_round_trip": _AS_TEXT,
    "union_of_logs": f"""WITH {_fold()}
        SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS revenue
        FROM (SELECT customer_id, amount FROM state WHERE type = 'ORDER'
              UNION ALL SELECT o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) FROM orders) AS u
        GROUP BY customer_id""",
    "result_document_top10": f"""{_FOLDED},
        top AS (SELECT *, row_number() OVER (ORDER BY ltv DESC, first_seq) AS rn FROM scored)
        SELECT CAST(to_json(list(json_array(customer_id, json_array(
                 last_name, adr_city, adr_state, revenue_per_visit, visits_per_week, ltv)
               ) ORDER BY rn)) AS VARCHAR) AS value
        FROM top WHERE rn <= 10""",
    "ingested_ltv": f"{_FOLDED} SELECT {_RESULT} FROM scored",
    "ingested_rejects": f"""WITH {_dispositions()}
        SELECT disposition AS reason, type, key, seq FROM judged WHERE disposition <> 'APPLIED'""",
    "ingested_twice_ltv": f"{_FOLDED} SELECT {_RESULT} FROM scored",
    "upserted_ltv": f"{_FOLDED} SELECT {_RESULT} FROM scored",
    "upserted_rejects": f"""WITH {_dispositions()}
        SELECT disposition AS reason, type, key, seq FROM judged WHERE disposition <> 'APPLIED'""",
    "value_store_ltv": f"{_FOLDED} SELECT {_RESULT} FROM scored",
    "value_store_calendar_ltv": f"""WITH {_fold()}, {_metrics('state', f'({_WEEK_START})', "DATE '0001-01-01'")}, {_PEOPLE}, {_scores('joined')}
        SELECT customer_id, visits, weeks, visits_per_week, ltv FROM scored""",
    "ingested_customers_only": f"""WITH {_fold()}
        SELECT key AS customer_id, last_name, adr_city, adr_state,
               0.0 AS revenue_per_visit, 0.0 AS visits_per_week, 0.0 AS ltv
        FROM state WHERE type = 'CUSTOMER'""",
    "json_array_ltv": _AS_TEXT,
    "json_array_lines_ltv": _AS_TEXT,
    "json_lines_ltv": _AS_TEXT,
    "json_split_arrays_ltv": _AS_TEXT,
    "json_salvaged_rejects": f"""WITH {_dispositions()}
        SELECT disposition AS reason, count(*) AS events FROM judged WHERE disposition <> 'APPLIED' GROUP BY disposition
        UNION ALL SELECT 'CORRUPT', count(DISTINCT event_id // 2000) FROM events""",
    "json_with_empty_folder_ltv": _AS_TEXT,
    "json_missing_fields": f"""WITH {_LOG}, judged AS (
          SELECT CASE WHEN seq % 37 = 0 THEN 'MISSING_type' WHEN seq % 31 = 0 THEN 'MISSING_event_time'
                      WHEN type = 'OTHER' THEN NULL WHEN seq % 23 = 0 THEN 'MISSING_key'
                      WHEN type <> 'CUSTOMER' AND seq % 29 = 0 THEN 'MISSING_customer_id'
                      WHEN type = 'ORDER' AND seq % 43 = 0 THEN 'MISSING_total_amount'
                      WHEN type = 'ORDER' AND amount IS NULL THEN NULL
                      WHEN type IN ('CUSTOMER', 'ORDER') AND seq % 41 = 0 THEN 'MISSING_verb' END AS reason FROM log)
        SELECT reason, count(*) AS events FROM judged WHERE reason IS NOT NULL GROUP BY reason""",
    "events_by_inline_kind": f"""WITH {_LOG}, kinds(type, kind) AS (
          VALUES ('CUSTOMER', 'person'), ('SITE_VISIT', 'page'), ('IMAGE', 'picture'), ('ORDER', 'sale'))
        SELECT kind, count(*) AS events FROM log JOIN kinds USING (type) GROUP BY kind
        UNION ALL SELECT 'all', count(*) FROM log""",
    "stream_json_ltv": _AS_TEXT,
    "json_array_rejects": f"""WITH {_dispositions()}
        SELECT disposition AS reason, count(*) AS events FROM judged
        WHERE disposition <> 'APPLIED' GROUP BY disposition UNION ALL SELECT 'CORRUPT', 1""",
    "event_log_by_type_verb": _BY_TYPE_VERB,
    "stream_state_equals_batch": f"""WITH {_fold()}
        SELECT type, key, customer_id, CAST(amount AS DOUBLE) AS amount, first_seq, last_seq FROM state""",
    "stream_partials_ltv": f"{_FOLDED} SELECT {_RESULT} FROM scored",
    "stream_compacted_ltv": f"{_FOLDED} SELECT {_RESULT} FROM scored",
    "stream_ltv_top10": _TOP10,
    "stream_store_top10": _TOP10,
    "stream_store_rejects": f"""WITH {_dispositions()}
        SELECT disposition AS reason, type, key, seq FROM judged WHERE disposition <> 'APPLIED'""",
    "stream_weekly_visits": f"""WITH {_fold()}
        SELECT strftime({_WEEK_START}, '%Y-%m-%d') AS week_start, count(*) AS visits
        FROM state WHERE type = 'SITE_VISIT' GROUP BY ALL""",
    "stream_late_visits": f"""WITH {_fold()}
        SELECT strftime({_WEEK_START}, '%Y-%m-%d') AS week_start, count(*) AS visits
        FROM state WHERE type = 'SITE_VISIT' GROUP BY ALL""",
    "stream_first_seen": f"""WITH {_LOG}
        SELECT DISTINCT type, key FROM log WHERE type IN ('SITE_VISIT', 'IMAGE')""",
    "stream_ingested_log": _BY_TYPE_VERB,
}
