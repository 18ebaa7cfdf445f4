"""The same queries as plain SQL over the test tables, to check results against.

Written from the definitions, without the shortcuts of the Spark plans: pools per
category set, grouping sets, hit arrays and value counts all appear here as the
naive joins and aggregates they replace.
"""

from __future__ import annotations

import re

from cartwise import config
from cartwise.functions.expressions import MULTIPLIER
from cartwise.operators import reports
from cartwise.plans.registry import (
    AGE_GROUPS,
    COVERAGE_CUT_OFFS,
    SEGMENT_PATTERN,
    SUBMISSION_CUSTOMERS,
    WEIGHTS,
)

X = dict(enumerate(config.FEATURE_COLUMNS, start=1))


def _score(n_features: int) -> str:
    terms = [
        f"CAST({c} AS DOUBLE) * CAST({WEIGHTS[c]!r} AS DOUBLE)"
        for c in config.FEATURE_SETS[n_features]
    ]
    text = terms[0]
    for term in terms[1:]:
        text = f"({text} + {term})"
    return text


def _key(column: str, seed: int = config.RANDOM_STATE) -> str:
    """The multiplicative hash of ``expressions.seeded_key`` for ids of 0 and above."""
    return f"((({column} % 4294967296) + {seed}) % 4294967296 * {MULTIPLIER}) % 4294967296"


# Named parts; a part may use those above it.
PARTS: dict[str, str] = {
    "tx": """
        SELECT o_custkey AS customer_id, l_partkey AS item_id, o_orderdate AS created_date,
               l_orderkey AS order_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
        SELECT p_partkey AS item_id, p_brand AS brand,
               'Step ' || CAST((p_size + 9) // 10 AS VARCHAR) AS age_group, p_type AS category
        FROM part""",
    "untidy": """
        SELECT CASE WHEN item_id % 97 <> 0 THEN item_id END AS item_id,
               CASE WHEN item_id % 7 <> 0 THEN brand END AS brand,
               CASE WHEN item_id % 11 <> 0 THEN age_group END AS age_group,
               CASE WHEN item_id % 13 <> 0 THEN category END AS category
        FROM items
        UNION ALL SELECT item_id, brand, age_group, category FROM items WHERE item_id % 5 = 0""",
    "users": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey % 20 <> 0
                    THEN CAST(DATE '1995-01-01' + CAST(c_custkey * 37 % 2400 AS INTEGER) AS DATE)
               END AS date_of_birth
        FROM customer""",
    "purchases": """
        SELECT user_id AS customer_id, event_id % 2000 AS item_id, ts AS created_date,
               event_id AS order_id
        FROM events WHERE event_type = 'purchase'""",
    "hist": """
        SELECT * FROM tx WHERE created_date >= TIMESTAMP '2000-08-01'
                           AND created_date < TIMESTAMP '2001-06-01'""",
    "recent": """
        SELECT * FROM tx WHERE created_date >= TIMESTAMP '2001-06-01'
                           AND created_date < TIMESTAMP '2001-07-01'""",
    "truth": "SELECT DISTINCT customer_id, item_id FROM recent",
    "hi": """
        SELECT hist.*, brand, age_group, category FROM hist LEFT JOIN items USING (item_id)""",
    "pop": "SELECT item_id, count(*) AS n FROM hist GROUP BY item_id",
    "top50": "SELECT item_id FROM pop ORDER BY n DESC, item_id LIMIT 50",
    "cat_ranked": """
        SELECT customer_id, item_id,
               row_number() OVER (PARTITION BY customer_id ORDER BY item_id) AS r
        FROM (SELECT DISTINCT customer_id, category FROM hi) JOIN items USING (category)""",
    "cands": """
        SELECT customer_id, item_id FROM truth
        UNION SELECT customer_id, item_id
              FROM (SELECT DISTINCT customer_id FROM hist), top50
        UNION SELECT customer_id, item_id FROM cat_ranked WHERE r <= 200""",
    "bc": "SELECT customer_id, brand, count(*) AS n FROM hi GROUP BY ALL",
    "ac": "SELECT customer_id, age_group, count(*) AS n FROM hi GROUP BY ALL",
    "cc": "SELECT customer_id, category, count(*) AS n FROM hi GROUP BY ALL",
    "act": f"""
        SELECT customer_id, count(*) AS n, count(DISTINCT created_date) AS t,
               CAST(date_sub('day', max(created_date), TIMESTAMP '2001-06-01') AS INTEGER) AS "{X[4]}",
               CAST(count(*) AS DOUBLE) / greatest(count(DISTINCT created_date), 1) AS "{X[5]}",
               CAST(count(*) > 13 AS INTEGER) AS "{X[6]}",
               CAST(count(*) < 3 AS INTEGER) AS "{X[12]}"
        FROM hist GROUP BY customer_id""",
    "loyal": f"""
        SELECT customer_id, CAST(max(n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS "{X[8]}",
               count(*) AS "{X[9]}"
        FROM bc GROUP BY customer_id""",
    "diverse": f"""
        SELECT customer_id, CAST(count(*) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS "{X[10]}"
        FROM cc GROUP BY customer_id""",
    "daymode": f"""
        SELECT customer_id, CAST(d AS INTEGER) AS "{X[11]}"
        FROM (SELECT customer_id, d,
                     row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, d) AS r
              FROM (SELECT customer_id, isodow(created_date) AS d, count(*) AS n
                    FROM hist GROUP BY ALL))
        WHERE r = 1""",
    "avgpop": f"""
        SELECT customer_id, CAST(sum(pop.n) AS DOUBLE) / count(*) AS "{X[13]}"
        FROM hist JOIN pop USING (item_id) GROUP BY customer_id""",
    "cust": f"""
        SELECT act.*, act."{X[5]}" AS "{X[7]}", "{X[8]}", "{X[9]}", "{X[10]}", "{X[11]}", "{X[13]}"
        FROM act JOIN loyal USING (customer_id) JOIN diverse USING (customer_id)
             JOIN daymode USING (customer_id) JOIN avgpop USING (customer_id)""",
    "given": """
        SELECT customer_id, item_id FROM (
            SELECT customer_id, item_id,
                   row_number() OVER (PARTITION BY customer_id ORDER BY item_id) AS r
            FROM (SELECT DISTINCT customer_id, item_id FROM tx
                  WHERE created_date >= TIMESTAMP '2001-07-01' - INTERVAL 120 DAY
                    AND created_date < TIMESTAMP '2001-07-01'))
        WHERE r <= 100""",
    "feat": "@FEATURES cands@",
    "feat_given": "@FEATURES given@",
    "scored": f"SELECT customer_id, item_id, {_score(13)} AS score FROM feat",
    "ranked": """
        SELECT customer_id, item_id, score,
               CAST(row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, item_id)
                    AS INTEGER) AS rank
        FROM scored""",
    "pred": "SELECT * FROM ranked WHERE rank <= 20",
    "n_true": "SELECT customer_id, count(*) AS n FROM truth GROUP BY customer_id",
    "ks": "SELECT unnest([5, 10, 20]) AS k",
    "ideal": """
        SELECT k, n, sum(1.0 / log2(r + 1)) AS best
        FROM ks, (SELECT unnest(range(1, 21)) AS n), (SELECT unnest(range(1, 21)) AS r)
        WHERE r <= least(n, k) GROUP BY k, n""",
    # One row per (user with predictions, k): hits, gain, precision sum, purchases.
    "hits": """
        SELECT customer_id, item_id, rank,
               row_number() OVER (PARTITION BY customer_id ORDER BY rank) AS nth
        FROM pred JOIN truth USING (customer_id, item_id)""",
    "per_user": """
        SELECT u.customer_id, k, coalesce(t.n, 0) AS n, coalesce(i.best, 0) AS best,
               count(h.rank) AS hits,
               coalesce(sum(1.0 / log2(h.rank + 1)), 0) AS gain,
               coalesce(sum(CAST(h.nth AS DOUBLE) / h.rank), 0) AS psum
        FROM (SELECT DISTINCT customer_id FROM pred) u CROSS JOIN ks
             LEFT JOIN n_true t ON t.customer_id = u.customer_id
             LEFT JOIN ideal i USING (k) LEFT JOIN hits h
               ON h.customer_id = u.customer_id AND h.rank <= k
        WHERE i.n = greatest(least(coalesce(t.n, 0), 20), 1)
        GROUP BY ALL""",
    "rec_eval": """
        SELECT unnest(['precision', 'recall', 'ndcg', 'map']) AS metric, CAST(k AS INTEGER) AS k,
               unnest([avg(hits / k), avg(hits / n), avg(gain / best), avg(psum / least(n, k))])
                 AS value
        FROM per_user WHERE n > 0 GROUP BY k""",
    "rank_eval": """
        SELECT unnest(['precision', 'ndcg']) AS metric, CAST(k AS INTEGER) AS k,
               unnest([avg(hits / k), avg(CASE WHEN n > 0 THEN gain / best ELSE 0 END)]) AS value
        FROM per_user GROUP BY k""",
    "cases": """
        SELECT t.customer_id, t.n AS n_actual, count(h.rank) AS hits,
               count(h.rank) / CAST(10 AS DOUBLE) AS "precision",
               CASE WHEN count(h.rank) >= 7 THEN 'EXCELLENT'
                    WHEN count(h.rank) >= 4 THEN 'GOOD' ELSE 'FAIR' END AS status
        FROM n_true t JOIN (SELECT DISTINCT customer_id FROM pred) USING (customer_id)
             LEFT JOIN hits h ON h.customer_id = t.customer_id AND h.rank <= 10
        GROUP BY t.customer_id, t.n""",
    "cstats": """
        SELECT customer_id, count(item_id) AS num_purchases,
               count(DISTINCT item_id) + CAST(max(CASE WHEN item_id IS NULL THEN 1 ELSE 0 END) AS BIGINT)
                 AS num_unique_items,
               date_sub('day', min(created_date), max(created_date)) AS days_active
        FROM tx GROUP BY customer_id""",
    "istats": """
        SELECT item_id, num_purchases, num_customers, brand, age_group, category
        FROM (SELECT item_id, count(*) AS num_purchases, count(DISTINCT customer_id) AS num_customers
              FROM tx GROUP BY item_id) LEFT JOIN items USING (item_id)""",
    "cmetrics": """
        SELECT 'num_purchases' AS metric, CAST(num_purchases AS DOUBLE) AS value FROM cstats
        UNION ALL SELECT 'num_unique_items', CAST(num_unique_items AS DOUBLE) FROM cstats
        UNION ALL SELECT 'days_active', CAST(days_active AS DOUBLE) FROM cstats""",
    "retention": """
        SELECT cohort_month, CAST(floor(CAST(date_diff('day', cohort_month, month) AS DOUBLE) / 30)
                                  AS INTEGER) AS months_since_first,
               count(DISTINCT customer_id) AS active_customers
        FROM (SELECT customer_id, CAST(date_trunc('month', created_date) AS DATE) AS month FROM tx)
             JOIN (SELECT customer_id, CAST(date_trunc('month', min(created_date)) AS DATE) AS cohort_month
                   FROM tx GROUP BY customer_id) USING (customer_id)
        GROUP BY ALL""",
    "cooc": """
        SELECT a.item_id AS "itemA", b.item_id AS "itemB", count(*) AS cooc_count
        FROM (SELECT DISTINCT customer_id, order_id, item_id FROM hist) a
             JOIN (SELECT DISTINCT customer_id, order_id, item_id FROM hist) b
               ON a.customer_id = b.customer_id AND a.order_id = b.order_id
                  AND a.item_id < b.item_id
        GROUP BY ALL""",
}

_FEATURES = f"""
        SELECT c.customer_id, c.item_id, coalesce(bc.n, 0) AS "{X[1]}",
               coalesce(ac.n, 0) AS "{X[2]}", coalesce(cc.n, 0) AS "{X[3]}",
               {", ".join(f'coalesce(cust."{X[i]}", 0) AS "{X[i]}"' for i in range(4, 14))},
               CAST(CASE WHEN truth.item_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS "Y"
        FROM {{source}} c LEFT JOIN items USING (item_id)
             LEFT JOIN bc ON bc.customer_id = c.customer_id AND bc.brand = items.brand
             LEFT JOIN ac ON ac.customer_id = c.customer_id AND ac.age_group = items.age_group
             LEFT JOIN cc ON cc.customer_id = c.customer_id AND cc.category = items.category
             LEFT JOIN cust ON cust.customer_id = c.customer_id
             LEFT JOIN truth ON truth.customer_id = c.customer_id AND truth.item_id = c.item_id"""

for _name, _text in PARTS.items():
    if _text.startswith("@FEATURES"):
        PARTS[_name] = _FEATURES.format(source=_text.strip("@").split()[1])

# The scorer on each ablation set.
for _n in config.FEATURE_SETS:
    PARTS[f"pred_{_n}"] = f"""
        SELECT {_n} AS fc, customer_id, item_id, rank FROM (
            SELECT customer_id, item_id, row_number() OVER
                   (PARTITION BY customer_id ORDER BY {_score(_n)} DESC, item_id) AS rank
            FROM feat) WHERE rank <= 20"""
PARTS["pred_sets"] = " UNION ALL ".join(f"SELECT * FROM pred_{n}" for n in config.FEATURE_SETS)
PARTS["hits_sets"] = """
        SELECT fc, customer_id, rank,
               row_number() OVER (PARTITION BY fc, customer_id ORDER BY rank) AS nth
        FROM pred_sets JOIN truth USING (customer_id, item_id)"""
PARTS["user_sets"] = """
        SELECT u.fc, u.customer_id, k, t.n, i.best, count(h.rank) AS hits,
               coalesce(sum(1.0 / log2(h.rank + 1)), 0) AS gain,
               coalesce(sum(CAST(h.nth AS DOUBLE) / h.rank), 0) AS psum
        FROM (SELECT DISTINCT fc, customer_id FROM pred_sets) u
             JOIN n_true t USING (customer_id) CROSS JOIN ks LEFT JOIN ideal i USING (k)
             LEFT JOIN hits_sets h
               ON h.fc = u.fc AND h.customer_id = u.customer_id AND h.rank <= k
        WHERE i.n = least(t.n, 20) GROUP BY ALL"""
PARTS["set_eval"] = """
        SELECT CAST(fc AS BIGINT) AS feature_count,
               unnest(['precision', 'recall', 'ndcg', 'map']) AS metric, CAST(k AS INTEGER) AS k,
               unnest([avg(hits / k), avg(hits / n), avg(gain / best), avg(psum / least(n, k))])
                 AS value
        FROM user_sets GROUP BY fc, k"""
PARTS["set_table"] = """
        SELECT feature_count,
               max(value) FILTER (metric = 'precision' AND k = 5) AS p5,
               max(value) FILTER (metric = 'precision' AND k = 10) AS p10,
               max(value) FILTER (metric = 'precision' AND k = 20) AS p20,
               max(value) FILTER (metric = 'recall' AND k = 10) AS r10,
               max(value) FILTER (metric = 'recall' AND k = 20) AS r20,
               max(value) FILTER (metric = 'ndcg' AND k = 10) AS ndcg10,
               max(value) FILTER (metric = 'map' AND k = 10) AS map10
        FROM set_eval GROUP BY feature_count"""


def _with(body: str) -> str:
    """``body`` behind a WITH clause of the parts it uses, directly or not."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\b[a-z_][a-z_0-9]*\b", text)):
            if word in PARTS and word not in needed:
                needed.add(word)
                visit(PARTS[word])

    visit(body)
    parts = [f"{n} AS ({PARTS[n].strip()})" for n in PARTS if n in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _describe(metric: str, column: str, source: str) -> str:
    value = f"CAST({column} AS DOUBLE)"
    return f"""
        SELECT '{metric}' AS metric, count({column}) AS "count",
               count(*) - count({column}) AS null_count, round(avg({value}), 6) AS mean,
               round(stddev_samp({value}), 6) AS std, round(min({value}), 6) AS min,
               round(quantile_cont({value}, 0.25), 6) AS q1,
               round(quantile_cont({value}, 0.5), 6) AS median,
               round(quantile_cont({value}, 0.75), 6) AS q3, round(max({value}), 6) AS max
        FROM {source}"""


def _iqr(quartiles: str) -> str:
    return f"""
        SELECT metric, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
               round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound,
               round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound,
               count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))
                 AS num_outliers,
               round(count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))
                     / CAST(count(*) AS DOUBLE), 6) AS outlier_rate
        FROM cmetrics JOIN ({quartiles}) USING (metric) GROUP BY metric, q1, q3"""


def _profile(name: str, table: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, CAST({len(columns)} AS BIGINT) AS n_columns,
            count(*) AS n_rows, '{c}' AS column_name, '{t}' AS dtype,
            count(*) - count({c}) AS null_count,
            CASE WHEN count(*) > 0 THEN (count(*) - count({c})) * CAST(100 AS DOUBLE) / count(*)
                 ELSE 0 END AS null_pct FROM {table}"""
        for c, t in columns
    )


def _nulls(name: str, table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{c}' AS "column", count(*) - count({c}) AS null_count,
            (count(*) - count({c})) / CAST(count(*) AS DOUBLE) AS null_rate FROM {table}"""
        for c in columns
    )


_TX_COLUMNS = [
    ("customer_id", "bigint"),
    ("item_id", "bigint"),
    ("created_date", "timestamp_ntz"),
    ("order_id", "bigint"),
]
_ITEM_COLUMNS = [(c, "string") for c in ("brand", "age_group", "category")]
_ITEM_COLUMNS.insert(0, ("item_id", "bigint"))
_USER_COLUMNS = [("customer_id", "bigint"), ("date_of_birth", "date")]


def _lookback(days: int, end: str = "2001-06-01") -> str:
    return f"""created_date >= TIMESTAMP '{end}' - INTERVAL {days} DAY
               AND created_date < TIMESTAMP '{end}'"""


def _history(days: int, cap: int) -> str:
    return f"""
        SELECT customer_id, item_id FROM (
            SELECT customer_id, item_id,
                   row_number() OVER (PARTITION BY customer_id ORDER BY item_id) AS r
            FROM (SELECT DISTINCT customer_id, item_id FROM tx WHERE {_lookback(days)}))
        WHERE r <= {cap}"""


def _popular(days: int, cap: int) -> str:
    return f"""
        SELECT customer_id, item_id FROM users, (
            SELECT item_id FROM tx WHERE {_lookback(days)}
            GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT {cap})"""


def _category(days: int, cap: int) -> str:
    bought = f"(SELECT * FROM tx JOIN items USING (item_id) WHERE {_lookback(days)})"
    return f"""
        SELECT customer_id, item_id FROM (
            SELECT customer_id, category,
                   row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, category) AS r
            FROM {bought} GROUP BY customer_id, category) u
        JOIN (
            SELECT category, item_id,
                   row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, item_id) AS r
            FROM {bought} GROUP BY category, item_id) i USING (category)
        WHERE u.r <= 3 AND i.r <= {cap // 3}"""


def _hybrid(days: int, cap: int) -> str:
    third = cap // 3
    return f"""{_history(days, third)} UNION {_popular(days, third)} UNION {_category(days, third)}"""


def _case(name: str, condition: str, order: str) -> str:
    return f"""
        SELECT * FROM (SELECT '{name}' AS "case", * FROM cases WHERE n_actual >= 2 AND {condition}
                       ORDER BY {order}, customer_id LIMIT 1)"""


def _against(fc: int, reference: dict[tuple[str, int], float]) -> str:
    base = " ".join(
        f"WHEN metric = '{m}' AND k = {k} THEN CAST({v!r} AS DOUBLE)"
        for (m, k), v in reference.items()
    )
    change = "(value - reference) / reference * 100"
    return f"""
        SELECT feature_count, metric, k, round(value, 4) AS value, round(reference, 4) AS reference,
               round({change}, 4) AS change_pct,
               CASE WHEN {change} < -5 THEN 'important' WHEN {change} > 5 THEN 'not important'
                    ELSE 'minor' END AS impact
        FROM (SELECT *, CASE {base} END AS reference FROM set_eval WHERE feature_count = {fc})
        WHERE reference IS NOT NULL"""


def _metric(name: str) -> str:
    return f"""SELECT metric, k, round(value, 6) AS value FROM rec_eval
               WHERE k = 10 AND metric = '{name}'"""


def _distribution(column: str) -> str:
    return f"SELECT {column}, count(*) AS n_items FROM items GROUP BY {column}"


_FILE = """CASE feature_count WHEN 3 THEN 'metrics_3features' WHEN 5 THEN 'metrics_5features'
           WHEN 9 THEN 'metrics_9features' WHEN 10 THEN 'metrics_without_history'
           ELSE 'metrics_tuned' END"""
_TOP_CUSTOMERS = f"""
        SELECT customer_id, avg(score) AS avg_score FROM pred
        GROUP BY customer_id ORDER BY avg_score DESC, customer_id LIMIT {SUBMISSION_CUSTOMERS}"""
_LIST = "string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank)"
_PAIR_KEY = _key(f"(({_key('customer_id')}) * 31 + item_id % 4294967296)")

_GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
_SPARK_TYPES = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
    WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'DOUBLE[]' THEN 'array<double>'
    WHEN 'SMALLINT' THEN 'smallint' WHEN 'TINYINT' THEN 'tinyint' ELSE lower(data_type) END"""


def _explored(table: str) -> str:
    """Every column of a given table with its type, rows and nulls."""
    nulls = f"""UNPIVOT (SELECT count(*) - count(COLUMNS('(.*)')) AS "\\1" FROM {table}) ON COLUMNS(*) INTO NAME column_name VALUE null_count"""
    return f"""
        SELECT '{table}' AS table_name, (SELECT count(*) FROM ({nulls}))::BIGINT AS n_columns, n_rows, column_name,
               (SELECT any_value({_SPARK_TYPES}) FROM duckdb_columns() c
                WHERE c.table_name = '{table}' AND c.column_name = u.column_name) AS dtype,
               null_count::BIGINT AS null_count, CASE WHEN n_rows > 0 THEN null_count * 100.0::DOUBLE / n_rows ELSE 0 END AS null_pct
        FROM ({nulls}) u, (SELECT count(*)::BIGINT AS n_rows FROM {table})"""


BODIES: dict[str, str] = {
    "explore_dataset": " UNION ALL ".join(map(_explored, _GIVEN)),
    "explore_files": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'ok' AS status, count(*)::BIGINT AS n_rows FROM {t}" for t in _GIVEN
    ),
    "scan_window": "SELECT * FROM recent",
    "scan_transactions": "SELECT * FROM tx",
    "scan_items": "SELECT * FROM items",
    "scan_users": "SELECT * FROM users",
    "declared_schemas": """
        SELECT customer_id, item_id, created_date, CAST(NULL AS BIGINT) AS order_id FROM purchases""",
    "load_table": "SELECT * FROM part",
    "profile_table": " UNION ALL ".join(
        [
            _profile("transactions", "tx", _TX_COLUMNS),
            _profile("items", "items", _ITEM_COLUMNS),
            _profile("users", "users", _USER_COLUMNS),
        ]
    ),
    "features_cache": """
        SELECT count(*) AS n_samples, CAST(13 AS BIGINT) AS n_features,
               CAST(sum("Y") AS BIGINT) AS n_positive, avg("Y") * 100 AS positive_pct FROM feat""",
    "predictions_io": "SELECT * FROM pred",
    "metrics_io": "SELECT feature_count, metric, k, round(value, 6) AS value FROM set_eval",
    "latest_artifact": """
        SELECT 'metrics_without_history' AS file_name, metric, k, round(value, 6) AS value
        FROM set_eval WHERE feature_count = 10""",
    "metric_curves": f"""
        SELECT {_FILE} AS file_name, metric, k, round(value, 6) AS value
        FROM set_eval WHERE metric IN ('precision', 'ndcg')""",
    "ground_truth_pairs": """
        SELECT DISTINCT CAST(customer_id AS VARCHAR) AS customer_id,
               CAST(item_id AS VARCHAR) AS item_id
        FROM recent WHERE order_id % 3 <> 2""",
    "ground_truth_from_label": 'SELECT customer_id, item_id FROM feat WHERE "Y" = 1',
    "time_window": "SELECT * FROM hist",
    "lookback_window": f"SELECT * FROM tx WHERE {_lookback(90)}",
    "hash_sample": f"SELECT * FROM tx WHERE ({_key('customer_id')}) % 10 = 0",
    "sample_customers": f"""
        SELECT tx.* FROM tx JOIN (
            SELECT customer_id, row_number() OVER (ORDER BY {_key("customer_id")}) AS r,
                   count(*) OVER () AS n
            FROM (SELECT DISTINCT customer_id FROM tx)) USING (customer_id)
        WHERE r <= floor(n * CAST(0.4 AS DOUBLE))""",
    "sample_rows_cap": f"""
        SELECT customer_id, item_id, "Y" FROM feat
        WHERE (SELECT count(*) FROM feat) <= 10000 OR ({_PAIR_KEY}) % 1000 < 200""",
    "restrict_customers": "SELECT * FROM hist WHERE customer_id IN (SELECT customer_id FROM recent)",
    "clean_transactions": """
        SELECT DISTINCT * FROM tx WHERE customer_id IS NOT NULL AND item_id IS NOT NULL
                                    AND created_date IS NOT NULL""",
    "clean_items": """
        SELECT item_id, brand, age_group, category FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY brand, age_group, category) AS r
            FROM (SELECT item_id, coalesce(brand, 'Unknown') AS brand,
                         coalesce(age_group, 'Unknown') AS age_group,
                         coalesce(category, 'Unknown') AS category
                  FROM untidy WHERE item_id IS NOT NULL))
        WHERE r = 1""",
    "clean_users": """
        SELECT customer_id, date_of_birth FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id
                                         ORDER BY date_of_birth NULLS FIRST) AS r
            FROM (SELECT nullif(customer_id % 1000, 0) AS customer_id, date_of_birth FROM users)
            WHERE customer_id IS NOT NULL)
        WHERE r = 1""",
    "item_cooccurrence": "SELECT * FROM cooc",
    "item_cooccurrence_by_customer": """
        SELECT a.item_id AS "itemA", b.item_id AS "itemB", count(*) AS cooc_count
        FROM (SELECT DISTINCT customer_id, item_id FROM hist) a
             JOIN (SELECT DISTINCT customer_id, item_id FROM hist) b
               ON a.customer_id = b.customer_id AND a.item_id < b.item_id
        GROUP BY ALL""",
    "candidates_from_cooc": """
        SELECT customer_id, item_id FROM (
            SELECT customer_id, e.candidate AS item_id,
                   row_number() OVER (PARTITION BY customer_id
                                      ORDER BY sum(e.n) DESC, e.candidate) AS r
            FROM (SELECT DISTINCT customer_id, item_id FROM hist) h
                 JOIN (SELECT "itemA" AS item_id, "itemB" AS candidate, cooc_count AS n FROM cooc
                       UNION ALL SELECT "itemB", "itemA", cooc_count FROM cooc) e USING (item_id)
            GROUP BY customer_id, e.candidate)
        WHERE r <= 200""",
    "cand_user_history": _history(90, 100),
    "cand_popular": _popular(90, 100),
    "cand_category": _category(90, 100),
    "cand_hybrid": _hybrid(90, 100),
    "generate_candidates": _hybrid(300, 100),
    "filter_already_purchased": f"""
        SELECT customer_id, item_id FROM ({_history(90, 100)}) c
        WHERE NOT EXISTS (SELECT 1 FROM tx WHERE tx.customer_id = c.customer_id
                          AND tx.item_id = c.item_id AND {_lookback(30)})""",
    "training_candidates": "SELECT * FROM cands",
    "feat_age_months": """
        SELECT customer_id, date_of_birth,
               CAST(floor(date_diff('day', date_of_birth, DATE '2001-06-01') / CAST(30.4375 AS DOUBLE))
                    AS INTEGER) AS age_in_month
        FROM users""",
    "item_segment": f"""
        SELECT item_id, category,
               CASE WHEN category LIKE '%{SEGMENT_PATTERN}%' AND age_group = 'Step 1'
                    THEN 'milk_step1' ELSE 'other' END AS segment
        FROM items""",
    "customer_segment": f"""
        SELECT customer_id, segment FROM (
            SELECT customer_id, segment, row_number() OVER (
                       PARTITION BY customer_id ORDER BY count(*) DESC, max(created_date) DESC, segment) AS r
            FROM (SELECT customer_id, created_date,
                         CASE WHEN category LIKE '%{SEGMENT_PATTERN}%' AND age_group = 'Step 1'
                              THEN 'milk_step1' ELSE 'other' END AS segment FROM hi)
            GROUP BY customer_id, segment)
        WHERE r = 1""",
    "candidate_features": f'SELECT customer_id, item_id, "{X[1]}", "{X[2]}", "{X[3]}" FROM feat',
    "x1_brand_cnt": f'SELECT customer_id, item_id, "{X[1]}" FROM feat',
    "x2_age_group_cnt": f'SELECT customer_id, item_id, "{X[2]}" FROM feat',
    "x3_category_cnt": f'SELECT customer_id, item_id, "{X[3]}" FROM feat',
    "x4_recency": f'SELECT customer_id, "{X[4]}" FROM act',
    "x4_recency_intraday": f"""
        SELECT customer_id, CAST(date_sub('day', max(created_date), TIMESTAMP '2024-02-15')
                                 AS INTEGER) AS "{X[4]}"
        FROM purchases GROUP BY customer_id""",
    "x5_frequency": f'SELECT customer_id, "{X[5]}" FROM act',
    "x6_power_user": f'SELECT customer_id, "{X[6]}" FROM act',
    "x7_items_per_order": f'SELECT customer_id, "{X[5]}" AS "{X[7]}" FROM act',
    "x8_top_brand_ratio": f'SELECT customer_id, "{X[8]}" FROM loyal',
    "x9_brand_diversity": f'SELECT customer_id, "{X[9]}" FROM loyal',
    "x10_category_diversity": f'SELECT customer_id, "{X[10]}" FROM diverse',
    "x11_day_mode": f'SELECT customer_id, "{X[11]}" FROM daymode',
    "x12_new_customer": f'SELECT customer_id, "{X[12]}" FROM act',
    "x13_avg_item_popularity": f'SELECT customer_id, "{X[13]}" FROM avgpop',
    "label_y": 'SELECT customer_id, item_id, "Y" FROM feat',
    "feature_table": "SELECT * FROM feat",
    "feature_table_given_pairs": "SELECT * FROM feat_given",
    "feature_subset": f"""SELECT customer_id, item_id, {", ".join(f'"{X[i]}"' for i in range(1, 6))},
                          "Y" FROM feat""",
    "class_balance": """
        SELECT count(*) AS n_samples, CAST(13 AS BIGINT) AS n_features,
               CAST(sum("Y") AS BIGINT) AS n_positive, avg("Y") * 100 AS positive_pct FROM feat""",
    "rank_topk": "SELECT * FROM ranked WHERE rank <= 10",
    "rank_all": "SELECT * FROM ranked",
    "importance_pct": f"""
        SELECT feature, importance, round(importance / sum(importance) OVER () * 100, 6) AS pct
        FROM (SELECT unnest([{", ".join(f"'{c}'" for c in X.values())}]) AS feature,
                     unnest([{", ".join(f'round(coalesce(abs(corr("{c}", "Y")), 0), 6)' for c in X.values())}])
                       AS importance FROM feat)
        ORDER BY importance DESC, feature LIMIT 10""",
    "precision_at_k": _metric("precision"),
    "recall_at_k": _metric("recall"),
    "ndcg_at_k": _metric("ndcg"),
    "map_at_k": _metric("map"),
    "evaluate_recommendations": "SELECT metric, k, round(value, 6) AS value FROM rec_eval",
    "ranking_precision": """
        SELECT metric, k, round(value, 6) AS value FROM rank_eval WHERE metric = 'precision'""",
    "ranking_ndcg": """
        SELECT metric, k, round(value, 6) AS value FROM rank_eval WHERE metric = 'ndcg'""",
    "groundtruth_eval": """
        SELECT unnest(['precision', 'recall', 'ndcg', 'f1']) AS metric, CAST(k AS INTEGER) AS k,
               round(unnest([p, r, g, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END]), 6)
                 AS value
        FROM (SELECT k, avg(hits / listed) AS p, avg(hits / n) AS r, avg(gain / best) AS g
              FROM (SELECT u.customer_id, u.k, t.n, i.best, listed, count(h.rank) AS hits,
                           coalesce(sum(1.0 / log2(h.rank + 1)), 0) AS gain
                    FROM (SELECT customer_id, k, count(*) AS listed FROM pred, ks
                          WHERE rank <= least(k, 10) GROUP BY ALL) u
                         JOIN n_true t USING (customer_id)
                         JOIN ideal i ON i.k = u.k AND i.n = least(t.n, 20)
                         LEFT JOIN hits h
                           ON h.customer_id = u.customer_id AND h.rank <= least(u.k, 10)
                    GROUP BY ALL)
              GROUP BY k)""",
    "mark_hits": """
        SELECT pred.*, truth.item_id IS NOT NULL AS is_hit
        FROM pred LEFT JOIN truth USING (customer_id, item_id) WHERE rank <= 10""",
    "case_best_worst": f"""
        {_case("best", '"precision" > 0', "hits DESC")}
        UNION ALL {_case("worst", '"precision" < 1', "hits")}""",
    "case_random": f"SELECT * FROM cases ORDER BY {_key('customer_id')}, customer_id LIMIT 1",
    "case_status": "SELECT * FROM cases",
    "overview_counts": """
        SELECT (SELECT count(*) FROM pred) AS total_predictions,
               (SELECT count(DISTINCT customer_id) FROM truth) AS total_customers,
               CAST(13 AS BIGINT) AS num_features""",
    "compare_feature_sets": """
        SELECT feature_count, round(p5, 6) AS p5, round(p10, 6) AS p10, round(p20, 6) AS p20,
               round(r10, 6) AS r10, round(r20, 6) AS r20, round(ndcg10, 6) AS ndcg10,
               round(map10, 6) AS map10 FROM set_table""",
    "improvement_vs_baseline": """
        SELECT t.feature_count, t.feature_count - b.feature_count AS added_features,
               round(t.p10, 4) AS p10, round(t.r10, 4) AS r10, round(t.ndcg10, 4) AS ndcg10,
               round(CASE WHEN b.p10 > 0 THEN (t.p10 - b.p10) / b.p10 * 100 ELSE 0 END, 4)
                 AS p10_change_pct,
               round(CASE WHEN b.r10 > 0 THEN (t.r10 - b.r10) / b.r10 * 100 ELSE 0 END, 4)
                 AS r10_change_pct,
               round(CASE WHEN b.ndcg10 > 0 THEN (t.ndcg10 - b.ndcg10) / b.ndcg10 * 100 ELSE 0 END, 4)
                 AS ndcg10_change_pct
        FROM set_table t, set_table b
        WHERE b.feature_count = 3 AND t.feature_count > 3""",
    "improvement_vs_constants": _against(13, reports.DEFAULT_BOOSTING),
    "impact_class": _against(10, reports.WITH_HISTORY),
    "comparison_summary": f"""
        SELECT '2001-07-01 00:00:00' AS comparison_date,
               (SELECT count(*) FROM set_table) AS models_compared, feature_count,
               CASE feature_count
                   {" ".join(f"WHEN {n} THEN '{t}'" for n, t in config.FEATURE_SET_NAMES.items())}
                   END AS feature_set,
               {", ".join(f"round({c}, 6) AS {c}" for c in ("p5", "p10", "p20", "r10", "r20", "ndcg10", "map10"))}
        FROM set_table""",
    "top_customers_by_score": f"""
        SELECT customer_id, round(avg_score, 6) AS avg_score FROM ({_TOP_CUSTOMERS})""",
    "submission_lists": f"""
        SELECT CAST(customer_id AS VARCHAR) AS customer_id, {_LIST} AS items
        FROM pred
        WHERE rank <= 10 GROUP BY customer_id""",
    "submission_json": f"""
        SELECT '{{"' || CAST(customer_id AS VARCHAR) || '":[' || {_LIST} || ']}}' AS value
        FROM pred
        WHERE rank <= 10 GROUP BY customer_id""",
    "submission_size": f"""
        SELECT count(*) AS n_customers, sum(length(line) + 1) / CAST(1048576 AS DOUBLE) AS size_mb,
               CASE WHEN sum(length(line) + 1) / 1048576.0 > 90 THEN 'too large'
                    WHEN sum(length(line) + 1) / 1048576.0 < 8 THEN 'might be too small'
                    ELSE 'ok' END AS verdict
        FROM (SELECT '{{"' || CAST(customer_id AS VARCHAR) || '":[' || {_LIST} || ']}}' AS line
              FROM pred WHERE rank <= 10 GROUP BY customer_id)""",
    "prediction_coverage": """
        SELECT count(*) AS n_predictions, count(DISTINCT customer_id) AS n_customers,
               count(*) FILTER (customer_id IN (SELECT customer_id FROM truth)) AS n_predictions_valid,
               count(DISTINCT customer_id) FILTER (customer_id IN (SELECT customer_id FROM truth))
                 AS n_customers_valid
        FROM pred""",
    "null_rates": " UNION ALL ".join(
        [
            _nulls("transactions", "tx", [c for c, _ in _TX_COLUMNS]),
            _nulls("items", "untidy", [c for c, _ in _ITEM_COLUMNS]),
            _nulls("users", "users", [c for c, _ in _USER_COLUMNS]),
        ]
    ),
    "customer_stats": "SELECT * FROM cstats",
    "top_customers": "SELECT * FROM cstats ORDER BY num_purchases DESC, customer_id LIMIT 20",
    "item_stats": "SELECT * FROM istats",
    "top_items": "SELECT * FROM istats ORDER BY num_purchases DESC, item_id LIMIT 20",
    "brand_distribution": _distribution("brand"),
    "age_group_distribution": _distribution("age_group"),
    "category_distribution": _distribution("category"),
    "time_range": """
        SELECT min(created_date) AS first_transaction, max(created_date) AS last_transaction FROM tx""",
    "daily_volume": """
        SELECT CAST(created_date AS DATE) AS date, count(*) AS num_transactions FROM tx GROUP BY 1""",
    "sparsity": """
        SELECT n_customers, n_items, n_interactions, CAST(n_customers AS DOUBLE) * n_items AS n_possible,
               round(1 - n_interactions / (CAST(n_customers AS DOUBLE) * n_items), 8) AS sparsity,
               round(n_interactions / (CAST(n_customers AS DOUBLE) * n_items), 8) AS density
        FROM (SELECT count(DISTINCT customer_id) AS n_customers, count(DISTINCT item_id) AS n_items,
                     count(*) AS n_interactions FROM tx)""",
    "category_volume": """
        SELECT category, count(*) AS num_purchases FROM tx LEFT JOIN items USING (item_id)
        GROUP BY category""",
    "brand_age_matrix": f"""
        SELECT brand, {", ".join(f'''count(*) FILTER (age_group = '{a}') AS "{a}"''' for a in AGE_GROUPS)}
        FROM items SEMI JOIN (SELECT brand FROM items GROUP BY brand
                              ORDER BY count(*) DESC, brand LIMIT 10) USING (brand)
        GROUP BY brand""",
    "cohort_retention": "SELECT * FROM retention",
    "cohort_sample": """
        SELECT * FROM retention WHERE cohort_month IN (
            SELECT DISTINCT cohort_month FROM retention ORDER BY cohort_month LIMIT 6)""",
    "metric_correlation": " UNION ALL ".join(
        f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, round(corr({a}, {b}), 6) AS corr FROM cstats"
        for i, a in enumerate(("num_purchases", "num_unique_items", "days_active"))
        for b in ("num_purchases", "num_unique_items", "days_active")[i:]
    ),
    "describe_stats": " UNION ALL ".join(
        [
            *[
                _describe(c, c, "cstats")
                for c in ("num_purchases", "num_unique_items", "days_active")
            ],
            _describe("num_customers", "num_customers", "istats"),
            _describe("score", "score", "pred"),
        ]
    ),
    "box_stats": """
        SELECT metric, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q1,
               round(quantile_cont(value, 0.5), 6) AS median,
               round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS max
        FROM cmetrics GROUP BY metric""",
    "iqr_outliers": _iqr(
        """SELECT metric, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
           FROM cmetrics GROUP BY metric"""
    ),
    "iqr_outliers_nearest": _iqr(
        """SELECT metric, max(value) FILTER (r = round((n - 1) * CAST(0.25 AS DOUBLE))) AS q1,
                  max(value) FILTER (r = round((n - 1) * CAST(0.75 AS DOUBLE))) AS q3
           FROM (SELECT metric, value, row_number() OVER (PARTITION BY metric ORDER BY value) - 1 AS r,
                        count(*) OVER (PARTITION BY metric) AS n FROM cmetrics)
           GROUP BY metric"""
    ),
    "histogram_bins": """
        SELECT metric, CAST(bin AS INTEGER) AS bin,
               round(a + bin * ((b - a) / CAST(50 AS DOUBLE)), 6) AS bin_start,
               count(value) AS n
        FROM (SELECT metric, min(value) AS a, max(value) AS b FROM cmetrics GROUP BY metric) e
             CROSS JOIN (SELECT unnest(range(0, 50)) AS bin)
             LEFT JOIN (SELECT metric AS m, value, least(floor((value - a) / ((b - a) / CAST(50 AS DOUBLE))), 49)
                          AS vb
                        FROM cmetrics JOIN (SELECT metric, min(value) AS a, max(value) AS b
                                            FROM cmetrics GROUP BY metric) USING (metric)) v
               ON v.m = e.metric AND v.vb = bin
        GROUP BY metric, bin, a, b""",
    "duplicate_rows": " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM {t})
            - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS n_duplicates"""
        for name, t in (("transactions", "tx"), ("items", "items"), ("users", "users"))
    ),
    "orphan_ids": """
        SELECT (SELECT count(DISTINCT customer_id) FROM tx WHERE customer_id NOT IN
                  (SELECT customer_id FROM users)) AS orphan_customers,
               (SELECT count(DISTINCT item_id) FROM tx WHERE item_id NOT IN
                  (SELECT item_id FROM items)) AS orphan_items""",
    "future_birth_dates": """
        SELECT count(*) AS n_future FROM users WHERE date_of_birth > DATE '2001-01-01'""",
    "prediction_overview": """
        SELECT count(*) AS n_predictions, count(DISTINCT customer_id) AS n_customers,
               count(DISTINCT item_id) AS n_items, round(avg(score), 6) AS mean_score,
               round(stddev_samp(score), 6) AS std_score, round(min(score), 6) AS min_score,
               round(max(score), 6) AS max_score FROM pred""",
    "top_recommended": """
        SELECT item_id, count(*) AS num_recommendations, round(avg(score), 6) AS avg_score,
               round(avg(rank), 6) AS avg_rank
        FROM pred GROUP BY item_id ORDER BY num_recommendations DESC, item_id LIMIT 20""",
    "rank_distribution": "SELECT rank, count(*) AS n FROM pred GROUP BY rank",
    "recs_per_customer": "SELECT customer_id, count(*) AS n FROM pred GROUP BY customer_id",
    "item_rec_frequency": "SELECT item_id, count(*) AS n FROM pred GROUP BY item_id",
    "sample_customer_recs": f"""
        SELECT customer_id, item_id, round(score, 9) AS score, rank FROM pred
        WHERE rank <= 10 AND customer_id IN (
            SELECT customer_id FROM (SELECT DISTINCT customer_id FROM pred)
            ORDER BY {_key("customer_id")}, customer_id LIMIT 3)""",
}

BODIES |= {
    "purchase_count_distribution": """
        SELECT n_purchases, count(*) AS n_customers,
               round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 6) AS pct
        FROM (SELECT CASE WHEN count(*) > 15 THEN '>15' ELSE CAST(count(*) AS VARCHAR) END
                       AS n_purchases
              FROM tx GROUP BY customer_id)
        GROUP BY n_purchases""",
    "precision_tiers": """
        SELECT tier, count(*) AS n_customers,
               round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 6) AS pct
        FROM (SELECT CASE WHEN hits > 5 THEN 'above 0.5' WHEN hits >= 1 THEN '0.1 to 0.5'
                          ELSE 'below 0.1' END AS tier FROM cases)
        GROUP BY tier""",
    "precision_by_loyalty": f"""
        SELECT CASE WHEN "{X[8]}" > CAST(0.7 AS DOUBLE) THEN 'high'
                    WHEN "{X[8]}" < CAST(0.3 AS DOUBLE) THEN 'low' ELSE 'medium' END AS loyalty,
               count(*) AS n_customers, round(avg("precision"), 6) AS "precision"
        FROM cases JOIN loyal USING (customer_id) GROUP BY loyalty""",
    "coverage_tradeoff": " UNION ALL ".join(
        f"""SELECT CAST({n} AS BIGINT) AS cut_off, count(*) AS n_customers,
                   count("precision") AS n_with_purchases, round(avg("precision"), 6) AS "precision"
            FROM (SELECT customer_id FROM pred GROUP BY customer_id
                  ORDER BY avg(score) DESC, customer_id LIMIT {n}) LEFT JOIN cases USING (customer_id)"""
        for n in COVERAGE_CUT_OFFS
    ),
    "truth_coverage": """
        SELECT count(*) AS n_truth, count(p.customer_id) AS n_predicted,
               round(count(p.customer_id) / CAST(count(*) AS DOUBLE) * 100, 6) AS coverage_pct
        FROM (SELECT DISTINCT customer_id FROM truth) t
             LEFT JOIN (SELECT DISTINCT customer_id FROM pred) p USING (customer_id)""",
}

ORACLE = {name: _with(body) for name, body in BODIES.items()}
