"""The same answers in SQL, for DuckDB over the same parquet tables. Written from the
meaning of each query, not from its Spark plan."""

from __future__ import annotations

AS_OF = "DATE '2001-07-15'"
AS_OF_EARLIER = "DATE '2001-04-15'"

# The star over the given tables.
CUSTOMERS = """
customers AS (
    SELECT c_custkey AS customer_id, c_custkey AS account_id, c_name AS customer_name,
        c_mktsegment AS segment, n_name AS industry, r_name AS country, created_date
    FROM customer
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN (
        SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS created_date
        FROM orders GROUP BY o_custkey
    ) ON o_custkey = c_custkey
)"""
TRAFFIC = """
traffic AS (
    SELECT o_orderkey AS traffic_id, CAST(o_orderdate AS DATE) AS send_date,
        o_custkey AS account_id, o_custkey AS customer_id,
        CAST(SUBSTR(o_orderpriority, 1, 1) AS INT) AS channel_id,
        CAST(COALESCE(lines, 0) AS INT) AS interactions_count,
        CAST(o_totalprice AS DECIMAL(12,2)) AS revenue_eur
    FROM orders
    LEFT JOIN (SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY l_orderkey)
        ON l_orderkey = o_orderkey
)"""
RAW = f"""{CUSTOMERS}, {TRAFFIC},
raw_customers AS (
    SELECT customer_id AS seq, customer_id // 2 AS account_id, customer_name, segment,
        industry, country, created_date
    FROM customers
),
raw_traffic AS (
    SELECT traffic_id AS seq, send_date,
        CASE WHEN customer_id % 8 = 0 THEN -customer_id ELSE customer_id // 2 END AS account_id,
        channel_id,
        interactions_count, revenue_eur
    FROM traffic
),
raw_channels AS (
    SELECT DISTINCT channel_id FROM traffic WHERE channel_id <= 4
),
loaded_customers AS (
    SELECT first_id AS customer_id, account_id, customer_name, segment, industry, country,
        created_date
    FROM (
        SELECT *, MIN(seq) OVER (PARTITION BY account_id) AS first_id,
            ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY seq DESC) AS nth
        FROM raw_customers
    ) WHERE nth = 1
),
resolved AS (
    SELECT t.*, c.customer_id
    FROM raw_traffic t
    JOIN loaded_customers c USING (account_id)
    JOIN raw_channels ch USING (channel_id)
),
loaded_traffic AS (
    SELECT MIN(seq) AS traffic_id, send_date, account_id, customer_id, channel_id,
        ARG_MAX(interactions_count, seq) AS interactions_count,
        ARG_MAX(revenue_eur, seq) AS revenue_eur
    FROM resolved GROUP BY send_date, account_id, customer_id, channel_id
),
rejected AS (
    SELECT t.*, CASE WHEN c.customer_id IS NULL THEN 'unknown account'
        ELSE 'unknown channel' END AS reason
    FROM raw_traffic t
    LEFT JOIN loaded_customers c USING (account_id)
    LEFT JOIN raw_channels ch ON ch.channel_id = t.channel_id
    WHERE c.customer_id IS NULL OR ch.channel_id IS NULL
)"""

TRAFFIC_ROW = """CAST(traffic_id AS BIGINT) AS traffic_id, CAST(send_date AS VARCHAR) AS send_date,
    account_id, customer_id, CAST(channel_id AS BIGINT) AS channel_id,
    CAST(interactions_count AS BIGINT) AS interactions_count,
    CAST(revenue_eur AS DOUBLE) AS revenue_eur"""

EXPOSURE = """
members AS (SELECT industry, COUNT(*) AS customer_count FROM customers GROUP BY industry),
earned AS (
    SELECT industry, SUM(revenue_eur) AS total_revenue
    FROM traffic NATURAL JOIN (SELECT customer_id, industry FROM customers)
    GROUP BY industry
),
exposure AS (
    SELECT industry, COALESCE(total_revenue, 0) AS total_revenue, customer_count
    FROM members LEFT JOIN earned USING (industry)
)"""


def daily(table: str, company: str, at: str, key: str, value: str) -> str:
    return f"""
    SELECT CAST(CAST({at} AS DATE) AS VARCHAR) AS date,
        FIRST({value} ORDER BY {at}, {key}) AS open, MAX({value}) AS high,
        MIN({value}) AS low, LAST({value} ORDER BY {at}, {key}) AS close,
        CAST(COUNT(*) AS DOUBLE) AS volume, {company} AS company
    FROM {table} GROUP BY CAST({at} AS DATE), {company}"""


EVENT_DAYS = daily("events", "event_type", "ts", "event_id", "value")
ORDER_DAYS = daily("orders", "o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice")
BOTH_DAYS = f"{EVENT_DAYS} UNION ALL {ORDER_DAYS}"


def periods(rows: str, as_of: str, clock: str = "INTERVAL 0 HOUR") -> str:
    """Metrics per customer; period starts are shifted by the time of day."""
    month = f"DATE_TRUNC('month', {as_of})"
    quarter = f"DATE_TRUNC('quarter', {as_of})"
    return f"""
    SELECT customer_id, last_month AS revenue_last_month, last_quarter AS revenue_last_quarter,
        mtd AS revenue_mtd, ytd AS revenue_ytd,
        CASE WHEN last_quarter > 0 THEN ROUND(
            CAST(this_quarter - last_quarter AS DOUBLE) / CAST(last_quarter AS DOUBLE) * 100, 2)
            ELSE 0.0 END AS revenue_increase_pct_qoq
    FROM (
        SELECT customer_id,
            COALESCE(SUM(revenue_eur) FILTER (d >= {month} - INTERVAL 1 MONTH + {clock}
                AND d < {month} + {clock}), 0) AS last_month,
            COALESCE(SUM(revenue_eur) FILTER (d >= {quarter} - INTERVAL 3 MONTH + {clock}
                AND d < {quarter} + {clock}), 0) AS last_quarter,
            COALESCE(SUM(revenue_eur) FILTER (d >= {quarter} + {clock}), 0) AS this_quarter,
            COALESCE(SUM(revenue_eur) FILTER (d >= {month} + {clock}), 0) AS mtd,
            COALESCE(SUM(revenue_eur) FILTER (
                d >= DATE_TRUNC('year', {as_of}) + {clock}), 0) AS ytd
        FROM (SELECT *, CAST(send_date AS TIMESTAMP) AS d FROM {rows})
        GROUP BY customer_id
    )"""


PERIOD_ROW = """customer_id, CAST(revenue_last_month AS DOUBLE) AS revenue_last_month,
    CAST(revenue_last_quarter AS DOUBLE) AS revenue_last_quarter,
    CAST(revenue_mtd AS DOUBLE) AS revenue_mtd, CAST(revenue_ytd AS DOUBLE) AS revenue_ytd,
    CAST(revenue_increase_pct_qoq AS DOUBLE) AS revenue_increase_pct_qoq"""


def flag_columns() -> str:
    month, quarter = f"DATE_TRUNC('month', {AS_OF})", f"DATE_TRUNC('quarter', {AS_OF})"
    before = f"send_date >= {quarter} - INTERVAL 3 MONTH AND send_date < {quarter}"
    return f"""
        send_date >= {month} - INTERVAL 1 MONTH AND send_date < {month} AS is_last_month,
        {before} AS is_last_quarter, send_date >= {month} AS is_mtd,
        send_date >= DATE_TRUNC('year', {AS_OF}) AS is_ytd,
        send_date >= {quarter} AS is_current_quarter, {before} AS is_prev_quarter"""


def active_top(entity: str, population: str, facts: str, active: str) -> str:
    return f"""
    SELECT {entity}, CAST(total AS DOUBLE) AS total_revenue
    FROM (
        SELECT {entity}, SUM(revenue_eur) AS total,
            ROW_NUMBER() OVER (ORDER BY SUM(revenue_eur) DESC, {entity}) AS nth
        FROM {facts} GROUP BY {entity}
    )
    WHERE nth <= (SELECT (COUNT(DISTINCT {entity}) + 9) // 10 FROM {population})
        AND {entity} IN ({active})"""


def statistics(table: str, name: str, columns: list[str]) -> str:
    def rounded(expression: str, alias: str) -> str:
        return f"CAST(CAST({expression} AS DECIMAL(20,4)) AS DOUBLE) AS {alias}"

    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{c}' AS column_name,
            {rounded(f"MIN({c})", "min_value")}, {rounded(f"MAX({c})", "max_value")},
            {rounded(f"AVG({c})", "mean_value")},
            {rounded(f"QUANTILE_DISC({c}, 0.5)", "median_value")},
            {rounded(f"STDDEV_SAMP({c})", "std_deviation")},
            COUNT({c}) AS count_non_null, COUNT(*) AS count_total
        FROM {table}"""
        for c in columns
    )


def rules(checks: list[tuple[str, str, str]]) -> str:
    """(rule, table, condition of a broken row)"""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, COUNT(*) FILTER ({broken}) AS violations FROM {table}"
        for rule, table, broken in checks
    )


LINEITEM_NUMBERS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]
LINEITEM_TYPES = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]


def draw(key: str, nth: int) -> str:
    """The nth 32-bit draw of a key under seed 42."""
    return f"CAST(('0x' || SUBSTR(MD5('42|' || ({key})), {1 + 8 * nth}, 8)) AS BIGINT)"


def pick(values: list[str], index: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[{index}]"


# What synthetic customers can be, and the message channels.
SYNTH_SEGMENTS = ["Enterprise", "SMB", "Startup", "Mid-Market"]
SYNTH_INDUSTRIES = [
    "Technology",
    "Finance",
    "Healthcare",
    "Retail",
    "Manufacturing",
    "Education",
    "Government",
    "Media",
    "Telecommunications",
    "Energy",
]
SYNTH_COUNTRIES = [
    "United States",
    "United Kingdom",
    "Germany",
    "France",
    "Italy",
    "Spain",
    "Netherlands",
    "Sweden",
    "Norway",
    "Denmark",
]
CHANNEL_VALUES = """(VALUES (1, 'SMS', 'SMS', 0.05), (2, 'Email', 'Email', 0.01),
    (3, 'Push Notification', 'Push', 0.02), (4, 'Voice Call', 'Voice', 0.15),
    (5, 'WhatsApp', 'WhatsApp', 0.08), (6, 'Viber', 'Viber', 0.06),
    (7, 'Telegram', 'Telegram', 0.04), (8, 'Facebook Messenger', 'Messenger', 0.07))
    AS channels (channel_id, channel_name, channel_type, unit_price_eur)"""

ORACLES: dict[str, str] = {
    "csv_scan": f"WITH {TRAFFIC} SELECT {TRAFFIC_ROW} FROM traffic",
    "json_roundtrip": f"WITH {TRAFFIC} SELECT {TRAFFIC_ROW} FROM traffic",
    "ensure_table": f"WITH {TRAFFIC} SELECT {TRAFFIC_ROW} FROM traffic",
    "typed_cast": """
        SELECT o_orderkey AS traffic_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS send_date,
            CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS revenue_eur,
            TRY_CAST(o_orderpriority AS INT) IS NULL AS bad_channel
        FROM orders""",
    "table_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "daily_series_flatten": EVENT_DAYS,
    "daily_series_from": f"SELECT * FROM ({EVENT_DAYS}) WHERE date >= '2024-01-15'",
    "series_head": f"SELECT * FROM ({EVENT_DAYS}) ORDER BY company, date LIMIT 5",
    "series_union": BOTH_DAYS,
    "price_panel": f"SELECT * FROM ({BOTH_DAYS}) WHERE date >= '1998-01-01'",
    "partitioned_sink": ORDER_DAYS,
    "value_counts": f"SELECT company, COUNT(*) AS row_count FROM ({BOTH_DAYS}) GROUP BY company",
    "series_extent": f"""
        SELECT company, MIN(date) AS first_date, MAX(date) AS last_date, COUNT(*) AS row_count
        FROM ({ORDER_DAYS}) GROUP BY company""",
    "channel_dim": f"""
        WITH {TRAFFIC}
        SELECT CAST(c.channel_id AS BIGINT) AS channel_id, channel_name, channel_type,
            CAST(unit_price_eur AS DOUBLE) AS unit_price_eur, COUNT(traffic_id) AS sends,
            CAST(COALESCE(SUM(interactions_count), 0) * unit_price_eur AS DOUBLE) AS list_value
        FROM {CHANNEL_VALUES.replace("AS channels", "AS c")}
        LEFT JOIN traffic t ON t.channel_id = c.channel_id
        GROUP BY c.channel_id, channel_name, channel_type, unit_price_eur""",
    "synth_customers": f"""
        SELECT c_custkey AS customer_id,
            CAST({draw("c_custkey", 0)} % 50 + 1 AS BIGINT) AS account_id,
            'Company ' || c_custkey AS customer_name,
            {pick(SYNTH_SEGMENTS, draw("c_custkey", 1) + " % 4 + 1")} AS segment,
            {pick(SYNTH_INDUSTRIES, draw("c_custkey", 2) + " % 10 + 1")} AS industry,
            {pick(SYNTH_COUNTRIES, draw("c_custkey", 0) + " // 50 % 10 + 1")} AS country,
            CAST({AS_OF} - CAST({draw("c_custkey", 3)} % 731 AS INT) AS VARCHAR) AS created_date
        FROM customer""",
    "synth_traffic": f"""
        WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS send_date FROM orders),
        ids AS (
            SELECT send_date,
                (send_date - DATE '1970-01-01') * 50 + UNNEST(GENERATE_SERIES(
                    1, {draw("send_date", 0)} % 41 + 10)) AS traffic_id
            FROM days
        ),
        drawn AS (
            SELECT traffic_id, send_date, {draw("traffic_id", 0)} AS a,
                {draw("traffic_id", 1)} AS b, {draw("traffic_id", 2)} AS c,
                {draw("traffic_id", 3)} AS d
            FROM ids
        )
        SELECT CAST(traffic_id AS BIGINT) AS traffic_id, CAST(send_date AS VARCHAR) AS send_date,
            d // 4001 % 50 + 1 AS account_id,
            a % (SELECT COUNT(*) FROM customer) + 1 AS customer_id, b % 8 + 1 AS channel_id,
            c % 10000 + 1 AS interactions_count,
            CAST((((c % 10000 + 1) * ([5, 1, 2, 15, 8, 6, 4, 7])[b % 8 + 1]
                * (d % 4001 + 8000) + 5000) // 10000) AS DOUBLE) / 100 AS revenue_eur
        FROM drawn""",
    "date_spine": f"""
        WITH {TRAFFIC}
        SELECT CAST(day AS VARCHAR) AS send_date,
            CAST(COALESCE(SUM(revenue_eur), 0) AS DOUBLE) AS revenue
        FROM (
            SELECT CAST(UNNEST(GENERATE_SERIES(MIN(send_date), MAX(send_date), INTERVAL 1 DAY))
                AS DATE) AS day
            FROM traffic
        ) LEFT JOIN traffic ON send_date = day
        GROUP BY day""",
    "sql_file_question": f"""
        WITH {CUSTOMERS}, {TRAFFIC}, {EXPOSURE}
        SELECT industry, CAST(total_revenue AS DOUBLE) AS total_revenue, customer_count
        FROM exposure""",
    "replace_table": f"""
        WITH {TRAFFIC}
        SELECT customer_id, CAST(SUM(revenue_eur) AS DOUBLE) AS total_revenue,
            '2001-07-15 09:00:00' AS last_updated, COUNT(*) OVER () AS rows_written
        FROM traffic GROUP BY customer_id""",
    "upsert_traffic_batch": f"""
        WITH {RAW}
        SELECT seq, CAST(send_date AS VARCHAR) AS send_date, account_id,
            CAST(channel_id AS BIGINT) AS channel_id,
            CAST(interactions_count AS BIGINT) AS interactions_count,
            CAST(revenue_eur AS DOUBLE) AS revenue_eur
        FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY send_date, account_id, channel_id ORDER BY seq DESC) AS nth
            FROM raw_traffic
        ) WHERE nth = 1""",
    "upsert_customers_batch": f"""
        WITH {RAW}
        SELECT customer_id, account_id, customer_name, segment, industry, country,
            CAST(created_date AS VARCHAR) AS created_date
        FROM loaded_customers""",
    "upsert_channels_batch": """
        SELECT MIN(o_orderkey) AS channel_id, SUBSTR(o_orderpriority, 3) AS channel_name,
            LAST(o_orderstatus ORDER BY o_orderkey) AS channel_type,
            LAST(o_orderkey ORDER BY o_orderkey) % 1000 / 10000 AS unit_price_eur
        FROM orders GROUP BY SUBSTR(o_orderpriority, 3)""",
    "upsert_period_metrics": f"""
        WITH {TRAFFIC}, earlier AS ({periods("traffic", AS_OF_EARLIER)}),
        recent AS (SELECT * FROM traffic WHERE send_date >= {AS_OF} - INTERVAL 6 MONTH),
        updates AS ({periods("recent", AS_OF)})
        SELECT {PERIOD_ROW}, '2001-07-15 09:00:00' AS last_updated FROM updates
        UNION ALL
        SELECT {PERIOD_ROW}, '2001-04-15 09:00:00' AS last_updated FROM earlier
        WHERE customer_id NOT IN (SELECT customer_id FROM updates)""",
    "surrogate_keys": f"""
        WITH {RAW}
        SELECT account_id, MIN(seq) AS customer_id FROM raw_customers GROUP BY account_id""",
    "describe_table": " UNION ALL ".join(
        f"""SELECT CAST({i} AS BIGINT) AS position, '{name}' AS column_name,
            '{kind}' AS data_type, TRUE AS is_nullable,
            COUNT(*) FILTER ({name} IS NULL) AS null_count FROM lineitem"""
        for i, (name, kind) in enumerate(LINEITEM_TYPES, 1)
    ),
    "last_12_months": f"""
        WITH {TRAFFIC}
        SELECT traffic_id, customer_id, CAST(send_date AS VARCHAR) AS send_date,
            CAST(revenue_eur AS DOUBLE) AS revenue_eur
        FROM traffic WHERE send_date >= {AS_OF} - INTERVAL 12 MONTH""",
    "period_flags": f"""
        WITH {TRAFFIC}
        SELECT traffic_id, CAST(send_date AS VARCHAR) AS send_date, {flag_columns()}
        FROM traffic""",
    "period_bounds": """
        WITH days AS (
            SELECT DISTINCT CAST(o_orderdate AS DATE) AS d,
                DATE_TRUNC('month', CAST(o_orderdate AS DATE)) AS m,
                DATE_TRUNC('quarter', CAST(o_orderdate AS DATE)) AS q
            FROM orders
        )
        SELECT CAST(d AS VARCHAR) AS send_date,
            CAST(CAST(m - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS last_month_start,
            CAST(CAST(q - INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS last_quarter_start,
            CAST(CAST(q AS DATE) AS VARCHAR) AS current_quarter_start,
            CAST(CAST(q - INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS prev_quarter_start,
            CAST(CAST(m AS DATE) AS VARCHAR) AS mtd_start,
            CAST(CAST(DATE_TRUNC('year', d) AS DATE) AS VARCHAR) AS ytd_start
        FROM days""",
    "numeric_columns": """
        SELECT 'value' AS column_name, 'double' AS data_type,
            COUNT(*) FILTER (value IS NULL) AS null_count FROM events""",
    "customers_with_traffic": f"""
        WITH {CUSTOMERS}, {TRAFFIC}
        SELECT c.customer_id, industry, CAST(send_date AS VARCHAR) AS send_date,
            CAST(revenue_eur AS DOUBLE) AS revenue_eur
        FROM customers c LEFT JOIN (
            SELECT * FROM traffic WHERE send_date >= {AS_OF} - INTERVAL 12 MONTH
        ) t ON t.customer_id = c.customer_id""",
    "traffic_of_changed": f"""
        WITH {TRAFFIC}
        SELECT traffic_id, customer_id, CAST(send_date AS VARCHAR) AS send_date,
            CAST(channel_id AS BIGINT) AS channel_id, CAST(revenue_eur AS DOUBLE) AS revenue_eur
        FROM traffic WHERE customer_id IN (
            SELECT customer_id FROM traffic WHERE send_date >= {AS_OF} - INTERVAL 12 MONTH
            GROUP BY customer_id HAVING COUNT(DISTINCT channel_id) >= 2
        )""",
    "resolve_traffic_keys": f"""
        WITH {RAW}
        SELECT seq, account_id, customer_id, CAST(channel_id AS BIGINT) AS channel_id,
            CAST(revenue_eur AS DOUBLE) AS revenue_eur
        FROM resolved""",
    "traffic_rejects": f"""
        WITH {RAW}
        SELECT seq, account_id, CAST(channel_id AS BIGINT) AS channel_id,
            CAST(revenue_eur AS DOUBLE) AS revenue_eur, reason
        FROM rejected""",
    "quartiles": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, QUANTILE_DISC({c}, 0.25) AS q1,
            QUANTILE_DISC({c}, 0.75) AS q3 FROM lineitem"""
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ),
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
        for t in ["customer", "orders", "lineitem", "events"]
    ),
    "top_fraction": f"""
        WITH {CUSTOMERS}, {TRAFFIC}
        SELECT customer_id, CAST(total AS DOUBLE) AS total_revenue
        FROM (
            SELECT customer_id, SUM(revenue_eur) AS total,
                ROW_NUMBER() OVER (ORDER BY SUM(revenue_eur) DESC, customer_id) AS nth
            FROM traffic GROUP BY customer_id
        ) WHERE nth <= (SELECT (COUNT(*) + 9) // 10 FROM customers)""",
    "date_and_math_functions": """
        WITH o AS (
            SELECT *, CAST(o_orderdate AS DATE) AS d,
                CAST(o_totalprice AS DECIMAL(12,2)) AS price
            FROM orders
        )
        SELECT o_orderkey,
            CAST(CAST(DATE_TRUNC('month', d) AS DATE) AS VARCHAR) AS month_start,
            CAST(CAST(DATE_TRUNC('quarter', d) AS DATE) AS VARCHAR) AS quarter_start,
            CAST(CAST(DATE_TRUNC('year', d) AS DATE) AS VARCHAR) AS year_start,
            QUARTER(d) AS quarter_number,
            CAST(CAST(d - INTERVAL 12 MONTH AS DATE) AS VARCHAR) AS year_before,
            CAST(d - 30 AS VARCHAR) AS days_before, STRFTIME(d, '%Y-%m') AS month_text,
            CAST(CEIL(price * CAST(0.1 AS DECIMAL(2,1))) AS BIGINT) AS tenth_up,
            CAST(ROUND(price * CAST(0.125 AS DECIMAL(4,3)), 2) AS DOUBLE) AS eighth,
            CASE WHEN TRY_CAST(o_orderpriority AS INT) IS NULL THEN 'text' ELSE 'number' END
                AS priority_kind
        FROM o""",
    "contract_unique": f"""
        WITH {TRAFFIC}
        SELECT CAST(send_date AS VARCHAR) AS send_date, account_id, customer_id,
            CAST(channel_id AS BIGINT) AS channel_id, COUNT(*) AS row_count
        FROM traffic GROUP BY ALL HAVING COUNT(*) > 1""",
    "contract_fk": f"""
        WITH {RAW}
        SELECT account_id, COUNT(*) AS row_count FROM raw_traffic
        WHERE account_id NOT IN (SELECT account_id FROM raw_customers)
        GROUP BY account_id""",
    "contract_range": f"WITH {TRAFFIC} "
    + rules(
        [
            ("interactions_count >= 0", "traffic", "interactions_count < 0"),
            ("revenue_eur >= 0", "traffic", "revenue_eur < 0"),
            ("c_acctbal >= 0", "customer", "c_acctbal < 0"),
        ]
    ),
    "contract_not_null": f"""
        WITH {CUSTOMERS}, {TRAFFIC}, seen AS (
            SELECT *, (SELECT MAX(send_date) FROM traffic t WHERE t.customer_id = c.customer_id
                AND send_date >= {AS_OF} - INTERVAL 12 MONTH) AS last_date
            FROM customers c
        ) """
    + rules(
        [
            (f"{c} is not null", "seen", f"{c} IS NULL")
            for c in [
                "customer_id",
                "account_id",
                "customer_name",
                "segment",
                "industry",
                "country",
                "created_date",
                "last_date",
            ]
        ]
    ),
    "contract_fit": f"WITH {CUSTOMERS}, {TRAFFIC}, periods AS ({periods('traffic', AS_OF)}) "
    + rules(
        [
            *[
                (f"revenue_{p} fits decimal(12,2)", "periods", f"ABS(revenue_{p}) >= 1e10")
                for p in ("last_month", "last_quarter", "mtd", "ytd")
            ],
            (
                "revenue_increase_pct_qoq fits decimal(5,2)",
                "periods",
                "ABS(revenue_increase_pct_qoq) >= 1000",
            ),
            ("customer_name fits varchar(255)", "customers", "LENGTH(customer_name) > 255"),
            ("segment fits varchar(8)", "customers", "LENGTH(segment) > 8"),
            ("industry fits varchar(100)", "customers", "LENGTH(industry) > 100"),
            ("country fits varchar(100)", "customers", "LENGTH(country) > 100"),
        ]
    ),
    "apply_defaults": """
        SELECT o_orderkey, (SELECT COUNT(*) FROM lineitem WHERE l_orderkey = o_orderkey)
            AS interactions_count
        FROM orders""",
    "q1_industry_exposure": f"""
        WITH {CUSTOMERS}, {TRAFFIC}, {EXPOSURE}
        SELECT industry, CAST(total_revenue AS DOUBLE) AS total_revenue, customer_count
        FROM exposure""",
    "q2_segment_share": f"""
        WITH {CUSTOMERS}
        SELECT segment, n AS client_count, CAST(ROUND(CAST(
                100 * n / (SELECT COUNT(*) FROM customers) AS DECIMAL(18,6)), 2) AS DOUBLE)
                AS percentage_share
        FROM (SELECT segment, COUNT(*) AS n FROM customers GROUP BY segment)""",
    "q3_segment_changes": f"""
        WITH {RAW}
        SELECT DISTINCT a.account_id
        FROM raw_customers a JOIN raw_customers b ON a.account_id = b.account_id
            AND a.segment < b.segment
        WHERE EXISTS (SELECT 1 FROM raw_traffic t WHERE t.account_id = a.account_id
            AND send_date >= {AS_OF} - INTERVAL 12 MONTH)""",
    "q3_segment_changes_history": f"""
        WITH {TRAFFIC}
        SELECT customer_id FROM traffic WHERE send_date >= {AS_OF} - INTERVAL 12 MONTH
        GROUP BY customer_id HAVING COUNT(DISTINCT channel_id) >= 2""",
    "q4_top_customers": f"""
        WITH {CUSTOMERS}, {TRAFFIC}
        SELECT customer_id, CAST(total AS DOUBLE) AS total_revenue
        FROM (
            SELECT customer_id, SUM(revenue_eur) AS total,
                ROW_NUMBER() OVER (ORDER BY SUM(revenue_eur) DESC, customer_id) AS nth
            FROM traffic WHERE customer_id IN (SELECT customer_id FROM customers)
            GROUP BY customer_id
        ) WHERE nth <= 20""",
    "q5_months_active": f"""
        WITH {TRAFFIC}
        SELECT customer_id, COUNT(DISTINCT DATE_TRUNC('month', send_date))
            AS months_with_activity
        FROM traffic WHERE send_date >= {AS_OF} - INTERVAL 12 MONTH GROUP BY customer_id""",
    "q5_always_active_top": f"""
        WITH {CUSTOMERS}, {TRAFFIC}, activity AS (
            SELECT industry, send_date, revenue_eur FROM traffic JOIN customers USING (customer_id)
        )"""
    + active_top(
        "industry",
        "customers",
        "activity",
        """SELECT industry FROM activity
           WHERE send_date >= DATE '2001-08-01' - INTERVAL 12 MONTH
           GROUP BY industry HAVING COUNT(DISTINCT DATE_TRUNC('month', send_date)) = 12""",
    ),
    "q5_whole_periods": f"""
        WITH {CUSTOMERS}, {TRAFFIC}, activity AS (
            SELECT industry, send_date, revenue_eur FROM traffic JOIN customers USING (customer_id)
        )"""
    + active_top(
        "industry",
        "customers",
        "activity",
        """SELECT industry FROM activity
           WHERE send_date >= DATE '2000-07-01' AND send_date < DATE '2001-07-01'
           GROUP BY industry HAVING COUNT(DISTINCT DATE_TRUNC('month', send_date)) = 12""",
    ),
    "q5_active_users": """
        WITH activity AS (
            SELECT user_id AS customer_id, CAST(ts AS DATE) AS send_date,
                CAST(value AS DECIMAL(12,2)) AS revenue_eur
            FROM events
        )"""
    + active_top(
        "customer_id",
        "activity",
        "activity",
        """SELECT customer_id FROM activity
           WHERE send_date >= DATE '2024-01-24' AND send_date < DATE '2024-01-31'
           GROUP BY customer_id HAVING COUNT(DISTINCT send_date) = 7""",
    ),
    "revenue_by_period": f"""
        WITH {TRAFFIC} SELECT {PERIOD_ROW} FROM ({periods("traffic", AS_OF)})""",
    "revenue_by_period_clock": f"""
        WITH {TRAFFIC} SELECT {PERIOD_ROW}
        FROM ({periods("traffic", "DATE '2001-07-01'", "INTERVAL 9 HOUR")})""",
    "freshness": """
        SELECT table_name, updated_rows, CASE WHEN updated_rows > 0
            THEN 'Table updated this month with ' || updated_rows || ' records'
            ELSE 'No records updated this month' END AS message, updated_rows > 0 AS success
        FROM (
            SELECT 'orders' AS table_name, COUNT(*) AS updated_rows FROM orders
            WHERE STRFTIME(o_orderdate, '%Y-%m') = '2001-07'
            UNION ALL
            SELECT 'events', COUNT(*) FROM events
            WHERE STRFTIME(ts, '%Y-%m') = '2024-02'
        )""",
    "column_statistics": statistics("lineitem", "lineitem", LINEITEM_NUMBERS),
    "column_statistics_exposure": f"""
        WITH {CUSTOMERS}, {TRAFFIC}, {EXPOSURE} """
    + statistics("exposure", "industry_exposure", ["customer_count"]),
    "industry_categories": f"""
        WITH {CUSTOMERS}, {TRAFFIC}, {EXPOSURE}, cuts AS (
            SELECT QUANTILE_DISC(total_revenue, 0.25) AS r1,
                QUANTILE_DISC(total_revenue, 0.75) AS r3,
                QUANTILE_DISC(customer_count, 0.25) AS c1,
                QUANTILE_DISC(customer_count, 0.75) AS c3
            FROM exposure
        )
        SELECT industry, CAST(total_revenue AS DOUBLE) AS total_revenue, customer_count,
            CASE WHEN total_revenue <= r1 THEN 'Low' WHEN total_revenue <= r3 THEN 'Mid'
                ELSE 'High' END AS total_revenue_category,
            CASE WHEN customer_count <= c1 THEN 'Low' WHEN customer_count <= c3 THEN 'Mid'
                ELSE 'High' END AS customer_count_category
        FROM exposure, cuts""",
    "load_star": f"WITH {RAW} SELECT {TRAFFIC_ROW} FROM loaded_traffic",
    "monthly_run": f"""
        WITH {RAW}, totals AS (
            SELECT customer_id, SUM(revenue_eur) AS total FROM loaded_traffic GROUP BY customer_id
        ),
        ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY total DESC, customer_id) AS nth FROM totals),
        steady AS (
            SELECT customer_id, total FROM ranked JOIN (
                SELECT customer_id FROM loaded_traffic
                WHERE send_date >= DATE '2000-07-01' AND send_date < DATE '2001-07-01'
                GROUP BY customer_id HAVING COUNT(DISTINCT DATE_TRUNC('month', send_date)) = 12
            ) USING (customer_id)
            WHERE nth <= (SELECT (COUNT(*) + 9) // 10 FROM loaded_customers)
        ),
        periods AS ({periods("loaded_traffic", AS_OF)}),
        exposure AS (
            SELECT industry, COUNT(*) AS members, COALESCE(SUM(total), 0) AS earned
            FROM loaded_customers LEFT JOIN totals USING (customer_id) GROUP BY industry
        ),
        shares AS (
            SELECT segment, COUNT(*) AS n,
                ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM loaded_customers), 2) AS share
            FROM loaded_customers GROUP BY segment
        ),
        found AS (
            SELECT 'customers' AS table_name, COUNT(*) AS row_count, SUM(customer_id) AS ids,
                SUM(LENGTH(customer_name) + LENGTH(segment) + LENGTH(industry)) AS amount
            FROM loaded_customers
            UNION ALL SELECT 'channels', COUNT(*), SUM(channel_id), SUM(channel_id) * 0.01
            FROM raw_channels
            UNION ALL SELECT 'traffic', COUNT(*), SUM(traffic_id), SUM(revenue_eur) FROM loaded_traffic
            UNION ALL SELECT 'traffic_rejects', COUNT(*), SUM(seq), SUM(revenue_eur) FROM rejected
            UNION ALL SELECT 'customers_revenue_by_period', COUNT(*), SUM(customer_id),
                SUM(revenue_ytd + revenue_last_quarter + revenue_last_month) FROM periods
            UNION ALL SELECT 'business_analytics/industry_exposure', COUNT(*), SUM(members),
                SUM(earned) FROM exposure
            UNION ALL SELECT 'business_analytics/segment_analysis', COUNT(*), SUM(n), SUM(share)
            FROM shares
            UNION ALL SELECT 'business_analytics/recent_customers', 0, 0, 0
            UNION ALL SELECT 'business_analytics/top_customers', COUNT(*), SUM(customer_id), SUM(total)
            FROM ranked WHERE nth <= 20
            UNION ALL SELECT 'business_analytics/monthly_active_customers', COUNT(*),
                COALESCE(SUM(customer_id), 0), COALESCE(SUM(total), 0) FROM steady
            UNION ALL SELECT 'descriptive_statistics/column_statistics', 2, 2 * COUNT(*),
                MAX(earned) + MIN(earned) + MAX(members) + MIN(members) FROM exposure
            UNION ALL SELECT 'descriptive_statistics/industry_exposure_extended', COUNT(*),
                SUM(members), SUM(earned) FROM exposure
        )
        SELECT table_name, row_count, CAST(ids AS BIGINT) AS ids, ROUND(CAST(amount AS DOUBLE), 2) AS amount
        FROM found""",
}
# The same answers, asked for as SQL text.
ORACLES |= {
    "sql_segment_share": ORACLES["q2_segment_share"],
    "sql_segment_changes": ORACLES["q3_segment_changes"],
    "sql_top_customers": ORACLES["q4_top_customers"],
    "sql_always_active_top": ORACLES["q5_whole_periods"],
    "sql_star_tables": ORACLES["csv_scan"],
}
