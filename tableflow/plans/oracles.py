"""DuckDB SQL equal to each registered query (tables are pre-registered views).

Column names and types follow the Spark side: counts are BIGINT, lengths and
positions INTEGER, float aggregates rounded the same way on both sides.
"""

from __future__ import annotations

CELL_COLUMNS_CUSTOMER = ["c_name", "c_mktsegment", "c_nationkey"]
CELL_COLUMNS_PART = ["p_name", "p_type", "p_size"]
DECLARED_CUSTOMER = {"c_custkey": "bigint", "c_name": "bigint", "c_nationkey": "int", "c_acctbal": "decimal(5,2)",
                     "c_mktsegment": "string", "c_phone": "string"}
DEFAULT_LINE_LIMIT, LONG_LINE_LIMIT = 2048, 4600
PREFIX = "red"
PRICE_BANDS = [(0, 10000, "small"), (10000, 100000, "medium"), (100000, 300000, "large")]
PRICE_DEFAULT = "very large"
PRIORITY_LABELS = [("1-URGENT", "rush"), ("2-HIGH", "rush"), ("3-MEDIUM", "normal"), ("4-NOT SPECIFIED", "normal")]

_DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}


def _price_case(col: str) -> str:
    whens = " ".join(
        f"WHEN {col} >= {lo} AND {col} < {hi} THEN '{label}'" for lo, hi, label in PRICE_BANDS
    )
    return f"CASE {whens} ELSE '{PRICE_DEFAULT}' END"


def _cells(table: str, key: str, cols: list[str], types: dict[str, str]) -> str:
    names = ", ".join(f"'{c}'" for c in cols)
    values = ", ".join(c if types.get(c) == "string" else f"CAST({c} AS VARCHAR)" for c in cols)
    return (
        f"SELECT CAST({key} AS VARCHAR) AS rowkey, 'cf' AS family, q AS qualifier, v AS value FROM "
        f"(SELECT {key}, unnest([{names}]) AS q, unnest([{values}]) AS v FROM {table}) WHERE v IS NOT NULL"
    )


_CUSTOMER_TYPES = {"c_name": "string", "c_mktsegment": "string", "c_nationkey": "int"}
_PART_TYPES = {"p_name": "string", "p_type": "string", "p_size": "int"}
CUSTOMER_CELLS = _cells("customer", "c_custkey", CELL_COLUMNS_CUSTOMER, _CUSTOMER_TYPES)
PART_CELLS = _cells("part", "p_partkey", CELL_COLUMNS_PART, _PART_TYPES)


def _java_hash(expr: str) -> str:
    unsigned = (
        f"list_reduce(list_transform(string_split({expr}, ''), lambda ch: ord(ch)::BIGINT), "
        f"lambda a, ch: (a * 31 + ch) % 4294967296, 0::BIGINT)"
    )
    return f"(CASE WHEN {unsigned} >= 2147483648 THEN {unsigned} - 4294967296 ELSE {unsigned} END)"


def _salt(expr: str) -> str:
    return f"lpad(CAST(abs({_java_hash(expr)}) % 16 AS VARCHAR), 2, '0')"


SALTED_CELLS = (
    f"SELECT {_salt('rowkey')} AS salt, {_salt('rowkey')} || ':' || rowkey AS salted, qualifier, value "
    f"FROM ({CUSTOMER_CELLS}) WHERE NOT (qualifier = 'c_mktsegment' AND value IN ('MACHINERY', 'BUILDING'))"
)


def _hex4(expr: str) -> str:
    return f"printf('%08X', (CAST({expr} AS BIGINT) + 4294967296) % 4294967296)"


def _lines(cols: str) -> str:
    return f"SELECT {cols}, unnest(string_split(text, chr(10))) AS line FROM documents"


def _flow(name: str, n: int, lines: str | None = None) -> str:
    return (
        f"SELECT '{name}' AS flow, substr(line, p * {n} + 1, {n}) AS value, true AS from_spool_file FROM "
        f"(SELECT line, unnest(range(0, greatest(CAST(ceil(length(line) / {n}.0) AS INTEGER), 1))) AS p "
        f"FROM ({lines or _lines('lang')}))"
    )


def _language_flow(name: str, n: int, where: str) -> str:
    return _flow(name, n, (
        "SELECT unnest(string_split(CASE WHEN doc_id % 7 = 0 THEN replace(text, chr(10), chr(13) || chr(10)) ELSE text END, "
        f"chr(10))) AS line FROM (SELECT doc_id, text, CASE WHEN doc_id % 10 <> 0 THEN lang END AS lang FROM documents) WHERE {where}"))


_JOIN_L = "(SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey FROM orders)"
_JOIN_R = "(SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey END AS c_custkey, c_name FROM customer)"

_EVENTS_E = (
    "(SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value, props FROM events)"
)


def _profile_numeric(col: str, dtype: str) -> str:
    return (
        f"SELECT '{col}' AS \"column\", '{dtype}' AS datatype, "
        f"count(DISTINCT {col}) + CAST(count(*) > count({col}) AS BIGINT) AS distinct_count, "
        f"count({col}) AS count, round(avg({col}), 4) AS mean, round(stddev_samp({col}), 4) AS stddev, "
        f"CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max, "
        f"count(*) - count({col}) AS null_count FROM {_EVENTS_E}"
    )


def _profile_other(col: str, dtype: str) -> str:
    return (
        f"SELECT '{col}' AS \"column\", '{dtype}' AS datatype, "
        f"count(DISTINCT {col}) + CAST(count(*) > count({col}) AS BIGINT) AS distinct_count, "
        f"count(*) AS count, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev, NULL::DOUBLE AS min, "
        f"NULL::DOUBLE AS max, count(*) - count({col}) AS null_count FROM {_EVENTS_E}"
    )


def _duck_type(t: str) -> str:
    return _DUCK_TYPES.get(t, t.upper())


def _conformance() -> str:
    table_cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    parts = []
    for c in table_cols + [c for c in DECLARED_CUSTOMER if c not in table_cols]:
        t = DECLARED_CUSTOMER.get(c)
        in_table = c in table_cols
        if in_table and t:
            bad = f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {_duck_type(t)}) IS NULL)"
        else:
            bad = "NULL::BIGINT"
        declared = f"'{t}'" if t else "NULL::VARCHAR"
        source = " FROM customer" if in_table and t else ""
        parts.append(
            f"SELECT '{c}' AS \"column\", {str(in_table).upper()} AS in_table, "
            f"{str(t is not None).upper()} AS in_schema, {declared} AS declared_type, "
            f"{bad} AS bad_values{source}"
        )
    return " UNION ALL ".join(parts)


_PRIORITY_INDEX = (
    "WITH l AS (SELECT o_orderpriority AS p, "
    "CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS i "
    "FROM orders GROUP BY o_orderpriority) "
)


def _labels_values() -> str:
    return ", ".join(f"('{p}', '{h}')" for p, h in PRIORITY_LABELS)


def oracles() -> dict[str, str]:
    sq = {}
    sq["entry_flagship"] = (
        "SELECT price_band, c_mktsegment, count(o_orderkey) AS n_orders, min(o_totalprice) AS least_total, "
        "max(o_totalprice) AS greatest_total, count(DISTINCT o_custkey) AS n_customers FROM "
        f"(SELECT o_orderkey, o_custkey, o_totalprice, {_price_case('o_totalprice')} AS price_band FROM orders) o "
        "LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY price_band, c_mktsegment "
        "ORDER BY n_orders DESC, price_band, c_mktsegment LIMIT 10"
    )
    sq["src_csv"] = (
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
        "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer"
    )
    sq["src_parquet"] = "SELECT * FROM lineitem"
    sq["src_inline"] = (
        "SELECT o_orderpriority, handling, count(o_orderkey) AS n_orders FROM orders "
        f"LEFT JOIN (VALUES {_labels_values()}) AS l(o_orderpriority, handling) USING (o_orderpriority) "
        "GROUP BY o_orderpriority, handling"
    )
    sq["sink_csv"] = (
        "SELECT *, CASE o_orderstatus WHEN 'F' THEN ' say \"hi\",' || chr(13) || chr(10) || 'next line' || chr(10) || '\\ ' "
        "WHEN 'O' THEN '' END AS note FROM orders"
    )
    sq["sink_parquet"] = "SELECT * FROM lineitem"
    sq["monthly_pipeline"] = (
        "SELECT o_orderstatus, count(*) AS n_orders, CASE WHEN o_orderpriority = '5-LOW' THEN '00' "
        "ELSE strftime(o_orderdate, '%m') END AS month FROM orders GROUP BY o_orderstatus, month"
    )
    sq["monthly_tables"] = sq["monthly_pipeline"]
    sq["monthly_drift"] = (
        "SELECT o_orderkey, CASE WHEN q = 1 THEN floor(o_totalprice) WHEN q = 2 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) "
        "ELSE o_totalprice END AS o_totalprice, CASE WHEN q <> 3 THEN o_orderstatus END AS o_orderstatus, "
        "CASE WHEN q > 2 THEN 'c' ELSE '' END || CAST(o_orderkey % 100 AS VARCHAR) AS o_code, "
        "CASE WHEN q > 1 THEN o_orderpriority END AS o_orderpriority, strftime(o_orderdate, '%m') AS month "
        "FROM (SELECT *, quarter(o_orderdate) AS q FROM orders)"
    )
    sq["monthly_changed"] = (
        "WITH o AS (SELECT *, strftime(o_orderdate, '%m') AS month FROM orders), "
        "c AS (SELECT o_orderkey, month, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM o WHERE month = '03') THEN 'X' "
        "ELSE o_orderstatus END AS o_orderstatus FROM o) "
        "SELECT o_orderstatus, count(*) AS n_orders, CASE WHEN month = '03' THEN 2 ELSE 1 END AS run, month FROM c "
        "GROUP BY o_orderstatus, month"
    )
    sq["catalog_partitions"] = (
        "SELECT o_orderkey, CASE WHEN month IN ('04', '05', '06') THEN 'done' ELSE o_orderstatus END AS o_orderstatus, month "
        "FROM (SELECT *, strftime(o_orderdate, '%m') AS month FROM orders) "
        "WHERE month NOT IN ('04', '05', '06') OR o_orderstatus = 'F'"
    )
    sq["monthly_write"] = "SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%m') AS month FROM orders"
    sq["rows_to_cells"] = (
        "SELECT CAST(c_custkey AS VARCHAR) AS rowkey, 'cf' AS family, q AS qualifier, v AS value_hex FROM "
        "(SELECT c_custkey, unnest(['c_name', 'c_mktsegment', 'c_nationkey']) AS q, "
        f"unnest([hex(encode(c_name)), hex(encode(c_mktsegment)), {_hex4('c_nationkey')}]) AS v FROM customer)"
    )
    sq["cells_scan_columns"] = (
        f"SELECT * FROM ({CUSTOMER_CELLS}) WHERE family = 'cf' AND qualifier IN ('c_name', 'c_mktsegment')"
    )
    sq["cells_row_keys"] = "SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS rowkey FROM customer"
    sq["cells_row_count"] = f"SELECT count(*) AS n_cells, count(DISTINCT rowkey) AS n_rows FROM ({CUSTOMER_CELLS})"
    sq["cells_long"] = f"SELECT qualifier, value FROM ({CUSTOMER_CELLS})"
    sq["cells_to_rows"] = (
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment, c_nationkey FROM customer"
    )
    sq["prefix_filter"] = f"SELECT p_name, p_type, p_size FROM part WHERE starts_with(p_name, '{PREFIX}')"
    sq["cells_prefix_filter"] = (
        f"WITH c AS ({PART_CELLS}) SELECT * FROM c WHERE rowkey IN "
        f"(SELECT rowkey FROM c WHERE family = 'cf' AND qualifier = 'p_name' AND starts_with(value, '{PREFIX}'))"
    )
    sq["cells_indexed_filter"] = sq["cells_prefix_filter"]
    sq["cells_upsert"] = (
        "WITH w AS ("
        "SELECT CAST(c_custkey AS VARCHAR) AS rowkey, 'cf' AS family, 'c_name' AS qualifier, c_name AS value, "
        "TIMESTAMP '1970-01-01 00:00:00' AS ts, -1::BIGINT AS event_id FROM customer UNION ALL "
        "SELECT CAST(c_custkey AS VARCHAR), 'cf', 'c_mktsegment', c_mktsegment, TIMESTAMP '1970-01-01 00:00:00', "
        "-1::BIGINT FROM customer UNION ALL "
        "SELECT CAST(user_id AS VARCHAR), 'cf', 'event_type', event_type, ts, event_id FROM events UNION ALL "
        "SELECT CAST(user_id AS VARCHAR), 'cf', 'props', props, ts, event_id FROM events) "
        "SELECT rowkey, family, qualifier, value FROM (SELECT *, row_number() OVER "
        "(PARTITION BY rowkey, family, qualifier ORDER BY ts DESC, event_id DESC) AS r FROM w) WHERE r = 1"
    )
    sq["cells_store_upsert"] = sq["cells_upsert"]
    sq["salt_key"] = (
        f"SELECT c_custkey, {_salt('CAST(c_custkey AS VARCHAR)')} || ':' || CAST(c_custkey AS VARCHAR) AS salted "
        "FROM customer"
    )
    sq["salted_cells"] = SALTED_CELLS
    sq["bulk_load"] = SALTED_CELLS
    sq["cell_codec"] = (
        f"SELECT c_custkey, {_hex4('c_nationkey')} AS nation_hex, c_nationkey AS nation_back, "
        f"{_hex4('floor(c_acctbal)')} AS acct_hex, CAST(floor(c_acctbal) AS INTEGER) AS acct_back, "
        "hex(encode(c_name)) AS name_hex, c_name AS name_back FROM customer"
    )
    sq["rename_cols"] = (
        "SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus, o_totalprice, o_orderdate, "
        "o_orderpriority FROM orders"
    )
    sq["drop_cols"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
    sq["cast_schema"] = (
        "SELECT o_orderkey, o_totalprice, "
        "CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS o_orderdate, "
        "TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority, o_orderstatus, "
        "TRY_CAST(o_orderkey * 100000 AS INTEGER) AS overflowing FROM orders"
    )
    sq["select_rename"] = "SELECT c_custkey AS custkey, c_name AS customer_name, c_mktsegment FROM customer"
    sq["case_bucket"] = (
        f"SELECT price_band, count(o_orderkey) AS n_orders FROM (SELECT o_orderkey, "
        f"{_price_case('o_totalprice')} AS price_band FROM orders) GROUP BY price_band"
    )
    sq["null_rows"] = f"SELECT DISTINCT user_id, event_type FROM {_EVENTS_E} WHERE event_type IS NULL"
    sq["null_count"] = (
        "SELECT count(*) FILTER (WHERE event_type IS NULL) AS null_event_type, "
        f"count(*) FILTER (WHERE value IS NULL) AS null_value FROM {_EVENTS_E}"
    )
    sq["clean_price"] = (
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'MYR ' ELSE 'RM ' END || "
        "format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '.50' END AS price, "
        "CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS prices FROM orders"
    )
    sq["round_cols"] = "SELECT p_partkey, round(p_retailprice / p_size, 3) AS unit_price FROM part"
    sq["safe_names"] = (
        "SELECT o_orderkey AS order_key, o_totalprice AS total_price_usd_, o_orderstatus AS status_code FROM orders"
    )
    sq["join_using_one"] = (
        "SELECT o.o_orderkey, o.o_custkey AS custkey, o.o_totalprice, c.c_name FROM orders o "
        "LEFT JOIN customer c ON o.o_custkey = c.c_custkey"
    )
    sq["join_using_list"] = (
        "SELECT e.user_id, e.event_type, e.event_id, n.n_events FROM events e LEFT JOIN "
        "(SELECT user_id, event_type, count(event_id) AS n_events FROM events GROUP BY user_id, event_type) n "
        "ON e.user_id = n.user_id AND e.event_type = n.event_type"
    )
    sq["join_skew_split"] = (
        "WITH e AS (SELECT event_id, user_id, CASE WHEN event_type IN ('click', 'view') THEN event_type "
        "ELSE event_type || '-' || user_id END AS key FROM events) "
        "SELECT e.key, e.event_id, e.user_id, t.n_key, t.users_key FROM e LEFT JOIN "
        "(SELECT key, count(event_id) AS n_key, count(DISTINCT user_id) AS users_key FROM e "
        "GROUP BY key) t ON e.key = t.key"
    )
    for kind in ("right", "full"):
        sq[f"join_skew_{kind}"] = (
            "SELECT coalesce(e.key, c.key) AS key, e.event_id, c.c_custkey, c.c_name FROM "
            "(SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type "
            "WHEN event_type <> 'error' THEN event_type || '-' || user_id END AS key FROM events) e "
            f"{kind} JOIN (SELECT c_custkey, c_name, CASE WHEN c_custkey = 5 THEN 'click' WHEN c_mktsegment = 'MACHINERY' "
            "THEN 'nothing' WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'purchase-' || c_custkey END AS key FROM customer) c "
            "ON e.key = c.key"
        )
    sq["join_composite"] = (
        f"SELECT e.event_id, e.user_id, e.event_type, n.n_events FROM {_EVENTS_E} e LEFT JOIN "
        f"(SELECT user_id, event_type, count(event_id) AS n_events FROM {_EVENTS_E} WHERE event_type <> 'view' "
        "GROUP BY user_id, event_type) n ON e.user_id = n.user_id AND e.event_type = n.event_type"
    )
    building = "(SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey END AS c_custkey, c_name FROM customer)"
    sq["join_mapped"] = (
        f"SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, c.c_name FROM orders o LEFT JOIN {building} c "
        "ON o.o_custkey = c.c_custkey"
    )
    sq["join_mapped_keep"] = (
        f"SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, c.c_custkey, c.c_name FROM orders o "
        f"LEFT JOIN {building} c ON o.o_custkey = c.c_custkey"
    )
    sq["join_select_rename"] = (
        "SELECT o.o_orderkey, o.o_custkey, c.c_custkey AS ck, c.c_name AS customer_name, c.c_mktsegment "
        "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"
    )
    sq["join_inner"] = (
        f"SELECT l.o_orderkey, l.o_custkey, r.c_name FROM {_JOIN_L} l JOIN {_JOIN_R} r ON l.o_custkey = r.c_custkey"
    )
    sq["join_right"] = (
        f"SELECT l.o_orderkey, coalesce(l.o_custkey, r.c_custkey) AS o_custkey, r.c_name FROM {_JOIN_L} l "
        f"RIGHT JOIN {_JOIN_R} r ON l.o_custkey = r.c_custkey"
    )
    sq["join_full"] = (
        f"SELECT l.o_orderkey, coalesce(l.o_custkey, r.c_custkey) AS o_custkey, r.c_name FROM {_JOIN_L} l "
        f"FULL JOIN {_JOIN_R} r ON l.o_custkey = r.c_custkey"
    )
    sq["join_semi"] = (
        f"SELECT o_orderkey, o_custkey FROM {_JOIN_L} l WHERE EXISTS "
        f"(SELECT 1 FROM {_JOIN_R} r WHERE r.c_custkey = l.o_custkey)"
    )
    sq["join_anti"] = (
        f"SELECT o_orderkey, o_custkey FROM {_JOIN_L} l WHERE NOT EXISTS "
        f"(SELECT 1 FROM {_JOIN_R} r WHERE r.c_custkey = l.o_custkey)"
    )
    sq["agg_flat"] = (
        "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity, count(DISTINCT l_orderkey) AS l_orderkey, "
        "max(l_extendedprice) AS l_extendedprice, min(l_discount) AS l_discount FROM lineitem "
        "GROUP BY l_returnflag, l_linestatus"
    )
    sq["agg_nested"] = (
        "SELECT c_nationkey, count(c_name) AS n_customers, min(c_acctbal) AS min_bal, max(c_acctbal) AS max_bal, "
        "round(avg(c_acctbal), 4) AS avg_bal, round(sum(c_acctbal), 2) AS sum_bal, "
        "count(DISTINCT c_mktsegment) AS n_segments FROM customer GROUP BY c_nationkey"
    )
    sq["agg_global"] = (
        "SELECT count(event_id) AS n_events, count(DISTINCT user_id) AS n_users, "
        "round(sum(value), 2) AS total_value, round(avg(value), 4) AS mean_value FROM events"
    )
    sq["distinct_values"] = "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders"
    sq["top_n"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"
    sq["data_profile"] = " UNION ALL ".join([
        _profile_numeric("event_id", "bigint"),
        _profile_other("ts", "timestamp_ntz"),
        _profile_numeric("user_id", "bigint"),
        _profile_other("event_type", "string"),
        _profile_numeric("value", "double"),
        _profile_other("props", "string"),
    ])
    sq["profile_merged"] = (
        "SELECT \"column\", datatype, count, mean, stddev, min, max, null_count, true AS distinct_close "
        f"FROM ({sq['data_profile']})"
    )
    sq["schema_conformance"] = _conformance()
    sq["line_profile"] = (
        "SELECT source, CAST(max(length(line)) AS INTEGER) AS max_line_length, count(*) AS n_lines "
        f"FROM ({_lines('source')}) GROUP BY source"
    )
    n = DEFAULT_LINE_LIMIT
    sq["line_chunk"] = (
        f"SELECT doc_id, CAST(ln - 1 AS INTEGER) AS line_no, CAST(p AS INTEGER) AS chunk_no, "
        f"substr(line, p * {n} + 1, {n}) AS chunk FROM "
        f"(SELECT doc_id, ln, line, unnest(range(0, greatest(CAST(ceil(length(line) / {n}.0) AS INTEGER), 1))) AS p "
        f"FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, "
        f"generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents))"
    )
    sq["encoding_profile"] = (
        "SELECT lang, count(*) AS n_lines, "
        "count(*) FILTER (WHERE regexp_matches(line, '[^\\x00-\\x7F]')) AS bad_lines "
        f"FROM ({_lines('lang')}) GROUP BY lang"
    )
    sq["charset_advice"] = r"""
WITH l AS (SELECT source, lang, CASE lang WHEN 'en' THEN 'UTF-16LE' WHEN 'de' THEN 'ISO-8859-2' WHEN 'es' THEN 'windows-1252'
                  ELSE 'UTF-8' END AS charset,
                  unnest(string_split(regexp_replace(text, '[^\x00-\x{FF}]', '?', 'g'), chr(10))) AS line FROM documents),
h AS (SELECT source || '-' || lang AS file, source, charset, '0A' || CASE WHEN line = '' THEN '' WHEN charset = 'UTF-8' THEN hex(encode(line))
             ELSE array_to_string(list_transform(string_split(CASE lang WHEN 'de' THEN translate(line, 'äöüß', '±³¿¶') ELSE line END, ''),
                  lambda c: printf('%02X', unicode(c)) || CASE lang WHEN 'en' THEN '00' ELSE '' END), '') END || '0A' AS b FROM l),
p AS (SELECT file, source, charset, substr(b, 2 * i + 1, 4) AS pair, count(*) AS n FROM
      (SELECT *, unnest(range(0, length(b) // 2 - 1)) AS i FROM h) GROUP BY ALL),
even AS (SELECT charset, pair, sum(n) AS n FROM p WHERE regexp_matches(source, '[02468]$') GROUP BY ALL),
t AS (SELECT charset, sum(n) AS total FROM even GROUP BY charset),
m AS (SELECT charset, pair, CAST(round(ln((n + 0.5) / (total + 0.5 * 65536)) * 1000) AS BIGINT) AS score FROM even JOIN t USING (charset)),
u AS (SELECT charset, CAST(round(ln(0.5 / (total + 0.5 * 65536)) * 1000) AS BIGINT) AS unseen FROM t),
f AS (SELECT file, pair, sum(n) AS n FROM p GROUP BY ALL),
s AS (SELECT file, u.charset, CAST(sum(n) AS BIGINT) AS n_bytes, CAST(sum(n * coalesce(m.score, unseen)) AS BIGINT) AS score
      FROM f CROSS JOIN u LEFT JOIN m ON m.charset = u.charset AND m.pair = f.pair GROUP BY ALL),
x AS (SELECT file, any_value(charset) AS own, bool_or(substr(pair, 1, 1) >= '8') AS high, bool_or(substr(pair, 1, 1) >= '8' OR substr(pair, 1, 2) = '00') AS odd FROM p GROUP BY file),
r AS (SELECT file, charset, n_bytes, score, odd, row_number() OVER q AS place, score - lead(score) OVER q AS margin
      FROM s JOIN x USING (file) WHERE charset <> 'UTF-8' OR own = 'UTF-8' OR NOT high
      WINDOW q AS (PARTITION BY file ORDER BY score DESC, charset))
SELECT file, CASE WHEN odd THEN charset ELSE 'US-ASCII' END AS charset, n_bytes, score, margin FROM r WHERE place = 1
"""
    sq["string_index"] = (
        _PRIORITY_INDEX
        + "SELECT o_orderkey, o_orderpriority, i AS priority_idx FROM orders JOIN l ON l.p = o_orderpriority"
    )
    early = (
        "WITH l AS (SELECT o_custkey AS k, CAST(row_number() OVER (ORDER BY count(*) DESC, o_custkey) - 1 AS DOUBLE) AS i "
        "FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY o_custkey) SELECT o_orderkey, o_custkey, "
    )
    sq["string_index_fitted"] = (
        early + "coalesce(i, (SELECT CAST(count(*) AS DOUBLE) FROM l)) AS cust_idx FROM orders LEFT JOIN l ON k = o_custkey"
    )
    sq["string_index_stream"] = early + "i AS cust_idx FROM orders JOIN l ON k = o_custkey"
    onehot = ", ".join(f"CAST(i = {k} AS DOUBLE) AS priority_vec_{k}" for k in range(4))
    sq["one_hot"] = (
        _PRIORITY_INDEX
        + f"SELECT o_orderkey, i AS priority_idx, {onehot} FROM orders JOIN l ON l.p = o_orderpriority"
    )
    feats = ", ".join(f"CAST(i = {k} AS DOUBLE) AS feature_{k + 1}" for k in range(4))
    sq["assemble"] = (
        _PRIORITY_INDEX
        + f"SELECT o_orderkey, i AS feature_0, {feats}, o_totalprice AS feature_5 FROM orders "
        "JOIN l ON l.p = o_orderpriority"
    )
    sq["stream_spool"] = _flow("docs", DEFAULT_LINE_LIMIT)
    sq["stream_wide_charset"] = _flow("docs_utf16", DEFAULT_LINE_LIMIT)
    sq["stream_charset"] = _flow("docs_cp1252", DEFAULT_LINE_LIMIT)
    sq["stream_line_chunk"] = _flow("long_lines", LONG_LINE_LIMIT)
    sq["stream_idle_close"] = (
        "SELECT source AS name, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars "
        f"FROM ({_lines('source')}) GROUP BY source"
    )
    sq["stream_multi_flow"] = " UNION ALL ".join(
        _language_flow(name, n, where) for name, n, where in (
            ("en", 2048, "lang = 'en'"), ("es", 2048, "lang = 'es'"), ("de", 2048, "lang = 'de'"), ("fr", 4600, "lang = 'fr'"),
            ("other", 2048, "lang IS NULL OR lang NOT IN ('en', 'es', 'de', 'fr')"))
    )
    return sq
