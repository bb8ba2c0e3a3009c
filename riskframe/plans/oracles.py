"""DuckDB SQL that states what each registered query must return."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_linenumber % 5 <> 0 THEN l_quantity END AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag,
         CASE WHEN l_partkey % 7 <> 0 THEN l_linestatus END AS l_linestatus
  FROM lineitem)"""

DOCS = """
features AS (
  SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
         round(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / length(text), 6) AS letter_share,
         round(len(list_distinct(string_split(text, ' '))) / len(string_split(text, ' ')), 6) AS distinct_share,
         lang, source
  FROM documents),
docs AS (SELECT f.*, l.quality, l.toxic FROM features f LEFT JOIN labels l USING (doc_id))"""

SCORED = """
scored AS (
  SELECT label, p0, round(0.2 + 0.25 * p0, 6) AS p1
  FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
               round(1 / (1 + exp(-((l_quantity - 25) / 12.0 + 5 * (l_discount - 0.05)))), 4) AS p0
        FROM lineitem))"""

APPLICANTS = """
applicants AS (
  SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, n_orders, total_price, max_price, last_status,
         CAST(c_acctbal < 0 AS INT) AS target
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price,
           round(max(o_totalprice), 2) AS max_price, max(o_orderstatus) AS last_status
    FROM orders GROUP BY 1) ON c_custkey = o_custkey)"""

LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax", "l_returnflag", "l_linestatus")
LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_KEYS = "CAST(l_orderkey AS BIGINT) l_orderkey, CAST(l_linenumber AS BIGINT) l_linenumber, l_partkey, l_suppkey"


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


def union(template: str, names) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in names)


def dbl(expr: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


# Quality

_MISSING = "missing AS (" + union(
    "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, count(*) AS n_rows FROM lines",
    LINE_COLUMNS) + ")"
oracle("missing_counts", f"""WITH {LINES}, {_MISSING}
SELECT "column", missing_count, n_rows, {dbl('missing_count / n_rows')} AS missing_fraction FROM missing""")
oracle("missing_report", f"""WITH {LINES}, {_MISSING}
SELECT "column", missing_count, {dbl('missing_count / n_rows * 100')} AS missing_percentage
FROM missing WHERE missing_count > 0""")
oracle("high_missing_strict", f"""WITH {LINES}, {_MISSING}
SELECT "column", missing_count, n_rows, {dbl('missing_count / n_rows')} AS missing_fraction
FROM missing WHERE missing_count / n_rows > 0.1""")
_DOC_COLUMNS = ("doc_id", "n_chars", "letter_share", "distinct_share", "lang", "source", "quality", "toxic")
_DOC_MISSING = "missing AS (" + union(
    "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, count(*) AS n_rows FROM docs",
    _DOC_COLUMNS) + ")"
oracle("high_missing", f"""WITH {DOCS}, {_DOC_MISSING}
SELECT "column", missing_count, n_rows, {dbl('missing_count / n_rows')} AS missing_fraction
FROM missing WHERE missing_count / n_rows > 0.5""")
oracle("duplicate_count", f"""WITH {LINES}
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
  SELECT count(*) AS n FROM lines GROUP BY l_quantity, l_discount, l_tax, l_returnflag, l_linestatus)""")
oracle("duplicate_count_wide", """
WITH twice AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 7 = 0)
SELECT (SELECT count(*) FROM twice) - (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS duplicate_rows""")

oracle("target_distribution", f"""WITH {DOCS}
SELECT CAST(quality AS BIGINT) AS target, count(*) AS n, {dbl('count(*) / (SELECT count(*) FROM docs)')} AS share
FROM docs GROUP BY quality""")
oracle("target_check", f"""WITH {DOCS}, c AS (
  SELECT count(*) AS n_rows, count(*) - count(quality) AS n_missing, count(DISTINCT quality) AS n_distinct FROM docs)
SELECT n_rows, n_missing, n_distinct,
       CAST(n_missing > 0 AS BIGINT) + CAST(n_distinct <> 2 AS BIGINT) AS n_warnings, CAST(0 AS BIGINT) AS n_errors
FROM c""")
oracle("target_check_whitelist", """
SELECT count(*) AS n_rows, count(*) - count(l_returnflag) AS n_missing, count(DISTINCT l_returnflag) AS n_distinct,
       CAST(0 AS BIGINT) AS n_warnings,
       CAST(max(CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 1 ELSE 0 END) AS BIGINT) AS n_errors
FROM lineitem""")
oracle("quality_report", f"""WITH {DOCS}, {_DOC_MISSING}
SELECT 'n_rows' AS "check", NULL AS "column", CAST(count(*) AS VARCHAR) AS value, 'info' AS severity FROM docs
UNION ALL SELECT 'n_columns', NULL, '8', 'info'
UNION ALL SELECT 'duplicate_rows', NULL, CAST(sum(n - 1) AS VARCHAR),
                 CASE WHEN sum(n - 1) > 0 THEN 'warning' ELSE 'info' END
          FROM (SELECT count(*) AS n FROM docs GROUP BY ALL)
UNION ALL SELECT 'missing_count', "column", CAST(missing_count AS VARCHAR),
                 CASE WHEN missing_count / n_rows > 0.5 THEN 'warning' ELSE 'info' END FROM missing
UNION ALL SELECT CASE WHEN c IN ('lang', 'source') THEN 'categorical_column' ELSE 'numerical_column' END, c, NULL, 'info'
          FROM (SELECT unnest(['doc_id', 'n_chars', 'letter_share', 'distinct_share', 'lang', 'source', 'toxic']) AS c)
UNION ALL SELECT 'target_count', CAST(quality AS VARCHAR), CAST(count(*) AS VARCHAR), 'info' FROM docs GROUP BY quality
UNION ALL SELECT 'warning', NULL, printf('The target has %d missing values (%.2f%%); these rows cannot be used for training.',
            missing_count, 100.0 * missing_count / n_rows), 'warning'
          FROM missing WHERE "column" = 'quality' AND missing_count > 0
UNION ALL SELECT 'warning', NULL, printf('Found %d duplicate rows.', sum(n - 1)::BIGINT), 'warning'
          FROM (SELECT count(*) AS n FROM docs GROUP BY ALL) HAVING sum(n - 1) > 0
UNION ALL SELECT 'warning', NULL, 'Columns with a share of missing values above 0.5: ['
            || string_agg('''' || "column" || '''', ', ' ORDER BY position) || ']', 'warning'
          FROM (SELECT *, list_position(['doc_id', 'n_chars', 'letter_share', 'distinct_share', 'lang', 'source', 'quality', 'toxic'],
                "column") AS position FROM missing WHERE missing_count / n_rows > 0.5) HAVING count(*) > 0
""".replace("SELECT count(*) AS n FROM docs GROUP BY ALL",
            "SELECT count(*) AS n FROM docs GROUP BY " + ", ".join(_DOC_COLUMNS)))
_FILE_COLUMNS = (("doc_id", "bigint"), ("n_chars", "double"), ("letter_share", "double"), ("distinct_share", "double"),
                 ("lang", "string"), ("source", "string"), ("quality", "bigint"))
oracle("profile_workflow", f"""
WITH {DOCS},
gaps AS ({" UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS name, '{t}' AS dtype, count(*) - count({c}) AS missing, count(*) AS n FROM docs"
                             for i, (c, t) in enumerate(_FILE_COLUMNS))}),
report("check", "column", value, severity) AS (
  SELECT 'n_rows', NULL, count(*)::VARCHAR, 'info' FROM docs
  UNION ALL SELECT 'n_columns', NULL, '7', 'info'
  UNION ALL SELECT 'duplicate_rows', NULL, sum(n - 1)::VARCHAR, CASE WHEN sum(n - 1) > 0 THEN 'warning' ELSE 'info' END
            FROM (SELECT count(*) AS n FROM docs GROUP BY {", ".join(c for c, _ in _FILE_COLUMNS)})
  UNION ALL SELECT 'missing_count', name, missing::VARCHAR, CASE WHEN missing / n > 0.4 THEN 'warning' ELSE 'info' END FROM gaps
  UNION ALL SELECT CASE WHEN dtype = 'string' THEN 'categorical_column' ELSE 'numerical_column' END, name, NULL, 'info'
            FROM gaps WHERE name <> 'quality'
  UNION ALL SELECT 'target_count', quality::VARCHAR, count(*)::VARCHAR, 'info' FROM docs GROUP BY quality
  UNION ALL SELECT 'warning', NULL, printf('The target has %d missing values (%.2f%%); these rows cannot be used for training.',
              missing, 100.0 * missing / n), 'warning' FROM gaps WHERE name = 'quality' AND missing > 0
  UNION ALL SELECT 'warning', NULL, 'Columns with a share of missing values above 0.4: ['
              || string_agg('''' || name || '''', ', ' ORDER BY position) || ']', 'warning'
            FROM gaps WHERE missing / n > 0.4 HAVING count(*) > 0),
tops AS (
  SELECT 'lang' AS key, lang AS v, count(*) AS n FROM docs GROUP BY lang
  UNION ALL SELECT 'source', source, count(*) FROM docs GROUP BY source),
summary AS (
  SELECT key, count(v) AS n_unique, arg_min(v, {{'n': -n, 'v': v}}) AS top_value, max(n) AS top_frequency,
    coalesce(sum(n) FILTER (v IS NULL), 0)::BIGINT AS n_missing FROM tops GROUP BY key),
found("table", key, name, value) AS (
  SELECT 'quality_table', "check", unnest(['column', 'value', 'severity']), unnest(["column", value, severity]) FROM report
  UNION ALL SELECT 'missing_values', name, 'missing_count', missing::VARCHAR FROM gaps WHERE missing > 0
  UNION ALL SELECT 'overview', name, unnest(['position', 'dtype', 'n_rows', 'n_columns']),
    unnest([position::VARCHAR, dtype, n::VARCHAR, '7']) FROM gaps
  UNION ALL SELECT 'categorical_summary', key, unnest(['n_unique', 'top_value', 'top_frequency', 'n_missing']),
    unnest([n_unique::VARCHAR, top_value, top_frequency::VARCHAR, n_missing::VARCHAR]) FROM summary
  UNION ALL SELECT 'target_distribution', quality::VARCHAR, 'n', count(*)::VARCHAR FROM docs GROUP BY quality)
SELECT * FROM found WHERE value IS NOT NULL""")

oracle("schema_typing", "WITH " + LINES + """
SELECT CAST(c.position AS BIGINT) AS position, c.name AS "column", c.dtype, (SELECT count(*) FROM lines) AS n_rows,
       CAST(10 AS BIGINT) AS n_columns, c.kind
FROM (VALUES (0, 'l_orderkey', 'bigint', 'numerical'), (1, 'l_linenumber', 'int', 'numerical'),
             (2, 'l_partkey', 'bigint', 'numerical'), (3, 'l_suppkey', 'bigint', 'numerical'),
             (4, 'l_quantity', 'double', 'numerical'), (5, 'l_extendedprice', 'double', 'numerical'),
             (6, 'l_discount', 'double', 'numerical'), (7, 'l_tax', 'double', 'numerical'),
             (8, 'l_returnflag', 'string', 'categorical'), (9, 'l_linestatus', 'string', 'categorical'))
     AS c(position, name, dtype, kind)""")

oracle("csv_typing", """
SELECT 'whole' AS "column", 'bigint' AS dtype, count(*) AS filled, round(sum(l_orderkey)::DOUBLE, 2) AS total FROM lineitem
UNION ALL SELECT 'decimal', 'double', count(*), round(sum(l_extendedprice), 2) FROM lineitem
UNION ALL SELECT 'gaps', 'bigint', count(*), round(sum(l_linenumber)::DOUBLE, 2) FROM lineitem WHERE l_linenumber <> 1
UNION ALL SELECT 'suffixed', 'string', count(*), NULL FROM lineitem
UNION ALL SELECT 'flag', 'boolean', count(*), NULL FROM lineitem
UNION ALL SELECT 'nothing', 'double', 0, NULL""")

# Splits. The order is md5('<seed>|<key>') ascending inside a class. Test sizes
# follow the largest remainder of the rows that stay.


def split_ctes(source: str, label: str, key: str, fraction: float, name: str = "parts",
               keep: str = "*", seed: int = 42) -> str:
    """CTEs that end in ``name`` with the column ``part`` (test or train)."""
    return f"""
{name}_classes AS (SELECT {label} AS c, count(*) AS n FROM {source} GROUP BY 1),
{name}_draw AS (
  SELECT c, n, stay * n / total AS exact, CAST(floor(stay * n / total) AS BIGINT) AS base, stay
  FROM (SELECT c, n, sum(n) OVER () AS total,
               sum(n) OVER () - CAST(ceil({fraction} * sum(n) OVER () - 1e-9) AS BIGINT) AS stay
        FROM {name}_classes)),
{name}_sizes AS (
  SELECT c, n - base - CASE WHEN row_number() OVER (ORDER BY base - exact, c) <= stay - sum(base) OVER ()
                            THEN 1 ELSE 0 END AS n_test
  FROM {name}_draw),
{name}_ranked AS (
  SELECT {keep}, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}|' || {key}), {key}) AS rn
  FROM {source}),
{name} AS (
  SELECT r.* EXCLUDE (rn), CASE WHEN r.rn <= s.n_test THEN 'test' ELSE 'train' END AS part
  FROM {name}_ranked r JOIN {name}_sizes s ON r.{label} = s.c)"""


oracle("unseen_categories", f"""WITH base AS (SELECT doc_id, lang, source || '-' || lang AS origin FROM documents),
{split_ctes('base', 'lang', 'doc_id', 0.6)},
pairs AS (SELECT part, 'lang' AS "column", lang AS value FROM parts UNION SELECT part, 'origin', origin FROM parts)
SELECT "column", value FROM pairs WHERE part = 'test'
EXCEPT SELECT "column", value FROM pairs WHERE part = 'train'""")

# Profiling

oracle("numeric_summary", f"WITH {LINES} " + union(f"""
SELECT '{{c}}' AS "column", count({{c}}) AS n, {dbl('avg({c})', 4)} AS mean, {dbl('stddev_samp({c})', 4)} AS std,
       {dbl('min({c})', 4)} AS min, {dbl('quantile_cont({c}, 0.25)', 4)} AS p25,
       {dbl('quantile_cont({c}, 0.5)', 4)} AS p50, {dbl('quantile_cont({c}, 0.75)', 4)} AS p75,
       {dbl('max({c})', 4)} AS max FROM lines""", LINE_NUMBERS))
_COUNTS = "counts AS (" + union(
    "SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM lines GROUP BY {c}",
    ("l_suppkey", "l_returnflag", "l_linestatus")) + ")"
oracle("categorical_summary", f"""WITH {LINES}, {_COUNTS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS FIRST) AS r FROM counts
           WHERE "column" <> 'l_suppkey')
SELECT "column", count(value) AS n_unique, max(CASE WHEN r = 1 THEN value END) AS top_value,
       max(n) AS top_frequency, CAST(coalesce(sum(CASE WHEN value IS NULL THEN n END), 0) AS BIGINT) AS n_missing
FROM ranked GROUP BY 1""")
oracle("category_shares", f"""WITH {LINES}, {_COUNTS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank,
                  count(*) OVER (PARTITION BY "column") AS n_unique,
                  sum(n) OVER (PARTITION BY "column") AS filled FROM counts WHERE value IS NOT NULL)
SELECT "column", n_unique, rank, value, n, {dbl('n / filled')} AS share FROM ranked WHERE rank <= 5""")


def histogram_sql(source: str, columns, bins: int, name: str, digits: int) -> str:
    edges = union(f"""
  SELECT '{{c}}' AS name, b, lo + b * ((hi - lo) / {bins}.0) AS lower,
         CASE WHEN b = {bins - 1} THEN hi ELSE lo + (b + 1) * ((hi - lo) / {bins}.0) END AS upper
  FROM (SELECT min({{c}}) AS lo, max({{c}}) AS hi FROM {source}), range({bins}) t(b)""", columns)
    values = union(f"SELECT '{{c}}' AS name, {{c}} AS v, count(*) AS k FROM {source} GROUP BY {{c}}", columns)
    return f"""edges AS ({edges}), vals AS ({values})
SELECT e.name AS "{name}", CAST(e.b AS BIGINT) AS bin, {dbl('e.lower', digits)} AS lower,
       {dbl('e.upper', digits)} AS upper, CAST(coalesce(sum(v.k), 0) AS BIGINT) AS n
FROM edges e LEFT JOIN vals v
  ON v.name = e.name AND v.v >= e.lower AND (v.v < e.upper OR (e.b = {bins - 1} AND v.v = e.upper))
GROUP BY e.name, e.b, e.lower, e.upper"""


oracle("histogram30", f"WITH {LINES}, " + histogram_sql("lines", LINE_NUMBERS, 30, "column", 4))


def _wide(i: int) -> str:
    return (f"CASE WHEN l_partkey % {i + 5} <> 0 THEN {i % 7}.0::DOUBLE * l_quantity + {(i % 5 - 2) / 1000}::DOUBLE * l_extendedprice"
            f" + {100 * (i % 3)}.0::DOUBLE * l_discount + {50 * (i % 4 - 1)}.0::DOUBLE * l_tax + l_partkey % {i + 3} END AS w{i}")


oracle("correlation_wide", f"""
WITH wide AS (SELECT {', '.join(_wide(i) for i in range(48))} FROM lineitem),
pairs AS (SELECT {', '.join(f'corr(w{i}, w{j}) AS r{i}_{j}' for i in range(48) for j in range(i, 48))} FROM wide),
cells AS (SELECT unnest([{', '.join(f"{{'a': 'w{i}', 'b': 'w{j}', 'r': r{i}_{j}}}" for i in range(48) for j in range(i, 48))}]) AS c
          FROM pairs)
SELECT c.a AS column_a, c.b AS column_b, {dbl('c.r')} AS correlation FROM cells
UNION ALL SELECT c.b, c.a, {dbl('c.r')} FROM cells WHERE c.a <> c.b""")

oracle("category_dictionary", f"""
WITH {LINES}, train AS (SELECT * FROM lines WHERE l_partkey % 3 <> 0),
orders_known AS (
  SELECT v, row_number() OVER (ORDER BY v) - 1 AS slot FROM (SELECT DISTINCT l_orderkey::VARCHAR AS v FROM train)),
statuses AS (
  SELECT l_linestatus AS v, count(*) AS n, row_number() OVER (ORDER BY l_linestatus) - 1 AS slot
  FROM train WHERE l_linestatus IS NOT NULL GROUP BY 1),
sizes AS (SELECT (SELECT count(*) FROM orders_known) AS orders, (SELECT count(*) FROM statuses) AS kinds,
  (SELECT v FROM statuses ORDER BY n DESC, v LIMIT 1) AS mode, (SELECT median(l_quantity) FROM train) AS middle)
SELECT {LINE_KEYS}, 1 + orders + kinds AS n_features, {dbl('coalesce(l_quantity, middle)', 4)} AS quantity,
  concat_ws(',', '0', (1 + o.slot)::VARCHAR, (1 + orders + s.slot)::VARCHAR) AS slots
FROM lines, sizes LEFT JOIN orders_known o ON o.v = l_orderkey::VARCHAR
LEFT JOIN statuses s ON s.v = coalesce(l_linestatus, mode)""")

oracle("correlation", f"WITH {LINES} " + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {dbl(f'corr({a}, {b})')} AS correlation FROM lines"
    for a in LINE_NUMBERS for b in LINE_NUMBERS))

# Projection and splits

oracle("feature_projection", f"""WITH {APPLICANTS}
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, n_orders, round(total_price, 2) AS total_price,
       round(max_price, 2) AS max_price, last_status, CAST(target AS BIGINT) AS label FROM applicants""")
oracle("stratified_split", f"""WITH {APPLICANTS}, {split_ctes('applicants', 'target', 'c_custkey', 0.2)}
SELECT c_custkey, CAST(target AS BIGINT) AS target, part FROM parts""")
oracle("split_balance", f"""WITH {APPLICANTS}, {split_ctes('applicants', 'target', 'c_custkey', 0.2)}
SELECT part, CAST(target AS BIGINT) AS target, count(*) AS n,
       {dbl('count(*) / sum(count(*)) OVER (PARTITION BY part)')} AS share FROM parts GROUP BY part, target""")
oracle("orders_split", f"""WITH {split_ctes('orders', 'o_orderstatus', 'o_orderkey', 0.2)}
SELECT part, o_orderstatus, count(*) AS n,
       {dbl('count(*) / sum(count(*)) OVER (PARTITION BY part)')} AS share FROM parts GROUP BY part, o_orderstatus""")
_LABELLED = "labelled AS (SELECT doc_id, quality AS label FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL)"
# The second cut goes on in the same order, so ranks continue after the test rows.
oracle("three_way_split", f"""WITH {_LABELLED}, {split_ctes('labelled', 'label', 'doc_id', 0.2)},
classes AS (SELECT label AS c, count(*) AS n, count(*) FILTER (part = 'test') AS n_test FROM parts GROUP BY 1),
draw AS (
  SELECT c, n_test, remaining, stay * remaining / sum(remaining) OVER () AS exact,
         CAST(floor(stay * remaining / sum(remaining) OVER ()) AS BIGINT) AS base, stay
  FROM (SELECT c, n_test, n - n_test AS remaining,
               sum(n - n_test) OVER () - CAST(ceil(0.15 * sum(n) OVER () - 1e-9) AS BIGINT) AS stay FROM classes)),
sizes AS (
  SELECT c, n_test, remaining - base - CASE WHEN row_number() OVER (ORDER BY base - exact, c) <= stay - sum(base) OVER ()
                                            THEN 1 ELSE 0 END AS n_validation FROM draw),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || doc_id), doc_id) AS rn FROM labelled)
SELECT doc_id, CAST(label AS BIGINT) AS label,
       CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_validation THEN 'validation' ELSE 'train' END AS part
FROM ranked JOIN sizes ON label = c""")


def fold_ctes(source: str, label: str, key: str, k: int) -> str:
    """Folds: class sizes as dealt out in class order, filled along the md5 order of the class."""
    return f"""
dealt AS (SELECT {label} AS c, (row_number() OVER (ORDER BY {label}) - 1) % {k} AS f FROM {source}),
fold_ends AS (
  SELECT c, f, sum(count(*)) OVER (PARTITION BY c ORDER BY f) AS upto FROM dealt GROUP BY c, f),
fold_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('42|' || {key}), {key}) AS rn FROM {source}),
folded AS (
  SELECT r.* EXCLUDE (rn), min(e.f) AS fold FROM fold_ranked r JOIN fold_ends e ON r.{label} = e.c AND e.upto >= r.rn
  GROUP BY ALL)"""


oracle("kfold_assignment", f"""WITH {APPLICANTS}, slim AS (SELECT c_custkey, target FROM applicants),
{fold_ctes('slim', 'target', 'c_custkey', 5).replace('GROUP BY ALL', 'GROUP BY r.c_custkey, r.target')}
SELECT c_custkey, CAST(target AS BIGINT) AS target, CAST(fold AS BIGINT) AS fold FROM folded""")
oracle("kfold_sizes", f"""WITH {_LABELLED},
{fold_ctes('labelled', 'label', 'doc_id', 5).replace('GROUP BY ALL', 'GROUP BY r.doc_id, r.label')}
SELECT CAST(fold AS BIGINT) AS fold, CAST(label AS BIGINT) AS label, count(*) AS n FROM folded GROUP BY fold, label""")
oracle("seeded_sample", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice, o_orderdate, o_orderpriority
FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 500""")

# Preprocessing

_FILLS = {
    "impute_mean": ("l_quantity", "(SELECT avg(l_quantity) FROM lines)"),
    "impute_median": ("l_quantity", "(SELECT median(l_quantity) FROM lines)"),
    "impute_most_frequent": ("l_quantity", "(SELECT l_quantity FROM lines WHERE l_quantity IS NOT NULL "
                                           "GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"),
    "impute_constant": ("l_quantity", "0.0"),
    "impute_category_mode": ("l_linestatus", "(SELECT l_linestatus FROM lines WHERE l_linestatus IS NOT NULL "
                                             "GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"),
    "impute_category_constant": ("l_linestatus", "'missing_value'"),
}
for _name, (_column, _fill) in _FILLS.items():
    _value = f"coalesce({_column}, {_fill})"
    if _column == "l_quantity":
        _value = dbl(_value, 4)
    oracle(_name, f"WITH {LINES} SELECT {LINE_KEYS}, {_value} AS {_column} FROM lines")
oracle("scale_numeric", f"""WITH {LINES}, filled AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, """ + ", ".join(
    f"coalesce({c}, (SELECT median({c}) FROM lines)) AS {c}" for c in LINE_NUMBERS) + f""" FROM lines),
moments AS (SELECT """ + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in LINE_NUMBERS) + f""" FROM filled)
SELECT {LINE_KEYS}, """ + ", ".join(
    dbl(f"({c} - m_{c}) / s_{c}", 4) + f" AS {c}" for c in LINE_NUMBERS) + " FROM filled, moments")

_APPLICANT_PARTS = f"{APPLICANTS}, {split_ctes('applicants', 'target', 'c_custkey', 0.2)}"
_CATS = ("c_nationkey", "c_mktsegment", "last_status")
_ENCODED = f"""raw AS ({union("SELECT c_custkey, part, '{c}' AS name, CAST({c} AS VARCHAR) AS v FROM parts", _CATS)}),
fills AS (SELECT name, v AS fill FROM (
  SELECT name, v, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, v) AS r FROM raw
  WHERE part = 'train' AND v IS NOT NULL GROUP BY name, v) WHERE r = 1),
categories AS (SELECT name, v, row_number() OVER (PARTITION BY name ORDER BY v) - 1 AS position FROM (
  SELECT DISTINCT name, v FROM raw WHERE part = 'train' AND v IS NOT NULL)),
imputed AS (SELECT c_custkey, name, coalesce(v, fill) AS v FROM raw JOIN fills USING (name))"""
oracle("onehot_long", f"""WITH {_APPLICANT_PARTS}, {_ENCODED}
SELECT c_custkey, 'categorical__' || name || '_' || v AS transformed, CAST(1 AS DOUBLE) AS value
FROM imputed JOIN categories USING (name, v)""")
oracle("onehot_drop_first", f"""WITH {_APPLICANT_PARTS}, {_ENCODED}
SELECT c_custkey, 'categorical__' || name || '_' || v AS transformed, CAST(1 AS DOUBLE) AS value
FROM imputed JOIN categories USING (name, v) WHERE position > 0""")
oracle("ordinal_encode", f"""WITH {_APPLICANT_PARTS}, {_ENCODED},
sizes AS (SELECT name, count(*) AS size FROM categories GROUP BY name)
SELECT c_custkey, 'categorical__' || i.name AS transformed, CAST(coalesce(c.position, s.size) AS DOUBLE) AS value
FROM imputed i JOIN sizes s ON s.name = i.name LEFT JOIN categories c ON c.name = i.name AND c.v = i.v
WHERE coalesce(c.position, s.size) <> 0""")
oracle("feature_map", f"""WITH {_APPLICANT_PARTS}, {_ENCODED},
slots AS (
  SELECT 0 AS block, position, 'numerical__' || name AS transformed, name AS original
  FROM (VALUES (0, 'n_orders'), (1, 'total_price'), (2, 'max_price')) t(position, name)
  UNION ALL
  SELECT CASE name WHEN 'c_nationkey' THEN 1 WHEN 'c_mktsegment' THEN 2 ELSE 3 END, position,
         'categorical__' || name || '_' || v, name FROM categories)
SELECT row_number() OVER (ORDER BY block, position) - 1 AS slot, transformed, original FROM slots""")

# Class weights

oracle("class_ratio", f"""WITH {_LABELLED}
SELECT count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives,
       {dbl('count(*) FILTER (label = 0) / count(*) FILTER (label = 1)')} AS ratio FROM labelled""")
oracle("class_weights", f"""WITH t AS (SELECT toxic AS label FROM labels JOIN documents USING (doc_id)),
c AS (SELECT count(*) AS n, count(*) FILTER (label = 0) AS neg, count(*) FILTER (label = 1) AS pos FROM t)
SELECT 'balanced' AS strategy, CAST(0 AS DOUBLE) AS label, {dbl('n / (2.0 * neg)')} AS weight FROM c
UNION ALL SELECT 'balanced', 1, {dbl('n / (2.0 * pos)')} FROM c
UNION ALL SELECT 'scale_pos_weight', 0, 1 FROM c
UNION ALL SELECT 'scale_pos_weight', 1, {dbl('neg / pos')} FROM c""")

# Metrics

_CONF = """count(*) FILTER ({y} = 1 AND {p}) AS tp, count(*) FILTER ({y} = 0 AND {p}) AS fp,
count(*) FILTER ({y} = 0 AND NOT ({p})) AS tn, count(*) FILTER ({y} = 1 AND NOT ({p})) AS fn"""
_PRF = (f"{dbl('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END')} AS precision, "
        f"{dbl('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END')} AS recall, "
        f"{dbl('CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END')} AS f1")
oracle("confusion", f"WITH {SCORED} SELECT {_CONF.format(y='label', p='p0 >= 0.5')} FROM scored")
oracle("prf_metrics", f"""WITH {SCORED}, c AS (SELECT {_CONF.format(y='label', p='p0 >= 0.5')} FROM scored)
SELECT {_PRF} FROM c""")


def metric_ctes(source: str, group: str = "", label: str = "label", proba: str = "p") -> str:
    """CTEs that end in ``metrics``, by (optional) group."""
    g = f"{group}, " if group else ""
    by = f"PARTITION BY {group} " if group else ""
    per = f"GROUP BY {group}" if group else ""
    join = f"USING ({group})" if group else "ON true"
    return f"""
g AS (SELECT {g}{proba} AS s, CAST(sum({label}) AS DOUBLE) AS pos, CAST(sum(1 - {label}) AS DOUBLE) AS neg
      FROM {source} GROUP BY {g}{proba}),
r AS (SELECT *, sum(pos) OVER ({by}ORDER BY s DESC) AS tp_upto, sum(neg) OVER ({by}ORDER BY s DESC) AS fp_upto FROM g),
sums AS (
  SELECT {g}sum(pos) AS P, sum(neg) AS N, sum(pos * (fp_upto - neg / 2)) AS above,
         sum(pos * tp_upto / (tp_upto + fp_upto)) AS ap,
         sum(pos * (1 - s) * (1 - s) + neg * s * s) AS squares,
         sum(-pos * ln(greatest(least(s, 1 - 2.220446049250313e-16), 2.220446049250313e-16))
             - neg * ln(1 - greatest(least(s, 1 - 2.220446049250313e-16), 2.220446049250313e-16))) AS losses
  FROM r {per}),
c AS (SELECT {g}{_CONF.format(y=label, p=f'{proba} >= 0.5')} FROM {source} {per}),
metrics AS (
  SELECT {g}{_PRF},
         CASE WHEN P > 0 AND N > 0 THEN {dbl('1 - above / (P * N)')} END AS roc_auc,
         CASE WHEN P > 0 AND N > 0 THEN {dbl('ap / P')} END AS pr_auc,
         CASE WHEN P > 0 AND N > 0 THEN {dbl('squares / (P + N)')} END AS brier_score,
         CASE WHEN P > 0 AND N > 0 THEN {dbl('losses / (P + N)')} END AS log_loss, tp, fp, tn, fn
  FROM sums JOIN c {join})"""


_V1_METRICS = f"{SCORED}, {metric_ctes('scored', proba='p0')}"
for _name, _metric in (("roc_auc", "roc_auc"), ("average_precision", "pr_auc"),
                       ("brier", "brier_score"), ("log_loss", "log_loss")):
    oracle(_name, f"WITH {_V1_METRICS} SELECT {_metric} FROM metrics")
oracle("all_metrics", f"WITH {_V1_METRICS} SELECT * FROM metrics")
oracle("grouped_metrics", f"""WITH rows AS (
  SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         round((l_tax + l_discount) * 5, 4) AS p FROM lineitem),
{metric_ctes('rows', 'l_linestatus')} SELECT * FROM metrics""")
oracle("single_class_metrics", f"""WITH {SCORED}, one AS (SELECT * FROM scored WHERE label = 0),
{metric_ctes('one', proba='p0')} SELECT * FROM metrics""")
_POINTS = f"""{SCORED},
g AS (SELECT p0 AS s, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY p0),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
r AS (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
             lead(pos) OVER (ORDER BY s DESC) AS pos_next, lead(neg) OVER (ORDER BY s DESC) AS neg_next,
             row_number() OVER (ORDER BY s DESC) AS i FROM g)"""
_START = "SELECT NULL AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr UNION ALL "
oracle("roc_curve", f"""WITH {_POINTS}
{_START} SELECT round(s, 6), {dbl('fp / N')}, {dbl('tp / P')} FROM r, t""")
oracle("roc_curve_pruned", f"""WITH {_POINTS}
{_START} SELECT round(s, 6), {dbl('fp / N')}, {dbl('tp / P')} FROM r, t
WHERE i = 1 OR pos_next IS NULL OR pos_next <> pos OR neg_next <> neg""")
oracle("pr_curve", f"""WITH {_POINTS}
SELECT NULL AS threshold, CAST(1 AS DOUBLE) AS precision, CAST(0 AS DOUBLE) AS recall
UNION ALL SELECT round(s, 6), {dbl('tp / (tp + fp)')}, {dbl('tp / P')} FROM r, t""")

# Thresholds

_SWEEP = f"""{SCORED},
grid AS (SELECT round(k / 100.0, 2) AS threshold FROM range(1, 100) t(k)),
counts AS (
  SELECT threshold, {_CONF.format(y='label', p='p0 >= threshold')}
  FROM (SELECT p0, label, count(*) AS k FROM scored GROUP BY ALL), grid GROUP BY threshold),
sweep AS (SELECT CAST(threshold AS DOUBLE) AS threshold, {_PRF}, tp, fp, tn, fn FROM counts)"""
_SWEEP = _SWEEP.replace("count(*) FILTER", "FILTERED").replace(
    "GROUP BY ALL", "GROUP BY p0, label")
for _part, _cond in (("tp", "label = 1 AND p0 >= threshold"), ("fp", "label = 0 AND p0 >= threshold"),
                     ("tn", "label = 0 AND NOT (p0 >= threshold)"), ("fn", "label = 1 AND NOT (p0 >= threshold)")):
    _SWEEP = _SWEEP.replace(f"FILTERED ({_cond}) AS {_part}",
                            f"CAST(coalesce(sum(k) FILTER ({_cond}), 0) AS BIGINT) AS {_part}")
oracle("threshold_sweep", f"WITH {_SWEEP} SELECT * FROM sweep")
# Selections order by unrounded values.
_EXACT = """exact AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS xp, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS xr,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS xf FROM sweep)"""
_PICK = "threshold, '{s}' AS strategy, precision, recall, f1, tp, fp, tn, fn"
for _name, _strategy, _where, _order in (
    ("threshold_max_f1", "maximize_f1", "true", "xf DESC"),
    ("threshold_min_recall", "min_recall", "xr >= 0.8", "xp DESC"),
    ("threshold_min_precision", "min_precision", "xp >= 0.33", "xr DESC"),
    ("threshold_cost", "cost_based", "true", "1.0 * fp + 5.0 * fn"),
    ("threshold_youden", "youden_j", "true", "xr - CASE WHEN fp + tn = 0 THEN 0 ELSE fp / (fp + tn) END DESC"),
):
    oracle(_name, f"""WITH {_SWEEP}, {_EXACT}
SELECT {_PICK.format(s=_strategy)} FROM exact WHERE {_where} ORDER BY {_order}, threshold LIMIT 1""")
oracle("threshold_fixed", f"""WITH {SCORED}, c AS (SELECT {_CONF.format(y='label', p='p0 >= 0.425')} FROM scored)
SELECT CAST(0.425 AS DOUBLE) AS threshold, 'fixed' AS strategy, {_PRF}, tp, fp, tn, fn FROM c""")
oracle("apply_threshold", f"""WITH {SCORED}
SELECT CAST(label AS BIGINT) AS label, CAST(p1 >= 0.29 AS BIGINT) AS prediction, count(*) AS n
FROM scored GROUP BY label, p1 >= 0.29""")
oracle("threshold_tradeoff", f"""WITH {_SWEEP}
SELECT threshold, precision, recall, f1,
       CAST(row_number() OVER (ORDER BY abs(threshold - 0.304), threshold) = 1 AS BIGINT) AS selected FROM sweep""")

# Calibration

_STAGES = f"""{SCORED},
stages AS (SELECT 'before' AS stage, label, p0 AS p FROM scored UNION ALL SELECT 'after', label, p1 FROM scored)"""
_METRIC_NAMES = ("precision", "recall", "f1", "roc_auc", "pr_auc", "brier_score", "log_loss")
_RAW_METRICS = metric_ctes("stages", "stage").replace("round(", "(").replace("AS DOUBLE), 6)", "AS DOUBLE))")
oracle("calibration_compare", f"""WITH {_STAGES}, {_RAW_METRICS}
SELECT """ + ", ".join(f"round(b.{m}, 6) AS before_{m}, round(a.{m}, 6) AS after_{m}" for m in _METRIC_NAMES) + """,
  round(a.brier_score - b.brier_score, 6) AS brier_score_delta, round(a.log_loss - b.log_loss, 6) AS log_loss_delta,
  round(a.roc_auc - b.roc_auc, 6) AS roc_auc_delta
FROM (SELECT * FROM metrics WHERE stage = 'before') b, (SELECT * FROM metrics WHERE stage = 'after') a""")
oracle("reliability_curve", f"""WITH {_STAGES}
SELECT stage, CAST({' + '.join(f'CAST(p > {i} * CAST(0.1 AS DOUBLE) AS INT)' for i in range(1, 10))} AS BIGINT) AS bin,
       count(*) AS n, {dbl('avg(p)')} AS mean_predicted, {dbl('avg(label)')} AS observed
FROM stages GROUP BY 1, 2""")
oracle("probability_histogram", f"""WITH {SCORED}, pair AS (SELECT p0 AS before, p1 AS after FROM scored),
{histogram_sql('pair', ('before', 'after'), 20, 'stage', 6)}""")
# Isotonic fit at i: the largest over j <= i of the smallest over k >= i of the mean of j..k.
oracle("isotonic", f"""WITH {SCORED},
g AS (SELECT p0, count(*) AS n, sum(label) AS y, row_number() OVER (ORDER BY p0) AS i FROM scored GROUP BY p0),
c AS (SELECT *, sum(n) OVER (ORDER BY i) AS cn, sum(y) OVER (ORDER BY i) AS cy FROM g),
spans AS (SELECT a.i AS j, b.i AS k, (b.cy - a.cy + a.y) / (b.cn - a.cn + a.n) AS mean FROM c a JOIN c b ON b.i >= a.i),
lowest AS (SELECT j, k AS i, min(mean) OVER (PARTITION BY j ORDER BY k DESC) AS m FROM spans),
fit AS (SELECT i, max(m) AS v FROM lowest GROUP BY i)
SELECT round(p0, 6) AS p0, n, {dbl('v')} AS p_calibrated FROM c JOIN fit USING (i)""")
oracle("isotonic_ranges", f"""
WITH RECURSIVE summed AS (
  SELECT l_extendedprice AS score, avg(CAST(l_quantity > 25 AS INT)) AS y, count(*)::DOUBLE AS w FROM lineitem GROUP BY 1),
ordered AS (SELECT row_number() OVER (ORDER BY score) AS i, score, y, w FROM summed),
-- The lower convex hull of the cumulated labels: its slopes are the fit.
sums AS (
  SELECT i, score, sum(w) OVER (ORDER BY i) AS x, sum(y * w) OVER (ORDER BY i) AS s FROM ordered
  UNION ALL SELECT 0, NULL, 0, 0),
hull AS (
  SELECT 0::BIGINT AS i, 0::DOUBLE AS x, 0::DOUBLE AS s, NULL::DOUBLE AS y
  UNION ALL
  SELECT n.best.i, n.best.x, n.best.s, n.best.slope FROM (
    SELECT arg_min({{'i': p.i, 'x': p.x, 's': p.s, 'slope': (p.s - h.s) / (p.x - h.x)}},
      {{'a': round((p.s - h.s) / (p.x - h.x), 12), 'b': -p.i}}) AS best
    FROM hull h JOIN sums p ON p.i > h.i GROUP BY h.i) n),
blocks AS (SELECT y, i, x - lag(x) OVER (ORDER BY i) AS w, lag(i) OVER (ORDER BY i) + 1 AS first FROM hull)
SELECT {dbl('a.score', 5)} AS lo, {dbl('b.score', 5)} AS hi, {dbl('k.y', 5)} AS y, {dbl('k.w', 5)} AS w
FROM blocks k JOIN ordered a ON a.i = k.first JOIN ordered b ON b.i = k.i""")

oracle("platt_gradient", f"""WITH {SCORED}
SELECT CAST(0 AS DOUBLE) AS intercept_gradient, CAST(0 AS DOUBLE) AS slope_gradient, count(*) AS n FROM scored""")

# Models: what can be stated without fitting them

_TRAIN = f"""{DOCS}, labelled AS (SELECT doc_id, quality AS label FROM docs WHERE quality IS NOT NULL),
{split_ctes('labelled', 'label', 'doc_id', 0.2)},
train AS (SELECT f.*, p.label FROM features f JOIN parts p USING (doc_id) WHERE p.part = 'train')"""
oracle("lr_gradient", f"""WITH {_TRAIN}
SELECT 'numerical__' || name AS transformed, CAST(0 AS DOUBLE) AS gradient
FROM (VALUES ('n_chars'), ('letter_share'), ('distinct_share')) t(name)
UNION ALL SELECT DISTINCT 'categorical__lang_' || lang, 0 FROM train
UNION ALL SELECT DISTINCT 'categorical__source_' || source, 0 FROM train""")
oracle("oof_coverage", f"""WITH {_TRAIN}, slim AS (SELECT doc_id, label FROM train),
{fold_ctes('slim', 'label', 'doc_id', 3).replace('GROUP BY ALL', 'GROUP BY r.doc_id, r.label')}
SELECT doc_id, CAST(fold AS BIGINT) AS fold, CAST(label AS BIGINT) AS label, CAST(1 AS BIGINT) AS scored FROM folded""")
for _name in ("shap_additivity", "stream_parity", "reload_parity"):
    oracle(_name, "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_apart FROM documents")

_PLATT_STEP = "1 / (1 + exp(-(a * x + b)))"
oracle("platt", f"""WITH RECURSIVE {SCORED},
grouped AS (SELECT p0 AS x, sum(label)::DOUBLE AS pos, (count(*) - sum(label))::DOUBLE AS neg FROM scored GROUP BY p0),
totals AS (SELECT sum(pos) AS P, sum(neg) AS N FROM grouped),
points AS (SELECT x, pos + neg AS n, pos * (P + 1) / (P + 2) + neg / (N + 2) AS k FROM grouped, totals),
newton AS (
  SELECT 0 AS step, 0::DOUBLE AS a, 0::DOUBLE AS b
  UNION ALL
  SELECT step + 1, a + (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b + (haa * gb - hab * ga) / (haa * hbb - hab * hab)
  FROM (
    SELECT step, a, b, sum(x * (k - n * p)) AS ga, sum(k - n * p) AS gb, sum(n * p * (1 - p) * x * x) AS haa,
      sum(n * p * (1 - p) * x) AS hab, sum(n * p * (1 - p)) AS hbb
    FROM (SELECT step, a, b, x, k, n, {_PLATT_STEP} AS p FROM newton, points WHERE step < 20) GROUP BY step, a, b))
SELECT {dbl('x')} AS p0, (pos + neg)::BIGINT AS n, {dbl(_PLATT_STEP)} AS p_calibrated
FROM grouped, (SELECT a, b FROM newton ORDER BY step DESC LIMIT 1)""")

_TEST = _TRAIN.replace("p.part = 'train'", "p.part = 'test'").replace("train AS (", "test AS (")
oracle("holdout_rows", f"""WITH {_TRAIN}, slim AS (SELECT doc_id, label FROM train),
{split_ctes('slim', 'label', 'doc_id', 0.25, 'held')}
SELECT doc_id, label::BIGINT AS label, 0::BIGINT AS unscored FROM held WHERE part = 'test'""")
oracle("cv_recounted", f"""WITH {_TRAIN}, slim AS (SELECT doc_id, label FROM train),
{fold_ctes('slim', 'label', 'doc_id', 3).replace('GROUP BY ALL', 'GROUP BY r.doc_id, r.label')}
SELECT fold::BIGINT AS fold, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
  0::BIGINT AS area_apart, 0::BIGINT AS brier_apart FROM folded GROUP BY fold""")
oracle("search_recounted", f"""WITH {_TRAIN}
SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives, 3::BIGINT AS n_candidates,
  3::BIGINT AS n_distinct, 0::BIGINT AS better, 0::BIGINT AS score_apart FROM train""")
oracle("final_test_recounted", f"""WITH {_TEST}
SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives, 0::BIGINT AS counts_apart,
  0::BIGINT AS area_apart, 0::BIGINT AS brier_apart FROM test""")
for _name in ("score_batch_rows", "score_stream_rows"):
    oracle(_name, """
SELECT doc_id, 'v1' AS model_version, 0::BIGINT AS decision_apart, 0::BIGINT AS label_apart FROM documents""")
for _name in ("explained_rows", "explained_stream_rows"):
    oracle(_name, """
SELECT doc_id, unnest(range(1, 4)) AS rank, 0::BIGINT AS unordered, 0::BIGINT AS sign_apart, 0::BIGINT AS value_apart
FROM documents""")
oracle("importance_recounted", f"""
SELECT unnest(['n_chars', 'letter_share', 'distinct_share', 'lang', 'source']) AS feature, 0::BIGINT AS apart
FROM (SELECT count(*) FROM documents)""")
oracle("calibrated_rows", """
SELECT unnest(['sigmoid', 'isotonic']) AS method, n, 0::BIGINT AS n_falling, 0::BIGINT AS n_outside
FROM (SELECT count(*) AS n FROM documents)""")
oracle("stream_registry", """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS model_version, doc_id % 2 AS batch_id FROM documents""")
