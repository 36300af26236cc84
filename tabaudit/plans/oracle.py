"""For each registered query, the same question in ANSI SQL over the test tables."""

from __future__ import annotations

# -- building blocks ---------------------------------------------------------

DIRTY = """
SELECT c_custkey,
       CASE WHEN c_custkey % 7 = 0 THEN '?' WHEN c_custkey % 11 = 0 THEN ' ?'
            WHEN c_custkey % 13 = 0 THEN NULL ELSE ' ' || c_mktsegment || '..' END AS seg_raw,
       CASE WHEN c_acctbal > 5000 THEN CASE WHEN c_custkey % 2 = 0 THEN ' >50K.' ELSE '>50K' END
            ELSE CASE WHEN c_custkey % 2 = 0 THEN '<=50K.' ELSE '<=50K' END END AS label_raw,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END AS bal_null,
       c_nationkey
FROM customer"""

COSTLY = "CAST(o_totalprice / 10000 + ((o_orderkey * 31) % 21 - 10) > 25 AS INTEGER)"

SCORED = f"""
SELECT o_orderkey AS row_id, o_custkey AS custkey, o_orderstatus AS sex, o_orderkey % 103 AS age,
       {COSTLY} AS y_true,
       CAST(o_totalprice >= 250000 AS INTEGER) AS y_pred,
       o_totalprice / 500000 AS y_proba
FROM orders"""

BINNED_NAMES = ("price_bin", "priority", "status", "key_mod")

BINNED = f"""
SELECT o_orderkey AS row_id, floor(o_totalprice / 10000) AS price_bin,
       CAST(o_orderpriority[1:1] AS DOUBLE) AS priority,
       CASE o_orderstatus WHEN 'F' THEN 0.0::DOUBLE WHEN 'O' THEN 1.0 ELSE 2.0 END AS status,
       CAST(o_orderkey % 7 AS DOUBLE) AS key_mod, {COSTLY} AS label
FROM orders"""

# One row per order and feature, with the order's place in the split.
BINNED_ROWS = f"""
long_rows AS (
  SELECT row_id, placed.label AS label, part, fold, unnest(range({len(BINNED_NAMES)}))::INTEGER AS feature,
         unnest([{', '.join(BINNED_NAMES)}]) AS value
  FROM ({BINNED}) AS b JOIN placed USING (row_id))"""

# Scores of called(model, part, fold, label, yes), and their mean and deviation over folds.
FOLD_SCORES = """
hits AS (SELECT model, part, fold, count(*) FILTER (yes AND label = 1)::DOUBLE AS tp,
                count(*) FILTER (yes AND label = 0)::DOUBLE AS fp,
                count(*) FILTER (NOT yes AND label = 1)::DOUBLE AS fn,
                count(*) FILTER (NOT yes AND label = 0)::DOUBLE AS tn FROM called GROUP BY ALL),
f1s AS (SELECT model, part, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
               (2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2 AS f1 FROM hits),
ranked AS (SELECT model, avg(f1) FILTER (part = 'train') AS f1_cv,
                  stddev_pop(f1) FILTER (part = 'train') AS f1_cv_std,
                  max(f1) FILTER (part = 'test') AS f1_test,
                  max(accuracy) FILTER (part = 'test') AS accuracy FROM f1s GROUP BY model)"""

AGE_GROUP = """CASE WHEN age > 0 AND age <= 25 THEN '<25' WHEN age > 25 AND age <= 35 THEN '25-35'
     WHEN age > 35 AND age <= 45 THEN '35-45' WHEN age > 45 AND age <= 55 THEN '45-55'
     WHEN age > 55 AND age <= 100 THEN '>55' END"""

ORDER_GROUPS = f"""
WITH scored AS ({SCORED}),
wide AS (
  SELECT scored.*, r_name AS race FROM scored
  JOIN customer ON custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
member AS (
  SELECT 'sex' AS dimension, sex AS "group", y_true, y_pred, y_proba FROM wide
  UNION ALL SELECT 'race', race, y_true, y_pred, y_proba FROM wide
  UNION ALL SELECT 'age', {AGE_GROUP}, y_true, y_pred, y_proba FROM wide)"""

DOC_SCORED = """
SELECT documents.doc_id AS row_id, lang || '/' || source AS origin, quality AS y_true,
       CAST(n_chars >= 1000 AS INTEGER) AS y_pred,
       least(n_chars, 4000) / 4000 AS y_proba
FROM documents JOIN labels ON documents.doc_id = labels.doc_id"""

DOC_GROUPS = f"""
WITH scored AS ({DOC_SCORED}),
member AS (
  SELECT 'origin' AS dimension, origin AS "group", y_true, y_pred, y_proba FROM scored)"""

FEATURES = f"""
SELECT o_orderkey AS row_id, o_totalprice, c_acctbal,
       coalesce(n_items, 0) AS n_items, coalesce(qty_sum, 0) AS qty_sum,
       coalesce(disc_avg, 0) AS disc_avg,
       o_orderstatus, o_orderpriority, c_mktsegment, r_name,
       {COSTLY} AS label
FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n_items, sum(l_quantity) AS qty_sum,
                  avg(l_discount) AS disc_avg FROM lineitem GROUP BY l_orderkey) lines
  ON o_orderkey = l_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""

NUMS = ["o_totalprice", "c_acctbal", "n_items", "qty_sum", "disc_avg"]
CATS = ["o_orderstatus", "o_orderpriority", "c_mktsegment", "r_name"]


def rnd(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def ratio(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / nullif({bottom}, 0))"


def null_sentinel(col: str) -> str:
    return f"CASE WHEN {col} IN ('?', ' ?') THEN NULL ELSE {col} END"


def clean(col: str) -> str:
    return f"coalesce(rtrim(trim({col}), '.'), 'nan')"


CELLS = """count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn,
       count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
       count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn,
       count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp"""

ACCURACY = ratio("tn + tp", "tn + fp + fn + tp")
F1_POS = f"coalesce({ratio('2 * tp', '2 * tp + fp + fn')}, 0)"
F1_NEG = f"coalesce({ratio('2 * tn', '2 * tn + fp + fn')}, 0)"
F1_MACRO = f"""(CASE WHEN tp + fp + fn = 0 THEN {F1_NEG} WHEN tn + fp + fn = 0 THEN {F1_POS}
     ELSE ({F1_NEG} + {F1_POS}) / 2 END)"""


def auc_by(table: str, keys: str) -> str:
    """Rank sum AUC per key from counts of equal scores."""
    return f"""
  SELECT {keys}, sum(CAST(p AS DOUBLE) * (below + n / 2)) / nullif(CAST(sum(p) AS DOUBLE) * sum(n), 0) AS auc,
         sum(p) AS n_pos, sum(n) AS n_neg
  FROM (SELECT {keys}, p, n, sum(n) OVER (PARTITION BY {keys} ORDER BY s) - n AS below
        FROM (SELECT {keys}, y_proba AS s, count(*) FILTER (y_true = 1) AS p,
                     count(*) FILTER (y_true = 0) AS n
              FROM {table} GROUP BY {keys}, s) AS equal_scores) AS ranked
  GROUP BY {keys}"""


GROUP_COUNTS = f"""
counts AS (SELECT dimension, "group", {CELLS} FROM member
           WHERE "group" IS NOT NULL GROUP BY dimension, "group" HAVING count(*) >= 10)"""

GROUP_METRICS = f"""
       {big('tn + fp + fn + tp')} AS n_samples, {rnd(ACCURACY)} AS accuracy,
       {rnd(F1_MACRO)} AS f1_macro, {rnd(F1_POS)} AS f1_binary,
       {rnd(ratio('tp + fp', 'tn + fp + fn + tp'))} AS positive_rate,
       {rnd(ratio('tp + fn', 'tn + fp + fn + tp'))} AS true_positive_rate"""


def split_of(table: str, folds: int = 5) -> str:
    """CTEs from ``base(row_id, label)`` to ``placed(row_id, label, part, fold)``.

    The test part takes each class's quota in hash order. Training rows are cut
    into folds whose sizes follow from dealing out the sorted classes in turn.
    """
    return f"""
base AS ({table}),
hashed AS (SELECT row_id, label, row_number() OVER
             (PARTITION BY label ORDER BY md5('42|' || CAST(row_id AS VARCHAR))) AS r FROM base),
sizes AS (SELECT label, count(*) AS n_c, sum(count(*)) OVER () AS n,
                 CAST(ceil(CAST(0.2 AS DOUBLE) * CAST(sum(count(*)) OVER () AS DOUBLE)) AS BIGINT) AS t
          FROM base GROUP BY label),
shares AS (SELECT label, n_c, t, n_c * t // n AS q,
                  row_number() OVER (ORDER BY n_c * t % n DESC, label) AS place,
                  t - sum(n_c * t // n) OVER () AS left_over FROM sizes),
quotas AS (SELECT label, n_c, q + CASE WHEN place <= left_over THEN 1 ELSE 0 END AS q FROM shares),
starts AS (SELECT label, q, n_c - q AS m,
                  sum(n_c - q) OVER (ORDER BY label) - (n_c - q) AS s FROM quotas),
blocks AS (SELECT label, i, ((s + m - i + {folds - 1}) // {folds}) - ((s - i + {folds - 1}) // {folds}) AS size
           FROM starts, (SELECT unnest(range({folds})) AS i) AS f),
ends AS (SELECT label, i, sum(size) OVER (PARTITION BY label ORDER BY i) AS upto FROM blocks),
placed AS (SELECT row_id, hashed.label AS label,
                  CASE WHEN r <= q THEN 'test' ELSE 'train' END AS part,
                  CASE WHEN r > q THEN (SELECT count(*) FROM ends
                       WHERE ends.label = hashed.label AND ends.upto < r - q) END AS fold
           FROM hashed JOIN quotas ON hashed.label = quotas.label)"""


def best_cuts(name: str, rows: str) -> str:
    """CTEs to ``name``: the cut of ``rows(grp, feature, value, label)`` that explains most, per group."""
    return f"""
{name}_counts AS (SELECT grp, feature, value, count(*) AS n, sum(2 * label - 1) AS s FROM {rows} GROUP BY ALL),
{name}_cuts AS (
  SELECT grp, feature, (value + lead(value) OVER o) / 2 AS threshold,
         sum(n) OVER o AS nl, sum(s) OVER o AS sl, sum(n) OVER p AS n, sum(s) OVER p AS s
  FROM {name}_counts
  WINDOW o AS (PARTITION BY grp, feature ORDER BY value), p AS (PARTITION BY grp, feature)),
{name} AS (
  SELECT grp, feature, threshold, {big('nl')} AS n_left, {big('n - nl')} AS n_right,
         sl / nl::DOUBLE AS left_value, (s - sl) / (n - nl)::DOUBLE AS right_value,
         (sl * sl / nl::DOUBLE + (s - sl) * (s - sl) / (n - nl)::DOUBLE - s * s / n::DOUBLE) / n AS gain
  FROM {name}_cuts WHERE threshold IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY grp ORDER BY gain DESC, feature, threshold) = 1)"""


def summary_of(table: str, cols: list[str], section: bool = False) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"""SELECT '{c}' AS "column", count({c}) AS "count", {rnd(f'avg({c})')} AS mean,
       {rnd(f'stddev_samp({c})')} AS std, {rnd(f'min({c})')} AS min,
       {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)')} AS q25,
       {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS q50,
       {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)')} AS q75,
       {rnd(f'max({c})')} AS max FROM {table}"""
        )
    return "\nUNION ALL\n".join(parts)


def top_of(table: str, cols: list[str], k: int = 10) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, {c} ASC NULLS LAST) AS INTEGER) AS rank
       FROM {table} GROUP BY {c} QUALIFY rank <= {k}"""
        for c in cols
    ]
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


def rows(*entries: str) -> str:
    return "\nUNION ALL\n".join(entries)


def not_null_failures(table: str, key: str, cols: list[str]) -> str:
    return rows(
        *[
            f"SELECT {key} AS row_id, '{c}' AS \"column\", 'not_nullable' AS \"check\", "
            f"CAST(NULL AS VARCHAR) AS failure_case FROM {table} WHERE {c} IS NULL"
            for c in cols
        ]
    )


def double_text(col: str) -> str:
    """A double as text, always with a decimal point."""
    whole = f"CAST(CAST({col} AS BIGINT) AS VARCHAR) || '.0'"
    return f"CASE WHEN {col} = floor({col}) THEN {whole} ELSE CAST({col} AS VARCHAR) END"


def value_failures(
    table: str, key: str, col: str, check: str, holds: str, text: str | None = None
) -> str:
    return (
        f"SELECT {key} AS row_id, '{col}' AS \"column\", '{check}' AS \"check\", "
        f"{text or col} AS failure_case FROM {table} WHERE NOT ({holds})"
    )


def rule_count(table: str, rule: str, fails: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, count(*) FILTER ({fails}) AS n_failed, "
        f"count(*) FILTER ({fails}) = 0 AS success FROM {table}"
    )


def scaled(cols: list[str], stats: str) -> str:
    return ", ".join(
        f"{rnd(f'({c} - (SELECT avg({c}) FROM {stats})) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM {stats})')} AS {c}"
        for c in cols
    )


def code_ctes(cols: list[str], fitted: str) -> str:
    return ",\n".join(
        f"codes_{c} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS code "
        f"FROM (SELECT DISTINCT {c} FROM {fitted} WHERE {c} IS NOT NULL) AS d)"
        for c in cols
    )


def code_joins(cols: list[str], table: str) -> str:
    return " ".join(f"LEFT JOIN codes_{c} ON {table}.{c} = codes_{c}.v" for c in cols)


def coded(cols: list[str]) -> str:
    return ", ".join(f"coalesce(codes_{c}.code, -1.0::DOUBLE) AS {c}" for c in cols)


LINE_NUMS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]
CORR_COLS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def decile_rows() -> str:
    return rows(
        *[
            f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, "
            f"{rnd(f'quantile_cont({c}, {p})')} AS value FROM lineitem"
            for c in ("l_extendedprice", "l_discount")
            for p in (0.1, 0.5, 0.9, 0.99)
        ]
    )


def sketch_bound_rows() -> str:
    slack = 2 * 2.296 / 1000**0.9723
    return rows(
        *[
            f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, count({c}) AS n, "
            f"{rnd(f'quantile_cont({c}, {round(p - slack, 6)})')} AS low, "
            f"{rnd(f'quantile_cont({c}, {round(p + slack, 6)})')} AS high, true AS inside FROM lineitem"
            for c in ("l_extendedprice", "l_quantity")
            for p in (0.1, 0.25, 0.5, 0.9)
        ]
    )


BROKEN = """
SELECT CASE WHEN c_custkey % 19 = 0 THEN line || ',more'
            WHEN c_custkey % 23 = 0 THEN c_custkey || ',' || c_name ELSE line END AS raw,
       CASE WHEN c_custkey % 19 = 0 OR c_custkey % 23 = 0 THEN 'fields'
            WHEN c_custkey % 17 = 0 THEN 'value of c_nationkey' END AS reason
FROM (SELECT *, c_custkey || ',' || c_name || ',' ||
             CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE CAST(c_nationkey AS VARCHAR) END AS line
      FROM customer) AS l"""


def report_rows() -> str:
    def line(
        section: str, column: str, statistic: str, value: str, table: str = "d", is_null: str = "false"
    ) -> str:
        return (
            f"SELECT '{section}' AS section, {column} AS \"column\", {statistic} AS statistic, "
            f"{is_null} AS is_null, {rnd(value)} AS value FROM {table}"
        )

    parts = []
    for col, check, fails in (
        ("seg_raw", "not_nullable", "seg_raw IS NULL"),
        ("label_raw", "not_nullable", "label_raw IS NULL"),
        ("label_raw", "isin(>50K, <=50K)", "label_raw NOT IN ('>50K', '<=50K')"),
        ("bal_null", "not_nullable", "bal_null IS NULL"),
        ("bal_null", "in_range(0, 9000)", "bal_null NOT BETWEEN 0 AND 9000"),
    ):
        parts.append(line("rules", f"'{col}'", f"'{check}'", f"count(*) FILTER ({fails})"))
    # The key takes no part in the profile, but a rule may speak of it.
    parts.append(line("rules", "'c_custkey'", "'not_nullable'", "count(*) FILTER (c_custkey IS NULL)"))
    for col, dtype in (
        ("seg_raw", "string"),
        ("label_raw", "string"),
        ("bal_null", "double"),
        ("c_nationkey", "int"),
    ):
        parts.append(line("null_counts", f"'{col}'", "'nulls'", f"count(*) FILTER ({col} IS NULL)"))
        parts.append(line("dtypes", f"'{col}'", f"'{dtype}'", "count(*) * 0 + 1"))
    parts.append(
        line(
            "duplicates", "CAST(NULL AS VARCHAR)", "'count'", "sum(n - 1)",
            "(SELECT count(*) AS n FROM d GROUP BY seg_raw, label_raw, bal_null, c_nationkey) AS g",
        )
    )
    for col in ("bal_null", "c_nationkey"):
        for stat, expr in (
            ("count", f"count({col})"),
            ("mean", f"avg({col})"),
            ("std", f"stddev_samp({col})"),
            ("min", f"min({col})"),
            ("q25", f"quantile_cont(CAST({col} AS DOUBLE), 0.25)"),
            ("q50", f"quantile_cont(CAST({col} AS DOUBLE), 0.5)"),
            ("q75", f"quantile_cont(CAST({col} AS DOUBLE), 0.75)"),
            ("max", f"max({col})"),
        ):
            parts.append(line("numeric_summary", f"'{col}'", f"'{stat}'", expr))
    parts.append(
        line(
            "categorical_distribution", '"column"', "value", "n",
            f"({top_of('d', ['seg_raw', 'label_raw'])}) AS t", "value IS NULL",
        )
    )
    return f"WITH d AS ({DIRTY})\n" + rows(*parts)


ORDER_LABELS = "SELECT o_orderkey AS row_id, o_orderstatus AS label FROM orders"
SCORED_LABELS = f"SELECT row_id, y_true AS label FROM ({SCORED}) AS v"
SPLIT_SCORED = f"""
WITH scored AS ({SCORED}), {split_of(SCORED_LABELS)},
joined AS (SELECT y_true, y_pred, part, fold FROM scored JOIN placed ON scored.row_id = placed.row_id)"""


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["csv_roundtrip"] = DIRTY
    sql["csv_quarantine"] = f"SELECT raw, reason FROM ({BROKEN}) AS b WHERE reason IS NOT NULL"
    sql["csv_quarantine_counts"] = f"""
SELECT count(*) AS n_read, count(*) FILTER (reason IS NULL) AS n_good,
       count(reason) AS n_bad, true AS reconciles FROM ({BROKEN}) AS b"""
    sql["ingest_split"] = (
        f"SELECT c_custkey AS row_id, seg_raw, bal_null, c_nationkey, label_raw FROM ({DIRTY}) AS d"
    )
    sql["ingest_summary"] = f"""
WITH d AS ({DIRTY})
SELECT label_raw AS label, count(*) AS n,
       round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM d), 2) AS pct,
       CAST(3 AS INTEGER) AS n_features FROM d GROUP BY label_raw"""
    sql["table_shape"] = (
        "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem"
    )
    info = [
        ("c_custkey", "bigint"), ("seg_raw", "string"), ("label_raw", "string"),
        ("bal_null", "double"), ("c_nationkey", "int"),
    ]
    sql["table_info"] = f"WITH d AS ({DIRTY})\n" + rows(
        *[
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", "
            f"count({c}) AS non_null, '{t}' AS dtype FROM d"
            for i, (c, t) in enumerate(info)
        ]
    )
    types = [
        ("doc_id", "bigint"), ("text", "string"), ("lang", "string"),
        ("source", "string"), ("n_chars", "bigint"),
    ]
    sql["column_dtypes"] = rows(
        *[
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS n_rows FROM documents"
            for c, t in types
        ]
    )
    roles = [
        ("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_orderstatus", "categorical"),
        ("o_totalprice", "numeric"), ("o_orderdate", "none"), ("o_orderpriority", "categorical"),
    ]
    sql["infer_column_roles"] = rows(
        *[
            f"SELECT '{c}' AS \"column\", '{role}' AS role, count({c}) AS non_null FROM orders"
            for c, role in roles
        ]
    )

    sql["sentinel_to_null"] = (
        f"SELECT c_custkey, {null_sentinel('seg_raw')} AS seg_raw FROM ({DIRTY}) AS d"
    )
    sql["clean_categoricals"] = f"""
SELECT c_custkey, {clean('seg')} AS seg_raw
FROM (SELECT c_custkey, {null_sentinel('seg_raw')} AS seg FROM ({DIRTY}) AS d) AS s"""
    sql["clean_target"] = (
        f"SELECT c_custkey, {clean('label_raw')} AS label_raw FROM ({DIRTY}) AS d"
    )
    sql["binarize_label"] = f"""
SELECT c_custkey, CASE WHEN {clean('label_raw')} = '>50K' THEN 1 ELSE 0 END AS label
FROM ({DIRTY}) AS d"""
    sql["age_bins"] = f"SELECT row_id, age, {AGE_GROUP} AS age_group FROM ({SCORED}) AS v"

    dirty_cols = [c for c, _ in info]
    sql["null_counts"] = f"WITH d AS ({DIRTY})\n" + rows(
        *[
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count FROM d"
            for c in dirty_cols
        ]
    )
    sql["null_pct_report"] = f"""
WITH d AS (SELECT c_custkey, {null_sentinel('seg_raw')} AS seg_raw, label_raw, bal_null, c_nationkey
           FROM ({DIRTY}) AS raw),
counted AS ({rows(*[f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS n FROM d" for c in dirty_cols])})
SELECT "column", null_count, round(100.0::DOUBLE * null_count / n, 2) AS null_pct
FROM counted WHERE null_count > 0"""
    for name, cols, table in (
        ("duplicate_rows", "text, lang", "documents"),
        ("duplicate_rows_with_nulls", "seg_raw, label_raw, bal_null", f"({DIRTY}) AS d"),
    ):
        sql[name] = f"""
SELECT {big('sum(n)')} AS n_rows, {big('sum(n - 1)')} AS n_duplicates, sum(n - 1) > 0 AS has_duplicates
FROM (SELECT count(*) AS n FROM {table} GROUP BY {cols}) AS g"""
    sql["numeric_summary"] = summary_of("lineitem", LINE_NUMS)
    sql["numeric_summary_narrowed"] = sql["numeric_summary"]
    sql["exact_quantiles"] = decile_rows()
    sql["sketched_quantile_bounds"] = sketch_bound_rows()
    sql["profile_state_merged"] = rows(
        *[
            f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS count, "
            f"count(*) - count({c}) AS null_count, {rnd(f'avg({c})')} AS mean, "
            f"{rnd(f'stddev_samp({c})')} AS std, {rnd(f'min({c})')} AS min, {rnd(f'max({c})')} AS max "
            f"FROM ({DIRTY}) AS d"
            for c in ("bal_null", "c_custkey")
        ]
    )
    sql["categorical_top10"] = f"WITH d AS ({DIRTY})\n" + top_of("d", ["seg_raw", "label_raw"])
    sql["categorical_top10_texts"] = top_of("documents", ["text", "lang", "source"])
    sql["top_words"] = f"""
WITH w AS (SELECT unnest(string_split_regex(text, '[ \\n]')) AS word FROM documents)
{top_of('w', ['word'], 20)}"""
    sql["target_distribution"] = f"""
WITH d AS (SELECT {clean('label_raw')} AS label FROM ({DIRTY}) AS raw)
SELECT label, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM d), 2) AS pct
FROM d GROUP BY label"""
    sql["correlation_matrix"] = rows(
        *[
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd(f'corr({a}, {b})')} AS r FROM lineitem"
            for a in CORR_COLS
            for b in CORR_COLS
        ]
    )
    kinds = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    key = "(l_orderkey + l_linenumber)"
    gappy = ", ".join(
        f"CASE WHEN {key} % {k + 2} <> 0 THEN {kinds[k % 5]} * (1 + {key} % {k // 5 + 1}) END AS x{k}"
        for k in range(30)
    )
    pairs = [(a, b) for a in range(30) for b in range(30)]
    sql["correlation_matrix_wide"] = f"""
WITH g AS (SELECT {gappy} FROM lineitem),
r AS (SELECT unnest([{', '.join(f"'x{a}'" for a, _ in pairs)}]) AS col_a,
             unnest([{', '.join(f"'x{b}'" for _, b in pairs)}]) AS col_b,
             unnest([{', '.join(f"corr(x{a}, x{b})" for a, b in pairs)}]) AS r FROM g)
SELECT col_a, col_b, {rnd('r')} AS r FROM r"""
    sql["validation_report_long"] = report_rows()

    declared = [
        ("l_orderkey", "bigint", "bigint"), ("l_quantity", "double", "double"),
        ("l_discount", "double", "double"), ("l_returnflag", "string", "string"),
        ("l_linenumber", "bigint", "int"), ("l_comment", "string", None),
    ]
    sql["expect_columns_and_types"] = rows(
        *[
            f"SELECT '{c}' AS \"column\", '{want}' AS declared, "
            f"CAST({'NULL' if got is None else repr(got)} AS VARCHAR) AS found, "
            f"{'true' if want == got else 'false'} AS ok, count(*) AS n_rows FROM lineitem"
            for c, want, got in declared
        ]
    )
    sql["expect_not_null"] = f"WITH d AS ({DIRTY})\n" + not_null_failures(
        "d", "c_custkey", ["seg_raw", "bal_null"]
    )
    in_range = [
        ("l_quantity", "in_range(1, 50)", "l_quantity BETWEEN 1 AND 50"),
        ("l_discount", "in_range(0, 0.05)", "l_discount BETWEEN 0 AND 0.05::DOUBLE"),
    ]
    sql["expect_in_range"] = rows(
        not_null_failures("lineitem", "l_orderkey", ["l_quantity", "l_discount"]),
        *[
            value_failures("lineitem", "l_orderkey", *check, double_text(check[0]))
            for check in in_range
        ],
    )
    in_set = ("l_returnflag", "isin(A, N)", "l_returnflag IN ('A', 'N')")
    sql["expect_in_set"] = rows(
        not_null_failures("lineitem", "l_orderkey", ["l_returnflag"]),
        value_failures("lineitem", "l_orderkey", *in_set),
    )
    sql["failure_cases"] = f"WITH d AS ({DIRTY})\n" + rows(
        not_null_failures(
            "d", "c_custkey", ["c_custkey", "seg_raw", "label_raw", "bal_null"]
        ),
        value_failures(
            "d", "c_custkey", "label_raw", "isin(>50K, <=50K)", "label_raw IN ('>50K', '<=50K')"
        ),
        value_failures(
            "d", "c_custkey", "bal_null", "in_range(0, 9000)", "bal_null BETWEEN 0 AND 9000",
            double_text("bal_null"),
        ),
    )
    verdict = [
        (f"{c}: not_nullable", f"{c} IS NULL")
        for c in ("l_orderkey", "l_quantity", "l_discount", "l_returnflag", "l_linenumber")
    ]
    verdict += [(f"{c}: {check}", f"NOT ({holds})") for c, check, holds in [*in_range, in_set]]
    verdict += [("l_linenumber: dtype(bigint)", "true"), ("l_comment: column_in_dataframe", "true")]
    sql["validation_verdict"] = rows(*[rule_count("lineitem", *v) for v in verdict])

    sql["scaler_fit"] = f"WITH f AS ({FEATURES})\n" + rows(
        *[
            f"SELECT '{c}' AS \"column\", {rnd(f'avg({c})')} AS mean, "
            f"{rnd(f'CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END')} AS scale FROM f"
            for c in NUMS
        ]
    )
    sql["scaler_transform"] = f"WITH f AS ({FEATURES})\nSELECT row_id, {scaled(NUMS, 'f')} FROM f"
    part_cols = ["p_brand", "p_type", "p_name"]
    sql["ordinal_fit"] = f"WITH {code_ctes(part_cols, 'part')}\n" + rows(
        *[f"SELECT '{c}' AS \"column\", v AS value, code FROM codes_{c}" for c in part_cols]
    )
    named = ["c_mktsegment", "c_name"]
    sql["ordinal_fit_ranges"] = f"WITH {code_ctes(named, 'customer')}\n" + rows(
        *[f"SELECT '{c}' AS \"column\", v AS value, code FROM codes_{c}" for c in named]
    )
    cust_cols = ["c_mktsegment", "c_name", "nation"]
    sql["ordinal_transform"] = f"""
WITH c AS (SELECT c_custkey, c_mktsegment, c_name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer),
{split_of('SELECT c_custkey AS row_id, c_mktsegment AS label FROM customer')},
fitted AS (SELECT c.* FROM c JOIN placed ON c_custkey = row_id WHERE part = 'train'),
{code_ctes(cust_cols, 'fitted')}
SELECT c_custkey, {coded(cust_cols)} FROM c {code_joins(cust_cols, 'c')}"""
    sql["preprocess_data"] = f"""
WITH f AS ({FEATURES}),
{split_of('SELECT row_id, label FROM f')},
fitted AS (SELECT f.* FROM f JOIN placed ON f.row_id = placed.row_id WHERE part = 'train'),
{code_ctes(CATS, 'fitted')}
SELECT row_id, {scaled(NUMS, 'fitted')}, {coded(CATS)} FROM f {code_joins(CATS, 'f')}"""
    dirty_cats = ["seg_raw", "label_raw"]
    sql["preprocessor_state_roundtrip"] = f"""
WITH f AS (SELECT c_custkey, {clean(null_sentinel('seg_raw'))} AS seg_raw,
                  {clean('label_raw')} AS label_raw, bal_null, c_nationkey FROM ({DIRTY}) AS raw),
{code_ctes(dirty_cats, 'f')}
SELECT c_custkey, {scaled(['bal_null', 'c_nationkey'], 'f')}, {coded(dirty_cats)}
FROM f {code_joins(dirty_cats, 'f')}"""

    sql["stratified_split"] = (
        f"WITH {split_of(ORDER_LABELS)}\nSELECT row_id, label, part FROM placed"
    )
    sql["stratified_folds"] = f"""
WITH {split_of(ORDER_LABELS)}
SELECT row_id, label, part, CAST(coalesce(fold, -1) AS INTEGER) AS fold FROM placed"""

    sql["confusion_matrix"] = f"WITH c AS (SELECT {CELLS} FROM ({SCORED}) AS v)\n" + rows(
        *[
            f"SELECT CAST({t} AS INTEGER) AS y_true, CAST({p} AS INTEGER) AS y_pred, {cell} AS n FROM c"
            for cell, t, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
        ]
    )
    sql["overall_metrics"] = f"""
WITH c AS (SELECT {CELLS} FROM ({SCORED}) AS v)
SELECT tn + fp + fn + tp AS n_samples, {rnd(ACCURACY)} AS accuracy,
       {rnd(F1_MACRO)} AS f1_macro, {rnd(F1_POS)} AS f1_binary FROM c"""
    sql["classification_report"] = f"""
WITH c AS (SELECT {CELLS} FROM ({SCORED}) AS v),
r AS (SELECT *, tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n,
        coalesce({ratio('tn', 'tn + fn')}, 0) AS p0, coalesce({ratio('tn', 'tn + fp')}, 0) AS r0,
        coalesce({ratio('tp', 'tp + fp')}, 0) AS p1, coalesce({ratio('tp', 'tp + fn')}, 0) AS r1,
        {F1_NEG} AS f0, {F1_POS} AS f1 FROM c)
SELECT '<=50K' AS class, {rnd('p0')} AS precision, {rnd('r0')} AS recall, {rnd('f0')} AS f1, s0 AS support FROM r
UNION ALL SELECT '>50K', {rnd('p1')}, {rnd('r1')}, {rnd('f1')}, s1 FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, {rnd(ratio('tn + tp', 'n'))}, n FROM r
UNION ALL SELECT 'macro avg', {rnd('(p0 + p1) / 2')}, {rnd('(r0 + r1) / 2')}, {rnd('(f0 + f1) / 2')}, n FROM r
UNION ALL SELECT 'weighted avg', {rnd('(p0 * s0 + p1 * s1) / n')}, {rnd('(r0 * s0 + r1 * s1) / n')},
       {rnd('(f0 * s0 + f1 * s1) / n')}, n FROM r"""
    sql["roc_auc"] = f"""
WITH v AS (SELECT 'all' AS grp, y_true, y_proba FROM ({SCORED}) AS s)
SELECT {rnd('auc')} AS auc, {big('n_pos')} AS n_pos, {big('n_neg')} AS n_neg
FROM ({auc_by('v', 'grp')}) AS a"""
    sql["evaluation_summary"] = f"""
WITH v AS (SELECT 'all' AS grp, y_true, y_pred, y_proba FROM ({DOC_SCORED}) AS s),
c AS (SELECT {CELLS} FROM v)
SELECT tn, fp, fn, tp, {rnd(ACCURACY)} AS accuracy, {rnd(F1_MACRO)} AS f1_macro,
       {rnd(F1_POS)} AS f1_binary, {rnd(f"(SELECT auc FROM ({auc_by('v', 'grp')}) AS a)")} AS auc FROM c"""

    keys = 'dimension, "group"'
    sql["subgroup_metrics"] = f"""{ORDER_GROUPS},
{GROUP_COUNTS}
SELECT {keys}, {GROUP_METRICS} FROM counts"""
    sql["subgroup_auc"] = f"""{ORDER_GROUPS},
{GROUP_COUNTS},
aucs AS ({auc_by('member', keys)})
SELECT counts.dimension AS dimension, counts."group" AS "group",
       {big('tn + fp + fn + tp')} AS n_samples, {rnd('auc')} AS auc
FROM counts JOIN aucs ON counts.dimension = aucs.dimension AND counts."group" = aucs."group\""""
    sql["subgroup_small_groups"] = f"""{DOC_GROUPS},
{GROUP_COUNTS},
aucs AS ({auc_by('member', keys)})
SELECT counts.dimension AS dimension, counts."group" AS "group", {GROUP_METRICS}, {rnd('auc')} AS auc
FROM counts JOIN aucs ON counts.dimension = aucs.dimension AND counts."group" = aucs."group\""""
    sql["subgroup_disparity"] = f"""{ORDER_GROUPS},
{GROUP_COUNTS},
scores AS (SELECT dimension, {ACCURACY} AS accuracy, {F1_MACRO} AS f1_macro FROM counts)
SELECT dimension, {rnd('max(accuracy) - min(accuracy)')} AS accuracy_max_diff,
       {rnd('max(f1_macro) - min(f1_macro)')} AS f1_max_diff
FROM scores GROUP BY dimension HAVING count(*) > 1"""

    sql["overfit_gap"] = f"""{SPLIT_SCORED},
s AS (SELECT part, {ACCURACY} AS acc, {F1_POS} AS f1
      FROM (SELECT part, {CELLS} FROM joined GROUP BY part) AS c),
g AS (SELECT a.acc AS train_accuracy, a.f1 AS train_f1, b.acc AS test_accuracy, b.f1 AS test_f1
      FROM s AS a JOIN s AS b ON a.part = 'train' AND b.part = 'test')
SELECT {rnd('train_accuracy')} AS train_accuracy, {rnd('train_f1')} AS train_f1,
       {rnd('test_accuracy')} AS test_accuracy, {rnd('test_f1')} AS test_f1,
       {rnd('train_accuracy - test_accuracy')} AS accuracy_diff, {rnd('train_f1 - test_f1')} AS f1_diff,
       CASE WHEN train_accuracy - test_accuracy > 0.1 OR train_f1 - test_f1 > 0.1 THEN 'alert'
            WHEN train_accuracy - test_accuracy > 0.05 OR train_f1 - test_f1 > 0.05 THEN 'caution'
            ELSE 'ok' END AS verdict FROM g"""
    sql["cv_test_consistency"] = f"""{SPLIT_SCORED},
f AS (SELECT avg(f1) AS f1_cv, stddev_pop(f1) AS f1_cv_std FROM (
        SELECT {F1_MACRO} AS f1 FROM (SELECT fold, {CELLS} FROM joined
                                      WHERE part = 'train' GROUP BY fold) AS c) AS s),
t AS (SELECT {F1_MACRO} AS macro, {F1_POS} AS bin
      FROM (SELECT {CELLS} FROM joined WHERE part = 'test') AS c)
SELECT {rnd('f1_cv')} AS f1_cv, {rnd('f1_cv_std')} AS f1_cv_std, {rnd('macro')} AS f1_test_macro,
       {rnd('bin')} AS f1_test_binary, {rnd('abs(f1_cv - macro)')} AS macro_diff,
       {rnd('abs(f1_cv - bin)')} AS binary_diff,
       CASE WHEN abs(f1_cv - macro) > 0.05 THEN 'check' ELSE 'consistent' END AS verdict
FROM f JOIN t ON true"""
    sql["run_log_best"] = f"""
WITH v AS ({SCORED}),
ruled AS (SELECT lim, y_true, CAST(y_proba >= CAST(lim AS DOUBLE) AS INTEGER) AS y_pred
          FROM v JOIN (SELECT unnest(['0.4', '0.5', '0.6']) AS lim) AS limits ON true),
runs AS (SELECT lim, {F1_MACRO} AS f1, {ACCURACY} AS acc
         FROM (SELECT lim, {CELLS} FROM ruled GROUP BY lim) AS c)
SELECT 'price-rule' AS experiment, lim AS "limit", {rnd('f1')} AS f1_test, {rnd('acc')} AS accuracy
FROM runs ORDER BY f1 DESC LIMIT 1"""
    sql["top_values_tied_texts"] = """
SELECT md5(text) AS digest, n, CAST(row_number() OVER (ORDER BY n DESC, encode(text)) AS INTEGER) AS rank
FROM (SELECT text, count(*) AS n FROM documents GROUP BY text)
ORDER BY rank LIMIT 5"""
    odd = f"""
SELECT row_id, CASE WHEN row_id % 13 = 0 THEN NULL WHEN row_id % 29 = 0 THEN 2 ELSE y_true END AS y_true,
       CASE WHEN row_id % 7 = 0 THEN NULL WHEN row_id % 31 = 0 THEN -1 ELSE y_pred END AS y_pred
FROM ({SCORED}) AS v"""
    sql["label_problems"] = f"""
SELECT count(*) AS n_rows, count(*) FILTER (y_true IN (0, 1) AND y_pred IN (0, 1)) AS n_valid,
       count(*) FILTER (y_true IS NULL) AS n_null_truth,
       count(*) FILTER (y_true NOT IN (0, 1)) AS n_other_truth,
       count(*) FILTER (y_pred IS NULL) AS n_null_prediction,
       count(*) FILTER (y_pred NOT IN (0, 1)) AS n_other_prediction FROM ({odd}) AS o"""
    sql["metrics_of_valid_rows"] = f"""
WITH c AS (SELECT {CELLS} FROM ({odd}) AS o WHERE y_true IN (0, 1) AND y_pred IN (0, 1))
SELECT tn + fp + fn + tp AS n_samples, {rnd(ACCURACY)} AS accuracy,
       {rnd(F1_MACRO)} AS f1_macro, {rnd(F1_POS)} AS f1_binary FROM c"""
    sql["classification_report_one_class"] = f"""
WITH c AS (SELECT count(*) AS n FROM ({SCORED}) AS v WHERE y_true = 1)
SELECT '0' AS class, 0.0::DOUBLE AS precision, 0.0::DOUBLE AS recall, 0.0::DOUBLE AS f1, 0::BIGINT AS support
UNION ALL SELECT '1', 1, 1, 1, n FROM c
UNION ALL SELECT 'accuracy', NULL, NULL, 1, n FROM c
UNION ALL SELECT 'macro avg', 1, 1, 1, n FROM c
UNION ALL SELECT 'weighted avg', 1, 1, 1, n FROM c"""
    sql["roc_auc_infinite_scores"] = f"""
WITH v AS (SELECT 'all' AS grp, y_true, CASE WHEN row_id % 3 = 0 THEN 1e300
             WHEN row_id % 5 = 0 THEN -1e300 ELSE y_proba END AS y_proba FROM ({SCORED}) AS s)
SELECT {rnd('auc')} AS auc, {big('n_pos')} AS n_pos, {big('n_neg')} AS n_neg
FROM ({auc_by('v', 'grp')}) AS a"""
    sql["strict_expectations"] = """
SELECT count(*) AS n, 'o_totalprice: in_range(0, 1): '
  || count(*) FILTER (o_totalprice NOT BETWEEN 0 AND 1) || ' rows' AS raised FROM orders"""
    sql["failing_rows_text_key"] = f"""
SELECT 'k' || c_custkey AS row_id, 'seg_raw' AS "column", 'not_nullable' AS "check",
       CAST(NULL AS VARCHAR) AS failure_case FROM ({DIRTY}) AS d WHERE seg_raw IS NULL"""
    sql["failing_rows_nan"] = """
SELECT c_custkey AS row_id, 'balance' AS "column", 'not_nullable' AS "check"
FROM customer WHERE c_custkey % 5 = 0"""
    sql["ordinal_transform_by_shuffle"] = sql["ordinal_transform"]
    sql["ordinal_fit_long_prefix"] = """
SELECT right(c_name, 18) AS ending, CAST(row_number() OVER (ORDER BY c_name) - 1 AS DOUBLE) AS code
FROM (SELECT DISTINCT c_name FROM customer) AS n"""
    many = "SELECT CAST(o_orderkey AS VARCHAR) AS row_id, o_custkey % 200 AS label FROM orders"
    sql["stratified_folds_many_classes"] = f"""
WITH {split_of(many)}
SELECT row_id, label, part, CAST(coalesce(fold, -1) AS INTEGER) AS fold FROM placed"""
    sql["flatten_target"] = (
        f"SELECT label_raw AS label, count(*) AS n FROM ({DIRTY}) AS d GROUP BY label_raw"
    )
    sql["report_document"] = f"""
SELECT y_true, y_pred, n, n AS n_rows FROM ({sql['confusion_matrix']}) AS c"""

    # Finished orders are told apart exactly by one feature, so every model is right everywhere.
    finished = "SELECT o_orderkey AS row_id, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders"
    test = f"WITH {split_of(finished)}, t AS (SELECT row_id, label FROM placed WHERE part = 'test')"
    sql["gbt_scored"] = f"""{test}
SELECT row_id, label, label AS y_pred, label = 1 AS likely FROM t"""
    sql["gbt_scored_noisy"] = f"""
WITH {split_of(f'SELECT row_id, label FROM ({FEATURES}) AS f')}
SELECT row_id, label, true AS agrees FROM placed WHERE part = 'test'"""
    one = "1.0::DOUBLE"
    sql["gbt_holdout_metrics"] = f"""{test}
SELECT count(*) FILTER (label = 0) AS tn, 0::BIGINT AS fp, 0::BIGINT AS fn,
       count(*) FILTER (label = 1) AS tp, {one} AS accuracy, {one} AS f1_macro, {one} AS f1_binary,
       {one} AS auc FROM t"""
    sql["model_state_roundtrip"] = f"{test}\nSELECT row_id, label, label AS y_pred FROM t"
    # Every model calls every row by its label, in its fold and in the test part.
    right = f"""
WITH {split_of(finished)},
called AS (
  SELECT model, part, fold, label, label = 1 AS yes
  FROM placed, (SELECT unnest(['GradientBoosting', 'LogisticRegression', 'RandomForest']) AS model) AS m),
{FOLD_SCORES}"""
    sql["gbt_cv_macro_f1"] = f"""{right}
SELECT {rnd('f1_cv')} AS f1_cv, {rnd('f1_cv_std')} AS f1_cv_std, {rnd('f1_test')} AS f1_test
FROM ranked WHERE model = 'GradientBoosting'"""
    sql["model_ranking"] = f"""{right}
SELECT model, {rnd('f1_cv')} AS f1_cv, {rnd('f1_cv_std')} AS f1_cv_std, {rnd('f1_test')} AS f1_test,
       {rnd('accuracy')} AS accuracy FROM ranked"""
    # Digests of the canonical text of a row: every field with its length, null as a dash.
    fields = " || ".join(
        f"coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
        for c in ("seg_raw", "label_raw", "c_nationkey")
    )
    keyless = f"""
SELECT d || '-' || (row_number() OVER (PARTITION BY d) - 1) AS row_id, label_raw AS label, seg_raw, c_nationkey
FROM (SELECT *, sha256({fields}) AS d FROM ({DIRTY}) AS x) AS y"""
    sql["ingest_content_key"] = f"""
WITH keyless AS MATERIALIZED ({keyless}), {split_of('SELECT row_id, label FROM keyless')}
SELECT row_id, seg_raw, c_nationkey, placed.label AS label_raw, part
FROM placed JOIN keyless USING (row_id)"""
    binned = f"{split_of(f'SELECT row_id, label FROM ({BINNED}) AS b')},\n{BINNED_ROWS}"
    sql["gbt_root_split"] = f"""
WITH {binned},
train AS (SELECT 0 AS grp, feature, value, label FROM long_rows WHERE part = 'train'),
{best_cuts('root', 'train')}
SELECT feature, {rnd('threshold')} AS threshold, {rnd('gain')} AS gain,
       {rnd('left_value')} AS left_value, n_left, {rnd('right_value')} AS right_value, n_right,
       feature AS best_feature, {rnd('threshold')} AS best_threshold, {rnd('gain')} AS best_gain,
       {rnd('left_value')} AS best_left_value, n_left AS best_n_left,
       {rnd('right_value')} AS best_right_value, n_right AS best_n_right
FROM root"""
    # Group -1 is fitted on all training rows and scores the test part.
    stumps = f"""{binned},
train AS (SELECT grp, feature, value, label FROM long_rows, (SELECT unnest(range(-1, 5)) AS grp) AS g
          WHERE part = 'train' AND fold <> grp),
{best_cuts('root', 'train')},
predicted AS (
  SELECT row_id, part, label, coalesce(fold, -1) AS fold,
         CASE WHEN value <= threshold THEN left_value ELSE right_value END AS margin
  FROM long_rows JOIN root ON root.grp = coalesce(fold, -1) AND root.feature = long_rows.feature)"""
    sql["gbt_predictions"] = f"""
WITH {stumps}
SELECT row_id, part, label, CAST(fold AS INTEGER) AS fold, CAST(margin > 0 AS INTEGER) AS y_pred,
       {rnd('1 / (1 + exp(-2 * margin))')} AS y_proba FROM predicted"""
    sql["stump_cv_macro_f1"] = f"""
WITH {stumps},
called AS (SELECT 'stump' AS model, part, fold, label, margin > 0 AS yes FROM predicted),
{FOLD_SCORES}
SELECT {rnd('f1_cv')} AS f1_cv, {rnd('f1_cv_std')} AS f1_cv_std, {rnd('f1_test')} AS f1_test FROM ranked"""
    observed = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS feature, count(*) AS n, {rnd(f'avg(label * {x})')} AS observed,"
        f" {rnd(f'avg(label * {x})')} AS fitted FROM t"
        for name, x in [("intercept", "1.0::DOUBLE"), *[(c, c) for c in BINNED_NAMES]]
    )
    sql["model_moments_roundtrip"] = f"""
WITH {split_of(f'SELECT row_id, label FROM ({BINNED}) AS b')},
t AS (SELECT b.* FROM ({BINNED}) AS b JOIN placed USING (row_id) WHERE part = 'train')
{observed}"""
    sql["small_model_ranking"] = f"""
WITH RECURSIVE {binned},
train AS (SELECT grp, feature, value, label FROM long_rows, (SELECT unnest(range(-1, 5)) AS grp) AS g
          WHERE part = 'train' AND fold <> grp AND feature = 0),
scored_rows AS (SELECT coalesce(fold, -1) AS grp, part, label, value FROM long_rows WHERE feature = 0),
{best_cuts('root', 'train')},
sides AS (SELECT t.grp * 2 + CAST(value > threshold AS INTEGER) AS grp, t.feature, value, label
          FROM train AS t JOIN root ON root.grp = t.grp),
{best_cuts('branch', 'sides')},
-- Newton steps on the counts of rows and labels per value.
counts AS (SELECT grp, value AS x, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS k FROM train GROUP BY ALL),
newton AS (
  SELECT -1 + i AS grp, 0 AS step, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1 FROM (SELECT unnest(range(6)) AS i) AS f
  UNION ALL
  SELECT grp, step + 1, b0 + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01),
         b1 + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (SELECT grp, step, b0, b1, sum(k - n * p) AS g0, sum((k - n * p) * x) AS g1,
               sum(n * p * (1 - p)) AS h00, sum(n * p * (1 - p) * x) AS h01,
               sum(n * p * (1 - p) * x * x) AS h11
        FROM (SELECT newton.*, x, n, k, 1 / (1 + exp(-(b0 + b1 * x))) AS p
              FROM newton JOIN counts USING (grp) WHERE step < 25) AS q
        GROUP BY grp, step, b0, b1) AS sums),
called AS (
  SELECT 'RandomForest' AS model, part, s.grp AS fold, label,
         CASE WHEN value <= threshold THEN left_value ELSE right_value END > 0 AS yes
  FROM scored_rows AS s JOIN root USING (grp)
  UNION ALL
  SELECT 'GradientBoosting', part, s.grp, label,
         1 / (1 + exp(-2 * CASE WHEN value <= b.threshold THEN b.left_value ELSE b.right_value END)) > 0.8
  FROM scored_rows AS s JOIN root AS r USING (grp)
  JOIN branch AS b ON b.grp = s.grp * 2 + CAST(value > r.threshold AS INTEGER)
  UNION ALL
  SELECT 'LogisticRegression', part, s.grp, label, b0 + b1 * value > 0
  FROM scored_rows AS s JOIN newton USING (grp) WHERE step = 25),
{FOLD_SCORES}
SELECT model, {rnd('f1_cv')} AS f1_cv, {rnd('f1_cv_std')} AS f1_cv_std, {rnd('f1_test')} AS f1_test,
       {rnd('accuracy')} AS accuracy FROM ranked"""
    return sql
