"""The queries of ``queries`` that SQL can express, in ANSI SQL, for checking results."""

ORDERS = """o AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
  nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders)"""
LINES = """l AS (SELECT l_orderkey, l_linenumber, l_quantity,
  CASE WHEN l_discount <> 0 THEN l_extendedprice END AS l_extendedprice, l_discount,
  CASE WHEN l_tax <> 0 THEN l_tax END AS l_tax, l_returnflag, l_linestatus FROM lineitem)"""
EVENTS = """e AS (SELECT event_id, user_id, event_type,
  CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"""
TRAIN = """d AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, g.quality, g.toxic
  FROM documents d JOIN labels g ON g.doc_id = d.doc_id)"""
RULE = "CASE WHEN lang IN ('de', 'fr') THEN 1 ELSE 0 END"
# What every model that has learned the rule predicts for the documents without labels.
LEARNED = f"""SELECT doc_id, {RULE} AS continental FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""
SIDE_BY_SIDE = """WITH a AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS i, o_orderkey, o_totalprice FROM orders),
  b AS (SELECT row_number() OVER (ORDER BY c_custkey) AS i, c_custkey, c_mktsegment FROM customer)
SELECT a.o_orderkey, a.o_totalprice, b.c_custkey, b.c_mktsegment FROM a FULL JOIN b ON a.i = b.i"""
FIXED = """s AS (SELECT o_orderkey, 1 / (1 + exp(-(o_totalprice * 0.00002
  - CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0.75 ELSE 0 END - 3.1))) AS p FROM orders)"""
PROFILED = """d AS (SELECT d.doc_id, d.lang, nullif(d.source, 'src0') AS source, d.n_chars, g.quality, g.toxic
  FROM documents d JOIN labels g ON g.doc_id = d.doc_id)"""
# Newton's steps from the weighted counts of a 0/1 feature x and label y; C is 0.01.
ONE_FEATURE = """WITH RECURSIVE
  o AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS x, CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS y
        FROM orders),
  c AS (SELECT sum(CASE WHEN x = 0 THEN w END) AS n0, sum(CASE WHEN x = 1 THEN w END) AS n1,
        sum(CASE WHEN x = 0 THEN w * y ELSE 0 END) AS s0, sum(CASE WHEN x = 1 THEN w * y ELSE 0 END) AS s1
        FROM (SELECT x, y, CAST(CASE WHEN y = 1 THEN 1.5 ELSE 1.0 END AS DOUBLE) AS w FROM o)),
  step(i, w, b) AS (
    SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
    UNION ALL
    SELECT i + 1, w - ((a + d) * gw - a * gb) / (h * (a + d) - a * a), b - (h * gb - a * gw) / (h * (a + d) - a * a)
    FROM (SELECT i, w, b, n1 * p1 * (1 - p1) AS a, n0 * p0 * (1 - p0) AS d, 1 / 0.01 + n1 * p1 * (1 - p1) AS h,
            w / 0.01 + n1 * p1 - s1 AS gw, n0 * p0 - s0 + n1 * p1 - s1 AS gb
          FROM (SELECT i, w, b, 1 / (1 + exp(-b)) AS p0, 1 / (1 + exp(-(w + b))) AS p1 FROM step), c)
    WHERE i < 30)
SELECT 'filled' AS feature, round(w, 3) AS score FROM step WHERE i = 30
UNION ALL SELECT 'intercept', round(b, 3) FROM step WHERE i = 30"""
PRICED = """p AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
  1 / (1 + exp(-((o_totalprice - 200000) / 100000))) AS score,
  CASE WHEN 1 / (1 + exp(-((o_totalprice - 200000) / 100000))) >= 0.5 THEN 1 ELSE 0 END AS prediction FROM orders)"""


def _folds(table: str, key: str, label: str) -> str:
    """CTEs ending in f(key, label, fold): rows sorted by class are dealt to five folds in turn."""
    return f"""
  ranked AS (SELECT {key}, {label}, row_number() OVER (PARTITION BY {label} ORDER BY {key}) AS r,
             min({key}) OVER (PARTITION BY {label}) AS first_key FROM {table}),
  placed AS (SELECT *, row_number() OVER (ORDER BY first_key, {key}) - 1 AS p FROM ranked),
  dealt AS (SELECT {label}, p % 5 AS fold, count(*) AS n FROM placed GROUP BY {label}, p % 5),
  ends AS (SELECT {label}, fold, sum(n) OVER (PARTITION BY {label} ORDER BY fold) AS hi FROM dealt),
  f AS (SELECT s.{key}, s.{label}, CAST(min(e.fold) AS INTEGER) AS fold
        FROM placed s JOIN ends e ON s.{label} = e.{label} AND s.r <= e.hi GROUP BY s.{key}, s.{label})"""


RULES = f"""{_folds("labels", "doc_id", "quality")},
  cuts AS (SELECT 0 AS candidate, 500 AS cut UNION ALL SELECT 1, 1000 UNION ALL SELECT 2, 2000 UNION ALL SELECT 3, 4000),
  scores AS (SELECT c.candidate, c.cut, f.fold,
             avg(CASE WHEN (CASE WHEN d.n_chars > c.cut THEN 1 ELSE 0 END) = f.quality THEN 1.0 ELSE 0.0 END) AS score
             FROM f JOIN documents d ON d.doc_id = f.doc_id CROSS JOIN cuts c GROUP BY c.candidate, c.cut, f.fold),
  results AS (SELECT candidate, cut, avg(score) AS mean_score, stddev_pop(score) AS std_score,
              rank() OVER (ORDER BY round(avg(score), 12) DESC) AS place FROM scores GROUP BY candidate, cut)"""


def _describe(table: str, names: list[str], extra: str = "") -> str:
    parts = [
        f"""SELECT '{n}' AS "column", count({n}) AS count, round(avg({n}), 4) AS mean,
  round(stddev_samp({n}), 4) AS std, round(CAST(min({n}) AS DOUBLE), 4) AS min,
  round(quantile_cont(CAST({n} AS DOUBLE), 0.25), 4) AS p25, round(quantile_cont(CAST({n} AS DOUBLE), 0.5), 4) AS p50,
  round(quantile_cont(CAST({n} AS DOUBLE), 0.75), 4) AS p75, round(CAST(max({n}) AS DOUBLE), 4) AS max{extra.replace("{n}", n)}
FROM {table}"""
        for n in names
    ]
    return "\nUNION ALL\n".join(parts)


def _counts(table: str, names: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS "column", CAST({n} AS VARCHAR) AS value, count(*) AS n
FROM {table} WHERE {n} IS NOT NULL GROUP BY {n}"""
        for n in names
    )


def _missing(table: str, names: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS "column", count(*) - count({n}) AS n_missing FROM {table}""" for n in names
    )


def _dummies(column: str, values: list, source: str = "") -> str:
    """One 0/1 column per value; a missing value equals none of them."""
    return ", ".join(
        f"""CASE WHEN {source or column} = {v if isinstance(v, int) else repr(v)} THEN 1 ELSE 0 END AS "{column}_{v}\""""
        for v in values
    )


def _fill(expression: str) -> str:
    return f"""WITH {LINES}, m AS (SELECT {expression.format("l_quantity")} AS q,
  {expression.format("l_extendedprice")} AS x, {expression.format("l_tax")} AS t FROM l)
SELECT l_orderkey, l_linenumber, coalesce(l_quantity, q) AS l_quantity,
  coalesce(l_extendedprice, x) AS l_extendedprice, coalesce(l_tax, t) AS l_tax FROM l, m"""


STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]

ORACLE: dict[str, str] = {
    # sources and sinks
    "csv_labelled": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "csv_unlabelled": """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "csv_text": "SELECT doc_id, text, lang, n_chars FROM documents",
    "csv_padded": "SELECT doc_id, '  ' || lang || chr(9) AS padded FROM documents",
    "csv_inferred": "SELECT o_orderkey, o_totalprice, o_totalprice > 200000 AS large, o_orderpriority FROM orders",
    "csv_missing": f"WITH {ORDERS} "
    + _missing("o", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]),
    "submission_csv": f"WITH {PRICED} SELECT o_orderkey, prediction AS large FROM p",
    "submission_one_csv": f"WITH {PRICED} SELECT o_orderkey, prediction AS large FROM p",
    "label_split": "SELECT d.doc_id, g.quality FROM documents d JOIN labels g ON g.doc_id = d.doc_id",
    "feature_split": f"WITH {TRAIN} SELECT doc_id, lang, source, n_chars, toxic FROM d",
    "label_replace": f"""WITH {TRAIN}
SELECT doc_id, lang, source, n_chars, quality * (1 - toxic) AS quality, toxic FROM d""",
    "label_replace_from": f"WITH {TRAIN} SELECT doc_id, lang, source, n_chars, toxic AS quality FROM d",
    "table_rows": "SELECT count(*) AS n_rows FROM lineitem",
    "prepared_shape": """SELECT count(*) AS n_rows,
  count(DISTINCT l_returnflag) + count(DISTINCT l_linestatus) + 2 AS n_columns FROM lineitem""",
    # projections
    "select_features": "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders",
    "drop_label": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "insert_derived": """SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 THEN 1 ELSE 0 END AS large,
  o_custkey, o_orderstatus, o_totalprice FROM orders""",
    "column_slice": "SELECT p_brand, p_type, p_size FROM part",
    "numeric_only": "SELECT p_partkey, p_size, p_retailprice FROM part",
    "missing_values": f"""WITH {ORDERS} SELECT o_orderkey, o_custkey IS NULL AS o_custkey,
  o_orderstatus IS NULL AS o_orderstatus, o_totalprice IS NULL AS o_totalprice,
  o_orderpriority IS NULL AS o_orderpriority FROM o""",
    "table_preview": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
ORDER BY o_orderkey LIMIT 1000""",
    "counts_to_wide": """SELECT count(*) FILTER (WHERE event_type = 'click') AS click,
  count(*) FILTER (WHERE event_type = 'error') AS error,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
  count(*) FILTER (WHERE event_type = 'signup') AS signup,
  count(*) FILTER (WHERE event_type = 'view') AS view FROM events""",
    "score_threshold": f"WITH {PRICED} SELECT o_orderkey, round(score, 6) AS score, prediction FROM p",
    "schema_difference": """SELECT 'event_type_' || event_type AS "column",
  bool_or(event_type <> 'error') AS in_left, bool_or(event_type <> 'view') AS in_right
FROM events GROUP BY event_type""",
    "named_probabilities": f"""WITH {PRICED}
SELECT o_orderkey, round(1 - score, 6) AS large_0, round(score, 6) AS large_1 FROM p""",
    # joins
    "side_by_side": SIDE_BY_SIDE,
    "side_by_side_files": SIDE_BY_SIDE,
    "prediction_inserted": """SELECT doc_id, CASE WHEN n_chars >= 2000 THEN 1 ELSE 0 END AS quality, lang, n_chars
FROM documents""",
    "predictions_by_key": f"""WITH {PRICED}
SELECT o.o_orderkey, o.o_custkey, p.prediction AS large FROM orders o JOIN p ON p.o_orderkey = o.o_orderkey""",
    "predictions_for_some": f"""WITH {PRICED}
SELECT o.o_orderkey, o.o_custkey, CASE WHEN p.o_totalprice > 100000 THEN p.prediction END AS large
FROM orders o JOIN p ON p.o_orderkey = o.o_orderkey""",
    # aggregates
    "category_counts": f"""WITH {ORDERS} SELECT o_orderpriority, count(*) AS n FROM o
WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""",
    "category_counts_all": f"WITH {ORDERS} " + _counts("o", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]),
    "category_counts_top": f"WITH {ORDERS}, c AS ("
    + _counts("o", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    + """) SELECT "column", value, n FROM c QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) <= 3""",
    "missing_per_column": f"WITH {LINES} " + _missing("l", LINE_COLUMNS),
    "numeric_describe": f"WITH {LINES} " + _describe("l", LINE_COLUMNS[:6]),
    "numeric_describe_narrowed": f"WITH {LINES} " + _describe("l", LINE_COLUMNS[:6]),
    "analyzed_statistics": f"WITH {PROFILED} " + _describe("d", ["doc_id", "n_chars", "quality", "toxic"]),
    "analyzed_missing": f"WITH {PROFILED} " + _missing("d", ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]),
    "analyzed_mask": f"""WITH {PROFILED} SELECT doc_id IS NULL AS doc_id, source IS NULL AS source, n_chars IS NULL AS n_chars,
  count(*) AS n FROM d GROUP BY ALL""",
    "analyzed_data": f"WITH {PROFILED} SELECT * FROM d ORDER BY doc_id LIMIT 1000",
    "table_summary": f"WITH {EVENTS} "
    + _describe("e", ["event_id", "user_id", "value"], ", count(*) - count({n}) AS n_missing")
    + """
UNION ALL
SELECT 'event_type', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*) - count(event_type) FROM e""",
    "profile_values": f"WITH {TRAIN} " + _counts("d", ["doc_id", "lang", "source", "quality", "toxic"]),
    "means": f"WITH {LINES} "
    + "\nUNION ALL\n".join(f"""SELECT '{n}' AS "column", round(avg({n}), 4) AS mean FROM l""" for n in LINE_COLUMNS[:6]),
    "medians": f"WITH {LINES} "
    + "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS "column", round(quantile_cont({n}, 0.5), 4) AS median FROM l"""
        for n in ("l_quantity", "l_extendedprice", "l_tax")
    ),
    "modes": f"""WITH {ORDERS},
  s AS (SELECT o_orderstatus AS v FROM o WHERE o_orderstatus IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1),
  q AS (SELECT o_orderpriority AS v FROM o WHERE o_orderpriority IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)
SELECT 'o_orderstatus' AS "column", v AS mode FROM s UNION ALL SELECT 'o_orderpriority', v FROM q""",
    "column_ranges": """SELECT 'p_size' AS "column", CAST(min(p_size) AS DOUBLE) AS low, CAST(max(p_size) AS DOUBLE) AS high
FROM part UNION ALL SELECT 'p_retailprice', min(p_retailprice), max(p_retailprice) FROM part""",
    "column_spreads": """SELECT 'c_acctbal' AS "column", round(avg(c_acctbal), 4) AS mean,
  round(stddev_pop(c_acctbal), 4) AS std FROM customer""",
    "rule_accuracy": f"""WITH {TRAIN} SELECT round(avg(CASE WHEN (n_chars >= 500) = (quality = 1) THEN 1.0 ELSE 0.0 END), 6)
  AS accuracy FROM d""",
    # folds, candidates, ranking
    "folds": f"WITH {_folds('orders', 'o_orderkey', 'o_orderstatus')} SELECT o_orderkey, o_orderstatus, fold FROM f",
    "folds_narrowed": f"WITH {_folds('orders', 'o_orderkey', 'o_orderstatus')} SELECT o_orderkey, o_orderstatus, fold FROM f",
    "folds_of_labels": f"WITH {_folds('labels', 'doc_id', 'quality')} SELECT doc_id, quality, fold FROM f",
    "weighted_classes": """SELECT doc_id, CAST(CASE quality WHEN 1 THEN 1.5 ELSE 1.0 END AS DOUBLE) AS weight
FROM labels""",
    "grid_penalties": f"""WITH {_folds("labels", "doc_id", "quality")},
  held AS (SELECT fold, sum(CAST(CASE quality WHEN 1 THEN 1.5 ELSE 1.0 END AS DOUBLE)) AS w FROM f GROUP BY fold),
  t AS (SELECT fold, (SELECT sum(w) FROM held) - w AS train_weight FROM held),
  g AS (SELECT c.i * 10 + m.i AS candidate, pow(10.0, c.i - 3) AS C, 100 + 100 * m.i AS max_iter
        FROM range(7) c(i) CROSS JOIN range(10) m(i))
SELECT g.candidate, CAST(g.C AS DOUBLE) AS "C", CAST(g.max_iter AS INTEGER) AS max_iter, t.fold, t.train_weight,
  round(1 / (g.C * t.train_weight), 10) AS penalty FROM t CROSS JOIN g""",
    "accuracy_per_fold": f"""WITH {RULES}
SELECT CAST(candidate AS BIGINT) AS candidate, cut, fold, round(score, 6) AS score FROM scores""",
    "candidate_table": f"""WITH {RULES}
SELECT CAST(r.candidate AS BIGINT) AS candidate, r.cut,
  {", ".join(f"round_even(max(CASE WHEN s.fold = {i} THEN s.score END) * 1000, 0) / 1000 AS split{i}_test_score" for i in range(5))},
  round_even(max(r.mean_score) * 1000, 0) / 1000 AS mean_test_score,
  round_even(max(r.std_score) * 1000, 0) / 1000 AS std_test_score,
  max(r.place) AS rank_test_score
FROM results r JOIN scores s ON s.candidate = r.candidate GROUP BY r.candidate, r.cut""",
    "candidate_ranks": f"WITH {RULES} SELECT cut, place AS rank_test_score FROM results",
    "candidate_best": f"""WITH {RULES} SELECT cut, round(mean_score, 6) AS mean_test_score FROM results
ORDER BY place, candidate LIMIT 1""",
    # scalar functions
    "half_even": """SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS whole,
  round_even(l_extendedprice / 7 * 10, 0) / 10 AS tenth,
  round_even(l_extendedprice / 7 * 1000, 0) / 1000 AS thousandth FROM lineitem""",
    "constant_fill": f"""WITH {ORDERS} SELECT o_orderkey, coalesce(o_orderstatus, '?') AS o_orderstatus,
  coalesce(o_orderpriority, '0-NONE') AS o_orderpriority FROM o""",
    "casts": """SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS flag,
  CAST(floor(o_totalprice / 1000) AS SMALLINT) AS thousands FROM orders""",
    "links": """SELECT o_orderkey, round(1 / (1 + exp(-((o_totalprice - 200000) / 100000))), 9) AS sigmoid,
  round(greatest((o_totalprice - 200000) / 100000, 0), 9) AS relu FROM orders""",
    "decoded": """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS status
FROM orders""",
    # preparation
    "one_hot": f"""SELECT o_orderkey, {_dummies("o_orderstatus", STATUSES)},
  {_dummies("o_orderpriority", PRIORITIES)} FROM orders""",
    "category_order": """SELECT 'p_brand' AS "column", row_number() OVER (ORDER BY p_brand) - 1 AS position, p_brand AS value
FROM (SELECT DISTINCT p_brand FROM part)
UNION ALL SELECT 'p_size', row_number() OVER (ORDER BY p_size) - 1, CAST(p_size AS VARCHAR)
FROM (SELECT DISTINCT p_size FROM part)""",
    "one_hot_missing": f"""WITH {ORDERS} SELECT o_orderkey, {_dummies("o_orderstatus", ["F", "O"])},
  {_dummies("o_orderpriority", [p for p in PRIORITIES if p[0] != "4"])} FROM o""",
    "one_hot_numbers": f"""SELECT l_orderkey, {_dummies("l_linenumber", list(range(1, 8)))}, l_quantity FROM lineitem""",
    "one_hot_unseen": f"""SELECT event_id, {_dummies("event_type", ["click", "purchase", "signup", "view"])} FROM events""",
    "one_hot_missing_category": f"""WITH {ORDERS} SELECT o_orderkey, {_dummies("o_orderstatus", ["F", "O"])},
  CASE WHEN o_orderstatus IS NULL THEN 1 ELSE 0 END AS o_orderstatus_nan FROM o""",
    "mean_fill_1": _fill("round_even(avg({}) * 10, 0) / 10"),
    "mean_fill_0": _fill("round_even(avg({}), 0)"),
    "median_fill": _fill("round_even(quantile_cont({}, 0.5) * 10, 0) / 10"),
    "mode_fill": f"""WITH {ORDERS},
  s AS (SELECT o_orderstatus AS v FROM o WHERE o_orderstatus IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1),
  q AS (SELECT o_orderpriority AS v FROM o WHERE o_orderpriority IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)
SELECT o_orderkey, coalesce(o_orderstatus, (SELECT v FROM s)) AS o_orderstatus,
  coalesce(o_orderpriority, (SELECT v FROM q)) AS o_orderpriority FROM o""",
    "min_max_scale": """WITH s AS (SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_extendedprice) AS x0,
  max(l_extendedprice) AS x1 FROM lineitem WHERE l_linestatus = 'F')
SELECT l_orderkey, l_linenumber, round((l_quantity - q0) / (q1 - q0), 6) AS l_quantity,
  round((l_extendedprice - x0) / (x1 - x0), 6) AS l_extendedprice, CAST(0 AS DOUBLE) AS constant FROM lineitem, s""",
    "standard_scale": """WITH s AS (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(l_extendedprice) AS xm,
  stddev_pop(l_extendedprice) AS xs FROM lineitem WHERE l_linestatus = 'F')
SELECT l_orderkey, l_linenumber, round((l_quantity - qm) / qs, 6) AS l_quantity,
  round((l_extendedprice - xm) / xs, 6) AS l_extendedprice, CAST(0 AS DOUBLE) AS constant FROM lineitem, s""",
    "column_transformer": f"""WITH {EVENTS},
  v AS (SELECT event_id, event_type, coalesce(value, (SELECT round_even(avg(value), 0) FROM e)) AS value FROM e),
  s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM v)
SELECT event_id, round((value - m) / d, 6) AS value,
  {_dummies("event_type", ["click", "error", "purchase", "signup", "view"])} FROM v, s""",
    "column_transformer_own_fill": f"""WITH {LINES},
  m AS (SELECT l_linestatus AS st, round_even(avg(l_extendedprice), 0) AS x, round_even(avg(l_quantity), 0) AS q
        FROM l GROUP BY l_linestatus),
  v AS (SELECT l.*, coalesce(l_extendedprice, x) AS fx, coalesce(l_quantity, q) AS fq FROM l JOIN m ON m.st = l_linestatus),
  s AS (SELECT avg(fx) AS xm, stddev_pop(fx) AS xs, avg(fq) AS qm, stddev_pop(fq) AS qs FROM v WHERE l_linestatus = 'F')
SELECT l_orderkey, l_linenumber, round((fx - xm) / xs, 6) AS l_extendedprice, round((fq - qm) / qs, 6) AS l_quantity,
  {_dummies("l_returnflag", ["A", "N", "R"])} FROM v, s WHERE l_linestatus = 'O'""",
    "prepared": f"""WITH {LINES}, m AS (SELECT round_even(avg(l_extendedprice) * 10, 0) / 10 AS x,
  round_even(avg(l_tax) * 10, 0) / 10 AS t FROM l)
SELECT l_orderkey, l_linenumber, {_dummies("l_returnflag", ["A", "N", "R"])}, {_dummies("l_linestatus", ["F", "O"])},
  l_quantity, coalesce(l_extendedprice, x) AS l_extendedprice, coalesce(l_tax, t) AS l_tax FROM l, m""",
    "prepared_from_train": f"""WITH {LINES},
  m AS (SELECT round_even(avg(l_extendedprice) * 10, 0) / 10 AS x FROM l WHERE l_linestatus = 'F')
SELECT l_orderkey, l_linenumber, {_dummies("l_returnflag", ["A", "N", "R"])}, l_quantity,
  coalesce(l_extendedprice, x) AS l_extendedprice FROM l, m""",
    "prepared_per_frame": f"""WITH {LINES},
  m AS (SELECT l_linestatus AS st, round_even(avg(l_extendedprice) * 10, 0) / 10 AS x FROM l GROUP BY l_linestatus)
SELECT l_orderkey, l_linenumber, {_dummies("l_returnflag", ["A", "N", "R"])}, l_quantity,
  coalesce(l_extendedprice, x) AS l_extendedprice FROM l JOIN m ON m.st = l_linestatus""",
    # models
    "logistic_submission": LEARNED,
    "grid_submission": LEARNED,
    "forest_submission": LEARNED,
    "network_submission": LEARNED,
    "boosting_submission": LEARNED,
    "sparse_submission": LEARNED,
    "sparse_one_hot": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM orders WHERE {c} IN (SELECT {c} FROM orders WHERE o_orderstatus = 'F') GROUP BY {c}"
        for c in ("o_custkey", "o_orderpriority")
    ),
    "logistic_inserted": f"""SELECT doc_id, {RULE} AS continental, {_dummies("lang", ["de", "en", "es", "fr"])},
  {_dummies("source", sorted(f"src{i}" for i in range(20)))}, CAST(n_chars AS DOUBLE) AS n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "linear_probabilities": f"""WITH {FIXED}
SELECT o_orderkey, round_even((1 - p) * 1e6, 0) / 1e6 AS large_0, round_even(p * 1e6, 0) / 1e6 AS large_1 FROM s""",
    "linear_classes": f"WITH {FIXED} SELECT o_orderkey, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS large FROM s",
    "logistic_one_feature": ONE_FEATURE,
    "forest_flag_importances": f"""SELECT 'flag' AS feature, CAST(max({RULE}) AS DOUBLE) AS score FROM documents
UNION ALL SELECT 'constant', CAST(max({RULE}) - 1 AS DOUBLE) FROM documents""",
    "forest_flag_importances_wide": f"""SELECT CAST(max({RULE}) AS DOUBLE) AS flag,
  CAST(max({RULE}) - 1 AS DOUBLE) AS constant FROM documents""",
    "forest_flag_probabilities": f"""SELECT doc_id, CAST(1 - {RULE} AS DOUBLE) AS continental_0,
  CAST({RULE} AS DOUBLE) AS continental_1 FROM documents""",
}
