"""One query per operator over the star-schema tables; ``oracle`` holds the same in SQL.

The tables have no missing values, so some columns get them by a rule on values:
status 'P' and priority '4-NOT SPECIFIED' count as unknown, a price without a
discount and an event value of type 'error' as not recorded. All rows stay.
"""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabprep.functions import class_weight, decode, relu, round_half_even, sigmoid, threshold
from tabprep.materialize import new_folder
from tabprep.operators.align import join_by_key, positional_concat
from tabprep.operators.encode import fit_one_hot
from tabprep.operators.folds import evenly_spaced, log_spaced, parameter_grid, stratified_folds, with_candidates
from tabprep.operators.frame import (
    LabelledTable,
    drop_columns,
    insert_columns,
    missing_mask,
    name_array,
    preview,
    row_count,
    schema_report,
    scores_to_wide,
    select_columns,
    select_numeric,
    shape,
    slice_columns,
)
from tabprep.operators.impute import Imputer, column_means, column_medians, column_modes, fit_imputer
from tabprep.operators.models import (
    LinearClassifier,
    class_probabilities,
    fit_boosting,
    fit_forest,
    fit_logistic,
    with_threshold,
)
from tabprep.operators.prepare import fit_column_transformer, fit_preparation, prepare_pair
from tabprep.operators.profile import describe, missing_counts, profile, summary, value_counts, value_counts_all
from tabprep.operators.scale import fit_min_max, fit_standard
from tabprep.operators.scoring import (
    accuracy,
    best_candidate,
    candidate_results,
    round_scores,
    submission,
    with_prediction,
)
from tabprep.operators.sparse import fit_sparse_logistic, fit_sparse_one_hot
from tabprep.operators.tune import grid_search
from tabprep.plans.lifecycles import (
    analyze,
    forest_predict,
    logistic_predict,
    network_predict,
    probabilities,
    tune_and_predict,
)
from tabprep.sources import LOGISTIC_TAG, scan_csv, scan_labelled, scan_table, write_csv, write_submission

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# ---- tables -----------------------------------------------------------------


def orders_with_unknowns(spark, folder) -> DataFrame:
    return scan_table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
        "o_totalprice",
        F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')").alias("o_orderpriority"),
    )


def lineitem_with_unknowns(spark, folder) -> DataFrame:
    return scan_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount",
        F.expr("nullif(l_tax, 0D)").alias("l_tax"),
        "l_returnflag",
        "l_linestatus",
    )


def events_with_unknowns(spark, folder) -> DataFrame:
    return scan_table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
    )


def labelled_documents(spark, folder) -> DataFrame:
    """Documents that have labels: the train table."""
    documents = scan_table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(scan_table(spark, folder, "labels"), "doc_id")


def unlabelled_documents(spark, folder) -> DataFrame:
    """Documents without labels: the test table."""
    documents = scan_table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(scan_table(spark, folder, "labels").select("doc_id"), "doc_id", "left_anti")


def orders_to_learn(spark, folder) -> DataFrame:
    """Orders with a label that follows from their columns."""
    return scan_table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
        F.expr("cast(o_totalprice + CASE o_orderstatus WHEN 'F' THEN 90000 ELSE 0 END > 250000 AS int)").alias("large"),
    )


def priced_orders(spark, folder) -> DataFrame:
    """Orders with a rule-based score and prediction."""
    score = sigmoid((F.col("o_totalprice") - 200000.0) / 100000.0)
    return (
        scan_table(spark, folder, "orders")
        .select("o_orderkey", "o_orderstatus", "o_totalprice", score.alias("score"))
        .withColumn("prediction", threshold(F.col("score"), 0.5))
    )


def as_rows(spark, values: dict, schema: str) -> DataFrame:
    return spark.createDataFrame(list(values.items()), schema)


# ---- sources and sinks ------------------------------------------------------


@query
def csv_labelled(spark, folder):
    table = select_columns(
        scan_table(spark, folder, "orders"),
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
    )
    path = write_csv(table, new_folder(spark, "orders-csv"))
    return scan_labelled(spark, path, "o_orderstatus", table.schema).frame


@query
def csv_unlabelled(spark, folder):
    path = write_csv(scan_table(spark, folder, "customer"), new_folder(spark, "customer-csv"))
    return scan_csv(spark, path)


@query
def csv_text(spark, folder):
    table = select_columns(scan_table(spark, folder, "documents"), ["doc_id", "text", "lang", "n_chars"])
    path = write_csv(table, new_folder(spark, "documents-csv"))
    return scan_csv(spark, path, table.schema, multi_line=True)


@query
def csv_padded(spark, folder):
    """Texts keep the white space around them."""
    padded = F.concat(F.lit("  "), "lang", F.lit("\t")).alias("padded")
    table = scan_table(spark, folder, "documents").select("doc_id", padded)
    return scan_csv(spark, write_csv(table, new_folder(spark, "padded-csv")), table.schema)


@query
def csv_inferred(spark, folder):
    """Types found in the cells: whole numbers, numbers, truth values and text."""
    orders = scan_table(spark, folder, "orders")
    table = orders.select("o_orderkey", "o_totalprice", (F.col("o_totalprice") > 200000).alias("large"), "o_orderpriority")
    return scan_csv(spark, write_csv(table, new_folder(spark, "inferred-csv")))


@query
def csv_missing(spark, folder):
    table = orders_with_unknowns(spark, folder)
    path = write_csv(table, new_folder(spark, "unknowns-csv"))
    return missing_counts(scan_csv(spark, path, table.schema))


@query
def submission_csv(spark, folder):
    table = submission(priced_orders(spark, folder), "o_orderkey", "large")
    moment = dt.datetime(2024, 1, 31, 20, 0, tzinfo=dt.timezone.utc)
    path = write_submission(table, LOGISTIC_TAG, moment, root=new_folder(spark, "output"))
    return scan_csv(spark, path, table.schema)


@query
def submission_one_csv(spark, folder):
    """The same as one file, joined of the parts that all tasks write."""
    table = submission(priced_orders(spark, folder), "o_orderkey", "large")
    moment = dt.datetime(2024, 1, 31, 20, 0, tzinfo=dt.timezone.utc)
    path = write_submission(table, LOGISTIC_TAG, moment, root=new_folder(spark, "output"), one_file=True)
    return scan_csv(spark, path, table.schema)


@query
def label_split(spark, folder):
    return LabelledTable(labelled_documents(spark, folder), "quality").labels("doc_id")


@query
def feature_split(spark, folder):
    return LabelledTable(labelled_documents(spark, folder), "quality").features


@query
def label_replace(spark, folder):
    table = LabelledTable(labelled_documents(spark, folder), "quality")
    return table.with_label(F.col("quality") * (1 - F.col("toxic"))).frame


@query
def label_replace_from(spark, folder):
    table = LabelledTable(labelled_documents(spark, folder).drop("toxic"), "quality")
    other = scan_table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("quality"))
    return table.with_label_from(other, "doc_id").frame


@query
def table_rows(spark, folder):
    return row_count(scan_table(spark, folder, "lineitem"))


@query
def prepared_shape(spark, folder):
    table = lineitem_with_unknowns(spark, folder)
    columns = ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"]
    return shape(fit_preparation(table, columns, columns[:2]).transform(table))


# ---- projections ------------------------------------------------------------


@query
def select_features(spark, folder):
    return select_columns(scan_table(spark, folder, "orders"), ["o_orderpriority", "o_orderkey", "o_totalprice"])


@query
def drop_label(spark, folder):
    return drop_columns(scan_table(spark, folder, "supplier"), "s_acctbal")


@query
def insert_derived(spark, folder):
    table = slice_columns(scan_table(spark, folder, "orders"), 0, 4)
    return insert_columns(table, 1, {"large": threshold(F.col("o_totalprice"), 200000.0)})


@query
def column_slice(spark, folder):
    return slice_columns(scan_table(spark, folder, "part"), 2, 5)


@query
def numeric_only(spark, folder):
    return select_numeric(scan_table(spark, folder, "part"))


@query
def missing_values(spark, folder):
    return missing_mask(orders_with_unknowns(spark, folder), keys=["o_orderkey"])


@query
def table_preview(spark, folder):
    table = drop_columns(scan_table(spark, folder, "orders"), "o_orderdate")
    return preview(table, "o_orderkey", max_rows=1000, max_columns=4)


@query
def counts_to_wide(spark, folder):
    table = scan_table(spark, folder, "events")
    names = fit_one_hot(table, ["event_type"]).vocabulary["event_type"]
    return scores_to_wide(value_counts(table, "event_type"), names, "event_type", "n")


@query
def score_threshold(spark, folder):
    return priced_orders(spark, folder).select("o_orderkey", F.round("score", 6).alias("score"), "prediction")


@query
def schema_difference(spark, folder):
    events = scan_table(spark, folder, "events").select("event_type")
    calm = events.where(F.col("event_type") != "error")
    busy = events.where(F.col("event_type") != "view")
    return schema_report(
        fit_one_hot(calm, ["event_type"]).transform(calm), fit_one_hot(busy, ["event_type"]).transform(busy)
    )


@query
def named_probabilities(spark, folder):
    one = F.col("score")
    table = priced_orders(spark, folder).select(
        "o_orderkey", F.array(F.round(1 - one, 6), F.round(one, 6)).alias("p")
    )
    return name_array(table, "p", ["large_0", "large_1"])


# ---- joins ------------------------------------------------------------------


@query
def side_by_side(spark, folder):
    orders = scan_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    customers = scan_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return positional_concat(orders, customers, "o_orderkey", "c_custkey")


@query
def side_by_side_files(spark, folder):
    """The same by the rows' places in their files, which have the order of the keys."""
    orders = scan_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    customers = scan_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return positional_concat(orders, customers)


@query
def prediction_inserted(spark, folder):
    """Predictions of a separate table put in as the second column, by position."""
    documents = scan_table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    predictions = scan_table(spark, folder, "documents").select(
        F.col("doc_id").alias("p_id"), threshold(F.col("n_chars"), 2000).alias("quality")
    )
    return positional_concat(documents, predictions, "doc_id", "p_id", position=1).drop("p_id")


@query
def predictions_by_key(spark, folder):
    orders = scan_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return join_by_key(orders, submission(priced_orders(spark, folder), "o_orderkey", "large"), "o_orderkey")


@query
def predictions_for_some(spark, folder):
    """Ids without a prediction stay, with NULL."""
    orders = scan_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    scored = priced_orders(spark, folder).where("o_totalprice > 100000")
    return join_by_key(orders, submission(scored, "o_orderkey", "large"), "o_orderkey")


# ---- aggregates -------------------------------------------------------------


@query
def category_counts(spark, folder):
    return value_counts(orders_with_unknowns(spark, folder), "o_orderpriority")


@query
def category_counts_all(spark, folder):
    table = orders_with_unknowns(spark, folder)
    return value_counts_all(table, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query
def category_counts_top(spark, folder):
    table = orders_with_unknowns(spark, folder)
    return value_counts_all(table, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"], top_k=3)


@query
def missing_per_column(spark, folder):
    return missing_counts(lineitem_with_unknowns(spark, folder))


def _rounded(table: DataFrame) -> DataFrame:
    return table.select(*[F.round(n, 4).alias(n) if t == "double" else F.col(n) for n, t in table.dtypes])


@query
def numeric_describe(spark, folder):
    return _rounded(describe(lineitem_with_unknowns(spark, folder)))


@query
def numeric_describe_narrowed(spark, folder):
    """The same table where no more than a hundred rows are ever ranked at once."""
    return _rounded(describe(lineitem_with_unknowns(spark, folder), finish_rows=100))


def analyzed(spark, folder):
    """The profile of the documents that have labels."""
    table = labelled_documents(spark, folder).withColumn("source", F.expr("nullif(source, 'src0')"))
    return analyze({"train": table}, "doc_id")["train"]


@query
def analyzed_statistics(spark, folder):
    return _rounded(analyzed(spark, folder).statistics)


@query
def analyzed_missing(spark, folder):
    return analyzed(spark, folder).missing


@query
def analyzed_mask(spark, folder):
    """Per column, how many cells the mask marks and how many it doesn't."""
    mask = analyzed(spark, folder).is_missing
    return mask.groupBy("doc_id", "source", "n_chars").agg(F.count(F.lit(1)).alias("n"))


@query
def analyzed_data(spark, folder):
    return analyzed(spark, folder).data


@query
def table_summary(spark, folder):
    return _rounded(summary(events_with_unknowns(spark, folder)))


@query
def profile_values(spark, folder):
    table = labelled_documents(spark, folder)
    return profile(table, "doc_id", ["doc_id", "lang", "source", "quality", "toxic"]).values


@query
def means(spark, folder):
    found = column_means(lineitem_with_unknowns(spark, folder))
    return as_rows(spark, found, "column string, mean double").withColumn("mean", F.round("mean", 4))


@query
def medians(spark, folder):
    table = lineitem_with_unknowns(spark, folder)
    found = column_medians(table, ["l_quantity", "l_extendedprice", "l_tax"])
    return as_rows(spark, found, "column string, median double").withColumn("median", F.round("median", 4))


@query
def modes(spark, folder):
    found = column_modes(orders_with_unknowns(spark, folder), ["o_orderstatus", "o_orderpriority"])
    return as_rows(spark, found, "column string, mode string")


@query
def column_ranges(spark, folder):
    scaler = fit_min_max(scan_table(spark, folder, "part"), ["p_size", "p_retailprice"])
    rows = [(n, scaler.shift[n], round(scaler.shift[n] + scaler.width[n], 4)) for n in scaler.shift]
    return spark.createDataFrame(rows, "column string, low double, high double")


@query
def column_spreads(spark, folder):
    scaler = fit_standard(scan_table(spark, folder, "customer"), ["c_acctbal"])
    rows = [(n, round(scaler.shift[n], 4), round(scaler.width[n], 4)) for n in scaler.shift]
    return spark.createDataFrame(rows, "column string, mean double, std double")


@query
def rule_accuracy(spark, folder):
    table = labelled_documents(spark, folder).withColumn("guess", threshold(F.col("n_chars"), 500))
    return table.agg(F.round(accuracy(F.col("guess"), F.col("quality")), 6).alias("accuracy"))


# ---- folds, candidates, ranking ---------------------------------------------


@query
def folds(spark, folder):
    table = scan_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_folds(table, "o_orderstatus", "o_orderkey")


@query
def folds_narrowed(spark, folder):
    """The same folds where no more than a hundred keys are ever ranked at once."""
    table = scan_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_folds(table, "o_orderstatus", "o_orderkey", finish_rows=100)


@query
def folds_of_labels(spark, folder):
    return stratified_folds(scan_table(spark, folder, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query
def weighted_classes(spark, folder):
    table = scan_table(spark, folder, "labels")
    return table.select("doc_id", class_weight(F.col("quality"), {0: 1.0, 1: 1.5}).alias("weight"))


@query
def grid_penalties(spark, folder):
    """Penalty of every candidate in every fold: 1 / (C * weight of the fold's training rows)."""
    labels = stratified_folds(scan_table(spark, folder, "labels"), "quality", "doc_id")
    weight = class_weight(F.col("quality"), {0: 1.0, 1: 1.5})
    per_fold = labels.groupBy("fold").agg(F.sum(weight).alias("held_out"))
    # Five rows, one per fold.
    total = F.sum("held_out").over(Window.partitionBy(F.lit(1)))
    per_fold = per_fold.select("fold", (total - F.col("held_out")).alias("train_weight"))
    grid = parameter_grid({"C": log_spaced(-3, 3, 7), "max_iter": evenly_spaced(100, 1000, 10)})
    table = with_candidates(per_fold, grid)
    penalty = F.round(1.0 / (F.col("C") * F.col("train_weight")), 10)
    return table.select("candidate", "C", "max_iter", "fold", "train_weight", penalty.alias("penalty"))


def rule_scores(spark, folder) -> DataFrame:
    """Accuracy of four rules in every fold: one average per rule, then one row for each."""
    table = stratified_folds(labelled_documents(spark, folder), "quality", "doc_id")
    rules = parameter_grid({"cut": [500, 1000, 2000, 4000]})
    scores = [accuracy(threshold(F.col("n_chars"), F.lit(r["cut"]), inclusive=False), F.col("quality")) for r in rules]
    per_fold = table.groupBy("fold").agg(F.array(*scores).alias("scores"))
    score = F.get("scores", F.col("candidate").cast("int")).alias("score")
    return with_candidates(per_fold, rules).select("candidate", "cut", "fold", score)


@query
def accuracy_per_fold(spark, folder):
    return rule_scores(spark, folder).withColumn("score", F.round("score", 6))


@query
def candidate_table(spark, folder):
    return round_scores(candidate_results(rule_scores(spark, folder), ["candidate", "cut"], 5))


@query
def candidate_ranks(spark, folder):
    table = candidate_results(rule_scores(spark, folder), ["candidate", "cut"], 5)
    return table.select("cut", "rank_test_score")


@query
def candidate_best(spark, folder):
    best = best_candidate(candidate_results(rule_scores(spark, folder), ["candidate", "cut"], 5))
    return best.select("cut", F.round("mean_test_score", 6).alias("mean_test_score"))


# ---- scalar functions -------------------------------------------------------


@query
def half_even(spark, folder):
    lines = scan_table(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        round_half_even(F.col("l_quantity") / 2, 0).alias("whole"),
        round_half_even(F.col("l_extendedprice") / 7, 1).alias("tenth"),
        round_half_even(F.col("l_extendedprice") / 7, 3).alias("thousandth"),
    )


@query
def constant_fill(spark, folder):
    table = orders_with_unknowns(spark, folder).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return Imputer({"o_orderstatus": "?", "o_orderpriority": "0-NONE"}, keep_integers=True).transform(table)


@query
def casts(spark, folder):
    orders = scan_table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        (F.col("o_totalprice") > 200000).cast("int").alias("flag"),
        F.floor(F.col("o_totalprice") / 1000).cast("smallint").alias("thousands"),
    )


@query
def links(spark, folder):
    score = (F.col("o_totalprice") - 200000.0) / 100000.0
    orders = scan_table(spark, folder, "orders")
    return orders.select(
        "o_orderkey", F.round(sigmoid(score), 9).alias("sigmoid"), F.round(relu(score), 9).alias("relu")
    )


@query
def decoded(spark, folder):
    legend = {"F": "filled", "O": "open"}
    return scan_table(spark, folder, "orders").select(
        "o_orderkey", decode(F.col("o_orderstatus"), legend).alias("status")
    )


# ---- preparation ------------------------------------------------------------


@query
def one_hot(spark, folder):
    table = scan_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return fit_one_hot(table, ["o_orderstatus", "o_orderpriority"]).transform(table)


@query
def category_order(spark, folder):
    """Categories in the ascending order that names and places the indicator columns."""
    encoder = fit_one_hot(scan_table(spark, folder, "part"), ["p_brand", "p_size"])
    rows = [(c, i, v) for c, values in encoder.vocabulary.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "column string, position bigint, value string")


@query
def one_hot_missing(spark, folder):
    table = orders_with_unknowns(spark, folder).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return fit_one_hot(table, ["o_orderstatus", "o_orderpriority"]).transform(table)


@query
def one_hot_numbers(spark, folder):
    table = scan_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return fit_one_hot(table, ["l_linenumber"]).transform(table)


@query
def one_hot_unseen(spark, folder):
    table = scan_table(spark, folder, "events").select("event_id", "event_type")
    known = table.where(F.col("event_type") != "error")
    return fit_one_hot(known, ["event_type"]).transform(table)


@query
def one_hot_missing_category(spark, folder):
    table = orders_with_unknowns(spark, folder).select("o_orderkey", "o_orderstatus")
    return fit_one_hot(table, ["o_orderstatus"], missing="category").transform(table)


def _fill_lineitem(spark, folder, method, digits):
    table = lineitem_with_unknowns(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax"
    )
    columns = ["l_quantity", "l_extendedprice", "l_tax"]
    return fit_imputer(table, method, digits, columns).transform(table)


@query
def mean_fill_1(spark, folder):
    return _fill_lineitem(spark, folder, "mean", 1)


@query
def mean_fill_0(spark, folder):
    return _fill_lineitem(spark, folder, "mean", 0)


@query
def median_fill(spark, folder):
    return _fill_lineitem(spark, folder, "median", 1)


@query
def mode_fill(spark, folder):
    table = orders_with_unknowns(spark, folder).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return fit_imputer(table, "mode", columns=["o_orderstatus", "o_orderpriority"]).transform(table)


def _scaled(spark, folder, fit):
    table = scan_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_quantity", "l_extendedprice", F.lit(7.0).alias("constant")
    )
    names = ["l_quantity", "l_extendedprice", "constant"]
    scaled = fit(table.where(F.col("l_linestatus") == "F"), names).transform(table)
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(n, 6).alias(n) for n in names])


@query
def min_max_scale(spark, folder):
    return _scaled(spark, folder, fit_min_max)


@query
def standard_scale(spark, folder):
    return _scaled(spark, folder, fit_standard)


@query
def column_transformer(spark, folder):
    table = events_with_unknowns(spark, folder)
    fitted = fit_column_transformer(table, ["value"], ["event_type"])
    return fitted.transform(table, ["event_id"]).withColumn("value", F.round("value", 6))


@query
def column_transformer_own_fill(spark, folder):
    """Statistics of the lines shipped in one state, fill values of the other state's own."""
    table = lineitem_with_unknowns(spark, folder)
    train, test = table.where("l_linestatus = 'F'"), table.where("l_linestatus = 'O'")
    fitted = fit_column_transformer(train, ["l_extendedprice", "l_quantity"], ["l_returnflag"])
    own = fit_imputer(test, "mean", 0, ["l_extendedprice", "l_quantity"])
    ready = fitted.transform(test, ["l_orderkey", "l_linenumber"], own)
    return ready.select(
        "l_orderkey",
        "l_linenumber",
        F.round("l_extendedprice", 6).alias("l_extendedprice"),
        F.round("l_quantity", 6).alias("l_quantity"),
        *ready.columns[4:],
    )


PREPARED = ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_tax"]


@query
def prepared(spark, folder):
    table = lineitem_with_unknowns(spark, folder)
    fitted = fit_preparation(table, PREPARED, PREPARED[:2])
    return fitted.transform(table, ["l_orderkey", "l_linenumber"])


@query
def prepared_from_train(spark, folder):
    table = lineitem_with_unknowns(spark, folder)
    train = table.where(F.col("l_linestatus") == "F")
    columns = ["l_returnflag", "l_quantity", "l_extendedprice"]
    _, ready = prepare_pair(train, table, columns, columns[:1], keys=((), ["l_orderkey", "l_linenumber"]))
    return ready


@query
def prepared_per_frame(spark, folder):
    table = lineitem_with_unknowns(spark, folder)
    train, test = table.where(F.col("l_linestatus") == "F"), table.where(F.col("l_linestatus") == "O")
    columns, keys = ["l_returnflag", "l_quantity", "l_extendedprice"], ["l_orderkey", "l_linenumber"]
    ready, other = prepare_pair(train, test, columns, columns[:1], per_frame=True, keys=(keys, keys))
    return ready.unionByName(other)


# ---- models -----------------------------------------------------------------

# The label is a rule of the language, which every model can learn, so SQL can state what they predict.
RULE = "CAST(lang IN ('de', 'fr') AS INT) AS continental"
DOCUMENT = {"columns": ["lang", "source", "n_chars"], "encode": ["lang", "source"], "label": "continental", "key": "doc_id"}


def rule_documents(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Train and test table: documents with labels, with the rule as label, and those without."""
    train = labelled_documents(spark, folder).selectExpr("doc_id", "lang", "source", "n_chars", RULE)
    return train, unlabelled_documents(spark, folder)


# Fixed coefficients, whose probabilities and classes are plain arithmetic.
FIXED = LinearClassifier(("o_totalprice", "o_shippriority"), (0.00002, -0.75), -3.1)


def fixed_scores(spark, folder) -> DataFrame:
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("o_shippriority")
    return FIXED.transform(scan_table(spark, folder, "orders").select("o_orderkey", "o_totalprice", urgent))


@query
def linear_probabilities(spark, folder):
    return class_probabilities(fixed_scores(spark, folder), "o_orderkey", "large", digits=6)


@query
def linear_classes(spark, folder):
    return submission(fixed_scores(spark, folder), "o_orderkey", "large")


@query
def logistic_one_feature(spark, folder):
    """Coefficient and intercept for a single 0/1 feature, with class weights and penalty."""
    table = scan_table(spark, folder, "orders").selectExpr("int(o_orderstatus = 'F') AS filled", "int(o_totalprice > 200000) AS large")
    model = fit_logistic(table, ["filled"], "large", C=0.01, class_weights={0: 1.0, 1: 1.5})
    rows = [("filled", round(model.coefficients[0], 3)), ("intercept", round(model.intercept, 3))]
    return spark.createDataFrame(rows, "feature string, score double")


def flag_forest(spark, folder):
    """A forest on one column that is the label and one that says nothing."""
    documents = scan_table(spark, folder, "documents").selectExpr("doc_id", RULE)
    table = documents.select("doc_id", "continental", F.col("continental").alias("flag"), F.lit(1).alias("constant"))
    model = fit_forest(table, ["flag", "constant"], "continental", n_trees=20, max_depth=3, key="doc_id")
    return table, model


@query
def forest_flag_importances(spark, folder):
    table, model = flag_forest(spark, folder)
    return model.scores(table)


@query
def forest_flag_importances_wide(spark, folder):
    table, model = flag_forest(spark, folder)
    return scores_to_wide(model.scores(table), model.features)


@query
def forest_flag_probabilities(spark, folder):
    table, model = flag_forest(spark, folder)
    return class_probabilities(model.transform(table), "doc_id", "continental")


@query
def logistic_submission(spark, folder):
    tables = rule_documents(spark, folder)
    return logistic_predict(*tables, **DOCUMENT).submission


@query
def logistic_coefficients(spark, folder):
    tables = rule_documents(spark, folder)
    outcome = logistic_predict(*tables, **DOCUMENT)
    scores = outcome.model.scores(tables[0])
    return scores_to_wide(scores, outcome.features)


@query
def logistic_probabilities(spark, folder):
    tables = rule_documents(spark, folder)
    return probabilities(logistic_predict(*tables, **DOCUMENT), "doc_id", "continental")


@query
def logistic_inserted(spark, folder):
    tables = rule_documents(spark, folder)
    outcome = logistic_predict(*tables, **DOCUMENT)
    return with_prediction(outcome.scored, "continental")


@query
def grid_submission(spark, folder):
    tables = rule_documents(spark, folder)
    return tune_and_predict(*tables, **DOCUMENT, class_weights={0: 1.0, 1: 1.5}).submission


@query
def grid_results(spark, folder):
    """Grid search over all orders."""
    table = orders_to_learn(spark, folder)
    columns = ["o_orderstatus", "o_orderpriority", "o_totalprice"]
    ready = fit_preparation(table, columns, columns[:2]).transform(table, ["o_orderkey", "large"])
    return round_scores(grid_search(ready, ready.columns[2:], "large", "o_orderkey").results)


@query
def forest_submission(spark, folder):
    tables = rule_documents(spark, folder)
    return forest_predict(*tables, **DOCUMENT).submission


@query
def forest_importances(spark, folder):
    tables = rule_documents(spark, folder)
    outcome = forest_predict(*tables, **DOCUMENT)
    return outcome.model.scores(tables[0])


@query
def network_submission(spark, folder):
    tables = rule_documents(spark, folder)
    return network_predict(*tables, ["n_chars"], ["lang", "source"], "continental", "doc_id", epochs=60).submission


@query
def sparse_one_hot(spark, folder):
    """Customers and priorities of filled orders as categories; how many of all orders have each."""
    orders = scan_table(spark, folder, "orders")
    fitted = fit_sparse_one_hot(orders.where("o_orderstatus = 'F'"), ["o_custkey", "o_orderpriority"])
    return fitted.counts(orders).withColumnRenamed("column", "feature")


@query
def sparse_submission(spark, folder):
    """As ``logistic_submission``, with the length as a category: almost one for each row, most of them new to the model."""
    train, test = rule_documents(spark, folder)
    model = fit_sparse_logistic(train, [], ["lang", "source", "n_chars"], "continental", C=10.0)
    return submission(model.transform(test), "doc_id", "continental")


@query
def boosting_submission(spark, folder):
    train, test = rule_documents(spark, folder)
    fitted = fit_preparation(train, DOCUMENT["columns"], DOCUMENT["encode"])
    model = fit_boosting(fitted.transform(train, ["doc_id", "continental"]), fitted.feature_names, "continental", key="doc_id")
    scored = with_threshold(model.transform(fitted.transform(test, ["doc_id"])))
    return submission(scored, "doc_id", "continental")
