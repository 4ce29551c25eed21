"""

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables. Doubles are rounded
to 6 places (+ 0.0 clears -0.0) so that the DuckDB oracle in ``oracle.py`` can compare
values exactly; counts are bigint.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.functions.expressions import distinct_word_share, non_letter_share, recode_label
from linclass.operators.checks import data_checks, failures, row_ok, run_checks
from linclass.operators.columns import LABEL, prepare, resolve_columns
from linclass.operators.evaluate import auc, balanced_accuracy
from linclass.operators.fit import coefficients, fit_pipeline, penalised_logistic, logistic_pipeline
from linclass.operators.linear import LinearModel
from linclass.operators.profile import class_counts, class_profile, dimensions
from linclass.operators.report import coefficient_frame, coefficient_table
from linclass.operators.scale import fit_scaler, scaled_expr, scaler_stats_frame, apply_scaler
from linclass.operators.score import score
from linclass.operators.sgd import NullRowsError, sgd_fit
from linclass.operators.split import FOLD, hash_split, random_folds
from linclass.operators.svm import bundle_fit
from linclass.plans import cli, jobs
from linclass.plans.jobs import enet_job, logistic_job, ridge_job, svm_job
from linclass.session import scratch_path
from linclass.sources.delimited import CORRUPT, lines_from_table, load_csv_inferred, load_delimited, parse_lines
from linclass.sources.models import load_model, save_model

# ---- fixed values shared with oracle.py (query parameters) ---------------------------
SEED = 11
R_SEED = 1099
SPLIT_SEP = "|"
SCAN_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
LINEITEM_ALL = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
PART_EXCLUDED = ["p_name", "p_brand", "p_type"]
SCALE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LOGIT_FEATURES = ["l_quantity", "l_discount", "l_tax"]
LOGIT_WEIGHTS = [0.0173, -2.91, 3.37]
LOGIT_INTERCEPT = -0.4519
SVM_WEIGHTS = [0.0231, -4.13, 2.77]
SVM_INTERCEPT = -0.5527
SGD_ITERATIONS = 5
SGD_REG = 0.01
DOC_FEATURES = ["n_chars", "non_letter", "distinct_share"]
CHECK_FEATURES = ["value", "user_id", "spike", "gap", "flat"]
WIDE_DIM = 64
WIDE_FEATURES = [f"e{i}" for i in range(WIDE_DIM)]
WIDE_LABEL_BELOW = 5


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c: str | Column) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x, 6) + F.lit(0.0)


def returnflag_label() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(0.0))


def lineitem_folds(spark: SparkSession, sf_dir: str, features: list[str]) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", returnflag_label().alias(LABEL), *features)
    return hash_split(li, "l_orderkey", seed=SEED, nulls=False)


def doc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents + labels: features computed from whole texts before the join (text never
    shuffles), then joined to the labelled ids."""
    docs = _t(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        non_letter_share("text").alias("non_letter"),
        distinct_word_share("text").alias("distinct_share"),
    )
    labels = _t(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id")


# ---- sources, column rules, profile ----------------------------------------------------
def q_scan_delimited(spark, sf_dir):
    lines, header = lines_from_table(_t(spark, sf_dir, "lineitem"), SCAN_COLUMNS, SPLIT_SEP)
    # the header line sits among the data lines, as in a folder of files with a header each
    with_header = lines.unionByName(spark.createDataFrame([(header.line,)], "value string"))
    parsed = parse_lines(with_header, header, string_columns=["l_returnflag"])
    return parsed.select(*[r6(c).alias(c) for c in SCAN_COLUMNS[:-1]], "l_returnflag")


def q_label_recode(spark, sf_dir):
    cu = _t(spark, sf_dir, "customer")
    raw = F.when(F.col("c_acctbal") >= 0, F.lit(1)).otherwise(F.lit(-1))
    return cu.select("c_custkey", raw.alias("raw_label"), recode_label(raw).alias("label"))


def q_drop_columns(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    cols = resolve_columns(part.columns, "p_size", PART_EXCLUDED)
    prepared = prepare(part, cols, recode=False)
    return prepared.select(*[r6(c).alias(c) for c in prepared.columns])


def q_dimensions(spark, sf_dir):
    lines, header = lines_from_table(_t(spark, sf_dir, "lineitem"), LINEITEM_ALL, ",")
    with_header = lines.unionByName(spark.createDataFrame([(header.line,)], "value string"))
    text_cols = ["l_returnflag", "l_linestatus", "l_shipdate"]
    parsed = parse_lines(with_header, header, string_columns=text_cols)
    return dimensions(parsed, n_columns=len(header.names))


def q_class_profile(spark, sf_dir):
    prof = class_profile(_t(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity")
    return prof.select("class", r6("mean").alias("mean"), "min", "max")


def q_class_counts(spark, sf_dir):
    return class_counts(_t(spark, sf_dir, "labels"), "quality")


def check_input(spark, sf_dir) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    raw = (
        F.when(F.col("event_type") == "purchase", F.lit(1.0))
        .when(F.col("event_type") == "click", F.lit(0.0))
        .when(F.col("event_type") == "view", F.lit(-1.0))
        .otherwise(F.lit(2.0))
    )
    v = F.col("value")
    df = ev.select(
        "event_id",
        recode_label(raw).alias(LABEL),
        v.alias("value"),
        F.col("user_id").cast("double").alias("user_id"),
        F.when(v > 300, F.lit(float("inf"))).otherwise(v).alias("spike"),
        F.when(v < 1, F.lit(None).cast("double")).otherwise(v).alias("gap"),
        F.lit(1.0).alias("flat"),
    )
    return hash_split(df, "event_id", seed=SEED, nulls=False)


def q_data_checks(spark, sf_dir):
    return data_checks(check_input(spark, sf_dir), LABEL, CHECK_FEATURES, fold_col=FOLD)


def q_set_aside(spark, sf_dir):
    """Rows kept / set aside by the permissive mode's row rule, in one pass."""
    ok = row_ok(LABEL, CHECK_FEATURES)
    part = F.when(ok, F.lit("kept")).otherwise(F.lit("set_aside")).alias("part")
    return check_input(spark, sf_dir).groupBy(part).agg(F.count(F.lit(1)).alias("n"))


# ---- split, scaling ----------------------------------------------------------------------
def q_hash_split(spark, sf_dir):
    return hash_split(_t(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", seed=SEED, nulls=False)


def fold_counts(rows: DataFrame, **names: str) -> DataFrame:
    """Number of rows, and of those in each named fold."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(FOLD) == fold).alias(c) for c, fold in names.items()])


def q_random_split(spark, sf_dir):
    """Folds without a key: every row is one of a kind, so its content decides alone."""
    return fold_counts(random_folds(_t(spark, sf_dir, "orders").select("o_orderkey"), seed=SEED), n_train="train", n_test="test")


def q_random_folds_layout(spark, sf_dir):
    """Rows that change their fold when the table is dealt to other partitions, in another order.
    Equal rows are told apart by nothing, so what is compared is each content's number in each fold."""
    rows = _t(spark, sf_dir, "lineitem").select("l_linestatus", "l_quantity", "l_linenumber")
    count = lambda df, sign: random_folds(df, seed=SEED).groupBy("l_linestatus", "l_quantity", "l_linenumber", FOLD).agg((sign * F.count(F.lit(1))).alias("n"))
    rows = rows.withColumn("l_quantity", F.col("l_quantity").cast("int"))
    other = rows.repartition(7, "l_linenumber").sortWithinPartitions(F.desc("l_quantity"))
    both = count(rows, 1).union(count(other, -1)).groupBy("l_linestatus", "l_quantity", "l_linenumber", FOLD).agg(F.max("n").alias("n"), F.sum("n").alias("moved"))
    return both.agg(F.sum(F.abs("moved")).alias("n_moved"), F.sum("n").alias("n_rows"), F.sum(F.when(F.col(FOLD) == "train", F.col("n"))).alias("n_train"))


def q_scaler_fit(spark, sf_dir):
    train = lineitem_folds(spark, sf_dir, SCALE_FEATURES).where(F.col(FOLD) == "train")
    stats = scaler_stats_frame(train, SCALE_FEATURES)
    return stats.select("feature", r6("mean").alias("mean"), r6("std").alias("std"))


def q_scaler_transform(spark, sf_dir):
    data = lineitem_folds(spark, sf_dir, SCALE_FEATURES)
    stats = fit_scaler(data.where(F.col(FOLD) == "train"), SCALE_FEATURES)
    scaled = apply_scaler(data, stats)
    return scaled.select("l_orderkey", "l_linenumber", FOLD, *[r6(c).alias(c) for c in SCALE_FEATURES])


# ---- scoring and evaluation with given weights ------------------------------------------
def _fixed_logit() -> LinearModel:
    return LinearModel(LOGIT_FEATURES, LOGIT_WEIGHTS, LOGIT_INTERCEPT, loss="logistic")


def _fixed_svm() -> LinearModel:
    return LinearModel(LOGIT_FEATURES, SVM_WEIGHTS, SVM_INTERCEPT, loss="hinge")


def _lineitem_scored(spark, sf_dir, model: LinearModel) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", returnflag_label().alias(LABEL), *LOGIT_FEATURES
    )
    return score(model, li)


def q_score_logistic_hard(spark, sf_dir):
    return _lineitem_scored(spark, sf_dir, _fixed_logit()).select("l_orderkey", "l_linenumber", "prediction")


def q_score_logistic_soft(spark, sf_dir):
    s = _lineitem_scored(spark, sf_dir, _fixed_logit())
    return s.select("l_orderkey", "l_linenumber", r6("margin").alias("margin"), r6("probability").alias("probability"), "prediction")


def q_score_svm(spark, sf_dir):
    s = _lineitem_scored(spark, sf_dir, _fixed_svm())
    return s.select("l_orderkey", "l_linenumber", r6("margin").alias("margin"), "prediction")


def q_balanced_accuracy(spark, sf_dir):
    ba = balanced_accuracy(_lineitem_scored(spark, sf_dir, _fixed_logit()), LABEL, "prediction")
    return ba.select("n_rows", "n_pos", "n_neg", "tp", "tn", r6("balanced_accuracy").alias("balanced_accuracy"))


def tie_score() -> Column:
    return F.col("l_quantity") + F.lit(100.0) * F.col("l_discount") - F.lit(50.0) * F.col("l_tax")


def q_auc_scores(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_linestatus", returnflag_label().alias(LABEL), tie_score().alias("score"))
    res = auc(li, LABEL, "score", by=["l_linestatus"])
    return res.select("l_linestatus", "n_rows", "n_pos", "n_neg", r6("auc").alias("auc"))


# ---- gradient-descent fits (5 iterations, exact unrolled oracles) -----------------------
def _coef_rows(spark, model: LinearModel) -> DataFrame:
    w, b = coefficients(model)
    return coefficient_frame(spark, model.features, w, b)


def _logit_sgd(spark, sf_dir, penalty: str) -> LinearModel:
    train = lineitem_folds(spark, sf_dir, LOGIT_FEATURES).where(F.col(FOLD) == "train")
    model, _ = sgd_fit(train, LOGIT_FEATURES, LABEL, "logistic", penalty, SGD_REG, SGD_ITERATIONS, intercept=True)
    return model


def _svm_sgd(spark, sf_dir, penalty: str) -> LinearModel:
    train = lineitem_folds(spark, sf_dir, SCALE_FEATURES).where(F.col(FOLD) == "train")
    stats = fit_scaler(train, SCALE_FEATURES)
    inputs = [scaled_expr(stats, i) for i in range(len(SCALE_FEATURES))]
    model, _ = sgd_fit(
        train, SCALE_FEATURES, LABEL, "hinge", penalty, SGD_REG, SGD_ITERATIONS, intercept=False, inputs=inputs
    )
    model.means, model.stds = stats.means, stats.stds
    return model


def _coef_query(penalty: str, svm: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        model = _svm_sgd(spark, sf_dir, penalty) if svm else _logit_sgd(spark, sf_dir, penalty)
        return _coef_rows(spark, model).select("variable", r6("coefficient").alias("coefficient"))

    return run


def embedding_folds(spark, sf_dir) -> DataFrame:
    """embeddings: one double column per vector element, label = class below 5."""
    emb = _t(spark, sf_dir, "embeddings")
    df = emb.select(
        "vec_id",
        F.when(F.col("label") < WIDE_LABEL_BELOW, F.lit(1.0)).otherwise(F.lit(0.0)).alias(LABEL),
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(WIDE_FEATURES)],
    )
    return hash_split(df, "vec_id", seed=SEED, nulls=False)


def _wide_query(loss: str, penalty: str) -> Callable[[SparkSession, str], DataFrame]:
    """64 features: per-partition gradient blocks in NumPy over Arrow batches."""

    def run(spark, sf_dir):
        train = embedding_folds(spark, sf_dir).where(F.col(FOLD) == "train")
        inputs = stats = None
        if loss == "hinge":
            stats = fit_scaler(train, WIDE_FEATURES)
            inputs = [scaled_expr(stats, i) for i in range(WIDE_DIM)]
        model, _ = sgd_fit(
            train,
            WIDE_FEATURES,
            LABEL,
            loss,
            penalty,
            SGD_REG,
            SGD_ITERATIONS,
            intercept=(loss == "logistic"),
            inputs=inputs,
        )
        if stats is not None:
            model.means, model.stds = stats.means, stats.stds
        return _coef_rows(spark, model).select("variable", r6("coefficient").alias("coefficient"))

    return run


def q_coefficient_report(spark, sf_dir):
    model = _logit_sgd(spark, sf_dir, "l1")
    rep = coefficient_table(spark, model.features, model.weights, model.intercept)
    return rep.select("variable", r6("coefficient").alias("coefficient"), "is_nonzero", "rank")


# ---- built-in fits ---------------------------------------------------------------------
def q_logit_closed_form(spark, sf_dir):
    od = _t(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.lit(1.0)).otherwise(F.lit(0.0)).alias(LABEL),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1.0)).otherwise(F.lit(0.0)).alias("urgent"),
    )
    model = fit_pipeline(penalised_logistic(["urgent"], "none", tol=1e-12, max_iter=100), od)
    w, b = coefficients(model)
    rows = coefficient_frame(spark, ["urgent"], w, b)
    return rows.select("variable", (F.round("coefficient", 4) + F.lit(0.0)).alias("coefficient"))


def q_enet_all_zero(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select(returnflag_label().alias(LABEL), *SCALE_FEATURES)
    model = fit_pipeline(logistic_pipeline(SCALE_FEATURES, reg=0.5, elastic_net=0.8, max_iter=10), li)
    w, b = coefficients(model)
    rep = coefficient_table(spark, SCALE_FEATURES, w, b)
    return rep.select("variable", r6("coefficient").alias("coefficient"), "is_nonzero", "rank")


def _fold_summary(result) -> DataFrame:
    m = result.metrics
    return m.select(FOLD, "n_rows", "n_pos", (F.coalesce(F.col("auc"), F.lit(0.0)) > 0.9).alias("auc_ok"))


def _doc_job(job, **kw):
    def run(spark, sf_dir):
        res = job(spark, doc_table(spark, sf_dir), save=False, **kw)
        return _fold_summary(res)

    return run


DOC_ARGS = {"target": "quality", "excluded": ["doc_id"], "key": "doc_id"}


def q_ridge_fit(spark, sf_dir):
    res = ridge_job(
        spark, doc_table(spark, sf_dir), response="quality", excluded=["doc_id"], key="doc_id", save=False
    )
    return _fold_summary(res)


def q_wide_enet_fit(spark, sf_dir):
    """The elastic-net job on 64 embedding features (its label is noise, so only the exact
    parts are reported: rows and positives per fold)."""
    emb = embedding_folds(spark, sf_dir).drop(FOLD)
    res = enet_job(spark, emb, target=LABEL, excluded=["vec_id"], key="vec_id", save=False)
    return res.metrics.select(FOLD, "n_rows", "n_pos")


def q_model_round_trip(spark, sf_dir):
    data = doc_table(spark, sf_dir)
    res = enet_job(spark, data, save=False, **DOC_ARGS)
    path = scratch_path(spark, "models")
    save_model(res.model, path, spark)
    loaded = load_model(spark, path)
    # scores of the fitted model (as expressions) against Spark ML's transform of the
    # reloaded model: equal predictions, margins equal up to summation order
    first = score(res.model, data).select("doc_id", *DOC_FEATURES, F.col("margin").alias("m1"), F.col("prediction").alias("p1"))
    both = score(loaded, first, native=False)
    mismatch = (F.abs(F.col("m1") - F.col("margin")) > 1e-9) | (F.col("p1") != F.col("prediction"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(mismatch).alias("n_mismatch"))


def q_run_record(spark, sf_dir):
    res = enet_job(spark, doc_table(spark, sf_dir), save=False, **DOC_ARGS)
    # the fields of the run record that do not depend on the fitted weights
    return res.run.select("job", "rows", "columns", "target", "train_rows", "test_rows", "model")


# ---- files, outputs and defined cases -----------------------------------------------------
def q_file_scan(spark, sf_dir):
    """lineitem written as a folder of delimited files, each with its header, and read back."""
    path = scratch_path(spark, "files")
    _t(spark, sf_dir, "lineitem").select(*SCAN_COLUMNS).write.csv(path, sep=SPLIT_SEP, header=True)
    rows, _ = load_delimited(spark, path, SPLIT_SEP, string_columns=["l_returnflag"])
    return rows.where(F.col(CORRUPT).isNull()).select(*[r6(c).alias(c) for c in SCAN_COLUMNS[:-1]], "l_returnflag")


def q_file_dimensions(spark, sf_dir):
    path = scratch_path(spark, "files")
    _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").write.csv(path, header=True)
    rows, header = load_delimited(spark, path)
    return dimensions(rows, n_columns=len(header.names))


def q_local_table(spark, sf_dir):
    """A local table (one row for each nation) copied to Spark by the jobs' loader and joined to the
    customers, whose account balances are profiled by the local table's column."""
    local = _t(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").toPandas()  # 25 rows at every size
    nations, names, corrupt, _ = jobs._load(spark, local, jobs.JobConfig("logistic"))
    rows = nations.select(*names).join(_t(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.col("n_regionkey").cast("int").alias("n_regionkey")).agg(F.count(F.lit(1)).alias("n_customers"), F.count_if(F.col("c_acctbal") < 0).alias("n_in_debt"))


def q_cli_options(spark, sf_dir):
    """A job as the command line starts it: every option of the logistic job on a delimited file
    of the labelled documents, and what its run record says of them."""
    path, out = scratch_path(spark, "cli"), scratch_path(spark, "cli-out")
    doc_table(spark, sf_dir).withColumn("note", F.lit("left out")).write.csv(path, sep="|", header=True)
    argv = ["logistic", "-f", path, "-s", "|", "-t", "quality", "-c", "doc_id", "note", "-p", "l1", "-r", "0.02", "-d", out, "--key", "doc_id", "--iterations", "60"]
    record = cli.run(spark, cli.options(argv)).run.first()
    p = json.loads(record["parameters"])
    saved = load_model(spark, record["model_path"])
    row = (record["job"], record["rows"], record["columns"], record["target"], ",".join(record["excluded"]), record["penalty"], record["train_rows"], record["test_rows"], p["reg"], p["iterations"], p["split"], coefficients(saved)[0] != [])
    return spark.createDataFrame([row], "job string, rows bigint, columns int, target string, excluded string, penalty string, train_rows bigint, test_rows bigint, reg double, iterations bigint, split string, model_saved boolean")


def q_csv_quoted(spark, sf_dir):
    """Customers written with line breaks, separators and quotes inside quoted names, over several
    files and splits, and read back: whole records, none marked as bad."""
    path = scratch_path(spark, "csv")
    name = F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, F.lit('\nsecond, "line"\n\nlast')).otherwise(F.lit("")))
    _t(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), "c_nationkey").repartition(3, "c_custkey").write.csv(path, header=True, escape='"', quoteAll=True)
    rows = load_csv_inferred(spark, path)
    return rows.select("c_custkey", F.length("name").alias("n_chars"), F.size(F.split("name", "\n")).alias("n_lines"), "c_nationkey", F.col(CORRUPT).isNotNull().alias("is_corrupt"))


def q_csv_inferred(spark, sf_dir):
    """A column that is whole numbers in all but the rows of its last file is read as what it is."""
    path = scratch_path(spark, "csv")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 997 == 0, F.lit("30.5")).otherwise(F.lit("7")).alias("amount"))
    od.repartition(4).sortWithinPartitions("amount", ascending=False).write.csv(path, header=True)
    rows = load_csv_inferred(spark, path)
    return rows.select("o_orderkey", F.col("amount").cast("double").alias("amount"), F.col(CORRUPT).isNotNull().alias("is_corrupt"))


def q_sgd_nulls(spark, sf_dir):
    """A fit on rows with nulls is refused, and the error counts them."""
    li = lineitem_folds(spark, sf_dir, LOGIT_FEATURES).where(F.col(FOLD) == "train")
    holes = li.withColumn("l_tax", F.when(F.col("l_quantity") > 45, F.lit(None).cast("double")).otherwise(F.col("l_tax")))
    try:
        sgd_fit(holes, LOGIT_FEATURES, LABEL, "logistic", "l2", SGD_REG, SGD_ITERATIONS)
        n = 0
    except NullRowsError as e:
        n = e.n_rows
    return spark.createDataFrame([(n,)], "n_null_rows bigint")


def q_auc_null_scores(spark, sf_dir):
    """Rows without a score or with a label outside 0/1 are counted, not lost."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_linestatus",
        F.when(F.col("l_quantity") == 50, F.lit(2.0)).otherwise(returnflag_label()).alias(LABEL),
        F.when(F.col("l_discount") < 0.015, F.lit(None).cast("double")).otherwise(tie_score()).alias("score"),
    )
    res = auc(li, LABEL, "score", by=["l_linestatus"])
    return res.select("l_linestatus", "n_rows", "n_pos", "n_neg", "n_dropped", r6("auc").alias("auc"))


def q_fold_checks(spark, sf_dir):
    """Checks that stop a strict run on a train fold with one class and keys that are null."""
    ev = _t(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "view", F.lit(None).cast("long")).otherwise(F.col("event_id")).alias("event_id"),
        F.col("value"),
        F.when(F.col("event_id") % 2 == 0, F.lit("train")).otherwise(F.lit("test")).alias(FOLD),
        (F.col("event_id") % 2).cast("double").alias(LABEL),
    )
    rows, _ = run_checks(ev, LABEL, ["value"], fold_col=FOLD, key_columns=["event_id"])
    fatal = {(r["check"], r["column"]) for r in failures(rows, train="train")}
    out = [(r["check"], r["column"], r["n_bad"], (r["check"], r["column"]) in fatal) for r in rows if not r["ok"]]
    return spark.createDataFrame(out, "check string, column string, n_bad bigint, is_fatal boolean")


def q_hash_split_nulls(spark, sf_dir):
    """Rows with a key have the fold of the key; the others, all equal, are spread by their number."""
    od = _t(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("long")).otherwise(F.col("o_orderkey")).alias("k"))
    train = F.count_if(F.col(FOLD) == "train")
    return hash_split(od, "k", seed=SEED).groupBy(F.col("k").isNotNull().alias("has_key")).agg(F.count(F.lit(1)).alias("n_rows"), train.alias("n_train"))


def q_random_named(spark, sf_dir):
    """Partitions without a key under the names of the R script; rows of an order are equal here."""
    rows = random_folds(_t(spark, sf_dir, "lineitem").select("l_orderkey"), {"training": 0.8, "test": 0.2}, R_SEED)
    return fold_counts(rows, n_training="training", n_test="test")


MARKED_REG = 0.02
MARKED_MIX = {"logit_l2_exact": 0.0, "logit_l1_exact": 1.0, "enet_exact": 0.6, "ridge_exact": 0.0}


def marked_docs(spark, sf_dir) -> DataFrame:
    """Labelled documents with one 0/1 feature: whether the text holds a table bar or a run of marks."""
    odd = F.col("text").contains(" | ") | F.col("text").contains("&&&")
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.when(odd, F.lit(1.0)).otherwise(F.lit(0.0)).alias("marked"))
    return docs.join(_t(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality")), "doc_id")


def _exact_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Coefficients of a converged penalised fit, where four counts determine the optimum."""

    def run(spark, sf_dir):
        data = marked_docs(spark, sf_dir).select(F.col("quality").alias(LABEL), "marked")
        pipe = logistic_pipeline(["marked"], reg=MARKED_REG, elastic_net=MARKED_MIX[name], tol=1e-13, max_iter=500)
        w, b = coefficients(fit_pipeline(pipe, data))
        rows = coefficient_frame(spark, ["marked"], w, b)
        return rows.select("variable", (F.round("coefficient", 4) + F.lit(0.0)).alias("coefficient"))

    return run


def q_svm_exact(spark, sf_dir):
    """Weight of the standardised feature in a linear SVM with each penalty, by planes."""
    data = marked_docs(spark, sf_dir).select(F.col("quality").alias(LABEL), "marked")
    stats = fit_scaler(data, ["marked"])
    rows = []
    for penalty in ("l1", "l2", "none"):
        model, _ = bundle_fit(data, ["marked"], LABEL, penalty, MARKED_REG, tol=1e-10, inputs=[scaled_expr(stats, 0)])
        rows.append((penalty, model.weights[0]))
    return spark.createDataFrame(rows, "penalty string, weight double").select("penalty", (F.round("weight", 4) + F.lit(0.0)).alias("weight"))


def q_fit_certificates(spark, sf_dir):
    """How each kind of job ended, from its run record: whether the optimum's conditions are met
    to 1e-3 by the returned weights (for an SVM by planes: to the duality gap asked for)."""
    docs = marked_docs(spark, sf_dir)
    own = {"target": "quality", "excluded": ["doc_id"], "key": "doc_id", "save": False}
    runs = {
        "enet": lambda: enet_job(spark, docs, reg=MARKED_REG, iterations=100, **own),
        "logistic_l1": lambda: logistic_job(spark, docs, penalty="l1", reg=MARKED_REG, **own),
        "logistic_l2": lambda: logistic_job(spark, docs, penalty="l2", reg=MARKED_REG, **own),
        "svm_l1": lambda: svm_job(spark, docs, penalty="l1", reg=MARKED_REG, **own),
        "svm_none": lambda: svm_job(spark, docs, penalty="none", **own),
    }
    ends = []
    for name, run in runs.items():
        record = run().run.first()
        p = json.loads(record["parameters"])
        ends.append((name, record["train_rows"], bool(p["converged"]), 0 <= p["optimality"] < 1e-3, 0 < p["iterations_run"] <= 100))
    return spark.createDataFrame(ends, "fit string, train_rows bigint, converged boolean, optimal boolean, iterations_ok boolean")


def wide_weight(i: int) -> float:
    return ((i * 37) % 11 - 5) / 10


def q_wide_margins(spark, sf_dir):
    """64 features scored with fixed weights."""
    emb = embedding_folds(spark, sf_dir)
    model = LinearModel(WIDE_FEATURES, [wide_weight(i) for i in range(WIDE_DIM)], 0.25)
    return score(model, emb).select("vec_id", (F.round("margin", 4) + F.lit(0.0)).alias("margin"))


def q_job_outputs(spark, sf_dir):
    """An elastic-net job with its outputs on disk: the time-stamped model, saved twice to one
    path, and the report tables, read back and compared with what the job returned."""
    out = scratch_path(spark, "job")
    res = enet_job(spark, doc_table(spark, sf_dir), out_dir=out, timestamped=True, **DOC_ARGS)
    save_model(res.model, res.model_path, spark)
    loaded = load_model(spark, res.model_path)
    report = f"{out}/report.enet"
    run, coeffs, checks = (spark.read.schema(df.schema).json(f"{report}/{t}") for t, df in (("run", res.run), ("coefficients", res.coefficients), ("checks", res.checks)))
    now = res.run.first()
    kept = run.first()
    written = {r["variable"]: r["coefficient"] for r in coeffs.collect()}
    same_fields = all(kept[f] == now[f] for f in ("auc_train", "auc_test", "train_rows", "test_rows", "n_nonzero", "model_path", "parameters"))
    w, b = coefficients(loaded)
    same_model = written == {**dict(zip(DOC_FEATURES, w)), "Intercept": b}
    stamped = res.model_path.rsplit("/", 1)[1].startswith("model.reglog.")
    nonzero = sum(v != 0 for v in written.values())
    return spark.createDataFrame(
        [(kept["job"], kept["rows"], kept["train_rows"], kept["test_rows"], len(written), nonzero == kept["n_nonzero"], same_fields, same_model, stamped, checks.count())],
        "job string, rows bigint, train_rows bigint, test_rows bigint, n_coefficients int, nonzero_ok boolean, run_ok boolean, model_ok boolean, stamped boolean, n_checks bigint",
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elastic net on document features: one row per fold with AUC, balanced accuracy and
    the number of non-zero coefficients."""
    res = enet_job(spark, doc_table(spark, sf_dir), save=False, **DOC_ARGS)
    n_nonzero = res.run.first()["n_nonzero"]
    return res.metrics.withColumn("n_nonzero", F.lit(n_nonzero).cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_delimited": q_scan_delimited,
    "label_recode": q_label_recode,
    "drop_columns": q_drop_columns,
    "dimensions": q_dimensions,
    "class_profile": q_class_profile,
    "class_counts": q_class_counts,
    "data_checks": q_data_checks,
    "set_aside": q_set_aside,
    "hash_split": q_hash_split,
    "random_split": q_random_split,
    "random_folds_layout": q_random_folds_layout,
    "scaler_fit": q_scaler_fit,
    "scaler_transform": q_scaler_transform,
    "score_logistic_hard": q_score_logistic_hard,
    "score_logistic_soft": q_score_logistic_soft,
    "score_svm": q_score_svm,
    "balanced_accuracy": q_balanced_accuracy,
    "auc_scores": q_auc_scores,
    "logit_sgd_l2": _coef_query("l2", svm=False),
    "logit_sgd_l1": _coef_query("l1", svm=False),
    "logit_sgd_none": _coef_query("none", svm=False),
    "svm_sgd_l2": _coef_query("l2", svm=True),
    "svm_sgd_l1": _coef_query("l1", svm=True),
    "wide_logit_sgd": _wide_query("logistic", "l2"),
    "wide_svm_sgd": _wide_query("hinge", "l1"),
    "coefficient_report": q_coefficient_report,
    "logit_closed_form": q_logit_closed_form,
    "enet_all_zero": q_enet_all_zero,
    "enet_fit": _doc_job(enet_job, **DOC_ARGS),
    "logit_fit": _doc_job(logistic_job, penalty="l2", **DOC_ARGS),
    "lasso_fit": _doc_job(logistic_job, penalty="l1", **DOC_ARGS),
    "svm_fit": _doc_job(svm_job, **DOC_ARGS),
    "ridge_fit": q_ridge_fit,
    "wide_enet_fit": q_wide_enet_fit,
    "model_round_trip": q_model_round_trip,
    "run_record": q_run_record,
    "file_scan": q_file_scan,
    "file_dimensions": q_file_dimensions,
    "csv_inferred": q_csv_inferred,
    "csv_quoted": q_csv_quoted,
    "local_table": q_local_table,
    "cli_options": q_cli_options,
    "sgd_nulls": q_sgd_nulls,
    "auc_null_scores": q_auc_null_scores,
    "fold_checks": q_fold_checks,
    "hash_split_nulls": q_hash_split_nulls,
    "random_named": q_random_named,
    "svm_exact": q_svm_exact,
    "fit_certificates": q_fit_certificates,
    **{name: _exact_query(name) for name in MARKED_MIX},
    "wide_margins": q_wide_margins,
    "job_outputs": q_job_outputs,
}
