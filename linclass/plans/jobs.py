"""The reference's jobs as functions: load -> check -> prepare -> split -> fit -> save ->
score -> evaluate -> report.

* ``logistic_job``  penalised logistic regression, l1 / l2 / none (default: converged
  fit; ``mode="sgd"`` runs the gradient-descent rules);
* ``enet_job``      elastic-net logistic regression, 10 iterations, model saved;
* ``svm_job``       standardise with train statistics, then a linear SVM (L2 by the
  built-in trainer, L1 and none by planes to a duality gap; ``mode="sgd"`` runs the
  gradient-descent rules); penalty and lambda are honoured;
* ``ridge_job``     the R script: CSV with inferred types, class profile of one column,
  named 80/20 partitions, ridge logistic regression.

Only small things reach the driver: the header line, one row of check counts, the model's
coefficients, per-iteration gradient sums in sgd mode, and one metrics row per fold.
Training rows are persisted around the fit and released after it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.operators.certificate import logistic_residual
from linclass.operators.checks import checks_frame, enforce, failures, require_classes, run_checks, set_aside
from linclass.functions.expressions import col
from linclass.operators.columns import LABEL, Columns, prepare, resolve_columns, safe_names
from linclass.operators.evaluate import binary_metrics
from linclass.operators.fit import (
    coefficients,
    fit_pipeline,
    logistic_pipeline,
    penalised_logistic,
    svm_pipeline,
)
from linclass.operators.profile import class_profile
from linclass.operators.report import coefficient_table, run_record
from linclass.operators.scale import fit_scaler, scaled_expr
from linclass.operators.score import score
from linclass.operators.sgd import sgd_fit
from linclass.operators.split import FOLD, hash_split, random_folds
from linclass.operators.svm import bundle_fit
from linclass.session import checkpoint_root
from linclass.sources.delimited import CORRUPT, load_csv_inferred, load_delimited
from linclass.sources.models import save_model, timestamped_path
from linclass.sources.reports import write_tables

STAMP = "%Y-%m-%dT%H:%M:%S"
# The names under which the jobs save their models, which users look for.
MODEL_NAMES = {"logistic": "model.lr", "enet": "model.reglog", "svm": "model.svm"}


@dataclass
class JobConfig:
    job: str  # logistic | enet | svm | ridge
    target: str = "Target"
    excluded: Sequence[str] = ()
    sep: str = ","
    penalty: str = "l2"
    reg: float = 0.01
    mix: float = 0.0  # elastic-net L1 share
    iterations: int = 100
    mode: str = "converged"  # converged | sgd
    key: str | Sequence[str] | None = None  # hash-split key; None = the content of each row
    split: str = "hash"  # hash | random
    weights: Mapping[str, float] = field(default_factory=lambda: {"train": 0.8, "test": 0.2})
    seed: int = 11
    strict: bool = True
    out_dir: str | None = None
    model_path: str | None = None
    save: bool = True
    model_prefix: str = "model"
    timestamped: bool = False
    profile_column: str | None = None
    # persist: cache the narrow prepared rows for checks, fit and metrics; checkpoint: write
    # them to spark.checkpoint.dir (lineage cut); none: no job-level copy - each of the
    # three reads the source once and the trainer keeps its own single cache (least memory)
    stage: str = "persist"
    # spread the narrow prepared rows evenly over the cluster's cores before they are
    # cached (one shuffle of d + 2 columns); for inputs read by few tasks, such as
    # non-splittable compressed files, where every later pass would wait on those tasks
    rebalance: bool = False


@dataclass
class JobResult:
    config: JobConfig
    columns: Columns
    run: DataFrame
    coefficients: DataFrame
    checks: DataFrame
    metrics: DataFrame
    scored: DataFrame
    model: object
    model_path: str | None
    set_aside: DataFrame | None = None
    profile: DataFrame | None = None
    sgd_iterations: int | None = None
    class_counts: DataFrame | None = None


def _load(spark: SparkSession, source, cfg: JobConfig) -> tuple[DataFrame, list[str], str | None, str]:
    if type(source).__name__ == "DataFrame" and type(source).__module__.startswith("pandas"):
        source = spark.createDataFrame(source)  # S5: a local table copied to Spark (Arrow)
    if isinstance(source, DataFrame):
        names = [c for c in source.columns if c != CORRUPT]
        return source, names, (CORRUPT if CORRUPT in source.columns else None), "<DataFrame>"
    if cfg.job == "ridge":
        df = load_csv_inferred(spark, source, cfg.sep)
        return df, [c for c in df.columns if c != CORRUPT], CORRUPT, str(source)
    df, header = load_delimited(spark, source, cfg.sep, string_columns=cfg.excluded)
    return df, header.names, CORRUPT, str(source)


def _model_path(cfg: JobConfig) -> str | None:
    if not cfg.save:
        return None
    if cfg.model_path:
        return cfg.model_path
    if cfg.out_dir is None:
        return None
    if cfg.timestamped:
        return timestamped_path(cfg.out_dir, cfg.model_prefix)
    return f"{cfg.out_dir.rstrip('/')}/{cfg.model_prefix}"


def _iterations(model) -> int | None:
    """Iterations of a built-in trainer, as its summary has them."""
    last = model.stages[-1]
    if not getattr(last, "hasSummary", False):
        return None
    summary = last.summary() if callable(last.summary) else last.summary
    return int(summary.totalIterations)


def _fit(spark: SparkSession, train: DataFrame, features: list[str], cfg: JobConfig):
    """(model, how the fit ended: ``iterations_run``, ``converged``, and for planes ``optimality``)."""
    if cfg.mode not in ("converged", "sgd"):
        raise ValueError(f"mode must be 'converged' or 'sgd', got {cfg.mode!r}")
    if cfg.mode == "sgd" and cfg.job not in ("logistic", "svm"):
        raise ValueError(f"sgd mode is for the logistic and svm jobs, not {cfg.job!r}")
    if cfg.mode == "sgd" and cfg.job == "logistic":
        model, trace = sgd_fit(train, features, LABEL, "logistic", cfg.penalty, cfg.reg, cfg.iterations, intercept=True)
        return model, {"iterations_run": trace.iterations, "converged": trace.converged}
    if cfg.job == "svm" and (cfg.mode == "sgd" or cfg.penalty != "l2"):
        stats = fit_scaler(train, features)
        inputs = [scaled_expr(stats, i) for i in range(len(features))]
        if cfg.mode == "sgd":
            model, trace = sgd_fit(train, features, LABEL, "hinge", cfg.penalty, cfg.reg, cfg.iterations, intercept=False, inputs=inputs)
            end = {"iterations_run": trace.iterations, "converged": trace.converged}
        else:
            model, trace = bundle_fit(train, features, LABEL, cfg.penalty, cfg.reg, cfg.iterations, inputs=inputs)
            end = {"iterations_run": trace.passes, "converged": trace.converged, "optimality": trace.gap}
        model.means, model.stds = stats.means, stats.stds
        return model, end
    if cfg.job == "logistic":
        pipe = penalised_logistic(features, cfg.penalty, cfg.reg, max_iter=cfg.iterations)
    elif cfg.job in ("enet", "ridge"):
        pipe = logistic_pipeline(features, reg=cfg.reg, elastic_net=cfg.mix, max_iter=cfg.iterations)
    elif cfg.job == "svm":
        pipe = svm_pipeline(features, reg=cfg.reg, max_iter=cfg.iterations)
    else:
        raise ValueError(f"unknown job {cfg.job!r}")
    model = fit_pipeline(pipe, train, persist=False)
    run = _iterations(model)
    return model, {"iterations_run": run, "converged": None if run is None else run < cfg.iterations}


def optimality(train: DataFrame, features: list[str], model, cfg: JobConfig) -> float | None:
    """Residual of a logistic fit's optimality conditions at the returned weights; None for a hinge
    loss, whose slope jumps (fits by planes report their duality gap)."""
    if cfg.job == "svm":
        return None
    weights, intercept = coefficients(model)
    share = cfg.mix if cfg.job in ("enet", "ridge") else {"l1": 1.0, "l2": 0.0, "none": 0.0}[cfg.penalty]
    reg = 0.0 if cfg.job == "logistic" and cfg.penalty == "none" else cfg.reg
    by_steps = cfg.mode == "sgd"
    return logistic_residual(train, features, weights, intercept, LABEL, reg * share, reg * (1 - share), scaled_penalty=not by_steps, intercept_penalty=by_steps)


def run_job(spark: SparkSession, source, cfg: JobConfig) -> JobResult:
    started = datetime.now().strftime(STAMP)
    cfg = replace(cfg)
    raw, names, corrupt, input_name = _load(spark, source, cfg)
    cols = resolve_columns(names, cfg.target, cfg.excluded)
    keys = [] if cfg.key is None else ([cfg.key] if isinstance(cfg.key, str) else list(cfg.key))
    carry = [k for k in keys if k not in (cfg.target, *cols.features)] + ([corrupt] if corrupt else [])
    # features under names every ML stage accepts (reports use the original names)
    safe = safe_names(cols.features, reserved=[LABEL, FOLD, *carry])
    feats = [safe[c] for c in cols.features]
    # the R script fits its response as it is; the other jobs read -1 as 0
    prepared = prepare(raw, cols, keep=carry, recode=cfg.job != "ridge", rename=safe)

    if len(cfg.weights) != 2:
        raise ValueError("two folds are expected: train and test")
    split_cols: list[str] = []
    if cfg.split == "hash":
        # a key that is also a feature or the target is hashed under its prepared name
        split_cols = [safe.get(k, LABEL if k == cfg.target else k) for k in keys]
        data = hash_split(prepared, split_cols or None, cfg.weights, cfg.seed)
    elif cfg.split == "random":
        data = random_folds(prepared, cfg.weights, cfg.seed)
    else:
        raise ValueError(f"split must be 'hash' or 'random', got {cfg.split!r}")

    profile = None
    if cfg.profile_column is not None:
        profile = class_profile(raw, cfg.target, cfg.profile_column)

    # The narrow prepared rows (label, d doubles, key, fold) are read by the checks, the
    # fit (many times) and the metrics: parse / derive them once. A lost block is
    # recomputed from the scan by lineage.
    if cfg.rebalance:
        data = data.repartition(spark.sparkContext.defaultParallelism)
    if cfg.stage == "checkpoint":
        # a written copy in the shared checkpoint folder: lineage cut, survives lost executors
        checkpoint_root(spark)
        data = data.checkpoint(eager=True)
        return _run_prepared(spark, cfg, data, raw, names, cols, feats, corrupt, input_name, profile, started, split_cols)
    if cfg.stage == "none":
        return _run_prepared(spark, cfg, data, raw, names, cols, feats, corrupt, input_name, profile, started, split_cols)
    if cfg.stage != "persist":
        raise ValueError(f"stage must be 'persist', 'checkpoint' or 'none', got {cfg.stage!r}")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _run_prepared(spark, cfg, data, raw, names, cols, feats, corrupt, input_name, profile, started, split_cols)
    finally:
        data.unpersist()


def _run_prepared(spark, cfg, data, raw, names, cols, feats, corrupt, input_name, profile, started, split_cols) -> JobResult:
    train_name, test_name = list(cfg.weights)
    fold_names = [train_name, test_name]
    check_rows, counts = run_checks(
        data,
        LABEL,
        feats,
        fold_col=FOLD,
        fold_names=fold_names,
        corrupt_col=corrupt,
        key_columns=split_cols,
        extra={
            "rows": F.count(F.lit(1)),
            **{
                f"{f}|{c}": F.count_if((F.col(FOLD) == f) & (F.col(LABEL) == float(c)))
                for f in fold_names
                for c in (0, 1)
            },
        },
    )
    # A3: rows per fold and class, from the same pass
    class_counts = spark.createDataFrame(
        [(f, c, int(counts[f"{f}|{c}"])) for f in fold_names for c in (0, 1)],
        "fold string, class int, n bigint",
    )
    original = dict(zip(feats, cols.features))
    for r in check_rows:
        r["column"] = original.get(r["column"], r["column"])
    enforce(check_rows, cfg.strict, train_name)
    aside = None
    if not cfg.strict:
        data, aside = set_aside(data, LABEL, feats, corrupt)
        require_classes(data, LABEL, FOLD, train_name)

    train = data.where(F.col(FOLD) == train_name).select(*[col(c) for c in [LABEL, *feats]])
    model, end = _fit(spark, train, feats, cfg)
    if "optimality" not in end:
        end["optimality"] = optimality(train, feats, model, cfg)

    path = _model_path(cfg)
    if path is not None:
        save_model(model, path, spark)

    scored = score(model, data)
    plan = binary_metrics(scored, LABEL, "margin", "prediction", by=[FOLD])
    rows = plan.collect()  # one row per fold
    metrics = spark.createDataFrame(rows, plan.schema)
    by_fold = {r[FOLD]: r for r in rows}

    weights, intercept = coefficients(model)
    coeffs = coefficient_table(spark, cols.features, weights, intercept)
    n_nonzero = sum(1 for v in [*weights, intercept] if v != 0.0)
    finished = datetime.now().strftime(STAMP)

    def metric(fold: str, name: str):
        r = by_fold.get(fold)
        return None if r is None else r[name]

    params = {"reg": cfg.reg, "iterations": cfg.iterations, "mode": cfg.mode, "seed": cfg.seed, "split": cfg.split, **end}
    if cfg.job in ("enet", "ridge"):
        params["elastic_net"] = cfg.mix
    model_kind = {
        "logistic": "logistic regression",
        "enet": "elastic-net logistic regression",
        "ridge": "ridge logistic regression",
        "svm": "linear svm",
    }[cfg.job]
    run = run_record(
        spark,
        {
            "job": cfg.job,
            "input": input_name,
            "rows": int(counts["rows"]),
            "columns": len(names),
            "target": cfg.target,
            "excluded": list(cols.excluded),
            "started_at": started,
            "finished_at": finished,
            "model": model_kind,
            "penalty": "elasticnet" if cfg.job == "enet" else ("l2" if cfg.job == "ridge" else cfg.penalty),
            "parameters": params,
            "model_path": path,
            "train_rows": metric(train_name, "n_rows"),
            "test_rows": metric(test_name, "n_rows"),
            "auc_train": metric(train_name, "auc"),
            "auc_test": metric(test_name, "auc"),
            "balanced_accuracy_train": metric(train_name, "balanced_accuracy"),
            "balanced_accuracy_test": metric(test_name, "balanced_accuracy"),
            "split_ratio": [float(v) for v in cfg.weights.values()],
            "n_nonzero": n_nonzero,
            "checks_failed": [f"{r['check']}({r['column']})" for r in failures(check_rows, fatal_only=False)],
        },
    )
    checks = checks_frame(spark, check_rows)
    if cfg.out_dir is not None:
        tables = {"run": run, "coefficients": coeffs, "checks": checks, "class_counts": class_counts}
        if profile is not None:
            tables["profile"] = profile
        write_tables(tables, f"{cfg.out_dir.rstrip('/')}/report.{cfg.job}")
    return JobResult(
        config=cfg,
        columns=cols,
        run=run,
        coefficients=coeffs,
        checks=checks,
        metrics=metrics,
        scored=scored,
        model=model,
        model_path=path,
        set_aside=aside,
        profile=profile,
        sgd_iterations=end["iterations_run"] if cfg.mode == "sgd" else None,
        class_counts=class_counts,
    )


def logistic_job(
    spark: SparkSession,
    source,
    target: str = "Target",
    excluded: Sequence[str] = (),
    sep: str = ",",
    penalty: str = "l2",
    reg: float = 0.01,
    mode: str = "converged",
    out_dir: str | None = None,
    **kw,
) -> JobResult:
    """Penalised logistic regression (l1, l2 or none); model saved under a time stamp."""
    kw.setdefault("model_prefix", MODEL_NAMES["logistic"])
    kw.setdefault("timestamped", True)
    cfg = JobConfig("logistic", target, excluded, sep, penalty, reg, mode=mode, out_dir=out_dir, **kw)
    return run_job(spark, source, cfg)


def enet_job(
    spark: SparkSession,
    source,
    target: str = "Target",
    excluded: Sequence[str] = (),
    sep: str = ",",
    reg: float = 0.01,
    mix: float = 0.8,
    iterations: int = 10,
    out_dir: str | None = None,
    **kw,
) -> JobResult:
    """Elastic-net logistic regression: ``reg`` = lambda, ``mix`` = L1 share."""
    kw.setdefault("model_prefix", MODEL_NAMES["enet"])
    cfg = JobConfig("enet", target, excluded, sep, "elasticnet", reg, mix, iterations, out_dir=out_dir, **kw)
    return run_job(spark, source, cfg)


def svm_job(
    spark: SparkSession,
    source,
    target: str = "Target",
    excluded: Sequence[str] = (),
    sep: str = ",",
    penalty: str = "l2",
    reg: float = 0.01,
    iterations: int = 100,
    mode: str = "converged",
    out_dir: str | None = None,
    **kw,
) -> JobResult:
    """Standardised linear SVM without intercept; ``iterations`` bounds the passes of any trainer."""
    kw.setdefault("model_prefix", MODEL_NAMES["svm"])
    cfg = JobConfig("svm", target, excluded, sep, penalty, reg, 0.0, iterations, mode, out_dir=out_dir, **kw)
    return run_job(spark, source, cfg)


def ridge_job(
    spark: SparkSession,
    source,
    response: str = "Creditability",
    excluded: Sequence[str] = (),
    profile_column: str | None = None,
    reg: float = 0.01,
    iterations: int = 100,
    sep: str = ",",
    seed: int = 1099,
    out_dir: str | None = None,
    **kw,
) -> JobResult:
    """The R script: ridge logistic regression (alpha 0) on all columns but the response
    (and ``excluded``, e.g. a key), class profile of ``profile_column``, named partitions
    ``training`` / ``test`` from seed 1099. The response must be 0 or 1: the script does not
    recode it."""
    kw.setdefault("model_prefix", "model.ridge")
    kw.setdefault("weights", {"training": 0.8, "test": 0.2})
    cfg = JobConfig(
        "ridge", response, excluded, sep, "l2", reg, 0.0, iterations, seed=seed, out_dir=out_dir, profile_column=profile_column, **kw
    )
    return run_job(spark, source, cfg)
