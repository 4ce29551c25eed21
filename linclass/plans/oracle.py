"""DuckDB SQL for each catalogue query, over the same parquet tables (pre-registered views).

Written independently of the Spark plans: plain SQL aggregates, window ranks for AUC, and
an unrolled CTE chain (one aggregate per iteration) for gradient descent. Parameters are
the catalogue's own constants.
"""

from __future__ import annotations

from linclass.plans import catalogue as C

TWO32 = "4294967296.0"


def fold_sql(key: str, seed: int = C.SEED, names: tuple[str, str] = ("train", "test"), share: float = 0.8) -> str:
    u = f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT / {TWO32}"
    return f"CASE WHEN {u} < {share} THEN '{names[0]}' ELSE '{names[1]}' END"


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


def d(x: float) -> str:
    return f"({x!r})::DOUBLE"


RETURNFLAG = "CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END"


def margin_sql(features: list[str], weights: list[float], intercept: float) -> str:
    terms = [d(intercept)] + [f"{d(w)} * CAST({c} AS DOUBLE)" for c, w in zip(features, weights)]
    return "(" + " + ".join(terms) + ")"


# ---- scans, rules, profile -------------------------------------------------------------
def scan_delimited() -> str:
    nums = ", ".join(f"{r6(f'CAST({c} AS DOUBLE)')} AS {c}" for c in C.SCAN_COLUMNS[:-1])
    return f"SELECT {nums}, l_returnflag FROM lineitem"


LABEL_RECODE = """
SELECT c_custkey,
       CASE WHEN c_acctbal >= 0 THEN 1 ELSE -1 END AS raw_label,
       CAST(CASE WHEN c_acctbal >= 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label
FROM customer"""

DROP_COLUMNS = f"""
SELECT {r6('CAST(p_size AS DOUBLE)')} AS label,
       {r6('CAST(p_partkey AS DOUBLE)')} AS p_partkey,
       {r6('p_retailprice')} AS p_retailprice
FROM part"""

DIMENSIONS = f"SELECT count(*)::BIGINT AS n_rows, {len(C.LINEITEM_ALL)} AS n_columns FROM lineitem"

CLASS_PROFILE = f"""
SELECT l_returnflag AS class, {r6('avg(l_quantity)')} AS mean, min(l_quantity) AS min, max(l_quantity) AS max
FROM lineitem GROUP BY l_returnflag"""

CLASS_COUNTS = "SELECT quality AS class, count(*)::BIGINT AS n FROM labels GROUP BY quality"

CHECK_INPUT = f"""
SELECT CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'click' THEN 0.0 WHEN 'view' THEN 0.0 ELSE 2.0 END AS label,
       value,
       CAST(user_id AS DOUBLE) AS user_id,
       CASE WHEN value > 300 THEN 'inf'::DOUBLE ELSE value END AS spike,
       CASE WHEN value < 1 THEN NULL ELSE value END AS gap,
       1.0::DOUBLE AS flat,
       {fold_sql('event_id')} AS fold
FROM events"""


def data_checks() -> str:
    flag = lambda cond: f"CASE WHEN {cond} THEN 1 ELSE 0 END"
    cnt = lambda cond: f"count(*) FILTER (WHERE {cond})"
    items = [("empty", "*", flag("count(*) = 0"))]
    items += [
        ("null", "label", cnt("label IS NULL")),
        ("label_domain", "label", cnt("label NOT IN (0.0, 1.0)")),
        ("single_class", "label", flag(f"{cnt('label = 1.0')} = 0 OR {cnt('label = 0.0')} = 0")),
    ]
    for c in C.CHECK_FEATURES:
        items += [
            ("null", c, cnt(f"{c} IS NULL")),
            ("non_finite", c, cnt(f"isnan({c}) OR isinf({c})")),
            ("constant", c, flag(f"min({c}) = max({c}) OR count({c}) = 0")),
        ]
    for f in ("train", "test"):
        items += [
            ("empty_fold", f, flag(f"{cnt(f'fold = {chr(39)}{f}{chr(39)}')} = 0")),
            (
                "single_class_fold",
                f,
                flag(f"{cnt(f'fold = {chr(39)}{f}{chr(39)} AND label = 1.0')} = 0 OR "
                     f"{cnt(f'fold = {chr(39)}{f}{chr(39)} AND label = 0.0')} = 0"),
            ),
        ]
    aggs = ", ".join(f"CAST({e} AS BIGINT) AS c{i}" for i, (_, _, e) in enumerate(items))
    rows = "\nUNION ALL ".join(
        f"SELECT '{chk}' AS \"check\", '{col}' AS \"column\", c{i} AS n_bad, c{i} = 0 AS ok FROM agg"
        for i, (chk, col, _) in enumerate(items)
    )
    return f"WITH d AS ({CHECK_INPUT}), agg AS (SELECT {aggs} FROM d)\n{rows}"


def set_aside() -> str:
    ok = " AND ".join(
        ["label IS NOT NULL", "label IN (0.0, 1.0)"]
        + [f"{c} IS NOT NULL AND NOT isnan({c}) AND NOT isinf({c})" for c in C.CHECK_FEATURES]
    )
    return f"""WITH d AS ({CHECK_INPUT})
SELECT CASE WHEN coalesce({ok}, false) THEN 'kept' ELSE 'set_aside' END AS part, count(*)::BIGINT AS n
FROM d GROUP BY 1"""


HASH_SPLIT = f"SELECT o_orderkey, {fold_sql('o_orderkey')} AS fold FROM orders"

def content_folds(content: str, source: str, seed: int = C.SEED) -> str:
    """Rows of ``source`` with their fold from the text of their content and their number among equal rows."""
    unit = f"('0x' || left(md5('{seed}:' || md5({content}) || ':' || (row_number() OVER (PARTITION BY {content}) - 1)), 8))::BIGINT / 4294967296.0"
    return f"SELECT *, CASE WHEN {unit} < 0.8 THEN 'train' ELSE 'test' END AS fold FROM {source}"


RANDOM_SPLIT = f"""
SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (fold = 'train')::BIGINT AS n_train, count(*) FILTER (fold = 'test')::BIGINT AS n_test
FROM ({content_folds("'1:' || o_orderkey", "orders")})"""
LAYOUT_CONTENT = "'3:' || replace(replace(l_linestatus, chr(92), chr(92) || chr(92)), ':', chr(92) || ':') || ':' || l_quantity::INT || ':' || l_linenumber"
RANDOM_FOLDS_LAYOUT = f"""
SELECT 0::BIGINT AS n_moved, count(*)::BIGINT AS n_rows, count(*) FILTER (fold = 'train')::BIGINT AS n_train
FROM ({content_folds(LAYOUT_CONTENT, "lineitem")})"""


# ---- scaling ---------------------------------------------------------------------------
def lineitem_folds(features: list[str]) -> str:
    cols = ", ".join(features)
    return f"SELECT l_orderkey, l_linenumber, {RETURNFLAG} AS label, {cols}, {fold_sql('l_orderkey')} AS fold FROM lineitem"


def scaler_fit() -> str:
    parts = "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std FROM tr"
        for c in C.SCALE_FEATURES
    )
    return f"WITH d AS ({lineitem_folds(C.SCALE_FEATURES)}), tr AS (SELECT * FROM d WHERE fold = 'train')\n{parts}"


def _stats_cte(features: list[str], source: str = "tr") -> str:
    cols = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in features)
    return f"st AS (SELECT {cols} FROM {source})"


def _z(c: str) -> str:
    return f"CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 0.0 ELSE ({c} - m_{c}) * (1.0 / s_{c}) END"


def scaler_transform() -> str:
    zs = ", ".join(f"{r6(_z(c))} AS {c}" for c in C.SCALE_FEATURES)
    return (
        f"WITH d AS ({lineitem_folds(C.SCALE_FEATURES)}), tr AS (SELECT * FROM d WHERE fold = 'train'), "
        f"{_stats_cte(C.SCALE_FEATURES)}\nSELECT l_orderkey, l_linenumber, fold, {zs} FROM d, st"
    )


# ---- scoring and evaluation ------------------------------------------------------------
def _scored(weights: list[float], intercept: float) -> str:
    m = margin_sql(C.LOGIT_FEATURES, weights, intercept)
    return f"SELECT l_orderkey, l_linenumber, l_linestatus, {RETURNFLAG} AS label, {m} AS margin FROM lineitem"


def score_logistic_hard() -> str:
    s = _scored(C.LOGIT_WEIGHTS, C.LOGIT_INTERCEPT)
    return (
        f"WITH s AS ({s}) SELECT l_orderkey, l_linenumber, "
        "CAST(CASE WHEN 1.0 / (1.0 + exp(-margin)) > 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction FROM s"
    )


def score_logistic_soft() -> str:
    s = _scored(C.LOGIT_WEIGHTS, C.LOGIT_INTERCEPT)
    return (
        f"WITH s AS ({s}) SELECT l_orderkey, l_linenumber, {r6('margin')} AS margin, "
        f"{r6('1.0 / (1.0 + exp(-margin))')} AS probability, "
        "CAST(CASE WHEN 1.0 / (1.0 + exp(-margin)) > 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction FROM s"
    )


def score_svm() -> str:
    s = _scored(C.SVM_WEIGHTS, C.SVM_INTERCEPT)
    return (
        f"WITH s AS ({s}) SELECT l_orderkey, l_linenumber, {r6('margin')} AS margin, "
        "CAST(CASE WHEN margin > 0.0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction FROM s"
    )


def balanced_accuracy() -> str:
    s = _scored(C.LOGIT_WEIGHTS, C.LOGIT_INTERCEPT)
    return f"""WITH s AS ({s}),
p AS (SELECT label, CASE WHEN 1.0 / (1.0 + exp(-margin)) > 0.5 THEN 1.0 ELSE 0.0 END AS prediction FROM s),
c AS (SELECT count(*) FILTER (WHERE label = 1.0) AS n_pos, count(*) FILTER (WHERE label = 0.0) AS n_neg,
             count(*) FILTER (WHERE label = 1.0 AND prediction = 1.0) AS tp,
             count(*) FILTER (WHERE label = 0.0 AND prediction = 0.0) AS tn FROM p)
SELECT (n_pos + n_neg)::BIGINT AS n_rows, n_pos::BIGINT AS n_pos, n_neg::BIGINT AS n_neg, tp::BIGINT AS tp,
       tn::BIGINT AS tn, {r6('(tp / n_pos::DOUBLE + tn / n_neg::DOUBLE) / 2.0')} AS balanced_accuracy FROM c"""


def auc_scores() -> str:
    return f"""WITH s AS (
  SELECT l_linestatus AS g, {RETURNFLAG} AS y, l_quantity + 100.0 * l_discount - 50.0 * l_tax AS score FROM lineitem),
r AS (
  SELECT g, y, rank() OVER (PARTITION BY g ORDER BY score)
             + (count(*) OVER (PARTITION BY g, score) - 1) / 2.0 AS avg_rank FROM s)
SELECT g AS l_linestatus, count(*)::BIGINT AS n_rows, sum(y)::BIGINT AS n_pos, (count(*) - sum(y))::BIGINT AS n_neg,
       {r6('(sum(avg_rank) FILTER (WHERE y = 1.0) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))')} AS auc
FROM r GROUP BY g"""


# ---- gradient descent, unrolled --------------------------------------------------------
def sgd_chain(
    features: list[str],
    loss: str,
    penalty: str,
    reg: float,
    iterations: int,
    intercept: bool,
    scaled: bool,
    step: float = 1.0,
    source: str | None = None,
) -> str:
    """CTEs ending in ``w{iterations}`` (columns w0..w{d-1}[, b]) for the train fold.

    ``source`` yields label, the feature columns and fold (default: lineitem)."""
    import math

    dcount = len(features)
    src = source or lineitem_folds(features)
    ctes = [f"d AS ({src})", "tr0 AS (SELECT * FROM d WHERE fold = 'train')"]
    if scaled:
        ctes.append(_stats_cte(features, "tr0"))
        zs = ", ".join(f"{_z(c)} AS x{i}" for i, c in enumerate(features))
        ctes.append(f"tr AS (SELECT label AS y, {zs} FROM tr0, st)")
    else:
        xs = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(features))
        ctes.append(f"tr AS (SELECT label AS y, {xs} FROM tr0)")
    init = [f"0.0::DOUBLE AS w{i}" for i in range(dcount)] + (["1.0::DOUBLE AS b"] if intercept else [])
    ctes.append(f"w0 AS (SELECT {', '.join(init)})")
    names = [f"w{i}" for i in range(dcount)] + (["b"] if intercept else [])
    for t in range(1, iterations + 1):
        margin = "(" + " + ".join(([f"p.b"] if intercept else ["0.0"]) + [f"p.w{i} * tr.x{i}" for i in range(dcount)]) + ")"
        if loss == "logistic":
            mult = f"1.0 / (1.0 + exp(-{margin})) - tr.y"
        else:
            mult = f"CASE WHEN (tr.y * 2.0 - 1.0) * {margin} < 1.0 THEN -(tr.y * 2.0 - 1.0) ELSE 0.0 END"
        sums = [f"sum(m * x{i}) AS g{i}" for i in range(dcount)] + (["sum(m) AS gb"] if intercept else [])
        xs = ", ".join(f"tr.x{i}" for i in range(dcount))
        ctes.append(
            f"g{t} AS (SELECT {', '.join(sums)}, count(*) AS n FROM "
            f"(SELECT {mult} AS m, {xs} FROM tr, w{t - 1} p) q)"
        )
        st = step / math.sqrt(t)
        gnames = [f"g{i}" for i in range(dcount)] + (["gb"] if intercept else [])
        upd = []
        for wn, gn in zip(names, gnames):
            grad = f"(g.{gn} / g.n)"
            if penalty == "l2":
                e = f"p.{wn} * (1.0 - {d(st)} * {d(reg)}) - {d(st)} * {grad}"
            elif penalty == "l1":
                v = f"(p.{wn} - {d(st)} * {grad})"
                e = f"sign({v}) * greatest(0.0, abs({v}) - {d(reg * st)})"
            else:
                e = f"p.{wn} - {d(st)} * {grad}"
            upd.append(f"{e} AS {wn}")
        ctes.append(f"w{t} AS (SELECT {', '.join(upd)} FROM w{t - 1} p, g{t} g)")
    return "WITH " + ",\n".join(ctes)


def sgd_coefficients(features, loss, penalty, intercept, scaled, source=None) -> str:
    chain = sgd_chain(features, loss, penalty, C.SGD_REG, C.SGD_ITERATIONS, intercept, scaled, source=source)
    last = f"w{C.SGD_ITERATIONS}"
    rows = [f"SELECT '{c}' AS variable, w{i} AS coefficient FROM {last}" for i, c in enumerate(features)]
    rows.append(f"SELECT 'Intercept' AS variable, {'b' if intercept else '0.0::DOUBLE'} AS coefficient FROM {last}")
    return chain + ",\ncoef AS (" + "\nUNION ALL ".join(rows) + ")"


def sgd_query(features, loss, penalty, intercept, scaled, source=None) -> str:
    return sgd_coefficients(features, loss, penalty, intercept, scaled, source) + (
        f"\nSELECT variable, {r6('coefficient')} AS coefficient FROM coef"
    )


def embedding_folds() -> str:
    cols = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(C.WIDE_FEATURES))
    return (
        f"SELECT vec_id, CASE WHEN label < {C.WIDE_LABEL_BELOW} THEN 1.0 ELSE 0.0 END AS label, {cols}, "
        f"{fold_sql('vec_id')} AS fold FROM embeddings"
    )


def coefficient_report() -> str:
    return sgd_coefficients(C.LOGIT_FEATURES, "logistic", "l1", True, False) + (
        f"\nSELECT variable, {r6('coefficient')} AS coefficient, coefficient <> 0 AS is_nonzero, "
        "row_number() OVER (ORDER BY coefficient DESC, variable) AS rank FROM coef"
    )


# ---- built-in fits ---------------------------------------------------------------------
LOGIT_CLOSED_FORM = """
WITH d AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS y,
                  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS x FROM orders),
c AS (SELECT sum(y) FILTER (WHERE x = 1) AS p1, count(*) FILTER (WHERE x = 1) AS n1,
             sum(y) FILTER (WHERE x = 0) AS p0, count(*) FILTER (WHERE x = 0) AS n0 FROM d)
SELECT 'urgent' AS variable, round(ln(p1 / (n1 - p1)) - ln(p0 / (n0 - p0)), 4) + 0.0 AS coefficient FROM c
UNION ALL
SELECT 'Intercept' AS variable, round(ln(p0 / (n0 - p0)), 4) + 0.0 AS coefficient FROM c"""


def enet_all_zero() -> str:
    zeros = "\nUNION ALL ".join(f"SELECT '{c}' AS variable, 0.0::DOUBLE AS coefficient" for c in C.SCALE_FEATURES)
    return f"""WITH p AS (SELECT avg({RETURNFLAG}) AS p FROM lineitem),
coef AS ({zeros}
UNION ALL SELECT 'Intercept' AS variable, ln(p / (1 - p)) AS coefficient FROM p)
SELECT variable, {r6('coefficient')} AS coefficient, coefficient <> 0 AS is_nonzero,
       row_number() OVER (ORDER BY coefficient DESC, variable) AS rank FROM coef"""


def doc_folds(seed: int = C.SEED, names: tuple[str, str] = ("train", "test")) -> str:
    return f"""WITH j AS (SELECT d.doc_id, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
f AS (SELECT quality, {fold_sql('doc_id', seed, names)} AS fold FROM j)
SELECT fold, count(*)::BIGINT AS n_rows, sum(quality)::BIGINT AS n_pos,
       -- AUC is defined (and expected above 0.9) only for a fold holding both classes
       (count(*) FILTER (WHERE quality = 1) > 0 AND count(*) FILTER (WHERE quality = 0) > 0) AS auc_ok
FROM f GROUP BY fold"""


RUN_RECORD = f"""
WITH j AS (SELECT d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
f AS (SELECT {fold_sql('doc_id')} AS fold FROM j)
SELECT 'enet' AS job, count(*)::BIGINT AS rows, 5 AS columns, 'quality' AS target,
       count(*) FILTER (WHERE fold = 'train')::BIGINT AS train_rows,
       count(*) FILTER (WHERE fold = 'test')::BIGINT AS test_rows,
       'elastic-net logistic regression' AS model
FROM f"""

def wide_enet_fit() -> str:
    return f"""WITH d AS ({embedding_folds()})
SELECT fold, count(*)::BIGINT AS n_rows, sum(label)::BIGINT AS n_pos FROM d GROUP BY fold"""


MODEL_ROUND_TRIP = """
SELECT count(*)::BIGINT AS n_rows, 0::BIGINT AS n_mismatch
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


CSV_INFERRED = """
SELECT o_orderkey::INTEGER AS o_orderkey, CASE WHEN o_orderkey % 997 = 0 THEN 30.5 ELSE 7.0 END::DOUBLE AS amount, false AS is_corrupt FROM orders"""

LOCAL_TABLE = """
SELECT n_regionkey, count(*)::BIGINT AS n_customers, count(*) FILTER (WHERE c_acctbal < 0)::BIGINT AS n_in_debt
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey"""

CLI_OPTIONS = f"""
SELECT 'logistic' AS job, count(*)::BIGINT AS rows, 6 AS columns, 'quality' AS target, 'doc_id,note' AS excluded, 'l1' AS penalty,
       count(*) FILTER (WHERE fold = 'train')::BIGINT AS train_rows, count(*) FILTER (WHERE fold = 'test')::BIGINT AS test_rows,
       0.02::DOUBLE AS reg, 60::BIGINT AS iterations, 'hash' AS split, true AS model_saved
FROM (SELECT {fold_sql('doc_id')} AS fold FROM documents JOIN labels USING (doc_id))"""

CSV_QUOTED = """
SELECT c_custkey::INTEGER AS c_custkey, (length(c_name) + CASE WHEN c_custkey % 3 = 0 THEN 21 ELSE 0 END)::INTEGER AS n_chars,
       CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE 1 END AS n_lines, c_nationkey, false AS is_corrupt
FROM customer"""

FILE_DIMENSIONS = "SELECT count(*)::BIGINT AS n_rows, 3 AS n_columns FROM orders"


def sgd_nulls() -> str:
    return f"SELECT count(*)::BIGINT AS n_null_rows FROM lineitem WHERE {fold_sql('l_orderkey')} = 'train' AND l_quantity > 45"


def auc_null_scores() -> str:
    return f"""WITH s AS (
  SELECT l_linestatus AS g, CASE WHEN l_quantity = 50 THEN 2.0 ELSE {RETURNFLAG} END AS y,
         CASE WHEN l_discount < 0.015 THEN NULL ELSE l_quantity + 100.0 * l_discount - 50.0 * l_tax END AS score FROM lineitem),
k AS (SELECT * FROM s WHERE y IN (0.0, 1.0) AND score IS NOT NULL),
r AS (
  SELECT g, y, rank() OVER (PARTITION BY g ORDER BY score)
             + (count(*) OVER (PARTITION BY g, score) - 1) / 2.0 AS avg_rank FROM k),
a AS (
  SELECT g, count(*) AS n, sum(y) AS p,
         (sum(avg_rank) FILTER (WHERE y = 1.0) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) AS auc FROM r GROUP BY g)
SELECT s.g AS l_linestatus, any_value(a.n)::BIGINT AS n_rows, any_value(a.p)::BIGINT AS n_pos, any_value(a.n - a.p)::BIGINT AS n_neg,
       (count(*) - any_value(a.n))::BIGINT AS n_dropped, {r6('any_value(a.auc)')} AS auc
FROM s JOIN a ON s.g = a.g GROUP BY s.g"""


FOLD_CHECKS = """
SELECT 'single_class_fold' AS check, fold AS column, 1::BIGINT AS n_bad, fold = 'train' AS is_fatal FROM (VALUES ('train'), ('test')) f(fold)
UNION ALL
SELECT 'null_key', 'event_id', count(*), false FROM events WHERE event_type = 'view'"""

KEY_OR_NONE = "(SELECT CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS k, * FROM orders)"
NO_KEY = "'1:' || chr(92) || 'N'"
HASH_SPLIT_NULLS = f"""
SELECT k IS NOT NULL AS has_key, count(*)::BIGINT AS n_rows, count(*) FILTER (fold = 'train')::BIGINT AS n_train
FROM (SELECT k, {fold_sql('k')} AS fold FROM {KEY_OR_NONE} WHERE k IS NOT NULL
  UNION ALL SELECT k, fold FROM ({content_folds(NO_KEY, KEY_OR_NONE + " WHERE k IS NULL")})) GROUP BY has_key"""

RANDOM_NAMED = f"""
SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (fold = 'train')::BIGINT AS n_training, count(*) FILTER (fold = 'test')::BIGINT AS n_test
FROM ({content_folds("'1:' || l_orderkey", "lineitem", C.R_SEED)})"""


def exact_fit(mix: float, reg: float = C.MARKED_REG, steps: int = 60) -> str:
    """The optimum of the penalised fit from its four counts, by Newton steps in the scaled
    coefficient; the sign of the l1 part is that of the unpenalised effect, and a coefficient
    that would cross zero is zero."""
    l1, l2 = d(reg * mix), d(reg * (1 - mix))
    if mix == 1:  # without a quadratic part the two optimality conditions give both rates
        return f"""WITH t AS (
  SELECT CASE WHEN contains(text, ' | ') OR contains(text, '&&&') THEN 1.0 ELSE 0.0 END::DOUBLE AS x, quality::DOUBLE AS y
  FROM documents JOIN labels USING (doc_id)),
c AS (
  SELECT count(*)::DOUBLE AS n, sum(x) AS n1, sum(1 - x) AS n0, sum(x * y) AS p1, sum(y) AS p,
         stddev_samp(x) AS sd, sign(sum(x * y) / sum(x) - sum((1 - x) * y) / sum(1 - x)) AS s FROM t),
q AS (SELECT *, (p1 - {l1} * s * n * sd) / n1 AS q1, (p - p1 + {l1} * s * n * sd) / n0 AS q0 FROM c),
e AS (SELECT CASE WHEN (q1 - q0) * s > 0 THEN ln(q1 / (1 - q1)) - ln(q0 / (1 - q0)) ELSE 0.0 END AS coefficient,
             CASE WHEN (q1 - q0) * s > 0 THEN ln(q0 / (1 - q0)) ELSE ln(p / (n - p)) END AS intercept FROM q)
SELECT 'marked' AS variable, round(coefficient, 4) + 0.0 AS coefficient FROM e
UNION ALL
SELECT 'Intercept', round(intercept, 4) + 0.0 FROM e"""
    return f"""WITH RECURSIVE t AS (
  SELECT CASE WHEN contains(text, ' | ') OR contains(text, '&&&') THEN 1.0 ELSE 0.0 END::DOUBLE AS x, quality::DOUBLE AS y
  FROM documents JOIN labels USING (doc_id)),
c AS (
  SELECT count(*)::DOUBLE AS n, sum(x) AS n1, sum(1 - x) AS n0, sum(x * y) AS p1, sum((1 - x) * y) AS p0,
         1 / stddev_samp(x) AS u, sign(sum(x * y) / sum(x) - sum((1 - x) * y) / sum(1 - x)) AS s, ln(sum(y) / (count(*) - sum(y))) AS b0 FROM t),
w(i, a, b) AS (
  SELECT 0, 0.0::DOUBLE, b0 FROM c
  UNION ALL
  SELECT i + 1, a - (gb2 * ga - gab * gb) / (ga2 * gb2 - gab * gab), b - (ga2 * gb - gab * ga) / (ga2 * gb2 - gab * gab)
  FROM (
    SELECT i, a, b, u * (n1 * q1 - p1) / n + {l1} * s + {l2} * a AS ga, (n1 * q1 - p1 + n0 * q0 - p0) / n AS gb,
           u * u * n1 * q1 * (1 - q1) / n + {l2} AS ga2, u * n1 * q1 * (1 - q1) / n AS gab,
           (n1 * q1 * (1 - q1) + n0 * q0 * (1 - q0)) / n AS gb2
    FROM (SELECT w.*, c.*, 1 / (1 + exp(-(a * u + b))) AS q1, 1 / (1 + exp(-b)) AS q0 FROM w, c WHERE i < {steps})
  )),
e AS (SELECT CASE WHEN a * s > 0 THEN a * u ELSE 0.0 END AS coefficient, CASE WHEN a * s > 0 THEN b ELSE b0 END AS intercept FROM w, c WHERE i = {steps})
SELECT 'marked' AS variable, round(coefficient, 4) + 0.0 AS coefficient FROM e
UNION ALL
SELECT 'Intercept', round(intercept, 4) + 0.0 FROM e"""


#: The objective is convex, with kinks where a margin is 1 and, between them, the square of the l2
#: penalty or straight lines: its least value is at a kink, at zero or where a piece's slope is zero.
SVM_EXACT = f"""
WITH t AS (
  SELECT CASE WHEN contains(text, ' | ') OR contains(text, '&&&') THEN 1.0 ELSE 0.0 END::DOUBLE AS x, 2.0::DOUBLE * quality - 1 AS s
  FROM documents JOIN labels USING (doc_id)),
m AS (SELECT avg(x) AS mean, stddev_samp(x) AS sd, count(*)::DOUBLE AS n FROM t),
g AS (SELECT s * (x - mean) / sd AS z, count(*) / any_value(n) AS share FROM t, m GROUP BY ALL),
p AS (SELECT * FROM (VALUES ('l1', {d(C.MARKED_REG)}, 0.0::DOUBLE), ('l2', 0.0::DOUBLE, {d(C.MARKED_REG)}), ('none', 0.0::DOUBLE, 0.0::DOUBLE)) AS v(penalty, l1, l2)),
kinks AS (SELECT 1 / z AS w FROM g UNION SELECT 0.0),
pieces AS (SELECT w, coalesce(lead(w) OVER (ORDER BY w), w + 2) AS upper, coalesce(lag(w) OVER (ORDER BY w), w - 2) AS lower FROM kinks),
middles AS (SELECT (w + upper) / 2 AS w FROM pieces UNION SELECT (w + lower) / 2 FROM pieces),
slopes AS (SELECT middles.w, coalesce(sum(-z * share) FILTER (WHERE z * middles.w < 1), 0) AS slope FROM middles, g GROUP BY middles.w),
tried AS (SELECT penalty, l1, l2, w FROM p, kinks UNION SELECT penalty, l1, l2, -slope / l2 FROM p, slopes WHERE l2 > 0),
costs AS (SELECT penalty, w, sum(share * greatest(0, 1 - z * w)) + any_value(l1) * abs(w) + any_value(l2) / 2 * w * w AS cost FROM tried, g GROUP BY penalty, w)
SELECT penalty, round(arg_min(w, cost), 4) + 0.0 AS weight FROM costs GROUP BY penalty"""

FIT_CERTIFICATES = f"""
WITH f AS (SELECT count(*)::BIGINT AS n FROM documents JOIN labels USING (doc_id) WHERE {fold_sql('doc_id')} = 'train')
SELECT fit, n AS train_rows, true AS converged, true AS optimal, true AS iterations_ok
FROM f, (VALUES ('enet'), ('logistic_l1'), ('logistic_l2'), ('svm_l1'), ('svm_none')) AS v(fit)"""


def wide_margins() -> str:
    terms = " + ".join(f"{d(C.wide_weight(i))} * CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(C.WIDE_DIM))
    return f"SELECT vec_id, round(0.25::DOUBLE + {terms}, 4) + 0.0 AS margin FROM embeddings"


JOB_OUTPUTS = f"""
WITH f AS (SELECT {fold_sql('doc_id')} AS fold FROM documents JOIN labels USING (doc_id))
SELECT 'enet' AS job, count(*)::BIGINT AS rows, (count(*) FILTER (WHERE fold = 'train'))::BIGINT AS train_rows,
       (count(*) FILTER (WHERE fold = 'test'))::BIGINT AS test_rows, {len(C.DOC_FEATURES) + 1} AS n_coefficients,
       true AS nonzero_ok, true AS run_ok, true AS model_ok, true AS stamped, 18::BIGINT AS n_checks
FROM f"""


def oracle_sql() -> dict[str, str]:
    return {
        "file_scan": scan_delimited(),
        "file_dimensions": FILE_DIMENSIONS,
        "csv_inferred": CSV_INFERRED,
        "csv_quoted": CSV_QUOTED,
        "local_table": LOCAL_TABLE,
        "cli_options": CLI_OPTIONS,
        "sgd_nulls": sgd_nulls(),
        "auc_null_scores": auc_null_scores(),
        "fold_checks": FOLD_CHECKS,
        "hash_split_nulls": HASH_SPLIT_NULLS,
        "random_named": RANDOM_NAMED,
        "svm_exact": SVM_EXACT,
        "fit_certificates": FIT_CERTIFICATES,
        **{name: exact_fit(mix) for name, mix in C.MARKED_MIX.items()},
        "wide_margins": wide_margins(),
        "job_outputs": JOB_OUTPUTS,
        "scan_delimited": scan_delimited(),
        "label_recode": LABEL_RECODE,
        "drop_columns": DROP_COLUMNS,
        "dimensions": DIMENSIONS,
        "class_profile": CLASS_PROFILE,
        "class_counts": CLASS_COUNTS,
        "data_checks": data_checks(),
        "set_aside": set_aside(),
        "hash_split": HASH_SPLIT,
        "random_split": RANDOM_SPLIT,
        "random_folds_layout": RANDOM_FOLDS_LAYOUT,
        "scaler_fit": scaler_fit(),
        "scaler_transform": scaler_transform(),
        "score_logistic_hard": score_logistic_hard(),
        "score_logistic_soft": score_logistic_soft(),
        "score_svm": score_svm(),
        "balanced_accuracy": balanced_accuracy(),
        "auc_scores": auc_scores(),
        "logit_sgd_l2": sgd_query(C.LOGIT_FEATURES, "logistic", "l2", True, False),
        "logit_sgd_l1": sgd_query(C.LOGIT_FEATURES, "logistic", "l1", True, False),
        "logit_sgd_none": sgd_query(C.LOGIT_FEATURES, "logistic", "none", True, False),
        "svm_sgd_l2": sgd_query(C.SCALE_FEATURES, "hinge", "l2", False, True),
        "svm_sgd_l1": sgd_query(C.SCALE_FEATURES, "hinge", "l1", False, True),
        "wide_logit_sgd": sgd_query(C.WIDE_FEATURES, "logistic", "l2", True, False, embedding_folds()),
        "wide_svm_sgd": sgd_query(C.WIDE_FEATURES, "hinge", "l1", False, True, embedding_folds()),
        "coefficient_report": coefficient_report(),
        "logit_closed_form": LOGIT_CLOSED_FORM,
        "enet_all_zero": enet_all_zero(),
        "enet_fit": doc_folds(),
        "logit_fit": doc_folds(),
        "lasso_fit": doc_folds(),
        "svm_fit": doc_folds(),
        "ridge_fit": doc_folds(C.R_SEED, ("training", "test")),
        "wide_enet_fit": wide_enet_fit(),
        "model_round_trip": MODEL_ROUND_TRIP,
        "run_record": RUN_RECORD,
    }
