"""Evaluation and explanation tables on the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from .block_queries import rounded
from .registry import query
from .roles import Roles, cte

_SCORED = cte("scored")


@query(
    "category_class_share",
    """WITH t AS (SELECT o_custkey AS c, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS class FROM orders), n AS (SELECT *, count(*) OVER (PARTITION BY c) AS total FROM t)
       SELECT CAST(n.c AS VARCHAR) || ': ' || total AS c, class, round(100.0::DOUBLE * count(*) / total, 6) AS percentage FROM n WHERE total >= 12 GROUP BY n.c, class, total""",
)
def category_class_share(spark, path):
    df = Roles(spark, path).table("orders").select(
        F.col("o_custkey").alias("c"), F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("class")
    )
    return rounded(ev.class_share(df, "c", "class", 12), ["percentage"])


_IMP = "SELECT p_name AS feature, l_linenumber AS fold, avg(l_quantity) AS importance FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"


def _importance(r):
    li, p = r.table("lineitem"), r.table("part")
    return (
        li.join(p, li["l_partkey"] == p["p_partkey"])
        .groupBy(F.col("p_name").alias("feature"), F.col("l_linenumber").alias("fold"))
        .agg(F.avg("l_quantity").alias("importance"))
    )


@query(
    "importance_summary",
    f"SELECT feature, round(avg(importance), 6) AS average_importance FROM ({_IMP}) GROUP BY 1 ORDER BY avg(importance) DESC, feature LIMIT 30",
)
def importance_summary(spark, path):
    return rounded(ev.importance_summary(_importance(Roles(spark, path)), 30), ["average_importance"])


_POINTS = """pts AS (SELECT score, sum(class) AS pos, count(*) AS n FROM scored GROUP BY 1),
 cum AS (SELECT score, pos, n, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS seen, sum(pos) OVER () AS allp, sum(n) OVER () AS alln FROM pts),
 pr AS (SELECT score, pos, tp, seen - tp AS fp, CAST(tp AS DOUBLE) / seen AS prec, CAST(tp AS DOUBLE) / allp AS recall, allp, alln,
   CASE WHEN seen - n > 0 THEN CAST(tp - pos AS DOUBLE) / (seen - n) ELSE 1 END AS before FROM cum)"""


@query(
    "pr_curve",
    _SCORED.rstrip() + ", " + _POINTS + " SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(prec, 6) AS precision, round(recall, 6) AS recall FROM pr",
)
def pr_curve(spark, path):
    p = ev.pr_points(Roles(spark, path).scored(), "class", "score")
    return rounded(p.select("threshold", "tp", "fp", "precision", "recall"), ["precision", "recall"])


@query(
    "pr_summary",
    _SCORED.rstrip()
    + ", "
    + _POINTS
    + " SELECT round(sum(CAST(pos AS DOUBLE) / allp * prec), 6) AS average_precision, round(sum(CAST(pos AS DOUBLE) / allp * (prec + before) / 2), 6) AS auc, round(max(CAST(allp AS DOUBLE) / alln), 6) AS base_rate FROM pr",
)
def pr_summary(spark, path):
    out = ev.pr_summary(Roles(spark, path).scored(), "class", "score")
    return rounded(out, out.columns)


@query(
    "pr_grid",
    _SCORED.rstrip()
    + ", "
    + _POINTS
    + " SELECT round(CAST(g AS DOUBLE) / 99, 6) AS precision, round(coalesce((SELECT max(recall) FROM pr WHERE CAST(floor(prec * 99 + 1e-9) AS INTEGER) >= g), 0), 6) AS recall FROM range(100) r(g)",
)
def pr_grid(spark, path):
    out = ev.pr_grid(Roles(spark, path).scored(), "class", "score")
    return rounded(out, out.columns)


@query(
    "f1_threshold",
    _SCORED
    + """SELECT round(avg(f1), 6) AS mean_f1, round(stddev_pop(f1), 6) AS std_f1, count(*) AS folds FROM (
       SELECT fold_key, 2.0::DOUBLE * tp / (2 * tp + fp + fn) AS f1 FROM (SELECT fold_key, count(*) FILTER (score > 0.5 AND class = 1) AS tp, count(*) FILTER (score > 0.5 AND class = 0) AS fp,
        count(*) FILTER (score <= 0.5 AND class = 1) AS fn FROM scored GROUP BY 1))""",
)
def f1_threshold(spark, path):
    out = ev.f1_summary(Roles(spark, path).scored(), "class", "score", 0.5, "fold_key")
    return rounded(out, ["mean_f1", "std_f1"])


@query(
    "confusion_matrix",
    _SCORED
    + """SELECT cell, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM scored), 6) AS percentage FROM (
       SELECT CASE WHEN class = 0 AND score <= 0.5 THEN 'True Neg' WHEN class = 0 THEN 'False Pos' WHEN score <= 0.5 THEN 'False Neg' ELSE 'True Pos' END AS cell FROM scored) GROUP BY 1""",
)
def confusion_matrix(spark, path):
    df = Roles(spark, path).scored().withColumn("pred", F.when(F.col("score") > 0.5, 1).otherwise(0))
    return rounded(ev.confusion(df, "class", "pred"), ["percentage"])


# train and test by ship date; the ship day itself drifts, so do prices that follow it
_DRIFT = """SELECT l_shipdate <= TIMESTAMP '1999-01-01' AS train, CAST(l_quantity AS DOUBLE) AS quantity, l_discount AS discount,
  CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS ship_day, CAST(year(l_shipdate) - 1994 AS DOUBLE) * l_quantity AS aged FROM lineitem"""
_FEATS = ["quantity", "discount", "ship_day", "aged"]


def _drift(r):
    li = r.table("lineitem")
    df = li.select(
        (F.col("l_shipdate") <= F.lit("1999-01-01").cast("timestamp_ntz")).alias("train"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("double").alias("ship_day"),
        ((F.year("l_shipdate") - 1994) * F.col("l_quantity")).cast("double").alias("aged"),
    )
    return df.where("train"), df.where("not train")


_KS = f"""WITH d AS ({_DRIFT}), long AS (UNPIVOT d ON {', '.join(_FEATS)} INTO NAME feature VALUE value),
  g AS (SELECT feature, value, sum(CASE WHEN train THEN 1 ELSE 0 END) AS a, sum(CASE WHEN train THEN 0 ELSE 1 END) AS b FROM long GROUP BY 1, 2),
  c AS (SELECT feature, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY feature) AS n1, sum(b) OVER (PARTITION BY feature) AS n2 FROM g WINDOW w AS (PARTITION BY feature ORDER BY value)),
  k AS (SELECT feature, max(abs(CAST(ca AS DOUBLE) / n1 - CAST(cb AS DOUBLE) / n2)) AS d, CAST(max(n1) AS DOUBLE) AS n1, CAST(max(n2) AS DOUBLE) AS n2 FROM c GROUP BY 1),
  t AS (SELECT *, d * sqrt(n1 * n2 / (n1 + n2)) AS t FROM k),
  ks AS (SELECT feature, d, CASE WHEN d = 0 THEN 1.0::DOUBLE ELSE least(1.0, greatest(0.0, 1 - sqrt(2 * pi()) / t.t * (SELECT sum(exp(-((2 * i - 1) * pi() / t.t) * ((2 * i - 1) * pi() / t.t) / 8)) FROM range(1, 20001) r(i)))) END AS p FROM t)
"""


@query("ks_table", _KS + "SELECT feature, round(d, 6) AS statistic, round(p, 6) AS p FROM ks")
def ks_table(spark, path):
    return rounded(ev.ks_table(*_drift(Roles(spark, path)), _FEATS), ["statistic", "p"])


@query(
    "ks_drift",
    _KS + "SELECT feature, round(p, 5) AS p, round(d, 2) AS statistic FROM ks WHERE p <= 0.05 AND d > 0.1",
)
def ks_drift(spark, path):
    return ev.ks_drift(*_drift(Roles(spark, path)), _FEATS)


@query(
    "log_histogram",
    f"""WITH d AS ({_DRIFT}), long AS (UNPIVOT d ON ship_day, aged INTO NAME feature VALUE value)
        SELECT feature, CASE WHEN train THEN 'train' ELSE 'test' END AS sample, CAST(floor(ln(1 + value) / 0.25::DOUBLE) AS BIGINT) AS bin, count(*) AS n,
        round(CAST(count(*) AS DOUBLE) / (sum(count(*)) OVER (PARTITION BY feature, train) * 0.25), 6) AS density FROM long WHERE value > -1 GROUP BY feature, train, bin""",
)
def log_histogram(spark, path):
    train, test = _drift(Roles(spark, path))
    return rounded(ev.log_histogram(train, test, ["ship_day", "aged"]), ["density"])


@query(
    "cluster_profile",
    """WITH f AS (SELECT l_suppkey AS "group", CAST(l_quantity AS DOUBLE) AS quantity, l_extendedprice AS price FROM lineitem)
       SELECT s."group", feature, round(median, 6) AS median, members FROM
       (SELECT "group", count(*) AS members FROM f GROUP BY 1 HAVING count(*) > 600) s JOIN
       (SELECT "group", 'quantity' AS feature, quantile_cont(quantity, 0.5) AS median FROM f GROUP BY 1 UNION ALL SELECT "group", 'price', quantile_cont(price, 0.5) FROM f GROUP BY 1) m ON s."group" = m."group" """,
)
def cluster_profile(spark, path):
    df = Roles(spark, path).table("lineitem").select(
        F.col("l_suppkey").alias("group"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price")
    )
    return rounded(ev.cluster_profile(df, ["quantity", "price"], "group", 600), ["median"])


# ---------------------------------------------------------------- explanations

# fixed values: weights of the linear scorer the explanation queries describe
COEF = {"quantity": 0.004, "price": -0.000002, "discount": 0.7, "tax": -0.6, "line": 0.03, "size": -0.002}
_X = """SELECT o_orderkey AS lead, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS class, quantity, o_totalprice AS price, discount, tax, line, size FROM orders
  JOIN (SELECT l_orderkey, sum(l_quantity) AS quantity, round(sum(l_discount), 2) AS discount, round(sum(l_tax), 2) AS tax, CAST(count(*) AS DOUBLE) AS line, CAST(max(l_suppkey) AS DOUBLE) AS size
        FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""
_CON = "SELECT lead, " + ", ".join(f"CAST({k} AS DOUBLE) * ({c} - avg({c}) OVER ()) AS {c}" for c, k in COEF.items()) + " FROM x"
_EXPLAIN = f"""WITH x AS ({_X}), con AS ({_CON}), long AS (SELECT lead, feature, round(c, 9) AS contribution FROM (UNPIVOT con ON {', '.join(COEF)} INTO NAME feature VALUE c)),
  pred AS (SELECT x.lead, class, CASE WHEN s > 0.1 THEN 1 ELSE 0 END AS class_pred FROM x JOIN (SELECT lead, round(sum(contribution), 6) AS s FROM long GROUP BY 1) t ON x.lead = t.lead)
"""


def _x(r):
    o = r.table("orders")
    lines = r.table("lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"),
        F.round(F.sum("l_discount"), 2).alias("discount"),
        F.round(F.sum("l_tax"), 2).alias("tax"),
        F.count(F.lit(1)).cast("double").alias("line"),
        F.max("l_suppkey").cast("double").alias("size"),
    )
    return o.join(lines, o["o_orderkey"] == lines["l_orderkey"]).select(
        F.col("o_orderkey").alias("lead"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("class"),
        "quantity",
        F.col("o_totalprice").alias("price"),
        "discount",
        "tax",
        "line",
        "size",
    )


def _contrib(x):
    wide = ev.linear_contributions(x, list(COEF), COEF)
    return wide.select("lead", *[F.round(c, 9).alias(c) for c in COEF])


def _long(x):
    return ev.melt_contributions(_contrib(x), ["lead"], list(COEF))


def _pred(x):
    # the same long contributions the explanation tables use, summed per row
    s = None
    for c in COEF:
        s = F.col(c) if s is None else s + F.col(c)
    scores = _contrib(x).select("lead", F.round(s, 6).alias("s"))
    return x.select("lead", "class").join(scores, "lead").select(
        "lead", "class", F.when(F.col("s") > 0.1, 1).otherwise(0).alias("class_pred")
    )


@query(
    "linear_contributions",
    _EXPLAIN + "SELECT lead, " + ", ".join(f"round({c}, 8) AS {c}" for c in COEF) + " FROM con",
)
def linear_contributions(spark, path):
    wide = ev.linear_contributions(_x(Roles(spark, path)), list(COEF), COEF).drop("class")
    return rounded(wide, list(COEF), 8)


@query(
    "top_contributions",
    _EXPLAIN.rstrip()
    + f""", vals AS (SELECT lead, feature, value FROM (UNPIVOT (SELECT lead, {', '.join(COEF)} FROM x) ON {', '.join(COEF)} INTO NAME feature VALUE value)),
       edges AS (SELECT feature, quantile_cont(value, 0.33) AS lower, quantile_cont(value, 0.66) AS upper FROM vals GROUP BY 1)
       SELECT t.lead, t.feature, CAST(value AS VARCHAR) || CASE WHEN value < lower THEN ' (low comparing to other leads)' WHEN value > upper THEN ' (high comparing to other leads)' ELSE ' (around the average)' END AS feature_value,
       round(contribution, 6) AS contribution FROM (SELECT *, row_number() OVER (PARTITION BY lead, contribution > 0 ORDER BY abs(contribution) DESC, feature) AS rn FROM long WHERE contribution <> 0 AND feature <> 'size') t
       JOIN vals v ON v.lead = t.lead AND v.feature = t.feature JOIN edges e ON e.feature = t.feature WHERE rn <= 2""",
)
def top_contributions(spark, path):
    x = _x(Roles(spark, path))
    out = ev.top_contributions(_contrib(x), x, "lead", list(COEF), n=2, exclude=["size"])
    return rounded(out, ["contribution"])


@query(
    "effect_strength",
    _EXPLAIN
    + """SELECT l.lead, l.feature, l.contribution, CASE WHEN l.contribution > 0 THEN CASE WHEN l.contribution > m.p THEN 'strong' ELSE 'weak' END WHEN l.contribution < m.n THEN 'strong' ELSE 'weak' END AS level_of_effect
       FROM long l JOIN (SELECT feature, quantile_cont(CASE WHEN contribution > 0 THEN contribution END, 0.5) AS p, quantile_cont(CASE WHEN contribution <= 0 THEN contribution END, 0.5) AS n FROM long GROUP BY 1) m ON m.feature = l.feature""",
)
def effect_strength(spark, path):
    return ev.effect_strength(_long(_x(Roles(spark, path))))


def _drivers_sql(actual: int) -> str:
    toward, away = (">", "<") if actual == 1 else ("<", ">")
    return (
        _EXPLAIN
        + f"""SELECT * FROM (SELECT feature, count(*) FILTER (class_pred <> {actual} AND contribution {away} 0) AS misled, count(*) FILTER (class_pred = {actual} AND contribution {toward} 0) AS led
           FROM long JOIN pred ON long.lead = pred.lead WHERE class = {actual} GROUP BY 1) WHERE misled > 0 OR led > 0"""
    )


@query("error_class_drivers", _drivers_sql(1))
def error_class_drivers(spark, path):
    x = _x(Roles(spark, path))
    return ev.error_drivers(_pred(x), _long(x), "lead", "positive")


@query("error_class_drivers_negative", _drivers_sql(0))
def error_class_drivers_negative(spark, path):
    x = _x(Roles(spark, path))
    return ev.error_drivers(_pred(x), _long(x), "lead", "negative")


@query(
    "contribution_summary",
    _EXPLAIN + "SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs_contribution FROM long GROUP BY 1",
)
def contribution_summary(spark, path):
    return rounded(ev.contribution_summary(_long(_x(Roles(spark, path)))), ["mean_abs_contribution"])
