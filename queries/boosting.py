"""Second-order boosting and tree attribution against closed forms: the gain of every split, leaf values, margins, Shapley values."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventwin.operators import attribution as A, boosting as B, models as M
from eventwin.sources.sinks import staged
from queries.models import FEATURES, matrix
from queries.tables import table

STEP, PENALTY = 0.05, 1.0
SEARCHED = {"quantity": "l_quantity", "line": "cast(l_linenumber as double)", "discount": "if(l_linenumber % 3 = 0, null, round(l_discount * 100))"}


def split_search(spark, d):
    """The best of all splits of three features, one with missing values; its two leaves and the rows that reach them."""
    rows = table(spark, d, "lineitem").selectExpr(*[f"{e} as {n}" for n, e in SEARCHED.items()],
                                                  "l_extendedprice * (1 + l_discount) + if(l_linenumber % 3 = 0, 20000, 0) as leaning")
    rows = rows.selectExpr(*SEARCHED, "if(leaning > 60000, 1, 0) as label_storm")
    model = B.fit_trees(rows, list(SEARCHED), rounds=1, depth=1, rows=1.0, columns=1.0, step=STEP, penalty=PENALTY)
    root = model.nodes(spark).where("node = 0").selectExpr("feature", "missing_left", "round(gain, 3) as gain")  # one row
    leaves = model.margins(rows).groupBy(F.expr("round(margin, 9) as value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return leaves.crossJoin(root)


def _two(spark, d):
    return staged(table(spark, d, "orders").selectExpr(
        "o_orderkey", "if(o_orderstatus = 'F', 1D, 0D) as closed", "if(o_orderpriority < '3', 1D, 0D) as urgent",
        "if(o_totalprice > 180000 + if(o_orderstatus = 'F', -30000, 30000) * if(o_orderpriority < '3', 1, 3), 1, 0) as label_storm"), "orders")


def depth_two(spark, d):
    """A tree over two binary features: each row's margin and the Shapley values of both."""
    rows, names = _two(spark, d), ["closed", "urgent"]
    model = B.fit_trees(rows, names, rounds=1, depth=2, rows=1.0, columns=1.0, step=STEP, penalty=PENALTY)
    found = A.tree_attribution(model.margins(rows), model, names, ["o_orderkey", "margin"])
    return found.selectExpr("o_orderkey", "round(margin, 9) + 0D as margin", "round(base, 9) + 0D as base", "round(phi[0], 9) + 0D as phi_closed",
                            "round(phi[1], 9) + 0D as phi_urgent")


def three_rounds(spark, d):
    """Three trees, each fitted to the margins of those before: margins and probabilities by class of the one feature."""
    rows = _two(spark, d)
    model = B.fit_trees(rows, ["closed"], rounds=3, depth=1, rows=1.0, columns=1.0, step=0.3, penalty=PENALTY)
    scored = model.predict(model.margins(rows))
    return scored.groupBy("closed").agg(F.count(F.lit(1)).alias("n_rows"), F.expr("round(min(margin), 9) + 0D as least"),
                                        F.expr("round(max(margin), 9) + 0D as most"), F.expr("round(avg(score), 9) as score"))


def scored(spark, d):
    """The whole score table, per split, of a model of 12 rounds; every column of it comes from the fitted model."""
    m = matrix(spark, d)
    model = B.fit_trees(m.where("split = 'train'"), list(FEATURES), rounds=12, depth=3, key="o_orderkey")
    return M.score_model(model, m, "second_order_trees")


def ablated(spark, d):
    """The whole comparison of a model of 6 rounds with one that is fitted again without a feature."""
    m = matrix(spark, d)
    fit = lambda train, kept: B.fit_trees(train, kept, rounds=6, depth=3, key="o_orderkey")
    return M.ablation(m.where("split = 'train'"), m.where("split = 'test'"), list(FEATURES), ["late"], fit)[1]


def group_scores(spark, d):
    """Trees on two binary features, on both and without either: counts of their predictions, and how recall differs from the full model's."""
    rows = _two(spark, d).withColumn("split", F.lit("all"))
    scores, compared, _ = M.group_ablation(rows, rows, ["closed", "urgent"], {"state": ["closed"], "priority": ["urgent"]}, key="o_orderkey",
                                           rounds=1, depth=1, rows=1.0, columns=1.0, step=STEP, penalty=PENALTY)
    delta = compared.where("metric = 'recall'").selectExpr("concat('without ', feature_group) as model", "round(delta, 9) + 0D as recall_delta")
    return scores.select("model", "tp", "fp", "tn", "fn").join(delta, "model", "left")


QUERIES = {"second_order_groups": group_scores, "second_order_split": split_search, "second_order_depth_two": depth_two, "second_order_three_rounds": three_rounds,
           "second_order_scores": scored, "second_order_ablation": ablated}

_SEARCHED_SQL = {"quantity": "l_quantity", "line": "CAST(l_linenumber AS DOUBLE)",
                 "discount": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE round(l_discount * 100) END"}
_EVERY = " UNION ALL ".join(f"SELECT {i} AS place, '{n}' AS feature, {e} AS x, g, h FROM r" for i, (n, e) in enumerate(_SEARCHED_SQL.items()))


def _round_sql(number: int) -> str:
    """One round over the classes of a binary feature: margins of the round before give gradients, gradients give margins."""
    last, gain = f"m{number - 1}", f"(gl * gl / (hl + {PENALTY}) + gr * gr / (hr + {PENALTY}) - (gl + gr) * (gl + gr) / (hl + hr + {PENALTY})) / 2"
    return f"""s{number} AS (SELECT closed, n0, n1, m, n0 * p - w * n1 * (1 - p) AS g, (n0 + w * n1) * p * (1 - p) AS h
FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM {last}), weight),
t{number} AS (SELECT sum(g) FILTER (closed = 0) AS gl, sum(h) FILTER (closed = 0) AS hl, sum(g) FILTER (closed = 1) AS gr, sum(h) FILTER (closed = 1) AS hr FROM s{number}),
m{number} AS (SELECT closed, n0, n1, m - 0.3 * CASE WHEN hl >= 1 AND hr >= 1 AND {gain} > 1e-6 THEN g / (h + {PENALTY}) ELSE (gl + gr) / (hl + hr + {PENALTY}) END AS m
FROM s{number}, t{number})"""


_TWO = """o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS closed, CASE WHEN o_orderpriority < '3' THEN 1 ELSE 0 END AS urgent,
CASE WHEN o_totalprice > 180000 + CASE WHEN o_orderstatus = 'F' THEN -30000 ELSE 30000 END * CASE WHEN o_orderpriority < '3' THEN 1 ELSE 3 END
THEN 1 ELSE 0 END AS y FROM orders),
weight AS (SELECT CAST(count(*) FILTER (y = 0) AS DOUBLE) / count(*) FILTER (y = 1) AS w FROM o)"""

_SIDES = " UNION ALL ".join(f"SELECT {i} AS place, '{c}' AS feature, {c} AS x, y, w FROM o, weight" for i, c in enumerate(("closed", "urgent")))

ORACLES = {
    "second_order_groups": f"""WITH {_TWO},
s AS (SELECT place, feature, x, sum(CASE WHEN y = 1 THEN -0.5 * w ELSE 0.5 END) AS g, sum(CASE WHEN y = 1 THEN 0.25 * w ELSE 0.25 END) AS h,
count(*) FILTER (y = 1) AS n1, count(*) FILTER (y = 0) AS n0 FROM ({_SIDES}) GROUP BY ALL),
t AS (SELECT place, feature, sum(g) AS g, sum(h) AS h, min(h) AS least, (sum(g * g / (h + {PENALTY})) - sum(g) * sum(g) / (sum(h) + {PENALTY})) / 2 AS gain FROM s GROUP BY ALL),
p AS (SELECT s.place, s.feature, n0, n1, t.gain, CASE WHEN least >= 1 AND t.gain > 1e-6 THEN -s.g / (s.h + {PENALTY}) ELSE -t.g / (t.h + {PENALTY}) END > 0 AS yes
FROM s JOIN t USING (place)),
c AS (SELECT place, feature, any_value(gain) AS gain, coalesce(sum(n1) FILTER (yes), 0) AS tp, coalesce(sum(n0) FILTER (yes), 0) AS fp,
coalesce(sum(n0) FILTER (NOT yes), 0) AS tn, coalesce(sum(n1) FILTER (NOT yes), 0) AS fn FROM p GROUP BY ALL),
f AS (SELECT * FROM c ORDER BY gain DESC, place LIMIT 1),
m AS (SELECT 'full' AS model, tp, fp, tn, fn FROM f UNION ALL
SELECT CASE feature WHEN 'closed' THEN 'without priority' ELSE 'without state' END, tp, fp, tn, fn FROM c)
SELECT m.model, CAST(m.tp AS BIGINT) AS tp, CAST(m.fp AS BIGINT) AS fp, CAST(m.tn AS BIGINT) AS tn, CAST(m.fn AS BIGINT) AS fn,
CASE WHEN m.model <> 'full' THEN round(CAST(m.tp AS DOUBLE) / (m.tp + m.fn) - CAST(f.tp AS DOUBLE) / (f.tp + f.fn), 9) + 0 END AS recall_delta FROM m, f""",
    "second_order_split": f"""WITH l AS (SELECT *, CASE WHEN l_extendedprice * (1 + l_discount) + CASE WHEN l_linenumber % 3 = 0 THEN 20000 ELSE 0 END > 60000
THEN 1 ELSE 0 END AS y FROM lineitem),
weight AS (SELECT CAST(count(*) FILTER (y = 0) AS DOUBLE) / count(*) FILTER (y = 1) AS w FROM l),
r AS (SELECT l.*, CASE WHEN y = 1 THEN -0.5 * w ELSE 0.5 END AS g, CASE WHEN y = 1 THEN 0.25 * w ELSE 0.25 END AS h FROM l, weight),
f AS ({_EVERY}),
whole AS (SELECT sum(g) AS g, sum(h) AS h, count(*) AS n FROM r),
none AS (SELECT place, coalesce(sum(g) FILTER (x IS NULL), 0) AS g, coalesce(sum(h) FILTER (x IS NULL), 0) AS h, count(*) FILTER (x IS NULL) AS n FROM f GROUP BY place),
vals AS (SELECT place, feature, x, sum(g) AS g, sum(h) AS h, count(*) AS n FROM f WHERE x IS NOT NULL GROUP BY ALL),
below AS (SELECT place, feature, x, sum(g) OVER b AS g, sum(h) OVER b AS h, CAST(sum(n) OVER b AS BIGINT) AS n FROM vals
WINDOW b AS (PARTITION BY place ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lefts AS (SELECT b.place, feature, x, false AS missing_left, b.g, b.h, b.n FROM below b WHERE b.n > 0
UNION ALL SELECT b.place, feature, x, true, b.g + none.g, b.h + none.h, b.n + none.n FROM below b JOIN none USING (place) WHERE b.n > 0),
best AS (SELECT lefts.*, whole.g - lefts.g AS rg, whole.h - lefts.h AS rh, whole.n - lefts.n AS rn,
(lefts.g * lefts.g / (lefts.h + {PENALTY}) + (whole.g - lefts.g) * (whole.g - lefts.g) / (whole.h - lefts.h + {PENALTY}) - whole.g * whole.g / (whole.h + {PENALTY})) / 2 AS gain
FROM lefts, whole WHERE lefts.h >= 1 AND whole.h - lefts.h >= 1 ORDER BY round(gain, 6) DESC, lefts.place, x, missing_left LIMIT 1)
SELECT feature, missing_left, round(gain, 3) AS gain, round(-{STEP} * g / (h + {PENALTY}), 9) AS value, n AS n_rows FROM best
UNION ALL SELECT feature, missing_left, round(gain, 3), round(-{STEP} * rg / (rh + {PENALTY}), 9), rn FROM best""",
    "second_order_depth_two": f"""WITH {_TWO},
c AS (SELECT closed, urgent, sum(CASE WHEN y = 1 THEN -0.5 * w ELSE 0.5 END) AS g, sum(CASE WHEN y = 1 THEN 0.25 * w ELSE 0.25 END) AS h FROM o, weight GROUP BY ALL),
gains AS (SELECT name, sum(part) AS gain FROM (
SELECT 'closed' AS name, sum(g) * sum(g) / (sum(h) + {PENALTY}) AS part FROM c GROUP BY closed UNION ALL
SELECT 'urgent', sum(g) * sum(g) / (sum(h) + {PENALTY}) FROM c GROUP BY urgent) GROUP BY name),
first AS (SELECT name FROM gains ORDER BY gain DESC, name LIMIT 1),
k AS (SELECT CASE WHEN name = 'closed' THEN closed ELSE urgent END AS a, CASE WHEN name = 'closed' THEN urgent ELSE closed END AS b, g, h FROM c, first),
child AS (SELECT a, sum(g) AS g, sum(h) AS h, min(h) >= 1 AND (sum(g * g / (h + {PENALTY})) - sum(g) * sum(g) / (sum(h) + {PENALTY})) / 2 > 1e-6 AS cut FROM k GROUP BY a),
leaf AS (SELECT k.a, k.b, k.h, child.h AS ha, -{STEP} * CASE WHEN cut THEN k.g / (k.h + {PENALTY}) ELSE child.g / (child.h + {PENALTY}) END AS m, cut FROM k JOIN child USING (a)),
by_a AS (SELECT a, any_value(ha) AS h, sum(m * h) / sum(h) AS v FROM leaf GROUP BY a),
by_b AS (SELECT b, sum(m * ha) / sum(ha) AS v FROM leaf GROUP BY b),
base AS (SELECT sum(v * h) / sum(h) AS v FROM by_a),
phi AS (SELECT a, b, m, base.v AS base, ((by_a.v - base.v) + (m - by_b.v)) / 2 AS phi_a, ((by_b.v - base.v) + (m - by_a.v)) / 2 AS phi_b
FROM leaf JOIN by_a USING (a) JOIN by_b USING (b), base)
SELECT o_orderkey, round(m, 9) + 0 AS margin, round(base, 9) + 0 AS base, round(CASE WHEN name = 'closed' THEN phi_a ELSE phi_b END, 9) + 0 AS phi_closed,
round(CASE WHEN name = 'closed' THEN phi_b ELSE phi_a END, 9) + 0 AS phi_urgent
FROM o, first JOIN phi ON a = CASE WHEN name = 'closed' THEN closed ELSE urgent END AND b = CASE WHEN name = 'closed' THEN urgent ELSE closed END""",
    "second_order_three_rounds": f"""WITH {_TWO},
m0 AS (SELECT closed, CAST(count(*) FILTER (y = 0) AS DOUBLE) AS n0, CAST(count(*) FILTER (y = 1) AS DOUBLE) AS n1, CAST(0 AS DOUBLE) AS m FROM o GROUP BY closed),
{_round_sql(1)},
{_round_sql(2)},
{_round_sql(3)}
SELECT CAST(closed AS DOUBLE) AS closed, CAST(n0 + n1 AS BIGINT) AS n_rows, round(m, 9) + 0 AS least, round(m, 9) + 0 AS most, round(1 / (1 + exp(-m)), 9) AS score FROM m3""",
}
