"""DuckDB SQL that states each registered query's result independently of the Spark plan."""

from __future__ import annotations

from tenura.functions.expressions import ERFC_FIT, POISSON_ONE_CDF
from tenura.operators.correlation import COLLINEAR_ABOVE
from tenura.operators.metrics import CALIBRATION_EDGES
from tenura.operators.resampling import (
    CURVE_REPLICATES,
    DIFFERENCE_REPLICATES,
    METRIC_REPLICATES,
    METRICS,
)
from tenura.operators.weight_cells import HIGH_STEP, MODULUS, REPLICATE_STEP, ROW_STEP, SECOND_STEP, WEIGHT_SEED
from tenura.plans.queries import (
    AREA_TO_STATE,
    CATEGORIES,
    COEFFICIENTS,
    SCALED,
    THRESHOLDS,
)
from tenura.plans.tables import BASE_NUMERIC, LINE_MEASURES

ORACLES: dict[str, str] = {}


def r(expression: str, digits: int = 6) -> str:
    """Rounded like the query, without a negative zero."""
    return f"(round({expression}, {digits}) + 0.0)"


def div(a: str, b: str, default: str = "0.0") -> str:
    return f"coalesce(({a})::double / nullif(({b})::double, 0), {default}::double)"


def h(key: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT)"


def h60(key: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 15))::BIGINT)"


def names(columns: list[str]) -> str:
    return ", ".join(columns)


def erfc(x: str) -> str:
    t = f"(1.0 / (1.0 + 0.5 * ({x})))"
    inner = str(ERFC_FIT[-1])
    for c in reversed(ERFC_FIT[1:-1]):
        inner = f"({c} + {t} * {inner})"
    return f"({t} * exp(-({x}) * ({x}) + {ERFC_FIT[0]} + {t} * {inner}))"


BASE = """
cut AS (SELECT max(o_orderdate) - INTERVAL '180' DAY AS c FROM orders),
ret AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r, count(*) AS n
        FROM lineitem GROUP BY l_orderkey),
j AS (SELECT o.o_custkey, o.o_orderdate, o.o_totalprice, cut.c, coalesce(ret.r, 0) AS r, coalesce(ret.n, 0) AS n
      FROM orders o CROSS JOIN cut LEFT JOIN ret ON ret.l_orderkey = o.o_orderkey),
base AS (
  SELECT cu.c_custkey AS row_id, re.r_name AS area, na.n_name AS nation, cu.c_mktsegment AS segment, cu.c_acctbal AS acctbal,
    avg(CASE WHEN o_orderdate < j.c AND o_orderdate >= j.c - INTERVAL '90' DAY THEN o_totalprice END) AS avg3,
    avg(CASE WHEN o_orderdate < j.c AND o_orderdate >= j.c - INTERVAL '180' DAY THEN o_totalprice END) AS avg6,
    avg(CASE WHEN o_orderdate < j.c AND o_orderdate >= j.c - INTERVAL '360' DAY THEN o_totalprice END) AS avg12,
    CAST(sum(CASE WHEN o_orderdate < j.c THEN r ELSE 0 END) AS double) AS returned,
    CAST(sum(CASE WHEN o_orderdate < j.c THEN n ELSE 0 END) AS double) AS placed,
    CAST(sum(CASE WHEN o_orderdate < j.c THEN 1 ELSE 0 END) AS double) AS n_orders,
    CAST(date_diff('day', max(CASE WHEN o_orderdate < j.c THEN o_orderdate END), max(j.c)) AS double) AS idle_days,
    CASE WHEN sum(CASE WHEN o_orderdate >= j.c THEN 1 ELSE 0 END) = 0 THEN 1 ELSE 0 END AS label
  FROM customer cu JOIN nation na ON na.n_nationkey = cu.c_nationkey
  JOIN region re ON re.r_regionkey = na.n_regionkey LEFT JOIN j ON j.o_custkey = cu.c_custkey
  GROUP BY cu.c_custkey, re.r_name, na.n_name, cu.c_mktsegment, cu.c_acctbal),
tall AS (SELECT row_id, label, series, value FROM base UNPIVOT (value FOR series IN (%s)))
""" % names(BASE_NUMERIC)

RAW = BASE + """,
raw AS (SELECT row_id, label,
    CASE WHEN row_id % 7 <> 0 THEN ' ' || lower(segment) || ' ' END AS segment,
    CASE WHEN row_id % 11 = 0 THEN 'n/a' ELSE replace(CAST(acctbal AS VARCHAR), '.', ',') END AS acctbal,
    replace(CAST(n_orders AS VARCHAR), '.', ',') AS n_orders
  FROM base)
"""

RULED = BASE + """,
ruled AS (SELECT row_id, area, nation, segment, label, avg3, avg6, returned, idle_days,
    CASE WHEN acctbal >= 0 THEN acctbal END AS acctbal,
    CASE WHEN n_orders > 13 THEN 13 ELSE n_orders END AS n_orders,
    CASE WHEN placed > 50 THEN 50 ELSE placed END AS placed,
    CASE WHEN avg12 > avg6 THEN avg6 ELSE avg12 END AS avg12 FROM base)
"""

CATS = "cats AS (SELECT row_id, label, feature, category FROM base UNPIVOT (category FOR feature IN (%s)))" % names(CATEGORIES)

LINES = """
lines AS (SELECT row_number() OVER () AS rid, l_quantity, l_extendedprice, l_discount, l_tax,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem),
ltall AS (SELECT rid, label, series, value FROM lines UNPIVOT (value FOR series IN (%s)))
""" % names(LINE_MEASURES)

SCORES = """
scores AS (SELECT event_id AS row_id, y AS label,
    (1000 + %s %% 6001 + 2000 * y) / CAST(10000 AS double) AS prob_lr,
    (1000 + %s %% 5001 + 3000 * y) / CAST(10000 AS double) AS prob_gbm
  FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events)),
stall AS (SELECT row_id, label, series, value FROM scores UNPIVOT (value FOR series IN (prob_lr, prob_gbm)))
""" % (h("concat('lr:', event_id)"), h("concat('gb:', event_id)"))

CELLS = SCORES + """,
cells AS (SELECT series, value, count(*) AS n, sum(label) AS pos FROM stall GROUP BY series, value),
cum AS (SELECT series, value, n, pos,
    sum(n) OVER w AS seen, sum(pos) OVER w AS tp,
    sum(pos) OVER (PARTITION BY series) AS all_pos, sum(n - pos) OVER (PARTITION BY series) AS all_neg
  FROM cells WINDOW w AS (PARTITION BY series ORDER BY value DESC))
"""

AUC_SQL = """SELECT series, sum((n - pos)::double * ((tp - pos)::double + pos::double / 2)) / max(all_pos::double * all_neg::double) AS auc FROM cum GROUP BY series"""
AP_SQL = f"SELECT series, sum({div('pos', 'all_pos')} * {div('tp', 'seen')}) AS average_precision FROM cum GROUP BY series"

HARD = SCORES + """,
hard AS (SELECT series, label, CASE WHEN value > 0.5 THEN 1 ELSE 0 END AS p FROM stall),
cm AS (SELECT series,
    count(*) FILTER (WHERE label = 0 AND p = 0) AS tn, count(*) FILTER (WHERE label = 0 AND p = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND p = 0) AS fn, count(*) FILTER (WHERE label = 1 AND p = 1) AS tp
  FROM hard GROUP BY series)
"""

SWEEP = SCORES + f""",
grid AS (SELECT i, CASE WHEN i = 199 THEN 1.0::double ELSE i * (1::double / 199::double) END AS threshold FROM range(200) t(i)),
counted AS (SELECT series, threshold, count(*) FILTER (WHERE value >= threshold) AS flagged,
    count(*) FILTER (WHERE value >= threshold AND label = 1) AS tp, sum(label) AS all_pos
  FROM stall, grid GROUP BY series, threshold),
rated AS (SELECT series, threshold, {div('tp', 'flagged')} AS precision, {div('tp', 'all_pos')} AS recall FROM counted),
sweep AS (SELECT *, {div('precision * recall * 2.0', 'precision + recall')} AS f1 FROM rated),
f AS (SELECT series, threshold AS best_f1_threshold, f1 AS best_f1 FROM sweep QUALIFY row_number() OVER (PARTITION BY series ORDER BY f1 DESC, threshold) = 1),
b AS (SELECT series, threshold, recall FROM sweep WHERE precision >= 0.6 QUALIFY row_number() OVER (PARTITION BY series ORDER BY recall DESC, threshold) = 1),
half AS (SELECT series, recall FROM sweep QUALIFY row_number() OVER (PARTITION BY series ORDER BY abs(threshold - 0.5), threshold) = 1),
best AS (SELECT f.series, 0.5::double AS threshold_0_5, best_f1_threshold, coalesce(b.threshold, 0.5::double) AS business_threshold,
    best_f1, coalesce(b.recall, half.recall) AS business_recall
  FROM f JOIN half USING (series) LEFT JOIN b USING (series))
"""

RANKED = SCORES + """,
ranked AS (SELECT row_id, prob_gbm AS prob, label,
    row_number() OVER (ORDER BY prob_gbm DESC, row_id) AS rank,
    CAST(sum(label) OVER (ORDER BY prob_gbm DESC, row_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS label_upto,
    count(*) OVER () AS n, sum(label) OVER () AS pos FROM scores)
"""

SEGMENTS = """SELECT p AS percent, any_value(n * p // 100) AS n_customers,
    round_even(100 * coalesce(sum(label) FILTER (WHERE rank <= n * p // 100), 0)::double / any_value(n * p // 100), 1) AS churn_rate_pct,
    round_even(coalesce(sum(label) FILTER (WHERE rank <= n * p // 100), 0)::double / any_value(greatest(pos, 1)) * 100, 1) AS churn_captured_pct
  FROM ranked, (VALUES (10), (20), (30)) t(p) GROUP BY p"""


def multinomial(replicates: int) -> str:
    return SCORES + f""",
draws AS (SELECT id // n AS b, {h60("concat(id // n, ':', id % n)")} % n AS p
  FROM (SELECT count(*) AS n FROM scores), range({replicates} * (SELECT count(*) FROM scores)) t(id)),
weights AS (SELECT b, p, count(*) AS w FROM draws GROUP BY b, p),
weighted AS (SELECT b, series, value, label AS y, w FROM weights
  JOIN (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS p FROM scores) USING (p) JOIN stall USING (row_id))
"""


def _fifth(x: str) -> str:
    square = f"(({x}) * ({x}) % {MODULUS})"
    return f"({square} * {square} % {MODULUS} * ({x}) % {MODULUS})"


def poisson(replicates: int) -> str:
    return SCORES + f""",
first_mix AS (SELECT row_id, b, ((row_id % {MODULUS}) * {ROW_STEP} + (b + 1) * {REPLICATE_STEP} + {WEIGHT_SEED}) % {MODULUS} AS x
  FROM scores, range({replicates}) t(b)),
first_power AS (SELECT row_id, b, {_fifth('x')} AS x FROM first_mix),
second_mix AS (SELECT row_id, b, (x + (row_id // {MODULUS}) * {HIGH_STEP} + (b + 1) * {SECOND_STEP}) % {MODULUS} AS x FROM first_power),
uniform AS (SELECT row_id, b, {_fifth('x')} / {MODULUS}::double AS u FROM second_mix),
weights AS (SELECT row_id, b, {' + '.join(f'(u >= {c}::double)::INT' for c in POISSON_ONE_CDF)} AS w FROM uniform),
weighted AS (SELECT b, series, value, label AS y, w FROM weights JOIN stall USING (row_id) WHERE w > 0)
"""


WCUM = """,
wcells AS (SELECT b, series, value, sum(w) AS n, sum(w * y) AS pos FROM weighted GROUP BY b, series, value),
wcum AS (SELECT b, series, value, n::double AS n, pos::double AS pos, (n - pos)::double AS neg,
    (sum(n) OVER w)::double AS seen, (sum(pos) OVER w)::double AS tp,
    (sum(pos) OVER (PARTITION BY b, series))::double AS all_pos, (sum(n - pos) OVER (PARTITION BY b, series))::double AS all_neg,
    (sum(n) OVER (PARTITION BY b, series))::double AS all_n
  FROM wcells WINDOW w AS (PARTITION BY b, series ORDER BY value DESC))
"""

WMETRICS = WCUM + f""",
sums AS (SELECT b, series, sum(pos) AS p, sum(neg) AS q, sum(neg * (tp - pos + pos / 2)) AS won, sum(pos * tp / seen) AS ap,
    coalesce(sum(pos) FILTER (WHERE value > 0.5), 0) AS hit, coalesce(sum(neg) FILTER (WHERE value > 0.5), 0) AS false_hit
  FROM wcum GROUP BY b, series),
rated AS (SELECT b, series, won / (p * q) AS auc_roc, ap / p AS avg_precision, {div('hit', 'hit + false_hit')} AS precision,
    {div('hit', 'p')} AS recall FROM sums WHERE p > 0 AND q > 0),
reps AS (SELECT *, {div('precision * recall * 2.0', 'precision + recall')} AS f1 FROM rated)
"""

CI = f"""SELECT series, metric, {r('avg(v)')} AS mean, {r('quantile_cont(v, 0.025)')} AS ci_low,
    {r('quantile_cont(v, 0.975)')} AS ci_high, count(*) AS n_valid
  FROM reps UNPIVOT (v FOR metric IN ({names(list(METRICS))})) GROUP BY series, metric"""

DIFF = f""",
paired AS (SELECT b, max(auc_roc) FILTER (WHERE series = 'prob_gbm') - max(auc_roc) FILTER (WHERE series = 'prob_lr') AS d FROM reps GROUP BY b),
diff AS (SELECT count(*) AS n_valid, avg(d) AS delta_auc_mean, quantile_cont(d, 0.025) AS ci_low, quantile_cont(d, 0.975) AS ci_high,
    greatest(least(2 * least(avg((d <= 0)::INT), avg((d >= 0)::INT)), 1.0), 1.0 / {DIFFERENCE_REPLICATES})::double AS p_value
  FROM paired WHERE d IS NOT NULL),
tested AS (SELECT *, ci_low > 0 OR ci_high < 0 AS significant FROM diff)
"""

DIFF_OUT = f"""SELECT n_valid, {r('delta_auc_mean')} AS delta_auc_mean, {r('ci_low')} AS ci_low, {r('ci_high')} AS ci_high,
    {r('p_value')} AS p_value, significant FROM tested"""

POINTS = f""",
cells AS (SELECT series, value, count(*) AS n, sum(label) AS pos FROM stall GROUP BY series, value),
cum AS (SELECT series, value, n, pos, sum(n) OVER w AS seen, sum(pos) OVER w AS tp,
    sum(pos) OVER (PARTITION BY series) AS all_pos, sum(n - pos) OVER (PARTITION BY series) AS all_neg
  FROM cells WINDOW w AS (PARTITION BY series ORDER BY value DESC)),
pr AS (SELECT series, {div('tp', 'tp + fp')} AS precision, {div('tp', 'tp + fn')} AS recall FROM cm),
points AS (SELECT series, auc AS auc_roc, average_precision AS avg_precision, precision, recall,
    {div('precision * recall * 2.0', 'precision + recall')} AS f1
  FROM ({AUC_SQL}) JOIN ({AP_SQL}) USING (series) JOIN pr USING (series)),
ptall AS (SELECT series, metric, v FROM points UNPIVOT (v FOR metric IN ({names(list(METRICS))}))),
versus AS (SELECT a.metric, a.v AS first, b.v AS second, CASE WHEN b.v > a.v THEN 'prob_gbm' ELSE 'prob_lr' END AS winner
  FROM ptall a JOIN ptall b ON a.metric = b.metric AND a.series = 'prob_lr' AND b.series = 'prob_gbm')
"""

AREAS = f"SELECT upper(trim(area)) AS area, {r('avg(label)')} AS churn_rate, count(*) AS n, round_even(avg(label) * 100, 1) AS churn_rate_pct FROM base GROUP BY 1"
STATES = "(VALUES %s) s(area, state)" % ", ".join(f"('{a}', '{s}')" for a, s in AREA_TO_STATE.items())

ORACLES["churn_by_area"] = f"WITH {BASE} {AREAS}"
ORACLES["churn_by_state"] = f"WITH {BASE} SELECT a.*, s.state FROM ({AREAS}) a JOIN {STATES} ON a.area = s.area"
ORACLES["churn_state_rollup"] = f"WITH {BASE} SELECT state, {r('avg(label)')} AS churn_rate, count(*) AS n FROM base JOIN {STATES} ON upper(trim(base.area)) = s.area GROUP BY state"

ORACLES["decimal_comma_parse"] = f"WITH {RAW} SELECT row_id, try_cast(replace(acctbal, ',', '.') AS double) AS acctbal, try_cast(replace(n_orders, ',', '.') AS double) AS n_orders FROM raw"
ORACLES["parse_quality"] = f"""WITH {RAW}, q AS (
  SELECT 'acctbal' AS "column", count(acctbal) AS n_text, count(try_cast(replace(acctbal, ',', '.') AS double)) AS n_parsed FROM raw
  UNION ALL SELECT 'n_orders', count(n_orders), count(try_cast(replace(n_orders, ',', '.') AS double)) FROM raw)
SELECT "column", n_text, n_parsed, {r(div('n_text - n_parsed', 'n_text'))} AS lost_share, {div('n_text - n_parsed', 'n_text')} > 0.05 AS warn FROM q"""
ORACLES["domain_rules"] = f"WITH {RULED} SELECT row_id, {r('acctbal')} AS acctbal, {r('n_orders')} AS n_orders, {r('placed')} AS placed, {r('avg12')} AS avg12 FROM ruled"
ORACLES["rule_violations"] = f"""WITH {BASE}
SELECT 'acctbal_negative' AS rule, count(*) FILTER (WHERE acctbal < 0) AS violations FROM base
UNION ALL SELECT 'n_orders_above_limit', count(*) FILTER (WHERE n_orders > 13) FROM base
UNION ALL SELECT 'placed_above_limit', count(*) FILTER (WHERE placed > 50) FROM base
UNION ALL SELECT 'avg12_above_avg6', count(*) FILTER (WHERE avg12 > avg6) FROM base"""
MISSING = """missing AS (SELECT series AS "column", count(*) AS n_rows, count(*) - count(value) AS n_missing
  FROM base UNPIVOT INCLUDE NULLS (value FOR series IN (%s)) GROUP BY series)""" % names(BASE_NUMERIC)
ORACLES["missing_report"] = f"""WITH {BASE}, {MISSING} SELECT "column", n_rows, n_missing, {r('n_missing::double / n_rows * 100')} AS missing_pct FROM missing WHERE n_missing > 0"""
ORACLES["was_missing_flags"] = f"""WITH {BASE}, {MISSING} SELECT row_id, series AS "column", (value IS NULL)::INTEGER AS was_missing
FROM (SELECT row_id, series, value FROM base UNPIVOT INCLUDE NULLS (value FOR series IN ({names(BASE_NUMERIC)})))
WHERE series IN (SELECT "column" FROM missing WHERE n_missing::double / n_rows > 0.2 AND n_missing::double / n_rows <= 0.5)"""
ORACLES["usage_features"] = f"WITH {BASE} SELECT row_id, {r('avg6 - avg12')} AS usage_delta, {r('returned / (placed + 1)')} AS drop_rate, CAST(idle_days > 500 AS double) AS old_phone FROM base"
ORACLES["category_normalise"] = f"WITH {RAW} SELECT row_id, upper(trim(segment)) AS kept_null, coalesce(upper(trim(segment)), 'NAN') AS null_as_category, coalesce(segment, 'MISSING') AS filled FROM raw"
ORACLES["source_checks"] = f"WITH {BASE} SELECT count(*) AS n_rows, count(*) FILTER (WHERE label IS NULL) AS n_null_target, count(DISTINCT label) AS n_classes FROM base"
ORACLES["target_distribution"] = f"WITH {BASE} SELECT v AS label, count(label) AS n, {r('count(label)::double / (SELECT count(*) FROM base)')} AS share FROM (VALUES (0), (1)) t(v) LEFT JOIN base ON label = v GROUP BY v"
ORACLES["duplicate_rows"] = f"""WITH g AS (SELECT text, lang, source, n_chars, count(*) AS n FROM documents GROUP BY ALL)
SELECT sum(n)::BIGINT AS n_rows, (sum(n) - count(*))::BIGINT AS n_duplicates, {r('(sum(n) - count(*)) * 100.0 / sum(n)')} AS duplicate_pct FROM g"""
ORACLES["cardinality"] = f"WITH {BASE}, {CATS} SELECT feature, count(DISTINCT category) AS n_values FROM cats GROUP BY feature"


def pearson(x: str, y: str) -> str:
    return f"(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0))"


ORACLES["corr_with_target"] = f"WITH {BASE} SELECT series, count(*) AS n, {r(pearson('value', 'label'))} AS r FROM tall GROUP BY series"
ORACLES["top_correlations"] = f"WITH {BASE}, c AS (SELECT series, count(*) AS n, {pearson('value', 'label')} AS r FROM tall GROUP BY series) SELECT series, n, {r('r')} AS r FROM c WHERE r IS NOT NULL ORDER BY abs(c.r) DESC, series LIMIT 5"


def pairs(tall: str, key: str, columns: list[str]) -> str:
    order = "[" + ", ".join(f"'{c}'" for c in columns) + "]"
    return f"""SELECT x.series AS a, y.series AS b, count(*) AS n, {r(pearson('x.value', 'y.value'))} AS r
FROM {tall} x JOIN {tall} y ON x.{key} = y.{key} AND list_position({order}, x.series) > list_position({order}, y.series) GROUP BY 1, 2"""


ORACLES["corr_matrix"] = f"WITH {LINES} {pairs('ltall', 'rid', LINE_MEASURES)}"
ORACLES["corr_matrix_wide"] = f"WITH {BASE} {pairs('tall', 'row_id', BASE_NUMERIC)}"
ORACLES["outlier_share"] = f"""WITH {BASE}, s AS (SELECT series, count(*) AS n, avg(value) AS m, stddev_pop(value) AS d FROM tall GROUP BY series HAVING count(*) >= 10),
o AS (SELECT series, count(*) AS n, count(*) FILTER (WHERE abs((value - m) / nullif(d, 0)) > 3.0) AS n_outliers FROM tall JOIN s USING (series) GROUP BY series)
SELECT series, n, n_outliers, {r('n_outliers * 100.0 / n')} AS outlier_pct FROM o WHERE n_outliers * 100.0 / n > 1.0"""
ORACLES["class_histogram"] = f"""WITH {LINES}, lim AS (SELECT series, label, min(value) AS lo0, max(value) AS hi0, count(*) AS total FROM ltall GROUP BY series, label),
rng AS (SELECT series, label, total, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM lim),
edges AS (SELECT series, label, i, lo + i * ((hi - lo) / 30::double) AS edge FROM rng, range(1, 30) t(i)),
vals AS (SELECT series, label, value, count(*) AS n FROM ltall GROUP BY ALL),
binned AS (SELECT v.series, v.label, v.value, any_value(v.n) AS n, count(*) FILTER (WHERE v.value >= e.edge) AS bin
  FROM vals v JOIN edges e ON e.series = v.series AND e.label = v.label GROUP BY 1, 2, 3)
SELECT series, label, bin::INTEGER AS bin, sum(n)::BIGINT AS n, {r('any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 30::double)', 9)} AS bin_from,
  {r('sum(n) / (any_value(total) * ((any_value(hi) - any_value(lo)) / 30::double))', 9)} AS density
FROM binned JOIN rng USING (series, label) GROUP BY series, label, bin"""
ORACLES["boxplot_stats"] = f"""WITH {BASE}, q AS (SELECT series, label, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM tall GROUP BY series, label),
f AS (SELECT tall.*, q1, median, q3, value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside FROM tall JOIN q USING (series, label))
SELECT series, label, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3, {r('min(value) FILTER (WHERE inside)')} AS whisker_low,
  {r('max(value) FILTER (WHERE inside)')} AS whisker_high, count(*) FILTER (WHERE NOT inside) AS n_fliers FROM f GROUP BY series, label, q1, median, q3"""
ORACLES["mann_whitney"] = f"""WITH {LINES},
k AS (SELECT series, label, rank() OVER (PARTITION BY series ORDER BY value) + (count(*) OVER (PARTITION BY series, value) - 1) / 2 AS mid,
    (count(*) OVER (PARTITION BY series, value))::double AS t FROM ltall),
s AS (SELECT series, count(*) FILTER (WHERE label = 1)::double AS n1, count(*) FILTER (WHERE label = 0)::double AS n0,
    sum(mid) FILTER (WHERE label = 0) AS rank_sum, sum(t * t - 1) AS ties FROM k GROUP BY series),
u AS (SELECT series, n0, n1, rank_sum - n0 * (n0 + 1) / 2 AS u0,
    n0 * n1 / 12 * ((n0 + n1 + 1) - ties / ((n0 + n1) * (n0 + n1 - 1))) AS variance FROM s),
z AS (SELECT series, u0, (greatest(u0, n0 * n1 - u0) - n0 * n1 / 2 - 0.5) / sqrt(variance) AS z FROM u),
p AS (SELECT series, u0, z, least(1.0, {erfc('abs(greatest(z, 0.0)) / sqrt(2.0)')}) AS p FROM z)
SELECT series, {r('u0')} AS u_statistic, {r('z')} AS z, {r('p')} AS p_value,
  CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END AS significance FROM p"""
ORACLES["category_rates"] = f"""WITH {BASE}, {CATS}, g AS (SELECT feature, category, avg(label) AS rate, count(*) AS n FROM cats GROUP BY ALL HAVING count(*) > 50),
o AS (SELECT avg(label) AS r FROM base)
SELECT feature, category, {r('rate')} AS churn_rate, n, {r('o.r')} AS global_rate, CASE WHEN rate > o.r THEN 'above' ELSE 'below' END AS side FROM g, o"""
ORACLES["category_dispersion"] = f"""WITH {BASE}, {CATS}, g AS (SELECT feature, category, avg(label) AS rate FROM cats GROUP BY ALL)
SELECT feature, count(*) AS n_categories, {r('stddev_samp(rate)')} AS dispersion FROM g GROUP BY feature HAVING count(*) >= 2"""

ORACLES["risk_histogram"] = f"WITH {SCORES} SELECT least(floor(prob_gbm * 50), 49)::INTEGER AS bin, label, count(*) AS n FROM scores GROUP BY 1, 2"
ORACLES["roc_points"] = f"""WITH {CELLS} SELECT series, {r('value')} AS threshold, {r(div('seen - tp', 'all_neg'))} AS fpr, {r(div('tp', 'all_pos'))} AS tpr FROM cum
UNION ALL SELECT DISTINCT series, NULL, 0.0::double, 0.0::double FROM cum"""
ORACLES["pr_points"] = f"""WITH {CELLS} SELECT series, {r('value')} AS threshold, {r(div('tp', 'seen'))} AS precision, {r(div('tp', 'all_pos'))} AS recall FROM cum
UNION ALL SELECT DISTINCT series, NULL, 1.0::double, 0.0::double FROM cum"""
ORACLES["auc"] = f"WITH {CELLS} SELECT series, {r('auc')} AS auc FROM ({AUC_SQL})"
ORACLES["average_precision"] = f"WITH {CELLS} SELECT series, {r('average_precision')} AS average_precision FROM ({AP_SQL})"
ORACLES["confusion"] = f"""WITH {HARD}, pr AS (SELECT *, {div('tp', 'tp + fp')} AS precision, {div('tp', 'tp + fn')} AS recall FROM cm)
SELECT series, tn, fp, fn, tp, {r('precision')} AS precision, {r('recall')} AS recall, {r(div('precision * recall * 2.0', 'precision + recall'))} AS f1 FROM pr"""
ORACLES["business_interpretation"] = f"""WITH {HARD} SELECT series, tp AS churners_caught, fn AS churners_missed, fp AS false_alarms,
  round_even({div('tp', 'tp + fn')} * 100, 1) AS catch_rate_pct, round_even({div('tp', 'tp + fp')} * 100, 1) AS precision_pct FROM cm"""
ORACLES["classification_report"] = f"""WITH {HARD}, c AS (
  SELECT series, '0' AS "row", {div('tn', 'tn + fn')} AS p, {div('tn', 'tn + fp')} AS r, tn + fp AS s FROM cm
  UNION ALL SELECT series, '1', {div('tp', 'tp + fp')}, {div('tp', 'tp + fn')}, tp + fn FROM cm),
f AS (SELECT *, {div('p * r * 2.0', 'p + r')} AS f FROM c)
SELECT series, "row", {r('p')} AS precision, {r('r')} AS recall, {r('f')} AS f1_score, s AS support FROM f
UNION ALL SELECT series, 'accuracy', NULL, NULL, {r('(tn + tp)::double / (tn + fp + fn + tp)')}, tn + fp + fn + tp FROM cm
UNION ALL SELECT series, 'macro avg', {r('avg(p)')}, {r('avg(r)')}, {r('avg(f)')}, sum(s)::BIGINT FROM f GROUP BY series
UNION ALL SELECT series, 'weighted avg', {r('sum(p * s) / sum(s)')}, {r('sum(r * s) / sum(s)')}, {r('sum(f * s) / sum(s)')}, sum(s)::BIGINT FROM f GROUP BY series"""
ORACLES["threshold_sweep"] = f"WITH {SWEEP} SELECT series, {r('threshold')} AS threshold, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1 FROM sweep"
ORACLES["best_thresholds"] = f"""WITH {SWEEP} SELECT series, threshold_0_5, {r('best_f1_threshold')} AS best_f1_threshold, {r('business_threshold')} AS business_threshold,
  {r('best_f1')} AS best_f1, {r('business_recall')} AS business_recall FROM best"""


def bins(op: str) -> str:
    return " + ".join(f"(value {op} {e}::double)::INT" for e in CALIBRATION_EDGES)


ORACLES["calibration_bins"] = f"WITH {SCORES} SELECT series, ({bins('>')})::INTEGER AS bin, count(*) AS n, {r('avg(value)')} AS mean_predicted, {r('avg(label)')} AS observed FROM stall GROUP BY 1, 2"
ORACLES["ece"] = f"""WITH {SCORES}, a AS (SELECT series, {bins('>')} AS k, abs(avg(value) - avg(label)) AS gap FROM stall GROUP BY 1, 2),
b AS (SELECT series, {bins('>=')} AS k, abs(avg(value) - avg(label)) AS gap, count(*) AS n FROM stall GROUP BY 1, 2)
SELECT series, {r('approx_ece')} AS approx_ece, {r('weighted_ece')} AS weighted_ece
FROM (SELECT series, avg(gap) AS approx_ece FROM a GROUP BY series) JOIN (SELECT series, sum(gap * n) / sum(n) AS weighted_ece FROM b GROUP BY series) USING (series)"""

ORACLES["risk_ranking"] = f"WITH {RANKED} SELECT row_id, prob, rank, label_upto FROM ranked"
ORACLES["segment_table"] = f"WITH {RANKED} {SEGMENTS}"
ORACLES["top_lift"] = f"WITH {RANKED} SELECT percent, {r('churn_captured_pct / 20.0')} AS lift FROM ({SEGMENTS}) WHERE percent = 20"
ORACLES["gain_curve"] = f"""WITH {RANKED} SELECT round_even(rank::double / n * 100, 2) AS customer_pct, round_even(label_upto::double / greatest(pos, 1) * 100, 2) AS churners_captured_pct
FROM ranked WHERE (rank - 1) % greatest(n // 200, 1) = 0"""
ORACLES["segmentation_report"] = f"""WITH {RANKED}, g AS (SELECT count(*)::INTEGER AS gain_points FROM ranked WHERE (rank - 1) % greatest(n // 200, 1) = 0)
SELECT s.*, gain_points FROM ({SEGMENTS}) s, g"""
ORACLES["campaign_reach"] = f"""WITH {RANKED}, p AS (SELECT p::INTEGER AS contact_pct, greatest(n * p // 100, 1) AS contacted, pos FROM (SELECT DISTINCT n, pos FROM ranked), range(1, 51) t(p)),
c AS (SELECT contact_pct, contacted, label_upto AS captured, {div('label_upto', 'p.pos')} * 100 AS share FROM p JOIN ranked ON rank = contacted)
SELECT contact_pct, contacted, captured, {r('share')} AS capture_pct, {r('captured::double / contacted * 100')} AS precision_pct, {r('share / contact_pct')} AS lift FROM c"""
ORACLES["predictions_export"] = f"""WITH {SCORES} SELECT prob_gbm AS churn_probability, {', '.join(f'(prob_gbm >= {t})::INTEGER AS prediction_{k}' for k, t in THRESHOLDS.items())}, label AS true_label FROM scores"""
ORACLES["top_customers"] = f"WITH {SCORES} SELECT row_id, prob_gbm FROM scores ORDER BY prob_gbm DESC, row_id LIMIT 100"

ORACLES["bootstrap_ci"] = f"WITH {multinomial(METRIC_REPLICATES)} {WMETRICS} {CI}"
ORACLES["bootstrap_auc_diff"] = f"WITH {multinomial(DIFFERENCE_REPLICATES)} {WMETRICS} {DIFF} {DIFF_OUT}"
ORACLES["bootstrap_ci_poisson"] = f"WITH {poisson(METRIC_REPLICATES)} {WMETRICS} {CI}"
ORACLES["bootstrap_auc_diff_poisson"] = f"WITH {poisson(DIFFERENCE_REPLICATES)} {WMETRICS} {DIFF} {DIFF_OUT}"
BANDS: dict[str, str] = {}
BANDS["roc_band"] = f""" {WCUM},
curve AS (SELECT b, series, grid, (tp - pos + pos * (grid * all_neg / 99 - (seen - tp - neg)) / neg) / all_pos AS tpr
  FROM wcum JOIN range(100) t(grid) ON grid * all_neg >= 99 * (seen - tp - neg) AND grid * all_neg < 99 * (seen - tp) WHERE neg > 0 AND all_pos > 0
  UNION ALL SELECT DISTINCT b, series, 99, 1.0::double FROM wcum WHERE all_pos > 0 AND all_neg > 0)
SELECT series, grid, count(*) AS n_curves, {r('quantile_cont(tpr, 0.025)')} AS ci_low, {r('quantile_cont(tpr, 0.975)')} AS ci_high FROM curve GROUP BY series, grid HAVING count(*) >= 10"""
BANDS["pr_band"] = f""" {WCUM},
grown AS (SELECT b, series, all_pos, pos, tp, tp - pos AS r0, tp / seen AS p1, coalesce(lag(tp / seen) OVER (PARTITION BY b, series ORDER BY value DESC), 1.0) AS p0
  FROM wcum WHERE pos > 0 AND all_neg > 0),
curve AS (SELECT b, series, grid, p0 + (p1 - p0) * (grid * all_pos / 99 - r0) / pos AS precision
  FROM grown JOIN range(100) t(grid) ON (grid * all_pos >= 99 * r0 AND grid * all_pos < 99 * tp) OR (grid = 99 AND tp = all_pos))
SELECT series, grid, count(*) AS n_curves, {r('quantile_cont(precision, 0.025)')} AS ci_low, {r('quantile_cont(precision, 0.975)')} AS ci_high FROM curve GROUP BY series, grid HAVING count(*) >= 10"""
BANDS["gain_band"] = f""" {WCUM},
curve AS (SELECT b, series, grid, (tp - pos + pos * (grid * greatest(floor(all_n / 200), 1) + 1 - (seen - n)) / n) / all_pos * 100 AS captured
  FROM wcum JOIN (SELECT unnest(range(CAST(all_n AS BIGINT))) AS grid FROM (SELECT max(200 + all_n - 200 * floor(all_n / 200)) AS all_n FROM wcum)) t
    ON grid * greatest(floor(all_n / 200), 1) >= seen - n AND grid * greatest(floor(all_n / 200), 1) < seen WHERE all_pos > 0 AND all_neg > 0)
SELECT series, grid, count(*) AS n_curves, {r('quantile_cont(captured, 0.025)')} AS ci_low, {r('quantile_cont(captured, 0.975)')} AS ci_high FROM curve GROUP BY series, grid HAVING count(*) >= 10"""
for _name, _band in BANDS.items():
    ORACLES[_name] = f"WITH {multinomial(CURVE_REPLICATES)} {_band}"
    ORACLES[f"{_name}_poisson"] = f"WITH {poisson(CURVE_REPLICATES)} {_band}"
ORACLES["bootstrap_brier"] = f"""WITH {multinomial(METRIC_REPLICATES)},
e AS (SELECT b, series, sum(w * (y - value) * (y - value)) / sum(w) AS v FROM weighted GROUP BY b, series)
SELECT series, 'brier' AS metric, {r('avg(v)')} AS mean, {r('quantile_cont(v, 0.025)')} AS ci_low, {r('quantile_cont(v, 0.975)')} AS ci_high, count(*) AS n_valid FROM e GROUP BY series"""

ORACLES["mcnemar"] = f"""WITH {SCORES}, t AS (
  SELECT 'threshold_0_5' AS test, label, (prob_gbm > 0.5)::INT AS p1, (prob_lr > 0.5)::INT AS p2 FROM scores
  UNION ALL SELECT 'business_threshold', label, (prob_gbm >= {THRESHOLDS['business']})::INT, (prob_lr >= {THRESHOLDS['best_f1']})::INT FROM scores),
c AS (SELECT test, count(*) FILTER (WHERE p1 = label AND p2 <> label) AS b, count(*) FILTER (WHERE p1 <> label AND p2 = label) AS c FROM t GROUP BY test),
x AS (SELECT test, b, c, {div('(abs(b - c) - 1) * (abs(b - c) - 1)', 'b + c')} AS chi2 FROM c),
p AS (SELECT *, CASE WHEN b + c > 0 THEN {erfc('sqrt(chi2 / 2.0)')} ELSE 1.0 END AS p FROM x)
SELECT test, b, c, {r('chi2')} AS chi2, {r('p')} AS p_value, p < 0.05 AS significant FROM p"""
ORACLES["aligned_models"] = f"WITH {SCORES} SELECT row_id, label, prob_lr AS prob_1, prob_gbm AS prob_2 FROM scores"
ORACLES["metric_comparison"] = f'WITH {HARD} {POINTS} SELECT metric, {r("first")} AS "first", {r("second")} AS "second", winner FROM versus'
ORACLES["winner_counts"] = f"WITH {HARD} {POINTS} SELECT winner, count(*) AS n FROM versus GROUP BY winner"
ORACLES["model_decision"] = f"""WITH {poisson(DIFFERENCE_REPLICATES)} {WMETRICS} {DIFF}, {HARD.replace(SCORES + ',', '')} {POINTS},
e AS (SELECT max(auc_roc) FILTER (WHERE series = 'prob_gbm') AS ac, max(auc_roc) FILTER (WHERE series = 'prob_lr') AS a_s,
    max(recall) FILTER (WHERE series = 'prob_gbm') - max(recall) FILTER (WHERE series = 'prob_lr') AS gain FROM points),
d AS (SELECT CASE WHEN NOT significant AND gain > 0.03 THEN 'gradient_boosted_trees' WHEN NOT significant THEN 'logistic_regression'
    WHEN ac >= a_s THEN 'gradient_boosted_trees' ELSE 'logistic_regression' END AS winner,
  CASE WHEN NOT significant AND gain > 0.03 THEN 'AUC difference not significant (p=' || printf('%.4f', p_value) || '); recall gain ' || printf('%+.1f', gain * 100) || ' points'
    WHEN NOT significant THEN 'AUC difference not significant (p=' || printf('%.4f', p_value) || '); recall change ' || printf('%+.1f', gain * 100) || ' points is small, so the simpler model'
    ELSE 'AUC differs significantly by ' || printf('%.4f', abs(ac - a_s)) || ' (p=' || printf('%.4f', p_value) || ')' END AS reason
  FROM e, tested)
SELECT winner, reason, winner AS selected_model, reason AS selection_reason FROM d"""

ORACLES["stratified_split"] = f"""WITH {BASE}, k AS (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY {h("concat('42:', row_id)")}, row_id) AS k, count(*) OVER (PARTITION BY label) AS n FROM base)
SELECT row_id, label, CASE WHEN k <= ceil(n * 20 / 100.0) THEN 'test' ELSE 'train' END AS part FROM k"""
ORACLES["model_round_trip"] = f"""WITH {BASE}, k AS (SELECT label, ceil(count(*) * 20 / 100.0) AS held FROM base GROUP BY label)
SELECT sum(held)::BIGINT AS n_rows, 0::BIGINT AS n_different FROM k"""
ORACLES["category_rate_bins"] = """WITH lines AS (SELECT l_partkey::VARCHAR AS l_partkey, l_suppkey::VARCHAR AS l_suppkey, l_linestatus, l_returnflag = 'R' AS y FROM lineitem WHERE l_returnflag IS NOT NULL),
c AS (SELECT 'l_partkey' AS feature, l_partkey AS category, count(*) AS n, count_if(y) AS pos FROM lines GROUP BY l_partkey
  UNION ALL SELECT 'l_suppkey', l_suppkey, count(*), count_if(y) FROM lines GROUP BY l_suppkey
  UNION ALL SELECT 'l_linestatus', l_linestatus, count(*), count_if(y) FROM lines GROUP BY l_linestatus),
t AS (SELECT feature, sum(pos)::DOUBLE / sum(n)::DOUBLE AS g FROM c GROUP BY feature),
s AS (SELECT c.*, g, floor((pos + g * 10) / (n + 10) * 65536)::BIGINT AS step FROM c JOIN t USING (feature)),
p AS (SELECT *, dense_rank() OVER (PARTITION BY feature ORDER BY step) - 1 AS place, sum(n) OVER (PARTITION BY feature) AS total,
  coalesce(sum(n) OVER (PARTITION BY feature ORDER BY step RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s),
b AS (SELECT *, CASE WHEN max(place) OVER (PARTITION BY feature) < 255 THEN place ELSE 255 * before // total END AS bin FROM p)
SELECT feature, category, n::BIGINT AS n, pos::BIGINT AS pos, bin::INTEGER AS bin,
  coalesce(max(CASE WHEN step <= floor(g * 65536) THEN bin END) OVER (PARTITION BY feature), 0)::INTEGER AS unseen FROM b"""
ORACLES["row_identity"] = """WITH d AS (SELECT *, md5(concat_ws(',', """ + ", ".join(
    f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("text", "lang", "source", "n_chars")
) + """)) AS digest FROM documents)
SELECT row_number() OVER (ORDER BY digest) - 1 AS row_id, lang, source, n_chars, md5(text) AS text_md5 FROM d"""
FOLDED = f"""folded AS (SELECT *, ((row_number() OVER (PARTITION BY label ORDER BY {h("concat('42:', row_id)")}, row_id) - 1) % 5)::INTEGER AS fold FROM base)"""
ORACLES["stratified_folds"] = f"WITH {BASE}, {FOLDED} SELECT row_id, label, fold FROM folded"
ORACLES["explanation_sample"] = f"""WITH {SCORES} SELECT row_id, label FROM scores ORDER BY {h("concat('explain:', row_id)")}, row_id LIMIT 2000"""


def shrunk(n: str, pos: str, all_n: str, all_pos: str) -> str:
    g, p = f"(({all_pos})::double / ({all_n}))", f"(({pos})::double / ({n}))"
    v, s2 = f"({g} * (1 - {g}))", f"({p} * (1 - {p}))"
    lam = f"({v} * ({n}) / nullif({v} * ({n}) + {s2}, 0))"
    return f"coalesce({lam} * {p} + (1 - {lam}) * {g}, {g})"


ORACLES["target_encode"] = f"""WITH {BASE}, {CATS}, t AS (SELECT count(*) AS all_n, sum(label) AS all_pos FROM base),
e AS (SELECT feature, category, {shrunk('n', 'pos', 'all_n', 'all_pos')} AS enc FROM (SELECT feature, category, count(*) AS n, sum(label) AS pos FROM cats GROUP BY ALL), t)
SELECT row_id, {', '.join(f"{r(f'{c[0]}.enc')} AS {c}_enc" for c in CATEGORIES)} FROM base
{' '.join(f"JOIN e {c[0]} ON {c[0]}.feature = '{c}' AND {c[0]}.category = base.{c}" for c in CATEGORIES)}"""
ORACLES["target_encode_crossfit"] = f"""WITH {BASE}, {FOLDED},
fc AS (SELECT row_id, label, fold, feature, category FROM folded UNPIVOT (category FOR feature IN ({names(CATEGORIES)}))),
f AS (SELECT fold, count(*) AS fn, sum(label) AS fp FROM folded GROUP BY fold), t AS (SELECT count(*) AS an, sum(label) AS ap FROM folded),
c AS (SELECT feature, category, count(*) AS cn, sum(label) AS cp FROM fc GROUP BY ALL),
cf AS (SELECT feature, category, fold, count(*) AS n, sum(label) AS p FROM fc GROUP BY ALL),
e AS (SELECT feature, category, fold, CASE WHEN cn - n > 0 THEN {shrunk('(cn - n)', 'cp - p', 'an - fn', 'ap - fp')} ELSE (ap - fp)::double / (an - fn) END AS enc
  FROM cf JOIN c USING (feature, category) JOIN f USING (fold), t)
SELECT row_id, b.fold, {', '.join(f"{r(f'{c[0]}.enc')} AS {c}_enc" for c in CATEGORIES)} FROM folded b
{' '.join(f"JOIN e {c[0]} ON {c[0]}.feature = '{c}' AND {c[0]}.category = b.{c} AND {c[0]}.fold = b.fold" for c in CATEGORIES)}"""
MEDIANS = "med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in SCALED) + " FROM base)"
IMPUTED = "imp AS (SELECT row_id, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in SCALED) + " FROM base, med)"
ORACLES["median_impute"] = f"WITH {BASE}, {MEDIANS}, {IMPUTED} SELECT row_id, {', '.join(f'{r(c)} AS {c}' for c in SCALED)} FROM imp"
QUARTS = "qs AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in SCALED
) + " FROM imp)"
ORACLES["robust_scale"] = f"""WITH {BASE}, {MEDIANS}, {IMPUTED}, {QUARTS}
SELECT row_id, {', '.join(f"{r(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END')} AS {c}" for c in SCALED)} FROM imp, qs"""

CONTRIB = "means AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in COEFFICIENTS) + " FROM base),\nwide AS (SELECT row_id, " + ", ".join(
    f"{w}::double * coalesce({c} - m_{c}, 0.0) AS {c}" for c, w in COEFFICIENTS.items()
) + f""" FROM base, means),
con AS (SELECT row_id, feature, value FROM wide UNPIVOT (value FOR feature IN ({names(list(COEFFICIENTS))})))"""
DRIVERS = """,
risk AS (SELECT row_id, 1.0 / (1.0 + exp(-sum(value))) AS prob FROM con GROUP BY row_id),
top AS (SELECT row_id, prob, row_number() OVER (ORDER BY prob DESC, row_id) AS rank FROM risk ORDER BY prob DESC, row_id LIMIT 100),
drv AS (SELECT rank::INTEGER AS rank, row_id, round_even(prob, 4) AS churn_probability,
    (row_number() OVER (PARTITION BY row_id ORDER BY abs(value) DESC, feature))::INTEGER AS place, feature, round_even(value, 4) AS shap_value,
    CASE WHEN value > 0 THEN 'increases_churn' ELSE 'decreases_churn' END AS direction
  FROM con JOIN top USING (row_id) QUALIFY place <= 3)
"""
ORACLES["retention_flags"] = f"""WITH {BASE}, {CONTRIB},
history AS (SELECT o_custkey AS row_id, max(age) // 30 AS months, sum(CASE WHEN age <= 180 THEN o_totalprice ELSE 0 END)
    - sum(CASE WHEN age > 180 AND age <= 360 THEN o_totalprice ELSE 0 END) AS revenue_delta
  FROM (SELECT o_custkey, o_totalprice, date_diff('day', o_orderdate, c) AS age FROM orders, cut) WHERE age > 0 GROUP BY o_custkey),
risk AS (SELECT row_id, row_number() OVER (ORDER BY 1.0 / (1.0 + exp(-sum(value))) DESC, row_id) AS rank, count(*) OVER () AS n FROM con GROUP BY row_id),
feat AS (SELECT row_id, segment, idle_days, avg12, avg6 - avg12 AS delta, returned / (placed + 1) AS drop_rate FROM base),
seg AS (SELECT segment, avg(drop_rate) AS segment_drop, quantile_cont(avg12, 0.5) AS segment_median FROM feat GROUP BY segment)
SELECT row_id, segment, coalesce((idle_days > 500)::INTEGER, 0) AS device_upgrade, coalesce((delta < 0)::INTEGER, 0) AS usage_outreach,
  coalesce((drop_rate > segment_drop)::INTEGER, 0) AS service_quality, coalesce((avg12 < segment_median)::INTEGER, 0) AS low_engagement,
  coalesce((months < 12)::INTEGER, 0) AS early_lifecycle, coalesce((revenue_delta < 0)::INTEGER, 0) AS revenue_review,
  coalesce((rank * 100 <= n * 10)::INTEGER, 0) AS priority_contact
FROM feat JOIN seg USING (segment) LEFT JOIN history USING (row_id) LEFT JOIN risk USING (row_id)"""
ORACLES["linear_attribution"] = f"WITH {BASE}, {CONTRIB} SELECT row_id, feature, {r('value')} AS value FROM con"
ORACLES["global_importance"] = f"""WITH {BASE}, {CONTRIB} SELECT feature, {r('avg(abs(value))')} AS importance, {r('avg(value)')} AS mean_value FROM con GROUP BY feature"""
ORACLES["waterfall"] = f"""WITH {BASE}, {CONTRIB}, s AS (SELECT row_id, row_number() OVER w AS step, feature, value, sum(value) OVER (w ROWS UNBOUNDED PRECEDING) AS e
  FROM con WHERE row_id = 7 WINDOW w AS (ORDER BY abs(value) DESC, feature))
SELECT row_id, step::INTEGER AS step, feature, {r('value')} AS value, {r('e')} AS "end", {r('e - value')} AS start FROM s"""
ORACLES["driver_topk"] = f"WITH {BASE}, {CONTRIB} {DRIVERS} SELECT * FROM drv"
ORACLES["driver_rollup"] = f"""WITH {BASE}, {CONTRIB} {DRIVERS} SELECT feature, {r('sum(abs(shap_value))')} AS total,
  array_to_string(list_transform(string_split(feature, '_'), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS label FROM drv GROUP BY feature"""
ORACLES["high_risk_list"] = f"""WITH {BASE}, {CONTRIB} {DRIVERS},
lab AS (SELECT rank, churn_probability, place, feature || ' (' || printf('%+.3f', shap_value) || ')' AS t FROM drv),
w AS (SELECT rank, churn_probability, round_even(churn_probability * 100, 1) AS risk_pct, max(t) FILTER (WHERE place = 1) AS primary_driver,
    max(t) FILTER (WHERE place = 2) AS driver_2, max(t) FILTER (WHERE place = 3) AS driver_3 FROM lab GROUP BY rank, churn_probability)
SELECT * FROM w WHERE churn_probability >= 0.5 AND contains(lower(concat_ws(' ', primary_driver, driver_2, driver_3)), 'idle_')"""
# The two-sided tail of Student's t as a finite sum with gamma functions; the angle's sine is the correlation.
AGREEMENT = f""", f AS (SELECT count(*) AS n, {pearson('ra', 'rb')} AS rho FROM k),
t AS (SELECT *, n - 2 AS df, least(abs(rho), 1) AS s, sqrt(1 - least(abs(rho), 1) * least(abs(rho), 1)) AS c FROM f),
m AS (SELECT *, CASE WHEN df % 2 = 0
    THEN s * list_sum(list_transform(range(0, df // 2), lambda k: gamma(k + 0.5) / (sqrt(pi()) * gamma(k + 1)) * c ** (2 * k)))
    ELSE 2 / pi() * (asin(s) + s * coalesce(list_sum(list_transform(range(0, (df - 1) // 2), lambda k: sqrt(pi()) / 2 * gamma(k + 1) / gamma(k + 1.5) * c ** (2 * k + 1))), 0)) END AS inside FROM t)
SELECT n, {r('rho')} AS rho, CASE WHEN df >= 1 AND rho IS NOT NULL THEN {r('greatest(1 - inside, 0)')} END AS p_value, CASE WHEN rho > 0.7 THEN 'agreement' ELSE 'disagreement' END AS agreement FROM m"""
ORACLES["spearman_importance"] = f"""WITH {BASE}, im AS (SELECT area IN ('AMERICA', 'EUROPE') AS west, series, abs({pearson('value', 'tall.label')}) AS i FROM tall JOIN base USING (row_id) GROUP BY 1, 2),
p AS (SELECT a.series, a.i AS a, b.i AS b FROM im a JOIN im b ON a.series = b.series AND a.west AND NOT b.west),
k AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2 AS rb FROM p)
{AGREEMENT}"""
ORACLES["importance_agreement"] = f"""WITH {BASE}, {CONTRIB}, c AS (SELECT feature, avg(abs(value)) AS a, any_value(abs(weight)) AS b
  FROM con JOIN (VALUES {', '.join(f"('{c}', {w!r}::double)" for c, w in COEFFICIENTS.items())}) w(feature, weight) USING (feature) GROUP BY feature),
p AS (SELECT feature, a, b FROM c),
k AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2 AS rb FROM p)
{AGREEMENT}"""
ORACLES["typed_lines"] = """SELECT l_orderkey AS row_id, l_linenumber, CASE WHEN l_linestatus = 'F' THEN '1' WHEN l_returnflag <> 'R' THEN '0' END AS truck,
  (l_returnflag = 'R')::INTEGER AS label FROM lineitem"""
ORACLES["undeclared_text"] = """SELECT 'p_name' AS feature, count(DISTINCT p_name) AS n_values FROM part UNION ALL SELECT 'p_brand' AS feature, count(DISTINCT p_brand) AS n_values FROM part UNION ALL SELECT 'p_type' AS feature, count(DISTINCT p_type) AS n_values FROM part"""
ORACLES["class_values"] = f"WITH {BASE} SELECT {r('avg12')} AS avg12 FROM base WHERE label = 1 AND avg12 IS NOT NULL"

CLASSES = "count(*) AS n_rows, round_even(avg(label), 4) AS churn_rate, count(*) FILTER (WHERE label = 1) AS churn_count, count(*) FILTER (WHERE label = 0) AS no_churn_count"
COLLINEAR = [*BASE_NUMERIC, "spend"]
# The greedy rule as a recursion over the close pairs: its state is the list of dropped columns and whether the current
# first column had been dropped before its own pairs began.
ORACLES["multicollinear_drop"] = f"""WITH RECURSIVE {BASE}, wide AS (SELECT *, avg12 * 1.1 + acctbal * 0.5 AS spend FROM base),
t AS (SELECT row_id, label, series, value FROM wide UNPIVOT (value FOR series IN ({names(COLLINEAR)}))),
placed AS (SELECT t.*, list_position({COLLINEAR}, series) AS i FROM t),
target AS (SELECT i, any_value(series) AS series, {pearson('value', 'label')} AS r FROM placed GROUP BY i),
close AS (SELECT a.i AS first, b.i AS second FROM placed a JOIN placed b ON a.row_id = b.row_id AND a.i < b.i
  GROUP BY a.i, b.i HAVING abs({pearson('a.value', 'b.value')}) > {COLLINEAR_ABOVE}),
steps AS (SELECT row_number() OVER (ORDER BY first, second) AS k, first, second, abs(f.r) >= abs(s.r) AS keeps_first
  FROM close JOIN target f ON f.i = first JOIN target s ON s.i = second),
walk AS (SELECT 0::BIGINT AS k, 0::BIGINT AS current, false AS skip, []::BIGINT[] AS gone
  UNION ALL SELECT k, first, skip, CASE WHEN skip OR list_contains(gone, second) THEN gone
      WHEN keeps_first THEN list_append(gone, second) ELSE list_append(gone, first) END
  FROM (SELECT s.k, s.first::BIGINT AS first, s.second::BIGINT AS second, s.keeps_first, w.gone,
      CASE WHEN s.first = w.current THEN w.skip ELSE list_contains(w.gone, s.first::BIGINT) END AS skip
    FROM walk w JOIN steps s ON s.k = w.k + 1))
SELECT series AS "column", list_contains((SELECT gone FROM walk ORDER BY k DESC LIMIT 1), i::BIGINT) AS dropped, {r('r')} AS target_r FROM target"""
ORACLES["preparation_report"] = f"""WITH {RULED},
m AS (SELECT series, 1 - count(value)::double / count(*) AS rate FROM ruled UNPIVOT INCLUDE NULLS (value FOR series IN ({names(BASE_NUMERIC)})) GROUP BY series),
kept AS (SELECT series, rate FROM m WHERE rate <= 0.5),
final AS (SELECT series, round_even(rate * 100, 2) AS pct FROM kept WHERE rate > 0
  UNION ALL SELECT 'usage_delta', round_even((1 - count(avg6 - avg12)::double / count(*)) * 100, 2) FROM ruled
  UNION ALL SELECT 'old_phone', round_even((1 - count(idle_days)::double / count(*)) * 100, 2) FROM ruled HAVING count(idle_days) < count(*))
SELECT {CLASSES}, (SELECT count(*) - count(DISTINCT row_id) FROM base)::BIGINT AS duplicate_row_count,
  (SELECT string_agg(series, ',' ORDER BY series) FROM m WHERE rate > 0.5) AS dropped_columns,
  (SELECT count(*) FROM kept WHERE rate > 0.2)::INTEGER AS n_flags, (SELECT count(*) FROM final)::INTEGER AS n_missing_columns,
  (SELECT series FROM final ORDER BY pct DESC, series LIMIT 1) AS most_missing FROM ruled"""
ORACLES["profile_summary"] = f"""WITH {BASE}, {CATS}, {MISSING},
g AS (SELECT area, nation, segment, {names(BASE_NUMERIC)}, label, count(*) AS n FROM base GROUP BY ALL)
SELECT {CLASSES}, (SELECT sum(n) - count(*) FROM g)::BIGINT AS duplicate_row_count,
  (SELECT series FROM (SELECT series, {pearson('value', 'label')} AS r FROM tall GROUP BY series) ORDER BY abs(r) DESC, series LIMIT 1) AS strongest,
  (SELECT "column" FROM missing ORDER BY n_missing DESC LIMIT 1) AS most_missing,
  (SELECT max(k) FROM (SELECT count(DISTINCT category) AS k FROM cats GROUP BY feature)) AS most_values FROM base"""
ORACLES["kpi_row"] = f"""WITH {poisson(METRIC_REPLICATES)} {WMETRICS}, {SWEEP.replace(SCORES + ',', '').replace('rated AS', 'trated AS').replace('FROM rated', 'FROM trated')}, {RANKED.replace(SCORES + ',', '')},
s AS ({SEGMENTS}),
t AS (SELECT business_threshold AS bt FROM best WHERE series = 'prob_gbm'),
bm AS (SELECT {div('count(*) FILTER (WHERE label = 1 AND prob_gbm >= bt)', 'count(*) FILTER (WHERE prob_gbm >= bt)')} AS precision_business,
    {div('count(*) FILTER (WHERE label = 1 AND prob_gbm >= bt)', 'count(*) FILTER (WHERE label = 1)')} AS recall_business FROM scores, t),
a AS (SELECT avg(auc_roc) AS auc, quantile_cont(auc_roc, 0.025) AS ci_low, quantile_cont(auc_roc, 0.975) AS ci_high FROM reps WHERE series = 'prob_gbm')
SELECT {r('auc')} AS auc, {r('ci_low')} AS ci_low, {r('ci_high')} AS ci_high, CASE WHEN auc >= 0.78 THEN 'strong' WHEN auc >= 0.72 THEN 'good' ELSE 'moderate' END AS band,
  {r('churn_captured_pct')} AS top_20_capture_pct, {r('churn_captured_pct / 20.0')} AS top_20_lift, {r('bt')} AS business_threshold,
  {r('precision_business')} AS precision_business, {r('recall_business')} AS recall_business FROM a, s, t, bm WHERE s.percent = 20"""
