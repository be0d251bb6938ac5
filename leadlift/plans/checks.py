"""SQL counterparts of the registered queries, for DuckDB over the same Parquet tables.

They are written from the definitions, not from the Spark plans: plain joins, window functions over the whole table,
and a threshold grid joined to every row.
"""

from __future__ import annotations

import math
from itertools import accumulate

# the table of beta quantiles is shared; a test integrates the density on its own
from leadlift.functions.draws import beta_quantiles
from leadlift.plans.queries import DRAWN_CHANNELS, DRAWN_REGIONS, NUMERIC, SCORECARD_FEATURES
from leadlift.settings import (
    BASELINE_LABEL,
    CATEGORICAL,
    EXPLAIN_TOP_N,
    F1_GRID_POINTS,
    FEATURES,
    FINAL_LABEL,
    LABEL_NOISE,
    METRIC_COLUMNS,
    REPORT_THRESHOLDS,
    SCORECARD,
    TEST_SHARE,
    TOP_K,
    TUNE_TRIALS,
    VALID_SHARE,
)


# Definitions of the checks, not taken from the code they check
UNIT = 2.0**52
BETA_STEPS = 1000
LOG_LOSS_EPS = 2.220446049250313e-16


def contribution_column(feature: str) -> str:
    return f"shap__{feature}"


def threshold_label(prefix: str, threshold: float) -> str:
    return f"{prefix}@{threshold:g}"


def grid_step(points: int) -> float:
    return 1 / (points - 1)


def num(x: float) -> str:
    """A double literal; without an exponent DuckDB would read a decimal."""
    text = repr(float(x))
    return text if "e" in text else text + "e0"


def r6(expression: str, name: str | None = None) -> str:
    text = f"floor(({expression}) * 1e6 + 0.5e0) / 1e6"
    return f"{text} AS {name}" if name else text


def r6_all(names: list[str]) -> str:
    return ", ".join(r6(n, n) for n in names)


def u(salt: str, key: str = "c_custkey") -> str:
    return f"(('0x' || substr(md5({key} || ':{salt}'), 1, 13))::BIGINT / {num(UNIT)})"


def z(salt: str, key: str = "c_custkey") -> str:
    radius = f"sqrt(-2e0 * ln(greatest({u(salt + '1', key)}, 1e-300)))"
    return f"({radius} * cos({num(2 * math.pi)} * {u(salt + '2', key)}))"


def clip(x: str, low: float, high: float) -> str:
    """Plain comparisons: a missing value passes neither and stays missing."""
    return f"(CASE WHEN ({x}) < {num(low)} THEN {num(low)} WHEN ({x}) > {num(high)} THEN {num(high)} ELSE ({x}) END)"


def sigmoid(x: str) -> str:
    return f"(1e0 / (1e0 + exp(-({x}))))"


def doubles(values) -> str:
    return "[" + ", ".join(map(num, values)) + "]::DOUBLE[]"


SCORE_SQL = "0e0" + "".join(f" + {num(w)} * ({f} - {num(c)})" for f, (w, c) in SCORECARD.items())

CUSTOMERS = f"""
WITH as_of AS (SELECT max(o_orderdate)::DATE AS last_day FROM orders),
aged AS (
  SELECT *, date_diff('day', o_orderdate::DATE, last_day) AS age_days FROM orders, as_of
),
history AS (
  SELECT o_custkey, max(age_days) AS oldest,
         count(*) FILTER (WHERE age_days < 90) AS recent,
         coalesce(sum(round(o_totalprice * 100)::BIGINT) FILTER (WHERE age_days < 90), 0)::BIGINT AS cents,
         count(*) FILTER (WHERE age_days < 365 AND o_orderstatus = 'P') AS late
  FROM aged GROUP BY o_custkey
),
returns AS (
  SELECT o_custkey, count(*) AS lines, count(*) FILTER (WHERE l_returnflag = 'R') AS returned
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey
),
newest AS (
  SELECT user_id, event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
),
customers AS (
  SELECT c_custkey, 100000 + c_custkey AS customer_id,
    (21 + floor({u('age')} * 54e0))::INTEGER AS age,
    round({clip('65000 + 22000e0 * (c_acctbal - 4500) / 3175', 15000, 250000)}) AS annual_income,
    round({clip(f"690e0 + 55e0 * {z('credit')}", 450, 850)}) AS credit_score,
    {clip('coalesce(returned / lines::DOUBLE, 0e0)', 0.01, 0.99)} AS utilization_rate,
    coalesce(floor(oldest / 30e0), 0)::INTEGER AS tenure_months,
    least(coalesce(recent, 0), 120)::INTEGER AS txn_count_3m,
    {clip('coalesce(CASE WHEN recent > 0 THEN floor(cents / (1000e0 * recent) + 0.5e0) / 100 END, 0e0)', 1, 600)}
      AS avg_txn_amount_3m,
    least(coalesce(late, 0), 10)::INTEGER AS late_payments_12m,
    round({clip('c_acctbal', 0, 250000)}) AS savings_balance,
    lower(r_name) AS region,
    (c_mktsegment = 'BUILDING')::INTEGER AS is_premium,
    ({u('mortgage')} < 0.45e0)::INTEGER AS has_mortgage,
    coalesce(event_type, 'NA') AS channel,
    'cust' || (100000 + c_custkey) || '@example.com' AS email,
    '+1-555-' || lpad((100 + floor({u('area')} * 899e0))::INTEGER::VARCHAR, 3, '0')
      || '-' || lpad((1000 + floor({u('suffix')} * 8999e0))::INTEGER::VARCHAR, 4, '0') AS phone
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN history h ON c_custkey = h.o_custkey
  LEFT JOIN returns r ON c_custkey = r.o_custkey
  LEFT JOIN newest ON c_custkey = user_id
),
scored AS (
  SELECT *, {SCORE_SQL} AS score, {sigmoid(SCORE_SQL)} AS p_apply,
    ({u('label')} < {sigmoid(f"{SCORE_SQL} + {num(LABEL_NOISE)} * {z('noise')}")})::INTEGER AS applied_cc
  FROM customers
)"""


def stratified(source: str, name: str, share: float, salt: str) -> str:
    """CTEs that end in ``<name>``: the keys a stratified split holds out of ``source``."""
    return f""",
{name}_sizes AS (
  SELECT applied_cc, c, c * kept // total AS base,
         row_number() OVER (ORDER BY c * kept % total DESC, applied_cc) AS place,
         kept - sum(c * kept // total) OVER () AS missing
  FROM (SELECT applied_cc, c, total, total - ceil({num(share)} * total)::BIGINT AS kept
        FROM (SELECT applied_cc, count(*) AS c, (sum(count(*)) OVER ())::BIGINT AS total
              FROM {source} GROUP BY applied_cc) AS counted) AS sized
),
{name} AS (
  SELECT customer_id FROM (
    SELECT customer_id, c - base - (place <= missing)::INTEGER AS wanted,
           row_number() OVER (PARTITION BY s.applied_cc ORDER BY {u(salt)}, customer_id) AS place_in_class
    FROM {source} s JOIN {name}_sizes z ON s.applied_cc = z.applied_cc
  ) AS placed WHERE place_in_class <= wanted
)"""


TEST_SPLIT = CUSTOMERS + stratified("scored", "test_keys", TEST_SHARE, "split")
IN_TEST = "customer_id IN (SELECT customer_id FROM test_keys)"
SPLIT = TEST_SPLIT + f""",
splitted AS (SELECT *, CASE WHEN {IN_TEST} THEN 'test' ELSE 'train' END AS split FROM scored),
train AS (SELECT * FROM splitted WHERE split = 'train')"""
THREE_WAY = SPLIT + stratified("train", "valid_keys", VALID_SHARE, "valid") + """,
three_way AS (
  SELECT * EXCLUDE (split),
    CASE WHEN customer_id IN (SELECT customer_id FROM valid_keys) THEN 'valid' ELSE split END AS split
  FROM splitted
)"""


# ---- metrics ------------------------------------------------------------------------------------------------------


def curve(source: str, name: str) -> str:
    return f""",
{name} AS (
  SELECT p_apply, pos, neg, (sum(pos) OVER w)::BIGINT AS tp, (sum(neg) OVER w)::BIGINT AS fp
  FROM (SELECT p_apply, sum(applied_cc)::BIGINT AS pos, sum(1 - applied_cc)::BIGINT AS neg
        FROM {source} GROUP BY p_apply) AS per_score
  WINDOW w AS (ORDER BY p_apply DESC)
),
{name}_areas AS (
  SELECT sum(neg * (tp - pos / 2e0)) / nullif(sum(pos) * sum(neg), 0)::DOUBLE AS auc_roc,
         CASE WHEN sum(pos) = 0 THEN 0e0 ELSE sum(pos * (tp / (tp + fp)::DOUBLE)) / sum(pos)::DOUBLE END AS auc_pr
  FROM {name}
)"""


LOG_LOSS_SQL = (
    f"avg(-ln(CASE WHEN applied_cc = 1 THEN {clip('p_apply', LOG_LOSS_EPS, 1 - LOG_LOSS_EPS)} "
    f"ELSE 1e0 - {clip('p_apply', LOG_LOSS_EPS, 1 - LOG_LOSS_EPS)} END))"
)


def confusion(source: str, thresholds: str, name: str) -> str:
    """Every row against every threshold of the table ``thresholds`` (label, threshold)."""
    return f""",
{name} AS (
  SELECT t.label, t.threshold,
    count(*) FILTER (WHERE applied_cc = 1 AND p_apply >= t.threshold) AS tp,
    count(*) FILTER (WHERE applied_cc = 0 AND p_apply >= t.threshold) AS fp,
    count(*) FILTER (WHERE applied_cc = 0 AND p_apply < t.threshold) AS tn,
    count(*) FILTER (WHERE applied_cc = 1 AND p_apply < t.threshold) AS fn
  FROM {source} CROSS JOIN {thresholds} t GROUP BY t.label, t.threshold
)"""


def report_thresholds(prefix: str) -> str:
    rows = ", ".join(f"('{threshold_label(prefix, t)}', {num(t)})" for t in REPORT_THRESHOLDS)
    return f"(SELECT * FROM (VALUES {rows}) AS v(label, threshold))"


def grid(prefix: str = "grid") -> str:
    last = F1_GRID_POINTS - 1
    step = num(grid_step(F1_GRID_POINTS))
    return (
        f"(SELECT '{prefix}_best_f1' AS label, CASE WHEN i = {last} THEN 1e0 ELSE i * {step} END AS threshold "
        f"FROM range({F1_GRID_POINTS}) AS g(i))"
    )


F1_SQL = "CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END"
RATES = {
    "accuracy": "CASE WHEN tp + fp + tn + fn = 0 THEN 0e0 ELSE (tp + tn) / (tp + fp + tn + fn)::DOUBLE END",
    "precision": "CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp / (tp + fp)::DOUBLE END",
    "recall": "CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp / (tp + fn)::DOUBLE END",
    "f1": F1_SQL,
}


def best(name: str) -> str:
    return f"(SELECT * FROM {name} ORDER BY {F1_SQL} DESC, threshold LIMIT 1)"


def report_rows(source: str, rows: str, areas: str) -> str:
    """Complete metrics rows for the confusion rows of ``rows``."""
    columns = {
        "label": "label",
        "n": "(SELECT count(*) FROM {s})".format(s=source),
        "pos_rate": r6(f"(SELECT avg(applied_cc) FROM {source})"),
        "threshold": r6("threshold"),
        "auc_roc": r6(f"(SELECT auc_roc FROM {areas})"),
        "auc_pr": r6(f"(SELECT auc_pr FROM {areas})"),
        "log_loss": r6(f"(SELECT {LOG_LOSS_SQL} FROM {source})"),
        **{name: r6(rate) for name, rate in RATES.items()},
        **{name: name for name in ("tp", "fp", "tn", "fn")},
    }
    return "SELECT " + ", ".join(f"{columns[c]} AS {c}" for c in METRIC_COLUMNS) + f" FROM {rows} AS found"


def full_report(source: str, prefix: str) -> tuple[str, str]:
    """(CTEs, SELECT) of the threshold rows and the best-F1 row of one table."""
    tag = f"{source}_{prefix}"
    ctes = (
        curve(source, f"curve_{tag}")
        + confusion(source, report_thresholds(prefix), f"cells_{tag}")
        + confusion(source, grid(prefix), f"grid_{tag}")
    )
    rows = f"(SELECT * FROM cells_{tag} UNION ALL SELECT * FROM {best(f'grid_{tag}')} AS b)"
    return ctes, report_rows(source, rows, f"curve_{tag}_areas")


# ---- ranks and leads ----------------------------------------------------------------------------------------------

RANKED = CUSTOMERS + """,
ranked AS (
  SELECT *, row_number() OVER (ORDER BY p_apply, customer_id) AS score_rank, count(*) OVER () AS total FROM scored
),
with_deciles AS (
  SELECT *, CASE WHEN score_rank = 1 THEN 1 ELSE ((score_rank - 1) * 10 + total - 2) // (total - 1) END::INTEGER
    AS decile
  FROM ranked
)"""

# ---- explanations -------------------------------------------------------------------------------------------------

EXPLAINED = RANKED + """,
shown AS (SELECT * REPLACE (""" + r6("utilization_rate") + """ AS utilization_rate) FROM with_deciles),
means AS (SELECT """ + ", ".join(f"avg({f}) AS mean_{f}" for f in SCORECARD) + """ FROM shown),
explained AS (
  SELECT shown.*, """ + "0e0" + "".join(f" + {num(w)} * (mean_{f} - {num(c)})" for f, (w, c) in SCORECARD.items()) + """
    AS exp_expected_value, """ + ", ".join(
    f"{num(w)} * ({f} - mean_{f}) AS {contribution_column(f)}" for f, (w, _) in SCORECARD.items()
) + """
  FROM shown CROSS JOIN means
),
long AS (
  """ + " UNION ALL ".join(
    f"SELECT customer_id, decile, {i} AS place, '{f}' AS feature, {contribution_column(f)} AS contribution, "
    f"{f}::VARCHAR AS shown_value FROM explained"
    for i, f in enumerate(SCORECARD)
) + """
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, place) AS n
  FROM long WHERE decile >= 9
),
top_features AS (
  SELECT customer_id, """ + ", ".join(
    f"max(feature) FILTER (WHERE n = {i}) AS exp_{i}_feature, "
    f"{r6(f'max(contribution) FILTER (WHERE n = {i})')} AS exp_{i}_contribution, "
    f"max(shown_value) FILTER (WHERE n = {i}) AS exp_{i}_value"
    for i in range(1, EXPLAIN_TOP_N + 1)
) + """
  FROM placed GROUP BY customer_id
)"""

CONTRIBUTIONS = [contribution_column(f) for f in SCORECARD_FEATURES]
RANKED_NAMES = ", ".join(
    f"exp_{i}_{f}" for i in range(1, EXPLAIN_TOP_N + 1) for f in ("feature", "contribution", "value")
)
SHOWN_UTILIZATION = r6("utilization_rate", "utilization_rate")
FEATURE_LIST = ", ".join(SHOWN_UTILIZATION if f == "utilization_rate" else f for f in FEATURES)
SCORECARD_LIST = ", ".join(SHOWN_UTILIZATION if f == "utilization_rate" else f for f in SCORECARD_FEATURES)


def beta_draw(salt: str) -> str:
    table = doubles(beta_quantiles(2.2, 4.5))
    position = f"({u(salt)} * {num(BETA_STEPS)})"
    low, high = f"t[floor({position})::INTEGER + 1]", f"t[floor({position})::INTEGER + 2]"
    return f"(SELECT {low} + ({high} - {low}) * ({position} - floor({position})) FROM (SELECT {table} AS t) AS q)"


def weighted(salt: str) -> str:
    edges = accumulate(DRAWN_CHANNELS.values())
    cases = " ".join(f"WHEN {u(salt)} < {num(e)} THEN '{v}'" for v, e in zip(list(DRAWN_CHANNELS)[:-1], edges))
    return f"CASE {cases} ELSE '{list(DRAWN_CHANNELS)[-1]}' END"


def poisson(salt: str, lam: float) -> str:
    terms = f"exp(k * ln({num(lam)}) - {num(lam)} - lgamma(k + 1))"
    cdf = f"SELECT k, sum({terms}) OVER (ORDER BY k) AS c FROM generate_series(0, 200) AS g(k)"
    return f"len(list_filter((SELECT list(c ORDER BY k) FROM ({cdf}) AS t), lambda x: x < {u(salt)}))::INTEGER"


def frequency_number(column: str) -> str:
    return f"""(SELECT category, row_number() OVER (ORDER BY n DESC, category) - 1 AS number
      FROM (SELECT {column} AS category, count(*) AS n FROM train GROUP BY {column}) AS c)"""


def ordered_target(column: str) -> str:
    window = (
        f"(PARTITION BY {column} ORDER BY {u('target', '(customer_id - 100000)')}, customer_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    return f"(coalesce(sum(applied_cc) OVER {window}, 0) + 0.5e0) / (count(*) OVER {window} + 1e0)"


def total_target(column: str) -> str:
    same = f"FROM train AS t WHERE t.{column} IS NOT DISTINCT FROM s.{column}"
    return f"((SELECT coalesce(sum(t.applied_cc), 0) {same}) + 0.5e0) / ((SELECT count(*) {same}) + 1e0)"


def slots(column: str) -> str:
    return (
        f"array_to_string(list_transform((SELECT list(DISTINCT {column} ORDER BY {column}) FROM train), "
        f"lambda v: (v = {column})::INTEGER), ',') AS {column}_slots"
    )


def scaled(column: str) -> str:
    mean, deviation = f"(SELECT avg({column}) FROM train)", f"(SELECT stddev_pop({column}) FROM train)"
    return r6(f"coalesce(({column} - {mean}) / nullif({deviation}, 0), 0)", column)


def queries_sql() -> dict[str, str]:
    train_ctes, train_rows = full_report("train", "train")
    test_ctes, test_rows = full_report("test", "test")
    all_ctes, all_rows = full_report("scored", "all")
    all_curve = curve("scored", "score_curve")
    all_cells = confusion("scored", report_thresholds("all"), "cells")
    grid_cells = confusion("scored", grid("all"), "grid_cells")
    test_table = SPLIT + ",\ntest AS (SELECT * FROM splitted WHERE split = 'test')"

    sql = {
        "customer_features": f"{CUSTOMERS} SELECT customer_id, {FEATURE_LIST}, email, phone FROM customers",
        "order_aggregates": f"""{CUSTOMERS}
            SELECT h.o_custkey, oldest AS first_order_age, recent AS recent_orders, cents AS recent_cents,
                   late AS late_orders, coalesce(lines, 0) AS lines, coalesce(returned, 0) AS returned_lines
            FROM history h LEFT JOIN returns r ON h.o_custkey = r.o_custkey""",
        "latest_channel_per_user": f"{CUSTOMERS} SELECT user_id, event_type AS channel FROM newest",
        "keyed_draws": f"""
            SELECT c_custkey, {r6(u('a'), 'uniform_draw')}, (21 + floor({u('b')} * 54e0))::INTEGER AS age,
                   {r6(f"65000e0 + 22000e0 * {z('c')}", 'income')}, {r6(f"exp(8.6e0 + 0.9e0 * {z('d')})", 'savings')},
                   {poisson('e', 18.0)} AS txn_count, {poisson('f', 0.35)} AS late_payments,
                   {r6(beta_draw('g'), 'utilization')},
                   {DRAWN_REGIONS}[floor({u('h')} * 4e0)::INTEGER + 1] AS region, {weighted('i')} AS channel,
                   ({u('j')} < 0.22e0)::INTEGER AS is_premium
            FROM customer""",
        "scorecard": f"{CUSTOMERS} SELECT customer_id, {r6_all(['score', 'p_apply'])} FROM scored",
        "scored_label": f"{CUSTOMERS} SELECT customer_id, {r6('score', 'score')}, applied_cc FROM scored",
        "feature_matrix": f"{CUSTOMERS} SELECT {FEATURE_LIST} FROM customers",
        "restricted_features": f"""{CUSTOMERS}
            SELECT customer_id, email, phone, applied_cc, {SCORECARD_LIST} FROM scored""",
        "normalized_categoricals": f"""{CUSTOMERS}
            SELECT c_custkey, coalesce(event_type, 'NA') AS channel
            FROM customer LEFT JOIN newest ON c_custkey = user_id""",
        "stratified_split": f"{SPLIT} SELECT customer_id, applied_cc, split FROM splitted",
        "train_valid_split": f"{THREE_WAY} SELECT customer_id, applied_cc, split FROM three_way",
        "bernoulli_split": f"""
            SELECT 100000 + c_custkey AS customer_id,
                   CASE WHEN {u('split')} < {num(TEST_SHARE)} THEN 'test' ELSE 'train' END AS split
            FROM customer""",
        "split_shares": f"""{THREE_WAY}
            SELECT split, count(*) AS n, sum(applied_cc)::BIGINT AS positives,
                   {r6('avg(credit_score)', 'avg_credit_score')}
            FROM three_way GROUP BY split""",
        "features_left_join": f"""{CUSTOMERS}
            SELECT l.customer_id, {r6('l.p_apply', 'p_apply')},
                   {', '.join(r6('r.' + f, f) if f in ('credit_score', 'annual_income', 'utilization_rate')
                              else 'r.' + f for f in SCORECARD_FEATURES)}
            FROM scored l LEFT JOIN scored r ON l.customer_id = r.customer_id""",
        "test_rows_semi_join": f"""{TEST_SPLIT}
            SELECT customer_id, applied_cc, email, phone FROM scored WHERE {IN_TEST}""",
        "scores_joined_to_labels": f"""{CUSTOMERS}
            SELECT l.customer_id, l.applied_cc, {r6('s.p_apply', 'p_apply')}, (s.p_apply >= 0.5e0)::INTEGER AS y_pred
            FROM scored l JOIN scored s ON l.customer_id = s.customer_id""",
        "threshold_predictions": f"""{CUSTOMERS}
            SELECT customer_id, {', '.join(f"(p_apply >= {num(t)})::INTEGER AS pred_{round(t * 100)}"
                                           for t in REPORT_THRESHOLDS)} FROM scored""",
        "score_summary": f"""{CUSTOMERS}
            SELECT count(*) AS n, {r6('avg(applied_cc)', 'pos_rate')}, {r6(LOG_LOSS_SQL, 'log_loss')} FROM scored""",
        "confusion_at_thresholds": f"""{CUSTOMERS}{all_cells} SELECT * FROM cells""",
        "threshold_rates": f"""{CUSTOMERS}{all_cells}
            SELECT label, {', '.join(r6(rate, name) for name, rate in RATES.items())} FROM cells""",
        "score_curve": f"""{CUSTOMERS}{all_curve}
            SELECT {r6('p_apply', 'score')}, pos, neg, tp, fp FROM score_curve""",
        "roc_auc": f"{CUSTOMERS}{all_curve} SELECT {r6('auc_roc', 'auc_roc')} FROM score_curve_areas",
        "average_precision": f"{CUSTOMERS}{all_curve} SELECT {r6('auc_pr', 'auc_pr')} FROM score_curve_areas",
        "log_loss": f"{CUSTOMERS} SELECT {r6(LOG_LOSS_SQL, 'log_loss')} FROM scored",
        "metrics_table": f"{CUSTOMERS}{all_curve}{all_cells} " + report_rows("scored", "cells", "score_curve_areas"),
        "f1_sweep": f"""{CUSTOMERS}{grid_cells}
            SELECT {r6('threshold', 'threshold')}, tp, fp, tn, fn, {r6(F1_SQL, 'f1')} FROM grid_cells""",
        "best_f1": f"{CUSTOMERS}{all_curve}{grid_cells} "
        + report_rows("scored", best("grid_cells"), "score_curve_areas"),
        "metrics_report": f"{test_table}{train_ctes}{test_ctes} {train_rows} UNION ALL {test_rows}",
        "metrics_csv_round_trip": f"{CUSTOMERS}{all_ctes} {all_rows}",
        "rank_first": f"{RANKED} SELECT customer_id, score_rank AS \"rank\" FROM ranked",
        "rank_within_class": f"""{CUSTOMERS}
            SELECT customer_id, applied_cc,
                   row_number() OVER (PARTITION BY applied_cc ORDER BY {u('split')}, customer_id) AS "rank"
            FROM scored""",
        "deciles_qcut": f"{RANKED} SELECT customer_id, decile FROM with_deciles",
        "deciles_ntile": f"""{CUSTOMERS}
            SELECT customer_id, (ntile(10) OVER (ORDER BY p_apply, customer_id))::INTEGER AS decile FROM scored""",
        "decile_table": f"""{RANKED}
            SELECT decile, customers, responders, {r6_all(['avg_score', 'response_rate'])},
                   {r6('response_rate / (SELECT avg(applied_cc) FROM scored)', 'lift_vs_avg')}
            FROM (SELECT decile, count(customer_id) AS customers, sum(applied_cc)::BIGINT AS responders,
                         avg(p_apply) AS avg_score, sum(applied_cc) / count(customer_id)::DOUBLE AS response_rate
                  FROM with_deciles GROUP BY decile) AS per_decile""",
        "scored_test": f"""{test_table}{curve('test', 'test_curve')}
            SELECT customer_id, email, phone, applied_cc, {', '.join(
                r6(f, f) if f in ('credit_score', 'annual_income', 'utilization_rate') else f
                for f in SCORECARD_FEATURES)}, {r6('p_apply', 'p_apply')},
                {r6('(SELECT auc_roc FROM test_curve_areas)', 'auc_on_test')}
            FROM test""",
        "leads": f"""{RANKED}
            SELECT customer_id, email, phone, applied_cc, {r6('p_apply', 'p_apply')}, decile
            FROM with_deciles WHERE decile >= 9""",
        "leads_top10": f"""{RANKED}
            SELECT customer_id, email, phone, applied_cc, {r6('p_apply', 'p_apply')}, decile
            FROM (SELECT * FROM with_deciles WHERE decile >= 9 ORDER BY p_apply DESC, customer_id LIMIT 10) AS top""",
        "lead_contributions": f"""{EXPLAINED}
            SELECT customer_id, {r6_all(['exp_expected_value', *CONTRIBUTIONS])} FROM explained""",
        "lead_top_contributions": f"{EXPLAINED} SELECT customer_id, {RANKED_NAMES} FROM top_features",
        "static_explanations": f"""{RANKED}
            SELECT customer_id, NULL::DOUBLE AS exp_expected_value,
                   {', '.join(f"{feature} AS exp_{i}_feature, NULL::DOUBLE AS exp_{i}_contribution, "
                              f"{value}::VARCHAR AS exp_{i}_value"
                              for i, (feature, value) in enumerate(
                                  [("'credit_score'", 'credit_score'), ("'is_premium'", 'is_premium'),
                                   ("'tenure_months'", 'tenure_months'), ('NULL::VARCHAR', 'NULL')], 1))}
            FROM with_deciles WHERE decile >= 9""",
        "mean_abs_contribution": f"""{EXPLAINED}
            SELECT feature, {r6('avg(abs(contribution))', 'mean_abs_shap')} FROM long GROUP BY feature""",
        "top_k_features": f"""{EXPLAINED}
            SELECT feature, {r6('avg(abs(contribution))', 'importance')} FROM long GROUP BY feature
            ORDER BY importance DESC, feature LIMIT {TOP_K // 2}""",
        "leads_export_csv": f"""{EXPLAINED}
            SELECT e.customer_id, email, phone, {', '.join(SCORECARD_FEATURES)},
                   {r6_all([*CONTRIBUTIONS, 'p_apply'])}, decile, {r6('exp_expected_value', 'exp_expected_value')},
                   {RANKED_NAMES}
            FROM explained e JOIN top_features t ON e.customer_id = t.customer_id""",
        "parquet_round_trip": f"""{CUSTOMERS}
            SELECT customer_id, {SCORECARD_LIST}, applied_cc, {r6('p_apply', 'p_apply')} FROM scored""",
        "column_statistics": f"{SPLIT} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_pop({c})', 'std')} FROM train"
            for c in NUMERIC
        ),
        "standard_scaled": f"""{SPLIT}
            SELECT customer_id, {', '.join(map(scaled, NUMERIC))}
            FROM splitted""",
        "category_dictionary": f"{SPLIT} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {c} AS category, (row_number() OVER (ORDER BY {c}) - 1)::INTEGER AS number, "
            f"count(*) AS n FROM train GROUP BY {c}"
            for c in CATEGORICAL
        ),
        "string_index": f"""{SPLIT}
            SELECT customer_id, {', '.join(
                f"coalesce({c}_numbers.number, (SELECT count(DISTINCT {c}) FROM train))::INTEGER AS {c}_index"
                for c in CATEGORICAL)}
            FROM splitted {' '.join(f"LEFT JOIN {frequency_number(c)} AS {c}_numbers ON {c} = {c}_numbers.category"
                                    for c in CATEGORICAL)}""",
        "target_statistics": f"""{SPLIT}
            SELECT customer_id, split, {", ".join(r6(ordered_target(c), f"{c}__target") for c in CATEGORICAL)} FROM train
            UNION ALL
            SELECT customer_id, split, {", ".join(r6(total_target(c), f"{c}__target") for c in CATEGORICAL)}
            FROM splitted AS s WHERE split = 'test'""",
        "lr_report_totals": f"""{THREE_WAY}
            SELECT label, count(*) AS n, {r6('avg(applied_cc)', 'pos_rate')}, sum(applied_cc)::BIGINT AS positives,
                   sum(1 - applied_cc)::BIGINT AS negatives
            FROM three_way CROSS JOIN (
              SELECT label FROM {report_thresholds(BASELINE_LABEL)} AS t
              UNION ALL SELECT '{BASELINE_LABEL}_best_f1'
            ) AS labels
            WHERE split = 'valid' GROUP BY label""",
        "gbt_decile_sizes": f"""{test_table}
            SELECT decile, count(*) AS customers, (SELECT sum(applied_cc) FROM test)::BIGINT AS all_responders
            FROM (SELECT CASE WHEN n = 1 THEN 1 ELSE ((n - 1) * 10 + total - 2) // (total - 1) END::INTEGER AS decile
                  FROM (SELECT row_number() OVER (ORDER BY customer_id) AS n, count(*) OVER () AS total
                        FROM test) AS numbered) AS placed
            GROUP BY decile""",
        "gbt_contributions_add_up": f"{test_table} SELECT customer_id, 1 AS adds_up FROM test",
        "model_reload_scores": f"{test_table} SELECT customer_id, applied_cc, 1 AS same_score FROM test",
        "lr_gradient": "SELECT * FROM (VALUES "
        + ", ".join(f"('{f}', 1)" for f in [*NUMERIC, "(intercept)"])
        + ") AS v(feature, vanishes)",
        "gbt_importance_totals": "SELECT * FROM (VALUES "
        + ", ".join(f"('{f}', 1, 1)" for f in FEATURES)
        + ") AS v(feature, not_negative, all_add_up)",
        "gbt_scored_rows": f"{test_table} SELECT customer_id, applied_cc, 1 AS auc_agrees, 1 AS is_share FROM test",
        "gbt_lead_rows": f"""{test_table}
            SELECT decile, count(*) AS leads, 1 AS ranks_agree FROM (
              SELECT CASE WHEN n = 1 THEN 1 ELSE ((n - 1) * 10 + total - 2) // (total - 1) END::INTEGER AS decile
              FROM (SELECT row_number() OVER (ORDER BY customer_id) AS n, count(*) OVER () AS total FROM test) AS numbered
            ) AS placed WHERE decile >= 9 GROUP BY decile""",
        "gbt_trial_choice": f"SELECT {TUNE_TRIALS}::BIGINT AS trials, 1 AS chosen_is_best, 1 AS chosen_is_first, "
        "1 AS in_order",
        "gbt_prefix_choice": f"SELECT i::INTEGER AS trial, 1 AS kept_of_grown, 1 AS auc_agrees "
        f"FROM range(1, {TUNE_TRIALS + 1}) AS r(i)",
        "gbt_missing_direction": f"""{THREE_WAY}
            SELECT customer_id, (customer_id % 5 < 2)::INTEGER AS applied_cc, 1 AS told
            FROM three_way WHERE split = 'test'""",
        "order_history_on_days": """
            WITH days AS (SELECT unnest([DATE '1996-03-31', DATE '1998-12-31', DATE '2001-06-30']) AS day),
            lines AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS back
                      FROM lineitem GROUP BY l_orderkey),
            seen AS (SELECT o_custkey, day, date_diff('day', o_orderdate::DATE, day) AS age, o_orderstatus,
                            round(o_totalprice * 100)::BIGINT AS cents, n, back
                     FROM orders JOIN days ON o_orderdate::DATE <= day LEFT JOIN lines ON o_orderkey = l_orderkey)
            SELECT o_custkey, strftime(day, '%Y-%m-%d') AS as_of, max(age)::INTEGER AS first_order_age,
                   count(*) FILTER (age < 90) AS recent_orders,
                   (sum(cents) FILTER (age < 90))::BIGINT AS recent_cents,
                   count(*) FILTER (age < 365 AND o_orderstatus = 'P') AS late_orders,
                   sum(n)::BIGINT AS lines, sum(back)::BIGINT AS returned_lines
            FROM seen GROUP BY o_custkey, day""",
        "customers_as_of": """
            WITH lines AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
            seen AS (SELECT o_custkey, date_diff('day', o_orderdate::DATE, DATE '1998-12-31') AS age, o_orderstatus,
                            round(o_totalprice * 100)::BIGINT AS cents, n
                     FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey WHERE o_orderdate::DATE <= DATE '1998-12-31'),
            history AS (SELECT o_custkey, max(age)::INTEGER AS first_order_age,
                               count(*) FILTER (age < 90) AS recent_orders,
                               (sum(cents) FILTER (age < 90))::BIGINT AS recent_cents,
                               count(*) FILTER (age < 365 AND o_orderstatus = 'P') AS late_orders,
                               sum(n)::BIGINT AS lines FROM seen GROUP BY o_custkey),
            newest AS (SELECT user_id, event_type AS channel FROM events WHERE ts::DATE <= DATE '2024-01-15'
                       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type) = 1)
            SELECT c_custkey, first_order_age, recent_orders, recent_cents, late_orders, lines, channel
            FROM customer LEFT JOIN history ON c_custkey = o_custkey LEFT JOIN newest ON c_custkey = user_id""",
        "gbt_mean_abs_totals": f"SELECT {TOP_K}::BIGINT AS features, 1 AS not_negative, 1 AS in_order, 1 AS agrees",
        "flow_report_totals": f"""{THREE_WAY}
            SELECT label, count(*) AS n, {r6('avg(applied_cc)', 'pos_rate')}, 1 AS cells_add_up
            FROM three_way JOIN (
              SELECT label, 'valid' AS part FROM {report_thresholds(BASELINE_LABEL)} AS t
              UNION ALL SELECT '{BASELINE_LABEL}_best_f1', 'valid'
              UNION ALL SELECT label, 'test' FROM {report_thresholds(FINAL_LABEL)} AS t
              UNION ALL SELECT '{FINAL_LABEL}_best_f1', 'test'
            ) AS labels ON split = part GROUP BY label""",
        "clipped_with_missing": f"""
            WITH seen AS (SELECT user_id, max(value) AS top, avg(value) AS mean FROM events GROUP BY user_id)
            SELECT c_custkey, {r6(clip('top', 40, 60), 'top_value')}, {r6(clip('mean', 45, 55), 'mean_value')}
            FROM customer LEFT JOIN seen ON c_custkey = user_id""",
        "metrics_with_missing_scores": f"""{CUSTOMERS},
            seen AS (SELECT user_id, avg(value) AS mean FROM events GROUP BY user_id),
            mixed AS (
              SELECT applied_cc, least(greatest(mean / 100e0, 0e0), 1e0) AS p_apply
              FROM scored JOIN seen ON customer_id - 100000 = user_id WHERE mean IS NOT NULL
            ){full_report("mixed", "mixed")[0]} {full_report("mixed", "mixed")[1]}""",
        "one_hot": f"{SPLIT} SELECT customer_id, {', '.join(map(slots, CATEGORICAL))} FROM splitted",
    }
    return sql
