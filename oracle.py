"""Independent DuckDB SQL for the correctness gate.

Plain SQL text over the driver's pre-registered views, written from the
method description (not from the Spark code). Window parameters come from the
same config values; everything else is spelled out in SQL.
"""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

from cadence.config import (
    EVENTS_MAPPING, INCOME_CUTS, LabelRules, ORDERS_FOLDS, ORDERS_MAPPING, SignalParams,
    SplitSpec, TxMapping,
)

# The oracle states its own windows, types and names.
WINDOWS = {
    "orders": SimpleNamespace(
        obs_end=dt.date(2000, 1, 1), obs_last_day=dt.date(1999, 12, 31), late_start=dt.date(1998, 5, 1),
        pred_start=dt.date(2000, 1, 1), obs_periods=60.0, pred_periods=20.0, early_periods=40.0, late_periods=20.0),
    "events": SimpleNamespace(
        obs_end=dt.date(2024, 1, 22), obs_last_day=dt.date(2024, 1, 21), late_start=dt.date(2024, 1, 15),
        pred_start=dt.date(2024, 1, 22), obs_periods=3.0, pred_periods=1.0, early_periods=2.0, late_periods=1.0),
}
FOLDS_START = dt.date(1995, 1, 1)
TYPES = {"orders": ("F", "O", "P"), "events": ("click", "error", "purchase", "signup", "view")}


def share_name(t: str) -> str:
    return "sh_" + t.lower()


def tx_feature_columns(types) -> list[str]:
    return ["tx_count", "tx_total", "tx_mean", "tx_median", "tx_std", "tx_min", "tx_max", "tx_cv", "tx_recency",
            "tx_span", "tx_freq", *map(share_name, types), "tx_wknd_ratio", "tx_count_trend", "tx_amt_trend",
            "tx_max_gap", "tx_late_ratio"]


def q(d) -> str:
    return f"DATE '{d.isoformat()}'"


def rounded(sql: str, cols: list[str], digits: int = 6) -> str:
    """Round double columns of ``sql`` (both sides round the same columns)."""
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _r"


def tx_sql(m: TxMapping, start=None, end=None) -> str:
    bounds = "".join(f" AND {m.date} {op} CAST({q(x)} AS TIMESTAMP)" for op, x in ((">=", start), ("<", end)) if x)
    return f"""
SELECT CAST({m.customer_id} AS BIGINT) AS customer_id, CAST({m.date} AS DATE) AS date,
       CAST({m.type} AS VARCHAR) AS type, CAST({m.amount} AS DOUBLE) AS amount
FROM {m.table}
WHERE {m.date} IS NOT NULL AND {m.customer_id} IS NOT NULL{bounds}"""


INT_SQL = {"tx_count": "BIGINT", "tx_recency": "INTEGER", "tx_span": "INTEGER", "tx_max_gap": "INTEGER"}


def mart_ctes(m: TxMapping, rules: LabelRules = LabelRules(), w=None, start=None, end=None) -> str:
    """CTEs ``tx``, ``mart`` (features + labels, one row per customer)."""
    w = w or WINDOWS[m.table]
    obs = f"date < {q(w.obs_end)}"
    fut = f"date >= {q(w.pred_start)}"
    late = q(w.late_start)
    last = q(w.obs_last_day)
    type_counts = ",\n    ".join(
        f"count(*) FILTER (WHERE type = '{t}') AS n_{share_name(t)}" for t in TYPES[m.table])
    shares = ",\n    ".join(
        f"CASE WHEN coalesce(a.n_typed, 0) = 0 THEN 0e0 ELSE a.n_{share_name(t)} / a.n_typed END"
        f" AS {share_name(t)}" for t in TYPES[m.table])
    return f"""
tx AS ({tx_sql(m, start, end)}),
obs AS (SELECT * FROM tx WHERE {obs}),
cnt AS (
  SELECT customer_id, count(*) FILTER (WHERE {obs}) AS obs_count,
         count(*) FILTER (WHERE {fut}) AS fut_count
  FROM tx GROUP BY customer_id),
agg AS (
  SELECT customer_id,
    count(amount) AS tx_count, sum(amount) AS tx_total, avg(amount) AS tx_mean,
    median(amount) AS tx_median, coalesce(stddev_samp(amount), 0e0) AS tx_std,
    min(amount) AS tx_min, max(amount) AS tx_max, min(date) AS first_d, max(date) AS last_d,
    count(type) AS n_typed,
    avg(CASE WHEN isodow(date) >= 6 THEN 1e0 ELSE 0e0 END) AS tx_wknd_ratio,
    count(*) FILTER (WHERE date < {late}) AS n_early,
    count(*) FILTER (WHERE date >= {late}) AS n_late,
    {type_counts}
  FROM obs GROUP BY customer_id),
days AS (
  SELECT customer_id, date, count(*) AS n, coalesce(sum(amount), 0e0) AS amt
  FROM obs GROUP BY customer_id, date),
gap AS (
  SELECT customer_id,
    CASE WHEN sum(n) = 1 THEN date_diff('day', max(date), {last})
         WHEN count(*) = 1 THEN 0 ELSE max(g) END AS tx_max_gap
  FROM (SELECT *, date_diff('day', lag(date) OVER (PARTITION BY customer_id ORDER BY date), date) AS g
        FROM days) AS d
  GROUP BY customer_id),
mon AS (
  SELECT customer_id, date_trunc('month', date) AS m, CAST(sum(n) AS DOUBLE) AS mc, sum(amt) AS ma
  FROM days GROUP BY customer_id, date_trunc('month', date)),
trend AS (
  SELECT customer_id,
    CASE WHEN count(*) >= 2 THEN regr_slope(mc, x) ELSE 0e0 END AS tx_count_trend,
    CASE WHEN count(*) >= 2 AND avg(ma) <> 0 THEN regr_slope(ma, x) / avg(ma) ELSE 0e0 END AS tx_amt_trend
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY m) - 1 AS DOUBLE) AS x
        FROM mon) AS mm
  GROUP BY customer_id),
feat AS (
  SELECT a.customer_id, a.tx_count, a.tx_total, a.tx_mean, a.tx_median, a.tx_std, a.tx_min, a.tx_max,
    a.tx_std / greatest(a.tx_mean, 1e0) AS tx_cv,
    date_diff('day', a.last_d, {last}) AS tx_recency,
    greatest(date_diff('day', a.first_d, a.last_d), 1) AS tx_span,
    a.tx_count / greatest(date_diff('day', a.first_d, a.last_d), 1) AS tx_freq,
    {shares},
    a.tx_wknd_ratio, t.tx_count_trend, t.tx_amt_trend, g.tx_max_gap,
    CASE WHEN a.n_early > 0 THEN (a.n_late / {float(w.late_periods)}e0) / (a.n_early / {float(w.early_periods)}e0)
         WHEN a.n_late > 0 THEN 2e0 ELSE 0e0 END AS tx_late_ratio
  FROM agg a LEFT JOIN trend t USING (customer_id) LEFT JOIN gap g USING (customer_id)),
base AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS customer_id,
    coalesce(n.obs_count, 0) AS obs_count, coalesce(n.fut_count, 0) AS fut_count
  FROM customer c LEFT JOIN cnt n ON n.customer_id = c.c_custkey),
lab AS (
  SELECT *, CASE WHEN obs_monthly > 0 THEN fut_monthly / obs_monthly
                 WHEN fut_count > 0 THEN 1e0 ELSE 0e0 END AS activity_ratio
  FROM (SELECT *, obs_count / {float(w.obs_periods)}e0 AS obs_monthly,
               fut_count / {float(w.pred_periods)}e0 AS fut_monthly FROM base) AS b),
mart AS (
  SELECT l.customer_id, l.obs_count, l.fut_count, l.obs_monthly, l.fut_monthly, l.activity_ratio,
    CAST(fut_count = 0 OR activity_ratio < {rules.disengage_ratio}e0 AS INTEGER) AS future_disengaged,
    CAST(fut_monthly >= {rules.growth_factor}e0 * obs_monthly OR (obs_monthly = 0 AND fut_count > 0) AS INTEGER)
      AS future_growth,
    {", ".join(f"CAST(coalesce(f.{c}, 0) AS {INT_SQL[c]}) AS {c}" if c in INT_SQL else f"coalesce(f.{c}, 0) AS {c}"
               for c in tx_feature_columns(TYPES[m.table]))}
  FROM lab l LEFT JOIN feat f USING (customer_id))"""


MART_DOUBLES_BASE = ["obs_monthly", "fut_monthly", "activity_ratio"]


def mart_doubles(m: TxMapping) -> list[str]:
    ints = {"tx_count", "tx_recency", "tx_span", "tx_max_gap"}
    return MART_DOUBLES_BASE + [c for c in tx_feature_columns(TYPES[m.table]) if c not in ints]


def mart_sql(m: TxMapping, cols: list[str] | None = None) -> str:
    sel = ", ".join(cols) if cols else "*"
    body = f"WITH {mart_ctes(m)}\nSELECT {sel} FROM mart"
    dbl = [c for c in mart_doubles(m) if cols is None or c in cols]
    return rounded(body, dbl)


LABEL_COLS = ["customer_id", "obs_count", "fut_count", "obs_monthly", "fut_monthly",
              "activity_ratio", "future_disengaged", "future_growth"]
RFM = ["tx_count", "tx_total", "tx_mean", "tx_median", "tx_std", "tx_min", "tx_max",
       "tx_cv", "tx_recency", "tx_span", "tx_freq"]


def class_dist_sql(label: str) -> str:
    return f"""WITH {mart_ctes(ORDERS_MAPPING)},
c AS (SELECT {label}, count(*) AS n FROM mart GROUP BY {label})
SELECT {label}, n, round(n * 100e0 / (SELECT sum(n) FROM c), 1) AS pct FROM c"""


def base_rate_sql(label: str) -> str:
    return rounded(f"""WITH {mart_ctes(ORDERS_MAPPING)}
SELECT count(*) AS n_total, CAST(sum({label}) AS BIGINT) AS n_pos,
       sum({label}) / count(*) AS pos_rate,
       CAST((count(*) - sum({label})) AS DOUBLE) / greatest(sum({label}), 1) AS imbalance_ratio
FROM mart""", ["pos_rate", "imbalance_ratio"])


def target_feature_sql() -> dict[str, str]:
    o, e = ORDERS_MAPPING, EVENTS_MAPPING
    shares = ["customer_id"] + [share_name(t) for t in TYPES[o.table]]
    return {
        "t_labels_orders": mart_sql(o, LABEL_COLS),
        "s1_s2_string_key_labels": "SELECT * REPLACE ('C' || CAST(customer_id AS VARCHAR) AS customer_id) "
                                   f"FROM ({mart_sql(o, LABEL_COLS)}) AS t",
        "t_labels_events": mart_sql(e, LABEL_COLS),
        "t9_class_dist_disengaged": class_dist_sql("future_disengaged"),
        "t9_class_dist_growth": class_dist_sql("future_growth"),
        "t10_base_rate": base_rate_sql("future_disengaged"),
        "f01_f09_rfm": mart_sql(o, ["customer_id"] + RFM),
        "f10_type_shares": mart_sql(o, shares),
        "f11_weekend_ratio": mart_sql(o, ["customer_id", "tx_wknd_ratio"]),
        "f13_f14_trends": mart_sql(o, ["customer_id", "tx_count_trend", "tx_amt_trend"]),
        "f15_max_gap": mart_sql(o, ["customer_id", "tx_max_gap"]),
        "f16_late_ratio": mart_sql(o, ["customer_id", "tx_late_ratio"]),
        "f18_mart_orders": mart_sql(o),
        "f18_mart_events": mart_sql(e),
    }




# ---------------------------------------------------------------- quality, split, prep
def income_sql(col: str = "c_acctbal") -> str:
    lo, mid, hi = INCOME_CUTS
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN {col} < {lo}e0 THEN 'Low' "
            f"WHEN {col} < {mid}e0 THEN 'Medium' WHEN {col} < {hi}e0 THEN 'High' "
            f"ELSE 'Very High' END")


CUST_CTE = f"""cust AS (
  SELECT CAST(c_custkey AS BIGINT) AS customer_id, CAST(c_acctbal AS DOUBLE) AS c_acctbal,
         CAST(c_nationkey AS INTEGER) AS c_nationkey, c_mktsegment,
         {income_sql()} AS income_bracket,
         (c_acctbal + 1000e0) / 11000e0 AS sanity_score
  FROM customer)"""


def hash_bucket_sql(key: str, seed: int = 42) -> str:
    return f"((('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT) % 100)"


def split_case(b: str, s: SplitSpec = SplitSpec()) -> str:
    return (f"CASE WHEN {b} < {s.train_pct} THEN 'train' WHEN {b} < {s.train_pct + s.val_pct} "
            f"THEN 'val' ELSE 'test' END")


def split_ctes() -> str:
    """``mart``, ``cust``, ``sp`` (mart + split) and ``full_rows``."""
    return f"""{mart_ctes(ORDERS_MAPPING)},
{CUST_CTE},
sp AS (SELECT *, {split_case(hash_bucket_sql('customer_id'))} AS split FROM mart),
full_rows AS (SELECT sp.*, c.c_acctbal, c.c_nationkey, c.c_mktsegment, c.income_bracket
              FROM sp JOIN cust c USING (customer_id))"""


def quality_split_sql() -> dict[str, str]:
    o, e = ORDERS_MAPPING, EVENTS_MAPPING
    ev_enriched = f"""WITH {CUST_CTE},
ev AS (SELECT user_id AS customer_id, count(*) AS n_events, sum(value) AS total_value,
              min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY user_id),
j AS (SELECT * FROM cust LEFT JOIN ev USING (customer_id))"""
    null_cols = ["customer_id", "c_acctbal", "c_nationkey", "c_mktsegment", "income_bracket",
                 "sanity_score", "n_events", "total_value", "first_ts", "last_ts"]
    null_union = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n FROM j"
        for c in null_cols)

    def orphans(m):
        return f"""WITH ck AS (SELECT DISTINCT c_custkey AS k FROM customer),
tk AS (SELECT DISTINCT {m.customer_id} AS k FROM {m.table} WHERE {m.customer_id} IS NOT NULL)
SELECT (SELECT count(*) FROM ck WHERE k NOT IN (SELECT k FROM tk)) AS orphans_cust_to_tx,
       (SELECT count(*) FROM tk WHERE k NOT IN (SELECT k FROM ck)) AS orphans_tx_to_cust"""

    exact = f"""WITH {split_ctes()},
r AS (SELECT customer_id, future_disengaged,
        row_number() OVER (PARTITION BY future_disengaged
          ORDER BY ('0x' || substr(md5('42:' || CAST(customer_id AS VARCHAR)), 1, 8))::BIGINT,
                   customer_id) - 1 AS pos,
        count(*) OVER (PARTITION BY future_disengaged) AS nc
      FROM mart)
SELECT customer_id, CASE WHEN pos / nc < 0.6e0 THEN 'train' WHEN pos / nc < 0.8e0 THEN 'val'
                         ELSE 'test' END AS split FROM r"""
    w = WINDOWS[o.table]
    return {
        "s3_table_profile": f"""SELECT count(*) AS n_rows, 4 AS n_cols, min(CAST({o.date} AS DATE)) AS min_date,
  max(CAST({o.date} AS DATE)) AS max_date FROM {o.table}""",
        "s3_source_profile": f"""SELECT 'orders' AS table_name, count(*) AS n_rows,
  (SELECT count(*)::INTEGER FROM (DESCRIBE orders)) AS n_cols, min(CAST({o.date} AS DATE)) AS min_date,
  max(CAST({o.date} AS DATE)) AS max_date FROM orders
UNION ALL SELECT 'customer', count(*), (SELECT count(*)::INTEGER FROM (DESCRIBE customer)), NULL, NULL FROM customer""",
        "t1_t2_window_rows": f"""SELECT count(*) FILTER (WHERE CAST({o.date} AS DATE) < {q(w.obs_end)}) AS obs_rows,
  count(*) FILTER (WHERE CAST({o.date} AS DATE) >= {q(w.pred_start)}) AS pred_rows
FROM {o.table}""",
        "f19_tx_strict_rows": mart_sql(o, ["customer_id"] + tx_feature_columns(TYPES["orders"])),
        "f19_cust_only_rows": rounded(f"WITH {CUST_CTE} SELECT customer_id, c_acctbal, c_nationkey, income_bracket, "
                                      f"c_mktsegment FROM cust", ["c_acctbal"]),
        "q1_q2_key_profile": f"""SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS n_cust_unique,
  (SELECT count(DISTINCT {o.customer_id}) FROM {o.table}) AS n_tx_unique,
  (SELECT count(*) - count(DISTINCT c_custkey) FROM customer) AS n_duplicated""",
        "q3_null_profile": f"""{ev_enriched}
SELECT column_name, n_null, round(n_null * 100e0 / n, 1) AS pct FROM ({null_union}) AS u WHERE n_null > 0""",
        "q4_orphans_orders": orphans(o),
        "q4_orphans_events": orphans(e),
        "q5_q7_clean_customers": f"WITH {CUST_CTE} SELECT customer_id, c_acctbal, c_nationkey, "
                                 f"c_mktsegment, income_bracket FROM cust",
        "q5_q7_clean_listed": "SELECT c_custkey AS customer_id, CAST(c_acctbal < 0 AS INTEGER) AS in_debt, "
                              "round(c_acctbal, 6) AS balance FROM customer",
        "q8_sanity_holdout": rounded(f"WITH {CUST_CTE} SELECT customer_id, sanity_score FROM cust",
                                     ["sanity_score"]),
        "p1_split_hash": f"WITH {split_ctes()} SELECT customer_id, split FROM sp",
        "p1_split_exact": exact,
        "p2_split_profile": rounded(f"""WITH {split_ctes()}
SELECT split, count(*) AS n, avg(CAST(future_disengaged AS DOUBLE)) AS pos_rate FROM sp GROUP BY split""",
                                    ["pos_rate"]),
        "p3_holdout_split": f"""SELECT CAST(c_custkey AS BIGINT) AS customer_id,
  CASE WHEN {hash_bucket_sql('c_custkey')} < 80 THEN 'train' ELSE 'test' END AS split FROM customer""",
        "p4_p9_preprocess_full": preprocess_sql(),
    }


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def preprocess_sql() -> str:
    numeric = ["c_acctbal", "c_nationkey"] + tx_feature_columns(TYPES["orders"])
    med = ", ".join(f"median({c}) AS md_{i}" for i, c in enumerate(numeric))
    imp = ", ".join(f"coalesce({c}, s1.md_{i}) AS {c}" for i, c in enumerate(numeric))
    mom = ", ".join(f"avg({c}) AS mu_{i}, stddev_pop({c}) AS sd_{i}" for i, c in enumerate(numeric))
    num_out = ", ".join(
        f"(coalesce(f.{c}, s1.md_{i}) - s2.mu_{i}) / CASE WHEN s2.sd_{i} IS NULL OR s2.sd_{i} < 2.220446049250313e-15 "
        f"THEN 1e0 ELSE s2.sd_{i} END AS {c}" for i, c in enumerate(numeric))
    ordinal = ("CASE f.income_bracket WHEN 'Low' THEN 0e0 WHEN 'Medium' THEN 1e0 WHEN 'High' THEN 2e0 "
               "WHEN 'Very High' THEN 3e0 ELSE -1e0 END AS income_bracket")
    nominal = ", ".join(
        f"CAST(coalesce(f.c_mktsegment, md.mode) = '{v}' AS DOUBLE) AS c_mktsegment_{v}"
        for v in SEGMENTS[1:])
    out_cols = numeric + ["income_bracket"] + [f"c_mktsegment_{v}" for v in SEGMENTS[1:]]
    return rounded(f"""WITH {split_ctes()},
tr AS (SELECT * FROM full_rows WHERE split = 'train'),
s1 AS (SELECT {med} FROM tr),
tri AS (SELECT {imp} FROM tr, s1),
s2 AS (SELECT {mom} FROM tri),
md AS (SELECT c_mktsegment AS mode FROM tr WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
       ORDER BY count(*) DESC, c_mktsegment ASC LIMIT 1)
SELECT f.customer_id, f.split, {num_out}, {ordinal}, {nominal}
FROM full_rows f, s1, s2, md""", out_cols)




# ---------------------------------------------------------------- evaluation
EPS10 = "2.220446049250313e-15"


def mm(col: str, src: str | None = None) -> str:
    """min-max over all rows of the CTE (constant -> 0)."""
    x = src or col
    return (f"CASE WHEN max({x}) OVER () - min({x}) OVER () < {EPS10} THEN 0e0 "
            f"ELSE ({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) END")


def standin_ctes(m: TxMapping = ORDERS_MAPPING) -> str:
    head = split_ctes() if m is ORDERS_MAPPING else f"{mart_ctes(m)},\nsp AS (SELECT * FROM mart)"
    return f"""{head},
st AS (SELECT *, {mm('s_recency', 'tx_recency')} AS s_recency, {mm('s_gap', 'tx_max_gap')} AS s_gap,
              {mm('s_late', 'tx_late_ratio')} AS s_late, {mm('s_freq', 'tx_freq')} AS s_freq
       FROM sp)"""


def scored_cte(name: str = "sc", split: str = "test", score: str = "s_recency") -> str:
    return (f"{name} AS (SELECT customer_id, future_disengaged AS label, {score} AS score "
            f"FROM st WHERE split = '{split}')")


def rank_sql(sc: str = "sc") -> str:
    return f"""SELECT CAST(sum(pos + neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS n_pos,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(neg * ((cum_pos - pos) + pos / 2e0)) / (sum(pos) * sum(neg)) END AS roc_auc,
  CASE WHEN sum(pos) > 0 THEN sum(pos * (cum_pos / (cum_pos + cum_neg))) / sum(pos) END AS pr_auc
FROM (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg
      FROM (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM {sc} GROUP BY score) AS t) AS c"""


def prf_sql(tp: str, fp: str, fn: str) -> str:
    return (f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0e0 END AS precision, "
            f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn}) ELSE 0e0 END AS recall, "
            f"CASE WHEN 2 * {tp} + {fp} + {fn} > 0 THEN 2 * {tp} / (2 * {tp} + {fp} + {fn}) ELSE 0e0 END AS f1")


def counts_sql(sc: str, t: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE score >= {t} AND label = 1) AS tp,
  count(*) FILTER (WHERE score >= {t} AND label <> 1) AS fp,
  count(*) FILTER (WHERE score < {t} AND label = 1) AS fn,
  count(*) FILTER (WHERE score < {t} AND label <> 1) AS tn FROM {sc}"""


def threshold_sql(sc: str, t: float) -> str:
    return (f"SELECT {t}e0 AS threshold, {prf_sql('tp', 'fp', 'fn')}, tp + fp AS n_flagged "
            f"FROM ({counts_sql(sc, f'{t}e0')}) AS k")


def top_decile_sql(sc: str = "sc") -> str:
    return f"""SELECT k, top_pos / k AS precision_at_k, top_pos / greatest(n_pos, 1) AS recall_at_k,
  (top_pos / k) / greatest(n_pos / n, 1e-9) AS lift_top_decile
FROM (SELECT n, n_pos, k, coalesce((SELECT sum(label) FROM r WHERE rn <= k), 0) AS top_pos
      FROM (SELECT count(*) AS n, sum(label) AS n_pos, greatest(count(*) // 10, 1) AS k FROM {sc}) AS a) AS b"""


def sweep_sql(sc: str) -> str:
    return f"""SELECT m / 100e0 AS threshold, {prf_sql('tp', 'fp', 'fn')}
FROM (SELECT m, count(*) FILTER (WHERE score >= m / 100e0 AND label = 1) AS tp,
             count(*) FILTER (WHERE score >= m / 100e0 AND label <> 1) AS fp,
             count(*) FILTER (WHERE score < m / 100e0 AND label = 1) AS fn
      FROM range(5, 96) AS th(m), {sc} GROUP BY m) AS s"""


METRIC_COLS = ["roc_auc", "pr_auc", "brier", "f1", "precision", "recall", "precision_at_k",
               "recall_at_k", "lift_top_decile"]


def eval_row_sql(sc: str) -> str:
    return f"""SELECT rk.roc_auc, rk.pr_auc, br.brier, th.f1, th.precision, th.recall,
  td.precision_at_k, td.recall_at_k, td.lift_top_decile
FROM ({rank_sql(sc)}) AS rk, (SELECT avg(power(score - label, 2)) AS brier FROM {sc}) AS br,
     ({threshold_sql(sc, 0.5)}) AS th,
     ({top_decile_sql(sc).replace(' FROM r WHERE', f' FROM (SELECT label, row_number() OVER (ORDER BY score DESC, customer_id ASC) AS rn FROM {sc}) AS r WHERE')}) AS td"""


GRID = [("Full", "recency", "s_recency"), ("Full", "gap", "s_gap"),
        ("Tx-strict", "recency", "s_recency"), ("Tx-strict", "freq", "s_freq")]


def grid_sql() -> str:
    ctes = ",\n".join(scored_cte(f"g{i}", "test", s) for i, (_, _, s) in enumerate(GRID))
    rows = " UNION ALL ".join(f"SELECT '{a}' AS setup, '{m}' AS model, * FROM ({eval_row_sql(f'g{i}')}) AS e{i}"
                              for i, (a, m, _) in enumerate(GRID))
    return f"WITH {standin_ctes()},\n{ctes}\n{rows}"


def evaluation_sql() -> dict[str, str]:
    base = f"WITH {standin_ctes()},\n{scored_cte()},\n{scored_cte('va', 'val')}"
    rk = f"{base},\nr AS (SELECT label, row_number() OVER (ORDER BY score DESC, customer_id ASC) AS rn FROM sc)"
    best = f"(SELECT threshold FROM ({sweep_sql('va')}) AS s ORDER BY f1 DESC, threshold ASC LIMIT 1)"
    report = f"""{base},
k AS ({counts_sql('sc', best)}),
m AS (SELECT tp, fp, fn, tn, tp + fn AS s1, tn + fp AS s0, tp + fn + tn + fp AS n,
        CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END AS p1,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END AS r1,
        CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0e0 END AS f1,
        CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0e0 END AS p0,
        CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0e0 END AS r0,
        CASE WHEN 2 * tn + fn + fp > 0 THEN 2 * tn / (2 * tn + fn + fp) ELSE 0e0 END AS f0 FROM k)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM m
UNION ALL SELECT '1', p1, r1, f1, s1 FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0e0 END, n FROM m
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM m
UNION ALL SELECT 'weighted avg', CASE WHEN n > 0 THEN (p0 * s0 + p1 * s1) / n ELSE 0e0 END,
  CASE WHEN n > 0 THEN (r0 * s0 + r1 * s1) / n ELSE 0e0 END,
  CASE WHEN n > 0 THEN (f0 * s0 + f1 * s1) / n ELSE 0e0 END, n FROM m"""
    cm = f"""{base}
SELECT a.actual, a.predicted, coalesce(c.n, 0) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS a(actual, predicted)
LEFT JOIN (SELECT CAST(label AS INTEGER) AS actual, CAST(score >= 0.5e0 AS INTEGER) AS predicted,
                  count(*) AS n FROM sc GROUP BY 1, 2) AS c USING (actual, predicted)"""
    sanity = f"""{base},
j AS (SELECT sc.*, cust.sanity_score FROM sc JOIN cust USING (customer_id)),
je AS (SELECT customer_id, label, sanity_score AS score FROM j)
SELECT (SELECT corr(score, sanity_score) FROM j) AS pearson,
       (SELECT roc_auc FROM ({rank_sql('j')}) AS a) AS auc_model,
       (SELECT roc_auc FROM ({rank_sql('je')}) AS b) AS auc_external"""
    setup = f"""WITH g AS ({grid_sql()}),
p AS (SELECT setup, max(CASE WHEN model = 'freq' THEN roc_auc END) AS freq,
             max(CASE WHEN model = 'gap' THEN roc_auc END) AS gap,
             max(CASE WHEN model = 'recency' THEN roc_auc END) AS recency,
             max(roc_auc) AS best_auc FROM g GROUP BY setup)
SELECT *, (SELECT max(best_auc) FILTER (WHERE setup = 'Full') - max(best_auc) FILTER (WHERE setup = 'Tx-strict') FROM p)
  AS gap_full_minus_tx FROM p"""
    cum = """(SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N
      FROM (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM sc GROUP BY score) AS t) AS c"""
    roc = f"""{base}
SELECT NULL::DOUBLE AS threshold, 0e0 AS fpr, 0e0 AS tpr
UNION ALL SELECT score, CASE WHEN N > 0 THEN cum_neg / N ELSE 0e0 END, CASE WHEN P > 0 THEN cum_pos / P ELSE 0e0 END FROM {cum}"""
    pr = f"""{base}
SELECT NULL::DOUBLE AS threshold, 0e0 AS recall, 1e0 AS precision
UNION ALL SELECT score, CASE WHEN P > 0 THEN cum_pos / P ELSE 0e0 END,
  CASE WHEN cum_pos + cum_neg > 0 THEN cum_pos / (cum_pos + cum_neg) ELSE 0e0 END FROM {cum}"""
    return {
        "e1_e2_rank_metrics": rounded(f"{base}\n{rank_sql()}", ["roc_auc", "pr_auc"]),
        "e1_e2_rank_metrics_events": rounded(
            f"WITH {standin_ctes(EVENTS_MAPPING)},\nsc AS (SELECT customer_id, future_disengaged AS label, "
            f"s_recency AS score FROM st)\n{rank_sql()}", ["roc_auc", "pr_auc"]),
        "e3_brier": rounded(f"{base}\nSELECT avg(power(score - label, 2)) AS brier FROM sc", ["brier"]),
        "e4_threshold_metrics": rounded(f"{base}\n{threshold_sql('sc', 0.5)}",
                                        ["threshold", "precision", "recall", "f1"]),
        "e5_e6_top_decile": rounded(f"{rk}\n{top_decile_sql()}",
                                    ["precision_at_k", "recall_at_k", "lift_top_decile"]),
        "e7_evaluation_table": rounded(grid_sql(), METRIC_COLS),
        "e8_threshold_sweep": rounded(f"{base}\n{sweep_sql('va')}",
                                      ["threshold", "precision", "recall", "f1"]),
        "e9_best_threshold": rounded(f"{base}\nSELECT threshold, f1 FROM ({sweep_sql('va')}) AS s "
                                     f"ORDER BY f1 DESC, threshold ASC LIMIT 1", ["threshold", "f1"]),
        "e10_classification_report": rounded(report, ["precision", "recall", "f1"]),
        "e11_confusion_matrix": cm,
        "e12_what_if_threshold": rounded(f"{base}\n{threshold_sql('sc', 0.35)}",
                                         ["threshold", "precision", "recall", "f1"]),
        "e13_sanity_check": rounded(sanity, ["pearson", "auc_model", "auc_external"]),
        "e14_setup_comparison": rounded(setup, ["freq", "gap", "recency", "best_auc",
                                                "gap_full_minus_tx"]),
        "h1_roc_points": rounded(roc, ["threshold", "fpr", "tpr"]),
        "h2_pr_points": rounded(pr, ["threshold", "recall", "precision"]),
    }


# ---------------------------------------------------------------- signals and ranking
SIG_COLS = ["customer_id", "buy_propensity", "redemption_risk", "engagement_score", "master_signal",
            "co_additive", "expected_client_value", "opportunity_frontier_score", "recommended_action"]
SIG_DOUBLES = SIG_COLS[1:-1]
TOP_COLS = ["customer_id", "buy_propensity", "redemption_risk", "engagement_score", "master_signal",
            "expected_client_value", "opportunity_frontier_score", "recommended_action"]


def signal_ctes(p: SignalParams = SignalParams(), m: TxMapping = ORDERS_MAPPING) -> str:
    return f"""{standin_ctes(m)},
e1 AS (SELECT customer_id, tx_total, s_late AS bp_raw, s_recency AS rr_raw,
         {mm('x', 'tx_freq')} AS f_n, {mm('x', 'tx_recency')} AS r_n,
         {mm('x', 'tx_max_gap')} AS g_n, {mm('x', 'tx_count_trend')} AS t_n FROM st),
e2 AS (SELECT *, least(greatest({p.w_freq}e0 * f_n + {p.w_trend}e0 * t_n + {p.w_recency}e0 * (1 - r_n)
                               + {p.w_gap}e0 * (1 - g_n), 0e0), 1e0) AS engagement_raw FROM e1),
n1 AS (SELECT customer_id, tx_total, {mm('x', 'bp_raw')} AS buy_propensity,
         {mm('x', 'rr_raw')} AS redemption_risk, {mm('x', 'engagement_raw')} AS engagement_score FROM e2),
c1 AS (SELECT *, buy_propensity * engagement_score - redemption_risk AS co_raw,
              buy_propensity * (1 - redemption_risk) * engagement_score AS ms_raw FROM n1),
c2 AS (SELECT customer_id, tx_total, buy_propensity, redemption_risk, engagement_score,
              {mm('x', 'co_raw')} AS co_additive, {mm('x', 'ms_raw')} AS master_signal FROM c1),
v1 AS (SELECT *, master_signal * coalesce(tx_total, 0e0) AS expected_client_value FROM c2),
v2 AS (SELECT *, expected_client_value / greatest(redemption_risk, {p.risk_floor}e0) AS of_raw FROM v1),
sig AS (SELECT customer_id, buy_propensity, redemption_risk, engagement_score, master_signal, co_additive,
          expected_client_value, {mm('x', 'of_raw')} AS opportunity_frontier_score,
          CASE WHEN buy_propensity > {p.upsell_bp}e0 AND redemption_risk < {p.upsell_rr}e0 THEN 'Upsell'
               WHEN redemption_risk > {p.retention_rr}e0 THEN 'Retention' ELSE 'Monitor' END AS recommended_action
        FROM v2)"""


def top_sql(by: str, cols: list[str] = TOP_COLS, n: int = 100) -> str:
    return f"SELECT {', '.join(cols)} FROM sig ORDER BY {by} DESC, customer_id ASC LIMIT {n}"


def signal_sql() -> dict[str, str]:
    base = f"WITH {signal_ctes()}"
    top_dbl = [c for c in TOP_COLS if c in SIG_DOUBLES]
    fmt3 = "printf('%.3f', round({v}, 3))"
    beh = ["tx_count", "tx_total", "tx_recency", "tx_max_gap", "tx_late_ratio", "tx_wknd_ratio"]
    drill_rows = " UNION ALL ".join(
        f"SELECT CAST(customer_id AS VARCHAR) AS client_id, '{c.replace('_', ' ').title()}' AS feature, "
        f"CASE WHEN CAST({c} AS DOUBLE) > 100 THEN format('{{:,}}', CAST(round(CAST({c} AS DOUBLE), 0) AS BIGINT)) "
        f"ELSE {fmt3.format(v=f'CAST({c} AS DOUBLE)')} END AS value FROM j WHERE {c} IS NOT NULL"
        for c in beh)
    f2 = "printf('%.2f', round({}, 2))"
    bp, rr, eng = (f2.format(c) for c in ("buy_propensity", "redemption_risk", "engagement_score"))
    interp = f"""{base}
SELECT customer_id, tier, CASE tier
  WHEN 'upsell' THEN 'Likely to grow and unlikely to leave; ' || CASE WHEN engagement_score > 0.5e0 THEN 'highly' ELSE 'fairly' END
    || ' active. Offer more.'
  WHEN 'retention' THEN 'Likely to leave; ' || CASE WHEN buy_propensity > 0.4e0 THEN 'some' ELSE 'little' END || ' growth left, '
    || CASE WHEN engagement_score < 0.3e0 THEN 'activity fading' ELSE 'still active' END || '. Get in touch soon.'
  WHEN 'emerging' THEN 'May grow, at a risk worth taking. Keep in contact.'
  ELSE 'No clear direction. Look again after the next run.' END
  || ' [growth ' || {bp} || ', risk ' || {rr} || ', engagement ' || {eng} || ']' AS interpretation
FROM (SELECT *, CASE WHEN buy_propensity > 0.6e0 AND redemption_risk < 0.3e0 THEN 'upsell'
                     WHEN redemption_risk > 0.6e0 THEN 'retention'
                     WHEN buy_propensity > 0.4e0 AND redemption_risk < 0.5e0 THEN 'emerging'
                     ELSE 'monitor' END AS tier FROM sig) AS t"""
    seg = f"""{base},
p99 AS (SELECT quantile_cont(expected_client_value, 0.99) AS p99 FROM sig),
c AS (SELECT sig.*, least(expected_client_value, p99) AS ecv_clipped FROM sig, p99),
q AS (SELECT quantile_cont(ecv_clipped, 0.5) AS mid, quantile_cont(ecv_clipped, 0.92) AS top,
             quantile_cont(ecv_clipped, 0.08) AS bot FROM c)
SELECT customer_id, redemption_risk, ecv_clipped, mid AS ecv_median, top AS label_top, bot AS label_bottom,
  CASE WHEN ecv_clipped >= mid AND redemption_risk < 0.5e0 THEN 'STRATEGIC UPSELL'
       WHEN ecv_clipped >= mid THEN 'RETENTION PRIORITY'
       WHEN redemption_risk < 0.5e0 THEN 'STABLE / LOW PRIORITY' ELSE 'MONITOR' END AS segment
FROM c, q"""
    quad = f"""{base},
ps AS (SELECT *, engagement_score * 0.4e0 + buy_propensity * 0.4e0 + (1 - redemption_risk) * 0.2e0 AS product_base_score FROM sig),
md AS (SELECT quantile_cont(master_signal, 0.5) AS med FROM ps)
SELECT customer_id, master_signal, product_base_score, med AS master_median,
  CASE WHEN master_signal >= med AND product_base_score >= 0.5e0 THEN 'upper_right'
       WHEN product_base_score >= 0.5e0 THEN 'upper_left'
       WHEN master_signal >= med THEN 'lower_right' ELSE 'lower_left' END AS quadrant
FROM ps, md"""
    return {
        "g1_minmax_scale": rounded(f"WITH {standin_ctes()} SELECT customer_id, s_recency, s_gap, s_late, s_freq FROM st",
                                   ["s_recency", "s_gap", "s_late", "s_freq"]),
        "g2_engagement": rounded(f"{base} SELECT customer_id, engagement_raw FROM e2", ["engagement_raw"]),
        "g1_g8_signal_table": rounded(f"{base} SELECT * FROM sig", SIG_DOUBLES),
        "g1_g8_signal_table_events": rounded(f"WITH {signal_ctes(m=EVENTS_MAPPING)} SELECT * FROM sig",
                                             SIG_DOUBLES),
        "g5_formulation_corr": rounded(f"{base} SELECT corr(co_additive, master_signal) AS corr_additive_master FROM sig",
                                       ["corr_additive_master"]),
        "g9_top_opportunities": rounded(f"{base} {top_sql('expected_client_value')}", top_dbl),
        "g10_top_frontier": rounded(f"{base} {top_sql('opportunity_frontier_score')}", top_dbl),
        "g10_top_master": rounded(f"{base} {top_sql('master_signal')}", top_dbl),
        "g11_ranking_overlap": f"""{base},
f AS ({top_sql('opportunity_frontier_score', ['customer_id'])}), m AS ({top_sql('master_signal', ['customer_id'])})
SELECT (SELECT count(*) FROM (SELECT * FROM f INTERSECT SELECT * FROM m) AS a) AS both,
       (SELECT count(*) FROM (SELECT * FROM f EXCEPT SELECT * FROM m) AS b) AS frontier_only,
       (SELECT count(*) FROM (SELECT * FROM m EXCEPT SELECT * FROM f) AS c) AS master_only""",
        "g12_hidden_gems": rounded(f"""{base},
f AS ({top_sql('opportunity_frontier_score')}), m AS ({top_sql('master_signal', ['customer_id'])})
SELECT * FROM f WHERE customer_id NOT IN (SELECT customer_id FROM m)""", top_dbl),
        "g13_product_score": rounded(f"""{base} SELECT customer_id, engagement_score * 0.4e0 + buy_propensity * 0.4e0
  + (1 - redemption_risk) * 0.2e0 AS product_base_score FROM sig""", ["product_base_score"]),
        "g14_product_quadrant": rounded(quad, ["master_signal", "product_base_score", "master_median"]),
        "g15_strategic_segments": rounded(seg, ["redemption_risk", "ecv_clipped", "ecv_median", "label_top",
                                                "label_bottom"]),
        "g16_frontier_zone": rounded(f"""{base} SELECT customer_id, buy_propensity, redemption_risk,
  CASE WHEN buy_propensity > 0.6e0 AND redemption_risk < 0.3e0 THEN 'HIGH OPP LOW RISK'
       WHEN buy_propensity > 0.6e0 THEN 'HIGH OPP HIGH RISK' ELSE 'LOW OPPORTUNITY' END AS zone FROM sig""",
                                     ["buy_propensity", "redemption_risk"]),
        "g17_drilldown_table": f"""{base},
j AS (SELECT sig.customer_id, m.tx_count, m.tx_total, m.tx_recency, m.tx_max_gap, m.tx_late_ratio, m.tx_wknd_ratio
      FROM sig LEFT JOIN mart m USING (customer_id))
{drill_rows}""",
        "g17_client_lookup": rounded(f"""{base}
SELECT CAST(customer_id AS VARCHAR) AS client_id, {', '.join(TOP_COLS[1:])} FROM sig
WHERE CAST(customer_id AS VARCHAR) = (SELECT CAST(customer_id AS VARCHAR) FROM sig
  ORDER BY expected_client_value DESC, customer_id ASC LIMIT 1)""", top_dbl),
        "g18_interpretation": interp,
    }


# ---------------------------------------------------------------- walk-forward, charts, reports
def folds_values() -> str:
    w = WINDOWS["orders"]
    rows = ", ".join(f"({f.fold}, {q(FOLDS_START)}, {q(f.obs_end)}, {q(f.pred_start)}, {q(f.pred_end)}, "
                     f"{f.obs_periods}e0, {f.pred_periods}e0)" for f in ORDERS_FOLDS)
    return (f"ft AS (SELECT * FROM (VALUES {rows}) AS f(fold, obs_start, obs_end, pred_start, pred_end, "
            f"obs_periods, pred_periods))")


def fold_ctes() -> str:
    o = ORDERS_MAPPING
    ob = "date < obs_end"
    counts = ", ".join(f"count(*) FILTER (WHERE {ob} AND type = '{t}') AS n_{share_name(t)}" for t in TYPES[o.table])
    shares = ", ".join(f"coalesce(CASE WHEN a.typed > 0 THEN a.n_{share_name(t)} / a.typed END, 0e0) AS {share_name(t)}"
                       for t in TYPES[o.table])
    return f"""tx AS ({tx_sql(o)}),
{folds_values()},
j AS (SELECT tx.*, ft.fold, ft.obs_start, ft.obs_end, ft.pred_start, ft.pred_end
      FROM tx JOIN ft ON tx.date >= ft.obs_start AND tx.date < ft.pred_end),
a AS (SELECT fold, customer_id, count(*) FILTER (WHERE {ob}) AS oc,
        count(*) FILTER (WHERE date >= pred_start AND date < pred_end) AS fc,
        count(amount) FILTER (WHERE {ob}) AS tx_count, sum(amount) FILTER (WHERE {ob}) AS tx_total,
        avg(amount) FILTER (WHERE {ob}) AS tx_mean, stddev_samp(amount) FILTER (WHERE {ob}) AS sd,
        max(date) FILTER (WHERE {ob}) AS last_d, count(type) FILTER (WHERE {ob}) AS typed, {counts}
      FROM j GROUP BY fold, customer_id),
ff AS (SELECT s.fold, s.customer_id, coalesce(a.oc, 0) AS obs_count, coalesce(a.fc, 0) AS fut_count,
         coalesce(a.tx_count, 0) AS tx_count, coalesce(a.tx_total, 0e0) AS tx_total,
         coalesce(a.tx_mean, 0e0) AS tx_mean, coalesce(a.sd, 0e0) AS tx_std,
         coalesce(coalesce(a.sd, 0e0) / greatest(a.tx_mean, 1e0), 0e0) AS tx_cv,
         CAST(coalesce(date_diff('day', a.last_d, s.obs_end - 1), 0) AS INTEGER) AS tx_recency, {shares},
         CAST(coalesce(a.fc, 0) = 0 OR (CASE WHEN coalesce(a.oc, 0) / s.obs_periods > 0
              THEN (coalesce(a.fc, 0) / s.pred_periods) / (coalesce(a.oc, 0) / s.obs_periods)
              WHEN coalesce(a.fc, 0) > 0 THEN 1e0 ELSE 0e0 END) < 0.2e0 AS INTEGER) AS future_disengaged
       FROM (SELECT CAST(c_custkey AS BIGINT) AS customer_id, ft.* FROM customer, ft) AS s
       LEFT JOIN a ON a.fold = s.fold AND a.customer_id = s.customer_id),
mm AS (SELECT fold, min(tx_recency) AS mn, max(tx_recency) AS mx FROM ff GROUP BY fold),
fs AS (SELECT ff.fold, customer_id, future_disengaged AS label,
         CASE WHEN mx - mn <= 0 THEN 0e0 ELSE (tx_recency - mn) / (mx - mn) END AS score
       FROM ff JOIN mm USING (fold) WHERE {hash_bucket_sql('customer_id')} >= 80),
fr AS (SELECT r.fold, r.roc_auc, r.pr_auc, b.brier FROM (
         SELECT fold, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(neg * ((cum_pos - pos) + pos / 2e0)) / (sum(pos) * sum(neg)) END AS roc_auc,
                CASE WHEN sum(pos) > 0 THEN sum(pos * (cum_pos / (cum_pos + cum_neg))) / sum(pos) END AS pr_auc
         FROM (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
                      sum(neg) OVER (PARTITION BY fold ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg
               FROM (SELECT fold, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM fs GROUP BY fold, score) AS t) AS c
         GROUP BY fold) AS r
       JOIN (SELECT fold, avg(power(score - label, 2)) AS brier FROM fs GROUP BY fold) AS b USING (fold))"""


def full_fold_sql() -> str:
    """Every fold's mart over its own windows, one below the other."""
    feats = tx_feature_columns(TYPES["orders"])
    parts = []
    for f in ORDERS_FOLDS:
        w = SimpleNamespace(
            obs_end=f.obs_end, obs_last_day=f.obs_end - dt.timedelta(days=1), pred_start=f.pred_start,
            late_start=f.obs_end - dt.timedelta(days=(f.obs_end - FOLDS_START).days // 3), obs_periods=f.obs_periods,
            pred_periods=f.pred_periods, early_periods=2 * f.obs_periods / 3, late_periods=f.obs_periods / 3)
        parts.append(f"""SELECT {f.fold} AS fold, customer_id, obs_count, fut_count, {', '.join(feats)}, future_disengaged
FROM (WITH {mart_ctes(ORDERS_MAPPING, w=w, start=FOLDS_START, end=f.pred_end)} SELECT * FROM mart) AS f{f.fold}""")
    return rounded(" UNION ALL ".join(parts), [c for c in feats if c not in INT_SQL])


def hist_sql(src: str, col: str, bins: int, series: str = "'all'", clip: bool = False,
             feature: str | None = None) -> str:
    x = f"CAST({col} AS DOUBLE)"
    if clip:
        x = f"least({x}, (SELECT quantile_cont(CAST({col} AS DOUBLE), 0.99) FROM {src}))"
    feat = f"'{feature}' AS feature, " if feature else ""
    return f"""SELECT {feat}series, bin, lo + bin * ((hi - lo) / {bins}) AS bin_lo, lo + (bin + 1) * ((hi - lo) / {bins}) AS bin_hi,
  cnt AS count, cnt / (n * ((hi - lo) / {bins})) AS density
FROM (SELECT series, CAST(least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, lo, hi, n, count(*) AS cnt
      FROM (SELECT d.*, st.lo, st.hi, st.n FROM (SELECT {series} AS series, {x} AS x FROM {src} WHERE {col} IS NOT NULL) AS d
            JOIN (SELECT series, count(*) AS n, CASE WHEN max(x) = min(x) THEN min(x) - 0.5e0 ELSE min(x) END AS lo,
                         CASE WHEN max(x) = min(x) THEN max(x) + 0.5e0 ELSE max(x) END AS hi
                  FROM (SELECT {series} AS series, {x} AS x FROM {src} WHERE {col} IS NOT NULL) AS d0 GROUP BY series) AS st
            USING (series)) AS dj
      GROUP BY series, bin, lo, hi, n) AS h"""


HIST_DBL = ["bin_lo", "bin_hi", "density"]


def report_sql() -> dict[str, str]:
    fb = f"WITH {fold_ctes()}"
    beh = ["tx_count", "tx_total", "tx_recency", "tx_max_gap", "tx_late_ratio", "tx_wknd_ratio"]
    class_h = " UNION ALL ".join(hist_sql("mart", c, 30, "CAST(future_disengaged AS VARCHAR)", True, c)
                                 for c in beh)
    attr_h = " UNION ALL ".join(hist_sql("full_rows", c, 30, "CAST(future_disengaged AS VARCHAR)", False, c)
                                for c in ["c_acctbal", "c_nationkey"])
    sig = f"WITH {signal_ctes()}"
    cols5 = ["buy_propensity", "redemption_risk", "engagement_score", "master_signal", "expected_client_value"]
    corr = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS pearson FROM sig"
                              for a in cols5 for b in cols5)
    from cadence.operators.report import FEATURE_DICTIONARY
    entries = FEATURE_DICTIONARY + [(share_name(t), f"Share of transactions of type {t}", "transactions")
                                    for t in TYPES["orders"]]
    attrs = ("c_acctbal", "c_nationkey", "c_mktsegment", "income_bracket")
    dict_rows = ", ".join("('{}', '{}', '{}')".format(*r) for r in
                          entries + [(c, f"Customer attribute {c}", "customers") for c in attrs])
    means = " UNION ALL ".join([f"SELECT '{f}' AS feature, avg({f}) AS mean FROM mart" for f, _, _ in entries]
                               + [f"SELECT '{c}' AS feature, avg({c}) AS mean FROM cust" for c in attrs[:2]])
    grid = f"({grid_sql()})"
    density = f"""WITH {standin_ctes()},
{scored_cte()},
j AS (SELECT sc.score, cust.sanity_score FROM sc JOIN cust USING (customer_id)),
gs AS (SELECT min(sanity_score) AS x0, max(sanity_score) AS x1, min(score) AS y0, max(score) AS y1 FROM j)
SELECT cx, cy, count(*) AS count FROM (
  SELECT CASE WHEN x1 - x0 <= 0 THEN 0 ELSE CAST(least(floor((sanity_score - x0) * 40 / (x1 - x0)), 39) AS INTEGER) END AS cx,
         CASE WHEN y1 - y0 <= 0 THEN 0 ELSE CAST(least(floor((score - y0) * 40 / (y1 - y0)), 39) AS INTEGER) END AS cy
  FROM j, gs) AS g GROUP BY cx, cy"""
    return {
        "v1_fold_table": f"""WITH tx AS ({tx_sql(ORDERS_MAPPING)}), {folds_values()}
SELECT ft.*, c.obs_rows, c.pred_rows FROM ft LEFT JOIN (
  SELECT fold, count(*) FILTER (WHERE date < obs_end) AS obs_rows, count(*) FILTER (WHERE date >= pred_start) AS pred_rows
  FROM tx JOIN ft ON tx.date >= ft.obs_start AND tx.date < ft.pred_end GROUP BY fold) AS c USING (fold)""",
        "v2_v3_fold_frame": rounded(f"{fb} SELECT * FROM ff",
                                    ["tx_total", "tx_mean", "tx_std", "tx_cv"] + [share_name(t) for t in TYPES["orders"]]),
        "v2_full_fold_frame": full_fold_sql(),
        "v4_fold_results_standin": rounded(f"{fb} SELECT * FROM fr", ["roc_auc", "pr_auc", "brier"]),
        "v5_fold_labels": rounded(f"""{fb}
SELECT ft.fold, strftime(ft.obs_start, '%b') || '-' || strftime(ft.obs_end - 1, '%b') AS obs_window,
       strftime(ft.pred_start, '%b') || '-' || strftime(ft.pred_end - 1, '%b') AS pred_window,
       (SELECT avg(CAST(future_disengaged AS DOUBLE)) FROM ff WHERE ff.fold = ft.fold) AS target_rate FROM ft""",
                                  ["target_rate"]),
        "v6_v7_fold_stability": rounded(f"""{fb}
SELECT avg(roc_auc) AS mean, stddev_samp(roc_auc) AS std, stddev_pop(roc_auc) AS std_pop,
       avg(roc_auc) - stddev_pop(roc_auc) AS band_low, avg(roc_auc) + stddev_pop(roc_auc) AS band_high,
       CASE WHEN stddev_samp(roc_auc) < 0.03e0 THEN 'stable' ELSE 'unstable' END AS verdict FROM fr""",
                                        ["mean", "std", "std_pop", "band_low", "band_high"]),
        "h3_histogram_recency": rounded(f"WITH {mart_ctes(ORDERS_MAPPING)} {hist_sql('mart', 'tx_recency', 30)}",
                                        HIST_DBL),
        "h4_h7_class_histograms": rounded(f"WITH {mart_ctes(ORDERS_MAPPING)} {class_h}", HIST_DBL),
        "h7_attribute_histograms": rounded(f"WITH {split_ctes()} {attr_h}", HIST_DBL),
        "h5_density_grid": density,
        "h6_marker_size": rounded(f"""{sig} SELECT customer_id,
  least(greatest(expected_client_value / (SELECT max(expected_client_value) FROM sig) * 60e0, 2e0), 60e0) AS marker_size
FROM sig""", ["marker_size"]),
        "r1_headline_kpis": rounded(f"""WITH g AS {grid}, f AS (WITH {fold_ctes()} SELECT * FROM fr), s AS (WITH {signal_ctes()} SELECT * FROM sig)
SELECT (SELECT max(roc_auc) FILTER (WHERE setup = 'Full') FROM g) AS best_full_auc,
       (SELECT max(roc_auc) FILTER (WHERE setup = 'Tx-strict') FROM g) AS best_tx_auc,
       (SELECT avg(roc_auc) FROM f) AS fold_auc_mean, (SELECT stddev_samp(roc_auc) FROM f) AS fold_auc_std,
       (SELECT count(*) FILTER (WHERE recommended_action = 'Upsell') FROM s) AS n_upsell""",
                                    ["best_full_auc", "best_tx_auc", "fold_auc_mean", "fold_auc_std"]),
        "r2_action_distribution": f"{sig} SELECT recommended_action, count(*) AS n FROM sig GROUP BY recommended_action",
        "r3_signal_means": rounded(f"""{sig} SELECT avg(buy_propensity) AS mean_buy_propensity,
  avg(redemption_risk) AS mean_redemption_risk, avg(engagement_score) AS mean_engagement_score,
  avg(master_signal) AS mean_master_signal FROM sig""",
                                   ["mean_buy_propensity", "mean_redemption_risk", "mean_engagement_score",
                                    "mean_master_signal"]),
        "r4_correlation_matrix": rounded(f"{sig} {corr}", ["pearson"]),
        "r5_ecv_summary": rounded(f"""{sig} SELECT quantile_cont(expected_client_value, 0.5) AS median,
  quantile_cont(expected_client_value, 0.99) AS p99, avg(expected_client_value) AS mean,
  count(expected_client_value) AS n, max(expected_client_value) AS max FROM sig""",
                                  ["median", "p99", "mean", "max"]),
        "r6_frontier_summary": rounded(f"""{sig} SELECT avg(opportunity_frontier_score) AS mean,
  max(opportunity_frontier_score) AS max, quantile_cont(opportunity_frontier_score, 0.5) AS median FROM sig""",
                                       ["mean", "max", "median"]),
        "r7_top100_total_ecv": rounded(f"""{sig} SELECT sum(expected_client_value) AS top_total_ecv, count(*) AS n
FROM ({top_sql('expected_client_value')}) AS t""", ["top_total_ecv"]),
        "r8_run_summary": rounded(f"""WITH gr AS {grid}, {signal_ctes()},
rs AS (SELECT {split_case(hash_bucket_sql('customer_id'))} AS split FROM mart),
br AS (SELECT * FROM gr ORDER BY round(roc_auc, 9) DESC, setup, model LIMIT 1),
bg AS (SELECT * FROM gr WHERE setup = 'Tx-strict' ORDER BY round(roc_auc, 9) DESC, setup, model LIMIT 1)
SELECT (SELECT count(*) FROM mart) AS n_customers,
       (SELECT count(*) FROM rs WHERE split = 'train') AS n_train,
       (SELECT count(*) FROM rs WHERE split = 'val') AS n_val,
       (SELECT count(*) FROM rs WHERE split = 'test') AS n_test,
       (SELECT avg(CAST(future_disengaged AS DOUBLE)) FROM mart) AS disengaged_rate,
       (SELECT avg(CAST(future_growth AS DOUBLE)) FROM mart) AS growth_rate,
       (SELECT count(*) FILTER (WHERE recommended_action = 'Upsell') FROM sig) AS n_upsell,
       (SELECT count(*) FILTER (WHERE recommended_action = 'Retention') FROM sig) AS n_retention,
       (SELECT count(*) FILTER (WHERE recommended_action = 'Monitor') FROM sig) AS n_monitor,
       (SELECT avg(master_signal) FROM sig) AS mean_master_signal,
       (SELECT avg(engagement_score) FROM sig) AS mean_engagement_score,
       (SELECT avg(expected_client_value) FROM sig) AS mean_expected_client_value,
       (SELECT setup FROM br) AS best_risk_setup, (SELECT model FROM br) AS best_risk_model, (SELECT roc_auc FROM br) AS best_risk_auc,
       (SELECT setup FROM bg) AS best_growth_setup, (SELECT model FROM bg) AS best_growth_model,
       (SELECT roc_auc FROM bg) AS best_growth_auc""",
                                  ["disengaged_rate", "growth_rate", "mean_master_signal", "mean_engagement_score",
                                   "mean_expected_client_value", "best_risk_auc", "best_growth_auc"]),
        "r9_metric_highlights": rounded(f"""WITH g AS {grid}
SELECT g.*, roc_auc = (SELECT max(roc_auc) FROM g) AS best_roc_auc, pr_auc = (SELECT max(pr_auc) FROM g) AS best_pr_auc,
  lift_top_decile = (SELECT max(lift_top_decile) FROM g) AS best_lift, brier = (SELECT min(brier) FROM g) AS best_brier
FROM g""", METRIC_COLS),
        "r10_feature_dictionary": rounded(f"""WITH {mart_ctes(ORDERS_MAPPING)},
{CUST_CTE},
d AS (SELECT * FROM (VALUES {dict_rows}) AS v(feature, description, source)),
m AS ({means})
SELECT d.*, m.mean FROM d LEFT JOIN m USING (feature)""", ["mean"]),
    }


def model_sql() -> dict[str, str]:
    base = f"WITH {standin_ctes()},\n{scored_cte()}"
    configs = ", ".join(
        [f"('risk', '{s}', '{a}')" for s in ("Full", "Tx-strict", "Cust-only") for a in ("LR", "RF", "GBT")]
        + [f"('growth', 'Tx-strict', '{a}')" for a in ("LR", "RF", "GBT")])
    zero = "CAST(0 AS BIGINT)"
    return {
        "m10_best_standin": rounded(f"""SELECT setup, model, roc_auc FROM ({grid_sql()}) AS g
QUALIFY row_number() OVER (PARTITION BY setup ORDER BY roc_auc DESC, model) = 1""", ["roc_auc"]),
        "m5_m9_score_properties": f"""WITH {split_ctes()},
c AS (SELECT * FROM (VALUES {configs}) AS v(target, setup, model))
SELECT target, setup, model, split, count(*) AS n, count(DISTINCT customer_id) AS n_customers,
  CAST(sum(CASE WHEN target = 'risk' THEN future_disengaged ELSE future_growth END) AS BIGINT) AS n_pos, {zero} AS n_bad
FROM sp, c WHERE split <> 'train' GROUP BY target, setup, model, split""",
        "m8_attribution_sums": f"WITH {split_ctes()}\nSELECT count(*) AS n, {zero} AS n_off FROM sp WHERE split = 'test'",
        "c2_calibration_properties": f"""WITH {split_ctes()}
SELECT signal, count(*) AS n, {zero} AS n_bad, {zero} AS n_falls
FROM sp, (VALUES ('risk'), ('growth')) AS v(signal) WHERE split = 'test' GROUP BY signal""",
        "c3_brier_standin": rounded(f"""{base}
SELECT 'recency' AS signal, avg(power(score - label, 2)) AS brier_before,
  avg(power(score * score - label, 2)) AS brier_after,
  avg(power(score - label, 2)) - avg(power(score * score - label, 2)) AS improvement FROM sc""",
                                    ["brier_before", "brier_after", "improvement"]),
        "m4_class_weights": rounded(f"""WITH {split_ctes()},
tr AS (SELECT * FROM sp WHERE split = 'train'),
c AS (SELECT count(*) AS n, sum(future_disengaged) AS p FROM tr)
SELECT customer_id,
  CASE WHEN future_disengaged = 1 THEN n / (2e0 * p) ELSE n / (2e0 * (n - p)) END AS w_balanced,
  CASE WHEN future_disengaged = 1 THEN (CASE WHEN p > 0 THEN (n - p) / p ELSE 1e0 END) ELSE 1e0 END AS w_pos
FROM tr, c""", ["w_balanced", "w_pos"]),
        "c4_reliability_standin": rounded(f"""{base}
SELECT bin, avg(score) AS mean_predicted, avg(CAST(label AS DOUBLE)) AS fraction_positive, count(*) AS n
FROM (SELECT *, {' + '.join(f'CAST(score > {i * (1.0 / 10)!r}e0 AS INTEGER)' if 'e' not in repr(i * (1.0 / 10)) else f'CAST(score > {i * (1.0 / 10)!r} AS INTEGER)' for i in range(1, 10))} AS bin FROM sc) AS b
GROUP BY bin""", ["mean_predicted", "fraction_positive"]),
        "c5_score_summary_standin": rounded(f"{base}\nSELECT min(score) AS min, max(score) AS max, avg(score) AS mean FROM sc",
                                            ["min", "max", "mean"]),
    }


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(target_feature_sql())
    out.update(quality_split_sql())
    out.update(evaluation_sql())
    out.update(signal_sql())
    out.update(report_sql())
    out.update(model_sql())
    return out
