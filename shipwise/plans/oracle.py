"""DuckDB oracle SQL for the registered queries.

Each statement is self-contained over the pre-registered test tables. The
SQL states the semantics the plain way (global windows, self-joins,
per-round CTEs); the engine computes the same results with bucketed plans.
"""

from __future__ import annotations

import re
from decimal import Decimal

from .. import config as C
from .oracle_base import CLEANED, SHIPMENTS, dbl, with_ctes

#: Rounds stated in SQL; a round in which nothing fits changes nothing.
R_FILL = 8
SWITCH = Decimal(C.DISCOUNT_FLAT_COST) / Decimal(str(C.DISCOUNT_LOSS_REDUCTION))
R = C.DISCOUNT_LOSS_REDUCTION
KEEP = 1.0 - R


def r(x: str, d: int) -> str:
    """floor(x·10^d + 0.5) / 10^d on doubles (same as the engine)."""
    s = float(10 ** d)
    return f"(CAST(floor(CAST({x} AS DOUBLE) * {dbl(s)} + 0.5) AS DOUBLE) / {dbl(s)})"


def cents(x: str) -> str:
    return f"CAST(floor({x} * 100 + 0.5) AS BIGINT)"


def money(c: str) -> str:
    return f"(CAST({c} AS DOUBLE) / 100.0)"


DATES_AS_TEXT = ("CAST(order_date AS VARCHAR) AS order_date, "
                 "CAST(shipping_date AS VARCHAR) AS shipping_date")

SPLIT = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY late_delivery_risk
             ORDER BY md5('{C.SPLIT_SEED}|' || row_key), row_key) - 1 AS rnk
  FROM cleaned WHERE late_delivery_risk IS NOT NULL),
cls AS (SELECT late_delivery_risk AS c, count(*) AS m FROM cleaned
        WHERE late_delivery_risk IS NOT NULL GROUP BY 1),
tot AS (SELECT sum(m) AS n, (sum(m) * {C.TEST_FRACTION_NUM} + {C.TEST_FRACTION_DEN - 1})
               // {C.TEST_FRACTION_DEN} AS k FROM cls),
alloc0 AS (SELECT c, (k * m) // n AS base, (k * m) % n AS rem, k FROM cls, tot),
alloc AS (SELECT c, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, c)
                                 <= k - sum(base) OVER () THEN 1 ELSE 0 END AS kc FROM alloc0),
split AS (
  SELECT r.* EXCLUDE (rnk),
    CASE WHEN rnk < kc THEN 'test' ELSE 'train' END AS split,
    CASE WHEN rnk >= kc THEN CAST((rnk - kc) % {C.N_FOLDS} AS INTEGER) END AS fold
  FROM ranked r JOIN alloc a ON r.late_delivery_risk = a.c)"""

SCORED = f"""
train AS (SELECT * FROM split WHERE split = 'train'),
prior AS (SELECT avg(late_delivery_risk) AS p0 FROM train),
cells AS (
  SELECT shipping_mode AS cm, category_name AS cc,
    (CAST(sum(late_delivery_risk) AS DOUBLE) + {dbl(C.SCORER_PRIOR_WEIGHT)} * p0)
      / (CAST(count(*) AS DOUBLE) + {dbl(C.SCORER_PRIOR_WEIGHT)}) AS cell_risk
  FROM train, prior GROUP BY shipping_mode, category_name, p0),
scored AS (
  SELECT t.*, COALESCE(c.cell_risk, p.p0) AS risk_score
  FROM split t
  LEFT JOIN cells c ON t.shipping_mode IS NOT DISTINCT FROM c.cm
                   AND t.category_name IS NOT DISTINCT FROM c.cc
  CROSS JOIN prior p
  WHERE t.split = 'test')"""

OPTIONS = f"""
options AS (
  SELECT *, order_country AS batch_id,
    CAST(CASE WHEN CAST(price AS DECIMAL(18,2)) < 0 THEN 0 ELSE CAST(price AS DECIMAL(18,2)) END
         * {C.UPGRADE_COST_RATE} AS DECIMAL(20,4)) AS upgrade_cost,
    CAST({C.DISCOUNT_FLAT_COST} AS DECIMAL(20,4)) AS discount_cost,
    abs(profit) AS value_at_risk,
    risk_score * abs(profit) AS base_expected_loss
  FROM scored),
budgets AS (
  SELECT batch_id, CAST(floor(sum(upgrade_cost) * {C.BUDGET_SHARE}) AS DECIMAL(20,4)) AS budget
  FROM options GROUP BY batch_id)"""

SAMPLE_OPTIONS = f"""
sampled AS (
  SELECT * FROM scored
  ORDER BY md5('{C.DEFAULT_SAMPLE_SEED}|' || row_key), row_key LIMIT {C.DEFAULT_BATCH_ORDERS}),
options AS (
  SELECT *, 'sample' AS batch_id,
    CAST(CASE WHEN CAST(price AS DECIMAL(18,2)) < 0 THEN 0 ELSE CAST(price AS DECIMAL(18,2)) END
         * {C.UPGRADE_COST_RATE} AS DECIMAL(20,4)) AS upgrade_cost,
    CAST({C.DISCOUNT_FLAT_COST} AS DECIMAL(20,4)) AS discount_cost,
    abs(profit) AS value_at_risk,
    risk_score * abs(profit) AS base_expected_loss
  FROM sampled),
budgets AS (SELECT 'sample' AS batch_id, CAST({C.DEFAULT_BUDGET} AS DECIMAL(20,4)) AS budget)"""


def allocation_ctes(two_option: bool = False, rounds: int = R_FILL,
                    capacity: bool = False) -> str:
    """The better, per batch, of a greedy pass and of the best single order
    followed by a greedy pass over the rest of its batch. With ``capacity`` a
    ``capacities(batch_id, max_upgrades)`` CTE must exist."""
    first = greedy_ctes(two_option, rounds, capacity)
    inputs = ["options", "budgets", "capacities", "report", "dec"]
    names = inputs + re.findall(r"^(\w+) AS (?:MATERIALIZED )?\(", first, re.M)

    def tagged(sql: str, tag: str, names=names) -> str:
        return re.sub(r"\b(" + "|".join(sorted(set(names), key=len, reverse=True)) + r")\b",
                      lambda m: m.group(1) + tag, sql)

    own = [n for n in names if n not in inputs[:3]]
    slots = ("LEFT JOIN capacities c ON c.batch_id = o.batch_id", "COALESCE(c.max_upgrades, 1) > 0") \
        if capacity else ("", "TRUE")
    disc = "" if two_option else f"""
  UNION ALL
  SELECT o.batch_id, row_key, 'discount', discount_cost, base_expected_loss * {dbl(R)}
  FROM options o JOIN budgets b USING (batch_id)
  WHERE base_expected_loss > 0 AND discount_cost <= b.budget"""
    pick = f"""
singles AS (
  SELECT o.batch_id, row_key, 'upgrade' AS act, upgrade_cost AS cost, base_expected_loss AS saving
  FROM options o JOIN budgets b USING (batch_id) {slots[0]}
  WHERE base_expected_loss > 0 AND upgrade_cost <= b.budget AND {slots[1]}{disc}),
pick AS (
  SELECT s.* FROM singles s JOIN report_1 r USING (batch_id)
  WHERE s.saving > r.saving * (1.0 + 1e-9)
  QUALIFY row_number() OVER (PARTITION BY s.batch_id ORDER BY s.saving DESC, row_key DESC) = 1),
options_2 AS (
  SELECT o.* FROM options o JOIN pick p ON o.batch_id = p.batch_id AND o.row_key <> p.row_key),
budgets_2 AS (
  SELECT batch_id, CAST(b.budget - p.cost AS DECIMAL(20,4)) AS budget
  FROM budgets b JOIN pick p USING (batch_id))"""
    if capacity:
        pick += """,
capacities_2 AS (
  SELECT batch_id, c.max_upgrades - CASE p.act WHEN 'upgrade' THEN 1 ELSE 0 END AS max_upgrades
  FROM capacities c JOIN pick p USING (batch_id))"""
    last = f"""
report AS (
  SELECT batch_id, budget, lp_bound, saving, gap FROM report_1
  WHERE batch_id NOT IN (SELECT batch_id FROM pick)
  UNION ALL
  SELECT p.batch_id, r.budget, r.lp_bound, p.saving + COALESCE(q.saving, 0.0),
         r.lp_bound - (p.saving + COALESCE(q.saving, 0.0))
  FROM pick p JOIN report_1 r USING (batch_id) LEFT JOIN report_2 q USING (batch_id)),
dec AS (
  SELECT * FROM dec_1 WHERE batch_id NOT IN (SELECT batch_id FROM pick)
  UNION ALL
  SELECT * FROM dec_2
  UNION ALL
  SELECT o.*, p.act, p.cost,
    CASE p.act WHEN 'upgrade' THEN 0.0 ELSE o.base_expected_loss * {dbl(KEEP)} END
  FROM options o JOIN pick p ON o.batch_id = p.batch_id AND o.row_key = p.row_key)"""
    return ",\n".join(x.strip() for x in
                      (tagged(first, "_1", own), pick, tagged(first, "_2"), last))


def greedy_ctes(two_option: bool, rounds: int, capacity: bool) -> str:
    """Greedy prefix, fill rounds and vouchers for idle orders, with plain
    per-batch windows; under ``capacity`` the count of upgrades is a second
    running-sum limit. Leaves ``report`` and ``dec``."""
    two = "FALSE" if two_option else f"(u > CAST({SWITCH} AS DECIMAL(20,4)) OR u > budget)"
    vouchers = not two_option
    cumu = ("sum(du) OVER (PARTITION BY {t}batch_id ORDER BY pos "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumu")
    parts = [f"""
ord_in AS (
  SELECT o.batch_id, row_key, upgrade_cost AS u, discount_cost AS d, base_expected_loss AS L,
         b.budget AS lim_b, {two} AS two
  FROM options o JOIN budgets b USING (batch_id) WHERE base_expected_loss > 0),
steps0 AS (
  SELECT batch_id, row_key, 1 AS step,
    CASE WHEN two THEN 'discount' ELSE 'upgrade' END AS act,
    CASE WHEN two THEN d ELSE u END AS dc,
    CASE WHEN two THEN L * {dbl(R)} ELSE L END AS ds,
    CASE WHEN two THEN 0 ELSE 1 END AS du
  FROM ord_in WHERE CASE WHEN two THEN d ELSE u END <= lim_b
  UNION ALL
  SELECT batch_id, row_key, 2, 'upgrade', CAST(u - d AS DECIMAL(20,4)), L * {dbl(KEEP)}, 1
  FROM ord_in WHERE two AND u <= lim_b AND d <= lim_b),
steps1 AS (
  SELECT *, CASE WHEN dc > 0 THEN 1 ELSE 0 END AS paid,
    CASE WHEN dc > 0 THEN -(ds / CAST(dc AS DOUBLE)) ELSE 0.0 END AS neg_eff
  FROM steps0),
pos AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY paid, neg_eff, row_key, step) AS pos
  FROM steps1),
st AS (
  SELECT a.batch_id, a.row_key, a.step, a.act, a.dc, a.ds, a.du, a.pos,
         b.pos AS prev_pos, b.dc AS prev_dc, b.du AS prev_du
  FROM pos a LEFT JOIN pos b
    ON a.step = 2 AND b.step = 1 AND a.row_key = b.row_key AND a.batch_id = b.batch_id),
lim AS (
  SELECT b.batch_id, b.budget, {"COALESCE(c.max_upgrades, " + str(2 ** 62) + ")" if capacity
                                else str(2 ** 62)} AS capu
  FROM budgets b {"LEFT JOIN capacities c USING (batch_id)" if capacity else ""}),
r0 AS (
  SELECT st.*, b.budget, b.capu,
    sum(dc) OVER (PARTITION BY st.batch_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
    {cumu.format(t="st.")}
  FROM st JOIN lim b USING (batch_id)),
s0 AS (SELECT batch_id, row_key, step, act, dc, ds, du, pos, prev_pos, prev_dc, prev_du,
              cum <= budget AND cumu <= capu AS taken FROM r0),
g0 AS (SELECT batch_id, sum(CASE WHEN taken THEN dc END) AS spent,
              sum(CASE WHEN taken THEN ds END) AS saved,
              sum(CASE WHEN taken THEN du END) AS used
       FROM s0 GROUP BY batch_id),
lp0 AS (SELECT batch_id, budget, cum <= budget AS taken, dc, ds, pos FROM r0),
lg0 AS (SELECT batch_id, sum(CASE WHEN taken THEN dc END) AS spent,
               sum(CASE WHEN taken THEN ds END) AS saved,
               min(CASE WHEN NOT taken THEN pos END) AS bpos
        FROM lp0 GROUP BY batch_id),
b0 AS (SELECT l.batch_id, l.dc AS bdc, l.ds AS bds FROM lp0 l JOIN lg0 g
       ON l.batch_id = g.batch_id AND l.pos = g.bpos),
p0 AS (
  SELECT b.batch_id, b.budget,
    COALESCE(g.spent, CAST(0 AS DECIMAL(20,4))) AS spent0, COALESCE(g.saved, 0.0) AS saved0,
    COALESCE(lg.saved, 0.0) AS lp_saved,
    b.budget - COALESCE(lg.spent, CAST(0 AS DECIMAL(20,4))) AS lp_rem,
    bb.bdc AS bdc0, bb.bds AS bds0,
    b.budget - COALESCE(g.spent, CAST(0 AS DECIMAL(20,4))) AS rem1,
    b.capu - COALESCE(g.used, 0) AS remu1
  FROM lim b LEFT JOIN g0 g USING (batch_id) LEFT JOIN lg0 lg USING (batch_id)
  LEFT JOIN b0 bb USING (batch_id))"""]
    for k in range(1, rounds + 1):
        parts.append(f"""
c{k} AS (
  SELECT s.*, p.taken AS ptaken, q.rem{k} AS cap, q.remu{k} AS capu
  FROM s{k - 1} s JOIN p{k - 1} q USING (batch_id)
  LEFT JOIN s{k - 1} p ON s.batch_id = p.batch_id AND s.prev_pos = p.pos),
k{k} AS (
  SELECT batch_id, pos, dc, ds, du, cap, capu,
    sum(dc) OVER (PARTITION BY batch_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
    {cumu.format(t="")}
  FROM c{k}
  WHERE NOT taken AND dc <= cap AND du <= capu
    AND (prev_pos IS NULL OR ptaken OR (prev_dc <= cap AND prev_du <= capu))),
t{k} AS (SELECT batch_id, pos, dc, ds, du, cum <= cap AND cumu <= capu AS tk FROM k{k}),
g{k} AS (SELECT batch_id, sum(CASE WHEN tk THEN dc END) AS spent,
               sum(CASE WHEN tk THEN ds END) AS saved,
               sum(CASE WHEN tk THEN du END) AS used FROM t{k} GROUP BY batch_id),
p{k} AS (
  SELECT q.*, COALESCE(g.spent, CAST(0 AS DECIMAL(20,4))) AS spent{k},
    COALESCE(g.saved, 0.0) AS saved{k},
    q.rem{k} - COALESCE(g.spent, CAST(0 AS DECIMAL(20,4))) AS rem{k + 1},
    q.remu{k} - COALESCE(g.used, 0) AS remu{k + 1}
  FROM p{k - 1} q LEFT JOIN g{k} g USING (batch_id)),
s{k} AS (
  SELECT s.* REPLACE (s.taken OR COALESCE(t.tk, FALSE) AS taken)
  FROM s{k - 1} s LEFT JOIN t{k} t ON s.batch_id = t.batch_id AND s.pos = t.pos)""")
    saved = " + ".join(["0.0"] + [f"saved{k}" for k in range(rounds + 1)])
    spent = " + ".join([f"spent{k}" for k in range(rounds + 1)])
    lp = "(lp_saved + COALESCE(bds0 * (CAST(lp_rem AS DOUBLE) / CAST(bdc0 AS DOUBLE)), 0.0))"
    parts.append(f"""
report{"0" if vouchers else ""} AS (
  SELECT batch_id, budget, {lp} AS lp_bound, ({saved}) AS saving,
         {lp} - ({saved}) AS gap, ({spent}) AS spent
  FROM p{rounds}),
decisions AS (
  SELECT o.*,
    CASE WHEN t2.taken THEN 'upgrade' WHEN t1.taken THEN t1.act ELSE 'nothing' END AS decision
  FROM options o
  LEFT JOIN s{rounds} t1 ON t1.batch_id = o.batch_id AND t1.row_key = o.row_key AND t1.step = 1
  LEFT JOIN s{rounds} t2 ON t2.batch_id = o.batch_id AND t2.row_key = o.row_key AND t2.step = 2),
dec{"0" if vouchers else ""} AS (
  SELECT *,
    CASE decision WHEN 'upgrade' THEN upgrade_cost WHEN 'discount' THEN discount_cost
         ELSE CAST(0 AS DECIMAL(20,4)) END AS cost,
    CASE decision WHEN 'upgrade' THEN 0.0
         WHEN 'discount' THEN base_expected_loss * {dbl(KEEP)}
         ELSE base_expected_loss END AS expected_loss_after
  FROM decisions)""")
    if vouchers:  # second pass: idle orders get a voucher within the budget left
        parts.append(f"""
vin AS (
  SELECT batch_id, row_key, discount_cost AS dc, base_expected_loss * {dbl(R)} AS ds
  FROM dec0 WHERE decision = 'nothing' AND base_expected_loss > 0),
vrk AS (
  SELECT v.*, rp.budget - rp.spent AS rem,
    sum(dc) OVER (PARTITION BY v.batch_id
                  ORDER BY CASE WHEN dc > 0 THEN 1 ELSE 0 END,
                           CASE WHEN dc > 0 THEN -(ds / CAST(dc AS DOUBLE)) ELSE 0.0 END, row_key
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM vin v JOIN report0 rp USING (batch_id)),
vt AS (SELECT batch_id, row_key, ds FROM vrk WHERE cum <= rem),
vg AS (SELECT batch_id, sum(ds) AS v_saved FROM vt GROUP BY batch_id),
report AS (
  SELECT r.batch_id, r.budget, r.lp_bound, r.saving + COALESCE(g.v_saved, 0.0) AS saving,
         r.lp_bound - (r.saving + COALESCE(g.v_saved, 0.0)) AS gap
  FROM report0 r LEFT JOIN vg g USING (batch_id)),
dec AS (
  SELECT d.* REPLACE (
    CASE WHEN t.row_key IS NOT NULL THEN 'discount' ELSE d.decision END AS decision,
    CASE WHEN t.row_key IS NOT NULL THEN d.discount_cost ELSE d.cost END AS cost,
    CASE WHEN t.row_key IS NOT NULL THEN d.base_expected_loss * {dbl(KEEP)}
         ELSE d.expected_loss_after END AS expected_loss_after)
  FROM dec0 d LEFT JOIN vt t ON d.batch_id = t.batch_id AND d.row_key = t.row_key)""")
    return ",\n".join(p.strip() for p in parts)


def optimum_ctes(two_option: bool = False) -> str:
    """After ``allocation_ctes``: the best saving per batch, by a recursion over the orders that have an
    option whose regret (at the break ratio) is below the gap; dominated states are dropped."""
    disc = "" if two_option else f"""
  UNION ALL
  SELECT o.batch_id, row_key, discount_cost, base_expected_loss * {dbl(R)}
  FROM options o JOIN budgets b USING (batch_id) WHERE base_expected_loss > 0 AND discount_cost <= b.budget"""
    by_worth = "OVER (PARTITION BY w.batch_id, row_key ORDER BY worth DESC, c)"
    return f"""
lam AS (
  SELECT r.batch_id, r.budget, r.saving, r.lp_bound, r.gap,
         COALESCE(b.bds / CAST(b.bdc AS DOUBLE), 0.0) AS lam
  FROM report r LEFT JOIN b0_1 b USING (batch_id)),
opt AS (
  SELECT batch_id, row_key, CAST(0 AS DECIMAL(20,4)) AS c, CAST(0 AS DOUBLE) AS s FROM options
  UNION ALL
  SELECT o.batch_id, row_key, upgrade_cost, base_expected_loss
  FROM options o JOIN budgets b USING (batch_id) WHERE base_expected_loss > 0 AND upgrade_cost <= b.budget{disc}),
w AS (SELECT opt.*, s - lam * CAST(c AS DOUBLE) AS worth, gap FROM opt JOIN lam USING (batch_id)),
rated AS (
  SELECT w.batch_id, row_key, row_number() {by_worth} AS k, c AS cost,
         c - first_value(c) {by_worth} AS dc, first_value(worth) {by_worth} - worth AS rg, gap
  FROM w),
near AS (SELECT * FROM rated WHERE k = 1 OR rg < gap),
core AS MATERIALIZED (
  SELECT batch_id, dense_rank() OVER (PARTITION BY batch_id ORDER BY row_key) AS i, dc, rg
  FROM (SELECT *, count(*) OVER (PARTITION BY batch_id, row_key) AS n FROM near) WHERE n > 1),
st AS (
  SELECT batch_id, CAST(0 AS BIGINT) AS i, CAST(sum(cost) AS DECIMAL(24,4)) AS cost, CAST(0 AS DOUBLE) AS rg
  FROM rated WHERE k = 1 GROUP BY batch_id
  UNION ALL
  SELECT batch_id, i, cost, rg FROM (
    SELECT s.batch_id, s.i + 1 AS i, CAST(s.cost + c.dc AS DECIMAL(24,4)) AS cost, s.rg + c.rg AS rg,
           l.lam * CAST(s.cost + c.dc AS DOUBLE) - (s.rg + c.rg) AS value
    FROM st s JOIN core c ON c.batch_id = s.batch_id AND c.i = s.i + 1 JOIN lam l ON l.batch_id = s.batch_id
    WHERE s.rg + c.rg <= l.gap + 1e-9)
  QUALIFY value > COALESCE(max(value) OVER (PARTITION BY batch_id ORDER BY cost, rg
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1e300)),
ends AS (SELECT batch_id, max(i) AS n FROM core GROUP BY batch_id),
optimum AS (
  SELECT l.batch_id, l.budget, l.lp_bound, l.saving AS greedy,
         greatest(l.saving, COALESCE(max(l.lp_bound - s.rg - l.lam * CAST(l.budget - s.cost AS DOUBLE)), CAST(0 AS DOUBLE))) AS best
  FROM lam l LEFT JOIN ends e USING (batch_id)
  LEFT JOIN st s ON s.batch_id = l.batch_id AND s.i = COALESCE(e.n, 0) AND s.cost <= l.budget
  GROUP BY l.batch_id, l.budget, l.lp_bound, l.saving)"""


RECORDS = f"""
rec AS (
  SELECT *,
    {cents('cost')} AS cost_c, {cents('base_expected_loss')} AS before_c,
    {cents('expected_loss_after')} AS after_c, {cents('upgrade_cost')} AS up_c,
    {cents('discount_cost')} AS disc_c, {cents(f'(base_expected_loss * {dbl(KEEP)})')} AS disc_loss_c
  FROM dec),
flat AS (
  SELECT row_key, batch_id, order_id,
    {r('risk_score', 4)} AS risk_score, {r('value_at_risk', 2)} AS value_at_risk,
    decision, {money('cost_c')} AS cost,
    {money('before_c')} AS expected_loss_before, {money('after_c')} AS expected_loss_after,
    {money('up_c')} AS upgrade_cost, 0.0 AS upgrade_loss_after,
    {money('disc_c')} AS discount_cost, {money('disc_loss_c')} AS discount_loss_after,
    0.0 AS nothing_cost, {money('before_c')} AS nothing_loss_after
  FROM rec)"""


def summary_select(with_report: bool) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE decision = '{o}') AS n_{o}" for o in C.OPTIONS)
    ncols = ", ".join(f"n_{o}" for o in C.OPTIONS)
    rep = ""
    rep_join = ""
    if with_report:
        rep = (f", {r('rp.lp_bound', 2)} AS lp_bound_saving, {r('rp.saving', 2)} AS achieved_saving,"
               f" {r('rp.gap', 2)} AS gap")
        rep_join = "LEFT JOIN report rp ON rp.batch_id = a.batch_id"
    return f"""
, agg AS (
  SELECT batch_id, count(*) AS batch_size, sum(cost_c) AS cost_c, sum(before_c) AS before_c,
         sum(after_c) AS after_c, sum(cost) AS cost_exact, {counts}
  FROM rec GROUP BY batch_id)
SELECT a.batch_id, a.batch_size, CAST(b.budget AS DOUBLE) AS budget,
  {money('a.cost_c')} AS total_cost, {money('a.before_c')} AS expected_loss_before,
  {money('a.after_c')} AS expected_loss_after,
  {r('CAST((a.before_c - a.after_c) * 100 AS DOUBLE) / NULLIF(CAST(a.before_c AS DOUBLE), 0)', 1)}
    AS loss_reduction_pct,
  {ncols}, CAST(a.cost_exact AS DOUBLE) AS total_cost_exact {rep}
FROM agg a LEFT JOIN budgets b ON a.batch_id = b.batch_id {rep_join}"""


def _base(*more: str) -> str:
    return with_ctes(SHIPMENTS, CLEANED, *more)


CAPACITIES = f"""
capacities AS (
  SELECT batch_id, CAST(count(*) * {C.UPGRADE_SLOTS_NUM} // {C.UPGRADE_SLOTS_DEN} AS BIGINT)
         AS max_upgrades
  FROM options GROUP BY batch_id)"""


def _prescribed(two_option=False, sample=False, capacity=False) -> str:
    opts = SAMPLE_OPTIONS if sample else OPTIONS
    extra = (CAPACITIES,) if capacity else ()
    return _base(SPLIT, SCORED, opts, *extra, allocation_ctes(two_option, capacity=capacity))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    S = with_ctes(SHIPMENTS)
    q["scan_shipments"] = S + f"SELECT * EXCLUDE (order_date, shipping_date), {DATES_AS_TEXT} FROM shipments"
    q["clean_shipments"] = _base() + f"SELECT * EXCLUDE (order_date, shipping_date), {DATES_AS_TEXT} FROM cleaned"
    cols = ["row_key", "order_id", "customer_id", "product_name", "customer_lname",
            "customer_zipcode", "order_zipcode", "product_description", "shipping_mode",
            "days_scheduled", "late_delivery_risk", "days_real", "delivery_status", "order_region",
            "order_country", "order_city", "category_name", "department_name",
            "customer_segment", "payment_type", "order_status", "order_date", "shipping_date",
            "price", "profit"]
    unions = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM shipments"
        for c in cols)
    q["audit_nulls"] = S + f"SELECT * FROM ({unions}) WHERE null_count > 0"
    types = " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, max(typeof({c})) AS duck_type, "
        f"count(*) - count({c}) AS null_count, count(*) AS n_rows FROM shipments" for i, c in enumerate(cols))
    q["column_types"] = S + f"""
, cols AS (
  SELECT * EXCLUDE (duck_type), CASE duck_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(duck_type) END AS data_type FROM ({types}))
SELECT position, column_name, data_type, null_count, n_rows, (SELECT count(*) FROM cols) AS n_columns,
  count(*) OVER (PARTITION BY data_type) AS columns_of_type
FROM cols"""
    q["target_share"] = S + f"""
, counts AS (SELECT late_delivery_risk, count(*) AS n FROM shipments
             WHERE late_delivery_risk IS NOT NULL GROUP BY 1)
SELECT late_delivery_risk, n, {r('n / (SELECT sum(n) FROM counts)', 6)} AS share FROM counts"""
    q["status_counts"] = S + """SELECT delivery_status, count(*) AS n FROM shipments
WHERE delivery_status IS NOT NULL GROUP BY 1"""
    q["column_redundancy"] = _base() + f"""
, pairs AS (SELECT shipping_mode, days_scheduled, count(*) AS n FROM cleaned
            WHERE shipping_mode IS NOT NULL GROUP BY 1, 2)
SELECT shipping_mode, count(*) AS n_values, sum(n) AS n_rows,
       {r('max(n) / sum(n)', 6)} AS top_share
FROM pairs GROUP BY shipping_mode"""

    def rate(key, top=None, by_key=False):
        order = f"ORDER BY {key}" if by_key else f"ORDER BY delay_rate DESC, {key}"
        lim = f" LIMIT {top}" if top else ""
        return _base() + f"""
SELECT {key}, {r('avg(late_delivery_risk)', 6)} AS delay_rate, count(*) AS n_orders
FROM cleaned WHERE {key} IS NOT NULL GROUP BY {key} {order}{lim}"""

    q["delay_rate_by_mode"] = rate("shipping_mode")
    q["delay_rate_by_region"] = rate("order_region", C.TOP_N_GROUPS)
    q["delay_rate_by_category"] = rate("category_name", C.TOP_N_GROUPS)
    q["delay_rate_by_scheduled"] = rate("days_scheduled", by_key=True)

    q["date_features"] = _base() + """
SELECT row_key, CAST(month(order_date) AS INTEGER) AS order_month,
  CAST(isodow(order_date) - 1 AS INTEGER) AS order_dayofweek,
  CAST(quarter(order_date) AS INTEGER) AS order_quarter,
  CAST(CASE WHEN isodow(order_date) - 1 IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS order_is_weekend
FROM cleaned"""
    cat_union = " UNION ".join(
        f"SELECT '{c}' AS column_name, COALESCE(CAST({c} AS VARCHAR), 'nan') AS value FROM {{src}}"
        for c in C.CATEGORICAL_COLS)
    dict_cte = lambda src, name: f""", {name} AS (
  SELECT column_name, value,
    CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code
  FROM ({cat_union.format(src=src)}))"""
    q["label_dictionary"] = _base() + dict_cte("cleaned", "dict") + " SELECT * FROM dict"

    def encoded(src, dname, cols, unseen=-1):
        joins = "\n".join(
            f"LEFT JOIN {dname} d_{c} ON d_{c}.column_name = '{c}' "
            f"AND d_{c}.value = COALESCE(CAST(t.{c} AS VARCHAR), 'nan')" for c in cols)
        repl = ", ".join(f"CAST(COALESCE(d_{c}.code, {unseen}) AS INTEGER) AS {c}" for c in cols)
        return f"SELECT t.* REPLACE ({repl}) FROM {src} t {joins}"

    fs_cte = f"""
, dated AS (
  SELECT * , CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(isodow(order_date) - 1 AS INTEGER) AS order_dayofweek,
    CAST(quarter(order_date) AS INTEGER) AS order_quarter,
    CAST(CASE WHEN isodow(order_date) - 1 IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS order_is_weekend
  FROM cleaned),
feat_in AS (
  SELECT * EXCLUDE (days_real, delivery_status, days_scheduled, order_id, customer_id,
                    product_name, customer_lname, customer_zipcode, order_date, shipping_date)
  FROM dated)""" + dict_cte("feat_in", "dict") + f""",
feature_set AS ({encoded('feat_in', 'dict', C.CATEGORICAL_COLS)})"""
    q["feature_set"] = _base() + fs_cte + " SELECT * FROM feature_set"
    q["encode_leftover"] = _base() + fs_cte + """
, dict2 AS (
  SELECT 'order_status' AS column_name, value,
    CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT COALESCE(CAST(order_status AS VARCHAR), 'nan') AS value FROM feature_set))
""" + encoded("feature_set", "dict2", ["order_status"])
    unseen_sum = ", ".join(f"count(*) FILTER (WHERE {c} = -1) AS {c}" for c in C.CATEGORICAL_COLS)
    q["encode_unseen"] = _base(SPLIT) + f"""
, tr AS (SELECT * FROM split WHERE split = 'train'),
te AS (SELECT * FROM split WHERE split = 'test')""" + dict_cte("tr", "dict") + f""",
enc AS ({encoded('te', 'dict', C.CATEGORICAL_COLS)}),
wide AS (SELECT count(*) AS n_rows, {unseen_sum} FROM enc)
SELECT column_name, CAST(n_unseen AS BIGINT) AS n_unseen, n_rows
FROM wide UNPIVOT (n_unseen FOR column_name IN ({", ".join(C.CATEGORICAL_COLS)}))"""

    q["stratified_split"] = _base(SPLIT) + "SELECT row_key, late_delivery_risk, split, fold FROM split"
    q["split_balance"] = _base(SPLIT) + f"""
, counts AS (SELECT late_delivery_risk, count(*) AS n FROM split
             WHERE split = 'train' AND late_delivery_risk IS NOT NULL GROUP BY 1)
SELECT late_delivery_risk, n, {r('n / (SELECT sum(n) FROM counts)', 6)} AS share FROM counts"""
    q["stratified_folds"] = _base(SPLIT) + """
SELECT fold, late_delivery_risk, count(*) AS n FROM split WHERE split = 'train' GROUP BY 1, 2"""
    q["sample_batch"] = _base(SPLIT) + f"""
SELECT row_key, order_id, shipping_mode, price, profit FROM split WHERE split = 'test'
ORDER BY md5('{C.DEFAULT_SAMPLE_SEED}|' || row_key), row_key LIMIT {C.DEFAULT_BATCH_ORDERS}"""

    SC = _base(SPLIT, SCORED)
    q["cell_scores"] = SC + f"SELECT row_key, late_delivery_risk, {r('risk_score', 6)} AS risk_score FROM scored"
    counts = """
, pred AS (SELECT *, CAST(risk_score > 0.5 AS INTEGER) AS prediction FROM scored),
cc AS (SELECT count(*) FILTER (WHERE late_delivery_risk = 1 AND prediction = 1) AS tp,
              count(*) FILTER (WHERE late_delivery_risk = 0 AND prediction = 1) AS fp,
              count(*) FILTER (WHERE late_delivery_risk = 0 AND prediction = 0) AS tn,
              count(*) FILTER (WHERE late_delivery_risk = 1 AND prediction = 0) AS fn FROM pred)"""
    q["metrics_accuracy_f1"] = SC + counts + f"""
SELECT {r('CAST(tp + tn AS DOUBLE) / CAST(tp + fp + tn + fn AS DOUBLE)', 6)} AS accuracy,
  {r('COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0)', 6)} AS f1,
  CAST(tp + fp + tn + fn AS BIGINT) AS n FROM cc"""
    q["confusion_matrix"] = SC + counts + """
SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cc UNION ALL
SELECT 0, 1, fp FROM cc UNION ALL SELECT 1, 0, fn FROM cc UNION ALL SELECT 1, 1, tp FROM cc"""

    def ratio(a, b):
        return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"

    q["classification_report"] = SC + counts + f"""
, m AS (SELECT {ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0,
              {ratio('2 * tn', '2 * tn + fn + fp')} AS f0, tn + fp AS s0,
              {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1,
              {ratio('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS s1,
              {ratio('tp + tn', 'tp + tn + fp + fn')} AS acc, tp + tn + fp + fn AS n FROM cc),
w AS (SELECT *, {ratio('s0', 'n')} AS w0, {ratio('s1', 'n')} AS w1 FROM m)
SELECT '0' AS label, {r('p0', 6)} AS precision, {r('r0', 6)} AS recall, {r('f0', 6)} AS f1_score,
       CAST(s0 AS BIGINT) AS support FROM w UNION ALL
SELECT '1', {r('p1', 6)}, {r('r1', 6)}, {r('f1', 6)}, CAST(s1 AS BIGINT) FROM w UNION ALL
SELECT 'accuracy', {r('acc', 6)}, {r('acc', 6)}, {r('acc', 6)}, CAST(n AS BIGINT) FROM w UNION ALL
SELECT 'macro avg', {r('(p0 + p1) / 2.0', 6)}, {r('(r0 + r1) / 2.0', 6)}, {r('(f0 + f1) / 2.0', 6)},
       CAST(n AS BIGINT) FROM w UNION ALL
SELECT 'weighted avg', {r('p0 * w0 + p1 * w1', 6)}, {r('r0 * w0 + r1 * w1', 6)},
       {r('f0 * w0 + f1 * w1', 6)}, CAST(n AS BIGINT) FROM w"""
    q["metrics_auc"] = SC + f"""
, g AS (SELECT risk_score, sum(late_delivery_risk) AS pos,
               count(*) FILTER (WHERE late_delivery_risk = 0) AS neg FROM scored GROUP BY 1),
b AS (SELECT *, COALESCE(sum(neg) OVER (ORDER BY risk_score
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM g),
a AS (SELECT sum(pos * neg_below) AS aa, sum(pos * neg) AS tt, sum(pos) AS n_pos,
             sum(neg) AS n_neg FROM b)
SELECT {r('CAST(2 * aa + tt AS DOUBLE) / (2.0 * CAST(n_pos AS DOUBLE) * CAST(n_neg AS DOUBLE))', 6)}
       AS roc_auc, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg FROM a"""

    saved = [*C.CATEGORICAL_COLS, "order_status"]
    union = " UNION ".join(f"SELECT '{c}' AS column_name, COALESCE(CAST({c} AS VARCHAR), 'nan') AS value "
                           "FROM split WHERE split = 'train'" for c in saved)
    joins = "\n".join(f"LEFT JOIN dict d_{c} ON d_{c}.column_name = '{c}' AND d_{c}.value = COALESCE(CAST(t.{c} AS VARCHAR), 'nan')"
                      for c in saved)
    codes = ", ".join(f"COALESCE(d_{c}.code, -1) AS {c}" for c in saved)
    q["encode_saved"] = _base(SPLIT) + f"""
, dict AS (
  SELECT column_name, value,
    CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code
  FROM ({union}))
SELECT t.row_key, {codes}, CAST(month(order_date) AS INTEGER) AS order_month,
  CAST(isodow(order_date) - 1 AS INTEGER) AS order_dayofweek,
  CAST(quarter(order_date) AS INTEGER) AS order_quarter,
  CAST(CASE WHEN isodow(order_date) - 1 IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS order_is_weekend
FROM split t {joins} WHERE t.split = 'test'"""

    OP = _base(SPLIT, SCORED, OPTIONS)
    q["option_costs"] = OP + f"""
SELECT row_key, batch_id, {r('risk_score', 6)} AS risk_score,
  CAST(upgrade_cost AS DOUBLE) AS upgrade_cost, CAST(discount_cost AS DOUBLE) AS discount_cost,
  {r('value_at_risk', 6)} AS value_at_risk, {r('base_expected_loss', 6)} AS base_expected_loss
FROM options"""
    q["batch_budgets"] = OP + "SELECT batch_id, CAST(budget AS DOUBLE) AS budget FROM budgets"

    TWO = _prescribed(two_option=True)
    q["rejected_orders"] = _base(SPLIT, SCORED, OPTIONS) + """
SELECT batch_id, count(*) AS n_orders,
  count(*) FILTER (WHERE upgrade_cost IS NULL OR base_expected_loss IS NULL
                   OR isnan(base_expected_loss)) AS n_rejected
FROM options GROUP BY batch_id"""
    q["allocate_two_option"] = TWO + """
SELECT row_key, batch_id, CAST(decision = 'upgrade' AS INTEGER) AS upgrade_decision,
       CAST(cost AS DOUBLE) AS cost FROM dec"""
    q["upgrade_summary"] = TWO + ", " + RECORDS.strip() + f"""
, agg AS (SELECT batch_id, sum(cost_c) AS cost_c, sum(before_c) AS before_c, sum(after_c) AS after_c,
                 count(*) FILTER (WHERE decision = 'upgrade') AS n_upgraded FROM rec GROUP BY 1)
SELECT a.batch_id, CAST(b.budget AS DOUBLE) AS budget, {money('cost_c')} AS spent,
  {money('before_c')} AS loss_before, {money('after_c')} AS loss_after, n_upgraded,
  {r('CAST((before_c - after_c) * 100 AS DOUBLE) / NULLIF(CAST(before_c AS DOUBLE), 0)', 1)}
    AS loss_reduction_pct
FROM agg a LEFT JOIN budgets b ON a.batch_id = b.batch_id"""

    MULTI = _prescribed()
    LOSS = "CAST(sum(CAST({} AS DECIMAL(28,10))) AS DOUBLE)"
    q["allocate_multi_option"] = MULTI + f"""
SELECT row_key, batch_id, decision, CAST(cost AS DOUBLE) AS cost,
       {r('expected_loss_after', 6)} AS expected_loss_after FROM dec"""
    q["multi_option_summary"] = MULTI + f"""
SELECT batch_id,
  CAST(sum(CASE WHEN decision = 'upgrade' THEN cost END) AS DOUBLE) AS upgrade_spend,
  CAST(sum(CASE WHEN decision = 'discount' THEN cost END) AS DOUBLE) AS discount_spend,
  CAST(sum(cost) AS DOUBLE) AS total_cost,
  {r(LOSS.format('base_expected_loss'), 2)} AS loss_before, {r(LOSS.format('expected_loss_after'), 2)} AS loss_after,
  {r(f"({LOSS.format('base_expected_loss')} - {LOSS.format('expected_loss_after')}) * 100.0 / NULLIF({LOSS.format('base_expected_loss')}, 0)", 1)}
    AS loss_reduction_pct
FROM dec GROUP BY batch_id"""
    CAP = _prescribed(capacity=True)
    q["allocate_with_capacity"] = CAP + f"""
SELECT row_key, batch_id, decision, CAST(cost AS DOUBLE) AS cost,
       {r('expected_loss_after', 6)} AS expected_loss_after FROM dec"""
    q["capacity_summary"] = CAP + ", " + RECORDS.strip() + summary_select(True).replace(
        "FROM agg a LEFT JOIN budgets b ON a.batch_id = b.batch_id",
        ", c.max_upgrades FROM agg a LEFT JOIN budgets b ON a.batch_id = b.batch_id "
        "LEFT JOIN capacities c ON c.batch_id = a.batch_id")
    for name, base, two in (("optimal_choice", MULTI, False), ("optimal_two_option", TWO, True),
                            ("optimal_sample_batch", _prescribed(sample=True), False)):
        q[name] = base.replace("WITH ", "WITH RECURSIVE ", 1) + "," + optimum_ctes(two) + f"""
SELECT batch_id, CAST(budget AS DOUBLE) AS budget, {r('lp_bound', 4)} AS lp_bound,
  {r('greedy', 4)} AS greedy_saving, {r('best', 4)} AS best_saving, TRUE AS optimal, TRUE AS within_budget
FROM optimum"""
    REC = MULTI + ", " + RECORDS.strip()
    q["prescription_records"] = REC + " SELECT * FROM flat"
    q["prescription_summary"] = REC + summary_select(True)
    SREC = _prescribed(sample=True) + ", " + RECORDS.strip()
    q["prescribe_end_to_end"] = SREC + summary_select(True)
    q["sample_batch_records"] = SREC + " SELECT * FROM flat"
    q["top_risk_decisions"] = REC + """
SELECT row_key, risk_score, value_at_risk, upgrade_cost, discount_cost, decision FROM flat
ORDER BY risk_score DESC, row_key LIMIT """ + str(C.TOP_N_ORDERS)
    q["decision_counts"] = MULTI + " SELECT decision, count(*) AS n FROM dec GROUP BY decision"
    labels = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.DECISION_LABELS.items())
    q["board_view"] = REC + f"""
SELECT row_key, batch_id,
  CASE WHEN length(CAST(order_id AS VARCHAR)) < {C.ORDER_LABEL_WIDTH}
       THEN lpad(CAST(order_id AS VARCHAR), {C.ORDER_LABEL_WIDTH}, '0')
       ELSE CAST(order_id AS VARCHAR) END AS order_label,
  CAST(floor(risk_score * 100.0 + 0.5) AS BIGINT) AS risk_pct,
  CASE WHEN risk_score > {C.RISK_BAND_HIGH} THEN 'high'
       WHEN risk_score > {C.RISK_BAND_MEDIUM} THEN 'medium' ELSE 'low' END AS risk_band,
  decision, CASE decision {labels} END AS decision_label, value_at_risk, cost
FROM flat"""
    q["board_money"] = REC + """
SELECT row_key, batch_id, printf('%.2f', value_at_risk) AS value_text, printf('%.2f', cost) AS cost_text,
  printf('%.2f', expected_loss_after) AS loss_text,
  CAST(CAST(floor(cost + 0.5) AS BIGINT) AS VARCHAR) AS cost_whole_text
FROM flat"""
    q["board_filtered"] = REC + """
SELECT row_key, batch_id, risk_score, decision, cost FROM flat WHERE decision = 'discount'"""
    all_labels = {**C.DECISION_LABELS, "all": "All"}
    q["board_counts"] = REC + " " + " UNION ALL ".join(
        [f"SELECT 'all' AS filter, '{all_labels['all']}' AS filter_label, count(*) AS n FROM flat"]
        + [f"SELECT '{o}', '{all_labels[o]}', count(*) FILTER (WHERE decision = '{o}') FROM flat"
           for o in C.OPTIONS])
    q["budget_usage"] = REC + summary_select(False).replace(
        "SELECT a.batch_id, a.batch_size", ", summ AS (SELECT a.batch_id, a.batch_size", 1) + f""")
SELECT batch_id, total_cost, budget,
  {r('100.0 * (total_cost / NULLIF(budget, 0))', 6)} AS budget_used_pct,
  {r('least(100.0, 100.0 * (total_cost / NULLIF(budget, 0)))', 6)} AS budget_bar_pct
FROM summ"""
    ledger = " UNION ALL ".join(
        f"SELECT row_key, batch_id, '{o}' AS option, '{C.OPTION_LABELS[o]}' AS option_label, "
        f"{o}_cost AS option_cost, {o}_loss_after AS option_loss_after, "
        f"decision = '{o}' AS chosen FROM flat" for o in C.OPTIONS)
    q["option_ledger"] = REC + " " + ledger
    q["closed_loop_calibration"] = MULTI + f"""
, cl AS (
  SELECT decision, CAST(least(9, floor(risk_score * 10.0)) AS INTEGER) AS risk_decile,
    risk_score, CAST(late_delivery_risk AS DOUBLE) AS late,
    {cents('expected_loss_after')} AS exp_c,
    {cents(f"CASE decision WHEN 'upgrade' THEN 0.0 WHEN 'discount' THEN value_at_risk * CAST(late_delivery_risk AS DOUBLE) * {dbl(KEEP)} ELSE value_at_risk * CAST(late_delivery_risk AS DOUBLE) END")} AS real_c,
    (risk_score - CAST(late_delivery_risk AS DOUBLE)) * (risk_score - CAST(late_delivery_risk AS DOUBLE)) AS sq
  FROM dec)
SELECT decision, risk_decile, count(*) AS n_orders,
  {r('avg(risk_score)', 6)} AS mean_predicted_risk, {r('avg(late)', 6)} AS observed_late_rate,
  {money('sum(exp_c)')} AS expected_loss_after, {money('sum(real_c)')} AS realised_loss_after,
  {r('avg(sq)', 6)} AS brier_score
FROM cl GROUP BY decision, risk_decile"""
    q["closed_loop_by_key"] = MULTI + f"""
, cl AS (
  SELECT decision, CAST(least(9, floor(risk_score * 10.0)) AS INTEGER) AS risk_decile,
    risk_score, CAST(o.late AS DOUBLE) AS late, {cents('expected_loss_after')} AS exp_c,
    {cents(f"CASE decision WHEN 'upgrade' THEN 0.0 WHEN 'discount' THEN value_at_risk * CAST(o.late AS DOUBLE) * {dbl(KEEP)} ELSE value_at_risk * CAST(o.late AS DOUBLE) END")} AS real_c,
    (risk_score - CAST(o.late AS DOUBLE)) * (risk_score - CAST(o.late AS DOUBLE)) AS sq
  FROM dec LEFT JOIN (SELECT row_key, late_delivery_risk AS late FROM shipments
                      WHERE delivery_status IS NOT NULL) o USING (row_key))
SELECT decision, risk_decile, count(late) AS n_orders, count(*) - count(late) AS n_open,
  {r('avg(risk_score) FILTER (WHERE late IS NOT NULL)', 6)} AS mean_predicted_risk,
  {r('avg(late)', 6)} AS observed_late_rate,
  {money('sum(exp_c) FILTER (WHERE late IS NOT NULL)')} AS expected_loss_after,
  {money('sum(real_c) FILTER (WHERE late IS NOT NULL)')} AS realised_loss_after,
  {r('avg(sq)', 6)} AS brier_score
FROM cl GROUP BY decision, risk_decile"""
    q["csv_shipments"] = q["scan_shipments"]
    q["csv_quarantine"] = S + """
, marked AS (SELECT order_id % 50 = 7 AS price, order_id % 40 = 3 AS order_date FROM shipments)
, reasons AS (
  SELECT 'price' AS reason, count(*) FILTER (WHERE price) AS n FROM marked
  UNION ALL SELECT 'order_date', count(*) FILTER (WHERE order_date) FROM marked)
SELECT reason, n FROM reasons WHERE n > 0
UNION ALL SELECT '(accepted)', count(*) FILTER (WHERE NOT (price OR order_date)) FROM marked
UNION ALL SELECT '(set aside)', count(*) FILTER (WHERE price OR order_date) FROM marked"""
    return q
