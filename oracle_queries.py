"""The queries of ``__spark_entry__`` as DuckDB SQL over the test tables.

Written from the business rules, with DuckDB's own means: ASOF joins, range joins of
months and whole-history windows, where the Spark side uses lookups and sums by day.
"""

from __future__ import annotations

import re

from ledgerline.plans.monthly import MONTHLY
from ledgerline.plans.transactions import FACT
from ledgerline.quality import suite
from ledgerline.quality.runner import Check
from ledgerline.sources.bridge import ID_DIGITS

_CLIENT = f"'C' || lpad(c::VARCHAR, {ID_DIGITS}, '0')"


def _id(number: str) -> str:
    return f"'T' || lpad(({number})::VARCHAR, {ID_DIGITS}, '0')"


CTES: dict[str, str] = {
    "ord": """
        SELECT o_orderkey AS k, o_custkey AS c, o_orderdate::DATE AS d,
               o_totalprice::DECIMAL(14,2) AS amt,
               CASE WHEN o_orderkey % 20 = 7 THEN 'fraud'
                    WHEN o_orderkey % 10 = 3 THEN 'chargeback' ELSE 'payment' END AS kind,
               list_extract(['GBP', 'USD', 'EUR'], (o_orderkey + o_custkey) % 3 + 1) AS cur
        FROM orders""",
    "tx_plain": f"""
        SELECT {_id('3*k')} AS tid, {_CLIENT} AS cid, amt, kind, d AS day, cur,
               NULL::VARCHAR AS link FROM ord
        UNION ALL
        SELECT {_id('3*k+1')}, {_CLIENT}, amt, 'refund', d + (k % 181)::INT, cur, {_id('3*k')}
        FROM ord WHERE kind = 'payment' AND k % 10 IN (4, 5)
        UNION ALL
        SELECT {_id('3*k+2')}, {_CLIENT}, amt, 'refund', d + (k % 181)::INT + 5, cur, {_id('3*k')}
        FROM ord WHERE kind = 'payment' AND k % 50 = 4""",
    "tx_broken": f"""
        WITH base AS (
            SELECT k, {_id('3*k')} AS tid,
                   CASE k % 997 WHEN 1 THEN 'X1' ELSE {_CLIENT} END AS cid,
                   CASE k % 997 WHEN 2 THEN 0 ELSE amt END::DECIMAL(14,2) AS amt,
                   CASE k % 997 WHEN 3 THEN 'unknown' ELSE kind END AS kind, d AS day,
                   CASE k % 997 WHEN 4 THEN 'JPY' ELSE cur END AS cur,
                   CASE k % 997 WHEN 5 THEN 'T-missing' END AS link
            FROM ord)
        SELECT * EXCLUDE (k) FROM base
        UNION ALL SELECT * EXCLUDE (k) FROM base WHERE k % 997 = 7
        UNION ALL SELECT * FROM tx_plain WHERE kind = 'refund'
        UNION ALL SELECT * FROM tx_plain WHERE kind = 'refund' AND tid IN (
            SELECT {_id('3*k+1')} FROM ord WHERE k % 7 = 3)""",
    "tx": """
        SELECT t.*, 0.2::DECIMAL(4,3) AS fee,
               CASE WHEN kind = 'refund' AND row_number() OVER (
                   PARTITION BY kind, link ORDER BY day NULLS FIRST, tid NULLS FIRST) > 1
               THEN 1 ELSE 0 END AS dup
        FROM {tx_source} t""",
    "res_plain": f"""
        SELECT {_id('3*k')} AS tid, CASE WHEN k % 30 = 3 THEN 'pending' ELSE 'resolved' END AS status,
               CASE WHEN k % 30 <> 3 THEN d + (k % 121)::INT END AS settled_on
        FROM ord WHERE k % 10 = 3""",
    "res_broken": f"""
        SELECT {_id('3*k')} AS tid, CASE WHEN k % 30 = 3 THEN 'pending' ELSE 'resolved' END AS status,
               CASE WHEN k % 30 <> 3 AND k % 990 <> 13 THEN d + (k % 121)::INT END AS settled_on
        FROM ord WHERE k % 10 = 3 OR k % 997 = 6""",
    "res": "SELECT * FROM {res_source}",
    "fx": """
        WITH days AS (SELECT DISTINCT d, d - DATE '1995-01-01' AS n FROM ord)
        SELECT 'GBP' AS cur, d AS from_day, 1::DECIMAL(8,4) AS rate FROM days
        UNION ALL
        SELECT 'USD', d, ((700 + n % 100)::DECIMAL(8,4) * 0.001)::DECIMAL(8,4) FROM days WHERE n % 4 < 3
        UNION ALL
        SELECT 'EUR', d, ((800 + n % 50)::DECIMAL(8,4) * 0.001)::DECIMAL(8,4) FROM days WHERE n % 4 < 3""",
    "deal": f"""
        SELECT 'C' || lpad(c_custkey::VARCHAR, {ID_DIGITS}, '0') AS cid,
               DATE '1996-01-01' + (c_custkey % 900)::INT AS starts,
               (6 + c_custkey % 30)::INT AS months,
               (199999 * (1 + c_custkey % 5))::DECIMAL(14,2) AS target,
               (0.1 + 0.01 * (c_custkey % 8))::DECIMAL(4,3) AS low_fee,
               (date_trunc('month', starts) + to_months(months)
                   + to_days((day(starts) - 1)::INT))::DATE AS ends
        FROM customer WHERE c_custkey % 4 = 0""",
    "rule": """
        SELECT * FROM (VALUES ('payment', 1, 1, 1, 0), ('refund', -1, 1, 1, 0),
                              ('chargeback', -1, 1, 1, 1), ('fraud', 1, 0, 0, 0))
               r(kind, sign, earns, spends, waits)""",
    "cls": """
        SELECT t.tid, t.cid, t.kind, t.cur, t.fee, t.amt, t.day, t.dup, t.link, r.sign,
               s.status, s.settled_on, p.day AS paid_on,
               (t.amt * r.sign)::DECIMAL(14,2) AS net,
               ifnull(s.settled_on, t.day) AS eff,
               CASE WHEN t.dup = 1 THEN 0 WHEN r.waits = 0 OR s.status = 'resolved' THEN r.earns
                    ELSE 0 * r.earns END AS booked,
               CASE WHEN t.dup = 1 THEN 0 WHEN r.waits = 0 OR s.status = 'resolved' THEN r.spends
                    ELSE 0 * r.spends END AS counted
        FROM tx t
        LEFT JOIN rule r USING (kind)
        LEFT JOIN res s ON s.tid = t.tid
        LEFT JOIN tx p ON p.tid = t.link""",
    "gbp": """
        SELECT a.*, round(a.amt * x.rate, 2)::DECIMAL(18,2) AS gross_gbp,
               round(a.net * x.rate, 2)::DECIMAL(18,2) AS net_gbp
        FROM cls a ASOF LEFT JOIN fx x ON a.cur = x.cur AND a.day >= x.from_day""",
    "spent": """
        WITH scoped AS (
            SELECT g.*, c.target, c.low_fee, c.starts <= g.day AND g.day < c.ends AS inside,
                   c.starts <= g.eff AND g.eff < c.ends AS takes_effect_inside,
                   g.paid_on IS NULL OR (c.starts <= g.paid_on AND g.paid_on < c.ends) AS reverses_inside
            FROM gbp g LEFT JOIN deal c ON c.cid = g.cid),
        added AS (
            SELECT *, (CASE WHEN inside IS NULL THEN NULL
                            WHEN inside AND takes_effect_inside AND reverses_inside AND counted = 1
                            THEN net_gbp ELSE 0 END)::DECIMAL(18,2) AS spend
            FROM scoped),
        summed AS (
            SELECT *, sum(spend) OVER (PARTITION BY cid ORDER BY eff, tid
                                       ROWS UNBOUNDED PRECEDING) AS running
            FROM added),
        latched AS (
            SELECT *, max((running >= target)::INT) OVER (PARTITION BY cid ORDER BY eff, tid
                                                     ROWS UNBOUNDED PRECEDING) AS reached
            FROM summed)
        SELECT * EXCLUDE (reached), CASE WHEN NOT inside THEN 0 WHEN inside THEN reached END AS earned
        FROM latched""",
    "own": """
        SELECT *, CASE WHEN inside AND earned = 1 THEN low_fee ELSE fee END AS own_fee FROM spent""",
    "rev": """
        SELECT o.*, CASE o.booked WHEN 1 THEN o.eff END AS booked_on,
               ifnull(p.own_fee, o.own_fee) AS used_fee,
               CASE o.booked WHEN 0 THEN 0 ELSE o.net_gbp * ifnull(p.own_fee, o.own_fee) END AS revenue
        FROM own o LEFT JOIN own p ON p.tid = o.link""",
    "span": """
        SELECT min(day) AS data_start_date, greatest(max(day), max(settled_on)) AS data_end_date FROM rev""",
    "cal": """
        SELECT unnest(generate_series(date_trunc('month', data_start_date)::DATE,
                                      last_day(data_end_date), INTERVAL 1 DAY))::DATE AS date_day,
               date_trunc('month', date_day)::DATE AS month_start_date,
               last_day(date_day) AS month_end_date
        FROM span""",
    "grid": """
        SELECT cid, month_start_date AS m, month_end_date AS m_end
        FROM (SELECT DISTINCT cid FROM rev),
             (SELECT DISTINCT month_start_date, month_end_date FROM cal) months,
             span
        WHERE month_end_date >= data_start_date AND month_start_date <= data_end_date""",
    "booked_m": """
        SELECT cid, date_trunc('month', booked_on)::DATE AS m,
               sum(if(sign = 1, gross_gbp, 0)) AS gross, sum(net_gbp) AS net,
               sum(revenue) AS revenue, count(*) AS n
        FROM rev WHERE booked = 1 GROUP BY ALL""",
    "made_m": """
        SELECT cid, date_trunc('month', day)::DATE AS m, sum(net_gbp) AS net, sum(revenue) AS revenue
        FROM rev WHERE booked = 1 GROUP BY ALL""",
    "open_m": """
        SELECT g.cid, g.m, sum(r.gross_gbp) AS open_gbp
        FROM grid g JOIN rev r ON r.cid = g.cid AND r.day <= g.m_end
        WHERE r.status IS NOT NULL AND (r.settled_on IS NULL OR r.settled_on > g.m_end)
        GROUP BY ALL""",
    "spend_m": """
        SELECT cid, date_trunc('month', eff)::DATE AS m, sum(spend) AS spend
        FROM rev WHERE spend IS NOT NULL GROUP BY ALL""",
    "earned_c": "SELECT cid, min(eff) AS earned_on FROM rev WHERE earned = 1 GROUP BY cid",
    "mart": """
        WITH joined AS (
            SELECT g.*, b.gross, b.net, b.revenue, b.n, a.net AS made_net, a.revenue AS made_revenue,
                   o.open_gbp, c.starts, c.ends, c.target, e.earned_on,
                   CASE WHEN c.cid IS NOT NULL THEN ifnull(s.spend, 0) END AS spend
            FROM grid g
            LEFT JOIN booked_m b USING (cid, m) LEFT JOIN made_m a USING (cid, m)
            LEFT JOIN open_m o USING (cid, m) LEFT JOIN spend_m s USING (cid, m)
            LEFT JOIN deal c USING (cid) LEFT JOIN earned_c e USING (cid)),
        summed AS (
            SELECT *, sum(spend) OVER (PARTITION BY cid ORDER BY m ROWS UNBOUNDED PRECEDING) AS to_date
            FROM joined)
        SELECT cid || '-' || m::VARCHAR AS client_month_id, cid AS client_id, m AS month_start_date,
               m_end AS month_end_date, (m_end > data_end_date)::INT AS is_partial_month,
               ifnull(gross, 0)::DOUBLE AS recognised_gross_gmv_gbp,
               ifnull(net, 0)::DOUBLE AS recognised_net_gmv_gbp,
               ifnull(revenue, 0)::DOUBLE AS recognised_revenue_gbp,
               ifnull(n, 0) AS recognised_transaction_count,
               ifnull(made_net, 0)::DOUBLE AS originated_net_gmv_gbp,
               ifnull(made_revenue, 0)::DOUBLE AS originated_revenue_gbp,
               ifnull(open_gbp, 0)::DOUBLE AS pending_chargebacks_gbp,
               CASE WHEN starts IS NULL THEN 'no contract' WHEN starts > m_end THEN 'not started'
                    WHEN ends <= m_end THEN 'ended' ELSE 'active' END AS contract_status,
               target::DOUBLE AS spend_threshold, spend::DOUBLE AS monthly_contract_spend_gbp,
               to_date::DOUBLE AS cumulative_contract_spend_gbp,
               round(to_date::DOUBLE / target::DOUBLE, 4) AS pct_of_spend_threshold,
               CASE WHEN earned_on <= m_end THEN earned_on END AS discount_earned_date,
               CASE WHEN starts IS NOT NULL
                    THEN ifnull(starts <= m_end AND m_end < ends AND earned_on <= m_end, false)::INT
               END AS is_discount_active
        FROM summed, span""",
    "fact": """
        SELECT tid AS transaction_id, cid AS client_id, kind AS transaction_type,
               cur AS transaction_currency, day AS transaction_date, status AS resolution_status,
               settled_on AS resolution_date, booked_on AS recognition_date,
               eff AS spend_effective_date, sign AS amount_direction,
               amt::DOUBLE AS gross_amount_local, net::DOUBLE AS net_amount_local,
               gross_gbp::DOUBLE AS gross_amount_gbp, net_gbp::DOUBLE AS net_amount_gbp,
               dup AS is_duplicate_refund, booked AS is_revenue_recognised,
               counted AS is_spend_qualifying, inside::INT AS is_in_contract_period,
               spend::DOUBLE AS contract_spend_gbp, earned AS is_discount_earned,
               used_fee::DOUBLE AS applicable_fee_margin, revenue::DOUBLE AS revenue_gbp
        FROM rev""",
    # the tables the checks name, with the names of their columns
    "transaction_types": """
        SELECT kind AS transaction_type, sign AS amount_direction, earns AS recognises_revenue,
               spends AS counts_toward_spend, waits AS requires_resolution FROM rule""",
    "transactions": """
        SELECT tid AS transaction_id, cid AS client_id, amt AS transaction_amount,
               kind AS transaction_type, fee AS platform_fee_margin, cur AS transaction_currency,
               link AS linked_transaction_id, day AS transaction_date, dup AS is_duplicate_refund
        FROM tx""",
    "resolutions": """
        SELECT tid AS transaction_id, status AS resolution_status, settled_on AS resolution_date
        FROM res""",
    "rates": """
        SELECT cur || '-' || from_day::VARCHAR AS currency_rate_id, cur AS currency,
               from_day AS rate_date, rate AS exchange_rate_to_gbp FROM fx""",
    "contracts": """
        SELECT cid AS client_id, starts AS contract_start_date, months AS contract_duration_months,
               target AS spend_threshold, low_fee AS discounted_fee_margin FROM deal""",
    "contract_windows": """
        SELECT cid AS client_id, months AS contract_duration_months, target AS spend_threshold,
               low_fee AS discounted_fee_margin, starts AS contract_start_date,
               ends AS contract_end_date FROM deal""",
    "classified": """
        SELECT tid AS transaction_id, day AS transaction_date, cid AS client_id,
               kind AS transaction_type, cur AS transaction_currency, fee AS platform_fee_margin,
               sign AS amount_direction, amt AS gross_amount_local, net AS net_amount_local,
               status AS resolution_status, settled_on AS resolution_date,
               link AS linked_transaction_id, paid_on AS linked_payment_date,
               dup AS is_duplicate_refund, eff AS spend_effective_date,
               booked AS is_revenue_recognised, counted AS is_spend_qualifying
        FROM cls""",
    "converted": """
        SELECT tid AS transaction_id, cur AS transaction_currency, sign AS amount_direction,
               gross_gbp AS gross_amount_gbp, net_gbp AS net_amount_gbp FROM gbp""",
    "contract_spend": """
        SELECT tid AS transaction_id, cid AS client_id, eff AS spend_effective_date,
               low_fee AS discounted_fee_margin, inside::INT AS is_in_contract_period,
               spend AS contract_spend_gbp, running AS running_contract_spend_gbp,
               earned AS is_discount_earned FROM spent""",
    "revenue": "SELECT * FROM fact",
    "fct_transactions": "SELECT * FROM fact",
    "dates": "SELECT * FROM cal",
    "monthly": "SELECT * FROM mart",
}


def _sql(select: str, dirty: bool = False) -> str:
    """``select`` with the CTEs it needs, over the plain or the broken raw tables."""
    sources = {
        "{tx_source}": "tx_broken" if dirty else "tx_plain",
        "{res_source}": "res_broken" if dirty else "res_plain",
    }

    def fill(text: str) -> str:
        for mark, source in sources.items():
            text = text.replace(mark, source)
        return text

    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b|,\s*{name}\b(?=\s*(WHERE|$|,|\)|GROUP))", text):
                if name not in needed:
                    visit(fill(CTES[name]))
                    if name not in needed:
                        needed.append(name)

    visit(select)
    # read by several others, so worth computing once
    kept = {"tx", "cls", "gbp", "spent", "own", "rev", "grid", "mart", "fact"}
    ctes = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in kept else ''}({fill(CTES[name])})"
        for name in needed
    )
    return f"WITH {ctes}\n{select}"


def _doubles(names: str) -> str:
    return ", ".join(f"{n}::DOUBLE AS {n}" for n in names.split())




def _metrics_by(grain: str) -> str:
    return f"""
        SELECT coalesce(a.t, b.t) AS metric_time, a.revenue::DOUBLE AS revenue,
               a.net::DOUBLE AS net_gmv, a.gross::DOUBLE AS gross_gmv,
               a.revenue::DOUBLE / nullif(a.net::DOUBLE, 0) AS take_rate, b.n AS transactions
        FROM (
            SELECT date_trunc('{grain}', booked_on)::DATE AS t, sum(revenue) AS revenue,
                   sum(if(booked = 1, net_gbp, 0)) AS net,
                   sum(if(booked = 1 AND sign = 1, gross_gbp, 0)) AS gross
            FROM rev WHERE booked_on IS NOT NULL GROUP BY ALL) a
        FULL JOIN (
            SELECT date_trunc('{grain}', day)::DATE AS t, count(tid) AS n FROM rev GROUP BY ALL) b
        ON a.t = b.t"""


_LOADED = {
    "transactions": """
        SELECT tid AS transaction_id, cid AS client_id, amt::DOUBLE AS transaction_amount,
               kind AS transaction_type, strftime(day, '%Y-%m-%d') AS transaction_date,
               0.2::DOUBLE AS platform_fee_margin, cur AS currency, link AS linked_transaction_id,
               right(tid, 2) = '13' AS broken
        FROM tx_plain""",
    "resolutions": """
        SELECT tid AS transaction_id, status AS resolution_status,
               strftime(settled_on, '%d/%m/%Y') AS resolution_date, false AS broken
        FROM res_plain""",
    "rates": """
        SELECT cur AS currency, strftime(from_day, '%Y-%m-%d') AS rate_date,
               rate::DOUBLE AS exchange_rate_to_gbp, cur = 'EUR' AND day(from_day) = 28 AS broken
        FROM fx""",
    "contracts": """
        SELECT cid AS client_id, strftime(starts, '%Y-%m-%d') AS contract_start_date,
               months AS contract_duration_months, target::DOUBLE AS spend_threshold,
               low_fee::DOUBLE AS discounted_fee_margin, right(cid, 2) = '08' AS broken
        FROM deal""",
    "types": "SELECT *, false AS broken FROM transaction_types",
}

SELECTS: dict[str, str] = {
    **{
        f"load_{name}": f"SELECT * EXCLUDE (broken) FROM ({select}) WHERE NOT broken"
        for name, select in _LOADED.items()
    },
    "load_rejected": "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS lines FROM ({select}) WHERE broken"
        for name, select in _LOADED.items()
    ),
    "stage_transactions": f"""
        SELECT * EXCLUDE (is_duplicate_refund) REPLACE (
            transaction_amount::DOUBLE AS transaction_amount,
            platform_fee_margin::DOUBLE AS platform_fee_margin) FROM transactions""",
    "flag_duplicate_refunds": """
        SELECT * REPLACE (transaction_amount::DOUBLE AS transaction_amount,
                          platform_fee_margin::DOUBLE AS platform_fee_margin) FROM transactions""",
    "stage_resolutions": "SELECT * FROM resolutions",
    "stage_rates": "SELECT * REPLACE (exchange_rate_to_gbp::DOUBLE AS exchange_rate_to_gbp) FROM rates",
    "stage_contracts": """
        SELECT * REPLACE (spend_threshold::DOUBLE AS spend_threshold,
                          discounted_fee_margin::DOUBLE AS discounted_fee_margin) FROM contracts""",
    "date_spine": """
        SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS date_day,
               date_trunc('month', date_day)::DATE AS month_start_date,
               last_day(date_day) AS month_end_date
        FROM (SELECT date_trunc('month', min(day)) AS lo, last_day(max(day))::TIMESTAMP AS hi FROM tx)""",
    "classify_transactions": """
        SELECT * REPLACE (gross_amount_local::DOUBLE AS gross_amount_local,
                          net_amount_local::DOUBLE AS net_amount_local,
                          platform_fee_margin::DOUBLE AS platform_fee_margin) FROM classified""",
    "asof_convert_gbp": f"""
        SELECT transaction_id, transaction_currency, {_doubles('gross_amount_gbp net_amount_gbp')}
        FROM converted""",
    "contract_windows": """
        SELECT * REPLACE (spend_threshold::DOUBLE AS spend_threshold,
                          discounted_fee_margin::DOUBLE AS discounted_fee_margin) FROM contract_windows""",
    "contract_spend_running": """
        SELECT * EXCLUDE (discounted_fee_margin) REPLACE (
            contract_spend_gbp::DOUBLE AS contract_spend_gbp,
            running_contract_spend_gbp::DOUBLE AS running_contract_spend_gbp) FROM contract_spend""",
    "discount_latch": """
        SELECT c.cid AS client_id, c.target::DOUBLE AS spend_threshold,
               arg_min(s.eff, (s.eff, s.tid)) AS reached_on, arg_min(s.tid, (s.eff, s.tid)) AS reached_by
        FROM deal c LEFT JOIN spent s ON s.cid = c.cid AND s.running >= s.target
        GROUP BY ALL""",
    "price_revenue": """
        SELECT transaction_id, recognition_date, applicable_fee_margin, revenue_gbp FROM fact""",
    "fct_transactions": f"SELECT {', '.join(FACT)} FROM fact",
    "data_coverage": "SELECT * FROM span",
    "client_month_scaffold": """
        SELECT cid AS client_id, m AS month_start_date, m_end AS month_end_date FROM grid""",
    "recognised_by_month": """
        SELECT cid AS client_id, m AS month_start_date, gross::DOUBLE AS recognised_gross_gmv_gbp,
               net::DOUBLE AS recognised_net_gmv_gbp, revenue::DOUBLE AS recognised_revenue_gbp,
               n AS recognised_transaction_count FROM booked_m""",
    "originated_by_month": """
        SELECT cid AS client_id, m AS month_start_date, net::DOUBLE AS originated_net_gmv_gbp,
               revenue::DOUBLE AS originated_revenue_gbp FROM made_m""",
    "pending_at_month_end": """
        SELECT cid AS client_id, m AS month_start_date, open_gbp::DOUBLE AS pending_chargebacks_gbp
        FROM open_m""",
    "contract_spend_by_month": """
        SELECT cid AS client_id, m AS month_start_date, spend::DOUBLE AS monthly_contract_spend_gbp
        FROM spend_m""",
    "discount_earned_date": """
        SELECT cid AS client_id, earned_on AS discount_earned_date FROM earned_c""",
    "client_monthly_revenue": f"SELECT {', '.join(MONTHLY)} FROM mart",
    "naive_threshold_comparison": """
        SELECT client_id, month_start_date, spend_threshold, cumulative_contract_spend_gbp,
               naive::DOUBLE AS naive_cumulative_gross_spend_gbp,
               (cumulative_contract_spend_gbp >= spend_threshold)::INT AS is_threshold_reached,
               (naive >= spend_threshold)::INT AS is_naive_threshold_reached
        FROM (
            SELECT a.*, sum(ifnull(b.gross, 0)) OVER (
                       PARTITION BY client_id ORDER BY month_start_date ROWS UNBOUNDED PRECEDING) AS naive
            FROM mart a LEFT JOIN (
                SELECT cid, date_trunc('month', day)::DATE AS m, sum(gross_gbp) AS gross
                FROM rev WHERE inside GROUP BY ALL) b
            ON b.cid = a.client_id AND b.m = a.month_start_date
            WHERE a.contract_status <> 'no contract')""",
    **{f"metrics_by_{grain}": _metrics_by(grain) for grain in ("day", "week", "month", "quarter", "year")},
    "metrics_by_type_currency": """
        SELECT kind AS transaction_type, cur AS transaction_currency, dup AS is_duplicate_refund,
               sum(revenue)::DOUBLE AS revenue,
               sum(if(booked = 1, net_gbp, 0))::DOUBLE AS net_gmv,
               sum(if(booked = 1 AND sign = 1, gross_gbp, 0))::DOUBLE AS gross_gmv,
               count(tid) AS transactions
        FROM rev GROUP BY ALL""",
    "take_rate_by_client": """
        SELECT client_id, revenue / nullif(net_gmv, 0) AS take_rate, revenue, net_gmv FROM (
            SELECT cid AS client_id, sum(revenue)::DOUBLE AS revenue,
                   sum(if(booked = 1, net_gbp, 0))::DOUBLE AS net_gmv
            FROM rev GROUP BY ALL)""",
    "dq_rates_daily": """
        SELECT * FROM (
            SELECT currency, rate_date,
                   lag(rate_date) OVER (PARTITION BY currency ORDER BY rate_date) AS previous_rate_date
            FROM rates)
        WHERE rate_date - previous_rate_date <> 1""",
}

_EXACT_FLOWS = """
    recognised_gross_gmv_gbp recognised_net_gmv_gbp recognised_revenue_gbp originated_net_gmv_gbp
    originated_revenue_gbp monthly_contract_spend_gbp"""


def _rollup(grain: str, by_client: bool) -> str:
    """Sums of doubles depend on their order, so money is summed as decimals again."""
    flows = ", ".join(f"sum({c}::DECIMAL(28,5)) AS {c}" for c in _EXACT_FLOWS.split())
    positions = ", ".join(
        f"arg_max_null({c}::DECIMAL(28,5), month_start_date) AS {c}"
        for c in ("pending_chargebacks_gbp", "cumulative_contract_spend_gbp")
    )
    names = f"{_EXACT_FLOWS} pending_chargebacks_gbp cumulative_contract_spend_gbp".split()
    count = "recognised_transaction_count"
    per_client = f"""
        SELECT client_id, date_trunc('{grain}', month_start_date)::DATE AS period_start_date,
               {flows}, {positions}, sum({count})::BIGINT AS {count}
        FROM mart GROUP BY ALL"""
    if by_client:
        outer = ", ".join(f"{c}::DOUBLE AS {c}" for c in names)
        return f"SELECT client_id, period_start_date, {count}, {outer} FROM ({per_client})"
    outer = ", ".join(f"sum({c})::DOUBLE AS {c}" for c in names)
    return f"""SELECT period_start_date, sum({count})::BIGINT AS {count}, {outer}
        FROM ({per_client}) GROUP BY ALL"""


SELECTS["rollup_quarter"] = _rollup("quarter", by_client=True)
SELECTS["rollup_year_all_clients"] = _rollup("year", by_client=False)


def _reconcile(booked_filter: str) -> str:
    """Totals of the mart, taken from its sources, against the fact."""
    return f"""
        SELECT * FROM (
            SELECT r.cid AS client_id,
                   sum(r.revenue) FILTER ({booked_filter})::DOUBLE AS recognised_revenue_gbp,
                   sum(r.revenue) FILTER ({booked_filter})::DOUBLE AS originated_revenue_gbp,
                   (ifnull(sum(r.net_gbp) FILTER (r.booked = 1 AND {booked_filter}), 0))::DOUBLE AS recognised_net_gmv_gbp,
                   (ifnull(sum(r.net_gbp) FILTER (r.booked = 1 AND {booked_filter}), 0))::DOUBLE AS originated_net_gmv_gbp,
                   CASE WHEN any_value(c.cid) IS NOT NULL
                        THEN ifnull(sum(r.spend) FILTER ({booked_filter}), 0) END::DOUBLE AS cumulative_contract_spend_gbp,
                   sum(r.revenue)::DOUBLE AS revenue_gbp,
                   sum(if(r.booked = 1, r.net_gbp, 0))::DOUBLE AS net_gmv_gbp,
                   sum(r.spend)::DOUBLE AS contract_spend_gbp
            FROM rev r LEFT JOIN deal c ON c.cid = r.cid GROUP BY r.cid
            HAVING count(*) FILTER ({booked_filter}) > 0)
        WHERE abs(recognised_revenue_gbp - revenue_gbp) > 0.001
           OR abs(recognised_net_gmv_gbp - net_gmv_gbp) > 0.001
           OR abs(ifnull(cumulative_contract_spend_gbp, 0) - ifnull(contract_spend_gbp, 0)) > 0.001"""


SELECTS["dq_reconcile_planted"] = _reconcile("r.kind <> 'refund'")
SELECTS["dq_reconcile"] = """
    SELECT m.*, f.* EXCLUDE (cid) FROM (
        SELECT client_id, sum(recognised_revenue_gbp) AS recognised_revenue_gbp,
               sum(originated_revenue_gbp) AS originated_revenue_gbp,
               sum(recognised_net_gmv_gbp) AS recognised_net_gmv_gbp,
               sum(originated_net_gmv_gbp) AS originated_net_gmv_gbp,
               arg_max_null(cumulative_contract_spend_gbp, month_start_date) AS cumulative_contract_spend_gbp
        FROM mart GROUP BY client_id) m
    JOIN (
        SELECT cid, sum(revenue)::DOUBLE AS revenue_gbp,
               sum(if(booked = 1, net_gbp, 0))::DOUBLE AS net_gmv_gbp,
               sum(spend)::DOUBLE AS contract_spend_gbp FROM rev GROUP BY cid) f
    ON f.cid = m.client_id
    WHERE abs(recognised_revenue_gbp - revenue_gbp) > 0.001
       OR abs(originated_revenue_gbp - revenue_gbp) > 0.001
       OR abs(recognised_net_gmv_gbp - net_gmv_gbp) > 0.001
       OR abs(originated_net_gmv_gbp - net_gmv_gbp) > 0.001
       OR abs(ifnull(cumulative_contract_spend_gbp, 0) - ifnull(contract_spend_gbp, 0)) > 0.001"""

_PLAIN_TX = """* EXCLUDE (is_duplicate_refund) REPLACE (
    transaction_amount::DOUBLE AS transaction_amount, platform_fee_margin::DOUBLE AS platform_fee_margin)"""

DIRTY_SELECTS: dict[str, str] = {
    "dq_unique": """
        SELECT transaction_id, count(*) AS n_records FROM transactions
        GROUP BY transaction_id HAVING count(*) > 1""",
    "dq_not_null": """
        SELECT * FROM resolutions WHERE resolution_status = 'resolved' AND resolution_date IS NULL""",
    "dq_accepted_values": """
        SELECT transaction_type, count(*) AS n_records FROM transactions
        WHERE transaction_type NOT IN ('payment', 'refund', 'chargeback', 'fraud')
        GROUP BY transaction_type""",
    "dq_relationships": f"""
        SELECT {_PLAIN_TX} FROM transactions
        WHERE transaction_currency NOT IN (SELECT currency FROM rates)""",
    "dq_relationships_where": f"""
        SELECT {_PLAIN_TX} FROM transactions
        WHERE linked_transaction_id NOT IN (SELECT tid FROM tx WHERE kind = 'payment')""",
    "dq_accepted_range": f"SELECT {_PLAIN_TX} FROM transactions WHERE transaction_amount <= 0",
    "dq_expression": f"""
        SELECT {_PLAIN_TX} FROM transactions
        WHERE NOT regexp_full_match(client_id, 'C[0-9]{{{ID_DIGITS}}}')""",
    "classify_dirty": SELECTS["classify_transactions"],
    "dq_equal_rowcount": """
        SELECT *, abs(row_count - other_row_count) AS difference FROM (
            SELECT (SELECT count(*) FROM classified) AS row_count,
                   (SELECT count(*) FROM transactions) AS other_row_count)
        WHERE row_count <> other_row_count""",
}


def _failures(check: Check) -> str:
    """A scalar query for the number of failures of one check."""
    table, column, a = check.table, check.column, check.arguments
    scope = check.where or "true"
    if check.kind == "not_null":
        return f"SELECT count(*) FROM {table} WHERE ({scope}) AND {column} IS NULL"
    if check.kind == "unique":
        return f"""SELECT count(*) FROM (SELECT {column} FROM {table} WHERE ({scope})
            AND {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"""
    if check.kind == "accepted_values":
        accepted = ", ".join(repr(value) for value in a["values"])
        return f"""SELECT count(DISTINCT {column}) FROM {table}
            WHERE ({scope}) AND {column} NOT IN ({accepted})"""
    if check.kind == "accepted_range":
        low, high = ("<", ">") if a["inclusive"] else ("<=", ">=")
        bounds = [f"{column} {low} {a['min_value']}"]
        if a["max_value"] is not None:
            bounds.append(f"{column} {high} {a['max_value']}")
        return f"SELECT count(*) FROM {table} WHERE ({scope}) AND ({' OR '.join(bounds)})"
    if check.kind == "expression_is_true":
        pattern = re.fullmatch(r"RLIKE '(.*)'", a["expression"])
        holds = (
            f"regexp_matches({column}, '{pattern[1]}')" if pattern else f"{column} {a['expression']}"
        )
        return f"SELECT count(*) FROM {table} WHERE ({scope}) AND NOT ({holds})"
    if check.kind == "relationships":
        return f"""SELECT count(*) FROM {table} WHERE ({scope}) AND {column} NOT IN (
            SELECT {a['field']} FROM {a['parent']} WHERE {a.get('parent_where', 'true')})"""
    if check.kind == "equal_rowcount":
        return f"SELECT abs((SELECT count(*) FROM {table}) - (SELECT count(*) FROM {a['other']}))"
    raise ValueError(check.kind)


def _failing_rows(check: Check) -> str:
    """A condition on the rows of the check's table that fail it."""
    column, scope = check.column, check.where or "true"
    if check.kind == "unique":
        return f"""({scope}) AND {column} IN (SELECT {column} FROM {check.table} WHERE ({scope})
            GROUP BY {column} HAVING count(*) > 1)"""
    if check.kind == "accepted_values":
        accepted = ", ".join(repr(value) for value in check.arguments["values"])
        return f"({scope}) AND {column} NOT IN ({accepted})"
    return _failures(check).split("WHERE", 1)[1]


def _stored(checks: list[Check]) -> str:
    rows = "\nUNION ALL ".join(
        f"SELECT {_quoted(c.table)} AS \"table\", {_quoted(c.name)} AS \"check\", count(*) AS failing_rows"
        f" FROM {c.table} WHERE {_failing_rows(c)}"
        for c in checks
        if c.kind != "equal_rowcount"
    )
    return f"SELECT * FROM ({rows}) WHERE failing_rows > 0"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _summary(checks: list[Check]) -> str:
    rows = "\nUNION ALL ".join(
        f"SELECT {_quoted(c.table)} AS \"table\", {_quoted(c.name)} AS \"check\","
        f" '{c.severity}' AS severity, {c.warn_above} AS w, {c.error_above} AS e,"
        f" ({_failures(c)})::BIGINT AS failures"
        for c in checks
    )
    return f"""SELECT "table", "check", severity, failures,
        CASE WHEN severity = 'error' AND failures > e THEN 'fail'
             WHEN failures > w THEN 'warn' ELSE 'pass' END AS status
        FROM ({rows})"""


def oracle_queries() -> dict[str, str]:
    patterns = {
        "client_pattern": f"^C[0-9]{{{ID_DIGITS}}}$",
        "transaction_pattern": f"^T[0-9]{{{ID_DIGITS}}}$",
    }
    staged = [*suite.rule_checks(), *suite.staging_checks(**patterns)]
    everything = [*staged, *suite.step_checks(), *suite.mart_checks()]
    queries = {name: _sql(select) for name, select in SELECTS.items()}
    queries |= {name: _sql(select, dirty=True) for name, select in DIRTY_SELECTS.items()}
    queries["dq_summary"] = _sql(_summary(staged), dirty=True)
    queries["dq_stored_failures"] = _sql(_stored(staged), dirty=True)
    queries["dq_suite"] = _sql(_summary(everything))
    return queries
