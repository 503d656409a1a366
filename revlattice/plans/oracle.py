"""The same results in DuckDB SQL, straight from the benchmark tables.

The SQL does not go through JSON or the Spark operators' steps; it is written from the
rules, so that agreement means something. Shared parts are named CTEs; `_sql` puts the
ones a query needs in front of it.
"""

from __future__ import annotations

import re

from revlattice.sources.driver_tables import HISTORY_DAY, USAGE_DAY
from revlattice.sources.seeds import PLANS

DAY, LAST = f"DATE '{USAGE_DAY}'", f"DATE '{HISTORY_DAY}'"

_plan_rows = ", ".join(str(p) for p in PLANS)
_MONDAY = "CAST(date_trunc('week', {}) AS DATE)"
_CRM_DAY = "CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP)"
_BILLED = "CAST(DATE '2023-10-01' + CAST(c_custkey % 90 AS INTEGER) AS TIMESTAMP)"
_PLAN_NO = "[1, 1, 1, 1, 2, 2, 2, 3, 3, 4][c_custkey % 10 + 1]"

CTES: dict[str, str] = {
    "plans": f"""
        SELECT * FROM (VALUES {_plan_rows})
            v(price_id, plan_name, plan_rank, monthly_price_usd, seat_limit, monthly_credits)""",
    "companies": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS company_id, c_name AS company_name,
               'c' || c_custkey || '.com' AS domain, (c_custkey * 37) % 500 + 1 AS employees,
               {_CRM_DAY} AS created_at
        FROM customer""",
    "contacts": f"""
        SELECT 'con_' || c_custkey || '_' || n AS contact_id,
               CASE n WHEN 0 THEN 'first.last' ELSE 'firstlast' END || c_custkey || '@c' || c_custkey || '.com' AS email,
               'c' || c_custkey || '.com' AS email_domain,
               CASE WHEN c_custkey % 11 <> 0 THEN 'First' END AS first_name,
               'Last' || c_custkey AS last_name, c_name AS company_name,
               {_CRM_DAY} + n * INTERVAL 1 DAY AS created_at, {_CRM_DAY} + n * INTERVAL 1 DAY AS updated_at
        FROM customer, (VALUES (0), (1)) t(n) WHERE n = 0 OR c_custkey % 20 = 3""",
    "deals": f"""
        SELECT 'deal_' || c_custkey AS deal_id, c_name || ' deal' AS deal_name,
               ['appointmentscheduled', 'qualifiedtobuy', 'closedwon', 'closedlost'][c_custkey % 4 + 1] AS deal_stage,
               'default' AS pipeline,
               CASE WHEN c_custkey % 9 <> 0 THEN CAST(12000.5 + c_custkey % 7 * 1000 AS DOUBLE) END AS amount,
               CAST(NULL AS TIMESTAMP) AS close_date, {_CRM_DAY} AS created_at, {_CRM_DAY} AS updated_at,
               CASE WHEN c_custkey % 6 = 0 OR c_custkey % 12 = 7 THEN CAST(c_custkey AS VARCHAR) END AS deal_company
        FROM customer""",
    "billing": f"""
        SELECT 'cus_' || c_custkey AS customer_id,
               CASE WHEN c_custkey % 25 = 7 THEN 'Formerly ' ELSE '' END || c_name AS customer_name,
               'billing' || c_custkey || '@c' || c_custkey || '.com' AS email,
               CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 25 <> 7 THEN CAST(c_custkey AS VARCHAR) END AS hubspot_company_id,
               {_BILLED} AS created_at
        FROM customer""",
    "subs": f"""
        SELECT 'sub_' || c_custkey AS subscription_id,
               'cus_' || c_custkey || CASE WHEN c_custkey % 25 = 7 THEN '_old' ELSE '' END AS customer_id,
               CASE WHEN c_custkey % 13 = 0 THEN 'canceled' ELSE 'active' END AS subscription_status,
               'usd' AS currency, price_id, CAST(monthly_price_usd AS DOUBLE) AS monthly_amount_usd,
               1 AS quantity, {_BILLED} AS current_period_start,
               {_BILLED} + INTERVAL 30 DAY AS current_period_end, {_BILLED} AS created_at,
               CASE WHEN c_custkey % 13 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' END AS canceled_at,
               CASE WHEN c_custkey % 13 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' END AS ended_at,
               c_custkey % 13 = 0 AS cancel_at_period_end
        FROM customer JOIN plans ON plan_rank = {_PLAN_NO}""",
    "invoices": """
        SELECT 'in_' || o_orderkey AS invoice_id,
               'cus_' || o_custkey || CASE WHEN o_custkey % 25 = 7 THEN '_old' ELSE '' END AS customer_id,
               'sub_' || o_custkey AS subscription_id,
               CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE 'void' END AS payment_status,
               CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS amount_due_usd,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 <> 0
                    THEN CAST(round(o_totalprice * 100) AS BIGINT) / 100 ELSE 0.0 END AS amount_paid_usd,
               'usd' AS currency, CAST(o_orderdate AS TIMESTAMP) AS created_at
        FROM orders""",
    "usage_log": """
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               CASE WHEN event_type = 'click' THEN 'prompt_run'
                    WHEN event_type = 'purchase' THEN 'project_created'
                    WHEN event_type = 'error' THEN 'project_published'
                    WHEN event_type = 'signup' AND event_id % 20 = 0 THEN 'teammate_invited'
                    ELSE 'session_started' END AS event_type,
               CASE WHEN event_id % 33 <> 0 THEN 'c' || (user_id // 3) || '.com' END AS account_domain,
               'user' || CASE WHEN (user_id // 3) % 4 = 1 THEN 1 ELSE user_id % 3 + 1 END
                   || '@c' || (user_id // 3) || '.com' AS user_email,
               CASE WHEN event_type = 'click'
                     AND NOT ((user_id // 3) % 7 = 0 AND ts >= TIMESTAMP '2024-01-17 00:00:00')
                    THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS credits_used,
               CAST(ts AS TIMESTAMP) AS occurred_at,
               CASE WHEN event_id % 20 = 0
                    THEN ts + (1 + (event_id // 20) % 2) * INTERVAL 1 DAY + (event_id % 601) * INTERVAL 1 MINUTE
                    ELSE ts + (event_id % 30 + 1) * INTERVAL 1 SECOND END AS ingested_at
        FROM events""",
    # Every company has one linked customer, one of equal name, or none.
    "account": """
        SELECT c.company_id AS hubspot_company_id, c.company_name, c.domain AS company_domain,
               c.employees AS total_employees, b.customer_id,
               CASE WHEN b.customer_id IS NULL THEN 'unmatched'
                    WHEN b.hubspot_company_id = c.company_id THEN 'direct' ELSE 'name' END AS match_type
        FROM companies c LEFT JOIN billing b
          ON b.hubspot_company_id = c.company_id
          OR (b.customer_name = c.company_name
              AND NOT EXISTS (SELECT 1 FROM billing x WHERE x.hubspot_company_id = c.company_id))""",
    "daily": """
        SELECT a.hubspot_company_id, e.account_domain, CAST(e.occurred_at AS DATE) AS usage_date,
               CAST(sum(credits_used) AS BIGINT) AS total_credits_used,
               count(DISTINCT user_email) AS active_users,
               count(*) FILTER (event_type = 'session_started') AS sessions,
               count(*) FILTER (event_type = 'prompt_run') AS prompt_runs,
               count(*) FILTER (event_type = 'project_created') AS projects_created,
               count(*) FILTER (event_type = 'teammate_invited') AS teammates_invited,
               count(*) FILTER (event_type = 'project_published') AS projects_published,
               count(*) AS total_events
        FROM account a JOIN usage_log e ON e.account_domain = a.company_domain
        GROUP BY ALL""",
    "account_sub": """
        SELECT a.hubspot_company_id, a.customer_id, a.company_name, s.subscription_id, p.plan_name,
               p.plan_rank, p.seat_limit, p.monthly_credits, s.monthly_amount_usd,
               s.subscription_status, s.created_at, s.canceled_at,
               s.subscription_status = 'active' AS is_active
        FROM account a LEFT JOIN subs s USING (customer_id) LEFT JOIN plans p USING (price_id)""",
    "two_windows": f"""
        SELECT hubspot_company_id,
               CAST(coalesce(sum(total_credits_used) FILTER (usage_date >= {DAY} - 14), 0) AS BIGINT) AS credits_recent,
               CAST(coalesce(sum(total_credits_used) FILTER (usage_date < {DAY} - 14), 0) AS BIGINT) AS credits_previous
        FROM daily WHERE usage_date >= {DAY} - 28 GROUP BY 1""",
    "health": """
        SELECT s.hubspot_company_id, s.company_name, s.plan_name, s.monthly_amount_usd,
               s.subscription_status, s.is_active, r AS credits_recent, p AS credits_previous,
               CASE WHEN r = 0 OR r * 2 < p THEN 'red' WHEN r * 4 < p * 3 THEN 'yellow' ELSE 'green' END AS health_status
        FROM account_sub s
        LEFT JOIN two_windows w USING (hubspot_company_id),
        LATERAL (SELECT coalesce(w.credits_recent, 0) AS r, coalesce(w.credits_previous, 0) AS p) v
        WHERE s.is_active AND s.plan_name <> 'free'""",
    "recent": f"""
        SELECT hubspot_company_id, CAST(sum(total_credits_used) AS BIGINT) AS credits_used,
               max(active_users) AS peak_active_users,
               CAST(sum(teammates_invited) AS BIGINT) AS teammates_invited,
               max(usage_date) AS last_active_date
        FROM daily WHERE usage_date >= {DAY} - 14 GROUP BY 1""",
    "signals": """
        SELECT b.*, signal_active_users + signal_credit_usage + signal_invite AS signal_count
        FROM (
            SELECT a.hubspot_company_id, a.company_name, a.company_domain, a.total_employees, s.plan_name,
                   s.monthly_credits, s.monthly_amount_usd,
                   coalesce(r.credits_used, 0) AS credits_used_14d,
                   coalesce(r.peak_active_users, 0) AS active_users,
                   coalesce(r.teammates_invited, 0) AS teammates_invited_14d, r.last_active_date,
                   CAST(coalesce(r.peak_active_users >= 3, false) AS BIGINT) AS signal_active_users,
                   CAST(coalesce(r.credits_used / nullif(s.monthly_credits, 0) >= 0.8, false) AS BIGINT) AS signal_credit_usage,
                   CAST(coalesce(r.teammates_invited >= 1, false) AS BIGINT) AS signal_invite,
                   round(coalesce(r.credits_used, 0) / nullif(s.monthly_credits, 0) * 100, 1) AS credit_usage_pct
            FROM account a JOIN account_sub s USING (hubspot_company_id)
            LEFT JOIN recent r USING (hubspot_company_id)
            WHERE a.total_employees >= 50 AND s.is_active AND s.plan_name IN ('free', 'pro', 'team')
        ) b""",
    "leads": "SELECT * FROM signals WHERE signal_count >= 2",
    "windows": f"""
        SELECT hubspot_company_id,
               CAST(coalesce(sum(total_credits_used) FILTER (usage_date >= {DAY} - 30), 0) AS BIGINT) AS credits_used_30d,
               CAST(coalesce(sum(total_credits_used) FILTER (usage_date >= {DAY} - 14), 0) AS BIGINT) AS credits_used_14d,
               CAST(coalesce(sum(total_credits_used) FILTER (usage_date >= {DAY} - 28 AND usage_date < {DAY} - 14), 0) AS BIGINT) AS credits_previous_14d,
               CAST(coalesce(sum(prompt_runs) FILTER (usage_date >= {DAY} - 14), 0) AS BIGINT) AS prompt_runs_14d,
               CAST(coalesce(sum(sessions) FILTER (usage_date >= {DAY} - 14), 0) AS BIGINT) AS sessions_14d,
               CAST(coalesce(sum(teammates_invited) FILTER (usage_date >= {DAY} - 14), 0) AS BIGINT) AS teammates_invited_14d,
               coalesce(max(active_users) FILTER (usage_date >= {DAY} - 14), 0) AS active_users_14d,
               max(usage_date) AS last_active_date,
               CAST(sum(total_credits_used) AS BIGINT) AS credits_used_all_time
        FROM daily GROUP BY 1""",
    "cash": """
        SELECT customer_id, round(sum(amount_paid_usd), 2) AS lifetime_revenue_usd, count(*) AS invoices_paid
        FROM invoices WHERE payment_status = 'paid' AND amount_paid_usd > 0 GROUP BY 1""",
    "main_contact": """
        SELECT email, email_domain, first_name || ' ' || last_name AS contact_name FROM contacts
        QUALIFY row_number() OVER (PARTITION BY email_domain ORDER BY created_at NULLS FIRST, contact_id) = 1""",
    "overview": f"""
        SELECT *, CASE WHEN is_active IS NOT TRUE THEN 'churned' WHEN is_pql THEN 'sales opportunity'
                       WHEN health_status = 'red' THEN 'at risk' WHEN health_status = 'yellow' THEN 'watch'
                       WHEN plan_name = 'free' AND credits_used_14d = 0 THEN 'dormant free'
                       WHEN plan_name = 'free' THEN 'active free' ELSE 'healthy paying' END AS account_segment
        FROM (
            SELECT a.hubspot_company_id, a.company_name, a.company_domain, a.total_employees,
                   a.match_type AS billing_match_type, s.customer_id, s.subscription_id, s.plan_name, s.plan_rank,
                   s.monthly_amount_usd,
                   CASE WHEN s.is_active THEN s.monthly_amount_usd ELSE 0 END AS current_mrr_usd,
                   CASE WHEN s.is_active THEN s.monthly_amount_usd * 12 ELSE 0 END AS annual_run_rate_usd,
                   s.subscription_status, s.is_active, s.created_at AS subscription_started_at, s.canceled_at,
                   s.seat_limit, s.monthly_credits,
                   date_diff('day', CAST(s.created_at AS DATE), {DAY}) AS tenure_days,
                   coalesce(w.credits_used_14d, 0) AS credits_used_14d,
                   coalesce(w.credits_previous_14d, 0) AS credits_previous_14d,
                   coalesce(w.prompt_runs_14d, 0) AS prompt_runs_14d,
                   coalesce(w.sessions_14d, 0) AS sessions_14d,
                   coalesce(w.teammates_invited_14d, 0) AS teammates_invited_14d,
                   coalesce(w.active_users_14d, 0) AS active_users_14d,
                   coalesce(w.credits_used_all_time, 0) AS credits_used_all_time,
                   w.last_active_date,
                   date_diff('day', w.last_active_date, {DAY}) AS days_since_last_active,
                   coalesce(w.credits_used_30d, 0) AS credits_used_30d,
                   round(coalesce(w.credits_used_30d, 0) / nullif(s.monthly_credits, 0) * 100, 1) AS credit_usage_pct,
                   round(coalesce(w.active_users_14d, 0) / nullif(s.seat_limit, 0) * 100, 1) AS seat_usage_pct,
                   coalesce(c.lifetime_revenue_usd, 0.0) AS lifetime_revenue_usd,
                   coalesce(c.invoices_paid, 0) AS invoices_paid,
                   coalesce(h.health_status, 'not_scored') AS health_status,
                   l.hubspot_company_id IS NOT NULL AS is_pql,
                   coalesce(l.signal_count, 0) AS pql_signal_count,
                   m.email AS contact_email, m.contact_name
            FROM account a
            LEFT JOIN account_sub s ON s.hubspot_company_id = a.hubspot_company_id
            LEFT JOIN windows w ON w.hubspot_company_id = a.hubspot_company_id
            LEFT JOIN health h ON h.hubspot_company_id = a.hubspot_company_id
            LEFT JOIN leads l ON l.hubspot_company_id = a.hubspot_company_id
            LEFT JOIN cash c ON c.customer_id = s.customer_id
            LEFT JOIN main_contact m ON m.email_domain = a.company_domain
        ) t""",
    "payload": """
        SELECT hubspot_company_id AS id, CAST(json_object(
            'revlattice_health_status', health_status,
            'revlattice_account_segment', account_segment,
            'revlattice_days_since_active', coalesce(CAST(days_since_last_active AS VARCHAR), ''),
            'revlattice_active_users_14d', CAST(active_users_14d AS VARCHAR),
            'revlattice_plan', coalesce(plan_name, ''),
            'revlattice_credit_usage_pct', coalesce(CAST(credit_usage_pct AS VARCHAR), ''),
            'revlattice_seat_usage_pct', coalesce(CAST(seat_usage_pct AS VARCHAR), ''),
            'revlattice_credits_used_14d', CAST(credits_used_14d AS VARCHAR),
            'revlattice_current_mrr', CAST(current_mrr_usd AS VARCHAR),
            'revlattice_lifetime_revenue', CAST(lifetime_revenue_usd AS VARCHAR),
            'revlattice_tenure_days', coalesce(CAST(tenure_days AS VARCHAR), ''),
            'revlattice_pql_signals', CAST(pql_signal_count AS VARCHAR),
            'revlattice_is_pql', CASE WHEN is_pql THEN 'Yes' ELSE 'No' END,
            'revlattice_synced_at', '2024-01-31T06:00:00+00:00') AS VARCHAR) AS properties
        FROM overview""",
    # Order-derived subscription states, one per customer and date.
    "state_days": """
        SELECT o_custkey AS c, max(o_orderkey) AS o, CAST(o_orderdate AS TIMESTAMP) AS seen_on,
               min(seen_on) OVER (PARTITION BY o_custkey) AS first_at,
               seen_on = max(seen_on) OVER (PARTITION BY o_custkey) AND count(*) OVER (PARTITION BY o_custkey) > 1 AS is_last
        FROM orders GROUP BY o_custkey, o_orderdate""",
    **{
        f"states_{variant}": f"""
        SELECT 'sub_' || c AS subscription_id, CAST(c AS VARCHAR) AS hubspot_company_id,
               'Account ' || c AS company_name, 'cus_' || c AS customer_id,
               ['free', 'pro', 'team', 'enterprise'][o % 4 + 1] AS plan_name, o % 4 + 1 AS plan_rank,
               CAST([0, 20, 100, 1000][o % 4 + 1] AS DOUBLE) AS monthly_amount_usd,
               CASE WHEN {active} THEN 'active' ELSE 'canceled' END AS subscription_status,
               {active} AS is_active, first_at AS created_at,
               CASE WHEN NOT ({active}) AND o % 2 = 0 THEN seen_on + INTERVAL 2 DAY END AS canceled_at,
               seen_on AS state_at
        FROM state_days"""
        for variant, active in (("a", "o % 5 <> 0"), ("b", "NOT (c % 13 = 0 AND is_last)"))
    },
    # Plan and price move together, so plan and activity are all that can change.
    **{
        f"history_{variant}": f"""
        SELECT * EXCLUDE (state_at, changed), state_at AS dbt_valid_from,
               lead(state_at) OVER (PARTITION BY subscription_id ORDER BY state_at) AS dbt_valid_to
        FROM (
            SELECT *, (plan_name, is_active) IS DISTINCT FROM
                      lag((plan_name, is_active)) OVER (PARTITION BY subscription_id ORDER BY state_at) AS changed
            FROM states_{variant}
        ) WHERE changed"""
        for variant in "ab"
    },
    **{
        f"prev_{variant}": f"""
        SELECT subscription_id, monthly_amount_usd, is_active, created_at, canceled_at, dbt_valid_from,
               lag(monthly_amount_usd) OVER v AS previous_amount, lag(is_active) OVER v AS previous_is_active,
               row_number() OVER v AS rn
        FROM history_{variant} WINDOW v AS (PARTITION BY subscription_id ORDER BY dbt_valid_from)"""
        for variant in "abs"
    },
    **{
        f"starts_{variant}": f"""
        SELECT subscription_id, {_MONDAY.format('created_at')} AS week_start, monthly_amount_usd AS amount
        FROM prev_{variant} WHERE rn = 1 AND is_active"""
        for variant in "abs"
    },
    **{
        f"changes_{variant}": f"""
        SELECT subscription_id, {_MONDAY.format('dbt_valid_from')} AS week_start,
               CASE WHEN previous_amount = 0 THEN 'new' WHEN monthly_amount_usd = 0 THEN 'churn'
                    WHEN monthly_amount_usd > previous_amount THEN 'expansion' ELSE 'contraction' END AS kind,
               CASE WHEN previous_amount = 0 THEN monthly_amount_usd WHEN monthly_amount_usd = 0 THEN previous_amount
                    ELSE abs(monthly_amount_usd - previous_amount) END AS amount
        FROM prev_{variant} WHERE rn > 1 AND monthly_amount_usd <> previous_amount"""
        for variant in "abs"
    },
    **{
        f"cancels_{variant}": f"""
        SELECT subscription_id, {_MONDAY.format('coalesce(canceled_at, dbt_valid_from)')} AS week_start,
               monthly_amount_usd AS amount
        FROM prev_{variant} WHERE previous_is_active AND NOT is_active AND monthly_amount_usd > 0"""
        for variant in "abs"
    },
    **{
        f"spine_{variant}": f"""
        SELECT CAST(unnest(generate_series((SELECT min(week_start) FROM starts_{variant}),
                                           {_MONDAY.format(LAST)}, INTERVAL 7 DAY)) AS DATE) AS week_start"""
        for variant in "abs"
    },
    **{
        f"weekly_{variant}": f"""
        SELECT week_start,
               coalesce(sum(amount) FILTER (kind = 'new'), 0.0) AS new_mrr,
               coalesce(sum(amount) FILTER (kind = 'expansion'), 0.0) AS expansion_mrr,
               coalesce(sum(amount) FILTER (kind = 'contraction'), 0.0) AS contraction_mrr,
               coalesce(sum(amount) FILTER (kind = 'churn'), 0.0) AS churned_mrr,
               count(*) FILTER (kind = 'new') AS new_accounts,
               count(*) FILTER (kind = 'expansion') AS upgrades,
               count(*) FILTER (kind = 'contraction') AS downgrades,
               count(*) FILTER (kind = 'churn') AS churned_accounts
        FROM spine_{variant} LEFT JOIN (
            SELECT week_start, 'new' AS kind, amount FROM starts_{variant} WHERE amount > 0
            UNION ALL SELECT week_start, kind, amount FROM changes_{variant}
            UNION ALL SELECT week_start, 'churn', amount FROM cancels_{variant}
        ) m USING (week_start) GROUP BY 1"""
        for variant in "abs"
    },
    **{
        f"revenue_{variant}": f"""
        SELECT *, new_mrr + expansion_mrr - contraction_mrr - churned_mrr AS net_mrr_change,
               sum(new_mrr + expansion_mrr - contraction_mrr - churned_mrr)
                   OVER (ORDER BY week_start ROWS UNBOUNDED PRECEDING) AS ending_mrr
        FROM weekly_{variant}"""
        for variant in "abs"
    },
    **{
        f"active_{variant}": f"""
        SELECT sum(monthly_amount_usd) FILTER (is_active) AS total_mrr
        FROM history_{variant} WHERE dbt_valid_to IS NULL"""
        for variant in "ab"
    },
}



def _islands(states: str, runs: str, payload: str) -> str:
    """Islands of equal, gapless states; one ends at the run after its last state."""
    return f"""
        SELECT subscription_id, {payload}, min(state_at) AS dbt_valid_from,
               arg_max([next_run], state_at)[1] AS dbt_valid_to
        FROM (
            SELECT *, sum(CASE WHEN prev_run_no = run_no - 1 AND same THEN 0 ELSE 1 END)
                          OVER (PARTITION BY subscription_id ORDER BY run_no) AS island
            FROM (
                SELECT s.*, r.next_run, r.run_no,
                       lag(r.run_no) OVER k AS prev_run_no,
                       (plan_name, is_active) IS NOT DISTINCT FROM lag((plan_name, is_active)) OVER k AS same
                FROM {states} s JOIN {runs} r ON r.seen_on = s.state_at
                WINDOW k AS (PARTITION BY subscription_id ORDER BY r.run_no)
            )
        ) GROUP BY subscription_id, island"""


_FIRST = ", ".join(
    f"arg_min({c}, state_at) AS {c}" if c not in ("canceled_at",) else
    # arg_min skips NULLs; a one-element list keeps them.
    f"arg_min([{c}], state_at)[1] AS {c}"
    for c in (
        "hubspot_company_id",
        "company_name",
        "customer_id",
        "plan_name",
        "plan_rank",
        "monthly_amount_usd",
        "subscription_status",
        "is_active",
        "created_at",
        "canceled_at",
    )
)
# The states as full snapshots: a date with any order is a run.
CTES["runs"] = """
        SELECT seen_on, lead(seen_on) OVER (ORDER BY seen_on) AS next_run, row_number() OVER (ORDER BY seen_on) AS run_no
        FROM (SELECT DISTINCT state_at AS seen_on FROM states_a)"""
CTES["deleted_history"] = _islands("states_a", "runs", _FIRST)
CTES["four_runs"] = """
        SELECT seen_on, lead(seen_on) OVER (ORDER BY seen_on) AS next_run, row_number() OVER (ORDER BY seen_on) AS run_no
        FROM (SELECT CAST(min(state_at)::DATE + CAST(date_diff('day', min(state_at)::DATE, max(state_at)::DATE) * i // 4 AS INTEGER) AS TIMESTAMP)
                     AS seen_on FROM states_a, range(1, 5) r(i) GROUP BY i)"""
CTES["snapshots"] = """
        SELECT s.* EXCLUDE (state_at), r.seen_on AS state_at
        FROM four_runs r JOIN states_a s ON s.state_at <= r.seen_on AND (r.run_no = 4 OR substr(subscription_id, 5)::BIGINT % 11 <> r.run_no)
        QUALIFY row_number() OVER (PARTITION BY r.seen_on, subscription_id ORDER BY s.state_at DESC) = 1"""
CTES["stored_history"] = _islands("snapshots", "four_runs", _FIRST)
CTES["history_s"] = "SELECT * FROM stored_history"
CTES["answer_key"] = f"""
        SELECT c_name AS company_name, 'c' || c_custkey || '.com' AS domain,
               CASE WHEN c_custkey % 20 < 10 THEN 'ghost' WHEN c_custkey % 20 < 14 THEN 'power_solo'
                    WHEN c_custkey % 20 < 17 THEN 'skeptic_exec' ELSE 'champion' END AS archetype,
               (c_custkey * 37) % 500 + 1 AS employees,
               ['free', 'pro', 'team', 'enterprise'][{_PLAN_NO}] AS starting_plan,
               CAST(c_custkey AS VARCHAR) AS hubspot_company_id,
               ['free', 'pro', 'team', 'enterprise'][{_PLAN_NO}] AS current_plan,
               CASE WHEN c_custkey % 13 = 0 THEN 'canceled' ELSE 'active' END AS status
        FROM customer"""
CTES["usage_state"] = f"""
        SELECT s.hubspot_company_id, s.company_name, s.subscription_id, s.plan_name, s.subscription_status,
               coalesce(c, 0) AS credits_30d, coalesce(u, 0) AS active_users, 1 + coalesce(i, 0) AS seats, t AS last_used_on
        FROM account_sub s LEFT JOIN (
            SELECT hubspot_company_id, CAST(sum(total_credits_used) FILTER (usage_date >= {DAY} - 30) AS BIGINT) AS c,
                   CAST(sum(teammates_invited) AS BIGINT) AS i, max(usage_date) AS t
            FROM daily GROUP BY 1
        ) d USING (hubspot_company_id) LEFT JOIN (
            SELECT hubspot_company_id, count(DISTINCT user_email) AS u
            FROM account JOIN usage_log ON account_domain = company_domain
            WHERE CAST(occurred_at AS DATE) >= {DAY} - 30 GROUP BY 1
        ) e USING (hubspot_company_id)"""


def _sql(body: str) -> str:
    """The body with the CTEs it needs, in order of use."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z_]+\b", re.sub(r"'[^']*'", "", text)):
            if name in CTES and name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    return f"WITH {head}\n{body}" if needed else body


def _all(cte: str) -> str:
    return f"SELECT * FROM {cte}"


_STAGED = {
    "companies": "company_id company_name domain employees created_at",
    "contacts": "contact_id email email_domain first_name last_name company_name created_at updated_at",
    "deals": "deal_id deal_name deal_stage pipeline amount close_date created_at updated_at",
    "customers": "customer_id customer_name email hubspot_company_id created_at",
    "subscriptions": "subscription_id customer_id subscription_status currency price_id monthly_amount_usd "
    "quantity current_period_start current_period_end created_at canceled_at ended_at cancel_at_period_end",
    "invoices": "invoice_id customer_id subscription_id payment_status amount_due_usd amount_paid_usd "
    "currency created_at",
    "usage_events": "event_id event_type account_domain user_email credits_used occurred_at ingested_at",
}
_STAGED_CTE = {"customers": "billing", "subscriptions": "subs", "usage_events": "usage_log"}


def _profile() -> str:
    parts = []
    for name, columns in _STAGED.items():
        source = _STAGED_CTE.get(name, name)
        names = columns.split()
        if name != "usage_events":
            names.append("extracted_at")
        for c in names:
            counted = "count(*)" if c == "extracted_at" else f"count({c})"
            parts.append(
                f"SELECT 'stg_{name}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, "
                f"{counted} AS non_null_rows FROM {source}"
            )
    return "\nUNION ALL ".join(parts)


_LANDED = {
    "raw_hubspot_companies": "companies",
    "raw_hubspot_contacts": "contacts",
    "raw_hubspot_deals": "deals",
    "raw_stripe_customers": "billing",
    "raw_stripe_subscriptions": "subs",
    "raw_stripe_invoices": "invoices",
}
_KEYS = {"companies": "company_id", "contacts": "contact_id", "deals": "deal_id", "billing": "customer_id",
         "subs": "subscription_id", "invoices": "invoice_id"}

_BODIES: dict[str, str] = {
    "land_raw_objects": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, TIMESTAMP '2024-01-31 05:00:00' AS extracted_at, count(*) AS objects, "
        f"count(DISTINCT {_KEYS[c]}) AS ids, count(*) AS documents FROM {c}"
        for t, c in _LANDED.items()
    ),
    "append_usage_events": """
        SELECT CAST(occurred_at AS DATE) AS occurred_date, count(*) AS events,
               count(DISTINCT event_id) AS ids, CAST(sum(credits_used) AS BIGINT) AS credits
        FROM usage_log GROUP BY 1""",
    # Landed as sent, before staging lowers the names.
    "load_usage_backfill": """
        SELECT * REPLACE ('C' || substr(account_domain, 2) AS account_domain,
                          'U' || substr(user_email, 2) AS user_email) FROM usage_log""",
    "seed_plans": """
        SELECT p.*, count(s.price_id) AS subscriptions
        FROM plans p LEFT JOIN subs s USING (price_id) GROUP BY ALL""",
    "materialise_layer": "SELECT hubspot_company_id AS company_id, company_name, health_status FROM health",
    "scan_overview": "SELECT hubspot_company_id, company_name, plan_name, account_segment FROM overview",
    "scan_pqls": _all("leads"),
    **{
        f"stg_{name}": f"SELECT {', '.join(columns.split())} FROM {_STAGED_CTE.get(name, name)}"
        for name, columns in _STAGED.items()
    },
    "account_identity": _all("account"),
    "account_daily_usage": _all("daily"),
    "account_subscription": _all("account_sub"),
    "scd2_snapshot_apply": _all("stored_history"),
    "scd2_from_daily_states": _all("history_a"),
    "scd2_from_daily_states_with_deletes": _all("deleted_history"),
    "scd2_as_of": """
        SELECT * FROM history_a WHERE dbt_valid_from <= TIMESTAMP '1998-06-15'
           AND coalesce(dbt_valid_to, TIMESTAMP '9999-01-01') > TIMESTAMP '1998-06-15'""",
    "scd2_as_of_join": """
        SELECT i.invoice_id, i.subscription_id, i.billed_at, h.plan_name AS version_plan_name,
               h.monthly_amount_usd AS version_monthly_amount_usd, h.is_active AS version_is_active,
               h.dbt_valid_from, h.dbt_valid_to
        FROM (SELECT invoice_id, subscription_id, created_at + INTERVAL 20 DAY AS billed_at FROM invoices) i
        ASOF LEFT JOIN history_a h
          ON i.subscription_id = h.subscription_id AND i.billed_at >= h.dbt_valid_from""",
    "usage_two_windows": _all("two_windows"),
    "account_health": _all("health"),
    "health_reason": """
        SELECT hubspot_company_id, credits_recent, credits_previous, health_status,
               CASE WHEN credits_recent = 0 THEN 'silent' WHEN health_status = 'red' THEN 'dropped by more than half'
                    WHEN health_status = 'yellow' THEN 'dropped by more than a quarter' ELSE 'steady' END AS health_reason
        FROM health""",
    "recent_usage_14d": _all("recent"),
    "pql_signals": _all("signals"),
    "product_qualified_leads": "SELECT * FROM leads ORDER BY signal_count DESC, credits_used_14d DESC",
    "subscription_versions_with_prev": _all("prev_a"),
    "subscription_starts": _all("starts_a"),
    "price_changes_classified": _all("changes_a"),
    "cancellations": _all("cancels_a"),
    "week_spine": _all("spine_a"),
    "weekly_movement_totals": _all("weekly_a"),
    "ending_mrr_running": "SELECT week_start, net_mrr_change, ending_mrr FROM revenue_b",
    "revenue_movements": _all("revenue_a"),
    "revenue_movements_by_run": _all("revenue_s"),
    "revenue_chart": """
        SELECT week_start, new_mrr, expansion_mrr, 0.0 - contraction_mrr AS contraction_bar,
               0.0 - churned_mrr AS churned_bar, net_mrr_change, ending_mrr
        FROM revenue_b ORDER BY week_start""",
    "revenue_reconciles": """
        SELECT ending_mrr, total_mrr, ending_mrr - total_mrr AS gap, history FROM (
            SELECT (SELECT arg_max(ending_mrr, week_start) FROM revenue_a) AS ending_mrr, total_mrr,
                   'reactivations' AS history FROM active_a
            UNION ALL
            SELECT (SELECT arg_max(ending_mrr, week_start) FROM revenue_b), total_mrr, 'plain' FROM active_b
        ) WHERE ending_mrr <> total_mrr""",
    "churn_at_peak_mrr": """
        SELECT c.subscription_id, c.week_start, c.amount AS churned_mrr, c.peak AS churned_mrr_at_peak
        FROM (
            SELECT *, max(monthly_amount_usd) OVER (PARTITION BY subscription_id ORDER BY dbt_valid_from) AS peak,
                   CAST(date_trunc('week', coalesce(canceled_at, dbt_valid_from)) AS DATE) AS week_start,
                   monthly_amount_usd AS amount
            FROM prev_a
        ) c WHERE c.previous_is_active AND NOT c.is_active AND c.amount > 0""",
    "hard_delete_churn": """
        SELECT subscription_id, CAST(date_trunc('week', dbt_valid_to) AS DATE) AS week_start,
               monthly_amount_usd AS churned_mrr
        FROM deleted_history d
        WHERE is_active AND monthly_amount_usd > 0 AND dbt_valid_to IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM deleted_history n
                          WHERE n.subscription_id = d.subscription_id AND n.dbt_valid_from = d.dbt_valid_to)""",
    "usage_windows": _all("windows"),
    "lifetime_revenue": _all("cash"),
    "primary_contact": _all("main_contact"),
    "account_overview": _all("overview"),
    "account_limits_usage": """
        SELECT hubspot_company_id, credit_usage_pct, seat_usage_pct, tenure_days, days_since_last_active
        FROM overview""",
    "account_segment": "SELECT hubspot_company_id, account_segment FROM overview",
    "company_property_payload": _all("payload"),
    "payload_batches": """
        SELECT n // 100 AS batch_no, count(*) AS size,
               '[' || string_agg('{"id":"' || id || '","properties":' || properties || '}', ',' ORDER BY n) || ']' AS inputs
        FROM (SELECT *, row_number() OVER (ORDER BY substr(md5(id || properties || '1'), 1, 3), id) - 1 AS n FROM payload)
        GROUP BY 1""",
    "new_pql_deals": """
        SELECT company_name || ' - Enterprise (PQL)' AS dealname, 'appointmentscheduled' AS dealstage,
               CASE WHEN total_employees >= 250 THEN '24000.0' WHEN total_employees >= 100 THEN '18000.0'
                    ELSE '12000.0' END AS amount,
               hubspot_company_id AS revlattice_company_id, CAST(signal_count AS VARCHAR) AS revlattice_pql_signals,
               coalesce(CAST(credit_usage_pct AS VARCHAR), '') AS revlattice_credit_usage_pct,
               CAST(active_users AS VARCHAR) AS revlattice_active_users
        FROM leads WHERE hubspot_company_id NOT IN (SELECT deal_company FROM deals WHERE deal_company IS NOT NULL)""",
    "deal_associations": """
        SELECT 'deals' AS from_object_type, company_name || ' - Enterprise (PQL)' AS dealname,
               'companies' AS to_object_type, hubspot_company_id AS to_object_id
        FROM leads WHERE hubspot_company_id NOT IN (SELECT deal_company FROM deals WHERE deal_company IS NOT NULL)""",
    "deal_follow_up": """
        SELECT 'close' AS action, deal_id, deal_company AS hubspot_company_id FROM deals
        WHERE deal_company IS NOT NULL AND deal_stage NOT IN ('closedwon', 'closedlost')
          AND deal_company NOT IN (SELECT hubspot_company_id FROM leads)
        UNION ALL
        SELECT 'open anew', NULL, deal_company FROM deals
        WHERE deal_company IN (SELECT hubspot_company_id FROM leads)
        GROUP BY deal_company HAVING count(*) = count(*) FILTER (deal_stage = 'closedlost')""",
    "deal_value_estimate": """
        SELECT company_id, employees, CAST(12000 + 6000 * (CAST(employees >= 100 AS INTEGER)
               + CAST(employees >= 250 AS INTEGER)) AS DOUBLE) AS deal_value_usd FROM companies""",
    "deal_sync_counts": """
        SELECT CASE WHEN hubspot_company_id IN (SELECT deal_company FROM deals WHERE deal_company IS NOT NULL)
                    THEN 'deal already existed' ELSE 'deal created' END AS action, count(*) AS records
        FROM leads GROUP BY 1
        UNION ALL SELECT 'company updated', count(*) FROM overview""",
    "null_profile": _profile(),
    "key_uniqueness": """
        SELECT 'account_subscription' AS table_name, hubspot_company_id AS key_value, count(*) AS copies
        FROM account_sub GROUP BY ALL HAVING count(*) > 1
        UNION ALL
        SELECT 'account_subscription', subscription_id, count(*) FROM account_sub
        WHERE subscription_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1
        UNION ALL
        SELECT 'stg_invoices', customer_id, count(*) FROM invoices GROUP BY ALL HAVING count(*) > 1""",
    "name_collisions": """
        SELECT name, companies, coalesce(payers, 0) AS customers, companies * coalesce(payers, 0) AS pairs
        FROM (SELECT c_mktsegment AS name, count(*) AS companies FROM customer GROUP BY 1)
        LEFT JOIN (SELECT c_mktsegment AS name, count(*) AS payers FROM customer WHERE c_acctbal > 0 GROUP BY 1) USING (name)
        WHERE companies > 1 OR payers > 1""",
    "unattributed_and_late_events": """
        SELECT count(*) AS events, count(*) - count(account_domain) AS without_domain,
               count(*) FILTER (ingested_at >= occurred_at + INTERVAL 1 DAY) AS late,
               round((count(*) - count(account_domain)) / count(*) * 100, 1) AS without_domain_pct,
               round(count(*) FILTER (ingested_at >= occurred_at + INTERVAL 1 DAY) / count(*) * 100, 1) AS late_pct,
               CAST(max((epoch_us(ingested_at) - epoch_us(occurred_at)) // 1000000) AS BIGINT) AS max_delay_seconds
        FROM usage_log""",
    "validate_against_answer_key": """
        SELECT k.archetype, o.health_status, o.is_pql, count(*) AS accounts
        FROM overview o JOIN answer_key k USING (hubspot_company_id) GROUP BY ALL""",
    "match_type_coverage": "SELECT match_type, count(*) AS accounts FROM account GROUP BY 1",
    "orphan_billing": """
        SELECT customer_id, CAST(sum(s) AS BIGINT) AS subscriptions, CAST(sum(i) AS BIGINT) AS invoices,
               round(sum(usd), 2) AS invoiced_usd
        FROM (SELECT customer_id, 1 AS s, 0 AS i, 0.0 AS usd FROM subs
              UNION ALL SELECT customer_id, 0, 1, amount_due_usd FROM invoices)
        WHERE customer_id NOT IN (SELECT customer_id FROM billing) GROUP BY 1""",
    "event_type_counts": "SELECT event_type, count(*) AS events FROM usage_log GROUP BY 1",
    "duplicate_contacts": """
        SELECT email_domain, replace(split_part(email, '@', 1), '.', '') AS local_part,
               count(DISTINCT email) AS addresses, min(email) AS first_email, max(email) AS last_email
        FROM contacts GROUP BY 1, 2 HAVING count(DISTINCT email) > 1""",
    "domain_from_name_check": """
        SELECT * FROM (SELECT company_id, company_name, domain,
               substr(regexp_replace(lower(company_name), '[^a-z0-9]', '', 'g'), 1, 24) || '.com' AS expected_domain
        FROM companies) WHERE domain <> expected_domain""",
    "account_usage_state": _all("usage_state"),
    "plan_pressure": """
        SELECT hubspot_company_id, subscription_id, u.plan_name, credits_30d, seats, ratio AS credit_ratio, pushing AS is_pushing,
               CASE WHEN pushing THEN map {'free': 'pro', 'pro': 'team'}[u.plan_name] END AS next_plan,
               quiet AS is_quiet,
               CASE WHEN quiet THEN map {'enterprise': 'team', 'team': 'pro', 'pro': 'free'}[u.plan_name] END AS lower_plan
        FROM (SELECT u.*, credits_30d / monthly_credits AS ratio, credits_30d / monthly_credits >= 0.8 OR seats > seat_limit AS pushing,
                     u.plan_name <> 'free' AND credits_30d / monthly_credits < 0.15 AS quiet
              FROM usage_state u LEFT JOIN plans p ON p.plan_name = u.plan_name) u""",
    "kpi_cards": """
        SELECT sum(current_mrr_usd) AS mrr_usd, sum(annual_run_rate_usd) AS arr_usd,
               count(*) FILTER (is_active AND monthly_amount_usd > 0) AS active_paying_accounts,
               count(*) FILTER (is_pql) AS pqls, count(*) FILTER (account_segment = 'at risk') AS accounts_at_risk
        FROM overview""",
    "segment_summary": "SELECT account_segment, count(*) AS accounts, sum(current_mrr_usd) AS current_mrr_usd FROM overview GROUP BY 1",
    "plan_summary": "SELECT plan_name, count(*) AS accounts, sum(current_mrr_usd) AS current_mrr_usd FROM overview GROUP BY 1",
    "account_filter": f"""
        SELECT hubspot_company_id, company_name, company_domain, plan_name, health_status, account_segment,
               is_pql, current_mrr_usd, credit_usage_pct, contact_email, last_active_date, days_since_last_active
        FROM overview
        WHERE company_name ILIKE '%customer#%' AND plan_name = 'pro' AND last_active_date >= {DAY} - 14""",
    "usage_chart_30d": f"""
        SELECT g.hubspot_company_id, g.usage_date, coalesce(d.total_credits_used, 0) AS credits,
               coalesce(d.prompt_runs, 0) AS prompt_runs, coalesce(d.sessions, 0) AS sessions
        FROM (SELECT hubspot_company_id, {DAY} - CAST(n AS INTEGER) AS usage_date FROM account, range(30) r(n)) g
        LEFT JOIN daily d USING (hubspot_company_id, usage_date)""",
    "incremental_daily_usage": _all("daily"),
    "streaming_daily_usage": """
        SELECT account_domain, CAST(occurred_at AS DATE) AS usage_date,
               CAST(sum(credits_used) AS BIGINT) AS total_credits_used,
               count(*) FILTER (event_type = 'session_started') AS sessions,
               count(*) FILTER (event_type = 'prompt_run') AS prompt_runs,
               count(*) FILTER (event_type = 'project_created') AS projects_created,
               count(*) FILTER (event_type = 'teammate_invited') AS teammates_invited,
               count(*) FILTER (event_type = 'project_published') AS projects_published,
               count(*) AS total_events
        FROM usage_log
        WHERE account_domain IS NOT NULL GROUP BY 1, 2""",
    "account_detail": f"""
        SELECT * FROM (WITH days AS (
            SELECT g.hubspot_company_id, g.usage_date, coalesce(d.total_credits_used, 0) AS credits,
                   coalesce(d.prompt_runs, 0) AS prompt_runs, coalesce(d.sessions, 0) AS sessions
            FROM (SELECT DISTINCT hubspot_company_id, {DAY} - CAST(n AS INTEGER) AS usage_date FROM account, range(30) r(n)) g
            LEFT JOIN daily d USING (hubspot_company_id, usage_date)),
        series AS (
            SELECT hubspot_company_id, '[' || string_agg('{{"usage_date":"' || usage_date || '","credits":' || credits
                   || ',"prompt_runs":' || prompt_runs || ',"sessions":' || sessions || ',"is_partial":'
                   || CASE WHEN usage_date = {DAY} THEN 'true' ELSE 'false' END || '}}', ',' ORDER BY usage_date) || ']' AS daily
            FROM days GROUP BY 1)
        SELECT hubspot_company_id, company_name, health_status, plan_name, current_mrr_usd, account_segment,
               contact_name, contact_email, seat_limit, seat_usage_pct, monthly_credits, credit_usage_pct,
               is_pql, pql_signal_count, credits_used_14d, active_users_14d, sessions_14d, last_active_date,
               days_since_last_active, monthly_amount_usd, annual_run_rate_usd, lifetime_revenue_usd, invoices_paid,
               tenure_days, company_domain, total_employees, customer_id, billing_match_type, daily
        FROM overview LEFT JOIN series USING (hubspot_company_id))""",
    "identity_normalised_name": _all("account"),
    "health_low_usage_rule": """
        SELECT hubspot_company_id, plan_name, health_status, credits_used_30d, monthly_credits,
               credits_used_30d / monthly_credits < 0.15 AS low_usage,
               CASE WHEN health_status = 'green' AND credits_used_30d / monthly_credits < 0.15 THEN 'yellow'
                    ELSE health_status END AS health_with_low_usage
        FROM overview WHERE health_status <> 'not_scored'""",
    "active_users_exact_14d": f"""
        SELECT a.hubspot_company_id, u.account_domain, count(DISTINCT u.user_email) AS active_users_14d_exact
        FROM account a JOIN usage_log u ON u.account_domain = a.company_domain
        WHERE CAST(u.occurred_at AS DATE) >= {DAY} - 14 GROUP BY 1, 2""",
    "active_users_by_window": f"""
        SELECT a.hubspot_company_id, u.account_domain, CAST(n AS INTEGER) AS window_days, count(DISTINCT u.user_email) AS active_users
        FROM account a JOIN usage_log u ON u.account_domain = a.company_domain, (VALUES (7), (14), (30)) w(n)
        WHERE CAST(u.occurred_at AS DATE) >= {DAY} - CAST(n AS INTEGER) GROUP BY 1, 2, 3""",
    "equal_health_windows": f"""
        SELECT s.hubspot_company_id, s.company_name, s.plan_name, s.monthly_amount_usd, s.subscription_status, s.is_active,
               r AS credits_recent, p AS credits_previous,
               CASE WHEN r = 0 OR r * 2 < p THEN 'red' WHEN r * 4 < p * 3 THEN 'yellow' ELSE 'green' END AS health_status
        FROM account_sub s LEFT JOIN (
            SELECT hubspot_company_id,
                   sum(total_credits_used) FILTER (usage_date BETWEEN {DAY} - 13 AND {DAY}) AS w0,
                   sum(total_credits_used) FILTER (usage_date BETWEEN {DAY} - 27 AND {DAY} - 14) AS w1
            FROM daily GROUP BY 1) w USING (hubspot_company_id),
        LATERAL (SELECT CAST(coalesce(w0, 0) AS BIGINT) AS r, CAST(coalesce(w1, 0) AS BIGINT) AS p) v
        WHERE s.is_active AND s.plan_name <> 'free'""",
    "dq_unattributed_report": """
        SELECT CAST(occurred_at AS DATE) AS usage_date, event_type, count(*) AS events,
               count(*) FILTER (account_domain IS NULL) AS without_domain,
               CAST(sum(credits_used) FILTER (account_domain IS NULL) AS BIGINT) AS credits_without_domain
        FROM usage_log GROUP BY 1, 2 HAVING count(*) > count(account_domain)""",
    "deal_funnel": "SELECT deal_stage, count(*) AS deals, sum(amount) AS amount FROM deals GROUP BY 1",
    "short_history_flag": """
        SELECT hubspot_company_id, health_status, tenure_days, tenure_days < 28 AS short_history
        FROM overview WHERE health_status <> 'not_scored'""",
    "failed_payment_signal": """
        SELECT s.hubspot_company_id, s.plan_name, count(i.invoice_id) AS unpaid_invoices,
               round(coalesce(sum(i.amount_due_usd), 0.0), 2) AS unpaid_usd, count(i.invoice_id) > 0 AS has_failed_payment
        FROM account_sub s LEFT JOIN invoices i
          ON i.customer_id = s.customer_id AND i.payment_status = 'open' AND i.amount_due_usd > 0
        WHERE s.is_active AND s.plan_name <> 'free' GROUP BY 1, 2""",
}

ORACLE: dict[str, str] = {name: _sql(body) for name, body in _BODIES.items()}
