"""The registered queries in DuckDB's SQL, written from the models' definitions and not from their Spark code."""

from __future__ import annotations

import re

from tidemark.sources import seeds, star

NOW = "DATE '2001-11-05'"
PARTS: dict[str, str] = {f"raw_{e}": star.sql(e, "duckdb") for e in star.ENTITIES}
for _e, _k in star.KEYS.items():
    PARTS[f"now_{_e}"] = f"SELECT * FROM (SELECT * FROM raw_{_e} QUALIFY row_number() OVER (PARTITION BY {_k} ORDER BY _version DESC, _lsn DESC) = 1) WHERE _is_deleted = 0"


def _div(n: str, d: str) -> str:
    return f"CASE WHEN {d} <> 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END"


def _days(later: str, earlier: str) -> str:
    return f"CAST(date_diff('day', {earlier}, {later}) AS INTEGER)"


def _bucket(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} <= 0 THEN 'Current' WHEN {x} <= 30 THEN 'PAR 1-30' WHEN {x} <= 60 THEN 'PAR 31-60' WHEN {x} <= 90 THEN 'PAR 61-90' WHEN {x} <= 180 THEN 'PAR 91-180' ELSE 'PAR 180+' END"


def _key(*columns: str) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in columns)
    return f"CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT)"


def _mean(x: str, where: str = "") -> str:
    """Of exact amounts: the sum is exact, and only the last step a double."""
    f = f" FILTER ({where})" if where else ""
    return f"CAST(sum({x}){f} AS DOUBLE) / nullif(count({x}){f}, 0)"


_META = "source_ingested_at, source_updated_at, _source_commit_at AS cdc_commit_at, _version AS cdc_version"
_money = lambda names: ", ".join(f"coalesce({n}, 0) AS {n}" for n in names.split())
_zero = lambda alias, names: ", ".join(f"coalesce({alias}.{n}, 0) AS {n}" for n in names.split())

_LOAN_KINDS = {"active_loans": "is_active = 1", "closed_loans": "is_closed = 1", "written_off_loans": "is_written_off = 1", "delinquent_loans": "days_past_due > 0", "defaulted_loans": "is_in_default = 1"}
_LIFETIME = {"lifetime_disbursed": "principal_disbursed", "lifetime_repaid": "total_repayment", "lifetime_written_off": "principal_written_off", "total_savings_balance": "account_balance", "lifetime_deposits": "total_deposits", "lifetime_withdrawals": "total_withdrawals"}
_TAKEN = "total_loans active_loans closed_loans written_off_loans delinquent_loans lifetime_disbursed lifetime_repaid current_total_outstanding current_total_overdue total_savings_balance active_savings_accounts is_repeat_borrower is_multi_product_client current_worst_days_past_due".split()

PARTS |= {
    "stg_clients": f"""SELECT client_id, account_no, external_id, status_id, status_value AS status, coalesce(is_active, 0) AS is_active, activation_date, submitted_on_date, closed_on_date, date_of_birth, office_id, office_name, staff_id,
        legal_form_value AS legal_form, gender_value AS gender, client_type_value AS client_type, client_classification_value AS client_classification, display_name, firstname, lastname, mobile_no, email_address, staff_name AS loan_officer_name, {_META}, {_key("client_id")} AS client_key,
        CAST(date_diff('year', date_of_birth, {NOW}) AS INTEGER) AS age_years, {_days(NOW, "activation_date")} AS tenure_days, CAST(date_diff('month', activation_date, {NOW}) AS INTEGER) AS tenure_months FROM now_clients""",
    "stg_loans": f"""SELECT *, {_bucket("days_past_due")} AS par_bucket, CASE WHEN days_past_due > 90 THEN 1 ELSE 0 END AS is_in_default, {_div("principal_paid", "principal_disbursed")} AS principal_repaid_ratio,
        {_div("total_repayment", "total_expected_repayment")} AS repayment_progress_ratio, {_days(NOW, "disbursed_on_date")} AS days_since_disbursement, {_days("expected_maturity_date", "disbursed_on_date")} AS term_days FROM (
        SELECT loan_id, account_no, client_id, product_id, office_id, loan_officer_id, loan_type, currency_code, status_id, status_value AS status, coalesce(is_active, 0) AS is_active, coalesce(is_closed, 0) AS is_closed, coalesce(is_overpaid, 0) AS is_overpaid,
        CASE WHEN status_id = 601 THEN 1 ELSE 0 END AS is_written_off, submitted_on_date, approved_on_date, disbursed_on_date, expected_maturity_date, closed_on_date, overdue_since_date, number_of_repayments, repayment_frequency_type, interest_rate_per_period, annual_interest_rate, {_META}, {_key("loan_id")} AS loan_key,
        {_money("principal approved_principal principal_disbursed principal_paid principal_written_off principal_outstanding principal_overdue interest_charged interest_paid interest_outstanding fee_charges_charged fee_charges_paid penalty_charges_charged total_expected_repayment total_repayment total_outstanding total_overdue delinquent_amount")},
        CASE WHEN delinquent_days > 0 THEN delinquent_days WHEN overdue_since_date IS NOT NULL THEN {_days(NOW, "overdue_since_date")} ELSE 0 END AS days_past_due FROM now_loans)""",
    "stg_tx": f"""SELECT transaction_id, loan_id, office_id, type_id, type_value, submitted_on_date, source_ingested_at, _source_commit_at AS cdc_commit_at, coalesce(is_reversed, 0) AS is_reversed, transaction_date, currency_code, _version AS cdc_version, {_money("amount principal_portion interest_portion fee_charges_portion penalty_charges_portion overpayment_portion outstanding_loan_balance")},
        CASE type_id WHEN 1 THEN 'disbursement' WHEN 2 THEN 'repayment' WHEN 4 THEN 'accrual' WHEN 5 THEN 'waive_interest' WHEN 6 THEN 'write_off' WHEN 7 THEN 'recovery_repayment' WHEN 8 THEN 'waive_charges' WHEN 9 THEN 'charge_payment' WHEN 10 THEN 'refund' ELSE 'other' END AS transaction_category,
        CASE WHEN is_reversed = 1 THEN 0 ELSE 1 END AS is_countable, CAST(year(transaction_date) AS INTEGER) AS transaction_year, CAST(month(transaction_date) AS INTEGER) AS transaction_month, CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month_start,
        CAST(isodow(transaction_date) AS INTEGER) AS transaction_day_of_week FROM now_loan_transactions""",
    "stg_offices": f"""SELECT office_id, name AS office_name, name_decorated AS office_name_decorated, external_id, {_META}, {_key("office_id")} AS office_key, parent_id AS parent_office_id, parent_name AS parent_office_name, hierarchy, CAST(greatest(length(hierarchy) - length(replace(hierarchy, '.', '')) - 1, 0) AS INTEGER) AS hierarchy_depth,
        CASE WHEN parent_id IS NULL THEN 1 ELSE 0 END AS is_head_office, opening_date, {_days(NOW, "opening_date")} AS days_open FROM now_offices""",
    "stg_staff": f"SELECT staff_id, display_name AS staff_name, firstname, lastname, office_name, mobile_no, {_META}, {_key('staff_id')} AS staff_key, office_id, coalesce(is_loan_officer, 0) AS is_loan_officer, coalesce(is_active, 0) AS is_active, joining_date, {_days(NOW, 'joining_date')} AS tenure_days FROM now_staff",
    "stg_products": f"SELECT currency_code, number_of_repayments AS default_number_of_repayments, annual_interest_rate, start_date, close_date, {_META}, {_key('product_id')} AS product_key, product_id, name AS product_name, short_name AS product_short_name, principal AS default_principal, min_principal, max_principal, status AS product_status, CASE WHEN status = 'loanProduct.active' THEN 1 ELSE 0 END AS is_active FROM now_loan_products",
    "stg_sproducts": f"SELECT product_id, name AS product_name, short_name AS product_short_name, currency_code, nominal_annual_interest_rate, interest_posting_period_type, status AS product_status, {_META}, {_key('product_id')} AS product_key FROM now_savings_products",
    "stg_savings": f"""SELECT field_officer_id, client_name, status_id, currency_code, closed_on_date, nominal_annual_interest_rate, {_META}, {_key("savings_id")} AS savings_key, savings_id, account_no, client_id, product_id, office_id, status_value AS status, coalesce(is_active, 0) AS is_active, submitted_on_date, activated_on_date, {_money("account_balance available_balance total_deposits total_withdrawals total_interest_posted")},
        {_div("total_withdrawals", "total_deposits")} AS withdrawal_ratio, {_days(NOW, "activated_on_date")} AS days_since_activation FROM now_savings_accounts""",
    "paid": "SELECT * FROM stg_tx WHERE transaction_category = 'repayment' AND is_countable = 1",
    "rep": f"""SELECT loan_id, count(*) AS repayment_count, sum(amount) AS total_repaid, sum(principal_portion) AS principal_repaid, sum(interest_portion) AS interest_repaid, sum(fee_charges_portion) AS fees_repaid, sum(penalty_charges_portion) AS penalties_repaid,
        min(transaction_date) AS first_repayment_date, max(transaction_date) AS last_repayment_date, {_mean("amount")} AS avg_repayment_amount, stddev_pop(CAST(amount AS DOUBLE)) AS stddev_repayment_amount, median(CAST(amount AS DOUBLE)) AS median_repayment_amount,
        max(amount) AS max_repayment_amount, count(DISTINCT transaction_month_start) AS active_repayment_months FROM paid GROUP BY loan_id""",
    "dis": "SELECT loan_id, count(*) AS disbursement_count, sum(amount) AS total_disbursed, min(transaction_date) AS first_disbursement_date, max(transaction_date) AS last_disbursement_date FROM stg_tx WHERE transaction_category = 'disbursement' AND is_countable = 1 GROUP BY loan_id",
    "ano": """SELECT loan_id, count(*) FILTER (is_reversed = 1) AS reversed_transaction_count, count(*) FILTER (transaction_category = 'write_off') AS write_off_transaction_count, count(*) FILTER (transaction_category = 'waive_interest') AS interest_waiver_count,
        count(*) FILTER (transaction_category = 'recovery_repayment') AS recovery_count, count(*) AS total_transaction_count, max(transaction_date) AS last_activity_date FROM stg_tx GROUP BY loan_id""",
    "gaps": """SELECT loan_id, avg(g) AS avg_days_between_repayments, stddev_pop(g) AS stddev_days_between_repayments, max(g) AS max_days_between_repayments FROM (
        SELECT loan_id, date_diff('day', lag(transaction_date) OVER (PARTITION BY loan_id ORDER BY transaction_date), transaction_date) AS g FROM paid) WHERE g >= 0 GROUP BY loan_id""",
    "behaviour": f"""SELECT coalesce(r.loan_id, d.loan_id, a.loan_id) AS loan_id, {_zero("r", "repayment_count total_repaid principal_repaid interest_repaid fees_repaid penalties_repaid active_repayment_months")}, first_repayment_date, last_repayment_date, avg_repayment_amount, stddev_repayment_amount,
        median_repayment_amount, max_repayment_amount, {_zero("d", "disbursement_count total_disbursed")}, first_disbursement_date, last_disbursement_date, {_zero("a", "reversed_transaction_count write_off_transaction_count interest_waiver_count recovery_count total_transaction_count")}, last_activity_date,
        {_days(NOW, "last_activity_date")} AS days_since_last_activity, avg_days_between_repayments, stddev_days_between_repayments, max_days_between_repayments, {_div("stddev_days_between_repayments", "avg_days_between_repayments")} AS repayment_regularity_cv
        FROM rep r FULL JOIN dis d ON r.loan_id = d.loan_id FULL JOIN ano a ON coalesce(r.loan_id, d.loan_id) = a.loan_id LEFT JOIN gaps i ON coalesce(r.loan_id, d.loan_id, a.loan_id) = i.loan_id""",
    "held": """SELECT client_id, loan_id, NULL AS savings_id, is_active, is_closed, is_written_off, days_past_due, is_in_default, product_id, principal, principal_disbursed, principal_outstanding, principal_written_off, total_repayment, total_outstanding, total_overdue, disbursed_on_date, closed_on_date,
        NULL AS account_balance, NULL AS total_deposits, NULL AS total_withdrawals, NULL AS activated_on_date FROM stg_loans
        UNION ALL BY NAME SELECT client_id, savings_id, is_active, account_balance, total_deposits, total_withdrawals, activated_on_date FROM stg_savings""",
    "summed": f"""SELECT client_id, count(loan_id) AS total_loans, count(savings_id) AS total_savings_accounts, {", ".join(f"count(loan_id) FILTER ({w}) AS {n}" for n, w in _LOAN_KINDS.items())}, count(savings_id) FILTER (is_active = 1) AS active_savings_accounts,
        {", ".join(f"coalesce(sum({x}), 0) AS {n}" for n, x in _LIFETIME.items())}, {", ".join(f"coalesce(sum({x}) FILTER (loan_id IS NOT NULL AND is_active = 1), 0) AS current_{x}" for x in ("principal_outstanding", "total_outstanding", "total_overdue"))},
        coalesce(max(days_past_due), 0) AS worst_days_past_due, coalesce(max(days_past_due) FILTER (is_active = 1), 0) AS current_worst_days_past_due, count(DISTINCT product_id) AS distinct_products_used, min(disbursed_on_date) AS first_disbursement_date,
        max(disbursed_on_date) AS latest_disbursement_date, max(closed_on_date) AS latest_closure_date, {_mean("principal")} AS avg_loan_principal, max(principal) AS max_loan_principal, min(activated_on_date) AS first_savings_date FROM held GROUP BY client_id""",
    "portfolio": f"""SELECT *, CAST(total_loans > 0 AND total_savings_accounts > 0 AS INTEGER) AS is_multi_product_client, CAST(total_loans > 1 AS INTEGER) AS is_repeat_borrower, greatest(total_loans, 1) - 1 AS prior_loan_count, {_div("written_off_loans", "total_loans")} AS historical_write_off_rate,
        {_div("lifetime_repaid", "lifetime_disbursed")} AS lifetime_repayment_ratio, CASE WHEN total_savings_accounts > 0 THEN {_div("total_savings_balance", "current_total_outstanding")} END AS savings_to_debt_ratio, {_days(NOW, "first_disbursement_date")} AS days_since_first_loan FROM summed""",
    "age_bands": "SELECT * FROM (VALUES ('18-24', -1000, 25), ('25-34', 25, 35), ('35-44', 35, 45), ('45-54', 45, 55), ('55+', 55, 1000)) b(age_band, low, high)",
    "tenure_bands": "SELECT * FROM (VALUES ('0-6 months', -100000, 6), ('6-12 months', 6, 12), ('1-2 years', 12, 24), ('2-5 years', 24, 60), ('5+ years', 60, 100000)) b(tenure_band, low, high)",
    "standing": f"""SELECT client_id, {", ".join(_TAKEN)}, historical_write_off_rate, lifetime_repayment_ratio, savings_to_debt_ratio FROM portfolio WHERE client_id IS NOT NULL UNION ALL BY NAME
        SELECT client_id, {", ".join(f"0 AS {n}" for n in _TAKEN)} FROM stg_clients ANTI JOIN portfolio USING (client_id)""",
    "dim_client": f"""SELECT * EXCLUDE (own_office, low, high, low_1, high_1), coalesce(office_name, own_office) AS shown_office, {_bucket("current_worst_days_past_due")} AS current_par_bucket,
        CASE WHEN total_loans = 0 THEN 'Prospect' WHEN active_loans = 0 THEN 'Dormant' WHEN current_worst_days_past_due > 0 THEN if(current_worst_days_past_due > 90, 'At risk', 'Watch') ELSE if(is_repeat_borrower = 1, 'Repeat - performing', 'New - performing') END AS client_segment
        FROM (SELECT c.* EXCLUDE (office_name, source_updated_at, age_band_key, tenure_key), c.office_name AS own_office, c.cdc_commit_at AS source_updated_at, s.* EXCLUDE (client_id), o.office_name, o.parent_office_name, o.hierarchy_depth AS office_depth, coalesce(a.age_band, 'Unknown') AS age_band,
        coalesce(t.tenure_band, 'Unknown') AS tenure_band, a.low, a.high, t.low AS low_1, t.high AS high_1 FROM (SELECT *, age_years AS age_band_key, tenure_months AS tenure_key FROM stg_clients) c JOIN standing s USING (client_id) LEFT JOIN stg_offices o USING (office_id)
        LEFT JOIN age_bands a ON age_band_key >= a.low AND age_band_key < a.high LEFT JOIN tenure_bands t ON tenure_key >= t.low AND tenure_key < t.high)""",
    "fct_loan": f"""SELECT l.* EXCLUDE (source_updated_at, source_ingested_at, cdc_commit_at, cdc_version), l.cdc_commit_at AS source_updated_at, CAST(strftime(disbursed_on_date, '%Y%m%d') AS INTEGER) AS disbursement_date_key, c.client_segment, c.client_classification, c.gender, c.legal_form, c.age_band, c.tenure_band, {_days("l.approved_on_date", "l.submitted_on_date")} AS days_to_approval,
        {_days("l.disbursed_on_date", "l.approved_on_date")} AS days_to_disbursement, CASE WHEN days_past_due > 30 THEN l.total_outstanding ELSE 0 END AS par30_exposure, CASE WHEN days_past_due > 90 THEN l.total_outstanding ELSE 0 END AS par90_exposure,
        {_zero("b", "repayment_count reversed_transaction_count")}, coalesce(b.total_repaid, 0) AS ledger_total_repaid, b.avg_repayment_amount, b.first_repayment_date, b.last_repayment_date, b.days_since_last_activity, b.avg_days_between_repayments, b.repayment_regularity_cv,
        {_div("l.total_overdue", "l.total_outstanding")} AS overdue_ratio, l.total_repayment - coalesce(b.total_repaid, 0) AS repayment_reconciliation_delta FROM stg_loans l LEFT JOIN behaviour b ON l.loan_id = b.loan_id LEFT JOIN dim_client c ON l.client_id = c.client_id""",
    "fct_tx": f"""SELECT t.type_value, t.submitted_on_date, t.cdc_commit_at AS source_updated_at, t.transaction_id, t.loan_id, l.client_id, l.product_id, coalesce(t.office_id, l.office_id) AS office_id, l.loan_officer_id, CAST(strftime(t.transaction_date, '%Y%m%d') AS INTEGER) AS transaction_date_key, t.transaction_date, t.transaction_month_start, t.transaction_year, t.transaction_month,
        t.transaction_day_of_week, t.type_id, t.transaction_category, t.is_reversed, t.is_countable, t.currency_code, l.status AS loan_status, l.par_bucket AS loan_par_bucket_now, t.outstanding_loan_balance, t.amount AS amount_including_reversals,
        {", ".join(f"CASE WHEN t.is_countable = 1 THEN t.{m} ELSE 0 END AS {m}" for m in "amount principal_portion interest_portion fee_charges_portion penalty_charges_portion overpayment_portion".split())},
        {", ".join(f"CASE WHEN t.is_countable = 1 AND t.transaction_category = '{k}' THEN t.amount ELSE 0 END AS {k}_amount" for k in ("repayment", "disbursement", "write_off"))}, {_days("t.transaction_date", "l.disbursed_on_date")} AS days_since_disbursement
        FROM stg_tx t LEFT JOIN stg_loans l ON t.loan_id = l.loan_id""",
    "disbursed": "SELECT * FROM stg_loans WHERE disbursed_on_date IS NOT NULL",
    "pairs": "SELECT n.loan_id, n.disbursed_on_date AS at, p.loan_id AS prior_id, p.principal, p.principal_disbursed, p.product_id, p.disbursed_on_date AS prior_at FROM disbursed n JOIN disbursed p ON n.client_id = p.client_id AND n.loan_id <> p.loan_id AND p.disbursed_on_date < n.disbursed_on_date",
    "pl": "SELECT loan_id, count(*) AS n, sum(principal_disbursed) AS total, max(principal) AS top, count(DISTINCT product_id) AS products, max(prior_at) AS last_at FROM pairs GROUP BY loan_id",
    "pr": "SELECT x.loan_id, count(*) AS n, sum(t.amount) AS total, CAST(sum(t.amount) AS DOUBLE) / count(*) AS mean, max(t.transaction_date) AS last_at FROM pairs x JOIN paid t ON t.loan_id = x.prior_id AND t.transaction_date < x.at GROUP BY x.loan_id",
    "default_features": f"""SELECT l.loan_id, l.client_id, l.disbursed_on_date AS observation_date, CAST(strftime(l.disbursed_on_date, '%Y%m') AS INTEGER) AS observation_month, CASE WHEN l.is_in_default = 1 OR l.is_written_off = 1 THEN 1 ELSE 0 END AS label_defaulted, l.days_past_due AS label_days_past_due,
        l.is_written_off AS label_written_off, l.principal AS feat_principal, l.number_of_repayments AS feat_number_of_repayments, l.annual_interest_rate AS feat_annual_interest_rate, l.term_days AS feat_term_days, {_div("l.principal", "l.number_of_repayments")} AS feat_installment_size,
        {_days("l.disbursed_on_date", "l.submitted_on_date")} AS feat_days_application_to_disbursement, l.product_id AS feat_product_id, p.product_name AS feat_product_name, p.default_principal AS feat_product_default_principal, {_div("l.principal", "p.default_principal")} AS feat_principal_vs_product_default,
        c.gender AS feat_gender, c.legal_form AS feat_legal_form, c.client_type AS feat_client_type, c.client_classification AS feat_client_classification, CAST(date_diff('year', c.date_of_birth, l.disbursed_on_date) AS INTEGER) AS feat_age_at_origination,
        {_days("l.disbursed_on_date", "c.activation_date")} AS feat_client_tenure_days, l.office_id AS feat_office_id, l.loan_officer_id AS feat_loan_officer_id, coalesce(pl.n, 0) AS feat_prior_loan_count, coalesce(pl.total, 0) AS feat_prior_total_disbursed, coalesce(pl.top, 0) AS feat_prior_max_principal,
        coalesce(pl.products, 0) AS feat_prior_distinct_products, {_days("l.disbursed_on_date", "pl.last_at")} AS feat_days_since_prior_loan, {_div("l.principal", "pl.top")} AS feat_principal_vs_prior_max, coalesce(pr.n, 0) AS feat_prior_repayment_count, coalesce(pr.total, 0) AS feat_prior_total_repaid,
        coalesce(pr.mean, 0) AS feat_prior_avg_repayment, CAST(0 AS BIGINT) AS feat_prior_reversal_count, {_days("l.disbursed_on_date", "pr.last_at")} AS feat_days_since_prior_repayment, CASE WHEN pl.n > 0 THEN 0 ELSE 1 END AS feat_is_first_time_borrower,
        CASE WHEN l.disbursed_on_date < {NOW} - INTERVAL 12 MONTH THEN 'train' WHEN l.disbursed_on_date < {NOW} - INTERVAL 6 MONTH THEN 'validation' ELSE 'test' END AS split_hint, CASE WHEN date_diff('day', l.disbursed_on_date, {NOW}) >= 180 THEN 1 ELSE 0 END AS is_label_mature
        FROM disbursed l LEFT JOIN stg_clients c ON l.client_id = c.client_id LEFT JOIN stg_products p ON l.product_id = p.product_id LEFT JOIN pl ON l.loan_id = pl.loan_id LEFT JOIN pr ON l.loan_id = pr.loan_id""",
    "book": f"""SELECT {{by}}, count(*) AS total_loans, count(*) FILTER (is_active = 1) AS active_loans, count(*) FILTER (is_closed = 1) AS closed_loans, count(*) FILTER (is_written_off = 1) AS written_off_loans, count(*) FILTER (days_past_due > 0) AS delinquent_loans, count(*) FILTER (days_past_due > 0 AND is_active = 1) AS active_delinquent,
        count(DISTINCT client_id) AS distinct_borrowers, coalesce(sum(principal_outstanding) FILTER (is_active = 1), 0) AS principal_outstanding, coalesce(sum(total_outstanding) FILTER (is_active = 1), 0) AS total_outstanding, coalesce(sum(total_overdue) FILTER (is_active = 1), 0) AS total_overdue,
        sum(principal_disbursed) AS lifetime_disbursed, sum(principal_written_off) AS lifetime_written_off, {_mean("principal")} AS avg_principal, median(CAST(principal AS DOUBLE)) AS median_principal, avg(CAST(days_past_due AS DOUBLE)) AS avg_days_past_due FROM stg_loans GROUP BY {{by}}""",
}
_FLOWS = {"repayment_amount": "repayment_amount", "principal_collected": "principal_portion", "interest_collected": "interest_portion", "fees_collected": "fee_charges_portion", "penalties_collected": "penalty_charges_portion", "disbursement_amount": "disbursement_amount", "write_off_amount": "write_off_amount"}
_FLOW_COUNTS = {"repayment_count": "transaction_category = 'repayment'", "disbursement_count": "transaction_category = 'disbursement'", "reversal_count": "is_reversed = 1"}
PARTS["monthly_rows"] = """SELECT 'flow' AS side, transaction_month_start AS month_start, * EXCLUDE (transaction_month_start) FROM fct_tx
        UNION ALL BY NAME SELECT 'vintage' AS side, CAST(date_trunc('month', disbursed_on_date) AS DATE) AS month_start, office_id, product_id, client_id, principal, principal_disbursed, submitted_on_date AS asked, approved_on_date, disbursed_on_date, is_in_default, is_written_off FROM disbursed"""
PARTS["monthly"] = f"""SELECT month_start, office_id, product_id, {", ".join(f"coalesce(sum({x}), 0) AS {n}" for n, x in _FLOWS.items())}, {", ".join(f"count(*) FILTER (side = 'flow' AND {w}) AS {n}" for n, w in _FLOW_COUNTS.items())}, count(DISTINCT loan_id) AS loans_with_activity,
        count(*) FILTER (side = 'vintage') AS loans_originated, coalesce(sum(principal_disbursed), 0) AS principal_originated, count(DISTINCT client_id) FILTER (side = 'vintage') AS borrowers_served, {_mean("principal")} AS avg_origination_principal, avg(date_diff('day', asked, approved_on_date)) AS avg_days_to_approval,
        avg(date_diff('day', approved_on_date, disbursed_on_date)) AS avg_days_to_disbursement, count(*) FILTER (is_in_default = 1) AS vintage_loans_in_default, count(*) FILTER (is_written_off = 1) AS vintage_loans_written_off
        FROM monthly_rows GROUP BY month_start, office_id, product_id, CASE WHEN month_start IS NULL OR office_id IS NULL OR product_id IS NULL THEN side END"""
PARTS["lately"] = f"""SELECT client_id, max(transaction_date) AS last_at, {", ".join(f"count(*) FILTER (age <= {n}) AS feat_repayments_last_{n}d, coalesce(sum(amount) FILTER (age <= {n}), 0) AS feat_repaid_last_{n}d" for n in (30, 90))}
        FROM (SELECT client_id, transaction_date, amount, date_diff('day', transaction_date, {NOW}) AS age FROM paid JOIN (SELECT loan_id, client_id FROM stg_loans) USING (loan_id)) GROUP BY client_id"""
_book = PARTS.pop("book")
for _n, _by in (("book_office", "office_id"), ("book_staff", "loan_officer_id"), ("book_product", "product_id")):
    PARTS[_n] = _book.replace("{by}", _by)
PARTS["audit"] = "SELECT 'events' AS source_table, user_id AS primary_key, CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'd' WHEN 'error' THEN 'r' ELSE 'u' END AS op, ts AS source_commit_at, event_id AS lsn, CAST(round(value * 1000) AS BIGINT) AS lag_ms FROM events"


#: Events as results of tests and models, by what their number leaves.
PARTS["results"] = """SELECT strftime(ts, '%Y-%m-%d') AS invocation_id, date_trunc('day', ts) AS executed_at, event_id % 5 IN (0, 3) AS is_test, (['staging', 'marts', 'staging', 'tests', 'other'])[event_id % 5 + 1] AS layer, (['t_', 'fct_', 'stg_', 't_', 'x_'])[event_id % 5 + 1] || event_id AS name,
        (['pass', 'success', 'warn', 'fail', 'error'])[user_id % 5 + 1] AS status, (event_id % 100) / 4.0 AS seconds, CASE WHEN user_id % 3 > 0 THEN 'error' ELSE 'ok' END AS severity FROM events"""
_RUN = "TIMESTAMP '2024-01-31 00:00:00'"
_statuses = ", ".join(f"({n}, '{g}')" for n, _, _, g, _ in seeds.STATUSES)
_buckets = ", ".join(f"({o}, '{n}', {low}, {high}, CAST({rate} AS DECIMAL(4,2)))" for o, n, low, high, rate in seeds.BUCKETS)
_loaded = lambda batch, status, read="0", inserted="0", updated="0", unchanged="0", rejected="0": f"SELECT '{batch}' AS batch_id, {status} AS status, {read} AS rows_read, {inserted} AS rows_inserted, {updated} AS rows_updated, {unchanged} AS rows_unchanged, {rejected} AS rows_rejected FROM customer"
_n = lambda where: f"count(*) FILTER ({where})"
_BATCH3 = "c_custkey % 100 <> 3 OR c_custkey % 7 = 0"


def query(final: str) -> str:
    """The final SELECT with the parts that it needs, in order."""
    needed: set[str] = set()
    text = [final]
    while text:
        for w in set(re.findall(r"\w+", text.pop())) & PARTS.keys() - needed:
            needed.add(w)
            text.append(PARTS[w])
    parts = [f"{k} AS ({v})" for k, v in PARTS.items() if k in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + final


#: What scoring features are called after "feat_", and the column of the client or of the portfolio behind each.
_OWN = {"gender": "gender", "legal_form": "legal_form", "client_type": "client_type", "client_classification": "client_classification", "age_at_origination": "age_years", "client_tenure_days": "tenure_days", "office_id": "office_id", "loan_officer_id": "staff_id"}
_BOOK = {
    "prior_loan_count": "total_loans", "prior_written_off_count": "written_off_loans", "prior_delinquent_count": "delinquent_loans", "prior_total_disbursed": "lifetime_disbursed", "prior_max_principal": "max_loan_principal", "prior_distinct_products": "distinct_products_used",
    "active_loans": "active_loans", "current_outstanding": "current_total_outstanding", "current_overdue": "current_total_overdue", "current_days_past_due": "current_worst_days_past_due", "savings_balance": "total_savings_balance",
}
_count = lambda t, where, name: f"SELECT '{name}' AS test_name, count(*) AS failures FROM {t} WHERE {where}"
_total = lambda names: ", ".join(names.split())
_EXPECTED = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, '{kind}' AS kind, '{severity}' AS severity, {ok} AS passed, CAST({value} AS DOUBLE) AS observed_value, CAST({least} AS DOUBLE) AS threshold_value FROM raw_loans"
    for name, kind, severity, value, ok, least in (
        ("pk_not_null", "not_null", "error", "count(*) FILTER (loan_id IS NULL)", "count(*) FILTER (loan_id IS NULL) = 0", 0), ("pk_unique", "unique", "error", "count(loan_id) - count(DISTINCT loan_id)", "count(loan_id) = count(DISTINCT loan_id)", 0),
        ("amounts_non_negative", "non_negative", "error", "count(*) FILTER (principal < 0) + count(*) FILTER (total_overdue < 0)", "count(*) FILTER (principal < 0 OR total_overdue < 0) = 0", 0),
        ("rate_in_range", "range", "warn", "count(*) FILTER (annual_interest_rate NOT BETWEEN 0 AND 20)", "count(*) FILTER (annual_interest_rate NOT BETWEEN 0 AND 20) = 0", 0), ("has_rows", "row_count_min", "error", "count(*)", "count(*) >= 1", 1),
    )
)
_LEAK = "SELECT loan_id, observation_date, feat_days_since_prior_loan, feat_days_since_prior_repayment, feat_is_first_time_borrower, feat_prior_loan_count, 'leakage: prior feature is not strictly before observation_date' AS failure_reason"
_leaks = lambda t: f"{_LEAK} FROM {t} WHERE feat_days_since_prior_loan <= 0 OR feat_days_since_prior_repayment <= 0 OR (feat_is_first_time_borrower = 1) <> (feat_prior_loan_count = 0)"
SQL: dict[str, str] = {
    "current_rows": "SELECT * FROM now_clients",
    "stream_collapsed": "SELECT * FROM now_clients",
    "latest_by_key": "SELECT transaction_id, arg_max_null(outstanding_loan_balance, row(_version, _lsn)) AS newest, arg_max(outstanding_loan_balance, row(_version, _lsn)) AS newest_known, arg_max_null(_is_deleted, row(_version, _lsn)) AS is_deleted, max(_version) AS cdc_version, arg_max_null(_source_commit_at, row(_version, _lsn)) AS cdc_commit_at FROM raw_loan_transactions GROUP BY transaction_id",
    "incremental_window": "SELECT * FROM raw_loan_transactions WHERE _source_commit_at >= (SELECT max(_source_commit_at) FROM raw_loan_transactions WHERE transaction_date < DATE '2000-01-01') - INTERVAL 48 HOUR",
    "merge_by_key": "SELECT * FROM stg_tx",
    "change_detection": "SELECT change, count(*) AS n FROM (SELECT n.c_custkey, CASE WHEN n.c_custkey % 7 = 0 THEN 'inserted' WHEN n.c_custkey % 5 = 0 THEN 'updated' ELSE 'unchanged' END AS change FROM customer n) GROUP BY change",
    "dedup_last_wins": "SELECT * FROM events WHERE event_id IN (SELECT max(event_id) FROM events GROUP BY user_id, event_type)",
    "watermark": "SELECT 'loans' AS entity, TIMESTAMP '2024-01-31 00:00:00' AS last_success_at, CAST(max(loan_id) AS VARCHAR) AS last_cursor, count(*) AS last_row_count, count(*) AS total_rows_loaded FROM raw_loans",
    "stg_clients": "SELECT * FROM stg_clients",
    "stg_loans": "SELECT * FROM stg_loans",
    "stg_loan_transactions": "SELECT * FROM stg_tx",
    "stg_offices": "SELECT * FROM stg_offices",
    "stg_staff": "SELECT * FROM stg_staff",
    "stg_loan_products": "SELECT * FROM stg_products",
    "stg_savings_products": "SELECT * FROM stg_sproducts",
    "stg_savings_accounts": "SELECT * FROM stg_savings",
    "loan_repayment_behaviour": "SELECT * FROM behaviour",
    "client_portfolio": "SELECT * FROM portfolio",
    "dim_client": "SELECT * EXCLUDE (office_name), shown_office AS office_name FROM dim_client",
    "dim_office": f"""SELECT o.*, {_zero("b", "total_loans active_loans distinct_borrowers principal_outstanding total_outstanding total_overdue lifetime_disbursed")}, coalesce(c.n, 0) AS total_clients, coalesce(c.a, 0) AS active_clients, coalesce(s.n, 0) AS total_staff, coalesce(s.a, 0) AS active_loan_officers,
        {_div("b.total_overdue", "b.total_outstanding")} AS par_ratio, {_div("b.active_loans", "s.a")} AS loans_per_officer FROM stg_offices o LEFT JOIN book_office b ON o.office_id = b.office_id LEFT JOIN (SELECT office_id, count(*) AS n, count(*) FILTER (is_active = 1) AS a FROM stg_clients GROUP BY 1) c ON o.office_id = c.office_id
        LEFT JOIN (SELECT office_id, count(*) AS n, count(*) FILTER (is_loan_officer = 1 AND is_active = 1) AS a FROM stg_staff GROUP BY 1) s ON o.office_id = s.office_id""",
    "dim_staff": f"""SELECT s.*, {_zero("b", "total_loans active_loans distinct_borrowers written_off_loans")}, coalesce(b.total_outstanding, 0) AS outstanding_portfolio, coalesce(b.total_overdue, 0) AS overdue_portfolio, coalesce(b.active_delinquent, 0) AS delinquent_loans, b.avg_days_past_due,
        {_div("b.total_overdue", "b.total_outstanding")} AS par_ratio, {_div("b.active_delinquent", "b.active_loans")} AS delinquency_rate FROM stg_staff s LEFT JOIN book_staff b ON s.staff_id = b.loan_officer_id""",
    "dim_loan_product": f"""SELECT p.* EXCLUDE (is_active), p.is_active AS is_product_active, {_zero("b", "total_loans active_loans closed_loans written_off_loans delinquent_loans distinct_borrowers lifetime_disbursed lifetime_written_off")}, coalesce(b.total_outstanding, 0) AS current_outstanding, coalesce(b.total_overdue, 0) AS current_overdue,
        b.avg_principal, b.median_principal, b.avg_days_past_due, {_div("b.total_overdue", "b.total_outstanding")} AS par_ratio, {_div("b.written_off_loans", "b.total_loans")} AS write_off_rate, {_div("b.delinquent_loans", "b.active_loans")} AS delinquency_rate FROM stg_products p LEFT JOIN book_product b ON p.product_id = b.product_id""",
    "fct_loan": "SELECT * FROM fct_loan",
    "fct_loan_transaction": "SELECT * FROM fct_tx",
    "fct_savings_account": f"""SELECT s.* EXCLUDE (source_updated_at), s.cdc_commit_at AS source_updated_at, p.product_name, p.interest_posting_period_type AS interest_posting_period, c.client_segment, c.client_classification, c.gender, coalesce(c.shown_office, '') AS office_name, {_div("s.total_deposits", "s.days_since_activation")} AS avg_daily_deposit_rate,
        CASE WHEN s.is_active = 0 THEN 'Closed' WHEN account_balance <= 0 THEN 'Empty' WHEN withdrawal_ratio IS NULL THEN 'No activity' WHEN withdrawal_ratio > 0.9 THEN 'Transactional' WHEN withdrawal_ratio > 0.5 THEN 'Mixed' ELSE 'Accumulating' END AS savings_behaviour
        FROM stg_savings s LEFT JOIN stg_sproducts p ON s.product_id = p.product_id LEFT JOIN dim_client c ON s.client_id = c.client_id""",
    "portfolio_snapshot": f"""SELECT *, {_div("par30_amount", "total_outstanding")} AS par30_ratio, {_div("par90_amount", "total_outstanding")} AS par90_ratio, {_div("cumulative_written_off", "cumulative_disbursed")} AS write_off_ratio, {_key("snapshot_date", "office_id", "product_id")} AS snapshot_key FROM (SELECT {NOW} AS snapshot_date, 20011105 AS snapshot_date_key, office_id, product_id, count(*) AS loans_total,
        count(*) FILTER (is_active = 1) AS loans_active, count(*) FILTER (is_closed = 1) AS loans_closed, count(*) FILTER (is_written_off = 1) AS loans_written_off, count(*) FILTER (is_active = 1 AND days_past_due > 0) AS loans_delinquent, count(*) FILTER (is_active = 1 AND days_past_due > 30) AS loans_par30,
        count(*) FILTER (is_active = 1 AND days_past_due > 90) AS loans_par90, count(DISTINCT client_id) AS distinct_borrowers, {", ".join(f"coalesce(sum({m}) FILTER (is_active = 1), 0) AS {m}" for m in "principal_outstanding interest_outstanding total_outstanding total_overdue".split())},
        coalesce(sum(total_outstanding) FILTER (is_active = 1 AND days_past_due > 30), 0) AS par30_amount, coalesce(sum(total_outstanding) FILTER (is_active = 1 AND days_past_due > 90), 0) AS par90_amount, sum(principal_disbursed) AS cumulative_disbursed, sum(principal_written_off) AS cumulative_written_off,
        {_mean("principal", "is_active = 1")} AS avg_active_principal, max(days_past_due) FILTER (is_active = 1) AS max_days_past_due, avg(CAST(days_past_due AS DOUBLE)) FILTER (is_active = 1) AS avg_days_past_due FROM stg_loans GROUP BY office_id, product_id)""",
    "loan_performance_monthly": f"SELECT *, CAST(strftime(month_start, '%Y%m') AS INTEGER) AS month_key, {_div('vintage_loans_in_default', 'loans_originated')} AS vintage_default_rate, repayment_amount - disbursement_amount AS net_cash_flow FROM monthly",
    "default_features": "SELECT * FROM default_features",
    "scoring_features": f"""SELECT client_id, {NOW} AS scoring_date, {", ".join(f"c.{x} AS feat_{n}" for n, x in _OWN.items())}, {", ".join(f"coalesce(p.{x}, 0) AS feat_{n}" for n, x in _BOOK.items())}, {", ".join(f"coalesce(r.feat_{k}_last_{n}d, 0) AS feat_{k}_last_{n}d" for k in ("repayments", "repaid") for n in (30, 90))},
        historical_write_off_rate AS feat_prior_write_off_rate, lifetime_repayment_ratio AS feat_lifetime_repayment_ratio, savings_to_debt_ratio AS feat_savings_to_debt_ratio, {_bucket("p.current_worst_days_past_due")} AS feat_current_par_bucket, {_days(NOW, "r.last_at")} AS feat_days_since_last_repayment,
        CAST(coalesce(p.total_loans, 0) = 0 AS INTEGER) AS feat_is_first_time_borrower, CAST(coalesce(p.active_loans, 0) > 0 AS INTEGER) AS is_currently_borrowing, CAST(coalesce(p.current_worst_days_past_due, 0) > 0 AS INTEGER) AS needs_collections_review
        FROM stg_clients c LEFT JOIN portfolio p USING (client_id) LEFT JOIN lately r USING (client_id)""",
    "expectations": f"SELECT * FROM ({_EXPECTED})",
    "expectation_summary": f"SELECT count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed AND severity = 'warn') AS warned, count(*) FILTER (NOT passed AND severity <> 'warn') AS failed, coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (NOT passed), '') AS failed_names FROM ({_EXPECTED})",
    "schema_tests": " UNION ALL ".join([
        _count("fct_loan", "loan_id IS NULL", "loan_id_not_null"), "SELECT 'loan_id_unique', count(*) FROM (SELECT loan_id FROM fct_loan GROUP BY 1 HAVING count(*) > 1)", _count("fct_loan", "par_bucket NOT IN ('Current', 'PAR 1-30')", "par_bucket_accepted"),
        "SELECT 'client_relationship', count(*) FROM fct_loan l WHERE client_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_client c WHERE c.client_id = l.client_id)",
    ]),
    "ledger_reconciles": "SELECT loan_id, total_repayment, ledger_total_repaid, repayment_reconciliation_delta FROM fct_loan WHERE abs(repayment_reconciliation_delta) > 1 AND repayment_count > 0 AND disbursed_on_date IS NOT NULL",
    "leakage": _leaks("default_features"),
    "leakage_planted": _leaks("(SELECT * REPLACE (CASE WHEN loan_id % 50 = 0 THEN 0 ELSE feat_days_since_prior_loan END AS feat_days_since_prior_loan, CASE WHEN loan_id % 41 = 0 THEN 0 ELSE feat_days_since_prior_repayment END AS feat_days_since_prior_repayment, CASE WHEN loan_id % 70 = 0 THEN 1 - feat_is_first_time_borrower ELSE feat_is_first_time_borrower END AS feat_is_first_time_borrower) FROM default_features)"),
    "future_dated": f"SELECT transaction_id, loan_id, transaction_date, {_days('transaction_date', NOW)} AS days_in_future FROM fct_tx WHERE transaction_date > {NOW} + 2",
    "dated_after": f"SELECT transaction_id, loan_id, transaction_date, {_days('transaction_date', NOW)} AS days_in_future FROM fct_tx WHERE transaction_date > {NOW} + 2 - 60",
    "bucket_agrees": f"SELECT loan_id, days_past_due, shown AS par_bucket, par_bucket AS expected_bucket FROM (SELECT *, CASE WHEN loan_id % 41 = 0 THEN 'Current' ELSE par_bucket END AS shown FROM fct_loan) WHERE shown <> par_bucket",
    "balance_sanity": """SELECT * FROM (SELECT loan_id, principal_disbursed, principal_outstanding, total_outstanding, total_overdue, is_active, is_closed, CASE WHEN principal_outstanding - principal_disbursed > 1 THEN 'outstanding principal exceeds disbursed' WHEN least(principal_outstanding, total_outstanding, total_overdue) < 0 THEN 'negative balance'
        WHEN total_overdue - total_outstanding > 1 THEN 'overdue exceeds total outstanding' WHEN is_active + is_closed = 2 THEN 'loan is both active and closed' END AS failure_reason FROM (SELECT * REPLACE (CASE loan_id % 90 WHEN 1 THEN -principal_outstanding ELSE principal_outstanding END AS principal_outstanding, CASE loan_id % 90 WHEN 2 THEN total_overdue + 2 * total_outstanding + 5 ELSE total_overdue END AS total_overdue,
        CASE loan_id % 90 WHEN 3 THEN is_active ELSE is_closed END AS is_closed, CASE loan_id % 90 WHEN 4 THEN CAST(0 AS DECIMAL(38,6)) ELSE principal_disbursed END AS principal_disbursed) FROM fct_loan WHERE disbursed_on_date IS NOT NULL)) WHERE failure_reason IS NOT NULL""",
    "quality_gate": f"""SELECT check_name, value, passed, blocking, CAST(NULL AS VARCHAR) AS error FROM (SELECT 'marts_not_empty' AS check_name, CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed, true AS blocking FROM fct_loan UNION ALL SELECT 'no_duplicate_loans', CAST(count(*) - count(DISTINCT loan_id) AS DOUBLE), count(*) = count(DISTINCT loan_id), true FROM fct_loan UNION ALL
        SELECT 'no_duplicate_transactions', CAST(count(*) - count(DISTINCT transaction_id) AS DOUBLE), count(*) = count(DISTINCT transaction_id), true FROM fct_tx UNION ALL SELECT 'no_negative_outstanding', CAST(count(*) FILTER (total_outstanding < 0) AS DOUBLE), count(*) FILTER (total_outstanding < 0) = 0, true FROM fct_loan UNION ALL
        SELECT 'ml_label_leakage', CAST(count(*) FILTER (feat_days_since_prior_loan <= 0) AS DOUBLE), count(*) FILTER (feat_days_since_prior_loan <= 0) = 0, true FROM default_features UNION ALL SELECT 'dimension_coverage', CAST(count(*) FILTER (client_segment IS NULL OR client_segment = '') AS DOUBLE), count(*) FILTER (client_segment IS NULL OR client_segment = '') = 0, false FROM fct_loan UNION ALL
        SELECT 'cdc_parse_errors', CAST(count(*) AS DOUBLE), count(*) = 0, false FROM customer WHERE c_custkey % 50 = 0)""",
    "cdc_freshness": """SELECT source_table, CAST(date_diff('second', max(source_commit_at), TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) AS freshness_seconds, quantile_cont(lag_ms, 0.5) / 1000 AS lag_p50_seconds, quantile_cont(lag_ms, 0.95) / 1000 AS lag_p95_seconds, max(lag_ms) / 1000 AS lag_max_seconds, max(source_commit_at) AS last_source_commit_at, max(source_commit_at) AS last_landed_at,
        count(*) FILTER (source_commit_at > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 5 MINUTE) AS events_last_5m, count(*) FILTER (source_commit_at > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 HOUR) AS events_last_1h, count(*) FILTER (op = 'c') AS creates, count(*) FILTER (op = 'u') AS updates, count(*) FILTER (op = 'd') AS deletes,
        count(*) FILTER (op = 'r') AS snapshot_reads FROM audit WHERE source_commit_at > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 720 HOUR GROUP BY source_table""",
    "rolling_counts": "SELECT CAST(epoch(time_bucket(INTERVAL 5 MINUTE, source_commit_at)) AS BIGINT) AS window_start, source_table, op, count(*) AS events FROM audit GROUP BY 1, 2, 3",
    "raw_health": " UNION ALL ".join(f"SELECT '{e}' AS table_name, count(*) AS row_count, count(*) FILTER (_is_deleted = 1) AS deleted_rows, max(_landed_at) AS last_insert_at, CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(max(_landed_at)) AS BIGINT) AS seconds_since_insert FROM raw_{e}" for e in star.KEYS),
    "reconciliation": " UNION ALL ".join(f"SELECT '{e}' AS entity, (SELECT count(DISTINCT {k}) FROM raw_{e}) AS distinct_keys, (SELECT count(*) FROM now_{e}) AS live_keys" for e, k in star.KEYS.items()),
    "topics_landed": " UNION ALL ".join(f"SELECT '{e}' AS entity, (SELECT count(*) FROM raw_{e}) AS messages, (SELECT count(DISTINCT {k}) FROM raw_{e}) AS distinct_keys, (SELECT count(*) FROM now_{e}) AS live_keys" for e, k in star.KEYS.items()),
    "streamed_counts": """SELECT CAST(epoch(time_bucket(INTERVAL 5 MINUTE, source_commit_at)) AS BIGINT) AS window_start, source_table, op, count(*) AS events FROM audit WHERE NOT (lsn % 13 = 0 AND source_commit_at < TIMESTAMP '2024-01-08 00:00:00') GROUP BY 1, 2, 3
        HAVING window_start + 300 <= epoch((SELECT max(source_commit_at) FROM audit) - INTERVAL 48 HOUR)""",
    "row_delta": "SELECT 'clients' AS entity, (SELECT count(*) FROM customer) AS source_rows, (SELECT count(*) FROM now_clients) AS live_keys, (SELECT count(*) FROM customer) - (SELECT count(*) FROM now_clients) AS delta UNION ALL SELECT 'loans', (SELECT count(*) FROM orders), (SELECT count(*) FROM now_loans), (SELECT count(*) FROM orders) - (SELECT count(*) FROM now_loans)",
    "latest_run": "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "par_by_branch": f"SELECT office_name, total_loans, round({_div('total_overdue * 100', 'total_outstanding')}, 2) AS par_percent FROM (SELECT o.office_name, b.total_loans, b.total_overdue, b.total_outstanding FROM stg_offices o JOIN book_office b ON o.office_id = b.office_id) WHERE total_outstanding > 0",
    "default_rate_by_split": "SELECT split_hint, count(*) AS loans, round(avg(label_defaulted), 6) AS default_rate FROM default_features WHERE is_label_mature = 1 GROUP BY split_hint",
    "dim_date": f"""SELECT d AS date_day, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year_number, CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(month(d) AS INTEGER) AS month_number, CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
        CAST(weekofyear(d) AS INTEGER) AS iso_week, strftime(d, '%b') AS month_short_name, strftime(d, '%B') AS month_name, strftime(d, '%a') AS day_short_name, strftime(d, '%A') AS day_name, concat(year(d), '-Q', quarter(d)) AS year_quarter, strftime(d, '%Y-%m') AS year_month, CAST(d - CAST(dayofweek(d) AS INTEGER) AS DATE) AS week_start_date,
        CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date, CAST(date_trunc('year', d) AS DATE) AS year_start_date, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN isodow(d) < 6 THEN 1 ELSE 0 END AS is_weekday,
        CASE WHEN d = last_day(d) THEN 1 ELSE 0 END AS is_month_end, CASE WHEN day(d) = 1 THEN 1 ELSE 0 END AS is_month_start, CASE WHEN d = date_trunc('quarter', d) THEN 1 ELSE 0 END AS is_quarter_start, CASE WHEN d <= {NOW} THEN 1 ELSE 0 END AS is_past, CASE WHEN d = {NOW} THEN 1 ELSE 0 END AS is_today, {_days(NOW, "d")} AS days_ago
        FROM (SELECT CAST(unnest(generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d)""",
    "row_rejects": """SELECT 'loans' AS entity, CASE o_orderkey % 60 WHEN 2 THEN CAST(-o_orderkey AS VARCHAR) WHEN 3 THEN CAST(o_orderkey AS VARCHAR) END AS source_key, CASE o_orderkey % 60 WHEN 1 THEN 'primary_key_not_null' WHEN 2 THEN 'primary_key_positive' ELSE 'record_not_empty' END AS rule FROM orders WHERE o_orderkey % 60 IN (1, 2, 3)
        UNION ALL SELECT 'loans', CAST(count(*) AS VARCHAR), 'valid rows' FROM orders WHERE o_orderkey % 60 NOT IN (1, 2, 3)""",
    "source_freshness": f"SELECT table_name, newest, age_hours, CASE WHEN age_hours <= 24 THEN 'pass' WHEN age_hours <= {24 * 365 * 31} THEN 'warn' ELSE 'error' END AS status FROM (SELECT *, date_diff('second', newest, TIMESTAMP '2001-11-05 00:00:00') / 3600.0 AS age_hours FROM (" + " UNION ALL ".join(f"SELECT '{e}' AS table_name, max(_landed_at) AS newest FROM raw_{e}" for e in star.KEYS) + "))",
    "caught_up": f"SELECT largest_delta, largest_p95, largest_delta <= 100 AND largest_p95 <= 300 AS caught_up FROM (SELECT greatest(abs((SELECT count(*) FROM customer) - (SELECT count(*) FROM now_clients)), abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM now_loans))) AS largest_delta, (SELECT quantile_cont(lag_ms, 0.95) / 1000 FROM audit WHERE source_commit_at > {_RUN} - INTERVAL 720 HOUR) AS largest_p95)",
    "last_success": f"SELECT 'e' || user_id AS entity, max(ts) AS last_success_at, date_diff('second', max(ts), {_RUN}) <= 86400 AS fresh FROM events WHERE event_type <> 'error' GROUP BY user_id",
    "latest_tests": "SELECT layer, count(*) FILTER (status IN ('pass', 'success')) AS passed, count(*) FILTER (status = 'warn') AS warned, count(*) FILTER (status IN ('fail', 'error')) AS failed, round(sum(seconds), 2) AS total_seconds, max(executed_at) AS executed_at FROM results WHERE is_test AND invocation_id = (SELECT max(invocation_id) FROM results WHERE is_test) GROUP BY layer",
    "model_runtimes": "SELECT name AS model_name, seconds AS execution_time FROM results WHERE NOT is_test AND invocation_id = (SELECT max(invocation_id) FROM results WHERE NOT is_test)",
    "results_by_layer": "SELECT CASE WHEN is_test THEN 'test' ELSE 'model' END AS kind, layer, status, CASE WHEN is_test THEN severity ELSE '' END AS severity, count(*) AS n, sum(seconds) AS seconds FROM results GROUP BY 1, 2, 3, 4",
    "reject_totals": f"SELECT event_type AS entity, count(*) AS rejects, count(DISTINCT user_id % 3) AS rules, max(ts) AS last_rejected_at FROM events WHERE date_diff('second', ts, {_RUN}) < 86400 GROUP BY 1",
    "gate_isolated": """SELECT 'loans_there' AS check_name, CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed, true AS blocking, CAST(NULL AS VARCHAR) AS error FROM stg_loans UNION ALL SELECT 'principal_non_negative', count(*) FILTER (principal < 0), count(*) FILTER (principal < 0) = 0, true, NULL FROM stg_loans
        UNION ALL SELECT 'status_is_a_number', NULL, false, true, 'CAST_INVALID_INPUT' UNION ALL SELECT 'gone', NULL, false, false, 'UNRESOLVED_COLUMN'""",
    "results_history": f"SELECT CASE WHEN is_test THEN 'test' ELSE 'model' END AS kind, CAST(ts AS DATE) AS day, count(*) AS n FROM (SELECT ts, event_id % 5 IN (0, 3) AS is_test FROM events) WHERE CAST(ts AS DATE) >= CAST({_RUN} - INTERVAL 10 DAY AS DATE) GROUP BY 1, 2",
    "parity": " UNION ALL ".join(f"SELECT '{e}' AS entity, (SELECT count(DISTINCT {k}) FROM raw_{e}) AS source_rows, (SELECT count(*) FROM now_{e}) AS live_keys, (SELECT count(DISTINCT {k}) FROM raw_{e}) - (SELECT count(*) FROM now_{e}) AS delta" for e, k in star.KEYS.items()),
    "recent_rejects": f"SELECT event_type AS entity, 'rule' || user_id % 3 AS rule, count(*) AS rejects FROM events WHERE date_diff('second', ts, {_RUN}) < 86400 GROUP BY 1, 2",
    "provisions": f"""SELECT bucket_order, bucket_name, status_group, count(*) AS loans, sum(total_outstanding * rate) AS provision FROM stg_loans LEFT JOIN (VALUES {_statuses}) s(status_id, status_group) USING (status_id)
        LEFT JOIN (VALUES {_buckets}) b(bucket_order, bucket_name, low, high, rate) ON greatest(days_past_due, 0) BETWEEN low AND high GROUP BY 1, 2, 3""",
    "backfill_guard": " UNION ALL ".join(f"SELECT '{t}' AS entity, count(*) AS rows_before, count(*) FILTER ({w}) AS rows_after, count(*) FILTER ({w}) < count(*) AS shrank FROM {t}" for t, w in (("customer", "true"), ("orders", "o_orderkey % 10 <> 0"), ("supplier", "true"))),
    "retained": "SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-21' GROUP BY 1",
    "merged_by_month": "SELECT * FROM stg_tx",
    "compacted": "SELECT * FROM raw_clients QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY _version DESC, _lsn DESC) = 1",
    "packed": "SELECT CAST(ts AS DATE) AS day, count(*) AS events, sum(event_id) AS ids, true AS fewer_files FROM events GROUP BY 1",
    "failing_loans": "SELECT loan_id, client_id, par_bucket FROM stg_loans WHERE par_bucket NOT IN ('Current', 'PAR 1-30')",
    "table_files": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("customer", "orders", "supplier", "lineitem")),
    "wire_round_trip": " UNION ALL ".join(f"SELECT '{e}' AS entity, count(*) AS rows, true AS same FROM raw_{e}" for e in star.KEYS),
    "atomic_load": " UNION ALL ".join([
        _loaded("1 new", "'success'", _n("c_custkey % 7 <> 0"), _n("c_custkey % 7 <> 0")), _loaded("2 same", "'success'", _n("c_custkey % 7 <> 0"), unchanged=_n("c_custkey % 7 <> 0")),
        _loaded("3 changed", "'success'", _n(_BATCH3), _n("c_custkey % 7 = 0"), _n("c_custkey % 7 <> 0 AND c_custkey % 100 <> 3 AND c_custkey % 5 = 0"), _n("c_custkey % 7 <> 0 AND c_custkey % 100 <> 3 AND c_custkey % 5 <> 0"), _n("c_custkey % 100 = 3")),
        _loaded("4 dry", "'skipped'", "count(*)"), _loaded("5 rejected", "'failed'", "0 * count(*)"),
        _loaded("table", f"CAST(max(c_custkey) FILTER ({_BATCH3}) AS VARCHAR)", f"2 * {_n('c_custkey % 7 <> 0')} + {_n(_BATCH3)}", "count(*)", _n("c_custkey % 5 = 0"), _n("c_custkey % 7 = 0 OR c_custkey % 5 <> 0 OR c_custkey % 100 = 3")),
    ]),
    "load_order": " UNION ALL ".join(f"SELECT '{e}' AS entity, 'success' AS status, count(DISTINCT {k}) AS rows_read, count(DISTINCT {k}) AS rows_inserted, 0 AS rows_rejected FROM raw_{e}" if e != "staff" else "SELECT 'staff', 'failed', 0, 0, 0" for e, k in star.KEYS.items()),
    "stream_replay": f"SELECT c_custkey AS savings_id, CAST(c_acctbal AS DECIMAL(19,6)) AS account_balance, DATE '1970-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS activated_on_date, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS is_active, 'u' AS _op, c_custkey * 1000 AS _version FROM customer WHERE c_custkey % 50 <> 0 AND c_custkey % 9 <> 0",
}
SQL["failures_stored"] = SQL["schema_tests"]
SQL["caught_up_all"] = f"SELECT largest_delta, largest_p95, largest_delta <= 0 AND largest_p95 <= 300 AS caught_up FROM (SELECT (SELECT max(abs(delta)) FROM ({SQL['parity']})) AS largest_delta, (SELECT quantile_cont(lag_ms, 0.95) / 1000 FROM audit WHERE source_commit_at > {_RUN} - INTERVAL 720 HOUR) AS largest_p95)"
ORACLE = {k: query(v) for k, v in SQL.items()}
