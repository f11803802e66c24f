"""Columns of the registered queries, all of each, with their kinds: d double as it is, a double to 6 places, l long, i int, s text, t date,
m timestamp (as microseconds), b boolean."""

COLUMNS = {
    "current_rows": "client_id:l office_id:l staff_id:l account_no:s external_id:s status_id:i status_value:s is_active:i office_name:s staff_name:s legal_form_value:s gender_value:s client_type_value:s client_classification_value:s firstname:s lastname:s display_name:s mobile_no:s email_address:s activation_date:t submitted_on_date:t closed_on_date:t date_of_birth:t _op:s _version:l _lsn:l _tx_id:l _is_deleted:i _source_commit_at:m _cdc_read_at:m _landed_at:m source_ingested_at:m source_updated_at:m",
    "latest_by_key": "transaction_id:l newest:d is_deleted:i cdc_commit_at:m cdc_version:l newest_known:d",
    "incremental_window": "transaction_id:l loan_id:l office_id:l type_id:i type_value:s is_reversed:i transaction_date:t submitted_on_date:t currency_code:s amount:d principal_portion:d interest_portion:d fee_charges_portion:d penalty_charges_portion:d overpayment_portion:d outstanding_loan_balance:d _op:s _version:l _lsn:l _tx_id:l _is_deleted:i _source_commit_at:m _cdc_read_at:m _landed_at:m source_ingested_at:m source_updated_at:m",
    "merge_by_key": "transaction_id:l loan_id:l office_id:l type_id:i type_value:s is_reversed:i transaction_date:t submitted_on_date:t currency_code:s amount:d principal_portion:d interest_portion:d fee_charges_portion:d penalty_charges_portion:d overpayment_portion:d outstanding_loan_balance:d source_ingested_at:m cdc_commit_at:m cdc_version:l transaction_category:s is_countable:i transaction_year:i transaction_month:i transaction_month_start:t transaction_day_of_week:i",
    "change_detection": "change:s n:l",
    "dedup_last_wins": "event_id:l ts:m user_id:l event_type:s value:d props:s",
    "watermark": "entity:s last_success_at:m last_cursor:s last_row_count:l total_rows_loaded:l",
    "stg_clients": "client_id:l office_id:l staff_id:l account_no:s external_id:s status_id:i status:s is_active:i office_name:s loan_officer_name:s legal_form:s gender:s client_type:s client_classification:s firstname:s lastname:s display_name:s mobile_no:s email_address:s activation_date:t submitted_on_date:t closed_on_date:t date_of_birth:t source_ingested_at:m source_updated_at:m client_key:l cdc_commit_at:m cdc_version:l age_years:i tenure_days:i tenure_months:i",
    "stg_loans": "loan_id:l client_id:l product_id:l office_id:l loan_officer_id:l account_no:s loan_type:s currency_code:s status_id:i status:s is_active:i is_closed:i is_overpaid:i submitted_on_date:t approved_on_date:t disbursed_on_date:t expected_maturity_date:t closed_on_date:t overdue_since_date:t number_of_repayments:i repayment_frequency_type:s interest_rate_per_period:d annual_interest_rate:d principal:d approved_principal:d principal_disbursed:d principal_paid:d principal_written_off:d principal_outstanding:d principal_overdue:d interest_charged:d interest_paid:d interest_outstanding:d fee_charges_charged:d fee_charges_paid:d penalty_charges_charged:d total_expected_repayment:d total_repayment:d total_outstanding:d total_overdue:d delinquent_amount:d source_ingested_at:m source_updated_at:m loan_key:l cdc_commit_at:m cdc_version:l is_written_off:i days_past_due:i par_bucket:s is_in_default:i principal_repaid_ratio:d repayment_progress_ratio:d days_since_disbursement:i term_days:i",
    "stg_loan_transactions": "transaction_id:l loan_id:l office_id:l type_id:i type_value:s is_reversed:i transaction_date:t submitted_on_date:t currency_code:s amount:d principal_portion:d interest_portion:d fee_charges_portion:d penalty_charges_portion:d overpayment_portion:d outstanding_loan_balance:d source_ingested_at:m cdc_commit_at:m cdc_version:l transaction_category:s is_countable:i transaction_year:i transaction_month:i transaction_month_start:t transaction_day_of_week:i",
    "stg_offices": "office_id:l parent_office_id:l office_name:s office_name_decorated:s external_id:s parent_office_name:s hierarchy:s opening_date:t source_ingested_at:m source_updated_at:m office_key:l cdc_commit_at:m cdc_version:l hierarchy_depth:i is_head_office:i days_open:i",
    "stg_staff": "staff_id:l office_id:l is_loan_officer:i is_active:i staff_name:s firstname:s lastname:s office_name:s mobile_no:s joining_date:t source_ingested_at:m source_updated_at:m staff_key:l cdc_commit_at:m cdc_version:l tenure_days:i",
    "stg_loan_products": "product_id:l product_name:s product_short_name:s currency_code:s default_principal:d min_principal:d max_principal:d default_number_of_repayments:i annual_interest_rate:d product_status:s start_date:t close_date:t source_ingested_at:m source_updated_at:m product_key:l cdc_commit_at:m cdc_version:l is_active:i",
    "stg_savings_products": "product_id:l product_name:s product_short_name:s currency_code:s nominal_annual_interest_rate:d interest_posting_period_type:s product_status:s source_ingested_at:m source_updated_at:m product_key:l cdc_commit_at:m cdc_version:l",
    "stg_savings_accounts": "savings_id:l client_id:l product_id:l office_id:l field_officer_id:l account_no:s client_name:s status_id:i status:s is_active:i currency_code:s submitted_on_date:t activated_on_date:t closed_on_date:t nominal_annual_interest_rate:d account_balance:d available_balance:d total_deposits:d total_withdrawals:d total_interest_posted:d source_ingested_at:m source_updated_at:m savings_key:l cdc_commit_at:m cdc_version:l withdrawal_ratio:d days_since_activation:i",
    "client_portfolio": "client_id:l total_loans:l active_loans:l closed_loans:l written_off_loans:l delinquent_loans:l defaulted_loans:l lifetime_disbursed:d lifetime_repaid:d current_principal_outstanding:d current_total_outstanding:d current_total_overdue:d lifetime_written_off:d worst_days_past_due:i current_worst_days_past_due:i first_disbursement_date:t latest_disbursement_date:t latest_closure_date:t avg_loan_principal:d max_loan_principal:d distinct_products_used:l total_savings_accounts:l active_savings_accounts:l total_savings_balance:d lifetime_deposits:d lifetime_withdrawals:d first_savings_date:t historical_write_off_rate:d lifetime_repayment_ratio:d savings_to_debt_ratio:d days_since_first_loan:i is_multi_product_client:i is_repeat_borrower:i prior_loan_count:l",
    "dim_client": "office_id:l client_id:l staff_id:l account_no:s external_id:s status:s is_active:i office_name:s loan_officer_name:s legal_form:s gender:s client_type:s client_classification:s firstname:s lastname:s display_name:s activation_date:t submitted_on_date:t closed_on_date:t client_key:l source_updated_at:m age_years:i tenure_days:i tenure_months:i total_loans:l active_loans:l closed_loans:l written_off_loans:l delinquent_loans:l lifetime_disbursed:d lifetime_repaid:d current_total_outstanding:d current_total_overdue:d total_savings_balance:d active_savings_accounts:l is_repeat_borrower:i is_multi_product_client:i current_worst_days_past_due:i historical_write_off_rate:d lifetime_repayment_ratio:d savings_to_debt_ratio:d parent_office_name:s office_depth:i age_band:s tenure_band:s current_par_bucket:s client_segment:s",
    "dim_office": "office_id:l parent_office_id:l office_name:s office_name_decorated:s external_id:s parent_office_name:s hierarchy:s opening_date:t office_key:l hierarchy_depth:i is_head_office:i days_open:i total_loans:l active_loans:l distinct_borrowers:l principal_outstanding:d total_outstanding:d total_overdue:d lifetime_disbursed:d total_clients:l active_clients:l total_staff:l active_loan_officers:l par_ratio:d loans_per_officer:d",
    "dim_staff": "staff_id:l office_id:l is_loan_officer:i is_active:i staff_name:s firstname:s lastname:s office_name:s joining_date:t staff_key:l tenure_days:i total_loans:l active_loans:l distinct_borrowers:l outstanding_portfolio:d overdue_portfolio:d delinquent_loans:l written_off_loans:l avg_days_past_due:d par_ratio:d delinquency_rate:d",
    "dim_loan_product": "product_id:l product_name:s product_short_name:s currency_code:s default_principal:d min_principal:d max_principal:d default_number_of_repayments:i annual_interest_rate:d product_status:s start_date:t close_date:t product_key:l is_product_active:i total_loans:l active_loans:l closed_loans:l written_off_loans:l delinquent_loans:l distinct_borrowers:l current_outstanding:d current_overdue:d lifetime_disbursed:d lifetime_written_off:d avg_principal:d median_principal:d avg_days_past_due:d par_ratio:d write_off_rate:d delinquency_rate:d",
    "fct_loan_transaction": "loan_id:l transaction_id:l office_id:l type_id:i type_value:s is_reversed:i transaction_date:t submitted_on_date:t currency_code:s amount:d principal_portion:d interest_portion:d fee_charges_portion:d penalty_charges_portion:d overpayment_portion:d outstanding_loan_balance:d source_updated_at:m transaction_category:s is_countable:i transaction_year:i transaction_month:i transaction_month_start:t transaction_day_of_week:i amount_including_reversals:d client_id:l product_id:l loan_officer_id:l loan_status:s loan_par_bucket_now:s transaction_date_key:i repayment_amount:d disbursement_amount:d write_off_amount:d days_since_disbursement:i",
    "fct_savings_account": "client_id:l product_id:l savings_id:l office_id:l field_officer_id:l account_no:s status:s is_active:i currency_code:s submitted_on_date:t activated_on_date:t closed_on_date:t nominal_annual_interest_rate:d account_balance:d available_balance:d total_deposits:d total_withdrawals:d total_interest_posted:d savings_key:l source_updated_at:m withdrawal_ratio:d days_since_activation:i product_name:s interest_posting_period:s client_segment:s client_classification:s gender:s office_name:s avg_daily_deposit_rate:d savings_behaviour:s",
    "portfolio_snapshot": "office_id:l product_id:l loans_total:l loans_active:l loans_closed:l loans_written_off:l loans_delinquent:l loans_par30:l loans_par90:l distinct_borrowers:l principal_outstanding:d interest_outstanding:d total_outstanding:d total_overdue:d par30_amount:d par90_amount:d cumulative_disbursed:d cumulative_written_off:d avg_active_principal:d max_days_past_due:i avg_days_past_due:d snapshot_date:t par30_ratio:d par90_ratio:d write_off_ratio:d snapshot_date_key:i snapshot_key:l",
    "loan_repayment_behaviour": "loan_id:l repayment_count:l total_repaid:d principal_repaid:d interest_repaid:d fees_repaid:d penalties_repaid:d first_repayment_date:t last_repayment_date:t avg_repayment_amount:d stddev_repayment_amount:a median_repayment_amount:d max_repayment_amount:d active_repayment_months:l disbursement_count:l total_disbursed:d first_disbursement_date:t last_disbursement_date:t reversed_transaction_count:l write_off_transaction_count:l interest_waiver_count:l recovery_count:l total_transaction_count:l last_activity_date:t avg_days_between_repayments:d stddev_days_between_repayments:a max_days_between_repayments:l days_since_last_activity:i repayment_regularity_cv:a",
    "fct_loan": "client_id:l loan_id:l product_id:l office_id:l loan_officer_id:l account_no:s loan_type:s currency_code:s status_id:i status:s is_active:i is_closed:i is_overpaid:i submitted_on_date:t approved_on_date:t disbursed_on_date:t expected_maturity_date:t closed_on_date:t overdue_since_date:t number_of_repayments:i repayment_frequency_type:s interest_rate_per_period:d annual_interest_rate:d principal:d approved_principal:d principal_disbursed:d principal_paid:d principal_written_off:d principal_outstanding:d principal_overdue:d interest_charged:d interest_paid:d interest_outstanding:d fee_charges_charged:d fee_charges_paid:d penalty_charges_charged:d total_expected_repayment:d total_repayment:d total_outstanding:d total_overdue:d delinquent_amount:d loan_key:l source_updated_at:m is_written_off:i days_past_due:i par_bucket:s is_in_default:i principal_repaid_ratio:d repayment_progress_ratio:d days_since_disbursement:i term_days:i repayment_count:l ledger_total_repaid:d avg_repayment_amount:d first_repayment_date:t last_repayment_date:t days_since_last_activity:i avg_days_between_repayments:d repayment_regularity_cv:a reversed_transaction_count:l client_segment:s client_classification:s gender:s legal_form:s age_band:s tenure_band:s disbursement_date_key:i days_to_approval:i days_to_disbursement:i par30_exposure:d par90_exposure:d overdue_ratio:d repayment_reconciliation_delta:d",
    "loan_performance_monthly": "month_start:t office_id:l product_id:l repayment_count:l repayment_amount:d principal_collected:d interest_collected:d fees_collected:d penalties_collected:d reversal_count:l loans_with_activity:l disbursement_count:l disbursement_amount:d write_off_amount:d loans_originated:l principal_originated:d borrowers_served:l avg_origination_principal:d avg_days_to_approval:d avg_days_to_disbursement:d vintage_loans_in_default:l vintage_loans_written_off:l month_key:i vintage_default_rate:d net_cash_flow:d",
    "default_features": "loan_id:l client_id:l observation_date:t observation_month:i label_defaulted:i label_days_past_due:i label_written_off:i feat_principal:d feat_number_of_repayments:i feat_annual_interest_rate:d feat_term_days:i feat_installment_size:d feat_days_application_to_disbursement:i feat_product_id:l feat_product_name:s feat_product_default_principal:d feat_principal_vs_product_default:d feat_gender:s feat_legal_form:s feat_client_type:s feat_client_classification:s feat_age_at_origination:i feat_client_tenure_days:i feat_office_id:l feat_loan_officer_id:l feat_prior_loan_count:l feat_prior_total_disbursed:d feat_prior_max_principal:d feat_prior_distinct_products:l feat_days_since_prior_loan:i feat_principal_vs_prior_max:d feat_prior_repayment_count:l feat_prior_total_repaid:d feat_prior_avg_repayment:d feat_prior_reversal_count:l feat_days_since_prior_repayment:i feat_is_first_time_borrower:i split_hint:s is_label_mature:i",
    "scoring_features": "client_id:l feat_gender:s feat_legal_form:s feat_client_type:s feat_client_classification:s feat_age_at_origination:i feat_client_tenure_days:i feat_office_id:l feat_loan_officer_id:l scoring_date:t feat_prior_loan_count:l feat_prior_written_off_count:l feat_prior_delinquent_count:l feat_prior_total_disbursed:d feat_prior_max_principal:d feat_prior_distinct_products:l feat_prior_write_off_rate:d feat_lifetime_repayment_ratio:d feat_is_first_time_borrower:i feat_active_loans:l feat_current_outstanding:d feat_current_overdue:d feat_current_days_past_due:i feat_current_par_bucket:s feat_savings_balance:d feat_savings_to_debt_ratio:d feat_repayments_last_30d:l feat_repayments_last_90d:l feat_repaid_last_30d:d feat_repaid_last_90d:d feat_days_since_last_repayment:i is_currently_borrowing:i needs_collections_review:i",
    "expectations": "check_name:s kind:s severity:s passed:b observed_value:d threshold_value:d",
    "expectation_summary": "total:l passed:l warned:l failed:l failed_names:s",
    "schema_tests": "test_name:s failures:l",
    "failures_stored": "test_name:s failures:l",
    "row_rejects": "entity:s source_key:s rule:s",
    "ledger_reconciles": "loan_id:l total_repayment:d ledger_total_repaid:d repayment_reconciliation_delta:d",
    "leakage": "loan_id:l observation_date:t feat_days_since_prior_loan:i feat_days_since_prior_repayment:i feat_is_first_time_borrower:i feat_prior_loan_count:l failure_reason:s",
    "leakage_planted": "loan_id:l observation_date:t feat_days_since_prior_loan:i feat_days_since_prior_repayment:i feat_is_first_time_borrower:i feat_prior_loan_count:l failure_reason:s",
    "future_dated": "transaction_id:l loan_id:l transaction_date:t days_in_future:i",
    "dated_after": "transaction_id:l loan_id:l transaction_date:t days_in_future:i",
    "bucket_agrees": "loan_id:l days_past_due:i par_bucket:s expected_bucket:s",
    "balance_sanity": "loan_id:l principal_disbursed:d principal_outstanding:d total_outstanding:d total_overdue:d is_active:i is_closed:i failure_reason:s",
    "quality_gate": "check_name:s value:d passed:b blocking:b error:s",
    "source_freshness": "table_name:s newest:m age_hours:d status:s",
    "caught_up": "largest_delta:l largest_p95:a caught_up:b",
    "last_success": "entity:s last_success_at:m fresh:b",
    "latest_tests": "layer:s passed:l warned:l failed:l total_seconds:d executed_at:m",
    "model_runtimes": "model_name:s execution_time:d",
    "results_by_layer": "kind:s layer:s status:s severity:s n:l seconds:d",
    "reject_totals": "entity:s rejects:l rules:l last_rejected_at:m",
    "gate_isolated": "check_name:s value:d passed:b blocking:b error:s",
    "results_history": "kind:s day:t n:l",
    "parity": "entity:s source_rows:l live_keys:l delta:l",
    "caught_up_all": "largest_delta:l largest_p95:a caught_up:b",
    "recent_rejects": "entity:s rule:s rejects:l",
    "provisions": "bucket_order:i bucket_name:s status_group:s loans:l provision:d",
    "backfill_guard": "entity:s rows_before:l rows_after:l shrank:b",
    "retained": "day:t events:l",
    "merged_by_month": "transaction_id:l loan_id:l office_id:l type_id:i type_value:s is_reversed:i transaction_date:t submitted_on_date:t currency_code:s amount:d principal_portion:d interest_portion:d fee_charges_portion:d penalty_charges_portion:d overpayment_portion:d outstanding_loan_balance:d source_ingested_at:m cdc_commit_at:m cdc_version:l transaction_category:s is_countable:i transaction_year:i transaction_month:i transaction_month_start:t transaction_day_of_week:i",
    "compacted": "client_id:l office_id:l staff_id:l account_no:s external_id:s status_id:i status_value:s is_active:i office_name:s staff_name:s legal_form_value:s gender_value:s client_type_value:s client_classification_value:s firstname:s lastname:s display_name:s mobile_no:s email_address:s activation_date:t submitted_on_date:t closed_on_date:t date_of_birth:t _op:s _version:l _lsn:l _tx_id:l _is_deleted:i _source_commit_at:m _cdc_read_at:m _landed_at:m source_ingested_at:m source_updated_at:m",
    "packed": "day:t events:l ids:l fewer_files:b",
    "failing_loans": "loan_id:l client_id:l par_bucket:s",
    "table_files": "table_name:s rows:l",
    "wire_round_trip": "entity:s rows:l same:b",
    "atomic_load": "batch_id:s status:s rows_read:l rows_inserted:l rows_updated:l rows_unchanged:l rows_rejected:l",
    "load_order": "entity:s status:s rows_read:l rows_inserted:l rows_rejected:l",
    "stream_replay": "savings_id:l account_balance:d activated_on_date:t is_active:i _op:s _version:l",
    "topics_landed": "entity:s messages:l distinct_keys:l live_keys:l",
    "streamed_counts": "window_start:l source_table:s op:s events:l",
    "stream_collapsed": "client_id:l office_id:l staff_id:l account_no:s external_id:s status_id:i status_value:s is_active:i office_name:s staff_name:s legal_form_value:s gender_value:s client_type_value:s client_classification_value:s firstname:s lastname:s display_name:s mobile_no:s email_address:s activation_date:t submitted_on_date:t closed_on_date:t date_of_birth:t _op:s _version:l _lsn:l _tx_id:l _is_deleted:i _source_commit_at:m _cdc_read_at:m _landed_at:m source_ingested_at:m source_updated_at:m",
    "cdc_freshness": "source_table:s last_source_commit_at:m last_landed_at:m freshness_seconds:l lag_p50_seconds:a lag_p95_seconds:a lag_max_seconds:d events_last_5m:l events_last_1h:l creates:l updates:l deletes:l snapshot_reads:l",
    "rolling_counts": "window_start:l source_table:s op:s events:l",
    "raw_health": "table_name:s row_count:l deleted_rows:l last_insert_at:m seconds_since_insert:l",
    "reconciliation": "entity:s distinct_keys:l live_keys:l",
    "row_delta": "entity:s source_rows:l live_keys:l delta:l",
    "latest_run": "event_id:l ts:m user_id:l event_type:s value:d props:s",
    "par_by_branch": "office_name:s total_loans:l par_percent:a",
    "default_rate_by_split": "split_hint:s loans:l default_rate:a",
    "dim_date": "date_day:t date_key:i year_number:i quarter_number:i month_number:i day_of_month:i day_of_week:i day_of_year:i iso_week:i month_short_name:s month_name:s day_short_name:s day_name:s year_quarter:s year_month:s week_start_date:t month_start_date:t month_end_date:t quarter_start_date:t year_start_date:t is_weekend:i is_weekday:i is_month_end:i is_month_start:i is_quarter_start:i is_past:i is_today:i days_ago:i",
}
