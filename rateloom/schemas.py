"""Schemas of staged tables and the keys of released ones."""

from __future__ import annotations

# Staged tables, in DDL.
FILES = "hospital_id string, source_sha256 string, source_filename string, source_url string, bytes bigint, source_format string, template_version string, hospital_name string, last_updated_on string, location_names array<string>, hospital_addresses array<string>, type_2_npis array<string>, license_state string, license_number string, attestation string, records_read bigint, charge_rows bigint, quarantined_rows bigint, unmapped_meta_json string"
CHARGES = "charge_id string, item_id string, hospital_id string, source_sha256 string, source_locator string, description string, setting string, billing_class string, modifiers string, drug_unit_of_measurement double, drug_type_of_measurement string, gross_charge double, discounted_cash double, payer_name string, plan_name string, negotiated_dollar double, negotiated_percentage double, negotiated_algorithm string, methodology string, count_raw string, median_amount double, p10_amount double, p90_amount double, min_charge double, max_charge double, additional_generic_notes string, additional_payer_notes string, unmapped_json string"
CODES = "item_id string, hospital_id string, code_seq bigint, code string, declared_type string"
MODIFIERS = "hospital_id string, source_sha256 string, modifier_locator string, code string, description string, setting string, payer_name string, plan_name string, payer_description string"
DRIFT = "hospital_id string, source_sha256 string, kind string, column string, n bigint, first_locator string, sample_value string"
QUARANTINE = "hospital_id string, source_sha256 string, source_locator string, reason string, raw_json string"
STAGED = {"charges": CHARGES, "codes": CODES, "modifiers": MODIFIERS, "drift": DRIFT, "quarantine": QUARANTINE, "file": FILES}

# The key of each released table. Null keys are equal to each other.
GRAIN = {
    "fct_standard_charges": ("charge_id",),
    "dim_charge_codes": ("item_id", "code_seq"),
    "agg_code_prices": ("hospital_id", "code_family", "code", "setting", "rate_basis"),
    "rpt_source_conformance": ("hospital_id", "kind", "column"),
    "files": ("hospital_id",),
    "rpt_nppes_file_log": ("seq",),
    "dim_modifiers": ("hospital_id", "code", "setting", "payer_name", "plan_name"),
    "rpt_fhir_summary": ("resource_type",),
    "rpt_fhir_mapping": ("resource_type", "path"),
    "rpt_fhir_code_bridge": ("code_system",),
    "rpt_fhir_claim_totals": ("claim_type",),
    "dim_provider_history": ("npi", "version"),
}
