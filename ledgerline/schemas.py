"""The staging contract: every column of a flattened record, in order, with the way it is read from text."""

from __future__ import annotations

# Columns by kind; the contract has them in the order of their names. Numbers are whole.
DATES = "probate_lead_filing_date rp_file_date statement_date".split()
FLAGS = "is_owner_grantee is_owner_grantor is_potential_decedent_match needs_review_flag".split()
NUMBERS = """date_proximity_score days_apart hcad_appraised_value_summary hcad_bedrooms hcad_building_area_count
hcad_best_property_fit_score hcad_full_bathrooms hcad_garage_sqft hcad_grade_adjustment hcad_half_bathrooms
hcad_impr_total_sqft hcad_improvement_market_value hcad_land_line_count hcad_land_market_value
hcad_land_market_value_total hcad_list_page_summary_rank_score hcad_lot_sqft_total hcad_market_value_summary
hcad_sqft_summary hcad_total_base_sqft hcad_total_structure_sqft hctax_appraised_value
hctax_improvements_market_value hctax_land_market_value hctax_total_market_value instrument_weight
match_score_total name_first_score name_last_score party_role_score rp_legal_block rp_legal_lot rp_legal_sec
rp_signal_strength score_hcad_vs_best_rp_grantee score_hcad_vs_probate score_hcad_vs_rp_party
score_probate_vs_rp_party search_tier_weight total_current_taxes_due taxes_due_by_jan31""".split()
DOCUMENTS = "hcad_appraised_history_json hcad_building_data_json hcad_land_data_json hcad_other_characteristics_json".split()
TEXTS = """account_status_text account_to_search cleaned_probate_lead_decedent_first cleaned_probate_lead_decedent_last
cleaned_rp_party_first_name cleaned_rp_party_last_name contact_target_tier error exemption_code hcad_account
hcad_account_summary hcad_address_summary hcad_appraised_value_detail hcad_detail_url hcad_detail_url_visited
hcad_exterior_wall hcad_final_tier_hit hcad_foundation_type hcad_heating_ac hcad_legal_desc_detail
hcad_mailing_address hcad_market_value_detail hcad_owner_full_name hcad_owner_match_type hcad_owner_summary
hcad_physical_condition hcad_search_status hcad_site_address hcad_zip_summary hctax_account hctax_legal_desc_full
hctax_owner_full_name hctax_owner_mailing_address hctax_site_address match_confidence_level owner_contact_name
owner_contact_rationale prior_years_taxes_due probate_lead_county probate_lead_decedent_first
probate_lead_decedent_last probate_lead_signal_strength probate_lead_status probate_lead_subtype
probate_lead_type_desc probate_name review_reason rp_file_number rp_found_by_search_term
rp_grantee_full_names_list rp_instrument_type rp_legal_abstract rp_legal_description_text rp_legal_tract
rp_party_first_name rp_party_full_name rp_party_last_name rp_party_type rp_search_tier soundex_decedent_last
soundex_rp_party_last""".split()
KEY = "probate_lead_case_number"
STAGED = sorted([KEY, *DATES, *FLAGS, *NUMBERS, *DOCUMENTS, *TEXTS])
# Zones of a report of leads, in reading order; columns that no zone names come last.
ZONES = {
    "1 Lead Triage": "contact_target_tier owner_contact_rationale match_confidence_level needs_review_flag review_reason match_score_total".split(),
    "2 Core People & Property": "owner_contact_name probate_name hcad_owner_full_name hctax_owner_full_name rp_party_full_name hctax_site_address hcad_site_address hctax_legal_desc_full hcad_legal_desc_detail".split(),
    "3 Enriched Contact": "contact_phone contact_email hctax_owner_mailing_address hcad_mailing_address".split(),
    "4 Financial & Tax Signals": "total_current_taxes_due prior_years_taxes_due account_status_text hctax_total_market_value hcad_market_value_detail hctax_appraised_value hcad_appraised_value_detail hcad_appraised_history_json account_to_search".split(),
    "5 Detailed Property": "hcad_bedrooms hcad_full_bathrooms hcad_half_bathrooms hcad_total_living_area_sf hcad_total_base_sqft hcad_lot_sqft_total hcad_physical_condition hcad_foundation_type hcad_exterior_wall hcad_roof_type hcad_heating_ac exemption_code hcad_building_data_json hcad_land_data_json hcad_land_market_value_total hcad_land_line_count hcad_total_structure_sqft hcad_garage_sqft hcad_building_area_count hcad_grade_adjustment hcad_land_market_value hcad_improvement_market_value".split(),
    "6 Provenance": "probate_lead_case_number rp_file_number hcad_account hctax_account hcad_owner_match_type hcad_search_status score_hcad_vs_probate score_hcad_vs_rp_party hcad_account_summary hcad_owner_summary hcad_address_summary".split(),
}
# What a property's detail page gives, all of it null where the page has none.
DETAIL = """hcad_account hcad_owner_full_name hcad_mailing_address hcad_legal_desc_detail hcad_site_address hcad_pct_ownership
hcad_market_value_detail hcad_appraised_value_detail hcad_land_area_sf hcad_total_living_area_sf hcad_lot_sqft_total
hcad_land_market_value_total hcad_land_line_count hcad_land_data_json hcad_total_base_sqft hcad_total_structure_sqft
hcad_garage_sqft hcad_building_area_count hcad_building_data_json hcad_main_building_data_json hcad_foundation_type
hcad_exterior_wall hcad_heating_ac hcad_grade_adjustment hcad_physical_condition hcad_full_bathrooms hcad_bedrooms
hcad_land_market_value hcad_improvement_market_value hcad_appraised_history_json hcad_detail_url_visited parsing_error""".split()
ESSENTIAL = "probate_lead_decedent_first probate_lead_decedent_last rp_party_type rp_file_number is_potential_decedent_match".split()
