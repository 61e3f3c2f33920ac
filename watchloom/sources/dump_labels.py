"""The labels of the two bulk dumps and the sources that they are routed to. Fixed values."""

from __future__ import annotations

COMPANY_AGENCY = "Ministry of Corporate Affairs (MCA)"

#: Label -> source id and list name.
COMPANY_LABELS = {
    "MCA Defaulter Companies": ("mca_defaulter_companies", "Defaulter Companies (Filing Default)"),
    "MCA Disqualified Directors": ("mca_disqualified_directors_164", "Disqualified Directors U/S 164(2)(A)"),
    "MCA Struck off Company": ("mca_companies_struck_off", "Companies Struck Off (STK-7) U/S 248(5)"),
    "MCA Defaulter Directors": ("mca_defaulter_directors", "Defaulter Directors (Filing Default)"),
    "MCA Proclaimed Director": ("mca_proclaimed_offenders", "Proclaimed Offenders U/S 82 Cr.PC"),
    "MCA Vanishing Company": ("mca_vanishing_companies", "Vanishing Companies (MCA)"),
    "MCA MLM Company": ("mca_mlm_companies", "MLM / Money-Circulation Companies (Negative List)"),
    "MCA Defaulter Secretaries": ("mca_defaulter_secretaries", "Defaulter Company Secretaries (Filing Default)"),
}

#: The source whose stored records are kept; the dump's go beside them.
COMPANY_KEPT = ("mca_vanishing_companies",)

#: Label -> source id and agency.
NEGATIVE_LABELS = {
    "Negative List NSDL": ("sm_nsdl_negative", "NSDL"),
    "Negative List BSE Delisted Companies": ("sm_bse_delisted", "BSE"),
    "Negative List DVAT Return Defaulters": ("sm_dvat_defaulters", "Delhi VAT (DVAT)"),
    "Negative List BSE Suspended": ("sm_bse_suspended", "BSE"),
    "Negative List RERA Madhya Pradesh Registration Lapsed": ("sm_rera_mp_lapsed", "RERA Madhya Pradesh"),
    "Negative List RERA Madhya Pradesh Defaulter Rejected Application": ("sm_rera_mp_rejected", "RERA Madhya Pradesh"),
    "Negative List RBI Imposed Penalty": ("sm_rbi_penalties", "Reserve Bank of India (RBI)"),
    "Negative List Rajasthan Rera Lapsed": ("sm_rera_rajasthan_lapsed", "RERA Rajasthan"),
    "Negative List PEP Lok Sabha Members": ("sm_pep_lok_sabha", "Parliament of India"),
    "Negative List IRDA warnings and penalties List": ("sm_irda_warnings", "IRDAI"),
    "Negative List PEP Rajya Sabha Members": ("sm_pep_rajya_sabha", "Parliament of India"),
    "Negative List Financial Intelligence Unit By Order": ("sm_fiu_orders", "Financial Intelligence Unit (FIU-IND)"),
    "Negative List East Zone Defaulter": ("sm_east_zone_defaulter", "CBIC East Zone"),
    "Negative List RERA Madhya Pradesh Defaulter Unused Application": ("sm_rera_mp_unused", "RERA Madhya Pradesh"),
    "Negative List Money Control": ("sm_money_control", "MoneyControl"),
    "Negative List NSE Expelled Members": ("sm_nse_expelled", "NSE"),
    "Negative List BSE Defaulter Expelled": ("sm_bse_defaulter_expelled", "BSE"),
    "Negative List MCX Defaulters": ("sm_mcx_defaulters", "Multi Commodity Exchange (MCX)"),
    "Negative List Income Tax Defaulters": ("sm_income_tax_defaulters", "Income Tax Department"),
    "Negative List NSE Defaulter Members": ("sm_nse_defaulter", "NSE"),
    "Negative List Blacklisted NGOs": ("sm_blacklisted_ngos", "Ministry of Home Affairs (MHA)"),
    "Negative List Rajasthan Rera Revoked": ("sm_rera_rajasthan_revoked", "RERA Rajasthan"),
    "Negative List Blacklisted Doctors": ("sm_blacklisted_doctors", "Medical Council of India (MCI)"),
    "Negative List MHA Terrorists": ("sm_mha_terrorists", "Ministry of Home Affairs (MHA)"),
    "Negative List MutualFunds ARN Suspended": ("sm_amfi_arn_suspended", "AMFI"),
    "Negative List RERA Uttar Pradesh Deregistered Projects": ("sm_rera_up_deregistered", "RERA Uttar Pradesh"),
    "Negative List MutualFunds ARN Terminated": ("sm_amfi_arn_terminated", "AMFI"),
    "Negative List NSE Other Order Of MCSGFC": ("sm_nse_mcsgfc_orders", "NSE"),
    "Negative List NCDEX Defaulter Member": ("sm_ncdex_defaulter", "NCDEX"),
    "Negative List Delhi RERA": ("sm_rera_delhi", "RERA Delhi"),
    "Negative List CBIC Service Tax Penalty Or Interest List": ("sm_cbic_service_tax", "CBIC"),
    "Negative List NCDEX Expelled Member": ("sm_ncdex_expelled", "NCDEX"),
    "Negative List CBIC Customs Penalty Or Interest List": ("sm_cbic_customs_penalty", "CBIC"),
    "Negative List RERA Madhya Pradesh Registration Cancelled": ("sm_rera_mp_cancelled", "RERA Madhya Pradesh"),
    "Negative List Rajasthan Rera Suspended": ("sm_rera_rajasthan_suspended", "RERA Rajasthan"),
    "Negative List CBIC Customs Fraud And Collusion List": ("sm_cbic_customs_fraud", "CBIC"),
    "Negative List NCDEX Cessation Member": ("sm_ncdex_cessation", "NCDEX"),
    "Negative List RERA Himachal Pradesh": ("sm_rera_hp", "RERA Himachal Pradesh"),
    "Negative List RBI NBFC": ("sm_rbi_nbfc", "Reserve Bank of India (RBI)"),
}

#: Labels of lists that are loaded from elsewhere.
NEGATIVE_SKIPPED = (
    "Negative List BSE Arbitration Award",
    "Negative List OFAC",
    "Negative List OFSI UK Sanction List",
    "Negative List SEBI Enforcement",
    "Negative List EU Sanctions",
    "Negative List World Bank Listing of Ineligible Firms and Individuals List",
    "Negative List National Housing Bank Penalties",
    "Negative List NFRA Debarment",
    "Negative List MSE Expelled Members",
    "Negative List MSE Defaulter Members",
)
