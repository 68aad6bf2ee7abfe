"""Headings of filing sections, as ordered lists of (pattern, section): the first pattern that finds a heading wins it."""

from __future__ import annotations

# Short headings without item numbers, which neither T8 nor T10 lists.
PLAIN = [("risk factors", "RISK"), ("legal matters", "LEGAL"), ("liquidity", "LIQUIDITY"), ("overview", "OVERVIEW")]
# T8: items of annual and quarterly reports, parts, statements.
DOCUMENT = [
    (r"Item\s+1[A]?\.?\s*Business", "ITEM_1_BUSINESS"),
    (r"Item\s+1A\.?\s*Risk\s+Factors", "ITEM_1A_RISK_FACTORS"),
    (r"Item\s+1B\.?\s*Unresolved\s+Staff\s+Comments", "ITEM_1B_UNRESOLVED_COMMENTS"),
    (r"Item\s+2\.?\s*Properties", "ITEM_2_PROPERTIES"),
    (r"Item\s+3\.?\s*Legal\s+Proceedings", "ITEM_3_LEGAL_PROCEEDINGS"),
    (r"Item\s+4\.?\s*Mine\s+Safety\s+Disclosures", "ITEM_4_MINE_SAFETY"),
    (r"Item\s+5\.?\s*Market\s+for\s+Registrant", "ITEM_5_MARKET"),
    (r"Item\s+6\.?\s*Selected\s+Financial\s+Data", "ITEM_6_FINANCIAL_DATA"),
    (r"Item\s+7\.?\s*Management.*Discussion", "ITEM_7_MD_AND_A"),
    (r"Item\s+7A\.?\s*Quantitative\s+and\s+Qualitative", "ITEM_7A_MARKET_RISK"),
    (r"Item\s+8\.?\s*Financial\s+Statements", "ITEM_8_FINANCIAL_STATEMENTS"),
    (r"Item\s+9\.?\s*Changes\s+in\s+and\s+Disagreements", "ITEM_9_DISAGREEMENTS"),
    (r"Item\s+9A\.?\s*Controls\s+and\s+Procedures", "ITEM_9A_CONTROLS"),
    (r"Item\s+9B\.?\s*Other\s+Information", "ITEM_9B_OTHER_INFORMATION"),
    (r"Item\s+10\.?\s*Directors", "ITEM_10_DIRECTORS"),
    (r"Item\s+11\.?\s*Executive\s+Compensation", "ITEM_11_EXECUTIVE_COMPENSATION"),
    (r"Item\s+12\.?\s*Security\s+Ownership", "ITEM_12_SECURITY_OWNERSHIP"),
    (r"Item\s+13\.?\s*Certain\s+Relationships", "ITEM_13_RELATIONSHIPS"),
    (r"Item\s+14\.?\s*Principal\s+Accountant\s+Fees", "ITEM_14_ACCOUNTANT_FEES"),
    (r"Item\s+15\.?\s*Exhibits", "ITEM_15_EXHIBITS"),
    (r"Item\s+1\.?\s*Financial\s+Statements", "ITEM_1_FINANCIAL_STATEMENTS"),
    (r"Item\s+2\.?\s*Management.*Discussion", "ITEM_2_MD_AND_A"),
    (r"Item\s+3\.?\s*Quantitative\s+and\s+Qualitative", "ITEM_3_MARKET_RISK"),
    (r"Item\s+4\.?\s*Controls\s+and\s+Procedures", "ITEM_4_CONTROLS"),
    (r"Part\s+I", "PART_I"),
    (r"Part\s+II", "PART_II"),
    (r"Part\s+III", "PART_III"),
    (r"Part\s+IV", "PART_IV"),
    (r"Consolidated\s+Balance\s+Sheets?", "BALANCE_SHEETS"),
    (r"Consolidated\s+Statements?\s+of\s+Operations", "INCOME_STATEMENTS"),
    (r"Consolidated\s+Statements?\s+of\s+Cash\s+Flows", "CASH_FLOW_STATEMENTS"),
    (r"Consolidated\s+Statements?\s+of\s+Stockholders'\s+Equity", "EQUITY_STATEMENTS"),
    (r"Notes\s+to\s+.*Financial\s+Statements", "NOTES_TO_FINANCIAL_STATEMENTS"),
]
# T10: by filing type, the key "" for all others; each list is followed by SUBSECTIONS.
_RENAMED = {"ITEM_1B_UNRESOLVED_COMMENTS": "ITEM_1B_UNRESOLVED_STAFF_COMMENTS", "ITEM_4_MINE_SAFETY": "ITEM_4_MINE_SAFETY_DISCLOSURES", "ITEM_6_FINANCIAL_DATA": "ITEM_6_SELECTED_FINANCIAL_DATA"}
SUBSECTIONS = [
    (r"Consolidated Balance Sheets?", "CONSOLIDATED_BALANCE_SHEET"),
    (r"Consolidated Statements? of Operations", "CONSOLIDATED_INCOME_STATEMENT"),
    (r"Consolidated Statements? of Cash Flows?", "CONSOLIDATED_CASH_FLOW"),
    (r"Consolidated Statements? of Stockholders['\"]? Equity", "CONSOLIDATED_EQUITY"),
    (r"Consolidated Statements? of Comprehensive Income", "CONSOLIDATED_COMPREHENSIVE_INCOME"),
    (r"Controls and Procedures", "CONTROLS_AND_PROCEDURES"),
    (r"Critical Accounting (Policies|Estimates)", "CRITICAL_ACCOUNTING"),
    (r"Forward[-\s]Looking Statements?", "FORWARD_LOOKING"),
    (r"Liquidity and Capital Resources", "LIQUIDITY_AND_CAPITAL"),
    (r"Results? of Operations", "RESULTS_OF_OPERATIONS"),
    (r"Significant Accounting Policies", "SIGNIFICANT_ACCOUNTING_POLICIES"),
]
BY_TYPE = {
    "10-K": [(r"Item\s+1\.?\s*Business", "ITEM_1_BUSINESS"), *((p, _RENAMED.get(s, s)) for p, s in DOCUMENT[1:20]), *SUBSECTIONS],
    "10-Q": [
        (r"Item\s+1\.?\s*Financial\s+Statements", "ITEM_1_FINANCIAL_STATEMENTS"),
        (r"Item\s+2\.?\s*Management.*Discussion", "ITEM_2_MD_AND_A"),
        (r"Item\s+3\.?\s*Quantitative\s+and\s+Qualitative", "ITEM_3_MARKET_RISK"),
        (r"Item\s+4\.?\s*Controls\s+and\s+Procedures", "ITEM_4_CONTROLS"),
        (r"Item\s+1\.?\s*Legal\s+Proceedings", "ITEM_1_LEGAL_PROCEEDINGS"),
        (r"Item\s+1A\.?\s*Risk\s+Factors", "ITEM_1A_RISK_FACTORS"),
        (r"Item\s+2\.?\s*Unregistered\s+Sales", "ITEM_2_UNREGISTERED_SALES"),
        (r"Item\s+3\.?\s*Defaults", "ITEM_3_DEFAULTS"),
        (r"Item\s+4\.?\s*Mine\s+Safety\s+Disclosures", "ITEM_4_MINE_SAFETY"),
        (r"Item\s+5\.?\s*Other\s+Information", "ITEM_5_OTHER_INFORMATION"),
        (r"Item\s+6\.?\s*Exhibits", "ITEM_6_EXHIBITS"),
        (r"Notes\s+to.*(Financial\s+Statements|Condensed)", "NOTES_TO_FINANCIAL_STATEMENTS"),
        (r"Management.*Discussion.*Analysis", "MANAGEMENT_DISCUSSION"),
        (r"Part\s+I\.?\s*Financial\s+Information", "PART_I_FINANCIAL_INFORMATION"),
        (r"Part\s+II\.?\s*Other\s+Information", "PART_II_OTHER_INFORMATION"),
        *SUBSECTIONS,
    ],
    "": [
        (r"Financial\s+Statements", "FINANCIAL_STATEMENTS"),
        (r"Notes\s+to.*Financial\s+Statements", "NOTES_TO_FINANCIAL_STATEMENTS"),
        (r"Management.*Discussion.*Analysis", "MANAGEMENT_DISCUSSION"),
        (r"Risk\s+Factors", "RISK_FACTORS"),
        *SUBSECTIONS,
    ],
}
