"""Texts of the issue log as small rule tables; pass your own to replace them."""

# --- fixed values -------------------------------------------------------------
# (detection rule, column or None for any column, text)
ROOT_CAUSES = (
    ("null_check", "cost_centre",
     "Expense submission form doesn't enforce cost_centre as a mandatory field, "
     "so a claim can be submitted without one."),
    ("negative_value", "quantity",
     "Manual quantity entry in the legacy procurement screen allows negative values "
     "with no validation, likely used informally to record returns or credits."),
    ("invalid_currency", "currency",
     "Currency is entered as free text rather than selected from a controlled list, "
     "allowing typos such as 'GBP' mistyped as 'GPB'."),
    ("cost_centre_format_drift", "cost_centre",
     "No enforced input format for cost_centre in the legacy system; different "
     "regional offices/business units free-text the code in their own local convention."),
    ("status_date_contradiction", "employment_status",
     "Termination processing updates termination_date manually but doesn't automatically "
     "flip employment_status, leaving the two fields able to drift out of sync."),
    ("exact_name_match", "name",
     "Manual re-entry by different HR administrators with no dedup check at source "
     "(e.g. onboarding processed twice before the first record was visible)."),
    ("name_abbreviation", "name",
     "Manual re-entry by different HR administrators with no dedup check at source; "
     "a shortened name variant was used on the second entry."),
    ("fuzzy_name_match", "name",
     "Manual re-entry by different HR administrators with no dedup check at source; "
     "the second entry has minor spelling differences from the first."),
    ("company_suffix_match", "vendor_name",
     "Vendor was onboarded independently by different purchasing/AP staff with no shared "
     "vendor master or dedup check, so it exists under two vendor codes with slightly "
     "different legal-name formatting."),
    ("fuzzy_name_match", "vendor_name",
     "Vendor was onboarded independently by different purchasing/AP staff with no shared "
     "vendor master or dedup check; the second entry has minor spelling differences from "
     "the first."),
    ("orphan_fk", "vendor_id",
     "Finance and Procurement maintain separate vendor references with no shared "
     "master-data validation at posting time, so a GL entry can be posted against a "
     "vendor_id that no longer exists (or never existed) in Procurement."),
    ("orphan_fk", "employee_id",
     "Termination process doesn't trigger downstream deactivation in dependent systems, "
     "so a leaver's employee_id can still be used on new expense claims after they've left."),
    ("date_out_of_bounds", None,
     "Date fields accept free-text/manual entry with no range validation against "
     "plausible business dates."),
)
ROOT_CAUSE_BY_TYPE = (
    ("completeness", "Required field was not enforced as mandatory at the point of entry in the legacy system."),
    ("accuracy", "No input validation at the point of entry allowed an out-of-range or invalid value to be saved."),
    ("consistency", "No enforced format/business rule at the point of entry allowed the same information to be "
                    "recorded inconsistently."),
    ("duplication", "Manual re-entry by different users with no dedup check at source."),
    ("obsolete_orphaned", "No referential integrity enforcement between source systems at the point of entry."),
)
ROOT_CAUSE_DEFAULT = "Root cause not yet determined; needs manual investigation."

_HEADCOUNT = ("A duplicated employee record can split one person's headcount and costs across "
              "two IDs, distorting workforce reporting and risking a duplicate payment.")
_SPLIT_VENDOR = ("A vendor split across two vendor codes fragments spend reporting for that supplier "
                 "and increases the risk of paying them twice or missing volume-discount thresholds.")
BUSINESS_IMPACTS = (
    ("null_check", "cost_centre",
     "Expense claims may be approved without a cost centre attached, so that spend "
     "won't show up against any budget owner's report."),
    ("negative_value", "quantity",
     "A negative quantity on a purchase order can understate goods received or "
     "misrepresent a return, throwing off stock and spend reports."),
    ("invalid_currency", "currency",
     "A mistyped currency code can cause a transaction to be misconverted or dropped "
     "from currency-based reporting, misstating reported spend."),
    ("cost_centre_format_drift", "cost_centre",
     "A cost centre recorded in a non-standard format won't match up with HR or Finance "
     "records for that cost centre, so spend and headcount reporting for it will look incomplete."),
    ("status_date_contradiction", "employment_status",
     "An employee shown as still Active despite having left may keep system access or "
     "keep accruing costs (e.g. approvals, payroll) they shouldn't."),
    ("exact_name_match", "name", _HEADCOUNT),
    ("name_abbreviation", "name", _HEADCOUNT),
    ("fuzzy_name_match", "name", _HEADCOUNT),
    ("company_suffix_match", "vendor_name", _SPLIT_VENDOR),
    ("fuzzy_name_match", "vendor_name", _SPLIT_VENDOR),
    ("orphan_fk", "vendor_id",
     "This spend can't be traced back to a valid vendor record, which breaks "
     "spend-by-vendor reporting and leaves a gap in the audit trail."),
    ("orphan_fk", "employee_id",
     "An expense claim references someone who has already left the company, so a "
     "payment or approval could be processed for a person no longer employed."),
    ("date_out_of_bounds", None,
     "A date outside the plausible business range can distort time-based reporting "
     "(e.g. spend-by-period, headcount-by-hire-date)."),
)
IMPACT_BY_TYPE = (
    ("completeness", "Missing data on this record means it may be excluded from, or misrepresented in, "
                     "downstream reports."),
    ("accuracy", "An invalid value on this record can produce an incorrect figure in downstream reports."),
    ("consistency", "Inconsistent formatting on this record may cause it to fail to match against related "
                    "records in other systems."),
    ("duplication", "A duplicate record can double-count activity or split it across two IDs, distorting reporting."),
    ("obsolete_orphaned", "This record references something that no longer exists elsewhere in the source data, "
                          "breaking traceability."),
)
IMPACT_DEFAULT = "Downstream impact not yet assessed; needs manual investigation."

STILL_OPEN_REASONS = (
    ("completeness", "blank value at source - no imputation/rejection logic in scope for this stage."),
    ("accuracy", "invalid/out-of-range value - no correction logic in scope for this stage."),
    ("duplication", "employee-level duplicate - no merge/dedup mechanism built for HR at this stage."),
    ("obsolete_orphaned", "references a vendor/employee id that never existed or was never deactivated - "
                          "no valid target to map to."),
)
STILL_OPEN_DEFAULT = "not resolved by this stage."
STATUS_DROPPED_NOTE = (
    "employment_status dropped from target_hr mapping per Stage 3 sign-off; "
    "employment status is now derived solely from termination_date (single source "
    "of truth), eliminating the Active/past-termination_date contradiction.")
# -------------------------------------------------------------------------------
