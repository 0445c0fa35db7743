"""Canonical column names for spreadsheet headers."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

# Spellings whose canonical name does not follow from the rules below.
HEADER_ALIASES = {
    "TransactionType": "transaction_type",
    "Policy #": "policy_number",
    "Policy Number": "policy_number",
    "PolicyNumber": "policy_number",
    "Policy": "policy_number",
    "Previous Policy": "prior_policy_number",
    "PriorPolicyNumber": "prior_policy_number",
    "InceptionDate": "policy_effective_date",
    "Inception Date": "policy_effective_date",
    "Expiration Date": "policy_expiration_date",
    "ExpirationDate": "policy_expiration_date",
    "TransactionEffectiveDate": "transaction_effective_date",
    "EndorsementNumber": "endorsement_number",
    "RateMethod": "rate_method",
    "RateMod": "rate_mod",
    "StatusTypeDescription": "status_type_description",
    "PolicyTypeDescription": "policy_type_description",
    "RatingCompany": "rating_company",
    "InsuredName": "insured_name",
    "AddressLine1": "address_line_1",
    "AddressLine2": "address_line_2",
    "ZipCode": "zip_code",
    "MGUCode": "mgu_code",
    "AuditFreq": "audit_freq",
    "CommissionPerc": "commission_percentage",
    "CommissionPrec": "commission_percentage",
    "GrossPremium": "gross_premium",
    "OccLmt": "occ_lmt",
    "AggLmt": "agg_lmt",
    "ClassCode": "class_code",
    "PolType": "pol_type",
    "ProRate": "pro_rate",
    "#RatEmp": "num_rat_emp",
    "TotEmp": "tot_emp",
    "CoverageDescription": "coverage_description",
    "ChangeLongDesc": "change_long_desc",
    "RetainedLimit": "retained_limit",
    "WrittenTax": "written_tax",
    "NIPCode": "nip_code",
    "CoveragePremium": "coverage_premium",
    "MAWaiver": "ma_waiver",
    "RCIndicator": "rc_indicator",
    "um2": "um_2",
    "um3": "um_3",
    "CoverageCode": "coverage_code",
    " PolicyAggregateLimit": "policy_aggregate_limit",
}

# Spelling rules, applied in this order to the trimmed header.
_BEFORE_LOWER = (
    ("#", "num_"),
    (r" \(see tab\)| \(SEE TAB\)", ""),
    (" ?- ?", "_"),
    (r"[()]", ""),
    ("%", "perc"),
)
_AFTER_LOWER = (
    (" &", "_AND_"),
    (" ?/ ?", "_OR_"),
    ("'", ""),
    (r"\.", "_"),
    ("_or_", "_OR_"),
    (" ", "_"),
    ("__", "_"),
)


def _rewrite(text: str, rules: Iterable[tuple[str, str]]) -> str:
    for pattern, replacement in rules:
        text = re.sub(pattern, replacement, text)
    return text


def canonical_name(header: str, aliases: dict[str, str] = HEADER_ALIASES) -> str:
    """Canonical form of one header; may be empty."""
    if header in aliases:
        return aliases[header]
    return _rewrite(_rewrite(header.strip(), _BEFORE_LOWER).strip().lower(), _AFTER_LOWER)


def canonical_names(headers: Iterable[str | None], aliases: dict[str, str] = HEADER_ALIASES) -> list[str]:
    """One unique name per header, position for position.

    A clash (also one in letter case only) gets trailing underscores until it is
    unique.  A header with no usable text becomes ``col_<position>`` so that
    names never shift.
    """
    taken: set[str] = set()
    names = []
    for position, header in enumerate(headers):
        name = canonical_name(header or "", aliases) or f"col_{position}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def canonical_headers(df: DataFrame, aliases: dict[str, str] = HEADER_ALIASES) -> DataFrame:
    return df.toDF(*canonical_names(df.columns, aliases))


def upper_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def quoted(name: str) -> str:
    """A column name that may hold spaces, dots or backticks, as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"
