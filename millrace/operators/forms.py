"""Search forms and indexes as data: what each parameter and each index means, and the filters that they give."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .search import lookup

#: The parameters of the search form for registrations and reports: how one is compared, and with what.
#: text: holds it, in any case; one: equals it, or one of a list; from, to: ends of a range, both included; flag: whether there is any.
REPORT_FORM = {
    "registrant_name": ("text", "registrant.name"),
    "registrant_id": ("one", "registrant.id"),
    "registrant_country": ("one", "registrant.country"),
    "registrant_ppb_country": ("one", "registrant.ppb_country"),
    "client_name": ("text", "client.name"),
    "client_id": ("one", "client.id"),
    "client_state": ("one", "client.state"),
    "client_country": ("one", "client.country"),
    "client_ppb_country": ("one", "client.ppb_country"),
    "client_ppb_state": ("one", "client.ppb_state"),
    "lobbyist_name": ("text", "lobbyists[].name"),
    "lobbyist_id": ("one", "lobbyists[].id"),
    "lobbyist_covered_position": ("text", "lobbyists[].covered_position"),
    "lobbyist_covered_position_indicator": ("flag", "lobbyists[].covered_position"),
    "lobbyist_conviction_disclosure": ("text", "convictions[].description"),
    "lobbyist_conviction_disclosure_indicator": ("flag", "convictions[].description"),
    "lobbyist_conviction_date_range_after": ("from", "convictions[].date"),
    "lobbyist_conviction_date_range_before": ("to", "convictions[].date"),
    "filing_type": ("one", "type"),
    "filing_period": ("one", "period"),
    "filing_year": ("one", "year"),
    "filing_dt_posted_after": ("from", "posted"),
    "filing_dt_posted_before": ("to", "posted"),
    "filing_amount_reported_min": ("from", "amount"),
    "filing_amount_reported_max": ("to", "amount"),
    "senate_doc_id": ("one", "senate_doc_id"),
    "house_doc_id": ("one", "house_doc_id"),
    "filing_specific_lobbying_issues": ("text", "activities[].description"),
    "general_issue_code": ("one", "activities[].issue_code"),
    "government_entities": ("one", "entities[]"),
    "affiliated_organization_name": ("text", "affiliates[].name"),
    "affiliated_organization_listed_indicator": ("flag", "affiliates[].name"),
    "affiliated_organization_country": ("one", "affiliates[].country"),
    "foreign_entity_name": ("text", "foreign[].name"),
    "foreign_entity_listed_indicator": ("flag", "foreign[].name"),
    "foreign_entity_country": ("one", "foreign[].country"),
    "foreign_entity_ppb_country": ("one", "foreign[].ppb_country"),
    "foreign_entity_ownership_percentage_min": ("from", "foreign[].percentage"),
    "foreign_entity_ownership_percentage_max": ("to", "foreign[].percentage"),
}
#: The parameters of the search form for contribution reports; `none` with True: there is no such value.
CONTRIBUTION_FORM = {
    "registrant_name": ("text", "registrant.name"),
    "registrant_id": ("one", "registrant.id"),
    "lobbyist_name": ("text", "lobbyist.name"),
    "lobbyist_id": ("one", "lobbyist.id"),
    "exclude_registrant_lobbyists": ("none", "lobbyist.id"),
    "filing_type": ("one", "type"),
    "filing_period": ("one", "period"),
    "filing_year": ("one", "year"),
    "filing_dt_posted_after": ("from", "posted"),
    "filing_dt_posted_before": ("to", "posted"),
    "senate_doc_id": ("one", "senate_doc_id"),
    "house_doc_id": ("one", "house_doc_id"),
    "contribution_date_after": ("from", "items[].date"),
    "contribution_date_before": ("to", "items[].date"),
    "contribution_amount_min": ("from", "items[].amount"),
    "contribution_amount_max": ("to", "items[].amount"),
    "contribution_type": ("one", "items[].type"),
    "contributor_name": ("text", "items[].contributor"),
    "payee_name": ("text", "items[].payee"),
    "honoree_name": ("text", "items[].honoree"),
}
#: The indexes of awards, bills and insider filings, by their hash and range keys.
AWARD_INDEXES = {
    "fiscal_year_obligation": ("fiscal_year", "total_obligated_amount"),
    "agency_code_obligation": ("awarding_agency_code", "total_obligated_amount"),
    "agency_name_obligation": ("awarding_agency_name", "total_obligated_amount"),
    "recipient_obligation": ("recipient_name_normalized", "total_obligated_amount"),
    "state_obligation": ("recipient_location_state", "total_obligated_amount"),
    "zip_obligation": ("recipient_zip_code", "total_obligated_amount"),
    "fiscal_year_end_date": ("fiscal_year", "period_end_date"),
    "assistance_fiscal_year": ("is_assistance", "fiscal_year"),
    "assistance_modified": ("is_assistance", "last_modified_date"),
}
BILL_INDEXES = {
    "sponsor_party": ("sponsor_party", "introduced_date"),
    "sponsor_name": ("sponsor_full_name", "introduced_date"),
    "congress_type": ("congress", "bill_type"),
    "type": ("bill_type", "introduced_date"),
    "title": ("bill_title", "introduced_date"),
    "number": ("bill_number", "introduced_date"),
    "bipartisan": ("bipartisan", "introduced_date"),
    "latest_action": ("latest_action_date", None),
    "policy_area": ("policy_area", "introduced_date"),
    "has_roll_call": ("has_roll_call", "introduced_date"),
    "introduced": ("introduced_date", None),
}
FILING_INDEXES = {
    "form": ("form", "filing_date"),
    "reporting_for": ("reporting_for", "filing_date"),
    "entity": ("filing_entity", "filing_date"),
    "location": ("located", "filing_date"),
    "incorporated": ("incorporated", "filing_date"),
    "cik": ("cik", "filing_date"),
    "file_number": ("file_number", "filing_date"),
    "film_number": ("film_number", "filing_date"),
}


def _compare(c: Column, op: str, value: Any) -> Column:
    if op == "text":
        return F.contains(F.lower(c), F.lit(str(value).lower()))
    if op == "from":
        return c >= F.lit(value)
    if op == "to":
        return c <= F.lit(value)
    if op in ("flag", "none"):
        return c.isNotNull() if op == "flag" else c.isNull()
    return c.isin(list(value)) if isinstance(value, (list, tuple, set)) else c == F.lit(value)


def conditions(form: dict[str, tuple[str, str]], given: dict[str, Any]) -> Iterator[Column]:
    """The filters of the parameters given; None asks for nothing, and a flag that is False for none such.

    Parameters of one path of a list must hold of one of its elements together, so the
    two ends of a range meet in one element; parameters of different paths may hold of
    different elements.
    """
    paths: dict[str, list[tuple[str, Any]]] = {}
    for name, value in given.items():
        if name not in form:
            raise KeyError(f"no such parameter: {name}")
        if value is not None:
            op, path = form[name]
            paths.setdefault(path if op not in ("flag", "none") else f"{path}?{name}", []).append((op, value))
    for key, asked in paths.items():
        path = key.split("?")[0]
        head, many, rest = path.partition("[]")

        def all_of(c: Column, asked=asked) -> Column:
            return reduce(Column.__and__, [_compare(c, op, v) for op, v in asked])

        if many:
            one = _any(head, rest.lstrip("."), all_of)
        else:
            one = all_of(F.col(path))
        one = F.coalesce(one, F.lit(False))
        yield ~one if asked[0][0] in ("flag", "none") and asked[0][1] is False else one


def _any(head: str, leaf: str, test) -> Column:
    return F.exists(F.col(head), lambda x: test(x[leaf] if leaf else x))


def search_form(df: DataFrame, form: dict[str, tuple[str, str]], **given: Any) -> DataFrame:
    """Rows that fulfil all parameters given."""
    return df.filter(reduce(Column.__and__, conditions(form, given), F.lit(True)))


def by_index(df: DataFrame, indexes: dict[str, tuple[str, str | None]], name: str, value: Any, between: tuple = (None, None), descending: bool = True, limit: int | None = None, tie: str | None = None) -> DataFrame:
    """A query of an index: equality on its hash key, a range and an order on its range key; rows without its keys are not in it."""
    hash_key, range_key = indexes[name]
    if range_key is None:
        out = df.filter(F.col(hash_key) == F.lit(value))
        out = out.orderBy(tie) if tie else out
        return out.limit(limit) if limit else out
    return lookup(df, hash_key, value, range_key, between, descending, limit, tie)
