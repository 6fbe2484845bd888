"""Fixed values of the ticketing data model, and the ones a site configures."""

from __future__ import annotations

# --- Fixed values: titles of the custom ticket fields that the views and the audit filter read.
TITLE_PRIORITY = "Case Priority"
TITLE_COMPONENT = "Component"
TITLE_CAUSE = "Root Cause"
TITLE_VERSION = "Confluent/Kafka Version"
TITLE_BUNDLE = "Support Bundle Used"
TITLE_TIME_TOTAL = "Total time spent (sec)"
TITLE_TIME_LAST = "Time spent last update (sec)"

# --- Fixed values: ticket attribute of the wide ticket view -> field title.
TICKET_ATTRIBUTES = {
    "priority": TITLE_PRIORITY,
    "component": TITLE_COMPONENT,
    "cause": TITLE_CAUSE,
    "version": TITLE_VERSION,
    "bundleused": TITLE_BUNDLE,
}

# --- Fixed values: organization attribute of the wide organization view -> field key.
ORGANIZATION_ATTRIBUTES = {
    "entitlement": "subscription_type",
    "renewaldate": "renewal_date",
    "se": "systems_engineer",
    "tam": "technical_account_manager",
    "timezone": "primary_timezone",
}

# --- Fixed values: which audit events are kept.
AUDIT_EVENT_TYPE = "Change"
AUDIT_TITLES = (TITLE_TIME_TOTAL, TITLE_PRIORITY, TITLE_TIME_LAST)

# --- Fixed values: paging and fetch outcomes.
FULL_PAGE = 1000
API_PATH = "/api/v2"

# --- Fixed values: text for a missing text column, number for a missing time column.
UNDEFINED = "UNDEFINED"
NO_TIME = -1

# --- Fixed values: mailbox -> ticket type. Anything else counts as DEFAULT_TICKET_TYPE.
DEFAULT_TICKET_TYPE = "enterprise"
COMPANY_MAILBOXES = {
    "escalations": "escalation",
    "se-support": "se-support",
    "support": "enterprise",
    "cloud-support": "cloud-professional",
}
DESK_MAILBOXES = {
    "support-escalations": "escalation",
    "se-support": "se-support",
    "support": "enterprise",
    "cloud-support": "cloud-professional",
}


def recipient_types(company: str = "example.com", desk: str = "desk.example.com") -> dict[str, str]:
    """The eight recipient addresses of a site and the ticket type each stands for.

    ``company`` is the site's own mail domain, ``desk`` the domain its ticketing service
    receives mail under.
    """
    types = {f"{box}@{company}": kind for box, kind in COMPANY_MAILBOXES.items()}
    types |= {f"{box}@{desk}": kind for box, kind in DESK_MAILBOXES.items()}
    return types
