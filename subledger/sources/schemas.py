"""The twelve table schemas and their constraint registry.

The registry is data, not code: the integrity operators turn each entry into
a Spark predicate, and the oracle tests turn the same text into DuckDB SQL.
Predicates are written in the SQL subset both engines parse identically.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STR = T.StringType()
DATE = T.DateType()
TS = T.TimestampNTZType()
INT = T.IntegerType()
BOOL = T.BooleanType()
MONEY = T.DecimalType(12, 2)
MINUTES = T.DecimalType(10, 2)


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    nullable: bool = False
    length: int | None = None  # VARCHAR(n) limit, checked as a rule


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass
class Table:
    name: str
    columns: list[Col]
    primary_key: str
    uniques: list[tuple[str, ...]] = field(default_factory=list)
    foreign_keys: list[ForeignKey] = field(default_factory=list)
    checks: list[tuple[str, str]] = field(default_factory=list)  # (constraint, holds-when predicate)
    defaults: dict[str, str] = field(default_factory=dict)  # column -> SQL literal / marker

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, c.nullable) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


def _v(name, n, nullable=False):
    return Col(name, STR, nullable, n)


# ---------------------------------------------------------------------------
# Allowed domains of the CHECK constraints (must equal the
# reference's schema).
ACCOUNT_STATUSES = ("active", "suspended", "closed")
PRODUCT_FAMILIES = ("Digital News", "ePaper")
TARGET_SEGMENTS = ("General", "Student", "Organisation")
BILLING_FREQUENCIES = ("Daily", "Weekly", "Monthly", "Annual")
ORGANISATION_TYPES = ("Corporate", "University", "Government", "NGO", "Professional Association", "Other")
SUBSCRIPTION_STATUSES = ("active", "past_due", "ended")
END_REASONS = ("plan_change", "voluntary_cancel", "payment_failure", "non_renewal")
PAYMENT_STATUSES = ("successful", "failed", "pending")
PAYMENT_METHODS = ("mobile_money", "card", "bank_transfer")
FAILURE_REASONS = ("insufficient_funds", "expired_card", "payment_declined", "invalid_payment_details", "timeout", "other")
EVENT_TYPES = (
    "subscription_started", "renewed", "cancellation_requested", "cancellation_reversed", "plan_changed",
    "past_due_started", "past_due_resolved", "subscription_ended", "reactivated", "seats_changed",
)
ORG_USER_STATUSES = ("active", "inactive")
MARKETING_CHANNELS = (
    "Organic Search", "Direct", "Email", "Organic Social", "Paid Social", "Paid Search", "Referral",
    "Affiliate / Partner", "Campus Activation", "Promotional Campaign",
)
TOUCHPOINT_TYPES = ("impression", "click", "visit", "email_open", "email_click", "referral", "campaign_response")
TRIAL_STATUSES = ("active", "converted", "expired", "cancelled")
SUPPORT_CHANNELS = ("email", "phone", "live_chat", "web_form")
ISSUE_CATEGORIES = (
    "billing", "payment", "access_login", "technical", "content", "subscription_change", "cancellation_enquiry", "other",
)
RESOLUTION_STATUSES = ("open", "in_progress", "resolved")
MIN_ORGANISATION_SEATS = 10
MAX_TRIAL_DAYS = 7
DEFAULT_CURRENCY = "KES"
# ---------------------------------------------------------------------------


def _in(col: str, values) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"{col} in ({quoted})"


TABLES: dict[str, Table] = {}


def _table(t: Table) -> Table:
    TABLES[t.name] = t
    return t


_table(Table(
    "customers",
    [_v("customer_id", 20), _v("first_name", 100), _v("last_name", 100), _v("email", 255),
     Col("signup_date", DATE), _v("country", 100), _v("account_status", 20)],
    "customer_id",
    uniques=[("email",)],
    checks=[("chk_customer_account_status", _in("account_status", ACCOUNT_STATUSES))],
))

_table(Table(
    "products",
    [_v("product_id", 20), _v("product_name", 100), _v("product_family", 50), _v("target_segment", 50),
     Col("is_active", BOOL)],
    "product_id",
    uniques=[("product_name",)],
    checks=[("chk_product_family", _in("product_family", PRODUCT_FAMILIES)),
            ("chk_target_segment", _in("target_segment", TARGET_SEGMENTS))],
    defaults={"is_active": "true"},
))

_table(Table(
    "plans",
    [_v("plan_id", 20), _v("product_id", 20), _v("plan_name", 150), _v("billing_frequency", 20),
     Col("billing_period_days", INT), Col("unit_price", MONEY), _v("currency", 10), Col("is_active", BOOL)],
    "plan_id",
    uniques=[("plan_name",)],
    foreign_keys=[ForeignKey("product_id", "products", "product_id")],
    checks=[("chk_billing_frequency", _in("billing_frequency", BILLING_FREQUENCIES)),
            ("chk_billing_period_days", "billing_period_days > 0"),
            ("chk_plan_unit_price", "unit_price >= 0")],
    defaults={"currency": f"'{DEFAULT_CURRENCY}'", "is_active": "true"},
))

_table(Table(
    "organisations",
    [_v("organisation_id", 20), _v("organisation_name", 200), _v("organisation_type", 50), _v("industry", 100),
     Col("organisation_size", INT), Col("signup_date", DATE), _v("billing_contact_name", 150),
     _v("billing_contact_email", 255), _v("account_status", 20), Col("created_at", TS)],
    "organisation_id",
    checks=[("chk_organisation_type", _in("organisation_type", ORGANISATION_TYPES)),
            ("chk_organisation_size", "organisation_size > 0"),
            ("chk_organisation_account_status", _in("account_status", ACCOUNT_STATUSES))],
    defaults={"created_at": "load_time"},
))

_table(Table(
    "subscriptions",
    [_v("subscription_id", 20), _v("customer_id", 20, True), _v("organisation_id", 20, True), _v("plan_id", 20),
     Col("subscription_start_date", DATE), Col("current_period_start", DATE), Col("current_period_end", DATE),
     Col("subscription_end_date", DATE, True), _v("status", 20), Col("auto_renew", BOOL),
     Col("cancellation_requested_at", TS, True), _v("end_reason", 30, True), Col("seats_purchased", INT, True),
     Col("created_at", TS)],
    "subscription_id",
    foreign_keys=[ForeignKey("customer_id", "customers", "customer_id"),
                  ForeignKey("organisation_id", "organisations", "organisation_id"),
                  ForeignKey("plan_id", "plans", "plan_id")],
    checks=[
        ("chk_subscription_owner", "(customer_id is null) <> (organisation_id is null)"),
        ("chk_subscription_status", _in("status", SUBSCRIPTION_STATUSES)),
        ("chk_subscription_end_reason", f"end_reason is null or {_in('end_reason', END_REASONS)}"),
        ("chk_subscription_period", "current_period_end >= current_period_start"),
        ("chk_subscription_start_period", "current_period_start >= subscription_start_date"),
        ("chk_subscription_end_date", "subscription_end_date is null or subscription_end_date >= subscription_start_date"),
        ("chk_subscription_seats",
         f"(organisation_id is not null and seats_purchased >= {MIN_ORGANISATION_SEATS}) "
         "or (organisation_id is null and seats_purchased is null)"),
        ("chk_ended_subscription",
         "status <> 'ended' or (subscription_end_date is not null and end_reason is not null)"),
    ],
    defaults={"auto_renew": "true", "created_at": "load_time"},
))

_table(Table(
    "payments",
    [_v("payment_id", 20), _v("subscription_id", 20), Col("payment_attempted_at", TS), Col("amount", MONEY),
     _v("currency", 10), _v("payment_status", 20), _v("payment_method", 30), _v("transaction_reference", 100, True),
     _v("failure_reason", 50, True), Col("created_at", TS)],
    "payment_id",
    uniques=[("transaction_reference",)],
    foreign_keys=[ForeignKey("subscription_id", "subscriptions", "subscription_id")],
    checks=[
        ("chk_payment_amount", "amount > 0"),
        ("chk_payment_status", _in("payment_status", PAYMENT_STATUSES)),
        ("chk_payment_method", _in("payment_method", PAYMENT_METHODS)),
        ("chk_payment_failure_reason", f"failure_reason is null or {_in('failure_reason', FAILURE_REASONS)}"),
        ("chk_successful_payment_no_failure", "payment_status <> 'successful' or failure_reason is null"),
    ],
    defaults={"currency": f"'{DEFAULT_CURRENCY}'", "created_at": "load_time"},
))

_table(Table(
    "subscription_events",
    [_v("event_id", 20), _v("subscription_id", 20), _v("related_subscription_id", 20, True),
     _v("triggering_payment_id", 20, True), _v("event_type", 40), Col("event_at", TS),
     Col("period_start", DATE, True), Col("period_end", DATE, True), Col("previous_seat_count", INT, True),
     Col("new_seat_count", INT, True), _v("event_reason", 255, True), Col("created_at", TS)],
    "event_id",
    foreign_keys=[ForeignKey("subscription_id", "subscriptions", "subscription_id"),
                  ForeignKey("related_subscription_id", "subscriptions", "subscription_id"),
                  ForeignKey("triggering_payment_id", "payments", "payment_id")],
    checks=[
        ("chk_subscription_event_type", _in("event_type", EVENT_TYPES)),
        ("chk_event_period", "period_start is null or period_end is null or period_end >= period_start"),
        ("chk_previous_seat_count", "previous_seat_count is null or previous_seat_count > 0"),
        ("chk_new_seat_count", "new_seat_count is null or new_seat_count > 0"),
        ("chk_seat_change_event",
         "event_type = 'seats_changed' or (previous_seat_count is null and new_seat_count is null)"),
    ],
    defaults={"created_at": "load_time"},
))

_table(Table(
    "organisation_users",
    [_v("organisation_user_id", 20), _v("organisation_id", 20), _v("subscription_id", 20), _v("email", 255),
     Col("activation_date", DATE), Col("deactivation_date", DATE, True), _v("user_status", 20), Col("created_at", TS)],
    "organisation_user_id",
    uniques=[("subscription_id", "email")],
    foreign_keys=[ForeignKey("organisation_id", "organisations", "organisation_id"),
                  ForeignKey("subscription_id", "subscriptions", "subscription_id")],
    checks=[("chk_org_user_status", _in("user_status", ORG_USER_STATUSES)),
            ("chk_org_user_dates", "deactivation_date is null or deactivation_date >= activation_date")],
    defaults={"created_at": "load_time"},
))

_table(Table(
    "marketing_touchpoints",
    [_v("touchpoint_id", 20), _v("customer_id", 20), Col("touchpoint_at", TS), _v("channel", 50),
     _v("campaign_name", 150, True), _v("touchpoint_type", 50), Col("attributed_cost", MONEY, True), Col("created_at", TS)],
    "touchpoint_id",
    foreign_keys=[ForeignKey("customer_id", "customers", "customer_id")],
    checks=[("chk_marketing_channel", _in("channel", MARKETING_CHANNELS)),
            ("chk_touchpoint_type", _in("touchpoint_type", TOUCHPOINT_TYPES)),
            ("chk_attributed_cost", "attributed_cost is null or attributed_cost >= 0")],
    defaults={"created_at": "load_time"},
))

_table(Table(
    "trials",
    [_v("trial_id", 20), _v("customer_id", 20), _v("product_id", 20), Col("trial_started_at", TS),
     Col("scheduled_end_at", TS), Col("actual_end_at", TS, True), _v("trial_status", 20),
     _v("converted_subscription_id", 20, True), Col("created_at", TS)],
    "trial_id",
    uniques=[("customer_id",)],
    foreign_keys=[ForeignKey("customer_id", "customers", "customer_id"),
                  ForeignKey("product_id", "products", "product_id"),
                  ForeignKey("converted_subscription_id", "subscriptions", "subscription_id")],
    checks=[
        ("chk_trial_status", _in("trial_status", TRIAL_STATUSES)),
        ("chk_trial_dates", "scheduled_end_at > trial_started_at"),
        ("chk_trial_actual_end", "actual_end_at is null or actual_end_at >= trial_started_at"),
        ("chk_trial_max_duration", f"scheduled_end_at <= trial_started_at + interval '{MAX_TRIAL_DAYS}' day"),
        ("chk_trial_conversion", "trial_status <> 'converted' or converted_subscription_id is not null"),
    ],
    defaults={"created_at": "load_time"},
))

_table(Table(
    "customer_engagement",
    [_v("engagement_id", 20), _v("customer_id", 20), Col("engagement_date", DATE), Col("sessions_count", INT),
     Col("articles_viewed", INT), Col("premium_articles_viewed", INT), Col("epaper_opens", INT),
     Col("reading_minutes", MINUTES), Col("created_at", TS)],
    "engagement_id",
    uniques=[("customer_id", "engagement_date")],
    foreign_keys=[ForeignKey("customer_id", "customers", "customer_id")],
    checks=[
        ("chk_sessions_count", "sessions_count >= 0"),
        ("chk_articles_viewed", "articles_viewed >= 0"),
        ("chk_premium_articles_viewed", "premium_articles_viewed >= 0"),
        ("chk_epaper_opens", "epaper_opens >= 0"),
        ("chk_reading_minutes", "reading_minutes >= 0"),
        ("chk_premium_not_greater_than_articles", "premium_articles_viewed <= articles_viewed"),
    ],
    defaults={"created_at": "load_time"},
))

_table(Table(
    "support_interactions",
    [_v("interaction_id", 20), _v("customer_id", 20), _v("subscription_id", 20, True), Col("interaction_at", TS),
     _v("channel", 30), _v("issue_category", 50), _v("resolution_status", 20), Col("resolved_at", TS, True),
     Col("created_at", TS)],
    "interaction_id",
    foreign_keys=[ForeignKey("customer_id", "customers", "customer_id"),
                  ForeignKey("subscription_id", "subscriptions", "subscription_id")],
    checks=[
        ("chk_support_channel", _in("channel", SUPPORT_CHANNELS)),
        ("chk_support_issue", _in("issue_category", ISSUE_CATEGORIES)),
        ("chk_resolution_status", _in("resolution_status", RESOLUTION_STATUSES)),
        ("chk_support_resolution_date", "resolved_at is null or resolved_at >= interaction_at"),
        ("chk_resolved_interaction", "resolution_status <> 'resolved' or resolved_at is not null"),
    ],
    defaults={"created_at": "load_time"},
))

# Parents first, as the schema script creates them.
LOAD_ORDER = [
    "customers", "products", "plans", "organisations", "subscriptions", "payments", "subscription_events",
    "organisation_users", "marketing_touchpoints", "trials", "customer_engagement", "support_interactions",
]
