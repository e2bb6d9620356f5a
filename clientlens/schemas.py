"""Registry of the seven input entities and the five marts.

Everything that differs between entities (fields, key, newest-first column,
contracts, cleaning rules, routing) is declared here once; operators read it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "binary": T.BinaryType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "decimal(12,2)": T.DecimalType(12, 2),
    "decimal(15,2)": T.DecimalType(15, 2),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(28,2)": T.DecimalType(28, 2),
    "decimal(38,12)": T.DecimalType(38, 12),
}


def struct(ddl: str) -> T.StructType:
    """Schema from a flat `name type, ...` list; unlike StructType.fromDDL, without a session."""
    pairs = [item.split() for item in ddl.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Entity:
    name: str
    topic: str
    label: str
    ddl: str
    key: str
    # Column that decides which of several versions of a record is the newest;
    # None for entities that are never deduplicated.
    newest_by: str | None
    not_null: tuple[str, ...]
    max_length: dict[str, int]
    # column -> name of a rule in functions.text.RULES
    cleaning: dict[str, str] = field(default_factory=dict)
    # Columns that decide between versions with the same newest_by value, before
    # the remaining columns are compared.
    tie_break: tuple[str, ...] = ()
    source_file: str = ""
    # Sums are taken of these columns or products, so they have to fit the money type.
    amounts: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return struct(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def raw_table(self) -> str:
        return f"{self.name}_raw"

    @property
    def structured_table(self) -> str:
        return f"{self.name}_structured"


# Field names and types, keys, contracts and routing of the inputs.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            name="clients",
            topic="clients",
            source_file="clients",
            label="Clients (EXT)",
            ddl="client_id string, client_name string, phone string, email string, birth_date date, "
            "registration_date date, city string, segment string, status string",
            key="client_id",
            newest_by="registration_date",
            tie_break=("client_name",),
            not_null=("client_id", "client_name"),
            max_length={
                "client_id": 20,
                "client_name": 100,
                "phone": 20,
                "email": 100,
                "city": 100,
                "segment": 50,
                "status": 20,
            },
            cleaning={"phone": "digits", "client_name": "trim", "email": "trim"},
        ),
        Entity(
            name="bank_transactions",
            topic="bank_transactions",
            source_file="bank_transactions",
            amounts=("amount",),
            label="Transactions (EXT)",
            ddl="transaction_id string, client_id string, transaction_date date, amount double, "
            "currency string, transaction_type string, channel string",
            key="transaction_id",
            newest_by="transaction_date",
            not_null=(
                "transaction_id",
                "client_id",
                "transaction_date",
                "amount",
                "currency",
                "transaction_type",
            ),
            max_length={
                "transaction_id": 20,
                "client_id": 20,
                "currency": 3,
                "transaction_type": 50,
                "channel": 50,
            },
            cleaning={"transaction_type": "code", "currency": "code"},
        ),
        Entity(
            name="client_logins",
            topic="client_logins",
            source_file="client_logins",
            label="Logins (EXT)",
            ddl="login_id string, client_id string, login_timestamp timestamp, ip_address string, "
            "device_type string, browser string, success boolean",
            key="login_id",
            newest_by="login_timestamp",
            not_null=("login_id", "client_id", "login_timestamp"),
            max_length={
                "login_id": 20,
                "client_id": 20,
                "ip_address": 45,
                "device_type": 50,
                "browser": 100,
            },
            cleaning={"device_type": "code"},
        ),
        Entity(
            name="client_activities",
            topic="client_activities",
            source_file="client_activities",
            label="Activities (EXT)",
            ddl="activity_id string, client_id string, activity_date date, activity_type string, "
            "duration_minutes int, page_views int",
            key="activity_id",
            newest_by="activity_date",
            not_null=("activity_id", "client_id", "activity_date", "activity_type"),
            max_length={"activity_id": 20, "client_id": 20, "activity_type": 100},
            cleaning={"activity_type": "code"},
        ),
        Entity(
            name="payments",
            topic="payments",
            source_file="payments",
            amounts=("amount",),
            label="Payments (EXT)",
            ddl="payment_id string, client_id string, payment_date date, amount double, currency string, "
            "payment_type string, status string",
            key="payment_id",
            newest_by="payment_date",
            not_null=("payment_id", "client_id", "payment_date", "amount", "currency", "payment_type"),
            max_length={
                "payment_id": 20,
                "client_id": 20,
                "currency": 3,
                "payment_type": 50,
                "status": 20,
            },
            cleaning={"payment_type": "code", "currency": "code"},
        ),
        Entity(
            name="portfolios",
            amounts=("quantity * current_price",),
            topic="securities_portfolios",
            source_file="securities_portfolios",
            label="Portfolios (EXT)",
            ddl="portfolio_id string, client_id string, security_type string, security_name string, "
            "quantity int, purchase_price double, current_price double, purchase_date date",
            key="portfolio_id",
            newest_by="purchase_date",
            not_null=("portfolio_id", "client_id", "security_name", "quantity", "purchase_price"),
            max_length={
                "portfolio_id": 20,
                "client_id": 20,
                "security_type": 50,
                "security_name": 200,
            },
            cleaning={"security_type": "code"},
        ),
        Entity(
            name="currency_rates",
            topic="currency_rates",
            source_file="currency_rates",
            label="Currency Rates (EXT)",
            ddl="rate_id string, currency_pair string, rate_date timestamp, rate_value double, rate_type string",
            key="rate_id",
            newest_by=None,
            not_null=("rate_id", "currency_pair", "rate_date", "rate_value"),
            max_length={"rate_id": 20, "currency_pair": 10, "rate_type": 50},
            cleaning={"currency_pair": "code"},
        ),
    )
}

# Entities that get a deduplicated local table (currency rates stop at the cleaned layer).
DEDUPLICATED = [e for e in ENTITIES.values() if e.newest_by]

# Columns of the message source; in files, the topic is the name of the folder.
ENVELOPE_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)
MESSAGE_FILE_DDL = ENVELOPE_DDL.replace("topic string, ", "")


@dataclass(frozen=True)
class Mart:
    name: str
    ddl: str
    sort_by: tuple[str, ...]
    # Column whose month forms the yyyymm partition.
    month_of: str
    # Newest row wins per sort_by and month on maintenance.
    version: str | None = None
    # Columns added up per sort_by on maintenance.
    summed: tuple[str, ...] = ()
    # Averages taken again from two of them: column -> (total, count).
    averages: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return struct(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names


# Mart layouts. Money totals are wider than the 15 digits of the
# original layout, which a sum over a very large client base would overflow.
MARTS: dict[str, Mart] = {
    m.name: m
    for m in (
        Mart(
            name="marketing_clients",
            ddl="client_id string, client_name string, portfolio_segment string, transaction_segment string, "
            "combined_segment string, total_value decimal(28,2), activity_score bigint, priority_level int, "
            "last_updated timestamp",
            sort_by=("client_id", "priority_level"),
            month_of="last_updated",
            version="last_updated",
        ),
        Mart(
            name="targeted_offers",
            ddl="offer_id bigint, client_id string, client_name string, portfolio_segment string, "
            "transaction_segment string, combined_segment string, offer_type string, offer_description string, "
            "expected_revenue decimal(12,2), priority_level int, offer_priority int, days_valid int, "
            "total_portfolio_value decimal(28,2), created_at timestamp",
            sort_by=("client_id", "priority_level", "offer_priority", "created_at"),
            month_of="created_at",
        ),
        Mart(
            name="marketing_campaign_results",
            ddl="campaign_id string, campaign_name string, target_segment string, start_date date, end_date date, "
            "total_clients bigint, response_count bigint, response_rate float, revenue_generated decimal(15,2), "
            "roi float, created_at timestamp",
            sort_by=("campaign_id", "start_date"),
            month_of="start_date",
            version="created_at",
        ),
        Mart(
            name="marketing_analytics_daily",
            ddl="analysis_date date, segment string, clients_count bigint, total_revenue decimal(28,2), "
            "avg_revenue decimal(28,2), active_clients bigint, new_clients bigint, created_at timestamp",
            sort_by=("analysis_date", "segment"),
            month_of="analysis_date",
            summed=("clients_count", "total_revenue", "active_clients", "new_clients"),
            averages={"avg_revenue": ("total_revenue", "clients_count")},
        ),
        Mart(
            name="campaign_performance",
            ddl="campaign_id string, segment string, impressions bigint, clicks bigint, conversions bigint, "
            "ctr float, conversion_rate float, roi float, performance_category string, analysis_date date, "
            "created_at timestamp",
            sort_by=("campaign_id", "analysis_date"),
            month_of="analysis_date",
        ),
    )
}

SEGMENTATION_DDL = (
    "client_id string, client_name string, city string, status string, segment string, original_segment string, "
    "transaction_count bigint, total_transaction_amount double, avg_transaction_amount double, "
    "max_transaction_amount double, login_count bigint, successful_logins bigint, activity_count bigint, "
    "total_activity_minutes bigint, total_page_views bigint, payment_count bigint, total_payment_amount double, "
    "portfolio_count bigint, portfolio_value double, processing_date date, created_at timestamp"
)
