"""Schemas, value sets and shard routes of the bank."""

from __future__ import annotations

from dataclasses import dataclass

# Regions, shards, id ranges, value sets, row limits and numeric error codes of the data model.
REGIONS = ("NA", "EU", "APAC")
ACCOUNT_TYPES = ("CHECKING", "SAVINGS", "BUSINESS")
ACCOUNT_STATUSES = ("ACTIVE", "INACTIVE", "CLOSED", "FROZEN")
TRANSACTION_TYPES = ("DEPOSIT", "WITHDRAWAL", "TRANSFER", "FEE", "INTEREST")
TRANSACTION_STATUSES = ("PENDING", "COMPLETED", "FAILED", "CANCELLED", "REVERSED")
ROUTE_STATUSES = ("ACTIVE", "INACTIVE", "MAINTENANCE")
CURRENCY = "USD"
RECENT_ROWS = 20
VOLUME_DAYS = 30
LIVE_DAYS = 1
BAND_LIMITS = (("Low", 1000), ("Medium", 10000))
TOP_BAND = "High"
MAX_LENGTHS = {
    "users": {"username": 50, "email": 100, "full_name": 100, "phone": 20, "address": 200, "region": 50},
    "accounts": {"account_number": 20, "account_type": 20, "currency": 3, "region": 50, "status": 10},
    "transactions": {
        "account_number": 20,
        "from_account_number": 20,
        "to_account_number": 20,
        "transaction_type": 20,
        "currency": 3,
        "status": 20,
        "description": 200,
        "reference_number": 50,
    },
}
USER_ERRORS = {"invalid_region": -20001, "id_out_of_range": -20002}
ACCOUNT_ERRORS = {"user_not_found": -20002, "region_mismatch": -20003}
POSTING_ERRORS = {
    "source_not_active": -20001,
    "account_not_active": -20001,
    "insufficient_balance": -20002,
    "destination_not_active": -20003,
    "account_not_found": 404,
    "missing_side": 400,
    "self_transfer": 400,
    "invalid_type": 400,
}


@dataclass(frozen=True)
class Route:
    """One shard: the region it serves and the user ids it holds."""

    shard_id: int
    shard_name: str
    region: str
    first_id: int
    last_id: int
    hostname: str | None = None
    port: int | None = None
    status: str = "ACTIVE"

    @property
    def tag(self) -> str:
        return f"SHARD{self.shard_id}"


ROUTES = (
    Route(1, "shard1", "NA", 1, 10_000_000, "shard1", 1521),
    Route(2, "shard2", "EU", 10_000_001, 20_000_000, "shard2", 1521),
    Route(3, "shard3", "APAC", 20_000_001, 30_000_000, "shard3", 1521),
)

USERS = (
    "user_id bigint, username string, email string, full_name string, phone string, address string, "
    "region string, created_date timestamp, last_updated timestamp, shard_location string"
)
ACCOUNTS = (
    "account_id bigint, user_id bigint, account_number string, account_type string, balance decimal(15,2), "
    "currency string, region string, status string, created_date timestamp, last_updated timestamp, "
    "shard_location string"
)
TRANSACTIONS = (
    "transaction_id bigint, account_number string, from_account_number string, to_account_number string, "
    "transaction_type string, amount decimal(15,2), currency string, status string, "
    "transaction_date timestamp, description string, reference_number string, shard_location string"
)
ROUTING = (
    "shard_id bigint, shard_name string, region string, user_id_range_start bigint, user_id_range_end bigint, "
    "connection_string string, hostname string, port bigint, status string, created_date timestamp, "
    "last_updated timestamp"
)
REQUESTS = (
    "seq bigint, transaction_type string, from_account_number string, to_account_number string, "
    "amount decimal(15,2), description string"
)

USERS_ALL = (
    "user_id", "username", "email", "full_name", "phone", "address", "region", "created_date", "last_updated",
    "shard_location",
)
ACCOUNTS_ALL = (
    "user_id", "account_number", "account_type", "balance", "currency", "region", "status", "created_date",
    "last_updated", "shard_location",
)
TRANSACTIONS_ALL = (
    "account_number", "from_account_number", "to_account_number", "transaction_type", "amount", "currency",
    "status", "transaction_date", "description", "reference_number", "shard_location",
)
