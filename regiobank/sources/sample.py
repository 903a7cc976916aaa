"""The sample bank: 15 users, 21 accounts and 12 transactions, loaded the way any batch is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.operators.onboarding import append_accounts, append_transactions, append_users
from regiobank.sources.bank import Bank, create_bank, read_bank

# Users per region in insert order, with phone and address; accounts as (owner's place, type, balance), numbered from ACC001
# on; transactions as (type, source, target, amount).
USERS = {
    "NA": ["john_doe", "maria_garcia", "robert_smith", "jennifer_wilson", "david_brown"],
    "EU": ["jane_smith", "pierre_dupont", "hans_mueller", "sophia_rossi", "carlos_rodriguez"],
    "APAC": ["lee_wong", "yuki_tanaka", "raj_kumar", "wei_zhang", "min_choi"],
}
CONTACTS = {
    "NA": [
        ("555-0101", "123 Main St, New York, NY"),
        ("555-0102", "456 Oak Ave, Los Angeles, CA"),
        ("555-0103", "789 Pine Rd, Chicago, IL"),
        ("555-0104", "321 Elm St, Houston, TX"),
        ("555-0105", "654 Maple Dr, Phoenix, AZ"),
    ],
    "EU": [
        ("+44-20-7123-4567", "10 Downing Street, London, UK"),
        ("+33-1-2345-6789", "15 Rue de la Paix, Paris, France"),
        ("+49-30-1234-5678", "Unter den Linden 1, Berlin, Germany"),
        ("+39-02-1234-5678", "Via Roma 5, Milan, Italy"),
        ("+34-91-123-4567", "Gran Via 1, Madrid, Spain"),
    ],
    "APAC": [
        ("+86-10-1234-5678", "1 Chang'an Avenue, Beijing, China"),
        ("+81-3-1234-5678", "1-1-1 Marunouchi, Tokyo, Japan"),
        ("+91-11-2345-6789", "Connaught Place, New Delhi, India"),
        ("+65-6-123-4567", "1 Marina Bay, Singapore"),
        ("+82-2-123-4567", "1 Jongno-gu, Seoul, South Korea"),
    ],
}
OWNERS = [1, 1, 2, 2, 3, 4, 5]
TYPES = ["CHECKING", "SAVINGS", "CHECKING", "SAVINGS", "CHECKING", "SAVINGS", "CHECKING"]
BALANCES = {
    "NA": [5000, 25000, 3500, 45000, 12000, 80000, 7500],
    "EU": [7500, 30000, 8500, 55000, 9200, 68000, 6200],
    "APAC": [15000, 90000, 18000, 120000, 25000, 75000, 14000],
}
TRANSACTIONS = [
    ("DEPOSIT", None, "ACC001", 5000),
    ("TRANSFER", "ACC001", "ACC002", 2000),
    ("DEPOSIT", None, "ACC003", 3500),
    ("WITHDRAWAL", "ACC005", None, 500),
    ("DEPOSIT", None, "ACC008", 7500),
    ("TRANSFER", "ACC008", "ACC009", 3000),
    ("DEPOSIT", None, "ACC010", 8500),
    ("WITHDRAWAL", "ACC012", None, 500),
    ("DEPOSIT", None, "ACC015", 15000),
    ("TRANSFER", "ACC015", "ACC016", 5000),
    ("DEPOSIT", None, "ACC017", 18000),
    ("WITHDRAWAL", "ACC019", None, 5000),
]


def user_requests(spark: SparkSession) -> DataFrame:
    people = [(name, *contact, region) for region, users in USERS.items() for name, contact in zip(users, CONTACTS[region])]
    rows = [
        (i, None, name, f"{name.replace('_', '.')}@example.com", name.replace("_", " ").title(), phone, address, region)
        for i, (name, phone, address, region) in enumerate(people, 1)
    ]
    return spark.createDataFrame(
        rows,
        "line bigint, user_id bigint, username string, email string, full_name string, phone string, address string, "
        "region string",
    )


def account_requests(spark: SparkSession, bank: Bank) -> DataFrame:
    """Accounts name their owner; the owner's id is looked up among the loaded users."""
    rows = []
    for region, balances in BALANCES.items():
        for owner, kind, balance in zip(OWNERS, TYPES, balances):
            line = len(rows) + 1
            rows.append((line, USERS[region][owner - 1], f"ACC{line:03d}", kind, balance))
    named = spark.createDataFrame(rows, "line bigint, username string, account_number string, account_type string, balance bigint")
    return named.join(bank.users.select("username", "user_id"), "username").select(
        "line",
        F.lit(None).cast("bigint").alias("account_id"),
        "user_id",
        "account_number",
        "account_type",
        F.col("balance").cast("decimal(15,2)").alias("balance"),
        F.lit(None).cast("string").alias("status"),
    )


def transaction_requests(spark: SparkSession) -> DataFrame:
    rows = [(i, *t) for i, t in enumerate(TRANSACTIONS, 1)]
    given = spark.createDataFrame(
        rows,
        "line bigint, transaction_type string, from_account_number string, to_account_number string, amount bigint",
    )
    return given.selectExpr(
        "line",
        "CAST(NULL AS STRING) AS account_number",
        "from_account_number",
        "to_account_number",
        "transaction_type",
        "CAST(amount AS DECIMAL(15,2)) AS amount",
        "'COMPLETED' AS status",
        "CAST(NULL AS TIMESTAMP) AS transaction_date",
        "CAST(NULL AS STRING) AS description",
        "CAST(NULL AS STRING) AS reference_number",
    )


def load_sample(spark: SparkSession, root: str, as_of) -> Bank:
    """Create a store with the sample rows."""
    create_bank(spark, root)
    append_users(user_requests(spark), root, "line", as_of, batch=1)
    append_accounts(account_requests(spark, read_bank(spark, root)), root, "line", as_of, batch=2)
    append_transactions(transaction_requests(spark), root, "line", as_of, batch=3)
    return read_bank(spark, root)
