"""Bank tables and request feeds derived from an order-book schema (customer, nation, region, orders, events).

Customers become users, their balances become accounts, their orders become transactions. Customers and orders
meet in one equi-join on the customer key; the two dimension tables are small and the optimizer measures them
before it broadcasts them. A customer with very many orders is split by the adaptive skew join.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.model import CURRENCY, ROUTES
from regiobank.sources.bank import Bank

FIRST_DAY = "1994-01-01 00:00:00"
MONEY = "decimal(15,2)"


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A source table under its declared schema, so that no job runs to infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


# The account numbers of a customer, and the place a transfer of an order goes to: the customer's own second
# account or the first one of the next customer.
FIRST_ACCOUNT = "concat('ACC-', {key} * 2 + 1)"
SECOND_ACCOUNT = "concat('ACC-', {key} * 2 + 2)"
HOME = FIRST_ACCOUNT.format(key="o_custkey")
TRANSFER_TARGET = (
    f"CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 2 = 0 THEN {SECOND_ACCOUNT.format(key='o_custkey')} "
    f"ELSE {FIRST_ACCOUNT.format(key='(o_custkey + 1)')} END"
)


def _day(offset: str) -> str:
    return f"TIMESTAMP '{FIRST_DAY}' + make_dt_interval(CAST({offset} AS INT))"


def _user_ids() -> str:
    """The customer key's place in the id range of its region; keys that don't fit in are an error."""
    full = "CAST(raise_error(concat('no user id for customer ', c_custkey, ' in region ', region)) AS BIGINT)"
    arms = [
        f"WHEN '{r.region}' THEN IF(c_custkey BETWEEN 0 AND {r.last_id - r.first_id}, {r.first_id} + c_custkey, {full})"
        for r in ROUTES
    ]
    return "CASE region " + " ".join(arms) + " END"


def _shards() -> str:
    return "CASE region " + " ".join(f"WHEN '{r.region}' THEN '{r.tag}'" for r in ROUTES) + " END"


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the bank region and shard that serve them."""
    return (
        _table(spark, folder, "customer")
        .join(_table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(_table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr("*", "CASE r_name WHEN 'AMERICA' THEN 'NA' WHEN 'ASIA' THEN 'APAC' ELSE 'EU' END AS region")
        .selectExpr("*", f"{_shards()} AS shard_location", f"{_user_ids()} AS user_id")
    )


def _users(served: DataFrame) -> DataFrame:
    return served.selectExpr(
        "user_id",
        "c_name AS username",
        "concat('user', c_custkey, '@example.com') AS email",
        "concat('Customer ', c_custkey) AS full_name",
        "CASE WHEN c_custkey % 4 <> 0 THEN concat('555-', c_custkey) END AS phone",
        "n_name AS address",
        "region",
        f"{_day('c_custkey % 365')} AS created_date",
        f"{_day('c_custkey % 365 + 30')} AS last_updated",
        "shard_location",
    )


def _raw_accounts(served: DataFrame) -> DataFrame:
    """One account per customer, and a savings account with ten times the balance for every third one."""
    return served.selectExpr(
        "*",
        "explode(IF(c_custkey % 3 = 0, array(1L, 2L), array(1L))) AS place",
        f"CAST(c_acctbal AS {MONEY}) AS main_balance",
    ).selectExpr(
        "c_custkey * 2 + place AS account_id",
        "user_id",
        "concat('ACC-', c_custkey * 2 + place) AS account_number",
        "CASE WHEN place = 2 THEN 'SAVINGS' WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'BUSINESS' "
        "WHEN c_mktsegment = 'HOUSEHOLD' THEN 'SAVINGS' ELSE 'CHECKING' END AS account_type",
        f"CAST(IF(place = 2, main_balance * 10, main_balance) AS {MONEY}) AS balance",
        f"'{CURRENCY}' AS currency",
        "region",
        "CASE c_custkey % 20 WHEN 7 THEN 'FROZEN' WHEN 13 THEN 'CLOSED' WHEN 17 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status",
        f"{_day('c_custkey % 365 + place')} AS created_date",
        f"{_day('c_custkey % 365 + 60')} AS last_updated",
        "shard_location",
    )


def _holders(served: DataFrame) -> DataFrame:
    """Customers whose accounts exist: a negative balance breaks the table check. Balances come in whole cents."""
    return served.where("c_acctbal >= 0")


def users(spark: SparkSession, folder: str) -> DataFrame:
    return _users(customers(spark, folder))


def raw_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_accounts(customers(spark, folder))


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_accounts(_holders(customers(spark, folder)))


KIND = (
    "CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'DEPOSIT' "
    "WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'TRANSFER' ELSE 'WITHDRAWAL' END AS transaction_type"
)
SOURCE = f"CASE WHEN transaction_type <> 'DEPOSIT' THEN {HOME} END AS from_account_number"
TARGET = (
    f"CASE transaction_type WHEN 'DEPOSIT' THEN {HOME} WHEN 'TRANSFER' THEN {TRANSFER_TARGET} END AS to_account_number"
)


def _transactions(spark: SparkSession, folder: str, owners: DataFrame) -> DataFrame:
    return (
        _table(spark, folder, "orders")
        .join(owners.selectExpr("c_custkey AS o_custkey", "shard_location"), "o_custkey")
        .selectExpr("*", KIND)
        .selectExpr(
            "o_orderkey + 1 AS transaction_id",
            f"{HOME} AS account_number",
            SOURCE,
            TARGET,
            "transaction_type",
            f"CAST(o_totalprice AS {MONEY}) AS amount",
            f"'{CURRENCY}' AS currency",
            "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS status",
            "CAST(o_orderdate AS TIMESTAMP) AS transaction_date",
            "CASE WHEN o_orderkey % 5 <> 0 THEN concat('Order ', o_orderkey) END AS description",
            "concat('REF-', o_orderkey) AS reference_number",
            "shard_location",
        )
    )


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _transactions(spark, folder, customers(spark, folder))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions whose home account exists."""
    return _transactions(spark, folder, _holders(customers(spark, folder)))


def load_bank(spark: SparkSession, folder: str) -> Bank:
    served = cache(lambda: customers(spark, folder))
    return Bank(
        lambda: _users(served()),
        lambda: _raw_accounts(_holders(served())),
        lambda: _transactions(spark, folder, _holders(served())),
    )


def ledger_requests(orders: DataFrame) -> DataFrame:
    """One posting request per order, with amounts a hundredth of the order so that both outcomes occur.

    Works on a batch and on a streaming table.
    """
    return orders.selectExpr("*", KIND).selectExpr(
        "o_orderkey AS seq",
        "transaction_type",
        SOURCE,
        TARGET,
        f"CAST(round(CAST(o_totalprice AS {MONEY}) / 100, 2) AS {MONEY}) AS amount",
        "concat('Request ', o_orderkey) AS description",
    )


def order_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders")


def order_stream(spark: SparkSession, path: str) -> DataFrame:
    """Orders as a stream of the files under a path, one part for each micro-batch."""
    return _stream(spark, "orders", path)


def transfer_targets(spark: SparkSession, folder: str) -> DataFrame:
    """The account number that each order's transfer could go to; they repeat, and some do not exist."""
    return order_batch(spark, folder).selectExpr(f"{TRANSFER_TARGET} AS account_number")


def faulty_requests(spark: SparkSession, folder: str) -> DataFrame:
    """The posting requests with faults of every kind worked in at regular places."""
    return ledger_requests(order_batch(spark, folder)).selectExpr(
        "seq",
        "CASE WHEN seq % 53 = 4 THEN 'FEE' ELSE transaction_type END AS transaction_type",
        "CASE WHEN seq % 59 = 5 THEN '' WHEN seq % 61 = 6 THEN 'ACC-NONE' ELSE from_account_number END "
        "AS from_account_number",
        "CASE WHEN seq % 67 = 7 THEN NULL WHEN seq % 71 = 8 THEN from_account_number ELSE to_account_number END "
        "AS to_account_number",
        f"CAST(CASE WHEN seq % 73 = 9 THEN 0 WHEN seq % 79 = 10 THEN -amount ELSE amount END AS {MONEY}) AS amount",
        "CASE WHEN seq % 5 = 0 THEN '' ELSE description END AS description",
    )


def user_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming user rows: some without an id, some with a wrong one, and other faults at regular places."""
    return customers(spark, folder).selectExpr(
        "c_custkey AS line",
        "CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 97 = 5 THEN user_id + 10000000 "
        "WHEN c_custkey % 101 = 7 THEN user_id - c_custkey ELSE user_id END AS user_id",
        "CASE WHEN c_custkey % 79 = 1 THEN rpad(c_name, 60, 'x') ELSE c_name END AS username",
        "CASE WHEN c_custkey % 83 <> 2 THEN concat('user', c_custkey, '@example.com') END AS email",
        "concat('Customer ', c_custkey) AS full_name",
        "'' AS phone",
        "n_name AS address",
        "CASE WHEN c_custkey % 89 = 3 THEN 'XX' WHEN c_custkey % 7 = 0 THEN lower(region) ELSE region END AS region",
        "shard_location",
    )


def account_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming account rows with faults at regular places."""
    return raw_accounts(spark, folder).selectExpr(
        "account_id AS line",
        "CASE WHEN account_id % 109 = 12 THEN 7 WHEN account_id % 10 <> 0 THEN account_id END AS account_id",
        "CASE WHEN account_id % 67 = 8 THEN user_id + 5000000 ELSE user_id END AS user_id",
        "CASE WHEN account_id % 103 = 11 THEN 'ACC-DUP' WHEN account_id % 10 <> 0 THEN account_number END "
        "AS account_number",
        "CASE WHEN account_id % 71 = 4 THEN 'PREMIUM' ELSE account_type END AS account_type",
        "CASE WHEN account_id % 41 <> 5 THEN balance END AS balance",
        "CASE WHEN account_id % 3 = 1 THEN 'EUR' ELSE currency END AS currency",
        "CASE WHEN account_id % 61 <> 6 THEN region WHEN region = 'NA' THEN 'EU' ELSE 'NA' END AS region",
        "CASE WHEN account_id % 73 = 9 THEN 'DORMANT' WHEN account_id % 4 <> 2 THEN status END AS status",
        "shard_location",
    )


def transaction_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming transaction rows with faults at regular places."""
    return raw_transactions(spark, folder).selectExpr(
        "transaction_id AS line",
        "CASE WHEN transaction_id % 2 <> 0 THEN account_number END AS account_number",
        "CASE WHEN transaction_id % 73 = 6 THEN NULL WHEN transaction_id % 79 = 7 THEN account_number "
        "ELSE from_account_number END AS from_account_number",
        "CASE WHEN transaction_id % 73 <> 6 AND transaction_id % 79 <> 7 THEN to_account_number END "
        "AS to_account_number",
        "CASE WHEN transaction_id % 79 = 7 THEN 'DEPOSIT' WHEN transaction_id % 53 = 4 THEN 'FEE' "
        "WHEN transaction_id % 71 = 5 THEN 'REFUND' ELSE transaction_type END AS transaction_type",
        "CASE WHEN transaction_id % 59 = 1 THEN 0 WHEN transaction_id % 61 = 2 THEN -amount "
        f"WHEN transaction_id % 67 = 3 THEN NULL ELSE CAST(amount AS {MONEY}) END AS amount",
        "CASE WHEN transaction_id % 3 = 1 THEN 'EUR' ELSE currency END AS currency",
        "CASE WHEN transaction_id % 83 = 8 THEN 'DONE' WHEN transaction_id % 4 <> 2 THEN status END AS status",
        "shard_location",
    )


def event_transactions(events: DataFrame) -> DataFrame:
    """Customer events as a transaction stream; works on a batch and on a streaming table."""
    return events.where("event_type IN ('purchase', 'signup', 'click')").selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP) AS transaction_date",
        "CASE event_type WHEN 'purchase' THEN 'WITHDRAWAL' WHEN 'signup' THEN 'DEPOSIT' ELSE 'TRANSFER' END "
        "AS transaction_type",
        f"CAST(value AS {MONEY}) AS amount",
        "CASE event_id % 10 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PENDING' ELSE 'COMPLETED' END AS status",
        f"{FIRST_ACCOUNT.format(key='user_id')} AS account_number",
    )


def on_shards(transactions: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add the shard that each transaction is booked on, that of the customer; NULL where there is none."""
    homes = customers(spark, folder).selectExpr(f"{FIRST_ACCOUNT.format(key='c_custkey')} AS account_number", "shard_location")
    return transactions.join(homes, "account_number", "left")


#: Files that are written for each micro-batch of a stream, by as many tasks.
FILES = 4
PARTS = 3


def _part(table: DataFrame, key: str, parts: int) -> str:
    """The part of a row: ranges of a key, as wide as each other. Rows without a key come first."""
    low, high = table.agg(F.min(key), F.max(key)).first()
    width = ((high or 0) - (low or 0)) // parts + 1
    return f"coalesce(({key} - {low or 0}) div {width}, 0)"


def _in_order(parts: list[DataFrame], path: str) -> str:
    """Write one part after the other, so that a stream takes them in this order."""
    for number, rows in enumerate(parts):
        rows.repartition(FILES).write.mode("overwrite").parquet(f"{path}/part={number}")
    return path


def in_files(table: DataFrame, key: str, path: str, parts: int = PARTS) -> str:
    """The rows of a table in files by ranges of a key, so that a stream takes the ranges one after the other."""
    part = _part(table, key, parts)
    return _in_order([table.where(f"{part} = {number}") for number in range(parts)], path)


def repeated_and_late(table: DataFrame, key: str, path: str, parts: int = PARTS) -> str:
    """As `in_files`, with faults at regular places: some rows come with the last part, some twice with their part, and
    some again with the next part."""
    part, last = _part(table, key, parts), parts - 1
    arrival = f"IF({key} % 50 = 7, {last}, {part})"
    copies = (
        f"concat(array({arrival}), IF({key} % 60 = 5, array({arrival}), array()), "
        f"IF({key} % 40 = 3, array(least({arrival} + 1, {last})), array()))"
    )
    rows = table.selectExpr("*", f"explode({copies}) AS _arrives")
    return _in_order([rows.where(F.col("_arrives") == number).drop("_arrives") for number in range(parts)], path)


def _stream(spark: SparkSession, name: str, path: str) -> DataFrame:
    reader = spark.readStream.schema(SCHEMAS[name]).option("maxFilesPerTrigger", str(FILES))
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """Events as a stream of the files under a path, one part for each micro-batch."""
    return event_transactions(_stream(spark, "events", path))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events")


def event_batch(spark: SparkSession, folder: str) -> DataFrame:
    return event_transactions(_table(spark, folder, "events"))
