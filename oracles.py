"""SQL counterparts of the registered queries, for an independent SQL engine over the same Parquet tables."""

from __future__ import annotations

# The bank tables, derived from the order-book tables by the same rules as regiobank.sources.orderbook.
BANK = """
WITH RECURSIVE cust AS (
  SELECT c_custkey AS k, c_name, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(15,2)) AS bal, n_name,
    CASE r_name WHEN 'AMERICA' THEN 'NA' WHEN 'ASIA' THEN 'APAC' ELSE 'EU' END AS region,
    CASE r_name WHEN 'AMERICA' THEN 'SHARD1' WHEN 'ASIA' THEN 'SHARD3' ELSE 'SHARD2' END AS shard_location,
    CASE r_name WHEN 'AMERICA' THEN 0 WHEN 'ASIA' THEN 20000000 ELSE 10000000 END AS base
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
users_all AS (
  SELECT base + k + 1 AS user_id, c_name AS username, 'user' || k || '@example.com' AS email,
    'Customer ' || k AS full_name, CASE WHEN k % 4 <> 0 THEN '555-' || k END AS phone, n_name AS address, region,
    TIMESTAMP '1994-01-01' + to_days(CAST(k % 365 AS INTEGER)) AS created_date,
    TIMESTAMP '1994-01-01' + to_days(CAST(k % 365 + 30 AS INTEGER)) AS last_updated, shard_location
  FROM cust
),
raw_accounts AS (
  SELECT 2 * k + place AS account_id, base + k + 1 AS user_id, 'ACC-' || (2 * k + place) AS account_number,
    CASE WHEN place = 2 THEN 'SAVINGS' WHEN segment IN ('BUILDING', 'MACHINERY') THEN 'BUSINESS'
      WHEN segment = 'HOUSEHOLD' THEN 'SAVINGS' ELSE 'CHECKING' END AS account_type,
    CAST(CASE WHEN place = 2 THEN bal * 10 ELSE bal END AS DECIMAL(15,2)) AS balance, 'USD' AS currency, region,
    CASE k % 20 WHEN 7 THEN 'FROZEN' WHEN 13 THEN 'CLOSED' WHEN 17 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
    TIMESTAMP '1994-01-01' + to_days(CAST(k % 365 + place AS INTEGER)) AS created_date,
    TIMESTAMP '1994-01-01' + to_days(CAST(k % 365 + 60 AS INTEGER)) AS last_updated, shard_location
  FROM cust, (VALUES (1), (2)) AS places(place) WHERE place = 1 OR k % 3 = 0
),
accounts_all AS (SELECT * FROM raw_accounts WHERE balance >= 0),
order_sides AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, CAST(o_totalprice AS DECIMAL(15,2)) AS amount,
    'ACC-' || (2 * o_custkey + 1) AS home,
    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'DEPOSIT'
      WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'TRANSFER' ELSE 'WITHDRAWAL' END AS transaction_type,
    CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'ACC-' || (2 * o_custkey + 2)
      ELSE 'ACC-' || (2 * (o_custkey + 1) + 1) END AS other
  FROM orders
),
raw_transactions AS (
  SELECT o_orderkey + 1 AS transaction_id, home AS account_number,
    CASE WHEN transaction_type <> 'DEPOSIT' THEN home END AS from_account_number,
    CASE transaction_type WHEN 'DEPOSIT' THEN home WHEN 'TRANSFER' THEN other END AS to_account_number,
    transaction_type, amount, 'USD' AS currency,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS status,
    o_orderdate AS transaction_date, CASE WHEN o_orderkey % 5 <> 0 THEN 'Order ' || o_orderkey END AS description,
    'REF-' || o_orderkey AS reference_number, shard_location, bal
  FROM order_sides JOIN cust ON o_custkey = k
),
transactions_all AS (SELECT * FROM raw_transactions WHERE bal >= 0),
requests AS (
  SELECT o_orderkey AS seq, transaction_type, CASE WHEN transaction_type <> 'DEPOSIT' THEN home END AS f,
    CASE transaction_type WHEN 'DEPOSIT' THEN home WHEN 'TRANSFER' THEN other END AS t,
    (CAST(amount * 100 AS BIGINT) + 50) // 100 AS cents, 'Request ' || o_orderkey AS description
  FROM order_sides
)
"""


def _text(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column.split('.')[-1]}"


def _avg(amount: str, n: str | None = None) -> str:
    """Average to two digits, half up, in whole cents (all amounts here are non-negative)."""
    total = f"CAST(sum({amount}) * 100 AS HUGEINT)"
    count = n or f"count({amount})"
    return f"CAST((2 * {total} + {count}) // (2 * {count}) AS DOUBLE) / 100"


def _dbl(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def _big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


USER_COLUMNS = (
    "user_id, username, email, full_name, phone, address, region, "
    f"{_text('created_date')}, {_text('last_updated')}, shard_location"
)
ACCOUNT_COLUMNS = (
    f"user_id, account_number, account_type, {_dbl('balance', 'balance')}, currency, region, status, "
    f"{_text('created_date')}, {_text('last_updated')}, shard_location"
)
TRANSACTION_COLUMNS = (
    f"account_number, from_account_number, to_account_number, transaction_type, {_dbl('amount', 'amount')}, currency, "
    f"status, {_text('transaction_date')}, description, reference_number, shard_location"
)
TYPE_COUNTS = """
  count(CASE WHEN transaction_type = 'DEPOSIT' THEN 1 END) AS deposits,
  count(CASE WHEN transaction_type = 'WITHDRAWAL' THEN 1 END) AS withdrawals,
  count(CASE WHEN transaction_type = 'TRANSFER' THEN 1 END) AS transfers
"""
TYPE_TOTALS = """
  coalesce(sum(CASE WHEN transaction_type = 'DEPOSIT' THEN amount ELSE 0 END), 0) AS total_deposits,
  coalesce(sum(CASE WHEN transaction_type = 'WITHDRAWAL' THEN amount ELSE 0 END), 0) AS total_withdrawals,
  coalesce(sum(CASE WHEN transaction_type = 'TRANSFER' THEN amount ELSE 0 END), 0) AS total_transfers
"""
TOTALS_AS_DOUBLE = ", ".join(_dbl(c, c) for c in ("total_deposits", "total_withdrawals", "total_transfers"))
BALANCE_MEASURES = (
    f"count(*) AS account_count, {_dbl('sum(balance)', 'total_balance')}, {_avg('balance')} AS avg_balance, "
    f"{_dbl('min(balance)', 'min_balance')}, {_dbl('max(balance)', 'max_balance')}"
)
AMOUNT_MEASURES = (
    f"count(*) AS transaction_count, {_dbl('sum(amount)', 'total_amount')}, {_avg('amount')} AS avg_amount"
)

# Transactions in the region of their home account, in the either-or form of the join.
HOME_STATS = f"""
  SELECT acc.region, count(*) AS total_transactions, {TYPE_COUNTS}, {TYPE_TOTALS}
  FROM transactions_all t JOIN accounts_all acc ON t.shard_location = acc.shard_location
    AND acc.account_number = CASE WHEN t.from_account_number IS NOT NULL THEN t.from_account_number
                                  ELSE t.to_account_number END
  GROUP BY acc.region
"""
# Accounts joined with every transaction that names them on their shard, rows repeated.
TOUCHES = """
  touches AS (
    SELECT shard_location, from_account_number AS account_number, transaction_date FROM transactions_all
    WHERE from_account_number IS NOT NULL
    UNION ALL
    SELECT shard_location, to_account_number, transaction_date FROM transactions_all
    WHERE to_account_number IS NOT NULL AND to_account_number IS DISTINCT FROM from_account_number
  )
"""
HOLDINGS = f"""
  count(DISTINCT u.user_id) AS total_users, count(DISTINCT a.account_number) AS total_accounts,
  {_dbl('coalesce(sum(a.balance), 0)', 'total_balance')}, {_avg('a.balance')} AS avg_balance_per_account
"""
LATEST = "(SELECT max(transaction_date) FROM transactions_all)"

# ---- feeds with faults, by the same rules as the feeds in regiobank.sources.orderbook ----
USER_FEED = """
  user_feed AS (
    SELECT k AS line,
      CASE WHEN k % 10 = 0 THEN NULL WHEN k % 97 = 5 THEN base + k + 1 + 10000000
        WHEN k % 101 = 7 THEN base + 1 ELSE base + k + 1 END AS user_id,
      CASE WHEN k % 79 = 1 THEN rpad(c_name, 60, 'x') ELSE c_name END AS username,
      CASE WHEN k % 83 <> 2 THEN 'user' || k || '@example.com' END AS email,
      'Customer ' || k AS full_name, n_name AS address,
      CASE WHEN k % 89 = 3 THEN 'XX' WHEN k % 7 = 0 THEN lower(region) ELSE region END AS region, shard_location
    FROM cust
  )
"""
USER_JUDGED = USER_FEED + """,
  user_judged AS (
    SELECT *, concat_ws(',',
      CASE WHEN upper(region) NOT IN ('NA', 'EU', 'APAC') THEN 'invalid_region' END,
      CASE WHEN (upper(region) = 'NA' AND user_id NOT BETWEEN 1 AND 10000000)
        OR (upper(region) = 'EU' AND user_id NOT BETWEEN 10000001 AND 20000000)
        OR (upper(region) = 'APAC' AND user_id NOT BETWEEN 20000001 AND 30000000) THEN 'id_out_of_range' END,
      CASE WHEN exact AND upper(region) IN ('NA', 'EU', 'APAC') AND region NOT IN ('NA', 'EU', 'APAC')
        THEN 'chk_region' END,
      CASE WHEN email IS NULL THEN 'null_email' END,
      CASE WHEN length(username) > 50 THEN 'long_username' END,
      CASE WHEN user_id IS NOT NULL AND line > min(line) OVER (PARTITION BY user_id) THEN 'duplicate_user_id' END
    ) AS reasons
    FROM user_feed, (SELECT {exact} AS exact)
  )
"""
ACCOUNT_FEED = """
  account_feed AS (
    SELECT account_id AS line, CASE WHEN account_id % 109 = 12 THEN 7 WHEN account_id % 10 <> 0 THEN account_id END
      AS account_id,
      CASE WHEN account_id % 67 = 8 THEN user_id + 5000000 ELSE user_id END AS user_id,
      CASE WHEN account_id % 103 = 11 THEN 'ACC-DUP' WHEN account_id % 10 <> 0 THEN account_number END
        AS account_number,
      CASE WHEN account_id % 71 = 4 THEN 'PREMIUM' ELSE account_type END AS account_type,
      CASE WHEN account_id % 41 <> 5 THEN balance END AS balance,
      CASE WHEN account_id % 61 = 6 THEN CASE WHEN region = 'NA' THEN 'EU' ELSE 'NA' END ELSE region END AS region,
      CASE WHEN account_id % 73 = 9 THEN 'DORMANT' WHEN account_id % 4 <> 2 THEN status ELSE 'ACTIVE' END AS status,
      shard_location, account_id % 67 = 8 AS ownerless
    FROM raw_accounts
  )
"""
TRANSACTION_FEED = """
  transaction_feed AS (
    SELECT transaction_id AS line, CASE WHEN transaction_id % 2 <> 0 THEN account_number END AS given,
      CASE WHEN transaction_id % 73 = 6 THEN NULL WHEN transaction_id % 79 = 7 THEN account_number
        ELSE from_account_number END AS f,
      CASE WHEN transaction_id % 73 = 6 OR transaction_id % 79 = 7 THEN NULL ELSE to_account_number END AS t,
      CASE WHEN transaction_id % 79 = 7 THEN 'DEPOSIT' WHEN transaction_id % 53 = 4 THEN 'FEE'
        WHEN transaction_id % 71 = 5 THEN 'REFUND' ELSE transaction_type END AS transaction_type,
      CASE WHEN transaction_id % 59 = 1 THEN 0 WHEN transaction_id % 61 = 2 THEN -amount
        WHEN transaction_id % 67 = 3 THEN NULL ELSE amount END AS amount,
      CASE WHEN transaction_id % 83 = 8 THEN 'DONE' WHEN transaction_id % 4 <> 2 THEN status ELSE 'PENDING' END AS status,
      shard_location
    FROM raw_transactions
  ),
  transaction_routed AS (
    SELECT *, coalesce(given, CASE WHEN transaction_type IN ('TRANSFER', 'WITHDRAWAL') THEN f
      WHEN transaction_type = 'DEPOSIT' THEN t ELSE coalesce(f, t) END) AS account_number
    FROM transaction_feed
  )
"""
FAULTY = """
  faulty AS (
    SELECT seq, CASE WHEN seq % 53 = 4 THEN 'FEE' ELSE transaction_type END AS transaction_type,
      CASE WHEN seq % 59 = 5 THEN NULL WHEN seq % 61 = 6 THEN 'ACC-NONE' ELSE f END AS f,
      CASE WHEN seq % 67 = 7 THEN NULL WHEN seq % 71 = 8 THEN f ELSE t END AS t,
      CASE WHEN seq % 73 = 9 THEN 0 WHEN seq % 79 = 10 THEN -cents ELSE cents END AS cents
    FROM requests
  )
"""


def _judge_requests(source: str) -> str:
    """Static checks of posting requests; account numbers are unique here, so one row per side is found."""
    return f"""
  judged AS (
    SELECT r.*, s.shard_location AS f_shard, d.shard_location AS t_shard,
      CASE WHEN (r.f IS NOT NULL AND s.account_number IS NULL) OR (r.t IS NOT NULL AND d.account_number IS NULL)
             THEN 'account_not_found'
           WHEN transaction_type NOT IN ('DEPOSIT', 'TRANSFER', 'WITHDRAWAL') THEN 'invalid_type'
           WHEN (transaction_type IN ('TRANSFER', 'WITHDRAWAL') AND r.f IS NULL)
             OR (transaction_type IN ('TRANSFER', 'DEPOSIT') AND r.t IS NULL) THEN 'missing_side'
           WHEN transaction_type = 'TRANSFER' AND r.f = r.t THEN 'self_transfer'
           WHEN transaction_type IN ('TRANSFER', 'WITHDRAWAL') AND s.status <> 'ACTIVE' THEN 'source_not_active'
           WHEN transaction_type = 'DEPOSIT' AND d.status <> 'ACTIVE' THEN 'account_not_active'
           WHEN transaction_type = 'TRANSFER' AND d.status <> 'ACTIVE' THEN 'destination_not_active'
           WHEN r.cents <= 0 THEN 'chk_amount' END AS reason
    FROM {source} r LEFT JOIN accounts_all s ON r.f = s.account_number
      LEFT JOIN accounts_all d ON r.t = d.account_number
  )
"""


ERROR_CODE = """
  CAST(CASE reason WHEN 'source_not_active' THEN -20001 WHEN 'account_not_active' THEN -20001
    WHEN 'insufficient_balance' THEN -20002 WHEN 'destination_not_active' THEN -20003
    WHEN 'account_not_found' THEN 404 WHEN 'missing_side' THEN 400 WHEN 'self_transfer' THEN 400
    WHEN 'invalid_type' THEN 400 END AS BIGINT) AS error_code
"""

# Posting as repeated whole-table rounds of running sums, until no outcome changes.
POSTED = (
    _judge_requests("requests")
    + """,
  valid AS MATERIALIZED (SELECT * FROM judged WHERE reason IS NULL),
  entries AS MATERIALIZED (
    SELECT seq, account, delta, debit, CAST(balance * 100 AS BIGINT) AS opening
    FROM (SELECT seq, f AS account, -cents AS delta, true AS debit FROM valid WHERE f IS NOT NULL
          UNION ALL SELECT seq, t, cents, false FROM valid WHERE t IS NOT NULL) e
      JOIN accounts_all ON account = account_number
  ),
  attempts AS (
    SELECT 0 AS i, seq, true AS ok, true AS moved FROM valid
    UNION ALL
    SELECT i + 1, seq, new_ok, bool_or(new_ok <> ok) OVER () FROM (
      SELECT a.i, a.seq, a.ok, coalesce(p.prior >= v.cents, true) AS new_ok
      FROM attempts a JOIN valid v ON a.seq = v.seq LEFT JOIN (
        SELECT e.seq, e.debit, e.opening + coalesce(sum(CASE WHEN b.ok THEN e.delta ELSE 0 END) OVER (
            PARTITION BY e.account ORDER BY e.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
        FROM entries e JOIN attempts b ON e.seq = b.seq) p ON p.seq = a.seq AND p.debit
      WHERE a.moved)
  ),
  posted AS MATERIALIZED (
    SELECT j.*, coalesce(j.reason, CASE WHEN NOT a.ok THEN 'insufficient_balance' END) AS final_reason
    FROM judged j LEFT JOIN (SELECT * FROM attempts WHERE NOT moved) a ON j.seq = a.seq
  )
"""
)
EVENTS = """
  event_rows AS (
    SELECT event_id, ts AS transaction_date, CAST(value AS DECIMAL(15,2)) AS amount,
      CASE event_type WHEN 'purchase' THEN 'WITHDRAWAL' WHEN 'signup' THEN 'DEPOSIT' WHEN 'click' THEN 'TRANSFER' END
        AS transaction_type,
      CASE event_id % 10 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PENDING' ELSE 'COMPLETED' END AS status,
      'ACC-' || (2 * user_id + 1) AS account_number
    FROM events WHERE event_type IN ('purchase', 'signup', 'click')
  )
"""


def _q(body: str, *parts: str) -> str:
    return BANK + "".join(f", {p}" for p in parts) + body


ACCOUNT_LIST = (
    f"a.account_number, a.user_id, a.account_type, {_dbl('a.balance', 'balance')}, a.currency, a.region, a.status"
)
OWNER_JOIN = "users_all u ON a.user_id = u.user_id AND a.shard_location = u.shard_location"
REGIONAL = f"""
  SELECT a.region, count(DISTINCT u.user_id) AS user_count, count(DISTINCT a.account_number) AS account_count,
    count(*) AS transaction_count, {_dbl('sum(a.balance)', 'total_balance')}, {_avg('a.balance')} AS avg_balance,
    {_dbl('min(a.balance)', 'min_balance')}, {_dbl('max(a.balance)', 'max_balance')}
  FROM accounts_all a LEFT JOIN {OWNER_JOIN}
    LEFT JOIN touches t ON a.account_number = t.account_number AND a.shard_location = t.shard_location
  GROUP BY a.region
"""
ACCOUNT_REASONS = """
  account_judged AS (
    SELECT f.*, concat_ws(',',
      CASE WHEN ownerless THEN 'user_not_found' END,
      CASE WHEN NOT ownerless AND upper(f.region) <> u.region THEN 'region_mismatch' END,
      CASE WHEN account_type NOT IN ('CHECKING', 'SAVINGS', 'BUSINESS') THEN 'chk_account_type' END,
      CASE WHEN balance < 0 THEN 'chk_balance' END,
      CASE WHEN status NOT IN ('ACTIVE', 'INACTIVE', 'CLOSED', 'FROZEN') THEN 'chk_status' END,
      CASE WHEN account_number IS NOT NULL
        AND line > min(line) OVER (PARTITION BY f.shard_location, account_number)
        THEN 'duplicate_account_number' END,
      CASE WHEN account_id IS NOT NULL AND line > min(line) OVER (PARTITION BY f.shard_location, account_id)
        THEN 'duplicate_account_id' END
    ) AS reasons, u.region AS owner_region
    FROM account_feed f LEFT JOIN users_all u ON f.user_id = u.user_id AND f.shard_location = u.shard_location
  )
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # scans and cross-shard tables
    q["users_all"] = _q(f"SELECT {USER_COLUMNS} FROM users_all")
    q["accounts_all"] = _q(f"SELECT {ACCOUNT_COLUMNS} FROM accounts_all")
    q["transactions_all"] = _q(f"SELECT {TRANSACTION_COLUMNS} FROM transactions_all")
    q["shard_scan"] = _q(
        f"SELECT account_id, {ACCOUNT_COLUMNS} FROM accounts_all WHERE shard_location = 'SHARD2'"
    )
    q["format_result"] = _q(
        "SELECT CAST(user_id AS DOUBLE) AS user_id, account_number, CAST(balance AS DOUBLE) AS balance, "
        f"{_text('created_date')}, {_dbl('balance', 'shown_balance')}, coalesce(CAST(n AS DOUBLE), 0) AS shown_count "
        "FROM (SELECT u.user_id, a.account_number, a.balance, u.created_date, c.n FROM users_all u "
        "LEFT JOIN (SELECT user_id, count(*) AS n FROM accounts_all GROUP BY 1) c ON u.user_id = c.user_id "
        "LEFT JOIN accounts_all a ON u.user_id = a.user_id)"
    )

    # filters and lookups of one key
    q["users_by_region"] = _q("SELECT user_id, username, email, region, shard_location FROM users_all WHERE region = 'NA'")
    q["accounts_by_region_filter"] = _q(f"SELECT {ACCOUNT_COLUMNS} FROM accounts_all WHERE region = 'NA'")
    q["accounts_over_balance"] = _q(f"SELECT {ACCOUNT_COLUMNS} FROM accounts_all WHERE balance > 10000")
    q["find_user"] = _q(
        "SELECT user_id, username, email, full_name, region, shard_location FROM users_all "
        "WHERE username = 'Customer#000000042'"
    )
    q["account_lookup"] = _q(
        f"SELECT account_number, account_type, {_dbl('balance', 'balance')}, region, status, shard_location "
        "FROM accounts_all WHERE account_number = 'ACC-1'"
    )
    q["account_history"] = _q(
        f"SELECT from_account_number, to_account_number, transaction_type, {_dbl('amount', 'amount')}, status, "
        f"{_text('transaction_date')}, description, reference_number FROM transactions_all "
        "WHERE from_account_number = 'ACC-1' OR to_account_number = 'ACC-1'"
    )
    q["user_accounts"] = _q(
        f"SELECT account_number, account_type, {_dbl('balance', 'balance')}, a.region, username, full_name "
        f"FROM accounts_all a JOIN {OWNER_JOIN} WHERE u.user_id = (SELECT min(user_id) FROM users_all)"
    )

    # joins
    q["account_summary_all"] = _q(
        f"SELECT a.account_number, a.user_id, username, full_name, email, account_type, {_dbl('balance', 'balance')}, "
        f"currency, a.region, status, {_text('a.created_date', 'account_created')}, "
        f"{_text('u.created_date', 'user_created')}, a.shard_location FROM accounts_all a JOIN {OWNER_JOIN}"
    )
    q["account_summary_by_balance"] = _q(
        f"SELECT account_number, username, full_name, account_type, {_dbl('balance', 'balance')}, a.region, "
        f"a.shard_location FROM accounts_all a JOIN {OWNER_JOIN}"
    )
    for name, count in (("account_summary", "count(*)"), ("account_summary_exact", "count(t.account_number)")):
        q[name] = _q(
            f"SELECT {ACCOUNT_LIST}, username, full_name, {count} AS transaction_count, "
            f"{_text('max(t.transaction_date)', 'last_transaction_date')} FROM accounts_all a JOIN {OWNER_JOIN} "
            "LEFT JOIN touches t ON a.account_number = t.account_number AND a.shard_location = t.shard_location "
            "GROUP BY a.account_number, a.user_id, username, full_name, a.account_type, a.balance, a.currency, "
            "a.region, a.status",
            TOUCHES,
        )
    q["accounts_list"] = _q(
        f"SELECT {ACCOUNT_LIST}, {_text('a.created_date')}, username, full_name FROM accounts_all a LEFT JOIN {OWNER_JOIN}"
    )
    q["users_list"] = _q(
        f"SELECT u.user_id, username, email, full_name, phone, address, u.region, {_text('u.created_date')}, "
        f"count(DISTINCT a.account_number) AS account_count, {_dbl('coalesce(sum(a.balance), 0)', 'total_balance')} "
        f"FROM users_all u LEFT JOIN accounts_all a ON a.user_id = u.user_id AND a.shard_location = u.shard_location "
        "GROUP BY u.user_id, username, email, full_name, phone, address, u.region, u.created_date"
    )
    q["users_directory"] = _q("SELECT username, email, region, shard_location, user_id FROM users_all")
    q["accounts_directory"] = _q(
        f"SELECT shard_location, account_id, user_id, account_number, account_type, {_dbl('balance', 'balance')}, region "
        "FROM accounts_all"
    )
    q["users_dropdown"] = _q("SELECT user_id, username, full_name, region FROM users_all")

    # statistics
    q["regional_stats"] = _q(REGIONAL, TOUCHES)
    q["regional_stats_exact"] = _q(
        f"SELECT a.region, count(DISTINCT u.user_id) AS user_count, count(DISTINCT a.account_number) AS account_count, "
        f"{_big('coalesce(sum(n.touched), 0)', 'transaction_count')}, {_dbl('sum(a.balance)', 'total_balance')}, "
        f"{_avg('a.balance')} AS avg_balance, {_dbl('min(a.balance)', 'min_balance')}, "
        f"{_dbl('max(a.balance)', 'max_balance')} FROM accounts_all a LEFT JOIN {OWNER_JOIN} "
        "LEFT JOIN (SELECT shard_location, account_number, count(*) AS touched FROM touches GROUP BY ALL) n "
        "ON a.account_number = n.account_number AND a.shard_location = n.shard_location GROUP BY a.region",
        TOUCHES,
    )
    q["transaction_stats_by_region"] = _q(
        f"SELECT region, total_transactions, deposits, withdrawals, transfers, {TOTALS_AS_DOUBLE} FROM ({HOME_STATS})"
    )
    q["dashboard_regional_stats"] = _q(
        f"""SELECT coalesce(h.region, s.region) AS region, coalesce(total_users, 0) AS total_users,
          coalesce(total_accounts, 0) AS total_accounts, coalesce(total_transactions, 0) AS total_transactions,
          coalesce(total_balance, 0) AS total_balance, coalesce(avg_balance_per_account, 0) AS avg_balance_per_account,
          coalesce(deposits, 0) AS deposits, coalesce(withdrawals, 0) AS withdrawals, coalesce(transfers, 0) AS transfers,
          {TOTALS_AS_DOUBLE}
        FROM (SELECT coalesce(a.region, u.region) AS region, {HOLDINGS} FROM users_all u LEFT JOIN accounts_all a
              ON a.user_id = u.user_id AND a.shard_location = u.shard_location GROUP BY 1) h
          FULL JOIN ({HOME_STATS}) s ON h.region = s.region"""
    )
    q["dashboard_overall_stats"] = _q(
        f"""SELECT 'TOTAL' AS metric, h.*, total_transactions, completed_transactions, pending_transactions,
          failed_transactions, {TOTALS_AS_DOUBLE}
        FROM (SELECT {HOLDINGS} FROM users_all u LEFT JOIN accounts_all a
              ON a.user_id = u.user_id AND a.shard_location = u.shard_location) h,
          (SELECT count(*) AS total_transactions, count(*) FILTER (status = 'COMPLETED') AS completed_transactions,
             count(*) FILTER (status = 'PENDING') AS pending_transactions,
             count(*) FILTER (status = 'FAILED') AS failed_transactions, {TYPE_TOTALS} FROM transactions_all)"""
    )
    q["dashboard_recent_transactions"] = _q(
        f"SELECT from_account_number, to_account_number, transaction_type, {_dbl('amount', 'amount')}, status, "
        f"{_text('transaction_date')}, description, reference_number, shard_location FROM "
        "(SELECT * FROM transactions_all ORDER BY transaction_date DESC, reference_number DESC LIMIT 20)"
    )
    q["dashboard_accounts_by_region"] = _q(
        f"SELECT region, account_type, {BALANCE_MEASURES} FROM accounts_all GROUP BY region, account_type"
    )
    q["tx_by_date"] = _q(
        f"SELECT strftime(transaction_date, '%Y-%m-%d') AS transaction_date, count(*) AS transaction_count, "
        f"{_dbl('sum(amount)', 'total_amount')}, {TYPE_COUNTS} FROM transactions_all "
        f"WHERE transaction_date >= {LATEST} - INTERVAL 30 DAY GROUP BY 1"
    )
    q["realtime_analytics"] = _q(
        f"SELECT transaction_type, {AMOUNT_MEASURES}, {_dbl('min(amount)', 'min_amount')}, "
        f"{_dbl('max(amount)', 'max_amount')} FROM transactions_all "
        f"WHERE transaction_date >= {LATEST} - INTERVAL 1 DAY GROUP BY transaction_type"
    )
    # the same over a store
    q["tx_by_date_stored"], q["realtime_analytics_stored"] = q["tx_by_date"], q["realtime_analytics"]
    for name, rows in (("users_per_shard", 1000), ("users_per_shard_pages", 100)):
        q[name] = _q(
            f"SELECT shard_location, (n - 1) // {rows} AS page, count(*) AS user_count, "
            "string_agg(username, ', ' ORDER BY user_id) AS users FROM (SELECT *, "
            "row_number() OVER (PARTITION BY shard_location ORDER BY user_id) AS n FROM users_all) GROUP BY ALL"
        )
    q["accounts_by_region_shard"] = _q(
        f"SELECT region, shard_location, count(*) AS account_count, {_dbl('sum(balance)', 'total_balance')}, "
        f"{_avg('balance')} AS avg_balance FROM accounts_all GROUP BY region, shard_location"
    )
    q["tx_by_shard_type"] = _q(
        f"SELECT shard_location, transaction_type, {AMOUNT_MEASURES} FROM transactions_all GROUP BY ALL"
    )
    q["balance_bands"] = _q(
        "SELECT region, shard_location, CASE WHEN balance < 1000 THEN 'Low' WHEN balance < 10000 THEN 'Medium' "
        "ELSE 'High' END AS balance_category, count(*) AS account_count FROM accounts_all GROUP BY ALL"
    )
    q["region_aggregate"] = _q(f"SELECT region, {BALANCE_MEASURES} FROM accounts_all GROUP BY region")
    q["tx_distribution"] = _q(
        f"SELECT count(*) AS total_transactions, {_dbl('sum(amount)', 'total_amount')}, "
        f"{_text('min(transaction_date)', 'first_transaction')}, {_text('max(transaction_date)', 'last_transaction')} "
        "FROM transactions_all"
    )
    q["tx_summary"] = _q(
        f"SELECT transaction_type, count(*) AS count, {_dbl('sum(amount)', 'total_amount')} FROM transactions_all GROUP BY 1"
    )
    q["account_count"] = _q("SELECT count(*) AS account_count FROM accounts_all")
    q["accounts_per_region"] = _q("SELECT region, count(*) AS account_count FROM accounts_all GROUP BY region")
    q["regional_share"] = _q(
        f"SELECT region, count(DISTINCT account_number) AS accounts, {_dbl('sum(balance)', 'total_balance')}, "
        "CAST((2 * CAST(sum(balance) * 1000000 AS HUGEINT) + g.cents) // (2 * g.cents) AS DOUBLE) / 100 AS percentage "
        "FROM accounts_all, (SELECT CAST(sum(balance) * 100 AS HUGEINT) AS cents FROM accounts_all) g "
        "GROUP BY region, g.cents"
    )
    q["first_accounts"] = _q(
        "SELECT region, min(user_id) AS first_user_id, min(account_number) AS first_account_number "
        "FROM accounts_all GROUP BY region"
    )
    q["balance_check"] = _q(
        f"SELECT min(account_number) AS account_number, {_dbl('arg_min(balance, account_number)', 'balance')}, region "
        "FROM accounts_all GROUP BY region"
    )

    # routing and batch lookups
    q["get_user_shard"] = _q(
        "SELECT line, CASE WHEN user_id BETWEEN 1 AND 10000000 THEN 'SHARD1' WHEN user_id BETWEEN 10000001 AND 20000000 "
        "THEN 'SHARD2' WHEN user_id BETWEEN 20000001 AND 30000000 THEN 'SHARD3' ELSE 'UNKNOWN' END AS shard "
        "FROM user_feed",
        USER_FEED,
    )
    q["route_users"] = _q(
        "SELECT line, CAST(CASE WHEN user_id BETWEEN 1 AND 10000000 THEN 1 WHEN user_id BETWEEN 10000001 AND 20000000 "
        "THEN 2 WHEN user_id BETWEEN 20000001 AND 30000000 THEN 3 END AS BIGINT) AS shard_id FROM user_feed",
        USER_FEED,
    )
    q["route_regions"] = _q(
        "SELECT line, region, CAST(CASE upper(region) WHEN 'NA' THEN 1 WHEN 'EU' THEN 2 WHEN 'APAC' THEN 3 END AS BIGINT) "
        "AS shard_id, CASE upper(region) WHEN 'NA' THEN 'SHARD1' WHEN 'EU' THEN 'SHARD2' WHEN 'APAC' THEN 'SHARD3' END "
        "AS shard FROM user_feed",
        USER_FEED,
    )
    q["shard_routing_usage"] = _q(
        "SELECT CAST(shard_id AS BIGINT) AS shard_id, shard_name, region, CAST(lo AS BIGINT) AS user_id_range_start, "
        "CAST(hi AS BIGINT) AS user_id_range_end, shard_name AS hostname, CAST(1521 AS BIGINT) AS port, "
        "'ACTIVE' AS status, CAST(hi - lo + 1 AS BIGINT) AS id_range_size, coalesce(used_ids, 0) AS used_ids "
        "FROM (VALUES (1, 'shard1', 'NA', 1, 10000000, 'SHARD1'), (2, 'shard2', 'EU', 10000001, 20000000, 'SHARD2'), "
        "(3, 'shard3', 'APAC', 20000001, 30000000, 'SHARD3')) m(shard_id, shard_name, region, lo, hi, tag) "
        "LEFT JOIN (SELECT shard_location, count(*) AS used_ids FROM users_all GROUP BY 1) ON tag = shard_location"
    )
    wanted = "(SELECT other AS account_number FROM order_sides)"
    q["balances_for"] = _q(
        f"SELECT w.account_number, {_dbl('balance', 'balance')} FROM {wanted} w "
        "LEFT JOIN accounts_all a ON w.account_number = a.account_number"
    )
    q["account_info"] = _q(
        f"SELECT w.account_number, region, shard_location FROM {wanted} w "
        "LEFT JOIN accounts_all a ON w.account_number = a.account_number"
    )
    q["account_region"] = _q(
        f"SELECT w.account_number, region FROM {wanted} w LEFT JOIN accounts_all a ON w.account_number = a.account_number"
    )
    q["account_id_lookup"] = _q(
        f"SELECT w.account_number, account_id FROM {wanted} w "
        "LEFT JOIN accounts_all a ON w.account_number = a.account_number"
    )
    q["user_region"] = _q(
        "SELECT f.line, f.user_id, u.region FROM user_feed f LEFT JOIN users_all u ON f.user_id = u.user_id", USER_FEED
    )
    q["find_user_shard"] = _q(
        "SELECT f.username, f.line, u.user_id, u.region, u.shard_location FROM user_feed f "
        "LEFT JOIN users_all u ON f.username = u.username",
        USER_FEED,
    )

    # ids and integrity
    q["validate_users"] = _q(
        "SELECT line, reasons, CAST(CASE WHEN contains(reasons, 'invalid_region') THEN -20001 "
        "WHEN contains(reasons, 'id_out_of_range') THEN -20002 END AS BIGINT) AS error_code FROM user_judged",
        USER_JUDGED.format(exact="true"),
    )
    q["dup_users"] = _q(
        "SELECT user_id, count(*) AS copies FROM user_feed WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        USER_FEED,
    )
    numbered = """
  asked AS (SELECT *, upper(region) AS home FROM user_judged WHERE reasons = ''),
  used AS (SELECT home, max(user_id) AS last_used FROM asked WHERE user_id IS NOT NULL GROUP BY home)"""
    given_id = (
        "coalesce(user_id, coalesce(last_used + 1, CASE asked.home WHEN 'NA' THEN 1 WHEN 'EU' THEN 10000001 "
        "ELSE 20000001 END) + row_number() OVER (PARTITION BY asked.home, user_id IS NULL ORDER BY line) - 1)"
    )
    q["assign_user_ids"] = _q(
        f"SELECT line, {_big(given_id, 'user_id')}, asked.home AS region FROM asked LEFT JOIN used ON asked.home = used.home",
        USER_JUDGED.format(exact="false"),
        numbered,
    )
    q["append_users"] = _q(
        f"""SELECT CAST(coalesce(user_id, greatest(last_used, coalesce(given_last, 0))
          + row_number() OVER (PARTITION BY upper(j.region), user_id IS NULL ORDER BY line)) AS BIGINT) AS user_id,
          username, email, upper(j.region) AS region, '2024-01-01 00:00:00' AS created_date,
          CASE upper(j.region) WHEN 'NA' THEN 'SHARD1' WHEN 'EU' THEN 'SHARD2' ELSE 'SHARD3' END AS shard_location
        FROM user_judged j JOIN (SELECT region AS home, max(user_id) AS last_used FROM users_all GROUP BY region)
            ON home = upper(j.region)
          LEFT JOIN (SELECT upper(region) AS g, max(user_id) AS given_last FROM user_judged
            WHERE reasons = '' AND user_id NOT IN (SELECT user_id FROM users_all) GROUP BY 1) ON g = upper(j.region)
        WHERE reasons = '' AND (user_id IS NULL OR user_id NOT IN (SELECT user_id FROM users_all))""",
        USER_JUDGED.format(exact="false"),
    )
    q["validate_accounts"] = _q(
        "SELECT line, reasons, CAST(CASE WHEN contains(reasons, 'user_not_found') THEN -20002 "
        "WHEN contains(reasons, 'region_mismatch') THEN -20003 END AS BIGINT) AS error_code, 'USD' AS currency, status "
        "FROM account_judged",
        ACCOUNT_FEED,
        ACCOUNT_REASONS,
    )
    q["assign_account_ids"] = _q(
        """SELECT line, CAST(new_id AS BIGINT) AS account_id, coalesce(account_number, 'ACC-' || new_id) AS account_number,
          shard_location FROM (SELECT f.*, coalesce(account_id, last_used
            + row_number() OVER (PARTITION BY f.shard_location, account_id IS NULL ORDER BY line)) AS new_id
          FROM account_feed f JOIN (SELECT shard_location, max(account_id) AS last_used FROM
            (SELECT shard_location, account_id FROM accounts_all
             UNION ALL SELECT shard_location, account_id FROM account_feed) GROUP BY 1) u
            ON f.shard_location = u.shard_location)""",
        ACCOUNT_FEED,
    )
    q["orphan_accounts"] = _q(
        "SELECT line, user_id, account_number, shard_location FROM account_feed WHERE ownerless", ACCOUNT_FEED
    )
    q["dup_accounts"] = _q(
        "SELECT shard_location, account_number, count(*) AS copies FROM account_feed WHERE account_number IS NOT NULL "
        "GROUP BY ALL HAVING count(*) > 1",
        ACCOUNT_FEED,
    )
    q["dup_accounts_global"] = _q(
        "SELECT account_number, count(*) AS copies FROM account_feed WHERE account_number IS NOT NULL "
        "GROUP BY ALL HAVING count(*) > 1",
        ACCOUNT_FEED,
    )
    q["append_accounts"] = _q(
        f"""SELECT CAST(u + row_number() OVER (PARTITION BY shard_location ORDER BY line) AS BIGINT) AS account_id,
          user_id, 'ACC-' || CAST(u + row_number() OVER (PARTITION BY shard_location ORDER BY line) AS BIGINT)
          AS account_number, account_type, {_dbl('balance', 'balance')}, 'USD' AS currency, region, 'ACTIVE' AS status,
          '2024-01-01 00:00:00' AS created_date, shard_location
        FROM (SELECT f.line, f.user_id, f.account_type, coalesce(f.balance, 0) AS balance, us.region, us.shard_location, u
              FROM account_feed f JOIN users_all us ON f.user_id = us.user_id
                JOIN (SELECT shard_location, max(account_id) AS u FROM accounts_all GROUP BY 1) m
                  ON us.shard_location = m.shard_location
              WHERE f.account_type IN ('CHECKING', 'SAVINGS', 'BUSINESS') AND coalesce(f.balance, 0) >= 0)""",
        ACCOUNT_FEED,
    )
    q["derive_routing"] = _q(
        "SELECT line, account_number, 'USD' AS currency, status FROM transaction_routed", TRANSACTION_FEED
    )
    home = "SELECT account_number FROM accounts_all a WHERE a.shard_location = r.shard_location"
    q["validate_transactions"] = _q(
        f"""SELECT line, concat_ws(',',
          CASE WHEN r.account_number IS NULL THEN 'null_account_number' END,
          CASE WHEN amount IS NULL THEN 'null_amount' END,
          CASE WHEN transaction_type = 'REFUND' THEN 'chk_transaction_type' END,
          CASE WHEN amount <= 0 THEN 'chk_amount' END,
          CASE WHEN r.status = 'DONE' THEN 'chk_status' END,
          CASE WHEN NOT ((f IS NOT NULL AND transaction_type IN ('TRANSFER', 'WITHDRAWAL'))
            OR (t IS NOT NULL AND transaction_type IN ('TRANSFER', 'DEPOSIT'))) THEN 'chk_trans_accounts' END,
          CASE WHEN r.account_number IS NOT NULL AND h.account_number IS NULL THEN 'orphan_account' END,
          CASE WHEN f IS NOT NULL AND s.account_number IS NULL THEN 'orphan_from_account' END) AS reasons
        FROM transaction_routed r
          LEFT JOIN accounts_all h ON h.shard_location = r.shard_location AND h.account_number = r.account_number
          LEFT JOIN accounts_all s ON s.shard_location = r.shard_location AND s.account_number = r.f""",
        TRANSACTION_FEED,
    )
    q["orphan_transactions"] = _q(
        f"SELECT transaction_id, account_number, from_account_number, shard_location FROM raw_transactions r "
        f"WHERE account_number NOT IN ({home}) OR (from_account_number IS NOT NULL AND from_account_number NOT IN ({home}))"
    )

    # posting
    q["validate_requests"] = _q(
        f"SELECT seq, reason, {ERROR_CODE} FROM judged", FAULTY, _judge_requests("faulty")
    )
    q["generate_requests"] = _q(
        """SELECT i AS seq, CASE i % 3 WHEN 0 THEN 'DEPOSIT' WHEN 1 THEN 'WITHDRAWAL' ELSE 'TRANSFER' END
          AS transaction_type, CASE WHEN i % 2 = 0 THEN 'ACC-' || (i * 12345 % 30000000 + 1) END AS from_account_number,
          'ACC-' || ((i + 1) * 54321 % 30000000 + 1) AS to_account_number,
          CAST(1000 + CAST(amount * 100 AS BIGINT) % 99001 AS DOUBLE) / 100 AS amount,
          'Batch transaction ' || i AS description
        FROM (SELECT o_orderkey + 1 AS i, amount FROM order_sides)"""
    )
    q["post_ledger"] = _q(
        f"SELECT seq, CASE WHEN reason IS NULL THEN 'COMPLETED' ELSE 'REJECTED' END AS status, reason, {ERROR_CODE} "
        "FROM (SELECT seq, final_reason AS reason FROM posted)",
        POSTED,
    )
    q["post_ledger_records"] = _q(
        "SELECT coalesce(f, t) AS account_number, f AS from_account_number, t AS to_account_number, transaction_type, "
        "CAST(cents AS DOUBLE) / 100 AS amount, 'USD' AS currency, 'COMPLETED' AS status, "
        "'2024-01-01 00:00:00' AS transaction_date, description, CAST(NULL AS VARCHAR) AS reference_number, "
        "coalesce(f_shard, t_shard) AS shard_location FROM posted WHERE final_reason IS NULL",
        POSTED,
    )
    q["post_ledger_accounts"] = _q(
        f"""SELECT a.account_number, a.shard_location,
          CAST(CAST(a.balance * 100 AS BIGINT) + coalesce(n.net, 0) AS DOUBLE) / 100 AS balance,
          CASE WHEN n.net IS NULL THEN strftime(a.last_updated, '%Y-%m-%d %H:%M:%S') ELSE '2024-01-01 00:00:00' END
            AS last_updated
        FROM accounts_all a LEFT JOIN (SELECT account, sum(delta) AS net FROM entries
          WHERE seq IN (SELECT seq FROM posted WHERE final_reason IS NULL) GROUP BY account) n
          ON a.account_number = n.account""",
        POSTED,
    )

    q["save_posting"] = q["save_posting_merged"] = q["post_ledger_accounts"]
    q["save_posting_records"] = _q(
        "SELECT CAST(m + row_number() OVER (PARTITION BY shard ORDER BY seq) AS BIGINT) AS transaction_id, "
        "coalesce(f, t) AS account_number, f AS from_account_number, t AS to_account_number, transaction_type, "
        "CAST(cents AS DOUBLE) / 100 AS amount, 'USD' AS currency, 'COMPLETED' AS status, "
        "'2024-01-01 00:00:00' AS transaction_date, description, CAST(NULL AS VARCHAR) AS reference_number, "
        "shard AS shard_location FROM (SELECT *, coalesce(f_shard, t_shard) AS shard FROM posted WHERE final_reason IS NULL) "
        "JOIN (SELECT shard_location, max(transaction_id) AS m FROM transactions_all GROUP BY 1) ON shard_location = shard",
        POSTED,
    )
    shard_id = "CASE WHEN {0} BETWEEN 1 AND 10000000 THEN {1} WHEN {0} BETWEEN 10000001 AND 20000000 THEN {2} " \
        "WHEN {0} BETWEEN 20000001 AND 30000000 THEN {3}"
    q["sql_functions"] = _q(
        f"SELECT line, {shard_id.format('user_id', *[repr(f'SHARD{n}') for n in (1, 2, 3)])} ELSE 'UNKNOWN' END AS shard, "
        f"CAST({shard_id.format('user_id', 1, 2, 3)} END AS BIGINT) AS shard_id, "
        "CAST(CASE upper(region) WHEN 'NA' THEN 1 WHEN 'EU' THEN 2 WHEN 'APAC' THEN 3 END AS BIGINT) AS region_shard_id "
        "FROM user_feed",
        USER_FEED,
    )
    q["sql_account_balance"] = q["balances_for"]
    q["sql_region_filter"] = _q(f"SELECT {ACCOUNT_COLUMNS} FROM accounts_all WHERE region = 'EU'")
    q["post_ledger_tight"] = q["post_ledger"].replace("CAST(balance * 100 AS BIGINT) AS opening", "CAST(floor(balance) AS BIGINT) AS opening")
    q["stream_post_ledger"] = _q(
        f"""SELECT a.account_number, a.shard_location,
          CAST(CAST(a.balance * 100 AS BIGINT) + coalesce(n.net, 0) AS DOUBLE) / 100 AS balance,
          CASE WHEN n.net IS NULL THEN strftime(a.last_updated, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(TIMESTAMP '2024-01-01' + to_days(CAST(n.batch AS INTEGER)), '%Y-%m-%d %H:%M:%S') END AS last_updated
        FROM accounts_all a LEFT JOIN (SELECT account, sum(delta) AS net,
            max((seq - (SELECT min(seq) FROM requests)) // ((SELECT max(seq) - min(seq) FROM requests) // 3 + 1)) AS batch
          FROM entries WHERE seq IN (SELECT seq FROM posted WHERE final_reason IS NULL) GROUP BY account) n
          ON a.account_number = n.account""",
        POSTED,
    )

    # streams, and the batch form of the first
    closed = (
        f"SELECT strftime(transaction_date, '%Y-%m-%d') AS transaction_date, count(*) AS transaction_count, "
        f"{_dbl('sum(amount)', 'total_amount')}, {TYPE_COUNTS} FROM event_rows "
        "WHERE date_trunc('day', transaction_date) + INTERVAL 2 DAY <= (SELECT max(transaction_date) FROM event_rows) "
        "GROUP BY 1"
    )
    q["stream_tx_by_day"] = _q(closed, EVENTS)
    q["tx_by_day_closed"] = _q(closed, EVENTS)
    arrivals = """
  arrivals AS (
    SELECT *, CASE WHEN event_id % 50 = 7 THEN 2
      ELSE (event_id - (SELECT min(event_id) FROM events)) // ((SELECT max(event_id) - min(event_id) FROM events) // 3 + 1) END AS part
    FROM event_rows),
  marks AS (
    SELECT part, max(max(transaction_date)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM arrivals GROUP BY part)"""
    q["stream_tx_by_day_corrected"] = _q(
        f"SELECT strftime(transaction_date, '%Y-%m-%d') AS transaction_date, count(*) AS transaction_count, "
        f"{_dbl('sum(amount)', 'total_amount')}, {TYPE_COUNTS}, "
        "count(*) FILTER (date_trunc('day', transaction_date) + INTERVAL 2 DAY <= before) AS late_count "
        "FROM arrivals JOIN marks USING (part) "
        "WHERE date_trunc('day', transaction_date) + INTERVAL 2 DAY <= (SELECT max(transaction_date) FROM event_rows) "
        "GROUP BY 1",
        EVENTS,
        arrivals,
    )
    q["stream_regional_totals"] = _q(
        f"SELECT region, total_transactions, deposits, withdrawals, transfers, {TOTALS_AS_DOUBLE} FROM "
        f"(SELECT a.region, count(*) AS total_transactions, {TYPE_COUNTS}, {TYPE_TOTALS} FROM event_rows e "
        "JOIN accounts_all a ON e.account_number = a.account_number GROUP BY a.region)",
        EVENTS,
    )
    q["stream_overall"] = _q(
        f"SELECT total_transactions, completed_transactions, pending_transactions, failed_transactions, {TOTALS_AS_DOUBLE} "
        "FROM (SELECT count(*) AS total_transactions, count(*) FILTER (status = 'COMPLETED') AS completed_transactions, "
        "count(*) FILTER (status = 'PENDING') AS pending_transactions, "
        f"count(*) FILTER (status = 'FAILED') AS failed_transactions, {TYPE_TOTALS} FROM event_rows)",
        EVENTS,
    )
    return q
