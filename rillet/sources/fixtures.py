"""Reference tables derived from the given parquet tables.

The workshop's tables (transactions, customer versions, a lookup table, JSON
customer feeds, support queries) are derived from ``events``, ``customer``,
``nation`` and ``part`` with plain column expressions, so every derived row
comes from a scanned row and the work grows with the input.  The DuckDB
oracle in :mod:`rillet.plans.oracle` uses the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Option lists of the reference's transaction generator, in the
# reference's order.  They must stay equal for results to match.
CURRENCIES = ["USD", "EUR", "INR", "GBP", "JPY"]
LOCATIONS = [
    "New York", "Los Angeles", "Chicago", "Charlotte", "San Francisco", "Indianapolis", "Seattle",
    "Denver", "Washington", "Boston", "El Paso", "Nashville", "Detroit", "Oklahoma City", "Portland",
    "Las Vegas", "Memphis", "Louisville", "Baltimore",
]
MERCHANTS = [
    "Walmart Inc.", "Amazon.com Inc.", "CVS Health", "Costco Wholesale Corporation", "Schwarz Group",
    "McKesson Corporation", "McDonalds Corporation", "Starbucks Corporation", "Cencora",
    "The Home Depot Inc.", "Yum! Brands", "The Kroger Co.", "Aldi Group", "Walgreens Boots Alliance",
    "Cardinal Health", "Subway", "JD.com Inc.", "Target Corporation", "Ahold Delhaize",
    "Lowe Companies Inc.",
]
# The five canned support questions of the customer-query generator; the
# account named in the text is filled in per row ('{}').
SUPPORT_QUESTIONS = [
    "What is my current balance for account {}?",
    "Are there any suspicious transactions on my account {}?",
    "What was my last transaction on account {}?",
    "Is my account {} in good standing?",
    "Can you check recent activity on account {}?",
]
# The message to a customer whose withdrawal is flagged: account, amount, currency.
DECLINED_MESSAGE = ("Dear user {}, your transaction of {} cannot be processed due to lack of {} "
                    "balance available on your card.")
# Account number layout of the generators: 'ACC' + 1000000 + user id.
ACCOUNT_PREFIX = "ACC"
ACCOUNT_BASE = 1000000
# ---------------------------------------------------------------------------

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(options: list[str], index: Column) -> Column:
    """``options[index]`` (0-based) as a Catalyst expression."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def account_of(user_id: Column) -> Column:
    return F.concat(F.lit(ACCOUNT_PREFIX), (F.lit(ACCOUNT_BASE) + user_id).cast("string"))


#: Rows that reach the operators' rare branches: event ids with this remainder (divisor, remainder).
NO_MERCHANT = (97, 5)
OTHER_MERCHANT = (89, 7)
LARGE = (211, 8)         # amount x 25
VERY_LARGE = (409, 3)    # amount x 100
NO_CUSTOMER = (59, 11)   # an account that no customer has; never a signup
UNLISTED = "Corner Shop"
STRANGER_BASE = 9000000


def _picked(event_id: Column, rule: tuple[int, int]) -> Column:
    return F.pmod(event_id, F.lit(rule[0])) == rule[1]


def transactions_from_events(events: DataFrame) -> DataFrame:
    """The 9-column transactions table, one row per event."""
    eid = F.col("event_id")
    amount = F.col("value").cast("decimal(10,2)")
    stranger = _picked(eid, NO_CUSTOMER) & (F.col("event_type") != "signup")
    return events.select(
        eid.cast("string").alias("txn_id"),
        F.when(stranger, F.concat(F.lit(ACCOUNT_PREFIX), (F.lit(STRANGER_BASE) + F.col("user_id")).cast("string")))
        .otherwise(account_of(F.col("user_id"))).alias("account_number"),
        F.col("ts").alias("timestamp"),
        F.when(_picked(eid, VERY_LARGE), amount * 100).when(_picked(eid, LARGE), amount * 25).otherwise(amount).cast("decimal(10,2)").alias("amount"),
        pick(CURRENCIES, F.pmod(F.floor(eid / 3), F.lit(5))).alias("currency"),
        F.when(_picked(eid, OTHER_MERCHANT), F.lit(UNLISTED)).when(~_picked(eid, NO_MERCHANT), pick(MERCHANTS, F.pmod(eid, F.lit(20)))).alias("merchant"),
        pick(LOCATIONS, F.pmod(eid, F.lit(19))).alias("location"),
        F.when(F.pmod(eid, F.lit(3)) == 0, "Failed").otherwise("Successful").alias("status"),
        F.when(F.col("event_type") == "error", "refund")
        .when(F.col("event_type") == "signup", "withdrawal")
        .otherwise("payment").alias("transaction_type"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(read_table(spark, sf_dir, "events"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer versions: each signup event is a new version of its account."""
    return customers_from_events(read_table(spark, sf_dir, "events"), spark, sf_dir)


def customers_from_events(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer versions from an events DataFrame (batch or stream; the
    customer and nation tables are static)."""
    ev = events.where(F.col("event_type") == "signup")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (ev.join(cust, ev.user_id == cust.c_custkey, "inner")
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    return j.select(
        account_of(F.col("user_id")).alias("account_number"),
        F.concat(F.col("c_name"), F.lit("#"), F.col("event_id").cast("string")).alias("customer_name"),
        F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("phone_number"),
        F.make_timestamp_ntz(F.lit(1970) + F.pmod(F.col("c_custkey"), F.lit(32)).cast("int"),
                             F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("date_of_birth"),
        F.col("n_name").alias("city"),
        F.col("ts").alias("created_at"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External key-searchable table (title, genres, rated, plot, year) from ``part``."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_name").alias("title"),
        F.array(F.col("p_type")).alias("genres"),
        F.col("p_brand").alias("rated"),
        F.concat(F.lit("A "), F.lower(F.col("p_type")), F.lit(" story.")).alias("plot"),
        (F.lit(1970) + F.pmod(F.col("p_size"), F.lit(32))).cast("int").alias("year"),
        F.col("p_partkey").alias("movie_id"),
        F.floor(F.col("p_partkey") / F.lit(SHELF)).alias("shelf"),
    )


#: Movies of one lookup key: keys grow with the table, matches per key don't.
SHELF = 8


def favourite_shelf(phone_number: Column) -> Column:
    """The shelf a customer looks up, by the digits of the phone number."""
    return F.floor(F.substring(phone_number, 8, 7).cast("bigint") / F.lit(SHELF))


def customers_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the address packed into a JSON string; every 50th is malformed."""
    c = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(nation, c.c_nationkey == nation.n_nationkey, "left")
    good = F.concat(
        F.lit('{"street": "'), F.col("c_custkey").cast("string"), F.lit(" Main Street"),
        F.lit('", "postcode": "'), F.lpad(F.col("c_nationkey").cast("string"), 5, "0"),
        F.lit('", "city": "'), F.col("n_name"), F.lit('"}'))
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(F.pmod(F.col("c_custkey"), F.lit(50)) == 0, F.lit("not valid json")).otherwise(good)
        .alias("full_address"),
        F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
    )


def customer_emails_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON arrays of 0..3 e-mail addresses per customer (`[]` when the count is 0)."""
    c = read_table(spark, sf_dir, "customer")
    n = F.pmod(F.col("c_custkey"), F.lit(4)).cast("int")
    three = F.array(*[F.concat(F.lit(f"user{i}."), F.col("c_custkey").cast("string"), F.lit("@mail.test"))
                      for i in range(1, 4)])
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.to_json(F.slice(three, 1, n)).alias("emails"),
        n.alias("desired_email_count"),
    )


def customer_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support questions, one per customer, the question chosen by key."""
    c = read_table(spark, sf_dir, "customer")
    acct = account_of(F.col("c_custkey"))
    return c.select(
        F.concat(F.lit("Q"), F.col("c_custkey").cast("string")).alias("query_id"),
        acct.alias("account_number"),
        F.concat(pick([q.split("{}")[0] for q in SUPPORT_QUESTIONS], F.pmod(F.col("c_custkey"), F.lit(5))),
                 acct,
                 pick([q.split("{}")[1] for q in SUPPORT_QUESTIONS], F.pmod(F.col("c_custkey"), F.lit(5))))
        .alias("query_text"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("timestamp"),
    )


def customer_records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON customer records with poison: every 97th is the reference's poison pill,
    every 89th has a NULL key, every 83rd is not JSON at all."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    good = F.concat(F.lit('{"customer_id": '), k.cast("string"), F.lit(', "name": "'), F.col("c_name"),
                    F.lit('", "city": "'), F.col("c_nationkey").cast("string"), F.lit('"}'))
    null_key = F.concat(F.lit('{"customer_id": null, "name": "'), F.col("c_name"), F.lit('"}'))
    raw = (F.when(F.pmod(k, F.lit(97)) == 0, F.lit('{"id": 1, "payload": "poisoned pill"}'))
           .when(F.pmod(k, F.lit(89)) == 0, null_key)
           .when(F.pmod(k, F.lit(83)) == 0, F.lit("not json {"))
           .otherwise(good))
    return c.select(k.alias("record_id"), raw.alias("raw"))
