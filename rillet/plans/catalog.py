"""The workshop's queries, expressed with rillet operators.

Every entry takes ``(spark, sf_dir)``, reads the given parquet tables (through
the derivations in :mod:`rillet.sources.fixtures`) and returns a lazy
DataFrame.  Output columns are aliased to the names used by the DuckDB
oracle in :mod:`rillet.plans.oracle`; money is summed exactly as DECIMAL and
cast to DOUBLE once, counts are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.operators import aggregations as agg
from rillet.operators import joins as J
from rillet.operators import over as W
from rillet.operators.scan import rank_slices
from rillet.plans import params as P
from rillet.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _dbl(c: str) -> F.Column:
    return F.col(c).cast("double")


# ----------------------------------------------------------------- A1 / A2
@query("group_by_having")
def group_by_having(spark: SparkSession, sf: str) -> DataFrame:
    """A1 (SQL spelling): withdrawal sums per account above the threshold."""
    fx.transactions(spark, sf).createOrReplaceTempView("transactions")
    return spark.sql(f"""
        SELECT account_number, transaction_type,
               CAST(SUM(amount) AS DOUBLE) AS total_amount
        FROM transactions
        WHERE transaction_type = 'withdrawal'
        GROUP BY account_number, transaction_type
        HAVING SUM(amount) > {P.GROUP_SUM_THRESHOLD}""")


@query("group_by_having_fluent")
def group_by_having_fluent(spark: SparkSession, sf: str) -> DataFrame:
    """A2 (fluent spelling): same plan as A1 through the operator."""
    t = fx.transactions(spark, sf)
    return agg.group_sum_having(t, ["account_number", "transaction_type"], "amount",
                                threshold=P.GROUP_SUM_THRESHOLD,
                                where=F.col("transaction_type") == "withdrawal")


# ----------------------------------------------------------------- A4 / A5
@query("tumble_count")
def tumble_count(spark: SparkSession, sf: str) -> DataFrame:
    """A4: failed payments per merchant and tumbling window (COUNT(*))."""
    t = fx.transactions(spark, sf)
    return agg.tumbling_count(t, "timestamp", P.TUMBLE_SIZE, "merchant", alias="total_tx_failed",
                              where=(F.col("transaction_type") == "payment") & (F.col("status") == "Failed"))


@query("tumble_count_column")
def tumble_count_column(spark: SparkSession, sf: str) -> DataFrame:
    """A5: fluent twin of A4 that counts non-NULL merchants."""
    t = fx.transactions(spark, sf)
    return agg.tumbling_count(t, "timestamp", P.TUMBLE_SIZE, "merchant", count_col="merchant",
                              alias="total_tx_failed",
                              where=(F.col("transaction_type") == "payment") & (F.col("status") == "Failed"))


# ----------------------------------------------------------------- A6
@query("session_count")
def session_count(spark: SparkSession, sf: str) -> DataFrame:
    """Session windows per merchant over all transactions."""
    t = fx.transactions(spark, sf)
    return agg.session_count(t, "timestamp", P.SESSION_GAP, "merchant", alias="total_tx")


# ----------------------------------------------------------------- W6
@query("tumble_lag")
def tumble_lag(spark: SparkSession, sf: str) -> DataFrame:
    """Successful payments per window, merchant and type, with LAG and delta."""
    t = fx.transactions(spark, sf)
    counts = agg.tumbling_count(t, "timestamp", P.TUMBLE_LAG_SIZE, ["merchant", "transaction_type"],
                                alias="total_successful",
                                where=(F.col("transaction_type") == "payment")
                                & (F.col("status") == "Successful"))
    return W.lag_over_tumble(counts, keys=["merchant", "transaction_type"], count_col="total_successful",
                             prev_alias="prev_total_successful", delta_alias="delta")


# ----------------------------------------------------------------- W1 / W2 / W3
@query("over_running_sum")
def over_running_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Running withdrawal sum per account over a time range, with a YES/NO flag."""
    t = fx.transactions(spark, sf).where(F.col("transaction_type") == "withdrawal")
    out = W.running_sum_flag(t.select("txn_id", "account_number", "transaction_type", "amount", "timestamp"),
                             keys=["account_number", "transaction_type"], time_col="timestamp",
                             value_col="amount", range_=P.RUNNING_RANGE, threshold=P.RUNNING_THRESHOLD,
                             flag_alias="FLAG")
    return out.select("txn_id", "account_number", "transaction_type", _dbl("amount").alias("amount"),
                      _dbl("total_value").alias("total_value"), "FLAG")


@query("over_running_count")
def over_running_count(spark: SparkSession, sf: str) -> DataFrame:
    """Failed payments per merchant within the preceding time range."""
    t = (fx.transactions(spark, sf)
         .where((F.col("transaction_type") == "payment") & (F.col("status") == "Failed"))
         .select("txn_id", "timestamp", "merchant"))
    out = W.running_count(t, keys="merchant", time_col="timestamp", range_=P.RUNNING_RANGE,
                          alias="total_tx_failed_last_range")
    return out.withColumn("total_tx_failed_last_range", F.col("total_tx_failed_last_range").cast("bigint"))


@query("flagged_withdrawals")
def flagged_withdrawals(spark: SparkSession, sf: str) -> DataFrame:
    """W3 (CTE + filter on the derived flag)."""
    t = (fx.transactions(spark, sf).where(F.col("transaction_type") == "withdrawal")
         .select("txn_id", "account_number", "currency", "transaction_type", "amount", "merchant",
                 "location", "timestamp"))
    out = W.running_sum_flag(t, keys=["account_number", "transaction_type"], time_col="timestamp",
                             value_col="amount", range_=P.FLAGGED_RANGE, threshold=P.FLAGGED_THRESHOLD)
    return (out.where(F.col("flag") == "YES")
            .select("txn_id", "account_number", "currency", "transaction_type", _dbl("amount").alias("amount"),
                    "merchant", "location", _dbl("total_value").alias("total_value"), "flag"))


# ----------------------------------------------------------------- W4 / J10
def dual_window_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Two differently filtered and partitioned windows, as one table.

    Each window runs over the base with a row condition instead of over a
    filtered copy, so the result needs no join back: two window shuffles in
    total, and every transaction keeps its own row (txn_id is the row key).
    """
    a = fx.transactions(spark, sf)
    slice_ = rank_slices(a, "timestamp")
    succ = F.col("status") == "Successful"
    wd = W.running_sum_flag(
        a, slice_=slice_, keys=["account_number", "transaction_type"], time_col="timestamp", value_col="amount",
        range_=P.DUAL_RANGE, threshold=P.DUAL_WITHDRAW_THRESHOLD, total_alias="withdrawal_total",
        flag_alias="withdraw_flag", only=(F.col("transaction_type") == "withdrawal") & succ)
    both = W.running_sum_flag(
        wd, slice_=slice_, keys=["account_number", "currency"], time_col="timestamp", value_col="amount",
        range_=P.DUAL_RANGE, threshold=P.DUAL_FX_THRESHOLD, total_alias="forex_total",
        flag_alias="fx_flag", only=(F.col("transaction_type") != "refund") & succ)
    j = both.where((F.col("withdraw_flag") == "YES") | (F.col("fx_flag") == "YES"))
    return j.select(*[c for c in a.columns if c != "amount"], _dbl("amount").alias("amount"),
                    _dbl("withdrawal_total").alias("withdrawal_total"),
                    F.coalesce(F.col("withdraw_flag"), F.lit("NO")).alias("withdraw_flag"),
                    _dbl("forex_total").alias("forex_total"), "fx_flag")


@query("dual_window_flags")
def dual_window_flags(spark: SparkSession, sf: str) -> DataFrame:
    return dual_window_frame(spark, sf)


@query("dual_window_flags_joined")
def dual_window_flags_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The reference's literal form - each window over its filtered subset,
    then two LEFT JOINs of the base on (txn_id, account_number) and an OR filter.
    Both joins share the base's partitioning on the join keys."""
    a = fx.transactions(spark, sf)
    succ = F.col("status") == "Successful"
    wd = W.running_sum_flag(
        a.where((F.col("transaction_type") == "withdrawal") & succ)
        .select("txn_id", "account_number", "transaction_type", "amount", "timestamp"),
        keys=["account_number", "transaction_type"], time_col="timestamp", value_col="amount",
        range_=P.DUAL_RANGE, threshold=P.DUAL_WITHDRAW_THRESHOLD, total_alias="withdrawal_total",
        flag_alias="withdraw_flag").select("txn_id", "account_number", "withdrawal_total", "withdraw_flag")
    fxw = W.running_sum_flag(
        a.where((F.col("transaction_type") != "refund") & succ)
        .select("txn_id", "account_number", "currency", "amount", "timestamp"),
        keys=["account_number", "currency"], time_col="timestamp", value_col="amount",
        range_=P.DUAL_RANGE, threshold=P.DUAL_FX_THRESHOLD, total_alias="forex_total",
        flag_alias="fx_flag").select("txn_id", "account_number", "forex_total", "fx_flag")
    j = J.flag_join(J.flag_join(a, wd, keys=["txn_id", "account_number"]), fxw,
                    keys=["txn_id", "account_number"])
    j = j.where((F.col("withdraw_flag") == "YES") | (F.col("fx_flag") == "YES"))
    return j.select(*[c for c in a.columns if c != "amount"], _dbl("amount").alias("amount"),
                    _dbl("withdrawal_total").alias("withdrawal_total"),
                    F.coalesce(F.col("withdraw_flag"), F.lit("NO")).alias("withdraw_flag"),
                    _dbl("forex_total").alias("forex_total"), "fx_flag")


@query("flagged_messages")
def flagged_messages(spark: SparkSession, sf: str) -> DataFrame:
    """P10 + F1: a query over the flagged view composing a customer message."""
    v = dual_window_frame(spark, sf).where(F.col("withdraw_flag") == "YES")
    message = F.format_string(fx.DECLINED_MESSAGE.replace("{}", "%s"), F.col("account_number"),
                              F.col("amount").cast("decimal(10,2)").cast("string"), F.col("currency"))
    return v.select("txn_id", "account_number", message.alias("message"))


# ----------------------------------------------------------------- W5 / U1
@query("latest_values_union")
def latest_values_union(spark: SparkSession, sf: str) -> DataFrame:
    """U1 + W5: union of transactions and customer versions padded with typed NULLs,
    then LAST_VALUE(.. IGNORE NULLS) per account over all preceding rows.

    Ties in event time: customer version first, then transactions by txn_id.
    """
    t = fx.transactions(spark, sf).select(
        "account_number", "txn_id", F.col("amount").cast("double").alias("amount"),
        F.col("timestamp").alias("event_time"), F.lit(1).alias("kind"))
    c = fx.customers(spark, sf).select(
        "account_number", "customer_name", "city", F.col("created_at").alias("event_time"),
        F.lit(0).alias("kind"))
    u = t.unionByName(c, allowMissingColumns=True)
    out = W.latest_values(u, keys="account_number", order_cols=["event_time", "kind", "txn_id"],
                          value_cols=["txn_id", "amount", "customer_name", "city"], prefix="last_")
    return out.select("account_number", "event_time", "kind", "last_txn_id", "last_amount",
                      "last_customer_name", F.col("last_city").alias("city"))


# ----------------------------------------------------------------- J1
@query("temporal_join")
def temporal_join(spark: SparkSession, sf: str) -> DataFrame:
    """Each transaction with the customer version valid at its time."""
    t = fx.transactions(spark, sf).select("txn_id", "account_number", "amount", "timestamp")
    c = fx.customers(spark, sf)
    j = J.temporal_join(t, c, key="account_number", left_time="timestamp", version_time="created_at",
                        version_cols=["customer_name", "created_at"], tiebreak="txn_id")
    return j.select("txn_id", _dbl("amount").alias("amount"), F.col("timestamp").alias("txn_time"),
                    "customer_name", F.col("created_at").alias("signup_time"))


# ----------------------------------------------------------------- J2 / J4 / J5
def _pairs(j: DataFrame) -> DataFrame:
    return j.select("txn_id", _dbl("amount").alias("amount"), F.col("timestamp").alias("txn_time"),
                    "customer_name", F.col("created_at").alias("signup_time"))


@query("interval_join")
def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    """T.timestamp BETWEEN c.created_at AND c.created_at + width."""
    t = fx.transactions(spark, sf).select("txn_id", "account_number", "amount", "timestamp")
    c = fx.customers(spark, sf).select("account_number", "customer_name", "created_at")
    return _pairs(J.interval_join(t, c, key="account_number", left_time="timestamp",
                                  right_time="created_at", lower="0 seconds", upper=P.INTERVAL_WIDTH))


@query("interval_join_left")
def interval_join_left(spark: SparkSession, sf: str) -> DataFrame:
    """J2, left outer: every transaction, with each customer version created in the
    preceding width (NULLs when none)."""
    t = fx.transactions(spark, sf).select("txn_id", "account_number", "amount", "timestamp")
    c = fx.customers(spark, sf).select("account_number", "customer_name", "created_at")
    return _pairs(J.interval_join(t, c, key="account_number", left_time="timestamp", right_time="created_at",
                                  lower="0 seconds", upper=P.INTERVAL_LEFT_WIDTH, how="left"))


@query("ttl_join")
def ttl_join(spark: SparkSession, sf: str) -> DataFrame:
    """J4 re-aimed in event time: pairs whose times differ by at most the TTL."""
    t = fx.transactions(spark, sf).select("txn_id", "account_number", "amount", "timestamp")
    c = fx.customers(spark, sf).select("account_number", "customer_name", "created_at")
    return _pairs(J.interval_join(t, c, key="account_number", left_time="timestamp",
                                  right_time="created_at", lower="-" + P.TTL_BOTH, upper=P.TTL_BOTH))


@query("ttl_join_per_side")
def ttl_join_per_side(spark: SparkSession, sf: str) -> DataFrame:
    """A transaction waits TTL_LEFT for a customer, a customer TTL_RIGHT for transactions:
    ``c.created_at BETWEEN t.ts - TTL_RIGHT AND t.ts + TTL_LEFT``."""
    t = fx.transactions(spark, sf).select("txn_id", "account_number", "amount", "timestamp")
    c = fx.customers(spark, sf).select("account_number", "customer_name", "created_at")
    return _pairs(J.interval_join(t, c, key="account_number", left_time="timestamp",
                                  right_time="created_at", lower="-" + P.TTL_LEFT, upper=P.TTL_RIGHT))


# ----------------------------------------------------------------- J3 / J9
@query("regular_join")
def regular_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every (transaction, customer version) pair per account, summarised per account.

    The pair set is n_t x n_c per account; it is counted from one pre-aggregated
    row per side instead of being materialised.
    """
    t = fx.transactions(spark, sf).select("account_number", "amount")
    c = fx.customers(spark, sf).select("account_number")
    out = J.per_key_pair_counts(t, c, key="account_number", how="inner", left_value="amount")
    return out.select("account_number", "pair_count", _dbl("pair_amount").alias("pair_amount"))


@query("full_outer")
def full_outer(spark: SparkSession, sf: str) -> DataFrame:
    """Full outer join on the account, coalesced key, summarised per account."""
    t = fx.transactions(spark, sf).select("account_number")
    c = fx.customers(spark, sf).select("account_number")
    out = J.per_key_pair_counts(t, c, key="account_number", how="full")
    return out.select(F.col("account_number").alias("account_id"), "pair_count")


@query("regular_join_rows")
def regular_join_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every transaction with its customer's current row; one match a row, so the output
    grows with the transactions."""
    t = fx.transactions(spark, sf).select("txn_id", "account_number", _dbl("amount").alias("amount"), "currency", "merchant", "timestamp")
    c = materialize_latest(spark, sf).select("account_number", "customer_name", "email", "city", "created_at")
    return J.regular_join(t, c, key="account_number")


@query("full_outer_rows")
def full_outer_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Large transactions and the customers of some cities, each with or without the
    other, the account from either side."""
    t = (fx.transactions(spark, sf).where(F.col("amount") > P.LARGE_AMOUNT)
         .select("account_number", "txn_id", _dbl("amount").alias("amount"), "timestamp"))
    c = materialize_latest(spark, sf).where(F.col("city") >= "J").select("account_number", "customer_name", "city")
    return J.regular_join(t, c, key="account_number", how="full")


# ----------------------------------------------------------------- J7 / J8 / C3
@query("materialize_latest")
def materialize_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The upsert table customers_pk as of now: latest version per account."""
    c = fx.customers(spark, sf)
    return J.latest_per_key(c, key="account_number", order_cols=["created_at", "customer_name"])


@query("spend_by_segment")
def spend_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    """Total spend and transaction count per city (transactions x customers_pk).

    SUM and COUNT are decomposable, so transactions are first reduced to one
    row per account (partial aggregation before the shuffle); the join then
    sees one row per account instead of every transaction, and a hot account
    is no longer a skewed join key.
    """
    t = fx.transactions(spark, sf).groupBy("account_number").agg(
        F.sum("amount").alias("acct_spent"), F.count("txn_id").alias("acct_count"))
    c = materialize_latest(spark, sf).select("account_number", "city")
    j = t.join(c, on="account_number", how="inner")
    return j.groupBy("city").agg(F.sum("acct_spent").cast("double").alias("total_spent"),
                                 F.sum("acct_count").cast("bigint").alias("transaction_count"))


@query("high_spenders")
def high_spenders(spark: SparkSession, sf: str) -> DataFrame:
    """Two-level aggregate, high spenders per city.

    Pre-aggregating transactions per account before the join shrinks the
    join input to one row per account; the (email, city) groups are then
    summed from those partials (exact: SUM is decomposable).
    """
    t = fx.transactions(spark, sf).groupBy("account_number").agg(F.sum("amount").alias("acct_total"))
    c = materialize_latest(spark, sf).select("account_number", "email", "city")
    inner = (t.join(c, on="account_number", how="inner")
             .groupBy("email", "city").agg(F.sum("acct_total").alias("total_spent"))
             .where(F.col("total_spent") > P.HIGH_SPENDER_THRESHOLD))
    return inner.groupBy("city").agg(F.count(F.lit(1)).cast("bigint").alias("high_spender_count"))


# ----------------------------------------------------------------- J6
@query("lookup_join")
def lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer version with all movies of its shelf; a key has few movies at any
    size, so the output grows with the customers."""
    c = fx.customers(spark, sf).select("customer_name", "date_of_birth", "phone_number")
    m = fx.movies(spark, sf)
    j = J.lookup_join(c, m, left_key=fx.favourite_shelf(F.col("phone_number")), table_key="shelf",
                      value_cols=["title", "genres", "rated", "plot", "year"], keep_array=False,
                      derive={"n_results": lambda a: F.size(a).cast("bigint"),
                              "titles": lambda a: F.array_join(F.transform(a, lambda s: s["title"]), "|")})
    return j.select("customer_name", "date_of_birth", "n_results", "titles")


# ----------------------------------------------------------------- C2 / C6
@query("changelog_view")
def changelog_view(spark: SparkSession, sf: str) -> DataFrame:
    """+I / -U / +U records of the customers_pk upsert stream."""
    from rillet.operators.changelog import changelog_view as cv
    c = fx.customers(spark, sf).select("account_number", "customer_name", "created_at")
    out = cv(c, key="account_number", order_cols=["created_at", "customer_name"])
    return out.select("op", "account_number", "customer_name", "created_at",
                      F.col("change_created_at").alias("change_time"), "change_seq")


@query("upsert_key_mismatch")
def upsert_key_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """City spend written to a sink whose primary key is total_spent, in bands that cities share."""
    from rillet.operators.changelog import upsert_by_other_key
    band = (F.floor(F.col("total_spent") / P.SPEND_BAND) * P.SPEND_BAND).cast("double")
    return upsert_by_other_key(spend_by_segment(spark, sf).select(band.alias("total_spent"), "city"),
                               query_key="city", sink_key="total_spent")


# ----------------------------------------------------------------- U-T1 / U-T2 / J11 / J12
@query("json_address")
def json_address(spark: SparkSession, sf: str) -> DataFrame:
    """U-T1 + J11: LEFT JOIN LATERAL unnest_json_address(full_address, FALSE) ON TRUE."""
    from rillet.functions.table import lateral, unnest_json_address
    cj = fx.customers_json(spark, sf)
    return lateral(cj, unnest_json_address("full_address", False), outer=True).drop("full_address")


@query("json_array")
def json_array(spark: SparkSession, sf: str) -> DataFrame:
    """U-T2 + J12: CROSS JOIN LATERAL normalize_json_array(emails, FALSE)."""
    from rillet.functions.table import lateral, normalize_json_array
    ce = fx.customer_emails_json(spark, sf)
    return lateral(ce, normalize_json_array("emails", False), outer=False).select(
        "customer_id", "name", "email_index", "email")


# ----------------------------------------------------------------- U-S1..U-S4 / F4
@query("concat_sep")
def concat_sep(spark: SparkSession, sf: str) -> DataFrame:
    """U-S1 over customer versions."""
    from rillet.functions.scalar import concat_with_separator
    c = fx.customers(spark, sf)
    return c.select("customer_name", concat_with_separator("customer_name", "city", "email", F.lit(" | "))
                    .alias("label"))


@query("account_lookup")
def account_lookup_q(spark: SparkSession, sf: str) -> DataFrame:
    """U-S4 for every account seen in the transactions."""
    from rillet.functions.scalar import account_lookup
    accts = fx.transactions(spark, sf).select("account_number").distinct()
    return accts.select("account_number", account_lookup("account_number").alias("lookup_json"))


@query("log_out_of_range")
def log_out_of_range_q(spark: SparkSession, sf: str) -> DataFrame:
    """U-S2: passthrough of every amount plus the out-of-range direction."""
    from rillet.functions.scalar import log_out_of_range, out_of_range_flag
    t = fx.transactions(spark, sf)
    return t.select("txn_id", log_out_of_range("amount", P.LOG_RANGE_LOW, P.LOG_RANGE_HIGH).alias("amount"),
                    out_of_range_flag("amount", P.LOG_RANGE_LOW, P.LOG_RANGE_HIGH).alias("out_of_range"))


@query("random_string")
def random_string_q(spark: SparkSession, sf: str) -> DataFrame:
    """U-S3: a random letter string per transaction; checked by length and alphabet."""
    from rillet.functions.scalar import random_string
    t = fx.transactions(spark, sf).select("txn_id", F.pmod(F.col("txn_id").cast("bigint"),
                                                          F.lit(P.RANDOM_STRING_MAX)).cast("int").alias("n"))
    r = t.withColumn("_r", random_string(F.col("n")))
    return r.select("txn_id", "n", F.length("_r").cast("bigint").alias("len"),
                    F.col("_r").rlike("^[a-zA-Z]*$").alias("letters_only"))


@query("convert_tz")
def convert_tz_q(spark: SparkSession, sf: str) -> DataFrame:
    """Computed column with the transaction time in Europe/Berlin."""
    from rillet.functions.scalar import convert_tz
    t = fx.transactions(spark, sf)
    return t.select("txn_id", convert_tz("timestamp", "UTC", "Europe/Berlin").alias("local_time"))


# ----------------------------------------------------------------- I1 / I2 / I3
@query("classify_risk")
def classify_risk(spark: SparkSession, sf: str) -> DataFrame:
    """I1 + I2: risk level per transaction from the rule model; 'recurring failed'
    = at least N failed transactions of the account within the preceding range."""
    from rillet.operators.inference import RISK_LOW, RISK_MEDIUM, predict_expression, prompt_risk, transaction_prompt
    t = fx.transactions(spark, sf)
    t = W.running_range_totals(t, keys="account_number", time_col="timestamp", range_=P.RECURRING_FAILED_RANGE,
                               counts={"_nf": F.when(F.col("status") == "Failed", 1)})
    prompt = transaction_prompt(F.col("amount"), F.col("transaction_type"), F.col("status"), F.col("merchant"))
    out = predict_expression(t.withColumn("prompt", prompt), F.col("prompt"), prompt_risk)
    # the one rule that the prompt's text can't show
    recurring = (F.col("risk_level") == RISK_LOW) & (F.col("_nf") >= P.RECURRING_FAILED_MIN)
    out = out.withColumn("risk_level", F.when(recurring, RISK_MEDIUM).otherwise(F.col("risk_level")))
    return out.select("txn_id", "account_number", _dbl("amount").alias("amount"), "transaction_type", "status",
                      "merchant", "timestamp", "prompt", "risk_level")


@query("classify_prompt")
def classify_prompt(spark: SparkSession, sf: str) -> DataFrame:
    """A Python model, loaded once per worker, scores the text of each prompt."""
    from rillet.operators.inference import parse_prompt_rules, predict, transaction_prompt
    t = fx.transactions(spark, sf)
    prompt = transaction_prompt(F.col("amount"), F.col("transaction_type"), F.col("status"), F.col("merchant"))
    return predict(t.select("txn_id", prompt.alias("prompt")), F.col("prompt"), parse_prompt_rules,
                   loader=lambda: parse_prompt_rules).select("txn_id", "risk_level")


@query("support_answers")
def support_answers_q(spark: SparkSession, sf: str) -> DataFrame:
    """One answer per support question, from the account tool."""
    from rillet.operators.inference import support_answers
    q = fx.customer_queries(spark, sf)
    return support_answers(q).select("query_id", "account_number", "query_text", "timestamp", "agent_response")


# ----------------------------------------------------------------- M1 / M2 / M3
def _payments(spark: SparkSession, sf: str) -> DataFrame:
    return fx.transactions(spark, sf).where(F.col("transaction_type") == "payment")


@query("match_failed3")
def match_failed3(spark: SparkSession, sf: str) -> DataFrame:
    """M1: three consecutive failed payments within the window (F{3,}? reluctant)."""
    from rillet.operators.patterns import min_run_reluctant
    return min_run_reluctant(_payments(spark, sf), key="account_number", time_col="timestamp",
                             tiebreak="txn_id", status_col="status", within=P.PATTERN_WINDOW)


@query("match_failed_then_success")
def match_failed_then_success(spark: SparkSession, sf: str) -> DataFrame:
    """M2: two or more failed payments then a successful one, within the window."""
    from rillet.operators.patterns import failures_then_success
    out = failures_then_success(_payments(spark, sf), key="account_number", time_col="timestamp",
                                tiebreak="txn_id", status_col="status", within=P.PATTERN_WINDOW,
                                carry=["amount", "merchant"])
    return out.select("account_number", "failed_attempts", "first_attempt_time", "success_time",
                      _dbl("amount").alias("amount"), "merchant")


@query("match_escalating")
def match_escalating(spark: SparkSession, sf: str) -> DataFrame:
    """M3: three consecutive withdrawals with rising amounts, within the window."""
    from rillet.operators.patterns import escalating
    wd = fx.transactions(spark, sf).where(F.col("transaction_type") == "withdrawal")
    out = escalating(wd, key="account_number", time_col="timestamp", value_col="amount",
                     within=P.PATTERN_WINDOW, tiebreak="txn_id")
    return out.select("account_number", *[_dbl(c).alias(c) for c in ("first_amount", "second_amount",
                                                                     "third_amount")],
                      "start_time", "end_time")


# ----------------------------------------------------------------- C11
@query("dlq_split")
def dlq_split(spark: SparkSession, sf: str) -> DataFrame:
    """C11: JSON customer records routed to the table or the dead-letter queue."""
    from rillet.operators.changelog import json_record_checks, tag_invalid
    raw = fx.customer_records_json(spark, sf)
    parsed, checks = json_record_checks(F.col("raw"), "customer_id BIGINT, name STRING, city STRING",
                                        ["customer_id", "name"])
    both = tag_invalid(raw.withColumn("rec", parsed), checks)
    # customer_id is NULL on dead letters; as text it keeps one type on every engine.
    return both.select("record_id", F.when(F.col("error_reason").isNull(), "ok").otherwise("dlq").alias("route"), "error_reason",
                       F.col("rec.customer_id").cast("string").alias("customer_id"),
                       F.col("rec.name").alias("name"))


# ----------------------------------------------------------------- U-R (SQL surface)
@query("json_address_sql")
def json_address_sql(spark: SparkSession, sf: str) -> DataFrame:
    """U-R + U-T1 + J11 in SQL: LEFT JOIN LATERAL .. ON TRUE written as the generator
    ``LATERAL VIEW OUTER inline(..)`` over the function's array (no decorrelation
    join, no shuffle; a SQL function cannot sit inside the generator itself)."""
    from rillet.functions.sql import register_sql_functions
    register_sql_functions(spark)
    fx.customers_json(spark, sf).createOrReplaceTempView("customers_json")
    return spark.sql("""
        SELECT c.customer_id, c.name, c.email, a.street, a.postcode, a.city
        FROM (SELECT *, unnest_json_address_rows(full_address, FALSE) AS address_rows
              FROM customers_json) c
        LATERAL VIEW OUTER inline(c.address_rows) a AS street, postcode, city""")


@query("json_array_sql")
def json_array_sql(spark: SparkSession, sf: str) -> DataFrame:
    """U-R + U-T2 + J12 in SQL: CROSS JOIN LATERAL as ``LATERAL VIEW inline(..)``
    (rows without e-mails are dropped)."""
    from rillet.functions.sql import register_sql_functions
    register_sql_functions(spark)
    fx.customer_emails_json(spark, sf).createOrReplaceTempView("customer_emails_json")
    return spark.sql("""
        SELECT c.customer_id, c.name, e.email_index, e.email
        FROM (SELECT *, normalize_json_array_rows(emails, FALSE) AS email_rows FROM customer_emails_json) c
        LATERAL VIEW inline(c.email_rows) e AS email_index, email""")
