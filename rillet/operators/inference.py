"""Model scoring.

``predict`` appends one output column per row from a pluggable predictor: a
Catalyst expression (the default rule model, fully JVM-side) or a Python
callable applied with an iterator pandas UDF, which loads the model once per
Python worker and scores Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.functions.scalar import account_lookup, let, parse_account_json
from rillet.sources.fixtures import MERCHANTS

RISK_HIGH, RISK_MEDIUM, RISK_LOW = "HIGH", "MEDIUM", "LOW"
# Fixed values of the classifier prompt: HIGH above 5000, MEDIUM 1000-5000.
HIGH_AMOUNT, MEDIUM_AMOUNT = 5000, 1000
HOTLINE = "1-800-BANK-HELP"


def transaction_prompt(amount: Column, ttype: Column, status: Column, merchant: Column) -> Column:
    """I1 input text: ``amount:<v>, type:<v>, status:<v>, merchant:<v>``."""
    return F.concat(F.lit("amount:"), amount.cast("string"), F.lit(", type:"), ttype,
                    F.lit(", status:"), status, F.lit(", merchant:"), merchant)


def rule_risk(amount: Column, ttype: Column, status: Column, merchant: Column,
              recurring_failed: Column | None = None, known_merchants: list[str] = MERCHANTS) -> Column:
    """The classifier prompt's rules as a Catalyst CASE (the default predictor)."""
    unknown = ~merchant.isin(*known_merchants) | merchant.isNull()
    high = (amount > HIGH_AMOUNT) | ((status == "Failed") & (ttype == "payment")) | unknown
    medium = amount.between(MEDIUM_AMOUNT, HIGH_AMOUNT)
    if recurring_failed is not None:
        medium = medium | recurring_failed
    return F.when(high, RISK_HIGH).when(medium, RISK_MEDIUM).otherwise(RISK_LOW)


def prompt_risk(text: Column) -> Column:
    """The rule model over the prompt text, as an expression: it stays in the JVM."""
    part = lambda i: F.regexp_extract(text, r"amount:([^,]*), type:([^,]*), status:([^,]*), merchant:(.*)", i)
    return rule_risk(part(1).try_cast("decimal(38,2)"), part(2), part(3), part(4))


def predict_expression(df: DataFrame, text: Column, model: Callable[[Column], Column], *, output_col: str = "risk_level") -> DataFrame:
    """I1 with a model that is an expression of the text, such as :func:`prompt_risk`."""
    return df.withColumn(output_col, model(text))


def predict(df: DataFrame, text: Column, predictor: Callable[[pd.Series], pd.Series] | Column, *,
            output_col: str = "risk_level", return_type: str = "string",
            loader: Callable[[], Callable[[pd.Series], pd.Series]] | None = None) -> DataFrame:
    """``ML_PREDICT(model, text)`` - one output value appended per row.

    ``predictor`` is a pandas function of the texts; with ``loader``, the model is built once
    per Python worker (iterator UDF) instead of once per batch.  A Column stands for a score
    that is there already; for a model in the JVM see :func:`predict_expression`.
    """
    if isinstance(predictor, Column):
        return df.withColumn(output_col, predictor)

    @F.pandas_udf(return_type)
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loader() if loader else predictor
        for b in batches:
            yield model(b)

    return df.withColumn(output_col, _score(text))


def parse_prompt_rules(texts: pd.Series) -> pd.Series:
    """The rule model over the prompt text (for the pandas predictor path)."""
    parts = texts.str.extract(r"amount:([^,]*), type:([^,]*), status:([^,]*), merchant:(.*)")
    amount = pd.to_numeric(parts[0], errors="coerce")
    high = (amount > HIGH_AMOUNT) | ((parts[2] == "Failed") & (parts[1] == "payment")) | ~parts[3].isin(MERCHANTS)
    medium = amount.between(MEDIUM_AMOUNT, HIGH_AMOUNT)
    out = pd.Series(RISK_LOW, index=texts.index)
    out[medium.fillna(False)] = RISK_MEDIUM
    out[high.fillna(False)] = RISK_HIGH
    return out


def extract_account(text: Column) -> Column:
    """The account named in a support question (``ACC`` + digits)."""
    acct = F.regexp_extract(text, r"(ACC[0-9]+)", 1)
    return F.when(acct != "", acct)


def default_responder(info: Column) -> Column:
    """Compose a 2-3 sentence answer from the looked-up account fields."""
    base = F.concat(
        F.lit("Account "), info["account_number"], F.lit(" is "), info["status"],
        F.lit(" with a balance of "), F.format_string("%.2f", info["balance"]),
        F.lit(". The last transaction was "), F.format_string("%.2f", info["last_transaction_amount"]),
        F.lit(" on "), info["last_transaction_date"], F.lit("."))
    alert = F.concat(F.lit(" An alert is set on this account; please call "), F.lit(HOTLINE), F.lit("."))
    return F.when(info["error"].isNotNull(), F.lit("Please provide your account number."))\
        .otherwise(F.concat(base, F.when(info["alert_flag"], alert).otherwise(F.lit(""))))


def support_answers(queries: DataFrame, *, text_col: str = "query_text",
                    responder: Callable[[Column], Column] = default_responder,
                    output_col: str = "agent_response") -> DataFrame:
    """I3 (re-aimed agent run): look up the account named in the question with the
    account tool and answer from its fields; one response row per query."""
    info = parse_account_json(account_lookup(extract_account(F.col(text_col))))
    return queries.withColumn(output_col, let(info, responder))
