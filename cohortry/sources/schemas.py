"""Explicit schemas of the raw and prepared tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _B, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()
# Amounts have two decimals. A decimal makes sums independent of row order.
MONEY = T.DecimalType(18, 2)


def _schema(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


TRANSACTIONS = _schema(
    id=_L, timestamp=_TS, company_id=_L, company_plan=_S, channel=_S, success=_B,
    state=_S, sender_name=_S, sender_country=_S, sendable_type=_S, **{"import": MONEY},
    international=_B, kind=_S, document_kind=_S, receiver_name=_S,
    sender_xin_value=_S, receiver_xin_value=_S,
)

REGISTRY = _schema(
    company_id=_L, country=_S, data_alta=_TS, data_subscripcio=_TS, plan=_S,
    date_first_client=_TS, date_first_invoice=_TS, number_clients=_I, postal_code=_S,
    date_last_updated=_TS, company_name=_S, xin_value=_S,
)

LIFECYCLE = T.StructType(
    [T.StructField("@timestamp", _TS)]
    + _schema(
        company=_L, action=_S, plan=_S, payment_type=_S, company_name=_S, altes=_L,
        date_last_updated=_TS, event_id=_S,
    ).fields
)

COMPANIES = _schema(
    company=_L, data_alta_basic=_TS, data_alta_premium=_TS, country=_S,
    date_first_client=_TS, date_first_invoice=_TS, number_clients=_I, postal_code=_S,
    company_name=_S, xin_value=_S, days_until_premium=_L, days_until_invoice=_L,
    days_until_client=_L, active_prem=_I,
)

CHURN = _schema(
    company=_L, data_baixa_prem=_TS, days_active_prem=_L, churn_plan=_I, churn=_I
)

CHURN_BASIC = T.StructType(
    [T.StructField("company", _L), T.StructField("@timestamp", _TS),
     T.StructField("action", _S), T.StructField("plan", _I)]
)
