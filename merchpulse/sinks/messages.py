"""Quota messages (K5-K9): the payload a broker publisher would send.

The quota table already holds one row per merchant, so every message
shape is a projection of that row -- an ``explode`` of the ten quotas for
the line forms, a ``to_json`` of a fixed-order struct for the envelope --
and nothing is regrouped or shuffled.  Publishing the rows to a broker is
the caller's sink (``foreachBatch`` or a connector).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchpulse.plans.periods import _as_date
from merchpulse.schema import KEY, QUOTA_NAMES, QUOTAS

DEFAULT_ITEM = "merchant_health"
DEFAULT_FLAG = "2"


def message_month(as_of) -> str:
    """K9: the message time is the reference month as ``yyyyMM``."""
    d = _as_date(as_of)
    return f"{d.year:04d}{d.month:02d}"


def _value_text(q: str) -> Column:
    """The value as the published line shows it: Java text, ``None`` if absent."""
    return F.coalesce(F.col(q).cast("string"), F.lit("None"))


def quota_messages(quotas: DataFrame, as_of, item_name: str = DEFAULT_ITEM, flag: str = DEFAULT_FLAG,
                   names: dict = QUOTA_NAMES, codes: dict | None = None) -> DataFrame:
    """Long form: one row per (merchant, quota) with the message fields.

    ``quota_code`` defaults to the quota column name.
    """
    codes = codes or {q: q for q in QUOTAS}
    items = F.array(
        *[
            F.struct(
                F.lit(i).alias("pos"),
                F.lit(codes[q]).alias("quota_code"),
                F.lit(names[q]).alias("quota_name"),
                F.col(q).cast("double").alias("quota_value"),
                _value_text(q).alias("value_text"),
            )
            for i, q in enumerate(QUOTAS)
        ]
    )
    return quotas.select(
        F.lit(item_name).alias("quota_item_name"),
        F.col(KEY).alias(KEY),
        F.lit(flag).alias("index_flag"),
        F.lit(message_month(as_of)).alias("target_time"),
        F.explode(items).alias("q"),
    ).select("quota_item_name", KEY, "q.pos", "q.quota_code", "q.quota_name", "index_flag", "target_time",
             "q.quota_value", "q.value_text")


def quota_lines(messages: DataFrame, sep: str = "\t") -> DataFrame:
    """K5: ``item, uuid, code, flag, time, value`` lines."""
    return messages.select(
        F.concat_ws(sep, "quota_item_name", KEY, "quota_code", "index_flag", "target_time", "value_text").alias("value")
    )


def quota_lines_named(messages: DataFrame, sep: str = "\t") -> DataFrame:
    """K6: ``uuid, item, code, name, flag, time, value`` lines (uuid and item
    swap places relative to K5)."""
    return messages.select(
        F.concat_ws(sep, KEY, "quota_item_name", "quota_code", "quota_name", "index_flag", "target_time",
                    "value_text").alias("value")
    )


def quota_json(quotas: DataFrame, as_of, item_name: str = DEFAULT_ITEM, flag: str = DEFAULT_FLAG,
               named: bool = False, names: dict = QUOTA_NAMES, codes: dict | None = None) -> DataFrame:
    """K7/K8: one JSON envelope per merchant,
    ``{"quotaItemName", "propertyUuid", "quotaItemList": [...]}``, list in
    slot order; each item carries ``quotaName`` only when ``named``.
    An absent value is written as ``null``."""
    codes = codes or {q: q for q in QUOTAS}
    month = message_month(as_of)

    def item(q):
        fields = [F.lit(flag).alias("indexFlag")]
        if named:
            fields.append(F.lit(names[q]).alias("quotaName"))
        fields += [
            F.lit(codes[q]).alias("quotaCode"),
            F.lit(month).alias("targetTime"),
            F.col(q).alias("quotaValue"),  # an integer quota prints as an integer
        ]
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    # items differ in type, so the list is joined as text
    head = F.to_json(F.struct(F.lit(item_name).alias("quotaItemName"), F.col(KEY).alias("propertyUuid")), {"ignoreNullFields": "false"})
    envelope = F.concat(
        F.expr("substring({0}, 1, length({0}) - 1)".format("head")), F.lit(',"quotaItemList":['), F.concat_ws(",", *[item(q) for q in QUOTAS]), F.lit("]}")
    )
    return quotas.withColumn("head", head).select(F.col(KEY), envelope.alias("json"))
