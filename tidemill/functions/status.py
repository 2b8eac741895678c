"""Status labels: a raw status becomes a message key, and the key its text."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .messages import MESSAGES


def message(key: Column, messages: dict[str, str] = MESSAGES) -> Column:
    """A known key's text; an unknown key is its own."""
    # One literal, folded to a map when the query is planned.
    table = F.from_json(F.lit(json.dumps(messages)), "map<string,string>")
    return F.coalesce(F.try_element_at(table, key), key)


def _first(c: Column, old: str, new: str) -> Column:
    """Replaces the first occurrence only."""
    return F.regexp_replace(c, f"(?s)^(.*?){old}", f"$1{new}")


def status_key(raw: Column) -> Column:
    # Each step sees what the one before has made of it.
    key = F.upper(raw)
    for old, new in (("DEL", "INA"), ("ACT", "ROM_ACT"), ("INA", "ROM_INA"), ("DEL", "INA")):
        key = _first(key, old, new)
    return F.coalesce(key, F.lit(""))


def status_label(raw: Column, registered: Column, messages: dict[str, str] = MESSAGES) -> Column:
    """registered: whether the record has a registration number, which tells the two kinds of pending apart."""
    key = status_key(raw)
    pending = F.replace(key, F.lit("PEND"), F.when(registered, F.lit("PEND_SD")).otherwise(F.lit("PEND_APP")))
    return message(F.concat(F.lit("STATUS_"), F.when(F.contains(key, F.lit("PEND")), pending).otherwise(key)), messages)
