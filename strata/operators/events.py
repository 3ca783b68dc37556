"""Event operators: first event of a type, lifecycle events from a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.constants import (EVENT_CLOSURE, EVENT_FILING, EVENT_ORDER, EVENT_SENTENCE,
                              ORDER_BASE_DAYS, ORDER_SPREAD_MOD, SENTENCE_LEAD_DAYS)


def first_event(events: DataFrame, key: str, date_col: str, type_col: str,
                type_value, out: str) -> DataFrame:
    """``min(date)`` per key over the events of one type (reactivation-safe).

    A grouped minimum: partial aggregation per task, so a case with a huge event
    history costs one row per map task in the shuffle.
    """
    return (events.filter(F.col(type_col) == F.lit(type_value))
                  .groupBy(key).agg(F.min(date_col).alias(out)))


def first_event_by_code(events: DataFrame, codes: DataFrame, key: str, date_col: str,
                        type_id_col: str, code_id_col: str, code_desc_col: str,
                        description: str, out: str) -> DataFrame:
    """``first_event`` where the type is named in a code table.

    The code table is a literal lookup (bounded), broadcast; Catalyst pushes the
    description filter into it before the join.
    """
    wanted = codes.filter(F.col(code_desc_col) == F.lit(description)).select(
        F.col(code_id_col).alias("_type"))
    tagged = events.join(F.broadcast(wanted), events[type_id_col] == F.col("_type"), "left_semi")
    return tagged.groupBy(key).agg(F.min(date_col).alias(out))


def lifecycle_events(cases: DataFrame, key: str, open_col: str, close_col: str,
                     type_col: str = "event_type_id", date_col: str = "event_date") -> DataFrame:
    """Four event kinds per case from one scan (a UNION ALL of four branches).

    filing = open date; order = open + 30 + (id % 200) days; and, for closed cases
    only, sentence = close - 20 days and closure = close date. Built as an array of
    structs exploded in place, so the input is read once.
    """
    o, c, k = F.col(open_col), F.col(close_col), F.col(key)
    offset = (F.lit(ORDER_BASE_DAYS) + (k % F.lit(ORDER_SPREAD_MOD))).cast("int")

    def ev(type_id, date):
        return F.struct(F.lit(type_id).alias(type_col), date.alias(date_col))

    closed = c.isNotNull()
    events = F.array_compact(F.array(
        ev(EVENT_FILING, o),
        ev(EVENT_ORDER, F.date_add(o, offset)),
        F.when(closed, ev(EVENT_SENTENCE, F.date_sub(c, SENTENCE_LEAD_DAYS))),
        F.when(closed, ev(EVENT_CLOSURE, c)),
    ))
    return (cases.select(k, F.explode(events).alias("_e"))
                 .select(k, F.col(f"_e.{type_col}"), F.col(f"_e.{date_col}")))
