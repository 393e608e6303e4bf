"""Small worlds of deals and touches, and a brute-force reading of the attribution rules over them."""

from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from touchledger.config import DIRECT_CHANNELS, MODELS, AttributionConfig
from touchledger.operators import asof, attribution, journeys
from touchledger.operators.numbering import place_rows
from touchledger.operators.touches import TIMELINE, account_touches

EPOCH = dt.datetime(2025, 6, 1)
DEAL = ("deal_id bigint, company_id bigint, amount decimal(12,2), created_at timestamp, closed_at timestamp, "
        "is_won boolean, is_closed boolean")
TOUCH = ("touchpoint_id string, person_id bigint, company_id bigint, touched_at timestamp, channel string, "
         "touch_type string")


def at(days: float, micros: int = 0) -> dt.datetime:
    return EPOCH + dt.timedelta(days=days, microseconds=micros)


def deal(deal_id, company, day, amount="100.00", won=True):
    created = day if isinstance(day, dt.datetime) else at(day)
    return (deal_id, company, Decimal(amount), created, created if won else None, won, won)


def touch(tid, company, day, channel="referral", person=1):
    return (tid, person, company, day if isinstance(day, dt.datetime) else at(day), channel, "web_session")


def written(df):
    """The frame through a table, as a run writes it."""
    folder = f"{df.sparkSession.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def timeline(touches):
    return account_touches(written(place_rows(
        touches.withColumns({"source_record_id": F.lit("r"), "source_system": F.lit("s")}), TIMELINE)))


def chain(spark, deals, touches, leads=(), cfg=AttributionConfig()):
    """Frames of the attribution chain: anchors, journeys and credit."""
    opps = spark.createDataFrame(list(deals), DEAL)
    touched = spark.createDataFrame(list(touches), TOUCH)
    moments = spark.createDataFrame(list(leads), "deal_id bigint, lead_at timestamp")
    numbered = timeline(touched)
    probes = written(place_rows(journeys.window_probes(opps, numbered, moments, cfg), asof.ORDER))
    anchors = journeys.deal_anchors(opps, probes, moments, cfg)
    pairs = journeys.deal_journeys(anchors, numbered, cfg)
    return opps, anchors, pairs, attribution.fct_attribution(pairs, anchors, cfg)


def brute_force(deals, touches, leads=(), cfg=AttributionConfig()):
    """(deal, model, touch) -> credit, by looping over everything."""
    lead_of, a = dict(leads), cfg.anchor_weight
    credit = {}
    for d in deals:
        created = d[3]
        window = sorted((t for t in touches if t[2] == d[1] and t[3] <= created
                         and t[3] > created - dt.timedelta(days=cfg.lookback_days)), key=lambda t: (t[3], t[0]))
        n = len(window)
        if not n:
            credit.update({(d[0], m, None): 1.0 for m in MODELS})
            continue
        direct = [i for i, t in enumerate(window, 1) if t[4] not in DIRECT_CHANNELS]
        led = [i for i, t in enumerate(window, 1) if lead_of.get(d[0]) and t[3] <= lead_of[d[0]]]
        anchors = [1, led[-1] if led else 1, n]
        shape = [a * anchors.count(i) if i in anchors else (1 - 3 * a) / (n - 3) if n != 3 else None
                 for i in range(1, n + 1)]
        decay = [0.5 ** ((created - t[3]).total_seconds() / 86400 / cfg.half_life_days) for t in window]
        total = sum(s for s in shape if s is not None)
        for i, t in enumerate(window, 1):
            weights = (float(i == 1), float(i == (direct[-1] if direct else n)), 1 / n,
                       None if shape[i - 1] is None else shape[i - 1] / total, decay[i - 1] / sum(decay))
            credit.update({(d[0], m, t[0]): w for m, w in zip(MODELS, weights) if w})
    return credit


def credits_of(df):
    return {(r["deal_id"], r["model"], r["touchpoint_id"]): float(r["credit"]) for r in df.collect()}
