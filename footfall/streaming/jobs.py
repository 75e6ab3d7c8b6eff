"""The three source applications as Structured Streaming jobs.

Each ``*_documents`` function turns source streams into the document
streams of its indexes (pure DataFrame code, testable with batch inputs
too); each ``start_*`` function starts one checkpointed, replay-safe query
per index. The ``arrival`` column is the clock: a watermark of
``settings.watermark_delay`` lets Spark close windows and drop state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from footfall import settings as S
from footfall.operators import foot_traffic as ft
from footfall.operators import instore, proximity, shared
from footfall.plans import documents as docs
from footfall.settings import DEFAULTS, Settings
from footfall.streaming import prefix
from footfall.streaming.published import publish_batch, publisher
from footfall.streaming.sinks import checkpoint_of, file_writer, write_batch, write_documents


def with_clock(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Declare ``arrival`` as the event-time clock of a stream (no-op in batch, and where ``clock.with_ticks`` did)."""
    if not df.isStreaming or "spark.watermarkDelayMs" in df.schema["arrival"].metadata:
        return df
    return df.withWatermark("arrival", settings.watermark_delay)


def foot_traffic_documents(readings: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Documents per key, and the range documents behind them. Each of a stream's two is a read of its own;
    ``start_foot_traffic`` writes both from one."""
    clocked = with_clock(readings, settings)
    nested = ft._nested(settings)
    if clocked.isStreaming and nested:
        return _foot_traffic_split(prefix.foot_traffic_rows(clocked, settings), settings)
    running = ft.running_by_zone(clocked) if clocked.isStreaming else clocked
    out = {S.INDEX_FOOT_TRAFFIC: docs.foot_traffic_docs(ft.foot_traffic_as_coded(running, settings))}
    if nested:
        out[f"{S.INDEX_FOOT_TRAFFIC}-ranges"] = docs.foot_traffic_factor_docs(ft.foot_traffic_factors(running, settings))
    return out


def _foot_traffic_split(rows: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    return {S.INDEX_FOOT_TRAFFIC: docs.foot_traffic_docs(prefix.keys_of(rows, settings)),
            f"{S.INDEX_FOOT_TRAFFIC}-ranges": docs.foot_traffic_factor_docs(prefix.ranges_of(rows, settings))}


def proximity_documents(readings: DataFrame, settings: Settings = DEFAULTS,
                        threshold: int | None = None) -> dict[str, DataFrame]:
    prox = proximity.proximity_traffic_as_coded(with_clock(readings, settings), settings)
    return {
        S.INDEX_PROXIMITY: docs.proximity_docs(prox),
        S.INDEX_TRAFFIC_JAM: docs.traffic_jam_docs(
            proximity.traffic_jam_as_coded(prox, settings, threshold)),
        "offer-alerts": docs.alert_docs(proximity.offer_alerts(prox, settings, threshold)),
    }


def instore_documents(purchases: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    p = with_clock(purchases, settings)
    return {
        S.INDEX_CATEGORIES: docs.category_docs(instore.category_count(p, settings)),
        S.INDEX_PAYMENT: docs.payment_docs(instore.payment_method_count(p, settings)),
        S.INDEX_STOCK: docs.stock_docs(instore.stock_availability(p, settings)),
        S.INDEX_SALES: docs.sales_docs(instore.total_sales_as_coded(p, settings)),
    }


def _start_all(streams: dict[str, DataFrame], root: str | None, writer_for=None,
               trigger: dict | None = None, checkpoint_base: str | None = None, zone: str = DEFAULTS.session_zone,
               publish: bool = False) -> dict[str, StreamingQuery]:
    out = {}
    for index, df in streams.items():
        df.sparkSession.conf.set("spark.sql.session.timeZone", zone)
        name = index.replace("-", "_")
        ck = f"{checkpoint_base.rstrip('/')}/{name}" if checkpoint_base else None
        if publish:
            ck = checkpoint_of(df.sparkSession, root, name, ck)
        writer = writer_for(index) if writer_for else publisher(root, index, ck) if publish else None
        out[index] = write_documents(df, index, root=root, checkpoint=ck, writer=writer,
                                     trigger=trigger, query_name=name)
    return out


def _start_split(rows: DataFrame, name: str, split, root: str | None, writer_for, trigger: dict | None,
                 checkpoint_base: str | None, zone: str, publish: bool = False) -> dict[str, StreamingQuery]:
    """One query that writes several indexes: ``split`` takes a micro-batch to its documents by index."""
    rows.sparkSession.conf.set("spark.sql.session.timeZone", zone)
    if writer_for is None and root is None:
        raise ValueError("give a root folder or a writer")
    query = name.replace("-", "_")
    ck = checkpoint_of(rows.sparkSession, root, query, f"{checkpoint_base.rstrip('/')}/{query}" if checkpoint_base else None)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the micro-batch is worked out once, not once per index
        try:
            for index, documents in split(batch).items():
                writer = writer_for(index) if writer_for else publisher(root, index, ck) if publish else file_writer(root, index)
                writer(documents, batch_id)
        finally:
            batch.unpersist()
    return {name: write_documents(rows, name, root=root, checkpoint=ck, writer=write, trigger=trigger, query_name=query)}


def write_all(documents: dict[str, DataFrame], root: str, publish: bool = False) -> dict[str, str]:
    """Batch counterpart of the ``start_*`` functions: one folder per index; with ``publish``, one run."""
    return {index: publish_batch(df, root, index) if publish else write_batch(df, index, root) for index, df in documents.items()}


def start_foot_traffic(readings: DataFrame, root: str | None = None, settings: Settings = DEFAULTS,
                       writer_for=None, trigger: dict | None = None,
                       checkpoint_base: str | None = None, publish: bool = False) -> dict[str, StreamingQuery]:
    """``readings``: zone 1..3 reading streams unioned (``zone`` column set). One query reads them and writes
    both indexes (two, if the join windows do not nest)."""
    if not (readings.isStreaming and ft._nested(settings)):
        return _start_all(foot_traffic_documents(readings, settings), root, writer_for, trigger,
                          checkpoint_base, settings.session_zone, publish)
    return _start_split(prefix.foot_traffic_rows(with_clock(readings, settings), settings), S.INDEX_FOOT_TRAFFIC,
                        lambda rows: _foot_traffic_split(rows, settings), root, writer_for, trigger, checkpoint_base, settings.session_zone, publish)


def start_proximity(readings: DataFrame, root: str | None = None, settings: Settings = DEFAULTS,
                    writer_for=None, trigger: dict | None = None,
                    threshold: int | None = None,
                    checkpoint_base: str | None = None, publish: bool = False) -> dict[str, StreamingQuery]:
    """``readings``: the zone-1 reading stream."""
    return _start_all(proximity_documents(readings, settings, threshold), root, writer_for,
                      trigger, checkpoint_base, settings.session_zone, publish)


def _instore_split(facts: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    by_kind = shared.split(facts, settings)
    return {S.INDEX_CATEGORIES: docs.category_docs(by_kind["category"]), S.INDEX_PAYMENT: docs.payment_docs(by_kind["payment"]),
            S.INDEX_STOCK: docs.stock_docs(by_kind["stock"]), S.INDEX_SALES: docs.sales_docs(by_kind["sales"])}


def start_instore_shared(purchases: DataFrame, root: str | None = None, settings: Settings = DEFAULTS,
                         writer_for=None, trigger: dict | None = None,
                         checkpoint_base: str | None = None, publish: bool = False) -> dict[str, StreamingQuery]:
    """The four in-store indexes from one read of the tills, in one query (see ``operators.shared``)."""
    facts = shared.instore_facts(with_clock(purchases, settings), settings)
    return _start_split(facts, "instore", lambda batch: _instore_split(batch, settings), root, writer_for, trigger,
                        checkpoint_base, settings.session_zone, publish)


def write_instore_shared(purchases: DataFrame, root: str, settings: Settings = DEFAULTS) -> dict[str, str]:
    """Batch counterpart: the purchases are read once, the four folders are written from their aggregate."""
    facts = shared.instore_facts(purchases, settings).persist()
    try:
        return write_all(_instore_split(facts, settings), root)
    finally:
        facts.unpersist()


def start_instore(purchases: DataFrame, root: str | None = None, settings: Settings = DEFAULTS,
                  writer_for=None, trigger: dict | None = None,
                  checkpoint_base: str | None = None, publish: bool = False) -> dict[str, StreamingQuery]:
    """``purchases``: POS1 and POS2 streams unioned (``pos`` column set)."""
    return _start_all(instore_documents(purchases, settings), root, writer_for, trigger,
                      checkpoint_base, settings.session_zone, publish)
