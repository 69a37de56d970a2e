"""Streaming queries (K1-K5): run with ``availableNow`` over the events file
stream, then read the maintained table back as a DataFrame."""

from __future__ import annotations

from ..sources import fixtures as fx
from ..streaming import quotes as K
from .registry import query

_QUOTES = """
SELECT e.user_id + 1000000 AS instrument_token, e.ts, e.event_id, e.value AS last_price,
       coalesce(CAST(json_extract_string(e.props, '$.k') AS DOUBLE) * 100, 0.0) AS volume,
       coalesce(i.tradingsymbol, CAST(e.user_id + 1000000 AS VARCHAR)) AS symbol
FROM events e LEFT JOIN instruments i ON i.instrument_token = e.user_id + 1000000"""


@query("stream_latest_quote", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_id DESC) AS rn
                            FROM quotes) WHERE rn = 1""", ("instruments",),
       doubles="last_price volume", extra=[("quotes", _QUOTES)])
def stream_latest_quote(spark, sf_dir):
    """K1 + K2: token intake (stream-static join) and the latest quote per symbol."""
    raw = K.raw_quotes(K.file_stream(spark, sf_dir, "events"))
    ticks = K.tick_intake(raw, fx.instruments(spark, sf_dir))
    out, ck = K.scratch(spark, "latest-quote"), K.scratch(spark, "ck-latest-quote")
    K.latest_quotes(ticks, out, ck, arrival="event_id").awaitTermination()
    return K.taken(spark, out, ck)


@query("stream_daily_signals", """
SELECT CAST(timestamp AS DATE) AS date, symbol AS ticker, count(*) AS signal_count,
       avg(confidence) AS avg_confidence, count_if(action = 'BUY') AS buy_signals,
       count_if(action = 'SELL') AS sell_signals, count_if(action = 'HOLD') AS hold_signals
FROM signals GROUP BY 1, 2""", ("signals",), doubles="avg_confidence")
def stream_daily_signals(spark, sf_dir):
    """K5: daily signal counts maintained by a watermarked streaming aggregate."""
    sig = K.signal_records(K.file_stream(spark, sf_dir, "events"))
    out, ck = K.scratch(spark, "daily-signals"), K.scratch(spark, "ck-daily-signals")
    K.run_daily_signal_counts(sig, out, ck).awaitTermination()
    return K.taken(spark, out, ck)


@query("stream_quote_polling", """
SELECT symbol, ts, last_price, 0.0::DOUBLE AS open, 0.0::DOUBLE AS high, 0.0::DOUBLE AS low,
       0.0::DOUBLE AS close, volume,
       CAST(ts AS DATE) AS date
FROM quotes
WHERE isodow(ts) < 6 AND strftime(ts, '%H:%M:%S.%f') BETWEEN '09:15:00.000000' AND '15:30:00.000000'""",
       ("instruments",), doubles="last_price open high low close volume", extra=[("quotes", _QUOTES)])
def stream_quote_polling(spark, sf_dir):
    """K3: flatten, keep market hours, back up as JSON and append per batch."""
    raw = K.raw_quotes(K.file_stream(spark, sf_dir, "events"))
    ticks = K.tick_intake(raw, fx.instruments(spark, sf_dir))
    out, bak, ck = (K.scratch(spark, n) for n in ("quotes", "quotes-json", "ck-quotes"))
    K.quote_polling(ticks, out, bak, ck).awaitTermination()
    return K.taken(spark, out, bak, ck).drop("batch")
