from shopflow.streaming.events import (  # noqa: F401
    alerts, decode_events, dedupe_events, run_for, enrich_events, start_batches, stream_by_payment,
    stream_by_platform,
)
