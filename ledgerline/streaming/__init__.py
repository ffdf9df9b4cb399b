from ledgerline.streaming.landing import StreamingIngest, stream_ingest

__all__ = ["StreamingIngest", "stream_ingest"]
