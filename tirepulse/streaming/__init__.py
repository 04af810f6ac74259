"""Streaming entry points.

The analyses are daily batch reports; the only incremental part is the
arrival of new daily report files, handled by ``ingest_stream``.
"""
