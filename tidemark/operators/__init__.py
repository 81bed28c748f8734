"""Batch operators: candles, alerts, keyed tables, quality, privacy, marts, maintenance."""
