"""Structured Streaming: message streams, built-in windowed aggregation with
watermarks (update = accumulating early results, append = final results),
redelivery removal, panes on ``transformWithState``, a refreshing lookup and one
query per sink."""
