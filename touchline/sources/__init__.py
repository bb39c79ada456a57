"""Sources and sinks: driver tables, JSON envelopes, seeds, warehouse IO."""
