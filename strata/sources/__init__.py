"""Sources and sinks: driver tables, landed JSON envelopes, layer tables."""
