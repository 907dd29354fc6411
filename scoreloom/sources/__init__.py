"""Where sequences come from: dataset indexes, raw files, decoders, and tables of events."""
