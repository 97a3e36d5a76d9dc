"""Row-local Column builders: text, line signals, time, fixed values."""
