"""Sinks: insert/update tagging and splitting, merged target frames, JDBC and
file writers, and saving changed data sets in order of last change."""
