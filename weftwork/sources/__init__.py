"""Readers: files, sequences of files, configuration, JDBC, and Kafka."""
