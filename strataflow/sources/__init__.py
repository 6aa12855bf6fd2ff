"""Readers: files, JDBC tables and Kafka topics."""
