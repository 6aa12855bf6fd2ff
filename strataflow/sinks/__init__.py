"""Writers: layers, numbered snapshots, JDBC tables and Kafka topics."""
