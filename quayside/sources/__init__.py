"""Sources and sinks: Kafka/file/JDBC readers, the replayed topics, writers."""
