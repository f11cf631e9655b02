"""Sources and sinks: CSV tables, Kafka-shaped records, the provided test tables."""
