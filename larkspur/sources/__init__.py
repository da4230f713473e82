"""Sources and sinks: table loading, stream stand-ins derived from tables,
Kafka / JDBC / file connectors (option builders) and sinks."""
