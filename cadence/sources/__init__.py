"""Sources and sinks: landed JSON pages, staging files, the warehouse store,
feeds from the driver tables, and an optional JDBC connector."""
