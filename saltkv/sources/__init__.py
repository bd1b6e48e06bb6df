"""Sources and sinks: table descriptions, delimited batches, the published table."""
