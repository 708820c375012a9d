"""Sources (TSV messages, stopwords, prediction inputs, test-table binding) and text sinks."""
