"""Sources: adapters from the supplied tables and the raw-record readers."""
