"""Reading pages of records, logs, sidecars, file inventories and archives; writing results."""
