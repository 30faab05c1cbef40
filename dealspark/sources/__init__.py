"""Sources and sinks: layered paths, raw CSV / Parquet readers, writers and
adapters that expose the CRM entities from the driver's benchmark tables."""
