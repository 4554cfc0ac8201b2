"""Writers for the raw and curated zones, catalog tables and JDBC targets."""
