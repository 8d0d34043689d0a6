"""Reading tables: databases, the catalog, documents."""
