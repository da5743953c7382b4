"""Writers of tables, logs and manifests."""
