"""Sources: JDBC extract (S1/S2), typed CSV scans (S3-S5), landing-JSON scans (S6), tables."""
