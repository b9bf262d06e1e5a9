"""Jobs: landing extract per hospital, claims/CPT to bronze, medallion refresh."""
