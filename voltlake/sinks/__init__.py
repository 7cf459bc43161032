"""Writers: delimited files and the snapshot archive."""
