"""Writers: tables, exports and publication."""
