"""Writers: batch folders, replaced tables, refreshed views, load audit."""
