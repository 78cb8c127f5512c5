"""Sources (trip files, zone CSV, semi-structured paths) and sinks."""
