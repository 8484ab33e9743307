"""Sources: tables of captured payloads -> decoded payloads or samples."""
