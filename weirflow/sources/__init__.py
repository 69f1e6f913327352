"""Sources: message scans, the document store and its query language."""
