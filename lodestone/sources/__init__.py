"""Sources: file parsers, connectors and the document-store scan."""
