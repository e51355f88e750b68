"""Writers of extraction results."""
