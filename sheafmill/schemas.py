"""The tables that pass between operators, as DDL strings."""

ELEMENT = (
    "doc_id string, element_no int, element_type string, file_type string, file_name string, source string, page int, pages array<int>, section string, is_heading boolean, region string, "
    "table_id string, title string, heading string, sheet_name string, sheet_index int, sheet_state string, block_range string, secondary_sheet boolean, kind string, merged_parts int, part_titles array<string>, "
    "has_header boolean, columns array<string>, headers array<string>, rows array<array<string>>, n_rows int, text string, error string"
)
NUMBERS = ("amount", "quantity", "unit_price", "discount", "score", "metric_a", "metric_b")
#: Fields of a master record in order; those in NUMBERS are doubles with a sibling ``*_is_int``.
MASTER = (
    "record_id", "name", "date_raw", "date_iso", "entity_site", "location", "department", "category", "amount", "quantity", "unit_price", "discount", "priority", "email", "phone", "product", "code", "score",
    "last_updated_raw", "metric_a", "metric_b", "status", "owner", "manager", "notes", "source_fields", "source_file", "sheet_name", "block_range", "source_pages", "flags",
)
INFO = ("document_type", "title", "revision", "date_range", "date", "name", "organization", "department", "designation", "email", "phone", "summary")
