"""Row shapes shared by the package."""

from __future__ import annotations

FINDINGS = (
    "id string, severity string, subject string, message string, "
    "detail string, path string, line int"
)
ISSUES = "subject string, source string, code string, message string, path string, line int"
SHEET = (
    "subject string, line int, sample_id string, input_type string, input string, "
    "library_id string, extra map<string,string>, path string"
)
OBJECTS = (
    "accession string, dir string, name string, key string, size bigint, "
    "etag string, last_modified string"
)

FINDING_COLUMNS = ["id", "severity", "subject", "message", "detail", "path", "line"]
