"""DuckDB's say on the queries that SQL can express."""

from __future__ import annotations

from veristream.llm import line_dedup, mixing, source_audit

ORACLE: dict[str, str] = {"op3_line_dedup": line_dedup.SQL, "op8_mixing": mixing.SQL, "op11_source_audit": source_audit.SQL}
