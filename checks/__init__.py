"""DuckDB SQL that recomputes the registered queries."""
