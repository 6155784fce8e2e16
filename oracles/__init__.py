"""Reference answers as DuckDB SQL, one statement per registered query."""
