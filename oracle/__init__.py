"""DuckDB SQL that answers the registered queries independently of the Spark code."""
