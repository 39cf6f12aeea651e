"""DataFrame operators that stay balanced when one key holds much of a table."""
