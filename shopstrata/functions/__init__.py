"""SQL expression texts: cleaning, lenient parsing, exact rounding.

Each helper takes and returns the text of a Spark SQL expression, to be used in ``selectExpr``
or ``expr``. They are all built-in functions, so they run in generated code, and a projection of
thirty of them is handed over in one call.
"""
