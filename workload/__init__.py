"""The queries of the driver contract: each operator on the given tables, with the SQL it must agree with."""
