"""DataFrame operators.  Column names are arguments, so each works on any table."""
