"""Column-expression builders.  Nothing here runs a job."""
