"""Models built from the operators: staging, intermediate, mart, serving, whole runs."""
