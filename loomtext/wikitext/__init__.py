"""The grammar that needs a stack or recursion, in plain Python without Spark."""
