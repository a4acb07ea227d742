"""``DataFrame -> DataFrame`` operators; none of them runs a job by itself
except where its docstring says so."""
