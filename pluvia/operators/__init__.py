"""DataFrame operators (``DataFrame -> DataFrame``), column-parameterised."""
