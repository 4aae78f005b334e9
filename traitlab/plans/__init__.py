"""Jobs (feature build, attribute inference) and the registered queries."""
