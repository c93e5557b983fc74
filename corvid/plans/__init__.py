"""Plans: bindings of the driver tables and the registered queries."""
