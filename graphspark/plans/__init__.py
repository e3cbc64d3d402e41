"""Plans: compositions of operators (retrieval end to end), the graph derived
from the driver tables, and the registered query catalogue."""
