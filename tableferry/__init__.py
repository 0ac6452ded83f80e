"""Move versioned lake tables into query-ready warehouse tables and prove the move was right."""

__version__ = "0.1.0"
