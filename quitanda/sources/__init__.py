"""Record feeds, the raw landing store and the warehouse tables."""
