"""The analytics: every operator takes ``Tables`` or a result and returns a DataFrame."""
