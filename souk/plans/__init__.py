"""How the operators run at scale: sessions, materialised tables, selection, slices."""
