"""``Column -> Column`` functions."""
