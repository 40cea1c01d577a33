"""What longer plans share: written tables between their steps, and numbering of rows."""
