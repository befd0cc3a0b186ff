"""Column helpers shared by every operator (Spark side and oracle text side)."""
