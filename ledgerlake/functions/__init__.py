"""Column functions (text, money, dates) and fixed lookup values."""
