"""Column functions: months, classification, codes and formats."""
