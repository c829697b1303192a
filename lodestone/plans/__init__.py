"""Plan builders: JSON or SQL descriptions compiled to DataFrame plans."""
