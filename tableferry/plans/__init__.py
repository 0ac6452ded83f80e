"""Reports, sample tables and table moves built from the operators."""
