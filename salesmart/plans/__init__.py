"""Table sets, period parameters, mart build / refresh / IO, publication."""
