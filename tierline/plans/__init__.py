"""Plans: catalog objects (S5-S8, S10), sinks (S2-S4, S9) and the layer pipeline."""
