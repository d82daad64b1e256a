"""Plans: the shared feature definition and the train / test / predict pipeline."""
