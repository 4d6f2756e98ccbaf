"""The model run on the driver's tables: inputs, registered queries and their SQL twins."""
