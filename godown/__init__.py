"""godown: supply-chain analytics as Spark DataFrame operators.

Every public function takes DataFrames (and plain parameters) and returns a DataFrame; nothing is
collected to the driver except a handful of scalars the model step needs.
"""

__version__ = "0.1.0"
